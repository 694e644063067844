"""Patient-level name matching: the name index loses no pair, live sides, null and empty inputs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rxlens.config import ReportConfig
from rxlens.functions.similarity import jaro_winkler_batch, jaro_winkler_scalar
from rxlens.operators.patients import (combination_size, hot_dates, index_candidates, indexable, jaro_needed,
                                       least_common, matched_names, name_keys, rare_first, split_hot)

D1, D2 = dt.date(1950, 1, 1), dt.date(1961, 2, 3)
NAMES = [f"{a} {b}" for a in ("ANN", "ANNE", "JOHN", "JON", "MARIA", "MARY") for b in ("SMITH", "SMYTH", "LEE", "LEA")]


def sides(spark, left, right):
    return (spark.createDataFrame(left, "ld date, ln string, lw int"),
            spark.createDataFrame(right, "rd date, rn string, rw int"))


def pairs(left, right, block, **options):
    hot = hot_dates([(left, "ld"), (right, "rd")], 0)
    if hot is None:
        return set()
    out = matched_names(left, right, ("ld", "ln"), ("rd", "rn"), 0.9, hot, block, **options)
    assert out.columns == ["_dob", "_left_name", "_right_name", "ratio"]
    rows = [tuple(r)[:3] for r in out.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def brute(left, right):
    import pandas as pd
    met = [(d, a, b) for d, a, _ in left for e, b, _ in right if d is not None and d == e and a and b]
    scores = jaro_winkler_batch(pd.Series([m[1] for m in met]), pd.Series([m[2] for m in met]))
    return {m for m, s in zip(met, scores) if round(float(s), 9) >= 0.9}


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_every_block_size_gives_the_brute_force_pairs(spark, block):
    left = [(D1, n, i) for i, n in enumerate(NAMES)] + [(D2, "ANN LEE", 0), (None, "ANN LEE", 0), (D1, None, 0)]
    right = [(D1, n, i) for i, n in enumerate(NAMES[::-1])] * 2 + [(D2, "ANN LEE", 0), (None, "ANN LEE", 0)]
    assert pairs(*sides(spark, left, right), block=block) == brute(left, right)


def test_live_keeps_pairs_with_a_live_side(spark):
    left = [(D1, "ANN LEE", 0), (D1, "ANN LEA", 1)]
    right = [(D1, "ANN LEE", 0), (D1, "ANNE LEE", 1)]
    got = pairs(*sides(spark, left, right), block=2, live=(F.col("lw") == 1, F.col("rw") == 1))
    live = {("ANN LEA"), ("ANNE LEE")}
    assert got == {p for p in brute(left, right) if p[1] in live or p[2] in live}
    assert (D1, "ANN LEE", "ANN LEE") not in got


def test_empty_side(spark):
    assert pairs(*sides(spark, [], [(D1, "ANN LEE", 0)]), block=2) == set()
    assert pairs(*sides(spark, [], []), block=2) == set()


FIRST = ["JOHN", "MARY", "ANN", "PETER", "ANNA", "JON", "MARIE", "PETRA", "JOAN", "ALEXANDER", "BO", "X", "JOSÉ"]
LAST = ["SMITH", "SMYTH", "LEE", "ANDERSON", "ANDERSEN", "LI", "MILLER", "MUELLER", "O", "GARCIA", "GARZIA"]


def mutated(rng, name):
    s = list(name)
    for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
        i, c = rng.randrange(len(s)), rng.choice("ABEINRSTZ ")
        kind = rng.random()
        if kind < .3:
            s[i] = c
        elif kind < .6 and len(s) > 1:
            del s[i]
        elif kind < .8:
            s.insert(i, c)
        else:
            j = (i + 1) % len(s)
            s[i], s[j] = s[j], s[i]
    return "".join(s)


@pytest.mark.parametrize("threshold,k", [(0.9, 2), (0.9, 4), (0.95, 3), (0.8, 2)])
def test_similar_names_share_a_key(threshold, k):
    rng = random.Random(11)
    names = sorted({mutated(rng, f"{rng.choice(FIRST)} {rng.choice(LAST)}") for _ in range(250)} - {""})
    keys = {n: name_keys(n, threshold, k) for n in names}
    similar = [(a, b) for a in names for b in names if round(jaro_winkler_scalar(a, b), 9) >= threshold]
    assert len(similar) > len(names) and all(keys[a] & keys[b] for a, b in similar)


def test_index_bounds():
    assert rare_first("ANNA")[0][2] in "AN" and [t[0] for t in rare_first("ANNA")] == [-2, -2, -1, -1]
    assert jaro_needed(0.9, 4) == pytest.approx(0.5 / 0.6) and jaro_needed(0.7, 4) == 0.7
    assert least_common(12, 12, jaro_needed(0.9, 4)) == 9 and least_common(12, 12, jaro_needed(0.9, 2)) == 10
    assert indexable(0.9) and indexable(0.7) and not indexable(0.5)
    assert [combination_size(n, 100) for n in (1, 100, 399, 400, 1600, 10 ** 9)] == [2, 2, 2, 3, 4, 6]


def test_pairs_that_meet_grow_slower_than_the_square(spark):
    """A placeholder birth date: eight times the names give far less than 64 times the pairs."""
    rng = random.Random(12)
    letters = "EEEEAAAIIIOOUTTTNNNRRRSSSLLDDCCMMPPGHBFVWKXZ"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(4, 8)))
    names = [f"{word()} {word()}" for _ in range(2400)]
    met = []
    for n in (300, 2400):
        left, right = sides(spark, [(D1, x, 0) for x in names[:n]], [(D1, x, 0) for x in names[:n]])
        hot = hot_dates([(left, "ld"), (right, "rd")], 100)
        met.append(index_candidates(left, right, ("ld", "ln"), ("rd", "rn"), 0.9, hot, 100).count())
    assert met[1] < 24 * met[0] and met[1] < 2400 ** 2 / 40, met


def test_hot_dates_and_split(spark):
    left, right = sides(spark, [(D1, "A", 0)] * 5 + [(D2, "B", 0), (None, "C", 0)], [(D2, "B", 0)] * 4)
    hot = hot_dates([(left, "ld"), (right, "rd")], 3)
    assert {(r["_dob"], r["_rows"]) for r in hot.collect()} == {(D1, 5), (D2, 4)}
    assert hot_dates([(left, "ld"), (right, "rd")], 5) is None
    inside, outside = split_hot(left, "ld", hot.where(F.col("_dob") == D1), 10)
    assert inside.count() == 5 and outside.count() == 2


@pytest.mark.parametrize("kind", ["part", "both"])
def test_hot_and_other_dates_give_the_same_overlaps(spark, sf_small, kind):
    from rxlens.plans.queries import plan
    from oracle_check import digest, spark_rows
    want = digest(*spark_rows(plan(spark, sf_small).pairs(kind)))
    sizes = plan(spark, sf_small).active.groupBy("dob").count().agg(F.expr("median(count)")).first()[0]
    for block in (1, max(1, int(sizes / 2))):
        assert digest(*spark_rows(plan(spark, sf_small, name_block=block).pairs(kind))) == want
    counted = [sorted(map(tuple, plan(spark, sf_small, name_block=b).overlap_counts(kind).collect()))
               for b in (1, ReportConfig.name_block)]
    assert counted[0] == counted[1] and counted[0]


def test_large_naive_groups_are_cut(spark, sf_small):
    """Any split gives the same matches; with a third of all rows on one date no part is much over its size."""
    from rxlens.operators.intervals import _large_groups, point_in_interval_join
    from rxlens.plans.queries import plan
    want = sorted(map(tuple, plan(spark, sf_small).naive_matches().collect()))
    assert sorted(map(tuple, plan(spark, sf_small, split_rows=3).naive_matches().collect())) == want
    rows = [(i, D1 if i % 3 == 0 else D2 + dt.timedelta(days=i), dt.date(2020, 1, 1 + i % 20)) for i in range(600)]
    pts = spark.createDataFrame(rows, "i int, d date, at date")
    ivs = spark.createDataFrame([(i, d, at, at + dt.timedelta(days=5)) for i, d, at in rows],
                                "j int, e date, s date, t date")
    join = lambda **o: point_in_interval_join(pts, ivs, [("d", "e")], "at", F.col("s"), F.col("t"), 30, **o)
    plain = sorted((r["i"], r["j"]) for r in join().collect())
    split = join(split_rows=40)
    assert sorted((r["i"], r["j"]) for r in split.collect()) == plain
    bucketed = pts.withColumn("_point_bucket", F.lit(1)), ivs.withColumn("_interval_bucket", F.lit(1))
    hot = _large_groups(*bucketed, [("d", "e")], 40).collect()
    assert [(r["_k0"], r["_rows"], r["_cols"]) for r in hot] == [(D1, 5, 5)]
    assert _large_groups(*bucketed, [("d", "e")], 1000) is None


DAY = dt.date(2024, 4, 10)
JOHNS = [("JOHN", "SMITH"), ("JON", "SMITH"), ("MARY", "JONES"), ("JOHN", "SMYTH")]


def odd_prescriptions(n, seed):
    """Few patients and days; intervals that begin before, on and after the written date, empty ones, nulls, copies."""
    import builders as B
    rng = random.Random(seed)
    day = lambda lo, hi: DAY + dt.timedelta(days=rng.randint(lo, hi))
    rows = []
    for _ in range(n):
        written = day(-35, 35)
        first, last = rng.choice(JOHNS)
        row = list(B.active(dea=rng.choice(["AB1234567", "CD1234567"]), ahfs=rng.choice([B.OPI, B.BZD]), first=first,
                            last=last, dob=rng.choice([D1, D1, D2]), written=written,
                            filled=written + dt.timedelta(days=rng.choice([-6, -1, 0, 0, 1, 4])),
                            create=written + dt.timedelta(days=rng.choice([-7, -1, 0, 1, 3])),
                            days=rng.choice([-3, 0, 1, 8, 30])))
        if rng.random() < 0.15:
            row[rng.choice([3, 4, 6, 7, 8, 9])] = None
        rows += [tuple(row)] * rng.choice([1, 1, 1, 2])
    return rows


@pytest.mark.parametrize("kind", ["part", "last", "both"])
@pytest.mark.parametrize("block", [1, ReportConfig.name_block])
def test_counted_overlaps_are_those_of_the_pairs(spark, kind, block):
    import builders as B
    from rxlens.plans.report import ReportPlan
    p = ReportPlan(B.inputs(spark, users=[B.user(1)], actives=odd_prescriptions(160, 5)),
                   ReportConfig(name_block=block), land_stages=False)
    pairs = p.pairs("both").where("is_part OR is_last").collect()
    first, last = p.cfg.first_date, p.cfg.last_date
    inside = lambda d: d is not None and first <= d <= last
    want = {}
    for r in pairs:
        b, o = r["written_date"], r["written_date_opi"]
        for rule in ("part", "last"):
            if not r[f"is_{rule}"]:
                continue
            later = b is not None and o is not None
            for who, mine, other in (("final_id", b, o), ("final_id_opi", o, b)):
                if inside(mine) and (rule == "part" or (later and mine > other)):
                    want[r[who], rule] = want.get((r[who], rule), 0) + 1
    got = {(r["final_id"], k): r[f"overlapping_rx_{k}"] for r in p.overlap_counts(kind).collect()
           for k in ("part", "last") if kind in (k, "both") and r[f"overlapping_rx_{k}"]}
    assert got == {k: v for k, v in want.items() if kind in (k[1], "both")} and len(got) > 1


def grown(spark, n, kind):
    """One patient with ``n`` prescriptions that all meet: rows that the joins and windows put out."""
    import builders as B
    from rxlens.plans.report import ReportPlan
    actives = [B.active(ahfs=(B.OPI, B.BZD)[i % 2], written=DAY + dt.timedelta(days=i % 7)) for i in range(n)]
    disps = [B.disp(rx=i, written=DAY + dt.timedelta(days=i % 7)) for i in range(n)]
    naives = [B.naive(filled=DAY - dt.timedelta(days=i % 60)) for i in range(n)]
    p = ReportPlan(B.inputs(spark, users=[B.user(1)], actives=actives, disps=disps, naives=naives), ReportConfig())
    return p.naive_matches() if kind == "naive" else p.overlap_counts("part")


@pytest.mark.parametrize("kind", ["naive", "overlap"])
def test_prescriptions_do_not_meet_in_pairs(spark, kind):
    """No join of prescriptions by time is left in the naive match and the overlap counts."""
    df = grown(spark, 60, kind)
    plan_text = df._jdf.queryExecution().optimizedPlan().toString()
    assert "_point_bucket" not in plan_text and "_interval_bucket" not in plan_text
    rows = df.collect()
    assert len(rows) == 60 if kind == "naive" else rows[0]["overlapping_rx_part"] == 2 * 30 * 30


def test_naive_match_is_the_same_both_ways(spark):
    """Names first (the usual way) and times first give what a plain comparison gives; nulls and empty windows too."""
    import builders as B
    from rxlens.functions.similarity import jaro_winkler_scalar
    from rxlens.operators import naive
    from rxlens.plans.report import ReportPlan
    rng = random.Random(9)
    day = lambda lo, hi: DAY + dt.timedelta(days=rng.randint(lo, hi))
    words = ["JOHN", "JON", "MARY", "MARIA", "X", ""]
    name = lambda: (rng.choice(words), rng.choice(["SMITH", "SMYTH", "JONES", None]))
    disps, naives = [], []
    for i in range(120):
        a, b = name(), name()
        disps.append(B.disp(rx=i, first=a[0], last=a[1], dob=rng.choice([D1, D2, None]), written=day(-9, 19)))
        start = day(-40, 19)
        naives.append(B.naive(first=b[0], last=b[1], dob=rng.choice([D1, D2, None]), filled=start,
                              end=start + dt.timedelta(days=rng.randint(-2, 4))))
    cfg = ReportConfig()
    text = lambda x: None if None in x else " ".join(x).upper()
    want = sorted(d[2] for d in disps if d[11] is not None and text(d[4:6]) is not None and any(
        n[1] == d[11] and text(n[2:4]) is not None and n[4] <= d[8] <= n[5]
        and round(jaro_winkler_scalar(text(n[2:4]), text(d[4:6])), 9) >= cfg.naive_ratio for n in naives))
    inputs = B.inputs(spark, users=[B.user(1)], disps=disps, naives=naives)
    assert sorted(r["rx_number"] for r in ReportPlan(inputs, cfg).naive_matches().collect()) == want and want
    slow = ReportPlan(inputs, cfg.with_(name_block=1)).naive_matches()
    assert sorted(r["rx_number"] for r in slow.collect()) == want
    pay = naive.names_pay
    old, naive.names_pay = pay, lambda block: F.lit(False)
    try:
        assert sorted(r["rx_number"] for r in ReportPlan(inputs, cfg).naive_matches().collect()) == want
    finally:
        naive.names_pay = old

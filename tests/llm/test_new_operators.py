"""Operators 11 to 13 against brute force, and their defined results."""

import hashlib
import random
import re
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("rxlens.llm")

from rxlens.llm import fill_middle, jaccard_join, whitening  # noqa: E402
from rxlens.session import ENGINE_CONF  # noqa: E402

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ------------------------------------------------------------------ fill in middle

def cut_by_hand(ident, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'null' if ident is None else ident}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return text, "plain", len(units), None, None
    if h[3] % 100 < 80:
        return f"<S>{s}<P>{p}<M>{m}", "spm", len(units), len(p), len(m)
    return f"<P>{p}<S>{s}<M>{m}", "psm", len(units), len(p), len(m)


def odd_texts(rng, n):
    letters = list("ab<>PSM \t\n\x0b\x0c\r\x1c\x85\xa0 é😀\x00\x1f!\x08\x0e")
    return [rng.choice([None, ""]) if rng.random() < .1 else
            "".join(rng.choice(letters) for _ in range(rng.randint(0, rng.choice([3, 10, 60, 400])))) for _ in range(n)]


def test_units_and_parts_by_hand():
    rng = random.Random(1)
    for _ in range(150):
        texts = odd_texts(rng, rng.randint(0, 25))
        ids = [str(rng.randint(-5, 10 ** 9)) for _ in texts]
        sliced = pa.array(["not", "of this batch", *texts], pa.string())[2:]
        got = [tuple(d.values()) for d in fill_middle.transform(ids, sliced).to_pylist()]
        assert got == [cut_by_hand(i, t) for i, t in zip(ids, texts)]


def test_long_text_is_cut_over_blocks():
    text = ("word\n  " * 400_000) + " "
    got = fill_middle.transform(["3", "4", "9"], pa.array([text] * 3)).to_pylist()
    assert [tuple(d.values()) for d in got] == [cut_by_hand(i, text) for i in ("3", "4", "9")]


def test_fill_in_middle_restores(spark):
    rng = random.Random(2)
    rows = [(i if i % 7 else None, t, "x") for i, t in enumerate(odd_texts(rng, 200))] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, made string")
    out = fill_middle.fill_in_middle(df)
    got = out.select("*", fill_middle.restore(out["fim.text"], out["fim.form"]).alias("again")).collect()
    assert out.columns == ["doc_id", "text", "made", "fim"]
    assert {r["fim"]["form"] for r in got} == {"plain", "psm", "spm"}
    for r in got:
        assert r["again"] == (r["text"] or "") and tuple(r["fim"]) == cut_by_hand(r["doc_id"], r["text"])
    assert fill_middle.fill_in_middle(df.limit(0)).count() == 0
    assert fill_middle.fill_in_middle(out, out="fim").columns == out.columns


# --------------------------------------------------------------------- jaccard join

def sets_by_hand(texts):
    out = []
    for t in texts:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        out.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    return out


def components_by_hand(rows):
    sets = sets_by_hand([t for _, t in rows])
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((d, len(s), least.get(root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def near_texts(rng, n, passage_share=.5):
    """Texts of a small vocabulary: near copies at all distances, shared passages, tiny and empty ones."""
    word = lambda: f"w{rng.randint(0, 400)}"
    passage = [word() for _ in range(25)]
    bases = [[word() for _ in range(rng.choice([4, 5, 6, 9, 30, 60, 130]))] for _ in range(6)]
    out = []
    for _ in range(n):
        w = list(rng.choice(bases)) if rng.random() < .7 else [word() for _ in range(rng.randint(0, 40))]
        for _ in range(rng.choice([0, 0, 1, 2, 3])):
            if w:
                w[rng.randrange(len(w))] = word()
        if rng.random() < passage_share:
            at = rng.randint(0, len(w))
            w[at:at] = passage
        if rng.random() < .2:
            w += [word() for _ in range(rng.randint(1, 4))]
        out.append("  ".join(x.upper() if rng.random() < .1 else x for x in w))
    return out


@pytest.mark.parametrize("classes", [((2, 64), (3, 4096)), ((2, 1), (3, 3)), ((2, 3), (3, 8))])
def test_similar_sets_share_a_signature(classes):
    rng = random.Random(3)
    texts = near_texts(rng, 220)
    sets = jaccard_join.shingle_sets(pa.array(texts))
    by_hand = sets_by_hand(texts)
    assert sets.sizes.tolist() == [len(s) for s in by_hand]
    token, count = np.unique(sets.tokens, return_counts=True)
    limits = [*classes, (0, 10 ** 9)]
    frequent = {k: token[(count > lo) & (count <= hi)] for (k, lo), (_, hi) in zip(limits, limits[1:])}
    row, sig = jaccard_join.signatures(sets, frequent)
    mine = [set(sig[row == i].tolist()) for i in range(len(texts))]
    for i, a in enumerate(by_hand):
        for j in range(i):
            b = by_hand[j]
            if a and a != b and 100 * len(a & b) >= 80 * len(a | b):
                assert mine[i] & mine[j], (i, j)


def test_bitmaps_never_rule_out_a_link():
    rng = random.Random(4)
    texts = near_texts(rng, 120)
    sets, by_hand = jaccard_join.shingle_sets(pa.array(texts)), sets_by_hand(texts)
    bits = jaccard_join.bitmaps(sets)
    for i in range(len(texts)):
        for j in range(i):
            assert jaccard_join.distance_bound(bits[i], bits[j]) <= len(by_hand[i] ^ by_hand[j])


@pytest.mark.parametrize("classes", [((2, 64), (3, 4096)), ((2, 2), (3, 6))])
def test_components_equal_brute_force(spark, classes):
    rng = random.Random(5)
    texts = near_texts(rng, 260) + [None, "", " \n", "one two", "ONE  two", "a b c d e", None]
    rows = [(i if i % 11 else None, t) for i, t in enumerate(texts)] + [(5, texts[5]), (6, texts[40])]
    df = (spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS key", "2 AS id", "3 AS n")
          .repartition(5))
    got = sorted((tuple(r) for r in jaccard_join.near_duplicates(df, class_rows=classes).collect()), key=str)
    assert got == components_by_hand(rows)


def test_nearest_partners_are_some_of_the_close_pairs():
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(w if rng.random() > 0.02 else f"x{rng.random()}" for w in base) for _ in range(40)]
    sets, by_hand = jaccard_join.shingle_sets(pa.array(texts)), sets_by_hand(texts)
    n = len(texts)
    label = np.arange(n) // 2
    args = (np.zeros(n, np.int64), sets.sizes, np.arange(n), label, jaccard_join.bitmaps(sets))
    every = {tuple(p) for p in jaccard_join.close_pairs(*args).tolist()}
    near = {tuple(p) for p in jaccard_join.close_pairs(*args, nearest=True).tolist()}
    links = {(i, j) for i in range(n) for j in range(i + 1, n) if label[i] != label[j]
             and 5 * len(by_hand[i] & by_hand[j]) >= 4 * len(by_hand[i] | by_hand[j])}
    assert links and links <= every                      # nothing that links is left out
    assert near <= every and len(near) <= n              # at most one pair for each row
    assert {i for p in near for i in p} == {i for p in every for i in p}


def test_a_group_of_near_copies_writes_few_pairs(spark, monkeypatch):
    rng, copies = random.Random(9), 60
    base = [f"w{i}" for i in range(80)]
    texts = [" ".join(w if rng.random() > 0.02 else f"x{rng.random()}" for w in base) for _ in range(copies)]
    written = {}

    def counted(df, name):
        out = jaccard_join_land(df, name)
        written[name] = written.get(name, 0) + out.count()
        return out

    jaccard_join_land = jaccard_join.land
    monkeypatch.setattr(jaccard_join, "land", counted)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(r) for r in jaccard_join.near_duplicates(df).collect())
    by_hand = sets_by_hand(texts)
    root = list(range(copies))
    for i in range(copies):
        for j in range(i):
            if 5 * len(by_hand[i] & by_hand[j]) >= 4 * len(by_hand[i] | by_hand[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    assert got == [(i, len(by_hand[i]), root[i]) for i in range(copies)]
    assert written["jaccard-others"] < copies * (copies - 1) / 4


def test_join_of_an_empty_table(spark):
    assert jaccard_join.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_join_broadcasts_stay_small(spark, monkeypatch):
    bound, static = "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.autoBroadcastJoinThreshold"
    before = {k: spark.conf.get(k, None) for k in (bound, static)}
    plans, kept = [], jaccard_join.land

    def seen(df, name):
        df.collect()
        plans.append((name, df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]))
        return kept(df, name)

    monkeypatch.setattr(jaccard_join, "land", seen)
    monkeypatch.setattr(jaccard_join, "BROADCAST_BYTES", "-1", raising=False)
    df = spark.createDataFrame(list(enumerate(near_texts(random.Random(6), 80))), "doc_id long, text string")
    try:
        spark.conf.set(static, "-1")
        spark.conf.set(bound, ENGINE_CONF[bound])
        out = jaccard_join.near_duplicates(df)
        assert spark.conf.get(bound) == ENGINE_CONF[bound]
        assert len(out.collect()) == 80
        plans.append(("result", out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]))
        # ids of texts that are read again are broadcast by their count, which is bounded
        assert [(n, x) for n, p in plans for x in re.findall(r"BroadcastHashJoin (?!\[(?:doc_)?id#).*", p)] == []
        assert any("SortMergeJoin" in p for _, p in plans)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_the_sessions_own_broadcast_bound_holds(spark):
    name = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = spark.conf.get(name, None)
    try:
        spark.conf.set(name, "-1")
        with jaccard_join.bounded_broadcasts(spark):
            assert spark.conf.get(name) == "-1"
        spark.conf.unset(name)
        with jaccard_join.bounded_broadcasts(spark):
            assert spark.conf.get(name) == jaccard_join.BROADCAST_BYTES
        assert spark.conf.get(name, None) is None
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def test_hot_groups_collapse_before_the_shuffle():
    n = 10_000
    sig, size = np.zeros(n, np.int64), np.full(n, 100)
    spread, _, _, top, _, hub, several = jaccard_join._collapse(sig, size, np.arange(n))
    assert (top > 0).sum() == 1 and several.sum() == 1 and (hub == 0).all() and len(np.unique(spread)) > n // 2


# ------------------------------------------------------------------------ whitening

def covariance_by_hand(x):
    n, d = x.shape
    mean = [Fraction(int(s), n) for s in x.sum(axis=0)]
    return np.array([[float(sum((int(a) - mean[i]) * (int(b) - mean[j]) for a, b in zip(x[:, i], x[:, j])) / n)
                      for j in range(d)] for i in range(d)])


def test_whitening_by_hand(spark):
    rng = np.random.default_rng(6)
    v = (rng.normal(size=(400, 10)) * np.linspace(.2, 3, 10)) @ rng.normal(size=(10, 10))
    rows = [(i, v[i].astype(np.float32).tolist()) for i in range(400)]
    rows += [(900, None), (901, []), (902, [None] * 10), (903, [float("nan")] * 10), (904, [float("inf")] + [0.0] * 9),
             (905, [1.0] * 9), (None, rows[3][1]), (3, rows[3][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS _v", "2 AS _in")
    model = whitening.fit(df.repartition(3))
    white = whitening.whiten(df, model)
    got = white.collect()
    fitted = [r for r in rows if r[1] and len(r[1]) == 10 and r[1][0] is not None and np.isfinite(r[1]).all()]
    x = np.floor(1024 * np.array([r[1] for r in fitted], np.float32).astype(float)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    cov = covariance_by_hand(x)
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:8], u[:, ::-1][:, :8]
    y = (x - s / n) @ u / np.sqrt(e)
    assert model.n == n == len(got) and model.sums == s.tolist()
    assert np.allclose(model.values, e, rtol=1e-12) and model.trace == pytest.approx(np.trace(cov), rel=1e-12)
    place = {(r[0], i): k for k, (r, i) in enumerate(zip(fitted, [0] * n))}
    signs = np.sign((model.vectors * u).sum(axis=0))
    for r in got:
        k = place[(r["vec_id"], 0)]
        assert np.allclose(np.array(r["white"]["values"]) * signs, y[k], atol=1e-9)
        assert r["white"]["deviation"] == int(((n * x[k] - s) ** 2).sum())
    assert whitening.identity_error(white, model) < 1e-9
    assert white.columns == [*df.columns, "white"]


def test_degenerate_tables(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert whitening.fit(make([])) is None and whitening.fit(make([(1, None), (2, [])])) is None
    assert whitening.no_rows(make([])).count() == 0
    one = make([(1, [1.0, 2.0]), (1, [1.0, 2.0])])
    model = whitening.fit(one)
    got = whitening.whiten(one, model).collect()
    assert [list(r["white"]["values"]) for r in got] == [[0.0, 0.0]] * 2 and got[0]["white"]["deviation"] == 0
    assert whitening.identity_error(whitening.whiten(one, model), model) == 0.0
    line = make([(i, [float(i), 2.0 * i, 7.0]) for i in range(5)])
    model = whitening.fit(line)
    assert (model.values > whitening.NO_VARIANCE * model.trace).tolist() == [True, False, False]
    assert whitening.identity_error(whitening.whiten(line, model), model) < 1e-12


@pytest.mark.parametrize("values", [
    np.linspace(1, 5, 40), np.ones(40), np.r_[[5.0] * 5, [4.0] * 3, np.linspace(.1, 1, 32)],
    np.r_[5, 5 + 1e-9, 5 + 2e-9, 4, 4 + 1e-12, np.linspace(.1, 1, 35)], 10.0 ** -np.arange(40.0),
    np.r_[5 + np.arange(20) * 1e-8, np.linspace(.1, 1, 20)], np.r_[1e9, np.zeros(39)]])
def test_refined_eigenvectors(values):
    q = np.linalg.qr(np.random.default_rng(7).normal(size=(40, 40)))[0]
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    e, x, error = whitening.refined_eigenvectors(a)
    size = np.abs(values).max()
    rough = np.linalg.eigh(a.astype(np.float32))[1]
    assert np.abs(x.T @ x - np.eye(40)).max() < 1e-13 and error < 1e-12
    assert np.abs(a @ x - x * e).max() < 1e-13 * size and np.abs(np.sort(e) - np.sort(values)).max() < 1e-13 * size
    assert np.abs(rough.T.astype(float) @ rough - np.eye(40)).max() > 1e-9  # the refinement has work to do


def test_products_are_exact():
    rng = np.random.default_rng(8)
    for width in (200, 2 ** 30, 2 ** 45):
        y = rng.integers(-width, width, (3000, 4))
        assert (whitening.exact_products(y) == y.astype(object).T @ y.astype(object)).all()

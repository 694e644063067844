"""What the report and the pairs shuffle and keep on disk; the ways in which names and times meet give the same pairs."""

import time

import builders as B
import pytest
from pyspark.sql import functions as F
from test_patients import DAY, dt, odd_prescriptions

from rxlens.config import ReportConfig
from rxlens.operators import overlaps
from rxlens.plans.report import ReportPlan
from rxlens.session import land
from rxlens.sources import fixtures


def depth(line):
    return len(line) - len(line.lstrip(" :+-|"))


def below(lines, at):
    part = []
    for ln in lines[at + 1:]:
        if depth(ln) <= depth(lines[at]):
            break
        part.append(ln)
    return part


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def test_landing_deletes_its_shuffles(spark):
    """The disk holds the shuffles of one landed stage at a time; the rows can still be used."""
    before = shuffle_files(spark)
    rows = spark.range(5000).groupBy((F.col("id") % 700).alias("k")).count()
    landed = land(rows, "grouped", "zstd")
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert landed.count() == 700 and rows.count() == 700 and rows.count() == 700
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None


def test_extracts_are_cut_from_one_landed_table(spark, sf_small, tmp_path):
    """Base rows land once for all extracts and variants; projections of them are not written again."""
    for t in ("lineitem", "orders", "part", "supplier"):
        spark.read.parquet(f"{sf_small}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    before = set(fixtures._LANDED)
    cfg = fixtures.whole_range_config()
    for nulls in (False, True):
        inputs = fixtures.report_inputs(spark, str(tmp_path), cfg, nulls)
        lazy = fixtures.report_inputs(spark, str(tmp_path), cfg, nulls, land=False)
        for name in fixtures.EXTRACTS:
            assert inputs[name].columns == lazy[name].columns
            assert inputs[name].exceptAll(lazy[name]).isEmpty() and lazy[name].exceptAll(inputs[name]).isEmpty()
    names = sorted(k[3] for k in set(fixtures._LANDED) - before)
    assert names == ["base", "naive_rx", "naive_rx"]
    assert "patient_first_name" not in fixtures._LANDED[next(
        k for k in set(fixtures._LANDED) - before if k[3] == "base")].columns


def test_credits_shuffle_each_prescription_once(spark):
    """Rows are dealt to their patients before they are written out day by day."""
    p = ReportPlan(B.inputs(spark, users=[B.user(1)], actives=odd_prescriptions(20, 3)), ReportConfig())
    rows = p.active.select("final_id", "dob", F.col("patient_name").alias("name"), "written_date",
                           F.col("rx_end").alias("end"), F.col("filled_date").alias("start_part"), F.lit(True).alias("live"))
    names = spark.createDataFrame([(B.DOB, "JOHN SMITH", "JOHN SMITH")], "_dob date, _left_name string, _right_name string")
    lines = optimized(overlaps._credits(rows, rows, names, ["part"]))
    dealt = [i for i, ln in enumerate(lines) if "RepartitionByExpression" in ln]
    assert len(dealt) == 2
    assert all("inline" not in ln for i in dealt for ln in below(lines, i))
    assert any("inline" in ln for ln in lines)


def repeats(n):
    """One patient with ``n`` prescriptions: few names for many rows."""
    return [B.active(ahfs=(B.OPI, B.BZD)[i % 2], written=DAY + dt.timedelta(days=i % 7)) for i in range(n)]


@pytest.mark.parametrize("kind", ["part", "last", "both"])
def test_prescriptions_of_few_names_meet_in_one_join(spark, kind):
    """Names are compared once per pair of patients, both sides are shuffled once, and not for each of two joins."""
    p = ReportPlan(B.inputs(spark, users=[B.user(1)], actives=repeats(40)), ReportConfig())
    pairs = p.pairs(kind)
    lines = optimized(pairs)
    assert not any("_point_bucket" in ln or "ArrowEvalPython" in ln for ln in lines)
    assert sum("Join" in ln and "_bucket_opi" in ln for ln in lines) == 1
    assert pairs.count() == 20 * 20 if kind != "last" else 0 < pairs.count() <= 20 * 20


@pytest.mark.parametrize("kind", ["part", "last", "both"])
def test_all_ways_give_the_same_pairs(spark, monkeypatch, kind):
    """Names first (compared or through the index), times first and a mix: the same pairs, nulls and copies too."""
    actives = odd_prescriptions(120, 8) + [B.active(ahfs=a, dob=dt.date(1999, 1, 1), first=f, last="LEE", written=DAY)
                                           for a in (B.OPI, B.BZD) for f in ("ANN", "ANNE")]
    inputs = B.inputs(spark, users=[B.user(1)], actives=actives)

    def found(ways, **options):
        p = ReportPlan(inputs, ReportConfig(**options))
        pairs = p.pairs(kind, digits=6)
        dates = [r["_way"] for r in seen[-1].select("_way").distinct().collect()]
        assert sorted(dates) == ways
        return sorted(map(str, pairs.collect()))

    seen, made = [], overlaps._ways
    monkeypatch.setattr(overlaps, "_ways", lambda *a: seen.append(made(*a)) or seen[-1])
    want = found(["names", "times"])
    assert want == found(["index"], name_block=1) == found(["names", "times"], salt_buckets=3)
    monkeypatch.setattr(overlaps, "NAMES_PAY", 10 ** 9)
    assert want == found(["times"]) and len(want) > 50
    monkeypatch.setattr(overlaps, "NAMES_PAY", 0)
    assert want == found(["names"])

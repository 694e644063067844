"""Landed extracts: periods as partitions, reuse, rebuild on change, retention."""

import datetime as dt

from pyspark.sql import functions as F

from rxlens.config import ReportConfig
from rxlens.plans.report import land_extracts
from rxlens.sources import extracts, fixtures
from rxlens.sources.landing import ExtractStore, period_name, source_fingerprint


def folders(root, name):
    return sorted(p.name for p in (root / name).glob("period=*"))


def test_periods_are_partitions_and_reused(spark, tmp_path, monkeypatch):
    store, built = ExtractStore(spark, str(tmp_path / "store")), []
    rows = spark.range(10).withColumn("m", F.col("id") % 2)

    def build(month):
        built.append(month)
        return rows.where(F.col("m") == month)

    one = store.land("x", "2024-04-01_2024-04-30", "a", lambda: build(0))
    assert sorted(r["id"] for r in one.collect()) == [0, 2, 4, 6, 8] and one.columns == ["id", "m"]
    times = {p: p.stat().st_mtime_ns for p in (tmp_path / "store" / "x").rglob("*.parquet")}
    two = store.land("x", "2024-05-01_2024-05-31", "a", lambda: build(1))
    assert folders(tmp_path / "store", "x") == ["period=2024-04-01_2024-04-30", "period=2024-05-01_2024-05-31"]
    assert all(p.stat().st_mtime_ns == t for p, t in times.items())       # the first month was not written again
    plan = two._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2024-05-01_2024-05-31" in plan.split("PartitionFilters: [", 1)[1]
    again = ExtractStore(spark, str(tmp_path / "store"))                 # another application
    assert again.land("x", "2024-04-01_2024-04-30", "a", lambda: build(0)).count() == 5 and built == [0, 1]
    assert again.land("x", "2024-04-01_2024-04-30", "b", lambda: build(1)).count() == 5 and built == [0, 1, 1]
    assert again.land("x", "2024-04-01_2024-04-30", "c", lambda: build(7)).count() == 0   # no rows left
    assert again.land("x", "2024-05-01_2024-05-31", "a", lambda: build(0)).first()["m"] == 1
    assert again.periods("x") == ["2024-04-01_2024-04-30", "2024-05-01_2024-05-31"] and again.periods("y") == []
    assert again.expire("x", 1) == ["2024-04-01_2024-04-30"] and again.periods("x") == ["2024-05-01_2024-05-31"]
    assert folders(tmp_path / "store", "x") == ["period=2024-05-01_2024-05-31"]


def test_a_landing_without_manifest_is_built_again(spark, tmp_path):
    store = ExtractStore(spark, str(tmp_path / "s"))
    store.land("x", "p", "a", lambda: spark.range(3))
    store._delete(store._manifest("x", "p"))
    assert store.fingerprint("x", "p") is None
    assert store.land("x", "p", "a", lambda: spark.range(5)).count() == 5


def test_a_rewritten_source_is_seen(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(3).write.parquet(path)
    before = source_fingerprint(spark, [path])
    assert source_fingerprint(spark, [path]) == before
    spark.range(4).write.mode("append").parquet(path)
    assert source_fingerprint(spark, [path]) != before


def test_extracts_land_by_period_and_follow_their_sources(spark, sf_small, tmp_path):
    sources = [str(tmp_path / "rx")]
    fixtures.base_prescriptions(spark, sf_small).write.parquet(sources[0])
    store = ExtractStore(spark, str(tmp_path / "store"))
    cfg = ReportConfig(first_date=dt.date(1998, 1, 1), last_date=dt.date(1998, 12, 31))

    def land_all(cfg=cfg):
        rx = spark.read.parquet(sources[0])
        return land_extracts(rx, fixtures._search_log_from(rx, False), fixtures.accounts(spark, sf_small), cfg,
                             "active_dea", store, sources)

    got = land_all()
    rx = spark.read.parquet(sources[0])
    want = extracts.build_extracts(rx, fixtures._search_log_from(rx, False), fixtures.accounts(spark, sf_small), cfg,
                                   "active_dea")
    for k, v in want.items():
        assert got[k].columns == v.columns and got[k].exceptAll(v).isEmpty() and got[k].count() == v.count(), k
    n = got["dispensations"].count()
    rx.where("written_date BETWEEN '1998-01-01' AND '1998-12-31'").limit(7).write.mode("append").parquet(sources[0])
    assert land_all()["dispensations"].count() == n + 7
    other = cfg.with_(first_date=dt.date(1997, 1, 1), last_date=dt.date(1997, 12, 31))
    land_all(other)
    assert store.periods("dispensations") == [period_name(c.first_date, c.last_date) for c in (other, cfg)]

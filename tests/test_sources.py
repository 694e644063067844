"""Extract CSV readers (S1-S5) round trip, period helpers, the batch job."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from rxlens.config import ReportConfig, report_file_name, report_period
from rxlens.sources import csv as C
from rxlens.sources import fixtures
from rxlens.sources import schemas as S


def _same(a, b):
    cols = sorted(a.columns)
    ra = sorted(tuple(r) for r in a.select(*[F.col(f"`{c}`") for c in cols]).collect())
    rb = sorted(tuple(r) for r in b.select(*[F.col(f"`{c}`") for c in cols]).collect())
    return ra == rb


@pytest.mark.parametrize("name,rename,longs,shorts,reader", [
    ("dispensations", S.DISPENSATIONS_RENAME, S.DISPENSATIONS_LONG_DATES, (), C.read_dispensations),
    ("searches", S.SEARCHES_RENAME, S.SEARCHES_LONG_DATES, (), C.read_searches),
    ("users", S.USERS_RENAME, (), (), C.read_users),
    ("active_rx", S.ACTIVE_RX_RENAME, S.ACTIVE_RX_LONG_DATES, (), C.read_active_rx),
    ("naive_rx", S.NAIVE_RX_RENAME, S.NAIVE_RX_LONG_DATES, S.NAIVE_RX_SHORT_DATES, C.read_naive_rx),
])
def test_csv_round_trip(spark, sf_small, name, rename, longs, shorts, reader):
    cfg = fixtures.whole_range_config()
    src = fixtures.report_inputs(spark, sf_small, cfg)[name]
    out = tempfile.mkdtemp(prefix=f"rxlens-{name}-")
    C.write_extract_csv(src, out, rename, longs, shorts)
    header = spark.read.text(out).first()[0]
    assert any(raw in header for raw in rename)          # raw headers on disk
    back = reader(spark, out)
    if "rx_number" in back.columns:
        back = back.withColumn("rx_number", F.col("rx_number").cast("bigint"))
    assert sorted(back.columns) == sorted(src.columns)
    assert _same(src, back.select(*[F.col(f"`{c}`").cast(src.schema[c].dataType).alias(c) for c in src.columns]))


def test_dotted_header_and_formats(spark):
    out = tempfile.mkdtemp(prefix="rxlens-naive-")
    with open(f"{out}/part.csv", "w") as fh:
        fh.write('Animal Name,Month, Day, Year of Patient Birthdate,Orig Patient First Name,'
                 'Orig Patient Last Name,Month, Day, Year of Filled At,Max. naive_end\n'.replace(
                     "Month, Day, Year of Patient Birthdate", '"Month, Day, Year of Patient Birthdate"').replace(
                     "Month, Day, Year of Filled At", '"Month, Day, Year of Filled At"'))
        fh.write('~,"April 7, 2024",ann,lee,"april 07, 2024",4/7/2024\n')
    row = C.read_naive_rx(spark, out).collect()[0]
    assert row["dob"] == dt.date(2024, 4, 7) and row["naive_filled_date"] == dt.date(2024, 4, 7)
    assert row["naive_end"] == dt.date(2024, 4, 7)


def test_report_period():
    assert report_period(dt.date(2024, 5, 24)) == (dt.date(2024, 4, 1), dt.date(2024, 4, 30))
    assert report_period(dt.date(2024, 1, 1)) == (dt.date(2023, 12, 1), dt.date(2023, 12, 31))
    assert report_period(first=dt.date(2021, 1, 1), last=dt.date(2021, 1, 31), auto=False) == (
        dt.date(2021, 1, 1), dt.date(2021, 1, 31))


def test_report_file_name():
    assert report_file_name(dt.date(2024, 4, 1), dt.date(2024, 4, 30), True) == "april2024_mandatory_use_full.csv"
    assert (report_file_name(dt.date(2023, 1, 1), dt.date(2024, 1, 31), False)
            == "january2023-january2024_mandatory_use_base.csv")


def test_config_validation():
    with pytest.raises(ValueError):
        ReportConfig(overlap_type="first")
    with pytest.raises(ValueError):
        ReportConfig(first_date=dt.date(2024, 5, 1), last_date=dt.date(2024, 4, 1))


def test_run_report_job(spark, sf_small):
    from rxlens.plans.report import run_report
    cfg = fixtures.whole_range_config(overlap_type="both")
    out = tempfile.mkdtemp(prefix="rxlens-report-")
    totals = run_report(fixtures.report_inputs(spark, sf_small, cfg), cfg, out, testing=True).collect()[0]
    name = report_file_name(cfg.first_date, cfg.last_date, True)
    written = spark.read.option("header", True).csv(f"{out}/{name}")
    assert written.count() > 0 and "overlapping_rx_part" in written.columns
    assert totals["dispensations"] == written.agg(F.sum(F.col("dispensations").cast("bigint"))).first()[0]
    assert spark.read.parquet(f"{out}/overlaps_last").count() > 0


def test_cli_config_mapping():
    from rxlens.__main__ import config_from_args, parse_args
    cfg = config_from_args(parse_args(["-ns", "-ot", "both", "-p", "0.4", "-nf"]), today=dt.date(2024, 5, 24))
    assert (cfg.first_date, cfg.last_date) == (dt.date(2024, 4, 1), dt.date(2024, 4, 30))
    assert not cfg.supplement and cfg.overlap_type == "both" and cfg.partial_ratio == 0.4 and not cfg.filter_vets
    cfg = config_from_args(parse_args(["-na", "-f", "2021-01-01", "-l", "2021-01-31"]))
    assert (cfg.first_date, cfg.last_date) == (dt.date(2021, 1, 1), dt.date(2021, 1, 31))


def test_cli_end_to_end(spark, sf_small):
    """Extract CSVs in a data folder -> report CSV, like the command line."""
    import os

    from rxlens.__main__ import FILES, main
    cfg = fixtures.whole_range_config()
    data = tempfile.mkdtemp(prefix="rxlens-data-")
    out = tempfile.mkdtemp(prefix="rxlens-out-")
    renames = {"dispensations": (S.DISPENSATIONS_RENAME, S.DISPENSATIONS_LONG_DATES, ()),
               "searches": (S.SEARCHES_RENAME, S.SEARCHES_LONG_DATES, ()),
               "users": (S.USERS_RENAME, (), ()),
               "active_rx": (S.ACTIVE_RX_RENAME, S.ACTIVE_RX_LONG_DATES, ()),
               "naive_rx": (S.NAIVE_RX_RENAME, S.NAIVE_RX_LONG_DATES, S.NAIVE_RX_SHORT_DATES)}
    for name, df in fixtures.report_inputs(spark, sf_small, cfg).items():
        C.write_extract_csv(df, os.path.join(data, FILES[name]), *renames[name])
    main(["-na", "-f", "1995-01-01", "-l", "2001-12-31", "--data", data, "--out", out])
    got = spark.read.option("header", True).csv(f"{out}/{report_file_name(cfg.first_date, cfg.last_date, True)}")
    from rxlens.plans.queries import q_report_full
    want = q_report_full(spark, sf_small)
    assert got.count() == want.count()
    assert sorted(r["final_id"] for r in got.collect()) == sorted(r["final_id"] for r in want.collect())


def test_unreadable_numbers_and_missing_headers_are_errors(spark, tmp_path):
    from rxlens.sources import csv
    from rxlens.sources import schemas as S
    heads = list(S.DISPENSATIONS_RENAME)
    mme = next(k for k, v in S.DISPENSATIONS_RENAME.items() if v == "mme")
    row = ['"1,200"' if h == mme else "" for h in heads]
    (tmp_path / "bad.csv").write_text(",".join(f'"{h}"' for h in heads) + "\n" + ",".join(row) + "\n")
    with pytest.raises(Exception, match="1,200"):
        csv.read_dispensations(spark, str(tmp_path / "bad.csv")).collect()
    (tmp_path / "short.csv").write_text(",".join(f'"{h}"' for h in heads[1:]) + "\n")
    with pytest.raises(ValueError, match="missing header"):
        csv.read_dispensations(spark, str(tmp_path / "short.csv"))


def test_quotes_breaks_and_backslashes_survive(spark, tmp_path):
    """K3 and S1-S5 share one quoting rule, and line breaks in fields are found without being asked for."""
    values = ['"start', 'a "quoted" name', 'back\\slash', 'ends with \\', '\\"', 'x, y', '""', "plain", ' lead ', None]
    rows = [(i, v, "s") for i, v in enumerate(values)]
    flat = spark.createDataFrame(rows, "true_id long, user_full_name string, specialty_1 string")
    broken = flat.union(spark.createDataFrame([(99, 'two\nlines "and" more', "s"), (100, "a\r\nb", "s")], flat.schema))
    heads = [c for c in S.USERS_RENAME.values() if c not in flat.columns]
    for name, df, breaks in (("flat", flat, False), ("broken", broken, True)):
        full = df.select("*", *[F.lit("x").alias(h) for h in heads])
        path = str(tmp_path / name)
        C.write_extract_csv(full, path, S.USERS_RENAME)
        assert C.has_line_breaks(spark, path) is breaks
        assert _same(full, C.read_users(spark, path).select(*full.columns))


def test_today_in_zone_and_period_key(spark, sf_small):
    from rxlens.plans.queries import QUERIES
    for r in QUERIES["report_period"](spark, sf_small).limit(50).collect():
        assert r["today"] == r["d"] - dt.timedelta(days=1)
        assert (r["first_date"], r["last_date"]) == report_period(today=r["today"])

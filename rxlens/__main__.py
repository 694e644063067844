"""Command line: ``python -m rxlens [options]``.

Reads the five extract CSVs (raw headers) from ``--data`` and writes the
report CSV (plus detail dumps with ``--testing``) under ``--out``; prints the
grand totals.  Options and defaults follow the report parameters of
``ReportConfig``; the period is the previous calendar month unless
``--no-auto-date`` is given.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os

from rxlens.config import ReportConfig, report_period

FILES = {
    "dispensations": "dispensations_data.csv",
    "searches": "searches_data.csv",
    "users": "ID_data.csv",
    "active_rx": "active_rx_data.csv",
    "naive_rx": "naive_rx_data.csv",
}


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="rxlens", description="mandatory-use report on Spark")
    p.add_argument("-r", "--ratio", type=float, default=0.7)
    p.add_argument("-p", "--partial-ratio", type=float, default=0.5)
    p.add_argument("-d", "--days-before", type=int, default=7)
    p.add_argument("-nf", "--no-filter-vets", action="store_true")
    p.add_argument("-t", "--testing", action="store_true")
    p.add_argument("-ns", "--no-supplement", action="store_true")
    p.add_argument("-o", "--overlap-ratio", type=float, default=0.9)
    p.add_argument("-ot", "--overlap-type", choices=["last", "part", "both"], default="last")
    p.add_argument("-n", "--naive-ratio", type=float, default=0.7)
    p.add_argument("-m", "--mme-threshold", type=int, default=90)
    p.add_argument("-na", "--no-auto-date", action="store_true")
    p.add_argument("-f", "--first-written-date", type=dt.date.fromisoformat, default=dt.date(2024, 4, 1))
    p.add_argument("-l", "--last-written-date", type=dt.date.fromisoformat, default=dt.date(2024, 4, 30))
    p.add_argument("--data", default="data", help="folder holding the five extract CSVs")
    p.add_argument("--out", default=".", help="output folder (shared storage on a cluster)")
    p.add_argument("--master", default=None, help="Spark master when not submitted (e.g. local[8])")
    return p.parse_args(argv)


def config_from_args(a: argparse.Namespace, today: dt.date | None = None) -> ReportConfig:
    first, last = report_period(today=today, first=a.first_written_date, last=a.last_written_date,
                                auto=not a.no_auto_date, tz=os.environ.get("TZ", "UTC"))
    return ReportConfig(first_date=first, last_date=last, ratio=a.ratio, partial_ratio=a.partial_ratio,
                        days_before=a.days_before, filter_vets=not a.no_filter_vets,
                        supplement=not a.no_supplement, overlap_ratio=a.overlap_ratio,
                        overlap_type=a.overlap_type, naive_ratio=a.naive_ratio,
                        mme_threshold=a.mme_threshold)


def main(argv=None) -> None:
    from pyspark.sql import SparkSession

    from rxlens.plans.report import run_report
    from rxlens.session import apply_engine_conf, ensure_checkpoint_dir
    from rxlens.sources import csv

    a = parse_args(argv)
    cfg = config_from_args(a)
    builder = SparkSession.builder.appName("rxlens")
    if a.master:
        builder = builder.master(a.master).config("spark.ui.enabled", "false")
    spark = builder.getOrCreate()
    apply_engine_conf(spark)
    ensure_checkpoint_dir(spark)
    readers = {"dispensations": csv.read_dispensations, "searches": csv.read_searches,
               "users": csv.read_users, "active_rx": csv.read_active_rx, "naive_rx": csv.read_naive_rx}
    needed = list(readers) if cfg.supplement else ["dispensations", "searches", "users"]
    inputs = {k: readers[k](spark, os.path.join(a.data, FILES[k])) for k in needed}
    totals = run_report(inputs, cfg, a.out, testing=a.testing)
    totals.show()


if __name__ == "__main__":
    main()

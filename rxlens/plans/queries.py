"""Registered queries: one per operator key of the coverage checklist.

Every query reads the driver tables through the fixture derivation; nothing is
collected.  Keys that end in ``_month`` report one calendar month (``MONTH``),
the others the whole data range.  Queries over a single extract are lazy; those
with several readers of an extract land the extracts they use on first use
(``fixtures.LandedInputs``).
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rxlens.config import Eligibility
from rxlens.functions import dates as D
from rxlens.functions.similarity import SCORE_DIGITS, jaro_winkler
from rxlens.functions.strings import normalize_dea, valid_dea
from rxlens.operators import match, metrics, prepare
from rxlens.plans.report import ReportPlan, land_extracts
from rxlens.session import ensure_checkpoint_dir
from rxlens.sources import csv, extracts, fixtures
from rxlens.sources import schemas as S
from rxlens.sources.fixtures import MONTH, MONTH_KEYS
from rxlens.sources.landing import ExtractStore

# The state rule set used by the extract query (fixed example values).
AZ_RULES = Eligibility(include_refills=False, states=("AZ",),
                       excluded_treatment_types=("Hospice", "Palliative", "Cancer_Associated"),
                       schedules=(2, 3, 4))

PAIR_COLUMNS = ("final_id", "dea", "ahfs", "dob", "patient_name", "written_date", "filled_date",
                "create_date", "rx_end", "final_id_opi", "dea_opi", "ahfs_opi", "patient_name_opi",
                "written_date_opi", "filled_date_opi", "create_date_opi", "rx_end_opi")
CANDIDATE_COLUMNS = ("rx_number", "prescriber_dea", "written_date", "true_id", "disp_dob", "patient_name",
                     "created_date", "full_name", "ratio_check")


def config(**changes):
    return fixtures.whole_range_config(**changes)


def plan(spark: SparkSession, sf_dir: str, with_nulls: bool = False, land: bool = True, **changes) -> ReportPlan:
    cfg = config(**changes)
    return ReportPlan(fixtures.report_inputs(spark, sf_dir, cfg, with_nulls, land), cfg)


def q_users(spark, sf_dir):
    return fixtures.users(spark, sf_dir)


def q_users_explode(spark, sf_dir):
    return plan(spark, sf_dir).users_explode


def q_dispensations(spark, sf_dir):
    return plan(spark, sf_dir, land=False).dispensations


def q_searches(spark, sf_dir, **period):
    return plan(spark, sf_dir, **period).searches


def q_active_rx(spark, sf_dir):
    return plan(spark, sf_dir, land=False).active


def q_naive_rx(spark, sf_dir):
    return plan(spark, sf_dir, land=False).naive_rx


def q_extract_users(spark, sf_dir):
    return extracts.extract_users(fixtures.accounts(spark, sf_dir))


def q_extract_dispensations(spark, sf_dir, **period):
    return extracts.extract_dispensations(fixtures.base_prescriptions(spark, sf_dir),
                                          config(eligibility=AZ_RULES, **period))


def q_extract_searches(spark, sf_dir, **period):
    return extracts.extract_searches(fixtures.search_log(spark, sf_dir), config(**period))


def q_extract_active_rx(spark, sf_dir, **period):
    return extracts.extract_active_rx(fixtures.base_prescriptions(spark, sf_dir), config(**period))


def q_extract_naive_rx(spark, sf_dir, **period):
    return extracts.extract_naive_rx(fixtures.base_prescriptions(spark, sf_dir), config(**period))


def q_filter_vets(spark, sf_dir):
    return prepare.filter_vets(fixtures.dispensations(spark, sf_dir))


def q_valid_dea(spark, sf_dir):
    d = fixtures.dispensations(spark, sf_dir)
    norm = normalize_dea("prescriber_dea")
    return d.select(F.col("prescriber_dea").alias("raw_dea"), norm.alias("prescriber_dea"),
                    valid_dea(norm).alias("valid")).distinct()


def q_search_window(spark, sf_dir):
    """Every search with every dispensation of its user and birth date whose window it lies in, before the name test."""
    p = plan(spark, sf_dir)
    return match.search_candidates(p.dispensations, p.searches, p.cfg).select(*CANDIDATE_COLUMNS)


def q_search_scan_month(spark, sf_dir):
    """F4 for the report month, over every search."""
    return prepare.search_window(fixtures.searches(spark, sf_dir), config(**MONTH))


def q_search_match(spark, sf_dir):
    return plan(spark, sf_dir).matched


def q_final_dispensations(spark, sf_dir):
    return plan(spark, sf_dir).final


def q_prescriber_rates(spark, sf_dir):
    return plan(spark, sf_dir).rates()


def q_opi_rx(spark, sf_dir):
    p = plan(spark, sf_dir)
    return metrics.class_count(p.final_core, p.cfg.opioid_pattern, "opi_rx")


def q_benzo_rx(spark, sf_dir):
    p = plan(spark, sf_dir)
    return metrics.class_count(p.final_core, p.cfg.benzo_pattern, "benzo_rx")


def q_rx_over_mme(spark, sf_dir):
    p = plan(spark, sf_dir)
    return metrics.over_mme(p.final_core, p.cfg.mme_threshold)


def q_report_base(spark, sf_dir):
    return plan(spark, sf_dir).report(full=False)


def _pairs(spark, sf_dir, kind):
    return plan(spark, sf_dir).pairs(kind, digits=6).select(*PAIR_COLUMNS, "ratio")


def q_overlap_pairs_part(spark, sf_dir):
    return _pairs(spark, sf_dir, "part")


def q_overlap_pairs_last(spark, sf_dir):
    return _pairs(spark, sf_dir, "last")


def q_overlap_part(spark, sf_dir, **period):
    return plan(spark, sf_dir, **period).overlap_counts("part")


def q_overlap_last(spark, sf_dir, **period):
    return plan(spark, sf_dir, **period).overlap_counts("last")


def q_naive_match(spark, sf_dir):
    return plan(spark, sf_dir).naive_matches()


def q_opi_to_opi_naive(spark, sf_dir):
    return plan(spark, sf_dir).naive_counts()


def q_report_full(spark, sf_dir):
    return plan(spark, sf_dir).report(full=True, overlap_type="last")


def q_report_full_both(spark, sf_dir, **options):
    return plan(spark, sf_dir, **options).report(full=True, overlap_type="both")


def q_report_from_tables(spark, sf_dir):
    """S6 end to end: base tables -> the month's extracts (E1-E8) -> full report."""
    cfg = config(eligibility=AZ_RULES, **MONTH)
    tables = [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ("lineitem", "orders", "part", "supplier")]
    folder = hashlib.sha256(sf_dir.rstrip("/").encode()).hexdigest()[:16]
    store = ExtractStore(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/rxlens-extracts/{folder}")
    inputs = land_extracts(fixtures.base_prescriptions(spark, sf_dir), fixtures.search_log(spark, sf_dir),
                           fixtures.accounts(spark, sf_dir), cfg, active_dea_col="active_dea", store=store,
                           sources=tables)
    return ReportPlan(inputs, cfg).report(full=True, overlap_type="both")


# extract -> (reader, raw headers, long dates, short dates, column that gets awkward text)
CSV_LAYOUTS = {
    "users": (csv.read_users, S.USERS_RENAME, (), (), "user_full_name"),
    "dispensations": (csv.read_dispensations, S.DISPENSATIONS_RENAME, S.DISPENSATIONS_LONG_DATES, (),
                      "patient_first_name"),
    "searches": (csv.read_searches, S.SEARCHES_RENAME, S.SEARCHES_LONG_DATES, (), "first_name"),
    "active_rx": (csv.read_active_rx, S.ACTIVE_RX_RENAME, S.ACTIVE_RX_LONG_DATES, (), "patient_first_name"),
    "naive_rx": (csv.read_naive_rx, S.NAIVE_RX_RENAME, S.NAIVE_RX_LONG_DATES, S.NAIVE_RX_SHORT_DATES,
                 "patient_last_name"),
}


def awkward(name: str, c: str) -> Column:
    """Quotes, commas and backslashes around texts of even length; line breaks too in ``users``."""
    extra = ' "the \\ 2nd", jr\\"' + ("\nII" if name == "users" else "")
    return F.when(F.length(c) % 2 == 0, F.concat(F.lit('"'), F.col(c), F.lit(extra))).otherwise(F.col(c))


def q_csv(spark, sf_dir, name):
    """S1-S5 over K3: the extract written as CSV with its raw headers, and read back."""
    reader, rename, long_dates, short_dates, text = CSV_LAYOUTS[name]
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/rxlens-csv/{uuid.uuid4().hex}/{name}"
    extract = fixtures.report_inputs(spark, sf_dir, config(), land=False)[name]
    csv.write_extract_csv(extract.withColumn(text, awkward(name, text)), path, rename, long_dates, short_dates)
    return reader(spark, path)


def q_grand_totals(spark, sf_dir):
    p = plan(spark, sf_dir)
    return p.totals(p.report(full=False, sort=False))


def q_similarity(spark, sf_dir):
    """C9 over every distinct (searched name, patient name) candidate pair."""
    p = plan(spark, sf_dir)
    names = match.search_candidates(p.dispensations, p.searches, p.cfg).select(
        "full_name", "patient_name").distinct()
    return names.withColumn("similarity",
                            F.round(jaro_winkler(F.col("full_name"), F.col("patient_name")), SCORE_DIGITS))


def q_parse_dates(spark, sf_dir):
    """D1-D4 round trip over every order date."""
    o = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet").select(
        "o_orderkey", F.to_date("o_orderdate").alias("d"))
    texts = o.select("o_orderkey", "d",
                     D.format_long_date("d", padded=True).alias("long_text"),
                     D.format_long_date("d", padded=False).alias("plain_text"),
                     D.format_short_date("d").alias("short_text"))
    return texts.select(
        "o_orderkey", "long_text", "plain_text", "short_text",
        D.parse_long_date("long_text").alias("from_long"),
        D.parse_long_date("plain_text").alias("from_plain"),
        D.parse_short_date("short_text").alias("from_short"),
        D.shift_days("d", 1).alias("day_after"),
        D.shift_days("d", -7).alias("week_before"),
        D.shift_days("d", (F.col("o_orderkey") % 90).cast("int")).alias("supply_end"))


def q_previous_month(spark, sf_dir):
    """D6/D7 (auto period and file name) for every distinct order date."""
    o = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet").select(
        F.to_date("o_orderdate").alias("d")).distinct()
    first, last = D.previous_month_start("d"), D.previous_month_end("d")
    return o.select(
        "d", first.alias("period_first"), last.alias("period_last"),
        D.month_name("d").alias("month"),
        F.concat(D.month_name(first), F.year(first).cast("string"),
                 F.lit("_mandatory_use_full.csv")).alias("file_name"))


def q_report_period(spark, sf_dir):
    """The automatic period of a run at 03:00 UTC of every order date, seen in Phoenix."""
    o = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet").select(F.to_date("o_orderdate").alias("d")).distinct()
    today = D.today_in_zone(F.to_timestamp("d") + F.expr("INTERVAL 3 HOURS"), "America/Phoenix")
    return (o.withColumn("today", today)
            .select("d", "today", D.previous_month_start("today").alias("first_date"),
                    D.previous_month_end("today").alias("last_date")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "users": q_users,
    "users_explode": q_users_explode,
    "dispensations": q_dispensations,
    "searches": q_searches,
    "active_rx": q_active_rx,
    "naive_rx": q_naive_rx,
    "extract_users": q_extract_users,
    "extract_dispensations": q_extract_dispensations,
    "extract_searches": q_extract_searches,
    "extract_active_rx": q_extract_active_rx,
    "extract_naive_rx": q_extract_naive_rx,
    "filter_vets": q_filter_vets,
    "valid_dea": q_valid_dea,
    "search_window": q_search_window,
    "search_scan_month": q_search_scan_month,
    "search_match": q_search_match,
    "final_dispensations": q_final_dispensations,
    "prescriber_rates": q_prescriber_rates,
    "opi_rx": q_opi_rx,
    "benzo_rx": q_benzo_rx,
    "rx_over_mme": q_rx_over_mme,
    "report_base": q_report_base,
    "overlap_pairs_part": q_overlap_pairs_part,
    "overlap_pairs_last": q_overlap_pairs_last,
    "overlap_part": q_overlap_part,
    "overlap_last": q_overlap_last,
    "naive_match": q_naive_match,
    "opi_to_opi_naive": q_opi_to_opi_naive,
    "report_full": q_report_full,
    "report_full_both": q_report_full_both,
    "grand_totals": q_grand_totals,
    "similarity": q_similarity,
    "parse_dates": q_parse_dates,
    "previous_month": q_previous_month,
    "report_period": q_report_period,
}
QUERIES |= {f"{k}_month": partial(QUERIES[k], **MONTH) for k in MONTH_KEYS}
QUERIES |= {f"csv_{k}": partial(q_csv, name=k) for k in CSV_LAYOUTS}
QUERIES |= {"report_full_both_nulls": partial(q_report_full_both, with_nulls=True),
            "report_from_tables": q_report_from_tables}

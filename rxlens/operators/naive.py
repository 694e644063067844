"""Opioid prescriptions written to opioid-naive patients.

An opioid dispensation is *not* naive when some naive-window record of a
patient with the same birth date covers its written date and the names score
at least ``naive_ratio`` (the prescription's own record counts, as upstream).
Everything else that is opioid, or has no drug class, counts as naive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxlens.config import ReportConfig
from rxlens.functions.similarity import name_signature
from rxlens.operators.daily import by_patient, day_rows, interval_days, merged, of_matching, sums_at
from rxlens.operators.intervals import point_in_interval_join
from rxlens.operators.match import score_candidates
from rxlens.operators.patients import name_pairs, patient_names, shared_dates
from rxlens.plans.strategy import fits, small_side
from rxlens.session import land

NAIVE_KEY = ("final_id", "rx_number")
NAMES_PAY = 16  # rows that meet by birth date, for each pair of names, from which names are met first


def naive_match(final: DataFrame, naive: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Distinct (final_id, rx_number) of opioid rx with a naive-window match.

    Names of a birth date are compared once per pair of patients.  The windows of a patient are merged, moved to
    every name they match, and an rx has a match if its written date is covered: no rx meets a window in a pair.
    Only birth dates where nearly every row has a name of its own and names are many (``names_pay``) take the other
    way, rx and windows that meet in time first.
    """
    opi = (final.filter(F.col("ahfs").contains(cfg.opioid_pattern))
           .select(*NAIVE_KEY, "disp_dob", "written_date", "patient_name").filter(F.col("written_date").isNotNull()))
    n = (naive.select(F.col("dob").alias("n_dob"), "naive_filled_date", "naive_end", "naive_patient_name")
         .filter(F.col("naive_filled_date") <= F.col("naive_end")))
    a = patient_names(opi, "disp_dob", "patient_name", live=F.lit(True))
    b = patient_names(n, "n_dob", "naive_patient_name", live=F.lit(True))
    dates = land(shared_dates(a, b).withColumn("_pay", names_pay(cfg.name_block)), "naive-dates")
    names = land(name_pairs(a, b, cfg.naive_ratio, dates.where("_pay")), "name-pairs")
    covered = _covered(opi, n, names)
    slow = dates.where("NOT _pay").select("_dob")
    if slow.isEmpty():
        return covered.distinct()
    slow = small_side(slow, fits(slow, cfg.max_broadcast_rows))
    met = _met_in_time(opi.join(slow, F.col("disp_dob") == F.col("_dob"), "left_semi"),
                       n.join(slow, F.col("n_dob") == F.col("_dob"), "left_semi"), cfg)
    return covered.unionByName(met).distinct()


def names_pay(block: int) -> Column:
    """Birth dates (of ``shared_dates``) whose names are met before times: at most ``block`` names a side, or few
    pairs of names for the pairs of rows."""
    return ((F.greatest("_names_a", "_names_b") <= block)
            | (F.col("_names_a").cast("double") * F.col("_names_b") * NAMES_PAY
               <= F.col("_rows_a").cast("double") * F.col("_rows_b")))


def _covered(opi: DataFrame, n: DataFrame, names: DataFrame) -> DataFrame:
    events = day_rows(n.select(F.col("n_dob").alias("dob"), F.col("naive_patient_name").alias("name"),
                               "naive_filled_date", "naive_end"), ["dob", "name"],
                      interval_days(F.col("naive_filled_date"), F.col("naive_end"), "windows"), ["windows"])
    events = events.filter(F.col("dob").isNotNull() & F.col("name").isNotNull())
    points = (opi.filter(F.col("disp_dob").isNotNull() & F.col("patient_name").isNotNull())
              .select(F.col("disp_dob").alias("dob"), F.col("patient_name").alias("name"),
                      F.col("written_date").alias("day"), *NAIVE_KEY))
    at = sums_at(by_patient(points), by_patient(of_matching(merged(events, "windows"), names)), ["windows"])
    return at.where(F.col("windows") > 0).select(*NAIVE_KEY)


def _met_in_time(opi: DataFrame, n: DataFrame, cfg: ReportConfig) -> DataFrame:
    cands = point_in_interval_join(
        opi.withColumn("_sig", name_signature(F.col("patient_name"))),
        n.withColumn("_n_sig", name_signature(F.col("naive_patient_name"))),
        on=[("disp_dob", "n_dob")], point="written_date",
        start=F.col("naive_filled_date"), end=F.col("naive_end"),
        bucket_days=cfg.bucket_days, salt=cfg.salt_buckets, split_rows=cfg.split_rows)
    scored = score_candidates(cands, "naive_patient_name", "patient_name", F.lit(float(cfg.naive_ratio)),
                              keep=list(NAIVE_KEY), sigs=("_n_sig", "_sig"))
    return scored.select(*NAIVE_KEY)


def opioid_to_naive(final: DataFrame, matched: DataFrame, cfg: ReportConfig) -> DataFrame:
    """J12 + A8: per prescriber, rows that are opioid (or classless) and whose
    (final_id, rx_number) has no naive-window match.

    ``coalesce(is_opioid AND not_matched, true)``: only opioid or null-class
    rows can count, so those are filtered first and the mark join becomes a
    left-anti join (a null number never matches, so such rows count).
    """
    cand = final.filter(F.col("ahfs").isNull() | F.col("ahfs").contains(cfg.opioid_pattern))
    left = cand.select(*NAIVE_KEY)
    return (left.join(matched, list(NAIVE_KEY), "left_anti")
            .groupBy("final_id").agg(F.count(F.lit(1)).alias("opi_to_opi_naive")))

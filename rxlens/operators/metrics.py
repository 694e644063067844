"""M6 (prescriber rates), M7 (drug counts), M12 (grand totals)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlens.config import ReportConfig
from rxlens.functions.strings import dea_or_null
from rxlens.plans.strategy import keep_first

RATE_COLUMNS = ("final_id", "prescriber_name", "dea_number(s)", "license_number", "specialty_1",
                "specialty_2", "specialty_3", "dispensations", "searches", "rate", "registered")
COUNT_COLUMNS = ("opi_rx", "benzo_rx", "rx_over_mme_threshold")


def _c(name: str):
    return F.col(f"`{name}`")


def prescriber_counts(final: DataFrame, cfg: ReportConfig, with_drugs: bool = True,
                      naive_matched: DataFrame | None = None) -> DataFrame:
    """A1-A4 (and A8) in ONE partial+final aggregation over the final
    dispensations: rows, searched rows, opioid rows, benzodiazepine rows,
    rows at/over the MME threshold and, given the naive matches, opioid (or
    classless) rows to naive patients.  Prescribers without a kind of row get
    0 directly, so no per-count join is needed."""
    aggs = [F.count(F.lit(1)).alias("dispensations"),
            F.sum(F.col("search").cast("bigint")).alias("searches")]
    if with_drugs:
        aggs += [F.count_if(F.col("ahfs").contains(cfg.opioid_pattern)).alias("opi_rx"),
                 F.count_if(F.col("ahfs").contains(cfg.benzo_pattern)).alias("benzo_rx"),
                 F.count_if(F.col("mme") >= F.lit(cfg.mme_threshold)).alias("rx_over_mme_threshold")]
    if naive_matched is not None:
        # (final_id, rx_number) is distinct on the right: the mark join never fans out
        marks = naive_matched.select("final_id", "rx_number", F.lit(True).alias("_not_naive"))
        final = final.join(marks, ["final_id", "rx_number"], "left")
        to_naive = ((F.col("ahfs").isNull() | F.col("ahfs").contains(cfg.opioid_pattern))
                    & F.col("_not_naive").isNull())
        aggs.append(F.count_if(to_naive).alias("opi_to_opi_naive"))
    return final.groupBy("final_id").agg(*aggs)


def dea_names(dispensations: DataFrame) -> DataFrame:
    """J7 right side: one name per DEA (the smallest), from every prepared row.

    A string ``min`` runs as a sort-based aggregate, so the (DEA, name) pairs
    are first collapsed with a hash aggregate (map-side), leaving the sort
    only the few distinct pairs.
    """
    pairs = dispensations.select(F.col("prescriber_dea").alias("n_dea"), "prescriber_name").distinct()
    return pairs.groupBy("n_dea").agg(F.min("prescriber_name").alias("dea_prescriber_name"))


def describe_prescribers(counts: DataFrame, users: DataFrame, names: DataFrame) -> DataFrame:
    """M6 tail: rate, user details for registered ids, dispensation name and
    DEA for unregistered ones, ``registered`` = the id parses as an integer.
    ``names`` is ``dea_names(...)``."""
    u = keep_first(users, ["true_id"], ["user_full_name"]).select(
        F.col("true_id").alias("u_true_id"), "user_full_name", _c("dea_number(s)"), "license_number",
        "specialty_1", "specialty_2", "specialty_3")
    r = counts.withColumns({
        "rate": F.col("searches") / F.col("dispensations") * 100,
        "true_id": F.col("final_id").try_cast("bigint"),
        "unreg_dea": dea_or_null("final_id"),
    })
    r = (r.join(u, r["true_id"] == u["u_true_id"], "left")
          .join(names, r["unreg_dea"] == names["n_dea"], "left"))
    return r.withColumns({
        "prescriber_name": F.coalesce("user_full_name", "dea_prescriber_name"),
        "dea_number(s)": F.coalesce(_c("dea_number(s)"), F.col("unreg_dea")),
        "registered": F.col("true_id").isNotNull(),
    })


def prescriber_rates(final: DataFrame, users: DataFrame, names: DataFrame,
                     cfg: ReportConfig) -> DataFrame:
    """M6: one row per ``final_id`` with dispensations, searches and rate."""
    counts = prescriber_counts(final, cfg, with_drugs=False)
    return describe_prescribers(counts, users, names).select(*[_c(c) for c in RATE_COLUMNS])


def class_count(final: DataFrame, pattern: str, name: str) -> DataFrame:
    """A2/A3: rows per prescriber whose class contains ``pattern``."""
    return (final.filter(F.col("ahfs").contains(pattern)).groupBy("final_id")
            .agg(F.count(F.lit(1)).alias(name)))


def over_mme(final: DataFrame, threshold: float) -> DataFrame:
    """A4: rows per prescriber with daily MME at or above ``threshold``."""
    return (final.filter(F.col("mme") >= F.lit(threshold)).groupBy("final_id")
            .agg(F.count(F.lit(1)).alias("rx_over_mme_threshold")))


def grand_totals(report: DataFrame) -> DataFrame:
    """Totals over the report; rate to 2 digits (null when empty)."""
    t = report.agg(F.coalesce(F.sum("dispensations"), F.lit(0)).cast("bigint").alias("dispensations"),
                   F.coalesce(F.sum("searches"), F.lit(0)).cast("bigint").alias("searches"))
    return t.select("dispensations", "searches",
                    F.round(F.try_divide(F.col("searches"), F.col("dispensations")) * 100, 2).alias("rate"))

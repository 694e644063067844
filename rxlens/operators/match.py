"""M4 (search match) and M5 (final dispensations)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlens.config import ReportConfig
from rxlens.functions.similarity import jaro_winkler, may_reach, may_reach_sig, passes
from rxlens.operators.intervals import point_in_interval_join

DISPENSATION_KEY = ("rx_number", "prescriber_dea", "written_date")
# Survivor rule for dispensations that share a key (fan-out over shared DEAs,
# repeated rows): lowest user id, then patient, class, MME, fill date.
# The report itself reads only the first five, so it de-duplicates on that
# prefix: rows tied on the prefix agree on every column the report uses.
SURVIVOR_ORDER = ("true_id", "patient_name", "disp_dob", "ahfs", "mme", "filled_date",
                  "disp_created_date", "days_supply", "prescriber_name", "generic_name")
REPORT_COLUMNS = SURVIVOR_ORDER[:5]


def search_candidates(dispensations: DataFrame, searches: DataFrame, cfg: ReportConfig) -> DataFrame:
    """J4 before the name test: same user, same birth date, search created
    inside [written - days_before, written + 1].  Time-bucketed equi-join."""
    d = dispensations.select(*DISPENSATION_KEY, "true_id", "disp_dob", "patient_name",
                             "start_date", "end_date").filter(F.col("true_id").isNotNull())
    s = searches.select(F.col("true_id").alias("s_true_id"), "search_dob", "created_date",
                        "full_name", "ratio_check")
    return point_in_interval_join(
        s, d, on=[("s_true_id", "true_id"), ("search_dob", "disp_dob")], point="created_date",
        start=F.col("start_date"), end=F.col("end_date"), bucket_days=cfg.bucket_days, point_range=(cfg.search_from, cfg.search_to),
        salt=cfg.salt_buckets)


def score_candidates(cands: DataFrame, a: str, b: str, threshold, out: str = "ratio",
                     keep: list[str] | None = None, sigs: tuple[str, str] | None = None) -> DataFrame:
    """Name test on candidate pairs: native length prefilter, then the
    vectorised scorer on the survivors only, then the threshold.

    ``keep`` narrows the rows before the Python stage to the columns the
    caller needs afterwards: the Python evaluation buffers every input row
    until its score comes back, so its cost grows with the row width.
    ``sigs`` names ``name_signature`` columns of ``a`` and ``b`` (computed
    once per side row) for the tighter character bound.
    """
    t = F.col(threshold) if isinstance(threshold, str) else threshold
    if sigs is not None:
        cands = cands.filter(may_reach_sig(F.col(a), F.col(b), F.col(sigs[0]), F.col(sigs[1]), t))
    else:
        cands = cands.filter(may_reach(F.col(a), F.col(b), t))
    if keep is not None:
        extra = [threshold] if isinstance(threshold, str) else []
        cols = list(dict.fromkeys(list(keep) + [a, b] + extra))
        cands = cands.select(*cols)
    return (cands.withColumn(out, jaro_winkler(F.col(a), F.col(b)))
            .filter(passes(F.col(out), t)))


def match_searches(dispensations: DataFrame, searches: DataFrame, cfg: ReportConfig) -> DataFrame:
    """M4: dispensation keys with at least one qualifying search (flag True)."""
    scored = score_candidates(search_candidates(dispensations, searches, cfg),
                              "full_name", "patient_name", "ratio_check", keep=list(DISPENSATION_KEY))
    return scored.select(*DISPENSATION_KEY).distinct().withColumn("search", F.lit(True))


def finalize_dispensations(dispensations: DataFrame, matched: DataFrame,
                           columns: tuple[str, ...] | None = None) -> DataFrame:
    """M5: one row per key (deterministic survivor), ``search`` flag by key
    (a null number never matches), ``final_id`` = user id else DEA.

    The de-duplication and the mark join share the same key, so the join
    reuses the aggregate's hash partitioning.  ``columns`` (a prefix of
    ``SURVIVOR_ORDER``) narrows the rows that are de-duplicated.
    """
    from rxlens.plans.strategy import keep_first
    if columns is not None:
        dispensations = dispensations.select(*DISPENSATION_KEY, *columns)
    first = keep_first(dispensations, DISPENSATION_KEY, SURVIVOR_ORDER)
    return (first.join(matched, list(DISPENSATION_KEY), "left")
            .withColumns({
                "search": F.coalesce(F.col("search"), F.lit(False)),
                "final_id": F.coalesce(F.col("true_id").cast("string"), F.col("prescriber_dea")),
            }))

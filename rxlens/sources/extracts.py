"""Period-parameterised extracts built from base tables.

These are the filters the upstream reporting views apply before the report
runs: a Spark user pointing the engine at raw prescription, search and
account tables builds the five report inputs with these functions
(``build_extracts`` builds all five).  Filters on stored columns reach the
parquet scan as pushed filters; those on computed ends (``rx_end``,
``naive_end``) run after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlens.config import BENZO_CLASSES, OPIOID_CLASSES, Eligibility, ReportConfig
from rxlens.functions.dates import lit_date, shift_days
from rxlens.sources import schemas as S


def eligibility_filter(rules: Eligibility):
    """Conjunction of the configured mandatory-use rules (None = no rule).

    Exclusion lists keep rows whose field is null (not excluded).
    """
    conds = []
    if rules.ahfs_in is not None:
        conds.append(F.col("ahfs").isin(*rules.ahfs_in))
    if not rules.include_refills:
        conds.append(~F.coalesce(F.col("refill"), F.lit(False)))
    if rules.states is not None:
        conds.append(F.col("state").isin(*rules.states))
    if rules.min_days_supply is not None:
        conds.append(F.col("days_supply") >= rules.min_days_supply)
    if rules.max_days_supply is not None:
        conds.append(F.col("days_supply") <= rules.max_days_supply)
    for colname, excluded in (("prescriber_role", rules.excluded_roles),
                              ("patient_location", rules.excluded_locations),
                              ("treatment_type", rules.excluded_treatment_types)):
        if excluded is not None:
            conds.append(F.col(colname).isNull() | ~F.col(colname).isin(*excluded))
    if rules.schedules is not None:
        conds.append(F.col("drug_schedule").isin(*rules.schedules))
    out = F.lit(True)
    for c in conds:
        out = out & c
    return out


def extract_dispensations(base: DataFrame, cfg: ReportConfig) -> DataFrame:
    """E1 + E2: dispensations written in the period that require a search."""
    period = F.col("written_date").between(lit_date(cfg.first_date), lit_date(cfg.last_date))
    keep = [c for c in S.DISPENSATIONS_COLUMNS + ("generic_name",) if c in base.columns]
    return base.filter(period & eligibility_filter(cfg.eligibility)).select(*keep)


def extract_searches(log: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Attribute each search (delegate, else requestor) inside the window."""
    window = F.col("created_date").between(lit_date(cfg.search_from), lit_date(cfg.search_to))
    return (log.filter(window)
            .withColumn("true_id", F.coalesce(F.col("delegator_id"), F.col("requestor_id")))
            .select(*S.SEARCHES_COLUMNS))


def extract_users(accounts: DataFrame) -> DataFrame:
    """Active accounts only."""
    return accounts.filter(F.col("active") == "Y").select(*[f"`{c}`" for c in S.USERS_COLUMNS])


def _with_rx_end(base: DataFrame) -> DataFrame:
    """Prescription end = filled + days supply."""
    return base.withColumn("rx_end", shift_days("filled_date", F.col("days_supply")))


def extract_active_rx(base: DataFrame, cfg: ReportConfig, dea_col: str = "prescriber_dea",
                      classes: tuple[str, ...] = OPIOID_CLASSES + BENZO_CLASSES) -> DataFrame:
    """E3 + E4: opioid/benzo prescriptions whose [filled, rx_end] meets the period."""
    df = _with_rx_end(base)
    cond = ((F.col("rx_end") >= lit_date(cfg.first_date))
            & (F.col("filled_date") <= lit_date(cfg.last_date))
            & F.col("ahfs").isin(*classes))
    return (df.filter(cond)
            .select("animal_name", F.col(dea_col).alias("dea"), "ahfs", F.col("disp_dob").alias("dob"),
                    "patient_first_name", "patient_last_name",
                    F.col("disp_created_date").alias("create_date"), "written_date", "filled_date", "rx_end"))


def extract_naive_rx(base: DataFrame, cfg: ReportConfig,
                     classes: tuple[str, ...] = OPIOID_CLASSES) -> DataFrame:
    """E5 + E6: opioid prescriptions active plus ``naive_days``, latest end per patient-fill.

    The grouping is a partial+final hash aggregate (map-side combine), so a
    patient with very many fills never lands whole in one task unaggregated.
    """
    df = _with_rx_end(base).withColumn("naive_end", shift_days("rx_end", cfg.naive_days))
    cond = ((F.col("naive_end") >= lit_date(cfg.first_date))
            & (F.col("filled_date") <= lit_date(cfg.last_date))
            & F.col("ahfs").isin(*classes))
    return (df.filter(cond)
            .groupBy("animal_name", F.col("disp_dob").alias("dob"), "patient_first_name",
                     "patient_last_name", F.col("filled_date").alias("naive_filled_date"))
            .agg(F.max("naive_end").alias("naive_end")))


def build_extracts(prescriptions: DataFrame, search_log: DataFrame, accounts: DataFrame, cfg: ReportConfig,
                   active_dea_col: str = "prescriber_dea") -> dict[str, DataFrame]:
    """The five report inputs of ``cfg``'s period from the base tables."""
    return {
        "dispensations": extract_dispensations(prescriptions, cfg),
        "searches": extract_searches(search_log, cfg),
        "users": extract_users(accounts),
        "active_rx": extract_active_rx(prescriptions, cfg, active_dea_col),
        "naive_rx": extract_naive_rx(prescriptions, cfg),
    }

"""Input preparation: M1 (prescriber identities), M2, M3, M8 and naive prep."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlens.config import ReportConfig
from rxlens.functions.dates import lit_date, shift_days
from rxlens.functions.strings import full_name, is_human, normalize_dea, strip_ws, valid_dea
from rxlens.plans.strategy import small_side


def filter_vets(df: DataFrame, enabled: bool = True) -> DataFrame:
    """keep human patients (``Unspecified`` or ``~``); drop the column."""
    if enabled:
        df = df.filter(is_human("animal_name"))
    return df.drop("animal_name")


def resolve_prescribers(users: DataFrame) -> DataFrame:
    """M1: one row per (user, DEA) from the comma separated DEA list.

    Upper-cased and stripped before the split, each element stripped after;
    a null list stays as one row with a null DEA.  No de-duplication: a DEA
    listed by two users belongs to both.
    """
    deas = F.split(strip_ws(F.upper(F.col("`dea_number(s)`"))), ",")
    return (users.select("true_id", F.explode_outer(deas).alias("dea_number"))
            .withColumn("dea_number", strip_ws("dea_number")))


def prepare_dispensations(disp: DataFrame, users_explode: DataFrame, cfg: ReportConfig,
                          broadcast_owners: bool = False) -> DataFrame:
    """M2: normalise DEA, build names, keep valid DEAs, attach owners, search window.

    ``broadcast_owners``: the caller proved the identity table small (see
    ``ReportPlan.owners_fit``); otherwise the owner join is a shuffle join.
    """
    d = (disp
         .withColumns({
             "prescriber_dea": normalize_dea("prescriber_dea"),
             "patient_name": full_name("patient_first_name", "patient_last_name"),
             "prescriber_name": full_name("prescriber_first_name", "prescriber_last_name"),
         })
         .filter(valid_dea("prescriber_dea")))
    owners = users_explode.select("true_id", "dea_number").filter(F.col("dea_number").isNotNull())
    owners = small_side(owners, broadcast_owners)
    d = (d.join(owners, d["prescriber_dea"] == owners["dea_number"], "left")
         .drop("dea_number")
         .withColumns({
             "start_date": shift_days("written_date", -cfg.days_before),
             "end_date": shift_days("written_date", 1),
         })
         .drop("patient_first_name", "patient_last_name", "prescriber_first_name", "prescriber_last_name"))
    return filter_vets(d, cfg.filter_vets)


def search_window(searches: DataFrame, cfg: ReportConfig) -> DataFrame:
    """searches created from ``days_before`` days before the period to the day after it (both included)."""
    return searches.filter(F.col("created_date").between(lit_date(cfg.search_from), lit_date(cfg.search_to)))


def prepare_searches(searches: DataFrame, dispensations: DataFrame | None, cfg: ReportConfig,
                     broadcast_owners: bool = False) -> DataFrame:
    """M3: searches by users that own a dispensation, inside the search window,
    with the per-row similarity threshold (partial search → lower bar; an
    unknown partial flag gives no threshold, so the row never matches).

    ``dispensations=None`` skips the owner semi-join: the match joins on the
    owner id anyway, so the match path does not pay for a distinct-owner
    pass over the dispensations.
    """
    s = searches
    if dispensations is not None:
        # distinct owners are a subset of the identity table, so its size bound holds
        owners = dispensations.select("true_id").filter(F.col("true_id").isNotNull()).distinct()
        s = s.join(small_side(owners, broadcast_owners), "true_id", "left_semi")
    partial = F.col("partial_first") | F.col("partial_last")
    return (search_window(s, cfg)
            .withColumns({
                "full_name": full_name("first_name", "last_name"),
                "partial": partial,
            })
            .withColumn("ratio_check",
                        F.when(F.col("partial"), F.lit(float(cfg.partial_ratio)))
                         .when(~F.col("partial"), F.lit(float(cfg.ratio))))
            .drop("first_name", "last_name", "partial_first", "partial_last"))


def prescriber_names(disp: DataFrame, cfg: ReportConfig) -> DataFrame:
    """(prescriber_dea, prescriber_name) of every valid, kept dispensation row.

    Same rows as ``prepare_dispensations`` without the owner join: the owner
    fan-out only repeats rows, which a per-DEA ``min`` ignores.
    """
    d = (disp.withColumns({"prescriber_dea": normalize_dea("prescriber_dea"),
                           "prescriber_name": full_name("prescriber_first_name", "prescriber_last_name")})
         .filter(valid_dea("prescriber_dea")))
    return filter_vets(d, cfg.filter_vets).select("prescriber_dea", "prescriber_name")


def prepare_active_rx(active: DataFrame, users_explode: DataFrame, cfg: ReportConfig,
                      broadcast_owners: bool = False) -> DataFrame:
    """M8: attach owners to active prescriptions (DEA as given unless
    ``normalize_active_dea``), ``final_id`` = user id else DEA, patient name."""
    a = active
    if cfg.normalize_active_dea:
        a = a.withColumn("dea", normalize_dea("dea"))
    owners = users_explode.select("true_id", "dea_number").filter(F.col("dea_number").isNotNull())
    owners = small_side(owners, broadcast_owners)
    a = (a.join(owners, a["dea"] == owners["dea_number"], "left")
         .drop("dea_number")
         .withColumns({
             "final_id": F.coalesce(F.col("true_id").cast("string"), F.col("dea")),
             "patient_name": full_name("patient_first_name", "patient_last_name"),
         })
         .drop("true_id", "patient_first_name", "patient_last_name"))
    return filter_vets(a, cfg.filter_vets)


def prepare_naive_rx(naive: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Naive-window records with the upper-cased patient name."""
    n = (naive.withColumn("naive_patient_name", full_name("patient_first_name", "patient_last_name"))
         .drop("patient_first_name", "patient_last_name"))
    return filter_vets(n, cfg.filter_vets)


def split_classes(active: DataFrame, cfg: ReportConfig) -> tuple[DataFrame, DataFrame]:
    """(benzodiazepine rows, opioid rows) of the active prescriptions."""
    return (active.filter(F.col("ahfs").contains(cfg.benzo_pattern)),
            active.filter(F.col("ahfs").contains(cfg.opioid_pattern)))

"""M11 report assembly and the K1/K2/K4 sinks.

``ReportPlan`` wires the operators into one DataFrame DAG per output; nothing
is collected.  ``run_report`` is the batch job: it cuts lineage once at the
final dispensations (written to the shared checkpoint folder, so a lost
executor recomputes from there, not from the raw extracts), writes the
sorted report as one header CSV (one row per prescriber, so one file is
fine), the optional detail dumps, and returns the grand totals.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlens.config import ReportConfig, report_file_name
from rxlens.operators import match, metrics, naive, overlaps, prepare
from rxlens.plans.strategy import fits, small_side
from rxlens.session import land
from rxlens.sources import extracts
from rxlens.sources.csv import CSV_RULES
from rxlens.sources.landing import ExtractStore, period_name, source_fingerprint

OVERLAP_COLUMNS = {"part": ("overlapping_rx_part",), "last": ("overlapping_rx_last",),
                   "both": ("overlapping_rx_part", "overlapping_rx_last")}
INPUTS = ("dispensations", "searches", "users", "active_rx", "naive_rx")


def sort_report(report: DataFrame) -> DataFrame:
    """O1: fewest searches first, then most dispensations."""
    return report.orderBy(F.asc("searches"), F.desc("dispensations"), F.asc("final_id"))


@dataclass
class ReportPlan:
    """Lazily built stages of one report over the five extracts."""

    inputs: dict[str, DataFrame]
    cfg: ReportConfig
    final_override: DataFrame | None = field(default=None, repr=False)
    land_stages: bool = True

    @cached_property
    def users(self) -> DataFrame:
        return self.inputs["users"]

    @cached_property
    def users_explode(self) -> DataFrame:
        return prepare.resolve_prescribers(self.users)

    @cached_property
    def owners_fit(self) -> bool:
        """Size check, once per plan, of the (user, DEA) table: it bounds every
        owner-side broadcast (the owner joins and the distinct-owner semi-join)."""
        return fits(self.users_explode, self.cfg.max_broadcast_rows)

    def _landed(self, df: DataFrame, name: str) -> DataFrame:
        if not self.land_stages:
            return df
        return land(df, name, "zstd")

    @cached_property
    def dispensations(self) -> DataFrame:
        """Prepared dispensations (M2)."""
        return prepare.prepare_dispensations(self.inputs["dispensations"], self.users_explode, self.cfg,
                                             self.owners_fit)

    @cached_property
    def searches(self) -> DataFrame:
        """Prepared searches (M3, with the owner semi-join)."""
        return prepare.prepare_searches(self.inputs["searches"], self.dispensations, self.cfg,
                                        self.owners_fit)

    @cached_property
    def matched(self) -> DataFrame:
        """M4 keys; the searches skip the (redundant here) owner semi-join."""
        s = prepare.prepare_searches(self.inputs["searches"], None, self.cfg)
        return match.match_searches(self.dispensations, s, self.cfg)

    @cached_property
    def final(self) -> DataFrame:
        """Final dispensations (M5), every column."""
        if self.final_override is not None:
            return self.final_override
        return match.finalize_dispensations(self.dispensations, self.matched)

    @cached_property
    def final_core(self) -> DataFrame:
        """Final dispensations narrowed to the columns the report reads (same
        survivors as ``final`` on those columns)."""
        if self.final_override is not None:
            return self.final_override
        return match.finalize_dispensations(self.dispensations, self.matched, match.REPORT_COLUMNS)

    @cached_property
    def final_shared(self) -> DataFrame:
        """``final_core`` landed once for plans with several consumers of it; the marks land before it, so that the
        shuffles of the search match are gone when the rows are de-duplicated."""
        if self.final_override is not None:
            return self.final_override
        marks = self._landed(self.matched, "matched")
        return self._landed(match.finalize_dispensations(self.dispensations, marks, match.REPORT_COLUMNS), "final")

    @cached_property
    def names(self) -> DataFrame:
        """Names are read only for DEAs without a registered owner, so the
        others leave before the aggregation."""
        owned = (self.users_explode.filter(F.col("true_id").isNotNull() & F.col("dea_number").isNotNull())
                 .select(F.col("dea_number").alias("prescriber_dea")))
        rows = prepare.prescriber_names(self.inputs["dispensations"], self.cfg)
        return metrics.dea_names(rows.join(small_side(owned, self.owners_fit), "prescriber_dea", "left_anti"))

    @cached_property
    def active(self) -> DataFrame:
        return prepare.prepare_active_rx(self.inputs["active_rx"], self.users_explode, self.cfg,
                                         self.owners_fit)

    @cached_property
    def naive_rx(self) -> DataFrame:
        return prepare.prepare_naive_rx(self.inputs["naive_rx"], self.cfg)

    def rates(self) -> DataFrame:
        return metrics.prescriber_rates(self.final_core, self.users, self.names, self.cfg)

    def base(self, final: DataFrame | None = None, naive_matched: DataFrame | None = None) -> DataFrame:
        counts = metrics.prescriber_counts(final if final is not None else self.final_core, self.cfg,
                                           with_drugs=True, naive_matched=naive_matched)
        return metrics.describe_prescribers(counts, self.users, self.names)

    def pairs(self, kind: str, keep: list[str] | None = None, credited_only: bool = False,
              digits: int | None = None) -> DataFrame:
        benzo, opi = prepare.split_classes(self.active, self.cfg)
        return overlaps.overlap_pairs(benzo, opi, self.cfg, kind, keep, credited_only, digits)

    def overlap_counts(self, kind: str) -> DataFrame:
        benzo, opi = prepare.split_classes(self.active, self.cfg)
        return overlaps.overlap_counts(benzo, opi, self.cfg, kind)

    def naive_matches(self, final: DataFrame | None = None) -> DataFrame:
        # counted before it is joined, so landed
        return naive.naive_match(final if final is not None else self.final_shared, self.naive_rx, self.cfg)

    def naive_counts(self) -> DataFrame:
        return naive.opioid_to_naive(self.final_shared, self.naive_matches(), self.cfg)

    def report(self, full: bool | None = None, overlap_type: str | None = None,
               sort: bool = True) -> DataFrame:
        """Base report, plus overlap and naive counts when ``full``."""
        full = self.cfg.supplement if full is None else full
        kind = overlap_type or self.cfg.overlap_type
        extra: list[str] = []
        if full:
            # the final dispensations feed the naive match and the counts
            final = self.final_shared
            overlaps_of = self.overlap_counts(kind)
            out = self.base(final, naive_matched=self._landed(self.naive_matches(final), "naive-matches"))
            ocols = OVERLAP_COLUMNS[kind]
            out = out.join(overlaps_of, "final_id", "left")
            out = out.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in ocols})
            extra = list(ocols) + ["opi_to_opi_naive"]
        else:
            out = self.base()
        cols = list(metrics.RATE_COLUMNS + metrics.COUNT_COLUMNS) + extra
        out = out.select(*[F.col(f"`{c}`") for c in cols])
        return sort_report(out) if sort else out

    def totals(self, report: DataFrame | None = None) -> DataFrame:
        return metrics.grand_totals(report if report is not None else self.report(full=False, sort=False))


def land_extracts(prescriptions: DataFrame, search_log: DataFrame, accounts: DataFrame, cfg: ReportConfig,
                  active_dea_col: str = "prescriber_dea", store: ExtractStore | None = None,
                  sources: Sequence[str] = ()) -> dict[str, DataFrame]:
    """The five inputs of the period, from the base tables, landed for their several readers.

    With a ``store``, each extract goes to the folder of its period there and
    is built again only if the files under ``sources`` or the parameters
    changed; otherwise it is landed for this run alone.
    """
    built = extracts.build_extracts(prescriptions, search_log, accounts, cfg, active_dea_col)
    if store is None:
        return {k: land(v, f"extract-{k}") for k, v in built.items()}
    period = period_name(cfg.first_date, cfg.last_date)
    mark = f"{source_fingerprint(store.spark, sources)} {cfg!r} {active_dea_col}"
    mark = hashlib.sha256(mark.encode()).hexdigest()
    return {k: store.land(k, period, mark, lambda v=v: v) for k, v in built.items()}


def run_report(inputs: dict[str, DataFrame], cfg: ReportConfig, out_dir: str,
               testing: bool = False, land_inputs: bool = True) -> DataFrame:
    """The batch job: write ``<out_dir>/<month...>_mandatory_use_<kind>.csv``
    (a directory with one CSV part) and return the 1-row grand totals.

    The inputs are landed first, so that CSV text is parsed once (set
    ``land_inputs`` to False for tables that are Parquet already); the report
    is computed once, and the detail dumps (``testing``) reuse landed stages.
    """
    plan = ReportPlan({k: land(inputs[k], f"input-{k}") for k in INPUTS} if land_inputs else inputs, cfg)
    name = report_file_name(cfg.first_date, cfg.last_date, cfg.supplement)
    base_dir = out_dir.rstrip("/")
    if testing:
        plan.final_override = land(plan.final, "final")
        plan.final_override.write.mode("overwrite").parquet(f"{base_dir}/dispensations_results")
        if cfg.supplement and cfg.overlap_type == "both":
            pairs = land(plan.pairs("both"), "overlaps")
            for k in ("part", "last"):
                (pairs.filter(f"is_{k}").drop("is_part", "is_last")
                 .write.mode("overwrite").parquet(f"{base_dir}/overlaps_{k}"))
        elif cfg.supplement:
            plan.pairs(cfg.overlap_type).write.mode("overwrite").parquet(f"{base_dir}/overlaps_{cfg.overlap_type}")
    report = land(plan.report(sort=False), "report")
    sort_report(report).coalesce(1).write.mode("overwrite").options(**CSV_RULES).csv(f"{base_dir}/{name}")
    if testing:
        report.write.mode("overwrite").parquet(f"{base_dir}/search_results")
    return metrics.grand_totals(report)

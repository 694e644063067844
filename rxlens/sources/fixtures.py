"""Deterministic report inputs derived from the driver's TPC-H-like tables.

Base rows are ``lineitem ⋈ orders ⋈ part`` (``p_partkey = o_custkey``); every
report input is a projection/filter of them (see ``FIXTURES.md`` §B).  The
recipe's constants below are fixed values shared with the SQL oracle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import MutableMapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rxlens.config import ReportConfig
from rxlens.sources import extracts
from rxlens.sources.landing import source_fingerprint

# Fixed values of the fixture recipe.
OPIOID_TEXT = "OPIOID AGONISTS"
BENZO_TEXT = "BENZODIAZEPINES (ANXIOLYTIC, SEDATIV/HYP)"
OTHER_TEXT = "AMPHETAMINES"
DOB_ORIGIN = dt.date(1950, 1, 1)
WHOLE_RANGE = (dt.date(1995, 1, 1), dt.date(2001, 12, 31))

# The report month of the ``_month`` keys (rows before and after it exist), and those keys.
MONTH = {"first_date": dt.date(1998, 4, 1), "last_date": dt.date(1998, 4, 30)}
MONTH_KEYS = ("extract_dispensations", "extract_searches", "extract_active_rx", "extract_naive_rx", "searches",
              "overlap_part", "overlap_last", "report_full_both")


def whole_range_config(**changes) -> ReportConfig:
    """Report parameters covering every row of the driver tables."""
    return ReportConfig(first_date=WHOLE_RANGE[0], last_date=WHOLE_RANGE[1]).with_(**changes)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def first_word(c: Column) -> Column:
    """``split_part(c, ' ', 1)``."""
    return F.substring_index(c, " ", 1)


def second_word(c: Column) -> Column:
    """``split_part(c, ' ', 2)`` ('' when there is no space)."""
    return F.when(F.instr(c, " ") > 0, F.substring_index(F.substring_index(c, " ", 2), " ", -1)) \
        .otherwise(F.lit(""))


def pad(c: Column) -> Column:
    return F.lpad(c.cast("string"), 7, "0")


def base_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` and ``orders`` both grow with the data, so their join is a
    shuffle join at every size; it also spreads small single-file inputs.
    Orders meet their part first, so the far longer ``lineitem`` is shuffled once."""
    li = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_name")
    orders = orders.join(part, F.col("p_partkey") == F.col("o_custkey")).drop("p_partkey")
    return li.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


def base_prescriptions(spark: SparkSession, sf_dir: str, with_nulls: bool = False) -> DataFrame:
    """One row per dispensation with the extract extras (clean names, typed)."""
    return derive_prescriptions(spark, sf_dir, with_nulls)


def derive_prescriptions(spark: SparkSession, sf_dir: str, with_nulls: bool = False) -> DataFrame:
    """The fixture recipe itself (lazy)."""
    return prescriptions_from(base_rows(spark, sf_dir), with_nulls)


def prescriptions_from(b: DataFrame, with_nulls: bool = False) -> DataFrame:
    """The recipe over ``base_rows``."""
    sk, pk, ln, ok = (F.col("l_suppkey"), F.col("l_partkey"), F.col("l_linenumber"),
                      F.col("l_orderkey"))
    written = F.to_date(F.col("o_orderdate"))
    filled = F.date_add(written, (ln % 4).cast("int"))
    ahfs = (F.when(F.col("l_returnflag") == "R", F.lit(OPIOID_TEXT))
            .when(F.col("l_returnflag") == "A", F.lit(BENZO_TEXT))
            .otherwise(F.lit(OTHER_TEXT)))
    rx_number = ok * 10 + ln
    if with_nulls:
        ahfs = F.when(pk % 29 != 0, ahfs)
        rx_number = F.when(ok % 97 != 0, rx_number)
    cols = {
        "animal_name": F.when(ln % 7 == 0, F.lit("Rex")).when(ln % 2 == 0, F.lit("~"))
                        .otherwise(F.lit("Unspecified")),
        "prescriber_dea": F.when(sk % 13 == 5, F.concat(F.lit("zz"), pad(sk)))
                           .when(sk % 17 == 9, F.lit("BAD"))
                           .when((sk % 3 == 0) & (pk % 2 == 0), F.concat(F.lit("CD"), pad(sk)))
                           .otherwise(F.concat(F.lit(" ab"), pad(sk), F.lit(" "))),
        "active_dea": F.when(sk % 4 == 1, F.concat(F.lit("ab"), pad(sk)))
                       .otherwise(F.concat(F.lit("AB"), pad(sk))),
        "rx_number": rx_number,
        "ahfs": ahfs,
        "patient_first_name": first_word(F.col("p_name")),
        "patient_last_name": second_word(F.col("p_name")),
        "prescriber_first_name": F.lit("Doc"),
        "prescriber_last_name": F.concat(F.lit("S"), pad(sk)),
        "written_date": written,
        "filled_date": filled,
        "disp_created_date": F.date_add(filled, 1),
        "disp_dob": F.date_add(F.lit(DOB_ORIGIN), (F.col("o_custkey") % 365).cast("int")),
        "days_supply": F.col("l_quantity").cast("int"),
        "mme": F.col("l_quantity") * 3,
        "drug_schedule": (pk % 4 + 2).cast("int"),
        "refill": ln % 2 == 0,
        "state": F.when(sk % 9 == 0, F.lit("NM")).otherwise(F.lit("AZ")),
        "treatment_type": F.when(pk % 19 == 0, F.lit("Hospice")),
        # search-log fields of the row that may be searched
        "l_orderkey": ok, "l_linenumber": ln, "l_partkey": pk, "l_suppkey": sk,
    }
    return b.select(*[v.alias(k) for k, v in cols.items()])


def dispensations(spark: SparkSession, sf_dir: str, with_nulls: bool = False) -> DataFrame:
    """Dispensations extract (clean names), all rows."""
    from rxlens.sources.schemas import DISPENSATIONS_COLUMNS
    return base_prescriptions(spark, sf_dir, with_nulls).select(*DISPENSATIONS_COLUMNS)


def search_log(spark: SparkSession, sf_dir: str, with_nulls: bool = False) -> DataFrame:
    """Every search event (before attribution and windowing)."""
    return _search_log_from(base_prescriptions(spark, sf_dir, with_nulls), with_nulls)


def _search_log_from(base: DataFrame, with_nulls: bool) -> DataFrame:
    b = base.filter((F.col("l_orderkey") + F.col("l_linenumber")) % 3 == 0)
    pk, first = F.col("l_partkey"), F.col("patient_first_name")
    partial_first = pk % 5 == 0
    if with_nulls:
        partial_first = F.when(pk % 31 != 0, partial_first)
    return b.select(
        F.col("l_suppkey").alias("true_id"),
        F.when(pk % 2 == 0, F.col("l_suppkey")).alias("delegator_id"),
        (F.col("l_suppkey") + 1).alias("requestor_id"),
        F.date_add(F.col("written_date"), (F.lit(2) - pk % 12).cast("int")).alias("created_date"),
        F.col("disp_dob").alias("search_dob"),
        F.when(pk % 5 == 0, F.substring(first, 1, 2)).when(pk % 5 == 1, first)
         .otherwise(F.concat(F.substring(first, 1, 3), F.lit("x"))).alias("first_name"),
        F.when((pk % 5 >= 2) & (pk % 11 == 0), F.lit("zzqq"))
         .otherwise(F.col("patient_last_name")).alias("last_name"),
        partial_first.alias("partial_first"),
        F.lit(False).alias("partial_last"),
    )


def searches(spark: SparkSession, sf_dir: str, with_nulls: bool = False) -> DataFrame:
    """Searches extract: attributed to ``l_suppkey`` as the recipe says."""
    from rxlens.sources.schemas import SEARCHES_COLUMNS
    return search_log(spark, sf_dir, with_nulls).select(*SEARCHES_COLUMNS)


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User accounts with the ``active`` flag (before E8)."""
    s = _table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    deas = F.concat(
        F.lit("AB"), pad(k),
        F.when(k % 3 == 0, F.concat(F.lit(", cd"), pad(k))).otherwise(F.lit("")),
        F.when(k % 10 == 0, F.concat(F.lit(",AB"), pad(k + 1))).otherwise(F.lit("")))
    return s.select(
        k.alias("true_id"),
        F.col("s_name").alias("user_full_name"),
        deas.alias("dea_number(s)"),
        F.concat(F.lit("LIC"), k.cast("string")).alias("license_number"),
        F.concat(F.lit("SPEC"), F.col("s_nationkey").cast("string")).alias("specialty_1"),
        F.lit(None).cast("string").alias("specialty_2"),
        F.lit(None).cast("string").alias("specialty_3"),
        F.when(k % 8 == 7, F.lit("N")).otherwise(F.lit("Y")).alias("active"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users extract as the report reads it (every account)."""
    return accounts(spark, sf_dir).drop("active")


def active_rx(spark: SparkSession, sf_dir: str, cfg: ReportConfig, with_nulls: bool = False) -> DataFrame:
    """Active opioid/benzo prescriptions; the DEA here is left un-normalised."""
    return extracts.extract_active_rx(base_prescriptions(spark, sf_dir, with_nulls), cfg,
                                      dea_col="active_dea")


def naive_rx(spark: SparkSession, sf_dir: str, cfg: ReportConfig, with_nulls: bool = False) -> DataFrame:
    """Opioid prescriptions active plus 60 days, latest end per patient and fill."""
    return extracts.extract_naive_rx(base_prescriptions(spark, sf_dir, with_nulls), cfg)


# (application, data folder, fingerprint of its tables, name, variant and period) -> landed frame
_LANDED: dict[tuple, DataFrame] = {}


class LandedInputs(MutableMapping):
    """The five extracts by name, cut from base rows that are landed when the first is asked for.

    Like the upstream extract pull, the rows of the three-table join are written
    once per application as parquet under the shared checkpoint folder and every
    later query reads the files, with column pruning and pushed filters; a lost
    executor re-reads them instead of running the joins again.  They are landed
    as they are in the tables, before the recipe writes its texts, and shared by
    all periods and variants.  Extracts that are a projection of them are not
    written again; ``naive_rx`` is grouped, so it is landed.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, cfg: ReportConfig, with_nulls: bool):
        self._frames = {"users": users(spark, sf_dir)}
        self._spark, self._sf_dir, self._cfg, self._nulls = spark, sf_dir, cfg, with_nulls
        self._mark: str | None = None

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name not in EXTRACTS:
                raise KeyError(name)
            cfg = self._cfg
            rows = self._land("base", (), lambda: base_rows(self._spark, self._sf_dir))
            extract = _extract(name, prescriptions_from(rows, self._nulls), cfg, self._nulls)
            if name in GROUPED:
                extract = self._land(name, (self._nulls, cfg.first_date, cfg.last_date, cfg.naive_days), lambda: extract)
            self._frames[name] = extract
        return self._frames[name]

    def __setitem__(self, name: str, df: DataFrame) -> None:
        self._frames[name] = df

    def __delitem__(self, name: str) -> None:
        del self._frames[name]

    def __iter__(self):
        return iter(dict.fromkeys((*EXTRACTS, *self._frames)))

    def __len__(self) -> int:
        return len(list(iter(self)))

    def _land(self, name: str, period: tuple, build) -> DataFrame:
        from rxlens.session import land
        if self._mark is None:  # once per query: a rewritten table is landed again
            folder = self._sf_dir.rstrip("/")
            self._mark = source_fingerprint(self._spark, [f"{folder}/{t}.parquet" for t in BASE_TABLES])
        key = (self._spark.sparkContext.applicationId, self._sf_dir.rstrip("/"), self._mark, name, *period)
        if key not in _LANDED:
            _LANDED[key] = land(build(), f"extract-{name}", "zstd")
        return _LANDED[key]


def report_inputs(spark: SparkSession, sf_dir: str, cfg: ReportConfig, with_nulls: bool = False,
                  land: bool = True) -> MutableMapping[str, DataFrame]:
    """The five extracts the report consumes: from landed base rows, or lazy frames (``land=False``)."""
    if land:
        return LandedInputs(spark, sf_dir, cfg, with_nulls)
    base = derive_prescriptions(spark, sf_dir, with_nulls)
    return {"users": users(spark, sf_dir), **{k: _extract(k, base, cfg, with_nulls) for k in EXTRACTS}}


BASE_TABLES = ("lineitem", "orders", "part")
EXTRACTS = ("dispensations", "searches", "active_rx", "naive_rx")
GROUPED = ("naive_rx",)


def _extract(name: str, base: DataFrame, cfg: ReportConfig, with_nulls: bool) -> DataFrame:
    from rxlens.sources.schemas import DISPENSATIONS_COLUMNS, SEARCHES_COLUMNS
    if name == "dispensations":
        return base.select(*DISPENSATIONS_COLUMNS)
    if name == "searches":
        return _search_log_from(base, with_nulls).select(*SEARCHES_COLUMNS)
    if name == "active_rx":
        return extracts.extract_active_rx(base, cfg, dea_col="active_dea")
    return extracts.extract_naive_rx(base, cfg)

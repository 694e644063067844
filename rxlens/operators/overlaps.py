"""M9: overlapping opioid/benzodiazepine prescriptions for the same patient.

A pair is (benzo rx, opioid rx) with the same birth date where one's written
date falls inside the other's active interval, and the patient names score
at least ``overlap_ratio``.  ``part`` uses ``[filled, rx_end]``; ``last``
uses ``[create + lag, rx_end]`` and credits only the later writer.

Names of a birth date with few names for its rows are compared first, once per
pair of patients, as are those of a birth date with very many rows (a
placeholder, say), which meet through a similarity index
(``rxlens.operators.patients``).  Prescriptions then meet on (dob, matched name,
time bucket) in one join, each side shuffled once.  For the other birth dates the
OR of two interval conditions is split into two disjoint point-in-interval
joins (opioid written inside benzo interval; else benzo written inside opioid
interval), each an equi-join on (dob, time bucket), never a nested loop; names
are scored on the pairs that meet.
``both`` runs ONE pass with the union interval and flags each pair for either rule.

The credits per prescriber are counted without the pairs (``overlap_counts``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxlens.config import ReportConfig
from rxlens.functions.dates import lit_date, shift_days
from rxlens.functions.similarity import name_signature
from rxlens.operators.daily import MAX_BROADCAST_NAMES, by_patient, day_rows, interval_days, of_matching, sums_at
from rxlens.operators.intervals import point_in_interval_join, time_bucket
from rxlens.operators.match import score_candidates
from rxlens.operators.patients import indexable, indexed_pairs, name_pairs, patient_names, shared_dates, split_hot
from rxlens.plans.strategy import fits, small_side
from rxlens.session import land

SIDE_COLUMNS = ("final_id", "dea", "ahfs", "dob", "patient_name", "written_date", "filled_date",
                "create_date", "rx_end")
NAMES_PAY = 16    # pairs of rows of a birth date, for each pair of its names, from which names are met first
PAIR_BUCKETS = 4  # buckets of the configured length in one bucket of the pairs whose names match


def _opi(c: str) -> str:
    return f"{c}_opi"


def _starts(cfg: ReportConfig, kind: str, suffix: str = "") -> Column:
    filled = F.col(f"filled_date{suffix}")
    lagged = shift_days(f"create_date{suffix}", cfg.report_lag_days)
    if kind == "part":
        return filled
    if kind == "last":
        return lagged
    return F.least(filled, lagged)


def _within(point: str, start: Column, end: str) -> Column:
    return F.col(point).between(start, F.col(end))


def part_rule() -> Column:
    return (_within("written_date_opi", F.col("filled_date"), "rx_end")
            | _within("written_date", F.col("filled_date_opi"), "rx_end_opi"))


def last_rule(cfg: ReportConfig) -> Column:
    return (_within("written_date_opi", shift_days("create_date", cfg.report_lag_days), "rx_end")
            | _within("written_date", shift_days("create_date_opi", cfg.report_lag_days), "rx_end_opi"))


CREDIT_COLUMNS = ("final_id", "final_id_opi", "written_date", "written_date_opi")


def _in_time(o: DataFrame, b: DataFrame, cfg: ReportConfig, kind: str) -> DataFrame:
    """Pairs with one birth date whose times meet, each once."""
    common = dict(bucket_days=cfg.bucket_days, salt=cfg.salt_buckets)
    start_b = _starts(cfg, kind)
    start_o = _starts(cfg, kind, "_opi")
    # branch 1: opioid written inside the benzo interval
    one = point_in_interval_join(o, b, on=[("dob_opi", "dob")], point="written_date_opi",
                                 start=start_b, end=F.col("rx_end"), **common)
    # branch 2: benzo written inside the opioid interval, and not already branch 1
    two = point_in_interval_join(b, o, on=[("dob", "dob_opi")], point="written_date",
                                 start=start_o, end=F.col("rx_end_opi"), **common)
    two = two.filter(~F.coalesce(_within("written_date_opi", start_b, "rx_end"), F.lit(False)))
    return one.unionByName(two)


def _flagged(pairs: DataFrame, cfg: ReportConfig, kind: str) -> DataFrame:
    if kind != "both":
        return pairs
    return pairs.withColumns({"is_part": F.coalesce(part_rule(), F.lit(False)),
                              "is_last": F.coalesce(last_rule(cfg), F.lit(False))})


def _scored_after(o: DataFrame, b: DataFrame, cfg: ReportConfig, kind: str, columns: list[str],
                  live: Column) -> DataFrame:
    """Times meet first, names are scored on what is left: few names share a birth date."""
    o = o.withColumn("_sig_opi", name_signature(F.col("patient_name_opi")))
    b = b.withColumn("_sig", name_signature(F.col("patient_name")))
    cands = _flagged(_in_time(o, b, cfg, kind).filter(live), cfg, kind)
    return score_candidates(cands, "patient_name_opi", "patient_name", F.lit(float(cfg.overlap_ratio)),
                            keep=columns, sigs=("_sig_opi", "_sig")).select(*columns, "ratio")


def _scored_before(o: DataFrame, b: DataFrame, cfg: ReportConfig, kind: str, columns: list[str], live: Column,
                   names: list[DataFrame]) -> DataFrame:
    """Names meet first, once per pair of patients, and times afterwards; ``names`` as from ``name_pairs``."""
    matching = None
    for pairs in names:
        one = (b.join(pairs, (F.col("dob") == F.col("_dob")) & (F.col("patient_name") == F.col("_right_name")))
               .drop("_dob", "_right_name"))
        matching = one if matching is None else matching.unionByName(one)
    return _flagged(_met_once(o, matching, cfg, kind).filter(live), cfg, kind).select(*columns, "ratio")


def _met_once(o: DataFrame, b: DataFrame, cfg: ReportConfig, kind: str) -> DataFrame:
    """Pairs with one birth date and matched name whose times meet, each once, by one join of both sides.

    Both sides are dealt to the time buckets of their interval and their written date; a pair belongs to the bucket
    of the written date that lies in the other's interval (the opioid's, if both do).  Most pairs that meet in a
    bucket are put out or nearly are, so buckets are ``PAIR_BUCKETS`` times as long as those of a join that has yet
    to compare names, and rows are seldom copied.
    """
    days = cfg.bucket_days * PAIR_BUCKETS
    start_b, start_o = _starts(cfg, kind), _starts(cfg, kind, "_opi")

    def dealt(df: DataFrame, start: Column, end: str, written: str, bucket: str) -> DataFrame:
        none = F.array().cast("array<bigint>")
        over = F.when(start <= F.col(end), F.sequence(time_bucket(start, days), time_bucket(F.col(end), days)))
        at = F.when(F.col(written).isNotNull(), F.array(time_bucket(F.col(written), days)))
        return df.withColumn(bucket, F.explode(F.array_union(F.coalesce(over, none), F.coalesce(at, none))))

    left = dealt(o, start_o, "rx_end_opi", "written_date_opi", "_bucket_opi")
    right = dealt(b, start_b, "rx_end", "written_date", "_bucket")
    inside_b = F.coalesce(_within("written_date_opi", start_b, "rx_end"), F.lit(False))
    inside_o = F.coalesce(_within("written_date", start_o, "rx_end_opi"), F.lit(False))
    cond = ((F.col("dob_opi") == F.col("dob")) & (F.col("patient_name_opi") == F.col("_left_name"))
            & (F.col("_bucket_opi") == F.col("_bucket"))
            & ((inside_b & (time_bucket(F.col("written_date_opi"), days) == F.col("_bucket")))
               | (~inside_b & inside_o & (time_bucket(F.col("written_date"), days) == F.col("_bucket")))))
    if cfg.salt_buckets > 1:
        left = left.withColumn("_salt_opi", F.pmod(F.xxhash64(*o.columns), F.lit(cfg.salt_buckets)).cast("int"))
        right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(cfg.salt_buckets - 1))))
        cond = cond & (F.col("_salt_opi") == F.col("_salt"))
    # estimates know neither the names nor the buckets: never broadcast on them
    return left.join(right.hint("merge"), cond)


def _ways(a: DataFrame, b: DataFrame, cfg: ReportConfig) -> DataFrame:
    """(_dob, _way, and counts) of the birth dates on both sides of ``patient_names``, landed.

    ``names``: few pairs of names for the pairs of rows, all names of the date are compared; ``index``: many rows,
    names meet through the index; ``times``: neither, prescriptions meet in time before their names are compared.
    """
    few = (F.col("_names_a").cast("double") * F.col("_names_b") * NAMES_PAY
           <= F.col("_rows_a").cast("double") * F.col("_rows_b"))
    index = F.lit(indexable(cfg.overlap_ratio))
    many_names, many_rows = (index & (F.greatest(f"_{c}_a", f"_{c}_b") >= F.lit(cfg.name_block + more))
                             for c, more in (("names", 0), ("rows", 1)))
    way = F.when(few & ~many_names, "names").when(many_rows, "index").otherwise("times")
    return land(shared_dates(a, b).withColumn("_way", way), "overlap-dates")


def overlap_pairs(benzo: DataFrame, opioid: DataFrame, cfg: ReportConfig, kind: str,
                  keep: list[str] | None = None, credited_only: bool = False, digits: int | None = None) -> DataFrame:
    """J9/J10 (+ both): scored overlap pairs, columns of the opioid side
    suffixed ``_opi``, with ``ratio`` and, for ``both``, ``is_part``/``is_last``.
    ``keep`` limits the carried columns (the credit counts need four);
    ``credited_only`` skips pairs of which neither side wrote in the period;
    ``digits`` rounds ``ratio``, once per pair of names where these meet first.

    The rows and names of each birth date are counted first, which decides
    whether its names or its times meet first (``_ways``).
    """
    o = opioid.select(*[F.col(c).alias(_opi(c)) for c in SIDE_COLUMNS])
    b = benzo.select(*SIDE_COLUMNS)
    columns = list(keep) if keep is not None else [*SIDE_COLUMNS, *(_opi(c) for c in SIDE_COLUMNS if c != "dob")]
    columns += ["is_part", "is_last"] if kind == "both" else []
    live, live_sides = F.lit(True), (F.lit(True), F.lit(True))
    if credited_only:
        first, last = lit_date(cfg.first_date), lit_date(cfg.last_date)
        live_sides = (F.col("written_date_opi").between(first, last), F.col("written_date").between(first, last))
        live = live_sides[0] | live_sides[1]
    named = (patient_names(o, "dob_opi", "patient_name_opi", live=live_sides[0]),
             patient_names(b, "dob", "patient_name", live=live_sides[1]))
    dates = _ways(*named, cfg)
    rounded = {"ratio": F.col("ratio") if digits is None else F.round("ratio", digits)}
    found = {r["_way"] for r in dates.select("_way").distinct().collect()}  # three at most
    names = []
    if "names" in found:
        pairs = land(name_pairs(*named, cfg.overlap_ratio, dates.where("_way = 'names'").drop("_way"))
                     .withColumns(rounded), "name-pairs")
        names.append(small_side(pairs, fits(pairs, MAX_BROADCAST_NAMES)))
    if "index" in found:
        hot = dates.where("_way = 'index'").select("_dob", F.greatest("_rows_a", "_rows_b").alias("_rows"))
        names.append(indexed_pairs(*named, cfg.overlap_ratio, hot, cfg.name_block).withColumns(rounded))
    if not names:
        return _scored_after(o, b, cfg, kind, columns, live).withColumns(rounded)
    if "times" not in found:
        return _scored_before(o, b, cfg, kind, columns, live, names)
    by_time = dates.where("_way = 'times'").select("_dob")
    (slow_o, rest_o), (slow_b, rest_b) = (split_hot(d, dob, by_time, cfg.max_broadcast_rows)
                                          for d, dob in ((o, "dob_opi"), (b, "dob")))
    return (_scored_after(slow_o, slow_b, cfg, kind, columns, live).withColumns(rounded)
            .unionByName(_scored_before(rest_o, rest_b, cfg, kind, columns, live, names)))


RULE_COLUMNS = {"part": "overlapping_rx_part", "last": "overlapping_rx_last"}


def overlap_counts(benzo: DataFrame, opioid: DataFrame, cfg: ReportConfig, kind: str) -> DataFrame:
    """Per prescriber ``overlapping_rx_part`` and/or ``overlapping_rx_last``: the pairs of ``overlap_pairs``
    credited to a side that wrote in the period, counted without meeting each other.

    Names of a birth date meet first, once per pair of patients.  For a credited prescription x the pairs are those
    prescriptions y of matching patients written inside the interval of x, plus those whose interval holds the
    written date of x, less those that do both.  The first two are running sums over the days of a patient
    (``operators.daily``).  Both hold only on one day, where intervals begin no earlier than the written date; those
    that begin before it are met in pairs over the days between (``_twice``).
    """
    first, last = lit_date(cfg.first_date), lit_date(cfg.last_date)
    rules = [k for k in RULE_COLUMNS if kind in (k, "both")]

    def side(df: DataFrame) -> DataFrame:
        rows = df.select("final_id", "dob", F.col("patient_name").alias("name"), "written_date",
                         F.col("rx_end").alias("end"), *[_starts(cfg, k).alias(f"start_{k}") for k in rules])
        return (rows.filter(F.col("dob").isNotNull() & F.col("name").isNotNull())
                .withColumn("live", F.coalesce(F.col("written_date").between(first, last), F.lit(False))))

    sides = [side(benzo), side(opioid)]
    named = [patient_names(x, "dob", "name", live=F.col("live"), **{f"early_{k}": _early(k) for k in rules})
             for x in sides]
    names = land(name_pairs(*named, cfg.overlap_ratio, shared_dates(*named), cfg.name_block)
                 .select("_dob", "_left_name", "_right_name"), "name-pairs")
    back = names.select("_dob", F.col("_right_name").alias("_left_name"), F.col("_left_name").alias("_right_name"))
    early = {k: not named[0].where(f"_early_{k}").unionAll(named[1].where(f"_early_{k}")).isEmpty() for k in rules}
    columns = [RULE_COLUMNS[k] for k in rules]
    counted = None
    for x, y, pairs in ((*sides, names), (*sides[::-1], back)):
        parts = [_credits(x, y, pairs, rules)] + [_twice(x, y, pairs, cfg, k, rules) for k in rules if early[k]]
        for part in parts:
            # landed one by one, so that the disk holds the shuffles of one
            part = land(part.groupBy("final_id").agg(*[F.sum(c).alias(c) for c in columns]), "credits")
            counted = part if counted is None else counted.unionByName(part)
    total = counted.groupBy("final_id").agg(*[F.sum(c).alias(c) for c in columns])
    return total.where(" OR ".join(f"{c} > 0" for c in columns))


def _early(rule: str) -> Column:
    return F.col(f"start_{rule}") < F.col("written_date")


def _inside(rule: str) -> tuple[Column, Column]:
    """The days on which a prescription counts for x if y is written on them: ``last`` credits the later writer."""
    end, before = F.col("end"), F.date_sub("written_date", 1)
    return F.col(f"start_{rule}"), end if rule == "part" else F.when(end < before, end).when(end >= before, before)


def _active(rule: str) -> tuple[Column, Column]:
    """The days on which y counts for x if x is written on them."""
    start, after = F.col(f"start_{rule}"), F.date_add("written_date", 1)
    return start if rule == "part" else F.when(start > after, start).when(start <= after, after), F.col("end")


def _credits(x: DataFrame, y: DataFrame, names: DataFrame, rules: list[str]) -> DataFrame:
    """(final_id, count per rule) of x: written inside, plus active when written, less both on one day (``part``)."""
    day, one, minus = F.col("written_date"), F.lit(1), F.lit(-1)
    # prescriptions that are written, begin and are active on one day
    same = F.coalesce((F.col("start_part") <= day) & (F.col("end") >= day), F.lit(False)) if "part" in rules else None
    events = [(day, {"written": one, **({"both": same.cast("long")} if same is not None else {})})]
    sums = ["written"] + (["both"] if same is not None else [])
    at_day: dict[str, Column] = {}
    found = []
    for k in rules:
        events += interval_days(*_active(k), f"active_{k}")
        sums.append(f"active_{k}")
        at_day[f"active_{k}"] = one
        lo, hi = _inside(k)
        there = lo <= hi
        before = {f"written_{k}": minus}
        if k == "part":
            on_day = F.coalesce(there & (lo == day), F.lit(False)).cast("long")
            before["both"], at_day["both"] = on_day, -on_day
        found += [(F.when(there, hi), {f"written_{k}": one}), (F.when(there, F.date_sub(lo, 1)), before)]
    weights = [f"written_{k}" for k in rules] + [f"active_{k}" for k in rules] + (["both"] if same is not None else [])
    found.append((day, at_day))
    days = ["written_date", "end", *[f"start_{k}" for k in rules]]
    lookups = day_rows(by_patient(x.filter("live").select("dob", "name", "final_id", *days)), ["dob", "name", "final_id"],
                       found, weights)
    lookups = lookups.withColumnsRenamed({w: f"times_{w}" for w in weights})
    matching = by_patient(of_matching(y.select("dob", "name", *days), names))
    at = sums_at(lookups, day_rows(matching, ["dob", "name"], events, sums), sums)
    counts = []
    for k in rules:
        n = (F.col(f"times_written_{k}") * F.col("written") + F.col(f"times_active_{k}") * F.col(f"active_{k}"))
        counts.append((n + F.col("times_both") * F.col("both") if k == "part" else n).alias(RULE_COLUMNS[k]))
    return at.select("final_id", *counts)


def _twice(x: DataFrame, y: DataFrame, names: DataFrame, cfg: ReportConfig, rule: str, rules: list[str]) -> DataFrame:
    """-1 for each pair that ``_credits`` counts twice because an interval begins before its written date."""
    (lo, hi), (start, end) = _inside(rule), _active(rule)
    x = x.filter("live").select("final_id", "dob", "name", F.col("written_date").alias("x_day"), lo.alias("x_lo"),
                                hi.alias("x_hi"), _early(rule).alias("x_early"))
    y = y.select(F.col("dob").alias("y_dob"), F.col("name").alias("y_name"), F.col("written_date").alias("y_day"),
                 start.alias("y_lo"), end.alias("y_hi"), _early(rule).alias("y_early"))
    common = dict(bucket_days=cfg.bucket_days, salt=cfg.salt_buckets)
    both = F.col("x_day").between(F.col("y_lo"), F.col("y_hi")) & F.col("y_day").between(F.col("x_lo"), F.col("x_hi"))
    # y written from the beginning of x up to the day x is written
    mine = (x.filter("x_early").join(names, (F.col("dob") == F.col("_dob")) & (F.col("name") == F.col("_left_name")))
            .drop("_dob", "_left_name"))
    upto = F.when(F.col("x_hi") < F.col("x_day"), F.col("x_hi")).otherwise(F.col("x_day"))
    pairs = point_in_interval_join(y, mine, on=[("y_dob", "dob"), ("y_name", "_right_name")], point="y_day",
                                   start=F.col("x_lo"), end=upto, **common).filter(both).select("final_id")
    if rule == "part":  # for ``last``, y is written before x: none is left
        theirs = (y.filter("y_early")
                  .join(names, (F.col("y_dob") == F.col("_dob")) & (F.col("y_name") == F.col("_right_name")))
                  .drop("_dob", "_right_name"))
        upto = F.when(F.col("y_hi") < F.date_sub("y_day", 1), F.col("y_hi")).otherwise(F.date_sub("y_day", 1))
        pairs = pairs.unionAll(
            point_in_interval_join(x, theirs, on=[("dob", "y_dob"), ("name", "_left_name")], point="x_day",
                                   start=F.col("y_lo"), end=upto, **common).filter(both).select("final_id"))
    return pairs.select("final_id", *[F.lit(-1 if k == rule else 0).cast("long").alias(RULE_COLUMNS[k]) for k in rules])

"""Name matching between two sets of patients that share a much used birth date.

A placeholder birth date may hold a large share of all patients, and every name
of one side would meet every name of the other.  Here names meet through an
index instead, which loses no pair that scores the threshold:

* A Jaro score of r needs m matching characters with m (1/a + 1/b) >= 3 r - 1
  (a, b the lengths), and matching characters are common ones.  So two names
  have c = ceil((3 r - 1) a b / (a + b)) common characters, counted with their
  repeats (the second E is another token than the first).
* Sort the tokens of a name from rare to common.  Two names with c common tokens
  share at least k of them within their first a - c + k and b - c + k tokens, so
  it is enough to look at the k-combinations of these prefixes.
* The Winkler boost grows with the common beginning: names that agree on less
  than three first characters need a higher Jaro score, which gives longer
  common parts and short prefixes; names that agree on three are only looked up
  among those with the same three.

A key is (birth date, case, both lengths, combination).  k grows with the number
of names of the date, so the pairs that meet grow slower than its square.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxlens.functions.similarity import WINKLER_SCALE, WINKLER_THRESHOLD, name_signature
from rxlens.operators.match import score_candidates
from rxlens.plans.strategy import fits, small_side

# letters from rare to common in names; other characters are rarer, the space most common
RARITY = {c: i for i, c in enumerate("QXZJVKWFYPBGUDMCHTOLSINREA ", start=1)}
HEAD = 3           # characters that decide between the two cases
MAX_COMBINATION = 6
DATE_PART = 512    # left names of a birth date in one join key


def rare_first(name: str) -> list[tuple]:
    """The characters of a name with their repeats, from rare to common."""
    seen: dict[str, int] = {}
    tokens = []
    for c in name:
        seen[c] = seen.get(c, 0) + 1
        tokens.append((-seen[c], RARITY.get(c, 0), c))
    return sorted(tokens)


def least_common(a: int, b: int, jaro: float) -> int:
    """Characters that names of lengths ``a`` and ``b`` must share for a Jaro score of ``jaro``."""
    return max(1, math.ceil((3 * jaro - 1) * a * b / (a + b) - 1e-6))


def jaro_needed(threshold: float, head: int) -> float:
    """Least Jaro score that ``head`` common first characters can lift to ``threshold``."""
    if threshold <= WINKLER_THRESHOLD:
        return threshold
    lift = head * WINKLER_SCALE
    return max(WINKLER_THRESHOLD, (threshold - lift) / (1 - lift))


def name_keys(name: str, threshold: float, k: int) -> set[int]:
    """Index keys: two names that score ``threshold`` share at least one (for the same ``k``)."""
    tokens, a = rare_first(name), len(name)
    keys = set()
    # the boost counts up to four characters; below HEAD common ones at most HEAD - 1 do
    for case, jaro in ((name[:HEAD] if a >= HEAD else None, jaro_needed(threshold, 4)),
                       ("", jaro_needed(threshold, HEAD - 1))):
        if case is None:
            continue
        b = 1
        while True:
            c = least_common(a, b, jaro)
            if c <= min(a, b):
                size = min(k, c)
                for combo in combinations(tokens[:a - c + size], size):
                    text = f"{case}|{min(a, b)}|{max(a, b)}|" + "".join(f"{ch}{-n}," for n, _, ch in combo)
                    keys.add(int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "big", signed=True))
            elif b > a:
                break
            b += 1
    return keys


def indexable(threshold: float) -> bool:
    """Below a Jaro score of 2/3 no length rules a partner out, and the index has no end of lengths."""
    return jaro_needed(threshold, 4) > 2 / 3 + 1e-9


def combination_size(names: int, block: int) -> int:
    """k for a birth date of ``names`` rows: two at ``block``, one more for every fourfold."""
    return min(MAX_COMBINATION, 2 + max(0, int(math.log(max(names, 1) / block, 4))))


def hot_dates(sides: list[tuple[DataFrame, str]], block: int) -> DataFrame | None:
    """(_dob, _rows) of the birth dates with more than ``block`` rows on a side; None if there are none."""
    counted = None
    for df, dob in sides:
        one = (df.where(F.col(dob).isNotNull()).groupBy(F.col(dob).alias("_dob")).agg(F.count(F.lit(1)).alias("_rows"))
               .where(F.col("_rows") > block))
        counted = one if counted is None else counted.unionByName(one)
    from rxlens.session import land
    found = land(counted.groupBy("_dob").agg(F.max("_rows").alias("_rows")), "hot-dates")
    return None if found.isEmpty() else found


def split_hot(df: DataFrame, dob: str, hot: DataFrame, max_rows: int) -> tuple[DataFrame, DataFrame]:
    """Rows of the hot birth dates, and the others."""
    dates = small_side(hot.select(F.col("_dob").alias(dob)), fits(hot, max_rows))
    return df.join(dates, dob, "left_semi"), df.join(dates, dob, "left_anti")


def _distinct(df: DataFrame, dob: str, name: str, live: Column | None, hot: DataFrame) -> DataFrame:
    """Distinct (birth date, name), with whether any row of the patient is live and the date's row count."""
    live = F.lit(True) if live is None else F.coalesce(live, F.lit(False))
    rows = df.filter(F.col(dob).isNotNull() & (F.length(name) > 0))
    return (rows.groupBy(F.col(dob).alias("_dob"), F.col(name).alias("_name")).agg(F.max(live).alias("_live"))
            .join(hot, "_dob").select("_dob", "_name", "_live", "_rows"))


def _keyed(side: DataFrame, threshold: float, block: int, tag: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dobs, names, live, rows = (c.to_pylist() for c in b.columns)
            for lo in range(0, len(names), 500):
                row, key = [], []
                for i in range(lo, min(lo + 500, len(names))):
                    mine = name_keys(names[i], threshold, combination_size(rows[i], block))
                    row += [i] * len(mine)
                    key += mine
                part = b.take(pa.array(row, pa.int64()))
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(key, pa.int64())],
                                                 names=["dob", "name", "live", "key"])

    kind = side.schema["_dob"].dataType.simpleString()
    made = side.mapInArrow(run, f"dob {kind}, name string, live boolean, key long")
    return made.select(*[F.col(c).alias(f"_{c}_{tag}") for c in made.columns])


def patient_names(df: DataFrame, dob: str, name: str, **flags: Column) -> DataFrame:
    """(_dob, _name, _rows) and whether any row has each flag, one row per patient; landed, since it has several readers.

    Rows without a birth date or a name match nothing and are left out.
    """
    from rxlens.session import land
    rows = df.filter(F.col(dob).isNotNull() & F.col(name).isNotNull())
    named = rows.groupBy(F.col(dob).alias("_dob"), F.col(name).alias("_name")).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.max(F.coalesce(v, F.lit(False))).alias(f"_{k}") for k, v in flags.items()])
    return land(named, "patient-names")


def shared_dates(a: DataFrame, b: DataFrame) -> DataFrame:
    """(_dob, _names_a, _rows_a, _names_b, _rows_b) of the birth dates on both sides of ``patient_names``."""
    def counted(side: DataFrame, tag: str) -> DataFrame:
        return side.groupBy("_dob").agg(F.count(F.lit(1)).alias(f"_names_{tag}"), F.sum("_rows").alias(f"_rows_{tag}"))

    return counted(a, "a").join(counted(b, "b"), "_dob")


def name_pairs(a: DataFrame, b: DataFrame, threshold: float, dates: DataFrame, block: int | None = None) -> DataFrame:
    """Pairs of names with one birth date that score ``threshold``: ``_dob``, ``_left_name``, ``_right_name``, ``ratio``.

    ``a`` and ``b`` come from ``patient_names`` with a ``live`` flag (pairs without a live patient are left out),
    ``dates`` from ``shared_dates``; other birth dates are left out.  Names of a date are compared with each other,
    at most ``DATE_PART`` of the left ones in a join key.  Given ``block``, dates with more names than that on a
    side go through the index instead (where the threshold allows one).
    """
    from rxlens.session import land
    hot = None
    if block is not None and indexable(threshold):
        names = F.greatest("_names_a", "_names_b")
        hot = land(dates.where(names > block).select("_dob", names.alias("_rows")), "hot-dates")
        dates = dates.where(names <= block)
    met = _met_by_date(a, b, dates)
    if hot is not None and not hot.isEmpty():
        met = met.unionByName(_signed(_met_by_key(_of_hot(a, hot), _of_hot(b, hot), threshold, block)))
    return _scored_names(met, threshold)


def _of_hot(side: DataFrame, hot: DataFrame) -> DataFrame:
    return side.where(F.length("_name") > 0).drop("_rows").join(hot, "_dob").select("_dob", "_name", "_live", "_rows")


def indexed_pairs(a: DataFrame, b: DataFrame, threshold: float, hot: DataFrame, block: int) -> DataFrame:
    """``name_pairs`` of the birth dates of ``hot`` (``_dob``, ``_rows``), all through the index; lazy."""
    return _scored_names(_signed(_met_by_key(_of_hot(a, hot), _of_hot(b, hot), threshold, block)), threshold)


def _met_by_date(a: DataFrame, b: DataFrame, dates: DataFrame) -> DataFrame:
    """(_dob_a, _name_a, _name_b) of one birth date, of which one is live, and their signatures (made once a name)."""
    parts = dates.select("_dob", F.ceil(F.col("_names_a") / F.lit(DATE_PART)).cast("int").alias("_parts"))
    mine = F.pmod(F.xxhash64("_name"), F.col("_parts")).cast("int")
    # an own number of partitions: few names in bytes may be many pairs, so they are not coalesced by their size
    n = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = (a.join(parts, "_dob").select(F.col("_dob").alias("_dob_a"), F.col("_name").alias("_name_a"),
                                         F.col("_live").alias("_live_a"), mine.alias("_part_a"),
                                         name_signature(F.col("_name")).alias("_sig_a"))
            .repartition(n, "_dob_a", "_part_a"))
    right = (b.join(parts, "_dob").select(F.col("_dob").alias("_dob_b"), F.col("_name").alias("_name_b"),
                                          F.col("_live").alias("_live_b"), name_signature(F.col("_name")).alias("_sig_b"),
                                          F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part_b"))
             .repartition(n, "_dob_b", "_part_b"))
    met = left.join(right.hint("merge"), (F.col("_dob_a") == F.col("_dob_b")) & (F.col("_part_a") == F.col("_part_b"))
                    & (F.col("_live_a") | F.col("_live_b")))
    return met.select("_dob_a", "_name_a", "_name_b", "_sig_a", "_sig_b")


def _signed(met: DataFrame) -> DataFrame:
    return met.withColumns({"_sig_a": name_signature(F.col("_name_a")), "_sig_b": name_signature(F.col("_name_b"))})


def _scored_names(met: DataFrame, threshold: float) -> DataFrame:
    scored = score_candidates(met, "_name_a", "_name_b", F.lit(float(threshold)), keep=["_dob_a"],
                              sigs=("_sig_a", "_sig_b"))
    return scored.select(F.col("_dob_a").alias("_dob"), F.col("_name_a").alias("_left_name"),
                         F.col("_name_b").alias("_right_name"), "ratio")


def matched_names(left: DataFrame, right: DataFrame, left_on: tuple[str, str], right_on: tuple[str, str],
                  threshold: float, hot: DataFrame, block: int, live: tuple[Column, Column] | None = None) -> DataFrame:
    """Pairs of names with one of the ``hot`` birth dates that score ``threshold`` or more.

    ``left_on`` and ``right_on`` name the (birth date, name) columns.  Returns
    ``_dob``, ``_left_name``, ``_right_name``, ``ratio``, one row per pair.
    ``live`` (a condition per side) keeps only pairs with a live patient on
    either side, before any name is scored.  Null dates, null and empty names
    match nothing; an empty side gives no pairs.
    """
    met = index_candidates(left, right, left_on, right_on, threshold, hot, block, live)
    return _scored_names(_signed(met), threshold)


def index_candidates(left: DataFrame, right: DataFrame, left_on: tuple[str, str], right_on: tuple[str, str],
                     threshold: float, hot: DataFrame, block: int,
                     live: tuple[Column, Column] | None = None) -> DataFrame:
    """Distinct (_dob_a, _name_a, _name_b) that share an index key."""
    l_live, r_live = live or (None, None)
    return _met_by_key(_distinct(left, *left_on, l_live, hot), _distinct(right, *right_on, r_live, hot), threshold, block)


def _met_by_key(left: DataFrame, right: DataFrame, threshold: float, block: int) -> DataFrame:
    a, b = _keyed(left, threshold, block, "a"), _keyed(right, threshold, block, "b")
    met = a.join(b, (F.col("_dob_a") == F.col("_dob_b")) & (F.col("_key_a") == F.col("_key_b"))
                 & (F.col("_live_a") | F.col("_live_b")), "inner")
    return met.select("_dob_a", "_name_a", "_name_b").distinct()

"""Counts per patient and day, without meeting prescriptions in pairs.

How many prescriptions of matching patients were written between two days, or
are active on a day, is a difference of running sums over the days of a
patient.  Events (a day and what it adds) and lookups (a day at which the sums
are wanted) of one patient are sorted by day once, so the work grows with the
rows and not with the pairs of rows that meet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxlens.plans.strategy import fits, small_side

MAX_BROADCAST_NAMES = 200_000  # pairs of names


def day_rows(df: DataFrame, keep: Sequence[str], days: Sequence[tuple[Column, dict[str, Column]]],
             sums: Sequence[str]) -> DataFrame:
    """``keep``, ``day`` and ``sums`` (0 where not given) for each (day, values) of a row; days that are null are left out."""
    structs = [F.struct(day.alias("day"), *[v.get(c, F.lit(0)).cast("long").alias(c) for c in sums]) for day, v in days]
    return df.select(*keep, F.inline(F.array(*structs))).where(F.col("day").isNotNull())


def interval_days(start: Column, end: Column, name: str) -> list[tuple[Column, dict[str, Column]]]:
    """Events of a closed interval: one more from ``start`` on, one less after ``end``; none if it is empty."""
    there = start <= end
    return [(F.when(there, start), {name: F.lit(1)}), (F.when(there, F.date_add(end, 1)), {name: F.lit(-1)})]


def _by_day(events: DataFrame, sums: Sequence[str]) -> DataFrame:
    return events.groupBy("dob", "name", "day").agg(*[F.sum(c).alias(c) for c in sums])


def merged(events: DataFrame, column: str) -> DataFrame:
    """Events of the days covered at all, given those of intervals that overlap: 1 where cover begins, -1 where it ends."""
    after = F.sum(column).over(Window.partitionBy("dob", "name").orderBy("day")
                               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    turns = _by_day(events, [column]).withColumn("_after", after).withColumn("_before", F.col("_after") - F.col(column))
    turn = (F.col("_after") > 0).cast("long") - (F.col("_before") > 0).cast("long")
    return turns.select("dob", "name", "day", turn.alias(column)).where(F.col(column) != 0)


def of_matching(rows: DataFrame, names: DataFrame) -> DataFrame:
    """``rows`` (with ``dob`` and ``name``) once for each name that they match, which becomes their ``name``.

    ``names`` (``_dob``, ``_left_name``, ``_right_name``, landed) says which right names belong to a left one.
    """
    small = small_side(names.select("_dob", "_left_name", "_right_name"), fits(names, MAX_BROADCAST_NAMES))
    moved = rows.join(small, (F.col("dob") == F.col("_dob")) & (F.col("name") == F.col("_right_name")))
    return moved.drop("name", "_dob", "_right_name").withColumnRenamed("_left_name", "name")


def by_patient(rows: DataFrame) -> DataFrame:
    """Rows of a patient in one place, before they are written out day by day: the shuffle carries each of them once."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "dob", "name")


def sums_at(lookups: DataFrame, events: DataFrame, sums: Sequence[str]) -> DataFrame:
    """``lookups`` with the ``sums`` of all events of their patient up to their day.

    Both sides have ``dob``, ``name`` and ``day`` and come from rows dealt ``by_patient``, so nothing is shuffled here.
    """
    own = [c for c in lookups.columns if c not in ("dob", "name", "day")]
    rows = (_by_day(events, sums).select("dob", "name", "day", F.lit(False).alias("_lookup"), *sums,
                                         *[F.lit(None).cast(lookups.schema[c].dataType).alias(c) for c in own])
            .unionByName(lookups.select("dob", "name", "day", F.lit(True).alias("_lookup"),
                                        *[F.lit(0).cast("long").alias(c) for c in sums], *own)))
    # the events of a day come before its lookups
    upto = (Window.partitionBy("dob", "name").orderBy("day", "_lookup")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    at = rows.select("dob", "name", "day", "_lookup", *own, *[F.sum(c).over(upto).alias(f"_at_{c}") for c in sums])
    return at.where("_lookup").select("dob", "name", "day", *own, *[F.col(f"_at_{c}").alias(c) for c in sums])

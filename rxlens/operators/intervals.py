"""Point-in-interval equi-join with time buckets (the engine's range join).

Spark has no interval join: with only the equality keys (a birth date, a
prescriber) every pair inside a key is compared, which is quadratic in a hot
key.  Here the time axis is cut into ``bucket_days`` buckets, each interval
row is exploded to the buckets it covers and each point row carries its own
bucket, so the join key becomes ``(keys..., bucket)``: only pairs that are
close in time meet, and a hot key is spread over its buckets.  A point lies in
exactly one bucket, so every (point, interval) pair is produced once.

Cost model: the interval side grows by ``span / bucket_days + 1`` rows per
interval (about 1.3x for a 9-day search window and 2-5x for supplies of
up to 110 days with 30-day buckets); the point side is not multiplied.  The
explosion is exact for any span, so no interval is capped or dropped.  When
the points are known to lie inside a date range (``point_range``) intervals
are exploded only over that range.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PB = "_point_bucket"
_IB = "_interval_bucket"
_PS = "_point_salt"
_IS = "_interval_salt"
MAX_BROADCAST_GROUPS = 200_000


def time_bucket(c: Column, days: int) -> Column:
    return F.floor(F.unix_date(c) / F.lit(float(days))).cast("long")


def _any_large(points: DataFrame, intervals: DataFrame, on: Sequence[tuple[str, str]], limit: int) -> bool:
    """Does any key hold more than ``limit`` rows?  If not, no bucket of it does, and nothing is exploded to count."""
    def counted(df: DataFrame, keys: list[str]) -> DataFrame:
        return df.groupBy(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)]).count().where(F.col("count") > limit)

    return not counted(points, [a for a, _ in on]).unionAll(counted(intervals, [b for _, b in on])).isEmpty()


def _large_groups(pts: DataFrame, exploded: DataFrame, on: Sequence[tuple[str, str]], limit: int) -> DataFrame | None:
    """(_k0.., _bucket, _rows, _cols): parts of the groups with more than ``limit`` rows on a side; None without any.

    At most rows / ``limit`` groups; landed, since both sides are joined with it.
    """
    from rxlens.session import land

    def counted(df: DataFrame, keys: list[str], points: bool) -> DataFrame:
        parts = F.ceil(F.count(F.lit(1)) / F.lit(limit)).cast("int")
        one = F.lit(1)
        return (df.groupBy(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)])
                .agg((parts if points else one).alias("_rows"), (one if points else parts).alias("_cols"))
                .where("_rows > 1 OR _cols > 1"))

    both = counted(pts, [a for a, _ in on] + [_PB], True).unionByName(
        counted(exploded, [b for _, b in on] + [_IB], False))
    keys = [f"_k{i}" for i in range(len(on) + 1)]
    hot = land(both.groupBy(*keys).agg(F.max("_rows").alias("_rows"), F.max("_cols").alias("_cols")), "large-groups")
    return None if hot.isEmpty() else hot


def _in_parts(df: DataFrame, hot: DataFrame, keys: list[str], own: str, other: str, tag: str) -> DataFrame:
    """Each row in its part of ``own`` and in every part of ``other``."""
    from rxlens.plans.strategy import fits, small_side
    named = hot.select(*[F.col(f"_k{i}").alias(f"_h{i}") for i in range(len(keys))], own, other)
    match = F.lit(True)
    for i, c in enumerate(keys):
        match = match & (F.col(c) == F.col(f"_h{i}"))
    parted = df.join(small_side(named, fits(named, MAX_BROADCAST_GROUPS)), match, "left")
    mine = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.coalesce(own, F.lit(1))).cast("int")
    return (parted.withColumns({f"{tag}{own}": mine})
            .withColumn(f"{tag}{other}", F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1)))
            .drop(own, other, *[f"_h{i}" for i in range(len(keys))]))


def point_in_interval_join(points: DataFrame, intervals: DataFrame,
                           on: Sequence[tuple[str, str]], point: str, start: Column, end: Column,
                           bucket_days: int,
                           point_range: tuple[dt.date, dt.date] | None = None,
                           salt: int = 1, split_rows: int | None = None) -> DataFrame:
    """Inner join: ``points.a == intervals.b`` for each (a, b) in ``on`` and
    ``start <= point <= end``.  Column names of the two sides must be disjoint.

    ``point_range`` (optional) is a guaranteed bound on the point dates; the
    interval side is then exploded only over buckets inside it.

    ``salt > 1`` splits every (keys, bucket) group ``salt`` ways: each point
    row goes to one sub-group chosen by a hash of its own values (stable when
    a task is recomputed) and each interval row is copied to all of them, so
    a hot group (say a placeholder birth date holding a third of the rows)
    is spread over ``salt`` tasks at the price of ``salt`` copies of the
    interval side.  Results are identical for every ``salt``.

    ``split_rows`` measures instead: the (keys, bucket) groups are counted on
    both sides, and a group with more rows than that is cut into parts of about
    so many points and so many intervals, each pair of parts a join key of its
    own.  Other groups are not touched or copied.
    """
    pts = points.withColumn(_PB, time_bucket(F.col(point), bucket_days))
    lo, hi = time_bucket(start, bucket_days), time_bucket(end, bucket_days)
    if point_range is not None:
        lo = F.greatest(lo, time_bucket(F.lit(point_range[0]), bucket_days))
        hi = F.least(hi, time_bucket(F.lit(point_range[1]), bucket_days))
    ivs = intervals.withColumns({"_lo": lo, "_hi": hi})
    exploded = (ivs.filter(F.col("_hi") >= F.col("_lo"))
                .withColumn(_IB, F.explode(F.sequence(F.col("_lo"), F.col("_hi")))))
    cond = F.col(point).between(start, end) & (F.col(_PB) == F.col(_IB))
    for a, b in on:
        cond = cond & (F.col(a) == F.col(b))
    if salt > 1:
        pts = pts.withColumn(_PS, F.pmod(F.xxhash64(*[F.col(c) for c in points.columns]), F.lit(salt)))
        exploded = exploded.withColumn(_IS, F.explode(F.sequence(F.lit(0).cast("long"),
                                                                 F.lit(salt - 1).cast("long"))))
        cond = cond & (F.col(_PS) == F.col(_IS))
    if split_rows is not None and _any_large(points, intervals, on, split_rows):
        hot = _large_groups(pts, exploded, on, split_rows)
        if hot is not None:
            pts = _in_parts(pts, hot, [a for a, _ in on] + [_PB], "_rows", "_cols", "_p")
            exploded = _in_parts(exploded, hot, [b for _, b in on] + [_IB], "_cols", "_rows", "_i")
            cond = cond & (F.col("_p_rows") == F.col("_i_rows")) & (F.col("_p_cols") == F.col("_i_cols"))
            return (pts.join(exploded.hint("merge"), cond, "inner")
                    .drop(_PB, _IB, _PS, _IS, "_lo", "_hi", "_p_rows", "_p_cols", "_i_rows", "_i_cols"))
    # the size estimate of the exploded side does not know the explosion: never broadcast it on an estimate
    return pts.join(exploded.hint("merge"), cond, "inner").drop(_PB, _IB, _PS, _IS, "_lo", "_hi")

"""Physical-strategy helpers: size-checked broadcast, deterministic dedupe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fits(df: DataFrame, max_rows: int) -> bool:
    """Measured size bound: does ``df`` have at most ``max_rows`` rows?

    One small distributed job (``limit`` stops early on big inputs); the
    caller runs it on the smallest frame that bounds the broadcast side.
    """
    if max_rows <= 0:
        return False
    return df.limit(max_rows + 1).count() <= max_rows


def small_side(df: DataFrame, proven_small: bool) -> DataFrame:
    """Broadcast hint only when a size bound was proven; otherwise leave the
    join to the planner (shuffle join, or AQE's run-time conversion from
    measured shuffle sizes)."""
    return F.broadcast(df) if proven_small else df


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the smallest by ``order`` (nulls last), then by
    every remaining column in frame order.

    Implemented as ``min(struct(...))`` per key, an aggregate with map-side
    partial aggregation: a key holding a large share of all rows is reduced
    inside each input partition before the shuffle, never gathered whole
    into one task (unlike ``row_number()`` over a window).
    """
    keys = list(keys)
    order = [c for c in order if c in df.columns and c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    cols = order + rest
    fields = []
    for i, c in enumerate(cols):
        fields.append(_c(c).isNull().alias(f"n{i}"))
        fields.append(_c(c).alias(f"v{i}"))
    agg = df.groupBy(*[_c(k) for k in keys]).agg(F.min(F.struct(*fields)).alias("_first"))
    picked = [F.col(f"_first.v{i}").alias(c) for i, c in enumerate(cols)]
    return agg.select(*[_c(k) for k in keys], *picked).select(*[_c(c) for c in df.columns])

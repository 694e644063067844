"""Operator 8: mixing sources to target weights by systematic sampling.

The targets share the corpus size by source weights; no source may be asked
for more than ``MAX_COPIES`` times its size, and the excess goes to the others
by weight.  A document's expected copies are its source's target over its
source's size.  Within a source the documents stand in order of size; the
prefix sums of their expected copies are shifted by one random offset, and a
document is emitted once for each integer boundary its own interval crosses.
Neighbours in that order have like sizes, so what a source yields stays close
to its target.

The prefix sum needs each document's rank within its source, which may hold a
third of all rows.  Documents are counted per (source, size band, hash part);
the counts, a small table, give each group its first rank, and only the
rank inside a group needs the group's rows together.  Groups of a hot source
are spread over bands and parts.

Defined results: a null text has size 0; a source without words has target 0
and yields nothing; a null source is a source, last in order; null ids are
ordinary; equal rows are interchangeable; extra columns pass through; an empty
table gives no rows.  The offset comes from a hash of seed and source, so
reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from rxlens.llm.common import land, text_or_empty

MAX_COPIES = 3
WEIGHTS = (1, 2, 3)
BANDS_PER_DOUBLING = 8
PARTS = 64
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def _source_key(source: Column) -> Column:
    """A non-null key whose order is that of the sources, null last."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("a"), source.cast("string")))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_copies: float = MAX_COPIES) -> DataFrame:
    """(key, source_size, target) per source, from (key, source_size): one row per source, no more.

    ``target = least(level * weight, max_copies * size)`` with the level at
    which the targets add up to all sizes: sources in the order in which a
    rising level caps them, the first prefix whose level caps no further one.
    """
    one = W.orderBy("key")
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                          (F.pmod(F.row_number().over(one) - 1, F.lit(len(weights))) + 1).cast("int"))
    t = sizes.withColumn("weight", weight)
    cap = max_copies * F.col("source_size")
    t = t.withColumn("cap", cap).withColumn("bends", F.col("cap") / F.col("weight"))
    before = W.orderBy("bends", "key").rowsBetween(W.unboundedPreceding, -1)
    rest = W.orderBy("bends", "key").rowsBetween(W.currentRow, W.unboundedFollowing)
    whole = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    t = (t.withColumn("total", F.sum("source_size").over(whole))
         .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
         .withColumn("open", F.sum("weight").over(rest))
         .withColumn("level_here", (F.col("total") - F.col("capped")) / F.col("open")))
    # the level if this source and all after it are open: it holds from the first one that does not reach its cap
    level = F.min(F.when(F.col("level_here") <= F.col("bends"), F.struct("bends", "key", "level_here"))).over(whole)
    t = t.withColumn("level", level["level_here"])
    target = F.coalesce(F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")),
                        F.col("cap").cast("double"))
    return t.select("key", "source_size", target.alias("target"))


def mix(docs: DataFrame, size: Column, source: str = "source", order: list[str] | None = None, seed: int = 8,
        weights: tuple[float, ...] = WEIGHTS, max_copies: float = MAX_COPIES, into: str = "mix") -> DataFrame:
    """``docs`` with a struct column ``into``: size, source_size, target, copies.

    ``order`` names columns that tell documents of one size apart.
    """
    order = order or ["doc_id"]
    size = size.cast("long")
    base = docs.withColumns({
        "_op8_key": _source_key(F.col(source)), "_op8_size": size,
        "_op8_hash": F.xxhash64(F.lit(seed), *order)})
    base = base.withColumns({
        "_op8_band": F.floor(BANDS_PER_DOUBLING * F.log2(F.col("_op8_size") + 1)).cast("int"),
        "_op8_part": F.pmod("_op8_hash", F.lit(PARTS)).cast("int")})
    groups = (base.groupBy("_op8_key", "_op8_band", "_op8_part")
              .agg(F.count(F.lit(1)).alias("rows"), F.sum("_op8_size").alias("words")))
    groups = land(groups, "mix-groups")
    per_source = targets(groups.groupBy(F.col("_op8_key").alias("key")).agg(F.sum("words").alias("source_size")),
                         weights, max_copies)
    before = (W.partitionBy("_op8_key").orderBy("_op8_band", "_op8_part").rowsBetween(W.unboundedPreceding, -1))
    starts = (groups.withColumn("first", F.coalesce(F.sum("rows").over(before), F.lit(0)))
              .join(per_source.withColumnRenamed("key", "_op8_key"), "_op8_key")
              .select("_op8_key", "_op8_band", "_op8_part", "first", "source_size", "target"))
    starts = land(starts, "mix-starts")
    group = ["_op8_key", "_op8_band", "_op8_part"]
    inside = W.partitionBy(*group).orderBy("_op8_size", "_op8_hash", *[F.col(f"`{c}`") for c in order])
    ranked = (base.join(starts.withColumnsRenamed({"first": "_op8_first", "source_size": "_op8_total",
                                                   "target": "_op8_target"}), group)
              .withColumn("_op8_rank", F.col("_op8_first") + F.row_number().over(inside) - 1))
    rate = F.when(F.col("_op8_total") > 0, F.least(F.col("_op8_target") / F.col("_op8_total"),
                                                   F.lit(float(max_copies)))).otherwise(F.lit(0.0))
    offset = F.pmod(F.xxhash64(F.lit(seed), F.col("_op8_key")), F.lit(1 << 52)) / float(1 << 52)
    crossed = (F.floor(offset + rate * (F.col("_op8_rank") + 1)) - F.floor(offset + rate * F.col("_op8_rank")))
    # rounding may let one interval of length 3 touch a fourth boundary
    copies = F.least(crossed, F.ceil(rate)).cast("int")
    out = ranked.withColumn(into, F.struct(
        F.col("_op8_size").alias("size"), F.col("_op8_total").alias("source_size"),
        F.col("_op8_target").alias("target"), copies.alias("copies")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns if c != into], into)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken (same columns)."""
    order = [c for c in ("doc_id", "text") if c in docs.columns]
    out = mix(docs, word_count(text_or_empty("text")), order=order, into="_op8_mix", **options)
    return (out.where("_op8_mix.copies > 0")
            .withColumn("_op8_copy", F.explode(F.sequence(F.lit(1), F.col("_op8_mix.copies"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))

"""Shared helpers: word splitting in Arrow and in SQL, bounded label samples."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rxlens.session import ensure_checkpoint_dir, land

__all__ = ["arrow_conf", "crc_mod", "encoded_words", "labelled_sample", "land", "lookup", "once", "read", "sql_words",
           "text_or_empty"]

# Arrow batches are sized in rows; texts average a few KB and may be very
# long, so batches stay small enough for a few hundred MB of worker memory.
TEXT_ROWS_PER_BATCH = "1000"

# Keys with more rows than this are split in ``lookup``; so many of them are broadcast.
HOT_ROWS = 10_000
HOT_KEYS = 100_000


def arrow_conf(spark: SparkSession) -> None:
    """Small Arrow batches for whole texts, and a checkpoint folder."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", TEXT_ROWS_PER_BATCH)
    ensure_checkpoint_dir(spark)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], salt_by: str) -> DataFrame:
    """Inner join of landed ``rows`` with ``table`` on ``keys``, where a key may hold a large share of the rows.

    Keys with more than ``HOT_ROWS`` rows are counted first; their rows are
    dealt to parts by a hash of ``salt_by`` and the table's rows copied to each.
    """
    if rows.limit(HOT_ROWS + 1).count() <= HOT_ROWS:
        return rows.join(table, keys)
    hot = land(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > HOT_ROWS)
               .select(*keys, F.ceil(F.col("_rows") / HOT_ROWS).cast("int").alias("_parts")), "hot-keys")
    if hot.isEmpty():
        return rows.join(table, keys)
    small = F.broadcast(hot) if hot.limit(HOT_KEYS + 1).count() <= HOT_KEYS else hot
    dealt = (rows.join(small, keys, "left")
             .withColumn("_part", F.pmod(F.xxhash64(salt_by), F.coalesce("_parts", F.lit(1))).cast("int"))
             .drop("_parts"))
    copied = (table.join(small, keys, "left")
              .withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
              .drop("_parts"))
    return dealt.join(copied, [*keys, "_part"]).drop("_part")


def text_or_empty(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with column ``name``, computed once per row.

    A one-element ``explode`` keeps the optimizer from copying a costly
    expression into every place that uses it (filters, struct fields).
    """
    keep = [F.col(f"`{c}`") for c in df.columns if c != name]
    return df.select(*keep, F.explode(F.array(value)).alias(name))


def sql_words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a non-null text."""
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def crc_mod(id_col: Column, m: int) -> Column:
    """crc32 of the id as text, modulo ``m`` (null id: null)."""
    return F.crc32(id_col.cast("string").cast("binary")) % m


def encoded_words(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Words of a batch of texts as (codes, distinct words, words per text).

    Splitting, lower-casing (A-Z only) and dictionary encoding run in Arrow;
    a null text has no words.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.offset:  # ascii_lower misreads slices
        texts = texts.take(pa.array(np.arange(len(texts))))
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    filled = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    counts = np.bincount(owner[filled], minlength=len(lengths)).astype(np.int64)
    enc = flat.filter(pa.array(filled)).cast(pa.large_binary()).dictionary_encode()
    codes = enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return codes, enc.dictionary.to_pylist(), counts


def labelled_sample(labels: DataFrame, label: str, held_mod: int, held_value: int, limit: int,
                    id_col: str = "doc_id") -> DataFrame:
    """A bounded training sample of labelled ids: at most ``limit`` of each class.

    Only rows whose crc32(id as text) mod ``held_mod`` differs from
    ``held_value`` take part; the sample is the rows with the smallest id
    hashes (the same at every run).  Null ids, null labels and ids whose label
    rows disagree are left out.  At most ``2 * limit`` rows, so callers may
    broadcast it.
    """
    ids = (labels.where(F.col(id_col).isNotNull() & F.col(label).isin(0, 1)
                        & (crc_mod(F.col(id_col), held_mod) != held_value))
           .groupBy(F.col(id_col).alias("_id"))
           .agg(F.min(label).alias("_y"), F.max(label).alias("_y2"))
           .where("_y = _y2").select("_id", "_y", F.xxhash64("_id").alias("_h")))
    parts = [ids.where(F.col("_y") == y).orderBy("_h", "_id").limit(limit) for y in (0, 1)]
    return land(parts[0].unionByName(parts[1]).select("_id", "_y"), "label-sample")

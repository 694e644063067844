"""Operator 11: fill-in-the-middle transformation over SWAR words.

A text is a sequence of units ``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+``:
a word with the white space before it, or the white space at the end.  The
UTF-8 bytes of an Arrow batch are viewed as uint64 words.  White-space bytes
are found by carry-free byte arithmetic; a byte ends a unit where it is not
white and the next byte is, or where its text ends.  Marks are counted per
word with ``bitwise_count`` and summed, which gives the rank of any byte.  The
end of unit k of a text is a select: a binary search in the running counts
finds the word, then the prefix counts of its eight bytes (one multiplication)
give the byte.  No text is split and no Python code runs per byte or per word.

Each text is cut twice by hashes of its id and rewritten as ``<P>``prefix
``<S>``suffix``<M>``middle (psm) or ``<S>``suffix``<P>``prefix``<M>``middle
(spm); some stay plain.  The three parts are slices over the batch's own
buffer, so the result is put together without copying parts one by one.

Defined results: a null or empty text is the empty plain text with no units;
a text that holds a sentinel is plain; a null id is hashed like the text
``null``; repeated rows give the same result each; an empty table gives no
rows.  All columns are kept; a column with the name of the result is replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from rxlens.llm.common import arrow_conf

SEED = 42
FIM_PERCENT, SPM_PERCENT = 50, 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
BLOCK_WORDS = 1 << 18  # words marked at a time

_ONES = np.uint64(0x0101010101010101)
_HIGH = np.uint64(0x8080808080808080)
_LOW = np.uint64(0x7F7F7F7F7F7F7F7F)


def _each(byte: int) -> np.uint64:
    return np.uint64(byte * 0x0101010101010101)


def white_bytes(words: np.ndarray) -> np.ndarray:
    """High bit of every byte that is 0x20 or 0x09 to 0x0D (no carry leaves a byte)."""
    low = words & _LOW
    between = (low + _each(0x80 - 0x09)) & ~(low + _each(0x80 - 0x0E))
    space = ~((low ^ _each(0x20)) + _each(0x7F))
    return (between | space) & ~words & _HIGH


def mark_unit_ends(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """High bit of every byte that ends a unit; ``ends`` are the end offsets of the non-empty texts."""
    marks = np.empty_like(words)
    for lo in range(0, len(words), BLOCK_WORDS):
        part = words[lo:lo + BLOCK_WORDS + 1]  # one word more: the next byte of the last one
        white = white_bytes(part)
        after = white >> np.uint64(8)
        after[:-1] |= white[1:] << np.uint64(56)
        n = min(BLOCK_WORDS, len(words) - lo)
        marks[lo:lo + n] = (~white & _HIGH & after)[:n]
    last = ends - 1
    np.bitwise_or.at(marks, last >> 3, np.uint64(0x80) << ((last & 7) << 3).astype(np.uint64))
    return marks


class UnitIndex:
    """Rank and select over the unit ends of a byte buffer."""

    def __init__(self, words: np.ndarray, ends: np.ndarray):
        self.marks = mark_unit_ends(words, ends)
        self.upto = np.cumsum(np.bitwise_count(self.marks), dtype=np.int64)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Unit ends among the bytes before each offset."""
        word = at >> 3
        before = np.where(word > 0, self.upto[word - 1], 0)
        inside = self.marks[word] & ((np.uint64(1) << ((at & 7) << 3).astype(np.uint64)) - np.uint64(1))
        return before + np.bitwise_count(inside)

    def select(self, nth: np.ndarray) -> np.ndarray:
        """Offset after the byte that holds the ``nth`` mark (from 1)."""
        word = np.searchsorted(self.upto, nth, side="left")
        left = (nth - np.where(word > 0, self.upto[word - 1], 0)).astype(np.uint64)
        running = (self.marks[word] >> np.uint64(7)) * _ONES  # byte i: marks in bytes 0..i
        reached = ((running | _HIGH) - left * _ONES) & _HIGH
        return (word << 3) + 9 - np.bitwise_count(reached)


def draws(ids: list, seed: int = SEED) -> np.ndarray:
    """Four 32-bit draws for each id: the first hex groups of sha256 of ``seed:id``."""
    digests = b"".join(hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(digests, ">u4").reshape(-1, 4).astype(np.int64)


def transform(ids: list, texts: pa.Array, seed: int = SEED, fim_percent: int = FIM_PERCENT,
              spm_percent: int = SPM_PERCENT) -> pa.StructArray:
    """text, form, n, prefix_chars and middle_chars of each row of a batch."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n_rows = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64, n_rows + 1, texts.offset * 8)
    first, size = int(offsets[0]), int(offsets[-1] - offsets[0])
    data = np.zeros((size >> 3) + 1, np.uint64)  # always a word beyond the last byte's
    if size:
        data.view(np.uint8)[:size] = np.frombuffer(texts.buffers()[2], np.uint8, size, first)
    start, end = offsets[:-1] - first, offsets[1:] - first
    index = UnitIndex(data, end[end > start])
    base = index.rank(start)
    n = index.rank(end) - base

    h = draws(ids, seed)
    cuts = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
    at = [np.where(k > 0, index.select(np.maximum(base + k, 1)) if size else 0, start) for k in cuts.T]
    # prefix, middle and suffix of every row are consecutive slices of the same bytes
    bounds = np.concatenate([np.stack([start, *at], axis=1).reshape(-1), [size]])
    parts = pa.LargeStringArray.from_buffers(3 * n_rows, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data))
    third = np.arange(n_rows) * 3
    prefix, middle, suffix = (parts.take(pa.array(third + i)) for i in range(3))

    marked = np.zeros(n_rows, bool)
    for s in (PREFIX, SUFFIX, MIDDLE):
        marked |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
    plain = (end == start) | marked | (h[:, 2] % 100 >= fim_percent)
    spm = ~plain & (h[:, 3] % 100 < spm_percent)
    form = pa.array(np.where(plain, "plain", np.where(spm, "spm", "psm")), pa.string())
    joined = [pc.binary_join_element_wise(*(pa.scalar(x, pa.large_string()) if isinstance(x, str) else x for x in row),
                                          pa.scalar("", pa.large_string()))
              for row in ((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle),
                          (PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))]
    text = pc.if_else(pa.array(plain), texts, pc.if_else(pa.array(spm), *joined))
    chars = [pa.array(pc.utf8_length(p).to_numpy(zero_copy_only=False).astype(np.int64), mask=plain)
             for p in (prefix, middle)]
    return pa.StructArray.from_arrays([text.cast(pa.string()), form, pa.array(n, pa.int64()), *chars],
                                      names=["text", "form", "n", "prefix_chars", "middle_chars"])


RESULT = StructType([StructField("text", StringType()), StructField("form", StringType()), StructField("n", LongType()),
                     StructField("prefix_chars", LongType()), StructField("middle_chars", LongType())])


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out: str = "fim", seed: int = SEED,
                   fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """``docs`` with the struct ``out`` (text, form, n units, prefix_chars, middle_chars)."""
    keep = [c for c in docs.columns if c != out]
    slim = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{id_col}`").cast("string"),
                       F.col(f"`{text_col}`").cast("string"))
    names = [f"c{i}" for i in range(len(keep))]
    schema = StructType([*(StructField(n, f.dataType) for n, f in zip(names, slim.schema)), StructField("made", RESULT)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            *kept, ids, texts = b.columns
            made = transform(ids.to_pylist(), texts, seed, fim_percent, spm_percent)
            yield pa.RecordBatch.from_arrays([*kept, made], names=[*names, "made"])

    arrow_conf(docs.sparkSession)
    made = slim.toDF(*names, "_id", "_text").mapInArrow(run, schema)
    return made.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], F.col("made").alias(out))


def restore(text: Column, form: Column) -> Column:
    """The original text of a transformed one.

    Exact: a text that holds a sentinel is never cut, and a sentinel cannot
    arise across the border of a part and a sentinel.
    """
    parts = F.split(text, "|".join((PREFIX, SUFFIX, MIDDLE)), -1)
    return (F.when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
            .when(form == "psm", F.concat(parts[1], parts[3], parts[2])).otherwise(text))

"""Operator 10: quality by random-indexing word vectors and a two-layer network.

Random indexing: every word bucket and every word-shape bucket (letters and
digits reduced to classes, runs collapsed) has a fixed sparse ternary index
vector; the vector of a bucket is the sum of the index vectors of its
neighbours, two to each side, over the whole corpus.  Tasks add up integer matrices of
fixed size (``2 * BUCKETS`` rows of ``DIMS``), and Spark sums them by bucket: sums
of integers do not depend on order, and the table's size does not depend on
the corpus, so it is broadcast for pooling.

A document is the frequency-weighted mean of its word vectors and of its shape
vectors, with three plain figures (length, share of distinct words, mean word
length).  A two-layer numpy network is fitted on at most ``2 *
TRAIN_PER_CLASS`` labelled rows; a fifth of them, left out of the fit, sets
the temperature of its probabilities.

Defined results: a null or empty text has the zero vector and is scored like
any other; with one class of labels every score is 0 or 1, without labels
0.5; null ids are scored, held_out null; repeated rows score alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlens.llm.common import arrow_conf, crc_mod, encoded_words, labelled_sample, land

BUCKETS, DIMS, NONZERO, WINDOW = 8192, 32, 4, 2
CACHE_FORMS = 300_000
COUNT_WORDS = 1 << 18  # words whose neighbours are counted at once
RARE = 1e-3  # a word of frequency p weighs RARE / (RARE + p)
TRAIN_PER_CLASS = 8000
HIDDEN, EPOCHS, RATE, DECAY = 32, 60, 3e-3, 1e-4
HELD_MOD, HELD_VALUE = 4, 2
THRESHOLD = 0.7
SHAPES = ((re.compile(rb"[a-z\x80-\xff]+"), b"a"), (re.compile(rb"[A-Z]{2,}"), b"AA"), (re.compile(rb"[0-9]+"), b"0"),
          (re.compile(rb"([^aA0])\1+"), rb"\1\1"))


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(10)
    at = np.argsort(rng.random((2 * BUCKETS, DIMS)), axis=1)[:, :NONZERO]
    sign = rng.integers(0, 2, (2 * BUCKETS, NONZERO)) * 2 - 1
    return at, sign


def _shape(word: bytes) -> bytes:
    for find, put in SHAPES:
        word = find.sub(put, word)
    return word[:24]


# letters and digits reduced to classes: words of one reduced form share a shape
CLASSES = bytes(97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256))
_SEEN: dict[bytes, int] = {}  # a worker's shape buckets of reduced forms met before


def _shape_bucket(form: bytes) -> int:
    bucket = xxhash.xxh32_intdigest(_shape(form), 1) % BUCKETS + BUCKETS
    if len(form) <= 64:
        _SEEN[form] = bucket
    return bucket


def buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word bucket, shape bucket, bytes) of each word, words per text, distinct words per text."""
    codes, words, counts = encoded_words(texts, lower=False)
    if not len(codes):
        none = np.zeros(0, np.int64)
        return none, none, none, counts, np.zeros(len(counts), np.int64)
    digest = xxhash.xxh32_intdigest
    word = np.fromiter(map(digest, words), np.int64, len(words)) % BUCKETS
    if len(_SEEN) > CACHE_FORMS:
        _SEEN.clear()
    get = _SEEN.get
    forms = [w.translate(CLASSES) for w in words]
    shape = np.fromiter((s if (s := get(x)) is not None else _shape_bucket(x) for x in forms), np.int64, len(words))
    size = np.fromiter(map(len, words), np.int64, len(words))
    owner = np.repeat(np.arange(len(counts)), counts)
    distinct = np.bincount(np.unique(owner * len(words) + codes) // len(words), minlength=len(counts))
    return word[codes], shape[codes], size[codes], counts, distinct


def word_vectors(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(bucket int, n long, v0.. long): neighbour sums over all documents."""
    names = [f"v{i}" for i in range(DIMS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sign = _index_vectors()
        entry = 2 * at + (sign < 0)  # a cell's additions and subtractions are counted side by side
        size = 2 * BUCKETS * DIMS
        seen, cells = np.zeros(2 * BUCKETS, np.int64), np.zeros(2 * size, np.int64)
        for b in batches:
            for lo in range(0, b.num_rows, 250):
                word, shape, _, counts, _ = buckets(b.column(0).slice(lo, 250))
                owner = np.repeat(np.arange(len(counts)), counts)
                for x in (word, shape):  # a word meets words, a shape meets shapes, in both directions
                    seen += np.bincount(x, minlength=2 * BUCKETS)
                    for first in range(0, len(x), COUNT_WORDS):
                        held = []
                        for gap in range(1, WINDOW + 1):
                            left = np.arange(first, min(first + COUNT_WORDS, len(x) - gap))
                            left = left[owner[left] == owner[left + gap]]
                            a, z = x[left], x[left + gap]
                            held += [(row[:, None] * (2 * DIMS) + entry[near]).ravel() for row, near in ((a, z), (z, a))]
                        cells += np.bincount(np.concatenate(held), minlength=2 * size)
        cells = cells[::2] - cells[1::2]
        table = cells.reshape(-1, DIMS)
        keep = np.flatnonzero(seen)
        if len(keep):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keep.astype(np.int32)), pa.array(seen[keep]), *[pa.array(table[keep, i]) for i in range(DIMS)]],
                names=["bucket", "n", *names])

    schema = "bucket int, n long, " + ", ".join(f"{x} long" for x in names)
    parts = docs.select(F.col(text_col).cast("string")).mapInArrow(run, schema)
    return land(parts.groupBy("bucket").agg(*[F.sum(x).alias(x) for x in ["n", *names]]), "word-vectors")


def vector_table(vectors: DataFrame) -> np.ndarray:
    """Weighted unit vectors by bucket, centred within words and within shapes (2 * BUCKETS rows at most)."""
    table, n = np.zeros((2 * BUCKETS, DIMS)), np.zeros(2 * BUCKETS)
    for r in vectors.collect():
        n[r["bucket"]] = r["n"]
        table[r["bucket"]] = r[2:]
    for part in (slice(0, BUCKETS), slice(BUCKETS, 2 * BUCKETS)):
        count = n[part, None]
        unit = table[part] / np.maximum(np.linalg.norm(table[part], axis=1, keepdims=True), 1)
        total = max(count.sum(), 1)
        unit = np.where(count > 0, unit - (unit * count).sum(0) / total, 0)
        table[part] = unit * RARE / (RARE + count / total) if part.start == 0 else unit
    return table.astype(np.float32)


def pool(texts: pa.Array, table: np.ndarray) -> np.ndarray:
    """Pooled features of each text (float32)."""
    word, shape, size, counts, distinct = buckets(texts)
    n = np.maximum(counts, 1)[:, None]
    ends = np.concatenate(([0], np.cumsum(counts)))
    out = np.zeros((len(counts), 2 * DIMS + 3), np.float32)
    for k, x in enumerate((word, shape)):
        for d in range(0, len(counts)):
            a, b = ends[d], ends[d + 1]
            if b > a:
                hit, times = np.unique(x[a:b], return_counts=True) if k else (x[a:b], None)
                rows = table[hit]
                out[d, k * DIMS:(k + 1) * DIMS] = (rows.sum(0) if times is None else times @ rows) / n[d]
    out[:, -3] = np.log1p(counts) / 5
    out[:, -2] = distinct / n[:, 0]
    length = np.bincount(np.repeat(np.arange(len(counts)), counts), weights=size, minlength=len(counts))
    out[:, -1] = length / n[:, 0] / 10
    return out


def fit_network(x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Two layers (tanh, logistic), Adam in batches, temperature on every fifth row."""
    rng = np.random.default_rng(0)
    held = np.arange(len(y)) % 5 == 4
    mean, std = x[~held].mean(0), x[~held].std(0) + 1e-6
    u = (x - mean) / std
    p = {"a": rng.normal(0, 1 / np.sqrt(u.shape[1]), (u.shape[1], HIDDEN)), "b": np.zeros(HIDDEN),
         "c": rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), "d": np.zeros(1)}
    m = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in p.items()}
    fit, step = np.flatnonzero(~held), 0
    for _ in range(EPOCHS):
        rng.shuffle(fit)
        for lo in range(0, len(fit), 128):
            i = fit[lo:lo + 128]
            h = np.tanh(u[i] @ p["a"] + p["b"])
            e = (1 / (1 + np.exp(-np.clip(h @ p["c"] + p["d"], -35, 35))) - y[i]) / len(i)
            back = np.outer(e, p["c"]) * (1 - h * h)
            grad = {"a": u[i].T @ back, "b": back.sum(0), "c": h.T @ e, "d": e.sum(keepdims=True)}
            step += 1
            for k in p:
                g = grad[k] + DECAY * p[k]
                m[k][0] = 0.9 * m[k][0] + 0.1 * g
                m[k][1] = 0.999 * m[k][1] + 0.001 * g * g
                p[k] = p[k] - RATE * (m[k][0] / (1 - 0.9 ** step)) / (np.sqrt(m[k][1] / (1 - 0.999 ** step)) + 1e-8)
    logit = np.tanh(u[held] @ p["a"] + p["b"]) @ p["c"] + p["d"]
    grid = np.exp(np.linspace(np.log(0.3), np.log(10), 60))
    loss = [np.logaddexp(0, np.where(y[held] > 0.5, -logit, logit) / t).mean() if held.any() else t for t in grid]
    return p | {"mean": mean, "std": std, "t": np.array([grid[int(np.argmin(loss))]])}


def apply_network(x: np.ndarray, net: dict[str, np.ndarray]) -> np.ndarray:
    if "constant" in net:
        return np.full(len(x), net["constant"][0])
    u = (x - net["mean"]) / net["std"]
    logit = (np.tanh(u @ net["a"] + net["b"]) @ net["c"] + net["d"]) / net["t"]
    return 1 / (1 + np.exp(-np.clip(logit, -35, 35)))


def train(docs: DataFrame, labels: DataFrame, table: np.ndarray, label: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", per_class: int = TRAIN_PER_CLASS) -> dict[str, np.ndarray]:
    """The network, fitted on the pooled features of the bounded sample."""
    sample = labelled_sample(labels, label, HELD_MOD, HELD_VALUE, per_class, id_col)
    # private names first (other columns may have any name); of a repeated id the least text
    own = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_t"))
    rows = (own.join(F.broadcast(sample), "_id").groupBy("_id", "_y").agg(F.min("_t").alias("_t"))
            .select(F.col("_id").cast("string"), F.col("_y").cast("int"), "_t"))
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pool(b.column(2), shared.value)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([r.tobytes() for r in x], pa.binary())], names=["id", "y", "x"])

    got = rows.mapInArrow(run, "id string, y int, x binary").orderBy("id").collect()  # 2 * per_class rows at most
    y = np.array([r["y"] for r in got], float)
    if len(set(y.tolist())) < 2:
        return {"constant": np.array([y[0] if len(y) else 0.5])}
    x = np.stack([np.frombuffer(bytes(r["x"]), np.float32) for r in got]).astype(float)
    order = np.random.default_rng(1).permutation(len(y))
    return fit_network(x[order], y[order])


def score(docs: DataFrame, table: np.ndarray, net: dict[str, np.ndarray], id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(id_col, score): every document over its whole text."""
    shared = docs.sparkSession.sparkContext.broadcast((table, net))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, model = shared.value
        for b in batches:
            p = apply_network(pool(b.column(1), vectors).astype(float), model)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p)], names=[id_col, "score"])

    narrow = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    return narrow.mapInArrow(run, f"`{id_col}` {kind}, score double")


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """(id_col, held_out, score, predicted) of every document."""
    arrow_conf(docs.sparkSession)
    table = vector_table(word_vectors(docs, text_col))
    scored = score(docs, table, train(docs, labels, table, label, id_col, text_col), id_col, text_col)
    return scored.select(id_col, (crc_mod(F.col(id_col), HELD_MOD) == HELD_VALUE).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

"""Operator 6: toxicity by FTRL-proximal logistic regression.

Features are hashed word n-grams and skip-grams (words, neighbours, words with
one word between them; A-Z lower-cased, punctuation around a word dropped),
each counted once per text.  FTRL-proximal gives every coordinate its own
learning rate and, by L1, leaves most weights at exactly zero, so the model is
a short list of (index, weight) pairs: at most ``1 << BITS`` of them, small
enough to broadcast to the scoring tasks whatever the corpus.

The model is fitted in one task on a bounded sample of labelled rows, at most
``2 * TRAIN_PER_CLASS`` of them (rows of the smallest id hashes, so the same at every run); every
document is scored over its whole text in a narrow map.

Defined results: a null or empty text gets the score of the bias alone; with
no labels of a class every score is that class's absence (0 or 1 by the only
class, 0.5 without labels); null ids are scored, held_out null; repeated rows score alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlens.llm.common import arrow_conf, crc_mod, encoded_words, labelled_sample, land

BITS = 20
TRAIN_PER_CLASS = 4000
EPOCHS = 8
# L1 grows with the evidence there is: per row of the rarer class, up to L1_MOST
ALPHA, BETA, L2, L1_PER_ROW, L1_MOST = 3.0, 1.0, 1.0, 0.06, 25.0
HELD_MOD, HELD_VALUE = 3, 1
THRESHOLD = 0.7
EDGE = b" \t.,;:!?\"'()[]{}<>#*$%&|/\\-_=+~`^@"


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w.strip(EDGE) or w) for w in words), np.uint64, len(words))


def features(texts: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, int]:
    """(text number, feature) of every n-gram and skip-gram of a batch, repeats included."""
    codes, words, counts = encoded_words(texts)
    h = word_hashes(words)[codes] if len(words) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(counts)), counts)
    rows, feats = [owner], [h]
    mul = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
    for gap in (1, 2):  # neighbours, and words with one between
        same = owner[gap:] == owner[:-gap]
        rows.append(owner[gap:][same])
        feats.append((h[:-gap][same] * mul[0] + h[gap:][same] * mul[1] + np.uint64(gap)) * mul[0])
    feat = (np.concatenate(feats) >> np.uint64(64 - bits)).astype(np.int64)
    return np.concatenate(rows), feat, len(counts)


def fit_ftrl(rows: list[np.ndarray], y: np.ndarray, bits: int = BITS, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """(weights, bias) from the distinct features of each row."""
    size = 1 << bits
    l1 = min(L1_MOST, L1_PER_ROW * min(float(y.sum()), float(len(y) - y.sum())))
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    rng = np.random.default_rng(0)

    def weights(i):
        zi = z[i]
        w = -(zi - np.sign(zi) * l1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(zi) > l1, w, 0.0)

    rows = [np.append(r, size) for r in rows]
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            i = rows[k]
            w = weights(i)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y[k]
            root = np.sqrt(n[i])
            z[i] += g - (np.sqrt(n[i] + g * g) - root) / ALPHA * w
            n[i] += g * g
    w = weights(np.arange(size + 1))
    return w[:size], float(w[size])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
          per_class: int = TRAIN_PER_CLASS) -> DataFrame:
    """The model: (index long, weight double) of the weights that are not zero; index -1 is the bias."""
    sample = labelled_sample(labels, label, HELD_MOD, HELD_VALUE, per_class, id_col)
    # private names first (other columns may have any name); of a repeated id the least text
    own = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_t"))
    rows = own.join(F.broadcast(sample), "_id").groupBy("_id", "_y").agg(F.min("_t").alias("_t"))

    def featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, feat, n = features(b.column(2))
            cell = np.unique(row << BITS | feat)
            per = np.bincount(cell >> BITS, minlength=n)
            ids = pa.array((cell & ((1 << BITS) - 1)).astype(np.int32))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(per))).astype(np.int32)), ids)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.string()), b.column(1).cast(pa.int32()), lists],
                                             names=["id", "y", "f"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, ys, rows_ = [], [], []
        for b in batches:
            ids += b.column(0).to_pylist()
            ys += b.column(1).to_pylist()
            flat, cut = b.column(2).values.to_numpy(), b.column(2).offsets.to_numpy()
            rows_ += [flat[a:c] for a, c in zip(cut[:-1], cut[1:])]
        order = sorted(range(len(ids)), key=ids.__getitem__)
        y = np.array([ys[k] for k in order], float)
        if len(set(ys)) < 2:  # nothing to tell apart
            weights, bias = np.zeros(1), 0.0 if not ys else 35.0 * (1 if ys[0] else -1)
        else:
            weights, bias = fit_ftrl([rows_[k] for k in order], y)
        at = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(weights[at], bias))],
                                         names=["index", "weight"])

    vectors = land(rows.mapInArrow(featurize, "id string, y int, f array<int>"), "toxic-features")
    return land(vectors.coalesce(1).mapInArrow(fit, "index long, weight double"), "toxic-model")


def score(docs: DataFrame, model: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score): every document over its whole text."""
    arrow_conf(docs.sparkSession)
    pairs = model.collect()  # at most 1 + (1 << BITS) rows
    weights = np.zeros(1 << BITS, np.float32)
    bias = 0.0
    for r in pairs:
        if r["index"] < 0:
            bias = r["weight"]
        else:
            weights[r["index"]] = r["weight"]
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for b in batches:
            row, feat, n = features(b.column(1))
            used = w[feat] != 0
            cell = np.unique(row[used] << BITS | feat[used])
            total = bias + np.bincount(cell >> BITS, weights=w[cell & ((1 << BITS) - 1)], minlength=n)
            p = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p)], names=[id_col, "score"])

    narrow = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    return narrow.mapInArrow(run, f"`{id_col}` {kind}, score double")


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """(id_col, held_out, score, predicted) of every document."""
    arrow_conf(docs.sparkSession)
    scored = score(docs, train(docs, labels, label, id_col, text_col), id_col, text_col)
    return scored.select(id_col, (crc_mod(F.col(id_col), HELD_MOD) == HELD_VALUE).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

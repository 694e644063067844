"""Operator 13: embedding whitening by mixed-precision eigenvector refinement.

Entries are turned into integers (``floor(scale * c) + offset``), so counts,
sums and the covariance are exact whatever the partitioning: one pass sums the
vectors, a second one the products of the vectors centred at the integer next
to their mean.  Each task returns one row per dimension or pair of dimensions,
and Spark adds them as decimals; the driver only sees d and d * (d + 1) / 2
numbers.

Eigenvectors of the covariance are taken in float32 and corrected in float64
by the Ogita-Aishima iteration: with R = I - X'X and S = X'AX, the update X +
X E has E_ij = (S_ij + l_j R_ij) / (l_j - l_i), four matrix products a round
and quadratic convergence.  Eigenvalues closer than the round's error bound
can't be told apart by this quotient; they form a cluster, whose columns are
turned by the solution of the small problem X_c' (A - mu I) X_c (the shift by
the cluster's mean keeps its digits) before the next round.

A last pass projects every vector on the leading components; the covariance of
the whitened rows is summed in the same way and compared with the identity.

Defined results: rows whose vector is null, empty, holds a null or non-finite
entry or one beyond ``MAX_ENTRY``, or has another length than most vectors
(ties: the longer), are dropped; null ids are kept; repeated rows count and are
returned each; components without variance (below ``NO_VARIANCE`` of the trace)
have whitened value 0 and stay out of the identity check; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
MAX_ENTRY = 2.0 ** 40
NO_VARIANCE = 1e-12
ROUNDS = 30
BLOCK_ROWS = 8192


# ------------------------------------------------------------------ eigenvectors

def _clusters(values: np.ndarray, gap: float) -> Iterator[slice]:
    """Runs of two or more sorted eigenvalues whose neighbours are no more than ``gap`` apart."""
    cut = np.flatnonzero(np.abs(np.diff(values)) > gap) + 1
    for lo, hi in zip(np.append(0, cut), np.append(cut, len(values))):
        if hi - lo > 1:
            yield slice(lo, hi)


def refined_eigenvectors(a: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, float]:
    """(eigenvalues falling, orthonormal eigenvectors as columns, relative error left) of a symmetric matrix.

    The error is the largest off-diagonal entry of X'AX relative to A, or of
    X'X; rounds end when it is at rounding level or no longer halves.
    """
    a = np.asarray(a, np.float64)
    size = np.abs(a).max(initial=0.0)
    if not size:
        return np.zeros(len(a)), np.eye(len(a)), 0.0
    a = (a + a.T) / (2 * size)
    eps, eye = np.finfo(np.float64).eps, np.eye(len(a))
    norm = np.linalg.norm(a, 2)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.float64)
    best = (np.inf, None, None)
    for _ in range(rounds):
        r = eye - x.T @ x
        s = x.T @ (a @ x)
        values = np.diag(s) / (1 - np.diag(r))
        order = np.argsort(-values, kind="stable")
        x, values, r, s = x[:, order], values[order], r[np.ix_(order, order)], s[np.ix_(order, order)]
        s = (s + s.T) / 2
        error = float(max(np.abs(r).max(), np.abs(s - np.diag(np.diag(s))).max() / norm))
        halved = error <= best[0] / 2
        best = (error, values, x) if error < best[0] else best
        if error <= eps or (best[0] < 1e-12 and not halved):
            break
        bound = 2 * (np.linalg.norm(s - np.diag(values), 2) + norm * np.linalg.norm(r, 2))
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > bound
        x = x + x @ np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1.0), r / 2)
        for run in _clusters(values, bound):
            q = np.linalg.qr(x[:, run])[0]
            mu = values[run].mean()
            t = q.T @ (a @ q - mu * q)
            x[:, run] = q @ np.linalg.eigh((t + t.T) / 2)[1][:, ::-1]
    error, values, x = best
    x = x + x @ ((eye - x.T @ x) / 2)  # what rounding over close eigenvalues left of non-orthogonality
    return values * size, x, error


# ------------------------------------------------------------- distributed sums

def _usable(df: DataFrame, vec_col: str) -> DataFrame:
    """Column ``_v`` (array<double>) of the vectors that take part, others dropped."""
    v = F.col(f"`{vec_col}`").cast("array<double>")
    fine = F.forall("_v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(MAX_ENTRY)))
    return df.withColumn("_v", v).where(F.col("_v").isNotNull() & (F.size("_v") > 0) & F.coalesce(fine, F.lit(False)))


def _integers(column: pa.Array, dim: int, scale: int, offset: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(scale * flat.reshape(-1, dim)).astype(np.int64) + offset


def _summed(df: DataFrame, measure, cells: int) -> list[int]:
    """Exact sums over all vectors of the ``cells`` integers that ``measure`` gives for a block of vectors."""
    def run(batches):
        total = np.zeros(cells, object)
        for b in batches:
            for lo in range(0, b.num_rows, BLOCK_ROWS):
                total = total + measure(b.column(0).slice(lo, BLOCK_ROWS))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells)), pa.array([Decimal(int(t)) for t in total],
                                                                              pa.decimal128(38, 0))], names=["i", "t"])

    rows = df.select("_v").mapInArrow(run, "i long, t decimal(38,0)").groupBy("i").agg(F.sum("t").alias("t")).collect()
    out = [0] * cells
    for r in rows:
        out[r["i"]] = int(r["t"])
    return out


def exact_products(y: np.ndarray) -> np.ndarray:
    """y'y of integer rows as Python integers: float64 products of 21-bit digits, each sum below 2**53."""
    digits, rest = [], y.astype(np.int64)
    while True:
        low = ((rest + (1 << 20)) & ((1 << 21) - 1)) - (1 << 20)
        digits.append(low.astype(np.float64))
        rest = (rest - low) >> 21
        if not rest.any():
            break
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for lo in range(0, len(y), 2048):  # 2**11 products of 2**40
        part = [d[lo:lo + 2048] for d in digits]
        for i, p in enumerate(part):
            for j, q in enumerate(part):
                total = total + (p.T @ q).astype(np.int64).astype(object) * (1 << 21 * (i + j))
    return total


@dataclass(frozen=True)
class Whitening:
    """A fitted transformation: exact counts and sums, and the leading components."""
    n: int
    sums: list[int]
    values: np.ndarray      # eigenvalues, falling
    vectors: np.ndarray     # columns
    trace: float
    scale: int
    offset: int

    @property
    def dim(self) -> int:
        return len(self.sums)

    @property
    def centre(self) -> np.ndarray:
        """The integer vector next to the mean."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)

    def apply(self, x: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
        """Whitened values and deviations of integer vectors; a deviation beyond a long is None."""
        shift = np.array([s - self.n * c for s, c in zip(self.sums, self.centre.tolist())], object)
        y = x - self.centre
        mean = (shift / self.n).astype(np.float64)
        some = self.values > NO_VARIANCE * self.trace
        root = np.where(some, np.sqrt(np.where(some, self.values, 1.0)), np.inf)
        white = ((y - mean) @ self.vectors) / root
        widest = int(np.abs(y).max(initial=0)) * self.n + self.n
        if widest ** 2 * self.dim < 1 << 63:
            d = self.n * y - shift.astype(np.int64)
            return white, (d * d).sum(axis=1).tolist()
        d = self.n * y.astype(object) - shift
        exact = (d * d).sum(axis=1).tolist()
        return white, [t if t < 1 << 63 else None for t in exact]


def fit(df: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE,
        offset: int = OFFSET) -> Whitening | None:
    """Fit on every usable vector of ``df``; None if there is none."""
    usable = _usable(df, vec_col)
    lengths = usable.groupBy(F.size("_v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).head(1)
    if not lengths:
        return None
    dim, n = lengths[0]["dim"], lengths[0]["count"]
    vectors = usable.where(F.size("_v") == dim)
    sums = _summed(vectors, lambda v: _integers(v, dim, scale, offset).astype(object).sum(axis=0), dim)
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    upper = np.triu_indices(dim)
    products = _summed(vectors, lambda v: exact_products(_integers(v, dim, scale, offset) - centre)[upper],
                       len(upper[0]))
    rest = [s - n * c for s, c in zip(sums, centre.tolist())]
    cov = np.zeros((dim, dim))
    for i, j, p in zip(*upper, products):  # exact integers, one division
        cov[i, j] = cov[j, i] = (n * p - rest[i] * rest[j]) / (n * n)
    values, vecs, _ = refined_eigenvectors(cov)
    k = min(components, dim)
    return Whitening(n, sums, np.maximum(values[:k], 0.0), vecs[:, :k], float(np.trace(cov)), scale, offset)


def whiten(df: DataFrame, model: Whitening, vec_col: str = "embedding", out: str = "white") -> DataFrame:
    """The rows of ``df`` that take part, with the struct ``out``: values (array<double>) and deviation (long)."""
    keep = [c for c in df.columns if c != out]
    names = [f"c{i}" for i in range(len(keep))]
    private = df.select(*[F.col(f"`{c}`").alias(n) for n, c in zip(names, keep)], F.col(f"`{vec_col}`").alias("_in"))
    slim = _usable(private, "_in").where(F.size("_v") == model.dim).drop("_in")
    made = StructType([StructField("values", ArrayType(DoubleType())), StructField("deviation", LongType())])
    schema = StructType([*(StructField(n, f.dataType) for n, f in zip(names, slim.schema)), StructField("made", made)])

    def run(batches):
        for whole in batches:
            for lo in range(0, whole.num_rows, BLOCK_ROWS):
                *kept, v = whole.slice(lo, BLOCK_ROWS).columns
                white, deviation = model.apply(_integers(v, model.dim, model.scale, model.offset))
                k = white.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, white.size + 1, k), pa.int32()),
                                                 pa.array(white.reshape(-1)))
                both = pa.StructArray.from_arrays([lists, pa.array(deviation, pa.int64())],
                                                  names=["values", "deviation"])
                yield pa.RecordBatch.from_arrays([*kept, both], names=[*names, "made"])

    rows = slim.mapInArrow(run, schema)
    return rows.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], F.col("made").alias(out))


def identity_error(white: DataFrame, model: Whitening, out: str = "white") -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity (components with variance)."""
    some = np.flatnonzero(model.values > NO_VARIANCE * model.trace)
    if not len(some):
        return 0.0
    k = len(model.values)
    one = F.col(f"`{out}`.values")
    # sums of values, then of products: the means are those of the rows themselves
    means = white.agg(*[F.avg(one[i]).alias(f"m{i}") for i in range(k)]).first()
    pairs = [(int(i), int(j)) for i in some for j in some if i <= j]
    cov = white.agg(*[F.avg((one[i] - F.lit(means[i])) * (one[j] - F.lit(means[j]))).alias(f"p{i}_{j}")
                      for i, j in pairs]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(cov, pairs))


def no_rows(df: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """The empty result of a table without usable vectors, by component."""
    return df.where(F.lit(False)).select(
        F.col(f"`{id_col}`"), F.lit(0).alias("component"), F.lit(0).cast("long").alias("n"),
        F.lit(0).cast("long").alias("deviation"), *[F.lit(0.0).alias(c) for c in ("whitened", "explained",
                                                                                   "identity_error")])

"""Operator 7: approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a bounded sample of vectors (``SAMPLE`` of the smallest
id hashes) and holds at most ``MAX_LEAVES`` leaves; every row is put into the leaf
its greedy descent ends in.  A query walks the tree best bin first: a priority
queue of nodes by inner product with the node's centre yields leaves in the
order to visit.  How many leaves: ``CALIBRATION`` queries are answered
exactly against all rows (in blocks, each batch keeping its best), and visits
widen until the mean share of true neighbours found reaches ``TARGET_RECALL``.

Rows with the same vector collapse to one row holding its smallest ``k + 1``
ids (no more can ever be among a query's k nearest), so a vector that fills a
third of the table costs as much as any other.  Leaves are gathered into
groups of about ``GROUP_ROWS`` rows, large leaves are dealt by hash over several groups, and
queries over blocks; each group multiplies its queries with the leaves they
visit, a batch of queries at a time, and keeps the best of each, so a task holds
one group and one batch; a partial rank limit precedes the last shuffle.

Scores are double precision inner products of the original vectors, summed in
one fixed way.  Ties go to the smaller id.

Defined results: vectors that are null, zero, hold null or non-finite
components, or have a null id take no part, nor do those of a length other than
the most frequent one's (ties: the shorter); a query has all candidates if there are fewer than k;
rows that repeat an id are one candidate each; empty tables give no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from rxlens.llm.common import arrow_conf, land

BRANCHES = 8
SAMPLE = 20_000
MAX_LEAVES = 4096
LEAF_ROWS = 256
GROUP_ROWS = 16_384
GROUP_BYTES = 16 << 20  # of the vectors of a group
WALK_BYTES = 4 << 20  # of an Arrow batch of walks
QUERY_BLOCK = 50_000
CELLS = 2_000_000  # numbers compared or multiplied at once
CALIBRATION = 64
TARGET_RECALL = 0.96


# ------------------------------------------------------------------------ tree

class Tree:
    """Node centres, children and leaf numbers (leaves in depth-first order)."""

    def __init__(self, centres: np.ndarray, children: list[list[int]], leaf: list[int]):
        self.centres, self.children, self.leaf = centres, children, leaf
        self.n_leaves = max(leaf) + 1

    @classmethod
    def fit(cls, x: np.ndarray, leaves: int) -> Tree:
        rng = np.random.default_rng(7)
        limit = max(8, -(-len(x) // max(1, leaves)))
        centres, children, leaf = [x.mean(0)], [[]], [-1]
        n_leaf = 0
        stack = [(0, np.arange(len(x)))]
        while stack:
            node, rows = stack.pop()
            parts = _kmeans(x[rows], min(BRANCHES, -(-len(rows) // limit)), rng) if len(rows) > limit else []
            if len(parts) < 2:
                leaf[node] = n_leaf
                n_leaf += 1
                continue
            for part in parts:
                children[node].append(len(centres))
                centres.append(x[rows[part]].mean(0))
                children.append([])
                leaf.append(-1)
            stack += [(c, rows[p]) for c, p in reversed(list(zip(children[node], parts)))]
        return cls(np.array(centres), children, leaf)

    def place(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row: at every level the nearest centre."""
        out = np.zeros(len(x), np.int64)
        stack = [(0, np.arange(len(x)))]
        while stack:
            node, rows = stack.pop()
            if not len(rows):
                continue
            if not self.children[node]:
                out[rows] = self.leaf[node]
                continue
            kids = np.array(self.children[node])
            near = _nearest(x[rows], self.centres[kids])
            stack += [(int(k), rows[near == i]) for i, k in enumerate(kids)]
        return out

    def visits(self, q: np.ndarray, limit: int) -> list[int]:
        """The first leaves of a best-bin-first walk."""
        bound = self.centres @ q
        queue, out = [(0.0, 0)], []
        while queue and len(out) < limit:
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                out.append(self.leaf[node])
            for c in self.children[node]:
                heapq.heappush(queue, (-bound[c], c))
        return out


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(1) - 2 * (x @ centres.T)).argmin(1)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> list[np.ndarray]:
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = _nearest(x, centres)
        centres = np.array([x[near == i].mean(0) if (near == i).any() else centres[i] for i in range(len(centres))])
    near = _nearest(x, centres)
    return [p for p in (np.flatnonzero(near == i) for i in range(len(centres))) if len(p)]


# ------------------------------------------------------------------- exact parts

def _matrix(column: pa.Array | pd.Series) -> np.ndarray:
    items = column.to_pylist() if isinstance(column, pa.Array) else list(column)
    return np.frombuffer(b"".join(bytes(v) for v in items), "<f8").reshape(len(items), -1)


def best(q: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per query the (row, score) arrays of its k largest inner products, ties to the smaller id (flattened)."""
    n, keep = x.shape[0], min(k, x.shape[0])
    if keep == n:
        at = np.broadcast_to(np.arange(n), (len(q), n))
        score = _exact(x, q, at)
        order = np.lexsort((ids[at], -score), axis=1)
        return np.take_along_axis(at, order, 1), np.take_along_axis(score, order, 1)
    rough = q @ x.T
    # a product summed in any order is off by less than this; twice it between two products, twice again for the k-th
    slack = 4 * (x.shape[1] + 1) * np.finfo(float).eps * np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max()
    top = np.argpartition(rough, (n - keep - 1, n - keep), axis=1)[:, n - keep - 1:]
    beyond, least = (np.take_along_axis(rough, top[:, i:i + 1], 1)[:, 0] for i in (0, 1))
    least = least - slack
    at, score = top[:, 1:].astype(np.int64), np.empty((len(q), keep))
    step = max(1, CELLS // (keep * x.shape[1]))
    for lo in range(0, len(q), step):
        part = slice(lo, lo + step)
        mine = _exact(x, q[part], at[part])
        order = np.lexsort((ids[at[part]], -mine), axis=1)
        at[part], score[part] = np.take_along_axis(at[part], order, 1), np.take_along_axis(mine, order, 1)
    for i in np.flatnonzero(~(beyond < least)):  # more may tie with the k-th: every row that may, however many
        rows = np.flatnonzero(~(rough[i] < least[i]))
        mine = _exact(x, q[i:i + 1], rows[None, :])[0]
        order = np.lexsort((ids[rows], -mine))[:keep]
        at[i], score[i] = rows[order], mine[order]
    return at, score


def _exact(x: np.ndarray, q: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Products rounded alike wherever a vector stands: summed row by row."""
    return (x[at] * q[:, None, :]).sum(axis=2)


def usable(vec: Column) -> Column:
    """The vector is not null or zero and all its components are finite numbers."""
    ok = F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(vec.isNotNull() & ok & F.exists(vec, lambda v: v != 0), F.lit(False))


def _usable_rows(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v) of the rows that take part."""
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where(
        F.col("id").isNotNull() & usable(F.col("v")))


def _packed(rows: DataFrame) -> DataFrame:
    """(id, h1, h2, vec) of ``_usable_rows``, vectors as little-endian doubles with a 128-bit identity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vec = pa.array([np.array(v, "<f8").tobytes() for v in (
                np.array(x, float) + 0.0 for x in b.column(1).to_pylist())], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), vec], names=["id", "vec"])

    out = rows.mapInArrow(run, "id long, vec binary")
    return out.select("id", F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(1), "vec").alias("h2"), "vec")


def _classes(rows: DataFrame, k: int) -> DataFrame:
    """(h1, h2, cid, ids, vec): one row per distinct vector with its k + 1 smallest ids."""
    w = W.partitionBy("h1", "h2").orderBy("id")
    few = rows.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k + 1)
    return few.groupBy("h1", "h2").agg(F.min("id").alias("cid"), F.sort_array(F.collect_list("id")).alias("ids"),
                                       F.first("vec").alias("vec"))


# ----------------------------------------------------------------------- search

def nearest(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
            target: float = TARGET_RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    arrow_conf(spark)
    rows = _usable_rows(vectors, id_col, vec_col)
    width = rows.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").limit(1).collect()
    if not width:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("v") == width[0]["w"])
    classes = land(_classes(_packed(rows), k), "ann-classes", "zstd")
    n = classes.count()
    sample = classes.orderBy(F.xxhash64("cid", F.lit(7)), "cid").limit(SAMPLE).select("cid", "vec").collect()
    x = np.stack([np.frombuffer(bytes(r["vec"]), "<f8") for r in sorted(sample, key=lambda r: r["cid"])])
    tree = Tree.fit(x, min(MAX_LEAVES, max(1, n // LEAF_ROWS)))
    shared = spark.sparkContext.broadcast(tree)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                leaf = shared.value.place(_matrix(b.column(1)))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(leaf), b.column(1), b.column(2)],
                                                 names=["cid", "leaf", "vec", "ids"])

    placed = land(classes.select("cid", "vec", "ids").mapInArrow(
        place, "cid long, leaf long, vec binary, ids array<long>"), "ann-leaves", "zstd")
    asked = land(_packed(rows.where(F.col("id") % every == 0)), "ann-asked", "zstd")
    queries = land(asked.groupBy("h1", "h2").agg(F.first("vec").alias("vec"), F.min("id").alias("qid")), "ann-queries",
                   "zstd")
    visits = _calibrated(placed, queries, tree, k, target)
    return _answers(placed, queries, asked, tree, shared, visits, k)


def _calibrated(placed: DataFrame, queries: DataFrame, tree: Tree, k: int, target: float) -> int:
    """Leaves to visit for the target recall, from exact answers of a fixed number of queries over all rows."""
    probe = queries.orderBy(F.xxhash64("qid", F.lit(3)), "qid").limit(CALIBRATION).collect()
    if not probe:
        return 1
    q = np.stack([np.frombuffer(bytes(r["vec"]), "<f8") for r in probe])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, ids, leaf = _matrix(b.column(1)), b.column(0).to_numpy(), b.column(2).to_numpy()
                at, score = best(q, x, ids, k + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.arange(len(q)), at.shape[1])), pa.array(ids[at].ravel()),
                     pa.array(leaf[at].ravel()), pa.array(score.ravel())], names=["q", "cid", "leaf", "score"])

    found = placed.select("cid", "vec", "leaf").mapInArrow(run, "q long, cid long, leaf long, score double")
    w = W.partitionBy("q").orderBy(F.desc("score"), "cid")
    true = found.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k + 1).collect()  # CALIBRATION * (k+1)
    leaves: dict[int, list[int]] = {}
    for r in true:
        if r["cid"] != probe[r["q"]]["qid"]:
            leaves.setdefault(r["q"], []).append(r["leaf"])
    share = np.zeros(tree.n_leaves)
    for i, mine in leaves.items():
        rank = {leaf: j for j, leaf in enumerate(tree.visits(q[i], tree.n_leaves))}
        np.add.at(share, [rank[leaf] for leaf in mine], 1 / len(mine) / len(leaves))
    return int(np.searchsorted(np.cumsum(share), min(target, 1.0) - 1e-9)) + 1 if leaves else 1


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The k + 1 best of each query within its group, of rows ordered by group, block, asking, leaves and id."""
    cell, held = None, []
    for b in batches:
        grp, block, asks = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        turns = np.flatnonzero((grp[1:] != grp[:-1]) | (block[1:] != block[:-1]) | (asks[1:] != asks[:-1])) + 1
        for lo, hi in zip([0, *turns], [*turns, b.num_rows]) if b.num_rows else ():
            if (grp[lo], block[lo]) != cell:
                cell, held = (grp[lo], block[lo]), []
            part = b.slice(lo, hi - lo)
            lists = part.column(3)
            leaves = lists.flatten().to_numpy()
            ids, vec = part.column(4).to_numpy(), _matrix(part.column(5))
            if not asks[lo]:
                held.append((leaves, ids, vec))
            elif held:
                if len(held) > 1:
                    held = [tuple(np.concatenate(c) for c in zip(*held))]
                query = np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy())
                yield _best_of_leaves(ids, vec, query, leaves, *held[0], k)


def _best_of_leaves(qid: np.ndarray, q: np.ndarray, query: np.ndarray, wanted: np.ndarray, leaf: np.ndarray,
                    ids: np.ndarray, x: np.ndarray, k: int) -> pa.RecordBatch:
    """(qid, cid, score): the k + 1 best of each query among the rows of its leaves (``query`` wants leaf ``wanted``)."""
    order = np.argsort(wanted, kind="stable")
    query, wanted = query[order], wanted[order]
    which, cid, score = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    for each, begin, end in zip(*np.unique(wanted, return_index=True), [*np.flatnonzero(np.diff(wanted)) + 1, len(wanted)]):
        a, z = np.searchsorted(leaf, [each, each + 1])
        step = max(16, CELLS // max(1, z - a))
        for lo in range(begin, end, step) if a < z else ():
            i = query[lo:min(lo + step, end)]
            at, mine = best(q[i], x[a:z], ids[a:z], k + 1)
            which.append(np.repeat(i, at.shape[1]))
            cid.append(ids[a:z][at].ravel())
            score.append(mine.ravel())
    which, cid, score = np.concatenate(which), np.concatenate(cid), np.concatenate(score)
    order = np.lexsort((cid, -score, which))
    sorted_ = which[order]
    keep = order[np.arange(len(order)) - np.searchsorted(sorted_, sorted_) <= k]
    return pa.RecordBatch.from_arrays([pa.array(qid[which[keep]]), pa.array(cid[keep]), pa.array(score[keep])],
                                      names=["qid", "cid", "score"])


def _answers(placed: DataFrame, queries: DataFrame, asked: DataFrame, tree: Tree, shared, visits: int,
             k: int) -> DataFrame:
    # groups of neighbouring leaves; a large leaf takes several groups, its rows dealt by hash
    group_rows = max(1, min(GROUP_ROWS, GROUP_BYTES // (8 * tree.centres.shape[1])))
    sizes = {r["leaf"]: r["count"] for r in placed.groupBy("leaf").count().collect()}  # MAX_LEAVES rows at most
    first, parts, group, held = [0] * tree.n_leaves, [1] * tree.n_leaves, 0, 0
    for leaf in range(tree.n_leaves):
        size = sizes.get(leaf, 0)
        if held and held + size > group_rows:
            group, held = group + 1, 0
        first[leaf], parts[leaf] = group, max(1, -(-size // group_rows))
        if parts[leaf] > 1:
            group, held = group + parts[leaf], 0
        else:
            held += size
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    lookup = placed.sparkSession.createDataFrame([(i, f, p) for i, (f, p) in enumerate(zip(first, parts))],
                                                 "leaf long, first long, parts long")
    members = (placed.join(F.broadcast(lookup), "leaf")
               .withColumn("grp", F.col("first") + F.pmod(F.xxhash64("cid"), F.col("parts")))
               .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
               .select("grp", "block", "leaf", "cid", "vec"))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(qids, grps, leaves, vecs):
            return pa.RecordBatch.from_arrays(
                [pa.array(qids, pa.int64()), pa.array(grps, pa.int64()), pa.array(leaves, pa.list_(pa.int64())),
                 pa.array(vecs, pa.binary())], names=["qid", "grp", "leaves", "vec"])

        for b in batches:
            qids, grps, leaves, vecs, size = [], [], [], [], 0
            for qid, vec in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                by: dict[int, list[int]] = {}
                for leaf in shared.value.visits(np.frombuffer(vec, "<f8"), visits):
                    for part in range(parts[leaf]):
                        by.setdefault(first[leaf] + part, []).append(leaf)
                for g, ls in by.items():
                    qids.append(qid); grps.append(g); leaves.append(ls); vecs.append(vec)
                    size += len(vec) + 8 * len(ls)
                    if size > WALK_BYTES:  # a query's vector goes to every group it visits
                        yield made(qids, grps, leaves, vecs)
                        qids, grps, leaves, vecs, size = [], [], [], [], 0
            yield made(qids, grps, leaves, vecs)

    walks = (queries.select("qid", "vec").mapInArrow(walk, "qid long, grp long, leaves array<long>, vec binary")
             .withColumn("block", F.pmod(F.xxhash64("qid"), F.lit(blocks)).cast("int")))

    # a group's vectors come first, then its queries, a batch at a time: a task holds one group and one batch
    cells = (members.select("grp", "block", F.lit(False).alias("asks"), F.array("leaf").alias("leaves"),
                            F.col("cid").alias("id"), "vec")
             .unionByName(walks.select("grp", "block", F.lit(True).alias("asks"), "leaves", F.col("qid").alias("id"), "vec")))
    # more tasks than cells, as few cells share a task then
    tasks = min(int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions")), 8 * (group + 1) * blocks)
    dealt = cells.repartition(tasks, "grp", "block").sortWithinPartitions("grp", "block", "asks", "leaves", "id")
    found = dealt.mapInArrow(partial(_search, k=k), "qid long, cid long, score double")
    w = W.partitionBy("qid").orderBy(F.desc("score"), "cid")
    top = found.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k + 1)
    # classes to ids: at most (k + 1) ** 2 per distinct query vector
    ids = top.join(placed.select("cid", "ids"), "cid").select("qid", "score", F.explode("ids").alias("vec_id"))
    per = ids.groupBy("qid").agg(F.slice(F.array_sort(F.collect_list(
        F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k + 1).alias("near"))
    named = queries.select("h1", "h2", "qid").join(per, "qid").select("h1", "h2", "near")
    own = asked.select("h1", "h2", F.col("id").alias("query_id")).join(named, ["h1", "h2"])
    mine = F.slice(F.filter("near", lambda c: c["vec_id"] != F.col("query_id")), 1, k)
    return own.select("query_id", F.posexplode(mine).alias("rank", "c")).select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("c.vec_id").alias("vec_id"),
        (-F.col("c.s")).alias("score"))

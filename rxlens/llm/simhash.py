"""Operator 9: SimHash near-duplicates by anchor-point covering.

Fingerprints: one bit-wise majority vote per text over the XXH64 (seed 42)
hashes of its word shingles.  Texts with the same fingerprint collapse first;
everything after works on distinct fingerprints (16 bytes a row).

Covering code: the perfect binary Golay code [23, 12] has covering radius 3,
so every 23-bit word has exactly one anchor (codeword) within distance 3.  A
fingerprint is cut into three blocks of 22, 21 and 21 bits.  Two fingerprints
at distance 4 or less differ in at most 2 bits over some two of the blocks
(the two with the fewest differences).  For such a pair of blocks some word
lies at distance 1 or less from both; its anchor pair (24 key bits) is within
the covering radius plus 1 of both fingerprints.  So each fingerprint is
replicated to every anchor pair within radius 3 plus half that threshold: 1 to
11 anchors for each of the three block pairs, whatever the input.  Fingerprints are
compared only where they share an anchor, and no link can be missed.

An anchor with more than ``GROUP_ROWS`` fingerprints is cut into hash blocks
that are compared block against block, each block pair its own group.  A group
is never emitted as pairs: it returns a spanning forest of its links as trees
of small degree, and connected components are found on these few edges by
contraction rounds.

Defined results: a null or empty text, or one of white space, has the zero
fingerprint and links like any other; fewer words than a shingle: one shingle
of all words; rows with a null id take part and get the component's smallest
non-null id (null if none); repeated rows repeat; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from rxlens.llm.common import arrow_conf, land

SEED = 42
SHINGLE_WORDS = 4
MAX_BITS = 4
GROUP_ROWS = 2048
BLOCKS = ((0, 22), (22, 21), (43, 21))  # (first bit, bits)
GOLAY_BITS, GOLAY_GENERATOR = 23, 0b101011100011
TREE_DEGREE = 64


# ---------------------------------------------------------------- fingerprints

def fingerprints_of(texts: pa.Array, shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """uint64 fingerprint of each text of a batch."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    size = pc.binary_length(flat).to_numpy(zero_copy_only=False).astype(np.int64)
    per = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(per)), per)[size > 0]
    flat, size = flat.filter(pa.array(size > 0)), size[size > 0]
    out = np.zeros(len(per), np.uint64)
    if not len(owner):
        return out
    # one buffer "w0 w1 w2 ...": a shingle is a slice of it
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat.cast(pa.string())), " ")
    data = joined[0].as_buffer().to_pybytes()
    start = np.concatenate(([0], np.cumsum(size + 1)[:-1]))
    end = start + size
    n_words = np.bincount(owner, minlength=len(per))
    first = np.cumsum(n_words) - n_words
    n_sh = np.where(n_words >= shingle, n_words - shingle + 1, np.minimum(n_words, 1))
    which = np.repeat(np.arange(len(per)), n_sh)
    begin = first[which] + np.arange(len(which)) - np.repeat(np.cumsum(n_sh) - n_sh, n_sh)
    last = begin + np.minimum(shingle, n_words[which]) - 1
    digest = xxhash.xxh64_intdigest
    step = 1 << 18
    votes = np.zeros((len(per), 64), np.int64)
    for lo in range(0, len(which), step):
        hi = min(lo + step, len(which))
        h = np.fromiter((digest(data[a:b], SEED) for a, b in zip(start[begin[lo:hi]].tolist(),
                                                                 end[last[lo:hi]].tolist())), np.uint64, hi - lo)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        w = which[lo:hi]
        cut = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1])))
        for a, b in zip(cut, np.append(cut[1:], hi - lo)):
            votes[w[a]] += bits[a:b].sum(axis=0, dtype=np.int64)
    major = (votes * 2 > n_sh[:, None]).astype(np.uint8)
    return np.packbits(major, axis=1, bitorder="little").view("<u8").reshape(-1).astype(np.uint64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(id_col, fp long): the 64 bits as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = fingerprints_of(b.column(1), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], names=[id_col, "fp"])

    arrow_conf(docs.sparkSession)
    narrow = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    kind = narrow.schema[0].dataType.simpleString()
    return narrow.mapInArrow(run, f"`{id_col}` {kind}, fp long")


def with_fingerprints(docs: DataFrame, text_col: str, shingle: int, into: str) -> DataFrame:
    """``docs`` with a column ``into`` of fingerprints (signed longs)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = fingerprints_of(b.column(b.num_columns - 1), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fp)], names=b.schema.names)

    arrow_conf(docs.sparkSession)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    texts = docs.select(*columns, F.col(text_col).cast("string").alias(into))
    return texts.mapInArrow(run, StructType([*docs.schema.fields, StructField(into, LongType())]))


# --------------------------------------------------------------- covering code

def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainder of each 23-bit word modulo the generator polynomial."""
    out = np.zeros(words.shape, np.int64)
    for bit in range(GOLAY_BITS):
        r = 1 << bit
        for top in range(GOLAY_BITS - 1, 10, -1):
            if r >> top & 1:
                r ^= GOLAY_GENERATOR << (top - 11)
        out ^= ((words >> bit) & 1) * r
    return out


class Golay:
    """Error patterns by syndrome: the one of weight 3 or less, and those of weight 4 (up to 5)."""
    _tables = None

    @classmethod
    def tables(cls) -> tuple[np.ndarray, np.ndarray]:
        if cls._tables is None:
            near = np.full(2048, -1, np.int64)
            far = np.full((2048, 5), -1, np.int64)
            for weight in range(5):
                pats = np.array([sum(1 << b for b in c) for c in combinations(range(GOLAY_BITS), weight)], np.int64)
                for s, p in zip(_syndromes(pats).tolist(), pats.tolist()):
                    if weight < 4:
                        near[s] = p
                    else:
                        far[s, int((far[s] >= 0).sum())] = p
            cls._tables = near, far
        return cls._tables


def anchors_of(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row index, anchor key) of every replica of the fingerprints (uint64)."""
    near, far = Golay.tables()
    home, beyond = [], []
    for first, bits in BLOCKS:
        w = ((fp >> np.uint64(first)) & np.uint64((1 << bits) - 1)).astype(np.int64)
        s = _syndromes(w)
        home.append((w ^ near[s]) >> 11)  # 12 consecutive bits name a codeword
        beyond.append(np.where(far[s] >= 0, (w[:, None] ^ far[s]) >> 11, -1))
    rows, keys = [], []
    base = np.arange(len(fp))
    for k, (p, q) in enumerate(combinations(range(3), 2)):
        tag = np.int64(k << 24)
        rows.append(base)
        keys.append(tag | home[p] << 12 | home[q])
        for j in range(beyond[p].shape[1]):
            ok = beyond[p][:, j] >= 0
            rows.append(base[ok])
            keys.append(tag | beyond[p][ok, j] << 12 | home[q][ok])
            ok = beyond[q][:, j] >= 0
            rows.append(base[ok])
            keys.append(tag | home[p][ok] << 12 | beyond[q][ok, j])
    return np.concatenate(rows), np.concatenate(keys)


def replicate(fps: DataFrame) -> DataFrame:
    """(anchor, fp): every distinct fingerprint at each of its anchors."""
    def run(batches):
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False)
            for lo in range(0, len(fp), 20_000):
                part = fp[lo:lo + 20_000]
                row, key = anchors_of(part.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[row])], names=["anchor", "fp"])

    return fps.select("fp").mapInArrow(run, "anchor long, fp long")


# ------------------------------------------------------------- links per anchor

def _forest(fp: np.ndarray, group: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links inside each group (rows sorted by group, fp): (fp, parent fp)."""
    n = len(fp)
    label = np.arange(n)
    bounds = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.append(bounds, n))
    room = np.repeat(bounds + sizes, sizes) - np.arange(n)  # rows from here to the end of the group
    active = np.arange(n)
    for d in range(1, int(sizes.max()) if n else 0):
        active = active[room[active] > d]
        if not len(active):
            break
        i, j = active, active + d
        near = np.bitwise_count(fp[i] ^ fp[j]) <= max_bits
        i, j = i[near], j[near]
        while len(i):
            a, b = label[i], label[j]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while True:  # roots point to themselves, everything else to its root
                up = label[label]
                if (up == label).all():
                    break
                label = up
    order = np.lexsort((np.arange(n), label))
    root = label[order]
    head = np.flatnonzero(np.concatenate(([True], root[1:] != root[:-1]))) if n else np.zeros(0, np.int64)
    rank = np.arange(n) - np.repeat(head, np.diff(np.append(head, n)))
    parent = order[np.arange(n) - rank + (rank - 1) // TREE_DEGREE]  # a tree of small degree per component
    child = rank > 0
    return fp[order[child]], fp[parent[child]]


def links(fps: DataFrame, max_bits: int = MAX_BITS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(a, b): a spanning forest of the links (``max_bits`` or fewer differing bits) of distinct fingerprints."""
    if max_bits > 4:
        raise ValueError("the anchors cover up to 4 differing bits")
    rep = replicate(fps)
    large = (rep.groupBy("anchor").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > group_rows)
             .select("anchor", F.ceil(F.col("rows") / group_rows).cast("int").alias("blocks")))
    # most anchors are one group; a large one is a group for each pair of its blocks
    own = F.coalesce("blocks", F.lit(1))
    dealt = (rep.join(large, "anchor", "left").withColumn("blocks", own)
             .withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("anchor", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), "fp"))
    key = ["anchor", "lo", "hi"]
    grouped = dealt.repartition(*key).sortWithinPartitions(*key, "fp")

    def run(batches):
        held: list[np.ndarray] = []
        held_rows = 0

        def emit(rows: np.ndarray):
            cut = np.concatenate(([True], (rows[1:, :3] != rows[:-1, :3]).any(axis=1)))
            a, b = _forest(rows[:, 3].view(np.uint64), np.cumsum(cut), max_bits)
            pairs = np.unique(np.stack([a.view(np.int64), b.view(np.int64)], axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64)
                                  for i in range(4)], axis=1))
            held_rows += batch.num_rows
            if held_rows < 100_000:
                continue
            rows = np.concatenate(held)
            same = (rows[:, :3] == rows[-1, :3]).all(axis=1)
            first = len(rows) - int(same.sum())  # the last group may go on
            if first:
                yield emit(np.ascontiguousarray(rows[:first]))
            held, held_rows = [rows[first:]], len(rows) - first
        if held_rows:
            yield emit(np.ascontiguousarray(np.concatenate(held)))

    found = grouped.mapInArrow(run, "a long, b long")
    return found.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each connected component, for nodes that have edges.

    Each round every node points to its smallest neighbour or itself, pointers
    are followed twice, and the edges are contracted; rounds end when no edge
    is left.  Every round is written to the checkpoint folder.
    """
    left = land(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v"), "cc-edges")
    root = None
    while not left.isEmpty():
        both = left.union(left.select("v", "u"))
        up = (both.groupBy("u").agg(F.min("v").alias("m"))
              .select(F.col("u").alias("node"), F.least("u", "m").alias("up")))
        up = land(up, "cc-up")
        for _ in range(2):
            over = up.select(F.col("node").alias("up"), F.col("up").alias("up2"))
            up = up.join(over, "up").select("node", F.col("up2").alias("up"))
        up = land(up, "cc-jump")
        a, b = (up.select(F.col("node").alias(x), F.col("up").alias(y)) for x, y in (("u", "u2"), ("v", "v2")))
        nxt = (left.join(a, "u").join(b, "v").where("u2 <> v2")
               .select(F.least("u2", "v2").alias("u"), F.greatest("u2", "v2").alias("v")).distinct())
        left = land(nxt, "cc-edges")
        if root is None:
            root = up.select("node", F.col("up").alias("root"))
        else:
            step = up.select(F.col("node").alias("root"), "up")
            root = (root.join(step, "root", "left")
                    .select("node", F.coalesce("up", "root").alias("root")))
            root = land(root, "cc-root")
    return left.select(F.col("u").alias("node"), F.col("v").alias("root")) if root is None else root


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(id_col, fp long, component_id): every row of ``docs`` with its fingerprint and component."""
    return grouped(docs, id_col, text_col, shingle, max_bits).select(id_col, "fp", "component_id")


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``near_duplicates`` with the group's own key ``root`` (a fingerprint; ids may repeat in other groups)."""
    marked = land(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    own = land(marked.groupBy("fp").agg(F.min(id_col).alias("first_id")), "simhash-distinct")
    linked = components(links(own.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    rooted = own.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = rooted.where("root <> fp").groupBy("root").agg(F.min("first_id").alias("least_id"))
    # a root's own smallest id counts too; only components of several fingerprints are looked up
    roots = (own.select(F.col("fp").alias("root"), "first_id").join(first, "root")
             .select("root", F.least("first_id", "least_id").alias("component_id")))
    by_fp = (rooted.join(roots, "root", "left")
             .select("fp", F.coalesce("component_id", "first_id").alias("component_id"), "root"))
    return marked.join(by_fp, "fp").select(id_col, "fp", "component_id", "root")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id (rows with a null id stay).

    Where an id repeats, its rows are told apart by their fingerprints: of a
    group's rows with the smallest id the one of the smallest fingerprint
    stays, so rows of one id with different texts in different groups all do.
    """
    found = land(grouped(docs, id_col, text_col, shingle, max_bits)
                 .select(F.col(id_col).alias("_op9_id"), "fp", "component_id", "root"), "simhash-grouped")
    named = found.where(F.col("_op9_id").isNotNull())
    stay = land(named.where(F.col("_op9_id") == F.col("component_id")).groupBy("root")
                .agg(F.min(F.struct("_op9_id", "fp")).alias("r")).select("r._op9_id", F.col("r.fp").alias("_op9_fp")),
                "simhash-stay")
    repeated = land(named.groupBy("_op9_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_op9_id"),
                    "simhash-repeated")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    own = docs.withColumn("_op9_id", F.col(id_col))
    kept = (own.join(stay.join(repeated, "_op9_id", "left_anti"), "_op9_id", "left_semi").select(*columns)
            .unionByName(docs.where(F.col(id_col).isNull())))
    if repeated.isEmpty():
        return kept
    twice = own.join(repeated.join(stay, "_op9_id", "left_semi"), "_op9_id", "left_semi")
    marked = with_fingerprints(twice, text_col, shingle, "_op9_fp")
    chosen = marked.join(stay, ["_op9_id", "_op9_fp"], "left_semi").dropDuplicates(["_op9_id", "_op9_fp"])
    return kept.unionByName(chosen.select(*columns))

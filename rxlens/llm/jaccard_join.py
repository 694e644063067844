"""Operator 12: n-gram Jaccard join with token-combination prefixes.

A document is the set of its distinct word shingles; two link when their
Jaccard similarity reaches a threshold (0.8).  Shingles are 64-bit hashes of
their words, sets are keyed by a 64-bit hash of the set, and documents of equal
sets collapse before anything else.

Prefixes.  A set of n tokens may miss at most n - ceil(0.8 n) of them in a
partner.  Tokens have one order: rare ones by hash, then the classes of
frequent ones, each dealt to groups by hash.  A rare token is indexed by
itself; of a frequent class only k-token combinations within a group are.  A
prefix is extended until sum(max(0, tokens - k + 1)) over its groups (k = 1
and one group for rare tokens) exceeds the tokens that may be missing: then at
least k common tokens remain in some group, whichever are missing, and the two
sets share one of the indexed combinations.  The number of groups follows the
power-of-two band of n, so a combination costs about as much as a token; a set
that may meet partners of the band below is indexed for both.

Classes are counted, not sampled: every round counts the tokens that the
current prefixes bring into the index, over all distinct sets, and tokens of
more than ``CLASS_ROWS`` sets change class; rounds end when none does, when those that
did are a small share of the index, or after ROUNDS.  A class
holds at most ``CLASS_TOKENS`` tokens, so it can be broadcast.  Classes only
steer the cost: a frequent token left out is indexed like any other.

Candidates.  Postings of a hot combination collapse inside each map task to one
row per size band before they are shuffled.  A group is never emitted as pairs:
each member is paired with a hub, and with its neighbour in size.  Candidates
are first compared on parity bitmaps of two to four bits a token (their distance
never exceeds the symmetric difference, so no link is lost), then on the whole
sets.  What is linked becomes one component.  After that all pairs of members of
different components, in groups that hold several, are compared by their
bitmaps inside the tasks, and by their whole sets where these leave a doubt:
first each member and its nearest partner only, so that most of a large group
is one component before the rest of its pairs is written.

Defined results: a null, empty or white text is the empty set and links with
nothing, not even its copies; fewer words than a shingle are one shingle; a row
with a null id takes part and gets the component's smallest non-null id (null
if there is none); repeated rows repeat; rows of one id with different texts
are judged by their texts; an empty table gives no rows; other columns don't
matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxlens.llm.common import arrow_conf, land, lookup
from rxlens.llm.simhash import components
from rxlens.session import ENGINE_CONF

SHINGLE_WORDS = 5
PERCENT = 80                      # Jaccard threshold
CLASS_ROWS = ((2, 64), (3, 4096))  # (k, sets a token must exceed)
CLASS_TOKENS = 1 << 18
GROUP_TOKENS = {2: 3, 3: 8}       # tokens a group has if the whole set is in the class
ROUNDS = 3
WORTH_A_ROUND = 0.01              # share of all postings that a round must move to classes for another pass over the texts
FLUSH_POSTINGS = 1 << 20
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = "4MB"           # of a finished shuffle; bitmaps and whole sets are larger and stay in theirs
GROUP_ROWS = 2048
NEAREST_ROUNDS = (True, True, False)    # whether only nearest partners are checked; the last round leaves none out

Classes = dict[int, np.ndarray]   # k -> sorted token hashes


# ------------------------------------------------------------------------- sets

def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Sets:
    """The shingle sets of a batch: ``tokens`` sorted inside each row, ``sizes`` and ``keys`` per row."""

    def __init__(self, tokens: np.ndarray, sizes: np.ndarray):
        self.tokens, self.sizes = tokens, sizes
        self.first = np.cumsum(sizes) - sizes
        self.row = np.repeat(np.arange(len(sizes)), sizes)
        sums = np.zeros(len(sizes), np.uint64)
        some = sizes > 0
        if some.any():  # a set's hash does not depend on an order
            sums[some] = np.add.reduceat(_mix(tokens + np.uint64(0x9E3779B97F4A7C15)), self.first[some])
        self.keys = _mix(sums ^ sizes.astype(np.uint64)).view(np.int64)


# odd multipliers of the word places in a shingle, and of the byte places in a word
PLACES = _mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)
# a value for each byte: none for white space, the same for both cases of A-Z
WHITE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
BYTES = _mix(np.arange(256, dtype=np.uint64) + np.uint64(1 << 32))
BYTES[65:91] = BYTES[97:123]
BYTES[WHITE] = 0
BLOCK_BYTES = 1 << 22


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word, words per text): sum of byte value times a power for its place in the word."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    first, size = int(offsets[0]), int(offsets[-1] - offsets[0])
    data = np.frombuffer(texts.buffers()[2], np.uint8, size, first) if size else np.zeros(0, np.uint8)
    bounds = offsets - first
    begins, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    powers = np.ones(1, np.uint64)
    lo = 0
    while lo < size:
        hi = min(lo + BLOCK_BYTES, size)
        while hi < size and not WHITE[data[hi]]:  # words are not cut
            more = np.flatnonzero(WHITE[data[hi:hi + BLOCK_BYTES]])
            hi = hi + int(more[0]) if len(more) else min(hi + BLOCK_BYTES, size)
        part = data[lo:hi]
        white = WHITE[part]
        head = ~white
        head[1:] &= white[:-1]
        edges = bounds[np.searchsorted(bounds, lo):np.searchsorted(bounds, hi)] - lo
        head[edges] = ~white[edges]
        at = np.flatnonzero(head)
        if len(at):
            length = np.diff(np.append(at, len(part)))
            place = np.arange(at[0], len(part)) - np.repeat(at, length)
            place[white[at[0]:]] = 0
            if place.max() >= len(powers):
                powers = np.full(int(place.max()) + 1, PLACES[0])
                powers[0] = 1
                powers = np.multiply.accumulate(powers)
            begins.append(at + lo)
            hashes.append(np.add.reduceat(BYTES[part[at[0]:]] * powers[place], at - at[0]))
        lo = hi
    begins = np.concatenate(begins)
    per = np.diff(np.searchsorted(begins, bounds))
    return np.concatenate(hashes), per.astype(np.int64)


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE_WORDS) -> Sets:
    """Shingle hashes: 64-bit word hashes times the multiplier of their place, added and mixed."""
    hashed, per = word_hashes(texts)
    hashed = _mix(hashed)
    at_place = np.zeros(len(hashed), np.uint64)  # the shingle that begins at each word, whatever text goes on there
    for k in range(min(shingle, len(hashed))):
        at_place[:len(hashed) - k] += hashed[k:] * PLACES[k]
    first = np.cumsum(per) - per
    for i in np.flatnonzero((per > 0) & (per < shingle)):  # fewer words: one shingle of all of them
        mine = hashed[first[i]:first[i] + per[i]]
        at_place[first[i]] = np.append(mine * PLACES[:len(mine)], PLACES[-len(mine)]).sum(dtype=np.uint64)
    h = _mix(at_place)
    n = np.where(per >= shingle, per - shingle + 1, np.minimum(per, 1))
    begin = np.arange(int(n.sum())) + np.repeat(first - (np.cumsum(n) - n), n)
    h = h[begin]
    ends = np.cumsum(n)
    for lo, hi in zip((ends - n).tolist(), ends.tolist()):
        h[lo:hi].sort()
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    new[(ends - n)[n > 0]] = True
    upto = np.concatenate(([0], np.cumsum(new)))
    return Sets(h[new], (upto[ends] - upto[ends - n]).astype(np.int64))


# --------------------------------------------------------------------- prefixes

def allowed_missing(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Tokens that a set may not share with a partner: n - ceil(percent * n / 100)."""
    return n + (-percent * n) // 100


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Index of the first element of the run (of equal keys) that each element is in."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)[np.cumsum(new) - 1] if n else np.zeros(0, np.int64)


def _among(tokens: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which tokens are in the sorted table."""
    out = np.zeros(len(tokens), bool)
    if len(table):
        lead = np.zeros(1 << 16, bool)  # most tokens are ruled out by their first bits
        lead[(table >> np.uint64(48)).astype(np.int64)] = True
        maybe = np.flatnonzero(lead[(tokens >> np.uint64(48)).astype(np.int64)])
        place = np.minimum(np.searchsorted(table, tokens[maybe]), len(table) - 1)
        out[maybe] = table[place] == tokens[maybe]
    return out


def rare_prefix(sets: Sets, classes: Classes, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, tokens) of the single-token prefixes, and the coverage still needed per row."""
    need = np.where(sets.sizes > 0, allowed_missing(sets.sizes, percent) + 1, 0)
    common = np.zeros(len(sets.tokens), bool)
    for tokens in classes.values():
        common |= _among(sets.tokens, tokens)
    rare = np.flatnonzero(~common)
    row = sets.row[rare]
    rank = np.arange(len(rare)) - _starts(row)
    chosen = rare[rank < need[row]]
    return sets.row[chosen], sets.tokens[chosen], need - np.bincount(sets.row[chosen], minlength=len(need))


def _combined(tokens: np.ndarray, run: np.ndarray, k: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Every k-combination inside the runs of consecutive equal ``run``: (last member, members)."""
    n = len(tokens)
    longest = int(np.bincount(run).max()) if n else 0
    out_last, out = [], [[] for _ in range(k)]
    for gaps in combinations(range(1, longest), k - 1):
        at = np.arange(n - gaps[-1] if n > gaps[-1] else 0)
        at = at[run[at] == run[at + gaps[-1]]]
        out_last.append(at + gaps[-1])
        for i, g in enumerate((0, *gaps)):
            out[i].append(tokens[at + g])
    if not out_last:
        return np.zeros(0, np.int64), [np.zeros(0, np.uint64)] * k
    return np.concatenate(out_last), [np.concatenate(o) for o in out]


def combination_signatures(sets: Sets, classes: Classes, need: np.ndarray,
                           percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(rows, signatures) of the frequent classes, for the rows whose rare tokens are not enough."""
    where = {k: np.flatnonzero((need[sets.row] > 0) & _among(sets.tokens, t)) for k, t in classes.items()}
    if not any(len(w) for w in where.values()):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    band = np.frexp(np.maximum(sets.sizes, 1).astype(float))[1] - 1  # 2**band <= n
    lower = percent * sets.sizes < 100 << band                      # a partner may be in the band below
    pieces = []
    for step in (0, 1):
        for k, at in where.items():
            if step:
                at = at[lower[sets.row[at]]]
            b = band[sets.row[at]] - step
            groups = np.maximum(np.left_shift(1, np.maximum(b, 0)) // GROUP_TOKENS[k], 1).astype(np.uint64)
            group = _mix(sets.tokens[at] + (b + 64 * k).astype(np.uint64)) % groups
            pieces.append((sets.row[at] * 2 + step, np.full(len(at), k), group, sets.tokens[at]))
    slot, k_of, group, token = (np.concatenate(p) for p in zip(*pieces))
    order = np.lexsort((token, group, k_of, slot))
    slot, k_of, group, token = slot[order], k_of[order], group[order], token[order]
    place = np.arange(len(token)) - _starts(slot, k_of, group)
    gain = (place >= k_of - 1).astype(np.int64)
    before = np.cumsum(gain) - gain
    before -= before[_starts(slot)]
    kept = before < need[slot >> 1]  # the prefix of each slot ends where its coverage is reached
    slot, k_of, group, token = slot[kept], k_of[kept], group[kept], token[kept]
    rows, sigs = [], []
    for k in classes:
        mine = k_of == k
        s, g, t = slot[mine], group[mine], token[mine]
        last, members = _combined(t, _starts(s, g), k)
        b = (band[s >> 1] - (s & 1))[last]
        h = (b + 64 * k).astype(np.uint64)
        for m in members:
            h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + m)
        rows.append(s[last] >> 1)
        sigs.append(h)
    return np.concatenate(rows), np.concatenate(sigs)


def signatures(sets: Sets, classes: Classes, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(rows, signatures): two sets at or above the threshold share at least one."""
    rows, tokens, need = rare_prefix(sets, classes, percent)
    more_rows, sigs = combination_signatures(sets, classes, need, percent)
    return np.concatenate([rows, more_rows]), np.concatenate([tokens, sigs])


# ------------------------------------------------------------------ Spark stages

def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))


@contextmanager
def bounded_broadcasts(spark: SparkSession) -> Iterator[None]:
    """Small run-time broadcasts while the block runs its jobs, unless the session has a bound of its own.

    The driver gathers, builds and serves each broadcast, several at a time;
    both sides are shuffled when one is chosen, so little is saved by it.
    """
    name = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = spark.conf.get(name, None)
    if before not in (None, ENGINE_CONF[name]):
        yield
        return
    spark.conf.set(name, BROADCAST_BYTES)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _fits(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    return df.limit(rows + 1).count() <= rows


def keyed(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(id, n long, key long) of rows (id, text): the size of the shingle set and its hash."""
    def run(batches):
        for b in batches:
            sets = shingle_sets(b.column(1), shingle)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets.sizes), pa.array(sets.keys)],
                                             names=["id", "n", "key"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, n long, key long")


def _only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` with an id of ``ids`` (one column, distinct), and those without an id."""
    some = docs.where(F.col("id").isNotNull())
    ids = F.broadcast(ids) if _fits(ids) else ids
    return some.join(ids, "id", "left_semi").unionAll(docs.where(F.col("id").isNull()))


def token_classes(docs: DataFrame, shingle: int = SHINGLE_WORDS, percent: int = PERCENT,
                  class_rows=CLASS_ROWS, posted: float = 0) -> Classes:
    """The frequent classes among the (about ``posted``) tokens that prefixes bring into the index."""
    classes: Classes = {k: np.zeros(0, np.uint64) for k, _ in class_rows}
    before: Classes | None = None
    for _ in range(ROUNDS):
        def run(batches, now=classes, old=before):
            for b in batches:
                sets = shingle_sets(b.column(1), shingle)
                row, tokens, _ = rare_prefix(sets, now, percent)
                if old is not None:  # only what the last change of classes brought in
                    seen_row, seen, _ = rare_prefix(sets, old, percent)
                    both = np.concatenate([tokens, seen])
                    who = np.concatenate([row, seen_row])
                    order = np.lexsort((np.arange(len(both)) < len(tokens), both, who))
                    both, who, fresh = both[order], who[order], (np.arange(len(both)) < len(tokens))[order]
                    known = np.zeros(len(both), bool)
                    known[1:] = (both[1:] == both[:-1]) & (who[1:] == who[:-1])
                    tokens = both[fresh & ~known]
                yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64))], names=["token"])

        counted = docs.mapInArrow(run, "token long").groupBy("token").agg(F.count(F.lit(1)).alias("sets"))
        least = min(rows for _, rows in class_rows)
        # the broadcast class tables are bounded: the most frequent tokens of a round
        found = (counted.where(F.col("sets") > least).orderBy(F.desc("sets"), "token").limit(CLASS_TOKENS)
                 .toPandas())
        if not len(found):
            break
        before, classes = classes, dict(classes)
        token, sets_of = found["token"].to_numpy().view(np.uint64), found["sets"].to_numpy()
        bounds = [*class_rows, (0, np.inf)]
        for (k, rows), (_, beyond) in zip(bounds, bounds[1:]):
            classes[k] = np.union1d(classes[k], token[(sets_of > rows) & (sets_of <= beyond)])
        if sum(map(len, classes.values())) >= CLASS_TOKENS or sets_of.sum() < WORTH_A_ROUND * posted:
            break
    return classes


def _collapse(sig: np.ndarray, n: np.ndarray, key: np.ndarray) -> list[np.ndarray]:
    """Postings of one task, one open row per (signature, size band): (spread, sig, n, top, key, hub, several).

    Members that share signature and band with another (sizes within a factor
    of 1.25) are closed: they have a hub, the first of them, and are spread
    over all tasks, as nothing more is asked of them.
    """
    band = np.floor(np.log(n) / np.log(1.25) + 1e-9).astype(np.int64)
    order = np.lexsort((key, n, band, sig))
    sig, n, key, band = sig[order], n[order], key[order], band[order]
    first = _starts(sig, band)
    hub = first == np.arange(len(sig))
    top = np.zeros(len(sig), np.int64)
    np.maximum.at(top, first, n)
    count = np.bincount(first, minlength=len(sig))
    spread = np.where(hub, 0, _mix(key.view(np.uint64)) >> np.uint64(33)).astype(np.int64)
    return [spread, sig, n, np.where(hub, top, 0), key, np.where(hub, 0, key[first]), hub & (count > 1)]


POSTING = "spread long, sig long, size long, key long, hub long, kind int"


def postings(docs: DataFrame, classes: Classes, shingle: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """Signature postings; ``kind`` 0: closed member (has a hub), 1: alone, 2: a hub with members."""
    def run(batches):
        held: list[tuple] = []
        rows = 0

        def flush():
            sig, n, key = (np.concatenate(c) for c in zip(*held))
            spread, sig, n, top, key, hub, several = _collapse(sig, n, key)
            kind = np.where(top == 0, 0, 1 + several).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array(spread), pa.array(sig), pa.array(n << 32 | top), pa.array(key), pa.array(hub, mask=kind > 0),
                 pa.array(kind)], names=["spread", "sig", "size", "key", "hub", "kind"])

        for b in batches:
            sets = shingle_sets(b.column(1), shingle)
            row, sig = signatures(sets, classes, percent)
            held.append((sig.view(np.int64), sets.sizes[row], sets.keys[row]))
            rows += len(row)
            if rows >= FLUSH_POSTINGS:
                yield flush()
                held, rows = [], 0
        if rows:
            yield flush()

    return docs.mapInArrow(run, POSTING)


def members(posted: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(sig, n, key, hub, prev): postings that meet another of fitting size.

    ``hub`` is the first of the size band in the group, ``prev`` the one before
    in size (null where that is the row itself or does not fit).
    """
    def judge(sig, size, key, kind):
        n, top = size >> 32, size & 0xFFFFFFFF
        start, at = _starts(sig), np.arange(len(sig))
        reach = np.maximum.accumulate((start << 32) + top) - (start << 32)  # largest size so far in the group
        before = np.concatenate(([0], reach[:-1]))
        back = (start < at) & (n * percent <= before * 100)
        ahead = np.zeros(len(sig), bool)
        ahead[:-1] = (start[1:] == start[:-1]) & (n[1:] * percent <= top[:-1] * 100)
        near = np.zeros(len(sig), bool)
        near[1:] = (start[1:] == start[:-1]) & (n[1:] * percent <= n[:-1] * 100)
        band = _starts(sig, np.floor(np.log(n) / np.log(100 / percent) + 1e-9).astype(np.int64))
        keep = back | ahead | (kind == 2)
        prev = key[np.maximum(at - 1, 0)]
        return pa.RecordBatch.from_arrays(
            [pa.array(sig[keep]), pa.array(n[keep]), pa.array(key[keep]),
             pa.array(key[band][keep], mask=(key[band] == key)[keep]), pa.array(prev[keep], mask=~near[keep])],
            names=["sig", "n", "key", "hub", "prev"])

    def run(batches):
        held: list[list[np.ndarray]] = []
        rows = 0
        for b in batches:
            cols = [b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2, 4)]
            closed = cols[3] == 0
            if closed.any():
                part = b.filter(pa.array(closed))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(cols[1][closed] >> 32), part.column(2), part.column(3),
                     pa.nulls(part.num_rows, pa.int64())], names=["sig", "n", "key", "hub", "prev"])
            held.append([c[~closed] for c in cols])
            rows += int((~closed).sum())
            if rows < FLUSH_POSTINGS // 8:
                continue
            cols = [np.concatenate(c) for c in zip(*held)]
            cut = int(np.searchsorted(cols[0], cols[0][-1]))  # the last group may go on
            if cut:
                yield judge(*(c[:cut] for c in cols))
            held, rows = [[c[cut:] for c in cols]], rows - cut
        if rows:
            yield judge(*(np.concatenate(c) for c in zip(*held)))

    grouped = (posted.repartition("sig", "spread").sortWithinPartitions("sig", "size", "key")
               .select("sig", "size", "key", "hub", "kind"))
    return grouped.mapInArrow(run, "sig long, n long, key long, hub long, prev long")


# ----------------------------------------------------------------- verification

def bitmaps(sets: Sets) -> list[bytes]:
    """Parity bitmaps: bit (token mod m) counts tokens modulo 2, m the power of two above 2n and up to 4n (64 at least)."""
    bits = np.maximum(4 << np.frexp(np.maximum(sets.sizes, 1).astype(float))[1] - 1, 64).astype(np.int64)
    base = np.cumsum(bits) - bits
    at = base[sets.row] + (sets.tokens & (bits[sets.row] - 1).astype(np.uint64)).astype(np.int64)
    packed = np.packbits(np.bincount(at, minlength=int(bits.sum())) & 1, bitorder="little").tobytes()
    return [packed[b // 8:(b + m) // 8] for b, m in zip(base.tolist(), bits.tolist())]


def distance_bound(a: bytes, b: bytes) -> int:
    """Differing bits of two parity bitmaps, the longer one folded: at most the symmetric difference of the sets."""
    x, y = (np.frombuffer(v, np.uint64) for v in (a, b))
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def sketches(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(key, n, bits) of rows (id, text), one for each set."""
    def run(batches):
        for b in batches:
            sets = shingle_sets(b.column(1), shingle)
            yield pa.RecordBatch.from_arrays([pa.array(sets.keys), pa.array(sets.sizes),
                                              pa.array(bitmaps(sets), pa.binary())], names=["key", "n", "bits"])

    return docs.mapInArrow(run, "key long, n long, bits binary").dropDuplicates(["key"])


def token_sets(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(key, tokens array<long>) of rows (id, text), one for each set."""
    def run(batches):
        for b in batches:
            sets = shingle_sets(b.column(1), shingle)
            lists = pa.ListArray.from_arrays(pa.array(np.append(sets.first, len(sets.tokens)), pa.int32()),
                                             pa.array(sets.tokens.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(sets.keys), lists], names=["key", "tokens"])

    return docs.mapInArrow(run, "key long, tokens array<long>").dropDuplicates(["key"])


def _near(pairs: DataFrame, table: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose bitmaps do not rule out the threshold."""
    def run(batches):
        for batch in batches:
            a, b, na, xa, nb, xb = batch.columns
            total = na.to_numpy(zero_copy_only=False) + nb.to_numpy(zero_copy_only=False)
            shared = -(-percent * total // (100 + percent))  # least intersection of a link
            bound = np.fromiter((distance_bound(x, y) for x, y in zip(xa.to_pylist(), xb.to_pylist())), np.int64,
                                len(total))
            keep = pa.array(bound <= total - 2 * shared)
            yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], names=["a", "b"])

    left, right = (table.select(F.col("key").alias(k), F.col("n").alias(f"n{k}"), F.col("bits").alias(f"x{k}"))
                   for k in "ab")
    both = lookup(lookup(pairs, left, ["a"], "b"), right, ["b"], "a").select("a", "b", "na", "xa", "nb", "xb")
    return both.mapInArrow(run, "a long, b long")


def _linked(pairs: DataFrame, table: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that reach the threshold, by their whole sets."""
    left, right = (table.select(F.col("key").alias(k), F.col("tokens").alias(f"t{k}")) for k in "ab")
    both = lookup(lookup(pairs, left, ["a"], "b"), right, ["b"], "a")
    common = F.size(F.array_intersect("ta", "tb"))
    both = both.select("a", "b", common.alias("common"), (F.size("ta") + F.size("tb")).alias("total"))
    return both.where((100 + percent) * F.col("common") >= percent * F.col("total")).select("a", "b")


def _keys(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()


class Verifier:
    """Checks candidate pairs of set keys; reads the texts of the sets it needs again."""

    def __init__(self, docs: DataFrame, ids: DataFrame, shingle: int, percent: int):
        self.docs, self.ids, self.shingle, self.percent = docs, ids, shingle, percent

    def _docs_of(self, keys: DataFrame) -> DataFrame:
        return _only(self.docs, land(self.ids.join(keys, "key", "left_semi").select("id"), "jaccard-ids"))

    def bits(self, keys: DataFrame) -> DataFrame:
        """Bitmaps (key, n, bits) of the sets with the given keys."""
        return sketches(self._docs_of(keys), self.shingle)

    def near(self, pairs: DataFrame) -> DataFrame:
        """Those of the landed ``pairs`` (a, b) that bitmaps don't rule out."""
        return land(_near(pairs, land(self.bits(_keys(pairs)), "jaccard-bits"), self.percent), "jaccard-near")

    def links(self, near: DataFrame) -> DataFrame:
        """The linked ones of the landed, distinct pairs."""
        if near.isEmpty():
            return near
        sets = land(token_sets(self._docs_of(_keys(near)), self.shingle), "jaccard-sets")
        return land(_linked(near, sets, self.percent), "jaccard-links")


def _ordered(a: str, b: str):
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def _first_pairs(met: DataFrame) -> DataFrame:
    return (met.where("hub IS NOT NULL").select(*_ordered("key", "hub"))
            .union(met.where("prev IS NOT NULL").select(*_ordered("key", "prev"))).where("a <> b").distinct())


def _folded(bits: list[bytes], words: int) -> np.ndarray:
    """Bitmaps as rows of ``words`` uint64 (longer ones are folded, by powers of two)."""
    out = np.empty((len(bits), words), np.uint64)
    for i, v in enumerate(bits):
        x = np.frombuffer(v, np.uint64)
        while len(x) > words:
            x = x[:len(x) // 2] ^ x[len(x) // 2:]
        out[i] = x
    return out


def close_pairs(group: np.ndarray, n: np.ndarray, key: np.ndarray, label: np.ndarray, bits: list[bytes],
                percent: int = PERCENT, nearest: bool = False) -> np.ndarray:
    """Pairs (least key, greatest key) of different labels inside the groups that sizes and bitmaps don't rule out.

    Bitmaps are as long as the band of the set's size demands; each band is
    compared with itself and with the next one, folded to its length.  With
    ``nearest`` only the nearest such partner of each row is returned.
    """
    order = np.lexsort((n, group))
    group, n, key, label = group[order], n[order], key[order], label[order]
    words = np.array([len(bits[i]) for i in order]) // 8
    found = [np.zeros((0, 2), np.int64)]
    best, partner = np.full(len(key), np.inf), np.arange(len(key))
    for w in np.unique(words):
        here = np.flatnonzero((words == w) | (words == 2 * w))
        rows = _folded([bits[order[i]] for i in here], int(w))
        g, m, k, lab, own = group[here], n[here], key[here], label[here], words[here] == w
        start = _starts(g)
        room = np.bincount(start, minlength=len(g))[start] + start - np.arange(len(g))  # rows to the group's end
        i = np.flatnonzero(own)
        for d in range(1, int(room.max(initial=1))):
            i = i[room[i] > d]
            i = i[m[i + d] * percent <= 100 * m[i]]  # sizes grow: once too far, always too far
            if not len(i):
                break
            x = i[lab[i] != lab[i + d]]
            for lo in range(0, len(x), max(1, (1 << 20) // int(w))):
                u = x[lo:lo + max(1, (1 << 20) // int(w))]
                total = m[u] + m[u + d]
                apart = np.bitwise_count(rows[u] ^ rows[u + d]).sum(axis=1, dtype=np.int64)
                close = apart <= total - 2 * -(-percent * total // (100 + percent))
                u, share = u[close], apart[close] / total[close]
                if not nearest:
                    found.append(np.stack([np.minimum(k[u], k[u + d]), np.maximum(k[u], k[u + d])], axis=1))
                    continue
                for one, other in ((here[u], here[u + d]), (here[u + d], here[u])):
                    better = share < best[one]
                    best[one[better]], partner[one[better]] = share[better], other[better]
    if nearest:
        i = np.flatnonzero(partner != np.arange(len(key)))
        j = partner[i]
        found.append(np.stack([np.minimum(key[i], key[j]), np.maximum(key[i], key[j])], axis=1))
    return np.unique(np.concatenate(found), axis=0)


def _mixed(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(sig, n, key, label, blocks): signatures met by several components, of those with the same members one."""
    label = F.coalesce("root", "key").alias("label")
    rows = land(rows.join(labels.withColumnRenamed("node", "key"), "key", "left").select("sig", "n", "key", label)
                .distinct(), "jaccard-labelled")
    whole = (rows.groupBy("sig").agg(F.count(F.lit(1)).alias("rows"), F.min("label").alias("a"), F.max("label").alias("b"),
                                     F.sum(F.xxhash64("key").cast("decimal(38,0)")).alias("members"))
             .where("a <> b"))
    one = land(whole.groupBy("rows", "members").agg(F.min("sig").alias("sig"))
               .select("sig", F.ceil(F.col("rows") / GROUP_ROWS).cast("int").alias("blocks")), "jaccard-mixed")
    return land(lookup(rows, one, ["sig"], "key"), "jaccard-mixed-rows")


def _close(mixed: DataFrame, bits: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """Pairs of different components that share a signature and that sizes and bitmaps don't rule out.

    The members of a signature are compared inside the tasks, by vectorised
    bitmap distances; large groups are cut to hash blocks that are compared
    block against block.  With ``nearest`` a task returns at most one pair for
    each of its rows.
    """
    dealt = (lookup(mixed, bits.select("key", "bits"), ["key"], "sig")
             .withColumn("mine", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("sig", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), "n", "key",
                     "label", "bits"))

    def run(batches):
        held, size = [], 0

        def judge(t: pa.Table):
            sig, lo, hi, n, key, label = (t.column(i).to_numpy().astype(np.int64) for i in range(6))
            pairs = close_pairs(_starts(sig, lo, hi), n, key, label, t.column(6).to_pylist(), percent,
                                nearest)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.nbytes
            if size < 1 << 24:
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            sig, lo, hi = (t.column(i).to_numpy() for i in range(3))
            cut = int(_starts(sig, lo, hi)[-1])  # the last group may go on
            if cut:
                yield judge(t.slice(0, cut))
            rest = t.slice(cut).combine_chunks()
            held, size = rest.to_batches(), 0 if cut else size
        if held:
            yield judge(pa.Table.from_batches(held).combine_chunks())

    grouped = dealt.repartition("sig", "lo", "hi").sortWithinPartitions("sig", "lo", "hi")
    return grouped.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS,
                    percent: int = PERCENT, class_rows=CLASS_ROWS) -> DataFrame:
    """(id_col, n long, component_id): every row with the size of its set and its component's smallest id."""
    arrow_conf(docs.sparkSession)
    with bounded_broadcasts(docs.sparkSession):
        texts = _texts(docs, id_col, text_col)
        marked = land(keyed(texts, shingle), "jaccard-keyed")
        own = land(marked.where("n > 0").groupBy("key").agg(F.min("id").alias("id"), F.min("n").alias("n")),
                   "jaccard-distinct")
        distinct = _only(texts, land(own.where("id IS NOT NULL").select("id").distinct(), "jaccard-first-ids"))

        posted = (own.agg(F.sum("n")).first()[0] or 0) * (100 - percent) / 100  # a prefix has that share of a set
        classes = token_classes(distinct, shingle, percent, class_rows, posted)
        met = land(members(postings(distinct, classes, shingle, percent), percent), "jaccard-members")
        verify = Verifier(texts, own.where("id IS NOT NULL"), shingle, percent)
        pairs = land(_first_pairs(met), "jaccard-pairs")
        edges = verify.links(verify.near(pairs))
        mixed, bits, checked = met.select("sig", "n", "key"), None, pairs
        for nearest in NEAREST_ROUNDS:
            mixed = _mixed(mixed, components(edges))
            bits = bits or land(verify.bits(mixed.select("key").distinct()), "jaccard-bits")
            others = land(_close(mixed, bits, percent, nearest).join(checked, ["a", "b"], "left_anti"), "jaccard-others")
            edges, checked = edges.union(verify.links(others)), checked.union(others)
        rooted = land(own.join(components(edges).withColumnRenamed("node", "key"), "key", "left")
                      .select("key", "id", F.coalesce("root", "key").alias("root")), "jaccard-rooted")
        least = rooted.groupBy("root").agg(F.min("id").alias("component"))
        by_key = land(lookup(rooted, least, ["root"], "key").select("key", "component"), "jaccard-components")
    # runs when the caller's session does: by its hint never as a broadcast of a row for each set
    some = lookup(marked.where("n > 0"), by_key.hint("merge"), ["key"], "id").select("id", "n", "component")
    none = marked.where("n = 0").select("id", "n", F.col("id").alias("component"))
    return some.union(none).toDF(id_col, "n", "component_id")

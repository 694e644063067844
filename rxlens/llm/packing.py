"""Operator 4: cost-balanced packing of token sequences.

Each partition streams its documents, turns them into token ids and packs
blocks of about ``BLOCK_TOKENS`` tokens: no shuffle, and no more than one
block in memory.  Within a block every piece has an estimated cost (linear in
its length plus quadratic attention inside the piece).  Whole multiples of the
sequence length are cut off long documents as sequences of their own; the
remainders, in descending order of cost, go to the sequence of lowest cost
among all with room for them (open sequences are kept by free tokens), or, if
none has, are cut to fill the cheapest one that has any room.
The sequences of a block have exactly the capacity of its tokens: full ones,
and for the rest sequences of power-of-two lengths, so nothing is padded.

Sequence ids are (partition << 40) + a counter.  A task that is run again packs the same
documents into a complete set of sequences by itself.

Chunks of text already seen come from a bounded cache; the ids are those of
encoding the whole text.  The strings of special tokens (``<|endoftext|>``) in
a text are ordinary text, as the description of the vocabulary files has it;
with ``special_tokens=True`` they become the special ids.

Defined results: a null or empty text is one piece holding the end id; null
ids are kept; repeated rows are packed each; an empty table gives no pieces.
"""

from __future__ import annotations

import heapq
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlens.llm.common import arrow_conf

CAPACITY = 2048
END_ID = 1
BLOCK_TOKENS = 1 << 22
LINEAR_COST, QUADRATIC_COST = 1.0, 1.0 / 1024
CACHE_CHUNKS = 150_000


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_ranks(path: str) -> dict[bytes, int] | None:
    """Token bytes -> id of a byte-level BPE file whose ids are its merge ranks; None for any other file."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab, merges = model.get("vocab"), model.get("merges") or []
    if model.get("type") != "BPE":
        return None
    pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
    if any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(pairs)):
        return None
    # byte-level files write each byte as one printable character
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    known = [t for t, i in vocab.items() if i < 256 + len(pairs)]
    if any(c not in byte_of for t in known for c in t):
        return None
    return {bytes(byte_of[c] for c in t): vocab[t] for t in known}


# fixed value: the word pattern of byte-level pre-tokenization
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ChunkEncoder:
    """Token ids of whole texts as little-endian uint32 bytes, by cached chunks.

    A text is cut before single spaces and line ends that stand between other
    characters; a byte-level pre-token begins there in any case.  Texts with
    other white space around a cut are encoded whole.  New chunks are encoded with the
    file's merges as ranks (the same ids, several times as fast), or by the
    tokenizer itself if its ids are not ranks.
    """
    _by_path: dict[tuple[str, bool], ChunkEncoder] = {}

    def __init__(self, path: str, special_tokens: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        self.special: list[str] = []
        if special_tokens:
            self.marking = Tokenizer.from_file(path)
            self.special = [t.content for t in self.marking.get_added_tokens_decoder().values()]
        ranks = _byte_ranks(path)
        if ranks is None:
            self.one = lambda text: self.model.encode(text, add_special_tokens=False).ids
        else:
            import tiktoken
            self.one = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks,
                                         special_tokens={}).encode_ordinary
        self.line_end = self.one("\n")
        self.seen: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.loose: set[str] = set()

    @classmethod
    def of(cls, path: str, special_tokens: bool = False) -> ChunkEncoder:
        key = (path, special_tokens)
        if key not in cls._by_path:
            cls._by_path[key] = cls(path, special_tokens)
        return cls._by_path[key]

    def _bytes(self, text: str) -> bytes:
        return np.array(self.one(text), "<u4").tobytes()

    def _joined(self, texts: list[str]) -> list[bytes]:
        """Ids of texts free of line ends, encoded as the lines of one text."""
        ids = np.array(self.one("\n".join(texts)), "<u4")
        cuts = np.flatnonzero(ids == self.line_end[0]) if len(self.line_end) == 1 else ()
        if len(cuts) != len(texts) - 1:
            return [self._bytes(t) for t in texts]
        data, lo = ids.tobytes(), [0, *(4 * cuts + 4).tolist()]
        return [data[a:b] for a, b in zip(lo, [*(4 * cuts).tolist(), len(data)])]

    def _learn(self, chunks: list[str]) -> None:
        spaced, lines = [], []
        for c in chunks:
            core = c[1:] if c[:1] == "\n" else c
            if not core or core[0].isspace() or core[-1].isspace():
                self.loose.add(c)
                self.seen[c] = b""
            else:
                (lines if c[0] == "\n" else spaced).append(c)
        if spaced:
            self.seen.update(zip(spaced, self._joined([" " + c for c in spaced])))
        if lines:
            end = np.array(self.line_end, "<u4").tobytes()
            self.seen.update((c, end + x) for c, x in zip(lines, self._joined([c[1:] for c in lines])))

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """uint32 ids of each text, with the end id."""
        if len(self.seen) > CACHE_CHUNKS:  # two generations: what is in use moves to the new one
            self.older, self.seen = self.seen, {}
            self.loose = {c for c in self.loose if c in self.older}
        texts = pc.fill_null(texts.cast(pa.string()), "")
        # each text becomes a line of its own: the first chunk is encoded as one at the start of a line
        lined = pc.replace_substring(pc.binary_join_element_wise("\n", texts, ""), "\n", " \n")
        lists = pc.split_pattern(lined, " ")
        enc = lists.flatten().dictionary_encode()
        code = enc.indices.to_numpy(zero_copy_only=False)
        chunks = enc.dictionary.to_pylist()
        seen, older = self.seen, self.older
        new = []
        for c in chunks:
            if c not in seen:
                if c in older:
                    seen[c] = older[c]
                else:
                    new.append(c)
        for lo in range(0, len(new), 4096):
            self._learn(new[lo:lo + 4096])
        ids = [seen[c] for c in chunks]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        pool = np.frombuffer(b"".join(ids), "<u4")
        first = np.cumsum(size) - size
        per = size[code]
        before = np.cumsum(per) - per
        flat = pool[np.repeat(first[code] - before, per) + np.arange(int(per.sum()))]
        n_chunks = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        last = np.cumsum(n_chunks) - 1
        ends = before[last] + per[last]
        starts = np.concatenate(([0], ends[:-1]))
        # drop the line end before each text, put the end id behind it
        moved = np.empty_like(flat)
        moved[:-1] = flat[1:]
        filled = ends > starts
        moved[ends[filled] - 1] = END_ID
        whole = np.zeros(len(n_chunks), bool)
        if self.loose:
            odd = np.fromiter((c in self.loose for c in chunks), bool, len(chunks)) & (np.array(chunks) != "")
            whole[np.repeat(np.arange(len(n_chunks)), n_chunks)[odd[code]]] = True
            # an empty chunk is a text's first one, or stands between two spaces
            empty = np.bincount(np.repeat(np.arange(len(n_chunks)), n_chunks)[(np.array(chunks) == "")[code]],
                                minlength=len(n_chunks))
            whole |= empty > 1
        out = [np.array([*self.one(texts[i].as_py()), END_ID], "<u4") if whole[i] else moved[a:b]
               for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist()))]
        marked = np.zeros(len(out), bool)
        for content in self.special:
            marked |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(marked):
            out[i] = np.array([*self.marking.encode(texts[i].as_py(), add_special_tokens=False).ids, END_ID], "<u4")
        return out


def capacities(tokens: int, capacity: int = CAPACITY) -> list[int]:
    """Full sequences, then power-of-two lengths for the rest."""
    rest = tokens % capacity
    return [capacity] * (tokens // capacity) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def cost(length: int) -> float:
    return LINEAR_COST * length + QUADRATIC_COST * length * length


def pack(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents of the given lengths."""
    pieces, tails, n = [], [], 0
    for d, total in enumerate(lengths):
        whole = total // capacity
        for k in range(whole):
            pieces.append((d, k * capacity, capacity, n, 0))
            n += 1
        if total % capacity:
            tails.append((total % capacity, d, whole * capacity))
    room = capacities(sum(t[0] for t in tails), capacity)
    used = [0] * len(room)
    # the open sequences by their free tokens: a heap of (cost, sequence) each, and the least cost of each heap
    free: list[list[tuple[float, int]]] = [[] for _ in range(capacity + 1)]
    for i, size in enumerate(room):
        free[size].append((0.0, i))
    least = np.array([h[0][0] if h else np.inf for h in free])
    tails.sort(key=lambda t: (-t[0], t[1]))
    for length, d, start in tails:
        while length:
            at = length + int(least[length:].argmin())
            if least[at] == np.inf:  # none has room for all of it
                at = 1 + int(least[1:].argmin())
            spent, i = heapq.heappop(free[at])
            least[at] = free[at][0][0] if free[at] else np.inf
            part = min(length, at)
            pieces.append((d, start, part, n + i, used[i]))
            used[i] += part
            if part < at:
                heapq.heappush(free[at - part], (spent + cost(part), i))
                least[at - part] = free[at - part][0][0]
            start, length = start + part, length - part
    return pieces


SCHEMA = "start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
                   capacity: int = CAPACITY, block_tokens: int = BLOCK_TOKENS,
                   special_tokens: bool = False) -> DataFrame:
    """One row per piece: id, start, length, doc_tokens, sequence_id, offset, ids (uint32, little-endian)."""
    arrow_conf(docs.sparkSession)
    path = vocabulary or default_vocabulary()
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder.of(path, special_tokens)
        sequence = TaskContext.get().partitionId() << 40
        keys, ids, held = [], [], 0

        def emit():
            nonlocal sequence
            sizes = [len(x) for x in ids]
            found = pack(sizes, capacity)
            used = max(p[3] for p in found) + 1
            key = pa.concat_arrays(keys)
            for lo in range(0, len(found), 5000):
                d, start, length, seq, offset = (np.array(c, np.int64) for c in zip(*found[lo:lo + 5000]))
                yield pa.RecordBatch.from_arrays(
                    [key.take(pa.array(d)), pa.array(start), pa.array(length), pa.array(np.array(sizes, np.int64)[d]),
                     pa.array(seq + sequence), pa.array(offset),
                     pa.array([ids[i][a:a + n].tobytes() for i, a, n in zip(d, start, length)], pa.binary())],
                    names=[id_col, "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
            sequence += used
            keys.clear()
            ids.clear()

        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                new = encoder.encode(part.column(1))
                keys.append(part.column(0))
                ids.extend(new)
                held += sum(map(len, new))
                if held >= block_tokens:
                    yield from emit()
                    held = 0
        if ids:
            yield from emit()

    narrow = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    return narrow.mapInArrow(run, f"`{id_col}` {kind}, {SCHEMA}")

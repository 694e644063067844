"""Jaro-Winkler name similarity (C9) as an Arrow-batched pandas UDF.

Spark has no Jaro-Winkler builtin, so the score is the one place where the
engine drops to Python.  The kernel is vectorised with numpy *across the pairs
of an Arrow batch*: the Python-level loop runs over character positions (a
few dozen), never over rows.

Variant (fixed values that must agree with the oracle):
  * Jaro: match window ``max(len_a, len_b) // 2 - 1`` (floored at 0), greedy
    left-to-right matching, half the out-of-order matches are transpositions
    (integer halving); an empty operand scores 0.
  * Winkler: prefix boost ``0.1`` per common leading character, at most ``4``
    characters, applied only when the Jaro score is above ``0.7``.

``may_reach`` gives a *lossless* prefilter that Spark evaluates
natively before any pair reaches Python: at most ``min(len)`` characters can
match, so ``jaro <= (2 + min/max) / 3`` and ``jw <= 0.4 + 0.6 * jaro``.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

# The scorer is the only code that runs in Python workers; shipping this
# module's functions by value lets executors run it without the package
# being installed or on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the scoring variant.
WINKLER_THRESHOLD = 0.7
WINKLER_SCALE = 0.1
WINKLER_MAX_PREFIX = 4

# Scores are compared after rounding to this many digits, on both the Spark
# and the SQL oracle side, so the last floating-point bit never decides.
SCORE_DIGITS = 9

# Cells (pairs x longest name x longest name) compared at once: bounds the
# memory of a chunk whatever the lengths of its names.
_CHUNK_CELLS = 8_000_000

# Scores already computed for this task's batches.  The score is a pure
# function of the two names, so the memo is exact; it is cleared when it
# reaches the cap, bounding memory.
_MEMO: dict[tuple[str, str], float] = {}
_MEMO_CAP = 500_000


def jaro_winkler_scalar(a: str | None, b: str | None) -> float | None:
    """Plain-Python reference implementation (tests and tiny inputs)."""
    if a is None or b is None:
        return None
    la, lb = len(a), len(b)
    if la == 0 or lb == 0:
        return 0.0
    window = max(max(la, lb) // 2 - 1, 0)
    used_b = [False] * lb
    matched_a = [False] * la
    m = 0
    for i, ch in enumerate(a):
        for j in range(max(0, i - window), min(lb, i + window + 1)):
            if not used_b[j] and b[j] == ch:
                used_b[j] = matched_a[i] = True
                m += 1
                break
    if m == 0:
        return 0.0
    seq_a = [a[i] for i in range(la) if matched_a[i]]
    seq_b = [b[j] for j in range(lb) if used_b[j]]
    half_t = sum(x != y for x, y in zip(seq_a, seq_b)) // 2
    sim = (m / la + m / lb + (m - half_t) / m) / 3.0
    if sim > WINKLER_THRESHOLD:
        prefix = 0
        for x, y in zip(a[:WINKLER_MAX_PREFIX], b[:WINKLER_MAX_PREFIX]):
            if x != y:
                break
            prefix += 1
        sim += prefix * WINKLER_SCALE * (1.0 - sim)
    return sim


def _codes(values: list[str], width: int) -> np.ndarray:
    """Fixed-width UTF-32 code points, zero padded, shape (n, width)."""
    arr = np.array(values, dtype=f"<U{max(width, 1)}")
    return arr.view(np.uint32).reshape(len(values), max(width, 1))


def _jw_chunk(a_list: list[str], b_list: list[str]) -> np.ndarray:
    n = len(a_list)
    la = np.fromiter((len(s) for s in a_list), dtype=np.int64, count=n)
    lb = np.fromiter((len(s) for s in b_list), dtype=np.int64, count=n)
    wa, wb = int(la.max(initial=0)), int(lb.max(initial=0))
    A = _codes(a_list, wa)
    B = _codes(b_list, wb)
    wa, wb = A.shape[1], B.shape[1]
    window = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    ia = np.arange(wa)
    jb = np.arange(wb)
    # candidate[r, i, j]: a[i] may match b[j] (equal, inside window, real chars)
    cand = A[:, :, None] == B[:, None, :]
    cand &= (ia[None, :] < la[:, None])[:, :, None]
    cand &= (jb[None, :] < lb[:, None])[:, None, :]
    cand &= np.abs(ia[:, None] - jb[None, :])[None, :, :] <= window[:, None, None]
    used_b = np.zeros((n, wb), dtype=bool)
    matched_a = np.zeros((n, wa), dtype=bool)
    rows = np.arange(n)
    for i in range(wa):
        free = cand[:, i, :] & ~used_b
        hit = free.any(axis=1)
        if not hit.any():
            continue
        first = free.argmax(axis=1)
        used_b[rows[hit], first[hit]] = True
        matched_a[:, i] = hit
    m = matched_a.sum(axis=1)
    # matched characters in order on each side, compared position by position
    ord_a = np.argsort(~matched_a, axis=1, kind="stable")
    ord_b = np.argsort(~used_b, axis=1, kind="stable")
    k = min(wa, wb)
    seq_a = np.take_along_axis(A, ord_a, axis=1)[:, :k]
    seq_b = np.take_along_axis(B, ord_b, axis=1)[:, :k]
    live = np.arange(k)[None, :] < m[:, None]
    half_t = ((seq_a != seq_b) & live).sum(axis=1) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        sim = (m / la + m / lb + (m - half_t) / m) / 3.0
    sim = np.where((m == 0) | (la == 0) | (lb == 0), 0.0, sim)
    p = min(WINKLER_MAX_PREFIX, wa, wb)
    same = (A[:, :p] == B[:, :p]) & (np.arange(p)[None, :] < np.minimum(la, lb)[:, None])
    prefix = np.cumprod(same, axis=1).sum(axis=1)
    boosted = sim + prefix * WINKLER_SCALE * (1.0 - sim)
    return np.where(sim > WINKLER_THRESHOLD, boosted, sim)


def _score_distinct(a: list[str], b: list[str]) -> np.ndarray:
    """Scores of distinct pairs, in chunks of pairs of like length."""
    size = np.fromiter((max(len(x), len(y), 1) for x, y in zip(a, b)), dtype=np.int64, count=len(a))
    order = np.argsort(size, kind="stable")
    out = np.empty(len(a))
    start = 0
    while start < len(order):
        # the widest pair of a chunk is its last: grow it while the cells fit
        width = size[order[start:]]
        fits = np.arange(1, len(width) + 1) * width * width <= _CHUNK_CELLS
        count = max(1, len(fits) if fits.all() else int(fits.argmin()))
        rows = order[start:start + count]
        if count == 1 and size[rows[0]] ** 2 > _CHUNK_CELLS:
            out[rows] = jaro_winkler_scalar(a[rows[0]], b[rows[0]])
        else:
            out[rows] = _jw_chunk([a[r] for r in rows], [b[r] for r in rows])
        start += count
    return out


def jaro_winkler_batch(a: pd.Series, b: pd.Series) -> pd.Series:
    """Vectorised score of aligned string Series; null in, null out.

    Pairs repeat heavily (one patient, many prescriptions; a small name
    vocabulary), so each distinct (a, b) of the batch is scored once, looked
    up first in the memo of earlier batches, and fanned back out.
    """
    out = np.full(len(a), np.nan)
    ok = (a.notna() & b.notna()).to_numpy()
    idx = np.flatnonzero(ok)
    if len(idx) == 0:
        return pd.Series(out, index=a.index)
    av = a.to_numpy(dtype=object)[idx]
    bv = b.to_numpy(dtype=object)[idx]
    code_a, names_a = pd.factorize(av)
    code_b, names_b = pd.factorize(bv)
    _, first, codes = np.unique(code_a * len(names_b) + code_b, return_index=True, return_inverse=True)
    keys = list(zip(av[first], bv[first]))
    scores = np.fromiter((_MEMO.get(k, np.nan) for k in keys), dtype=float, count=len(keys))
    todo = np.flatnonzero(np.isnan(scores))
    if len(todo):
        ua, ub = av[first[todo]], bv[first[todo]]
        fresh = _score_distinct([str(x) for x in ua], [str(x) for x in ub])
        scores[todo] = fresh
        if len(_MEMO) + len(todo) > _MEMO_CAP:
            _MEMO.clear()
        _MEMO.update((keys[t], f) for t, f in zip(todo, fresh))
    out[idx] = scores[codes]
    return pd.Series(out, index=a.index)


def _score(a: pd.Series, b: pd.Series) -> pd.Series:
    return jaro_winkler_batch(a, b)


# Marked non-deterministic for the optimizer only (the score is a pure
# function): otherwise a threshold filter on the score is pushed below the
# projection that computes it and the Python scorer runs twice per row.
_jaro_winkler_udf = pandas_udf(_score, DoubleType()).asNondeterministic()


def jaro_winkler(a: Column, b: Column) -> Column:
    """Spark column function: Jaro-Winkler similarity of ``a`` and ``b``.

    Identical non-empty strings score 1.0 natively; only the other pairs
    are shipped to Python (the identical ones are sent as nulls, which the
    UDF skips), since Spark evaluates a UDF on every row of its input.
    """
    same = (a == b) & (F.length(a) > 0)
    raw = _jaro_winkler_udf(F.when(~same, a), F.when(~same, b))
    return F.when(same, F.lit(1.0)).otherwise(raw)


def required_jaro(threshold: float | Column) -> Column:
    """Smallest Jaro score that can still reach ``threshold`` after Winkler."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    boosted_floor = F.greatest(F.lit(WINKLER_THRESHOLD),
                               (t - WINKLER_MAX_PREFIX * WINKLER_SCALE)
                               / (1.0 - WINKLER_MAX_PREFIX * WINKLER_SCALE))
    return F.when(t <= WINKLER_THRESHOLD, t).otherwise(boosted_floor)


def may_reach(a: Column, b: Column, threshold: float | Column) -> Column:
    """Native, lossless necessary condition for ``jw(a, b) >= threshold``.

    ``jaro <= (2 + short/long) / 3`` so the length ratio must be at least
    ``3 * required_jaro - 2``; written multiplicatively (no division).
    """
    la, lb = F.length(a), F.length(b)
    short, long_ = F.least(la, lb), F.greatest(la, lb)
    ratio_floor = F.lit(3.0) * required_jaro(threshold) - F.lit(2.0)
    return short >= ratio_floor * long_ - F.lit(1e-9) * long_


# Fixed values of the name signature: one presence bit per symbol, then one
# bit for "any other character".
SIGNATURE_SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ "


def name_signature(c: Column) -> Column:
    """Character-presence bitmask of a name, computed natively once per row
    (substring tests, no string building).  Used by ``may_reach_sig``."""
    sig = F.lit(0).cast("long")
    for k, ch in enumerate(SIGNATURE_SYMBOLS):
        sig = sig + F.when(c.contains(ch), F.lit(1 << k)).otherwise(F.lit(0)).cast("long")
    # any character outside the symbols
    other = F.length(F.translate(c, SIGNATURE_SYMBOLS, "")) > 0
    sig = sig + F.when(other, F.lit(1 << len(SIGNATURE_SYMBOLS))).otherwise(F.lit(0)).cast("long")
    return sig


def may_reach_sig(a: Column, b: Column, sig_a: Column, sig_b: Column, threshold: float | Column) -> Column:
    """Native, lossless necessary condition for ``jw(a, b) >= threshold``,
    tighter than ``may_reach``: each symbol of ``a`` that never occurs in
    ``b`` leaves at least one character of ``a`` unmatched, so
    ``m <= M = min(len_a - |sym(a) - sym(b)|, len_b - |sym(b) - sym(a)|)``
    and ``jaro <= (M/len_a + M/len_b + 1) / 3``.
    """
    la, lb = F.length(a).cast("double"), F.length(b).cast("double")
    absent_a = F.bit_count(sig_a.bitwiseAND(F.bitwise_not(sig_b)))
    absent_b = F.bit_count(sig_b.bitwiseAND(F.bitwise_not(sig_a)))
    m = F.least(la - absent_a, lb - absent_b)
    r = required_jaro(threshold)
    lhs = m * lb + m * la + la * lb
    rhs = F.lit(3.0) * r * la * lb - F.lit(1e-9) * la * lb
    return (la == 0) | (lb == 0) | (lhs >= rhs)


def passes(score: Column, threshold: float | Column) -> Column:
    """``round(score, 9) >= threshold`` (same test as the SQL oracle)."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.round(score, SCORE_DIGITS) >= t

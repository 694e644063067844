"""Operator 5 [native]: personal data, base patterns plus bootstrapped contexts.

Base kinds (email, ip, card, phone) are found by regular expressions with
code-point spans: ``regexp_extract_all`` gives the matches, ``split`` by the
same expression the text between them, and their lengths the positions.

Bootstrapping: identifier-like tokens (eight characters or more, four digits
or more) are instances, the up to three chunks of text before them, and the
shorter suffixes of these, are lexical patterns.  Seed instances are those that
overlap a base span anywhere, and long hexadecimal keys.  Over the graph of
distinct (pattern, instance) pairs Spark scores in turns: a pattern by the mean
score of its distinct instances (one pseudo-instance of score 0 added), an
instance that is no seed by its best promoted pattern.  Each round promotes
patterns with a score of ``MIN_SCORE`` or more over at least ``MIN_SEEDS``
instances that are seeds or were found by a promoted pattern, so what one
pattern finds is evidence for the next.  All of these are kept.  No score ever
falls, and rounds go on until none can add a pattern: the promoted set is the
same as before and would be so if every found instance scored 1, or no score
has changed in its first six digits.  Every token after a promoted pattern
becomes a span of kind ``id``, as do the hexadecimal seeds.  Up to
``LITERAL_PATTERNS`` counted patterns are a literal of the last pass, up to
``BROADCAST_PATTERNS`` a broadcast; beyond, mentions and patterns are shuffled,
every pattern salted.

Defined results: a null or empty text has no spans; null ids are kept; spans
of different kinds may overlap; a discovered token that overlaps a base span
adds nothing; repeated rows repeat; an empty table promotes no pattern.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxlens.llm.common import land, once, text_or_empty

KINDS = ("email", "ip", "card", "phone", "id")
# The expressions of the base kinds, guarded so that a long run of word or
# digit characters is scanned once (possessive, and started only at its start).
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BYTE = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})$"
TOKEN = r"(?<![A-Za-z0-9_./+=@:-])[A-Za-z_./+=@:-]*+[0-9](?:[A-Za-z0-9_./+=@:-]*[A-Za-z0-9=])?"
SECRET = r"^[0-9a-fA-F]{32,}$"
CONTEXT_CHARS = 48
CONTEXT = r"((?:\S+\s+){0,2}\S*)$"
MIN_SEEDS, MIN_SCORE = 5, 0.9
# positions are summed, and texts cut, in blocks of these sizes
SCAN_BLOCK, CUT_CHARS = 128, 4096
# how patterns reach the mentions, by their counted number
LITERAL_PATTERNS, BROADCAST_PATTERNS, SALTS = 1000, 100_000, 16


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def add(total, i):
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = F.substring(F.lit("0246813579"), d + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: p.rlike(BYTE))
    if kind == "card":
        return _let(_digits(m), lambda d: F.when(F.length(d).between(13, 19), _luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


def _located(text: Column, pattern: str, extra=None) -> Column:
    """Array of (value, start, end[, context]) of all matches, in order."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def place(matches):
        kind = "array<struct<value:string,start:int,end:int" + (",context:string>>" if extra else ">>")

        def located(gaps):
            # a match starts after the gaps up to it and the matches before it
            moves = F.transform(matches, lambda m, i: F.length(gaps[i]) + F.when(
                i > 0, F.length(matches[F.greatest(i - 1, F.lit(0))])).otherwise(0))

            def fields(starts, m, i):
                out = [m.alias("value"), starts[i].alias("start"), (starts[i] + F.length(m)).alias("end")]
                return F.struct(*out, *([] if extra is None else [extra(gaps[i]).alias("context")]))

            return _let(_running(moves, lambda a, b: a + b),
                        lambda starts: F.transform(matches, lambda m, i: fields(starts, m, i)))

        return F.when(F.size(matches) > 0, _let(F.split(text, pattern, -1), located)).otherwise(F.array().cast(kind))

    return _let(found, place)


def _later(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _running(values: Column, step) -> Column:
    """Running totals under ``step`` (a sum or greatest, from 0) of an int array.

    ``aggregate`` copies its state at every element, so totals are built in
    blocks of ``SCAN_BLOCK`` and the blocks' own totals carried between them.
    """
    def build(items, first):
        return F.aggregate(items, F.array(first), lambda acc, x: F.array_append(
            acc, step(F.element_at(acc, -1), x)))

    def over(items):
        n_blocks = F.floor((F.size(items) + SCAN_BLOCK - 1) / SCAN_BLOCK).cast("int")
        cut = F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda k: F.slice(
            items, k * SCAN_BLOCK + 1, F.lit(SCAN_BLOCK)))

        def carried(blocks):
            totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), step))
            return _let(build(totals, F.lit(0)), lambda before: F.flatten(F.transform(
                blocks, lambda b, k: F.slice(build(b, before[k]), F.lit(2), F.size(b)))))

        return F.when(F.size(items) > 0, _let(cut, carried)).otherwise(F.array().cast("array<int>"))

    return _let(values, over)


def base_spans(text: Column) -> dict[str, Column]:
    """kind -> array of (value, start, end) of the valid matches."""
    gate = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}
    out = {}
    for kind, pattern in PATTERNS.items():
        spans = _filtered(kind, _located(text, pattern))
        out[kind] = F.when(gate[kind], spans).otherwise(F.array().cast("array<struct<value:string,start:int,end:int>>")) \
            if kind in gate else spans
    return out


def _filtered(kind: str, spans: Column) -> Column:
    return F.filter(spans, lambda s: _valid(kind, s["value"]))


def _context(gap: Column) -> Column:
    tail = F.regexp_extract(F.right(gap, F.lit(CONTEXT_CHARS)), CONTEXT, 1)
    return F.lower(F.regexp_replace(tail, r"\s+", " "))


def _mentions(text: Column) -> Column:
    """Identifier-like tokens with the lexical pattern before them."""
    found = _located(text, TOKEN, _context)
    return F.when(text.rlike("[0-9]"), F.filter(found, lambda s: (F.length(s["value"]) >= 8) & (
        F.length(_digits(s["value"])) >= 4))).otherwise(
            F.array().cast("array<struct<value:string,start:int,end:int,context:string>>"))


def find(docs: DataFrame, text: str = "text", into: str = "pii") -> DataFrame:
    """``docs`` with a struct column ``into``: base (kind, start, end) and mentions (value, start, end, context, seed).

    Mentions that overlap a base span are seeds; they and the hexadecimal keys carry ``seed``.
    """
    t = text_or_empty(text)
    staged = docs
    for kind, spans in base_spans(t).items():
        staged = staged.withColumn(f"_op5_{kind}", spans)
    base = F.concat(*[F.transform(F.col(f"_op5_{k}"), _typed(i)) for i, k in enumerate(PATTERNS)])
    staged = once(staged.withColumn("_op5_tokens", _mentions(t)), "_op5_found",
                  F.struct(base.alias("base"), F.col("_op5_tokens").alias("tokens")))
    staged = staged.drop("_op5_tokens", *[f"_op5_{k}" for k in PATTERNS])

    def flag(m, inside):
        return F.struct(m["value"].alias("value"), m["start"].alias("start"), m["end"].alias("end"),
                        m["context"].alias("context"), inside.alias("inside"),
                        (inside | m["value"].rlike(SECRET)).alias("seed"))

    flagged = _let(_touched(F.col("_op5_found.tokens"), F.col("_op5_found.base")), lambda inside: F.transform(
        "_op5_found.tokens", lambda m, i: flag(m, inside[i])))
    return once(staged, into, F.struct(F.col("_op5_found.base").alias("base"),
                                       flagged.alias("mentions"))).drop("_op5_found")


def _touched(tokens: Column, base: Column) -> Column:
    """Of each token (in order, disjoint): does it overlap a base span?

    The furthest end of the base spans that start before the token's end lies
    behind its start.  Tokens (at their ends) and base spans (at their starts)
    are sorted into one list, whose running greatest end answers for all.
    """
    def event(at, order, end, start):
        return F.struct(at.alias("at"), F.lit(order).alias("order"), end.alias("end"), start.alias("start"))

    asked = F.transform(tokens, lambda m: event(m["end"], 0, F.lit(0), m["start"]))
    held = F.transform(base, lambda s: event(s["start"], 1, s["end"], F.lit(0)))

    def answer(events):
        return _let(_running(F.transform(events, lambda e: e["end"]), _later), lambda ends: F.transform(
            F.filter(F.arrays_zip(events.alias("e"), ends.alias("far")), lambda x: x["e"]["order"] == 0),
            lambda x: x["far"] > x["e"]["start"]))

    return F.when(F.size(base) > 0, _let(F.sort_array(F.concat(asked, held)), answer)).otherwise(
        F.transform(tokens, lambda m: F.lit(False)))


def _typed(order: int):
    return lambda s: F.struct(F.lit(order).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))


def _suffixes(context: Column) -> Column:
    """The context and its suffixes of fewer chunks, without blank ones."""
    shorter = [F.regexp_replace(context, p, "") for p in (r"^\S+ ", r"^\S+ \S+ ")]
    return F.array_distinct(F.filter(F.array(context, *shorter), lambda s: s.rlike(r"\S")))


def _with_patterns(rows: DataFrame, patterns: DataFrame, n: int, spread: list[str],
                   broadcast_patterns: int = BROADCAST_PATTERNS) -> DataFrame:
    """Inner join on ``pattern`` with ``n`` distinct patterns; a shuffled hot pattern is spread by ``spread``."""
    if n <= broadcast_patterns:
        return rows.join(F.broadcast(patterns), "pattern")
    salt = F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int")
    copies = patterns.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", salt).join(copies, ["pattern", "_salt"]).drop("_salt")


def promote(found: DataFrame, into: str = "pii", min_seeds: int = MIN_SEEDS, min_score: float = MIN_SCORE,
            broadcast_patterns: int = BROADCAST_PATTERNS) -> DataFrame:
    """(pattern, score): all promoted lexical patterns."""
    pairs = (found.select(F.explode(f"{into}.mentions").alias("m"))
             .select(F.explode(_suffixes(F.col("m.context"))).alias("pattern"),
                     F.xxhash64("m.value").alias("instance"), F.col("m.seed").alias("seed"))
             .groupBy("pattern", "instance").agg(F.max("seed").alias("seed")))
    pairs = land(pairs, "pii-pairs")
    # too few instances for the threshold even if every one scored 1: no round can change that
    able = land(pairs.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).where(
        (F.col("n") >= min_seeds) & (F.round(F.col("n") / (F.col("n") + 1), 9) >= min_score)).select("pattern"),
        "pii-able")
    seeds = pairs.where("seed").select("instance").distinct().withColumn("any_seed", F.lit(True))
    graph = _with_patterns(pairs.select("pattern", "instance"), able, able.count(), ["instance"], broadcast_patterns)
    graph = land(graph.join(seeds, "instance", "left")
                 .select("pattern", "instance", F.coalesce("any_seed", F.lit(False)).alias("seed")), "pii-graph")
    scored = graph.withColumn("x", F.col("seed").cast("double"))
    before = (0, 0)
    while True:
        # score: of the round; bound: if every instance that is a seed or found scored 1
        rank = (scored.groupBy("pattern").agg(F.sum("x").alias("sum"), F.count(F.lit(1)).alias("n"),
                                              F.count_if(F.col("x") > 0).alias("evidence"))
                .where((F.col("evidence") >= min_seeds)
                       & (F.round(F.col("evidence") / (F.col("n") + 1), 9) >= min_score))
                .select("pattern", F.round(F.col("sum") / (F.col("n") + 1), 9).alias("score")))
        rank = land(rank, "pii-rank")
        promoted = rank.where(F.col("score") >= min_score)
        n, digits = promoted.agg(F.count(F.lit(1)), F.coalesce(
            F.sum(F.floor(F.col("score") * 1_000_000)), F.lit(0))).first()
        if n == before[0] and (digits == before[1] or rank.count() == n):
            return promoted
        before = (n, digits)
        best = (_with_patterns(graph.where("NOT seed"), promoted, n, ["instance"], broadcast_patterns)
                .groupBy("instance").agg(F.max("score").alias("best")))
        scored = graph.join(land(best, "pii-best"), "instance", "left").withColumn(
            "x", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("best", F.lit(0.0))))


def learn(found: DataFrame, into: str = "pii", **options) -> list[str]:
    """The promoted lexical patterns as a list, for small tables."""
    return [r["pattern"] for r in promote(found, into, **options).collect()]


def all_spans(found_here, into: str = "pii") -> Column:
    """Array of (kind, start, end): base spans by kind and start, then the discovered ones by start.

    ``found_here`` tells of a mention whether a promoted pattern precedes it.
    """
    new = F.filter(F.col(f"{into}.mentions"), lambda m: ~m["inside"] & (m["seed"] | found_here(m)))
    return F.concat(F.col(f"{into}.base"), F.transform(new, _typed(KINDS.index("id"))))


def with_spans(found: DataFrame, patterns: DataFrame, into: str = "pii", name: str = "spans",
               literal_patterns: int = LITERAL_PATTERNS,
               broadcast_patterns: int = BROADCAST_PATTERNS) -> DataFrame:
    """``found`` with a column ``name`` of all spans; ``patterns`` are those of ``promote``."""
    n = patterns.count()
    if n <= literal_patterns:
        known = [F.lit(r["pattern"]) for r in patterns.select("pattern").collect()]
        known = F.array(*known) if known else F.array().cast("array<string>")
        return once(found, name, all_spans(lambda m: F.arrays_overlap(_suffixes(m["context"]), known), into))
    # too many for a literal: mentions meet the patterns by their suffixes, a row's finds come back by its number
    rows = land(found.withColumn("_op5_row", F.monotonically_increasing_id()), "pii-rows")
    asked = (rows.select("_op5_row", F.explode(f"{into}.mentions").alias("m")).where("NOT m.inside AND NOT m.seed")
             .select("_op5_row", F.col("m.start").alias("start"), F.explode(_suffixes(F.col("m.context")))
                     .alias("pattern")))
    met = _with_patterns(asked, patterns.select("pattern"), n, ["_op5_row", "start"], broadcast_patterns)
    starts = met.groupBy("_op5_row").agg(F.collect_set("start").alias("_op5_starts"))
    joined = rows.join(starts, "_op5_row", "left").withColumn(
        "_op5_starts", F.coalesce("_op5_starts", F.array().cast("array<int>")))
    return once(joined, name, all_spans(lambda m: F.array_contains(F.col("_op5_starts"), m["start"]), into)).drop(
        "_op5_row", "_op5_starts")


def span_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def redact(text: Column, spans: Column) -> Column:
    """``text`` with every span, or run of overlapping spans, replaced by its first kind in brackets."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))

    def cut(parts, a, b):
        """Characters a to b: the text is in parts of CUT_CHARS, of which only the first and last are searched."""
        p, q = (F.floor(x / CUT_CHARS).cast("int") for x in (a, b))
        inside = F.substring(F.coalesce(F.get(parts, p), F.lit("")), a - p * CUT_CHARS + 1, b - a)
        across = F.concat(F.substring(F.get(parts, p), a - p * CUT_CHARS + 1, F.lit(CUT_CHARS)),
                          F.array_join(F.slice(parts, p + 2, F.greatest(q - p - 1, F.lit(0))), ""),
                          F.substring(F.coalesce(F.get(parts, q), F.lit("")), F.lit(1), b - q * CUT_CHARS))
        return F.when(p == q, inside).otherwise(across)

    def joined(parts, marks, ends):
        # before[i]: the furthest end of the spans before i; a span that starts behind it opens a run
        def piece(s, i):
            before = F.when(i > 0, ends[F.greatest(i - 1, F.lit(0))]).otherwise(0)
            return F.when(s["start"] >= before, F.concat(cut(parts, before, s["start"]), names[s["kind"]])).otherwise("")

        return F.concat(F.array_join(F.transform(marks, piece), ""),
                        cut(parts, F.element_at(ends, -1), F.length(text)))

    done = _let(ordered, lambda marks: _let(
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CUT_CHARS}}}"), F.lit(0)), lambda parts: _let(
            _running(F.transform(marks, lambda s: s["end"]), _later), lambda ends: joined(parts, marks, ends))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def redact_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the spans replaced in their texts (``n_chars`` follows); null texts stay null."""
    patterns = promote(find(docs.select("text")), **options)
    out = with_spans(find(docs, into="_op5_pii"), patterns, "_op5_pii", "_op5_spans")
    out = once(out, "_op5_text", redact(F.col("text"), F.col("_op5_spans")))
    columns = {"text": F.col("_op5_text")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(F.size("_op5_spans") > 0, F.length("_op5_text")) \
            .otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.withColumns(columns).select(*[F.col(f"`{c}`") for c in docs.columns])

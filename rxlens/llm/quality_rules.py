"""Operator 2 [native]: quality rules with risk-controlled thresholds.

Each text gets a few measures; a rule rejects a text whose measure lies
beyond a cutoff.  Cutoffs are not set by hand: for each stratum (language)
and rule, the labelled documents give, for each cutoff of a fixed grid, the
number of good documents (quality 1) and of good documents it would reject;
a cutoff is certified when the exact binomial test shows a false rejection
rate below ``alpha / number of rules`` (equivalently: the exact one-sided
Clopper-Pearson bound is below it).  Of the certified cutoffs the one that
rejects most labelled bad documents is taken, the loosest of these.  Cutoffs of one rule are nested
and tested from loose to tight until the first that fails, so they share one
error level; the levels of all rules and strata are Bonferroni-corrected.
With probability ``1 - delta`` every stratum loses at most ``alpha`` of its
good documents to the rules.  Where labels are too few, nothing is certified
and the rule rejects nothing.

A stratum is a language, exactly as written.  Thresholds are one row per
certified language; they are broadcast up to a counted ``BROADCAST_LANGS``
rows, beyond that joined by a shuffle, the documents of a language salted.

All of it runs as DataFrame expressions.  Repeated words are found per text by
sorting (64-bit hash of three words, position) pairs.

Defined results: a null or empty text has no words and fails the base rules
(n_words < 50); a null language is a stratum of its own; labels with a null
quality or an unknown doc_id do not count; repeated rows are judged alike; an
empty label table certifies nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxlens.llm.common import land, once, sql_words, text_or_empty

SYMBOLS = "[#*$%&|<>]"
WORD = "[^\\x20\\x09-\\x0D]"
CAPITALS = "[A-Z]"
BROADCAST_LANGS, SALTS = 10_000, 64
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")


@dataclass(frozen=True)
class Rule:
    """Reject when ``value > cutoff`` (cutoffs from loose to tight)."""
    name: str
    cutoffs: tuple[float, ...]

    def value(self, struct: str | None = None) -> Column:
        """The measure over columns, or over the fields of a struct column."""
        m = {k: F.col(f"{struct}.{k}" if struct else k) for k in MEASURES}
        words, chars, lines = (F.greatest(m[k], F.lit(1)) for k in ("n_words", "word_chars", "n_lines"))
        return {
            "symbol_share": m["n_symbols"] / chars,
            "dup_line_share": m["n_dup_lines"] / lines,
            "repeat_share": m["n_repeat_words"] / words,
            "capital_share": m["n_capitals"] / chars,
            "word_length": m["word_chars"] / words,
            "word_shortness": F.lit(1.0) - F.least(m["word_chars"] / words / 10, F.lit(1.0)),
        }[self.name]


def _grid(*parts: tuple[float, float, float]) -> tuple[float, ...]:
    """Descending cutoffs: (from, to, step) runs."""
    out = []
    for hi, lo, step in parts:
        out += [round(hi - i * step, 6) for i in range(int(round((hi - lo) / step)) + 1)]
    return tuple(dict.fromkeys(out))


SHARES = _grid((0.95, 0.2, 0.05), (0.19, 0.05, 0.01), (0.045, 0.005, 0.005))
RULES = (Rule("symbol_share", SHARES), Rule("dup_line_share", SHARES), Rule("repeat_share", SHARES),
         Rule("capital_share", SHARES), Rule("word_length", _grid((60, 20, 2), (19, 8, 0.5))),
         Rule("word_shortness", _grid((0.95, 0.3, 0.05))))


def _let(value: Column, body) -> Column:
    """Bind ``value`` once inside an expression."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column, n: Column) -> Column:
    """Words that lie in a three-word window found twice or more in the text."""

    def starts(s):
        """Positions of the windows whose hash has a neighbour in the sorted list."""
        flagged = F.filter(s, lambda v, i: (v["h"] == F.get(s, i + 1)["h"]) | (
            (i > 0) & (v["h"] == F.get(s, F.greatest(i - 1, F.lit(0)))["h"])))
        return F.sort_array(F.transform(flagged, lambda v: v["at"]))

    def covered(p):
        return F.aggregate(p, F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-3).cast("long").alias("last")),
                           lambda acc, v: F.struct((acc["sum"] + F.least(v - acc["last"], F.lit(3).cast("long")))
                                                   .alias("sum"), v.alias("last")), lambda acc: acc["sum"])

    # most texts repeat no window: count the distinct ones first, sort only where some repeat
    windows = F.transform(F.slice(words, 1, n - 2),
                          lambda x, i: F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2)))

    def judged(h):
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.cast("long").alias("at"))))
        return F.when(F.size(F.array_distinct(h)) == n - 2, F.lit(0).cast("long")).otherwise(
            _let(placed, lambda s: covered(starts(s))))

    return F.when(n < 4, F.lit(0).cast("long")).otherwise(_let(windows, judged))


def _dup_lines(text: Column) -> Column:
    """Struct (lines with a word, those equal to an earlier line)."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    return _let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"),
                                          (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))


def measure(docs: DataFrame, text: str = "text", into: str = "measures") -> DataFrame:
    """``docs`` with a struct column ``into`` of the measures of every whole text."""
    t = text_or_empty(text)
    staged = docs.withColumn("_op2_words", sql_words(t))
    n = F.size("_op2_words")
    staged = staged.withColumn("_op2_lines", _dup_lines(t))
    fields = {
        "n_words": n.cast("long"),
        "word_chars": F.length(F.array_join("_op2_words", "")).cast("long"),
        "n_symbols": F.regexp_count(t, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": F.col("_op2_lines.dup"),
        "n_repeat_words": _repeat_words(F.col("_op2_words"), n),
        "n_lines": F.col("_op2_lines.n"),
        "n_capitals": F.regexp_count(t, F.lit(CAPITALS)).cast("long"),
    }
    return (once(staged, into, F.struct(*[c.alias(k) for k, c in fields.items()]))
            .drop("_op2_words", "_op2_lines"))


def base_failed(n_words: Column, n_repeat: Column) -> Column:
    return (n_words < 50) | (100 * n_repeat > 50 * n_words)


def stratum(lang: Column) -> Column:
    """The language with a mark before it; a null language is a value of its own."""
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit("null"))


def _ln_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1 (Stirling's series after a shift by 7)."""
    y = x + 7
    shift = F.lit(0.0)
    for i in range(7):
        shift = shift + F.log(x + i)
    return ((y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y)
            + 1 / (1260 * y * y * y * y * y) - shift)


TAIL_TERMS = 2000


def ln_binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """ln P(X <= k) for X ~ Binomial(n, rate); 0 where k >= n * rate (no evidence).

    The terms fall off below k, so they are summed downwards from k.  At most
    ``TAIL_TERMS`` terms are added one by one; the rest, if any, is bounded by
    a geometric series, which makes the result an upper bound.
    """
    kd, nd = k.cast("double"), n.cast("double")
    odds = (1 - rate) / rate
    top = (_ln_gamma(nd + 1) - _ln_gamma(kd + 1) - _ln_gamma(nd - kd + 1)
           + kd * math.log(rate) + (nd - kd) * math.log1p(-rate))
    terms = F.sequence(F.lit(0), F.least(k.cast("int"), F.lit(TAIL_TERMS)))
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(1.0).alias("term"))
    step = lambda a, j: F.struct((a["sum"] + a["term"]).alias("sum"),
                                 (a["term"] * (kd - j) / (nd - kd + j + 1) * odds).alias("term"))
    rest = lambda a: a["sum"] + a["term"] / (1 - (kd / (nd - kd + 1) * odds))
    total = F.aggregate(terms, start, step, rest)
    return F.when((n > 0) & (kd < nd * rate), F.least(top + F.log(total), F.lit(0.0))).otherwise(F.lit(0.0))


def _cutoffs_beyond(rule: Rule) -> Column:
    """How many of the rule's cutoffs reject the row."""
    value = rule.value()
    return F.size(F.filter(F.array(*[F.lit(float(c)) for c in rule.cutoffs]), lambda c: value > c))


def calibrate(measured: DataFrame, labels: DataFrame, alpha: float = 0.05, delta: float = 0.05,
              rules: tuple[Rule, ...] = RULES, lang: str = "lang", measures: str = "measures",
              id_col: str = "doc_id", quality: str = "quality") -> DataFrame:
    """Certified cutoffs, one row per stratum and certified rule: stratum, rule, cutoff, n_good, n_rejected, ...

    Counts cover every labelled document that passes the base rules.
    """
    spark = measured.sparkSession
    marked = (labels.where(F.col(id_col).isNotNull() & F.col(quality).isin(0, 1))
              .select(F.col(id_col).alias("_id"), F.col(quality).alias("good")).distinct())
    flat = measured.select(F.col(id_col).alias("_id"), stratum(F.col(lang)).alias("stratum"), F.col(measures + ".*"))
    flat = flat.where(~base_failed(F.col("n_words"), F.col("n_repeat_words"))).join(marked, "_id")
    # how many cutoffs of each rule reject the document (they are nested)
    hits = [F.struct(F.lit(i).alias("rule"), _cutoffs_beyond(r).alias("hits")) for i, r in enumerate(rules)]
    counts = (flat.select("stratum", "good", F.explode(F.array(*hits)).alias("h"))
              .groupBy("stratum", F.col("h.rule").alias("rule"), F.col("h.hits").alias("hits"))
              .agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad")))
    counts = land(counts, "quality-counts")
    n_strata = max(1, counts.select("stratum").distinct().count())
    level = math.log(delta / (n_strata * len(rules)))
    grid = spark.createDataFrame([(i, j, len(r.cutoffs), float(c)) for i, r in enumerate(rules)
                                  for j, c in enumerate(r.cutoffs)],
                                 "rule int, position int, size int, cutoff double")
    by_rule = counts.groupBy("stratum", "rule").agg(
        F.sum("good").alias("n_good"), F.collect_list(F.struct("hits", "good", "bad")).alias("bins"))

    def rejected(kind):
        # the cutoff at ``position`` (0 is the loosest) rejects what size - position or more cutoffs reject
        return F.aggregate(F.filter("bins", lambda b: b["hits"] >= F.col("size") - F.col("position")),
                           F.lit(0).cast("long"), lambda a, b: a + b[kind])

    tested = once(by_rule.join(F.broadcast(grid), "rule"), "cut", F.struct(
        rejected("good").alias("n_rejected"), rejected("bad").alias("n_bad_rejected")))
    tested = tested.select("stratum", "rule", "cutoff", "n_good", "cut.*")
    tested = once(tested, "ln_p", ln_binomial_tail(F.col("n_rejected"), F.col("n_good"), alpha / len(rules)))
    certified = (tested.where((F.col("ln_p") <= level) & (F.col("n_bad_rejected") > 0))
                 .groupBy("stratum", "rule")
                 .agg(F.max_by(F.struct("cutoff", "n_good", "n_rejected", "n_bad_rejected", "ln_p"),
                               F.struct("n_bad_rejected", "cutoff")).alias("best")))
    return land(certified.select("stratum", "rule", "best.*"), "quality-thresholds")


def judge(measured: DataFrame, thresholds: DataFrame, rules: tuple[Rule, ...] = RULES, lang: str = "lang",
          measures: str = "measures", into: str = "verdict", broadcast_langs: int = BROADCAST_LANGS) -> DataFrame:
    """``measured`` with a struct column ``into``: base_failed, kept, failed_rules (names).

    The threshold table, pivoted to one row per stratum, is broadcast if it is
    counted small.
    """
    per = thresholds.groupBy(F.col("stratum").alias("_op2_stratum")).agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("_op2_cut"))
    m = F.col(measures)
    bound = measured.withColumn("_op2_s", stratum(F.col(lang)))
    if per.count() <= broadcast_langs:
        joined = bound.join(F.broadcast(per), F.col("_op2_s") == F.col("_op2_stratum"), "left")
    else:
        salted = bound.withColumn("_op2_salt", F.pmod(F.xxhash64(m), F.lit(SALTS)).cast("int"))
        copies = per.withColumn("_op2_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = salted.join(copies, (F.col("_op2_s") == F.col("_op2_stratum"))
                             & (F.col("_op2_salt") == F.col("_op2_copy")), "left").drop("_op2_salt", "_op2_copy")
    scoped = joined.withColumn("_op2_values", m)
    failed = F.array_compact(F.array(*[
        F.when(r.value("_op2_values") > F.col("_op2_cut")[F.lit(i)], F.lit(r.name))
        for i, r in enumerate(rules)]))
    base = base_failed(m["n_words"], m["n_repeat_words"])
    out = scoped.withColumn(into, F.struct(base.alias("base_failed"), (~base & (F.size(failed) == 0)).alias("kept"),
                                           failed.alias("failed_rules")))
    return out.drop("_op2_s", "_op2_stratum", "_op2_cut", "_op2_values")


def filter_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that pass the base rules and the certified rules (same columns).

    The texts are measured twice (once to calibrate, once to judge), which
    costs a second scan but neither a shuffle nor a copy of the texts.
    """
    thresholds = calibrate(measure(docs.select("doc_id", "text", "lang")), labels, **options)
    judged = judge(measure(docs, into="_op2_m"), thresholds, measures="_op2_m", into="_op2_v")
    return judged.where("_op2_v.kept").select(*[F.col(f"`{c}`") for c in docs.columns])

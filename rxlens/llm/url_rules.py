"""Operator 3 [native]: URL rules fetched by their rarest literal token.

A rule is written as ``host/path`` (anchored to a host and its subdomains,
the path a prefix) or as a free pattern between separators, such as
``*/adclick/`` or ``*/tag/*/feed``: ``*`` stands for any run of characters.
From each rule follow a regular expression and the literal tokens (runs of
``[a-z0-9]`` that are whole tokens of every url that fits).  Token
frequencies are counted over all urls, for rule tokens only; each rule is
filed under its rarest token.  A url's tokens fetch candidate rules from that
index and only those run their regular expression; rules without a whole
token are candidates everywhere (so results never depend on the index).

Everything is native: one aggregation over the distinct tokens (at most one
row per rule token comes back, bounded by the rules given), then one narrow
projection; no shuffle of urls.

Verdict: the longest fitting host rule wins; if none fits, the url is blocked
when a free pattern fits, else allowed.

Defined results: null urls or urls without ``://`` have empty host and path,
no rule and verdict allow; an empty rule list allows all; ties in length go to
block, then to the smaller rule text; repeated rows repeat.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxlens.llm.common import once

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    rule: str
    action: str = "block"

    @property
    def anchored(self) -> bool:
        return not self.rule.startswith("*")

    @property
    def regex(self) -> str:
        """Over the target ``host + path`` (host rules) or the same in lower case (free patterns)."""
        if self.anchored:
            host, _, path = self.rule.partition("/")
            return "^(?:[^/]*\\.)?" + _quote(host) + _quote("/" + path)
        return "(?s)" + ".*".join(_quote(x) for x in self.rule.strip("*").split("*"))

    @property
    def tokens(self) -> tuple[str, ...]:
        body = self.rule if self.anchored else self.rule.strip("*")
        out = set()
        for m in re.finditer(r"[a-z0-9]+", body.lower()):
            # a token is whole when the rule itself fixes a separator on both sides
            left = body[m.start() - 1] if m.start() else ("/" if self.anchored else "*")
            right = body[m.end()] if m.end() < len(body) else "*"
            if left != "*" and right != "*":
                out.add(m.group(0))
        return tuple(sorted(out))


def _quote(s: str) -> str:
    return re.sub(r"([^A-Za-z0-9/_ -])", r"\\\1", s)


# Example production set of free patterns (advert, tracking and spam hosts).
FREE_PATTERNS = tuple(Rule(r) for r in (
    "*/adclick/", "*/adserver/", "*/banner/", "*/popup/", "*/track/*/pixel", "*/affiliate/", "*/casino/",
    "*.spam-farm.", "*.cheap-pills.", "*.free-bets.", "*.adult-x.", "*.doubleclick.", "*.adserver.",
    "*/wp-admin/", "*/login/", "*/cart/checkout/"))


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) columns; empty when the url is null or has no ``://``."""
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, u.substr(at + 3, F.length(u))).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest.substr(F.length(raw) + 1, F.length(rest)), r"^([^?#]*)", 1)
    return F.translate(raw, UPPER, LOWER), path


def url_tokens(host: Column, path: Column) -> Column:
    """Distinct ``[a-z0-9]`` runs of host and path (A-Z as a-z), with the empty token for rules that have none."""
    low = F.translate(F.concat(host, path), UPPER, LOWER)
    return F.array_distinct(F.split(low, "[^a-z0-9]+"))


def _file_rules(rules: list[Rule], counts: dict[str, int]) -> dict[str, list[int]]:
    index: dict[str, list[int]] = {}
    for i, r in enumerate(rules):
        key = min(r.tokens, key=lambda t: (counts.get(t, 0), t)) if r.tokens else "*"
        index.setdefault(key, []).append(i)
    return index


def rule_index(urls: DataFrame, rules: list[Rule], url: str = "url") -> dict[str, list[int]]:
    """token -> rules filed under it, from token counts over all ``urls``."""
    wanted = sorted({t for r in rules for t in r.tokens})
    if not wanted:
        return _file_rules(rules, {})
    host, path = url_parts(F.col(url))
    hit = F.array_intersect(url_tokens(host, path), F.array(*[F.lit(t) for t in wanted]))
    counts = (urls.select(F.explode(hit).alias("token")).groupBy("token").count())
    return _file_rules(rules, {r["token"]: r["count"] for r in counts.collect()})  # at most len(wanted) rows


def _rule_structs(rules: list[Rule], ids: list[int]) -> Column:
    return F.array(*[F.struct(F.lit(len(rules[i].rule)).alias("size"),
                              F.lit(int(rules[i].action == "block")).alias("block"),
                              F.lit(i).alias("id"), F.lit(rules[i].rule).alias("rule"),
                              F.lit(rules[i].anchored).alias("anchored"),
                              F.lit(rules[i].regex).alias("regex")) for i in ids])


def judge_urls(urls: DataFrame, rules: list[Rule], free: tuple[Rule, ...] = FREE_PATTERNS, url: str = "url",
               into: str = "judged") -> DataFrame:
    """``urls`` with a struct column ``into``: host, path, rule, verdict, n_candidates."""
    every = sorted(set(rules) | set(free), key=lambda r: (r.rule, r.action), reverse=True)
    host, path = url_parts(F.col(url))
    if not every:
        return urls.withColumn(into, F.struct(
            host.alias("host"), path.alias("path"), F.lit(None).cast("string").alias("rule"),
            F.lit("allow").alias("verdict"), F.lit(0).alias("n_candidates")))
    index = rule_index(urls, every, url)
    anywhere = index.pop("*", [])
    parts = once(urls, "_op3_parts", F.struct(host.alias("host"), path.alias("path")))
    host, path = F.col("_op3_parts.host"), F.col("_op3_parts.path")
    candidates = _rule_structs(every, anywhere)
    if index:
        lookup = F.create_map(*[x for t, ids in sorted(index.items()) for x in (F.lit(t), _rule_structs(every, ids))])
        keys = F.array_intersect(url_tokens(host, path), F.array(*[F.lit(t) for t in sorted(index)]))
        fetched = F.flatten(F.transform(keys, lambda t: lookup[t]))
        candidates = F.concat(fetched, candidates) if anywhere else fetched
    staged = once(parts, "_op3_cand", candidates)
    target = F.concat(host, path)
    low = F.translate(F.concat(F.lit("."), host, path, F.lit("/")), UPPER, LOWER)
    staged = once(staged, "_op3_fits", F.filter("_op3_cand", lambda c: F.when(c["anchored"], F.rlike(
        target, c["regex"])).otherwise(F.rlike(low, c["regex"]))))
    best = F.array_max(F.filter("_op3_fits", lambda c: c["anchored"]))
    verdict = F.when(best.isNotNull(), F.when(best["block"] == 1, "block").otherwise("allow")) \
        .when(F.exists("_op3_fits", lambda c: ~c["anchored"]), "block").otherwise("allow")
    return staged.withColumn(into, F.struct(host.alias("host"), path.alias("path"), best["rule"].alias("rule"),
                                            verdict.alias("verdict"), F.size("_op3_cand").alias("n_candidates"))) \
        .drop("_op3_parts", "_op3_cand", "_op3_fits")

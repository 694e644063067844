"""Registered queries of the training-data operators, and their DuckDB statements.

Each query applies one operator, with production parameters, to the whole of
its table and derives the digest columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxlens.llm import (ann_tree, fill_middle, html_mincut, jaccard_join, mixing, packing, pii, quality_net,
                        quality_rules, simhash, toxicity, url_rules, whitening)
from rxlens.llm.common import arrow_conf, land, read, text_or_empty

# Host rules of the url query.
URL_RULES = (url_rules.Rule("com/", "allow"), url_rules.Rule("example.com/en/", "block"),
             url_rules.Rule("www.example.com/en/", "allow"), url_rules.Rule("net/es/", "block"),
             url_rules.Rule("net/fr/", "block"))


def op1_html_mincut(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrow_conf(spark)
    out = html_mincut.extract_pages(read(spark, sf_dir, "pages"), "html", "main")
    return out.select("page_id", "url", F.col("main.text").alias("text"),
                      F.length("main.text").cast("long").alias("n_chars"),
                      F.col("main.n_blocks").alias("n_blocks"), F.col("main.n_content").alias("n_content"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    measured = land(quality_rules.measure(docs).select("doc_id", "lang", "measures"), "quality-measures")
    thresholds = quality_rules.calibrate(measured, read(spark, sf_dir, "labels"))
    out = quality_rules.judge(measured, thresholds)
    return out.select("doc_id", *[F.col(f"measures.{c}").alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        F.col("verdict.base_failed").alias("base_failed"), F.col("verdict.kept").alias("kept"))


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = url_rules.judge_urls(read(spark, sf_dir, "pages").select("page_id", "url"), list(URL_RULES))
    return out.select("page_id", *[F.col(f"judged.{c}").alias(c) for c in ("host", "path", "rule", "verdict")])


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack_documents(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                      "offset")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = land(pii.find(docs).select("doc_id", "pii"), "pii-found")
    spanned = pii.with_spans(found, pii.promote(found))
    base = F.col("pii.base")
    count = lambda k: F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long")  # noqa: E731
    return spanned.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(pii.PATTERNS)],
                          F.sha2(pii.span_text(base), 256).alias("base_sha256"),
                          pii.span_text(F.col("spans")).alias("spans"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_ann_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_tree.nearest(read(spark, sf_dir, "embeddings"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    sized = land(docs.select("doc_id", "source", mixing.word_count(text_or_empty("text")).alias("size")), "mix-sizes")
    out = mixing.mix(sized, F.col("size"))
    return out.select("doc_id", F.col("mix.size").alias("size"), F.col("mix.source_size").alias("source_size"),
                      F.col("mix.target").alias("target"),
                      (F.col("mix.copies") * F.col("mix.size")).cast("long").alias("taken"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_quality_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_net.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_middle.fill_in_middle(read(spark, sf_dir, "documents").select("doc_id", "text"))
    made = out.select("doc_id", "fim.*")
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("text", 256).alias("output_sha256"),
                       F.sha2(fill_middle.restore(F.col("text"), F.col("form")), 256).alias("restored_sha256"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard_join.near_duplicates(read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(rows)
    if model is None:
        return whitening.no_rows(rows)
    white = whitening.whiten(rows, model)
    error = whitening.identity_error(white, model)
    explained = F.array(*[F.lit(float(v) / model.trace if model.trace else 0.0) for v in model.values])
    return (white.select("vec_id", F.col("white.deviation").alias("deviation"),
                         F.posexplode("white.values").alias("i", "whitened"))
            .select("vec_id", (F.col("i") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
                    "whitened", explained[F.col("i")].alias("explained"), F.lit(error).alias("identity_error")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_html_mincut, op2_quality_rules, op3_url_rules, op4_packing, op5_pii, op6_toxicity, op7_ann_tree, op8_mixing,
    op9_simhash, op10_quality_net, op11_fill_middle, op12_jaccard_join, op13_whitening)}


def _url_statement() -> str:
    """Every rule against every url, without an index."""
    anchored = [r for r in URL_RULES]
    fits = ", ".join(
        "CASE WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') "
        "THEN struct_pack(size := {n}, rule := '{r}', action := '{a}') END".format(
            h=r.rule.partition("/")[0], p="/" + r.rule.partition("/")[2], n=len(r.rule), r=r.rule, a=r.action)
        for r in anchored)
    free = " OR ".join(f"regexp_matches(target, '{r.regex}')" for r in url_rules.FREE_PATTERNS)
    upper, lower = url_rules.UPPER, url_rules.LOWER
    return f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{upper}', '{lower}') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^([^/?#]*)', 1)) + 1), '^([^?#]*)', 1) AS path
  FROM cut),
judged AS (
  SELECT *, list_max([{fits}]) AS best,
         translate('.' || host || path || '/', '{upper}', '{lower}') AS target FROM parts)
SELECT page_id, host, path, best.rule AS rule,
       CASE WHEN best IS NOT NULL THEN best.action WHEN {free} THEN 'block' ELSE 'allow' END AS verdict
FROM judged"""


def _fill_middle_statement() -> str:
    """Units by one regular expression, parts as joined list slices."""
    return r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || CAST(doc_id AS VARCHAR)) AS x,
         regexp_extract_all(coalesce(text, ''), '[ 	-]*[^ 	-]+|[ 	-]+') AS u
  FROM documents),
draws AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || x[1:8] AS BIGINT) AS h1, CAST('0x' || x[9:16] AS BIGINT) AS h2,
         CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4 FROM cut),
parts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50
              THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM draws),
made AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:n], '') AS s
  FROM parts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM made"""


ORACLE = {"op3_url_rules": _url_statement(), "op11_fill_middle": _fill_middle_statement()}

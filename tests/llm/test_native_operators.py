"""Operators 2, 3, 5 and 8 against plain Python on small fixtures."""

import collections
import hashlib
import math
import re

import pytest

pytest.importorskip("rxlens.llm")

from pyspark.sql import functions as F  # noqa: E402

from rxlens.llm import mixing, pii, quality_rules, url_rules  # noqa: E402
from rxlens.llm.common import land, text_or_empty  # noqa: E402

TEXTS = [None, "", " \t\n", "one", "a b a b a b a b", "x\ny\nx\n\n \nx", "a\u000bb\u000cc\rd e",
         "#tag *b* <c> & | %", "the cat sat " * 40, "é😀 w " * 3, "same same same same",
         " ".join(f"w{i % 7}" for i in range(3000)), " ".join(f"u{i}" for i in range(3000))]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s1", 7) for i, t in enumerate(TEXTS)] + [(3, "one", None, None, None), (None, "two", "en", "", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words long")


def plain_measures(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    count = collections.Counter(grams)
    inside = {i + j for i, g in enumerate(grams) if count[g] > 1 for j in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside))


def test_measures_match_plain_python(docs):
    # a column named like a measure stays what it was
    rows = quality_rules.measure(docs).collect()
    assert [r["n_words"] for r in rows][:2] == [7, 7]
    for r in rows:
        assert tuple(r["measures"])[:5] == plain_measures(r["text"]), r["text"]


def test_binomial_tail_is_exact(spark):
    cases = [(0, 100), (3, 500), (0, 1), (7, 5000), (30, 5000), (60, 1000)]
    rate = 0.01
    df = spark.createDataFrame(cases, "k long, n long")
    got = df.select("k", "n", quality_rules.ln_binomial_tail(F.col("k"), F.col("n"), rate).alias("p")).collect()
    for r in got:
        exact = sum(math.comb(r["n"], i) * rate ** i * (1 - rate) ** (r["n"] - i) for i in range(r["k"] + 1))
        assert (r["p"] == 0.0) if r["k"] >= r["n"] * rate else r["p"] == pytest.approx(math.log(exact), abs=1e-8)


def test_thresholds_keep_good_and_reject_junk(spark):
    clean = " ".join(f"word{i}" for i in range(60))
    junk = " ".join(f"w{i}***" for i in range(60))
    n = 3000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 == 0, F.lit(junk)).otherwise(
        F.lit(clean)).alias("text"), F.lit("en").alias("lang"))
    labels = docs.select("doc_id", F.when(F.col("doc_id") % 10 == 0, 0).otherwise(1).alias("quality"))
    measured = land(quality_rules.measure(docs), "t")
    th = quality_rules.calibrate(measured, labels)
    assert th.where("rule = 0").count() == 1
    kept = {r["doc_id"] for r in quality_rules.judge(measured, th).where("verdict.kept").collect()}
    assert kept == {i for i in range(n) if i % 10}
    out = quality_rules.filter_documents(docs.withColumn("source", F.lit("x")), labels)
    assert out.columns == ["doc_id", "text", "lang", "source"] and out.count() == len(kept)
    # too few labels certify nothing: only the base rules act
    few = quality_rules.calibrate(measured, labels.limit(50))
    assert few.count() == 0
    assert quality_rules.judge(measured, few).where("verdict.kept").count() == n
    empty = quality_rules.calibrate(measured.limit(0), labels.limit(0))
    assert quality_rules.judge(measured.limit(0), empty).count() == 0


def test_languages_do_not_share_a_calibration(spark):
    def bucket(lang):  # he and zh met in one of 256 buckets
        return spark.range(1).select(F.pmod(F.xxhash64(F.lit(lang)), F.lit(256))).first()[0]
    assert bucket("he") == bucket("zh")
    # 3,900 Hebrew documents of short words, 100 of them junk in long words; 40 clean Chinese ones, long between spaces
    kind = F.when(F.col("id") < 3800, "he").when(F.col("id") < 3900, "junk").otherwise("zh")
    word = F.when(kind == "he", "abcde").when(kind == "junk", "z" * 70).otherwise("q" * 70)
    docs = spark.range(3940).select(
        F.col("id").alias("doc_id"), F.when(kind == "zh", "zh").otherwise("he").alias("lang"),
        F.array_join(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda i: F.concat(word, i.cast("string"))), " ")
        .alias("text"), kind.alias("kind"))
    labels = docs.select("doc_id", F.when(F.col("kind") == "junk", 0).otherwise(1).alias("quality"))
    measured = land(quality_rules.measure(docs), "t")
    th = quality_rules.calibrate(measured, labels)
    for options in ({}, {"broadcast_langs": 0}):
        kept = quality_rules.judge(measured, th, **options).where("verdict.kept").groupBy("kind").count().collect()
        assert {r["kind"]: r["count"] for r in kept} == {"he": 3800, "zh": 40}


URLS = [None, "", "no scheme", "http://example.com", "http://example.com/", "https://A.EXAMPLE.com/en/x?q#f",
        "http://www.example.com/en/1", "http://xexample.com/en/", "http://a.net/es/1", "http://a.net/ES/1",
        "http://net/fr/", "ftp://h.org/adclick/1", "http://www.spam-farm.example.org/", "http://spam-farmer.org/x",
        "://x.com/", "http://é.com/en/#", "http://a.org/track/9/pixel", "http://a.org/trackpixel"]


def plain_verdict(url, rules, free):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        raw = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(raw):]).group()
        host = re.sub("[A-Z]", lambda m: m.group().lower(), raw)
    fits = []
    for r in rules:
        h, _, p = r.rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(r.rule), r.rule, r.action))
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    low = re.sub("[A-Z]", lambda m: m.group().lower(), f".{host}{path}/")
    hit = any(re.search(".*".join(map(re.escape, r.rule.strip("*").split("*"))), low) for r in free)
    return host, path, None, "block" if hit else "allow"


def test_url_rules_match_every_rule_on_every_url(spark):
    from rxlens.llm.queries import URL_RULES
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS * 2)], "host long, url string")
    rows = url_rules.judge_urls(df, list(URL_RULES)).collect()
    assert len(rows) == 2 * len(URLS)
    for r in rows:
        j = r["judged"]
        assert (j["host"], j["path"], j["rule"], j["verdict"]) == plain_verdict(
            r["url"], URL_RULES, url_rules.FREE_PATTERNS), r["url"]
    assert {r["judged"]["verdict"] for r in url_rules.judge_urls(df, [], ()).collect()} == {"allow"}
    assert url_rules.judge_urls(df.limit(0), list(URL_RULES)).count() == 0


def test_rules_are_filed_under_their_rarest_token(spark):
    df = spark.createDataFrame([("http://a.example.com/x",), ("http://b.com/y",), ("http://c.net/es/1",)], "url string")
    index = url_rules.rule_index(df, [url_rules.Rule("example.com/en/"), url_rules.Rule("net/es/")])
    assert {k: len(v) for k, v in index.items()} == {"en": 1, "es": 1}


PII = ["mail a.b@x.org, c@d and +1 (555) 010-7788 or 4111 1111 1111 1111", "1.2.3.4 1.2.3.256 1.2.3.4.5.6.7.8 0001.2.3.4",
       "a@b.c._x@d.e..f", "4111111111111112 12345678901234567890 4111-1111 1111-1111", "+12 +123456789 +1--2",
       "é😀 x@y.zz é 10.0.0.1", None, "", "no data here", "9" * 3000 + " " + "a" * 3000 + "@", "x.y@z.w" * 50]


def plain_spans(t):
    def luhn(s):
        return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(s)))) % 10 == 0
    t, out = t or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in out)


def test_base_spans_match_plain_python(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(PII)], "doc_id long, text string")
    rows = pii.find(df).select("text", pii.span_text(F.col("pii.base")).alias("s")).collect()
    for r in rows:
        assert r["s"] == plain_spans(r["text"]), r["text"]
    assert hashlib.sha256(b"").hexdigest() == pii.find(df.where("text = ''")).select(
        F.sha2(pii.span_text(F.col("pii.base")), 256)).first()[0]


def test_bootstrapping_finds_identifiers_after_learned_contexts(spark):
    rows = [(i, f"note {i}: member card no 41111111111{i:04d}x and key = 0123456789abcdef0123456789ab{i:04d}")
            for i in range(40)]
    rows += [(100, "key = QX77-1234-99-ZZ ends"), (101, "invoice total 1234567890 ends"), (102, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    patterns = pii.learn(pii.find(df))
    assert any(p.endswith("key = ") for p in patterns)
    out = {r["doc_id"]: r["text"] for r in pii.redact_documents(df).collect()}
    assert out[100] == "key = [ID] ends"
    assert out[101] == "invoice total 1234567890 ends" and out[102] is None
    assert pii.learn(pii.find(df.limit(0))) == []


def test_bootstrapping_goes_on_from_found_identifiers(spark):
    ids = [f"QX{i:04d}-77-{i:04d}" for i in range(40)]
    keys = [f"{i:032x}" for i in range(1000, 1400)]
    # 'alpha = ' is certified by hexadecimal keys, 'beta ref ' only by what 'alpha = ' finds
    lines = [f"note alpha = {v}" for v in keys + ids] + [f"see the beta ref {v}" for v in ids] + ["my beta ref ZZ99-88-7766 ends"]
    # one cue behind varied words; nine seeds of nine give exactly 0.9
    lines += [f"w{chr(97 + i)} passport {v}" for i, v in enumerate(keys[:18])] + ["other passport 12345678 ends"]
    lines += [f"nine of {v}" for v in keys[:9]] + [f"eight of {v}" for v in keys[:8]]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    out = {r["text"] for r in pii.redact_documents(df).collect()}
    assert "my beta ref [ID] ends" in out and "other passport [ID] ends" in out
    patterns = pii.learn(pii.find(df))
    assert "nine of " in patterns and "eight of " not in patterns


def test_every_certified_pattern_is_kept_and_applied(spark):
    def name(i):
        return "".join(chr(97 + i // 26 ** p % 26) for p in range(3))
    lines = spark.range(1200 * 18).select(F.col("id").alias("doc_id"), F.concat(
        F.element_at(F.array(*[F.lit(name(i)) for i in range(1200)]), (F.col("id") % 1200 + 1).cast("int")),
        F.lit(" "), F.md5(F.col("id").cast("string"))).alias("text"))
    asks = spark.createDataFrame([(100_000 + i, f"{name(i)} QX77-{i:04d}") for i in range(1200)],
                                 "doc_id long, text string")
    found = land(pii.find(lines.unionByName(asks)), "t")
    patterns = pii.promote(found)
    assert patterns.count() == 1200
    asked = found.where("doc_id >= 100000")
    for options in ({}, {"broadcast_patterns": 10}, {"literal_patterns": 2000}):
        out = pii.with_spans(asked.unionByName(asked.limit(1)), patterns, **options)
        assert out.where(F.size("spans") == 1).count() == out.count() == 1201


def test_redaction_replaces_whole_spans(spark):
    df = spark.createDataFrame([(1, "é a@b.cc, +1 555 010 7788!", 26)], "doc_id long, text string, n_chars int")
    r = pii.redact_documents(df).first()
    assert r["text"] == "é [EMAIL], [PHONE]!" and r["n_chars"] == len(r["text"])


def test_targets_stop_at_three_times_a_source(spark):
    sizes = {"a": 100, "b": 1000, "c": 10, "d": 4000, None: 7, "e": 0}
    df = spark.createDataFrame([(mixing.MAX_COPIES, s, n) for s, n in sizes.items()], "x int, source string, n long")
    keyed = df.select(mixing._source_key(F.col("source")).alias("key"), F.col("n").alias("source_size"))
    got = {r["key"]: r["target"] for r in mixing.targets(keyed).collect()}
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    want, open_, total = {}, set(order), float(sum(sizes.values()))
    while True:
        level = (total - sum(want.values())) / sum(weight[s] for s in open_) if open_ else 0
        over = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not over:
            want.update({s: level * weight[s] for s in open_})
            break
        want.update({s: 3.0 * sizes[s] for s in over})
        open_ -= over
    for s in order:
        assert got["n" if s is None else "a" + s] == pytest.approx(want[s], rel=1e-9, abs=1e-6), s


def test_mix_comes_near_its_targets_and_reruns_agree(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
            F.concat(F.lit("s"), F.col("id") % 5)).alias("source"),
        F.repeat(F.lit("w "), (F.col("id") % 50).cast("int")).alias("text"), F.lit(1).alias("mix"))
    out = mixing.mix(docs, mixing.word_count(text_or_empty("text")), into="m")
    first = out.select("doc_id", "source", "m.*").collect()
    again = mixing.mix(docs, mixing.word_count(text_or_empty("text")), into="m").select("doc_id", "source", "m.*")
    assert sorted(first) == sorted(again.collect())
    taken = collections.Counter()
    for r in first:
        assert 0 <= r["copies"] <= 3
        taken[r["source"]] += r["copies"] * r["size"]
    for r in first:
        assert abs(taken[r["source"]] - r["target"]) <= 100
    whole = mixing.mixed_documents(docs)
    assert whole.columns == docs.columns and whole.count() == sum(r["copies"] for r in first)
    assert mixing.mixed_documents(docs.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, None, None), (1, None, "a b")], "doc_id long, source string, text string")
    assert mixing.mix(odd, mixing.word_count(text_or_empty("text"))).count() == 2


def test_a_text_of_many_matches(spark):
    """Spans, overlaps and redaction of a long log equal plain Python, in steps linear in its matches."""
    lines = [f"é host 10.{i % 250}.{i // 250 % 250}.{i % 99} u{i}@ex.org +1 555 010 {i % 9000 + 1000} 10.0.0.{i % 300}@a.bc"
             for i in range(4000)]
    lines[1000:1000] = ["plain words without any match " * 700]
    text = "\n".join(lines)
    df = spark.createDataFrame([(1, text), (2, "none"), (3, "")], "doc_id long, text string")
    found = pii.find(df).where("doc_id = 1").select(pii.span_text(F.col("pii.base")).alias("s"), "pii.mentions").first()
    assert found["s"] == plain_spans(text)
    base = [tuple(map(int, s.split(":")[1:])) for s in found["s"].split(",")]
    covered = bytearray(len(text))
    for a, b in base:
        covered[a:b] = b"\x01" * (b - a)
    assert len(found["mentions"]) > 8000
    for m in found["mentions"]:
        assert m["inside"] == any(covered[m["start"]:m["end"]]) and text[m["start"]:m["end"]] == m["value"]
    spans = sorted({(a, b, k) for k, a, b in ((pii.KINDS.index(s.split(":")[0]), *map(int, s.split(":")[1:]))
                                              for s in found["s"].split(","))})
    out, at = [], 0
    for a, b, k in spans:
        if a >= at:
            out += [text[at:a], f"[{pii.KINDS[k].upper()}]"]
        at = max(at, b)
    want = "".join(out) + text[at:]
    made = spark.createDataFrame([(text, [(k, a, b) for a, b, k in spans]), ("x", [])],
                                 "text string, spans array<struct<kind:int,start:int,end:int>>")
    assert [r[0] for r in made.select(pii.redact(F.col("text"), F.col("spans"))).collect()] == [want, "x"]


@pytest.mark.parametrize("size", [1, 5, 4095, 4096, 4097, 8192, 9000])
def test_redaction_at_the_edges_of_text_parts(spark, size):
    text = "aé😀\n"[:size] if size < 4 else ("aé😀\n" * size)[:size]
    spots = sorted({0, 1, size // 2, 4095, 4096, 8191, 8192, size - 1})
    spans = [(3, a, a + 1) for a in spots if a < size]
    want, at = "", 0
    for _, a, b in spans:
        want, at = want + text[at:a] + "[PHONE]", b
    df = spark.createDataFrame([(text, spans)], "text string, spans array<struct<kind:int,start:int,end:int>>")
    assert df.select(pii.redact(F.col("text"), F.col("spans"))).first()[0] == want + text[at:]

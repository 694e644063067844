"""Operators 1, 4, 6, 7, 9, 10 and the pipeline: brute force, round trips and held-out accuracy."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("rxlens.llm")

from rxlens.llm import ann_tree, html_mincut, packing, quality_net, simhash, toxicity  # noqa: E402

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site name</h1></header><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>
<div class="cookie-notice">We use cookies.</div><div class="ad">Buy now!</div>
<article><h1>The &quot;title&quot;</h1><p><b>First &amp; foremost.<br><p>Second
   paragraph&nbsp;here.</p><aside>Related links</aside><p>Short.</p><form><label>Name</label></form></article>
<div id="comments"><p>Nice article, well written and long enough to look like content of the page.</p></div>
<aside class="sidebar">More</aside><footer>&copy; x</footer></body></html>"""


def test_page_text():
    text, n, kept = html_mincut.extract(PAGE)
    assert text == 'The "title"\nFirst & foremost.\nSecond paragraph here.\nShort.'
    assert n > kept == 4
    assert html_mincut.extract(None) == html_mincut.extract("") == html_mincut.extract("   ") == ("", 0, 0)
    assert html_mincut.extract("<article><p>cut off<p class='x")[0] == "cut off"
    assert html_mincut.extract("<nav><a>only</a> <a>links</a></nav>")[0] == ""
    assert html_mincut.extract("<" * 5000 + "'" * 5000)[1] >= 0


def test_article_text_is_not_lost():
    line = "The article goes on with a sentence that is long enough to be read as text."
    for odd in ("<svg width='1'/>", "<math/>", "<object data='x'>", "<video src='x'>", "<video-player></video-player>",
                "<select-box>", "<svg><text>label</text></svg>"):
        assert html_mincut.extract(f"<article><p>{line}</p>{odd}<p>{line}</p></article>")[0] == f"{line}\n{line}", odd
    page = '<div class="{}"><article><div class="entry-header"><h1>A title</h1></div><p>{}</p></article></div>'
    for name in ("content no-sidebar", "layout sidebar", "content"):
        assert html_mincut.extract(page.format(name, line))[0] == f"A title\n{line}", name
    assert html_mincut.extract(f'<div class="sidebar"><p>{line}</p></div>')[0] == ""


def test_min_cut_is_minimal():
    rng = np.random.default_rng(1)
    for _ in range(40):
        n = int(rng.integers(2, 9))
        w = rng.normal(0, 2, n).tolist()
        edges = [(i, j, float(rng.random())) for i in range(n) for j in range(i) if rng.random() < 0.5]

        def price(side):
            return (sum(x for x, s in zip(w, side) if x > 0 and not s) + sum(-x for x, s in zip(w, side) if x < 0 and s)
                    + sum(c for i, j, c in edges if side[i] != side[j]))
        best = min(price([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert price(html_mincut.min_cut(w, edges)) == pytest.approx(best, abs=1e-6)


def test_pages_keep_their_columns(spark):
    df = spark.createDataFrame([(1, PAGE, "x"), (2, None, "y"), (1, PAGE, "x")], "page_id long, html string, text string")
    rows = html_mincut.extract_pages(df).collect()
    assert [r["text"] for r in rows] == ["x", "y", "x"] and rows[0]["main"] == rows[2]["main"]
    assert html_mincut.extract_pages(df.limit(0)).count() == 0


ODD = ["a  b \n c", "\n x", "<|endoftext|> hi", "x  y", "tab\t end ", "", None, " lead", "a \n\nb  ", "it's don't 12 34",
       "\r\n foo", "one two\nthree four.\nFive", " x  y", "é😀 ok"]


def test_token_ids_are_those_of_the_whole_text():
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(packing.default_vocabulary())
    model.encode_special_tokens = True
    encoder = packing.ChunkEncoder(packing.default_vocabulary())
    for _ in range(2):  # new chunks, then cached ones
        for t, ids in zip(ODD, encoder.encode(pa.array(ODD, pa.string()))):
            assert ids.tolist() == [*model.encode(t or "", add_special_tokens=False).ids, packing.END_ID], repr(t)


def test_packing_is_a_partition_without_padding(spark):
    rows = [(i, "word " * (i * 37 % 900)) for i in range(120)] + [(500, "w " * 9000), (None, None), (7, "seven")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    out = packing.pack_documents(df, block_tokens=20_000).toPandas()
    assert out["length"].sum() == sum(len(x) // 4 for x in out["ids"])
    for _, s in out.sort_values("offset").groupby("sequence_id"):
        total = int(s["length"].sum())
        assert total <= 2048 and total & (total - 1) == 0
        assert (s["offset"].to_numpy() == np.cumsum(s["length"]) - s["length"]).all()
    one = out[out.doc_id == 500].sort_values("start")
    assert one["start"].tolist() == (one["length"].cumsum() - one["length"]).tolist()
    assert one["length"].sum() == one["doc_tokens"].iloc[0]
    assert len(out[out.doc_id.isna()]) == 1
    assert packing.pack_documents(df.limit(0)).count() == 0


def test_packing_balances_cost():
    lengths = np.random.default_rng(0).integers(1, 2048, 2000).tolist()
    pieces = packing.pack(lengths)
    cost = {}
    for _, _, n, seq, _ in pieces:
        cost[seq] = cost.get(seq, 0) + packing.cost(n)
    full = np.array([c for s, c in cost.items() if s < sum(lengths) // 2048])
    assert full.std() / full.mean() < 0.25


def test_golay_anchors_meet_all_close_pairs():
    rng = np.random.default_rng(2)
    fp = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    near, far = simhash.Golay.tables()
    assert (near >= 0).all() and (far >= 0).sum() == 8855
    for bits in range(1, 5):
        other = fp.copy()
        for i in range(len(other)):
            for b in rng.choice(64, bits, replace=False):
                other[i] ^= np.uint64(1 << int(b))
        a, b = (set(zip(*(x.tolist() for x in simhash.anchors_of(v)))) for v in (fp, other))
        assert {r for r, _ in a & b} == set(range(len(fp)))


def plain_fingerprint(text):
    import re

    import xxhash
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    sh = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_and_components_match_brute_force(spark):
    rng = np.random.default_rng(3)
    base = [" ".join(rng.choice(list("abcdefgh"), 80)) for _ in range(30)]
    texts = [None, "", " \n", "One two", "one TWO", "x y z", "é ß w q r"]
    for t in base:
        words = t.split()
        for k in range(6):  # near copies: a word more
            texts.append(" ".join([*words, *["zz"] * (k % 3)]))
    rows = list(enumerate(texts)) + [(2000, base[0]), (None, base[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = simhash.near_duplicates(df).collect()
    want = {i: plain_fingerprint(t) for i, t in rows}
    fps = np.array([want[i] for i, _ in rows], np.uint64)
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if int(np.bitwise_count(fps[i] ^ fps[j])) <= 4:
                a, b = sorted((find(i), find(j)))
                group[b] = a
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    root = {doc: least[find(i)] for i, (doc, _) in enumerate(rows)}
    assert len(got) == len(rows)
    for r in got:
        assert r["fp"] & (1 << 64) - 1 == want[r["doc_id"]]
        assert r["component_id"] == root[r["doc_id"]]
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(df).collect()}
    assert kept - {None} == {d for d in root if d is not None and root[d] == d}
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_large_anchor_groups_are_compared_in_blocks(spark):
    rng = np.random.default_rng(4)
    fp = np.unique(np.array([int(x) << 43 for x in rng.integers(0, 1 << 20, 400)], np.int64))
    df = spark.createDataFrame([(int(x),) for x in fp], "fp long")
    whole = simhash.components(simhash.links(df)).collect()
    small = simhash.components(simhash.links(df, group_rows=16)).collect()
    assert sorted(whole) == sorted(small) and whole


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    x[100:700] = x[0]  # one vector holds much of the table
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(5000, None), (5020, [0.0] * 16), (5040, [float("nan")] + [1.0] * 15), (None, [1.0] * 16), (5060, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann_tree.nearest(df, k=20, every=20).toPandas()
    q = np.arange(0, 1500, 20)
    assert sorted(got.query_id.unique().tolist()) == q.tolist()
    s = x[q].astype(float) @ x.T.astype(float)
    hit = 0
    for i, k in enumerate(q):
        mine = got[got.query_id == k].sort_values("rank")
        order = [j for j in np.lexsort((np.arange(1500), -np.round(s[i], 10))) if j != k][:20]
        assert mine["rank"].tolist() == list(range(1, 21)) and k not in set(mine.vec_id)
        assert np.allclose(mine.score, s[i][mine.vec_id.to_numpy()], atol=1e-9)
        hit += len(set(order) & set(mine.vec_id))
    assert hit / (20 * len(q)) >= 0.9
    assert ann_tree.nearest(df.limit(0)).count() == 0


def test_ties_go_to_the_smaller_id_however_many():
    rng = np.random.default_rng(8)
    x = rng.integers(0, 2, (400, 12)).astype(float)
    ids = rng.permutation(400)
    q = np.vstack([x[:20], np.eye(12)])
    at, score = ann_tree.best(q, x, ids, 21)
    full = (x[None] * q[:, None]).sum(2)
    for i in range(len(q)):
        order = np.lexsort((ids, -full[i]))[:21]
        assert at[i].tolist() == order.tolist() and score[i].tolist() == full[i][order].tolist()
    at, _ = ann_tree.best(q, x[:5], ids[:5], 21)
    assert at.shape == (len(q), 5)


def test_queries_pass_through_a_group_in_batches(spark, monkeypatch):
    """A task of the search holds one group and a batch of its queries: no cogroup; any cut gives the same answers."""
    import pyarrow as pa
    rng = np.random.default_rng(9)
    x = rng.integers(-3, 4, (300, 8)).astype("<f8")
    rows = [(g, 0, False, [i % 6 + 6 * g], i + 300 * g, v.tobytes()) for g in (0, 1) for i, v in enumerate(x)]
    asks = [(g, 0, True, [6 * g, 6 * g + 4], 1000 + i, x[i].tobytes()) for g in (0, 1) for i in range(40)]
    rows = sorted(rows + asks + [(2, 0, True, [12], 1000, x[0].tobytes())], key=lambda r: r[:5])
    names = ["grp", "block", "asks", "leaves", "id", "vec"]
    whole = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows]) for i in range(6)], names=names)
    found = []
    for size in (7, 64, len(rows)):
        out = list(ann_tree._search((whole.slice(i, size) for i in range(0, len(rows), size)), 5))
        assert all(b.num_rows <= 6 * size for b in out)
        found.append(sorted(zip(*(c for c in pa.Table.from_batches(out).to_pydict().values()))))
    assert found[0] == found[1] == found[2] and len(found[0]) == 2 * 40 * 6
    for i in (0, 17):
        score = x @ x[i]
        want = sorted((j for j in range(300) if j % 6 in (0, 4)), key=lambda j: (-score[j], j))[:6]
        assert {c for q, c, _ in found[0] if q == 1000 + i and c < 300} == set(want)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    made = ann_tree.nearest(df, k=5, every=3)
    assert "CoGroup" not in made._jdf.queryExecution().optimizedPlan().toString()
    want = sorted(map(tuple, made.collect()))
    for name, value in (("WALK_BYTES", 100), ("GROUP_BYTES", 64 * 40), ("CELLS", 50), ("QUERY_BLOCK", 30)):
        monkeypatch.setattr(ann_tree, name, value)
    assert sorted(map(tuple, ann_tree.nearest(df, k=5, every=3).collect())) == want and len(want) == 500


def corpus(spark, n=900):
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("abcdeiou"), 5)) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        w = list(rng.choice(words, int(rng.integers(20, 80))))
        if i % 3 == 0:
            w[len(w) // 2] = rng.choice(["vilefool", "dirtscum"])
        if i % 2:
            w = [x + "***" for x in w]
        rows.append((i, " ".join(w), "en"))
        labels.append((i, int(i % 2 == 0), int(i % 3 == 0)))
    rows += [(None, None, None), (n, "", "en")]
    return (spark.createDataFrame(rows, "doc_id long, text string, lang string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


@pytest.mark.parametrize("module,label,mod,value", [(toxicity, "toxic", 3, 1), (quality_net, "quality", 4, 2)])
def test_classifiers_on_held_out_rows(spark, module, label, mod, value):
    docs, labels = corpus(spark)
    got = module.classify(docs, labels).toPandas()
    assert len(got) == 902 and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.7)).all()
    y = {r["doc_id"]: r[label] for r in labels.collect()}
    named = got.dropna(subset=["doc_id"])
    assert (named.held_out == named.doc_id.map(lambda i: zlib.crc32(str(int(i)).encode()) % mod == value)).all()
    held = named[named.held_out & named.doc_id.isin(list(y))]
    assert (held.predicted == held.doc_id.map(y)).mean() > 0.95
    none = module.classify(docs, labels.limit(0)).toPandas()
    assert (none.score == 0.5).all()
    assert module.classify(docs.limit(0), labels).count() == 0


def test_index_vectors_do_not_depend_on_partitions(spark):
    docs, _ = corpus(spark, 60)
    a, b = (quality_net.vector_table(quality_net.word_vectors(docs.repartition(k))) for k in (1, 5))
    assert np.array_equal(a, b)


def test_pipeline_stages(spark, sf_small):
    import corpus_pipeline
    names = [k for k, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "simhash_near_dedup", "pii", "mixing", "packing"]
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_small)
        assert out.columns == docs.columns, name
    pieces = corpus_pipeline.run(spark, sf_small).toPandas()
    per = pieces.groupby("sequence_id")["length"].sum()
    assert per.max() <= 2048 and len(pieces)


def test_special_tokens_become_their_ids_on_request():
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(packing.default_vocabulary())
    encoder = packing.ChunkEncoder(packing.default_vocabulary(), special_tokens=True)
    for t, ids in zip(ODD, encoder.encode(pa.array(ODD, pa.string()))):
        assert ids.tolist() == [*model.encode(t or "", add_special_tokens=False).ids, packing.END_ID], repr(t)


def test_remainders_go_to_the_cheapest_sequence_with_room():
    rng = np.random.default_rng(3)
    # many long remainders leave little room each, so the cheapest sequences have none for the next
    lengths = [*rng.integers(1500, 2048, 300).tolist(), *rng.integers(1, 500, 900).tolist(), 5000, 0]
    got = [p for p in packing.pack(lengths) if p[2] < packing.CAPACITY]
    first = sum(n // packing.CAPACITY for n in lengths)
    tails = sorted(((n % packing.CAPACITY, d, n - n % packing.CAPACITY) for d, n in enumerate(lengths)
                    if n % packing.CAPACITY), key=lambda t: (-t[0], t[1]))
    room = packing.capacities(sum(t[0] for t in tails))
    spent, free, want = [0.0] * len(room), list(room), []
    for length, d, start in tails:
        while length:
            fit = [i for i in range(len(room)) if free[i] >= length] or [i for i in range(len(room)) if free[i]]
            i = min(fit, key=lambda i: (spent[i], free[i], i))
            part = min(length, free[i])
            want.append((d, start, part, first + i, room[i] - free[i]))
            free[i] -= part
            spent[i] += packing.cost(part)
            start, length = start + part, length - part
    assert got == want


def test_no_text_is_lost_where_ids_repeat(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in ("alpha", "beta", "gamma"))
    rows = [(3, a), (7, a), (7, b), (9, b), (7, c), (7, c), (1, b + " end"), (None, a), (20, "lonely words only here")]
    df = spark.createDataFrame([(i, t, "x", 5) for i, t in rows], "doc_id long, text string, root string, fp int")
    kept = sorted(((r["doc_id"] or 0, r["text"]) for r in simhash.drop_near_duplicates(df).collect()))
    fp = {t: plain_fingerprint(t) for _, t in rows}
    least_b = (1, b + " end") if int(np.bitwise_count(np.uint64(fp[b] ^ fp[b + " end"]))) <= 4 else None
    want = [(0, a), (3, a), (7, c), (20, "lonely words only here")] + ([least_b] if least_b else [(1, b + " end"), (7, b)])
    assert kept == sorted(want)
    assert simhash.drop_near_duplicates(df).columns == df.columns


@pytest.mark.parametrize("module", [toxicity, quality_net])
def test_classifiers_ignore_other_columns_and_repeated_ids(spark, module):
    docs, labels = corpus(spark, 240)
    odd = docs.selectExpr("*", "1 as _id", "2 as _y", "3 as _t", "4 as score")
    twice = odd.union(odd.where("doc_id < 50").withColumn("text", odd.text.substr(1, 40)))
    # up to the last digits: a matrix product's rounding depends on the batch's rows
    one, two = (sorted((repr(r["doc_id"]), round(r["score"], 9), r["predicted"]) for r in
                       module.classify(twice.repartition(k), labels).collect()) for k in (1, 7))
    assert one == two and len(one) == 292


def test_ftrl_equals_the_plain_per_coordinate_form():
    rng = np.random.default_rng(11)
    bits, rows = 6, [np.unique(rng.integers(0, 64, rng.integers(0, 12))) for _ in range(80)]
    y = (rng.random(80) < 0.4).astype(float)
    weights, bias = toxicity.fit_ftrl(rows, y, bits=bits, epochs=3)
    l1 = min(toxicity.L1_MOST, toxicity.L1_PER_ROW * min(y.sum(), 80 - y.sum()))
    z, n = [0.0] * 65, [0.0] * 65

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * l1) / ((toxicity.BETA + n[i] ** 0.5) / toxicity.ALPHA + toxicity.L2)
    order = np.random.default_rng(0)
    for _ in range(3):
        for k in order.permutation(80):
            on = [*rows[k].tolist(), 64]
            w = {i: weight(i) for i in on}
            g = 1 / (1 + np.exp(-sum(w.values()))) - y[k]
            for i in on:
                s = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / toxicity.ALPHA
                z[i] += g - s * w[i]
                n[i] += g * g
    assert np.allclose([*weights, bias], [weight(i) for i in range(65)], atol=1e-9) and (weights != 0).any()


def test_word_vectors_equal_plain_random_indexing(spark, monkeypatch):
    monkeypatch.setattr(quality_net, "COUNT_WORDS", 70)
    docs, _ = corpus(spark, 30)
    at, sign = quality_net._index_vectors()
    want = {}
    for r in docs.collect():
        word, shape, _, _, _ = quality_net.buckets(pa.array([r["text"]], pa.string()))
        for x in (word, shape):
            for i, b in enumerate(x):
                v = want.setdefault(int(b), np.zeros(quality_net.DIMS, int))
                for j in range(max(0, i - 2), min(len(x), i + 3)):
                    if j != i:
                        v[at[x[j]]] += sign[x[j]]
    got = {r["bucket"]: np.array(r[2:]) for r in quality_net.word_vectors(docs).collect()}
    assert got.keys() == want.keys() and all((got[k] == want[k]).all() for k in want)


LINE = "The article goes on with a sentence that is long enough to be read as text."
AROUND = '<nav><a href="/x">Home</a></nav>', "<footer>Copyright us</footer>"


@pytest.mark.parametrize("frame", [
    '<div style="overflow:hidden">{}</div>', '<div aria-hidden="false">{}</div>', '<div class="page-hidden-nav">{}</div>',
    '<form id="aspnetForm">{}</form>', '<div class="search share">{}</div>', '<form><div data-hidden="1">{}</div></form>'])
def test_frames_around_an_article_do_not_hide_it(frame):
    article = f"<article><h1>A title</h1><p>{LINE}</p><p>Short one</p><p>{LINE}</p></article>"
    want = f"A title\n{LINE}\nShort one\n{LINE}"
    page = AROUND[0] + frame.format(article) + AROUND[1]
    assert html_mincut.extract(page)[0] == want
    styled = f'<article style="overflow: hidden"><div class="share-title"><h1>A title</h1></div><p>{LINE}</p></article>'
    assert html_mincut.extract(AROUND[0] + styled + AROUND[1])[0] == f"A title\n{LINE}"


def test_hidden_parts_and_unmarked_comments_go():
    for attrs in ("hidden", 'style="color:red; display : none"', 'aria-hidden="true"'):
        assert html_mincut.extract(f"<div {attrs}><p>{LINE}</p></div><article><p>{LINE}</p></article>")[0] == LINE, attrs
    for head in ("Comments", "3 comments", "Leave a reply", "Reader comments (12)"):
        page = f"<article><p>{LINE}</p></article><section><h3>{head}</h3><p>{LINE} {LINE} {LINE}</p></section>"
        assert html_mincut.extract(page)[0] == LINE, head
    inside = f'<article><p>{LINE}</p><aside><p>{LINE}</p></aside><div class="comments"><p>{LINE} {LINE}</p></div></article>'
    assert html_mincut.extract(inside)[0] == LINE


def test_a_form_around_the_whole_page_is_no_furniture():
    body = f"<div><p>{LINE} {LINE}</p><p>{LINE} {LINE}</p></div>"
    assert html_mincut.extract(f'<form id="f">{AROUND[0]}{body}</form>')[0] == "\n".join([f"{LINE} {LINE}"] * 2)


def test_the_cut_decides_where_costs_alone_do_not():
    """Unmarked blocks whose own cost has the wrong sign follow their neighbours."""
    long = f"<p>{LINE} {LINE}</p>"
    page = f"<div>{long}<p>But then</p>{long}</div>"
    found = html_mincut.blocks_of(page)
    assert [html_mincut._cost(*b) > 0 for b in found] == [True, False, True]
    assert html_mincut.extract(page)[2] == 3
    links = "".join(f'<li><a href="/{i}">Link number {i}</a></li>' for i in range(6))
    page = f"<div>{long}{long}</div><div><ul>{links}<li>More of it to be read here, quite a long one.</li>{links}</ul></div>"
    found = html_mincut.blocks_of(page)
    assert [html_mincut._cost(*b) > 0 for b in found].count(True) == 3
    assert html_mincut.extract(page)[0] == "\n".join([f"{LINE} {LINE}"] * 2)

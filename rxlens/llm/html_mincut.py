"""Operator 1: HTML main-text extraction by minimum-cut labelling.

A page is cut into text blocks.  A small linear classifier over the block's
containers, link density and wording gives each block a signed cost, which
becomes a terminal capacity (content side or boilerplate side).  Smoothness
edges join neighbours in page order and the next block of the same container,
stronger the more of the DOM path two blocks share.  Max-flow separates
content from boilerplate; the content blocks are joined in page order.

Each page is judged on its own (a narrow Arrow-batched map, no shuffle).

Defined results: null or empty html and pages without content give an empty
text; unclosed or cut-off tags are markup; repeated rows give repeated
results; extra columns pass through (the result is one struct column).
"""

from __future__ import annotations

import html as _html
import re
from collections import deque

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_blocks", T.IntegerType()),
                       T.StructField("n_content", T.IntegerType())])

# fixed values: HTML element names by role
RAW = "script style textarea title"
SKIPPED = "noscript template svg math iframe object select canvas video audio"
INLINE = ("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
          "samp small span strike strong sub sup time tt u var wbr")
VOID = "area base br col embed hr img input link meta param source track wbr"
PARAGRAPH = "p li dd dt h1 h2 h3 h4 h5 h6 tr td th"
BOILER_TAGS = "nav header footer aside form menu dialog button fieldset"
CONTENT_TAGS = "article main"
# fixed values: class, id and role words of page furniture
BOILER_WORDS = ("ad ads adv advert advertisement advertising aside banner breadcrumb breadcrumbs comment comments "
                "complementary contentinfo cookie cookies consent copyright disclaimer disqus footer form gdpr header "
                "login menu modal nav navbar navigation newsletter notice notification pagination pager popup "
                "promo promotion related reply replies respond search share sharing sidebar signup social sponsor "
                "sponsored subscribe tags toolbar widget")
# words beside them: the name tells the layout, or the head of the text itself
LAYOUT_WORDS = "no not without has with"
TEXT_WORDS = "entry post article story content"
HEAD_WORDS = "header banner"
HEADINGS = ("h1", "h2", "h3", "h4")
(RAW, SKIPPED, INLINE, VOID, PARAGRAPH, BOILER_TAGS, CONTENT_TAGS, BOILER_WORDS, LAYOUT_WORDS, TEXT_WORDS,
 HEAD_WORDS) = (frozenset(x.split()) for x in (RAW, SKIPPED, INLINE, VOID, PARAGRAPH, BOILER_TAGS, CONTENT_TAGS,
                                               BOILER_WORDS, LAYOUT_WORDS, TEXT_WORDS, HEAD_WORDS))

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(sorted(RAW)) + r")(?![\w:.-])[^>]*(?:>.*?(?:</(?P=raw)\s*>|\Z)|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)", re.S | re.I)
SKIP_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in SKIPPED}
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
HINT_SPLIT = re.compile(r"[^a-z]+")
NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
# headings over reader comments
COMMENT_HEAD = re.compile(r"(?:\d+ )?(?:(?:reader|user|your|all|latest) )?(?:comments?|replies|responses)(?: \(?\d+\)?)?:?"
                          r"|(?:leave|post|add|write) a (?:comment|reply)|join the (?:discussion|conversation)", re.I)
SPACE = re.compile(r"\s+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

# classifier weights (positive: content) and smoothness strengths
W_BOILER, W_WEAK, W_CONTENT, W_HEADING, W_TITLE = -4.0, -1.2, 2.5, 1.0, 4.0
W_LINKS, W_SHORT, W_LONG, W_SENTENCE, W_BIAS = -2.5, -0.6, 1.0, 0.6, 0.1
S_ADJACENT, S_CONTAINER, S_APART = 0.9, 0.5, 0.15
# an element around this share of the page's text is a frame of the page, whatever its name
FRAME_SHARE = 0.6
# evidence of furniture: weak, a class word, a tag or hidden
WEAK, WORD, TAG = 1, 2, 3


class _Node:
    __slots__ = ("tag", "parent", "depth", "own", "chars", "holds", "evidence")

    def __init__(self, tag, parent, own):
        self.tag, self.parent, self.own = tag, parent, own
        self.depth = parent.depth + 1 if parent else 0
        self.chars, self.holds, self.evidence = 0, False, (0, False)


def _word_level(name: str) -> int:
    """Evidence of furniture in one class, id or role name."""
    words = set(HINT_SPLIT.split(name))
    found = words & BOILER_WORDS
    if not found or words & LAYOUT_WORDS:
        return 0
    return WEAK if found <= HEAD_WORDS and words & TEXT_WORDS else WORD


def _own_evidence(tag: str, attrs: str) -> int:
    """Evidence of page furniture in an element's name and attributes."""
    found = TAG if tag in BOILER_TAGS else 0
    if not attrs or tag in ("body", "html"):
        return found
    for m in ATTRIBUTE.finditer(attrs):
        name, value = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
        if (name == "hidden" or name == "style" and NO_DISPLAY.search(value)
                or name == "aria-hidden" and value.strip().lower() == "true"):
            return TAG
        if name in ("class", "id", "role"):
            found = max([found, *map(_word_level, CAMEL.sub("-", value).lower().split())])
    return found


def _judge(nodes: list[_Node], found: list[tuple[str, _Node, int]]) -> None:
    """``evidence`` of every element: (evidence of page furniture, inside article), its containers' included.

    An element around an article, or around most of the page's text, is weak
    evidence against what it holds, a form around most of the page none.  A heading such as "Comments" is a class
    word of the container it opens.
    """
    first = {}
    for text, node, _ in found:
        node.chars += len(text)
        if node.parent is not None and first.setdefault(id(node.parent), node) is node and node.tag in HEADINGS \
                and COMMENT_HEAD.fullmatch(text) and node.parent.tag not in ("body", "html", "") \
                and node.parent.tag not in CONTENT_TAGS:
            node.parent.own = max(node.parent.own, WORD)
    for n in reversed(nodes):  # children come after their parents
        if n.parent is not None:
            n.parent.chars += n.chars
            n.parent.holds |= n.holds or n.tag in CONTENT_TAGS and n.chars > 0
    total = nodes[0].chars
    for n in nodes[1:]:
        boiler, content = n.parent.evidence
        frame = n.chars > FRAME_SHARE * total
        own = 0 if frame and n.tag == "form" else min(n.own, WEAK) if n.holds or frame else n.own
        n.evidence = max(boiler, own), content or n.tag in CONTENT_TAGS


def blocks_of(page: str) -> list[tuple[str, _Node, int]]:
    """Text blocks in page order: (text, container element, characters inside links)."""
    node = _Node("", None, 0)
    nodes = [node]
    out, buf, links, in_link, pos = [], [], 0, 0, 0
    unclosed = set()

    def flush():
        nonlocal links
        if buf:
            text = SPACE.sub(" ", _html.unescape("".join(buf))).strip()
            if text:
                out.append((text, node, links))
            buf.clear()
        links = 0

    def pop_to(tags, stop=()):
        n = node
        while n.parent is not None and n.tag not in stop:
            if n.tag in tags:
                return n.parent
            n = n.parent
        return node

    while (m := TOKEN.search(page, pos)) is not None:
        if m.start() > pos:
            piece = page[pos:m.start()]
            buf.append(piece)
            if in_link:
                links += len(piece)
        pos = m.end()
        tag = m.group("tag")
        if tag is None:
            continue
        tag = tag.lower()
        if tag in SKIPPED and not m.group("close"):
            if m.group("attrs").endswith("/"):
                continue
            end = None if tag in unclosed else SKIP_END[tag].search(page, pos)
            if end:
                pos = end.end()
                continue
            unclosed.add(tag)  # only the tag is markup: the rest of the page is not its content
            continue
        if tag in INLINE:
            if tag == "a":
                in_link = 0 if m.group("close") else 1
            elif tag == "br":
                buf.append(" ")
            elif tag in ("img", "wbr"):
                pass
            continue
        flush()
        if m.group("close"):
            in_link = 0
            node = pop_to((tag,))
            continue
        if tag in PARAGRAPH:  # the start of a paragraph ends an open one of its kind
            if tag in ("td", "th"):
                node = pop_to(("td", "th"), ("tr", "table"))
            elif tag == "li":
                node = pop_to(("li",), ("ul", "ol", "menu"))
            elif tag == "tr":
                node = pop_to(("tr",), ("table",))
            elif node.tag == "p" or node.tag == tag:
                node = node.parent
        elif node.tag == "p":
            node = node.parent
        if tag not in VOID and not m.group("attrs").endswith("/"):
            node = _Node(tag, node, _own_evidence(tag, m.group("attrs")))
            nodes.append(node)
    buf.append(page[pos:])
    flush()
    _judge(nodes, out)
    return out


def _cost(text: str, node: _Node, links: int) -> float:
    boiler, content = node.evidence
    w = W_BIAS + (W_CONTENT if content and boiler <= WEAK else 0.0)
    if boiler == WEAK:
        w += W_WEAK
    elif boiler:
        title = content and (node.tag == "h1" and boiler == WORD or node.tag in ("h1", "h2") and _header_only(node))
        w += W_BOILER + (W_TITLE if title else 0.0)
    density = min(1.0, links / len(text))
    w += W_LINKS * density
    n = len(text)
    w += W_SHORT if n < 30 else W_LONG if n >= 120 else 0.0
    if text[-1] in ".!?…\"'»”":
        w += W_SENTENCE
    if node.tag in HEADINGS:
        w += W_HEADING
    return w


def _header_only(node: _Node) -> bool:
    """The furniture around a heading is the article's own header."""
    n, seen = node.parent, 0
    while n is not None and n.tag not in CONTENT_TAGS:
        if n.evidence[0] > WEAK and n.tag not in ("header", "div", "hgroup", "section"):
            return False
        seen += n.tag == "header"
        n = n.parent
    return n is not None and n.evidence[0] <= WEAK and seen == 1


def _proximity(a: _Node, b: _Node) -> float:
    """Share of the DOM path two containers have in common (1: the same container or its paragraphs)."""
    if a.evidence != b.evidence:
        return S_APART
    depth = max(a.depth, b.depth) or 1
    while a.depth > b.depth:
        a = a.parent
    while b.depth > a.depth:
        b = b.parent
    while a is not b:
        a, b = a.parent, b.parent
    return (a.depth + 1) / depth if a.depth + 1 < depth else 1.0


def min_cut(weights: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Side of each node in a minimum s-t cut: True if with the source.

    ``weights[i]`` > 0 is the capacity source -> i, < 0 the capacity i -> sink;
    ``edges`` are undirected (i, j, capacity).  Dinic's level graphs with an
    explicit stack.
    """
    n = len(weights)
    s, t = n, n + 1
    to: list[int] = []
    cap: list[float] = []
    adj: list[list[int]] = [[] for _ in range(n + 2)]

    def add(u, v, c, back):
        adj[u].append(len(to)); to.append(v); cap.append(c)
        adj[v].append(len(to)); to.append(u); cap.append(back)

    for i, w in enumerate(weights):
        if w > 0:
            add(s, i, w, 0.0)
        elif w < 0:
            add(i, t, -w, 0.0)
    for i, j, c in edges:
        add(i, j, c, c)
    eps = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque((s,))
        while queue:
            u = queue.popleft()
            for e in adj[u]:
                v = to[e]
                if level[v] < 0 and cap[e] > eps:
                    level[v] = level[u] + 1
                    queue.append(v)
        if level[t] < 0:
            return [level[i] >= 0 for i in range(n)]
        at = [0] * (n + 2)
        path: list[int] = []
        u = s
        while True:
            if u == t:
                flow = min(cap[e] for e in path)
                for k, e in enumerate(path):
                    cap[e] -= flow
                    cap[e ^ 1] += flow
                k = next(k for k, e in enumerate(path) if cap[e] <= eps)
                u = to[path[k] ^ 1]
                del path[k:]
                continue
            moved = False
            while at[u] < len(adj[u]):
                e = adj[u][at[u]]
                v = to[e]
                if cap[e] > eps and level[v] == level[u] + 1:
                    path.append(e)
                    u = v
                    moved = True
                    break
                at[u] += 1
            if moved:
                continue
            if u == s:
                break
            level[u] = -1
            e = path.pop()
            u = to[e ^ 1]
            at[u] += 1


def extract(page: str | None) -> tuple[str, int, int]:
    """(main text, number of text blocks, number of content blocks) of one page."""
    if not page:
        return "", 0, 0
    found = blocks_of(page)
    if not found:
        return "", 0, 0
    weights = [_cost(*b) for b in found]
    edges, last = [], {}
    for i, (_, node, _) in enumerate(found):
        holder = node.parent if node.tag in PARAGRAPH and node.parent is not None else node
        if i:
            before = found[i - 1][1]
            edges.append((i - 1, i, S_ADJACENT * _proximity(before, node)))
            j = last.get(id(holder))
            if j is not None and j != i - 1:
                edges.append((j, i, S_CONTAINER * _proximity(found[j][1], node)))
        last[id(holder)] = i
    keep = min_cut(weights, edges)
    kept = [b[0] for b, k in zip(found, keep) if k]
    return "\n".join(kept), len(found), len(kept)


@F.pandas_udf(RESULT)
def _extract_udf(pages: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([extract(p) for p in pages], columns=["text", "n_blocks", "n_content"])


def main_text(html: str | Column) -> Column:
    """Struct column (text, n_blocks, n_content) of an html column."""
    return _extract_udf(html)


def extract_pages(pages: DataFrame, html: str = "html", into: str = "main") -> DataFrame:
    """``pages`` with one struct column ``into`` (replaced if it is there)."""
    return pages.withColumn(into, main_text(html))

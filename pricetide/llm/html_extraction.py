"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks of text at block-level tags.  A linear classifier gives each block a score from its words,
links and the marks of its ancestors (tags, class and id words); a positive score is the capacity from the source
(content), a negative one that to the sink (boilerplate).  Smoothness edges join blocks that follow each other, the
heavier the nearer they stand in the DOM.  The minimum cut, found by max-flow, labels all blocks of a page at once.
Blocks whose score outweighs all their edges have the label of their score in every minimum cut; they are decided
first, which leaves few blocks for the flow.

There are no labelled pages to train on, so the classifier's weights are fixed parameters.

Defined results: null or empty html, and pages without content, give an empty text.  ``<br>`` is white space.
Unclosed tags end with their parent or, where the standard says so, at the next block.  Comments, scripts and styles
that never end run to the end of the page if HTML reads them as raw text; others drop nothing then.  A page of any length is read whole.  Repeated rows are treated alike and
never merged.  Other columns pass through, but for ``text`` and ``n_chars``, which are replaced.  An empty table
gives an empty result.
"""

from __future__ import annotations

import re
from collections import deque
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from pricetide.llm.common import read_table

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|title|iframe|textarea)\b[^>]*>"
    r".*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|</?[a-zA-Z][^>]*>",
    re.S | re.I)
_MARK = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)", re.I)
_MAY_HIDE = re.compile(r"hidden|display\s*:\s*none", re.I)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*))?")
_NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_WORDS = re.compile(r"[A-Za-z][a-z]*")

# Elements of HTML.  The text of dropped ones goes up to their own end tag, that of MathML stays.
DROPPED = frozenset("svg object select template annotation annotation-xml".split())
MATHML = frozenset("math mi mn mo ms mspace mtext merror mfrac mmultiscripts mover mpadded mphantom mprescripts mroot mrow "
                   "msqrt mstyle msub msubsup msup mtable mtd mtr munder munderover none semantics".split())
_DROPPED = re.compile("<(?:" + "|".join(DROPPED) + r")\b", re.I)
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY_NEXT = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
                  "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table tr td th div section article aside nav header footer main form body".split())
# Words of marks; a mark of boilerplate beats one of content in the same element.
BOILER_TAGS = frozenset("nav header footer aside form menu dialog button label fieldset head".split())
CONTENT_TAGS = frozenset("article main".split())
BOILER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "notice notices gdpr alert sidebar aside menu menus nav navbar navigation navigationbar breadcrumb breadcrumbs "
    "pagination pager footer foot header masthead topbar comment comments disqus reply replies respond share sharing "
    "social related recommended recommendations popular trending subscribe subscription newsletter signup login "
    "register popup modal overlay search widget toolbar copyright legal complementary contentinfo teaser tags meta "
    "form skip outbrain taboola".split())
CONTENT_WORDS = frozenset("article content post entry story main body text maincontent articlebody".split())


@dataclass(frozen=True)
class Weights:
    content_mark: float = 4.0
    boiler_mark: float = -5.0
    words_per_point: float = 15.0
    most_for_words: float = 3.0
    sentence: float = 0.7
    linked: float = -3.0
    short: float = -0.8
    few_words: int = 6
    top_heading: float = 1.5
    list_item: float = -0.7
    notice: float = -2.0
    next_block: float = 1.2
    block_after: float = 0.4


_NOTICE = re.compile(r"©|\(c\) *\d{4}|all rights reserved|cookie|subscribe|newsletter|privacy policy", re.I)


def _hides(attributes: str) -> bool:
    """The element has the attribute ``hidden``, or a style that does not display it."""
    if not _MAY_HIDE.search(attributes):
        return False
    return any(m[1].lower() == "hidden" or (m[1].lower() == "style" and _NOT_SHOWN.search((m[2] or "").strip("\"'")))
               for m in _ATTRIBUTE.finditer(attributes))


class _Node:
    __slots__ = ("tag", "parent", "depth", "mark", "linked", "skip")

    def __init__(self, tag, parent, attributes):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.mark = 0
        if tag in BOILER_TAGS:
            self.mark = -1
        elif tag in CONTENT_TAGS:
            self.mark = 1
        if attributes and tag not in ("body", "html"):
            words = {w.lower() for m in _MARK.findall(attributes) for w in _WORDS.findall(m)}
            if words & BOILER_WORDS:
                self.mark = -1
            elif not self.mark and words & CONTENT_WORDS:
                self.mark = 1
        self.linked = tag == "a" or bool(parent and parent.linked and tag in INLINE)
        self.skip = bool(parent and parent.skip) or bool(attributes and _hides(attributes))


class _Block:
    __slots__ = ("text", "node", "n_words", "linked")

    def __init__(self, text, node, n_words, linked):
        self.text, self.node, self.n_words, self.linked = text, node, n_words, linked


def _dropped(tokens: list) -> dict[int, int]:
    """The end tag of each dropped element that has one, by the place of its start tag."""
    ends, opened = {}, {name: [] for name in DROPPED}
    for k, m in enumerate(tokens):
        name = (m[3] or "").lower()
        if name in DROPPED:
            if not m[2]:
                if name != "svg" or not m[4].endswith("/"):
                    opened[name].append(k)
            elif opened[name]:
                ends[opened[name].pop()] = k
    return ends


def blocks_of(html: str) -> list[_Block]:
    """The page's blocks, in order."""
    root = node = _Node("", None, "")
    out: list[_Block] = []
    parts: list[tuple[str, bool]] = []
    at = 0
    holder = root  # the block-level element of the text so far

    def flush():
        if parts:
            words = "".join([t for t, _ in parts]).split()
            if words:
                linked = sum([len(t.split()) for t, in_link in parts if in_link])
                out.append(_Block(" ".join(words), holder, len(words), linked))
            parts.clear()

    def text(raw):
        if raw and not node.skip:
            parts.append((unescape(raw), node.linked))

    tokens = list(_TOKEN.finditer(html))
    ends, last = _dropped(tokens) if _DROPPED.search(html) else {}, -1
    for k, m in enumerate(tokens):
        if k <= last:
            at = m.end()
            continue
        if m.start() > at:
            text(html[at:m.start()])
        at = m.end()
        name = m[3]
        if name is None:
            if m[1] and m[1].lower() in ("title", "iframe", "textarea"):
                flush()
            continue
        tag = name.lower()
        if tag in DROPPED or tag in MATHML:
            last = ends.get(k, -1)
            if tag in ("object", "select"):
                flush()
            continue
        if m[2]:
            target = node
            while target is not root and target.tag != tag:
                # An end tag of an inline element does not close blocks.
                if tag in INLINE and target.tag not in INLINE:
                    target = root
                    break
                target = target.parent
            if tag not in INLINE:
                flush()
            if target is not root:
                node = target.parent
        else:
            if tag not in INLINE:
                flush()
                node = _implied(node, root, tag)
            elif tag == "br":
                text(" ")
            if tag not in VOID:
                node = _Node(tag, node, m[4])
        holder = node
        while holder.tag in INLINE and holder.parent:
            holder = holder.parent
    if at < len(html):
        text(html[at:])
    flush()
    return out


def _implied(node, root, tag):
    """The element that a block-level start tag goes into: open paragraphs and list items before it end."""
    ends = CLOSED_BY_NEXT.get(tag)
    target = node
    while target is not root:
        if target.tag == "p" or (ends and target.tag in ends):
            return target.parent
        if target.tag in SCOPES:
            break
        target = target.parent
    while node is not root and node.tag in INLINE:
        node = node.parent
    return node


def score(block: _Block, w: Weights) -> float:
    """The classifier: over zero for content."""
    mark, inner_header, heading, node = 0, False, False, block.node
    heading = node.tag in ("h1", "h2", "h3", "h4", "h5", "h6")
    item = False
    while node is not None and not mark:
        if node.tag == "header" and node.mark < 0 and heading:
            inner_header = True  # a heading's header counts as what is around it
        else:
            mark = node.mark
        item = item or node.tag == "li"
        node = node.parent
    if inner_header and not mark:
        mark = -1
    s = w.content_mark if mark > 0 else w.boiler_mark if mark < 0 else 0.0
    s += min(w.most_for_words, block.n_words / w.words_per_point)
    if block.text[-1] in ".!?…\"”»":
        s += w.sentence
    if 2 * block.linked > block.n_words:
        s += w.linked
    if block.n_words < w.few_words:
        s += w.short
    if block.node.tag == "h1":
        s += w.top_heading
    if item:
        s += w.list_item
    if mark <= 0 and _NOTICE.search(block.text):
        s += w.notice
    return s


def dom_distance(a: _Node, b: _Node) -> int:
    """Steps from one element to the other over their nearest common ancestor."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def min_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the source's side of a minimum cut.

    A score is the capacity from the source if positive, to the sink if negative; edges go both ways.
    """
    n = len(scores)
    links: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, c in edges:
        links[a][b] = links[a].get(b, 0.0) + c
        links[b][a] = links[b].get(a, 0.0) + c
    scores, label = list(scores), [None] * n
    # Decide what every minimum cut decides alike; a decided node's edges become scores of its neighbours.
    waiting = deque(range(n))
    while waiting:
        v = waiting.popleft()
        if label[v] is None and abs(scores[v]) > sum(links[v].values()):
            label[v] = scores[v] > 0
            for u, c in links[v].items():
                scores[u] += c if label[v] else -c
                del links[u][v]
                waiting.append(u)
            links[v] = {}
    free = [v for v in range(n) if label[v] is None]
    # Max-flow over the others: shortest augmenting paths from nodes with supply to nodes with demand.
    left = {v: scores[v] for v in free}
    while True:
        came, queue, end = {v: None for v in free if left[v] > 1e-9}, deque(v for v in free if left[v] > 1e-9), None
        while queue and end is None:
            v = queue.popleft()
            for u, c in links[v].items():
                if c > 1e-9 and u not in came:
                    came[u] = v
                    if left[u] < -1e-9:
                        end = u
                        break
                    queue.append(u)
        if end is None:
            break
        path, v = [], end
        while came[v] is not None:
            path.append((came[v], v))
            v = came[v]
        flow = min(left[v], -left[end], min(links[a][b] for a, b in path))
        for a, b in path:
            links[a][b] -= flow
            links[b][a] += flow
        left[v] -= flow
        left[end] += flow
    for v in free:
        label[v] = v in came
    return label


def main_text(html: str | None, weights: Weights = Weights()) -> str:
    """The content blocks of a page, one to a line."""
    blocks = blocks_of(html or "")
    edges = [(i, j, base / (1 + dom_distance(blocks[i].node, blocks[j].node)))
             for step, base in ((1, weights.next_block), (2, weights.block_after))
             for i, j in zip(range(len(blocks)), range(step, len(blocks)))]
    keep = min_cut([score(b, weights) for b in blocks], edges)
    return "\n".join(b.text for b, k in zip(blocks, keep) if k)


def extract_pages(pages: DataFrame, html: str = "html", weights: Weights = Weights()) -> DataFrame:
    """``pages`` without the html, with ``text`` and ``n_chars``."""
    others = [f for f in pages.schema.fields if f.name != html and f.name.lower() not in ("text", "n_chars")]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in others] + ["text string", "n_chars bigint"])

    def run(batches):
        for batch in batches:
            texts = [main_text(h, weights) for h in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                list(batch.columns[1:]) + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[f.name for f in others] + ["text", "n_chars"])

    return pages.select(html, *[f.name for f in others]).mapInArrow(run, schema)


def op7(spark, folder: str) -> DataFrame:
    return extract_pages(read_table(spark, folder, "pages"))

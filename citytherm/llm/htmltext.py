"""Main text of web pages: minimum-cut labelling of blocks.

A page is read once into blocks of text (paragraphs, headings, list items, table
rows, loose text) with the containers that they stand in.  Each block is labelled
content or boilerplate so that the total cost is least:

* a terminal capacity per block from a classifier: a logistic model over the
  block's shape (length, links, punctuation, kind, place), trained here, plus the log
  odds that its containers hint at (``article``, ``nav``, class words);
* smoothness edges between neighbours on the page, weaker over container borders;
* edges between successive blocks of one container (DOM proximity).

Hints are finite and of the order of the shape's odds, and edges join blocks of
any hints, so shape and neighbours can outvote them.  Each element is read anew:
``article`` and ``main`` start over whatever stands around them, and a class word
of boilerplate weighs by the share of the page's text outside its element, so a
wrapper (``page with-header``, ``body class="has-sidebar"``) says nothing.

The minimum cut comes from a maximum flow (Dinic) on the page's own small graph.

The classifier's training blocks are those of at most ``sample_pages`` pages
(smallest hashes) whose containers hint clearly at a label; the shape model learns
from them and weighs in on every block.  All pages are then
labelled in one map, page by page: no page meets another one.

Defined cases: null and empty html give empty text; broken markup is read as far
as it goes (an unfinished tag at the end is dropped, unknown references stay as
they are); only scripts, styles, text areas and comments swallow markup; what is
not shown (``head``, ``svg``, ``button``, ``hidden`` ...) ends with its own or its
parent's end tag, ``head`` also with the first tag or text that cannot stand in it; without training blocks the shape model is 0 and containers alone
decide; repeated rows and null ids are carried; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citytherm.llm.common import spread, table

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(script|style|textarea)(?=[\s/>]|$)[^>]*(?:>.*?(?:</\1\s*>|$)|$)"
                    r"|<(/?)([a-zA-Z][\w:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|$)|<[!?][^>]*(?:>|$)", re.S | re.I)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr pre address figcaption summary caption hr legend".split())
_CONTAINERS = frozenset("html body div section article main nav header footer aside form ul ol dl table tbody thead tfoot blockquote figure "
                        "details dialog fieldset menu center".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HIDDEN = frozenset("head title noscript template select svg foreignobject iframe object button".split())
_HEAD = frozenset("head title meta link base script style noscript template object".split())  # what may stand in a head
_CLOSED = frozenset("p h1 h2 h3 h4 h5 h6".split())  # a block that starts closes these
_NOT_CONTENT = frozenset("nav footer aside form menu dialog".split())
_CONTENT = frozenset("article main".split())
_NOT_CONTENT_WORDS = frozenset(
    "nav navigation navbar menu breadcrumb breadcrumbs header masthead footer sidebar aside rail ad ads advert adverts advertisement advertising banner "
    "promo promotion sponsor sponsored cookie cookies consent notice notices alert popup modal overlay newsletter subscribe subscription "
    "signup login search share sharing social related recommended recommendations comment comments reply replies disqus respond pagination pager widget "
    "copyright legal disclaimer toolbar skip".split())
_CONTENT_WORDS = frozenset("article post entry story content".split())
_THREAD_WORDS = frozenset("comment comments commentlist reply replies respond disqus".split())  # first words of what holds readers' comments
_SWITCH_WORDS = frozenset("open opened closed on off enabled disabled allowed count counter link".split())  # last words of what only tells of them
_THREAD = -3.0  # hint inside readers' comments, whatever their share: more than shape and neighbours can outvote
_WORD = 0.75  # weight of a class word beside a tag that states its label
_ABOVE = 0.25  # what is left of the hint around an element that says the opposite
_CLEAR = 0.5  # hints that label training blocks
KINDS = ("p", "heading", "item", "row", "loose")


@dataclass
class Block:
    kind: str
    text: str
    links: int  # characters inside links
    parent: int  # nearest container
    holder: int  # nearest element of those read
    hint: float = 0.0  # log odds of content by the containers, in units of ``Settings.stated``


@dataclass
class Settings:
    sample_pages: int = 2_000  # bound on the pages whose blocks train the shape model
    stated: float = 4.0  # log odds of a tag that states its label
    near: float = 0.8  # smoothness between neighbours in one container
    far: float = 0.3  # ... over a container border
    sibling: float = 0.6  # successive blocks of one container
    shape_limit: float = 4.0
    weights: list[float] = field(default_factory=list)


def _says(tag: str, attributes: str) -> tuple[int, bool, bool, bool, bool]:
    """What a tag states of what it holds (1, -1, 0), whether its class words name
    content, boilerplate and readers' comments, and whether it is hidden."""
    says = -1 if tag in _NOT_CONTENT else 1 if tag in _CONTENT else 0
    good = bad = thread = False
    if attributes:
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (
                    name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
                return -1, False, False, False, True
            if name in ("class", "id", "role") and tag != "a":  # a link's words are about its goal
                words = {w.lower() for w in _WORDS.findall(value)}
                bad = bad or bool(words & _NOT_CONTENT_WORDS) or value.lower() in ("complementary", "contentinfo", "dialog")
                good = good or bool(words & _CONTENT_WORDS)
                if tag not in ("html", "body", "main") and name != "role":
                    for names in (_WORDS.findall(w.lower()) for w in value.split()):
                        thread = thread or bool(names) and names[0] in _THREAD_WORDS and names[-1] not in _SWITCH_WORDS
    return says, good, bad, thread, False


def _hint(tag: str, says: tuple[int, bool, bool, bool], above: float, share: float) -> float:
    """The hint inside an element that holds ``share`` of the page's text, from the
    hint ``above`` it."""
    stated, good, bad, thread = says
    if thread or above <= _THREAD:
        return _THREAD
    if tag == "header" and above <= 0:
        stated = -1
    against = _ABOVE * max(above, 0.0)
    if tag == "form":  # around most of a page it says nothing of it
        return share * above + (1 - share) * (against - 1)
    if stated < 0:
        return against - 1
    if bad:
        # an element with much of the page is no sidebar; other words or an article tell the more, the larger it is
        base = 1.0 if stated else _WORD if good else above
        return share * base + (1 - share) * (against - _WORD)
    if stated:
        return 1.0
    if good:
        return above + _WORD if above < 0 else max(above, _WORD)
    return above


class _Open:
    """The open elements around a place of a page."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int, int, int]] = [("", 0, 0, 0)]  # tag, number, nearest container, place of the outermost hidden element
        self.elements: list[tuple] = [("", 0, (0, False, False, False))]  # tag, the element around it, what it says
        self.count: Counter[str] = Counter()

    @property
    def tag(self) -> str:
        return self.stack[-1][0]

    @property
    def hidden(self) -> int:
        return self.stack[-1][3]

    def push(self, tag: str, attributes: str) -> None:
        *says, hidden = _says(tag, attributes)
        _, around, parent, out_of_sight = self.stack[-1]
        number = len(self.elements)
        self.elements.append((tag, around, tuple(says)))
        self.stack.append((tag, number, number if tag in _CONTAINERS else parent, out_of_sight or (len(self.stack) if hidden or tag in _HIDDEN else 0)))
        self.count[tag] += 1

    def cut(self, size: int) -> None:
        while len(self.stack) > size:
            self.count[self.stack.pop()[0]] -= 1

    def drop(self, tag: str) -> None:
        """Close the innermost element of this tag and all in it."""
        if self.count[tag]:
            while self.tag != tag:
                self.cut(len(self.stack) - 1)
            self.cut(len(self.stack) - 1)

    def make_room(self, tag: str) -> None:
        """Close what the start of a tag closes."""
        if tag == "body":
            self.cut(self.hidden or len(self.stack) if self.count["body"] else 2 if self.stack[1:] and self.stack[1][0] == "html" else 1)
        elif self.tag == "head" and tag not in _HEAD:
            self.cut(len(self.stack) - 1)
        if tag not in _BLOCKS and tag not in _CONTAINERS:
            if tag in ("button", "select"):  # these never hold their like
                self.drop(tag)
            return
        if self.tag == "title":  # left open in a head
            self.drop("title")
            if self.tag == "head":
                self.drop("head")
        elif self.hidden and tag != "hr" and not self.count["foreignobject"]:  # no block stands in a drawing or a choice
            self.drop("svg")
            self.drop("select")
        item, at = tag in ("li", "dt", "dd", "tr"), len(self.stack) - 1
        while at and self.stack[at][0] not in _CONTAINERS and self.stack[at][0] not in _HIDDEN and (item or self.stack[at][0] not in _BLOCKS):
            at -= 1
        self.cut(at + 1 if item or self.stack[at][0] not in _CLOSED else at)


def blocks_of(html: str) -> list[Block]:
    out: list[Block] = []
    now = _Open()
    kind, pieces, links, in_link = "loose", [], 0, False

    def close() -> None:
        nonlocal pieces, links, kind
        text = " ".join("".join(pieces).split())
        if text:
            _, holder, parent, _ = now.stack[-1]
            out.append(Block(kind, text, min(links, len(text)), parent, holder))
        pieces, links = [], 0

    def read(piece: str) -> None:
        nonlocal links
        if now.tag == "head" and piece.strip():
            now.drop("head")
        if not now.hidden:
            pieces.append(unescape(piece))
            links += len(pieces[-1].strip()) if in_link else 0

    at = 0
    for m in _TOKEN.finditer(html):
        if m.start() > at:
            read(html[at: m.start()])
        at = m.end()
        tag = m[3]
        if tag is None:
            pieces.append(" " if m[1] else "")
            continue
        tag = tag.lower()
        ending, attributes = bool(m[2]), m[4]
        borders = tag in _BLOCKS or tag in _CONTAINERS
        if ending and now.hidden and now.count[tag] and all(e[0] != tag for e in now.stack[now.hidden:]):
            now.cut(now.hidden)  # a parent's end tag
        if borders and not (now.hidden and ending):
            if not now.hidden:
                close()  # a block belongs to what holds its end
            if not ending:
                now.make_room(tag)
                if not now.hidden:
                    close()
        elif not ending:
            now.make_room(tag)
        if now.hidden:
            pieces.append(" ")
        else:
            if tag == "a":
                in_link = not ending
            elif tag in ("br", "td", "th"):
                pieces.append(" ")
            if borders:
                kind = "loose" if ending or tag in _CONTAINERS else (
                    "heading" if tag[0] == "h" and tag != "hr" else "item" if tag in ("li", "dt", "dd") else "row" if tag == "tr" else "loose" if tag == "hr" else "p")
                in_link = in_link and tag not in _CONTAINERS
        if ending:
            now.drop(tag)
        elif tag not in _VOID and not attributes.endswith("/") and not (tag == "body" and now.count["body"]):
            now.push(tag, attributes)
    if at < len(html):
        rest = html[at:]
        cut = rest.rfind("<")  # an unfinished tag
        read(rest[:cut] if cut >= 0 and re.match(r"<[a-zA-Z/!?]|<$", rest[cut:]) else rest)
    close()
    return _hinted(out, now.elements)


def _hinted(blocks: list[Block], elements: list[tuple]) -> list[Block]:
    """Give the blocks the hints of their elements."""
    hints, sizes = [0.0], [0] * len(elements)
    for b in blocks:
        sizes[b.holder] += len(b.text)
    for i in range(len(elements) - 1, 0, -1):
        sizes[elements[i][1]] += sizes[i]
    for i, (tag, around, says) in enumerate(elements[1:], 1):
        hints.append(_hint(tag, says, hints[around], sizes[i] / max(sizes[0], 1)))
    for b in blocks:
        b.hint = hints[b.holder]
    return blocks


def shape(blocks: list[Block]) -> np.ndarray:
    """Features of the blocks of a page, without what containers hint at."""
    n = len(blocks)
    rows = np.zeros((n, 7 + len(KINDS)))
    for i, b in enumerate(blocks):
        words = b.text.count(" ") + 1
        rows[i, :7] = (math.log1p(len(b.text)) / 5, b.links / len(b.text), min(sum(map(b.text.count, ".,;!?")) / words, 1.0), len(b.text) / words / 10,
                       i / n, b.text[-1] in ".!?:\"'", "©" in b.text)
        rows[i, 7 + KINDS.index(b.kind)] = 1
    return rows


def logits(blocks: list[Block], s: Settings) -> np.ndarray:
    """Log odds of content for each block."""
    stated = s.stated * np.array([b.hint for b in blocks], dtype=float)
    if not s.weights:
        return stated
    return stated + np.clip(shape(blocks) @ np.array(s.weights[1:]) + s.weights[0], -s.shape_limit, s.shape_limit)


def cut(costs: np.ndarray, edges: list[tuple[int, int, float]]) -> np.ndarray:
    """True for the source side of a minimum cut: node i costs max(costs[i], 0) off
    the source side and max(-costs[i], 0) on it; an edge costs its weight if cut."""
    n = len(costs)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def join(a: int, b: int, there: float, back: float) -> None:
        out[a].append(len(to))
        out[b].append(len(to) + 1)
        to.extend((b, a))
        room.extend((there, back))
    for i, c in enumerate(costs.tolist()):
        join(source, i, c, 0.0) if c > 0 else join(i, sink, -c, 0.0)
    for a, b, w in edges:
        join(a, b, w, w)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return np.array(level[:n]) >= 0
        following = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                full = next(i for i, e in enumerate(path) if room[e] <= tiny)
                a = to[path[full] ^ 1]
                del path[full:]
            while following[a] < len(out[a]):
                e = out[a][following[a]]
                if room[e] > tiny and level[to[e]] == level[a] + 1:
                    break
                following[a] += 1
            if following[a] < len(out[a]):
                path.append(e)
                a = to[e]
            elif a == source:
                break
            else:
                level[a] = -1
                a = to[path.pop() ^ 1]


def extract(html: str, s: Settings) -> str:
    blocks = blocks_of(html)
    if not blocks:
        return ""
    edges, latest = [], {}
    for i, b in enumerate(blocks):
        if i:
            edges.append((i - 1, i, s.near if blocks[i - 1].parent == b.parent else s.far))
        if b.parent in latest and latest[b.parent] < i - 1:
            edges.append((latest[b.parent], i, s.sibling))
        latest[b.parent] = i
    keep = cut(logits(blocks, s), edges)
    return "\n\n".join(b.text for b, k in zip(blocks, keep) if k)


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, labels = [], []
        for html in batch.column(0).to_pylist():
            blocks = blocks_of(html)
            if blocks:
                said = [b.hint for b in blocks]
                x = shape(blocks)
                rows += [x[i].tolist() for i, v in enumerate(said) if abs(v) >= _CLEAR]
                labels += [float(v > 0) for v in said if abs(v) >= _CLEAR]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), pa.array(labels)], ["x", "label"])


def fit(pages: DataFrame, s: Settings | None = None) -> Settings:
    """Train the shape model on blocks whose containers hint clearly at their label."""
    s = s or Settings()
    # numbers first: only the pages of the smallest hashes travel
    hashed = pages.where("html <> ''").select("html", F.xxhash64("html").alias("h"))
    least = hashed.select("h").distinct().orderBy("h").limit(s.sample_pages)  # at most sample_pages numbers
    sample = hashed.join(F.broadcast(least), "h", "left_semi").groupBy("h").agg(F.min("html").alias("html")).select("html")
    rows = spread(sample).mapInArrow(_training, "x array<double>, label double").select(array_to_vector("x").alias("features"), "label").persist()
    try:
        if rows.select("label").distinct().count() < 2:
            return Settings(**{**s.__dict__, "weights": []})
        model = LogisticRegression(regParam=0.01, maxIter=30).fit(rows)
        return Settings(**{**s.__dict__, "weights": [float(model.intercept), *map(float, model.coefficients)]})
    finally:
        rows.unpersist()


def main_text(pages: DataFrame, s: Settings) -> DataFrame:
    """page_id, url, text."""
    kinds = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url {pages.schema['url'].dataType.simpleString()}, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [extract(h, s) if h else "" for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])
    return pages.select("page_id", "url", "html").mapInArrow(run, kinds)


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return main_text(pages, fit(pages)).withColumn("n_chars", F.char_length("text").cast("long"))

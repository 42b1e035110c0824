"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree of block elements. Each node is content or not; a node's look (tag, names,
length and links of its text) gives its own potential, and parent-child potentials connect the
nodes. Sum-product messages go from the leaves up and from the root down; a node whose content
marginal exceeds one half gives its text.

Edges are of three kinds, by whether the child says it is no content, is a section or another block.
The potentials are counts on a bounded sample of labelled pages: pages that mark their content
with exactly one ``article`` or ``main`` element, whose insides are content except for parts that
say otherwise (menus, notes, forms and so on). A table of usual looks is added as prior counts, so
that elements absent from the sample are judged too.

* null, empty or plain-text html: empty text unless a node looks like content; cut-off pages
  count as far as they go; a repeated row gets the same answer; an empty table: no rows;
* html of any length is parsed whole, in one linear pass.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the HTML standard.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - frozenset("body html caption td th tr tbody thead tfoot li dd dt summary legend".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = frozenset("script style head title template noscript textarea select button svg iframe object option math canvas audio video".split())
RAW = frozenset("script style textarea title noscript iframe".split())
SAME = {"li": "li", "dt": "dd dt", "dd": "dd dt", "tr": "tr", "td": "td th", "th": "td th", "option": "option"}

NOT_CONTENT = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu|breadcrumbs?|footer|header|masthead|sidebar|side|aside|widget"
    r"|comments?|disqus|replies|cookie\w*|consent|gdpr|notice|popup|modal|newsletter|subscribe|signup|login|share|sharing|social|related|recommended|copyright|toolbar|pager|pagination)(?:$|[\s_-])",
    re.I,
)
CONTENT = re.compile(r"(?:^|[\s_-])(?:article|content|main|post|entry|story|text|body)(?:$|[\s_-])", re.I)
SECTIONS = frozenset("article main section div center td table tr tbody details blockquote".split())
#: Blocks that menus and articles share: their tag says nothing.
NEUTRAL = frozenset("ul ol li dl dt dd table tr td th tbody thead tfoot caption figure figcaption pre blockquote div section".split())
OUTSIDE = frozenset("nav header footer aside form menu dialog search fieldset".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)", re.S)
NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

#: Prior counts of (parent, child) labels 00, 01, 10, 11 per kind of edge.
PRIOR_EDGES = ((20.0, 0.2, 20.0, 1.0), (8.0, 2.0, 1.0, 8.0), (40.0, 0.2, 1.0, 40.0))

#: One kind of look says at most so much, since looks are not independent.
MOST_ODDS = 4.0

#: Prior counts of a look value among (other, content) nodes.
PRIOR = {
    **{("tag", t): (40.0, 0.2) for t in OUTSIDE},
    **{("tag", t): (0.2, 40.0) for t in ("article", "main")},
    ("tag", "p"): (2.0, 4.0),
    ("tag", "body"): (40.0, 0.2),
    ("tag", "html"): (40.0, 0.2),
    ("names", "not"): (60.0, 0.2),
    ("names", "yes"): (1.0, 4.0),
}


class Node:
    __slots__ = ("tag", "names", "parent", "chars", "links")

    def __init__(self, tag: str, names: str, parent: int) -> None:
        self.tag, self.names, self.parent = tag, names, parent
        self.chars = self.links = 0


def parse(html: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Nodes (a parent precedes its children) and text blocks (node, text) in page order."""
    nodes = [Node("html", "", -1)]
    open_: list[tuple[str, int]] = [("html", 0)]  # every open element with the node its text goes to
    blocks: list[tuple[int, str]] = []
    buffer: list[str] = []
    places: dict[str, list[int]] = {}  # where in ``open_`` the elements of a tag are
    linked = hidden = 0

    def flush() -> None:
        text = " ".join(unescape("".join(buffer)).split())
        buffer.clear()
        if text:
            blocks.append((open_[-1][1], text))

    def close(upto: int) -> None:
        nonlocal linked, hidden
        for tag, _ in open_[upto:]:
            linked -= tag == "a"
            hidden -= tag in HIDDEN
            places[tag].pop()
        if any(open_[i][1] != open_[upto - 1][1] for i in range(upto, len(open_))):
            flush()
        del open_[upto:]

    def last(tags: frozenset[str] | set[str], stop: frozenset[str] = frozenset()) -> int:
        """The last open element of ``tags``, if no element of ``stop`` was opened since."""
        found, ended = (max((places[t][-1] for t in some if places.get(t)), default=0) for some in (tags, stop))
        return found if found > ended else 0

    def text(piece: str) -> None:
        if piece and not hidden:
            buffer.append(piece)
            node = nodes[open_[-1][1]]
            size = len(piece) if not piece.isspace() else 0
            node.chars += size
            node.links += size if linked > 0 else 0

    at, size = 0, len(html)
    while at < size:
        found = TOKEN.search(html, at)
        if found is None:
            cut = html.find("<", at)
            # a tag that the end of the page cuts off is no text
            while cut >= 0 and not re.match(r"</?[a-zA-Z!]", html[cut : cut + 3]):
                cut = html.find("<", cut + 1)
            text(html[at:] if cut < 0 else html[at:cut])
            break
        text(html[at : found.start()])
        at = found.end()
        if found[2] is None or not found[4]:
            continue
        tag = found[2].lower()
        if found[1]:
            if tag == "br" or tag == "p" and not last({"p"}):
                continue
            place = last({tag})
            if place:
                close(place)
            continue
        if tag == "br":
            text(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in ("html", "body") and (tag == "html" or last({"body"})):
            continue
        if tag in CLOSES_P and (place := last({"p"}, frozenset({"table", "td", "li"}))):
            close(place)
        if tag in SAME and (place := last(set(SAME[tag].split()), frozenset({"ul", "ol", "dl", "table"}))):
            close(place)
        if tag == "body" and (place := last({"head"})):
            close(place)
        names = " ".join(a or b or c for a, b, c in NAMES.findall(found[3])) if found[3] else ""
        apart = tag in BLOCKS or bool(names and NOT_CONTENT.search(names))
        if apart and not hidden:
            flush()
            nodes.append(Node(tag if tag in BLOCKS else "inline", names, open_[-1][1]))
        self_closed = found[3].endswith("/") and tag not in BLOCKS
        if self_closed:
            continue
        places.setdefault(tag, []).append(len(open_))
        open_.append((tag, len(nodes) - 1 if apart and not hidden else open_[-1][1]))
        linked += tag == "a"
        hidden += tag in HIDDEN
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            at = end.start() if end else size
    flush()
    return nodes, blocks


def named(node: Node) -> str:
    """What an element's class, id and role say."""
    if not node.names:
        return "none"
    return "not" if NOT_CONTENT.search(node.names) else "yes" if CONTENT.search(node.names) else "none"


def edge_kind(child: Node) -> int:
    """0: says it is no content, 1: a section that may open the content, 2: any other block."""
    if child.tag in OUTSIDE or named(child) == "not":
        return 0
    return 1 if child.tag in SECTIONS else 2


def looks(nodes: list[Node]) -> list[list[tuple[str, str]]]:
    """Look values of each node; lengths and links are those of its own text."""
    out = []
    for node in nodes:
        share = node.links / node.chars if node.chars else 0.0
        says = named(node)
        out.append(
            [
                ("tag", "other" if says == "not" else "list" if node.tag in NEUTRAL else node.tag),
                ("names", says),
                ("length", "none" if not node.chars else "short" if node.chars < 25 else "middle" if node.chars < 100 else "long"),
                ("links", "none" if share == 0 else "some" if share < 0.5 else "most"),
            ]
        )
    return out


def own_labels(nodes: list[Node]) -> list[bool] | None:
    """Content labels of a page that marks its content with one element; else None."""
    marked = [i for i, n in enumerate(nodes) if n.tag in ("article", "main")]
    if len(marked) != 1:
        return None
    out: list[bool] = []
    for i, node in enumerate(nodes):
        inside = i == marked[0] or (node.parent >= 0 and out[node.parent])
        out.append(inside and node.tag not in OUTSIDE and not (node.names and NOT_CONTENT.search(node.names)))
    return out


class TreeModel:
    """Potentials from counts {(kind + label, value): n} and {("edge", kind + parent + child): n}."""

    def __init__(self, counts: dict[tuple[str, str], int]) -> None:
        self.edge = []
        for kind, prior in enumerate(PRIOR_EDGES):
            own = [counts.get(("edge", f"{kind}{pair}"), 0) + n for pair, n in zip(("00", "01", "10", "11"), prior)]
            self.edge.append((own[0] / (own[0] + own[1]), own[1] / (own[0] + own[1]), own[2] / (own[2] + own[3]), own[3] / (own[2] + own[3])))
        totals = [Counter(), Counter()]
        values: dict[str, set[str]] = {}
        for (kind, value), n in counts.items():
            if kind != "edge":
                kind, label = kind[:-1], int(kind[-1])
                totals[label][kind, value] += n
                values.setdefault(kind, set()).add(value)
        for (kind, value), prior in PRIOR.items():
            values.setdefault(kind, set()).add(value)
            for label in (0, 1):
                totals[label][kind, value] += prior[label]
        self.odds: dict[tuple[str, str], float] = {("tag", "list"): 0.0}
        for kind, seen in values.items():
            sums = [sum(totals[label][kind, v] + 0.5 for v in seen) for label in (0, 1)]
            for v in seen - {"list"}:
                odds = math.log((totals[1][kind, v] + 0.5) / sums[1]) - math.log((totals[0][kind, v] + 0.5) / sums[0])
                self.odds[kind, v] = max(-MOST_ODDS, min(MOST_ODDS, odds))

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Content marginal of each node by one upward and one downward pass."""
        odds, own = self.odds, []
        edges = [self.edge[edge_kind(node)] for node in nodes]
        for look in looks(nodes):
            total = sum(odds.get(value, 0.0) for value in look)
            own.append(1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, total)))))
        up1, up0 = own[:], [1.0 - p for p in own]  # beliefs from below
        sent: list[tuple[float, float]] = [(1.0, 1.0)] * len(nodes)
        for i in range(len(nodes) - 1, 0, -1):
            parent, (stay0, turn1, turn0, stay1) = nodes[i].parent, edges[i]
            m0, m1 = stay0 * up0[i] + turn1 * up1[i], turn0 * up0[i] + stay1 * up1[i]
            scale = m0 + m1
            sent[i] = (m0 / scale, m1 / scale)
            b0, b1 = up0[parent] * sent[i][0], up1[parent] * sent[i][1]
            scale = max(b0 + b1, 1e-300)
            up0[parent], up1[parent] = max(b0 / scale, 1e-290), max(b1 / scale, 1e-290)
        out = [0.0] * len(nodes)
        full0, full1 = up0[:], up1[:]
        for i, node in enumerate(nodes):
            if i:
                p, (stay0, turn1, turn0, stay1) = node.parent, edges[i]
                # the parent's belief without what this node told it
                a0, a1 = full0[p] / sent[i][0], full1[p] / sent[i][1]
                d0, d1 = a0 * stay0 + a1 * turn0, a0 * turn1 + a1 * stay1
                b0, b1 = up0[i] * d0, up1[i] * d1
                scale = max(b0 + b1, 1e-300)
                full0[i], full1[i] = max(b0 / scale, 1e-290), max(b1 / scale, 1e-290)
            out[i] = full1[i] / (full0[i] + full1[i])
        return out

    def extract(self, html: str | None) -> str:
        nodes, blocks = parse(html or "")
        if not blocks:
            return ""
        content = self.marginals(nodes)
        return "\n".join(text for node, text in blocks if content[node] > 0.5)


def learn(pages: DataFrame, sample: int = 2000, html: str = "html", key: str = "page_id") -> TreeModel:
    """Count potentials on about ``sample`` pages, taken by hash of their key."""
    total = pages.count()
    share = min(1.0, sample / max(total, 1))
    some = pages.where(F.pmod(F.xxhash64(F.col(f"`{key}`"), F.lit("labelled pages")), F.lit(1 << 20)) < share * (1 << 20))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                nodes, _ = parse(page or "")
                labels = own_labels(nodes)
                if labels is None:
                    continue
                for node, label, look in zip(nodes, labels, looks(nodes)):
                    for kind, value in look:
                        counts[f"{kind}{int(label)}", value] += 1
                    if node.parent >= 0:
                        counts["edge", f"{edge_kind(node)}{int(labels[node.parent])}{int(label)}"] += 1
        kinds, values = zip(*counts) if counts else ((), ())
        yield pa.record_batch([pa.array(kinds, pa.string()), pa.array(values, pa.string()), pa.array(list(counts.values()), pa.int64())], names=["kind", "value", "n"])

    # Values are tags of the standard and a few classes, so the table is small whatever the pages hold.
    counted = some.select(F.col(f"`{html}`")).mapInArrow(run, "kind string, value string, n long").groupBy("kind", "value").agg(F.sum("n").alias("n"))
    return TreeModel({(r.kind, r.value): r.n for r in counted.collect()})


def extract_text(pages: DataFrame, model: TreeModel, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [model.extract(page) for page in batch.column(2).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    base = pages.select(F.col(f"`{key}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`"))
    return base.mapInArrow(run, "page_id long, url string, text string, n_chars long")

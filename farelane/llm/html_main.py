"""Operator 6 - main text of web pages by consensus host paths.

Every page scores its containers by the text outside of links that they hold.
Its own container is the lowest one with nearly all of that text, or the
``article`` or ``main`` around it; it is widened while the container above has
paragraphs or headings of its own.  The page votes for the generalised
tag-class path of its container.  Spark adds the votes per host; the paths with at
least ``MIN_SHARE`` of a host's votes win, a page is re-extracted with the
winner that holds most of its text, and a page that has none of them uses its
own container.  Menus, headers, footers, sidebars, notices, adverts, forms,
comments, scripts and styles are left out by tag, role and class; a header
inside an article is part of it, and a class only counts by what it names
(``share-buttons``), not by words of another meaning (``share-price``).

Votes are summed with map-side aggregation, so a host with a third of all
pages is no hot key; pages are joined with one row per host that holds at most
``1 / MIN_SHARE`` paths.

Defined results: a null or empty page has an empty text; a null url is a host
of its own (empty name); broken markup is read as far as it goes (a paragraph
ends the one before, open elements end with their parent); winners that tie on
a page yield to the first in the order of paths; repeated pages vote each and
give repeated rows; input columns named like new ones are replaced.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.llm.frames import add_columns, arrow_map, materialize

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^<>]*+>|<(/?)([a-zA-Z][^\s/<>\"']*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")

#: fixed lists of element names
RAW = set("script style noscript template textarea title iframe object svg annotation annotation-xml".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
LEFT_OUT = set("head nav header footer aside form button select dialog menu audio video canvas map".split()) | RAW
LEAVES = set("p h1 h2 h3 h4 h5 h6 li td th dt dd pre blockquote figcaption caption summary address".split())
BLOCKS = set("html body main article section div ul ol dl table thead tbody tfoot tr figure details hr center fieldset hgroup".split()) | LEAVES | LEFT_OUT - RAW
CLOSED_BY_BLOCK = {"p"}
ITEMS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
MARKS = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices"
    " alert sidebar menu nav navbar navigation breadcrumb breadcrumbs comment comments disqus respond reply replies share sharing social"
    " related recommended newsletter subscribe subscription signup popup modal widget widgets masthead header footer copyright toolbar"
    " pagination pager skip".split()
)
#: marks that have no other meaning, at any place of a class name; other marks count as its last part
STRONG = set("advert adverts advertisement advertising breadcrumbs disqus gdpr masthead navbar navigation pagination sidebar widget widgets".split())
#: what may follow a mark in a class name (``ad-slot``, ``comment-list``)
GENERIC = set(
    "area articles bar block blocks body bottom box button buttons col column container content group head icon icons info inner item items"
    " label law layer layout left link links list main outer overlay panel policy posts right row section slot small stories strip text title"
    " top unit wrap wrapper zone".split()
)
#: first parts of names that tell a state, and of names for the parts of an article
STATES = set("has with no is without".split())
ARTICLE_PARTS = set("article entry post story".split())
HEADERS = {"header", "masthead"}
#: elements that are only left out when they are marked as one of these
WHOLE = set("html body main article".split())
WHOLE_MARKS = {"comment", "comments", "ad", "ads", "advert", "advertisement", "sponsored", "promo", "related"}
#: elements that are parts of a container, never the container of an article
PARTS = set("table thead tbody tfoot tr ul ol dl figure details fieldset hgroup".split())
LEAST_CHARS = 20
#: share of a page's text that its container holds, and share of a host's votes that a winning path has
HOLDS = 0.8
MIN_SHARE = 0.25


class Node:
    __slots__ = ("tag", "parent", "label", "order", "out", "article")

    def __init__(self, tag: str, parent: "Node | None", label: str, order: int, out: bool, article: bool = False):
        self.tag, self.parent, self.label, self.order = tag, parent, label, order
        self.out = out or (parent is not None and parent.out)
        self.article = article or (parent is not None and parent.article)

    @property
    def path(self) -> str:
        labels, node = [], self
        while node is not None:
            labels.append(node.label)
            node = node.parent
        return "/".join(reversed(labels))


def _marks(name: str) -> set[str]:
    """The marks that a class or id names."""
    parts = [p for p in re.split(r"[-_:]+|\d+", name) if p]
    if not parts or parts[0] in STATES:
        return set()
    strong = STRONG.intersection(parts)
    while len(parts) > 1 and parts[-1] in GENERIC:
        parts.pop()
    last = {parts[-1]} & MARKS
    if last & HEADERS and parts[0] in ARTICLE_PARTS:
        return strong
    return strong | last


def _read(tag: str, attributes: str, in_article: bool) -> tuple[str, bool, bool]:
    """(generalised tag-class label, left out, an article or named as one)."""
    article = tag == "article"
    out, label, marks = tag in LEFT_OUT and not (tag == "header" and in_article), tag, set()
    if "=" in attributes or "hidden" in attributes:
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
        names = found.get("class", "").lower().split()
        if names:
            label = ".".join([tag, *sorted({re.sub(r"[\d/]+", "#", n) for n in names})])
        for n in (*names, *found.get("id", "").lower().split()):
            marks |= _marks(n)
            article = article or (tag not in ("html", "body") and re.split(r"[-_:]+|\d+", n)[0] in ARTICLE_PARTS)
        if in_article:
            marks -= HEADERS
        out = out or found.get("role", "").lower() in ROLES or found.get("aria-hidden", "").lower() == "true"
        out = out or "display:none" in found.get("style", "").lower().replace(" ", "")
        out = out or re.search(r"(?:^|\s)hidden(?:\s|/|$)", attributes) is not None
    return label, out or bool(marks & (WHOLE_MARKS if tag in WHOLE else MARKS)), article


def blocks(page: str) -> list[tuple[Node, str, int]]:
    """(innermost block element, text, characters in links) of each text block, in page order."""
    found: list[tuple[Node, str, int]] = []
    root = Node("", None, "", 0, False)
    made = 0
    stack: list[Node] = [root]
    block, text, linked, links, at = root, [], 0, 0, 0

    def flush():
        nonlocal text, linked
        whole = " ".join(html.unescape("".join(text)).split())
        if whole and not block.out:
            found.append((block, whole, min(linked, len(whole))))
        text, linked = [], 0

    def leave(depth: int):
        nonlocal block, links
        for node in stack[depth:]:
            if node.tag == "a":
                links -= 1
        if any(n.tag in BLOCKS or n.out != stack[depth - 1].out for n in stack[depth:]):
            flush()
        del stack[depth:]
        block = next((n for n in reversed(stack) if n.tag in BLOCKS or not n.tag or n.out), root)

    pos, end = 0, len(page)
    while pos < end:
        m = _TAG.search(page, pos)
        piece = page[pos : m.start()] if m else page[pos:]
        if piece:
            text.append(piece)
            if links:
                linked += len(piece)
        if not m:
            break
        pos = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                text.append(html.escape(m[0][9:-3], quote=False))
            continue
        tag = m[2].lower()
        if m[1]:  # an end tag closes the nearest open element of its name
            at = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if at:
                leave(at)
            continue
        if tag in RAW:  # raw text up to the end tag
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, pos)
            pos = close.end() if close else end
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            else:
                text.append(" ")
            continue
        if tag in BLOCKS:
            at = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag in CLOSED_BY_BLOCK), 0)
            if at:
                leave(at)
            if tag in ITEMS:
                i = len(stack) - 1
                while i > 0 and stack[i].tag not in ITEMS[tag]:
                    if stack[i].tag == tag or (tag in ("dt", "dd") and stack[i].tag in ("dt", "dd")) or (tag in ("td", "th") and stack[i].tag in ("td", "th")):
                        leave(i)
                        break
                    i -= 1
        label, out, article = _read(tag, m[3], stack[-1].article)
        if m[3].endswith("/") and tag not in BLOCKS:
            continue
        made += 1
        node = Node(tag, stack[-1], label, made, out, article)
        if tag in BLOCKS or node.out != stack[-1].out:
            flush()
            block = node
        stack.append(node)
        links += tag == "a"
    flush()
    return found


def _container(node: Node) -> Node:
    while node.parent is not None and (node.tag in LEAVES or node.tag in PARTS or node.tag not in BLOCKS):
        node = node.parent
    return node


def _tree(found: list[tuple[Node, str, int]]) -> list[Node]:
    """The elements around the blocks, in page order, so that each comes after its parent."""
    nodes: dict[int, Node] = {}
    for node, _, _ in found:
        while node is not None and node.order not in nodes:
            nodes[node.order] = node
            node = node.parent
    return [nodes[i] for i in sorted(nodes)]


def container_scores(found: list[tuple[Node, str, int]]) -> tuple[dict[int, float], dict[int, float]]:
    """(worth of all text in an element, worth of the text that is a container's own), by the order of the element."""
    held: dict[int, float] = {}
    own: dict[int, float] = {}
    for node, text, linked in found:
        plain = len(text) - linked
        worth = plain / 100 + max(0, plain - LEAST_CHARS)  # short blocks only decide where there is nothing else
        held[node.order] = held.get(node.order, 0.0) + worth
        at = _container(node).order
        own[at] = own.get(at, 0.0) + worth
    for node in reversed(_tree(found)):
        if node.parent is not None:
            held[node.parent.order] = held.get(node.parent.order, 0.0) + held.get(node.order, 0.0)
    return held, own


def own_container(found: list[tuple[Node, str, int]]) -> Node | None:
    """The container of a page's main text; None for a page without text."""
    if not found:
        return None
    held, own = container_scores(found)
    nodes = _tree(found)
    total = held[nodes[0].order]
    if not total:  # nothing but links
        return nodes[0]
    for tag in ("article", "main"):
        named = [n for n in nodes if n.tag == tag and 2 * held[n.order] > total]
        if named:  # the innermost one with more than half of the text
            return named[-1]
    best = nodes[0]
    for node in nodes:
        if node is _container(node) and held[node.order] >= HOLDS * total:
            best = node
    while best.parent is not None:
        above = _container(best.parent)
        if above.tag in ("", "html", "body") or not own.get(above.order):
            break
        best = above
    return best


def page_text(page: str, paths: list[str]) -> str:
    """The blocks below the path that holds most text, or in the page's own container where it has none of the paths."""
    found = blocks(page)
    best, most = None, 0
    if paths:
        nodes = _tree(found)
        for path in sorted(paths):
            labels = path.split("/")
            inside = {-1}
            depth = {}  # number of labels that an element and those around it match
            for n in nodes:
                if n.parent is None:
                    depth[n.order] = int(n.label == labels[0])
                else:
                    up = depth[n.parent.order]
                    depth[n.order] = up + 1 if up and up < len(labels) and n.label == labels[up] else 0
                    if n.parent.order in inside:
                        inside.add(n.order)
                if depth[n.order] == len(labels):
                    inside.add(n.order)
            texts = [text for node, text, _ in found if node.order in inside]
            size = sum(map(len, texts))
            if size > most:
                best, most = texts, size
    if best is None:
        own = own_container(found)
        inside = set()
        for n in _tree(found):
            if n is own or (n.parent is not None and n.parent.order in inside):
                inside.add(n.order)
        best = [text for node, text, _ in found if node.order in inside]
    return "\n".join(best)


def main_text(page: str, path: str | None) -> str:
    """The text of a page below one path, or in its own container."""
    return page_text(page, [] if path is None else [path])


def host(url: str) -> F.Column:
    """The lower-case host name of a url, empty if there is none."""
    return F.coalesce(F.regexp_extract(F.lower(F.col(url)), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit(""))


def host_paths(pages: DataFrame, html_col: str = "html", url_col: str = "url", min_share: float = MIN_SHARE) -> DataFrame:
    """host, paths: the winning container paths of each host."""

    def run(batch):
        votes: dict[tuple[str, str], int] = {}
        for i, name in enumerate(batch.column(0).to_pylist()):
            own = own_container(blocks(batch.column(1)[i].as_py() or ""))
            if own is not None:
                key = name, own.path
                votes[key] = votes.get(key, 0) + 1
        hosts, paths = [k[0] for k in votes], [k[1] for k in votes]
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(list(votes.values()), pa.int64())], names=["host", "path", "votes"])

    ballots = arrow_map(pages.select(host(url_col).alias("host"), html_col), run, "host string, path string, votes bigint")
    sums = materialize(ballots.groupBy("host", "path").agg(F.sum("votes").alias("votes")), "host_votes")
    least = sums.groupBy("host").agg((F.sum("votes") * min_share).alias("least"), F.max("votes").alias("most"))
    least = least.select("host", F.least("least", "most").alias("least"))  # a host without a majority keeps its first paths
    won = sums.join(least, "host").filter(F.col("votes") >= F.col("least"))
    first = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("n"), "path"))), 1, max(1, int(1 / min_share)))
    return won.groupBy("host").agg(first.alias("w")).select("host", F.col("w.path").alias("paths"))


def extract(pages: DataFrame, html_col: str = "html", url_col: str = "url", text_col: str = "text") -> DataFrame:
    """``pages`` with the main text of each page."""
    winners = materialize(host_paths(pages, html_col, url_col), "host_paths").select(F.col("host").alias("__host"), F.col("paths").alias("__paths"))
    joined = pages.withColumn("__name", host(url_col)).join(winners, F.col("__name") == F.col("__host"), "left").drop("__host", "__name")

    def run(batch):
        text, paths = (batch.schema.get_field_index(c) for c in (html_col, "__paths"))
        for lo in range(0, batch.num_rows, 64):
            hi = min(lo + 64, batch.num_rows)
            made = [page_text(batch.column(text)[i].as_py() or "", batch.column(paths)[i].as_py() or []) for i in range(lo, hi)]
            yield lo, hi, [made]

    return add_columns(joined, [(text_col, T.StringType(), pa.string())], run).drop("__paths")

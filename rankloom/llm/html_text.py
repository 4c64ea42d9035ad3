"""Main text of a web page by composite text density.

Every node of the page has characters, tags, and both again inside links. Its density is characters per tag,
adjusted by links: much text in links, or many links, bring it down. A node's density sum is that of its
children and of its own runs of text. The path from the node with the largest sum up to the body gives a
threshold, its lowest density; every node whose density or density sum reaches it gives the subtree with the
largest density sum in it, with the headings right before that. Nested ones are one. (The sum counts too, as
densities grow with the number of tags: without links, the smaller of two like blocks lies below their parent.) Where the
largest sum lies in an article or main element, the text is that of the article and main elements with such subtrees, in
whole, and of the innermost one that holds that sum, not of a main element around it.

What is never article (scripts, forms, menus, headers and footers of the page, sidebars, notices,
adverts, reader comments) is left out before densities are computed, by tag, role and name. Forms and
names leave out nothing that wraps the article or most of the text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre
    search section summary table tbody td tfoot th thead tr ul""".split()
)
#: Elements that are no text of the article.
DROPPED = frozenset(
    """head script style noscript template nav aside button select textarea input iframe object embed svg canvas
    audio video map dialog menu search annotation annotation-xml""".split()
)
#: Those that may wrap it.
FORMS = frozenset("form fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that are the article.
WHOLE = frozenset("article main".split())
#: Those that are not when they stand outside the article.
FRAME = frozenset("header footer".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split()
)
#: Class and id names of what is no article: one of these, or a compound of these and words of PARTS and LISTS.
NAMES = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promoted
    nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar aside rail widget widgets toc toolbar
    footer masthead topbar comment comments commentlist disqus respond replies reply discussion cookie cookies consent
    gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login share
    sharing social related recommended recommendations""".split()
)
PARTS = frozenset(
    """area bar block box button container form fixed global inner list main mobile outer primary secondary section site
    slot sticky top bottom unit wrap wrapper""".split()
)
LISTS = frozenset("articles buttons icons links posts stories".split())
#: Names that an article has for parts of its own: as the id of a section, or of a paragraph, they leave out nothing in it.
TOPICS = frozenset(
    """advertising banner consent cookies discussion navigation notice notices notification alert overlay promotion
    recommendations recommended related sharing social sponsor subscription""".split()
)
#: Names of reader comments, which may be longer than the article.
READERS = frozenset("comment comments commentlist disqus respond replies reply discussion".split())
#: Left out elements whose inside closes nothing around them, not even by an end tag.
SEALED = frozenset("textarea select template noscript iframe object svg canvas audio video".split())
#: Elements that an opening tag of the same kind closes, up to the container they belong to.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}


class Node:
    __slots__ = (
        "tag", "parent", "children", "dropped", "boxed", "readers", "linked", "whole", "rich",
        "chars", "tags", "link_chars", "link_tags", "density", "sum",
    )

    def __init__(self, tag: str, parent: Node | None, dropped: bool, boxed: bool = False, readers: bool = False):
        self.tag, self.parent, self.dropped, self.boxed, self.readers = tag, parent, dropped, boxed, readers
        self.children: list[Node | str] = []
        self.linked = tag == "a" or parent is not None and parent.linked
        #: The article or main element it is in, or is.
        self.whole: Node | None = self if tag in WHOLE else parent.whole if parent else None
        self.rich = self
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0


class Tree(HTMLParser):
    """Nodes of a page in order, parents before children."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html", None, False)
        self.open = [self.root]
        self.nodes = [self.root]
        #: Places in ``open`` of each tag, of block elements, and of the outermost element that is left out.
        self.places: dict[str, list[int]] = {"html": [0]}
        self.blocks = [0]
        self.sealed: int | None = None

    def _last(self, tags: Iterable[str]) -> int:
        """The innermost open element of some tags; -1 if there is none."""
        last, places = -1, self.places
        for tag in tags:
            if tag in places and places[tag] and places[tag][-1] > last:
                last = places[tag][-1]
        return last

    def _push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.open))
        if node.tag in BLOCKS:
            self.blocks.append(len(self.open))
        if node.dropped and self.sealed is None:
            self.sealed = len(self.open)
        self.open.append(node)

    def _cut(self, at: int) -> None:
        """Close all open elements from a place on."""
        while len(self.open) > max(at, 1):
            node = self.open.pop()
            self.places[node.tag].pop()
            if node.tag in BLOCKS:
                self.blocks.pop()
        if self.sealed is not None and self.sealed >= len(self.open):
            self.sealed = None

    def _close(self, closed: Iterable[str], within: Iterable[str]) -> None:
        """Close the innermost of some elements, unless it lies outside another one or what is left out."""
        at = self._last(closed)
        if at > 0 and at > self._last(within) and (self.sealed is None or at > self.sealed):
            self._cut(at)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("html", "body") and (tag == "html" or self.places.get("body")):
            return
        if tag in BLOCKS and self.places.get("p"):
            self._close(("p",), ("table", "td", "th", "button", "object"))
        if tag == "body":
            self._cut(1)
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        names = self._names(tag, attrs)
        node = Node(
            tag, self.open[-1], self.open[-1].dropped or self._no_article(tag, attrs),
            bool(names) or tag in FORMS or ("role", "form") in attrs, not READERS.isdisjoint(names),
        )
        self.open[-1].children.append(node)
        self.nodes.append(node)
        if tag not in VOID:
            self._push(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # A slash closes nothing in HTML but in foreign elements.
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self._last(("svg", "math")) >= 0:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        places = self.places.get(tag)
        at = places[-1] if places else -1
        if at < 1 or tag not in BLOCKS and self.blocks[-1] > at and at != self.sealed:
            return  # an inline end tag closes nothing outside its block, but what is left out
        if self.sealed is not None and at < self.sealed and self.open[self.sealed].tag in SEALED:
            return
        self._cut(at)

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)

    def _no_article(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in DROPPED or tag in FRAME and self._last(WHOLE) < 0:
            return True
        for name, value in attrs:
            value = (value or "").lower()
            if name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and value in ROLES:
                return True
            if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return True
        return False

    def _names(self, tag: str, attrs: list[tuple[str, str | None]]) -> set[str]:
        """Words of the class and id names that say that an element is no article."""
        found: set[str] = set()
        if tag in HEADINGS or tag in WHOLE or tag in ("html", "body"):
            return found
        inside = self.open[-1].whole is not None
        for key, value in attrs:
            for name in (value or "").lower().split() if key in ("class", "id") else ():
                words = {word for word in re.split(r"[^a-z0-9]+", name) if word}
                if not words <= NAMES | PARTS | LISTS:
                    continue
                said = words & NAMES
                topic = inside and said <= TOPICS and words.isdisjoint(LISTS)
                if said and not (topic and (tag == "p" or tag == "section" and key == "id")):
                    found |= said
        return found


def _text(node: Node) -> int:
    """Characters of a node's own runs of text."""
    return sum(len("".join(c.split())) for c in node.children if isinstance(c, str))


def _leave_out(tree: Tree, body: Node) -> None:
    """Drop the forms and what names say is no article, but not what wraps the article or most of the text.

    While an article stands elsewhere, all of them go. Otherwise one stays that has an article in it, or more
    than half of the body's characters; reader comments stay only in the second case, and not beside an
    article or a first heading.
    """
    chars = {node: 0 if node.dropped else _text(node) for node in tree.nodes}
    wholes = dict.fromkeys(tree.nodes, 0)
    heads = dict.fromkeys(tree.nodes, 0)
    for node in reversed(tree.nodes):
        wholes[node] += node.tag in WHOLE and chars[node] > 0
        heads[node] += node.tag == "h1" and chars[node] > 0
        if node.parent is not None:
            for counts in (chars, wholes, heads):
                counts[node.parent] += counts[node]
    # Articles by the innermost form or named element that they are in, and how many are around each node.
    box: dict[Node, Node | None] = {}
    around: dict[Node, int] = {}
    owned: dict[Node | None, int] = {}
    for node in tree.nodes:
        up = node.parent
        box[node] = None if up is None else up if up.boxed else box[up]
        around[node] = 0 if up is None else around[up] + (up.tag in WHOLE and chars[up] > 0)
        if node.tag in WHOLE and chars[node] > 0:
            owned[box[node]] = owned.get(box[node], 0) + 1
    free = owned.get(None, 0)
    for node in tree.nodes:
        if node.parent is not None and node.parent.dropped:
            node.dropped = True
        if not node.boxed or node.dropped:
            continue
        most = 2 * chars[node] > chars[body]
        if free > around[node]:
            node.dropped = True
        elif node.readers:
            node.dropped = not most or around[node] > 0 or heads[body] > heads[node]
        else:
            node.dropped = not most and not wholes[node]
        if not node.dropped:
            free += owned.get(node, 0)


def _measure(tree: Tree) -> Node:
    """Fill in characters, tags, densities, sums and richest subtrees; returns the body."""
    body = next((n for n in tree.nodes if n.tag == "body"), tree.root)
    _leave_out(tree, body)
    for node in tree.nodes:
        node.chars = 0 if node.dropped else _text(node)
        if node.tag == "a" and not node.dropped:
            node.link_tags = 1
    own = {node: node.chars for node in tree.nodes}
    for node in reversed(tree.nodes):
        if node.linked:
            node.link_chars = node.chars
        if node.parent is not None and not node.dropped:
            up = node.parent
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags
    overall = body.link_chars / body.chars if body.chars else 0.0

    def density(chars: int, tags: int, link_chars: int, link_tags: int) -> float:
        tags, links, link_tags = max(tags, 1), max(link_chars, 1), max(link_tags, 1)
        free = max(chars - link_chars, 1)
        base = math.log(chars / free * link_chars + overall * chars + math.e)
        return chars / tags * max(math.log(chars / links * tags / link_tags), 0.0) / base

    for node in tree.nodes:
        if node.dropped or not node.chars or node.linked:
            continue  # all of a link's text is in links
        node.density = density(node.chars, node.tags, node.link_chars, node.link_tags)
        # Its own text counts like that of a child without tags.
        node.sum += density(own[node], 0, 0, 0) if own[node] else 0.0
        if node.parent is not None:
            node.parent.sum += node.density
    for node in reversed(tree.nodes):
        for child in node.children:
            # The largest sum in the subtree, the first of equals.
            if isinstance(child, Node) and not child.dropped and child.rich.sum > node.rich.sum:
                node.rich = child.rich
    return body


def _inside(top: Node) -> Iterator[Node]:
    stack = [top]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.dropped)


def _selected(body: Node) -> list[Node]:
    """Subtrees of the main text in page order, none in another."""
    best = body.rich
    threshold, node = best.density, best
    while node is not body and node.parent is not None:
        node = node.parent
        threshold = min(threshold, node.density)
    # Parents come before children, so a node knows whether it is in a subtree that was found.
    found: set[Node] = set()
    covered: set[Node] = set()
    for node in _inside(body):
        if node in found or node.parent in covered:
            covered.add(node)
        elif node.chars and max(node.density, node.sum) >= threshold:
            found.add(node.rich)
            if node.rich is node:
                covered.add(node)
    if best.whole is not None:
        found = {node.whole for node in found if node.whole is not None} | {best.whole}
        up = best.whole.parent
        while up is not None:
            found.discard(up)
            up = up.parent
        inside = {node for node in _headings(body, found) if node.whole is not None}
        found |= inside
    else:
        found = {node.whole or node for node in found}
        found |= _headings(body, found)
    tops: list[Node] = []
    covered.clear()
    for node in _inside(body):
        if node.parent in covered:
            covered.add(node)
        elif node in found:
            covered.add(node)
            tops.append(node)
    return tops


def _headings(body: Node, found: set[Node]) -> set[Node]:
    """Headings that stand right before a node with a subtree that was found."""
    holding: set[Node] = set()
    for node in found:
        up: Node | None = node
        while up is not None and up not in holding:
            holding.add(up)
            up = up.parent
    headings: set[Node] = set()
    for node in _inside(body):
        if node not in holding:
            continue
        before: list[Node] = []
        for item in node.children:
            if isinstance(item, str):
                before = [] if item.strip() else before
            elif item in holding:
                headings.update(before)
                before = [item] if item.tag in HEADINGS else []
            elif item.tag in HEADINGS and not item.dropped:
                before.append(item)
            elif item.chars and not item.dropped:
                before = []
    return headings


def _blocks(top: Node) -> Iterator[str]:
    """Texts of a subtree block by block."""
    line: list[str] = []
    stack: list[Node | str | None] = [top]  # None ends a block
    while stack:
        item = stack.pop()
        if item is None:
            yield "".join(line)
            line = []
        elif isinstance(item, str):
            line.append(item)
        elif item.tag == "br":
            line.append(" ")
        elif not item.dropped:
            block = item.tag in BLOCKS
            if block:
                yield "".join(line)
                line = []
                stack.append(None)
            stack.extend(reversed(item.children))
    yield "".join(line)


def main_text(html: str) -> str:
    """The main text of a page, blocks joined by line breaks."""
    tree = Tree()
    tree.feed(html)
    tree.close()
    body = _measure(tree)
    if not body.chars:
        return ""
    lines = (" ".join(block.split()) for top in _selected(body) for block in _blocks(top))
    return "\n".join(line for line in lines if line)


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages (page_id, url, html)``.

    A null or empty html, and a page without text, give an empty text. Broken markup is read as
    far as it goes. Repeated rows and null ids are rows like others; other columns are ignored.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py() or "") for html in batch.column("html")]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                       pa.array([len(text) for text in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(work, "page_id long, url string, text string, n_chars long")

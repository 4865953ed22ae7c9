"""Main text of web pages by tree scoring (operator 4).

A page's tags are read into a light tree that tolerates missing end tags.  Elements that are never content
(menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, comments; by their names, roles or a
whole class name or id) are left out.  Each paragraph passes points, for its length and its commas, to the elements around
it, half as many with each step up.  An element's points are discounted by the share of its text that is link text, and
much if a part of its class or id marks it (``comment-list``); the best container is kept, with siblings of similar
worth and without marked elements inside it, unless nothing else is there.  Their blocks are the text: white space inside a
block is one space, blocks are joined by an empty line in page order.

An element without an end tag ends with the element around it; ``svg`` and ``math`` also before a block, and an
element of raw text (but scripts and styles, which run to the end of the page) where it begins.  Points, sums and choices are
one pass over the tree each, so a page costs time in proportion to its length however deep it nests.

Defined cases: null and empty pages, and pages without content, have the text '' and 0 characters; a page
without any markup is one block; pages are read row by row, so repeated rows and null ids are kept; ties
between containers go to the one that begins first; other columns are ignored, whatever their names; an empty
table gives an empty result.  Pages of any length are read whole.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT = "page_id long, url string, text string, n_chars long"

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>", re.DOTALL)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.IGNORECASE)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Elements whose content is text up to their end tag, and those of them that run to the end of the page without one.
RAW = {"script", "style", "textarea", "iframe", "title", "xmp", "noembed", "noframes"}
ENDLESS = {"script", "style"}
FOREIGN = {"svg", "math"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "search",
    "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
#: Elements that are never content, by name.
DROPPED = {"head", "nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "option", "input", "fieldset", "object", "embed", "canvas", "audio", "video", "search", "svg", "math", "template", "noscript", *RAW}
#: And by role, or by a class name or an id; as a part of one they are a mark.
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "menubar", "dialog", "alertdialog", "alert"}
MARKS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "disqus",
    "footer", "gdpr", "header", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pagination", "pager", "popup", "promo", "related",
    "respond", "share", "sharing", "sidebar", "skyscraper", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
#: Parts of a name after which a mark says what is not there, or is elsewhere; the header of these is part of the article.
_NEGATIONS = {"no", "not", "without", "with", "has", "hide", "non"}
_ARTICLE = {"article", "post", "entry", "content", "section", "story"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}
#: What is left of the points of a marked element.
MARKED = 0.2
#: Elements that a new block of the key's kind closes.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Points that an element has for its name alone.
_START = {"article": 25.0, "main": 20.0, "section": 5.0, "div": 5.0, "body": 0.0, "td": 3.0, "blockquote": 3.0, "pre": 3.0}


class Node:
    __slots__ = ("block", "chars", "children", "kept", "linked", "marked", "name", "parent", "passed", "points", "worth")

    def __init__(self, name: str, parent: Node | None, marked: bool = False):
        self.name, self.parent, self.marked, self.kept = name, parent, marked, False
        self.children: list[Node | str] = []
        self.points, self.worth, self.passed, self.chars, self.linked = _START.get(name, 0.0), 0.0, 0.0, 0, 0
        #: The innermost block that it is, or lies in.
        self.block: Node | None = self if name in BLOCK else parent and parent.block


def _judge(name: str, attributes: str) -> tuple[bool, bool]:
    """(is never content, is marked) by an element's name and attributes."""
    if name in DROPPED:
        return True, False
    if not attributes or name in ("html", "body", "article", "main"):
        return False, False
    marked = False
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
            return True, False
        if key == "role" and value.lower() in ROLES:
            return True, False
        if key in ("class", "id"):
            for whole in value.split():
                if whole.lower() in MARKS and name not in _HEADINGS:
                    return True, False
                parts = [w.lower() for w in _WORD.findall(whole)]
                for before, part in zip(["", *parts], parts):
                    if part in MARKS and before not in _NEGATIONS and not (part == "header" and not _ARTICLE.isdisjoint(parts)):
                        marked = name not in _HEADINGS
    return False, marked


def parse(page: str) -> list[Node]:
    """The elements of a page without those that are never content, the root first, each before those inside it."""
    root = now = Node("html", None)
    nodes, opened = [root], {"html": 1}  # how many elements of a name are open
    skipped: list[str] = []  # names of open elements within an unwanted one
    skipping: dict[str, int] = {}
    unended: set[str] = set()  # raw elements that have no end tag from here on
    at, size = 0, len(page)

    def close(node: Node) -> Node:
        closed = now
        while closed is not node:
            opened[closed.name] -= 1
            closed = closed.parent
        opened[node.name] -= 1
        return node.parent

    def unskip(count: int) -> None:
        for name in skipped[count:]:
            skipping[name] -= 1
        del skipped[count:]

    while at < size:
        found = _TOKEN.search(page, at)
        begin = found.start() if found else size
        if begin > at and not skipped:
            now.children.append(page[at:begin])
        if not found:
            break
        at = found.end()
        closing, name, attributes = found.groups()
        if name is None:
            continue
        name = name.lower()
        if skipped:
            if closing:
                if skipping.get(name):
                    count = len(skipped) - 1
                    while skipped[count] != name:
                        count -= 1
                    unskip(count)
                    continue
                if not opened.get(name) or name in ("html", "body"):
                    continue
                unskip(0)  # the end of an element around the unwanted one
            elif skipped[0] in FOREIGN and name in BLOCK and not skipping.get("foreignobject"):
                unskip(0)
        if skipped:
            if name in RAW:
                at = _raw_end(page, name, at, unended)
            elif name not in VOID and not attributes.endswith("/"):
                if name == "p" or name in _CLOSES:
                    while len(skipped) > 1 and skipped[-1] in _CLOSES.get(name, {"p"}):
                        unskip(len(skipped) - 1)
                skipped.append(name)
                skipping[name] = skipping.get(name, 0) + 1
            continue
        if closing:
            if opened.get(name):
                node = now
                while node.name != name:
                    node = node.parent
                if node.parent is not None:
                    now = close(node)
            continue
        if name in VOID:
            if name not in DROPPED:
                now.children.append(Node(name, now))
            continue
        if name in RAW:
            at = _raw_end(page, name, at, unended)
            continue
        if name in ("html", "body") and now.parent is None:
            continue
        closes = _CLOSES.get(name) or ({"p"} if name in BLOCK else None)
        if closes:
            inside = now.block
            while inside is not None and inside.name == "p" and "p" not in closes:
                inside = inside.parent and inside.parent.block
            if inside is not None and inside.name in closes and inside.parent is not None:
                now = close(inside)
        never, marked = _judge(name, attributes)
        if never:
            if not attributes.endswith("/"):
                skipped.append(name)
                skipping[name] = skipping.get(name, 0) + 1
            continue
        child = Node(name, now, marked)
        now.children.append(child)
        nodes.append(child)
        opened[name] = opened.get(name, 0) + 1
        now = child
    return nodes


def _raw_end(page: str, name: str, at: int, unended: set[str]) -> int:
    """The place behind the end tag of a raw element."""
    end = None if name in unended else re.compile(f"</{name}[^>]*>", re.IGNORECASE).search(page, at)
    if end:
        return end.end()
    unended.add(name)
    return len(page) if name in ENDLESS else at


def _blocks(node: Node) -> Iterator[tuple[Node, str, int]]:
    """(the element a block belongs to, its text, characters in links) in page order."""
    parts: list[str] = []
    linked = 0
    owner = node
    todo: list[tuple[Node | str | None, Node, int]] = [(node, node, 0)]
    while todo:
        item, block, links = todo.pop()
        if isinstance(item, str):
            if not parts:
                owner, linked = block, 0
            text = html.unescape(item) if "&" in item else item
            parts.append(text)
            if links:
                linked += len(text.strip())
            continue
        border = item is None or item.name in BLOCK
        if border and parts:
            text = " ".join("".join(parts).split())
            parts = []
            if text:
                yield owner, text, min(linked, len(text))
        if item is None:
            continue
        if item.name == "br":
            parts.append(" ") if parts else None
            continue
        inner = item if item.name in BLOCK else block
        if border:
            todo.append((None, block, 0))
        todo.extend((c, inner, links + (item.name == "a")) for c in reversed(item.children))
    text = " ".join("".join(parts).split())
    if text:
        yield owner, text, min(linked, len(text))


def main_text(page: str | None) -> str:
    """The main text of a page."""
    if not page:
        return ""
    nodes = parse(page)
    root = nodes[0]
    blocks = list(_blocks(root))
    if not blocks:
        return ""
    for owner, text, linked in blocks:
        owner.worth += 1.0 + text.count(",") + min(len(text) / 100, 3.0)
        owner.chars += len(text)
        owner.linked += linked
    for node in reversed(nodes):  # what lies inside an element comes before it
        node.points += node.passed + (node.worth if node is root else 0.0)
        if node.parent is not None:
            node.parent.passed += node.worth + node.passed / 2
            node.parent.chars += node.chars
            node.parent.linked += node.linked
    value = lambda n: n.points * (1 - n.linked / max(1, n.chars)) * (MARKED if n.marked else 1)
    inner = [n for n in nodes if n.chars and (n.name not in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "a", "b", "i", "span") or n.parent is None)]
    best = max(inner, key=value) if inner else root
    best.kept = True
    if best.parent is not None and best.name not in ("article", "main"):
        least = max(10.0, 0.2 * value(best))
        for other in best.parent.children:
            if isinstance(other, Node) and other is not best and other.chars and not other.marked:
                density = other.linked / other.chars
                if value(other) >= least or other.name == "p" and (density < 0.25 and other.chars > 80 or not density):
                    other.kept = True
    return _joined(nodes, blocks, True) or _joined(nodes, blocks, False)


def _joined(nodes: list[Node], blocks: list[tuple[Node, str, int]], unmarked: bool) -> str:
    """The blocks of the kept elements; with ``unmarked`` without those of marked elements inside them."""
    inside: set[int] = set()
    for node in nodes:
        if node.kept or node.parent is not None and id(node.parent) in inside and not (unmarked and node.marked):
            inside.add(id(node))
    return "\n\n".join(text for owner, text, _ in blocks if id(owner) in inside)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 64) for i in range(0, len(batch), 64)):
                texts = [main_text(h) for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    string = [F.col(c).cast("string").alias(c) for c in ("url", "html")]
    return pages.select(F.col("page_id").cast("long").alias("page_id"), *string).mapInArrow(run, RESULT)

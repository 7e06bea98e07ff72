"""Main text of web pages by composite text density.

A page is read into a tree (comments, scripts, styles, forms and elements that name themselves a menu, header, footer,
sidebar, notice, advert or reader comment are left out). A name is any part of a class or id that is listed, unless a word
such as ``with`` or ``no`` stands right before or behind it. It doesn't count for an element that holds the article: see ``_unname``. Each node
gets its characters per tag, adjusted by the links in it: dense links make a node sparse. Bare text and inline
elements in a block make a node of their own, whose density is the sum of its parts between doubled line breaks; line
breaks are no tags in this. The node whose children's densities sum to the most is the centre of the text. The least
density on the way from it to the body is the threshold: an article or main element on that way is taken whole;
otherwise, beside the centre, those neighbours of the way are taken whose density reaches the threshold, and headings.

Character references are decoded, white space inside a block becomes one space, blocks are trimmed and joined by
newlines in page order. Null or empty html, or a page without text, gives an empty string. Pages are read one by
one whatever their length; broken markup (open tags at the end, missing end tags, a lone <) is read as browsers
do, in time that grows with the page (open elements are found by name, not by a walk). Repeated rows and ties change nothing; an empty table gives an empty table; extra columns pass through, and a
column with the result's name is replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cardwatch.llm.common import need, small_batches

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "template"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure",
    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section",
    "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
FOREIGN = {"svg", "math"}
#: What may be in a head; anything else ends it.
HEAD = {"base", "link", "meta", *RAW} - {"textarea", "xmp", "iframe"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Elements that are no article text.
DROPPED = {"head", "nav", "footer", "aside", "form", "button", "select", "svg", "canvas", "object", "dialog", "menu", *RAW}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "form"}
#: Words in class or id by which an element names itself something else than article text.
NAMES = {
    "ad", "ads", "adbox", "adsense", "advert", "advertisement", "advertising", "adverts", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
    "cookie", "cookies", "consent", "disqus", "footer", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "popup",
    "promo", "related", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
#: Names of readers' comments, which may be longer than the article.
READERS = {"comment", "comments", "disqus"}
#: Names that count only as a whole: page builders call any part of an article so.
WHOLE = {"widget"}
#: Words that make a name say what an element has or hasn't, not what it is.
MODIFIERS = {"with", "without", "has", "have", "no", "non", "not", "free", "hide"}
#: Characters from which most of a page's text, though not all of it, is taken for its article whatever its name is.
DENSE = 100
#: A run of bare text and inline elements, and a part of it: nodes without a tag.
RUN, PART = "#run", "#part"
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z:_-]+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


class Node:
    __slots__ = ("blocks", "chars", "density", "depth", "dropped", "ended", "kids", "link_chars", "link_tags", "name", "parent", "tag", "tags", "total")

    def __init__(self, tag: str, parent: Node | None, dropped: bool = False) -> None:
        self.tag, self.parent, self.dropped = tag, parent, dropped
        self.name = ""
        self.depth = parent.depth + 1 if parent else 0
        #: Blocks and left-out elements from the root down to this one.
        self.blocks = (parent.blocks if parent else 0) + (tag in BLOCKS or dropped)
        self.ended = False  # an inline element whose end tag came inside a block that is still open
        self.kids: list = []  # nodes and strings
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def is_text(tag: str, attributes: str, in_article: bool) -> bool:
    """False for elements that by tag, role or style aren't part of an article."""
    if tag in DROPPED or tag == "header" and not in_article:
        return False
    if attributes and tag not in ("html", "body", "article", "main"):
        for name, value in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'").lower()
            if name == "role" and value in ROLES:
                return False
            if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
                return False
    return True


def name_of(tag: str, attributes: str) -> str:
    """The listed word by which an element names itself something else than article text, or nothing."""
    found: list[str] = []
    if attributes and tag not in ("html", "body", "article", "main"):
        for name, value in ATTRIBUTE.findall(attributes):
            if name.lower() in ("class", "id"):
                for token in value.strip("\"'").split():
                    parts = [p.lower() for p in WORD.findall(token)]
                    for k, p in enumerate(parts):
                        if p in NAMES and MODIFIERS.isdisjoint(parts[max(k - 1, 0):k + 2]) and (len(parts) == 1 or p not in WHOLE):
                            found.append(p)
    return next((p for p in found if p in READERS), found[0] if found else "")


def read(html: str) -> Node:
    """The tree of what may be text; what isn't is read into the tree like the rest, and then left out with all that it holds."""
    root = Node("body", None)
    node, at = root, 0
    articles = foreign = 0  # open article and main elements; open svg and math elements
    open_by: dict[str, list[Node]] = {}  # open elements by name, the innermost last
    live: dict[str, list[Node]] = {}  # those of them whose end tag wasn't seen
    end = len(html)

    def nearest(tags: Iterable[str]) -> Node | None:
        """The innermost open element of these names."""
        found = [open_by[t][-1] for t in tags if open_by.get(t)]
        return max(found, key=lambda x: x.depth, default=None)

    def outside(tags: Iterable[str], stop_at: Iterable[str]) -> Node:
        """The parent of the nearest open element of ``tags``; the current one if there is none, or one of ``stop_at`` is nearer."""
        found, wall = nearest(tags), nearest(stop_at)
        return node if found is None or wall is not None and wall.depth > found.depth or wall is found else found.parent

    def leave(to: Node) -> None:
        """Close the open elements down to ``to``, and below it those whose end tag was seen."""
        nonlocal node, articles, foreign
        while node is not to or node.ended and node.parent:
            if node is to:
                to = node.parent
            articles -= node.tag in ("article", "main")
            foreign -= node.tag in FOREIGN
            open_by[node.tag].pop()
            if not node.ended:
                live[node.tag].pop()
            node = node.parent

    def finish(x: Node) -> None:
        """The end tag of an inline element came inside a block that is still open."""
        if not x.ended:
            x.ended = True
            same = live[x.tag]
            same.pop() if same[-1] is x else same.remove(x)

    while at < end:
        m = TOKEN.search(html, at)
        stop = m.start() if m else end
        if stop > at:
            if node.tag == "head" and html[at:stop].strip():
                leave(node.parent)
            node.kids.append(html[at:stop])
        if not m:
            break
        at = m.end()
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            open_, table = live[tag][-1] if live.get(tag) else None, nearest(("table",))
            if open_ and not (table and table.depth > open_.depth):  # no end tag reaches out of a table
                if node.blocks > open_.blocks and tag not in BLOCKS and not open_.dropped:
                    finish(open_)
                else:
                    leave(open_.parent)
            elif tag == "p":
                node.kids.append(Node("p", node))
            continue
        if node.tag == "head" and tag not in HEAD:
            leave(node.parent)
        empty = tag in VOID or attributes.endswith("/") and (foreign > 0 or tag in FOREIGN)
        if tag in RAW:
            close = None if empty else re.compile(f"</{re.escape(tag)}[^>]*(?:>|\\Z)", re.I).search(html, at)
            at = at if empty else close.end() if close else end
            continue
        if tag in ("html", "body") or tag == "form" and open_by.get("form"):  # no form in a form
            continue
        if foreign and tag in BLOCKS:  # a block ends a picture or formula that is open
            x = nearest((*FOREIGN, "foreignobject"))
            if x.tag in FOREIGN:
                leave(x.parent)
        if tag in BLOCKS and tag != "li":  # a block ends an open paragraph
            leave(outside(("p",), BLOCKS - {"p"}))
        if tag in ("li", "dt", "dd", "option", "tr", "td", "th"):
            ends = {"dt", "dd"} if tag in ("dt", "dd") else {"td", "th"} if tag in ("td", "th") else {"tr"} if tag == "tr" else {tag}
            leave(outside(ends, {"ul", "ol", "dl", "table", "select", "menu"} | ({"tr"} if tag in ("td", "th") else set())))
        if tag in ("button", "select"):  # can't be nested
            leave(outside((tag,), ("table",)))
        if tag == "a":
            x = nearest(("a", "table"))
            if x is not None and x.tag == "a":
                finish(x)
                leave(outside(("a",), BLOCKS))
        new = Node(tag, node, not is_text(tag, attributes, articles > 0))
        new.name = name_of(tag, attributes)
        node.kids.append(new)
        if not empty:
            node = new
            open_by.setdefault(tag, []).append(new)
            live.setdefault(tag, []).append(new)
            articles += tag in ("article", "main")
            foreign += tag in FOREIGN
    prune(root)
    _unname(root)
    prune(root)
    _wrap(root)
    return root


def _wrap(root: Node) -> None:
    """Make a node of each run of text and inline elements in a block, so that these are on a par with the blocks beside them."""
    nodes = _walk(root)
    block = {id(root)}  # blocks, and inline elements that hold one
    for x in reversed(nodes):
        if x.parent and (x.tag in BLOCKS or id(x) in block):
            block.update((id(x), id(x.parent)))
    for x in nodes:
        if id(x) in block:
            runs: list = [[]]
            for k in x.kids:
                if isinstance(k, Node) and id(k) in block:
                    runs += [k, []]
                else:
                    runs[-1].append(k)
            x.kids = []
            for r in runs:
                x.kids += [r] if isinstance(r, Node) else [_run(r, x)] if any(isinstance(k, Node) or k.strip() for k in r) else r


def _run(kids: list, parent: Node) -> Node:
    run = Node(RUN, parent)
    part: list = []
    breaks = 0

    def end() -> None:
        if part:
            new = Node(PART, run)
            new.kids = list(part)
            for k in part:
                if isinstance(k, Node):
                    k.parent = new
            run.kids.append(new)
            part.clear()

    for k in kids:
        if isinstance(k, str) and not k.strip():
            part.append(k)
            continue
        if isinstance(k, Node) and k.tag == "br":
            breaks += 1
        else:
            if breaks > 1:
                end()
            breaks = 0
        part.append(k)
    end()
    return run


def _unname(root: Node) -> None:
    """Mark named elements as dropped, but not one that holds the article.

    That is one that holds a main or h1 element, or, if no other article or main element with text of its own is on the
    page, an article element or most of the page's characters outside links. Comments need a main element if an
    article, main or h1 element is outside of them. Outer elements are judged first, then those in the ones kept. A page
    whose whole text is in named elements keeps them.
    """
    nodes = _walk(root)
    named = [x for x in nodes if x.name]
    if not named:
        return
    linked, own, plain, holds = {id(root): False}, {}, dict.fromkeys(map(id, nodes), 0), dict.fromkeys(map(id, nodes), frozenset())
    for x in nodes[1:]:
        linked[id(x)] = x.tag == "a" or linked[id(x.parent)]
    for x in reversed(nodes):
        own[id(x)] = 0 if linked[id(x)] else sum(len("".join(k.split())) for k in x.kids if isinstance(k, str))
        plain[id(x)] += own[id(x)]
        if x.tag in ("article", "main", "h1"):
            holds[id(x)] |= {x.tag}
        if x.parent:
            plain[id(x.parent)] += plain[id(x)]
            holds[id(x.parent)] |= holds[id(x)]
    for inner in (False, True):
        inside = {id(root): False}
        for x in nodes[1:]:
            inside[id(x)] = inside[id(x.parent)] or bool(x.name)
        outside = dict.fromkeys(map(id, nodes), 0)
        for x in reversed(nodes):
            outside[id(x)] += 0 if inside[id(x)] else own[id(x)]
            if x.parent:
                outside[id(x.parent)] += outside[id(x)]
        marks = [x for x in nodes if x.tag in ("article", "main", "h1") and not inside[id(x)]]
        texts = {id(x) for x in marks if x.tag != "h1" and outside[id(x)]}
        above = {id(root): 0}
        for x in nodes[1:]:
            above[id(x)] = above[id(x.parent)] + (id(x) in texts)
        for x in nodes[1:]:
            if not x.name or x.dropped or not inner and inside[id(x.parent)]:
                continue
            held = holds[id(x)]
            elsewhere = len(texts) > above[id(x)]
            most = plain[id(x)] >= DENSE and 2 * plain[id(x)] > plain[id(root)]
            if "main" in held or not (x.name in READERS and marks) and ("h1" in held or not elsewhere and ("article" in held or most)):
                x.name = ""
            else:
                x.dropped = True
    gone = {id(root): False}
    for x in nodes[1:]:
        gone[id(x)] = gone[id(x.parent)] or x.dropped
    left = sum(own[id(x)] for x in nodes if not gone[id(x)])
    if not left:
        for x in named:
            x.dropped = False


def prune(root: Node) -> None:
    for x in _walk(root):
        x.kids = [k for k in x.kids if isinstance(k, str) or not k.dropped]


def _walk(root: Node) -> list[Node]:
    """Parents before children, in page order."""
    out, stack = [], [root]
    while stack:
        x = stack.pop()
        out.append(x)
        stack.extend(k for k in reversed(x.kids) if isinstance(k, Node))
    return out


def measure(root: Node) -> Node:
    """Set the densities; the node with the largest sum of its children's densities (the first if equal)."""
    nodes = _walk(root)
    linked = {id(root): False}
    for x in nodes[1:]:
        linked[id(x)] = x.tag == "a" or linked[id(x.parent)]
    for x in reversed(nodes):
        own = sum(len("".join(k.split())) for k in x.kids if isinstance(k, str))
        x.chars += own
        x.link_chars += own if linked[id(x)] else 0
        if x.parent:
            p = x.parent
            p.chars += x.chars
            p.tags += x.tags + (x.tag not in ("br", RUN, PART))
            p.link_chars += x.link_chars
            p.link_tags += x.link_tags + (x.tag == "a")
    page = root.link_chars / max(root.chars, 1)
    for x in nodes:
        plain = x.chars / max(x.tags, 1)
        base = math.log(math.log(x.chars / max(x.chars - x.link_chars, 1) * x.link_chars + page * x.chars + math.e))
        ratio = x.chars / max(x.link_chars, 1) * max(x.tags, 1) / max(x.link_tags, 1)
        # without any link on the page the base is 1: plain characters per tag
        x.density = plain * max(0.0, math.log(ratio)) / base if base > 1e-9 and x.chars else plain
    inline = {id(root): False}
    for x in nodes[1:]:
        inline[id(x)] = x.tag == RUN or inline[id(x.parent)]
    for x in reversed(nodes):
        x.total = sum(k.density for k in x.kids if isinstance(k, Node))
        if x.tag == RUN:
            x.density = x.total
    return max((x for x in nodes if not inline[id(x)]), key=lambda x: x.total)


def chosen(root: Node) -> set[int]:
    """Ids of the nodes to take whole."""
    centre = measure(root)
    way = [centre]
    while way[-1].parent:
        way.append(way[-1].parent)
    whole = [x for x in way if x.tag in ("article", "main")]
    if whole:
        return {id(whole[-1])}
    threshold = min(x.density for x in way)
    take = {id(centre)}
    for below, x in zip(way, way[1:], strict=False):
        take.update(id(k) for k in x.kids if isinstance(k, Node) and k is not below and k.chars and (k.density >= threshold or k.tag in HEADINGS))
    return take


def text_of(root: Node, take: set[int]) -> str:
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        if text:
            blocks.append(text)
        line.clear()

    stack: list = [(root, id(root) in take, False)]
    while stack:
        x, inside, leaving = stack.pop()
        if isinstance(x, str):
            line.append(unescape(x))
        elif leaving:
            flush()
        else:
            if x.tag in BLOCKS or x.tag == RUN:
                if inside:
                    flush()
                stack.append((x, inside, True))
            if x.tag == "br" and inside:
                line.append(" ")
            for k in reversed(x.kids):
                if isinstance(k, Node):
                    stack.append((k, inside or id(k) in take, False))
                elif inside:
                    stack.append((k, inside, False))
    flush()
    return "\n".join(blocks)


def main_text(html: str | None) -> str:
    root = read(html or "")
    return text_of(root, chosen(root))


def extract(df: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """Replace the column ``html`` by ``text``."""
    need(df, html)
    small_batches(df.sparkSession)
    kept = [f for f in df.schema.fields if f.name not in (html, text)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = pa.array([main_text(h.as_py()) for h in part.column(html)], pa.string())
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), texts], names=[*(f.name for f in kept), text])

    return df.mapInArrow(run, T.StructType([*kept, T.StructField(text, T.StringType(), False)]))

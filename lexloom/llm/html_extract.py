"""Main text of HTML pages by composite text density.

A page becomes a tree without scripts, styles, menus and other parts that are
never main text.  For every node: characters C, tags T, characters in links LC
and tags in links LT of its subtree.  Its density is characters per tag,
adjusted by links,

    C / T * log(C * T / (LC * LT)) / log(log(C * LC / (C - LC) + C * LCb / Cb + e))

with b for the body.  The sum of its children's densities tells how much dense
text hangs directly on a node; the node with the greatest sum holds the main
text.  The least density on the path from it to the body is the threshold
below which, outside an article, a part that is mostly links is left out.  An
article that holds the node is taken whole.  Where no article or main holds it,
the text is taken from the body down: beside the path, the children whose
density comes near the threshold belong to it too, in page order.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map

#: Nothing is given back once it is read, so that a page of broken tags takes no longer than another.
_TOKEN = re.compile(
    r"""<!--.*?(?:--\s*+>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|</?[a-zA-Z!?/][^>]*+(?:>|\Z)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*))?""")
_WORD = re.compile(r"[a-z]+")

#: Elements of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody"
    " td tfoot th thead tr ul".split()
)
NEVER = frozenset(
    "script style textarea title noscript iframe xmp noembed noframes template head nav footer aside form menu dialog search svg"
    " object canvas audio video button select datalist fieldset map applet".split()
)
#: Elements that a class or id may mark as furniture; others are text whatever their names, unless an advert.
PARTS = frozenset("article aside center dd details div dl dt figure header li ol section span table tbody td tr ul".split())
#: Words in classes and ids that mark a part as never main text.
NOISE = frozenset(
    "ad ads adbox advert advertisement advertisements advertising adverts banner breadcrumb breadcrumbs byline comment commentlist comments"
    " consent cookie cookies disclaimer discussion disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices"
    " notification pager pagination popup privacy promo promoted promotion recommended related replies respond share sharing sidebar signup"
    " skip social sponsor sponsored subscribe subscription tags toolbar topbar widget".split()
)
ADVERTS = frozenset("ad ads adbox advert advertisement advertisements advertising adverts promo promoted promotion sponsor sponsored".split())
#: Words that say where or how a part is, and don't change what it is.
PLACES = frozenset(
    "area bar block bottom box center container content global group header inner item left links list main outer page post primary right row secondary"
    " section site top wrap wrapper".split()
)
REMARKS = frozenset("comment commentlist comments discussion disqus replies respond".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
#: Elements that an opening tag closes, and where the search for them ends.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Share of link characters from which a child below the threshold is left out.
LINKS = 0.5
#: Part of the threshold that a part beside the path has to reach: of parts alike, a smaller one is less dense.
BESIDE = 0.5
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())


class _Node:
    __slots__ = ("block", "chars", "children", "density", "link_chars", "link_tags", "parent", "tag", "tags", "total")

    def __init__(self, tag: str, parent: "_Node | None") -> None:
        self.tag, self.parent = tag, parent
        self.block = tag in BLOCK
        self.children: list = []  # nodes and strings
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _noisy(names: str, noise: frozenset[str] = NOISE) -> bool:
    """Whether one of the classes (or ids) names furniture: all of its words do, or say where it is."""
    for name in names.split():
        words = _WORD.findall(name)
        if not noise.isdisjoint(words) and all(x in noise or x in PLACES for x in words):
            return True
    return False


def _noise(tag: str, attributes: str, inside: bool, named: bool = True) -> bool:
    """Whether a part is never main text; without ``named``, classes and ids don't tell.

    Inside an article, ids are anchors of its parts.  Paragraphs, headings and
    quotations are text whatever their names, but for adverts.
    """
    if tag in NEVER or tag == "header" and not inside:
        return True
    if attributes:
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'").lower()
            if name == "role":
                if value in ROLES:
                    return True
            elif name == "hidden":
                if value != "until-found":
                    return True
            elif name == "aria-hidden":
                if value == "true":
                    return True
            elif name == "style":
                if "none" in value and re.search(r"display\s*:\s*none", value):
                    return True
            elif name in ("class", "id") and named and tag not in ("body", "html", "main"):
                if not (inside and name == "id") and _noisy(value, NOISE if tag in PARTS else ADVERTS):
                    return True
    return False


class _Open:
    """Open elements, with the places of each tag and of blocks among them, so that none has to be searched for."""

    def __init__(self) -> None:
        self.tags: list[str] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = [-1]

    def push(self, tag: str) -> None:
        self.places.setdefault(tag, []).append(len(self.tags))
        if tag in BLOCK:
            self.blocks.append(len(self.tags))
        self.tags.append(tag)

    def cut(self, k: int) -> None:
        """Close all from place ``k`` on."""
        while len(self.tags) > k:
            tag = self.tags.pop()
            self.places[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()

    def last(self, *tags: str) -> int:
        """The innermost place of one of ``tags``, or -1."""
        return max((x[-1] for t in tags if (x := self.places.get(t))), default=-1)


def parse(page: str, named: bool = True) -> _Node:
    """The tree of ``page`` without noise (that which classes and ids name only if ``named``); a broken page gives a tree all the same.

    Takes time in proportion to the page, however its tags are nested or left open.
    """
    root = _Node("html", None)
    stack = [root]  # one more than what is open
    open_ = _Open()
    # tags that were opened within noise; its first one is the noise itself
    noise = _Open()
    at = 0
    remarks = False  # the noise is readers' comments, which may be articles themselves

    def close(k: int) -> None:
        open_.cut(k)
        del stack[k + 1 :]

    def opening(tag: str) -> None:
        if tag in BLOCK and (k := open_.blocks[-1]) >= 0 and open_.tags[k] == "p":
            close(k)
        if tag in CLOSES:
            closed, ends = CLOSES[tag]
            if (k := open_.last(*closed)) > open_.last(*ends):
                close(k)

    for m in _TOKEN.finditer(page):
        if m.start() < at:
            continue
        if not noise.tags and m.start() > at:
            stack[-1].children.append(page[at : m.start()])
        at = m.end()
        tag = m[2]
        if not tag:
            continue
        tag, end, attributes = tag.lower(), m[1], m[3]
        if noise.tags:
            if end:
                own = tag in ("article", "main") and open_.last(tag) >= 0
                if (k := noise.last(tag)) >= 0:
                    noise.cut(k)
                elif own or tag == "body":
                    noise.cut(0)
                if noise.tags or not own:
                    continue
            elif tag in RAW:
                raw = re.compile(rf"</{tag}\s*+>", re.I).search(page, at)
                at = raw.end() if raw else len(page)
                continue
            else:
                inside = open_.last("article", "main") >= 0
                if (tag == "main" or tag == "article" and noise.tags[0] not in ("aside", "form") and not inside and not remarks) and not _noise(tag, attributes, False, named):
                    noise.cut(0)  # an unclosed part doesn't take the article with it
                elif tag == "body":
                    noise.cut(0)
                else:
                    if tag not in VOID and not attributes.endswith("/"):
                        noise.push(tag)
                    continue
        if end:
            k = open_.last(tag)
            if k >= 0 and (tag in BLOCK or k > open_.blocks[-1]):
                close(k)  # but an inline end tag doesn't close a block
            continue
        if tag in RAW:
            raw = re.compile(rf"</{tag}\s*+>", re.I).search(page, at)
            at = raw.end() if raw else len(page)
            continue
        if tag in VOID:
            stack[-1].tags += 1
            if tag == "br":
                stack[-1].children.append("\n")
            elif tag == "hr":
                stack[-1].children.append(None)
            continue
        if tag in ("html", "body"):
            continue
        opening(tag)
        # a button within a sentence is a part of it
        spoken = tag == "button" and open_.blocks[-1] >= 0 and open_.tags[open_.blocks[-1]] == "p"
        if not spoken and _noise(tag, attributes, open_.last("article", "main") >= 0, named):
            if not attributes.endswith("/"):
                noise.push(tag)
                remarks = not REMARKS.isdisjoint(_WORD.findall(attributes.lower()))
            stack[-1].children.append(None if tag in BLOCK else "")
            continue
        node = _Node(tag, stack[-1])
        stack[-1].children.append(node)
        stack.append(node)
        open_.push(tag)
    if not noise.tags and at < len(page):
        stack[-1].children.append(page[at:])
    return root


def _measure(root: _Node) -> list[_Node]:
    """Fills in the counts and densities; the nodes in page order."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(x for x in reversed(node.children) if isinstance(x, _Node))
    for node in reversed(order):
        for x in node.children:
            if isinstance(x, str):
                node.chars += len(x.strip())
            elif x is not None:
                node.chars += x.chars
                node.tags += x.tags + 1
                node.link_chars += x.chars if x.tag == "a" else x.link_chars
                node.link_tags += x.tags + 1 if x.tag == "a" else x.link_tags
    share = root.link_chars / root.chars if root.chars else 0.0
    for node in order:
        c, t, lc, lt = node.chars, max(1, node.tags), max(1, node.link_chars), max(1, node.link_tags)
        if c:
            base = math.log(c * lc / max(1, c - node.link_chars) + share * c + math.e)
            node.density = max(0.0, c / t * math.log(max(1.0, c * t / (lc * lt))) / max(1e-9, math.log(max(base, 1.0 + 1e-9))) if base > 1 + 1e-9 else c / t)
        if node.parent is not None:
            node.parent.total += node.density
    return order


def _dense(node: _Node, path: set[_Node], whole: _Node, threshold: float) -> list:
    """The children of a node of the path that belong to the text, a heading with what follows it."""
    kept, wanted = [], False
    for x in reversed(node.children):
        if not isinstance(x, _Node):
            kept.append(x)  # loose text is no child that could be weighed
            continue
        text = (x.chars if x.tag == "a" else x.link_chars) <= LINKS * x.chars
        if x.tag in HEADINGS:
            keep = wanted and text
        else:
            keep = x in path or x is whole or text and (not x.block or x.density >= BESIDE * threshold)
            if x.chars:
                wanted = keep
        kept.append(x if keep else None)
    return kept[::-1]


def extract(page: str | None) -> str:
    """The main text of ``page``; empty for null, empty or textless pages.

    Blocks in page order, joined by line ends; white space within a block is
    one space; character references are decoded.
    """
    if not page:
        return ""
    root = parse(page)
    order = _measure(root)
    if not root.chars:
        # a name took the wrapper of all the page
        root = parse(page, named=False)
        order = _measure(root)
    if not root.chars:
        return ""
    best = max(order, key=lambda x: x.total)
    if best.total <= 0:
        best = root
    threshold, x = best.density, best
    while x is not None:
        threshold = min(threshold, x.density)
        x = x.parent
    # the whole article, when the text is within one; and never a part of a block
    x, top = best, best
    while x is not None:
        if x.tag in ("article", "main") or not top.block:
            top = x
        x = x.parent
    path: set[_Node] = set()
    whole = top
    if top.tag not in ("article", "main"):
        x = top.parent
        while x is not None:
            path.add(x)
            top, x = x, x.parent
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        if line:
            if text := " ".join(html.unescape("".join(line)).split()):
                blocks.append(text)
            line.clear()

    # end marks of blocks are None on the stack
    todo: list = [top]
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            line.append(x)
        elif whole.tag != "article" and x is not top and x.block and x.tag != "p" and x.density < threshold and x.link_chars > LINKS * x.chars:
            flush()
        else:
            if x.block:
                flush()
                todo.append(None)
            todo.extend(reversed(_dense(x, path, whole, threshold) if x in path else x.children))
    flush()
    return "\n".join(blocks)


def extract_pages(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """``pages`` with its HTML replaced by ``text``, the main text, and ``n_chars``, its code points.

    Null or empty pages give an empty text; repeated rows are extracted each
    for itself.  No shuffle: a page is read and written by one task, a batch at
    a time.  Columns that are called text or n_chars already are replaced.
    """
    kept = [c for c in pages.columns if c not in (html_column, "text", "n_chars")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(x.as_py()) for x in batch.column(len(kept))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[*kept, "text", "n_chars"]
            )

    rows = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(html_column))
    schema = ", ".join([*[f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in kept], "text string", "n_chars long"])
    return arrow_map(rows, work, schema)

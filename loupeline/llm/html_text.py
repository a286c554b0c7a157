"""Main text of web pages by tree scoring.

Every page becomes a small tree. A block of text gives points for its length and commas to its parent, half of them to
the grandparent and a third to the level above; a container's points are discounted by its share of link text. The best
container and its siblings are kept, siblings that are mostly links excepted; menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and reader comments are never part of it. Character references are decoded, white space inside a
block becomes one space, blocks are joined in page order by a newline; nothing else is dropped or cut.

What a class, id or role says counts by where it stands. A whole name that means page furniture (``class="menu"``) marks any block; a name that only
contains such a word (``id="related-work"``) marks it outside articles, and inside them only if the word means nothing else (``ad-slot``,
``comment-list``) or most of its text are links. Headings and
paragraphs are judged by whole classes and roles alone. A form is page furniture unless it holds most of the page's text.

Every step takes time in proportion to the page: ancestors are looked up by pointers and counts of open tags, texts are added up once
from the leaves, and a quote without an end ends with its tag.

A null or empty page, or one without such text, gives an empty string. Unclosed and crossing tags are accepted. Pages are
judged one at a time, so the work per task is bounded by its Arrow batch; repeated rows are judged each. Input columns
named ``text`` or ``n_chars`` are replaced by the result.
"""
from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loupeline.llm import common

# Element names of HTML by role, and the words in class, id or role that mark page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("aside button canvas datalist dialog footer head header iframe input label menu nav noframes noscript object option script select style "
                    "svg template textarea title".split())
RAW = frozenset("script style textarea title noscript iframe noframes xmp".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                   "header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
ENDS_PARAGRAPH = BLOCKS - frozenset("html body caption td th tr tbody thead tfoot".split())
SIBLINGS = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
FURNITURE = frozenset("ad ads advert adverts advertisement advertising adsense adbox banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb "
                      "breadcrumbs sidebar side footer header masthead comment comments commentlist disqus respond reply replies cookie cookies consent gdpr notice notices "
                      "alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended widget toolbar pagination pager "
                      "skip hidden search complementary contentinfo".split())
CERTAIN = frozenset("ad ads advert adverts advertisement advertising adsense adbox sponsor sponsored comment comments commentlist disqus cookie cookies consent gdpr newsletter "
                    "sidebar breadcrumb breadcrumbs masthead navbar pagination".split())
CONTENT = frozenset("article content main entry post story body text".split())
CONTAINERS = frozenset("html body div article section main td form".split())
CONTENT_TAGS = {"article": 30.0, "main": 25.0, "section": 3.0, "div": 2.0, "blockquote": 1.0, "td": 1.0}
PARAGRAPH_STOPS = frozenset("table td th button article body div section aside li blockquote".split())
LIST_STOPS = frozenset("ul ol dl table".split())
MOSTLY = 0.5  # share of link text from which on a doubtful block is a menu, and of a page's text from which on a form is the page

_OPENING = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|/?[a-zA-Z])")
_NAME = re.compile(r"[^\s/>]*")
_TAG_PART = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[a-z]+")


class Node:
    """An element. ``block`` is the nearest block, itself included; ``paragraph`` and ``item`` the nearest element that decides what closes."""

    __slots__ = ("tag", "parent", "skipped", "doubtful", "marks", "points", "size", "linked", "order", "block", "paragraph", "item", "article")

    def __init__(self, tag: str, parent: Node | None, attributes: str, order: int):
        self.tag, self.parent, self.order = tag, parent, order
        self.points, self.size, self.linked = 0.0, 0, 0
        self.block = self if tag in BLOCKS or parent is None else parent.block
        self.paragraph = self if tag == "p" or tag in PARAGRAPH_STOPS else parent and parent.paragraph
        self.item = self if tag in SIBLINGS or tag in LIST_STOPS else parent and parent.item
        self.article = tag in ("article", "main") or parent is not None and parent.article
        found = {}
        if attributes.strip():
            found = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(attributes)}
        named = f"{found.get('class', '')} {found.get('role', '')}"
        if tag not in HEADINGS and tag != "p":
            named += f" {found.get('id', '')}"
        names = named.split()
        self.marks = frozenset(_WORDS.findall(named))
        mine = tag not in ("html", "body", "main") and not (tag == "article" and not self.marks & {"comment", "comments", "reply"})
        whole = mine and any(name in FURNITURE for name in names)
        part = mine and bool(self.marks & FURNITURE) and tag not in HEADINGS and tag != "p"
        above = parent is not None and parent.skipped
        outside = not self.article or bool(self.marks & CERTAIN)
        self.skipped = above or tag in SKIPPED or "hidden" in found or found.get("aria-hidden") == "true" or whole or part and outside
        self.doubtful = not self.skipped and (part or tag == "form")
        if tag in HEADINGS and self.skipped and not whole and parent is not None and (parent.tag == "header" or "header" in parent.marks):
            self.skipped = not parent.article or parent.parent.skipped  # an article's own title


class _Tags:
    """Reads markup from left to right; a quote that never ends is looked for once."""

    def __init__(self, page: str):
        self.page, self.endless = page, set()

    def _ending(self, what: str, at: int) -> int:
        """Place behind ``what``, or the end of the page."""
        found = -1 if what in self.endless else self.page.find(what, at)
        if found < 0:
            self.endless.add(what)
            return len(self.page)
        return found + len(what)

    def next(self, at: int) -> tuple[int, int, str, str, bool] | None:
        """Start and end of the next piece of markup; name, attributes and whether it closes (no name: comments and the like)."""
        mark = _OPENING.search(self.page, at)
        if mark is None:
            return None
        start, end, lead = mark.start(), mark.end(), mark[0]
        if lead in ("<!--", "<![CDATA["):
            return start, self._ending("-->" if lead == "<!--" else "]]>", end), "", "", False
        if lead in ("<!", "<?"):
            return start, self._ending(">", end), "", "", False
        name = _NAME.match(self.page, end - 1)
        place = name.end()
        while True:
            part = _TAG_PART.search(self.page, place)
            if part is None:  # no end: the rest is no markup
                return start, len(self.page), "", "", False
            place = part.end()
            if part[0] == ">":
                return start, place, name[0].lower(), self.page[name.end():place - 1], lead[1] == "/"
            close = -1 if part[0] in self.endless else self.page.find(part[0], place)
            if close < 0:
                self.endless.add(part[0])
            else:
                place = close + 1


def parse(page: str) -> tuple[list[Node], list[tuple[Node, str, int]]]:
    """Elements in page order, and blocks: the block element that holds the text, the text, and how many of its characters are links."""
    root = node = Node("html", None, "", 0)
    nodes, tags = [root], _Tags(page)
    blocks: list[tuple[Node, str, int]] = []
    held: list[str] = []
    opened = Counter()
    holder, linked = root, 0

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join("".join(held).split())
            held.clear()
            if text:
                blocks.append((holder, text, linked))
        linked = 0

    def say(piece: str) -> None:
        nonlocal holder, linked
        if not piece or node.skipped:
            return
        if node.block is not holder:
            flush()
            holder = node.block
        text = html.unescape(piece)
        held.append(text)
        if opened["a"]:
            linked += len(text.strip())

    def close(top: Node) -> None:
        nonlocal node
        while True:
            done, node = node, node.parent
            opened[done.tag] -= 1
            if done.tag in BLOCKS:
                flush()
            if done is top:
                return

    size, at = len(page), 0
    while at < size:
        mark = tags.next(at)
        if mark is None:
            say(page[at:])
            break
        start, end, tag, attributes, closes = mark
        say(page[at:start])
        at = end
        if not tag:
            continue
        if closes:
            if tag == "br" or tag == "p" and not opened["p"]:
                flush()
            elif opened[tag]:
                top = node
                while top.tag != tag:
                    top = top.parent
                close(top)
            continue
        if tag in ENDS_PARAGRAPH and node.paragraph is not None and node.paragraph.tag == "p" and node.paragraph is not root:
            close(node.paragraph)
        for other in SIBLINGS.get(tag, "").split():
            item = node.item
            while item is not None and item.tag != other and item.tag not in LIST_STOPS:
                item = item.parent and item.parent.item
            if item is not None and item.tag == other:
                close(item)
        if tag in ("br", "hr"):
            held.append(" ")
            if tag == "hr":
                flush()
        if tag in VOID:
            continue
        if tag in BLOCKS:
            flush()
        if attributes.endswith("/") and tag in ("svg", "path", "use"):
            continue
        node = Node(tag, node, attributes, len(nodes))
        nodes.append(node)
        opened[tag] += 1
        if tag in RAW:
            found = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            at = found.start() if found else size
    flush()
    return nodes, blocks


def main_text(page: str | None) -> str:
    nodes, blocks = parse(page) if page else ([], [])
    for node, text, linked in blocks:
        node.size += len(text)
        node.linked += linked
    for node in reversed(nodes[1:]):  # children come after their parents
        node.parent.size += node.size
        node.parent.linked += node.linked
    total = nodes[0].size if nodes else 0
    dropped: set[int] = set()
    for node in nodes:
        form = node.tag == "form" and not node.marks & FURNITURE
        # a form that is not the page, or a block of links whose name sounds like page furniture
        if node.doubtful and (node.size < MOSTLY * total if form else node.linked > MOSTLY * node.size) or node.parent is not None and id(node.parent) in dropped:
            dropped.add(id(node))
    blocks = [block for block in blocks if id(block[0]) not in dropped]
    scored: dict[int, Node] = {}
    for node, text, _ in blocks:
        points = 0.5 if node.tag in HEADINGS else 1.0 + sum(text.count(c) for c in ",،、，") + min(len(text) / 100.0, 3.0)
        # bare text gives its points to the container that holds it
        above, level = node if node.tag in CONTAINERS or node.parent is None else node.parent, 1
        while above is not None and level <= 3:
            above.points += points / level
            scored[id(above)] = above
            above, level = above.parent, level + 1
    if not scored:
        return ""

    def score(node: Node) -> float:
        prior = CONTENT_TAGS.get(node.tag, 0.0) + (5.0 if node.marks & CONTENT else 0.0)
        return (node.points + prior) * (1.0 - min(1.0, node.linked / max(node.size, 1)))

    best = max(scored.values(), key=lambda n: (score(n), -n.order))
    most = score(best)

    def beside(node: Node) -> bool:
        """Whether a sibling of the best container is content: all that is not mostly links, but beside an article only what scores like one."""
        if node.linked > MOSTLY * node.size:
            return False
        return not best.article or node.tag in ("p", *HEADINGS) or node.tag == best.tag and node.marks == best.marks or score(node) >= max(10.0, 0.2 * most)

    kept: dict[int, bool] = {}
    for node in nodes:
        if node is best:
            kept[id(node)] = True
        elif node.parent is not None and node.parent is best.parent and node is node.block:  # a sibling of the best container
            kept[id(node)] = beside(node)
        else:
            kept[id(node)] = node.parent is not None and kept[id(node.parent)]
    return "\n".join(text for node, text, _ in blocks if kept[id(node)])


def extract_main_text(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """``pages`` without the html, with ``text`` and ``n_chars`` (its code points)."""
    kept = [c for c in pages.columns if c not in (html_column, "text", "n_chars")]
    given = pages.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{html_column}`").alias("_html"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema if f.name != "_html"), "text string", "n_chars bigint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(page) for page in part.column("_html").to_pylist()]
                columns = [part.column(c) for c in kept] + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, "text", "n_chars"])

    return common.bounded(given).mapInArrow(run, schema)

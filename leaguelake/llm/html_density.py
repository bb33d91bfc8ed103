"""Main text of web pages by composite text density.

A page is parsed to a tree of elements. Elements that say what they are not (scripts, forms, navigation, page headers,
footers, sidebars, notices, adverts, reader comments, hidden parts; by tag, role, class or id) are cut out. A class or id alone does not cut a part that holds most of the page's
characters outside links: wrappers such as ``has-sidebar`` stay and their children are judged instead. For every other
node the composite density is the number of characters per tag, adjusted by its link characters and link tags against
those of the whole body. The density sum of a node adds up its children's densities. Among the nodes at or above the
threshold (the least density on the path from the body to the densest sum) the one with the maximum sum is the core
of the article. It is widened to the article, main part or block container that it lies in, and blocks beside it join if they
reach the threshold and are not mostly links.

Blocks are joined by line ends, white space inside a block is one space, character references are decoded. Nothing else
is changed, dropped or capped.

Each page is a task-local row: there is no shuffle. Trees are walked without recursion, so depth is not limited.

Defined cases. NULL and empty html give an empty text, as do pages without text. Truncated pages keep the text before the cut; a tag
cut in two is dropped. Repeated rows are extracted row by row. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from leaguelake.llm.common import batches_of, mapped

# element classes of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
IN_HEAD = frozenset("base link meta noscript script style template title".split())
# an opening tag closes these open elements, up to the boundary
CLOSES = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu", "dir"})),
    "dd": (frozenset({"dd", "dt"}), frozenset({"dl"})),
    "dt": (frozenset({"dd", "dt"}), frozenset({"dl"})),
    "option": (frozenset({"option"}), frozenset({"select", "datalist"})),
    "tr": (frozenset({"tr", "td", "th", "caption"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "tbody": (frozenset({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}), frozenset({"table"})),
    "tfoot": (frozenset({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}), frozenset({"table"})),
}
P_BOUNDARY = frozenset("table td th caption button".split())
NEVER_TEXT = frozenset(
    "head title script style noscript template iframe object embed svg math canvas audio video map select datalist textarea button input label "
    "dialog nav aside footer menu search".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar tablist status".split())
# words of class and id that mark what does not belong to an article
APART = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors promo promotion banner banners "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager sidebar sidebars sidenav toolbar topbar masthead footer foot footnav copyright "
    "notice notices cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup login "
    "comment comments commentlist discussion replies reply respond disqus "
    "share sharing social related recommended recommendations widget widgets skip search searchform form".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist discussion replies reply respond disqus".split())
# words of parts that are links or forms where they do not belong to the text
LINK_WORDS = frozenset("related recommended recommendations social share sharing search skip form searchform navigation copyright notice notices".split())
HEADER_WORDS = frozenset({"header", "siteheader", "pageheader"})
ARTICLE_WORDS = frozenset({"article", "articlebody"})
TEXT_LEVEL = frozenset(
    "p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre td th tr tbody thead tfoot table caption figure figcaption header hgroup details summary "
    "a abbr b bdi bdo big br cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
LINKY = 0.5
MOST = 0.5
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
CUT_TAG = re.compile(r"<[A-Za-z/!?][^>]*\Z")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("tag", "marks", "apart", "marked", "inside", "parent", "items", "chars", "link_chars", "tags", "link_tags", "density", "sum")

    def __init__(self, tag: str, parent: Node | None, attrs: dict[str, str]) -> None:
        self.tag, self.parent, self.items = tag, parent, []
        name = f"{attrs.get('class', '')} {attrs.get('id', '')}"
        self.marks = {w.lower() for w in WORDS.findall(name)} if name.strip() else frozenset()
        role = attrs.get("role", "").lower()
        if role == "main" or attrs.get("itemprop", "").lower() == "articlebody":
            self.marks = {*self.marks, "articlebody"}
        self.apart = (
            tag in NEVER_TEXT
            or role in ROLES
            or "hidden" in attrs
            or attrs.get("aria-hidden", "").lower() == "true"
            or bool(HIDDEN.search(attrs.get("style", "")))
        )
        self.marked = bool(self.marks & APART) and not self.is_article() and tag != "body"
        self.inside = self.is_article() or (parent is not None and parent.inside)
        self.chars = self.link_chars = self.tags = self.link_tags = 0
        self.density = self.sum = 0.0

    def is_article(self) -> bool:
        return self.tag in ("article", "main") and not self.marks & {"comment", "comments", "reply"} or bool(self.marks & ARTICLE_WORDS)


class Builder(HTMLParser):
    """Tree of a page in document order; ``nodes`` lists parents before children.

    ``places`` has, for each tag, where it is open, so no step looks through all open elements, however deep the page.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html", None, {})
        self.nodes, self.open = [self.root], [self.root]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def _open(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.open))
        if node.tag in BLOCK:
            self.blocks.append(len(self.open))
        self.open.append(node)

    def _cut(self, place: int) -> None:
        """Close the element at a place and all within it."""
        while len(self.open) > place:
            tag = self.open.pop().tag
            self.places[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()

    def _innermost(self, tag: str) -> int:
        return self.places[tag][-1] if self.places.get(tag) else 0

    def _close(self, tags: frozenset[str], boundary: frozenset[str]) -> None:
        """Close the outermost of ``tags`` within the innermost ``boundary``."""
        edge = max(map(self._innermost, boundary))
        found = [places[i] for places in map(self.places.get, tags) if places and (i := bisect_right(places, edge)) < len(places)]
        if found:
            self._cut(min(found))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "html" or (tag == "body" and self._innermost("body")):
            return
        if tag not in IN_HEAD and len(self.open) > 1 and self.open[1].tag == "head":
            self._cut(1)
        if tag in BLOCK:
            self._close(frozenset({"p"}), P_BOUNDARY)
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        node = Node(tag, self.open[-1], {k: v or "" for k, v in attrs})
        self.open[-1].items.append(node)
        self.nodes.append(node)
        if tag not in VOID:
            self._open(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        place = self._innermost(tag)
        if tag in ("html", "body") or not place:
            return
        if tag in BLOCK or not self.blocks or self.blocks[-1] < place:
            self._cut(place)

    def handle_data(self, data: str) -> None:
        self.open[-1].items.append(data)


def _unmark_wrappers(nodes: list[Node], body: Node) -> None:
    """Take the mark from nodes that hold most characters outside links, of comments only with a heading or article inside;
    and within an article from nodes whose mark speaks of links or forms while their text is not mostly links."""
    plain: dict[Node, int] = {}
    total: dict[Node, int] = {}
    heads: set[Node] = set()
    for node in reversed(nodes):
        if node.apart:
            continue
        own = sum(len("".join(x.split())) for x in node.items if isinstance(x, str))
        kids = [x for x in node.items if not isinstance(x, str)]
        total[node] = own + sum(total.get(k, 0) for k in kids)
        if node.tag == "a":
            continue
        plain[node] = own + sum(plain.get(k, 0) for k in kids)
        if node.tag == "h1" or node.is_article() or any(k in heads for k in kids):
            heads.add(node)
    for node, chars in plain.items():
        if node.marked and chars > MOST * plain.get(body, 0) and (node in heads or not node.marks & COMMENT_WORDS):
            node.marked = False
        if node.marked and node.inside and chars > LINKY * total[node]:
            quoted = node.tag == "blockquote" and node.marks & APART <= COMMENT_WORDS
            node.marked = not (quoted or node.marks & APART <= LINK_WORDS)


def _drop(nodes: list[Node], forms: bool) -> None:
    """Cut out what does not belong to an article; ``forms`` tells whether forms go too."""
    for node in nodes:
        items = node.items
        if not items:
            continue
        node.items = [
            x
            for x in items
            if isinstance(x, str)
            or not (
                x.apart
                or x.marked
                or (x.tag == "form" and forms)
                or ((x.tag == "header" or x.marks & HEADER_WORDS) and not node.inside and not x.is_article())
            )
        ]


def _reached(root: Node) -> list[Node]:
    """Nodes that are still in the tree, parents before children."""
    out, at = [root], 0
    while at < len(out):
        out += [x for x in out[at].items if not isinstance(x, str)]
        at += 1
    return out


def _measure(nodes: list[Node]) -> None:
    """Characters and tags of every node, its composite density and its density sum."""
    for node in reversed(nodes):
        is_link = node.tag == "a"
        own = sum(len("".join(x.split())) for x in node.items if isinstance(x, str))
        kids = [x for x in node.items if not isinstance(x, str)]
        node.chars = own + sum(k.chars for k in kids)
        node.link_chars = node.chars if is_link else sum(k.link_chars for k in kids)
        node.tags = len(kids) + sum(k.tags for k in kids)
        node.link_tags = is_link + sum(k.link_tags for k in kids)
    body = nodes[0]
    share = body.link_chars / body.chars if body.chars else 0.0
    for node in nodes:
        if not node.chars:
            continue
        node.density = node.chars / max(1, node.tags)
        if share:
            base = math.log(node.chars / max(1, node.chars - node.link_chars) * node.link_chars + share * node.chars + math.e)
            ratio = node.chars / max(1, node.link_chars) * max(1, node.tags) / max(1, node.link_tags)
            node.density *= max(0.0, math.log(ratio) / math.log(base)) if base > 1.0 else 1.0
    for node in nodes:
        node.sum = sum(k.density for k in node.items if not isinstance(k, str))


def _linky(node: Node) -> bool:
    return node.link_chars > LINKY * node.chars


def _article(nodes: list[Node]) -> list[Node]:
    """The parts of the page that make the article, in page order."""
    body = nodes[0]
    densest = max(nodes, key=lambda n: n.sum if n.sum else n.density / 2)
    threshold, at = densest.density, densest
    while at is not None and at is not body:
        threshold, at = min(threshold, at.density), at.parent
    core = max((n for n in nodes if n.density >= threshold), key=lambda n: n.sum, default=body)
    if not core.sum:
        core = densest
    above, at = None, core
    while at is not None and at is not body:
        if at.is_article():
            above = at
        at = at.parent
    if above is not None:
        return [above]
    while core is not body and core.tag in TEXT_LEVEL and core.parent is not None:
        core = core.parent
    if core is body:
        return [body]
    beside = core.parent.items if core.parent is not None else [core]
    return [x for x in beside if x is core or (not isinstance(x, str) and x.chars and x.density >= threshold and not _linky(x))]


def _blocks(parts: list[Node]) -> Iterator[str]:
    """Text of blocks in page order; lists of links outside an article element are left out."""
    words: list[str] = []

    def ended() -> Iterator[str]:
        text = " ".join("".join(words).split())
        words.clear()
        if text:
            yield text

    stack: list[Node | str | None] = list(reversed(parts))
    while stack:
        item = stack.pop()
        if item is None:
            yield from ended()
        elif isinstance(item, str):
            words.append(item)
        elif item.tag == "br":
            words.append(" ")
        elif item.tag in ("ul", "ol", "dl", "table") and item.link_tags > 1 and not item.inside and _linky(item):
            continue
        else:
            if item.tag in BLOCK:
                yield from ended()
                stack.append(None)
            stack.extend(reversed(item.items))
    yield from ended()


def main_text(html: str | None) -> str:
    """Main text of a page, blocks joined by line ends."""
    if not html:
        return ""
    for forms in (True, False):  # a page that is one form has its article inside
        builder = Builder()
        builder.feed(CUT_TAG.sub("", html))
        builder.close()
        root = next((n for n in builder.nodes if n.tag == "body"), builder.root)
        _unmark_wrappers(builder.nodes, root)
        _drop(builder.nodes, forms)
        nodes = _reached(root)
        _measure(nodes)
        if root.chars:
            return "\n".join(_blocks(_article(nodes)))
    return ""


def _extract(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece, (pages,) in batches_of(rows, "html"):
        texts = [main_text(page) for page in pages]
        yield pa.record_batch(
            [piece.column(0), piece.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    columns = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    return mapped(columns, _extract, "page_id bigint, url string, text string, n_chars bigint")

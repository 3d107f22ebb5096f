"""Main text of web pages by tree scoring.

A page is parsed into a tree.  Elements that never hold the article (scripts,
menus, forms ...), or whose class, id or role says so, are set aside unless
they hold an ``article`` or ``main`` element.  A form that holds most of the
page's prose is a wrapper and stays; of a name of several words the last one
decides, but for words of layout, and the others count only for elements
without prose.  Each paragraph gives points for
its length and commas to its ancestors, less the farther up; an element's score
is discounted by the share of its text that is links.  The ``article`` (or else
``main``) that the best container lies in is kept whole but for parts set aside;
without one, the container itself, less lists of links.  Siblings that score
enough are kept as well, and headings and short paragraphs between or directly
before what is kept; the blocks are joined.

Work is per page: the pages are dealt by Spark and each is read whole by one
small parser pass, in time that grows with the page's length and not with the
depth of its elements.

Defined results: a null, empty or textless page has the text ''; unclosed and
misnested elements are closed where the next block begins; a comment without
an end is closed by the next ``>``, a tag cut off by the page's end is left out; repeated pages are
read alike; an empty table gives no rows; extra columns are ignored or, by
``add_main_text``, kept.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tarmac.llm.tables import table

# HTML element names by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ASIDE = frozenset(
    "aside button canvas dialog footer form head iframe input map menu nav noscript object script search select style svg template "
    "textarea title video audio".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th "
    "thead title tr ul".split()
)
#: An open element that the start of another one closes, up to the nearest of the third.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Words of a class or id of elements beside the article.
BESIDE = frozenset(
    "ad adbox ads adsense adslot adunit adv advert advertisement advertising adverts advt alert alerts announcement banner breadcrumb "
    "breadcrumbs colophon combx comment commentarea commentbox commentform commentlist comments consent cookie cookiebanner cookiebar "
    "cookies copyright disclaimer disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice noticebox "
    "notices notification outbrain overlay pagefooter pager pagination popup promo promobox promoted promotion recommended related "
    "relatedlinks relatedposts remark replies reply respond rss share sharebar sharing shoutbox sidebar sidenav signup sitefooter skip "
    "skyscraper social sponsor sponsored subnav subscribe subscription taboola teaser toast toolbar topbar topnav widget widgets".split()
)
#: Words of layout, passed over at the end of a name of several words.
LAYOUT = frozenset(
    "area bar block body bottom box button buttons col column container content element entry form frame group holder icons id "
    "inline inner item items left link links list main message node outer panel part post posts region right row section slot space "
    "text thread title top unit wrap wrapper zone".split()
)
#: Those of an article's own head as well; set aside outside of one only.
HEADS = frozenset("header pageheader siteheader".split())
BESIDE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
_NOT_A_PART = ("has", "with", "no", "without", "is")
_NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_TAG_START = re.compile(r"<[A-Za-z/!?]")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_SCORED = frozenset("p pre td blockquote li dd figcaption".split())
_START = {"article": 10.0, "main": 10.0, "div": 5.0, "section": 5.0, "blockquote": 3.0, "td": 3.0, "pre": 3.0, "ul": -3.0, "ol": -3.0}
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Characters from which the text of a block, few of them links, is prose.
PROSE = 25
#: Share of the best score from which a sibling is kept.
SIBLING_SHARE = 0.2


class Node:
    __slots__ = ("aside", "beside", "children", "commas", "depth", "head", "hinted", "holds_main", "length", "links", "parent", "prose", "score", "tag")

    def __init__(self, tag: str, parent: Node | None, aside: bool = False, head: bool = False, hinted: bool = False):
        self.tag, self.parent, self.aside, self.head, self.hinted = tag, parent, aside, head, hinted
        self.beside = False
        self.depth, self.prose = 0 if parent is None else parent.depth + 1, 0
        self.children: list[Node | str] = []
        self.holds_main, self.score = tag in ("article", "main"), _START.get(tag, 0.0)
        self.length = self.links = self.commas = 0


def _names(attrs: list[tuple[str, str | None]]) -> Iterator[list[str]]:
    """The words of each class and id, lower-cased."""
    for name, value in attrs:
        if name in ("class", "id"):
            for one in (value or "").split():
                found = [x.lower() for x in _NAME_WORDS.findall(one)]
                if found and found[0] not in _NOT_A_PART:
                    yield found


def _named(attrs: list[tuple[str, str | None]], words: frozenset[str]) -> bool:
    """Whether one of the words is in a class or id."""
    return any(not words.isdisjoint(found) for found in _names(attrs))


def _named_beside(attrs: list[tuple[str, str | None]]) -> bool:
    for found in _names(attrs):
        last = next((x for x in reversed(found) if x not in LAYOUT or x in BESIDE), "")
        if last in BESIDE:
            return True
    for name, value in attrs:
        value = value or ""
        if (name == "role" and value.lower() in BESIDE_ROLES) or name == "hidden":
            return True
        elif (name == "aria-hidden" and value == "true") or (name == "style" and _HIDDEN.search(value.lower())):
            return True
    return False


class _Tree(HTMLParser):
    """Builds the tree; the open elements are indexed by tag, so that no step walks up them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.here = self.root = Node("#root", None)
        self.nodes: list[Node] = [self.root]
        self.open: dict[str, list[Node]] = {}
        self.open_blocks: list[Node] = []
        self.no_comment_ends = False

    def read(self, html: str) -> None:
        """Read a whole page; a tag that the page's end cuts off is left out."""
        last = html.rfind(">") + 1
        cut = _TAG_START.search(html, last)
        self.feed(html[: cut.start()] if cut else html)
        self.close()

    def _skip(self, i: int) -> int:
        end = self.rawdata.find(">", i)
        return len(self.rawdata) if end < 0 else end + 1

    def parse_comment(self, i, report=1):
        """A comment that nothing closes ends at the next ``>``; that nothing does is looked up once."""
        end = -1 if self.no_comment_ends else super().parse_comment(i, report)
        self.no_comment_ends = end < 0
        return self._skip(i + 4) if end < 0 else end

    def parse_marked_section(self, i, report=1):
        """``<![`` begins a comment up to the next ``>``, whatever follows."""
        return self._skip(i + 3)

    def _deepest(self, tags: Iterable[str]) -> int:
        """Depth of the deepest open element of these tags, 0 if there is none."""
        return max((self.open[x][-1].depth for x in tags if self.open.get(x)), default=0)

    def _leave(self, node: Node) -> None:
        """Close ``node`` and all that is open in it."""
        while self.here is not node.parent:
            self.open[self.here.tag].pop()
            if self.here.tag in BLOCKS:
                self.open_blocks.pop()
            self.here = self.here.parent

    def _close(self, tags: set[str], stop: Iterable[str]) -> None:
        """Close the outermost open element of ``tags`` that no element of ``stop`` stands in."""
        if not any(self.open.get(x) for x in tags):
            return
        least, found = self._deepest(stop), None
        for tag in tags:
            held = self.open.get(tag, [])
            at = bisect_right(held, least, key=lambda x: x.depth)
            if at < len(held) and (found is None or held[at].depth < found.depth):
                found = held[at]
        if found is not None:
            self._leave(found)

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body") and self.open.get(tag):
            return
        if tag in BLOCKS and tag != "br":
            self._close({"p"}, ("td", "th", "table", "button", "object"))
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        if tag == "a":
            self._close({"a"}, BLOCKS - {"br"})
        named = tag not in ("html", "body", "main")
        beside = named and _named_beside(attrs)
        head = tag == "header" or (named and tag != "article" and _named(attrs, HEADS))
        node = Node(tag, self.here, tag in ASIDE or beside, head, named and not beside and _named(attrs, BESIDE))
        node.beside = beside
        if beside:
            node.holds_main = False
        self.here.children.append(node)
        self.nodes.append(node)
        if tag not in VOID:
            self.here = node
            self.open.setdefault(tag, []).append(node)
            if tag in BLOCKS:
                self.open_blocks.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "path", "script", "iframe"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in ("html", "body") or not self.open.get(tag):
            return
        node = self.open[tag][-1]
        # an inline end tag doesn't reach out of its block, nor a block's out of its cell
        if tag not in BLOCKS and self.open_blocks and self.open_blocks[-1].depth > node.depth:
            return
        if tag not in ("tr", "table", "tbody", "thead", "tfoot") and self._deepest(("td", "th")) > node.depth:
            return
        self._leave(node)

    def handle_data(self, data):
        self.here.children.append(data)


def _find_prose(nodes: list[Node]) -> None:
    """Prose (characters) in each element, without that of elements set aside, but for forms."""
    for node in reversed(nodes):
        if node.aside and node.tag != "form" and not node.holds_main:
            node.prose = 0
            continue
        run = links = 0
        for child in node.children:
            if isinstance(child, str):
                run += len(child.strip())
            else:
                node.prose += child.prose
                if child.tag not in BLOCKS and not child.aside:
                    run, links = run + child.length, links + child.links
        node.length, node.links = run, run if node.tag == "a" else links
        if run >= PROSE and links < 0.25 * run and (node.tag in BLOCKS or node.parent is None):
            node.prose += run
    for node in nodes:
        node.length = node.links = 0


def _settle_hints(nodes: list[Node]) -> None:
    """Forms that wrap the page's prose stay; elements with a hint in their name and no prose go."""
    most = nodes[0].prose / 2
    for node in nodes:
        if node.tag == "form" and node.prose > most and not node.beside:
            node.aside = False
        elif node.hinted and not node.prose and node.tag not in _SCORED and node.tag not in _HEADINGS:
            node.aside, node.holds_main = True, False


def _mark_aside(nodes: list[Node]) -> None:
    """Settle which elements are set aside; nodes come in page order."""
    for node in reversed(nodes):
        if node.holds_main and node.parent is not None:
            node.parent.holds_main = True
    inside: set[int] = set()  # of an article or main
    for node in nodes[1:]:
        up = node.parent
        if id(up) in inside or up.tag in ("article", "main"):
            inside.add(id(node))
        own = node.aside or (node.head and id(node) not in inside)
        node.aside = up.aside or (own and not node.holds_main)


def _measure(nodes: list[Node]) -> None:
    """Text length, link length, commas and scores, from the leaves up."""
    for node in reversed(nodes):
        if node.aside:
            continue
        inline_length = inline_commas = inline_links = 0
        for child in node.children:
            if isinstance(child, str):
                text = child.strip()
                length, commas = len(text), sum(map(text.count, ",،、，;"))
                links = length if node.tag == "a" else 0
                inline = True
            elif child.aside:
                continue
            else:
                length, commas, links = child.length, child.commas, child.links
                inline = child.tag not in BLOCKS
            node.length, node.commas, node.links = node.length + length, node.commas + commas, node.links + links
            if inline:
                inline_length, inline_commas, inline_links = inline_length + length, inline_commas + commas, inline_links + links
        if node.tag == "a":
            node.links = node.length
        if inline_length and (node.tag in _SCORED or node.tag in ("div", "section", "article", "main", "body", "center", "#root")):
            points = (1 + inline_commas + min(inline_length / 100, 3)) * (1 - inline_links / inline_length)
            to = node.parent if node.tag in _SCORED else node
            for share in (1.0, 0.5, 1 / 6, 1 / 9):
                if to is None:
                    break
                to.score += points * share
                to = to.parent


def _score(node: Node) -> float:
    return node.score * (1 - node.links / node.length) if node.length else 0.0


def _whole(best: Node) -> Node | None:
    """The outermost article around or at ``best``, or else the outermost main."""
    found = None
    at: Node | None = best
    while at is not None:
        if at.tag == "article" or (at.tag == "main" and (found is None or found.tag == "main")):
            found = at
        at = at.parent
    return found


def _kept(nodes: list[Node]) -> tuple[list[Node], Node | None]:
    """The best container and the siblings that belong to it, in page order, and the article that is kept whole."""
    usable = [x for x in nodes if not x.aside and x.length and (x.tag in BLOCKS or x.tag == "#root") and x.tag not in _SCORED]
    inner = [x for x in usable if x.tag not in ("html", "#root")]
    if not (inner or usable):
        return [], None
    best = max(inner or usable, key=_score)  # ties: the first
    if best.parent is None or best.tag in ("body", "html"):
        return [best], None
    least = SIBLING_SHARE * _score(best)
    whole = _whole(best)
    best = whole or best
    beside = [x for x in best.parent.children if not isinstance(x, str) and not x.aside and x.length]
    kept, short = [], []
    for child in beside:
        density = child.links / child.length
        paragraph = child.tag in _SCORED and density < 0.25 and (child.length > 80 or child.commas)
        kept.append(child is best or (child.tag in BLOCKS and _score(child) >= max(least, 5.0) and density < 0.5) or paragraph)
        short.append(child.tag in _HEADINGS or (child.tag in _SCORED and density < 0.25))
    first, last = kept.index(True), len(kept) - 1 - kept[::-1].index(True)
    while first and short[first - 1]:
        first -= 1
    return [x for i, x in enumerate(beside) if kept[i] or (short[i] and first <= i <= last)], whole


def _is_link_list(node: Node) -> bool:
    return node.tag in ("ul", "ol", "div", "section", "table") and node.length > 0 and node.links > 0.75 * node.length and sum(
        not isinstance(x, str) for x in node.children
    ) > 2


def _blocks(root: Node, whole: bool) -> Iterator[str]:
    """Text of each block in page order, white space collapsed; without lists of links unless it is kept whole."""
    parts: list[str] = []
    end = object()
    stack: list = [root]
    boundary = True
    while stack:
        at = stack.pop()
        if isinstance(at, str):
            parts.append(at)
            continue
        boundary = at is end or at.tag in BLOCKS
        if boundary and parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                yield text
        if at is end or at.aside or (not whole and _is_link_list(at)):
            continue
        if boundary:
            stack.append(end)
        stack.extend(reversed(at.children))
    text = " ".join("".join(parts).split())
    if text:
        yield text


def main_text(html: str | None) -> str:
    """The article of one page."""
    if not html:
        return ""
    tree = _Tree()
    tree.read(html)
    _find_prose(tree.nodes)
    _settle_hints(tree.nodes)
    _mark_aside(tree.nodes)
    _measure(tree.nodes)
    roots, whole = _kept(tree.nodes)
    return " ".join(text for root in roots for text in _blocks(root, root is whole))


def add_main_text(pages: DataFrame, html: str = "html", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``pages`` with the main text of its ``html`` column, and its code points, appended."""
    names, at = pages.columns, pages.columns.index(html)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                found = [main_text(x.as_py()) for x in part.column(at)]
                new = [pa.array(found, pa.string()), pa.array([len(x) for x in found], pa.int64())]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*names, text, n_chars])

    added = [StructField(text, StringType()), StructField(n_chars, LongType())]
    return pages.mapInArrow(run, StructType([*pages.schema.fields, *added]))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return add_main_text(pages).drop("html")

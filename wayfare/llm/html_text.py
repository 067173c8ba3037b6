"""Main text of web pages by scoring the element tree.

Every block of running text gives points for its length and its commas to the elements around it,
less with distance. What an element has gathered is discounted by the share of its text that lies
in links. The best element is the container of the article; siblings that look like its
continuation are kept as well. Menus, forms, adverts, notices and comments are taken out first,
by what the tags and their names say.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the HTML definition.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby rb rt rp s samp "
    "small span strike strong sub sup time tt u var wbr img".split()
)
# An opening tag ends these, up to the nearest element that may hold it.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
# A closing tag of these ends whatever is still open inside, an unknown one is ignored.
SCOPES = frozenset("table td th caption button".split())

# Never part of an article.
DROPPED = RAW | frozenset(
    "head nav aside form button select input label datalist dialog menu svg math canvas object embed "
    "template audio video map footer".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu".split())
# Words in class and id: the first always mean something else, the second unless a good one is there.
BAD = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion nav "
    "navbar navigation menu breadcrumb breadcrumbs sidebar comment comments commentlist disqus replies "
    "respond cookie cookies consent gdpr newsletter subscribe subscription signup share sharing social "
    "related recommended recommendations pagination pager footer masthead popup modal teaser".split()
)
DOUBTFUL = frozenset(
    "header banner notice notices notification alert warning disclaimer side widget widgets toolbar "
    "search login overlay hidden tags meta byline copyright legal skip".split()
)
GOOD = frozenset("article articlebody body content entry main page post story text".split())

PRIOR = {"article": 25, "main": 20, "section": 5, "div": 5, "pre": 3, "td": 3, "blockquote": 3}
PRIOR |= dict.fromkeys(("ul", "ol", "dl", "dd", "dt", "li", "address"), -3)
PRIOR |= dict.fromkeys(("h1", "h2", "h3", "h4", "h5", "h6", "th"), -5)
MENU_LINKS = 4  # so many links make a menu, where little else is said
MIN_BLOCK = 25  # characters of a block that gives points

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)",
    re.S,
)
_NAMES = re.compile(
    r"""\b(class|id|role|hidden|aria-hidden|style|itemprop)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""",
    re.I,
)
_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")


class Element:
    __slots__ = (
        "tag", "attrs", "parent", "parts", "words", "role", "unseen", "own", "size", "linked", "links",
        "commas", "score", "gone",
    )

    def __init__(self, tag: str, attrs: str, parent: Element | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.parts: list[Element | str] = []
        self.words: frozenset[str] = frozenset()
        self.role, self.unseen = "", False
        self.own = self.size = self.linked = self.links = self.commas = 0
        self.score, self.gone = 0.0, False
        if attrs and not attrs.isspace():
            words: set[str] = set()
            for name, *values in _NAMES.findall(attrs):
                name, value = name.lower(), "".join(values)
                if name in ("class", "id", "itemprop"):
                    words.update(w.lower() for w in _WORDS.findall(value))
                    words.update(re.split(r"[^a-z]+", value.lower()))
                elif name == "role":
                    self.role = value.lower()
                elif name == "hidden":
                    self.unseen = True
                elif name == "aria-hidden":
                    self.unseen |= value.lower() == "true"
                elif name == "style":
                    self.unseen |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value))
            self.words = frozenset(words)


def parse(page: str) -> tuple[Element, list[Element]]:
    """Root and all elements, parents before their children. Never fails, whatever the page."""
    root = Element("#root", "", None)
    elements, top = [root], root
    at = 0
    while True:
        found = _TOKEN.search(page, at)
        text = page[at : found.start()] if found else page[at:]
        if text:
            top.parts.append(text)
        if not found:
            return root, elements
        at = found.end()
        name = found.group(2)
        if not name:
            continue
        name = name.lower()
        if found.group(1):
            node = top
            while node.parent and node.tag != name and not (node.tag in SCOPES and name in INLINE):
                node = node.parent
            if node.tag == name:
                top = node.parent
            continue
        if name not in INLINE and name not in VOID:  # a block ends an open paragraph
            node = top
            while node.parent and (node.tag in INLINE or node.tag == "p"):
                if node.tag == "p":
                    top = node.parent
                node = node.parent
        if name in ENDS:
            ended, holders = ENDS[name]
            node = top
            while node.parent and node.tag not in holders:
                if node.tag in ended:
                    top = node.parent
                node = node.parent
        attrs = found.group(3)
        element = Element(name, attrs, top)
        top.parts.append(element)
        elements.append(element)
        if name in RAW:
            end = re.compile(f"</{name}", re.I).search(page, at)
            at = end.start() if end else len(page)
        elif name not in VOID and not attrs.endswith("/"):
            top = element


def _unwanted(element: Element, holds_article: bool) -> bool:
    if element.tag in ("#root", "html", "body", "article", "main"):
        return element.unseen and not holds_article
    if element.tag in DROPPED or element.unseen:
        return not holds_article or element.tag in RAW
    if holds_article:
        return False
    if element.role in ROLES or element.words & BAD:
        return True
    if element.tag == "header":
        node = element.parent
        while node and node.tag not in ("article", "main"):
            node = node.parent
        return node is None
    return bool(element.words & DOUBTFUL) and not element.words & GOOD


def main_text(page: str | None) -> str:
    """Text of the article: references decoded, white space in a block as one blank, blocks joined by one.

    A page without any text gives an empty one.
    """
    if not page:
        return ""
    root, elements = parse(page)
    holders: set[int] = set()
    for element in elements:
        if element.tag in ("article", "main") and not element.words & BAD:
            node = element
            while node and id(node) not in holders:
                holders.add(id(node))
                node = node.parent
    block_of: dict[int, Element] = {}
    for element in elements:  # parents come first
        parent = element.parent
        element.gone = bool(parent and parent.gone) or _unwanted(element, id(element) in holders)
        inline = element.tag in INLINE and parent is not None
        block_of[id(element)] = block = block_of[id(parent)] if inline else element
        if element.gone:
            continue
        for part in element.parts:
            if isinstance(part, str):
                size = len(part.strip())
                element.size += size
                element.commas += part.count(",")
                block.own += size
    for element in reversed(elements):
        if element.tag == "a":
            element.linked, element.links = element.size, 1
        if element.parent and not element.gone:
            element.parent.size += element.size
            element.parent.linked += element.linked
            element.parent.links += element.links
            element.parent.commas += element.commas
    candidates: dict[int, Element] = {}

    def candidate(element: Element) -> None:
        if id(element) not in candidates:
            candidates[id(element)] = element
            element.score += PRIOR.get(element.tag, 0)
            element.score += 25 * bool(element.words & GOOD) - 25 * bool(element.words & (BAD | DOUBTFUL))

    for element in elements:
        if element.gone:
            continue
        if element.tag in ("article", "main"):
            candidate(element)
        if block_of[id(element)] is element and element.own >= MIN_BLOCK:
            points = 1 + element.commas + min(element.size / 100, 3)
            # Text right in a container speaks for the container itself.
            node = element if element.tag in ("div", "section", "article", "main", "body") else element.parent
            distance = 0
            while node and distance < 5:
                candidate(node)
                node.score += points / (1, 2, 6, 9, 12)[distance]
                node, distance = node.parent, distance + 1
    for element in candidates.values():
        if element.size:
            element.score *= 1 - element.linked / element.size
    alive = [e for e in candidates.values() if not e.gone and e.size]
    if not alive:
        return _text([e for e in elements if e.tag == "body" and not e.gone][:1] or [root])
    best = max(alive, key=lambda e: e.score)
    node, marked = best, False
    while node:  # the article that it lies in is the whole of it
        marked |= node.tag in ("article", "main")
        if node.tag == "article":
            best = node
        node = node.parent
    if not marked:  # nothing says where the article ends: lists of links are menus
        for element in elements:
            menu = element.tag in ("ul", "ol", "div", "section", "table", "p") and element.links >= MENU_LINKS
            element.gone |= menu and element.linked > 0.8 * element.size
    return _text(_with_siblings(best))


def _with_siblings(best: Element) -> list[Element]:
    if best.parent is None:
        return [best]
    least = max(10.0, 0.2 * best.score)
    kept = []
    for part in best.parent.parts:
        if part is best:
            kept.append(part)
        elif isinstance(part, Element) and not part.gone:
            links = part.linked / part.size if part.size else 1.0
            title = part.tag in ("h1", "h2") and best not in kept and links < 0.5
            if title or part.score >= least or (part.tag == "p" and part.size > 80 and links < 0.25):
                kept.append(part)
    return kept


def _text(elements: list[Element]) -> str:
    pieces: list[str] = []
    todo: list[Element | str] = list(reversed(elements))
    while todo:
        part = todo.pop()
        if isinstance(part, str):
            pieces.append(part)
        elif not part.gone:
            if part.tag not in INLINE:  # a block, or a line break
                pieces.append(" ")
                todo.append(" ")
            todo.extend(reversed([html.unescape(p) if isinstance(p, str) else p for p in part.parts]))
    return " ".join("".join(pieces).split())


def extract(pages: DataFrame, page: str = "html", columns: list[str] | None = None) -> DataFrame:
    """``row`` with the given columns (all by default) and ``text``, the main text of the whole page.

    Null or empty pages give an empty text, and so do pages without an article or other text.
    Repeated rows give repeated rows, an empty table none; other columns pass through in ``row``.
    """
    rows = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in columns or pages.columns]).alias("row"),
        F.col(page).alias("page"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [main_text(p) for p in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(texts, pa.string())], ["row", "text"]
                )

    return rows.mapInArrow(run, rows.select("row").schema.add("text", T.StringType()))

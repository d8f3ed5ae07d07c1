"""Main text of web pages by a minimum cut over their text blocks.

A page becomes blocks of text, each with the element that holds it.  A
linear classifier scores a block for content against boilerplate; the score is its
capacity to one of two terminals.  Neighbouring blocks and blocks in one element are
joined by smoothness edges.  The minimum cut separates content from boilerplate with the
least sum of classifier cost and cut edges.  Each page is worked on by itself.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULTS = ("text", "n_chars", "n_blocks", "n_content_blocks")

#: Elements whose content is no text of the page.
DROPPED = "script|style|noscript|template|svg|math|iframe|object|textarea|select|button|head|title|canvas|audio|video"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({DROPPED})(?=[\s/>])[^>]*+>.*?(?:</\1\s*>|\Z)"
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*+)(?:>|\Z)"""
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)",
    re.S | re.I)
ATTRIBUTE = re.compile(r"""([a-zA-Z:-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code del dfn em font i img input ins kbd label mark nobr q s samp small span "
    "strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base col embed hr link meta param source track".split())
#: Elements that end an open paragraph, and those that end their own kind.
ENDS_OWN = frozenset("li dt dd tr td th option p".split())

#: Scores of the classifier: positive for content.
OUTSIDE = frozenset("nav footer aside form menu dialog".split())
NOTICE_WORDS = frozenset(
    "ad ads advert adverts advertisement adsense advertorial sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login "
    "sidebar widget related recommended share sharing social follow menu nav navbar navigation breadcrumb breadcrumbs "
    "masthead footer copyright comment comments reply replies respond disqus discussion pagination pager toolbar search "
    "disclaimer skip form".split())
MAIN_WORDS = frozenset("article content entry post story main body maincontent articlebody".split())
BIAS, LONG, SHORT, LINKS, HEADING, PARAGRAPH, ITEM = 0.2, 1.2, -0.6, -3.0, 0.4, 0.5, -0.3
IN_MAIN, BESIDE_MAIN, MAIN_NAME, IN_OUTSIDE, PAGE_HEADER = 4.0, -3.0, 1.5, -9.0, -6.0
#: Smoothness: blocks that follow each other in one element, in neighbouring ones, elsewhere; block and element; nested elements.
SAME, NEAR, FAR, HELD, NESTED = 0.8, 0.4, 0.1, 0.3, 0.2


@dataclass
class Element:
    tag: str
    parent: int
    main: bool = False
    outside: bool = False
    header: bool = False
    named_main: bool = False


@dataclass
class Block:
    element: int
    text: str
    link_chars: int


@dataclass
class Page:
    elements: list[Element] = field(default_factory=lambda: [Element("page", 0)])
    blocks: list[Block] = field(default_factory=list)
    has_main: bool = False


def parse(source: str) -> Page:
    """Blocks of a page in order; white space is folded and character references are decoded."""
    page = Page()
    stack = [0]
    parts: list[str] = []
    linked = 0
    in_link = False

    def end_block() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            page.blocks.append(Block(stack[-1], text, linked))
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        parts.append(text)
        if in_link:
            linked += len(text.strip())

    place = 0
    for found in TOKEN.finditer(source):
        if found.start() > place:
            add(source[place:found.start()])
        place = found.end()
        tag = (found[3] or found[6] or "").lower()
        if not tag:
            continue
        closing = bool(found[2] or found[5])
        if tag in INLINE:
            if tag == "a":
                in_link = not closing
            elif tag in ("br", "img", "input"):
                parts.append(" ")
            continue
        end_block()
        if tag in VOID:
            continue
        if closing:
            in_link = False
            for depth in range(len(stack) - 1, 0, -1):
                if page.elements[stack[depth]].tag == tag:
                    del stack[depth:]
                    break
            continue
        top = page.elements[stack[-1]].tag
        if top == "p" or top == tag and tag in ENDS_OWN:
            stack.pop()
        if found[0].endswith("/>") and tag not in ("p", "div", "li"):
            continue
        page.elements.append(_element(tag, found[4] or found[7] or "", stack[-1], page))
        stack.append(len(page.elements) - 1)
    add(source[place:])
    end_block()
    return page


def _element(tag: str, attributes: str, parent: int, page: Page) -> Element:
    above = page.elements[parent]
    made = Element(tag, parent, above.main, above.outside, above.header, above.named_main)
    names: set[str] = set()
    role = ""
    for name, *values in ATTRIBUTE.findall(attributes):
        value = next((v for v in values if v), "")
        if name.lower() in ("class", "id"):
            names.update(part.lower() for part in NAME_PART.findall(value))
        elif name.lower() == "role":
            role = value.lower()
    if tag in ("article", "main") or role in ("main", "article"):
        made.main = page.has_main = True
    if tag in OUTSIDE or role in ("navigation", "contentinfo", "complementary", "search", "dialog", "alert"):
        made.outside = True
    if tag not in ("body", "html", "article", "main"):
        made.outside |= not NOTICE_WORDS.isdisjoint(names)
        made.named_main |= not MAIN_WORDS.isdisjoint(names)
    if not above.main and (tag == "header" or role == "banner" or "header" in names):
        made.header = True
    return made


def score(block: Block, page: Page) -> float:
    """The classifier: above 0 for content."""
    element = page.elements[block.element]
    n = block.text.count(" ") + 1
    total = BIAS + (LONG if n >= 15 else SHORT if n < 5 else 0.0)
    total += LINKS * min(1.0, block.link_chars / max(1, len(block.text)))
    total += HEADING if element.tag in ("h1", "h2", "h3") else PARAGRAPH if element.tag == "p" else 0.0
    total += ITEM if element.tag in ("li", "td", "th") else 0.0
    if element.main:
        total += IN_MAIN
    elif page.has_main:
        total += BESIDE_MAIN
    elif element.named_main:
        total += MAIN_NAME
    return total + IN_OUTSIDE * element.outside + PAGE_HEADER * element.header


def edges(page: Page) -> list[tuple[int, int, float]]:
    """Smoothness edges; nodes are the blocks, then the elements."""
    n = len(page.blocks)
    out = []
    used: set[int] = set()
    for i, block in enumerate(page.blocks):
        holder = page.elements[block.element].parent if block.element else 0
        out.append((i, n + holder, HELD))
        used.add(holder)
        if i:
            before = page.blocks[i - 1]
            other = page.elements[before.element].parent if before.element else 0
            near = page.elements[holder].parent == page.elements[other].parent
            out.append((i - 1, i, SAME if holder == other else NEAR if near else FAR))
    for e in used:
        if page.elements[e].parent != e:
            out.append((n + e, n + page.elements[e].parent, NESTED))
    return out


def minimum_cut(scores: list[float], joined: list[tuple[int, int, float]]) -> list[bool]:
    """Which side of the minimum cut each node is on; True is content.

    A node whose score outweighs all its edges is settled at once, and its edges
    become scores of its neighbours; what is left goes through augmenting paths in a level graph.
    """
    scores = list(scores)
    around: list[dict[int, float]] = [{} for _ in scores]
    for a, b, w in joined:
        if a != b:
            around[a][b] = around[a].get(b, 0.0) + w
            around[b][a] = around[b].get(a, 0.0) + w
    side: list[bool | None] = [None] * len(scores)
    queue = deque(range(len(scores)))
    while queue:
        v = queue.popleft()
        if side[v] is not None or abs(scores[v]) < sum(around[v].values()) or not scores[v] and around[v]:
            continue
        side[v] = scores[v] > 0
        for u, w in around[v].items():
            scores[u] += w if side[v] else -w
            del around[u][v]
            queue.append(u)
        around[v] = {}
    rest = [v for v, s in enumerate(side) if s is None]
    if rest:
        for v, s in zip(rest, _max_flow(rest, scores, around)):
            side[v] = s
    return side  # type: ignore[return-value]


def _max_flow(rest: list[int], scores: list[float], around: list[dict[int, float]]) -> list[bool]:
    place = {v: k for k, v in enumerate(rest)}
    source, sink = len(rest), len(rest) + 1
    room: list[dict[int, float]] = [{} for _ in range(len(rest) + 2)]
    for v, k in place.items():
        for u, w in around[v].items():
            room[k][place[u]] = w
        a, b = (source, k) if scores[v] > 0 else (k, sink)
        room[a][b], room[b][a] = abs(scores[v]), 0.0
    tiny = 1e-9
    while True:
        level = {source: 0}
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for b, w in room[a].items():
                if w > tiny and b not in level:
                    level[b] = level[a] + 1
                    queue.append(b)
        if sink not in level:
            return [k in level for k in range(len(rest))]
        ways = [iter(list(room[a])) for a in range(len(room))]
        path = [source]
        while path:
            a = path[-1]
            if a == sink:
                flow = min(room[x][y] for x, y in zip(path, path[1:]))
                cut = None
                for i, (x, y) in enumerate(zip(path, path[1:])):
                    room[x][y] -= flow
                    room[y][x] = room[y].get(x, 0.0) + flow
                    if cut is None and room[x][y] <= tiny:
                        cut = i
                for x in path[cut:]:  # the edge into a node may have room left; look at all its edges again
                    if x not in (source, sink):
                        ways[x] = iter([b for b in room[x] if room[x][b] > tiny])
                path = path[:cut + 1]
                continue
            for b in ways[a]:
                if room[a][b] > tiny and level.get(b) == level[a] + 1:
                    path.append(b)
                    break
            else:
                level.pop(a, None)
                path.pop()


def main_blocks(source: str) -> tuple[list[str], int]:
    """The blocks of a page's main text, and how many blocks the page has."""
    page = parse(source)
    if not page.blocks:
        return [], 0
    scores = [score(b, page) for b in page.blocks] + [0.0] * len(page.elements)
    sides = minimum_cut(scores, edges(page))
    return [b.text for b, content in zip(page.blocks, sides) if content], len(page.blocks)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Every row with ``text``, ``n_chars``, ``n_blocks`` and ``n_content_blocks``; the html column is dropped.

    A null page, an empty one and one of boilerplate alone have the text ``''``.
    Markup that is cut off or not closed counts up to the end of the page.  Repeated rows stay; columns named like a result are
    replaced.  An empty table gives an empty result.
    """
    columns = [c for c in pages.columns if c.lower() not in RESULTS and c != html_col]
    schema = T.StructType([pages.schema[c] for c in columns] + [
        T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()),
        T.StructField("n_blocks", T.LongType()), T.StructField("n_content_blocks", T.LongType())])
    source = pages.select(*(F.col(f"`{c}`") for c in columns), F.col(f"`{html_col}`"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                rows = batch.slice(first, 256)
                found = [main_blocks(value.as_py() or "") for value in rows.column(len(columns))]
                texts = ["\n".join(blocks) for blocks, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(k) for k in range(len(columns))] + [
                        pa.array(texts, type=pa.string()), pa.array([len(t) for t in texts], type=pa.int64()),
                        pa.array([n for _, n in found], type=pa.int64()),
                        pa.array([len(blocks) for blocks, _ in found], type=pa.int64())],
                    names=schema.names)

    return source.mapInArrow(run, schema)

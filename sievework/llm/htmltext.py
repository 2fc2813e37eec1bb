"""Main-text extraction from HTML by tree scoring.

The page is read into a tree with the usual repairs (implied ends of p, li, table parts and
options; raw text of script and style; unclosed inline elements end with their block; quotes
count only around an attribute's value). Elements that are never article text (scripts, menus,
...; or by their role or a class or id of such a name) are cut. A form, and an element of a
compound name of which one word could also be a topic ("share-price-report"), is cut only if it
does not hold most of the page's prose.

Each paragraph passes points for its length and its commas to its parent, half as many to the
grandparent and a third to the next; a container's points are discounted by its link density.
The best container is kept, with those of its siblings that score near it or are paragraphs of
prose; a semantic container (article, main) counts as a bonus, not as a rule.

The text: character references decoded, white space inside a block made one space, trimmed,
blocks joined in page order by a line feed.

Defined results: null and empty pages give an empty text; text without any element is one
block; a page whose every candidate is cut gives an empty text; unclosed, misnested and very
deeply nested tags never fail (nothing recurses, and no tag walks the open elements); equal pages
give equal texts; repeated rows are rows like others; an empty table gives no rows; other columns
are ignored. Whole pages are read.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import utf8
from .tables import small_batches

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCKS - frozenset("html body caption tbody td tfoot th thead tr".split())
IMPLIED = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu", "dir"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "tbody": (frozenset({"thead", "tbody", "tfoot", "tr", "td", "th"}), frozenset({"table"})),
    "thead": (frozenset({"tbody", "tfoot", "tr", "td", "th"}), frozenset({"table"})),
    "tfoot": (frozenset({"thead", "tbody", "tr", "td", "th"}), frozenset({"table"})),
    "option": (frozenset({"option"}), frozenset({"select"})),
}

#: Elements that are never article text.
CUT = frozenset("script style noscript iframe template svg math canvas object embed audio video nav aside footer button input select textarea option fieldset label dialog menu head title noembed noframes search map".split())
CUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form tablist toolbar".split())
#: Words that name a part beside the article, in a class or id of one word or of several.
BESIDE = frozenset(
    "ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promoted nav navbar navigation menu menus breadcrumb breadcrumbs sidebar "
    "footer foot masthead topbar cookie cookies consent gdpr popup newsletter subscribe signup comment comments reply replies disqus respond outbrain taboola pagination pager copyright widget widgets".split()
)
#: Words that do so where they stand alone; in a compound name they may be a topic.
ALONE = frozenset(
    "ad banner promotion aside rail header notice notices modal overlay subscription login share sharing social discussion related recommended recommendations "
    "trending skip legal disclaimer toolbar tags alert announcement toc search lightbox feedback survey poll".split()
)
#: Words beside which a name only says what a page has ("with-sidebar", "comments-open").
_STATES = frozenset("has with no without enabled disabled open closed".split())
#: Names of the article's own parts or its container ("entry-header", "article-tags").
_OWN = frozenset("header head tags legal rail aside toc notice".split())
_ARTICLE = frozenset("article content entry main post story".split())
_GOOD = frozenset("article body content entry main page post story text blog prose".split())
# A quote opens a value only after "="; elsewhere it is a character like others.
_REST = r"((?:[\s/]++|(?:=[^\s/>=]*+|[^\s/>=]++)(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+)?+)?+)*+)(?:>|\Z)"
_TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(?:[!?]|/[^A-Za-z])[^>]*+(?:>|\Z)|</>|<(/?)([A-Za-z][^\s/>]*+)" + _REST, re.S)
_ATTRIBUTE = re.compile(r"(=[^\s/>=]*|[^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_SPACE = re.compile(r"\s+")
_CLOSERS = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for tag in RAW}
#: Characters of a block that make it prose where it is no sentence.
PROSE = 80


class Node:
    """An element: ``cut`` 0 stays, 1 goes, 2 goes unless it holds most of the prose; ``first`` and ``last`` bound its events."""

    __slots__ = ("tag", "up", "cut", "bonus", "kids", "block", "first", "last", "own", "links", "chars", "linked", "prose", "points")

    def __init__(self, tag: str, up: Node | None, cut: int, bonus: float, first: int) -> None:
        self.tag, self.up, self.cut, self.bonus, self.first, self.last = tag, up, cut, bonus, first, first
        self.kids: list[Node] = []
        self.block: Node = self if up is None or tag in BLOCKS else up.block
        self.own: list[str] = []
        self.links = self.chars = self.linked = self.prose = 0
        self.points: float | None = None


def _beside(name: str, parts: list[str]) -> int:
    """Whether a class or id names a part beside the article: 0 no, 1 yes, 2 perhaps."""
    words = set(parts)
    if len(parts) == 1:
        return int(parts[0] in BESIDE or parts[0] in ALONE)
    if words & _STATES or words & _ARTICLE and words & (BESIDE | ALONE) <= _OWN:
        return 0
    return 1 if words & BESIDE else 2 if words & ALONE else 0


def _marks(tag: str, attributes: str) -> tuple[int, float]:
    """What becomes of the element, and its bonus as a container."""
    cut, bonus = int(tag in CUT), {"article": 30.0, "main": 20.0}.get(tag, 0.0)
    if tag == "form":
        cut = 2
    if not attributes or attributes.isspace():
        return cut, bonus
    names, words = [], set()
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name in ("class", "id"):
            for token in value.split():
                parts = [p.lower() for p in _PARTS.findall(token)]
                words.update(parts)
                names.append((token, parts))
        elif name == "role":
            role = value.strip().lower()
            cut = 1 if role in CUT_ROLES and tag != "form" else cut
            bonus += 20 * (role in ("main", "article"))
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and "display:none" in value.replace(" ", "").lower():
            cut = 1
    if names and tag not in ("body", "html", "article", "main"):
        found = {_beside(token, parts) for token, parts in names if parts}
        # Of several names that of the article's container outweighs one of its own parts ("content toc").
        if 1 in found and not (words & _ARTICLE and words & (BESIDE | ALONE) <= _OWN):
            cut = 1
        elif 2 in found and not cut:
            cut = 2
    if not cut and words & _GOOD:
        bonus += 15
    return cut, bonus


def parse(page: str) -> tuple[list[Node], list[tuple[Node, str | None]]]:
    """Elements in page order (a root first), and events: text with the element it stands in, None at the edges of blocks."""
    root = Node("#root", None, 0, 0.0, 0)
    nodes, events = [root], []
    stack, open_, blocks_at = [root], {}, [0]
    lost = 0  # the place in the stack of the first element that is cut for certain
    at, n = 0, len(page)

    def pop_to(k: int) -> None:
        nonlocal lost
        for i in range(len(stack) - 1, k - 1, -1):
            node = stack.pop()
            open_[node.tag].pop()
            if blocks_at[-1] == i:
                blocks_at.pop()
                events.append((node, None))
            node.last = len(events)
        if lost >= len(stack):
            lost = 0

    def text(value: str) -> None:
        if not lost and value:
            events.append((stack[-1], value))

    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        end, tag, attributes = m.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if end:
            places = open_.get(tag)
            # An inline end tag does not reach over a block; a block's end ends what is open in it.
            if places and (tag in BLOCKS or places[-1] > blocks_at[-1]):
                pop_to(places[-1])
            continue
        if tag in CLOSES_P and stack[blocks_at[-1]].tag == "p":
            pop_to(blocks_at[-1])
        if tag in IMPLIED:
            ends, within = IMPLIED[tag]
            edge = max((open_[t][-1] for t in within if open_.get(t)), default=0)
            over = [p[k] for t in ends if (p := open_.get(t)) and (k := bisect_right(p, edge)) < len(p)]
            if over:
                pop_to(min(over))
        if tag == "br":
            text(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                events.append((stack[-1], None))
            continue
        cut, bonus = _marks(tag, attributes)
        # A page's header goes; an article's own holds its headline.
        if tag == "header" and not (open_.get("article") or open_.get("main")):
            cut = 1
        if tag in BLOCKS:
            events.append((stack[-1], None))
        node = Node(tag, stack[-1], cut, bonus, len(events))
        stack[-1].kids.append(node)
        nodes.append(node)
        if tag in RAW:
            stop = _CLOSERS[tag].search(page, at)
            if cut != 1 and not lost:
                events.append((node, page[at : stop.start() if stop else n]))
            node.last = len(events)
            at = stop.end() if stop else n
        elif not (attributes.endswith("/") and (tag in ("svg", "math") or open_.get("svg") or open_.get("math"))):
            if cut == 1 and not lost:
                lost = len(stack)
            open_.setdefault(tag, []).append(len(stack))
            if tag in BLOCKS:
                blocks_at.append(len(stack))
            stack.append(node)
    pop_to(1)
    root.last = len(events)
    return nodes, events


def _clean(text: str) -> str:
    return _SPACE.sub(" ", html.unescape(text)).strip()


def _blocks(events: list[tuple[Node, str | None]], spans: list[tuple[int, int]]) -> list[str]:
    """The text blocks of some stretches of the page."""
    out, now = [], []
    for first, last in spans:
        for node, value in [*events[first:last], (None, None)]:
            if value is None:
                if now and (plain := _clean("".join(now))):
                    out.append(plain)
                now = []
            elif not node.cut:
                now.append(value)
    return out


def _measure(nodes: list[Node], events: list[tuple[Node, str | None]]) -> None:
    """Characters, characters in links, and prose of every element; then what is cut, for certain or for want of prose."""
    linked = {}
    for node in nodes:
        linked[node] = node.tag == "a" or node.up is not None and linked[node.up]
    for node, value in events:
        if value is not None:
            size = len(value.strip())
            node.chars += size
            node.block.own.append(value)
            if linked[node]:
                node.linked += size
                node.block.links += size
    for node in reversed(nodes):
        if node.own:
            size = len(plain := "".join(node.own).strip())
            if node.links <= size / 2 and (size >= PROSE or size >= 25 and plain.endswith((".", "!", "?"))):
                node.prose += size
        if node.up is not None and node.cut != 1:
            node.up.prose += node.prose
    for node in nodes:
        if node.up is not None and node.up.cut or node.cut == 2 and node.prose * 2 <= nodes[0].prose:
            node.cut = 1
        elif node.cut == 2:
            node.cut = 0
    for node in reversed(nodes):
        if node.up is not None and not node.cut:
            node.up.chars += node.chars
            node.up.linked += node.linked


_LEAVES = frozenset("p pre blockquote li dd td h1 h2 h3 h4 h5 h6".split())


def _score(nodes: list[Node], events: list[tuple[Node, str | None]]) -> dict[Node, float]:
    """Points of every container, discounted by its link density."""
    for node in nodes:
        node.own = []
    for node, value in events:
        if value is not None and not node.cut:
            node.block.own.append(value)
    points: dict[Node, float] = {}
    # From the last to the first, so that of equal containers the inner one comes first.
    for node in reversed(nodes):
        if node.cut or not node.own:
            continue
        text = "".join(node.own)
        if len(text) < 25 or len(plain := _clean(text)) < 25:
            continue
        # Bare text in a container is a paragraph of that container.
        value = 1 + plain.count(",") + plain.count("、") + plain.count("，") + min(len(plain) / 100, 3)
        target = node.up if node.tag in _LEAVES and node.up is not None else node
        for share in (1, 2, 3):
            if target is None:
                break
            points[target] = points.get(target, 0.0) + value / share
            target = target.up
    return {n: (p + n.bonus) * (1 - n.linked / max(1, n.chars)) for n, p in points.items()}


def extract(page: str) -> str:
    """The page's main text; empty if it has none."""
    nodes, events = parse(page)
    _measure(nodes, events)
    scored = _score(nodes, events)
    if not scored:
        return "\n".join(_blocks(events, [(0, len(events))]))
    best = max(scored, key=scored.__getitem__)
    # Climb while the parent holds clearly more article text in containers of the same kind.
    while best.up is not None and best.up.up is not None and best.up in scored and scored[best.up] >= 0.75 * scored[best] and best.tag not in ("article", "main", "body"):
        best = best.up
    if best.up is None or best.tag in ("body", "html"):
        return "\n".join(_blocks(events, [(best.first, best.last)]))
    spans, least = [], max(10.0, scored[best] * 0.2)
    for kid in best.up.kids:
        if kid is best or not kid.cut and scored.get(kid, 0.0) >= least:
            spans.append((kid.first, kid.last))
        elif not kid.cut and kid.tag == "p" and best.tag not in ("article", "main"):
            text = " ".join(_blocks(events, [(kid.first, kid.last)]))
            if len(text) > PROSE or text.endswith((".", "!", "?")):
                spans.append((kid.first, kid.last))
    return "\n".join(_blocks(events, spans))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    small_batches(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    schema = rows.select("page_id", "url").schema.add("text", "string").add("n_chars", T.LongType())

    def run(batches):
        for batch in batches:
            data, at = utf8(batch.column(2))
            raw = data.tobytes()
            texts = [extract(raw[at[i] : at[i + 1]].decode("utf-8", "replace")) for i in range(len(at) - 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema.names)

    return rows.mapInArrow(run, schema)

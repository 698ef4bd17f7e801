"""HTML extraction (operator 10): flat text blocks, described by their own and their neighbours' word count and link density
and by the markup around them, classified by a decision tree trained on a small labelled table.

A page is cut at block-level tags into blocks of text.  References are decoded, white space becomes one space, and each block
gets numbers: words and link density of itself, the block before and the block after; whether it is a heading; and what the markup
around it says: whether it lies in an article or main element, or in page furniture (by element, by the layout name of a container,
by a name for other people's text, by a name of its own), and whether most of the page's text lies in main content so marked.  Names
count as whole classes: one that has other words beside a name for other people's text says nothing.  Names are
features like the others: the tree that decides is grown from labelled_table() by Gini impurity.  What wraps an article or main
element - a form, a container with a layout name - says nothing about it; only a name for other people's text does.

Defined results.  Tags that html lets out: text or an element of the body ends an open head, and one that drawings and formulas cannot
hold ends an open svg or math.  Null or empty html: empty text, 0 characters.  No tags: the whole text is one block.  Unclosed, crossed and stray
tags: a closing tag closes its nearest open element and what is open inside it; one that closes nothing is ignored; the end of the page closes all.
Repeated rows are extracted each.  Empty table: no rows.  Further columns are ignored.  Nothing is capped or dropped by length.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import with_small_batches

#: Elements whose content is no text; block-level elements; elements without an end tag.
NO_TEXT = frozenset("script style noscript template svg math iframe object canvas audio video head select datalist textarea title".split())
BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that a new one of the same kind closes, with the containers that keep it open, and those that close a paragraph.
CLOSES_ITSELF = {"li": ("ul", "ol", "menu"), "p": (), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
#: Elements that a head may hold; furniture also around main content, and only elsewhere.
HEAD = frozenset("title meta link base script style noscript template".split())
FURNITURE = frozenset("nav footer aside button search dialog".split())
WRAPPING_FURNITURE = frozenset("header form menu fieldset".split())
#: Elements that hold one piece of text; their names say less than those of containers.
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li td th dt dd blockquote pre span b i em strong a caption figcaption".split())
#: Names (class, id, role) of page layout, of text that is not the page's own, and of main content.
LAYOUT_NAME = re.compile(
    r"(?:^|[\s_-])(?:banner\w*|popup|nav\w*|menu\w*|breadcrumb\w*|pagination|pager|sidebar\w*|side|aside|header|masthead|topbar|footer|foot|form|search\w*|login|register|widget\w*|complementary)(?:$|[\s_-])"
)
#: Names of text that is not the page's own; names that are also headings of an article's own parts; and words that only say
#: what kind of box something is.
FOREIGN_WORD = re.compile(r"ad|ads|adv|advert\w*|adsense|promo\w*|sponsor\w*|cookie\w*|gdpr|modal|overlay|newsletter|subscri\w*|signup|related|recommend\w*|share\w*|sharing|social|copyright|comment\w*|reply|replies|disqus|contentinfo")
DOUBTFUL_WORD = re.compile(r"discussion|legal|notices?|alerts?|consent|follow|respond")
BOX_WORD = re.compile(
    r"\d*|a|the|of|to|for|on|by|in|us|me|our|your|and|with|no|area|bar|banner|block|body|bottom|box|boxes|btn|button|buttons|card|cards|center|col|column|container|content|count|feed|footer|form|grid|group|header|holder|"
    r"icon|icons|inline|inner|item|items|label|left|link|links|list|main|media|menu|message|meta|module|more|nav|network|networks|outer|page|pages|panel|popup|post|posts|products?|right|row|section|side|sidebar|"
    r"site|slot|space|stories|story|strip|tags|text|thread|title|toolbar|tools|top|unit|view|widget|widgets|wrap|wrapper|zone|articles?|reading|readers?|user|users|login|info|policy|entry|js|is|has|v"
)
MAIN_NAME = re.compile(r"(?:^|[\s_-])(?:article|articlebody|post|entry|content|story|body|main|text|markdown)(?:$|[\s_-])")

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)(?:>|\Z)", re.S)
#: Every attribute with its value, so that a value is never taken for a name.
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s>"']\S*)))?|"[^"]*(?:"|\Z)|'[^']*(?:'|\Z)""")
_SPACE = re.compile(r"\s+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")




def foreign_name(value: str) -> str:
    """What a name (class, id or role, in lower case) says of text that is not the page's own: "yes", "maybe", or nothing.  Only a whole
    class counts: all of its words are such names or kinds of boxes.  related-posts is one, related-work is not."""
    out = ""
    for name in value.split():
        words = [w for w in re.split(r"[_-]+", name) if w]
        others = [w for w in words if not FOREIGN_WORD.fullmatch(w)]
        if len(others) < len(words) and all(BOX_WORD.fullmatch(w) or DOUBTFUL_WORD.fullmatch(w) for w in others):
            return "yes"
        if any(DOUBTFUL_WORD.fullmatch(w) for w in words) and all(DOUBTFUL_WORD.fullmatch(w) or BOX_WORD.fullmatch(w) for w in words) and not {"text", "content", "body", "main", "article", "story", "entry"} & {*words}:
            out = "maybe"
    return out


@dataclass
class Block:
    text: str
    words: int
    linked: float
    main: bool
    furniture: bool
    layout_named: bool
    foreign_named: bool
    leaf_named: bool
    heading: bool


@dataclass
class _Open:
    """An open element and what its markup says."""

    tag: str
    main: bool = False
    hidden: bool = False
    layout: bool = False
    foreign: bool = False
    leaf: bool = False
    doubtful: bool = False


def _opened(tag: str, attributes: str) -> _Open:
    out = _Open(tag, tag in ("article", "main"))
    named_main = comment = False
    for found in _ATTRIBUTE.finditer(attributes or ""):
        name = (found[1] or "").lower()
        value = (found[2] or found[3] or found[4] or "").strip()
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            out.hidden = True
        elif name in ("class", "id", "role"):
            value = _CAMEL.sub("-", value).lower()
            out.layout |= bool(LAYOUT_NAME.search(value))
            said = foreign_name(value)
            out.foreign |= said == "yes"
            out.doubtful |= said == "maybe"
            comment |= bool({"comment", "comment-body", "reply"} & {*value.split()})
            named_main |= bool(MAIN_NAME.search(value))
        elif name == "itemprop":
            named_main |= value.lower() == "articlebody"
            comment |= value.lower() == "comment"
    out.foreign |= comment
    if tag in LEAVES:
        out.leaf, out.layout, out.foreign, out.doubtful = out.layout or out.foreign or out.doubtful, False, False, False
    elif tag in ("html", "body"):
        out.layout = out.foreign = out.doubtful = False
    elif named_main and not out.foreign and not out.doubtful and not out.layout and tag in ("div", "section", "td"):
        out.main = True
    if tag in ("article", "main"):  # a name on the element itself does not condemn it, but for a single reader's comment
        out.layout = out.doubtful = False
        out.foreign = comment and tag == "article"
        out.main = not out.foreign
    return out


def blocks_of(page: str) -> list[Block]:
    """The page's blocks of text in order."""
    out: list[Block] = []
    open_: list[_Open] = []
    silent = anchors = 0
    text: list[str] = []
    linked = 0

    def block(joined: str, share: float) -> Block:
        main = furniture = layout = foreign = leaf = heading = False
        for x in reversed(open_):
            furniture |= x.hidden or x.tag in FURNITURE or not main and x.tag in WRAPPING_FURNITURE and not (x.tag == "header" and any(y.main for y in open_))
            inside = any(y.main for y in open_)
            foreign |= x.foreign or x.doubtful and not inside
            leaf |= x.doubtful and inside
            layout |= x.layout and not main
            leaf |= x.leaf
            heading |= x.tag in ("h1", "h2", "h3", "h4", "h5", "h6")
            main |= x.main
        return Block(joined, joined.count(" ") + 1, share, main, furniture, layout, foreign, leaf, heading)

    def flush() -> None:
        nonlocal linked
        if text:
            joined = _SPACE.sub(" ", html.unescape("".join(text))).strip()
            if joined:
                size = sum(map(len, text))
                out.append(block(joined, linked / size if size else 0.0))
            text.clear()
        linked = 0

    def close(at: int) -> None:
        nonlocal silent, anchors
        while len(open_) > at:
            if open_[-1].tag in BLOCK:
                flush()
            tag = open_.pop().tag
            silent -= tag in NO_TEXT
            anchors -= tag == "a"

    at, end = 0, len(page)
    while at < end:
        found = _TOKEN.search(page, at)
        stop = found.start() if found else end
        if stop > at and silent and open_[-1].tag == "head" and not page[at:stop].isspace():
            close(len(open_) - 1)
        if stop > at and not silent:
            piece = page[at:stop]
            text.append(piece)
            if anchors:
                linked += len(piece)
        if not found:
            break
        at = found.end()
        tag = found[2] or found[5]
        if not tag:
            if not silent and found[0].startswith("<![CDATA["):
                text.append(html.escape(found[0][9:].removesuffix("]]>")))
            continue
        tag = tag.lower()
        if found[1] or found[4]:
            for n in range(len(open_) - 1, -1, -1):
                if open_[n].tag == tag:
                    close(n)
                    break
            else:
                if tag in BLOCK and not silent:
                    flush()
            continue
        if tag == "body":
            close(next((n for n, x in enumerate(open_) if x.tag == "head"), len(open_)))
        if silent and (open_[-1].tag == "head" and tag not in HEAD and tag != "html" or open_[-1].tag in ("svg", "math") and tag in BLOCK):
            close(len(open_) - 1)
        if silent:
            if tag in NO_TEXT and tag not in ("script", "style", "textarea"):
                open_.append(_Open(tag))
                silent += 1
            elif tag in ("script", "style", "textarea"):
                at = re.compile(rf"</{tag}\s*>|\Z", re.I).search(page, at).end()
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in VOID:
            if tag in BLOCK:
                flush()
            continue
        attributes = found[3] if found[2] else found[6]
        if attributes and attributes.rstrip().endswith("/") and tag not in BLOCK and tag not in NO_TEXT:
            continue
        if tag in ("script", "style", "textarea"):  # raw text: only its own end tag ends it
            closing = re.compile(rf"</{tag}\s*>|\Z", re.I).search(page, at)
            at = closing.end()
            continue
        if tag in BLOCK:
            flush()
            for n in range(len(open_) - 1, -1, -1):
                inner = open_[n].tag
                if inner == tag and tag in CLOSES_ITSELF or inner == "p":
                    close(n)
                    break
                if inner in BLOCK and (inner in CLOSES_ITSELF.get(tag, ()) or tag not in CLOSES_ITSELF or inner not in CLOSES_ITSELF):
                    break
        open_.append(_opened(tag, attributes))
        silent += tag in NO_TEXT
        anchors += tag == "a"
    close(0)
    flush()
    return out


#: Names of the numbers of a block, in order.
FEATURES = (
    "in_main", "furniture", "layout_named", "foreign_named", "leaf_named", "page_has_main", "heading", "words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after",
)


def block_features(blocks: list[Block]) -> list[tuple[float, ...]]:
    own = [b for b in blocks if not b.furniture and not b.foreign_named]
    marked = sum(b.words for b in own if b.main)
    # marked main content is what the page is about if it holds most of the text that could be that
    any_main = any(b.main for b in own) and 2 * marked >= sum(b.words for b in own if b.main or not b.layout_named and b.linked < 0.5 and b.words >= LONG[0])
    rows = []
    for n, b in enumerate(blocks):
        p = blocks[n - 1] if n else None
        q = blocks[n + 1] if n + 1 < len(blocks) else None
        rows.append((
            float(b.main and (any_main or b.furniture or b.foreign_named)), float(b.furniture), float(b.layout_named), float(b.foreign_named), float(b.leaf_named), float(any_main), float(b.heading), float(b.words), b.linked,
            float(p.words) if p else 0.0, p.linked if p else 0.0, float(q.words) if q else 0.0, q.linked if q else 0.0,
        ))
    return rows


#: Numbers that stand for blocks of one size: labels and buttons, short lines, sentences, paragraphs, long ones; text without links,
#: with some, links alone; and neighbours that are missing, text, or links.
SHORT, LONG, VERY_LONG = (1, 5), (14,), (45, 120)
ANY_WORDS = (*SHORT, *LONG, *VERY_LONG)
FEW_LINKS, ALL_LINKS = (0.0, 0.3), (1.0,)
ANY_LINKS = (*FEW_LINKS, *ALL_LINKS)
NONE, TEXT, LINKS = (0, 0.0), (90, 0.0), (2, 1.0)
ANY_SIDE = (NONE, TEXT, LINKS)
#: The labelled table in short: kinds of blocks seen in page layouts, labelled by hand (1: main text).  Each line gives, in turn, in_main,
#: furniture, layout_named, foreign_named, leaf_named, page_has_main and heading; then the words, the link densities, and the
#: neighbours before and after that such blocks have.  A line stands for all combinations of these.
KINDS: list[tuple] = [
    # marked main content: paragraphs, list items and headings of any length, whatever their links and neighbours
    ((1, 0, 0, 0, 0, 1, 0), ANY_WORDS, ANY_LINKS, ANY_SIDE, ANY_SIDE, 1),
    ((1, 0, 0, 0, 0, 1, 1), ANY_WORDS, ANY_LINKS, ANY_SIDE, ANY_SIDE, 1),
    # inside it, paragraphs with a name of their own: real ones are sentences, labels and buttons are a few words or links
    ((1, 0, 0, 0, 1, 1, 0), (*LONG, *VERY_LONG), FEW_LINKS, ANY_SIDE, ANY_SIDE, 1),
    ((1, 0, 0, 0, 1, 1, 0), SHORT, ANY_LINKS, ANY_SIDE, ANY_SIDE, 0),
    ((1, 0, 0, 0, 1, 1, 0), (*LONG, *VERY_LONG), ALL_LINKS, ANY_SIDE, ANY_SIDE, 0),
    # furniture by element, by the name of a container, or text of others: also when it is long and without links
    *[((main, *marks, 0, page, heading), ANY_WORDS, ANY_LINKS, ANY_SIDE, ANY_SIDE, 0) for marks in ((1, 0, 0), (0, 0, 1)) for main, page in ((1, 1), (0, 1), (0, 0)) for heading in (0, 1)],
    *[((1, 0, 1, 0, 0, 1, heading), ANY_WORDS, ANY_LINKS, ANY_SIDE, ANY_SIDE, 0) for heading in (0, 1)],
    # anything else on a page whose main content is marked
    *[((0, 0, layout, 0, leaf, 1, heading), ANY_WORDS, ANY_LINKS, ANY_SIDE, ANY_SIDE, 0) for layout, leaf, heading in ((0, 0, 0), (0, 0, 1), (1, 0, 0), (0, 1, 0))],
    # pages without such marks: sentences and paragraphs with few links, and short lines that have text beside them or stand alone
    ((0, 0, 0, 0, 0, 0, 0), (*LONG, *VERY_LONG), FEW_LINKS, ANY_SIDE, ANY_SIDE, 1),
    ((0, 0, 0, 0, 0, 0, 0), SHORT, FEW_LINKS, (TEXT,), ANY_SIDE, 1),
    ((0, 0, 0, 0, 0, 0, 0), SHORT, FEW_LINKS, (NONE, LINKS), (TEXT,), 1),
    ((0, 0, 0, 0, 0, 0, 0), SHORT, FEW_LINKS, (NONE,), (NONE,), 1),
    # runs of links, and short blocks among them
    ((0, 0, 0, 0, 0, 0, 0), ANY_WORDS, ALL_LINKS, ANY_SIDE, ANY_SIDE, 0),
    ((0, 0, 0, 0, 0, 0, 0), SHORT, FEW_LINKS, (LINKS,), (LINKS, NONE), 0),
    ((0, 0, 0, 0, 0, 0, 0), SHORT, FEW_LINKS, (NONE,), (LINKS,), 0),
    # headings go with what follows them
    ((0, 0, 0, 0, 0, 0, 1), ANY_WORDS, ANY_LINKS, ANY_SIDE, (TEXT, NONE), 1),
    ((0, 0, 0, 0, 0, 0, 1), ANY_WORDS, ANY_LINKS, ANY_SIDE, (LINKS,), 0),
    # containers with a layout name on such pages: long text with few links is what the page is about
    ((0, 0, 1, 0, 0, 0, 0), VERY_LONG, FEW_LINKS, ANY_SIDE, ANY_SIDE, 1),
    ((0, 0, 1, 0, 0, 0, 0), (*SHORT, *LONG), ANY_LINKS, ANY_SIDE, ANY_SIDE, 0),
    ((0, 0, 1, 0, 0, 0, 0), VERY_LONG, ALL_LINKS, ANY_SIDE, ANY_SIDE, 0),
    ((0, 0, 0, 0, 1, 0, 0), (*LONG, *VERY_LONG), FEW_LINKS, ANY_SIDE, ANY_SIDE, 1),
    ((0, 0, 0, 0, 1, 0, 0), SHORT, ANY_LINKS, ANY_SIDE, ANY_SIDE, 0),
    ((0, 0, 0, 0, 1, 0, 0), (*LONG, *VERY_LONG), ALL_LINKS, ANY_SIDE, ANY_SIDE, 0),
]


def labelled_table() -> list[tuple[tuple[float, ...], int]]:
    """Rows of (numbers in the order of FEATURES, label)."""
    return [
        (tuple(map(float, (*marks, words, links, *before, *after))), label)
        for marks, *choices, label in KINDS
        for words, links, before, after in product(*choices)
    ]


def grow(rows: list[tuple[tuple[float, ...], int]], depth: int = 16):
    """A decision tree: a share of label 1, or (feature, threshold, tree up to it, tree above it)."""
    ones = sum(y for _, y in rows)
    if depth == 0 or ones in (0, len(rows)):
        return ones / len(rows)
    best = None
    for f in range(len(rows[0][0])):
        values = sorted({x[f] for x, _ in rows})
        for low, high in zip(values, values[1:]):
            cut = (low + high) / 2
            left = [y for x, y in rows if x[f] <= cut]
            k, n = sum(left), len(left)
            r, m = ones - k, len(rows) - n
            impurity = 2 * k * (n - k) / n + 2 * r * (m - r) / m
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, cut)
    if best is None:
        return ones / len(rows)
    _, f, cut = best
    return f, cut, grow([z for z in rows if z[0][f] <= cut], depth - 1), grow([z for z in rows if z[0][f] > cut], depth - 1)


def decide(tree, x: tuple[float, ...]) -> float:
    while isinstance(tree, tuple):
        f, cut, low, high = tree
        tree = low if x[f] <= cut else high
    return tree


def main_text(page: str | None, tree) -> str:
    if not page:
        return ""
    blocks = blocks_of(page)
    return "\n\n".join(b.text for b, x in zip(blocks, block_features(blocks)) if decide(tree, x) >= 0.5)


def extract_pages(pages: DataFrame, labelled: list[tuple[tuple[float, ...], int]] | None = None) -> DataFrame:
    """page_id, url, text (main blocks joined by empty lines) and n_chars of every page."""
    tree = grow(labelled or labelled_table())

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                some = batch.slice(at, 200)
                texts = pa.array([main_text(x, tree) for x in some.column(2).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), texts], ["page_id", "url", "text"])

    rows = with_small_batches(pages).select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(extract, "page_id long, url string, text string").withColumn("n_chars", F.length("text").cast("long"))

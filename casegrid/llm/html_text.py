"""HTML extraction: flat text blocks classified by a small decision tree.

A page is cut into blocks at block-level tags.  A block has its words, the share
of them inside links, the tag it stands in, and whether a container that is not
article text (navigation, header, footer, aside, form, advert, notice, comments)
is open around it.  With the same measures of the blocks before and after it, a
decision tree decides whether it is main text.  The tree is grown here, from the
labelled blocks below.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements that start and end a block.  Fixed values.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html iframe "
    "legend li link main menu meta nav noscript ol optgroup option p pre search section select "
    "summary table tbody td textarea tfoot th thead title tr ul".split()
)
#: Elements whose content is never text.
SILENT_TAGS = frozenset(
    "script style noscript template svg math iframe object canvas audio video head title".split()
)
HEADING_TAGS = ("h1", "h2", "h3", "h4", "h5", "h6")
LISTED_TAGS = ("li", "dd", "dt", "option")
#: Elements without an end tag.
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Elements that hold page furniture.
FURNITURE_TAGS = frozenset("nav footer aside form menu dialog button select textarea fieldset search".split())
#: Words of a class, id or role that mark page furniture.
FURNITURE_WORDS = frozenset(
    "ad ads adsbygoogle adslot advert adverts advertisement advertising banner sponsor sponsored promo promotion "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar side rail widget widgets "
    "masthead topbar footer foot bottom copyright legal "
    "cookie cookies consent notice notices alert popup modal overlay gdpr newsletter subscribe signup "
    "comment comments disqus reply replies respond discussion "
    "share sharing social related recommended recommendations pagination pager toolbar search login form "
    "complementary contentinfo dialog alertdialog"
    .split()
)
#: Words that mark the article itself, stronger than the ones above.
ARTICLE_WORDS = frozenset("article articlebody post postbody entry story main maincontent content".split())

#: Words that say of the next one that it is beside the element, not in it.
LAYOUT_WORDS = frozenset("with has no without".split())
#: Furniture tags that can also hold a whole page.
WRAPPER_TAGS = frozenset("form fieldset".split())
#: A block of as many words outside links is a text of its own.
LONG_WORDS = 20

#: Tags that a word of their class does not make page furniture: it names the layout.
FRAME_TAGS = frozenset("html body article main".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # a quote opens a value only after an equals sign; any other one is a character
    r"|<(?P<end>/)?(?P<tag>[a-zA-Z][^\s/>]*)"
    r"(?P<attrs>(?:[^>\"'=]++|=\s*+(?:\"[^\"]*\"|'[^']*')|[=\"'])*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.S)
_HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?=\s|=|/|$)|aria-hidden\s*=\s*[\"']?true)", re.I)
_SPACE = re.compile(r"\s+")
_SILENT_END = {t: re.compile(rf"</{t}\s*(?=[>/\s])[^>]*>", re.I) for t in SILENT_TAGS}


@dataclass
class Block:
    text: str
    words: int = 0
    linked: int = 0
    heading: bool = False
    listed: bool = False
    furniture: bool = False
    article: bool = False
    #: Innermost element around the block that may be a wrapper of the page, not furniture.
    wrapper: int = 0

    @property
    def density(self) -> float:
        return self.linked / self.words if self.words else 0.0


@dataclass
class _Open:
    tag: str
    block: bool
    furniture: bool
    article: bool
    wrapper: int = 0
    #: Inline elements open since a block element was, by tag.
    inline: Counter = field(default_factory=Counter)


class _Stack:
    """Open elements, with counts of what a block has to know of them."""

    def __init__(self):
        self.open = [_Open("", True, False, False)]
        self.tags, self.furniture, self.article, self.levels = Counter(), 0, 0, [0]
        self.wrappers = [0]

    @property
    def top(self) -> _Open:
        return self.open[-1]

    def push(self, element: _Open) -> None:
        self.open.append(element)
        self.tags[element.tag] += 1
        self.furniture += element.furniture and not element.wrapper
        self.article += element.article
        if element.wrapper:
            self.wrappers.append(element.wrapper)
        if element.block:
            self.levels.append(len(self.open) - 1)
        else:
            self.open[self.levels[-1]].inline[element.tag] += 1

    def pop(self) -> None:
        element = self.open.pop()
        self.tags[element.tag] -= 1
        self.furniture -= element.furniture and not element.wrapper
        self.article -= element.article
        if element.wrapper:
            self.wrappers.pop()
        if element.block:
            self.levels.pop()
        else:
            self.open[self.levels[-1]].inline[element.tag] -= 1

    def close(self, tag: str) -> None:
        """End tag: pops to its element; an inline end tag closes no block."""
        within = self.tags[tag] if tag in BLOCK_TAGS else self.open[self.levels[-1]].inline[tag]
        while within:
            done = self.top.tag == tag
            self.pop()
            if done:
                break

    def any(self, tags) -> bool:
        return any(self.tags[t] for t in tags)


@dataclass
class _Flow:
    """Text of the block that is being read."""

    parts: list[str] = field(default_factory=list)
    linked: list[bool] = field(default_factory=list)


def _names(value: str) -> Iterator[set[str]]:
    """Words of each name in a class, id or role, without those that name the layout."""
    for name in re.sub(r"([a-z0-9])([A-Z])", r"\1 \2", value.replace(" ", "\n")).lower().split("\n"):
        words = re.findall("[a-z0-9]+", name)
        yield {w for before, w in zip(["", *words], words, strict=False) if before not in LAYOUT_WORDS}


def _marks(tag: str, attrs: str) -> tuple[bool, bool, bool]:
    """Whether an element is page furniture, whether it is the article, and whether
    it is furniture only as long as it does not hold most of the page."""
    furniture, article = tag in FURNITURE_TAGS, tag in ("article", "main")
    hidden, named, weak = bool(_HIDDEN.search(attrs)), False, False
    for m in _ATTRIBUTE.finditer(attrs):
        if m[1].lower() in ("class", "id", "role", "itemprop", "aria-label"):
            for words in _names(m[2] or m[3] or m[4] or ""):
                # A name of both (comment-content) is a part of the furniture.
                weak |= bool(words & FURNITURE_WORDS) or "header" in words and not words & ARTICLE_WORDS
                named |= bool(words & ARTICLE_WORDS) and not words & FURNITURE_WORDS
        elif m[1].lower() == "style" and re.search(r"display\s*:\s*none", m[0], re.I):
            hidden = True
    weak &= tag not in FRAME_TAGS and not named
    loose = not hidden and (tag in WRAPPER_TAGS or weak and not furniture)
    return furniture or weak or hidden, article or named, loose


def _unwrap(page: list[Block], parents: dict[int, int]) -> None:
    """Furniture marks go from elements that hold most of the page's words, with no
    long text beside them; the outer ones first.

    `parents` names the possible wrappers in page order with the one around them.
    Those that hold most words stand inside each other, so one walk inwards finds
    which of them are wrappers.
    """
    held, long = Counter(), set()
    for b in page:
        held[b.wrapper] += b.words - b.linked
        if not b.furniture and b.words - b.linked >= LONG_WORDS:
            long.add(b.wrapper)
    for k in reversed(parents):
        held[parents[k]] += held[k]
    total, beside, free = held[0], 0 in long, {0}
    for k in parents:
        if 2 * held[k] > total and not beside:
            free.add(k)
            beside = k in long
    for b in page:
        b.furniture |= b.wrapper not in free


def blocks(page: str) -> list[Block]:
    """Text blocks of a page in order; empty ones are left out.  Linear in the page."""
    out: list[Block] = []
    stack = _Stack()
    parents: dict[int, int] = {}
    flow = _Flow()

    def flush() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(flow.parts))).strip()
        if text:
            count = lambda s: len(html.unescape(s).split())
            # Words of parts can join over inline tags, so link words are capped by all words.
            n = len(text.split())
            linked = min(n, sum(count(p) for p, in_link in zip(flow.parts, flow.linked, strict=True) if in_link))
            article = stack.article > 0
            out.append(Block(
                text, n, linked, stack.any(HEADING_TAGS), stack.any(LISTED_TAGS),
                stack.tags["header"] > 0 and not article or stack.furniture > 0, article,
                stack.wrappers[-1],
            ))
        flow.parts.clear()
        flow.linked.clear()

    def add(text: str) -> None:
        if text:
            flow.parts.append(text)
            flow.linked.append(stack.tags["a"] > 0)

    at = 0
    while m := _TOKEN.search(page, at):
        add(page[at : m.start()])
        at = m.end()
        if m["tag"] is None:
            if m[0].startswith("<![CDATA["):
                add(html.escape(m[0][9:].removesuffix("]]>")))
            continue
        tag = m["tag"].lower()
        if tag in BLOCK_TAGS:
            flush()
        if m["end"]:
            stack.close(tag)
        elif tag in SILENT_TAGS and tag not in ("head",) and not m["attrs"].rstrip().endswith("/"):
            end = _SILENT_END[tag].search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID_TAGS and not m["attrs"].rstrip().endswith("/"):
            if tag in BLOCK_TAGS:
                # A block inside an unclosed inline element: the element ends here.
                while not stack.top.block and stack.top.tag != "a":
                    stack.pop()
            if tag in ("p", "li", "dt", "dd", "option", "tr", "td", "th") and stack.top.tag == tag:
                stack.pop()  # its end tag was left out
            furniture, article, loose = _marks(tag, m["attrs"])
            number = len(parents) + 1 if loose else 0
            if loose:
                parents[number] = stack.wrappers[-1]
            stack.push(_Open(tag, tag in BLOCK_TAGS, furniture, article, number))
    add(page[at:])
    flush()
    _unwrap(out, parents)
    return out


#: Measures that the tree may test, of the block itself and of its neighbours.
FEATURES = (
    "words", "density", "furniture", "article", "heading", "listed",
    "before_words", "before_density", "after_words", "after_density", "before_furniture",
    "after_furniture", "page_has_article",
)


def features(page: list[Block]) -> list[list[float]]:
    nothing = Block("")
    # An article that holds less text than what stands beside it is a teaser.
    plain = [b for b in page if not b.furniture]
    own = sum(b.words - b.linked for b in plain if b.article)
    marked = float(any(b.article for b in plain) and 2 * own >= sum(b.words - b.linked for b in plain))
    rows = []
    for i, b in enumerate(page):
        before = page[i - 1] if i else nothing
        after = page[i + 1] if i + 1 < len(page) else nothing
        rows.append([
            b.words, b.density, b.furniture, b.article, b.heading, b.listed,
            before.words, before.density, after.words, after.density, before.furniture,
            after.furniture, marked,
        ])
    return [[float(x) for x in r] for r in rows]


#: Kinds of neighbours: words, link density, furniture.
NONE, MENU, NOTICE = (0, 0.0, 0), (2, 1.0, 1), (12, 0.0, 1)
LINKS, SHORT, TEXT = (3, 1.0, 0), (6, 0.0, 0), (60, 0.0, 0)
_ANY = (NONE, MENU, NOTICE, LINKS, SHORT, TEXT)
_CALM = (NONE, NOTICE, SHORT, TEXT)
_WORDS = (1, 5, 15, 50, 150)

#: The labelled table, by kinds: words, densities, furniture, article, heading,
#: listed, what stands before and after, whether the page marks its article, and
#: whether such blocks are main text.
KINDS = (
    # an article: its paragraphs, headings and lists, short and long
    (_WORDS, (0.0, 0.1, 0.4), (0,), (1,), (0, 1), (0, 1), _ANY, _ANY, (1,), 1),
    # a linked line or item among text, and lists of links
    ((2, 6, 12), (0.8, 1.0), (0,), (1,), (0,), (0, 1), _CALM, _CALM, (1,), 1),
    ((2, 6, 12), (0.8, 1.0), (0,), (1,), (0,), (1,), (LINKS,), _ANY, (1,), 0),
    ((2, 6, 12), (0.8, 1.0), (0,), (1,), (0,), (1,), _CALM, (LINKS,), (1,), 0),
    ((2, 9, 25), (0.9, 1.0), (0,), (1,), (0,), (0,), (LINKS,), (LINKS, NONE, MENU), (1,), 0),
    # page furniture, inside an article or not
    ((1, 5, 15, 50, 80), (0.0, 0.5, 1.0), (1,), (0, 1), (0, 1), (0, 1), _ANY, _ANY, (0, 1), 0),
    # loose text beside a marked article
    (_WORDS, (0.0, 0.4, 1.0), (0,), (0,), (0, 1), (0, 1), _ANY, _ANY, (1,), 0),
    # no marked article: text with few links, whatever stands beside it
    ((14, 50, 150), (0.0, 0.1), (0,), (0,), (0, 1), (0, 1), _ANY, _ANY, (0,), 1),
    # short lines and headings beside text, or on a page of short lines
    ((1, 5), (0.0, 0.1), (0,), (0,), (0, 1), (0, 1), (TEXT,), _ANY, (0,), 1),
    ((1, 5), (0.0, 0.1), (0,), (0,), (0, 1), (0, 1), _ANY, (TEXT,), (0,), 1),
    ((1, 5), (0.0,), (0,), (0,), (0, 1), (0, 1), (NONE, SHORT), (NONE, SHORT), (0,), 1),
    ((3, 5), (0.0,), (0,), (0,), (0,), (0,), (MENU,), (NONE, SHORT, NOTICE), (0,), 1),
    # short lines among links, link lists, lines half of links
    ((2, 5), (0.0, 0.1), (0,), (0,), (0, 1), (0, 1), (LINKS,), (LINKS, MENU, NONE), (0,), 0),
    ((2, 10, 30), (0.7, 1.0), (0,), (0,), (0, 1), (0, 1), _ANY, _ANY, (0,), 0),
    ((3,), (0.5,), (0,), (0,), (0,), (0, 1), _ANY, (LINKS,), (0,), 0),
)


def labelled() -> list[tuple]:
    """Rows of FEATURES with the label last, one for each combination of a kind."""
    rows = []
    for words, densities, furniture, article, heading, listed, before, after, marked, label in KINDS:
        for w, d, f, a, h, li, x, y, m in product(
            words, densities, furniture, article, heading, listed, before, after, marked
        ):
            rows.append((w, d, f, a, h, li, *x[:2], *y[:2], x[2], y[2], m, label))
    return rows


LABELLED = labelled()


def _gini(rows) -> float:
    p = sum(r[-1] for r in rows) / len(rows)
    return 2 * p * (1 - p) * len(rows)


def grow(rows, depth: int = 8):
    """A binary tree by Gini impurity: a label, or (feature, threshold, low, high).

    Splits are tried in order of features and thresholds; the first best one wins.
    """
    labels = {r[-1] for r in rows}
    if len(labels) == 1 or depth == 0:
        return int(sum(r[-1] for r in rows) * 2 >= len(rows))
    best = None
    for f in range(len(rows[0]) - 1):
        values = sorted({r[f] for r in rows})
        for a, b in zip(values, values[1:], strict=False):
            cut = (a + b) / 2
            low, high = [r for r in rows if r[f] <= cut], [r for r in rows if r[f] > cut]
            score = _gini(low) + _gini(high)
            if best is None or score < best[0] - 1e-9:
                best = (score, f, cut, low, high)
    if best is None:
        return int(sum(r[-1] for r in rows) * 2 >= len(rows))
    _, f, cut, low, high = best
    return f, cut, grow(low, depth - 1), grow(high, depth - 1)


def classify(tree, row) -> int:
    while not isinstance(tree, int):
        f, cut, low, high = tree
        tree = low if row[f] <= cut else high
    return tree


def main_text(page: str, tree) -> str:
    """Main text of a page: blocks the tree keeps, joined by one space."""
    found = blocks(page)
    return " ".join(b.text for b, row in zip(found, features(found), strict=True) if classify(tree, row))


def _kernel(tree):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(page or "", tree) for page in batch["html"]]
            yield batch[["page_id", "url"]].assign(text=texts, n_chars=[len(t) for t in texts])

    return run


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Character references are decoded, white space in a block is one space.  A
    NULL or empty page, or one without main text, has an empty text.  Repeated
    rows stay; other columns are ignored; an empty table gives no rows.
    """
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html")
    )
    return rows.mapInPandas(_kernel(grow(LABELLED)), "page_id long, url string, text string, n_chars long")

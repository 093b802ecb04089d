"""Main text of web pages: flat text blocks and a small decision tree.

A page is cut at block-level tags into flat text blocks. A block's features
are its word count and link density, those of the blocks before and after it,
whether it stands in an article or main element, and a grade for what the
elements around it are called. A decision tree, trained by Gini impurity on
the labelled table below, says which blocks are article.

The grade is 1 where an element is boilerplate by its tag (nav, header,
footer, aside, form) or by a class, id or role made of such words only
(``comments``, ``ad-slot``, ``related-posts``), and 0.5 where a name merely
holds such a word (``related-work``, ``no-ads``, ``search-algorithms``): then
words and link density decide. An element that is around the page says
nothing of a part of it: a grade of 0.5 is dropped on article and main, and
on elements that hold an article or half of the page's words; a form's as
well; any other one on elements that hold four fifths of the words and all the
page's article elements.

Tags are found by one pattern, linear in the page. Broken markup is usual:
a closing tag closes the innermost open element of its name or nothing, and
what is still open at the end of the page ends there.

Result text: character references decoded, white space inside a block turned
into one space, blocks joined in page order by a blank line; nothing else is
dropped or capped.

Edge cases: null html is empty; a page without blocks or article has empty
text; plain text without tags is one block; repeated rows and null ids are
rows like any other; an unclosed comment or script hides the rest of the
page, as in browsers; an empty table gives an empty result; result columns
replace input columns of the same name.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernel import slices

# HTML elements by what they mean for text.
HIDDEN = "script style noscript template svg math iframe object canvas select textarea button title audio video"
BLOCK = (
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead tr ul")
VOID = "area base br col embed hr img input link meta param source track wbr"
BOILERPLATE = "nav header footer aside form dialog menu head"
ARTICLE = "article main"
# Words in class, id or role that name what isn't article, wherever it stands.
HARD_HINTS = (
    "ad ads adv advert advertisement advertising sponsor sponsored promo promotion comment comments reply replies respond disqus "
    "discussion related recommended cookie cookies consent gdpr newsletter subscribe subscription signup popup modal overlay banner "
    "notice alert share sharing social breadcrumb breadcrumbs pagination pager tags outbrain taboola complementary contentinfo "
    "navigation search dialog adsbygoogle adbox adslot advertorial teaser teasers")
# Words in class, id, role or itemprop that name the article.
ARTICLE_HINTS = "article articlebody main maincontent content post entry story"
# Words that also name page layouts; an article inside overrides them.
SOFT_HINTS = "sidebar menu nav navbar topbar header footer masthead toolbar widget widgets login skip"
# Words that name a part or a place; a name of hints and these alone is no more than the hint.
PART_WORDS = (
    "list area section container wrapper wrap box block item items link links button buttons post posts story stories article articles bar form "
    "inner outer content contents body row col column text title heading message thread slot unit top bottom left right main side primary "
    "secondary desktop mobile sticky fixed site page global banner header footer nav menu widget your our the has")

HIDDEN_SET, BLOCK_SET, VOID_SET = set(HIDDEN.split()), set(BLOCK.split()), set(VOID.split())
BOILERPLATE_SET, ARTICLE_SET = set(BOILERPLATE.split()), set(ARTICLE.split())
HARD_SET, SOFT_SET, ARTICLE_WORDS = set(HARD_HINTS.split()), set(SOFT_HINTS.split()), set(ARTICLE_HINTS.split())
PART_SET = set(PART_WORDS.split())
# Shares of the page's words from which an element is around the page.
HALF, MOST = 0.5, 0.8

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(HIDDEN.split()) + r")\b(?:[^>]*[^/>])?>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/)?(?P<name>[a-z][a-z0-9:-]*)(?P<rest>(?:[^<>\"']|\"[^\"<]*\"|'[^'<]*'|[\"'])*)>"
    r"|<[!?/][^>]*>", re.S | re.I)
_HINT = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_UNSEEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    article: bool
    hint: float                          # 0, 0.5 or 1


@dataclass
class Element:
    parent: int                          # index in the page's elements; -1 at the top
    tag: str
    grade: float = 0.0                   # of what names it anywhere
    soft: float = 0.0                    # of what also names layouts
    article: bool = False
    words: int = 0                       # of its blocks, inner elements included
    articles: int = 0                    # article elements in it


def _grade(tokens: list[list[str]], hints: set[str]) -> float:
    """1 if a name is made of hints and words for parts only, 0.5 if it holds a hint, else 0."""
    found = [t for t in tokens if not hints.isdisjoint(t)]
    if not found:
        return 0.0
    return 1.0 if any(all(w in hints or w in PART_SET for w in t) for t in found) else 0.5


def _element(parent: int, tag: str, rest: str) -> Element:
    """What an opening tag says of its content."""
    out = Element(parent, tag)
    if tag in ("html", "body"):
        return out
    tokens = [_WORD.findall(t) for m in _HINT.finditer(rest) for t in (m[1] or m[2] or m[3] or "").lower().split()] if rest else []
    out.grade = 1.0 if tag in BOILERPLATE_SET or rest and _UNSEEN.search(rest) else _grade(tokens, HARD_SET)
    out.soft = _grade(tokens, SOFT_SET)
    out.article = tag in ARTICLE_SET or not out.grade and not out.soft and any(not ARTICLE_WORDS.isdisjoint(t) for t in tokens)
    return out


def _settle(elements: list[Element], total: int) -> list[tuple[bool, float, float]]:
    """(in an article, grade, soft grade) inside each element."""
    for e in reversed(elements):
        if e.parent >= 0:
            up = elements[e.parent]
            up.words += e.words
            up.articles += e.articles + (e.tag in ARTICLE_SET and e.grade < 1)
    out: list[tuple[bool, float, float]] = []
    everywhere = sum(e.tag in ARTICLE_SET and e.grade < 1 for e in elements)
    for e in elements:
        article, grade, soft = out[e.parent] if e.parent >= 0 else (False, 0.0, 0.0)
        share = e.words / max(1, total)
        around = share >= HALF or e.articles > 0 or e.tag in ARTICLE_SET
        most = share >= MOST and e.articles == everywhere   # no article stands outside
        own, own_soft = e.grade, e.soft
        if most or (own < 1 or e.tag == "form") and around:
            own = 0.0
        if most or own_soft < 1 and around:
            own_soft = 0.0
        if e.article:                                       # an article inside overrides what names layouts
            article, soft = True, 0.0
        out.append((article, max(grade, own), max(soft, own_soft)))
    return out


def blocks(page: str) -> list[Block]:
    """The flat text blocks of a page, in order."""
    found: list[tuple[str, int, int, int]] = []             # text, words, words in links, innermost element
    elements: list[Element] = []
    held: list[str] = []                                    # text of the open block
    linked: list[str] = []                                  # its part inside links
    stack: list[int] = []                                   # open block elements
    links = 0

    def flush() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        if text:
            n = len(text.split())
            inside = stack[-1] if stack else -1
            found.append((text, n, min(n, len(html.unescape(" ".join(linked)).split())), inside))
            if inside >= 0:
                elements[inside].words += n
        held.clear()
        linked.clear()

    def add(text: str) -> None:
        held.append(text)
        if links:
            linked.append(text)

    at = 0
    for m in _TAG.finditer(page):
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if name == "a":
            links = max(0, links + (-1 if m["end"] else 1))
        elif name == "br":
            held.append(" ")
        elif name in BLOCK_SET:
            flush()
            links = 0 if name in ("p", "div", "li") and not m["end"] else links
            if m["end"]:
                for i in range(len(stack) - 1, -1, -1):
                    if elements[stack[i]].tag == name:
                        del stack[i:]
                        break
            elif name not in VOID_SET and not m["rest"].endswith("/"):
                if name in ("p", "li", "td", "th", "tr", "dd", "dt", "option") and stack and elements[stack[-1]].tag == name:
                    stack.pop()                             # these close a neighbour of their name
                elements.append(_element(stack[-1] if stack else -1, name, m["rest"]))
                stack.append(len(elements) - 1)
    if at < len(page):
        add(page[at:])
    flush()
    inside = _settle(elements, sum(n for _, n, _, _ in found))
    out = []
    for text, n, in_links, e in found:
        article, grade, soft = inside[e] if e >= 0 else (False, 0.0, 0.0)
        out.append(Block(text, n, in_links, article, max(grade, soft)))
    return out


FEATURES = "words density words_before density_before words_after density_after article hint".split()

# Labelled blocks (the features above, then 1 for article).
LABELLED = [
    # paragraphs, headings and one-word lines inside an article
    (48, 0.00, 9, 0.00, 60, 0.00, 1, 0, 1), (1, 0.00, 48, 0.00, 52, 0.00, 1, 0, 1), (9, 0.00, 5, 1.00, 48, 0.00, 1, 0, 1),
    (120, 0.02, 80, 0.00, 7, 0.30, 1, 0, 1), (3, 0.00, 2, 0.00, 1, 0.00, 1, 0, 1), (22, 0.20, 30, 0.10, 41, 0.00, 1, 0, 1),
    (6, 1.00, 40, 0.00, 35, 0.00, 1, 0, 1), (15, 0.60, 25, 0.00, 3, 0.00, 1, 0, 1), (1, 0.00, 1, 1.00, 8, 0.00, 1, 0, 1),
    (2, 0.00, 14, 0.00, 0, 0.00, 1, 0, 1), (75, 0.00, 0, 0.00, 0, 0.00, 1, 0, 1), (4, 0.00, 6, 1.00, 9, 0.20, 1, 0, 1),
    (3, 1.00, 2, 1.00, 4, 1.00, 1, 0, 1), (1, 1.00, 1, 1.00, 1, 1.00, 1, 0, 1), (5, 0.80, 70, 0.00, 2, 1.00, 1, 0, 1),
    (12, 0.75, 6, 1.00, 9, 0.90, 1, 0, 1), (2, 1.00, 0, 0.00, 44, 0.00, 1, 0, 1), (8, 0.50, 3, 1.00, 5, 1.00, 1, 0, 1),
    (4, 0.00, 2, 1.00, 3, 1.00, 1, 0, 1), (7, 0.00, 3, 0.00, 4, 0.70, 1, 0, 1), (10, 1.00, 52, 0.00, 6, 1.00, 1, 0, 1),
    # menus, adverts, notices, forms, comments and footers, inside an article or not
    (1, 1.00, 1, 1.00, 1, 1.00, 0, 1, 0), (2, 1.00, 0, 0.00, 1, 1.00, 0, 1, 0), (14, 0.00, 1, 1.00, 9, 0.00, 0, 1, 0),
    (60, 0.00, 55, 0.00, 48, 0.00, 0, 1, 0), (33, 0.00, 70, 0.00, 28, 0.00, 1, 1, 0), (5, 0.00, 44, 0.00, 61, 0.00, 1, 1, 0),
    (11, 0.00, 52, 0.00, 0, 0.00, 0, 1, 0), (80, 0.05, 12, 0.00, 90, 0.00, 1, 1, 0), (3, 0.33, 20, 0.00, 18, 0.00, 1, 1, 0),
    (25, 0.00, 8, 0.50, 2, 0.00, 0, 1, 0), (1, 0.00, 4, 0.00, 30, 0.00, 1, 1, 0), (140, 0.00, 100, 0.00, 90, 0.00, 0, 1, 0),
    # pages whose elements say nothing: running text
    (40, 0.00, 35, 0.00, 50, 0.00, 0, 0, 1), (65, 0.05, 10, 0.00, 22, 0.00, 0, 0, 1), (21, 0.00, 40, 0.00, 33, 0.10, 0, 0, 1),
    (90, 0.10, 0, 0.00, 0, 0.00, 0, 0, 1), (28, 0.00, 6, 1.00, 45, 0.00, 0, 0, 1), (19, 0.00, 55, 0.00, 5, 0.00, 0, 0, 1),
    (8, 0.00, 38, 0.00, 47, 0.00, 0, 0, 1), (5, 0.00, 60, 0.00, 52, 0.00, 0, 0, 1), (35, 0.20, 30, 0.00, 4, 1.00, 0, 0, 1),
    (55, 0.00, 3, 0.00, 2, 0.00, 0, 0, 1), (12, 0.00, 26, 0.00, 31, 0.00, 0, 0, 1), (3, 0.00, 42, 0.00, 36, 0.00, 0, 0, 1),
    (60, 0.00, 62, 0.00, 2, 1.00, 0, 0, 1), (45, 0.00, 52, 0.00, 0, 0.00, 0, 0, 1), (70, 0.10, 40, 0.00, 1, 1.00, 0, 0, 1),
    (38, 0.05, 66, 0.00, 3, 0.50, 0, 0, 1), (26, 0.00, 44, 0.00, 2, 0.00, 0, 0, 1), (24, 0.00, 2, 1.00, 3, 1.00, 0, 0, 1),
    # pages whose elements say nothing: links, labels and notes
    (2, 1.00, 3, 1.00, 2, 1.00, 0, 0, 0), (4, 0.75, 1, 1.00, 5, 0.60, 0, 0, 0), (30, 0.80, 25, 0.90, 28, 0.85, 0, 0, 0),
    (7, 0.00, 2, 1.00, 3, 0.50, 0, 0, 0), (9, 0.00, 4, 0.00, 0, 0.00, 0, 0, 0), (1, 0.00, 2, 0.00, 3, 0.00, 0, 0, 0),
    (10, 0.50, 60, 0.00, 8, 0.70, 0, 0, 0), (6, 0.00, 0, 0.00, 5, 1.00, 0, 0, 0), (18, 0.60, 9, 0.40, 12, 0.70, 0, 0, 0),
    (2, 1.00, 60, 0.00, 0, 0.00, 0, 0, 0), (3, 1.00, 45, 0.00, 50, 0.00, 0, 0, 0), (8, 0.90, 38, 0.00, 2, 1.00, 0, 0, 0),
    (12, 0.00, 3, 1.00, 6, 0.00, 0, 0, 0), (5, 0.00, 48, 0.00, 3, 1.00, 0, 0, 0), (22, 0.70, 70, 0.00, 64, 0.00, 0, 0, 0),
    # pages whose elements say nothing: long lists of links
    (45, 0.85, 30, 0.90, 40, 0.80, 0, 0, 0), (70, 0.95, 5, 0.00, 20, 0.50, 0, 0, 0), (50, 0.90, 60, 0.00, 58, 0.00, 0, 0, 0),
    (38, 0.75, 2, 1.00, 3, 1.00, 0, 0, 0), (110, 0.80, 0, 0.00, 44, 0.00, 0, 0, 0),
    # names that merely hold such a word: running text and its headings
    (60, 0.00, 2, 0.00, 58, 0.00, 1, 0.5, 1), (45, 0.05, 62, 0.00, 0, 0.00, 1, 0.5, 1), (80, 0.00, 75, 0.00, 6, 1.00, 0, 0.5, 1),
    (35, 0.10, 4, 0.00, 50, 0.00, 0, 0.5, 1), (2, 0.00, 48, 0.00, 60, 0.00, 1, 0.5, 1), (3, 0.00, 55, 0.00, 44, 0.00, 0, 0.5, 1),
    (28, 0.00, 33, 0.00, 41, 0.00, 1, 0.5, 1), (52, 0.20, 60, 0.10, 48, 0.00, 0, 0.5, 1),
    # the same: short notes, labels and links
    (3, 0.00, 6, 1.00, 2, 1.00, 0, 0.5, 0), (6, 0.00, 4, 0.00, 5, 1.00, 0, 0.5, 0), (9, 1.00, 8, 1.00, 7, 1.00, 1, 0.5, 0),
    (2, 0.00, 40, 0.00, 4, 1.00, 1, 0.5, 0), (5, 0.80, 52, 0.00, 3, 1.00, 0, 0.5, 0), (8, 0.00, 3, 0.00, 4, 0.00, 0, 0.5, 0),
    (24, 0.90, 30, 0.80, 26, 0.95, 0, 0.5, 0), (4, 0.00, 2, 0.50, 48, 0.00, 0, 0.5, 0), (3, 0.00, 50, 0.00, 0, 0.00, 0, 0.5, 0),
    (5, 0.00, 60, 0.00, 0, 0.00, 0, 0.5, 0), (4, 0.00, 0, 0.00, 52, 0.00, 0, 0.5, 0), (6, 0.00, 45, 0.00, 3, 0.00, 0, 0.5, 0),
    # pages whose elements say nothing: a line between text, and the same between long lists of links
    (10, 0.00, 34, 0.00, 30, 0.00, 0, 0, 1), (9, 0.00, 31, 0.05, 33, 0.00, 0, 0, 1), (10, 0.00, 34, 0.90, 30, 0.85, 0, 0, 0),
    (9, 0.00, 31, 0.95, 33, 0.90, 0, 0, 0), (26, 0.00, 35, 0.90, 40, 0.95, 0, 0, 0), (25, 0.00, 36, 0.00, 41, 0.90, 0, 0, 1),
]


def train(rows: list[tuple], depth: int = 6):
    """A decision tree by Gini impurity: a class, or (feature, limit, tree if <=, tree if >)."""
    yes = sum(r[-1] for r in rows)
    if not depth or yes in (0, len(rows)):
        return int(2 * yes >= len(rows))
    best = None
    for f in range(len(rows[0]) - 1):
        values = sorted({r[f] for r in rows})
        for low, high in zip(values, values[1:]):
            limit = (low + high) / 2
            parts = [[r for r in rows if r[f] <= limit], [r for r in rows if r[f] > limit]]
            cost = sum(2 * (k := sum(r[-1] for r in p)) * (len(p) - k) / len(p) for p in parts)
            if best is None or cost < best[0] - 1e-12:
                best = (cost, f, limit, parts)
    if best is None:
        return int(2 * yes >= len(rows))
    _, f, limit, (low, high) = best
    return f, limit, train(low, depth - 1), train(high, depth - 1)


def decide(tree, x: tuple) -> bool:
    while not isinstance(tree, int):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return bool(tree)


def main_text(page: str | None, tree) -> str:
    """The article's blocks, joined by blank lines."""
    found = blocks(page or "")
    shape = [(b.words, b.linked / b.words) for b in found]
    out = []
    for i, b in enumerate(found):
        before = shape[i - 1] if i else (0, 0.0)
        after = shape[i + 1] if i + 1 < len(found) else (0, 0.0)
        if decide(tree, (*shape[i], *before, *after, int(b.article), b.hint)):
            out.append(b.text)
    return "\n\n".join(out)


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    tree = train(LABELLED)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"),
                 pa.array([main_text(p, tree) for p in part.column("html").to_pylist()], pa.string())],
                names=["page_id", "url", "text"])

    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    ).mapInArrow(scan, "page_id long, url string, text string").withColumn("n_chars", F.char_length("text").cast("long"))

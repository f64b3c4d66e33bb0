"""Main text of web pages: flat text blocks, judged by a small decision tree.

A page is cut into blocks at block-level tags. A block is described by its word count and link
density, those of the blocks before and after it under the same mark, and the nearest element around it
that marks an article or something beside it. The tree is trained on ``LABELLED``, a table of such descriptions.
Each page is a row of its own: nothing is shuffled and no page is cut short.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML.
RAW = frozenset("script style textarea title".split())  # text up to the end tag
SKIPPED = frozenset("noscript template svg math iframe object select button".split())  # elements that may nest
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track".split())
# Elements, and words of class, id or role, that mark what stands in them.
BESIDE_TAGS = frozenset("nav footer aside form head menu dialog fieldset".split())
ARTICLE_TAGS = frozenset("article main".split())
BESIDE_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment "
    "commentlist comments complementary consent contentinfo cookie cookies copyright dialog disclaimer disqus "
    "footer footnav form gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice "
    "notification overlay pager pagination popup privacy promo promoted promotion recommended related replies "
    "reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe tags "
    "toolbar topbar widget".split()
)
ARTICLE_WORDS = frozenset("article articlebody content entry main post story".split())
COMMENT_WORDS = frozenset("comment commentlist comments disqus replies reply respond".split())
# Words that say what a name is about whatever stands before them (reader-comments), but for those of states and layouts.
SURE_WORDS = frozenset(
    "adbox advert adverts advertisement advertising breadcrumb breadcrumbs commentlist comments disqus gdpr navbar "
    "newsletter pagination promo replies sidebar signup sponsored".split()
)
STATE_WORDS = frozenset("can disable enable has have hide is no non not of off on show with without".split())
# Words that a name may have next to those above; any other word makes it another name (has-sidebar, share-of-market).
PLAIN_WORDS = frozenset(
    "area author bar block body bottom box button buttons center col column container cta group head header holder "
    "icon icons inline inner item items js left link links list meta module outer page panel primary right row secondary "
    "section site slot sticky text title top unit user wrap wrapper global".split()
)

ARTICLE, BESIDE, UNMARKED = 1, -1, 0
OUTSIDE, FORM = -2, 2  # beside the article whatever is in it; in a form, which may hold the whole page

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SKIPPED_TAGS = {name: re.compile(rf"<(/?){name}(?=[\s/>])([^>]*)>", re.I) for name in SKIPPED}
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in RAW}


def _mark(tag: str, attributes: str, inside_article: bool) -> int:
    """What an element says about the text in it."""
    if tag in ("footer", "aside"):
        return OUTSIDE
    if tag == "form":
        return BESIDE if inside_article else FORM
    if tag in BESIDE_TAGS or (tag == "header" and not inside_article):
        return BESIDE
    usual = ARTICLE if tag in ARTICLE_TAGS else UNMARKED
    if tag in ("html", "body") or not attributes:
        return usual
    article = False
    for found in _NAMED.finditer(attributes):
        if tag in HEADINGS and found[1].lower() == "id":
            continue
        for name in (found[2] or found[3] or found[4] or "").split():
            words = [w.lower() for w in _WORDS.findall(name)]
            said = list(words)
            while said and said[-1] in PLAIN_WORDS:
                said.pop()
            if said and said[-1] in SURE_WORDS and STATE_WORDS.isdisjoint(words):
                if said[-1] in COMMENT_WORDS:
                    return OUTSIDE
                if not usual:
                    return BESIDE
            if words and (words[-1] in BESIDE_WORDS or words[0] in BESIDE_WORDS):
                if all(w in BESIDE_WORDS or w in ARTICLE_WORDS or w in PLAIN_WORDS for w in words):
                    if words[0] in COMMENT_WORDS or words[-1] in COMMENT_WORDS:
                        return OUTSIDE
                    # Parts of an article often carry its name: article-header, post-header.
                    if not usual and not (words[-1] == "header" and inside_article):
                        return BESIDE
            article = article or bool(words and words[-1] in ARTICLE_WORDS)
    return ARTICLE if article else usual


def _ends_of(page: str, tag: str) -> dict[int, int]:
    """Where each element of a name that is closed ends, by where its start tag ends."""
    ends, opened = {}, []
    for found in _SKIPPED_TAGS[tag].finditer(page):
        if not found[1]:
            if not found[2].endswith("/"):
                opened.append(found.end())
        elif opened:
            ends[opened.pop()] = found.end()
    return ends


def blocks(page: str) -> list[tuple[str, int, float]]:
    """Text, mark and link density of each block with text, in page order.

    Character references are decoded and white space is one space. A line break is white space.
    """
    found: list[tuple[str, int, float]] = []
    around: list[tuple[str, int]] = []  # open block elements with the mark that holds inside them
    opened: Counter[str] = Counter()  # how many elements of a name are in around
    text: list[str] = []
    linked: list[str] = []
    ends: dict[str, dict[int, int]] = {}
    in_link = False

    def close_block() -> None:
        if text:
            words = html.unescape("".join(text)).split()
            if words:
                links = len(html.unescape(" ".join(linked)).split()) if linked else 0
                mark = around[-1][1] if around else UNMARKED
                found.append((" ".join(words), mark, min(1.0, links / len(words))))
            text.clear()
            linked.clear()

    def enter(tag: str, mark: int) -> None:
        around.append((tag, mark))
        opened[tag] += 1

    def leave() -> str:
        tag, _ = around.pop()
        opened[tag] -= 1
        return tag

    def put(piece: str) -> None:
        text.append(piece)
        if in_link:
            linked.append(piece)

    at, end = 0, len(page)
    while at < end:
        start = page.find("<", at)
        if start < 0:
            put(page[at:])
            break
        if start > at:
            put(page[at:start])
        markup = _MARKUP.match(page, start)
        if markup is None:
            put("&lt;")
            at = start + 1
            continue
        at = markup.end()
        closing, tag = markup[1] or markup[4], (markup[2] or markup[5] or "").lower()
        attributes = markup[3] or markup[6] or ""
        if not tag:
            continue
        if tag == "br":
            put(" ")
        elif tag in RAW:
            if not closing and not attributes.endswith("/"):
                over = _RAW_END[tag].search(page, at)
                at = over.end() if over else end
        elif tag in SKIPPED:
            if not closing:
                if tag not in ends:
                    ends[tag] = _ends_of(page, tag)
                at = ends[tag].get(at, at)
        elif tag == "a":
            in_link = not closing
        elif tag in INLINE:
            if not closing and attributes and _mark(tag, attributes, True) in (BESIDE, OUTSIDE):
                close_block()
                held = around[-1][1] if around else UNMARKED
                enter(tag, OUTSIDE if held == OUTSIDE else BESIDE)
            elif closing and around and around[-1][0] == tag:
                close_block()
                leave()
        else:
            close_block()
            if tag in VOID:
                continue
            if closing:
                # Each element is left once, so tags that close nothing or too much cost no walk of their own.
                while opened[tag] and leave() != tag:
                    pass
            elif not attributes.endswith("/"):
                if around and around[-1][0] == "p" or around and around[-1][0] == tag == "li":
                    leave()
                held = around[-1][1] if around else UNMARKED
                mark = _mark(tag, attributes, held == ARTICLE)
                enter(tag, OUTSIDE if held == OUTSIDE else mark or held)
    close_block()
    # A form with most of the words of a page without an article is the page.
    sizes = [(mark, text.count(" ") + 1) for text, mark, _ in found]
    inside = sum(n for mark, n in sizes if mark == FORM)
    whole = all(mark != ARTICLE for mark, _ in sizes) and 2 * inside > sum(n for _, n in sizes)
    marks = {FORM: UNMARKED if whole else BESIDE, OUTSIDE: BESIDE}
    return [(text, marks.get(mark, mark), density) for text, mark, density in found]


# words, density, words before, density before, words after, density after, mark, is main text
LABELLED = (
    # menus, notices, adverts, footers, comments: marked as beside the article
    (1, 1.0, 0, 0.0, 1, 1.0, BESIDE, 0),
    (2, 1.0, 1, 1.0, 2, 1.0, BESIDE, 0),
    (1, 1.0, 2, 1.0, 8, 0.0, BESIDE, 0),
    (8, 0.0, 1, 1.0, 10, 0.0, BESIDE, 0),
    (14, 0.2, 60, 0.0, 0, 0.0, BESIDE, 0),
    (45, 0.0, 80, 0.0, 30, 0.0, BESIDE, 0),
    (120, 0.0, 45, 0.0, 60, 0.0, BESIDE, 0),
    (200, 0.05, 8, 0.0, 150, 0.0, BESIDE, 0),
    (30, 0.5, 120, 0.0, 5, 1.0, BESIDE, 0),
    (3, 0.0, 90, 0.0, 40, 0.0, BESIDE, 0),
    (5, 0.0, 2, 1.0, 60, 0.0, BESIDE, 0),
    (7, 0.0, 40, 0.0, 0, 0.0, BESIDE, 0),
    (9, 0.0, 30, 0.0, 3, 1.0, BESIDE, 0),
    (60, 0.0, 3, 1.0, 2, 1.0, BESIDE, 0),
    (25, 0.1, 1, 1.0, 0, 0.0, BESIDE, 0),
    (2, 0.0, 1, 1.0, 30, 0.0, BESIDE, 0),
    # headings and paragraphs of articles, long and short, with and without links
    (9, 0.0, 8, 0.0, 120, 0.0, ARTICLE, 1),
    (1, 0.0, 90, 0.0, 70, 0.0, ARTICLE, 1),
    (120, 0.0, 9, 0.0, 45, 0.0, ARTICLE, 1),
    (45, 0.1, 120, 0.0, 1, 0.0, ARTICLE, 1),
    (300, 0.02, 45, 0.1, 14, 0.2, ARTICLE, 1),
    (6, 1.0, 50, 0.0, 80, 0.0, ARTICLE, 1),
    (20, 0.6, 4, 0.0, 12, 0.3, ARTICLE, 1),
    (2, 0.0, 1, 1.0, 0, 0.0, ARTICLE, 1),
    (80, 0.0, 0, 0.0, 0, 0.0, ARTICLE, 1),
    # menus and lists of links inside an article, also at its end and before its text goes on
    (1, 1.0, 1, 1.0, 1, 1.0, ARTICLE, 0),
    (2, 1.0, 60, 0.0, 1, 1.0, ARTICLE, 0),
    (4, 1.0, 45, 0.1, 5, 1.0, ARTICLE, 0),
    (5, 1.0, 3, 0.0, 6, 1.0, ARTICLE, 0),
    (3, 1.0, 0, 0.0, 2, 1.0, ARTICLE, 0),
    (2, 1.0, 2, 1.0, 3, 1.0, ARTICLE, 0),
    (6, 1.0, 5, 1.0, 4, 1.0, ARTICLE, 0),
    (9, 1.0, 7, 1.0, 12, 1.0, ARTICLE, 0),
    (3, 1.0, 4, 1.0, 0, 0.0, ARTICLE, 0),
    (7, 1.0, 6, 1.0, 0, 0.0, ARTICLE, 0),
    (2, 1.0, 3, 1.0, 70, 0.0, ARTICLE, 0),
    (4, 1.0, 5, 1.0, 9, 0.0, ARTICLE, 0),
    # a linked heading or paragraph between text, and one linked line alone
    (4, 1.0, 0, 0.0, 60, 0.0, ARTICLE, 1),
    (3, 1.0, 70, 0.0, 1, 0.0, ARTICLE, 1),
    (2, 1.0, 40, 0.0, 0, 0.0, ARTICLE, 1),
    (5, 1.0, 0, 0.0, 0, 0.0, ARTICLE, 1),
    (1, 1.0, 3, 0.0, 30, 0.4, ARTICLE, 1),
    (4, 1.0, 60, 0.1, 50, 0.0, ARTICLE, 1),
    (2, 1.0, 25, 0.4, 40, 0.1, ARTICLE, 1),
    (6, 1.0, 30, 0.3, 0, 0.0, ARTICLE, 1),
    # paragraphs with many links next to a list of links
    (8, 0.6, 40, 0.0, 5, 1.0, ARTICLE, 1),
    (15, 0.5, 30, 0.0, 3, 1.0, ARTICLE, 1),
    (6, 0.7, 3, 1.0, 4, 1.0, ARTICLE, 1),
    # headings and paragraphs right after a linked one
    (4, 0.0, 1, 1.0, 70, 0.0, ARTICLE, 1),
    (5, 0.0, 3, 1.0, 48, 0.0, ARTICLE, 1),
    (6, 0.0, 2, 1.0, 3, 0.0, ARTICLE, 1),
    (7, 0.0, 1, 1.0, 90, 0.02, ARTICLE, 1),
    (5, 0.2, 6, 1.0, 60, 0.0, ARTICLE, 1),
    (4, 0.0, 3, 1.0, 2, 1.0, ARTICLE, 1),
    (7, 0.0, 2, 1.0, 1, 1.0, ARTICLE, 1),
    (5, 0.0, 2, 1.0, 0, 0.0, ARTICLE, 1),
    (5, 0.4, 4, 1.0, 0, 0.0, ARTICLE, 1),
    (12, 1.0, 40, 0.0, 30, 0.0, ARTICLE, 1),
    (30, 0.9, 60, 0.0, 2, 1.0, ARTICLE, 1),
    (8, 0.7, 3, 1.0, 0, 0.0, ARTICLE, 1),
    (50, 0.0, 2, 1.0, 40, 0.0, ARTICLE, 1),
    (60, 0.0, 5, 1.0, 3, 1.0, ARTICLE, 1),
    (3, 0.6, 1, 1.0, 20, 0.0, ARTICLE, 1),
    (90, 0.0, 30, 0.0, 40, 1.0, ARTICLE, 1),
    (15, 0.5, 9, 0.5, 60, 0.6, ARTICLE, 1),
    (5, 0.0, 40, 0.0, 8, 1.0, ARTICLE, 1),
    (6, 0.0, 2, 1.0, 12, 1.0, ARTICLE, 1),
    (4, 0.0, 3, 1.0, 7, 0.9, ARTICLE, 1),
    (2, 0.0, 6, 1.0, 20, 0.8, ARTICLE, 1),
    (6, 0.0, 4, 1.0, 20, 0.8, ARTICLE, 1),
    (5, 0.0, 4, 1.0, 2, 1.0, ARTICLE, 1),
    (3, 0.0, 50, 0.0, 6, 1.0, ARTICLE, 1),
    # pages without marks: menus and link lists
    (1, 1.0, 0, 0.0, 1, 1.0, UNMARKED, 0),
    (2, 1.0, 1, 1.0, 1, 1.0, UNMARKED, 0),
    (3, 1.0, 2, 1.0, 40, 0.0, UNMARKED, 0),
    (12, 0.9, 60, 0.0, 10, 0.8, UNMARKED, 0),
    (25, 0.7, 10, 0.8, 4, 1.0, UNMARKED, 0),
    (6, 0.5, 70, 0.0, 3, 1.0, UNMARKED, 0),
    (3, 1.0, 48, 0.0, 0, 0.0, UNMARKED, 0),
    (5, 1.0, 70, 0.0, 30, 0.0, UNMARKED, 0),
    (5, 0.4, 4, 1.0, 0, 0.0, UNMARKED, 0),
    (4, 0.0, 3, 1.0, 2, 1.0, UNMARKED, 0),
    (7, 0.0, 2, 1.0, 1, 1.0, UNMARKED, 0),
    (5, 0.0, 2, 1.0, 0, 0.0, UNMARKED, 0),
    (6, 0.0, 1, 1.0, 0, 0.0, UNMARKED, 0),
    (4, 0.0, 2, 1.0, 0, 0.0, UNMARKED, 0),
    (7, 0.0, 1, 1.0, 0, 0.0, UNMARKED, 0),
    (7, 0.1, 6, 1.0, 8, 1.0, UNMARKED, 0),
    (4, 0.0, 8, 0.9, 3, 1.0, UNMARKED, 0),
    (5, 0.0, 1, 1.0, 45, 0.6, UNMARKED, 0),
    (6, 0.0, 3, 1.0, 60, 0.9, UNMARKED, 0),
    (4, 0.0, 3, 1.0, 12, 1.0, UNMARKED, 0),
    (5, 0.0, 2, 1.0, 6, 0.9, UNMARKED, 0),
    (6, 0.0, 4, 1.0, 20, 0.8, UNMARKED, 0),
    (8, 1.0, 2, 1.0, 60, 0.0, UNMARKED, 0),
    (15, 0.8, 40, 0.0, 50, 0.0, UNMARKED, 0),
    (30, 0.6, 70, 0.0, 45, 0.1, UNMARKED, 0),
    (10, 0.5, 5, 0.0, 12, 0.0, UNMARKED, 0),
    (40, 0.9, 30, 0.0, 0, 0.0, UNMARKED, 0),
    # pages without marks: headings and paragraphs
    (8, 0.0, 3, 1.0, 60, 0.0, UNMARKED, 1),
    (3, 0.0, 2, 1.0, 48, 0.0, UNMARKED, 1),
    (1, 0.0, 1, 1.0, 90, 0.0, UNMARKED, 1),
    (4, 0.0, 1, 1.0, 70, 0.0, UNMARKED, 1),
    (5, 0.0, 3, 1.0, 48, 0.0, UNMARKED, 1),
    (6, 0.0, 2, 1.0, 3, 0.0, UNMARKED, 1),
    (7, 0.0, 1, 1.0, 90, 0.02, UNMARKED, 1),
    (5, 0.2, 6, 1.0, 60, 0.0, UNMARKED, 1),
    (5, 0.0, 2, 1.0, 1, 0.0, UNMARKED, 1),
    (7, 0.0, 1, 1.0, 2, 0.0, UNMARKED, 1),
    (4, 0.0, 4, 1.0, 5, 0.1, UNMARKED, 1),
    (6, 0.0, 2, 1.0, 8, 0.0, UNMARKED, 1),
    (5, 0.0, 1, 1.0, 12, 0.2, UNMARKED, 1),
    (7, 0.0, 3, 1.0, 20, 0.0, UNMARKED, 1),
    # the last paragraphs of a text, with menus or nothing after them, and short ones between links
    (4, 0.0, 60, 0.0, 2, 1.0, UNMARKED, 1),
    (6, 0.0, 40, 0.0, 1, 1.0, UNMARKED, 1),
    (12, 0.0, 8, 0.0, 3, 1.0, UNMARKED, 1),
    (18, 0.1, 50, 0.1, 5, 0.9, UNMARKED, 1),
    (5, 0.0, 70, 0.0, 0, 0.0, UNMARKED, 1),
    (9, 0.0, 30, 0.2, 0, 0.0, UNMARKED, 1),
    (30, 0.0, 45, 0.0, 0, 0.0, UNMARKED, 1),
    (60, 0.1, 9, 0.0, 2, 1.0, UNMARKED, 1),
    (2, 0.0, 1, 1.0, 2, 1.0, UNMARKED, 1),
    (3, 0.0, 2, 1.0, 0, 0.0, UNMARKED, 1),
    (8, 0.0, 2, 1.0, 3, 1.0, UNMARKED, 1),
    (8, 0.0, 2, 1.0, 0, 0.0, UNMARKED, 1),
    (10, 0.0, 1, 1.0, 0, 0.0, UNMARKED, 1),
    (14, 0.0, 2, 1.0, 1, 1.0, UNMARKED, 1),
    (40, 0.0, 3, 1.0, 0, 0.0, UNMARKED, 1),
    (5, 0.0, 40, 0.0, 8, 1.0, UNMARKED, 1),
    (7, 0.0, 12, 0.0, 20, 0.8, UNMARKED, 1),
    (4, 0.0, 5, 0.1, 6, 1.0, UNMARKED, 1),
    (3, 0.0, 50, 0.0, 6, 1.0, UNMARKED, 1),
    (2, 0.0, 3, 1.0, 12, 1.0, UNMARKED, 1),
    (3, 0.0, 5, 1.0, 7, 0.9, UNMARKED, 1),
    (1, 0.0, 1, 1.0, 20, 0.8, UNMARKED, 1),
    (6, 0.0, 4, 0.0, 2, 1.0, UNMARKED, 1),
    (5, 0.0, 4, 0.0, 0, 0.0, UNMARKED, 1),
    (7, 0.0, 2, 0.0, 1, 1.0, UNMARKED, 1),
    (4, 0.0, 3, 0.1, 0, 0.0, UNMARKED, 1),
    (60, 0.0, 8, 0.0, 90, 0.02, UNMARKED, 1),
    (90, 0.02, 60, 0.0, 15, 0.0, UNMARKED, 1),
    (15, 0.0, 90, 0.02, 70, 0.1, UNMARKED, 1),
    (70, 0.1, 15, 0.0, 25, 0.7, UNMARKED, 1),
    (3, 0.0, 40, 0.0, 50, 0.0, UNMARKED, 1),
    (48, 0.0, 48, 0.0, 3, 1.0, UNMARKED, 1),
    (25, 0.0, 2, 1.0, 2, 1.0, UNMARKED, 1),
    (40, 0.3, 30, 0.0, 20, 0.0, UNMARKED, 1),
    (2, 0.0, 70, 0.0, 5, 0.4, UNMARKED, 1),
    (50, 0.0, 0, 0.0, 0, 0.0, UNMARKED, 1),
    (6, 0.0, 0, 0.0, 0, 0.0, UNMARKED, 1),
)

# (place of the feature, most on the left side, left, right), or the answer
Tree = tuple | int


def grow(rows: Sequence[tuple], depth: int = 12) -> Tree:
    """Decision tree over rows of features and, at the end, 0 or 1, by least Gini impurity."""
    positive = sum(row[-1] for row in rows)
    answer = int(2 * positive >= len(rows))
    if depth == 0 or positive in (0, len(rows)):
        return answer

    def impurity(part: list[tuple]) -> float:
        ones = sum(row[-1] for row in part)
        return 2 * ones * (len(part) - ones) / len(part)

    best, least = None, impurity(list(rows))
    for place in range(len(rows[0]) - 1):
        values = sorted({row[place] for row in rows})
        for low, high in zip(values, values[1:]):
            most = (low + high) / 2
            left = [row for row in rows if row[place] <= most]
            right = [row for row in rows if row[place] > most]
            now = impurity(left) + impurity(right)
            if now < least - 1e-9:
                best, least = (place, most, left, right), now
    if best is None:
        return answer
    place, most, left, right = best
    return place, most, grow(left, depth - 1), grow(right, depth - 1)


def answer_of(tree: Tree, features: Sequence[float]) -> int:
    while isinstance(tree, tuple):
        place, most, left, right = tree
        tree = left if features[place] <= most else right
    return tree


def main_text(page: str | None, tree: Tree) -> str:
    """The blocks that the tree takes for main text, one per line; empty if there are none."""
    cut = [(text, mark, (text.count(" ") + 1, density)) for text, mark, density in blocks(page or "")]
    none = ("", None, (0, 0.0))

    def described(place: int) -> tuple:
        # A block under another mark is no neighbour: a menu says nothing of the title below it.
        _, mark, size = cut[place]
        around = (cut[place - 1] if place else none, cut[place + 1] if place + 1 < len(cut) else none)
        return (*size, *(n for b in around for n in (b[2] if b[1] == mark else none[2])), mark)

    return "\n".join(text for k, (text, _, _) in enumerate(cut) if answer_of(tree, described(k)))


def extract(pages: DataFrame, labelled: Sequence[tuple] = LABELLED) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page, from the whole of its html.

    A NULL or empty page has an empty text. Repeated rows stay; further columns are left out.
    """
    tree = grow(labelled)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(page.as_py(), tree) for page in batch.column(2)]
            columns = [batch.column(0), batch.column(1), pa.array(found, pa.string())]
            columns.append(pa.array([len(t) for t in found], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")
    )
    return rows.mapInArrow(texts, "page_id long, url string, text string, n_chars long")

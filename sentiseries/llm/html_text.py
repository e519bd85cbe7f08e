"""The main text of HTML pages: flat text blocks classified by a decision tree.

A page becomes a list of blocks: the text between tags that start or end a block, with
character references decoded, white space as single spaces, trimmed. Script, style, form
controls and the like give no text. A block is described by its number of words and its
link density (words in links by words), the same of the blocks before and after it, and
by what encloses it, as a few yes-or-no marks read from element names and from the
words of ``class``, ``id`` and ``role``. A decision tree grown from a small table of
labelled blocks (``labelled_blocks``) says which blocks are main text.
The text is those blocks, in order, joined by one space.

Null and empty pages have no text, an empty table gives an empty one, and other columns,
whatever their names, are not touched. Unclosed and misnested tags end with the element
around them; a tag without an end is text. Every page is read once from start to end, in
time in proportion to its length however malformed it is. Pages are taken whole, row by
row, so repeated rows need no special care.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# Names of elements.
_SILENT = frozenset("script style noscript template textarea select option button svg math iframe object canvas audio video head title".split())
_BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = re.compile(r"(script|style|textarea|title|noscript|template|iframe)\b", re.I)
_COMMENT_END = re.compile(r"--!?>")
_NAME_END = re.compile(r"[\s/>]")
_QUOTE_OR_END = re.compile(r"""["'>]""")
_LONG_REFERENCE = re.compile(r"&#(?:([0-9]{20,})|([xX])([0-9a-fA-F]{20,}))")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|style|aria-label)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
# whole words of an attribute, borders of camel case included: "has-sidebar", "pageNoNav", but not "notice"
_LAYOUT = re.compile(
    r"(?<![A-Za-z])(?:has|with|without|no)[-_]\w+"
    r"|(?-i:(?:(?<![A-Za-z])(?:has|with|without|no)|(?<![A-Z])(?:Has|With|Without|No))[A-Z]\w*)", re.I,
)
_WORDS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")

#: Marks of an enclosing element, by its name and by words of its attributes.
MARKS = ("article", "menu", "header", "footer", "side", "advert", "notice", "form", "comment", "hidden")
_BY_NAME = {
    "article": "article", "main": "article", "nav": "menu", "menu": "menu", "header": "header", "footer": "footer",
    "aside": "side", "form": "form", "fieldset": "form", "dialog": "notice",
}
_BY_WORD = {
    "article": "article content post entry story main text body prose".split(),
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs crumbs pagination pager toolbar tabs toc skip".split(),
    "header": "header masthead banner topbar logo branding".split(),
    "footer": "footer foot copyright legal colophon bottom".split(),
    "side": "sidebar side aside widget related recommended recommendations share sharing social popular trending promo teaser teasers more also tags rail".split(),
    "advert": "ad ads adv advert adverts advertisement advertising sponsor sponsored promoted promotion adslot dfp".split(),
    "notice": "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription paywall disclaimer warning contentinfo".split(),
    "form": "form search login signup signin register".split(),
    "comment": "comment comments reply replies discussion disqus respond reader readers".split(),
    "hidden": ["hidden"],
}
_WORD_MARK = {w: MARKS.index(m) for m, ws in _BY_WORD.items() for w in ws}
_NAME_MARK = {n: MARKS.index(m) for n, m in _BY_NAME.items()}
COLUMNS = ("words", "links", "words_before", "links_before", "words_after", "links_after", *MARKS)

# The labelled blocks: every length and link density, among every kind of neighbours, for every part of a page.
_SIZES = (1, 3, 6, 12, 30, 80, 400)
_DENSITIES = (0.0, 0.2, 0.5, 1.0)
_AROUND = ((0, 0.0), (2, 0.0), (2, 1.0), (12, 0.0), (30, 1.0), (60, 0.0), (300, 0.1))
_MAIN = ("article", "article header")
_OTHER = ("menu", "header", "footer", "side", "advert", "notice", "form", "comment", "hidden")
_INSIDE = tuple(f"article {m}" for m in _OTHER if m != "header")


def _text_like(words: int, links: float) -> bool:
    return words >= 10 and links <= 0.4


def labelled_blocks() -> list[tuple]:
    """(words, link density, both before, both after, marks, main text or not).

    A marked part is main text or not as a whole. Without marks, blocks with few links
    are if they, or a neighbour, are long.
    """
    rows = []
    for own, before, after in product(product(_SIZES, _DENSITIES), _AROUND, _AROUND):
        plain = own[1] <= 0.4 and any(_text_like(*x) for x in (own, before, after))
        rows.append((*own, *before, *after, "", int(plain)))
    for own, around in product(product(_SIZES, _DENSITIES), _AROUND):
        rows += [(*own, *around, *around, marks, int(marks in _MAIN)) for marks in _MAIN + _OTHER + _INSIDE]
    return rows


def grow(rows: np.ndarray, labels: np.ndarray) -> tuple | float:
    """A binary tree by Gini impurity: (column, threshold, at most, above), leaves are shares."""
    share = labels.mean()
    if share in (0.0, 1.0):
        return float(share)
    best = None
    for column in range(rows.shape[1]):
        values = np.unique(rows[:, column])
        for threshold in (values[1:] + values[:-1]) / 2:
            low = rows[:, column] <= threshold
            impurity = sum(part.sum() * labels[part].mean() * (1 - labels[part].mean()) for part in (low, ~low))
            if best is None or impurity < best[0] - 1e-12:
                best = impurity, column, float(threshold), low
    if best is None:
        return float(share)
    _, column, threshold, low = best
    return column, threshold, grow(rows[low], labels[low]), grow(rows[~low], labels[~low])


def tree(table: list[tuple] | None = None) -> tuple | float:
    table = table or labelled_blocks()
    rows = np.array([[*r[:6], *(m in r[6].split() for m in MARKS)] for r in table], float)
    return grow(rows, np.array([r[7] for r in table], float))


def is_main(node: tuple | float, block: tuple) -> bool:
    while not isinstance(node, float):
        node = node[2] if block[node[0]] <= node[1] else node[3]
    return node >= 0.5


def marks_of(name: str, attributes: str) -> frozenset[int]:
    """Marks that an element gives to what it encloses."""
    found = {_NAME_MARK[name]} if name in _NAME_MARK else set()
    if attributes and not attributes.isspace() and name not in ("html", "body"):
        for m in _ATTRIBUTE.finditer(attributes):
            value = m[2] or m[3] or m[4] or ""
            key = m[1].lower()
            if key == "style":
                if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                    found.add(MARKS.index("hidden"))
            elif key == "hidden":
                found.add(MARKS.index("hidden"))
            else:
                found.update(_WORD_MARK[w] for w in (x.lower() for x in _WORDS.findall(_LAYOUT.sub("", value))) if w in _WORD_MARK)
    # what is named for the article as well as for another part is that part ("article-footer")
    own = MARKS.index("article")
    return frozenset(found - {own} if len(found) > 1 else found)


def decoded(text: str) -> str:
    """Character references decoded; long numbers are cut to digits that still name no character."""
    short = _LONG_REFERENCE.sub(lambda m: f"&#{m[2] or ''}{(m[1] or m[3]).lstrip('0')[:12] or 0}", text)
    return html.unescape(short)


class Tags:
    """The tags of a page, in order.

    A tag ends at the first ``>`` outside quotes. Where that is depends only on the first
    quote or ``>`` after its name, so it is kept by that place and nothing is searched twice.
    """

    def __init__(self, page: str):
        self.page = page
        self.ends: dict[int, int] = {}
        self.name_end = self.first = -1

    def _place(self, pattern: re.Pattern, at: int) -> int:
        found = pattern.search(self.page, at)
        return found.start() if found else len(self.page)

    def _end(self, at: int) -> int:
        """Where the first ``>`` outside quotes is, from the quote or ``>`` at ``at``; the page's length if nowhere."""
        passed = []
        while at < len(self.page) and self.page[at] != ">" and at not in self.ends:
            passed.append(at)
            closing = self.page.find(self.page[at], at + 1)
            at = self._place(_QUOTE_OR_END, closing + 1) if closing >= 0 else len(self.page)
        end = self.ends.get(at, at)
        self.ends.update(dict.fromkeys(passed, end))
        return end

    def next(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """(start, end, closing, name, attributes) of the next tag; comments and the like have no name."""
        page, start = self.page, at
        while (start := page.find("<", start)) >= 0:
            if page.startswith("<!--", start):
                found = _COMMENT_END.search(page, start + 4)
                return start, found.end() if found else len(page), False, "", ""
            closing = page.startswith("/", start + 1)
            name = start + 1 + closing
            if page[name : name + 1].isascii() and page[name : name + 1].isalpha():
                if self.name_end < name:
                    self.name_end = self._place(_NAME_END, name)
                if self.first < self.name_end:
                    self.first = self._place(_QUOTE_OR_END, self.name_end)
                end = self._end(self.first)
                if end < len(page):
                    return start, end + 1, closing, page[name : self.name_end].lower(), page[self.name_end : end]
            if page[start + 1 : start + 2] in ("!", "?", "/"):
                end = page.find(">", start + 1)
                return start, end + 1 if end >= 0 else len(page), False, "", ""
            start += 1
        return None


def raw_end(page: str, name: str, at: int) -> int:
    """Where the end tag of a script or the like ends; the page's length if nowhere."""
    found = re.compile(rf"</{name}\b", re.I).search(page, at)
    return page.find(">", found.end()) + 1 or len(page) if found else len(page)


def blocks(page: str | None) -> list[tuple[str, int, int, frozenset[int]]]:
    """(text, words, words in links, marks) of the page's non-empty blocks, in order."""
    page = page or ""
    out: list[tuple[str, int, int, frozenset[int]]] = []
    stack: list[tuple[str, frozenset[int]]] = []
    marks: frozenset[int] = frozenset()
    pieces: list[str] = []
    linked: list[str] = []
    links = silent = 0

    def flush() -> None:
        text = " ".join(decoded("".join(pieces)).split())
        if text:
            out.append((text, text.count(" ") + 1, min(len(decoded(" ".join(linked)).split()), text.count(" ") + 1), marks))
        pieces.clear()
        linked.clear()

    tags, opened, at = Tags(page), Counter(), 0
    while True:
        tag = tags.next(at)
        chunk = page[at : tag[0] if tag else len(page)]
        if chunk and not silent:
            pieces.append(chunk)
            if links:
                linked.append(chunk)
        if not tag:
            break
        _, at, closing, name, attributes = tag
        if not name:
            continue
        if name in _BLOCKS and pieces:
            flush()
        if closing:
            while opened[name] > 0:
                n, _ = stack.pop()
                opened[n] -= 1
                links -= n == "a"
                silent -= n in _SILENT
                marks = stack[-1][1] if stack else frozenset()
                if n == name:
                    break
            continue
        if name in _VOID or attributes.endswith("/") and name not in _BLOCKS:
            continue
        if _RAW.fullmatch(name):
            at = raw_end(page, name, at)
            continue
        if name in ("p", "li") and stack and stack[-1][0] == name:
            stack.pop()
            opened[name] -= 1
            marks = stack[-1][1] if stack else frozenset()
        marks = marks | marks_of(name, attributes)
        stack.append((name, marks))
        opened[name] += 1
        links += name == "a"
        silent += name in _SILENT
    flush()
    return out


def main_text(page: str | None, node: tuple | float) -> str:
    found = blocks(page)
    sizes = [(0, 0.0), *((n, k / n) for _, n, k, _ in found), (0, 0.0)]
    kept = []
    for i, (text, _, _, marks) in enumerate(found):
        described = (*sizes[i + 1], *sizes[i], *sizes[i + 2], *(j in marks for j in range(len(MARKS))))
        if is_main(node, described):
            kept.append(text)
    return " ".join(kept)


def extract(page: Column | str) -> Column:
    """The main text, an empty string if there is none."""
    node = tree()

    @F.pandas_udf(T.StringType())
    def texts(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in pages:
            yield pd.Series([main_text(p, node) for p in batch], dtype=object)

    return texts(page)

"""Main text of web pages by tree scoring.

A page becomes a tree of its elements. Every block of text passes points for its length
and commas to its parent, half of them to the grandparent, and less further up; an
element's points are discounted by the share of its text that stands in links. The
element with most points, or the article it stands in, is the container; siblings that
read like text are kept with it. What its name or its class marks as menu, header, footer,
sidebar, notice, advert, form or comments passes no points. Outside the container any such
word of a class leaves an element out, and so do lists made of links; inside it only an
element of such a kind does, or a class that as a whole names one (``comment-list``, but
not ``related-work``).

Defined cases: a null, empty or text-free page gives an empty text; unclosed, crossed and
cut-off tags are closed where the next block or the page ends; a page without any tag is
one block. Text without a paragraph counts by its length. A page that has no container
smaller than its body is judged as outside one. Time grows with the length of a page,
however its tags are nested. Repeated rows give equal rows.
Only ``page_id, url, html`` are read.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docindex.llm.common import ship, slices

BATCH_TEXT = 8 << 20
EXTRACTED = "page_id long, url string, text string, n_chars long"

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|template|iframe|svg|math|textarea|select|title|object|canvas|audio|video)\b(?:\"[^\"]*\"|'[^']*'|[^'\"<>])*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\"<>])*)>"
    r"|</?[a-zA-Z][^<>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
NAMED = re.compile(r"""\b(class|id|role|hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
WORD = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var wbr img".split()
)
#: Elements that are never main text, and words that mark one in a class, id or role.
DROPPED = frozenset("nav header footer aside form button menu dialog fieldset head".split())
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice notices alert "
    "popup modal overlay sidebar sidebars nav navbar navigation menu menus breadcrumb breadcrumbs footer header masthead comment comments "
    "disqus reply replies respond share sharing social related recommended newsletter subscribe subscription signup login search widget "
    "pagination pager toolbar skip complementary contentinfo navigation".split()
)
#: Inside the container, a class token of these words, and of such words of layout after them, marks an element.
KINDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent notice notices popup sidebar "
    "sidebars nav navbar navigation menu menus breadcrumb breadcrumbs footer header masthead comment comments disqus replies newsletter "
    "pagination pager toolbar complementary contentinfo".split()
)
LAYOUT = frozenset("area bar block body box container content form item items list section slot thread unit wrap wrapper".split())
#: What a page has as its whole; the article is no wider.
WHOLE = frozenset("#page html body".split())
#: Words that take a mark back ("with-sidebar"), and those that make a header the article's own.
UNMARKS = frozenset("with has no without".split())
OWN = frozenset("article entry post story title".split())
#: What closes an open element of the same or a listed kind.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LISTS = frozenset("ul ol dl table div section".split())
LEVELS = 6


class Page:
    """The elements of a page in order, parents first, and its blocks of text."""

    def __init__(self, source: str) -> None:
        self.tags, self.parents, self.marked, self.barred = ["#page"], [-1], [False], [False]
        self.chars, self.linked, self.points = [0], [0], [0.0]
        self.blocks: list[tuple[int, str]] = []
        self._open = [0]
        #: Places among the open elements: by name, and of those that are no inline ones.
        self._places: defaultdict[str, list[int]] = defaultdict(list)
        self._solid = [0]
        self._pieces: list[str] = []
        self._link: list[str] = []
        self._read(source)

    def _read(self, source: str) -> None:
        at = 0
        for m in MARKUP.finditer(source):
            if m.start() > at:
                self._text(source[at : m.start()])
            at = m.end()
            if m[3]:
                tag = m[3].lower()
                if m[2]:
                    self._end(tag)
                else:
                    self._start(tag, m[4])
            elif m[1] is None and m[0][1:2].isalpha():
                self._start(re.match(r"<([^\s/<>]+)", m[0])[1].lower(), "")
        self._text(source[at:])
        self._flush()

    def _text(self, text: str) -> None:
        self._pieces.append(text)
        if any(self.tags[k] == "a" for k in self._open[-3:]):
            self._link.append(text)

    def _flush(self) -> None:
        """End a block: it belongs to the innermost element that is no inline one."""
        text = " ".join(html.unescape("".join(self._pieces)).split())
        if text:
            k = self._open[self._solid[-1]]
            if not self.barred[k]:
                self.blocks.append((k, text))
            if not self.marked[k]:
                link = len(" ".join(html.unescape("".join(self._link)).split()))
                self.chars[k] += len(text)
                self.linked[k] += min(link, len(text))
                self._award(k, text, link)
        self._pieces, self._link = [], []

    def _award(self, k: int, text: str, link: int) -> None:
        points = min(len(text) / 25, 1) + text.count(",") + min(len(text) / 100, 3)
        points *= 1 - min(link / len(text), 1)
        if self.tags[k] != "p":
            self.points[k] += points / 2
        share = 1.0
        for level in range(LEVELS):
            k = self.parents[k]
            if k < 0:
                break
            self.points[k] += points * share
            share = 0.5 if not level else share / 2

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "br" or tag == "wbr":
            self._pieces.append(" " if tag == "br" else "")
            return
        if tag not in INLINE:
            self._flush()
            self._close_implied(tag)
        if tag in VOID:
            return
        parent = self._open[-1]
        marked, barred = self._unwanted(tag, attributes)
        self.tags.append(tag)
        self.parents.append(parent)
        self.marked.append(self.marked[parent] or marked)
        self.barred.append(self.barred[parent] or barred)
        self.chars.append(0)
        self.linked.append(0)
        self.points.append(0.0)
        place = len(self._open)
        self._open.append(len(self.tags) - 1)
        self._places[tag].append(place)
        if tag not in INLINE:
            self._solid.append(place)
            if attributes.endswith("/"):
                self._cut(place)

    def _cut(self, place: int) -> None:
        """Close the open elements from ``place`` on."""
        while len(self._open) > place:
            tag = self.tags[self._open.pop()]
            self._places[tag].pop()
            if tag not in INLINE:
                self._solid.pop()

    def _unwanted(self, tag: str, attributes: str) -> tuple[bool, bool]:
        """Whether an element is left out outside the container, and inside it."""
        if tag in DROPPED:
            return True, True
        if not attributes or tag in ("html", "body", "main"):
            return tag == "noscript", False
        words: set[str] = set()
        named = False
        for name, a, b, c in NAMED.findall(attributes):
            name, value = name.lower(), (a or b or c).lower()
            if name == "hidden" or name == "style" and "display:none" in value.replace(" ", ""):
                return (True, True) if tag != "article" else (False, False)
            if name in ("class", "id", "role"):
                words.update(WORD.findall(value))
                named = named or any(_names_kind(token) for token in value.split())
        if tag == "article":
            # An article within another one may be a reader's comment.
            named = named and bool(self._places["article"] or self._places["main"])
            return named, named
        marks = words & MARKS
        return named or tag == "noscript" or bool(marks) and not words & UNMARKS and not (marks == {"header"} and words & OWN), named

    def _close_implied(self, tag: str) -> None:
        ends = CLOSES.get(tag, ())
        while place := self._solid[-1]:
            name = self.tags[self._open[place]]
            if name != "p" and name not in ends:
                return
            self._cut(place)
            if name in ends and tag != "tr":
                return

    def _end(self, tag: str) -> None:
        if tag not in INLINE:
            self._flush()
        places = self._places[tag]
        # An inline end does not close a block.
        if places and (tag not in INLINE or places[-1] > self._solid[-1]):
            self._cut(places[-1])

    def main_text(self) -> str:
        if not self.blocks:
            return ""
        n = len(self.tags)
        chars, linked = self.chars[:], self.linked[:]
        for k in range(n - 1, 0, -1):
            chars[self.parents[k]] += chars[k]
            linked[self.parents[k]] += linked[k]
        density = [l / c if c else 1.0 for l, c in zip(linked, chars)]
        score = [p * (1 - d) for p, d in zip(self.points, density)]
        top = max(range(n), key=lambda k: (score[k], -k))
        k = top
        while k > 0 and self.tags[k] not in ("article", "main"):
            k = self.parents[k]
        top = k or top
        kept, inside = [False] * n, [False] * n
        inside[top] = self.tags[top] not in WHOLE
        for k in range(n):
            if k == top or k and self.parents[k] == self.parents[top] and self._reads_like_text(k, chars[k], density[k], score[k], score[top]):
                kept[k] = True
            elif k and kept[self.parents[k]]:
                inside[k] = inside[self.parents[k]]
                # Lists made of links are menus, but for those of the article itself.
                kept[k] = not self.barred[k] if inside[k] else not (self.marked[k] or self.tags[k] in LISTS and density[k] > 0.5)
        return "\n".join(text for k, text in self.blocks if kept[k])

    def _reads_like_text(self, k: int, chars: int, density: float, score: float, best: float) -> bool:
        if self.marked[k]:
            return False
        return score >= max(10.0, best / 5) or self.tags[k] in ("p", "h1", "h2", "h3", "blockquote", "pre") and chars > 80 and density < 0.25


def _names_kind(token: str) -> bool:
    words = WORD.findall(token)
    kinds = next((k for k, word in enumerate(words) if word not in KINDS), len(words))
    return kinds > 0 and all(word in LAYOUT for word in words[kinds:])


def main_text(source: str | None) -> str:
    """The page's main text.

    >>> main_text("<nav><a href=x>Home</a></nav><div><p>One,  two &amp;\\nthree.<p>Four</div><footer>End</footer>")
    'One, two & three.\\nFour'
    """
    return Page(source).main_text() if source else ""


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html", BATCH_TEXT):
        texts = [main_text(source) for source in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    ship(pages.sparkSession)
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(_extracted, EXTRACTED)

"""Main text of web pages.

The standard library's parser streams events; each block element gives a line of text with the number of tags and
link characters in it. A line's ratio is its text outside links per tag. Names and class words that tell of menus,
headers, footers, sidebars, notices, adverts, forms or comments turn the ratio of the lines inside negative; nothing
else is decided by them. The ratios are smoothed with a Gaussian, and the threshold on the smoothed ratios, their standard
deviation, sorts lines into three clusters:

* content: the smoothed ratio reaches the threshold and the line's own a tenth of it, so that a short note beside a long
  paragraph is not taken for a part of it;
* outside: the own ratio is negative, or the line is one of several neighbours that are links alone and under the threshold;
* between: short lines, headings, single links. They go with the region they stand in.

The region covers all content lines: every innermost `article` or `main` element that holds some, and the lowest element
that holds the others with their neighbours. The text is every line of the region that is not outside.

Defined results: null and empty pages have no text; broken markup is read as far as it goes; pages of any
length are fed in slices and read whole, in time and memory in proportion to their tags and text however deep they nest; rows
repeat as they come; a result column replaces an input column of its name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from .frames import Inner, add_columns

SLICE = 1 << 16
SIGMA = 1.0
OWN = 0.1  # of the threshold
MENU = 3  # so many neighbouring lines of links alone are a menu
CONTENT, BETWEEN, OUTSIDE = 2, 1, 0

# HTML element names.
BLOCK = set("""address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead
tr ul""".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = set("script style noscript template head title svg math iframe object textarea select button datalist audio video canvas".split())
APART = set("nav header footer aside form dialog menu".split())
ARTICLE = ("article", "main")
ENDS_ARTICLE = (*ARTICLE, "body", "html")
ONE_OF_A_KIND = ("li", "dd", "dt", "td", "th", "tr", "option")
HOLDS_BLOCKS = ("ul", "ol", "table", "article", "main", "section", "div", "blockquote", "body")
CLOSES_P = BLOCK - {"option", "body", "html"}
# Words in a class, id or role that mark what is not the article.
ASIDE_WORDS = set("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary
consent contentinfo cookie cookies dialog disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices
popup promo related replies reply respond search share sharing sidebar skip social sponsor sponsored subscribe toolbar widget""".split())
EXEMPT = {"html", "body", "main", "article"}
PIECES = re.compile(r"[^a-z]+")
OPEN_COMMENT = re.compile(r"<!--[^<>]*>?")


@dataclass
class Line:
    text: str
    tags: int
    linked: int
    element: int  # the innermost one
    block: int  # the innermost block element


@dataclass
class Element:
    """An element of the page; what holds for all inside it is handed down when it opens."""

    tag: str
    parent: int
    block: int
    article: int  # the innermost article or main element, 0 outside of any
    silent: bool
    apart: bool
    link: bool


@dataclass
class Page:
    """Element 0 stands for the page itself; elements come after the ones they lie in."""

    lines: list[Line] = field(default_factory=list)
    elements: list[Element] = field(default_factory=lambda: [Element("", 0, 0, 0, False, False, False)])


def marked_apart(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> bool:
    if tag in APART and not (tag == "header" and in_article):
        return True
    if tag in EXEMPT:
        return False
    for name, value in attrs:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and value and "display:none" in value.replace(" ", "").lower():
            return True
        if name in ("class", "id", "role") and value:
            for word in value.lower().split():
                pieces = [p for p in PIECES.split(word) if p]
                if pieces and (pieces[0] in ASIDE_WORDS or pieces[-1] in ASIDE_WORDS):
                    return True
    return False


class Reader(HTMLParser):
    """Turns parser events into lines. Of every tag name the depths where it is open are known, so no step walks the nesting."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.page = Page()
        self.open = [0]
        self.depths: dict[str, list[int]] = {}
        self.parts: list[str] = []
        self.tags = self.linked = 0

    @property
    def inner(self) -> Element:
        return self.page.elements[self.open[-1]]

    def deepest(self, tags: tuple[str, ...]) -> int:
        """Depth of the innermost open element of these names, 0 when there is none."""
        return max((d[-1] for d in map(self.depths.get, tags) if d), default=0)

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.page.lines.append(Line(text, self.tags, self.linked, self.open[-1], self.inner.block))
        self.parts, self.tags, self.linked = [], 0, 0

    def shut(self, depth: int) -> None:
        """Close the element at this depth and all it holds."""
        closing = [self.page.elements[n] for n in self.open[depth:]]
        if any(e.tag in BLOCK for e in closing):
            self.flush()
        for e in closing:
            self.depths[e.tag].pop()
        del self.open[depth:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID:
            if tag == "hr":
                self.flush()
            else:
                self.parts.append(" ")
            self.tags += 1
            return
        if tag in CLOSES_P or tag == "body":
            self.leave(tag)
        if tag in BLOCK:
            self.flush()
        outer, number = self.inner, len(self.page.elements)
        self.page.elements.append(Element(
            tag, self.open[-1], number if tag in BLOCK else outer.block, number if tag in ARTICLE else outer.article,
            outer.silent or tag in SILENT, outer.apart or marked_apart(tag, attrs, outer.article > 0), outer.link or tag == "a",
        ))
        self.depths.setdefault(tag, []).append(len(self.open))
        self.open.append(number)
        self.tags += 1

    def leave(self, tag: str) -> None:
        """End what the start of a block element ends: an open paragraph, a list item or cell of the same kind, the head,
        and, for an article, menus and the like that were left open."""
        ends = ("p", "head") + ((tag,) if tag in ONE_OF_A_KIND else ())
        if tag in ARTICLE:
            depth, limit = self.deepest((*ends, "nav", "header", "aside")), 0
        else:
            depth, limit = self.deepest(ends), self.deepest(HOLDS_BLOCKS)
        if depth > limit:
            self.shut(depth)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        depth = self.deepest((tag,))
        # a stray end tag does not reach beyond the article
        if depth and (tag in ENDS_ARTICLE or depth > self.deepest(("article", "main", "body"))):
            self.shut(depth)

    def handle_data(self, data: str) -> None:
        if not self.inner.silent:
            self.parts.append(data)
            if self.inner.link:
                self.linked += len(data)


def read_page(html: str) -> Page:
    reader = Reader()
    for at in range(0, len(html), SLICE):
        reader.feed(html[at : at + SLICE])
    while reader.rawdata.startswith("<!--"):  # a comment that nothing ends is no text; what follows its words is read
        reader.rawdata = OPEN_COMMENT.sub("", reader.rawdata, count=1)
        reader.feed("")
    reader.close()
    reader.flush()
    return reader.page


def smooth(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; beyond the ends the outermost values go on."""
    reach = max(1, int(np.ceil(3 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    padded = np.concatenate([np.full(reach, values[0]), values, np.full(reach, values[-1])])
    return np.convolve(padded, kernel / kernel.sum(), "valid")


def ratios(page: Page) -> np.ndarray:
    """Characters outside links per tag; negative for lines whose surroundings tell that they are not the article."""
    return np.array([
        (-len(x.text) if page.elements[x.element].apart else max(len(x.text) - x.linked, 0)) / max(x.tags, 1) for x in page.lines
    ])


def cluster(page: Page) -> np.ndarray:
    """The cluster of every line, by the threshold on the smoothed ratios."""
    ratio = ratios(page)
    level = smooth(ratio)
    threshold = level.std()
    high = level >= threshold
    found = np.where(ratio < 0, OUTSIDE, np.where(high & (ratio > 0) & (ratio >= OWN * threshold), CONTENT, BETWEEN))
    links = (ratio == 0) & ~high
    edges = np.flatnonzero(np.diff(np.r_[False, links, False]))
    for begin, end in zip(edges[::2], edges[1::2]):
        if end - begin >= MENU:
            found[begin:end] = OUTSIDE
    if not (found == CONTENT).any():
        found[found == BETWEEN] = CONTENT
    return found


def regions(page: Page, content: np.ndarray) -> np.ndarray:
    """Which elements lie in the region that covers all content lines."""
    elements = page.elements
    held, chosen, inside = (np.zeros(len(elements), np.int64) for _ in range(3))
    for x in page.lines:
        held[x.element] += 1
    for n in range(len(elements) - 1, 0, -1):
        held[elements[n].parent] += held[n]
    loose = 0
    for x in (x for x, c in zip(page.lines, content) if c):
        article = elements[x.element].article
        if article:
            inside[article] = 1
        else:  # an element that holds this line only is the line itself
            chosen[elements[x.block].parent if held[x.block] == 1 else x.block] += 1
            loose += 1
    if loose:
        for n in range(len(elements) - 1, 0, -1):
            chosen[elements[n].parent] += chosen[n]
        inside[np.flatnonzero(chosen == loose)[-1]] = 1  # the innermost: elements come after the ones they lie in
    for n in range(1, len(elements)):
        inside[n] |= inside[elements[n].parent]
    return inside


def main_lines(page: Page) -> list[str]:
    if not page.lines:
        return []
    found = cluster(page)
    inside = regions(page, found == CONTENT)
    return [x.text for x, c in zip(page.lines, found) if c != OUTSIDE and inside[x.element]]


def main_text(html: str | None) -> str:
    return "\n".join(main_lines(read_page(html))) if html else ""


def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """The input with `text` and `n_chars` (code points)."""
    inner = Inner(pages)

    def step(column: pa.Array) -> list[pa.Array]:
        texts = [main_text(x.as_py()) for x in column]
        return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

    fields = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    rows = add_columns(inner.df.withColumn("_html", inner.text(html)), "_html", fields, step)
    return inner.with_results(rows.drop("_html"), ["text", "n_chars"])

"""Main text of web pages, from streamed parser events.

A page becomes *lines*, one per block of text.  A line's ratio is its text over the tags around it, text
of links not counting; lines of menus, adverts, forms and the like count as empty.  Ratios are smoothed
with a Gaussian over neighbouring lines and split into two clusters; the upper one marks content.  A
region, that is the article a line belongs to or else the division around it, is kept if it holds
content, and so are the short paragraphs and headings in it.  Where articles hold content, other regions
go.  Within a region that is kept, two kinds of line in the lower cluster go: runs of lines that are nothing
but links, and divisions of their own that hold no line of the upper cluster and whose ratio stays below
``THIN`` of the threshold before any smoothing.

Null and empty pages, and pages without any content, give the empty string.  Broken markup never fails:
declarations the standard library's parser knows nothing about are read as comments, and open elements
end with the one around them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import groupby
from math import exp
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from chartmill.llm.base import shielded

SIGMA = 1.0
RADIUS = 3
KERNEL = [exp(-((k / SIGMA) ** 2) / 2) for k in range(-RADIUS, RADIUS + 1)]

# Share of the threshold a division inside an article must reach to stay without a line of content.
THIN = 0.25
# Lines of links alone that make a list of links.
LINKS = 3

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
SPACED = frozenset("br td th option".split())
BOILERPLATE = frozenset(
    "aside button canvas datalist dialog fieldset footer form head iframe input label math menu nav noscript object script "
    "select style svg template textarea title".split()
)
ARTICLE = frozenset(["article", "main"])
REGION = frozenset(["body", "div", "section", "td", "table", "blockquote"])
# Inside an article these may be something of their own.
DIVISION = frozenset(["div", "section", "table"])
# A new one of these ends an open one of the same kind.
SELF_ENDING = {"p": BLOCK - {"p"}, "li": frozenset(["ul", "ol", "menu"]), "dt": frozenset(["dl"]), "dd": frozenset(["dl"]), "tr": frozenset(["table"])}
WORDS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies copyright disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter "
    "notice notices outbrain pager pagination popup promo promoted promotion related recommended respond search share sharing "
    "sidebar signup skip social sponsor sponsored subscribe taboola toolbar topbar widget".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
_SPLIT = re.compile(r"[^a-z]+")
# A class such as "has-sidebar" speaks of what is beside the element.
BESIDE = frozenset(["has", "with", "no", "without", "after", "before"])
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")


def is_boilerplate(tag: str, attributes: list[tuple[str, str | None]], inside: str | None) -> bool:
    """Whether an element's kind, or its own attributes, mark it as not part of the text."""
    if tag in BOILERPLATE or (tag == "header" and not inside):
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    for name, value in attributes:
        if name in ("class", "id"):
            words = _SPLIT.split(_HUMP.sub("-", value).lower()) if value else []
            if any(w in WORDS and not (inside and w == "header") and before not in BESIDE for before, w in zip(["", *words], words)):
                return True
        elif name == "role":
            if value and value.lower() in ROLES:
                return True
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        elif name == "style" and value and "display:none" in value.replace(" ", "").lower():
            return True
    return False


# What lies around text outside all elements.
OUTSIDE = ("", False, 0, None, 0)


class Line(NamedTuple):
    text: str  # empty where boilerplate
    tags: int
    region: int
    article: bool
    division: int
    plain: int  # letters outside links


class Lines(HTMLParser):
    """Collects a :class:`Line` for each block of a page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        # Tag, boilerplate, region, article around, division inside the article.
        self.open: list[tuple[str, bool, int, str | None, int]] = []
        self.text: list[str] = []
        self.linked = self.anchors = 0
        self.tags = 0
        self.regions = 0

    def flush(self) -> None:
        text = " ".join("".join(self.text).split()) if self.text else ""
        self.text = []
        if text:
            _, hidden, region, article, division = self.open[-1] if self.open else OUTSIDE
            shown = "" if hidden else text
            plain = len(shown) if not self.linked else max(0, sum(map(str.isalnum, shown)) - self.linked)
            self.lines.append(Line(shown, self.tags + 1, region, article is not None, division, plain))
            self.tags = 0
        self.linked = 0

    def close_to(self, at: int) -> None:
        if any(tag in BLOCK for tag, *_ in self.open[at:]) or self.open[at][1] != (at > 0 and self.open[at - 1][1]):
            self.flush()
        self.anchors -= sum(tag == "a" for tag, *_ in self.open[at:])
        del self.open[at:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in SELF_ENDING:
            for at in range(len(self.open) - 1, -1, -1):
                if self.open[at][0] == tag:
                    self.close_to(at)
                    break
                if self.open[at][0] in SELF_ENDING[tag]:
                    break
        elif tag in BLOCK:
            for at in range(len(self.open) - 1, -1, -1):
                if self.open[at][0] == "p":
                    self.close_to(at)
                    break
                if self.open[at][0] in BLOCK:
                    break
        _, hidden, region, article, division = self.open[-1] if self.open else OUTSIDE
        out = hidden or is_boilerplate(tag, attrs, article)
        if tag in BLOCK or out != hidden:
            self.flush()
        elif tag in SPACED:
            self.text.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        if tag in ARTICLE and article is None:
            article = tag
            self.regions += 1
            region = self.regions
        elif article is None and tag in REGION:
            self.regions += 1
            region = self.regions
        elif tag in DIVISION:
            self.regions += 1
            division = self.regions
        self.anchors += tag == "a"
        self.open.append((tag, out, region, article, division))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open and self.open[-1][0] == tag and tag not in BLOCK:
            self.open.pop()

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in SPACED:
            self.text.append(" ")
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                self.close_to(at)
                return

    def parse_marked_section(self, i: int, report: bool = True) -> int:
        """``<![...>`` is a comment: the library gives up on most of them."""
        return self.parse_bogus_comment(i, report)

    def handle_data(self, data: str) -> None:
        if not self.open or not self.open[-1][1]:
            self.text.append(data)
            if self.anchors:
                self.linked += sum(map(str.isalnum, data))
        elif not data.isspace():
            self.text.append("-")  # its place in the page counts, its words do not


def smoothed(ratios: list[float]) -> list[float]:
    n, out = len(ratios), []
    for i in range(n):
        total = weight = 0.0
        for k in range(max(-RADIUS, -i), min(RADIUS, n - 1 - i) + 1):
            total += KERNEL[k + RADIUS] * ratios[i + k]
            weight += KERNEL[k + RADIUS]
        out.append(total / weight)
    return out


def threshold(values: list[float]) -> float:
    """The border between two clusters: halfway between their means, until it no longer moves."""
    low, high = min(values), max(values)
    border = (low + high) / 2
    while True:
        upper = [v for v in values if v >= border]
        lower = [v for v in values if v < border]
        if not lower:
            return border
        new = (sum(upper) / len(upper) + sum(lower) / len(lower)) / 2
        if abs(new - border) <= 1e-9 * max(1.0, high):
            return min(new, max(upper))
        border = min(new, high)


def main_text(html: str | None) -> str:
    """The blocks of the content regions, in page order, one per line."""
    if not isinstance(html, str) or not html:
        return ""
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    lines = parser.lines
    if not any(line.text for line in lines):
        return ""
    own = [line.plain / line.tags for line in lines]
    scores = smoothed(own)
    border = threshold([s for s, line in zip(scores, lines) if line.text])
    high = [s >= border for s in scores]
    content = [line for line, above in zip(lines, high) if above and line.text]
    articles = any(line.article for line in content)
    kept = {line.region for line in content if line.article or not articles}
    rich = {line.division for line in content}
    thick = {line.division for line, ratio in zip(lines, own) if ratio >= THIN * border} | rich
    links = link_lists([bool(line.text) and not line.plain and not above for line, above in zip(lines, high)])
    return "\n".join([
        line.text for line, linked in zip(lines, links)
        if line.text and line.region in kept and not linked and (not line.division or line.division in thick)
    ])


def link_lists(alone: list[bool]) -> list[bool]:
    """Which lines belong to a run of at least ``LINKS`` lines of links alone."""
    out: list[bool] = []
    for same, run in groupby(alone):
        n = len(list(run))
        out += [same and n >= LINKS] * n
    return out


@shielded("html", adds=("out",))
def extract(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """Add ``out``, the main text of ``html``.  All other columns pass unchanged."""

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(page) for page in batch], dtype=object)

    return pages.withColumn(out, texts(F.col(html)))

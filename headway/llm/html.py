"""Main text of web pages by text-to-tag ratios.

The standard library's parser gives a stream of events; each run of text between
block-level tags is a line, with the number of tags around and within it.  The
lines' text-to-tag ratios are smoothed with a Gaussian, and a threshold between
two clusters of the smoothed ratios marks the content lines.  The content region
is the articles that hold most of the marked text, or else the innermost element
that holds all of it and can be an article, with the heading before it; every
line in it counts, but for those in elements that are not the article's (menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles, comments).  Readers'
comments are known by what they are called and where they stand, not by their weight.
The work on a page grows with its length, however deep it is nested.
"""

from __future__ import annotations

import re
from collections.abc import Container, Iterable, Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters given to the parser at a time.
FEED_CHARS = 1 << 20
#: Width of the smoothing, in lines.
SIGMA = 1.5
#: Text-to-tag ratio of a paragraph of some 160 characters.
PARAGRAPH = 80

# Fixed values of HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
#: Elements without any text of the page, and elements that are not the article's.
_SILENT = frozenset("script style noscript template head title svg math iframe object select textarea button datalist".split())
_OTHER = frozenset("nav footer aside form dialog menu".split())
_OTHER_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar".split())
_OTHER_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion promoted banner cookie "
    "cookies consent gdpr notice notices notification alert popup modal overlay nav navbar navigation menu submenu breadcrumb "
    "breadcrumbs sidebar sidenav footer topbar toolbar masthead share sharing social related recommended recommendations newsletter subscribe subscription signup login pagination pager "
    "widget skip".split()
)
#: Words that may stand beside such a name in a class or id; any other word makes it the name of something else.
_BESIDE = frozenset(
    "site page main global left right top bottom primary secondary box bar list item items link links button buttons icon icons "
    "wrap wrapper container inner outer area block section slot unit form post posts article articles".split()
)
#: The same for readers' comments.
_COMMENT_NAMES = frozenset("comment comments commentlist disqus respond replies".split())
_COMMENT_BESIDE = _BESIDE | frozenset(
    "user users reader readers visitor visitors guest guests public all new latest recent thread threads feed body text content "
    "author meta reply count".split()
)
#: What an author or a date is called.
_SIGNED = frozenset("author byline user username date datetime datepublished datecreated timestamp published posted".split())
#: Text-to-tag ratio from which a line is text and not a menu's.
TEXT = 40
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that may stand in the head; any other ends it.
_IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
#: Elements that the names say nothing of; comments may be articles.
_NEVER_COMMENTS = frozenset(["html", "body", "main"]) | _HEADINGS
_UNNAMED = _NEVER_COMMENTS | {"article"}
_ARTICLE = frozenset(["article", "main"])
#: Parts of an article, which are never all of it.
_PARTS = _HEADINGS | frozenset(
    "pre blockquote ul ol dl table thead tbody tfoot caption section figure figcaption details summary address fieldset hgroup header".split()
)
# a start tag of these ends an open element of the same group
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_LISTS = ("ul", "ol", "dl", "table", "select")
_NAME = re.compile("[a-z]+")
_COMMENT_END = re.compile("--!?>")


def _is_other(tag: str, attrs: list, in_article: bool) -> bool:
    if tag in _OTHER or tag == "header" and not in_article:
        return True
    for key, value in attrs:
        if key == "hidden":
            return True
        if not value:
            continue
        value = value.lower()
        if key == "role":
            if value in _OTHER_ROLES:
                return True
        elif key == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def _has_name(attrs: list, names: frozenset, beside: frozenset) -> bool:
    """Is a whole class or id made of words of ``names``, with or without those of ``beside``?"""
    for key, value in attrs:
        if key in ("class", "id") and value:
            for token in value.lower().split():
                words = _NAME.findall(token)
                if not names.isdisjoint(words) and all(w in names or w in beside for w in words):
                    return True
    return False


def _is_named(tag: str, attrs: list) -> bool:
    """Is a whole class or id the name of something that is not the article's?"""
    return tag not in _UNNAMED and _has_name(attrs, _OTHER_NAMES, _BESIDE)


def _is_comment(tag: str, attrs: list) -> bool:
    """Is the element called a reader's comment, or a place of them?"""
    if tag in _NEVER_COMMENTS:
        return False
    for key, value in attrs:
        if value and (key == "itemprop" and value.lower() == "comment" or key == "itemtype" and value.lower().endswith(("/comment", "/usercomments"))):
            return True
    return _has_name(attrs, _COMMENT_NAMES, _COMMENT_BESIDE)


def _is_signed(tag: str, attrs: list) -> bool:
    """Does the element give an author or a date?"""
    if tag == "time":
        return True
    return any(
        value and key in ("class", "itemprop", "rel") and not _SIGNED.isdisjoint(_NAME.findall(value.lower())) for key, value in attrs
    )


class _Line(NamedTuple):
    """A line: its text, the tags around and in it, its region, and the elements that it may be left out for."""

    text: str
    tags: int
    region: int
    other: bool
    named: int
    comment: int


class _Region(NamedTuple):
    """An element that can hold the article or a part of it; regions are numbered in page order, outer ones first."""

    parent: int
    tag: str
    named: int
    #: Is it an article or main, or in one?
    within: bool

    @property
    def article(self) -> bool:
        return self.tag in _ARTICLE


class _Open(NamedTuple):
    """An open element, with what holds for the text in it."""

    tag: str
    silent: bool
    other: bool
    region: int
    named: int
    comment: int


class _Lines(HTMLParser):
    """Collects the lines and the regions of a page, and the nesting of its named and of its comment elements."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.now = _Open("", False, False, 0, -1, -1)
        self.stack: list[_Open] = []
        self.places: dict[str, list[int]] = {}  # of each tag in the stack
        self.blocks: list[int] = []  # places of all that are not inline
        self.regions = [_Region(-1, "", -1, False)]
        self.signed = [0]  # authors and dates directly in each region
        self.named: list[int] = []  # parent among the named elements
        self.comments: list[int] = []  # parent among the comment elements
        self.lines: list[_Line] = []
        self.parts: list[str] = []
        self.tags = 0

    def _end_line(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            self.parts = []
            if text:
                now = self.now
                self.lines.append(_Line(text, self.tags, now.region, now.other, now.named, now.comment))
                self.tags = 0

    def _push(self, element: _Open) -> None:
        self.places.setdefault(element.tag, []).append(len(self.stack))
        if element.tag not in _INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append(element)
        self.now = element

    def _close_from(self, place: int) -> None:
        """Close the open elements from this place of the stack on."""
        while len(self.stack) > place:
            tag = self.stack.pop().tag
            self.places[tag].pop()
            if tag not in _INLINE:
                self.blocks.pop()
        self.now = self.stack[-1] if self.stack else _Open("", False, False, 0, -1, -1)

    def _last(self, tags: Iterable[str]) -> int:
        """Place of the innermost open element of these tags, or -1."""
        last = -1
        for t in tags:
            places = self.places.get(t)
            if places and places[-1] > last:
                last = places[-1]
        return last

    def _end_head(self, tag: str) -> None:
        """The end tag of a head may be missing: what cannot stand in it ends it."""
        head = self._last(("head",))
        if head >= 0 and (tag in ("body", "frameset") or tag not in _IN_HEAD and self.stack[-1].tag in ("head", "title")):
            self._end_line()
            self._close_from(head)

    def handle_starttag(self, tag, attrs):
        if tag != "head":
            self._end_head(tag)
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
            return
        if tag not in _INLINE:
            self._end_line()
            self.tags = max(self.tags, 1)
            if tag in _SIBLINGS:
                place = self._last(_SIBLINGS[tag])
                if place > self._last(_LISTS):
                    self._close_from(place)
            elif self.now.tag == "p":
                self._close_from(len(self.stack) - 1)
        if tag in _VOID:
            return
        now = self.now
        region, named, comment = now.region, now.named, now.comment
        if attrs and _is_named(tag, attrs):
            self.named.append(named)
            named = len(self.named) - 1
        if attrs and _is_comment(tag, attrs):
            self.comments.append(comment)
            comment = len(self.comments) - 1
        if tag not in _INLINE and tag != "p" and tag not in _SIBLINGS and not now.other:
            self.regions.append(_Region(region, tag, named, tag in _ARTICLE or self.regions[region].within))
            self.signed.append(0)
            region = len(self.regions) - 1
        if (attrs or tag == "time") and _is_signed(tag, attrs):
            self.signed[region] += 1
        other = now.other or _is_other(tag, attrs, self.regions[now.region].within)
        self._push(_Open(tag, now.silent or tag in _SILENT, other, region, named, comment))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag not in _INLINE:
            self._end_line()
        place = self._last((tag,))
        # an inline end tag does not close a block
        if place >= 0 and not (tag in _INLINE and self.blocks and self.blocks[-1] > place):
            self._close_from(place)

    def handle_data(self, data):
        if self.now.tag == "head" and not data.isspace():
            self._end_head("")
        if not self.now.silent:
            self.parts.append(data)

    def parse_comment(self, i, report=1):
        """A comment ends where browsers end it, with ``--!>`` too."""
        end = _COMMENT_END.search(self.rawdata, i + 2)
        return end.end() if end else -1

    def close(self):
        if self.rawdata.startswith("<!--"):  # never closed: all of it is the comment
            self.rawdata = ""
        super().close()
        self._end_line()


def smooth(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing with the window cut at three widths and renormalised at the ends."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    inside = np.convolve(np.ones(len(ratios)), kernel)[reach : reach + len(ratios)]
    return np.convolve(ratios, kernel)[reach : reach + len(ratios)] / inside


def threshold(values: np.ndarray) -> float:
    """Half-way between the means of the two clusters that a two-means search on a line ends with."""
    low, high = float(values.min()), float(values.max())
    for _ in range(50):
        cut = (low + high) / 2
        above = values > cut
        if above.all() or not above.any():
            return cut
        new = float(values[~above].mean()), float(values[above].mean())
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def main_text(html: str | None) -> str:
    """The article's blocks, in page order, joined by two line feeds; empty if there are none."""
    if not html:
        return ""
    parser = _Lines()
    for at in range(0, len(html), FEED_CHARS):
        parser.feed(html[at : at + FEED_CHARS])
    parser.close()
    lines, regions = parser.lines, parser.regions
    own = _without_comments(parser, [k for k, line in enumerate(lines) if not line.other])
    left_out = _left_out(parser, own)
    own = [k for k in own if not (lines[k].named >= 0 and left_out[lines[k].named])]
    if not own:
        return ""
    marked = _marked(lines, own)
    weight = _totals(regions, ((lines[k].region, len(lines[k].text)) for k in marked))
    articles = [r for r, region in enumerate(regions) if region.article and not regions[region.parent].within]
    if sum(weight[r] for r in articles) * 2 >= weight[0]:
        held = _totals(regions, ((lines[k].region, 1) for k in {*marked, *_paragraphs(lines, own)}))
        chosen = {r for r in articles if held[r]}
    else:
        chosen = _around(parser, own, marked)
    inside = _below(regions, chosen)
    return "\n\n".join(lines[k].text for k in own if inside[lines[k].region])


def _totals(regions: list[_Region], amounts: Iterable[tuple[int, int]]) -> list[int]:
    """The sum of (region, amount) in each region, with those of the regions inside it."""
    total = [0] * len(regions)
    for r, amount in amounts:
        total[r] += amount
    for r in range(len(regions) - 1, 0, -1):
        total[regions[r].parent] += total[r]
    return total


def _below(regions: list[_Region], chosen: Container[int]) -> list[bool]:
    """Is each region one of ``chosen`` or inside one?"""
    inside = [False] * len(regions)
    for r, region in enumerate(regions):
        inside[r] = r in chosen or r > 0 and inside[region.parent]
    return inside


def _marked(lines: list[_Line], own: list[int]) -> list[int]:
    """The lines among ``own`` whose smoothed ratio is in the upper cluster."""
    ratios = np.zeros(len(lines))
    for k in own:
        ratios[k] = _ratio(lines[k])
    smoothed = smooth(ratios)
    cut = threshold(smoothed[own])
    return [k for k in own if smoothed[k] >= cut]


def _paragraphs(lines: list[_Line], own: list[int]) -> list[int]:
    """The lines in the upper cluster of the ratios cut at that of a paragraph, which no very long line hides."""
    ratios = np.minimum([_ratio(lines[k]) for k in own], PARAGRAPH)
    cut = threshold(ratios)
    return [k for k, ratio in zip(own, ratios, strict=True) if ratio > cut]


def _ratio(line: _Line) -> float:
    return len(line.text) / max(1, line.tags)


def _without_comments(parser: _Lines, own: list[int]) -> list[int]:
    """``own`` without the lines of readers' comments.

    Elements that are called comments are, whatever their weight, but for those
    around the page's title (an opinion is a comment, too) and on pages with no
    other text.  The title is the first ``h1``; text is a line in an article
    or main, beside the title, or with a ratio of ``TEXT`` or more.

    Articles without such a name are, if they have an author or a date, no
    heading, and others like them beside them, and stand inside the first article with
    a heading, or after it and not beside it.
    """
    lines, regions = parser.lines, parser.regions
    if parser.comments:
        title = next((k for k in own if regions[lines[k].region].tag == "h1"), None)
        stays = set()
        at = lines[title].comment if title is not None else -1
        while at >= 0:
            stays.add(at)
            at = parser.comments[at]
        out: list[bool] = []
        for c, parent in enumerate(parser.comments):
            out.append(c not in stays or parent >= 0 and out[parent])
        rest = [k for k in own if lines[k].comment < 0 or not out[lines[k].comment]]
        beside = regions[lines[title].region].parent if title is not None else None

        def is_text(line: _Line) -> bool:
            region = regions[line.region]
            return region.tag not in _HEADINGS and (region.within or line.region == beside or _ratio(line) >= TEXT)

        if any(is_text(lines[k]) for k in rest):
            own = rest
    headed = _totals(regions, ((lines[k].region, 1) for k in own if regions[lines[k].region].tag in _HEADINGS))
    signed = _totals(regions, enumerate(parser.signed))
    first = next((r for r, region in enumerate(regions) if region.tag == "article" and headed[r]), None)
    if first is None:
        return own
    within = _below(regions, {first})
    alike: dict[int, list[int]] = {}
    for r in range(first + 1, len(regions)):
        region = regions[r]
        if region.tag == "article" and signed[r] and not headed[r] and (within[r] or region.parent != regions[first].parent):
            alike.setdefault(region.parent, []).append(r)
    inside = _below(regions, {r for group in alike.values() if len(group) > 1 for r in group})
    return [k for k in own if not inside[lines[k].region]]


def _left_out(parser: _Lines, own: list[int]) -> list[bool]:
    """For each named element: is it, or one around it, not the article's?

    It is the article's, whatever its name, if it holds an article with marked
    text, or most of the marked text, unless the articles outside of all named
    elements hold a tenth of it or more.
    """
    lines, regions, named = parser.lines, parser.regions, parser.named
    if not named or not own:
        return [True] * len(named)
    marked = _marked(lines, own)
    total = sum(len(lines[k].text) for k in marked)
    outside = sum(len(lines[k].text) for k in marked if lines[k].named < 0 and regions[lines[k].region].within)
    weight, holds = [0] * len(named), [False] * len(named)
    for k in marked:
        if lines[k].named >= 0:
            weight[lines[k].named] += len(lines[k].text)
    held = _totals(regions, ((lines[k].region, 1) for k in marked))
    for r, region in enumerate(regions):
        if region.article and region.named >= 0 and held[r]:
            holds[region.named] = True
    for g in range(len(named) - 1, -1, -1):
        if named[g] >= 0:
            weight[named[g]] += weight[g]
            holds[named[g]] |= holds[g]
    out: list[bool] = []
    for g, parent in enumerate(named):
        stays = outside * 10 < total and (holds[g] or weight[g] * 2 > total)
        out.append(not stays or parent >= 0 and out[parent])
    return out


def _around(parser: _Lines, own: list[int], marked: list[int]) -> set[int]:
    """The smallest region that holds all marked lines and can be an article, with the heading before it.

    Lines that are marked for their neighbours' sake only, with a ratio like that
    of the unmarked ones (up to twice their mean), do not widen it.  Lines that a
    much longer one leaves unmarked do, if they would be in the upper cluster of
    the ratios cut at that of a paragraph.
    Parts of an article (lists, tables, sections) and elements of a single line
    are none: what is around them is taken.  Where no heading comes before the
    marked text in it, the next element around it that has one is taken, or, if
    that is the whole page, the last such heading alone.
    """
    lines, regions = parser.lines, parser.regions
    ratio = {k: _ratio(lines[k]) for k in own}
    unmarked = [ratio[k] for k in sorted({*own} - {*marked})]
    least = 2 * sum(unmarked) / len(unmarked) if unmarked else -1
    rich = {k for k in marked if ratio[k] > least}
    marked = sorted(rich.union(_paragraphs(lines, own))) or marked
    # the regions around the first marked line, from the outermost on, that hold all marked lines
    held = _totals(regions, ((lines[k].region, 1) for k in marked))
    path, r = [], lines[marked[0]].region
    while r >= 0:
        if held[r] == len(marked):
            path.append(r)
        r = regions[r].parent
    path.reverse()
    size = _totals(regions, ((lines[k].region, 1) for k in own))
    while len(path) > 1 and (regions[path[-1]].tag in _PARTS or size[path[-1]] < 2):
        path.pop()
    headings = [lines[k].region for k in own if k <= marked[0] and regions[lines[k].region].tag in _HEADINGS]
    before = _totals(regions, ((r, 1) for r in headings))
    for at in range(len(path) - 1, -1, -1):
        if before[path[at]]:
            if at < len(path) - 1 and regions[path[at]].tag in ("", "html", "body"):
                inside = _below(regions, {path[at]})
                return {path[-1], [r for r in headings if inside[r]][-1]}
            return {path[at]}
    return {path[-1]}


def extract(pages: DataFrame, *, html_col: str = "html", carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` of ``pages`` (all but the html by default) with ``main_text``.

    Null, empty and textless pages have an empty text.  Every page is read alone
    and whole, so repeated rows and nulls elsewhere do not matter; an input
    column named ``main_text`` is replaced.
    """
    names = [c for c in (pages.columns if carry is None else carry) if c not in ("main_text", *([html_col] if carry is None else []))]
    schema = T.StructType([*pages.select(*names).schema.fields, T.StructField("main_text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(len(names))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(texts, pa.string())], names=schema.names)

    return pages.select(*names, F.col(html_col).alias("_hw_html")).mapInArrow(run, schema)

"""Main text of web pages from parser events, text-to-tag ratios and clustering.

The standard library's streaming parser turns a page into lines: the text
between two block-level tags is one line. A line's text-to-tag ratio is its
number of characters per tag met in it. The ratios are smoothed with a Gaussian
over the lines in page order, and a threshold splits the smoothed ratios into
two clusters: the midpoint between the means of two groups, found by iterating
from the overall mean. A region of content is the innermost article (or main)
that holds lines of the upper cluster. All of a region's lines are content, short ones too, but for those
under menus, headers, footers, sidebars, notices, adverts, forms, scripts and
the like. Scripts, menus and so on are known by their element. A form, or an element whose role, class or id
names such a part, is only suspected until the page is read: it is no boilerplate if all articles
of the page lie in it (or all main elements, or, on a page without either, most of the text and few links), so a
wrapper of the page loses nothing by its name. Only a token that says it is such a part counts as a name, not one that denies or mentions it.

Where a page has article elements with content, the regions are these, the first one with text among them,
as the story comes before what readers say about it; else the
main elements; else the smallest sectioning element (or the body) that holds all
lines of the upper cluster. There the clusters are those of the logarithms of the
lines' own ratios: one very long paragraph doesn't put the others into the lower one,
and a menu next to it isn't smoothed into the upper one.

Defined results: a null or empty page, or one without text, has the empty
text; broken markup (unclosed elements, a page cut anywhere) is read as far as it
goes, in time linear in the page; very long pages are read whole, by the same parser; repeated rows are extracted each; an empty table gives an empty table;
other columns pass through, those named like the output are replaced.
"""

from __future__ import annotations

import heapq
import html
import re
from collections.abc import Iterable
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType

from lumenflow.llm.textops import add_columns

SIGMA = 1.0

# Elements of HTML by their kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset(
    "head script style noscript template iframe object svg math nav footer aside button select option "
    "textarea menu dialog canvas audio video map".split()
)
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td "
    "tfoot th thead tr ul".split()
)
SECTION = frozenset("body main article section div td".split())
#: Elements that leave an open head open; every other start tag ends it.
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
#: Elements whose content, in a head, isn't the head's own: nothing in them ends it.
_HOLDS = frozenset("noscript template".split())
#: A start tag of the key ends an open element of the value, as far as the next block that isn't one.
IMPLIED_END = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adbox adsense banner sponsor sponsored sponsors promo promotion "
    "cookie cookies consent gdpr notice notices notification alert disclaimer newsletter subscribe subscription signup "
    "sidebar aside menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar toolbar comment comments "
    "disqus respond replies related recommended recommendations share sharing social popup modal overlay widget "
    "login search copyright pagination pager skip".split()
)
#: Names that mark boilerplate only outside an article, where they may frame its title.
OUTER_NAMES = frozenset({"header"})
COMMENT_NAMES = frozenset("comment comments disqus respond replies".split())
#: Words of a class or id that deny or only mention the part named beside them.
DENIALS = frozenset("no not non without has have with is hide hides show shows".split())
#: Words that may follow the name of a part and leave it that part.
LAYOUT = frozenset(
    "area areas article articles bar bars block blocks body bottom box boxes btn button buttons card cards center col column "
    "columns container content count desktop entry feed field first footer form global grid group head header heading holder home icon "
    "icons image img inline inner item items label large last layer left link links list local main message mobile module "
    "outer page panel placeholder policy post posts primary promo region right root row secondary section sections site slot small "
    "social stories strip tag tags text thread title toggle tools top unit units view wide wrap wrapper zone".split()
)
#: Unfinished tags of a page that are tried again as text, and elements without a block among them that an implied end looks through.
RETRIES = 20
IMPLIED_REACH = 200
_TAG = re.compile(r"<[^<>]*>")
_TAG_START = re.compile(r"<[a-zA-Z/!?]")
_WORD = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Suspect:
    """An element that its name, its role or its being a form takes for boilerplate, until the page is read."""

    outer: int  # the suspect around it, -1 for none
    comments: bool
    chars: int = 0
    linked: int = 0
    articles: int = 0
    mains: int = 0


class LineReader(HTMLParser):
    """Collects (text, tags, region, suspect) per line while a page streams through."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int, int]] = []  # element, whether it is dropped, its region, its suspect
        self.depths: dict[str, list[int]] = {}  # where elements of a name are open
        self.regions: list[tuple[str, int]] = [("body", -1)]  # element and the region around it
        self.nearest: list[tuple[int, int]] = [(-1, -1)]  # innermost article and main that is or holds a region
        self.suspects: list[Suspect] = []
        self.lines: list[tuple[str, int, int, int]] = []
        self.articles: list[tuple[int, int]] = []  # region and suspect of each article
        self.mains = 0
        self.head = -1  # place of the open head
        self.parts: list[str] = []
        self.linked = 0  # characters of the line that lie in links
        self.tags = 0

    def _state(self) -> tuple[bool, int, int]:
        return self.open[-1][1:] if self.open else (False, 0, -1)

    def _flush(self) -> None:
        if self.parts:
            if text := " ".join("".join(self.parts).split()):
                _, region, suspect = self._state()
                self.lines.append((text, self.tags, region, suspect))
                if suspect >= 0:
                    self.suspects[suspect].chars += len(text)
                    self.suspects[suspect].linked += min(self.linked, len(text))
                self.tags = 0
            self.parts = []
        self.linked = 0

    def _close(self, depth: int) -> None:
        for tag, *_ in self.open[depth:]:
            self.depths[tag].pop()
        del self.open[depth:]
        if self.head >= depth:
            self.head = -1

    def _implied(self, tag: str) -> None:
        ends = {"p"} if tag in BLOCK else set()
        ends |= IMPLIED_END.get(tag, set())
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] in ends:
                self._close(depth)
                return
            if self.open[depth][0] in BLOCK or len(self.open) - depth > IMPLIED_REACH:
                return

    def _end_head(self, tag: str) -> None:
        """The end tag of a head may be left out: what can't stand in a head ends it."""
        if self.head >= 0 and tag not in IN_HEAD and (tag == "body" or not any(e[0] in _HOLDS for e in self.open[self.head :])):
            self._close(self.head)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._end_head(tag)
        if tag in BLOCK or tag in DROPPED:
            self._flush()
            self._implied(tag)
        self.tags += 1
        if tag == "br":
            self.parts.append("\n")
        if tag in VOID:
            return
        dropped, region, suspect = self._state()
        if not dropped:
            inner = max(self.nearest[region]) >= 0
            dropped = tag in DROPPED or tag == "header" and not inner or self._hidden(attrs)
            if not dropped:
                if kind := self._suspicious(tag, attrs, inner):
                    self.suspects.append(Suspect(suspect, kind == "comments"))
                    suspect = len(self.suspects) - 1
                if tag in SECTION and tag != "body":
                    region = self._region(tag, region, suspect)
        if tag == "head" and self.head < 0:
            self.head = len(self.open)
        self.depths.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, dropped, region, suspect))

    def _region(self, tag: str, around: int, suspect: int) -> int:
        self.regions.append((tag, around))
        region = len(self.regions) - 1
        article, main = self.nearest[around]
        self.nearest.append((region if tag == "article" else article, region if tag == "main" else main))
        if tag == "article":
            self.articles.append((region, suspect))
            if suspect >= 0:
                self.suspects[suspect].articles += 1
        elif tag == "main":
            self.mains += 1
            if suspect >= 0:
                self.suspects[suspect].mains += 1
        return region

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "math"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if not (places := self.depths.get(tag)):
            return
        depth = places[-1]
        if tag not in BLOCK and any((b := self.depths.get(barrier)) and b[-1] > depth for barrier in ("article", "main", "body")):
            return
        if tag in BLOCK or tag in DROPPED:
            self._flush()
        self._close(depth)

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1][0] == "head" and not data.isspace():
            self._close(len(self.open) - 1)
        if not self._state()[0]:
            self.parts.append(data)
            if self.depths.get("a"):
                self.linked += len(data)

    def read(self, page: str) -> None:
        """The whole page, in time linear in its length: a tag that never ends is tried at ``RETRIES`` places at most."""
        end = page.rfind(">") + 1
        self.feed(page[:end])
        tail = page[end:]
        for _ in range(RETRIES):
            if not self.rawdata.startswith("<"):
                break
            # something unfinished: its first character is text, the rest is read anew
            rest, self.rawdata = self.rawdata, ""
            self.handle_data("<")
            self.feed(rest[1:])
        rest, self.rawdata = self.rawdata, ""
        if rest.startswith("<"):
            self.handle_data(html.unescape(_TAG.sub(" ", rest)))
            rest = ""
        if cut := _TAG_START.search(tail):  # the page ends inside a tag
            tail = tail[: cut.start()]
        self.feed(rest + tail)
        self.close()

    def close(self) -> None:
        super().close()
        self._flush()

    def within(self, region: int, name: str) -> int:
        """The innermost article or main that is or holds ``region``, else -1."""
        return self.nearest[region][name == "main"]

    def common(self, regions: Iterable[int]) -> int:
        """The innermost region that is or holds all of ``regions``."""
        left = set(regions)
        order = [-r for r in left]
        heapq.heapify(order)
        while len(left) > 1:  # a region's number is above that of the one around it
            last = -heapq.heappop(order)
            left.remove(last)
            around = self.regions[last][1]
            if around not in left:
                left.add(around)
                heapq.heappush(order, -around)
        return left.pop()

    def boilerplate(self) -> list[bool]:
        """Which suspects are boilerplate: all but those that hold the content, whatever their name.

        A suspect holds the content if all articles (or, without articles, all main elements) of the page lie
        in it, or on a page without either more than half of the text, mostly outside links. Comments never do by their share of the text.
        """
        for s in reversed(self.suspects):  # a suspect's number is above that of the one around it
            if s.outer >= 0:
                outer = self.suspects[s.outer]
                for name in ("chars", "linked", "articles", "mains"):
                    setattr(outer, name, getattr(outer, name) + getattr(s, name))
        total = sum(len(text) for text, *_ in self.lines)
        out: list[bool] = []
        for s in self.suspects:
            if self.articles:
                spared = s.articles == len(self.articles)
            elif self.mains:
                spared = s.mains == self.mains
            else:
                spared = not s.comments and 2 * s.chars > total and 3 * s.linked < s.chars
            out.append((s.outer >= 0 and out[s.outer]) or not spared)
        return out

    @staticmethod
    def _hidden(attrs: list[tuple[str, str | None]]) -> bool:
        return any(
            name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and value and _HIDDEN.search(value) for name, value in attrs
        )

    @staticmethod
    def _suspicious(tag: str, attrs: list[tuple[str, str | None]], inner: bool) -> str | None:
        """``comments`` or ``other`` for an element that looks like boilerplate."""
        found = "other" if tag == "form" else None
        if not attrs or tag in ("html", "body", "main"):
            return found
        for name, value in attrs:
            if not value:
                continue
            if name == "role" and value.strip().lower() in ROLES:
                found = found or "other"
            if name in ("class", "id"):
                for token in value.split():
                    if named := _named(token, inner):
                        if named & COMMENT_NAMES:
                            return "comments"
                        found = found or "other"
        return found if tag != "article" or found == "comments" else None


def _named(token: str, inner: bool) -> set[str]:
    """The names of boilerplate that a class or id is made of; none if it says something else.

    What comes after the last name must be words of layout: ``ad-slot`` and ``left-sidebar`` are named, ``share-price``,
    ``header-fixed`` and ``cookie-recipe`` are not; neither is a token that denies or only mentions a part (``no-sidebar``, ``has-menu``).
    """
    words = [w.lower() for w in _WORD.findall(token)]
    if not words or DENIALS & set(words):
        return set()
    names = NAMES if inner else NAMES | OUTER_NAMES
    last = max((i for i, w in enumerate(words) if w in names), default=-1)
    return {w for w in words if w in names} if last >= 0 and all(w in LAYOUT or len(w) == 1 for w in words[last + 1 :]) else set()


def smooth(ratios: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian mean over neighbouring lines, over those that exist at the ends."""
    reach = max(1, int(np.ceil(3 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel)[reach : reach + len(ratios)]
    return np.convolve(ratios, kernel)[reach : reach + len(ratios)] / weight


def two_cluster_threshold(values: np.ndarray) -> float:
    """Midpoint of the means below and above it, iterated from the mean."""
    at = float(values.mean())
    for _ in range(100):
        upper = values[values >= at]
        lower = values[values < at]
        if not len(lower) or not len(upper):
            break
        new = (float(upper.mean()) + float(lower.mean())) / 2
        if abs(new - at) <= 1e-9:
            break
        at = new
    return at


def main_text(page: str, sigma: float = SIGMA) -> str:
    reader = LineReader()
    reader.read(page)
    gone = reader.boilerplate()
    lines = [(text, tags, region) for text, tags, region, suspect in reader.lines if suspect < 0 or not gone[suspect]]
    if not lines:
        return ""
    ratios = np.array([len(text) / max(1, tags) for text, tags, _ in lines])
    smoothed = smooth(ratios, sigma)
    upper = smoothed >= min(two_cluster_threshold(smoothed), float(smoothed.max()))
    holding: dict[str, set[int]] = {}
    for (_, _, region), is_upper in zip(lines, upper):
        if is_upper:
            for name in ("article", "main"):
                if (at := reader.within(region, name)) >= 0:
                    holding.setdefault(name, set()).add(at)
    if "article" in holding:
        chosen = holding["article"]
        # the story comes before what readers say about it, however short it is
        told = {reader.within(region, "article") for _, _, region in lines}
        first = next((region for region, _ in reader.articles if region in told), None)
        chosen |= {first} if first is not None else set()
    elif "main" in holding:
        chosen = holding["main"]
    else:
        logs = np.log(ratios)
        upper = logs >= min(two_cluster_threshold(logs), float(logs.max()))
        chosen = {reader.common([region for (_, _, region), is_upper in zip(lines, upper) if is_upper])}
    kept: list[bool] = []
    for region, (_, around) in enumerate(reader.regions):
        kept.append(region in chosen or around >= 0 and kept[around])
    return " ".join(text for text, _, region in lines if kept[region])


def extract(pages: DataFrame, html: str = "html", text: str = "text", sigma: float = SIGMA) -> DataFrame:
    """``pages`` with ``text``, the main text of the whole ``html``."""

    def compute(column: pa.Array) -> list[pa.Array]:
        return [pa.array([main_text(h, sigma) if h else "" for h in column.to_pylist()], pa.string())]

    return add_columns(pages, [html], [(text, StringType())], compute)

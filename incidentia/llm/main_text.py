"""Main text of web pages by text-to-tag ratios.

1. The standard library's parser streams through a page. Its events give lines:
   the text between two block tags, with the number of tags met on the way. No
   tree is built; open elements are a stack.
2. Elements that hold no article by their very name (menus, headers, footers,
   sidebars, forms, scripts, styles) or by a word of their class, id or role
   (adverts, notices, comments and the like) are passed over with all they hold.
3. Each other line has a ratio: characters of text over tags. The ratios are
   smoothed along the page with a Gaussian, and lines at or above the standard
   deviation of the smoothed ratios (or all of them, where they are even) are
   content.
4. Content lines choose regions: the article around them, or else the nearest
   container. Of a chosen region every line is kept, so a short paragraph is not
   lost. So is a line between two content lines that is not mostly links.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentia.llm.common import arrow_rows

# Gaussian over the lines: lines on either side, and its width.
RADIUS = 2
SIGMA = 1.0
# A line with a larger share of its text in links is no part of an article by itself.
LINK_SHARE = 0.5

# Element names.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "legend li main menu nav ol option p pre section select summary table tbody td textarea "
    "tfoot th thead title tr ul".split()
)
CONTAINER = frozenset(
    "article body center details div figure html main section table tbody td tr".split()
)
# Never part of an article.
EXCLUDED = frozenset(
    "applet aside audio button canvas datalist dialog embed footer form frameset head header iframe "
    "input map math menu nav noframes noscript object option script select style svg template "
    "textarea title video".split()
)
# Nor an element with one of these words in its class, id or role. Compound
# names are taken apart at hyphens, underscores and capitals.
EXCLUDED_WORDS = frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs complementary "
    "consent contentinfo cookie cookies disclaimer footer gdpr login masthead menu modal nav navbar "
    "navigation newsletter notice notices notification pagination paywall popup promo promoted "
    "promotion related search share sharing sidebar signup social sponsor sponsored subscribe "
    "subscription toolbar topbar widget widgets".split()
)
READER_WORDS = frozenset("comment comments disqus replies reply".split())
# Names that count as a whole, as the head of an article has similar ones.
EXCLUDED_NAMES = frozenset("header page-header pageheader site-header siteheader top-bar".split())
# Names that say how the element is laid out, not what it is.
LAYOUT = ("has", "is", "js", "no", "with", "without")
# Not judged by words: they hold the article, or are its headings.
TRUSTED = frozenset("body h1 h2 h3 h4 h5 h6 html main".split())

_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_TAG = re.compile(r"<[A-Za-z/!?]")

# (name, attributes) opens an element, (name, None) closes it, a text is text.
Event = tuple[str, list | None] | str


class Events(HTMLParser):
    """Parser events of one page, in order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.events: list[Event] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.events.append((tag, attrs))

    def handle_endtag(self, tag: str) -> None:
        self.events.append((tag, None))

    def handle_data(self, data: str) -> None:
        self.events.append(data)


def events(html: str) -> list[Event]:
    """The events of a page; a tag that the page's end cuts off is none."""
    last = html.rfind("<")
    if last > html.rfind(">") and _TAG.match(html, last):
        html = html[:last]
    parser = Events()
    parser.feed(html)
    parser.close()
    return parser.events


def _judged(tag: str, attrs: list) -> str:
    """Why an element is passed over: by its name, its words, or as readers' text."""
    if tag in EXCLUDED:
        return "name"
    if tag in TRUSTED:
        return ""
    reason = ""
    for name, value in attrs:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return "name"
        if name not in ("class", "id", "role"):
            continue
        for token in (value or "").split():
            words = [w.lower() for w in _WORD.findall(token)]
            if not words or words[0] in LAYOUT:
                continue
            if not READER_WORDS.isdisjoint(words):
                return "readers"
            whole = token.lower()
            if whole in EXCLUDED_NAMES or whole in EXCLUDED_WORDS:
                reason = "words"
            elif tag != "article" and not EXCLUDED_WORDS.isdisjoint(words):
                reason = "words"
    return reason


def _closings(found: list[Event]) -> dict[int, int]:
    """For each event that opens an element, the event that closes it; minus that
    number where the element has no end tag of its own.

    An end tag closes the last open element of its name and all that opened
    after it. Only end tags of containers and of excluded elements reach out
    of the container they stand in.
    """
    ends: dict[int, int] = {}
    # (name, event, number of containers around it)
    stack: list[tuple[str, int, int]] = []
    depths: dict[str, list[int]] = {}
    depth = 0
    for place, event in enumerate(found):
        if isinstance(event, str):
            continue
        tag, attrs = event
        wide = tag in CONTAINER or tag in EXCLUDED
        if attrs is not None:
            if tag not in VOID:
                stack.append((tag, place, depth))
                depths.setdefault(tag, []).append(depth)
                depth += wide
        elif (same := depths.get(tag)) and (wide or same[-1] == depth):
            name = None
            while name != tag:
                name, begin, depth = stack.pop()
                depths[name].pop()
                ends[begin] = place if name == tag else -place
    for _, begin, _ in stack:
        ends[begin] = -len(found)
    return ends


class Lines:
    """The lines of a page outside excluded elements: text, tags met on the way,
    characters in links, the region they belong to, and if that is an article."""

    def __init__(self, found: list[Event]):
        self.texts: list[str] = []
        self.tags: list[int] = []
        self.links: list[int] = []
        self.regions: list[int] = []
        self.in_article: list[bool] = []
        self.found = found
        self.ends = _closings(found)
        # Where the elements begin that hold the main part by their name.
        self.mains = [
            i
            for i, e in enumerate(found)
            if not isinstance(e, str)
            and e[1] is not None
            and (e[0] == "main" or e[0] == "article" and not _judged(*e))
        ]
        self._parts: list[str] = []
        self._linked = self._tags = 0
        # Containers around the place: the event that opened each, its end, if it is an article.
        self._around: list[tuple[int, int, bool]] = [(-1, len(found), False)]
        self._walk()

    def _walk(self) -> None:
        link_end, place = -1, 0
        while place < len(self.found):
            while len(self._around) > 1 and self._around[-1][1] <= place:
                self._flush()
                self._around.pop()
            event = self.found[place]
            place += 1
            if isinstance(event, str):
                self._parts.append(event)
                if place <= link_end:
                    self._linked += len("".join(event.split()))
                continue
            tag, attrs = event
            self._tags += 1
            if tag in BLOCK:
                self._flush()
            if attrs is None:
                continue
            if self._passed_over(tag, attrs, place - 1):
                place = self._after(tag, place - 1)
            elif tag in CONTAINER:
                end = min(abs(self.ends[place - 1]), self._around[-1][1])
                self._around.append((place - 1, end, tag == "article"))
            elif tag == "a":
                link_end = abs(self.ends[place - 1])
        self._flush()

    def _flush(self) -> None:
        text = " ".join("".join(self._parts).split())
        self._parts = []
        if text:
            articles = [begin for begin, _, article in self._around if article]
            self.texts.append(text)
            self.tags.append(self._tags)
            self.links.append(self._linked)
            self.regions.append(articles[0] if articles else self._around[-1][0])
            self.in_article.append(bool(articles))
            self._linked = self._tags = 0

    def _passed_over(self, tag: str, attrs: list, place: int) -> bool:
        reason = _judged(tag, attrs)
        if reason == "words" and tag not in VOID and tag != "article":
            # What holds the main part is a wrapper, whatever its words.
            inner = bisect.bisect_right(self.mains, place)
            return inner == len(self.mains) or self.mains[inner] >= abs(self.ends[place])
        return bool(reason)

    def _after(self, tag: str, place: int) -> int:
        """Where the page goes on after an excluded element. One without an end
        tag ends with its parent, or where the main part begins."""
        if tag in VOID:
            return place + 1
        end = self.ends[place]
        if end > 0:
            return end + 1
        later = bisect.bisect_right(self.mains, place)
        return min([-end, *self.mains[later : later + 1]])


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Gaussian mean of each value and its neighbours; beyond the ends there are none."""
    offsets = np.arange(-RADIUS, RADIUS + 1)
    weights = np.exp(-(offsets**2) / (2 * SIGMA**2))
    padded = np.pad(ratios, RADIUS)
    counted = np.pad(np.ones(len(ratios)), RADIUS)
    total = np.convolve(padded, weights, "valid")
    return total / np.convolve(counted, weights, "valid")


def main_text(html: str | None) -> str:
    """The article of one page: its blocks joined by one blank."""
    lines = Lines(events(html or ""))
    if not lines.texts:
        return ""
    chars = np.array([len(t) for t in lines.texts], dtype=float)
    ratio = smoothed(chars / np.maximum(lines.tags, 1))
    linked = np.array(lines.links) > LINK_SHARE * chars
    article = np.array(lines.in_article)
    content = (ratio >= min(ratio.std(), ratio.max())) & ~linked
    if 2 * chars[content & article].sum() >= chars[content].sum() > 0:
        # The page marks its articles: other lines are none.
        content &= article
    elif article.any():
        article[:] = False
    chosen = {r for r, c in zip(lines.regions, content) if c}
    places = np.flatnonzero(content)
    between = np.zeros(len(chars), bool)
    if len(places) and not article.any():
        between[places[0] : places[-1]] = True
    between &= ~linked
    return " ".join(t for t, r, b in zip(lines.texts, lines.regions, between) if r in chosen or b)


def extract(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every row of ``pages``.

    A page that is null, empty or holds no article gives an empty text with
    ``n_chars`` 0. Ids and addresses pass unchanged, also when null or
    repeated; each row is handled by itself, whatever its length. Other
    columns are left out, so none can clash. An empty table gives an empty
    table.
    """
    rows = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.col(html).cast("string").alias("html"),
    )

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = pa.array((main_text(cell.as_py()) for cell in batch["html"]), pa.string())
        chars = pa.array([len(t.as_py()) for t in texts], pa.int64())
        columns = [batch["page_id"], batch["url"], texts, chars]
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    return arrow_rows(rows, run, "page_id bigint, url string, text string, n_chars bigint")

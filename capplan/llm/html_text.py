"""Main text of web pages: streaming parser events, text-to-tag ratio per line, smoothing, clustering.

The standard library's parser gives events; they become lines (blocks of the page) with the characters of
text and of links in each, and the number of tags. The text-to-tag ratio of each line is smoothed with a
Gaussian, and a threshold that splits the ratios into two clusters marks the lines of content. Around that,
what page structure says plainly is followed: elements that never hold content (scripts, forms, menus,
headers and footers of the page) are left out, and so are those whose names say so (sidebars, adverts, notices,
comments of readers), unless the region of the content lies in them. An article in which the clusters choose
lines is taken up to its borders, and chosen lines outside articles are content too.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capplan.llm.common import map_arrow

#: Elements without content, whatever is in them.
SILENT = frozenset(
    "script style noscript template svg math canvas iframe object form nav aside select button textarea input "
    "dialog menu audio video map head title".split()
)
#: Their content is character data up to their end tag.
RAW = frozenset(["script", "style", "textarea", "title", "noscript", "iframe"])
#: Elements that begin and end a line.
BLOCKS = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol p pre section summary table tbody td tfoot th thead tr "
    "ul aside dialog".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that an opening tag of the key closes if they are open (end tags may be left out).
CLOSES = {
    "p": {"p"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
#: Words of a class, id or role that mark an element without content.
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adbox|banner|sponsor\w*|promo\w*|cookie\w*|consent|gdpr|notice|newsletter|"
    r"subscribe|popup|modal|menu|nav\w*|breadcrumbs?|sidebar|side|widget\w*|footer|masthead|header|"
    r"comments?|commentlist|disqus|reply|replies|respond|share|sharing|social|related|recommend\w*|pagination|pager|"
    r"toolbar|login|signup|search|skip|complementary|contentinfo|navigation|alert|alertdialog|copyright)(?:$|[\s_-])",
    re.IGNORECASE,
)
#: Elements whose names say little, as whole pages and articles carry such words too.
TRUSTED = frozenset(["main", "article"])
#: What marks an article that isn't the page's.
ASIDE = re.compile(r"comment|repl(?:y|ies)|related|promo|advert|sponsor|teaser", re.IGNORECASE)
#: Names that only tell of such parts elsewhere.
ABOUT = re.compile(r"\b(?:no|has|with|without|hide|show)[-_]\w+", re.IGNORECASE)
#: Names of what opens an article, which is its header as much as a header element is.
HEADER = re.compile(r"(?:^|(?<=\s))(?:[\w-]*[_-])?header(?=\s|$)", re.IGNORECASE)
#: Elements that say that their lines are the content.
ARTICLE = frozenset(["article"])
#: Width of the Gaussian, in lines.
WIDTH = 1.0

_SPACE = re.compile(r"\s+")


class Lines(HTMLParser):
    """Lines of a page: parts of text with the marked elements they lie in, tags, and the article they are in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, bool, bool]] = []  # tag, silent, marked, article
        self.lines: list[tuple[list[tuple[tuple[int, ...], str, int]], int, int]] = []
        self.parts: list[tuple[tuple[int, ...], str, int]] = []  # marked elements, text, characters in links
        self.marks: tuple[int, ...] = ()
        self.within: list[tuple[int, ...]] = [()]  # marked elements around each article, none for no article
        self.tags = self.links = self.silent = self.article = self.marked = 0

    def cut(self) -> None:
        if self.parts:
            self.lines.append((self.parts, self.tags, len(self.within) - 1 if self.article else 0))
        self.parts, self.tags = [], 0

    def _close(self, count: int) -> None:
        for _ in range(count):
            tag, silent, marked, article = self.open.pop()
            self.silent -= silent
            self.links -= tag == "a"
            if tag in BLOCKS:
                self.cut()
            self.marks = self.marks[:-1] if marked else self.marks
            self.article -= article

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in CLOSES or tag in BLOCKS:
            shut = CLOSES.get(tag, {"p"} if tag not in ("html", "body") else set())
            for depth in range(len(self.open) - 1, -1, -1):
                if self.open[depth][0] in shut:
                    self._close(len(self.open) - depth)
                    break
                if self.open[depth][0] in BLOCKS or self.open[depth][0] in SILENT:
                    break
        if tag in BLOCKS:
            self.cut()
        if tag == "br" and not self.silent:
            self.parts.append((self.marks, " ", 0))
        if tag in VOID:
            return
        silent = tag in SILENT or (tag in ("header", "footer") and not self.article)
        silent = silent or (self.article > 0 and tag == "footer")
        marked = False
        if attrs and not silent and tag not in ("html", "body"):
            named = ABOUT.sub("", " ".join(v for n, v in attrs if v and n in ("class", "id", "role")))
            named = HEADER.sub("", named) if self.article else named
            silent = any(n == "hidden" or (n == "aria-hidden" and v == "true") for n, v in attrs)
            silent = silent or any(n == "style" and v and re.search(r"display\s*:\s*none", v) for n, v in attrs)
            marked = not silent and bool(named and (ASIDE if tag in TRUSTED else MARKED).search(named))
        article = tag in ARTICLE and not silent and not marked
        self.open.append((tag, silent, marked, article))
        self.silent += silent
        if marked:
            self.marked += 1
            self.marks = (*self.marks, self.marked)
        if article and not self.article and not self.silent:
            self.within.append(self.marks)
        self.article += article
        self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                self._close(len(self.open) - depth)
                return
        if tag in BLOCKS:
            self.cut()

    def handle_data(self, data: str) -> None:
        if self.silent:
            return
        self.parts.append((self.marks, data, len(data.strip()) if self.links else 0))


def smoothed(values: list[float], width: float = WIDTH) -> list[float]:
    """Values under a Gaussian of the given width, weights adding up to one at the ends too."""
    reach = max(1, math.ceil(3 * width))
    weights = [math.exp(-(k * k) / (2 * width * width)) for k in range(-reach, reach + 1)]
    out = []
    for i in range(len(values)):
        total = weight = 0.0
        for k in range(max(0, i - reach), min(len(values), i + reach + 1)):
            w = weights[k - i + reach]
            total += w * values[k]
            weight += w
        out.append(total / weight)
    return out


def threshold(values: list[float]) -> float:
    """Between the means of two clusters of values, by turns of assigning and averaging."""
    low, high = min(values), max(values)
    for _ in range(50):
        middle = (low + high) / 2
        lower, upper = [v for v in values if v <= middle], [v for v in values if v > middle]
        if not lower or not upper:
            break
        now = sum(lower) / len(lower), sum(upper) / len(upper)
        if now == (low, high):
            break
        low, high = now
    return (low + high) / 2


def _shown(lines: list, heard: set[int] | None) -> list[tuple[str, int, int, int]]:
    """Text, characters in links, tags and article of each line, of marked elements those in ``heard`` (None: all)."""
    out = []
    for parts, tags, article in lines:
        if heard is not None:
            parts = [p for p in parts if heard.issuperset(p[0])]
        text = _SPACE.sub(" ", "".join(p[1] for p in parts)).strip()
        if text:
            out.append((text, sum(p[2] for p in parts), tags, article))
    return out


def chosen(lines: list[tuple[str, int, int, int]]) -> list[bool]:
    """Whether each line is in the upper cluster of smoothed text-to-tag ratios, and not mostly links."""
    soft = smoothed([math.log1p(max(0, len(text) - linked) / max(1, tags)) for text, linked, tags, _ in lines])
    limit = threshold(soft)
    # a page of one kind of line has no second cluster: links and few words tell then
    even = max(soft) - min(soft) < 0.7
    return [
        2 * linked <= len(text) and (even or ratio > limit)
        for (text, linked, *_), ratio in zip(lines, soft, strict=True)
    ]


def _heard(page: Lines, every: list[tuple[str, int, int, int]]) -> set[int]:
    """Marked elements that hold the article with most of the chosen text or, without articles, most of that text."""
    weight: dict[int, int] = {}
    for (text, linked, _, article), yes in zip(every, chosen(every), strict=True):
        weight[article] = weight.get(article, 0) + yes * (len(text) - linked)
    articles = [a for a in weight if a]
    if articles:
        return set(page.within[max(articles, key=lambda a: (weight[a], -a))])
    kept = [line for line in page.lines if _shown([line], None)]
    held: dict[int, int] = {}
    for (parts, *_), yes in zip(kept, chosen(every), strict=True):
        for marks, text, linked in parts if yes else ():
            for mark in marks:
                held[mark] = held.get(mark, 0) + len(text.strip()) - linked
    return {mark for mark, size in held.items() if 2 * size > weight.get(0, 0)}


def content(html: str) -> str:
    """The main text of a page, blocks joined by one space; empty if there is none."""
    page = Lines()
    page.feed(html)
    page.close()
    page.cut()
    every = _shown(page.lines, None)
    if not every:
        return ""
    lines = _shown(page.lines, _heard(page, every)) or every if page.marked else every
    yes = chosen(lines)
    regions = {article for (*_, article), y in zip(lines, yes, strict=True) if y and article}
    return " ".join(text for (text, _, _, article), y in zip(lines, yes, strict=True) if (article in regions if article else y))


def _extractor():
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [content(h) if h else "" for h in batch.column("html").to_pylist()]
        columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())]
        sizes = pa.array([len(t) for t in texts], pa.int64())
        return pa.RecordBatch.from_arrays([*columns, sizes], names=["page_id", "url", "text", "n_chars"])

    return step


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars``, one row per row of ``pages`` (needs ``page_id, url, html``).

    NULL or empty html, and a page without content, have empty text; repeated rows are extracted each, broken
    markup is read as far as it goes, no rows give an empty result. Pages are independent of each other.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    return map_arrow(rows, _extractor, "page_id long, url string, text string, n_chars long")

"""Main text of web pages from parser events and smoothed text-to-tag ratios.

The standard library's parser streams start tags, end tags and text. Text runs between block tags
are the lines of a page; a line's ratio is its characters per tag. The ratios are smoothed by a
Gaussian along the page, and lines above a threshold are content. They decide which parts of the page
are the article: the elements that say so and hold content, or else the one that holds most of it,
and around these every part with more content. All their lines and the lines between them are the
text, so short lines and headings stay. Parts whose tag says that they are a menu, an advert, a form
or the like never count. Parts whose name says so only count if they hold most of the content and
little of it is beside them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import slices, table, text_of, without

SIGMA = 1.0
RADIUS = 2
# A line is content if its smoothed ratio is above this share of the page's standard deviation.
SPREADS = 0.5

# Elements of HTML by their use.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset(
    "head script style template noscript svg math iframe object canvas audio video map "
    "title datalist".split()
)
BOILERPLATE = frozenset(
    "nav footer aside form button select option textarea input label fieldset dialog menu".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p "
    "pre section summary table tbody td tfoot th thead tr ul caption".split()
)
# Elements in which the article of a page may lie, as a whole.
CONTAINERS = frozenset("article main section div body td".split())
# Words in class, id, role or label that name other things than the article, wherever they stand.
OTHER = frozenset(
    "ad ads adsense adslot adunit advert adverts advertisement advertising banner sponsor sponsored "
    "promo promotion taboola outbrain nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar "
    "widget footer masthead topbar toolbar comment comments reply replies disqus cookie cookies "
    "consent gdpr popup modal newsletter subscribe subscription signup login share sharing social "
    "related recommended pagination complementary contentinfo".split()
)
# Words that do so only if nothing but such words and those for places and containers is beside them.
OTHER_ALONE = frozenset(
    "side header notice notices alert overlay respond pager search form skip dialog trending popular "
    "tags byline".split()
)
PLACES = frozenset(
    "area bar block bottom box button buttons bottom col column container content count cta entry form "
    "global group holder icons inner item items js left link links list main module more page panel "
    "placeholder post posts article articles stories reader region right row section site slot sticky "
    "thread top unit user users view wp wrap wrapper".split()
)
# Words before one of these that turn it round: a part without or beside such a thing.
TURNED = frozenset("no not non without with has hide hidden".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NAMES = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
# A part with a name of other things is kept for its content only if less than a tenth is elsewhere.
ELSEWHERE = 10


def hidden(attributes: list[tuple[str, str | None]]) -> bool:
    return any(k == "hidden" or (k == "aria-hidden" and v == "true") for k, v in attributes)


def names_other(tag: str, attributes: list[tuple[str, str | None]], in_article: bool) -> int:
    """How surely an element's own names say that it is no part of an article: 0, 1 or 2.

    Surely (2) if a name holds a listed word and else only words for places and containers, as in
    ``comment-list``; perhaps (1) if it holds such a word beside others, as in ``content-sidebar-wrap``.
    ``no-sidebar`` and ``has-comments`` say the opposite. Labels, and ids inside an article, may be
    the words of a heading and so need the sure form; a heading's id is never more than that. Inside
    an article a header is the article's own.
    """
    alone = OTHER_ALONE - {"header"} if in_article else OTHER_ALONE
    found = 0
    for key, value in attributes:
        if key not in ("class", "id", "role", "aria-label") or not value:
            continue
        if key == "id" and tag in HEADINGS:
            continue
        for name in [value] if key == "aria-label" else value.split():
            words = [word.lower() for word in NAMES.findall(name)]
            listed = OTHER.intersection(words)
            if not listed and alone.isdisjoint(words) or not TURNED.isdisjoint(words):
                continue
            if all(w in OTHER or w in alone or w in PLACES or len(w) == 1 for w in words):
                return 2
            if listed and (key == "class" or (key == "id" and not in_article)):
                found = 1
    return found


@dataclass(frozen=True)
class Line:
    """A line, its tags, the containers and the parts named as something else around it."""

    text: str
    tags: int
    path: tuple[int, ...]
    others: tuple[int, ...]
    dark: bool
    heading: bool


class Lines(HTMLParser):
    """Collects a page's lines with their tag counts and the containers around them."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.stack: list[tuple[str, int]] = []  # tag; container number, or 0
        self.containers: list[str] = [""]
        self.dark = 0  # depth below an element that is not shown or not content
        self.dark_at: list[int] = []
        self.others: list[tuple[int, int]] = []  # depth and number of open parts named otherwise
        self.sure: list[bool] = []  # whether the name of a part is surely one of other things
        self.words: list[str] = []
        self.tags = 0

    def end_line(self) -> None:
        text = " ".join("".join(self.words).split())
        if text:
            path = tuple(number for _, number in self.stack if number)
            others = tuple(number for _, number in self.others)
            heading = any(tag in HEADINGS for tag, _ in self.stack[-4:])
            self.lines.append(Line(text, self.tags, path, others, self.dark > 0, heading))
            self.tags = 0
        self.words = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag == "br":
            self.words.append(" ")
            return
        if tag in BLOCKS:
            self.end_line()
            self.close_implied(tag)
        if tag in VOID:
            return
        number = 0
        if tag in CONTAINERS:
            number = len(self.containers)
            self.containers.append(tag)
        in_article = any(t in ("article", "main") for t, _ in self.stack)
        dark = tag in UNSEEN or tag in BOILERPLATE or (tag == "header" and not in_article)
        named = tag not in ("html", "body", "article", "main")
        dark = dark or (named and hidden(attrs))
        self.stack.append((tag, number))
        if named and not dark and (sure := names_other(tag, attrs, in_article)):
            self.others.append((len(self.stack), len(self.sure)))
            self.sure.append(sure == 2)
        if dark:
            self.dark += 1
            self.dark_at.append(len(self.stack))

    def close_implied(self, tag: str) -> None:
        """A block ends an open paragraph, a list item ends the item before it."""
        for at in range(len(self.stack) - 1, -1, -1):
            open_tag = self.stack[at][0]
            same = open_tag == tag and tag in ("li", "dt", "dd", "tr", "td", "th", "option")
            if open_tag == "p" or same:
                self.pop_to(at)
                return
            if open_tag in BLOCKS:
                return

    def pop_to(self, length: int) -> None:
        del self.stack[length:]
        while self.dark_at and self.dark_at[-1] > length:
            self.dark_at.pop()
            self.dark -= 1
        while self.others and self.others[-1][0] > length:
            self.others.pop()

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.end_line()
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] == tag:
                self.pop_to(at)
                return

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "path", "use"):
            self.handle_endtag(tag)

    def handle_data(self, data: str) -> None:
        self.words.append(data if not self.unseen() else "")

    def unseen(self) -> bool:
        return self.dark > 0 and any(tag in UNSEEN for tag, _ in self.stack)


def smoothed(values: np.ndarray) -> np.ndarray:
    """Weighted means of each value and its neighbours, by a Gaussian that ends at the edges."""
    weights = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / SIGMA) ** 2)
    total = np.convolve(values, weights, mode="full")[RADIUS:-RADIUS]
    share = np.convolve(np.ones(len(values)), weights, mode="full")[RADIUS:-RADIUS]
    return total / share


def content_lines(ratios: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which lines belong to the cluster of high smoothed ratios; at least the highest does.

    The second result tells which lines are that high themselves and not only by their neighbours.
    """
    smooth = smoothed(ratios)
    threshold = min(SPREADS * float(ratios.std()), float(smooth.max()))
    return smooth >= threshold, ratios >= threshold


def content_of(lines: list[Line]) -> tuple[list[bool], list[bool]]:
    """Which lines are content, and which of these are so by themselves or as a heading."""
    ratios = np.array([len(x.text) / max(x.tags, 1) for x in lines], dtype=np.float64)
    content, high = content_lines(ratios)
    own = content & (high | np.array([x.heading for x in lines]))
    return content.tolist(), own.tolist()


def weights(lines: list[Line], chosen: list[bool], around: str) -> tuple[dict[int, int], int]:
    """Characters of content in each of the elements ``around`` the lines, and in all lines."""
    weight: dict[int, int] = {}
    total = 0
    for line, is_content in zip(lines, chosen):
        if is_content:
            total += len(line.text)
            for number in getattr(line, around):
                weight[number] = weight.get(number, 0) + len(line.text)
    return weight, total


def without_others(lines: list[Line], containers: list[str], sure: list[bool]) -> list[Line]:
    """The lines outside parts named as something else.

    A part that holds most content is named wrongly, unless enough is beside it: in an article or
    main element, or anywhere if the name is sure. Beside it means outside all parts of such names,
    but for those around the part itself.
    """
    if not any(line.others for line in lines):
        return lines
    chosen, _ = content_of(lines)
    weight, total = weights(lines, chosen, "others")
    kept = set()
    # Parts with most content lie within one another, so there are few.
    for part in (n for n, w in weight.items() if 2 * w > total):
        around = next(x.others[: x.others.index(part)] for x in lines if part in x.others)
        beside = sum(
            len(x.text) for x, is_content in zip(lines, chosen)
            if is_content and not x.heading and part not in x.others
            and set(x.others).issubset(around)
            and (sure[part] or any(containers[n] in ("article", "main") for n in x.path))
        )
        if ELSEWHERE * beside < total:
            kept.add(part)
    return [x for x in lines if kept.issuperset(x.others)]


def main_text(html: str | None) -> str:
    """The article's lines joined by line ends; empty for a page without one."""
    if not html:
        return ""
    page = Lines()
    page.feed(html)
    page.close()
    page.end_line()
    shown = without_others([x for x in page.lines if not x.dark], page.containers, page.sure)
    if not shown:
        return ""
    chosen, own = content_of(shown)
    weight, total = weights(shown, chosen, "path")
    # The outermost elements that say they are articles, if they hold most content, else the
    # innermost container with nearly all of it, else the page.
    says = [next((n for n in x.path if page.containers[n] in ("article", "main")), 0) for x in shown]
    named = {n for n, is_content in zip(says, chosen) if is_content and n}
    nearly = [n for n, w in weight.items() if 10 * w >= 9 * total]
    if 2 * sum(weight[n] for n in named) > total:
        regions = named
    elif nearly:
        regions = {max(nearly)}
    else:
        return "\n".join(line.text for line in shown)
    kept = [not regions.isdisjoint(line.path) for line in shown]
    # Beside them: lines that are content by themselves, and parts that are content for the most
    # part. A part is a container, or lines in a row where the container holds the regions too.
    holding = {n for line, inside in zip(shown, kept) if inside for n in line.path}
    parts, run = [], 0
    for at, line in enumerate(shown):
        innermost = line.path[-1] if line.path else 0
        run += at == 0 or kept[at - 1] or shown[at - 1].path != line.path
        parts.append(-run if innermost == 0 or innermost in holding else innermost)
    share: dict[int, int] = {}
    for line, part, is_content in zip(shown, parts, chosen):
        share[part] = share.get(part, 0) + (len(line.text) if is_content else -len(line.text))
    kept = [
        inside or is_own or share[part] >= 0
        for inside, is_own, part in zip(kept, own, parts)
    ]
    first, last = kept.index(True), len(kept) - kept[::-1].index(True)
    while first and shown[first - 1].heading:
        first -= 1
    return "\n".join(line.text for line in shown[first:last])


def extract_text(
    pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")
) -> DataFrame:
    """``keep`` columns, ``text`` and ``n_chars`` of every page.

    Character references are decoded, white space inside a block becomes one space, blocks are
    joined in page order by one line end. Null or empty html gives an empty text; unclosed or
    misplaced tags end nothing but themselves. Pages with the same id stay separate rows. An empty
    table gives an empty result.
    """
    rows = without(pages.select(*keep, text_of(html_col).alias("_html")), ["text", "n_chars"])
    rest = [c for c in rows.columns if c != "_html"]

    def extract(batches):
        for batch in batches:
            for part in slices(batch, 256):
                texts = [main_text(html) for html in part.column("_html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in rest], pa.array(texts, pa.string())],
                    names=[*rest, "text"],
                )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields
                       if f.name != "_html")
    texts = rows.mapInArrow(extract, f"{schema}, text string")
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))


def op7_extract_text(spark, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


QUERIES = {"op7_extract_text": op7_extract_text}
ORACLES: dict[str, str] = {}

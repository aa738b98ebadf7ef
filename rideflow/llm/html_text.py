"""Main text of pages: a maximum-scoring contiguous run of words and tags.

A page becomes a line of items in page order. Words score +1, tags cost what labelled pages say
they cost, as do names that may mark a part. Words of menus, headers, footers and sidebars outside the
article score what labelled pages say, less than nothing; one linear scan finds the best run, and so leaves them
out. What no text holds (scripts, styles) is not read, and adverts, forms of controls, notices and comments are cut from the run.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflow.llm.common import fresh, small_batches

#: Pages that the tag costs are learned from: the first ones by hash that mark their article.
FIT_PAGES = 400
#: Costs are in words. An unseen tag costs DEFAULT_COST; a learned cost lies between the other two.
LEAST_COST, DEFAULT_COST, MOST_COST = 0.02, 0.1, 3.0
PART_COST = 0.5
#: What a word of a menu, header, footer or sidebar costs where no labelled page has one.
OUT_COST = 1.0
#: Outside an article a name that may mark a part costs NAME_COST where unseen; a learned one up to MOST_NAME_COST.
NAME_COST, MOST_NAME_COST = 5.0, 20.0

_BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot "
    "th thead tr ul title".split()
)
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_DROPPED = set(
    "script style noscript template head title nav menu aside footer form fieldset button select textarea label iframe object svg "
    "canvas audio video map dialog datalist".split()
)
#: Of these the ones that furnish a page: outside the article their words are scored, not cut.
_FURNITURE = set("nav menu aside footer header hgroup".split())
#: Forms that hold one of these are a page's frame and not a form of controls alone.
_TEXT_BLOCKS = set("p h1 h2 h3 h4 h5 h6 article main section blockquote pre table".split())
#: Within one of these a label or button is part of a sentence.
_SENTENCES = set("p li td th dd dt blockquote figcaption h1 h2 h3 h4 h5 h6".split())
_UNSEEN = {"script", "style", "noscript", "template", "head", "title"}
#: Whole names in class and id that say outright that a block is not the article.
_DROPPED_NAMES = set(
    "ad ads adv advert adverts advertisement advertisements ad-banner ad-container ad-slot adsbygoogle sponsored-content cookie-notice "
    "cookie-banner cookie-consent cookie-bar gdpr-notice newsletter-signup sidebar nav navbar nav-bar main-nav site-nav nav-menu "
    "breadcrumb breadcrumbs share-buttons social-share social-links related-posts related-articles comment comments comment-list "
    "commentlist comment-body comments-area disqus-thread footer site-footer page-footer masthead popup modal pagination pager "
    "search-form login-form skip-link".split()
)
_DROPPED_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog menu menubar toolbar".split())
#: Names that mark a part of a page, but not of an article.
_PAGE_NAMES = set("masthead footer nav navbar pager pagination".split())
#: A page has one of these at its top; an article keeps its own.
_HEADER_NAMES = set("header site-header page-header".split())
#: What an article element is only when it is a reader's comment.
_COMMENTS = set("comment comment-body".split())
#: Words in class, id and role that may mark such a part; they cost, and the scan decides.
_DOUBTFUL_NAMES = set(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promoted promotion banner "
    "cookie cookies consent gdpr notice notices alert alerts newsletter subscribe subscription signup paywall sidebar aside menu nav "
    "navbar navigation breadcrumb breadcrumbs share sharing social related recommended recommendations comment comments commentlist "
    "discussion responses reply replies disqus header footer masthead popup modal overlay login search widget toolbar pagination pager "
    "contentinfo complementary dialog skip tracking".split()
)
_HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: Parts of the page that hold the article itself; only outside of them a header is a page header.
_ARTICLES = {"article", "main"}
_HEADERS = {"header", "hgroup"}
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")


class Item(NamedTuple):
    """One tag, dropped part, or piece of text of a page."""

    kind: str  # "tag", "name", "part", "text", "out" or "edge"; an edge parts the outermost articles from the rest
    value: str
    inside: bool  # within the page's article


def _whole_name(token: str) -> str:
    """A class or id in lower case with hyphens between its words, without numbers at its end."""
    return re.sub(r"(-[0-9]+)+$", "", "-".join(_NAME.findall(token)).lower())


def _doubtful_names(tag: str, attrs: list[tuple[str, str | None]]) -> list[str]:
    """The words in the names of a block that may mark it as a part; not of an article, main or heading."""
    if tag not in _BLOCKS or tag in _HEADINGS or tag in _ARTICLES:
        return []
    words = {n.lower() for key, value in attrs if key in ("class", "id", "role") for n in _NAME.findall(value or "")}
    return sorted(words & _DOUBTFUL_NAMES)


class _Open(NamedTuple):
    """An open element."""

    number: int  # of the page's elements, from 1 up
    tag: str
    drop: bool  # starts a dropped part
    article: bool  # counted as an article
    out: str = ""  # the furniture that it starts


class _Items(HTMLParser):
    """Reads a page into items. Broken nesting is read as far as it goes.

    ``closed`` are the elements with an end tag, known from an earlier reading. A part that stays
    open does not reach into an article; a closed one does, unless it is the page's first article.
    """

    def __init__(self, closed: frozenset[int] | None = None, frames: frozenset[int] = frozenset()) -> None:
        super().__init__(convert_charrefs=True)
        self.frames, self.found_frames = frames, set()
        self.heading: tuple[int, int] | None = None  # parent and place of the last first-level heading outside articles
        self.items: list[Item] = []
        self.open: list[_Open] = []
        self.dropped = self.articles = self.elements = 0
        self.known, self.closed = closed, set()
        self.unsure = self.entered = False
        self.last_edge: tuple[int, int] | None = None  # parent and place of the last article's end

    def _dropped_by(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in ("label", "button") and any(e.tag in _SENTENCES for e in self.open):
            return False
        if tag == "form" and self.elements + 1 in self.frames:
            return False
        if tag in _DROPPED or tag in _HEADERS and not self.articles:
            return True
        if tag in ("html", "body"):
            return False
        if any(key == "hidden" or key == "aria-hidden" and value == "true" for key, value in attrs):
            return True
        if tag in _HEADINGS or tag not in _BLOCKS or tag == "blockquote":
            return False
        tokens = {_whole_name(t) for key, value in attrs if key in ("class", "id") for t in (value or "").split()}
        if tag in _ARTICLES:
            return tag == "article" and bool(tokens & _COMMENTS)
        if self.articles:
            tokens -= _PAGE_NAMES
        roles = {t.lower() for key, value in attrs if key == "role" for t in (value or "").split()}
        return bool(tokens & _DROPPED_NAMES or roles & _DROPPED_ROLES or not self.articles and tokens & _HEADER_NAMES)

    def _add(self, kind: str, value: str) -> None:
        if not self.dropped:
            self.items.append(Item(kind, value, self.articles > 0))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        drop = self._dropped_by(tag, attrs)
        if tag == "body" or tag in _ARTICLES and not drop:
            self._close_dropped(first=tag == "body" or not self.entered)
        if tag in _VOID:
            if not drop:
                self._add("tag", tag)
            return
        out = tag if drop and tag in _FURNITURE and not self.articles and not self.dropped else ""
        drop = drop and not out
        if tag in _TEXT_BLOCKS:
            self.found_frames.update(e.number for e in self.open if e.tag == "form")
        if tag == "h1" and not self.articles and not self._out():
            self.heading = self._parent(), len(self.items)
        self._add("part" if drop or out else "tag", tag)
        if not drop and not out:
            for name in _doubtful_names(tag, attrs):
                self._add("name", name)
        article = tag in _ARTICLES and not drop and not self.dropped
        if article and not self.articles:
            self._enter(tag)
        self.articles += article
        self.elements += 1
        self.open.append(_Open(self.elements, tag, drop, article, out))
        self.dropped += drop

    def _out(self) -> str:
        """The innermost furniture that is open; an article in it is not part of it."""
        return next((e.out for e in reversed(self.open) if e.out), "") if not self.articles else ""

    def _parent(self) -> int:
        return self.open[-1].number if self.open else 0

    def _enter(self, tag: str) -> None:
        """An edge before an outermost article; none between articles with the same parent, or with nothing between them.

        A first-level heading beside the article, and what follows it, belong to the article.
        """
        first, self.entered = not self.entered, True
        if first and self.heading and self.heading[0] == self._parent():
            at = self.heading[1]
            self.items[at:] = [Item("edge", tag, True), *(i._replace(inside=True) for i in self.items[at:])]
            return
        if self.last_edge and (
            self.last_edge[0] == self._parent() or all(i.kind == "tag" or i.kind == "text" and not i.value.strip() for i in self.items[self.last_edge[1] + 1 :])
        ):
            place = self.last_edge[1]
            self.items[place] = self.items[place]._replace(kind="tag")
        else:
            self.items.append(Item("edge", tag, True))

    def handle_endtag(self, tag: str) -> None:
        if not any(e.tag == tag for e in reversed(self.open)):
            if tag in _BLOCKS:
                self._add("tag", "/" + tag)
            return
        while self.open:
            last = self.open.pop()
            self.dropped -= last.drop
            if last.article:
                self.articles -= 1
                if not self.articles:
                    self.last_edge = self._parent(), len(self.items)
                    self.items.append(Item("edge", "/" + last.tag, True))
            if last.tag == tag:
                self.closed.add(last.number)
                break
        self._add("tag", "/" + tag)

    def _close_dropped(self, first: bool) -> None:
        """What was left open before the body or the article does not reach into it."""
        if not self.dropped:
            return
        self.unsure = self.unsure or not first
        if first or self.known is not None:
            self.open = [e if e.drop and not first and e.number in self.known else e._replace(drop=False) for e in self.open]
            self.dropped = sum(e.drop for e in self.open)

    def handle_data(self, data: str) -> None:
        if data and not self.dropped:
            out = self._out()
            self._add("out" if out else "text", f"{out}\n{data}" if out else data)


def page_items(html: str) -> list[Item]:
    parser = _read(html)
    frames = frozenset(parser.found_frames)
    if frames:  # forms around the page
        parser = _read(html, None, frames)
    if parser.unsure:  # an article within a dropped part: it counts what was closed later on
        parser = _read(html, frozenset(parser.closed), frames)
    return parser.items


def _read(html: str, closed: frozenset[int] | None = None, frames: frozenset[int] = frozenset()) -> _Items:
    parser = _Items(closed, frames)
    parser.feed(html)
    parser.close()
    return parser


def _score(item: Item, costs: dict[str, float]) -> float:
    if item.kind == "text":
        return float(len(item.value.split()))
    if item.kind == "out":
        tag, _, words = item.value.partition("\n")
        return -costs.get("~" + tag, OUT_COST) * len(words.split())
    if item.inside:  # the mark says more than tags; empty rows and names cut nothing off an article
        return 0.0
    if item.kind == "part":
        return 0.0 if item.value in _UNSEEN else -PART_COST
    if item.value.startswith("/"):
        return 0.0
    if item.kind == "name":
        return -costs.get("." + item.value, NAME_COST)
    return -costs.get(item.value, DEFAULT_COST)


def _ends_block(item: Item) -> bool:
    return item.kind in ("edge", "name") or item.kind not in ("text", "out") and item.value.removeprefix("/") in _BLOCKS


def best_run(items: list[Item], costs: dict[str, float]) -> tuple[int, int]:
    """Start and end of the contiguous run with the largest sum; the first and longest of equal ones.

    No run crosses the edge of an outermost article: the scan starts anew there. A tag costs when words follow in its
    element; an empty element costs nothing.
    """
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    waiting: list[float] = []
    for i, item in enumerate(items):
        if item.kind == "edge":
            total, start = 0.0, i + 1
            waiting.clear()
            continue
        if item.kind == "tag":
            if not item.value.startswith("/"):
                waiting.append(_score(item, costs))
            elif waiting:
                waiting.pop()
        elif item.kind in ("text", "out") and item.value.strip():
            for cost in waiting:
                total += cost
            waiting.clear()
        if total < 0:
            total, start = 0.0, i
        if item.kind != "tag":
            total += _score(item, costs)
        if total > best or total == best and found[1] and start == found[0]:
            best, found = total, (start, i + 1)
    return found


def main_text(html: str | None, costs: dict[str, float]) -> str:
    """The text of the best run: white space in a block is one space, blocks are lines."""
    items = page_items(html or "")
    start, end = best_run(items, costs)
    while 0 < start < end and not _ends_block(items[start - 1]) and items[start - 1].kind != "out":  # the run begins and ends at whole blocks
        start -= 1
    while start < end < len(items) and not _ends_block(items[end]) and items[end].kind != "out":
        end += 1
    blocks, piece = [], []

    def flush() -> None:
        text = " ".join("".join(piece).split())
        if text:
            blocks.append(text)
        piece.clear()

    for item in items[start:end]:
        if item.kind == "text":
            piece.append(item.value)
        elif item.kind == "out":
            piece.append(item.value.partition("\n")[2])
        elif _ends_block(item):
            flush()
        elif item.value == "br":
            piece.append(" ")
    flush()
    return "\n".join(blocks)


def tag_costs(pages: DataFrame) -> dict[str, float]:
    """The cost of each tag and doubtful name (``.name``) in words, from a bounded sample of pages that mark their article.

    A tag or name costs more, the more often it stands outside the articles; one that is commoner
    inside has the least cost. Without labelled pages all have the default cost.
    """
    marked = pages.where(F.lower("html").contains("<article")).select("html", F.xxhash64("html").alias("hash"))
    first = marked.select("hash").distinct().orderBy("hash").limit(FIT_PAGES)
    sample = marked.join(F.broadcast(first), "hash").groupBy("hash").agg(F.min("html").alias("html")).select("html")

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            seen: Counter = Counter()
            for html in part["html"]:
                for item in page_items(html):
                    if item.kind == "out":
                        seen["~" + item.value.partition("\n")[0], item.inside] += len(item.value.split()) - 1
                    elif item.kind == "name":
                        seen["." + item.value, item.inside] += 1
                    elif item.kind == "tag" and not item.value.startswith("/"):
                        seen[item.value, item.inside] += 1
            yield pd.DataFrame([(t, i, n) for (t, i), n in seen.items()], columns=["tag", "inside", "n"])

    counted = sample.mapInPandas(count, "tag string, inside boolean, n long").groupBy("tag")
    rows = counted.agg(
        F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("within"), F.sum(F.when(F.col("inside"), 0).otherwise(F.col("n"))).alias("without")
    ).collect()
    costs = {}
    for r in rows:
        share = (r["without"] + 0.5) / (r["within"] + r["without"] + 1.0)
        if r["tag"].startswith("~"):
            costs[r["tag"]] = max(LEAST_COST, 2 * share - 1)
            continue
        most = MOST_NAME_COST if r["tag"].startswith(".") else MOST_COST
        costs[r["tag"]] = LEAST_COST if share <= 0.5 else min(most, LEAST_COST + (most - LEAST_COST) * (2 * share - 1))
    return costs


def extracted(pages: DataFrame, costs: dict[str, float] | None = None) -> DataFrame:
    """The pages with ``text``, empty where there is none; null and empty pages have none.

    Pages are read one by one and whole. A column ``text`` of the input stays; the new one then
    gets a longer name.
    """
    spark: SparkSession = pages.sparkSession
    small_batches(spark)
    known = tag_costs(pages) if costs is None else costs

    @F.pandas_udf("string")
    def text_of(htmls: pd.Series) -> pd.Series:
        return htmls.map(lambda h: main_text(h, known))

    return pages.withColumn(fresh(pages, "text"), text_of(F.coalesce(F.col("html"), F.lit(""))))


def page_report(pages: DataFrame) -> DataFrame:
    """One row per page with its text and the text's length in code points."""
    rows = extracted(pages.select("page_id", "url", "html"))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))

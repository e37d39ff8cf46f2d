"""Main text of web pages by markup and nearest-URL page differencing.

1. A page's markup gives text blocks. Blocks of elements that never hold an article (menus,
   sidebars, comments ...) are left out, those that only a name or a form marks unless they
   hold most of the page; blocks inside an article or main element that holds as much as
   the rest are sure to belong to the article, others aren't.
2. Pages are paired by URL path within their host: each with the one whose path shares
   the longest beginning among its neighbours in path order. Different pages of one path are
   paired in order of their query strings.
3. The text lines of a pair are aligned by longest common subsequence. Lines in common that
   aren't sure are the site's, not the article's, and are deleted. Where most of a page's
   text is in common, a second neighbour decides: its lines in common are
   deleted if it's no copy either, and lines that all three have if they leave text of the
   page's own. Else the pages are copies of one article, and it stays.

Only hashes of lines travel between pages.
"""

from __future__ import annotations

import os.path
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from html.parser import HTMLParser
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.tables import Workspace

#: A page that has more than this share of its text in common with its neighbour may be a copy of it.
COPY = 0.5
#: It is none if, without the lines that a second neighbour has too, this share is its own.
OWN = 0.1
#: Cells of an alignment that are kept as bits at once; larger ones are divided.
CELLS = 1 << 24

# Elements without text of the article, elements that end a text block,
# elements without an end, and words in class, id or role of the former.
OUTSIDE = frozenset(
    "script style noscript template head title nav footer aside button select option textarea input label iframe object "
    "svg canvas audio video menu dialog datalist fieldset legend".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center caption dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MARKED = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent "
    "contentinfo cookie cookies dialog disqus footer gdpr login masthead menu menubar modal nav navbar navigation newsletter "
    "notice notices notification pager pagination popup promo promoted promotion related replies reply search share sharing "
    "sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
#: Of these, the names of what is never an article, however much of a page it holds.
NEVER = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer gdpr masthead menubar nav navbar navigation newsletter notice notices pager pagination replies reply sidebar "
    "sponsor sponsored subscribe".split()
)
#: Words that say nothing about what an element so named holds.
NEUTRAL = frozenset("area block body box container form group holder inner item items list new reader section thread user users wrap".split())
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_BLANK = re.compile(r"\s+")
_NAMES = re.compile(r"[a-z]+")
#: Words; scripts without blanks count by characters.
_WORDS = re.compile(r"[\u2e80-\u9fff]|\w+")


@dataclass(frozen=True)
class _Place:
    """Whether text is outside, in main (1), in an article (2) or both (3), the number of the article,
    and the marked elements around it."""

    outside: bool = False
    held: int = 0
    article: int = 0
    marks: tuple[int, ...] = ()


class _Blocks(HTMLParser):
    """Collects (text, place, whether it's links alone) per block."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, _Place, bool]] = []
        self.open: list[tuple[str, _Place]] = []
        #: Marked elements: how, 0 if a form is all they are.
        self.named: list[int] = []
        self.articles = 0
        self.text: list[str] = []
        self.link_free = False

    def _state(self) -> _Place:
        return self.open[-1][1] if self.open else _Place()

    def _flush(self) -> None:
        text, place = _BLANK.sub(" ", "".join(self.text)).strip(), self._state()
        # List items of links alone, outside an article, are a menu.
        if text and (self.link_free or place.held or not any(name == "li" for name, _ in self.open)):
            self.blocks.append((text, place, not self.link_free))
        self.text, self.link_free = [], False

    def _is_outside(self, tag: str, given: dict[str, str | None], held: int) -> bool:
        if tag in OUTSIDE or tag == "header" and not held:
            return True
        return "hidden" in given or given.get("aria-hidden") == "true" or bool(_HIDDEN.search(given.get("style") or ""))

    def _marked(self, tag: str, given: dict[str, str | None]) -> int:
        """Whether a whole class, id or role is made of marked and neutral words (1), all of them such as
        no article has (2)."""
        if tag in ("html", "body", "main"):
            return 0
        found = 0
        for name in " ".join(given.get(key) or "" for key in ("class", "id", "role")).lower().split():
            words = [word for word in _NAMES.findall(name) if word not in NEUTRAL]
            if words and MARKED.issuperset(words):
                found = max(found, 2 if NEVER.issuperset(words) else 1)
        return found

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID:
            if tag == "hr":
                self._flush()
            elif tag == "br":
                self.text.append(" ")
            return
        if tag in BLOCKS:
            self._flush()
            # An unclosed paragraph or list item ends where the next block or item begins.
            closes = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",)}
            self._close_within(closes.get(tag, ("p",)))
        place, given = self._state(), dict(attrs)
        if tag in ("article", "main") and not any(block.held for _, block, _ in self.blocks) and not place.held:
            place = _Place()  # an element before it was never closed
        if self._is_outside(tag, given, place.held):
            place = replace(place, outside=True)
        marked = self._marked(tag, given)
        if tag == "form" or marked:
            place = replace(place, marks=(*place.marks, len(self.named)))
            self.named.append(marked)
        if tag in ("article", "main") and not any(self.named[mark] for mark in place.marks):
            if tag == "article" and not place.article:
                self.articles += 1
                place = replace(place, article=self.articles)
            place = replace(place, held=place.held | {"main": 1, "article": 2}[tag])
        self.open.append((tag, place))

    def _close_within(self, tags: tuple[str, ...]) -> None:
        for at in range(len(self.open) - 1, -1, -1):
            name = self.open[at][0]
            if name in tags:
                del self.open[at:]
                return
            if name in BLOCKS:
                return

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        # Browsers take <div/> as <div>; only foreign elements close themselves.
        if tag in ("svg", "path", "iframe", "script", "style"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self._flush()
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                del self.open[at:]
                return
            if tag not in BLOCKS and self.open[at][0] in BLOCKS:
                return  # an inline end doesn't close a block

    def handle_data(self, data: str) -> None:
        if not self._state().outside:
            self.text.append(data)
            if not self.link_free and data.strip():
                self.link_free = not any(name == "a" for name, _ in self.open)


def blocks_of(html: str) -> tuple[list[str], list[bool]]:
    """The page's candidate blocks, and which are sure to be the article's.

    Elements named as what an article never is (comments, sidebars, notices, …) are left out, other marked ones
    where they hold at most half of the remaining words; those that stay are never sure. With an article
    element that holds as many words as what is beside it, only articles are candidates;
    else with a main element that holds as many as what is outside, all of that; else all
    that isn't outside. Only what such an element holds by itself is sure.
    """
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    parser._flush()
    words = [len(_WORDS.findall(text)) for text, _, _ in parser.blocks]
    marked = [0] * len(parser.named)
    for n, (_, place, _) in zip(words, parser.blocks, strict=True):
        for mark in place.marks:
            marked[mark] += n
    never = {mark for mark, how in enumerate(parser.named) if how == 2}
    rest = sum(n for n, (_, place, _) in zip(words, parser.blocks, strict=True) if never.isdisjoint(place.marks))
    left = never | {mark for mark, n in enumerate(marked) if 2 * n <= rest}
    live = [k for k, (_, place, _) in enumerate(parser.blocks) if left.isdisjoint(place.marks)]
    articles, main, body, nested = {}, 0, 0, 0
    for k in live:
        _, place, links = parser.blocks[k]
        if any(parser.named[mark] for mark in place.marks) or links and not place.held:
            continue
        if place.held & 2:
            articles[place.article] = articles.get(place.article, 0) + words[k]
            nested += words[k] * (place.held & 1)
        elif place.held:
            main += words[k]
        else:
            body += words[k]
    largest = max(articles.values(), default=0)
    if articles and largest >= max(main, body):
        level, certain = 2, True
    elif main and main + nested >= body:
        level, certain = 1, not articles
    else:
        level, certain = 0, False
    kept = [parser.blocks[k] for k in live if parser.blocks[k][1].held & level == level]
    return [text for text, _, _ in kept], [certain and not place.marks for _, place, _ in kept]


def _row(row: int, matches: int, full: int) -> int:
    """One step of the bit-parallel LCS (Crochemore et al. 2001): a bit is 0 where the
    length grows."""
    own = row & matches
    return ((row + own) | (row - own)) & full


def _positions(x: np.ndarray) -> dict[int, int]:
    found: dict[int, int] = {}
    for i, value in enumerate(x.tolist()):
        found[value] = found.get(value, 0) | 1 << i
    return found


def _lengths(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """LCS lengths of all beginnings of x with the whole of y."""
    at, full = _positions(x), (1 << len(x)) - 1
    v = full
    for value in y.tolist():
        v = _row(v, at.get(value, 0), full)
    zeros = ~v & full
    bits = np.unpackbits(np.frombuffer(zeros.to_bytes(len(x) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(x)]
    return np.concatenate(([0], np.cumsum(bits)))


def common_lines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Places in x of one longest common subsequence with y."""
    start = 0
    while start < min(len(x), len(y)) and x[start] == y[start]:
        start += 1
    end = 0
    while end < min(len(x), len(y)) - start and x[len(x) - 1 - end] == y[len(y) - 1 - end]:
        end += 1
    outer = np.concatenate((np.arange(start), np.arange(len(x) - end, len(x))))
    a, b = x[start : len(x) - end], y[start : len(y) - end]
    keep = np.flatnonzero(np.isin(a, b))
    inner = keep[_aligned(a[keep], b[np.isin(b, a)])]
    return np.sort(np.concatenate((outer, inner + start)))


def _aligned(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    if not len(x) or not len(y):
        return np.empty(0, np.int64)
    if len(y) == 1:
        return np.flatnonzero(x == y[0])[:1]
    if len(x) * len(y) > CELLS:  # Hirschberg: divide y, and x where both parts fit best
        half = len(y) // 2
        fits = _lengths(x, y[:half]) + _lengths(x[::-1], y[half:][::-1])[::-1]
        cut = int(fits.argmax())
        return np.concatenate((_aligned(x[:cut], y[:half]), _aligned(x[cut:], y[half:]) + cut))
    at, full = _positions(x), (1 << len(x)) - 1
    rows = [full]
    for value in y.tolist():
        rows.append(_row(rows[-1], at.get(value, 0), full))
    length = lambda i, j: (~rows[j] & ((1 << i) - 1)).bit_count()
    found, i, j = [], len(x), len(y)
    while i and j:
        if x[i - 1] == y[j - 1]:
            i, j = i - 1, j - 1
            found.append(i)
        elif length(i - 1, j) >= length(i, j - 1):
            i -= 1
        else:
            j -= 1
    return np.array(found[::-1], np.int64)


def _site(url: str | None) -> tuple[str | None, str | None, str | None]:
    """Host, path and query string; None without a host."""
    try:
        parts = urlsplit((url or "").strip())
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return None, None, None
    return (host, parts.path or "/", parts.query) if host else (None, None, None)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        urls, pages = batch.column(1).to_pylist(), batch.column(3)
        for start in range(0, len(pages), 256):
            part = pages.slice(start, 256).to_pylist()
            found = [blocks_of(html or "") for html in part]
            sites = [_site(url) for url in urls[start : start + 256]]
            lines = [text for text, _ in found]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(k).slice(start, 256) for k in range(3)),
                    *(pa.array([site[k] for site in sites], pa.string()) for k in range(3)),
                    pa.array(lines, pa.list_(pa.string())),
                    pa.array([sure for _, sure in found], pa.list_(pa.bool_())),
                    pa.array([np.array([xxhash.xxh3_64_intdigest(t) for t in text], np.uint64).view(np.int64) for text in lines], pa.list_(pa.int64())),
                    pa.array([[len(t) for t in text] for text in lines], pa.list_(pa.int32())),
                ],
                ["page_id", "url", "page", "host", "path", "query", "lines", "sure", "hashes", "sizes"],
            )


def _of_the_site(hashes: np.ndarray, sizes: np.ndarray, others: np.ndarray, second: np.ndarray | None) -> np.ndarray:
    """Places of lines that the neighbours show to be the site's."""
    found, most = common_lines(hashes, others), COPY * sizes.sum()
    if sizes[found].sum() <= most:
        return found
    if second is None:
        return found[:0]
    also = common_lines(hashes, second)
    if sizes[also].sum() <= most:
        return also
    found = np.intersect1d(found, also)
    # Copies of one article are the same up to a date or a counter.
    return found if sizes.sum() - sizes[found].sum() >= OWN * sizes.sum() else found[:0]


def _shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        columns = ["id", "page", "hashes", "sizes", "sure", "others", "second"]
        for name, page, hashes, sizes, sure, others, second in batch[columns].itertuples(index=False):
            sizes, sure = np.asarray(sizes), np.asarray(sure, bool)
            found = _of_the_site(np.asarray(hashes), sizes, np.asarray(others), None if second is None else np.asarray(second))
            rows.append((name, page, found[~sure[found]].tolist()))
        yield pd.DataFrame(rows, columns=["id", "page", "gone"])


def _nearer(path: pd.Series, before: pd.Series, after: pd.Series) -> pd.Series:
    def choose(own: str, one: str | None, two: str | None) -> str | None:
        if one is None or two is None:
            return one if two is None else two
        shared = [len(os.path.commonprefix((own, other))) for other in (one, two)]
        return one if shared[0] >= shared[1] else two

    return pd.Series([choose(*x) for x in zip(path, before.replace({np.nan: None}), after.replace({np.nan: None}), strict=True)], dtype=object)


def partners(paths: DataFrame, work: Workspace) -> DataFrame:
    """(host, path, partner, second) of distinct (host, path): the nearest other path of the
    host, and the neighbour on the other side, at the host's ends the partner's other one, if any.

    Paths are dealt out by range, so that a host of any size is spread; neighbours across the
    ends of ranges come from a table with a row per range.
    """
    order = ["host", "path"]
    ranged = paths.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = work.write(ranged.withColumn("part", F.spark_partition_id()), "paths")
    site = F.struct(*order)
    within = Window.partitionBy("part").orderBy(*order)
    near = ranged.select("part", *order, F.lag(site).over(within).alias("before"), F.lead(site).over(within).alias("after"))
    parts = Window.orderBy("part")
    ends = ranged.groupBy("part").agg(F.min(site).alias("least"), F.max(site).alias("most"))
    ends = ends.select("part", F.lag("most").over(parts).alias("earlier"), F.lead("least").over(parts).alias("later"))
    near = near.join(ends, "part").select(
        *order, F.coalesce("before", "earlier").alias("before"), F.coalesce("after", "later").alias("after")
    )
    same = lambda name: F.when(F.col(f"{name}.host") == F.col("host"), F.col(f"{name}.path"))
    nearer = F.pandas_udf(_nearer, "string")
    found = near.select(*order, same("before").alias("before"), same("after").alias("after"))
    found = found.withColumn("partner", nearer("path", "before", "after")).where("partner is not null")
    other = F.when(F.col("partner").eqNullSafe(F.col("before")), F.col("after")).otherwise(F.col("before"))
    beyond = found.select("host", F.col("path").alias("partner"), F.col("before").alias("one"), F.col("after").alias("two"))
    further = F.when(F.col("one").eqNullSafe(F.col("path")), F.col("two")).otherwise(F.col("one"))
    return found.join(beyond, ["host", "partner"]).select(*order, "partner", F.coalesce(other, further).alias("second"))


def _apart(placed: DataFrame) -> DataFrame:
    """``placed`` with the path as ``base``, and query strings in ``path`` where they name different pages."""
    print_ = F.xxhash64("hashes")
    several = placed.groupBy("host", "path").agg(
        ((F.min(print_) < F.max(print_)) & (F.min("query") < F.max("query"))).alias("several")
    )
    found = placed.withColumn("base", F.col("path")).join(several, ["host", "path"])
    return found.withColumn("path", F.when(F.col("several"), F.concat_ws("?", "base", "query")).otherwise(F.col("base")))


def page_hash(*columns: str) -> Column:
    """Tells pages of one id apart."""
    return F.xxhash64(*columns)


def main_text(pages: DataFrame, work: Workspace) -> DataFrame:
    """page_id, url, text, n_chars per row of ``pages`` (page_id, url, html).

    text joins the article's blocks in page order by two line ends; white space within a block is
    one space; character references are decoded. n_chars counts its code points.

    Null and empty pages, and pages without an article's text, give the empty text. Pages
    without a host in their URL, or alone on their host, are not compared. Different
    pages of one path are compared with each other, in order of their query strings, and with
    a page of a neighbouring path. Rows of one path and query string share a neighbour; of its
    own rows, the one with the smallest hash is compared. Null
    page_ids and repeated rows give rows of their own. No rows give no rows. Other columns
    aren't read. Pages of any length and number of lines work.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    rows = rows.select("page_id", "url", page_hash("page_id", "url", "html").alias("page"), "html")
    parsed = work.write(
        rows.mapInArrow(
            _parsed,
            "page_id long, url string, page long, host string, path string, query string, lines array<string>, sure array<boolean>, "
            "hashes array<long>, sizes array<int>",
        ),
        "pages",
    )
    placed = _apart(parsed.where("host is not null"))
    paths = placed.groupBy("host", "path").agg(F.min_by("hashes", "page").alias("others"), F.min("base").alias("base"))
    # Pages of one path are likely to be alike: a neighbouring path is the second witness.
    bases = paths.groupBy("host", "base").agg(F.min("path").alias("path"))
    next_to = partners(bases.select("host", F.col("base").alias("path")), work).select("host", F.col("path").alias("base"), F.col("partner").alias("next"))
    next_to = next_to.join(bases.toDF("host", "next", "beside"), ["host", "next"]).select("host", "base", "beside")
    pairs = partners(paths, work).join(paths.select("host", "path", "base"), ["host", "path"]).join(next_to, ["host", "base"], "left")
    inside = F.startswith("partner", F.concat("base", F.lit("?"))) & (F.col("path") != F.col("base"))
    pairs = pairs.withColumn("second", F.when(inside, F.coalesce("beside", "second")).otherwise(F.col("second")))
    others = pairs.join(paths.select("host", F.col("path").alias("partner"), "others"), ["host", "partner"])
    others = others.select("host", "path", "others", F.col("second").alias("aside"))
    others = others.join(paths.select("host", F.col("path").alias("aside"), F.col("others").alias("second")), ["host", "aside"], "left")
    # Pages are told apart by their id and a hash; a missing id is as good as any.
    name = F.coalesce("page_id", F.lit(0)).alias("id")
    unsure = placed.where(F.exists("sure", lambda s: ~s)).select(name, "host", "path", "page", "hashes", "sizes", "sure")
    gone = (
        unsure.distinct()
        .join(others.select("host", "path", "others", "second"), ["host", "path"])
        .select("id", "page", "hashes", "sizes", "sure", "others", "second")
        .mapInPandas(_shared, "id long, page long, gone array<int>")
        .where(F.size("gone") > 0)
    )
    gone = work.write(gone, "gone")
    kept = parsed.withColumn("id", name).join(gone, ["id", "page"], "left")
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    left = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(F.transform(places, lambda k: F.get("lines", k)))
    kept = kept.select("page_id", "url", F.array_join(left, "\n\n").alias("text"))
    return kept.withColumn("n_chars", F.char_length("text").cast("long"))

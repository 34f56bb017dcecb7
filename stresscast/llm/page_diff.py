"""Main text of web pages by structure and by differencing with the nearest page of the host.

A page is read into text lines, one per block, each with its zone: *content* (inside an ``article`` or ``main``),
*chrome* (inside a menu, header, footer, sidebar, notice, advert, form or comment section, by element, role or
class), or *open* (anywhere else). Pages of a host are sorted by URL path; a page's partner is the nearest page
of another URL before or after it, the one that shares the longer beginning of the path. Rows of one URL are neighbours
and have the same partner. The lines of the two pages are aligned by a longest common subsequence,
and shared lines are deleted as template.

Content lines are never deleted: pages that hold copies of one article would lose it, and so would pages whose
articles share a passage. A page with content lines is its content lines; a page without is its open lines less
the shared ones (all of them if nothing else is left: a copy tells nothing about the template).

Scale: pages are dealt into parts of consecutive addresses by bounds that a first pass over the addresses alone finds,
so a hot host or path is many parts; only the rows of one URL are always in one. Each part is streamed in order; beside the page, the last page of another URL is held, and
the rows of one URL wait (on local disk if they are many) for the next URL. The first and last URL of a part meet their
neighbours in a small stream. Pages are shuffled once and not written.
"""

from __future__ import annotations

import pickle
import re
import tempfile
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stresscast.llm.common import docs_with

CONTENT, OPEN, CHROME = "content", "open", "chrome"
#: Elements that start and end a block of text.
BLOCKS = frozenset("""address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th
thead tr ul""".split())
#: Elements without end tags.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never part of a page's lines.
UNSEEN = frozenset("head script style noscript template iframe object svg canvas select button textarea title".split())
CHROME_TAGS = frozenset("nav footer aside form menu dialog".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
CHROME_NAMES = frozenset("""ad ads adv advert adverts advertisement advertisements advertising banner banners breadcrumb breadcrumbs
comment comments consent cookie cookies disqus footer header masthead menu menus modal nav navbar navigation newsletter notice
notices popup promo promos promotion related replies reply share sharing sidebar sidebars social sponsor sponsored subscribe
toolbar widget widgets""".split())
#: A class or id with one of these tells of the page's state ("has-sidebar", "menu-open"), not what the element is.
STATE_NAMES = frozenset("has with no not without is hide show open closed layout enabled disabled active collapsed expanded".split())
#: Inside content a class or id names chrome only if it has no word but chrome names and these.
PART_NAMES = frozenset("""area articles bar block box button buttons container form icons items label link links list media placeholder
posts section signup slot tools unit wrap wrapper""".split())
#: Elements that names never make chrome: headings have ids made of their text.
NEVER_NAMED = frozenset("html body main article h1 h2 h3 h4 h5 h6".split())
#: Names that say little beside one of the second group ("entry-header", "content with-sidebar").
WEAK_NAMES = frozenset("banner banners header sidebar sidebars toolbar widget widgets".split())
#: Elements a head may hold; any other closes it.
HEAD_TAGS = frozenset("html head base link meta title style script noscript template".split())
CONTENT_NAMES = frozenset("article body content entry main post story text".split())
#: An open element of these is closed by a start tag of the same group.
IMPLIED_ENDS = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
                "th": ("td", "th"), "option": ("option",)}


class Line(NamedTuple):
    zone: str
    text: str


class _Reader(HTMLParser):
    """Collects lines; tolerates unclosed, stray and cut off markup."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.stack: list[tuple[str, str | None]] = []  # element, the zone it opens if any
        self.parts: list[str] = []

    def zone(self) -> str:
        out = OPEN
        for _, z in self.stack:
            if z == CHROME:
                return CHROME
            out = z or out
        return out

    def end_block(self) -> None:
        text = " ".join("".join(self.parts).split())
        self.parts.clear()
        if text:
            self.lines.append(Line(self.zone(), text))

    def opens(self, tag: str, attrs: dict[str, str | None]) -> str | None:
        if tag in CHROME_TAGS or "hidden" in attrs or (attrs.get("role") or "").lower() in CHROME_ROLES:
            return CHROME
        within = self.zone() == CONTENT
        if tag == "header" and not within:
            return CHROME
        if tag not in NEVER_NAMED and self.named_chrome(tag, attrs, within):
            return CHROME
        return CONTENT if tag in ("article", "main") else None

    @staticmethod
    def named_chrome(tag: str, attrs: dict[str, str | None], within: bool) -> bool:
        ids = "" if within and tag == "section" else attrs.get("id") or ""  # sections have the ids of their headings
        each = [set(re.split(r"[^a-z]+", x)) - {""} for x in f"{attrs.get('class') or ''} {ids}".lower().split()]
        names = set().union(*each)
        if within:
            each = [x for x in each if x <= CHROME_NAMES | PART_NAMES]
        named = CHROME_NAMES & set().union(*[x for x in each if not x & STATE_NAMES])
        return bool(named - WEAK_NAMES if names & CONTENT_NAMES else named)

    def leave_head(self) -> None:
        at = next((i for i, (t, _) in enumerate(self.stack) if t == "head"), None)
        if at is not None:
            del self.stack[at:]

    def in_head(self) -> bool:
        return bool(self.stack) and self.stack[-1][0] == "head"

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "body" or tag not in HEAD_TAGS and self.in_head():
            self.leave_head()
        if tag in BLOCKS:
            self.end_block()
        if tag in VOID:
            return
        for closed in IMPLIED_ENDS.get(tag, ()):
            # Inline elements left open inside a paragraph do not keep it open.
            at = next((i for i in range(len(self.stack) - 1, -1, -1) if self.stack[i][0] in BLOCKS or self.stack[i][0] in UNSEEN), None)
            if at is not None and self.stack[at][0] == closed:
                del self.stack[at:]
        self.stack.append((tag, self.opens(tag, dict(attrs))))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in HEAD_TAGS and self.in_head():
            self.leave_head()
        if tag in BLOCKS:
            self.end_block()

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.end_block()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                return

    def handle_data(self, data: str) -> None:
        if self.in_head() and data.strip():
            self.leave_head()
        if not any(t in UNSEEN for t, _ in self.stack):
            self.parts.append(data)


def page_lines(html: str | None) -> list[Line]:
    """Text lines of a page in order, with their zones. A null page has none."""
    reader = _Reader()
    reader.feed(html or "")
    reader.close()
    reader.end_block()
    return reader.lines


def common_lines(a: list[str], b: list[str]) -> list[bool]:
    """For each line of ``a``: it is in a longest common subsequence with ``b`` (Hirschberg, linear memory)."""
    ids: dict[str, int] = {}
    x, y = (np.array([ids.setdefault(t, len(ids)) for t in z], np.int64) for z in (a, b))
    shared = [False] * len(a)

    def row(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        best = np.zeros(len(q) + 1, np.int64)
        for v in p:
            best[1:] = np.maximum.accumulate(np.maximum(best[1:], best[:-1] + (q == v)))
        return best

    todo = [(0, len(x), 0, len(y))]
    while todo:
        i, j, k, n = todo.pop()
        while i < j and k < n and x[i] == y[k]:
            shared[i] = True
            i, k = i + 1, k + 1
        while i < j and k < n and x[j - 1] == y[n - 1]:
            j, n = j - 1, n - 1
            shared[j] = True
        if i == j or k == n:
            continue
        if j - i == 1:
            shared[i] = bool((y[k:n] == x[i]).any())
            continue
        mid = (i + j) // 2
        ahead, behind = row(x[i:mid], y[k:n]), row(x[mid:j][::-1], y[k:n][::-1])[::-1]
        cut = k + int(np.argmax(ahead + behind))
        todo += [(i, mid, k, cut), (mid, j, cut, n)]
    return shared


class Page(NamedTuple):
    page_id: int | None
    url: str | None
    host: str
    path: str
    html: str | None

    def nearness(self, other: Page | None) -> int:
        """Length of the common beginning of the paths; -1 for no page, another host or the same URL."""
        if other is None or other.host != self.host or other.url == self.url:
            return -1
        n = 0
        for p, q in zip(self.path, other.path):
            if p != q:
                break
            n += 1
        return n


def main_text(lines: list[Line], partner: list[Line]) -> tuple[str, int]:
    """Main text of a page given its partner's lines, and the number of its lines shared with it."""
    shared = common_lines([x.text for x in lines], [x.text for x in partner]) if partner else [False] * len(lines)
    content = [x.text for x in lines if x.zone == CONTENT]
    if not content:
        content = [x.text for x, s in zip(lines, shared) if x.zone == OPEN and not s]
        content = content or [x.text for x in lines if x.zone == OPEN]
    return "\n".join(content), sum(shared)


_PAGE = "part int, ghost boolean, page_id long, url string, host string, path string, html string"
_OUT = "page_id long, url string, text string, n_chars long, partner_id long, n_shared long"
#: Rows of one URL that wait in memory for the next URL.
WAITING_ROWS = 64


def _rows(pages: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in pages:
        yield from zip(*(c.to_pylist() for c in b.columns))


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [x.strip().split(" ") for x in schema.split(",")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[t]) for i, (_, t) in enumerate(names)],
                                      [n for n, _ in names])


def _batches(rows: Iterator[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for row in rows:
        out.append(row)
        if len(out) >= 64:
            yield _batch(out, schema)
            out = []
    yield _batch(out, schema)


class _Memory:
    """Lines of the last few pages, so that each is read once."""

    def __init__(self) -> None:
        self.known: dict[int, tuple[Page, list[Line]]] = {}

    def __call__(self, page: Page) -> list[Line]:
        if id(page) not in self.known:
            if len(self.known) > 3:
                del self.known[next(iter(self.known))]
            self.known[id(page)] = page, page_lines(page.html)
        return self.known[id(page)][1]


class _Run:
    """The rows of one URL in a part; many of them wait in a local file of the task's own. Ghosts are only neighbours."""

    def __init__(self, part: int, first: Page) -> None:
        self.part, self.first, self.last = part, first, first
        self.pages: list[Page] = []
        self.file = None

    def add(self, page: Page, ghost: bool) -> None:
        self.last = page
        if not ghost:
            self.pages.append(page)
        if len(self.pages) >= WAITING_ROWS:
            self.file = self.file or tempfile.TemporaryFile()
            pickle.dump([tuple(x) for x in self.pages], self.file)
            self.pages = []

    def __iter__(self) -> Iterator[Page]:
        if self.file:
            end = self.file.tell()
            self.file.seek(0)
            while self.file.tell() < end:
                yield from (Page(*x) for x in pickle.load(self.file))
        yield from self.pages


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Run | None, _Run, _Run | None]]:
    """Each URL of sorted pages, between the URLs before and after it in its part."""
    def each() -> Iterator[_Run | None]:
        run = None
        for part, ghost, *page in _rows(batches):
            now = Page(*page)
            if run is None or run.part != part or run.first.url != now.url:
                if run is not None:
                    yield run
                run = _Run(part, now)
            run.add(now, ghost)
        if run is not None:
            yield run
        yield None

    before = run = None
    for after in each():
        if run is not None:
            yield (before if before and before.part == run.part else None, run,
                   after if after and after.part == run.part else None)
        before, run = run, after


def _answers(edges: bool):
    """Over pages sorted by part and address: answers for the inner URLs of each part, or for all URLs of an edge."""

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        read = _Memory()
        for before, run, after in _runs(batches):
            if not edges and not (before and after):
                continue
            near = [x for x in (before and before.last, after and after.first) if run.first.nearness(x) >= 0]
            partner = max(near, key=run.first.nearness, default=None)
            lines = read(partner) if partner else []
            for page in run:
                text, shared = main_text(read(page), lines)
                yield page.page_id, page.url, text, len(text), partner.page_id if partner else None, shared

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(answered(batches), _OUT)

    return run


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and last URL of each part with one page of their neighbours inside it, and a page of each for the part
    before and the part after."""

    def found() -> Iterator[tuple]:
        for before, run, after in _runs(batches):
            if before and after:
                continue
            yield from ((run.part, False, *page) for page in run)
            if before:
                yield (run.part, True, *before.last)
            else:
                yield (run.part - 1, True, *run.first)
            if after:
                yield (run.part, True, *after.first)
            else:
                yield (run.part + 1, True, *run.last)

    return _batches(found(), _PAGE)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars, partner_id, n_shared)`` per page row.

    ``text`` joins the main text's blocks by line feeds (empty if there is none), ``partner_id`` is the nearest page
    of the host with another URL (null if none), ``n_shared`` the lines shared with it. Null html is an empty page; pages
    without a URL form a host of their own; repeated rows each get their row. Empty table: no rows.
    """
    spark = pages.sparkSession
    url = F.coalesce(F.col(url_col), F.lit(""))
    rows = docs_with(pages, id_col, url_col, html_col).select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(url, r"^(?:(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*)?([^?#]*)", 1).alias("path"),
        F.col(html_col).alias("html"))
    keys = ["host", "path", "url", "page_id", "html"]
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    # Parts of consecutive pages, by bounds from the addresses alone: the same for both passes below.
    place = F.concat_ws("\n", "host", "path", "url")
    sizes = rows.select(place.alias("place")).repartitionByRange(n, "place").groupBy(F.spark_partition_id()).agg(F.min("place"))
    bounds = np.array(sorted(r[1] for r in sizes.collect()), object)

    @F.pandas_udf("int")
    def part_of(places: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, places.to_numpy(object), "right"), dtype="int32")

    dealt = rows.select(part_of(place).alias("part"), F.lit(False).alias("ghost"), *rows.columns).repartition(n, "part")
    dealt = dealt.sortWithinPartitions("part", *keys)
    # Every part has pages, so the parts beside one have the numbers beside its own.
    edges = dealt.mapInArrow(_edges, _PAGE).repartition(n, "part").sortWithinPartitions("part", *keys)
    return dealt.mapInArrow(_answers(False), _OUT).unionByName(edges.mapInArrow(_answers(True), _OUT))

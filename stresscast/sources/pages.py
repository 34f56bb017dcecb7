"""Notice pages (S11, S12): stored HTML pages to list rows and detail fields.

HTML parsing is the one step Spark's built-ins cannot express, so it runs in
``mapInPandas`` (Arrow batches of pages, stdlib ``html.parser``; each task
parses the pages of its partition). Everything after the parse - positional
field mapping, timestamp parsing, the take-while cutoff - is DataFrame code.
Selectors are arguments: the source site marks rows with ``tr`` and the
detail with ids containing ``headingData`` / ``bulletin``.
"""

from __future__ import annotations

from dataclasses import dataclass
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from stresscast.functions.scalar import (clean_text_list, critical_flag, normalize_space, parse_notice_ts, safe_get,
                                         strip_ws)
from stresscast.operators.filters import take_while_newer

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


@dataclass(frozen=True)
class Selector:
    """Element match: tag name (None = any) and a substring of the id (None = any)."""
    tag: str | None = None
    id_contains: str | None = None

    def match(self, tag: str, attrs: dict) -> bool:
        if self.tag and tag != self.tag:
            return False
        if self.id_contains and self.id_contains not in (attrs.get("id") or ""):
            return False
        return True


class _Walker(HTMLParser):
    """Collects, in document order: rows (cells + links), heading text nodes, body outer HTML."""

    def __init__(self, row: Selector, cell: str, heading: Selector, body: Selector):
        super().__init__(convert_charrefs=False)
        self.row_sel, self.cell_tag, self.head_sel, self.body_sel = row, cell, heading, body
        self.stack: list[tuple[str, bool, bool, bool]] = []  # tag, opens row, opens heading, opens body
        self.rows: list[dict] = []
        self.cur: dict | None = None
        self.cell_buf: list[str] | None = None
        self.heading: list[str] = []
        self.head_depth = 0
        self.in_text = False  # no tag since the last text: an entity or reference continues the node
        self.body_parts: list[str] = []
        self.body_depth = 0

    def handle_starttag(self, tag, attrs):
        self.in_text = False
        a = {k: (v or "") for k, v in attrs}
        opens_row = self.cur is None and self.row_sel.match(tag, a)
        if opens_row:
            self.cur = {"cells": [], "links": [], "cell_links": [], "text": []}
        if self.cur is not None:
            if tag == self.cell_tag and self.cell_buf is None:
                self.cell_buf = []
                self.cur["cell_links"].append([])
            if tag == "a" and a.get("href"):
                self.cur["links"].append(a["href"])
                if self.cell_buf is not None:
                    self.cur["cell_links"][-1].append(a["href"])
        opens_head = self.head_sel.match(tag, a)
        if opens_head:
            self.head_depth += 1
        opens_body = self.body_sel.match(tag, a) and self.body_depth == 0
        if opens_body or self.body_depth:
            self.body_parts.append(self.get_starttag_text() or f"<{tag}>")
        if opens_body:
            self.body_depth = 1
        elif self.body_depth and tag not in VOID:
            self.body_depth += 1
        if tag not in VOID:
            self.stack.append((tag, opens_row, opens_head, opens_body))

    def handle_endtag(self, tag):
        self.in_text = False
        if tag in VOID or not any(t == tag for t, *_ in self.stack):
            return
        while self.stack:
            t, o_row, o_head, _ = self.stack.pop()
            if self.body_depth:
                self.body_parts.append(f"</{t}>")
                self.body_depth -= 1
            if self.cur is not None and t == self.cell_tag and self.cell_buf is not None:
                self.cur["cells"].append("".join(self.cell_buf))
                self.cell_buf = None
            if o_head:
                self.head_depth -= 1
            if o_row and self.cur is not None:
                self.rows.append(self.cur)
                self.cur = None
            if t == tag:
                break

    def _text(self, data, raw):
        if self.cur is not None:
            self.cur["text"].append(data)
            if self.cell_buf is not None:
                self.cell_buf.append(data)
        if self.head_depth:
            if self.in_text and self.heading:
                self.heading[-1] += data
            else:
                self.heading.append(data)
        self.in_text = True
        if self.body_depth:
            self.body_parts.append(raw)

    def handle_data(self, data):
        self._text(data, data)

    def handle_entityref(self, name):
        from html import unescape
        self._text(unescape(f"&{name};"), f"&{name};")

    def handle_charref(self, name):
        from html import unescape
        self._text(unescape(f"&#{name};"), f"&#{name};")


#: Parts of the addresses that lead to a notice.
DETAIL_LINKS = ("NoticeDetail", "NoticesDetail", "Notice")
LIST_SCHEMA = StructType([StructField("page_id", LongType()), StructField("row_pos", IntegerType()),
                          StructField("cells", ArrayType(StringType())), StructField("row_text", StringType()),
                          StructField("href", StringType()), StructField("detail_url", StringType())])


def extract_list_rows(pages: DataFrame, row: Selector = Selector("tr"), cell: str = "td",
                      link_contains: tuple[str, ...] = DETAIL_LINKS) -> DataFrame:
    """S11 parse: rows holding a matching link; link = second-last cell's link, else the row's first link;
    absolute URL from the page URL. Empty ``link_contains`` accepts any link."""

    def parse(it):
        for pdf in it:
            out = []
            for pid, url, html in zip(pdf["page_id"], pdf["url"], pdf["html"]):
                w = _Walker(row, cell, Selector("\0"), Selector("\0"))
                w.feed(html or "")
                w.close()
                pos = 0
                for r in w.rows:
                    if link_contains and not any(s in h for h in r["links"] for s in link_contains):
                        continue
                    cl = r["cell_links"]
                    href = cl[-2][0] if len(cl) >= 2 and cl[-2] else (r["links"][0] if r["links"] else None)
                    out.append((int(pid), pos, r["cells"], "".join(r["text"]), href,
                                urljoin(url or "", href) if href else None))
                    pos += 1
            yield pd.DataFrame(out, columns=LIST_SCHEMA.fieldNames())
    return pages.select("page_id", "url", "html").mapInPandas(parse, LIST_SCHEMA)


def list_notices(rows: DataFrame, cutoff_date, time_cell: int = 1) -> DataFrame:
    """S11 filters: posted time from a cell (normalize-space, fixed format), rows with no time or
    no link skipped, take-while newer than the cutoff per page in row order (P11)."""
    d = rows.withColumn("posted_dt", parse_notice_ts(normalize_space(F.get("cells", time_cell))))
    d = d.withColumn("_pd", F.to_date("posted_dt"))
    # the cutoff is checked before the link: an old row without a link still ends the scan
    kept = take_while_newer(d, "_pd", cutoff_date, ["page_id"], "row_pos").drop("_pd")
    return kept.where(F.col("detail_url").isNotNull())


DETAIL_SCHEMA = StructType([StructField("page_id", LongType()), StructField("url", StringType()),
                            StructField("heading", ArrayType(StringType())), StructField("body", StringType())])


def extract_detail(pages: DataFrame, heading: Selector = Selector("div", "headingData"),
                   body: Selector = Selector("div", "bulletin")) -> DataFrame:
    """S12 parse: all text nodes under the heading element(s); outer HTML of the body element(s)."""

    def parse(it):
        for pdf in it:
            out = []
            for pid, url, html in zip(pdf["page_id"], pdf["url"], pdf["html"]):
                w = _Walker(Selector("\0"), "\0", heading, body)
                w.feed(html or "")
                w.close()
                out.append((int(pid), url, w.heading, "".join(w.body_parts).strip()))
            yield pd.DataFrame(out, columns=DETAIL_SCHEMA.fieldNames())
    return pages.select("page_id", "url", "html").mapInPandas(parse, DETAIL_SCHEMA)


def detail_fields(detail: DataFrame, list_posted: DataFrame | None = None, keep_blanks: bool = False,
                  legacy_truthy: bool = False) -> DataFrame:
    """S12 mapping: cleaned heading nodes by position to notice fields.

    Positions: 0 tsp, 1 name, 2 critical label, 3-4 effective, 5-6 end, 7 notice id,
    8 status, 9 type, 10-11 posted, 12 prior id, 13 response, 14-15 response time,
    16 subject. Blank nodes are dropped before mapping (so a blank shifts later
    fields, §8 Q22) unless ``keep_blanks``. A missing posted time falls back to
    the list page's time when ``list_posted`` (url, posted_dt) is given.
    """
    h = F.transform("heading", lambda s: strip_ws(s)) if keep_blanks \
        else clean_text_list("heading")
    d = detail.withColumn("_h", h)

    def g(i):
        return safe_get("_h", i)

    def ts(i, j):
        return parse_notice_ts(F.concat_ws(" ", g(i), g(j)))

    out = d.select(
        "page_id", "url", F.lit("pipeline").alias("kind"), g(0).alias("tsp"), g(1).alias("name"),
        g(7).alias("notice_id"),
        F.when(critical_flag(g(2), legacy_truthy), "Y").otherwise("N").alias("critical"),
        ts(3, 4).alias("effective_dt"), ts(5, 6).alias("end_dt"), F.lower(g(8)).alias("status"),
        F.lower(g(9)).alias("type"), ts(10, 11).alias("_posted"), g(12).alias("prior_id"), g(13).alias("response"),
        ts(14, 15).alias("response_dt"), g(16).alias("subject"), F.col("body"),
        F.size("_h").alias("n_heading"))
    if list_posted is not None:
        out = out.join(list_posted.select(F.col("detail_url").alias("url"), F.col("posted_dt").alias("_lp")),
                       "url", "left")
        posted = F.coalesce("_posted", "_lp")
    else:
        posted = F.col("_posted")
    return out.withColumn("posted_dt", posted).drop("_posted", "_lp")

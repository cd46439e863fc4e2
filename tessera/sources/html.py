"""Pages of an HTML listing: links to pages, and rows of tables."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.results import numbers
from ..schema import INPUT_COLUMNS

HREF = r"""(?is)<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""


def hrefs(html: Column) -> Column:
    """Targets of all links of a page."""
    return F.regexp_extract_all(html, F.lit(HREF), F.lit(1))


def page_number(url: Column) -> Column:
    """The whole number of the query parameter ``page`` of a link, relative ones included, or null."""
    return F.try_parse_url(url, F.lit("QUERY"), F.lit("page")).try_cast("bigint")


def last_page(pages: DataFrame, html: str = "html", by: list[str] = ()) -> DataFrame:
    """(by, last_page): the largest page number that links name, 1 without any."""
    links = pages.select(*by, F.explode_outer(hrefs(F.col(html))).alias("_href"))
    return links.groupBy(*by).agg(F.coalesce(F.max(page_number(F.col("_href"))), F.lit(1)).alias("last_page"))


class _FirstTable(HTMLParser):
    """Cell texts of the rows of the first table: pieces of text joined by one space, each stripped."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[list[str]] = []
        self.depth, self.done, self.cell = 0, False, None

    def handle_starttag(self, tag, attrs):
        if self.done:
            return
        if tag == "table":
            self.depth += 1
        elif self.depth and tag == "tr":
            self.cell = None
            self.rows.append([])
        elif self.depth and tag in ("td", "th"):
            if not self.rows:
                self.rows.append([])
            self.cell = []
            self.rows[-1].append(self.cell)

    def handle_endtag(self, tag):
        if tag in ("td", "th"):
            self.cell = None
        elif tag == "table" and self.depth and not self.done:
            self.depth -= 1
            self.done = self.depth == 0

    def handle_data(self, data):
        if self.cell is not None and data.strip():
            self.cell.append(data.strip())


def table_rows(html: str | None, width: int = len(INPUT_COLUMNS)) -> list[list[str]]:
    """Rows of ``width`` cells of the first table, without the header row, whose first cell is 'no' in any case."""
    parser = _FirstTable()
    parser.feed(html or "")
    parser.close()
    rows = [[" ".join(cell) for cell in row] for row in parser.rows]
    return [r for r in rows if r and r[0].strip().lower() != "no" and len(r) == width]


def parse_tables(pages: DataFrame, key: str = "page_id", html: str = "html", width: int = len(INPUT_COLUMNS)) -> DataFrame:
    """(key, row, cells): the table rows of each page in their order, from 1."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [table_rows(h, width) for h in b.column(1).to_pylist()]
            owner = [i for i, rows in enumerate(found) for _ in rows]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(owner, pa.int64())), pa.array([n for rows in found for n in range(1, len(rows) + 1)], pa.int64()), pa.array([r for rows in found for r in rows], pa.list_(pa.string()))], ["key", "row", "cells"])

    return pages.select(F.col(key).alias("key"), F.col(html).alias("html")).mapInArrow(run, f"key {kind}, row bigint, cells array<string>").withColumnRenamed("key", key)


def listing(pages: DataFrame, page: str = "page_id") -> DataFrame:
    """All facilities of a listing's pages, under their workbook column names; No is a number or null."""
    rows = parse_tables(pages, page).select(page, "row", *(F.col("cells")[i].alias(c) for i, c in enumerate(INPUT_COLUMNS)))
    return rows.withColumn("No", numbers(F.col("`No`")))


def fetch_pages(spark: SparkSession, url: str, last: int, delay: float = 0.2, timeout: float = 30.0, per_second: float = 5.0) -> DataFrame:
    """(page_id, html) of pages 1 to ``last``: GET with ``page`` and an empty ``search``; an HTTP error fails the read.

    Pages are few and a server bears few requests, so tasks are as many as keep
    ``per_second`` with the delay after each.
    """

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import time
        from urllib.parse import urlencode
        from urllib.request import urlopen

        for b in batches:
            for n in b.column(0).to_pylist():
                with urlopen(f"{url}?{urlencode({'page': n, 'search': ''})}", timeout=timeout) as r:
                    html = r.read().decode(r.headers.get_content_charset() or "utf-8", "replace")
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([html])], ["page_id", "html"])
                time.sleep(delay)

    return spark.range(1, last + 1, 1, max(1, int(per_second * delay))).mapInArrow(get, "page_id bigint, html string")

"""HTML tables as rows of cells, and the layouts of the state feeds."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from furrow.functions import scalars as X
from furrow.session import ship


class _Cells(HTMLParser):
    """Rows of all tables in page order: (table, caption before it, row, cells, whether they are headers, whether one holds a link)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[int, str, int, list[str], bool, bool]] = []
        self.table, self.row, self.caption, self.loose = -1, -1, "", ""
        self.cells: list[str] | None = None
        self.cell: list[str] | None = None
        self.head = self.link = False
        self.depth = 0

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag == "table":
            self.depth += 1
            self.table, self.row, self.caption, self.loose = self.table + 1, -1, " ".join(self.loose.split()), ""
        elif tag == "tr":
            self._end_row()
            self.cells, self.head, self.link = [], False, False
        elif tag in ("td", "th") and self.cells is not None:
            self._end_cell()
            self.cell, self.head = [], self.head or tag == "th"
        elif tag == "a":
            self.link = True
        elif tag in ("span", "h1", "h2", "h3", "h4", "caption") and not self.depth:
            self.loose = ""

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th"):
            self._end_cell()
        elif tag == "tr":
            self._end_row()
        elif tag == "table":
            self._end_row()
            self.depth -= 1

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell.append(data)
        elif not self.depth:
            self.loose += data

    def _end_cell(self) -> None:
        if self.cell is not None and self.cells is not None:
            self.cells.append(" ".join("".join(self.cell).split()))
        self.cell = None

    def _end_row(self) -> None:
        self._end_cell()
        if self.cells:
            self.row += 1
            self.rows.append((self.table, self.caption, self.row, self.cells, self.head, self.link))
        self.cells = None


def table_rows(html: str | None) -> list[tuple[int, str, int, list[str], bool, bool]]:
    p = _Cells()
    p.feed(html or "")
    p.close()
    return p.rows


def read_rows(pages: DataFrame, key: str = "page_id", column: str = "html") -> DataFrame:
    """Rows (key, table, caption, row, cells, head, link) of the tables in pages, a batch of pages at a time."""
    ship(pages.sparkSession)

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = [(k, *r) for k, h in zip(f[key], f[column], strict=True) for r in table_rows(h)]
            yield pd.DataFrame(out, columns=[key, "table", "caption", "row", "cells", "head", "link"])

    kind = dict(pages.dtypes)[key]
    return pages.select(key, column).mapInPandas(run, f"{key} {kind}, table int, caption string, row int, cells array<string>, head boolean, link boolean")


def header_records(rows: DataFrame, key: str = "page_id", drop: tuple[str, ...] = ()) -> DataFrame:
    """Records (key, table, caption, row, record map) of tables whose first row names the columns.

    Rows with another number of cells than the header are left out, "No Data" tables are empty.
    """
    head = F.first("cells").over(Window.partitionBy(key, "table").orderBy("row"))
    body = rows.withColumn("header", head).where((F.col("row") > 0) & (F.size("cells") == F.size("header")))
    body = body.where(~F.exists("cells", lambda c: F.lower(c) == "no data"))
    record = F.map_from_arrays("header", "cells")
    if drop:
        record = F.map_filter(record, lambda k, _: ~k.isin(*drop))
    return body.select(key, "table", "caption", "row", record.alias("record"))


def dated_rows(rows: DataFrame, key: str = "page_id", width: int = 7) -> DataFrame:
    """Rows of width cells with the date of the last row of one cell above them."""
    date = F.when(F.size("cells") == 1, F.col("cells")[0])
    carried = F.last(date, ignorenulls=True).over(Window.partitionBy(key, "table").orderBy("row"))
    return rows.withColumn("date", carried).where(F.size("cells") == width)


def grid_rows(rows: DataFrame, width: int = 9) -> DataFrame:
    """Rows of width cells, or one more with a group's name in front; rows with links (pagers) are left out."""
    cells = F.when(F.size("cells") == width + 1, F.slice("cells", 2, width)).when(F.size("cells") == width, F.col("cells"))
    return rows.where(~F.col("link")).withColumn("cells", F.transform(cells, X.number_or_text)).where("cells is not null")

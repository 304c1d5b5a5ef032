"""Tables in HTML documents as cells with their place, header path and value.

Spans are laid out as browsers do: a cell takes the first free slots of its row, and every slot it covers
gets a row here. Leading rows of header cells alone (or in ``thead``) are the table's header; a column's
header path is its header values from top to bottom, repeated ones once.

Malformed markup has a defined reading: a new cell, row or table end closes what is still open in that
table, cells outside rows open one, a document's end closes all, spans that are no numbers from 1 to
``MOST_SPAN`` count as 1, spans that run past the last row or over a taken slot end there. Tables within a
cell are tables of their own, numbered by their start, and no part of that cell's value.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_SPAN = 1000
SEPARATOR = " / "
CELLS = (
    "filename string, customer_id string, table_index int, parent int, row_index int, column_index int,"
    " header_path string, value string, is_header boolean, spanned boolean"
)


def _span(value: str | None) -> int:
    value = (value or "").strip()
    return int(value) if re.fullmatch("[0-9]{1,4}", value) and 1 <= int(value) <= MOST_SPAN else 1


class _Tables(HTMLParser):
    """Collects tables as (parent, rows); a row is (in thead, cells), a cell [is th, colspan, rowspan, text]."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables: list[tuple[int | None, list]] = []
        self.open: list[dict] = []  # innermost last
        self.silent = 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.silent += 1
        if tag == "table":
            parent = self.open[-1]["number"] if self.open else None
            self.open.append({"number": len(self.tables), "row": False, "cell": None, "head": False})
            self.tables.append((parent, []))
        elif self.open:
            now = self.open[-1]
            rows = self.tables[now["number"]][1]
            if tag in ("thead", "tbody", "tfoot"):
                now.update(row=False, cell=None, head=tag == "thead")
            elif tag == "tr":
                now.update(row=True, cell=None)
                rows.append((now["head"], []))
            elif tag in ("td", "th"):
                if not now["row"]:
                    now["row"] = True
                    rows.append((now["head"], []))
                named = dict(attrs)
                now["cell"] = [tag == "th", _span(named.get("colspan")), _span(named.get("rowspan")), []]
                rows[-1][1].append(now["cell"])
            elif tag in ("br", "p", "div", "li"):
                self.handle_data(" ")

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.silent = max(0, self.silent - 1)
        elif self.open:
            now = self.open[-1]
            if tag == "table":
                self.open.pop()
            elif tag in ("td", "th"):
                now["cell"] = None
            elif tag in ("tr", "thead", "tbody", "tfoot"):
                now.update(row=False, cell=None, head=now["head"] and tag == "tr")

    def handle_data(self, data):
        if self.open and not self.silent and self.open[-1]["cell"] is not None:
            self.open[-1]["cell"][3].append(data)


def _laid_out(rows: list) -> list[dict[int, tuple]]:
    """Per row: column -> (value, is header cell, is a covered slot but not the first)."""
    grid: list[dict[int, tuple]] = [{} for _ in rows]
    for r, (_, cells) in enumerate(rows):
        column = 0
        for is_header, wide, high, parts in cells:
            while column in grid[r]:
                column += 1
            value = " ".join("".join(parts).split())
            for c in range(column, column + wide):
                if c in grid[r]:
                    break
                for below in range(r, min(r + high, len(rows))):
                    if c in grid[below]:
                        break
                    grid[below][c] = (value, is_header, (below, c) != (r, column))
                column = c + 1
    return grid


def cells_of(html: str) -> Iterator[tuple]:
    """(table_index, parent, row_index, column_index, header_path, value, is_header, spanned) of the body
    slots, rows numbered behind the header; of a table that is header alone, none."""
    parser = _Tables()
    parser.feed(html)
    parser.close()
    for number, (parent, rows) in enumerate(parser.tables):
        grid = _laid_out(rows)
        heads = 0
        while heads < len(rows) and (
            rows[heads][0] or (grid[heads] and all(is_header for _, is_header, _ in grid[heads].values()))
        ):
            heads += 1
        paths: dict[int, list[str]] = {}
        for row in grid[:heads]:
            for c, (value, *_) in row.items():
                own = paths.setdefault(c, [])
                if value and (not own or own[-1] != value):
                    own.append(value)
        for r, row in enumerate(grid[heads:]):
            for c in sorted(row):
                value, is_header, spanned = row[c]
                yield number, parent, r, c, SEPARATOR.join(paths.get(c, [])), value, is_header, spanned


def table_cells(docs: DataFrame, html: str = "html") -> DataFrame:
    """(filename, customer_id, html) to one row per body slot of every table. Documents without tables, and
    null ones, have no rows; repeated documents come as often as they occur. A document's tables are held
    by its own task alone, and rows leave in batches."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in CELLS.split(", ")]
        held = []
        for batch in batches:
            for filename, customer, text in batch.itertuples(index=False):
                for cell in cells_of(text or ""):
                    held.append((filename, customer, *cell))
                    if len(held) >= 10_000:
                        yield pd.DataFrame(held, columns=names).astype({"parent": "Int32"})
                        held = []
        yield pd.DataFrame(held, columns=names).astype({"parent": "Int32"})

    found = docs.select(
        F.col("filename").cast("string"), F.col("customer_id").cast("string"), F.col(html).cast("string").alias("html")
    )
    # A page without this word has no table: it is not sent to Python.
    return found.filter(F.lower("html").contains("<table")).mapInPandas(read, CELLS)


def table_rows(cells: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row per body row of a table: filename, customer_id, table_index, row_index and, for each name in
    ``columns``, the value under that header path (whatever its case; the leftmost of several). Rows with
    none of them are left out."""

    def under(path: str) -> Column:
        mine = F.lower("header_path") == path.lower()
        return F.min(F.when(mine, F.struct("column_index", "value")))["value"]

    keys = ["filename", "customer_id", "table_index", "row_index"]
    wanted = cells.filter(F.lower("header_path").isin([p.lower() for p in columns.values()]))
    return wanted.groupBy(*keys).agg(*[under(path).alias(name) for name, path in columns.items()])

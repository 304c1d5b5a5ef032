from __future__ import annotations

import random

import pytest
from pricing_audit.operators import layout


def cells(html):
    return [(c[0], c[2], c[3], c[4], c[5]) for c in layout.cells_of(html)]


def test_header_spans_and_row_spans():
    html = (
        "<table><tr><th rowspan=2>Size</th><th colspan=2>Price</th></tr><tr><th>EUR</th><th>USD</th></tr>"
        "<tr><td rowspan=2>S<br>mall</td><td>1</td><td>2 &amp; 3</td></tr><tr><td>4</td><td>5</td></tr></table>"
    )
    assert cells(html) == [
        (0, 0, 0, "Size", "S mall"), (0, 0, 1, "Price / EUR", "1"), (0, 0, 2, "Price / USD", "2 & 3"),
        (0, 1, 0, "Size", "S mall"), (0, 1, 1, "Price / EUR", "4"), (0, 1, 2, "Price / USD", "5"),
    ]
    assert [c[7] for c in layout.cells_of(html)] == [False, False, False, True, False, False]


@pytest.mark.parametrize("html,want", [
    ("<table><tr><th>a<th>b<tr><td>1<td>2<tr><td>3", [(0, 0, 0, "a", "1"), (0, 0, 1, "b", "2"), (0, 1, 0, "a", "3")]),
    ("<table><td>1<td>2</table> tail", [(0, 0, 0, "", "1"), (0, 0, 1, "", "2")]),
    ("<table><thead><tr><td>a</thead><tbody><tr><td>1</table>", [(0, 0, 0, "a", "1")]),
    ("<TABLE><tr><th>only</th></tr></TABLE>", []),
    ("</table><table></table>text <td>no", []),
    ("<table><tr><td colspan=x rowspan=0>1<td colspan='2'>2<tr><td rowspan=9>3</table>",
     [(0, 0, 0, "", "1"), (0, 0, 1, "", "2"), (0, 0, 2, "", "2"), (0, 1, 0, "", "3")]),
    ("<table><tr><td>a<script>var x='<td>'</script>b<td>c</table>", [(0, 0, 0, "", "ab"), (0, 0, 1, "", "c")]),
    ("", []), ("no table", []),
])
def test_malformed_markup(html, want):
    assert cells(html) == want


def test_nested_tables():
    html = "<table><tr><td>out <table><tr><td>in</table> side<td>x</table>"
    assert cells(html) == [(0, 0, 0, "", "out side"), (0, 0, 1, "", "x"), (1, 0, 0, "", "in")]
    assert {c[0]: c[1] for c in layout.cells_of(html)} == {0: None, 1: 0}


def test_random_grids_are_read_back():
    rng = random.Random(1)
    for _ in range(200):
        high, wide, grid, rows = rng.randint(1, 6), rng.randint(1, 6), {}, []
        for r in range(high):
            row = ""
            for c in range(wide):
                if (r, c) in grid:
                    continue
                free = next(k for k in range(1, wide - c + 1) if c + k == wide or (r, c + k) in grid)
                w, h = rng.randint(1, free), rng.randint(1, high - r)
                if any((r + i, c + j) in grid for i in range(h) for j in range(w)):
                    h = 1
                for i in range(h):
                    for j in range(w):
                        grid[r + i, c + j] = f"{r}.{c}"
                row += f"<td colspan={w} rowspan={h}>{r}.{c}" + rng.choice(["</td>", "", " "])
            rows.append("<tr>" + row + rng.choice(["</tr>", ""]))
        got = {(r, c): v for _, r, c, _, v in cells("<table>" + "".join(rows) + "</table>")}
        assert got == grid


def test_cells_of_a_table_of_documents(spark):
    html = "<table><tr><th>Size<th>Price<tr><td>S<td>1<tr><td>M<td>2</table>"
    docs = spark.createDataFrame(
        [("a", "c", html, "x"), ("a", "c", html, "x"), ("b", None, None, "x"), ("d", "c", "", "x"), (None, "c", html, "x")],
        "filename string, customer_id string, html string, value string",
    )
    found = layout.table_cells(docs)
    assert found.count() == 12 and found.filter("filename is null").count() == 4
    rows = layout.table_rows(found.dropDuplicates(), {"size": "size", "price": "PRICE", "none": "none"})
    got = sorted((str(r.filename), r.row_index, r["size"], r.price, r.none) for r in rows.collect())
    assert got == [("None", 0, "S", "1", None), ("None", 1, "M", "2", None), ("a", 0, "S", "1", None), ("a", 1, "M", "2", None)]
    assert layout.table_cells(docs.limit(0)).count() == 0

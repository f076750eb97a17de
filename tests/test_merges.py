"""Merges in tables with spans, against a grid of places."""

import random

from docweave.operators import package_edit as P
from docweave.sources import views
from docweave.sources.views import grid_columns
from tests.test_structure import _cell, _members


def _grid_plan(rows, row, col, count, down):
    """merge_plan of a table whose places are all covered once, by a grid that names each place's cell."""
    here = rows[row] if 0 <= row < len(rows) else None
    if here is None and not down:
        return "index_range", 0, []
    if here is None or count < 2 or not 0 <= col < len(here) or (row + count > len(rows) if down else col + count > len(here)):
        return "bad_span", 0, []
    cells = [(i, j, *c) for i, r in enumerate(rows) for j, c in enumerate(r)]
    left = grid_columns(*([c[k] for c in cells] for k in (0, 2, 3, 4)))
    place = {(i + y, a + x): (i, j) for (i, j, _, tall, wide), a in zip(cells, left, strict=True) for y in range(tall) for x in range(wide)}
    of = lambda k: {p for p, c in place.items() if c == k}
    first = of((row, col))
    columns = {x for _, x in first}
    if down:
        want = {(y, x) for y in range(row, row + count) for x in columns}
    else:
        last = {x for _, x in of((row, col + count - 1))}
        want = {(y, x) for y in {y for y, _ in first} for x in range(min(columns), max(last) + 1)}
    names = {place[p] for p in want if p in place}
    whole = all(of(k) <= want for k in names)
    apt = all({x for _, x in of(k)} == columns for k in names) if down else names == {(row, col + i) for i in range(count)} and all({y for y, _ in of(k)} == {y for y, _ in first} for k in names)
    if not (whole and apt):
        return "overlap", 0, []
    return "ok", count if down else max(x for _, x in want) - min(columns) + 1, sorted(names - {(row, col)})


def _random_table(r, n, m):
    """Rows of (None, row span, column span) that cover n by m places once each."""
    free, rows = {(y, x) for y in range(n) for x in range(m)}, [[] for _ in range(n)]
    for y in range(n):
        for x in range(m):
            if (y, x) in free:
                wide = max(w for w in range(1, r.randint(1, 3) + 1) if all((y, x + i) in free for i in range(w)))
                tall = r.randint(1, min(3, n - y))
                free -= {(y + j, x + i) for j in range(tall) for i in range(wide)}
                rows[y].append((None, tall, wide))
    return rows


def test_plan_against_grid():
    r, seen = random.Random(5), []
    for _ in range(9000):
        rows = _random_table(r, r.randint(2, 5), r.randint(2, 6))
        what = (rows, r.randint(-1, len(rows)), r.randint(-1, 3), r.choice([1, 2, 2, 3]), r.random() < 0.5)
        got = P.merge_plan(*what)
        assert got == _grid_plan(*what), what
        seen.append(got[0])
    assert min(map(seen.count, ("ok", "overlap", "bad_span", "index_range"))) > 100


def _row(*cells):
    return "<hp:tr>" + "".join(cells) + "</hp:tr>"


def test_merges_refuse_overlaps(spark):
    """Of a and b the first reaches into row 1, so cells of row 1 stand behind it."""
    table = "<hp:tbl>" + _row(_cell("a", 2), _cell("b"), _cell("c", 1, 2)) + _row(_cell("d"), _cell("e", 2), _cell("f")) + _row(_cell("g"), _cell("h"), _cell("i")) + "</hp:tbl>"
    members = _members(spark, {"d": [f"<hs:sec><hp:p><hp:run>{table}</hp:run></hp:p></hs:sec>"], "none": ["<hs:sec><hp:p/></hs:sec>"]})

    def after(edits):
        code = {e.doc: e.code for e in edits.collect()}
        assert code["none"] == "index_range"
        t = views.body_tokens(P.applied(members, edits)).filter("doc = 'd'")
        return code["d"], [(c.row, c.col, c.row_span, c.col_span, c.text) for c in views.table_cells(t).orderBy("row", "col").collect()]

    whole = [(0, 0, 2, 1, "a"), (0, 1, 1, 1, "b"), (0, 2, 1, 2, "c"), (1, 1, 1, 1, "d"), (1, 2, 2, 1, "e"), (1, 3, 1, 1, "f"), (2, 0, 1, 1, "g"), (2, 1, 1, 1, "h"), (2, 3, 1, 1, "i")]
    assert after(P.merge_horizontal(members, 0, 0, 0, 2)) == ("overlap", whole)  # of two heights
    assert after(P.merge_horizontal(members, 0, 2, 1, 2)) == ("overlap", whole)  # e lies between
    assert after(P.merge_vertical(members, 0, 2, 0, 2)) == ("overlap", whole)  # c is wider than e
    assert after(P.merge_vertical(members, 0, 1, 1, 9)) == ("bad_span", whole)
    got = after(P.merge_horizontal(members, 0, 0, 1, 2))  # spans add up
    assert got == ("ok", [whole[0], (0, 1, 1, 3, "b"), *whole[3:]])
    got = after(P.merge_vertical(members, 0, 0, 0, 3))  # a cell that spans already
    assert got == ("ok", [(0, 0, 3, 1, "a"), *whole[1:6], *whole[7:]])
    got = after(P.merge_vertical(members, 0, 0, 1, 2))  # d stands first and lies under b
    assert got == ("ok", [*whole[:3], (1, 1, 2, 1, "d"), *whole[4:7], whole[8]])

"""Edits of packages: each takes the members of any number of documents and gives edits
(doc, entry, code, n, xml), which `applied` puts back.

code is ok, or says why nothing changes (xml is null then): index_range, bad_span, overlap,
target_missing, nested_target (a paragraph that holds others). n counts what the edit
touched. Structural edits see each document's first section part; indexes count from 0,
paragraphs by their ends (`flat` of the tokens), tables by the outermost ones, cells as
they stand in their row. Row and column counts and cell addresses follow an edit.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from html import escape

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.functions.arguments import MOST_INDEX, json_pairs
from docweave.functions.text import replace_each, xml_escape
from docweave.sources.markup import CLOSE, EMPTY, MOST_ID, OPEN, TEXT, Cut, assembled, attribute, free_id, if_said, per_part, put_back, said, tokens, with_attribute, with_said
from docweave.sources.part_views import field_marks, spans
from docweave.sources.storage import stored
from docweave.sources.views import MEDIA, grid_columns

#: Sizes of an inserted picture (about 100 mm) and of an inserted table.
PICTURE, TABLE_WIDTH, ROW_HEIGHT = 28350, 40000, 5000


def _doc():
    return Window.partitionBy("doc", "entry")


def _line():
    return _doc().orderBy("at")


def applied(members: DataFrame, edits: DataFrame) -> DataFrame:
    """members with the parts that edits changed."""
    return put_back(members, edits)


def first_sections(members: DataFrame) -> DataFrame:
    """(doc, section, entry, xml): the first section part of each document in archive order."""
    parts = members.filter(F.col("entry").rlike(r"(?i)^Contents/section\d+\.xml$"))
    first = parts.groupBy("doc").agg(F.min_by(F.struct("entry", "bytes"), "seq").alias("p"))
    return first.select("doc", F.lit(0).alias("section"), F.col("p.entry").alias("entry"), F.decode("p.bytes", "UTF-8").alias("xml"))


def _numbered(parts: DataFrame) -> DataFrame:
    """parts with free_id: the first of the widest range of 32-bit ids that no tag of the part uses. New elements of an edit
    count on from it, so no two share an id, nor do those of edits made one after the other."""
    used = F.transform(F.regexp_extract_all("xml", F.lit(r'\sid="(\d{1,10})"'), 1), lambda x: x.cast("long"))
    parts = parts.withColumn("_ids", F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0).cast("long"), F.lit(MOST_ID)), F.filter(used, lambda x: x < MOST_ID)))))
    room = F.zip_with(F.slice("_ids", 2, F.size("_ids") - 1), F.slice("_ids", 1, F.size("_ids") - 1), lambda b, a: F.struct((b - a).alias("ids"), (-a).alias("after")))
    return parts.withColumn("free_id", 1 - F.array_max(room)["after"]).drop("_ids")


def _edits(t: DataFrame) -> DataFrame:
    """Edits of token rows that carry code and n."""
    whole = assembled(t, code=F.max("code"), n=F.max("n").cast("long"))
    return whole.select("doc", "entry", "code", "n", F.when(F.col("code") == "ok", F.col("xml")).alias("xml"))


def _id(nth: Column | int = 0) -> Column:
    """The id of an edit's nth new element."""
    return (F.col("free_id") + nth).cast("string")


def _with_ids(tok: Column, nth: Column) -> Column:
    return F.when(tok.rlike(r'\sid="\d+"'), with_attribute(tok, "id", _id(nth))).otherwise(tok)


def _if_said(tok: Column, name: str, value: Column) -> Column:
    """The tag with the attribute set if it has it."""
    return F.when(attribute(tok, name).isNotNull(), with_attribute(tok, name, value)).otherwise(tok)


def _renumbered(t: DataFrame, table: int, rows: Column | None = None, cols: Column | None = None, row_from: Column | None = None, col_from: Column | None = None) -> DataFrame:
    """Tokens with a table's counts set to `rows` and `cols`, and addresses from row_from or col_from on one less."""
    own = (F.col("table") == table) & (F.col("in_tbl") == 1)
    tok = F.col("tok")
    head = own & (F.col("name") == "hp:tbl") & (F.col("kind") != "close")
    for name, value in (("rowCnt", rows), ("colCnt", cols)):
        if value is not None:
            tok = F.when(head, _if_said(tok, name, value)).otherwise(tok)
    for name, start in (("rowAddr", row_from), ("colAddr", col_from)):
        if start is not None:
            at = attribute(F.col("tok"), name).cast("int")
            tok = F.when(own & (F.col("name") == "hp:cellAddr") & (at > start), _if_said(tok, name, at - 1)).otherwise(tok)
    return t.withColumn("tok", tok)


def _filled(t: DataFrame, where: Column, value: Column) -> DataFrame:
    """Tokens where the text nodes at `where` hold `value` alone."""
    node = where & (F.col("name") == "hp:t")
    tok = F.when(node & (F.col("kind") == "open"), F.concat("tok", xml_escape(value))).when(node & (F.col("kind") == "empty"), F.concat(F.lit("<hp:t>"), xml_escape(value), F.lit("</hp:t>")))
    inside = where & (F.col("in_t") > 0) & (F.col("name") != "hp:t")
    return t.filter(~F.coalesce(inside, F.lit(False))).withColumn("tok", F.coalesce(tok, "tok"))


# Paragraphs

def whole_edits(parts: DataFrame, change: Callable[[Cut, list[dict]], Iterator[tuple]], more: str = "") -> DataFrame:
    """Edits of parts that are read whole: change(cut, rows) gives code, n, the pieces of the new part and columns `more` for each part in
    turn. Parts without tokens have no edit."""

    def run(cut: Cut, rows: list[dict]) -> Iterator[tuple]:
        for row, size, (code, n, pieces, *rest) in zip(rows, cut.many(cut.kind >= 0), change(cut, rows), strict=True):
            if size:
                yield row["doc"], row["entry"], code, n, "".join(pieces) if code == "ok" else None, *rest

    return per_part(parts, run, "doc string, entry string, code string, n long, xml string" + more)


def run_of(text: str, ref: str) -> str:
    return f'<hp:run charPrIDRef="{ref}">{text}</hp:run>'


def node(text: str) -> str:
    return f"<hp:t>{escape(text, quote=False)}</hp:t>"


def run_ref(cut: Cut, runs: list[int]) -> str:
    """The style of the first of the runs."""
    return (said(cut.toks[runs[0]], "charPrIDRef") if runs else None) or "0"


def _ended(cut: Cut, rows: list[dict], body: Callable[[int, dict, str], str]) -> Iterator[list[str] | None]:
    """Each part's pieces with a paragraph like the last top-level one, with a fresh id and one run in the style of its first run, before the
    section's end; null where there is no such paragraph or end. body(id, row, style) is what the run holds; id counts on
    from the first fresh one, style is the run's."""
    own, styled = cut.p & (cut.in_p == 1) & (cut.kind == OPEN), cut.of("hp:run") & cut.starts
    ends = cut.places(cut.of("hs:sec") & (cut.kind == CLOSE))
    for i, (row, like, runs, end) in enumerate(zip(rows, cut.places(own), cut.places(styled), ends, strict=True)):
        a, b = int(cut.bounds[i]), int(cut.bounds[i + 1])
        if not like or not end:
            yield None
            continue
        last = max((cut.paragraph[r] for r in runs), default=0)
        ref = run_ref(cut, [r for r in runs if cut.paragraph[r] == last])
        fresh = free_id(row["xml"])
        put = if_said(cut.toks[like[-1]], "id", fresh) + run_of(body(fresh, row, ref), ref) + "</hp:p>"
        pieces = cut.toks[a:b]
        for e in end:
            pieces[e - a] = put + pieces[e - a]
        yield pieces


def _before_end(members: DataFrame, body: Callable[[int, dict, str], str], n: int = 1) -> DataFrame:
    """Edits that put a paragraph before the section's end, as _ended() does."""

    def change(cut: Cut, rows: list[dict]) -> Iterator[tuple]:
        for pieces in _ended(cut, rows, body):
            yield "target_missing" if pieces is None else "ok", n, pieces or ()

    return whole_edits(first_sections(members), change)


def append_paragraph(members: DataFrame, text: str) -> DataFrame:
    """A paragraph like the last one, with one run of `text`, at the section's end."""
    return _before_end(members, lambda *_: node(text))


def _paragraph(members: DataFrame, index: int) -> DataFrame:
    """Tokens with code and n (paragraphs in all) of an edit of one paragraph, and `hit`."""
    t = tokens(first_sections(members)).withColumn("hit", F.coalesce(F.col("flat") == index, F.lit(False)))
    opens = F.max(F.when(F.col("hit"), F.col("flat_opens"))).over(_doc())
    code = F.when(opens.isNull(), "index_range").when(opens > 1, "nested_target").otherwise("ok")
    return t.withColumns({"code": code, "n": F.coalesce(F.max("flat").over(_doc()) + 1, F.lit(0))})


def delete_paragraph(members: DataFrame, index: int) -> DataFrame:
    """n is how many paragraphs there were."""
    t = _paragraph(members, index)
    return _edits(t.filter(~F.col("hit") | (F.col("code") != "ok")))


def set_paragraph_text(members: DataFrame, index: int, text: str) -> DataFrame:
    """The paragraph becomes one run of `text` in its first run's style; n is how many paragraphs there are."""

    def change(cut: Cut, rows: list[dict]) -> Iterator[tuple]:
        hit = cut.flat == index
        runs = cut.places(hit & cut.of("hp:run") & cut.starts)
        for i, (own, styled, n) in enumerate(zip(cut.places(hit), runs, cut.many(cut.begins_flat), strict=True)):
            if not own or cut.flat_opens[own[0]] > 1:
                yield "nested_target" if own else "index_range", n, ()
                continue
            a, b = int(cut.bounds[i]), int(cut.bounds[i + 1])
            yield "ok", n, [*cut.toks[a : own[0]], *set_paragraph(cut, own, node(text), run_ref(cut, styled)), *cut.toks[own[-1] + 1 : b]]

    return whole_edits(first_sections(members), change)


def set_paragraph(cut: Cut, own: list[int], node: str, ref: str) -> Iterator[str]:
    """The tokens of a paragraph that holds no others, with one run of the node."""
    for i in own:
        if cut.p[i]:
            tok = cut.toks[i]
            if cut.kind[i] == EMPTY:
                yield re.sub(r"(?a)\s*/>$", ">", tok) + run_of(node, ref) + "</hp:p>"
            else:
                yield tok + run_of(node, ref) if cut.kind[i] == OPEN else tok


# Tables

def _table(members: DataFrame, table: int) -> DataFrame:
    """Tokens of first sections with n_rows of the table, null without it, and n_cells of a token's row."""
    t = tokens(_numbered(first_sections(members)))
    own = F.col("table") == table
    return t.withColumns({
        "own": F.coalesce(own, F.lit(False)), "n_rows": F.max(F.when(own, F.coalesce(F.col("row") + 1, F.lit(0)))).over(_doc()),
        "n_cells": F.max(F.when(own, F.coalesce(F.col("cell") + 1, F.lit(0)))).over(Window.partitionBy("doc", "entry", "table", "row")),
    })


def delete_row(members: DataFrame, table: int, row: int) -> DataFrame:
    """n is how many rows are left; counts and later addresses are one less."""
    hit = F.col("own") & (F.col("row") == row)
    t = _table(members, table)
    t = t.withColumns({"code": F.when(F.max(hit).over(_doc()), "ok").otherwise("index_range"), "n": F.col("n_rows") - 1})
    t = t.filter(~F.coalesce(hit, F.lit(False)) | (F.col("code") != "ok"))
    return _edits(_renumbered(t, table, rows=F.col("n_rows") - 1, row_from=F.lit(row)))


def append_row(members: DataFrame, table: int, texts: list[str]) -> DataFrame:
    """A copy of the last row, its text nodes taking texts in turn, empty beyond them; n is how many cells it has."""
    t = _table(members, table)
    t = t.withColumns({"n": F.max(F.when(F.col("own") & (F.col("row") == F.col("n_rows") - 1), F.col("n_cells"))).over(_doc()), "code": F.when(F.col("n_rows") > 0, "ok").otherwise("index_range")})
    last = t.filter(F.col("own") & (F.col("row") == F.col("n_rows") - 1) & (F.col("in_lines") == 0))
    nth = F.sum(((F.col("name") == "hp:t") & (F.col("kind") != "close")).cast("int")).over(_line().rowsBetween(Window.unboundedPreceding, 0)) - 1
    values = F.array(*map(F.lit, texts)) if texts else F.array().cast("array<string>")
    copy = _filled(last.withColumn("nth", nth), F.lit(True), F.coalesce(F.get(values, F.col("nth")), F.lit(""))).drop("nth")
    tok = _with_ids(F.col("tok"), F.row_number().over(_line()) - 1)
    tok = F.when((F.col("name") == "hp:cellAddr") & (F.col("in_tbl") == 1), _if_said(tok, "rowAddr", F.col("n_rows"))).otherwise(tok)
    copy = copy.withColumns({"tok": tok, "sub": F.row_number().over(_line()), "at": F.max("at").over(_doc())})
    return _edits(_renumbered(t, table, rows=F.col("n_rows") + 1).unionByName(copy))


def append_column(members: DataFrame, table: int, texts: list[str]) -> DataFrame:
    """In each row a copy of its last cell, all its text nodes being the row's of texts, empty
    beyond them. Rows without cells stay. n is how many rows there are."""
    t = _table(members, table)
    t = t.withColumns({"n": F.col("n_rows"), "code": F.when(F.col("n_rows").isNotNull(), "ok").otherwise("index_range")})
    last = t.filter(F.col("own") & (F.col("cell") == F.col("n_cells") - 1) & (F.col("in_lines") == 0))
    values = F.array(*map(F.lit, texts)) if texts else F.array().cast("array<string>")
    copy = _filled(last, F.lit(True), F.coalesce(F.get(values, F.col("row")), F.lit("")))
    tok = _with_ids(F.col("tok"), F.row_number().over(_line()) - 1)
    col = attribute(F.col("tok"), "colAddr").cast("int") + 1
    tok = F.when((F.col("name") == "hp:cellAddr") & (F.col("in_tbl") == 1), _if_said(tok, "colAddr", col)).otherwise(tok)
    row = Window.partitionBy("doc", "entry", "row")
    copy = copy.withColumns({"tok": tok, "sub": F.row_number().over(row.orderBy("at")), "at": F.max("at").over(row)})
    wide = attribute(F.col("tok"), "colCnt").cast("int") + 1
    return _edits(_renumbered(t, table, cols=wide).unionByName(copy))


def delete_column(members: DataFrame, table: int, col: int) -> DataFrame:
    """The cell that stands at `col` goes from each row that has it; n is how many rows had it.
    Without any such row nothing changes: index_range."""
    hit = F.coalesce(F.col("own") & (F.col("cell") == col), F.lit(False))
    t = _table(members, table)
    n = F.sum((hit & (F.col("name") == "hp:tc") & (F.col("kind") != "close") & (F.col("in_tbl") == 1)).cast("int")).over(_doc())
    t = t.withColumns({"n": n, "code": F.when(n > 0, "ok").otherwise("index_range")}).filter(~hit | (F.col("code") != "ok"))
    return _edits(_renumbered(t, table, cols=attribute(F.col("tok"), "colCnt").cast("int") - 1, col_from=F.lit(col)))


def set_cell_text(members: DataFrame, table: int, row: int, col: int, text: str) -> DataFrame:
    """The first text node of the cell that stands at `col` of the row; without one target_missing."""
    hit = F.coalesce(F.col("own") & (F.col("row") == row) & (F.col("cell") == col) & (F.col("in_tbl") == 1), F.lit(False))
    t = _table(members, table).withColumn("hit", hit)
    t = t.withColumn("nth", F.sum((F.col("hit") & (F.col("name") == "hp:t") & (F.col("kind") != "close")).cast("int")).over(_line().rowsBetween(Window.unboundedPreceding, 0)))
    nodes = F.max("nth").over(_doc())
    t = t.withColumns({"n": F.lit(1), "code": F.when(~F.max("hit").over(_doc()), "index_range").when(nodes == 0, "target_missing").otherwise("ok")})
    return _edits(_filled(t, F.col("hit") & (F.col("nth") == 1), F.lit(text)))


def merge_plan(rows: list[list[tuple]], row: int, col: int, count: int, down: bool) -> tuple[str, int, list[tuple[int, int]]]:
    """(code, span, gone) of a merge of `count` cells of a row, or of as many rows of a column if `down`, from the cell that stands at
    `col` of `row`: the merged cell's span, and the (row, cell) that go. rows: (column address or None, row span, column span) of
    the cells of each row. Cells go by the grid. overlap: a cell that the edit does not name lies in the merged area, or one
    that it names reaches beyond it, so the area would be no rectangle of whole cells."""
    here = rows[row] if 0 <= row < len(rows) else None
    if here is None and not down:
        return "index_range", 0, []
    if here is None or count < 2 or not 0 <= col < len(here) or (row + count > len(rows) if down else col + count > len(here)):
        return "bad_span", 0, []
    cells = [(i, j, *c) for i, r in enumerate(rows) for j, c in enumerate(r)]
    left = grid_columns(*([c[k] for c in cells] for k in (0, 2, 3, 4)))
    area = {(i, j): (i, min(i + max(tall, 1), len(rows)), at, at + max(wide, 1)) for (i, j, _, tall, wide), at in zip(cells, left, strict=True)}
    top, bottom, start, end = area[row, col]
    if down:
        bottom = row + count
    else:
        end = area[row, col + count - 1][3]
    met = {k: x for k, x in area.items() if x[0] < bottom and x[1] > top and x[2] < end and x[3] > start}
    if down:
        fits = all(x[0] >= top and x[1] <= bottom and x[2:] == (start, end) for x in met.values())
    else:
        fits = set(met) == {(row, col + i) for i in range(count)} and all(x[:2] == (top, bottom) and x[2] >= start and x[3] <= end for x in met.values())
    return ("ok", count if down else end - start, sorted(set(met) - {(row, col)})) if fits else ("overlap", 0, [])


def _merge(members: DataFrame, table: int, row: int, col: int, count: int, down: bool) -> DataFrame:
    t = _table(members, table)
    said = lambda name, *tags: F.max(F.when(F.col("name").isin(*tags) & (F.col("in_tbl") == 1) & (F.col("kind") != "close"), attribute(F.col("tok"), name))).cast("int").alias
    cells = t.filter("own and row is not null").groupBy("doc", "entry", "row", "cell").agg(
        said("colAddr", "hp:cellAddr")("address"), said("rowSpan", "hp:cellSpan", "hp:tc")("down"), said("colSpan", "hp:cellSpan", "hp:tc")("wide"))
    whole = cells.groupBy("doc", "entry").agg(F.array_sort(F.collect_list(F.struct("row", F.coalesce("cell", F.lit(-1)).alias("cell"), "address", "down", "wide"))).alias("cells"))

    def plan(tables: pd.Series) -> pd.DataFrame:
        out = []
        for cells in tables:
            rows: dict[int, list[tuple]] = {}
            for c in cells:
                line = rows.setdefault(int(c["row"]), [])
                if c["cell"] >= 0:
                    line.append((None if c["address"] is None else int(c["address"]), int(c["down"] or 1), int(c["wide"] or 1)))
            code, span, gone = merge_plan([rows[r] for r in sorted(rows)], row, col, count, down)
            out.append((code, span, [{"row": r, "cell": c} for r, c in gone]))
        return pd.DataFrame(out, columns=["code", "span", "gone"])

    plans = whole.select("doc", "entry", F.pandas_udf(plan, "code string, span int, gone array<struct<row:long,cell:long>>")("cells").alias("plan"))
    t = t.join(plans, ["doc", "entry"], "left")
    none = "bad_span" if down else "index_range"  # a table without rows
    t = t.withColumns({"n": F.lit(count), "code": F.coalesce("plan.code", F.when(F.col("n_rows").isNull(), "index_range").otherwise(none))})
    first = F.coalesce(F.col("own") & (F.col("row") == row) & (F.col("cell") == col) & (F.col("in_tbl") == 1), F.lit(False))
    has = F.max(first & (F.col("name") == "hp:cellSpan")).over(_doc())
    put = first & (F.col("kind") != "close") & F.when(has, F.col("name") == "hp:cellSpan").otherwise(F.col("name") == "hp:tc") & (F.col("code") == "ok")
    t = t.withColumn("tok", F.when(put, with_attribute(F.col("tok"), "rowSpan" if down else "colSpan", F.col("plan.span"))).otherwise(F.col("tok")))
    gone = F.col("own") & F.exists("plan.gone", lambda g: (g["row"] == F.col("row")) & (g["cell"] == F.col("cell")))
    return _edits(t.filter(~F.coalesce(gone, F.lit(False))))


def merge_horizontal(members: DataFrame, table: int, row: int, start: int, count: int) -> DataFrame:
    """The cell gets the span of the `count` cells, the next count - 1 cells of the row and their text go. overlap where these are
    not side by side in the grid or not of one height."""
    return _merge(members, table, row, start, count, False)


def merge_vertical(members: DataFrame, table: int, col: int, start: int, count: int) -> DataFrame:
    """The cell that stands at `col` of row `start` gets the span; from the next count - 1 rows the cells in the same grid columns
    go. overlap where one of them is wider or narrower or reaches below the last row."""
    return _merge(members, table, start, col, count, True)


def insert_table(members: DataFrame, headers: list[str], rows: list[list[str]]) -> DataFrame:
    """A paragraph with a table of the headers and rows at the section's end; n is its rows. Rows may differ in length."""
    every = [headers, *rows]
    n, cols, widest = len(every), len(headers), max(map(len, every))

    def cell(text: str, i: int, j: int, fresh: int, ref: str) -> str:
        nth = fresh + (i * widest + j) * 2
        return (f'<hp:tc><hp:subList id="{nth + 2}" textDirection="HORIZONTAL" lineWrap="BREAK" vertAlign="TOP"><hp:p id="{nth + 3}" paraPrIDRef="0" styleIDRef="0" pageBreak="0" columnBreak="0" merged="0">'
                f'{run_of(node(text), ref)}</hp:p></hp:subList><hp:cellAddr colAddr="{j}" rowAddr="{i}"/><hp:cellSpan colSpan="1" rowSpan="1"/></hp:tc>')

    head = (f'" zOrder="0" numberingType="TABLE" textWrap="TOP_AND_BOTTOM" textFlow="BOTH_SIDES" pageBreak="CELL" repeatHeader="1" rowCnt="{n}" colCnt="{cols}" cellSpacing="0" borderFillIDRef="2" noAdjust="0">'
            f'<hp:sz width="{TABLE_WIDTH}" widthRelTo="ABSOLUTE" height="{ROW_HEIGHT * n}" heightRelTo="ABSOLUTE" protect="0"/>')

    def body(fresh: int, row: dict, ref: str) -> str:
        return f'<hp:tbl id="{fresh + 1}{head}' + "".join("<hp:tr>" + "".join(cell(x, i, j, fresh, ref) for j, x in enumerate(r)) + "</hp:tr>" for i, r in enumerate(every)) + "</hp:tbl>"

    return _before_end(members, body, n=n)


# Text of packages

def fill(members: DataFrame, pairs: list[tuple[str, str]], all_occurrences: bool = False) -> DataFrame:
    """Edits of all section parts and the header: in each text node that holds text alone, each
    pair's key once, at its last place, or at all with all_occurrences, later pairs in what earlier ones left. hits: how many
    nodes each pair changed, in order; n their sum. Written without a hit too."""
    if not all(key for key, _ in pairs):
        raise ValueError("a key must not be empty")
    parts = members.filter(F.col("entry").rlike(r"(?i)^Contents/(section\d+|header)\.xml$")).select("doc", "entry", F.decode("bytes", "UTF-8").alias("xml"))
    steps = [(escape(k, quote=False), escape(v, quote=False)) for k, v in pairs]

    def change(cut: Cut, rows: list[dict]) -> Iterator[tuple]:
        # A node of text alone: its tags and at most one token of text between them.
        kind, last = cut.kind, len(cut.toks) - 1
        opens = cut.places(cut.t & (kind == OPEN))
        for i, (starts, a, b) in enumerate(zip(opens, cut.bounds[:-1].tolist(), cut.bounds[1:].tolist(), strict=True)):
            pieces, hits = cut.toks[a:b], [0] * len(steps)
            for at in starts:
                if at < last and kind[at + 1] == TEXT and at + 2 < b and cut.t[at + 2] and kind[at + 2] == CLOSE:
                    text = was = cut.toks[at + 1]
                    for k, (key, value) in enumerate(steps):
                        place = text.rfind(key)
                        if place >= 0:
                            hits[k] += 1
                            text = text.replace(key, value) if all_occurrences else text[:place] + value + text[place + len(key) :]
                    if text is not was:
                        pieces[at + 1 - a] = text
            yield "ok", sum(hits), pieces, hits

    return whole_edits(parts, change, ", hits array<long>")


def fill_report(edits: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """(doc, report): total and hits of each key, those with hits first, as fill() counted."""
    sums = edits.groupBy("doc").agg(F.array(*(F.sum(F.col("hits")[i]) for i in range(len(pairs)))).alias("h"))
    each = F.array(*(F.struct((F.col("h")[i] == 0).alias("none"), F.lit(i).alias("i"), F.format_string("  '%s' → %d건", F.lit(k), F.col("h")[i]).alias("line")) for i, (k, _) in enumerate(pairs)))
    total = F.aggregate("h", F.lit(0).cast("long"), lambda a, x: a + x)
    return sums.select("doc", F.concat(F.format_string("총 %d건 치환 (%d replacements)\n\n", total, total), F.array_join(F.transform(F.array_sort(each), lambda x: x["line"]), "\n")).alias("report"))


def fill_each(members: DataFrame, arguments: DataFrame, all_occurrences: bool = False) -> tuple[DataFrame, DataFrame]:
    """(edits, outcome): each document filled by its own pairs. arguments: (doc, replacements), a row for a document, replacements
    being a JSON object of strings; its pairs are taken in JavaScript's order of keys, as fill() takes pairs. outcome: (doc,
    code, n, report) of each document of arguments: ok, bad_json, bad_value, empty_key, or not_found without
    members; report lists each key's nodes: integer keys by size, then others by their first hit, then those
    without one. Parts are filled where they stand, with no shuffle but the join on doc."""
    told = arguments.select("doc", json_pairs("replacements").alias("j")).select("doc", F.col("j.code").alias("code"), F.col("j.pairs").alias("pairs"))
    parts = members.filter(F.col("entry").rlike(r"(?i)^Contents/(section\d+|header)\.xml$")).select("doc", "entry", "seq", F.decode("bytes", "UTF-8").alias("was"))
    parts = parts.join(told.filter("code = 'ok'"), "doc")
    steps = F.transform("pairs", lambda p: F.struct(xml_escape(p["key"]).alias("k"), xml_escape(p["value"]).alias("v")))
    node = r"(?s)^<hp:t(?:\s[^>]*)?>[^<]*</hp:t>$"

    def piece(x: Column) -> Column:
        start = F.regexp_extract(x, r"^(<[^>]*>)", 1)
        text = F.substring(x, F.char_length(start) + 1, F.char_length(x) - F.char_length(start) - len("</hp:t>"))
        done = replace_each(text, F.col("steps"), all_occurrences)
        new = F.struct(F.concat(start, done["text"], F.lit("</hp:t>")).alias("text"), done["hits"].alias("hits"))
        return F.when(x.rlike(node), new).otherwise(F.struct(x.alias("text"), F.array().cast("array<boolean>").alias("hits")))

    bits = F.regexp_extract_all("was", F.lit(r"(?s)(<hp:t(?:\s[^>]*)?>[^<]*</hp:t>|<[^>]*>|[^<]+)"), 1)
    parts = parts.withColumn("steps", steps).withColumn("done", F.transform(bits, piece))
    hit = F.transform("pairs", lambda _, i: F.size(F.filter("done", lambda d: F.coalesce(F.get(d["hits"], i), F.lit(False)))).cast("long"))
    edits = stored(parts.select("doc", "entry", "code", "seq", "pairs", hit.alias("hits"), F.array_join(F.transform("done", lambda d: d["text"]), "").alias("xml")))
    edits = edits.withColumn("n", F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + x))

    each = edits.select("doc", "seq", F.posexplode(F.arrays_zip("pairs", "hits")).alias("i", "x")).select("doc", "seq", "i", F.col("x.pairs.key").alias("key"), F.col("x.hits").alias("n"))
    keys = each.groupBy("doc", "i", "key").agg(F.sum("n").alias("n"), F.min(F.when(F.col("n") > 0, F.col("seq"))).alias("first"))
    index = F.col("key").rlike("^(0|[1-9][0-9]{0,9})$") & (F.expr("try_cast(key AS bigint)") < MOST_INDEX)
    place = F.struct((~index).alias("other"), F.when(index, 0).otherwise(F.coalesce("first", F.lit((1 << 31) - 1))).alias("first"), "i", F.format_string("  '%s' → %d건", "key", "n").alias("line"))
    lines = keys.groupBy("doc").agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(place)).alias("lines"))
    there = members.select("doc").distinct().withColumn("there", F.lit(True))
    outcome = told.join(there, "doc", "left").join(lines, "doc", "left")
    n = F.coalesce("n", F.lit(0).cast("long"))
    code = F.when((F.col("code") == "ok") & F.col("there").isNull(), "not_found").otherwise(F.col("code"))
    said = F.concat(F.format_string("총 %d건 치환 (%d replacements)\n\n", n, n), F.coalesce(F.array_join(F.transform("lines", lambda x: x["line"]), "\n"), F.lit("")))
    outcome = outcome.select("doc", code.alias("code"), n.alias("n"), F.when(code == "ok", said).alias("report"))
    return edits.select("doc", "entry", "code", "n", "xml"), outcome


def set_field(members: DataFrame, name: str, value: str) -> DataFrame:
    """The first field of that name gets the value: its first text node holds it, its others are emptied, but fields
    within it stay as they are. n is how many nodes that were. Without field, own end or text node of its own target_missing."""

    def change(cut: Cut, rows: list[dict]) -> Iterator[tuple]:
        begins, marks = field_marks(cut)
        for i, at in enumerate(cut.places(marks)):
            found = spans(cut, at, begins)
            own = next((f for f in found if f["name"] == name), None)
            if own is None or own["stop"] is None:
                yield "target_missing", 0, ()
                continue
            a, b, first, end = int(cut.bounds[i]), int(cut.bounds[i + 1]), own["start"], own["stop"]
            held = np.zeros(end - first, bool)
            for f in found:
                if f["stop"] is not None and f["start"] > first and f["stop"] < end:
                    held[f["start"] - first : f["stop"] - first + 1] = True
            pieces, n = cut.toks[a:b], 0
            for j in range(first + 1, end):
                if held[j - first]:
                    continue
                if cut.t[j]:
                    if cut.starts[j]:
                        n += 1
                        text = escape(value, quote=False) if n == 1 else ""
                        pieces[j - a] = cut.toks[j] + text if cut.kind[j] == OPEN else f"<hp:t>{text}</hp:t>"
                elif cut.in_t[j] > 0:
                    pieces[j - a] = ""
            yield "ok" if n else "target_missing", n, pieces

    return whole_edits(first_sections(members), change)


# Styles

def _header(members: DataFrame, element: str, change) -> DataFrame:
    """(doc, entry, new_id, xml) of headers with a changed copy of the first `element` after it, with the
    largest id plus one; null where there is none."""
    head = members.filter(F.lower("entry") == "contents/header.xml").select("doc", "entry", F.decode("bytes", "UTF-8").alias("was"))
    whole = rf"(?s)(<{element}\s[^>]*/>|<{element}\s[^>]*>.*?</{element}>)"
    base = F.regexp_extract("was", whole, 1)
    ids = F.transform(F.regexp_extract_all("was", F.lit(rf'<{element}\s[^>]*?\bid="(\d+)"'), 1), lambda x: x.cast("long"))
    head = head.withColumns({"base": base, "new_id": (F.array_max(ids) + 1).cast("string")})
    put = change(with_attribute(F.col("base"), "id", F.col("new_id")))
    at = F.position(F.col("base"), F.col("was")) + F.char_length("base")
    xml = F.concat(F.substring(F.col("was"), F.lit(1), at - 1), put, F.substring(F.col("was"), at, F.char_length("was")))
    return head.select("doc", F.col("entry").alias("head"), "new_id", F.when(F.col("base") != "", xml).alias("head_xml"))


def _restyled(members: DataFrame, heads: DataFrame, target: Callable[[Cut], list[list[int]]], ref: str, miss: str) -> DataFrame:
    """Edits of section and header: the first token of `target` in each part refers to the new style."""

    def change(cut: Cut, rows: list[dict]) -> Iterator[tuple]:
        for i, (row, at) in enumerate(zip(rows, target(cut), strict=True)):
            a, b = int(cut.bounds[i]), int(cut.bounds[i + 1])
            code = "target_missing" if row["head_xml"] is None else "ok" if at else miss
            pieces = cut.toks[a:b]
            if code == "ok":
                pieces[at[0] - a] = with_said(pieces[at[0] - a], ref, row["new_id"])
            yield code, 1, pieces, row["head"], row["head_xml"] if code == "ok" else None

    both = whole_edits(first_sections(members).join(heads.hint("merge"), "doc", "left"), change, ", head string, head_xml string")
    edit = lambda entry, n, xml: F.struct(F.col(entry).alias("entry"), "code", F.lit(n).cast("long").alias("n"), F.col(xml).alias("xml"))
    return both.select("doc", F.inline(F.array_compact(F.array(edit("entry", 1, "xml"), F.when(F.col("code") == "ok", edit("head", 0, "head_xml"))))))


def apply_text_style(members: DataFrame, target: str, color: str | None = None, bold: bool | None = None, italic: bool | None = None, underline: bool | None = None, font_size: int | None = None) -> DataFrame:
    """The first run whose text holds `target` gets a new character style: a copy of the first one with
    what is given changed. Size changes only where the style has one; underline is accepted and not applied."""

    if color and not re.fullmatch("#?[0-9A-Fa-f]{6}", color):
        raise ValueError(f"bad_color: {color}")

    def change(style: Column) -> Column:
        if color:
            tag = f'<hc:color val="#{color.lstrip("#")}"/>'
            style = F.when(style.contains("<hc:color "), F.regexp_replace(style, r"<hc:color [^>]*/>", tag)).when(
                style.endswith("/>"), F.concat(F.regexp_replace(style, r"\s*/>$", ">"), F.lit(tag + "</hh:charPr>"))).otherwise(F.regexp_replace(style, r"</hh:charPr>$", tag + "</hh:charPr>"))
        for name, value in (("bold", bold), ("italic", italic)):
            style = style if value is None else with_attribute(style, name, F.lit("1" if value else "0"))
        return _if_said(style, "height", F.lit(font_size)) if font_size else style

    said_in_xml = escape(target or "", quote=False)

    def owners(cut: Cut) -> list[list[int]]:
        """The last run that starts before the first text that holds the target; texts before any run do not count."""
        runs = cut.places(cut.of("hp:run") & (cut.kind == OPEN))
        out = []
        for own, texts in zip(runs, cut.places((cut.kind == TEXT) & (cut.in_t > 0)), strict=True):
            hit = next((i for i in texts if own and own[0] < i and said_in_xml in cut.toks[i]), None)
            out.append([] if hit is None else [own[bisect_left(own, hit) - 1]])
        return out

    return _restyled(members, _header(members, "hh:charPr", change), owners, "charPrIDRef", "target_missing")


def apply_paragraph_style(members: DataFrame, index: int, align: str | None = None, indent: int | None = None, line_spacing: int | None = None) -> DataFrame:
    """The paragraph gets a new paragraph style: a copy of the first one with alignment (its element, else
    an attribute) and indent changed. Line spacing is accepted and not applied."""

    if align and not re.fullmatch("[A-Za-z_]+", align):
        raise ValueError(f"bad_align: {align}")

    def change(style: Column) -> Column:
        if align:
            tag = f'<hh:align horizontal="{align}" vertical="BASELINE"/>'
            style = F.when(style.contains("<hh:align "), F.regexp_replace(style, r"<hh:align [^>]*/>", tag)).when(
                attribute(style, "horizontal").isNotNull(), with_attribute(style, "horizontal", F.lit(align))).otherwise(with_attribute(style, "align", F.lit(align)))
        return style if indent is None else with_attribute(style, "indent", F.lit(indent))

    starts = lambda cut: cut.places(cut.p & cut.starts & (cut.flat == index))
    return _restyled(members, _header(members, "hh:paraPr", change), starts, "paraPrIDRef", "index_range")


# Images

def _places(members: DataFrame, ext: str) -> DataFrame:
    """(doc, item, new_entry, seq): what free_item() gives, and the number behind the document's last member."""
    number = r"(?i)^(?:image|img)(\d{1,9})$"
    stem = F.regexp_extract("entry", r"([^/]*?)(?:\.[^./]*)?$", 1)
    tags = F.regexp_extract_all(F.decode("bytes", "UTF-8"), F.lit(r"(<opf:item\s[^>]*>)"), 1)
    names = F.when(F.col("entry").startswith("BinData/"), F.array(stem)).when(F.col("entry") == "Contents/content.hpf", F.transform(tags, lambda x: attribute(x, "id"))).otherwise(F.array().cast("array<string>"))
    numbers = F.transform(F.filter(F.transform(names, lambda x: F.regexp_extract(x, number, 1)), lambda x: x != ""), lambda x: x.cast("int"))
    used = members.select("doc", "seq", numbers.alias("n")).groupBy("doc").agg(F.array_distinct(F.flatten(F.collect_list("n"))).alias("used"), (F.max("seq") + 1).alias("seq"))
    free = F.array_min(F.array_except(F.sequence(F.lit(1), F.size("used") + 1), F.col("used")))
    return used.select("doc", F.format_string("image%d", free).alias("item"), F.format_string(f"BinData/image%d.{ext}", free).alias("new_entry"), "seq")


def free_item(members: DataFrame, ext: str) -> DataFrame:
    """(doc, item, new_entry): the first imageN that no member of BinData, of any suffix and spelt imageN or imgN, and no
    item of the manifest has, and the member's name with it."""
    return _places(members, ext).drop("seq")


#: What the format wants of a picture beside its item and ids, before and after the item.
PIC_HEAD = (f'" zOrder="0" numberingType="PICTURE" textWrap="TOP_AND_BOTTOM" textFlow="BOTH_SIDES" lock="0" href="" groupLevel="0" reverse="0"><hp:offset x="0" y="0"/><hp:orgSz width="{PICTURE}" height="{PICTURE}"/><hp:curSz width="{PICTURE}" height="{PICTURE}"/>'
            f'<hp:imgRect><hc:pt0 x="0" y="0"/><hc:pt1 x="{PICTURE}" y="0"/><hc:pt2 x="{PICTURE}" y="{PICTURE}"/><hc:pt3 x="0" y="{PICTURE}"/></hp:imgRect><hp:imgClip left="0" right="{PICTURE}" top="0" bottom="{PICTURE}"/><hc:img binaryItemIDRef="')
PIC_TAIL = (f'" bright="0" contrast="0" effect="REAL_PIC" alpha="0"/><hp:sz width="{PICTURE}" widthRelTo="ABSOLUTE" height="{PICTURE}" heightRelTo="ABSOLUTE" protect="0"/>'
            '<hp:pos treatAsChar="1" affectLSpacing="0" flowWithText="1" allowOverlap="0" holdAnchorAndSO="0" vertRelTo="PARA" horzRelTo="COLUMN" vertAlign="TOP" horzAlign="LEFT" vertOffset="0" horzOffset="0"/></hp:pic>')


def insert_image(members: DataFrame, content: Column, ext: str = "png") -> DataFrame:
    """members with a new picture in every document that has a section: `content` under the first free name (free_item),
    in the manifest if there is one, and a paragraph with the picture at the section's end. Only png, jpg,
    bmp and gif."""
    if ext not in ("png", "jpg", "bmp", "gif"):
        raise ValueError(f"bad_image_ext: {ext}")
    # Where parts stand, first whether a section can take the picture, then all that changes: no part meets its document's others.
    part = F.col("entry").rlike(r"(?i)^Contents/section\d+\.xml$")
    sections = members.filter(part)

    def takes(cut: Cut, rows: list[dict]) -> Iterator[tuple]:
        for row, pieces in zip(rows, _ended(cut, rows, lambda *_: ""), strict=True):
            yield row["doc"], row["seq"], pieces is not None

    able = per_part(sections.select("doc", "seq", F.decode("bytes", "UTF-8").alias("xml")), takes, "doc string, at int, able boolean")
    first = able.groupBy("doc").agg(F.min_by(F.struct("at", "able"), "at").alias("f")).filter("f.able").select("doc", F.col("f.at").alias("at"))
    put = stored(_places(members, ext).join(first.hint("merge"), "doc"))

    def body(fresh: int, row: dict, ref: str) -> str:
        return f'<hp:pic id="{fresh + 1}{PIC_HEAD}{row["item"]}{PIC_TAIL}'

    def change(_, rows: list[dict]) -> Iterator[tuple]:
        own = [r for r in rows if r["at"] == r["seq"]]
        own = [r | {"xml": r["xml"].decode()} for r in own]
        new = zip(own, _ended(Cut([r["xml"] for r in own]), own, body), strict=True)
        new = {(r["doc"], r["seq"]): "".join(pieces).encode() for r, pieces in new}
        for r in rows:
            yield r["doc"], r["seq"], r["entry"], r["method"], new.get((r["doc"], r["seq"]), r["xml"])

    said_of = "doc string, seq int, entry string, method int, bytes binary"
    edited = per_part(sections.withColumnRenamed("bytes", "xml").join(put.select("doc", "at", "item").hint("merge"), "doc", "left"), change, said_of, False)
    hpf = F.coalesce(F.col("entry") == "Contents/content.hpf", F.lit(False))
    tag = F.concat(F.lit('<opf:item id="'), "item", F.lit('" href="'), "new_entry", F.lit(f'" media-type="{MEDIA[ext]}" isEmbeded="1"/></opf:manifest>'))
    listed = members.filter(hpf).join(put.drop("seq").hint("merge"), "doc", "left")
    listed = listed.withColumn("bytes", F.when(F.col("item").isNotNull(), F.encode(F.replace(F.decode("bytes", "UTF-8"), F.lit("</opf:manifest>"), tag), "UTF-8")).otherwise(F.col("bytes")))
    new = put.select("doc", "seq", F.col("new_entry").alias("entry"), F.lit(8).alias("method"), content.alias("bytes"))
    every = members.filter(~hpf & ~F.coalesce(part, F.lit(False)))
    for rows in (edited, listed, new):
        every = every.select("doc", "seq", "entry", "method", "bytes").unionByName(rows.select("doc", "seq", "entry", "method", "bytes"))
    return every

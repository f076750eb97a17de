"""Views of parts that are read where they stand: a part's text, cells, pictures and fields from one pass over its tokens, without
token rows and without a shuffle. They give what sources.views gives of the same parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.functions.text import extension, stripped, unescaped
from docweave.sources.markup import CLOSE, DATA, OPEN, TEXT, Cut, number, per_part, said
from docweave.sources.views import FIELD_ENDS, FIELD_STARTS, PAGES, grid_columns, manifest, media_type

_PLACE = "doc string, section int, paragraph long, control long"
_BREAKS = {"hp:lineBreak": "\n", "hp:tab": "\t"}


def body_parts(members: DataFrame) -> DataFrame:
    """(doc, section, entry, xml) of all body sections, the number in the entry's name as section."""
    part = r"(?i)^Contents/section(\d+)\.xml$"
    return members.filter(F.col("entry").rlike(part)).select("doc", F.regexp_extract("entry", part, 1).cast("int").alias("section"), "entry", F.decode("bytes", "UTF-8").alias("xml"))


def says(cut: Cut) -> np.ndarray:
    """Where tokens add to a text: text and character data in hp:t, line breaks and tabs."""
    return (cut.in_t > 0) & ((cut.kind == TEXT) | (cut.kind == DATA) | cut.of(*_BREAKS))


def what(cut: Cut, i: int) -> str:
    """What such a token adds."""
    if cut.kind[i] == TEXT:
        return unescaped(cut.toks[i])
    return cut.toks[i][len("<![CDATA[") : -len("]]>")] if cut.kind[i] == DATA else _BREAKS[cut.name(i)]


def _maybe(x: int, least: int = 0) -> int | None:
    return None if x < least else int(x)


# Text

def _notes(cut: Cut, of: list[int], speaks: np.ndarray) -> list[dict]:
    """Controls that hold paragraphs of their own, in order; of: the tokens in such elements. A control's text is that of its own paragraphs."""
    found: list[dict] = []
    last: dict[tuple[int, int], dict] = {}
    for i in of:
        key = int(cut.paragraph[i]), int(cut.control[i])
        if cut.starts_control[i]:
            last[key] = {"place": key, "tag": cut.toks[i], "name": cut.name(i), "lines": [[]], "script": [], "level": 0}
            found.append(last[key])
        c = last.get(key)
        if c is None:
            continue
        if c["name"] == "hp:equation":
            name, kind = cut.name(i), cut.kind[i]
            if name == "hp:script":
                c["level"] += (kind == OPEN) - int(kind == CLOSE)
            if kind == TEXT and c["level"] > 0:
                c["script"].append(unescaped(cut.toks[i]))
        elif cut.in_p[i] == 2 and cut.in_tbl[i] == 0:
            if cut.p[i] and cut.kind[i] == OPEN:
                c["lines"].append([])
            if speaks[i]:
                c["lines"][-1].append(what(cut, i))
    for c in found:
        c["text"] = stripped("\n".join("".join(x) for x in c["lines"]))
    return found


def _said_by(rows: list[tuple[tuple, str]]) -> str | None:
    return "\n".join(line for _, line in sorted(rows)) if rows else None


def _texts(cut: Cut, rows: list[dict]) -> Iterator[tuple]:
    speaks = says(cut)
    body = cut.places(speaks & (cut.paragraph >= 0) & (cut.in_p == 1) & (cut.in_tbl == 0) & (cut.in_note == 0))
    noted = cut.places((cut.in_note > 0) & (cut.paragraph >= 0))
    paragraphs = cut.paragraph
    for row, n, own, notes in zip(rows, cut.many(cut.begins_paragraph), body, noted, strict=True):
        lines: list[list[str]] = [[] for _ in range(n)]
        for i, p in zip(own, paragraphs[own].tolist() if own else [], strict=True):
            lines[p].append(what(cut, i))
        section, kinds = row["section"], {}
        heads: dict[tuple[str, int], tuple] = {}
        for c in _notes(cut, notes, speaks) if notes else []:
            place, name = c["place"], c["name"]
            if name in ("hp:header", "hp:footer"):
                label = said(c["tag"], "applyPageType")
                heads.setdefault((name, PAGES.get(label, 0)), (place, f"[section {section} {label or ''}] {c['text']}"))
            elif name == "hp:footNote":
                kinds.setdefault(name, []).append((place, f"[{number(said(c['tag'], 'number')) or 0}] {c['text']}"))
            elif name == "hp:equation" and any(c["script"]):
                kinds.setdefault(name, []).append((place, f"[eq {section}/{place[0]}/{place[1]}] {''.join(c['script'])}"))
        for (name, _), x in heads.items():
            kinds.setdefault(name, []).append(x)
        yield row["doc"], section, _said_by(kinds.get("hp:header", [])), "\n".join("".join(x) for x in lines) if n else None, _said_by(kinds.get("hp:footer", [])), _said_by(kinds.get("hp:footNote", [])), _said_by(kinds.get("hp:equation", []))


def texts(members: DataFrame) -> DataFrame:
    """(doc, section, headers, body, footers, footnotes, equations): lines of each body section as report.full_text() joins them,
    null where it has none of a kind. Sections without tokens have a row too."""
    return per_part(body_parts(members), _texts, "doc string, section int, headers string, body string, footers string, footnotes string, equations string")


# Tables

def _tables(cut: Cut) -> list[list[dict]]:
    """For each part its outermost tables with cells, as views.table_cells() has them: place, n_rows, n_cols and the cells (row, nth,
    cell, column, row span, column span, text) in order of row."""
    speaks = says(cut)
    inside = (cut.table >= 0) & (cut.in_tbl == 1)
    heads = cut.places(inside & cut.tbl & (cut.kind != CLOSE))
    facts = cut.of("hp:cellAddr", "hp:cellSpan") & (cut.kind != CLOSE)
    tags = cut.places(inside & (cut.cell >= 0) & (speaks | facts | cut.tc & (cut.kind != CLOSE) | cut.p & (cut.kind == OPEN)))
    address = cut.of("hp:cellAddr")
    out = []
    for head, own in zip(heads, tags, strict=True):
        tables: dict[int, dict] = {}
        for i in head:
            tables.setdefault(int(cut.table[i]), {
                "place": (_maybe(cut.paragraph[i]), _maybe(cut.control[i], -1)), "rows": number(said(cut.toks[i], "rowCnt")), "cols": number(said(cut.toks[i], "colCnt")), "cells": {}})
        keys = zip(cut.table[own].tolist(), cut.row[own].tolist(), cut.cell[own].tolist(), strict=True) if own else ()
        for i, (table, row, cell) in zip(own, keys, strict=True):
            if table not in tables:
                continue
            c = tables[table]["cells"].setdefault((row, cell), {"addr": {}, "lines": [[]]})
            tok = cut.toks[i]
            if speaks[i]:
                c["lines"][-1].append(what(cut, i))
            elif cut.p[i]:
                c["lines"].append([])
            else:
                for name in ("rowAddr", "colAddr") if address[i] else ("rowSpan", "colSpan"):
                    x = said(tok, name)
                    if x is not None:
                        c["addr"][name] = max(c["addr"].get(name, ""), x)
        found = []
        for k, t in tables.items():
            cells = []
            for (row, cell), c in t["cells"].items():
                at, col, down, wide = (number(c["addr"].get(x)) for x in ("rowAddr", "colAddr", "rowSpan", "colSpan"))
                cells.append((max(row, 0) if at is None else at, row, cell, col, 1 if down is None else down, 1 if wide is None else wide, stripped("\n".join("".join(x) for x in c["lines"]))))
            if not cells:
                continue
            cells.sort(key=lambda c: c[:3])
            cols = grid_columns(*([c[j] for c in cells] for j in (0, 3, 4, 5)))
            wide = max(col + (c[5] if c[3] is None else 1) for c, col in zip(cells, cols, strict=True))
            found.append({
                "table": k, "place": t["place"], "n_rows": max(c[0] for c in cells) + 1 if t["rows"] is None else t["rows"], "n_cols": wide if t["cols"] is None else t["cols"],
                "cells": [(c[0], c[1], c[2], col, *c[4:]) for c, col in zip(cells, cols, strict=True)]})
        out.append(found)
    return out


def _cells(cut: Cut, rows: list[dict]) -> Iterator[tuple]:
    for row, tables in zip(rows, _tables(cut), strict=True):
        for t in tables:
            for idx, (r, _, _, col, down, wide, text) in enumerate(sorted(t["cells"], key=lambda c: c[1:3])):
                yield row["doc"], row["section"], *t["place"], t["table"], t["n_rows"], t["n_cols"], idx, r, col, down, wide, text


def table_cells(members: DataFrame) -> DataFrame:
    """(doc, section, paragraph, control, table, n_rows, n_cols, cell_idx, row, col, row_span, col_span, text) of all body
    sections; see views.table_cells()."""
    return per_part(body_parts(members), _cells, f"{_PLACE}, table long, n_rows int, n_cols int, cell_idx int, row int, col int, row_span int, col_span int, text string")


def _grids(cut: Cut, rows: list[dict]) -> Iterator[tuple]:
    for row, tables in zip(rows, _tables(cut), strict=True):
        for t in tables:
            n, m = t["n_rows"], t["n_cols"]
            if n > 0 and m > 0:
                grid = {(c[0], c[3]): c[6] for c in sorted(t["cells"], key=lambda c: c[1:3])}
                yield row["doc"], row["section"], *t["place"], t["table"], n, m, [[grid.get((i, j), "") for j in range(m)] for i in range(n)]


def tables(members: DataFrame) -> DataFrame:
    """(doc, section, paragraph, control, table, n_rows, n_cols, cells): dense grids; see views.tables()."""
    return per_part(body_parts(members), _grids, f"{_PLACE}, table long, n_rows int, n_cols int, cells array<array<string>>")


# Pictures

def _pictures(cut: Cut, rows: list[dict]) -> Iterator[tuple]:
    img = cut.of("hc:img")
    own = cut.places((cut.paragraph >= 0) & (cut.in_p == 1) & (cut.starts_control | img))
    for row, at in zip(rows, own, strict=True):
        places: dict[tuple, dict] = {}
        for i in at:
            c = places.setdefault((int(cut.paragraph[i]), int(cut.control[i])), {"name": "", "item": None})
            if cut.starts_control[i]:
                c["name"] = max(c["name"], cut.name(i))
            elif (x := said(cut.toks[i], "binaryItemIDRef")) is not None:
                c["item"] = max(c["item"] or "", x)
        for place, c in places.items():
            if c["name"] == "hp:pic" and c["item"] is not None:
                yield row["doc"], row["section"], *place, c["item"]


def images(members: DataFrame) -> DataFrame:
    """(doc, section, paragraph, control, entry, mime, ext, byte_length) of pictures whose bytes the package holds; see views.images()."""
    refs = per_part(body_parts(members), _pictures, f"{_PLACE}, item string")
    sizes = members.filter(F.col("entry").startswith("BinData/")).select("doc", "entry", F.octet_length("bytes").cast("long").alias("byte_length"))
    found = refs.join(manifest(members).hint("merge"), ["doc", "item"]).join(sizes.hint("merge"), ["doc", "entry"])
    mime = media_type(F.col("entry"))
    return found.select("doc", "section", "paragraph", "control", "entry", mime.alias("mime"), extension(mime).alias("ext"), "byte_length")


# Fields

def spans(cut: Cut, marks: list[int], begins: np.ndarray) -> list[dict]:
    """A part's fields in order: ord from 1, name, type, start, and stop, the token of its own end, or None, and after, the next
    mark, or None. Ends close the latest open start, as brackets do."""
    found: list[dict] = []
    still: list[dict] = []
    for i, after in zip(marks, [*marks[1:], None], strict=False):
        if begins[i]:
            name = said(cut.toks[i], "name")
            still.append({"ord": len(found) + 1, "name": unescaped("?" if name is None else name), "type": said(cut.toks[i], "type") or "", "start": i, "stop": None, "after": after})
            found.append(still[-1])
        elif still:
            still.pop()["stop"] = i
    return found


def field_marks(cut: Cut) -> tuple[np.ndarray, np.ndarray]:
    """Where fields start, and where they start or end."""
    begins = cut.of(*FIELD_STARTS) & (cut.kind != CLOSE)
    return begins, begins | cut.of(*FIELD_ENDS) & (cut.kind != CLOSE)


def _fields(cut: Cut, rows: list[dict]) -> Iterator[tuple]:
    begins, marks = field_marks(cut)
    spoken = cut.places(says(cut))
    for row, at, own in zip(rows, cut.places(marks), spoken, strict=True):
        if not at:
            continue
        pieces = [what(cut, i) for i in own]
        off = np.concatenate(([0], np.cumsum([len(x) for x in pieces]))).astype(int)
        before = dict(zip(at, off[np.searchsorted(own, at)].tolist() if own else [0] * len(at), strict=True))
        text = "".join(pieces)
        for f in spans(cut, at, begins):
            stop = f["after"] if f["stop"] is None else f["stop"]
            yield row["doc"], row["section"], f["ord"], f["name"], f["type"], text[before[f["start"]] : len(text) if stop is None else before[stop]]


def fields(members: DataFrame) -> DataFrame:
    """(doc, section, ord, name, type, value) of all body sections; see views.fields()."""
    return per_part(body_parts(members), _fields, "doc string, section int, ord long, name string, type string, value string")

"""Section XML as rows of tokens, each with its place in the document.

A token is a tag or a run of text. A part is cut and counted in one pass over its text, in the task that has its row:
running sums over its tokens give what is open at each, so paragraphs, controls, tables, rows and cells get their
indexes at any nesting without a shuffle. An edit is a filter, a projection or a union of token rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType

#: Comments, character data, tags (a > in a quoted value does not end them), text.
TOKEN = re.compile(r"""(?s)(<!--.*?-->|<!\[CDATA\[.*?\]\]>|<(?:[^<>"']++|"[^"]*"|'[^']*')++>|[^<]++)""")
#: Elements that count as controls of a paragraph, and those of them that hold paragraphs of their own.
CONTROLS = ("hp:tbl", "hp:pic", "hp:equation", "hp:footNote", "hp:endNote", "hp:header", "hp:footer", "hp:fldBegin", "hp:fieldBegin")
NOTES = ("hp:equation", "hp:footNote", "hp:endNote", "hp:header", "hp:footer")
#: Fixed value: ids are below this.
MOST_ID = 1 << 32
_PART = ["doc", "entry"]


def attribute(tag: Column, name: str) -> Column:
    """An attribute's value in a tag; null without it."""
    value = F.regexp_extract(tag, rf'\s{name}="([^"]*)"', 1)
    return F.when(tag.rlike(rf'\s{name}="'), value)


def with_attribute(tag: Column, name: str, value: Column) -> Column:
    """The tag with the attribute set, or added before all others."""
    safe = F.regexp_replace(value.cast("string"), r"([\\$])", r"\\$1")
    put = F.concat(F.lit(f'$1 {name}="'), safe, F.lit('"'))
    return F.when(tag.rlike(rf'\s{name}="'), F.regexp_replace(tag, F.lit(rf'^(<[^>]*?)\s{name}="[^"]*"'), put)).otherwise(F.regexp_replace(tag, F.lit(r"^(<[^\s/>]+)"), put))


#: Tokens of a part that go to Spark at once.
RUN = 1 << 16
_COUNTERS = ("in_p", "in_tbl", "in_t", "in_note", "in_lines", "in_script", "in_props", "depth", "flat_opens", "flat", "paragraph", "table", "control", "row", "cell")
_FIELDS = [StructField("at", IntegerType()), StructField("sub", IntegerType()), StructField("tok", StringType()), StructField("name", StringType()), StructField("kind", StringType()),
           *(StructField(c, LongType()) for c in _COUNTERS), StructField("starts_control", BooleanType())]


#: Kinds of tokens; the last is character data, which rows of tokens call other.
KINDS = ("open", "close", "empty", "text", "other", "other")
OPEN, CLOSE, EMPTY, TEXT, OTHER, DATA = range(len(KINDS))
#: Characters of parts that are cut together, so that small parts share the steps over arrays.
TOGETHER = 1 << 19


def _named(tok: str) -> tuple[str, int]:
    """(name, kind) of a token."""
    if tok[0] != "<":
        return "", TEXT
    if tok[1] in "!?":
        return "", DATA if tok.startswith("<![CDATA[") else OTHER
    return re.match(r"</?([^\s/>]*)", tok)[1], CLOSE if tok[1] == "/" else EMPTY if tok.endswith("/>") else OPEN


class Cut:
    """Tokens of parts, one part after the other, with their names, kinds and counters as arrays; part i has the tokens from
    bounds[i] to bounds[i + 1]. A counter is below 0 (control: below -1) where it is null."""

    def __init__(self, xmls: list[str | None]) -> None:
        parts = [TOKEN.findall(x or "") for x in xmls]
        self.toks = toks = [t for p in parts for t in p]
        self.bounds = np.cumsum([0, *map(len, parts)])
        ids: dict[str, int] = {}
        known = {}
        for t in set(toks):
            name, kind = _named(t)
            known[t] = ids.setdefault(name, len(ids)) * len(KINDS) + kind
        codes = np.fromiter(map(known.__getitem__, toks), np.int64, len(toks))
        self.names, self._ids, self._name, self.kind = list(ids), ids, codes // len(KINDS), codes % len(KINDS)
        self._count()

    def of(self, *names: str) -> np.ndarray:
        """Where the tokens of these names are."""
        return self._table([n in names for n in self.names])[self._name]

    @staticmethod
    def _table(said: list[bool]) -> np.ndarray:
        return np.array(said, bool) if said else np.zeros(1, bool)

    def name(self, i: int) -> str:
        return self.names[self._name[i]]

    def places(self, mask: np.ndarray) -> list[list[int]]:
        """The tokens of each part where the mask is true."""
        at = np.flatnonzero(mask)
        ends = np.searchsorted(at, self.bounds).tolist()
        at = at.tolist()
        return [at[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def many(self, mask: np.ndarray) -> list[int]:
        """How many tokens of each part the mask has."""
        upto = np.concatenate(([0], np.cumsum(mask)))[self.bounds]
        return np.diff(upto).tolist()

    def _count(self) -> None:
        n, kind = len(self.toks), self.kind
        part = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        begin = self.bounds[part]  # of each token, where its part begins
        new = np.arange(n) == begin

        def upto(x: np.ndarray) -> np.ndarray:
            """How many are true in the part up to each place."""
            total = np.concatenate(([0], np.cumsum(x)))
            return total[1:] - total[begin]

        def since(x: np.ndarray, start: np.ndarray) -> np.ndarray:
            """How many are true up to each place since the last place of the part where start is, or since its beginning."""
            first = np.maximum.accumulate(np.where(start | new, np.arange(n), 0)) if n else np.empty(0, np.int64)
            total = np.concatenate(([0], np.cumsum(x)))
            return total[1:] - total[first]

        self.starts = starts = (kind == OPEN) | (kind == EMPTY)
        ends = (kind == CLOSE) | (kind == EMPTY)
        depth = lambda own: upto(own & starts) - upto(own & ends) + (own & ends)
        p, tbl, tr, tc = self.of("hp:p"), self.of("hp:tbl"), self.of("hp:tr"), self.of("hp:tc")
        self.p, self.tbl, self.tr, self.tc, self.t = p, tbl, tr, tc, self.of("hp:t")
        self.in_p, self.in_tbl, self.in_t, self.in_note = depth(p), depth(tbl), depth(self.t), depth(self.of(*NOTES))
        self.in_lines, self.in_script, self.in_props = depth(self.of("hp:linesegarray")), depth(self.of("hp:script")), depth(self.of("hp:secPr"))
        self.depth = depth(np.ones(n, bool))
        in_p, in_tbl = self.in_p, self.in_tbl

        group = np.cumsum(p & ends) - (p & ends) + part  # from one paragraph's end, or a part's beginning, to the next
        opens = p & starts
        nth = since(opens, np.diff(group, prepend=-1) > 0)
        ended = np.zeros(int(group[-1]) + 1 if n else 0, bool)
        ended[group[p & ends]] = True
        nth = np.where(ended[group], nth, 0)
        self.flat_opens = np.bincount(group, opens, minlength=1).astype(np.int64)[group] if n else np.empty(0, np.int64)
        self.begins_flat = opens & (nth == 1)
        self.flat = np.where(nth > 0, upto(self.begins_flat) - 1, -1)

        first, outer = starts & (in_p == 1), starts & (in_tbl == 1)
        top = (in_tbl == 0) | tbl & (in_tbl == 1)  # in no table, but for the table itself
        self.starts_control = control = self.of(*CONTROLS) & first & top
        inside = lambda own: upto(own & outer) - upto(own & ends & (in_tbl == 1)) + (own & ends & (in_tbl == 1)) > 0
        self.begins_paragraph = p & first
        self.paragraph = np.where(in_p > 0, upto(p & first) - 1, -1)
        self.table = np.where(in_tbl > 0, upto(tbl & outer) - 1, -1)
        self.control = np.where(in_p > 0, since(control, p & first) - 1, -2)  # -1: before a paragraph's first control
        self.row = np.where(inside(tr), since(tr & outer, tbl & outer) - 1, -1)
        self.cell = np.where(inside(tc), since(tc & outer, tr & outer) - 1, -1)


def together(xmls: list[str | None]) -> Iterator[tuple[int, int]]:
    """(first, end) of parts that are cut together."""
    first = size = 0
    for i, xml in enumerate(xmls):
        size += len(xml or "")
        if size >= TOGETHER:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(xmls):
        yield first, len(xmls)


#: Characters or bytes that go to Spark at once, but for a longer row.
MOST = 1 << 22


def arrow_batches(rows: Iterable[tuple], schema: pa.Schema, size: Callable[[tuple], int]) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about MOST in size at most."""

    def batch(got: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*got, strict=True), schema, strict=True)], schema=schema)

    got, total = [], 0
    for row in rows:
        got.append(row)
        total += size(row)
        if total >= MOST or len(got) >= RUN:
            yield batch(got)
            got, total = [], 0
    if got:
        yield batch(got)


def per_part(parts: DataFrame, change: Callable[[Cut | None, list[dict]], Iterable[tuple]], schema: str, cut: bool = True) -> DataFrame:
    """Rows of the schema as change(cut, rows) gives them for parts (..., xml) that are cut together, or with cut=False
    come together uncut; rows: the parts' columns. All of a part is read in the task that has its row, so that there is no shuffle."""
    kind = StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for a, b in together([r["xml"] for r in rows]):
                yield from arrow_batches(change(Cut([r["xml"] for r in rows[a:b]]) if cut else None, rows[a:b]), arrow, lambda r: sum(len(x) for x in r if isinstance(x, str | bytes)))

    return parts.mapInArrow(run, kind)


def tokens(parts: DataFrame, *only: str) -> DataFrame:
    """Rows (doc, entry, section, at, sub, tok, name, kind, ...) of parts (doc, entry,
    section, xml), `at` counting from 0 and sub 0; further columns of parts stay. kind: open, close, empty, text or other. only: of
    the columns below and those before, the ones to give, all if none is named.

    in_p, in_tbl, in_t, in_note, in_lines, in_script, in_props (hp:secPr): how many such elements are open, a tag's own
    included; depth: how many of any kind. paragraph: the outermost paragraph's index; control: its last control's index so
    far, -1 before the first; table, row, cell: indexes of the outermost table and of rows and
    cells in it. All are null outside of such an element. flat: index of the span from a
    paragraph's start to the next paragraph end, nested ones too; flat_opens: paragraphs that
    start in it, more than one where it holds others."""
    kept = [c for c in parts.columns if c != "xml"]
    fields = [f for f in _FIELDS if not only or f.name in only]
    schema = StructType([*(parts.schema[c] for c in kept), *fields])
    arrow = to_arrow_schema(schema)

    def column(cut: Cut, name: str, a: int, b: int, begin: np.ndarray):
        if name == "at":
            return np.arange(a, b, dtype=np.int32) - begin.astype(np.int32)
        if name == "sub":
            return np.zeros(b - a, np.int32)
        if name == "tok":
            return cut.toks[a:b]
        if name == "name":
            return [cut.names[i] for i in cut._name[a:b].tolist()]
        if name == "kind":
            return [KINDS[i] for i in cut.kind[a:b].tolist()]
        return getattr(cut, name)[a:b]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xmls = batch.column("xml").to_pylist()
            for first, end in together(xmls):
                cut = Cut(xmls[first:end])
                part = np.repeat(np.arange(end - first), np.diff(cut.bounds))
                for a in range(0, len(part), RUN):
                    b = min(a + RUN, len(part))
                    of = part[a:b]
                    arrays = [batch.column(c).take(pa.array(of + first)) for c in kept]
                    for f in fields:
                        v = column(cut, f.name, a, b, cut.bounds[of])
                        null = v < (-1 if f.name == "control" else 0) if f.name in _COUNTERS else None
                        arrays.append(pa.array(v, arrow.field(f.name).type, mask=null))
                    yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return parts.select(*kept, "xml").mapInArrow(run, schema)


# The same on plain strings, for steps that work on a part's tokens where it stands.

@cache
def _pattern(text: str) -> re.Pattern:
    return re.compile(text, re.A)


def said(tag: str, name: str) -> str | None:
    """attribute() of a string."""
    if name not in tag or not _pattern(rf'\s{name}="').search(tag):
        return None
    found = _pattern(rf'\s{name}="([^"]*)"').search(tag)
    return found[1] if found else ""


def with_said(tag: str, name: str, value: str | int) -> str:
    """with_attribute() of a string."""
    if said(tag, name) is not None:
        return _pattern(rf'^(<[^>]*?)\s{name}="[^"]*"').sub(lambda m: f'{m[1]} {name}="{value}"', tag)
    return _pattern(r"^(<[^\s/>]+)").sub(lambda m: f'{m[1]} {name}="{value}"', tag)


def if_said(tag: str, name: str, value: str | int) -> str:
    """The tag with the attribute set if it has it."""
    return tag if said(tag, name) is None else with_said(tag, name, value)


def number(text: str | None) -> int | None:
    """An attribute's value as an integer; null if it is none."""
    return int(text) if text is not None and _pattern(r"\s*[+-]?[0-9]{1,18}\s*").fullmatch(text) else None


def free_id(xml: str) -> int:
    """The first of the widest range of 32-bit ids that no tag of the part uses. New elements of an edit count on from it, so no
    two share an id, nor do those of edits made one after the other."""
    used = sorted({0, MOST_ID, *(x for x in map(int, _pattern(r'\sid="([0-9]{1,10})"').findall(xml)) if x < MOST_ID)})
    return 1 - max((b - a, -a) for a, b in zip(used[:-1], used[1:], strict=True))[1]


def assembled(t: DataFrame, **more: Column) -> DataFrame:
    """(doc, entry, xml) of token rows, in the order of at and sub, and aggregates `more` of the same rows."""
    rows = F.array_sort(F.collect_list(F.struct("at", "sub", "tok")))
    return t.groupBy(*_PART).agg(F.array_join(F.transform(rows, lambda r: r["tok"]), "").alias("xml"), *(v.alias(k) for k, v in more.items()))


def put_back(members: DataFrame, parts: DataFrame) -> DataFrame:
    """Members (doc, seq, entry, method, bytes) with the bytes of parts (doc, entry, xml); a null xml changes nothing."""
    new = parts.filter("xml is not null").select("doc", "entry", F.encode("xml", "UTF-8").alias("new_bytes"))
    # New bytes are as long as the parts; sent to all tasks they would meet in the driver's memory.
    return members.join(new.hint("merge"), _PART, "left").select("doc", "seq", "entry", "method", F.coalesce("new_bytes", "bytes").alias("bytes"))

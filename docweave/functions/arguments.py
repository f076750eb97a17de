"""JSON arguments as they mean it that write them for JavaScript: ordered pairs, and content items.

Spark's own JSON reader makes maps of objects, which keep neither the order of integer keys nor repeated ones, and
takes broken texts; so a small step in Arrow batches reads them. A code says what is wrong; nothing ends the job.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

PAIRS = "code string, pairs array<struct<key:string,value:string>>"
ITEMS = "code string, items array<struct<pos:int,type:string,text:string,headers:array<string>,rows:array<array<string>>>>"
#: Fixed value: keys that are integers below this come first, by size.
MOST_INDEX = (1 << 32) - 1


def _refused(name: str):
    raise ValueError(name)


def parsed(text: str | None):
    """What a JSON text says; ValueError if it is none. NaN and infinities are none."""
    if text is None:
        raise ValueError("null")
    try:
        return json.loads(text, parse_constant=_refused)
    except RecursionError as deep:
        raise ValueError("nested too deep") from deep


def _plain(s: str) -> str:
    """Halves of surrogate pairs, which UTF-8 has not, as the replacement character."""
    return s.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def ordered(of: dict) -> list[tuple[str, object]]:
    """The object's members, integer keys first by size, then the others by their first place; a repeated key has its last value."""
    index = lambda k: int(k) if re.fullmatch("0|[1-9][0-9]{0,9}", k) and int(k) < MOST_INDEX else None
    first = sorted((k for k in of if index(k) is not None), key=int)
    return [(k, of[k]) for k in first] + [(k, v) for k, v in of.items() if index(k) is None]


def pairs_of(text: str | None) -> tuple[str, list | None]:
    """(code, pairs): ok; bad_json: no JSON object; bad_value: a value is no string; empty_key."""
    try:
        of = parsed(text)
    except ValueError:
        return "bad_json", None
    if not isinstance(of, dict):
        return "bad_json", None
    if not all(isinstance(v, str) for v in of.values()):
        return "bad_value", None
    if "" in of:
        return "empty_key", None
    return "ok", [{"key": _plain(k), "value": _plain(v)} for k, v in ordered(of)]


def _cell(x) -> str:
    """A value as joined text shows it: nothing for null."""
    if x is None:
        return ""
    if isinstance(x, str):
        return _plain(x)
    if isinstance(x, float) and x == int(x) and abs(x) < 1e21:
        return str(int(x))
    return ",".join(map(_cell, x)) if isinstance(x, list) else json.dumps(x)


def items_of(text: str | None) -> tuple[str, list | None]:
    """(code, items): ok; bad_json: no JSON array; bad_item: an item that is null, a text without text, a table without arrays."""
    try:
        of = parsed(text)
    except ValueError:
        return "bad_json", None
    if not isinstance(of, list):
        return "bad_json", None
    out = []
    for pos, x in enumerate(of):
        kind = x.get("type") if isinstance(x, dict) else None
        if x is None or kind == "text" and not isinstance(x.get("text"), (str, int, float)):
            return "bad_item", None
        if kind == "text":
            out.append((pos, "text", _cell(x["text"]), None, None))
        elif kind == "table":
            rows = x.get("rows")
            if not isinstance(x.get("headers"), list) or not isinstance(rows, list) or not all(isinstance(r, list) for r in rows):
                return "bad_item", None
            out.append((pos, "table", None, [_cell(c) for c in x["headers"]], [[_cell(c) for c in r] for r in rows]))
    names = ("pos", "type", "text", "headers", "rows")
    return "ok", [dict(zip(names, x, strict=True)) for x in out]


def _pairs(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([pairs_of(x) for x in texts], columns=["code", "pairs"])


def _items(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([items_of(x) for x in texts], columns=["code", "items"])


def json_pairs(text: Column | str) -> Column:
    """struct(code, pairs) of a JSON object of strings: its pairs in the order in which JavaScript goes through them."""
    return F.pandas_udf(_pairs, PAIRS)(text)


def json_items(text: Column | str) -> Column:
    """struct(code, items) of a JSON array of content items; items of types other than text and table are left out."""
    return F.pandas_udf(_items, ITEMS)(text)

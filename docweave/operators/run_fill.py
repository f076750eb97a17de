"""Template fill whose keys may be split over runs.

A word processor cuts a paragraph's text into runs wherever its style or its editing history changes, so a key that a
reader sees as one may lie in several text nodes. Here the texts of a stretch, the nodes that only tags of runs and
text nodes part, are searched as one. The value goes to the node where the key starts, the others lose their part of it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import escape
from itertools import groupby
from operator import itemgetter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.operators.package_edit import whole_edits
from docweave.sources.markup import TEXT, Cut

#: Stands between the texts of a stretch; no XML text may hold it.
BORDER = "\x01"
#: Tags that part the nodes of a stretch and do not end it.
THIN = ("hp:run", "hp:t")


def _step(key: str, value: str, all_occurrences: bool) -> Callable[[str], str | None]:
    """What replaces a key's last occurrence, or all, in joined texts, borders within it put behind the value; null without one."""
    key, value = escape(key, quote=False), escape(value, quote=False)
    pattern = f"({BORDER}*)".join(map(re.escape, key))
    every = re.compile(pattern)
    last = re.compile(f"(?s)^(.*){pattern}")

    def of(s: str) -> str | None:
        if BORDER not in s:
            at = s.rfind(key)
            if at < 0:
                return None
            return s.replace(key, value) if all_occurrences else s[:at] + value + s[at + len(key) :]
        if key not in s.replace(BORDER, ""):
            return None
        if all_occurrences:
            return every.sub(lambda m: value + "".join(m.groups()), s)
        return last.sub(lambda m: m[1] + value + "".join(m.groups()[1:]), s)

    return of


def fill_across_runs(members: DataFrame, pairs: list[tuple[str, str]], all_occurrences: bool = False) -> DataFrame:
    """Edits (doc, entry, code, n, xml, hits) of all section parts and the header, as package_edit.fill() gives them, with each
    pair's key replaced once in a stretch, at its last place, or at all with all_occurrences, later pairs in what earlier ones
    left. hits: how many stretches each pair changed.

    A stretch ends at a paragraph's start and end and at any other element (a tab, a table, a field's mark), so no key is found
    across one; text beside such an element within a node takes part. Line layout tags end none. Stretches with a
    character that stands for the border, which no XML may hold, stay as they are. A key must not be empty, and neither key nor value hold it."""
    if not all(key for key, _ in pairs) or any(BORDER in x for pair in pairs for x in pair):
        raise ValueError("a key must not be empty, nor a pair hold U+0001")
    parts = members.filter(F.col("entry").rlike(r"(?i)^Contents/(section\d+|header)\.xml$")).select("doc", "entry", F.decode("bytes", "UTF-8").alias("xml"))
    steps = [_step(k, v, all_occurrences) for k, v in pairs]

    def change(cut: Cut, rows: list[dict]) -> Iterator[tuple]:
        ends = (cut.kind != TEXT) & ~cut.of(*THIN) & (cut.in_lines == 0)
        stretch = np.cumsum(ends)
        nodes = cut.places((cut.kind == TEXT) & (cut.in_t > 0))
        for own, a, b in zip(nodes, cut.bounds[:-1].tolist(), cut.bounds[1:].tolist(), strict=True):
            pieces, hits = cut.toks[a:b], [0] * len(steps)
            for _, at in groupby(zip(stretch[own].tolist() if own else (), own, strict=True), key=itemgetter(0)):
                at = [i for _, i in at]
                texts = [cut.toks[i] for i in at]
                if any(BORDER in x for x in texts):
                    continue
                s = was = BORDER.join(texts)
                for k, step in enumerate(steps):
                    new = step(s)
                    if new is not None:
                        hits[k] += 1
                        s = new
                if s is not was:
                    for i, x in zip(at, s.split(BORDER), strict=True):
                        pieces[i - a] = x
            yield "ok", sum(hits), pieces, hits

    return whole_edits(parts, change, ", hits array<long>")

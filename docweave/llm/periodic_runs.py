"""Periodic run detection by an all-lag vectorised scan.

A text's words become numbers, and the array of numbers is compared with itself at each shift up to
n / min_exp; a stretch of equal places is a run with that shift as a period. Texts of a batch stand one
after the other, the longest first, with numbers of their own, so that one comparison serves a shift in
all texts that are long enough. A text whose scan is longer than one unit of work is cut into ranges of
shifts that Spark deals to its tasks, and the runs of the ranges meet again by text.

Only the smallest shift of a stretch is its period: if a stretch of three periods or more has a smaller
period too, that divides the larger one and has the same stretch, so equal stretches keep the smallest shift.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import in_slices, stored

#: Eight equal places side by side, as one number.
_ALL = np.uint64(0x0101010101010101)
RUN = "array<struct<start:long,length:long,period:long>>"


def word_ids(words: list[bytes]) -> np.ndarray:
    """Each word's number, by first place."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int32, len(words))


def last_lag(n: int, least: int, exponent: int) -> int:
    """The largest shift that a run of n words can have as its period."""
    return n // exponent if n >= least else 0


def scan(ids: list[np.ndarray], first: int, last: int, least: int, exponent: int) -> list[dict[tuple[int, int], int]]:
    """For each array of word numbers {(start, length): smallest period from first to last} of the stretches that
    have such a period, are as long as `least` words and as `exponent` periods, and cannot be extended."""
    found: list[dict[tuple[int, int], int]] = [{} for _ in ids]
    order = sorted(range(len(ids)), key=lambda i: -len(ids[i]))
    lengths = np.array([len(ids[i]) for i in order], np.int64)
    ends = np.cumsum(lengths)
    below, parts = 0, []
    for i in order:  # no number is in two texts
        parts.append(ids[i] + np.int32(below))
        below += int(ids[i].max()) + 1 if len(ids[i]) else 0
    line = np.concatenate(parts) if parts else np.empty(0, np.int32)
    room = np.zeros(len(line) + 8, bool)
    for lag in range(first, last + 1):
        texts = int(np.searchsorted(-lengths, -max(least, exponent * lag), side="right"))  # those long enough stand in front
        if not texts:
            break
        n, need = int(ends[texts - 1]) - lag, max(least, exponent * lag) - lag
        np.equal(line[lag : n + lag], line[:n], out=room[:n])
        room[n : n + 8] = False
        if need >= 15:  # such a stretch holds eight places that start at a multiple of eight
            hits = np.flatnonzero(room[: (n + 7) // 8 * 8].view(np.uint64) == _ALL) * 8
        else:
            hits = np.flatnonzero(room[:n])
        if not len(hits):
            continue
        for t in np.unique(np.searchsorted(ends, hits, side="right")).tolist():
            a, b = int(ends[t] - lengths[t]), min(int(ends[t]), n)
            edge = np.flatnonzero(np.diff(room[a:b].view(np.int8), prepend=0, append=0))
            start, stop = edge[0::2], edge[1::2]
            own = found[order[t]]
            for i in np.flatnonzero(stop - start >= need).tolist():
                own.setdefault((int(start[i]), int(stop[i] - start[i]) + lag), lag)
    return found


def sorted_runs(found: dict[tuple[int, int], int]) -> list[tuple[int, int, int]]:
    """(start, length, period) by start, then period."""
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words but those of a run after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return b" ".join([w for w, g in zip(words, np.cumsum(gone).tolist(), strict=False) if not g])


def _words(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode("utf-8", "surrogatepass").split()  # bytes split at \x20 and \x09-\x0D alone


def _frame(batch: pd.DataFrame, words: list[list[bytes]], runs: list[list[tuple[int, int, int]]], keys: list[str]) -> pd.DataFrame:
    best = [min(r, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None) for r in runs]
    return pd.DataFrame({**{k: batch[k] for k in keys}, "n_words": list(map(len, words)), "runs": [[dict(zip(("start", "length", "period"), x, strict=True)) for x in r] for r in runs], "best": [None if b is None else dict(zip(("start", "length", "period"), b, strict=True)) for b in best],
                         "text": [collapsed(w, r).decode("utf-8", "surrogatepass") for w, r in zip(words, runs, strict=True)]})


OUT = f"n_words long, runs {RUN}, best struct<start:long,length:long,period:long>, text string"


def periodic_runs(docs: DataFrame, least: int = 24, exponent: int = 3, unit: int = 1 << 31) -> DataFrame:
    """doc_id, n_words, runs, best and text of each row of docs (columns doc_id and text; others are ignored).

    runs: array of (start, length, period) by start, then period, words counting from 0: stretches of consecutive
    words with smallest period `period` and max(least, exponent * period) words or more that no neighbouring word
    extends. best: the one of the greatest length / period, then smallest start, then period; null without runs.
    text: the words that no run holds after its first period, joined by one space.

    exponent is 3 or more. A null text has no words, an empty result text and no runs. Rows of a null or repeated
    doc_id, and repeated rows, are rows like others. unit: comparisons of a text in one task; a longer text's shifts
    are cut into ranges, each with the word numbers of the text, so what a task holds is bounded by one text. An
    empty table gives an empty result."""
    if exponent < 3 or least < 1:
        raise ValueError("exponent must be 3 or more, least 1 or more")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # A text of n words has 2n - 1 bytes or more, and a scan of n words compares n * n / exponent at most.
    bytes_whole = 2 * int((unit * exponent) ** 0.5)
    long = F.coalesce(F.octet_length("text") > bytes_whole, F.lit(False))

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [_words(t) for t in batch["text"].tolist()]
            ids = [word_ids(w) for w in words]
            found = scan(ids, 1, max((last_lag(len(w), least, exponent) for w in words), default=0), least, exponent)
            yield _frame(batch, words, [sorted_runs(f) for f in found], ["doc_id"])

    def ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for h1, h2, text in zip(batch["h1"], batch["h2"], batch["text"], strict=True):
                ids = word_ids(_words(text))
                last, step = last_lag(len(ids), least, exponent), max(1, unit // max(len(ids), 1))
                for at in range(1, last + 1, step):
                    yield pd.DataFrame({"h1": [h1], "h2": [h2], "first": [at], "last": [min(last, at + step - 1)], "ids": [ids.tobytes()]})

    def scanned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for h1, h2, first, last, ids in batch[["h1", "h2", "first", "last", "ids"]].itertuples(index=False):
                runs = sorted_runs(scan([np.frombuffer(ids, np.int32)], int(first), int(last), least, exponent)[0])
                yield pd.DataFrame({"h1": h1, "h2": h2, "start": [r[0] for r in runs], "length": [r[1] for r in runs], "period": [r[2] for r in runs]})

    def finished(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [_words(t) for t in batch["text"].tolist()]
            runs = [[] if r is None else sorted(((x["start"], x["length"], x["period"]) for x in r), key=lambda x: (x[0], x[2])) for r in batch["found"]]
            yield _frame(batch, words, runs, ["doc_id"])

    out = in_slices(rows.filter(~long), whole, f"doc_id long, {OUT}")
    longer = stored(rows.filter(long).select("doc_id", "text", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(7), "text").alias("h2")))
    once = longer.dropDuplicates(["h1", "h2"])
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = in_slices(once, ranges, "h1 long, h2 long, first int, last int, ids binary").repartition(n, "h1", "first")
    runs = in_slices(units, scanned, "h1 long, h2 long, start long, length long, period long")
    by_text = runs.groupBy("h1", "h2", "start", "length").agg(F.min("period").alias("period")).groupBy("h1", "h2").agg(F.collect_list(F.struct("start", "length", "period")).alias("found"))
    return out.unionByName(in_slices(longer.join(by_text, ["h1", "h2"], "left"), finished, f"doc_id long, {OUT}"))


def planted(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) with the words of those whose h = crc32(doc_id as text) ends in 0 made periodic: with
    g = h // 10, from word a = g % n on they repeat the p words there, p = 1 + (n - a) // (3 + g % 8)."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = F.pmod(g, n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        tail = F.slice(F.flatten(F.array_repeat(F.slice(w, a + 1, p), F.ceil((n - a) / p).cast("int"))), 1, n - a)
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, 1, a), tail), " "))

    # A lambda's variable is its words once; as a column Catalyst would put their pattern in place of each use.
    words = F.array(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), 0))
    made = F.when((h % 10 == 0) & F.col("text").isNotNull(), F.transform(words, repeated)[0])
    return docs.select("doc_id", F.coalesce(made, "text").alias("text"))


def run_digest(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256 of periodic_runs()."""
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.floor(F.expr("1000 * best.length div best.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"))

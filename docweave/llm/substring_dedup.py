"""Substring dedup with a count-min prefilter.

Every window of consecutive words has an anchor: the part of it with the smallest
hash. Equal windows have equal anchors, at different places if the windows are, so a
window is repeated only if its anchor is. A first pass counts anchors in a count-min
sketch for each partition; merged, they overestimate. A second pass takes the windows
whose anchor is estimated to be repeated, and groups just those by their words.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import _stream, bit_words, gram_hashes, in_bits, in_slices, mix, runs, stored, word_hashes

ANCHOR = 8
#: The sketch has two rows of cells; a row has 8 cells for each anchor expected, within these powers of two.
LEAST_LOG, MOST_LOG = 16, 29
#: Cells that are merged together.
PIECE_LOG = 21
#: Copies of whole documents are left out of the second pass if they are no more than this, 8 bytes each.
MOST_COPIES = 2_000_000
_ROW_SHIFT = (2, 33)  # bits of an anchor's hash that pick its cell in each row


def _cells(anchors: np.ndarray, row: int, log: int) -> np.ndarray:
    return (mix(anchors + np.uint64(_ROW_SHIFT[row])) >> np.uint64(64 - log)).astype(np.uint32)


def _anchors(words: np.ndarray, at: np.ndarray, window: int):
    """(window starts, anchors' places, anchors' hashes by place) in the words of a run of texts."""
    grams = gram_hashes(words, ANCHOR)
    lengths = np.diff(at)
    n = np.maximum(lengths - window + 1, 0)
    starts = np.repeat(at[:-1] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    if not len(starts):
        return starts, starts, grams
    low = np.lib.stride_tricks.sliding_window_view(grams, window - ANCHOR + 1).argmin(1)
    return starts, starts + low[starts], grams


def _window_hashes(words: np.ndarray, starts: np.ndarray, window: int) -> list[np.ndarray]:
    """Two 64-bit hashes of the windows at starts."""
    out = []
    for seed in (3, 4):
        part = next(p for p in (5, 4, 3, 2, 1) if window % p == 0)
        grams = gram_hashes(words, part, seed)
        total = np.zeros(len(starts), np.uint64)
        for k, factor in enumerate(_stream(window // part, seed << 40) | np.uint64(1)):
            total += grams[starts + k * part] * factor
        out.append(mix(total))
    return out


def _pass_one(docs: DataFrame, window: int, log: int) -> DataFrame:
    """Rows of documents (doc_id, n_words, sha, crc) and of sketches (piece, cells): a task's
    cells of one piece, twice the cell plus 1 if it counted it more than once."""

    def rows(batches):
        seen: list[list[np.ndarray]] = [[], []]
        for batch in batches:
            n_words, sha, crc = [], [], []
            for _, _, part in runs(batch["text"].tolist()):
                words, at = word_hashes(part, lower=False)
                _, places, grams = _anchors(words, at, window)
                own = grams[np.unique(places)]
                for row in (0, 1):
                    cell, n = np.unique(_cells(own, row, log), return_counts=True)
                    seen[row].append(cell.astype(np.uint64) * 2 + (n > 1))
                n_words.extend(np.diff(at).tolist())
                sha.extend(hashlib.sha256(b" ".join(t.split())).hexdigest() for t in part)
                crc.extend(map(zlib.crc32, part))
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "n_words": n_words, "sha": sha, "crc": crc, "piece": None, "cells": None})
        pack = zstandard.ZstdCompressor(level=1).compress
        for row in (0, 1):
            every = np.sort(np.concatenate([np.empty(0, np.uint64), *seen[row]]))
            if not len(every):
                continue
            cell = every >> np.uint64(1)
            first = np.flatnonzero(np.diff(cell, prepend=np.uint64(1 << 62)))
            many = (np.diff(first, append=len(cell)) > 1) | (np.maximum.reduceat(every, first) & np.uint64(1)).astype(bool)
            coded = cell[first] * np.uint64(2) + many.astype(np.uint64)
            piece = (coded >> np.uint64(PIECE_LOG + 1)).astype(np.int64)
            cut = np.flatnonzero(np.diff(piece, prepend=-1))
            for a, b in zip(cut, [*cut[1:], len(coded)], strict=True):
                steps = np.diff((coded[a:b] & np.uint64((2 << PIECE_LOG) - 1)).astype(np.uint32), prepend=np.uint32(0))
                yield pd.DataFrame({"doc_id": [None], "n_words": [None], "sha": [None], "crc": [None], "piece": [int(piece[a]) * 2 + row], "cells": [pack(steps.tobytes())]})

    return in_slices(docs.select("doc_id", "text"), rows, "doc_id long, n_words long, sha string, crc long, piece int, cells binary")


def _repeated(pieces: DataFrame, log: int) -> np.ndarray:
    """The merged sketch: for each row, a bit for each cell that counts two or more;
    2 * 2**log bits, MOST_LOG bounds them."""
    size = 1 << min(PIECE_LOG, log)

    def merge(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, cells in zip(batch["piece"], batch["cells"], strict=True):
                coded = np.cumsum(np.frombuffer(unpack(cells), np.uint32), dtype=np.uint32)
                own = sums.setdefault(piece, np.zeros(size, np.uint8))
                own[coded >> 1] = np.minimum(own[coded >> 1] + 1 + (coded & 1), 2)
        for piece, own in sums.items():
            yield pd.DataFrame({"piece": [piece], "bits": [np.packbits(own > 1, bitorder="little").tobytes()]})

    out = np.zeros((2, (1 << log) // 8), np.uint8)
    n = max(8, (2 << log) // (size * 4))
    for piece, bits in pieces.repartition(n, "piece").mapInPandas(merge, "piece int, bits binary").toLocalIterator():
        own = np.frombuffer(bits, np.uint8)
        out[piece % 2, piece // 2 * (size // 8) : piece // 2 * (size // 8) + len(own)] = own
    return out


def _pass_two(docs: DataFrame, window: int, log: int, bits: np.ndarray, copies: np.ndarray) -> DataFrame:
    """(h1, h2, doc, at, run): windows estimated to be repeated, the earliest of each
    batch only, run 0; and with run > 0 as many windows from `at` on that an earlier one
    of the same batch equals. at: start * 2**32 + crc32 of the text."""
    spark = docs.sparkSession
    bits, copies = spark.sparkContext.broadcast(bits), spark.sparkContext.broadcast(copies)

    def rows(batches):
        for batch in batches:
            texts, ids = batch["text"].tolist(), batch["doc"].to_numpy(np.int64)
            if len(copies.value):
                i = np.minimum(np.searchsorted(copies.value, ids), len(copies.value) - 1)
                own = np.flatnonzero(copies.value[i] != ids)
                texts, ids = [texts[k] for k in own], ids[own]
            h1, h2, doc, start, crc = [], [], [], [], []
            for low, high, part in runs(texts):
                words, at = word_hashes(part, lower=False)
                starts, places, grams = _anchors(words, at, window)
                if not len(starts):
                    continue
                ok = np.ones(len(starts), bool)
                for row in (0, 1):
                    cell = _cells(grams[places], row, log)
                    ok &= (bits.value[row][cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1
                starts = starts[ok]
                of = np.searchsorted(at, starts, "right") - 1
                a, b = _window_hashes(words, starts, window)
                h1.append(a), h2.append(b), doc.append(ids[low:high][of]), start.append(starts - at[of])
                crc.append(np.array([zlib.crc32(t) for t in part], np.int64)[of])
            if not h1:
                continue
            h1, h2, doc, start, crc = (np.concatenate(x) for x in (h1, h2, doc, start, crc))
            order = np.lexsort((start, doc, h2, h1))
            h1, h2, doc, start, crc = (x[order] for x in (h1, h2, doc, start, crc))
            new = np.ones(len(h1), bool)
            new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            group = np.cumsum(new) - 1
            head = np.flatnonzero(new)[group] if len(h1) else group
            first = (doc == doc[head]) & (start == start[head])
            at = (start << 32) + crc
            yield pd.DataFrame({"h1": h1[first].view(np.int64), "h2": h2[first].view(np.int64), "doc": doc[first], "at": at[first], "run": np.zeros(int(first.sum()), np.int32)})
            doc, start, crc = doc[~first], start[~first], crc[~first]
            order = np.lexsort((start, crc, doc))
            doc, start, crc = doc[order], start[order], crc[order]
            cut = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(crc, prepend=-1) != 0) | (np.diff(start, prepend=-9) > 1))
            if len(cut):
                last = np.append(cut[1:], len(start)) - 1
                yield pd.DataFrame({"h1": None, "h2": None, "doc": doc[cut], "at": (start[cut] << 32) + crc[cut], "run": (start[last] - start[cut] + 1).astype(np.int32)})

    return in_slices(docs.select("doc", "text"), rows, "h1 long, h2 long, doc long, at long, run int")


def remove_repeats(docs: DataFrame, window: int = 20) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept (the text that is left, words
    joined by one space; null where nothing was removed) of every row of docs (columns
    doc_id and text; others are ignored).

    A word is removed when a window of `window` words that covers it also starts
    earlier: at a smaller doc_id, or in the same document before. Windows are judged on
    the input. Windows are equal by 128 bits of hash of their words. Null texts have no words. A null doc_id counts as larger than all.
    Rows that share a doc_id count as one document's in that order: windows at the same
    start are neither earlier. An empty table gives an empty result.

    Beyond the largest sketch (2**MOST_LOG cells a row) estimates grow and the second
    pass groups more windows; what is removed does not depend on it."""
    if window < ANCHOR + 1:
        raise ValueError(f"window must be over {ANCHOR} words")
    ids = docs.select(F.col("doc_id").cast("long"), "text")
    n_bytes = ids.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    expected = n_bytes / 6.5 * 2 / (window - ANCHOR + 2)
    log = min(MOST_LOG, max(LEAST_LOG, int(np.ceil(np.log2(max(8 * expected, 1))))))
    both = stored(_pass_one(ids, window, log))
    plain = both.filter("piece is null").select("doc_id", "n_words", "sha", "crc")
    bits = _repeated(both.filter("piece is not null").select("piece", "cells"), log)

    key = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    first = plain.filter(F.col("n_words") >= window).groupBy("sha").agg(F.min(key).alias("first"), F.count("*").alias("n")).filter("n > 1")
    # doc_ids all of whose rows are later copies: their windows are nobody's earliest
    marked = plain.withColumn("doc", key).join(first, "sha", "left").withColumn("copy", F.coalesce(F.col("doc") > F.col("first"), F.lit(False)))
    copies = marked.groupBy("doc").agg(F.min("copy").alias("copy")).filter("copy").select("doc")
    n_copies = copies.count()
    out_of = np.empty(0, np.int64)
    if n_copies <= MOST_COPIES:
        out_of = np.sort(copies.toPandas()["doc"].to_numpy(np.int64))

    found = stored(_pass_two(ids.withColumn("doc", key), window, log, bits, out_of))
    earliest = Window.partitionBy("h1", "h2").orderBy("doc", F.shiftright("at", 32))
    later = found.filter("run = 0").withColumn("rank", F.rank().over(earliest)).filter("rank > 1").select("doc", "at", F.lit(1).alias("run"))
    later = later.unionByName(found.filter("run > 0").select("doc", "at", "run"))
    hit = stored(later.groupBy("doc", (F.col("at").bitwiseAND(0xFFFFFFFF)).alias("crc")).agg(
        F.collect_list(F.struct(F.shiftright("at", 32).cast("int").alias("start"), "run")).alias("starts")))

    def cut(batches):
        for batch in batches:
            out = []
            for doc_id, text, starts in zip(batch["doc_id"], batch["text"], batch["starts"], strict=True):
                words = text.encode("utf-8", "surrogatepass").split()
                edge = np.zeros(len(words) + 1, np.int32)
                for s in starts:
                    edge[s["start"]] += 1
                    edge[s["start"] + s["run"] - 1 + window] -= 1
                gone = np.cumsum(edge[:-1]) > 0
                left = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])
                out.append((doc_id, len(words), int(gone.sum()), hashlib.sha256(left).hexdigest(), left.decode("utf-8", "surrogatepass")))
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]).astype({"doc_id": "Int64"})

    texts = in_bits(ids.withColumn("doc", key), "doc", bit_words(hit, "doc", 24))
    changed = texts.withColumn("crc", F.crc32("text")).join(hit, ["doc", "crc"]).select("doc_id", "text", "starts")
    changed = in_slices(changed, cut, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
    empty = hashlib.sha256(b"").hexdigest()
    if not len(out_of):
        copies = copies.filter("false")
    copied = marked.join(copies, "doc", "left_semi")
    same = marked.join(copies, "doc", "left_anti").join(hit.select("doc", "crc"), ["doc", "crc"], "left_anti")
    return (
        same.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256"), F.lit(None).cast("string").alias("kept"))
        .unionByName(copied.select("doc_id", "n_words", F.col("n_words").alias("n_removed"), F.lit(empty).alias("kept_sha256"), F.lit("").alias("kept")))
        .unionByName(changed)
    )

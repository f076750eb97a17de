"""Best-fit packing of token sequences: bounded-space online best-fit.

Every task packs the pieces of its own documents as they come. A fixed number of bins
is open; a bitset has a bit for each free space that an open bin has, so the bin that
a piece fills best is the lowest bit at or above its length. When all are open, the
fullest closes first. What a task leaves open at its end is packed once more by few tasks,
so that many tasks strand no more space than few.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_pairs import byte_symbols
from .shared import in_slices, stored

#: Words of a generation whose ids a task remembers (it keeps the one before too), and the
#: longest of them in characters: text without spaces is long words that seldom come again.
MOST_WORDS, LONGEST = 300_000, 64
#: Cells that tell words seen before, by hash.
SEEN = 1 << 21
#: The fill up to which a sequence is placed once more, and how many such sequences one task takes.
LEFT, GATHERED = 0.9, 20_000
_ODD_SPACE = re.compile("[\x1c-\x1f]")  # white space to str.split(), not to the tokenizers library
_SPACES = re.compile("[\t-\r ]+")
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
#: The split of words that word_bpe files name, for lower-case plain words.
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


class BestFit:
    """place(length) gives (bin number, offset)."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.most = capacity, open_bins
        self.by_free: dict[int, list[int]] = defaultdict(list)
        self.free = 0  # bit f: a bin with f free is open
        self.open = self.opened = 0

    def _take(self, f: int) -> int:
        bins = self.by_free[f]
        number = bins.pop()
        if not bins:
            del self.by_free[f]
            self.free &= ~(1 << f)
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        fits = self.free >> length
        if fits:
            f = length + (fits & -fits).bit_length() - 1
            number = self._take(f)
        else:
            if self.open == self.most:
                self._take((self.free & -self.free).bit_length() - 1)
            f, number = self.capacity, self.opened
            self.opened += 1
        left = f - length
        if left:
            self.by_free[left].append(number)
            self.free |= 1 << left
            self.open += 1
        return number, self.capacity - f


class WordIds(dict):
    """Ids of words as little-endian unsigned 32-bit bytes. White space neither joins nor
    enters this vocabulary's tokens, so a text's ids are those of its words. A word is
    remembered when it comes the second time. When MOST_WORDS are held a new generation
    begins, which takes over from the old one what it meets again.

    A word of printable ASCII and Latin-1 letters has the ids of its lower-case pieces, which
    are fewer than words: letters, single digits, other characters and the endings that the
    file's split names. Pieces go to the file's merges alone; any other word takes the whole way."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.symbol = dict(enumerate(byte_symbols()))
        self.old: dict[str, bytes] = {}
        self.seen = bytearray(SEEN)
        self.pieces: dict[str, bytes] = {}

    def _whole(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = array("I", [t.id for t in self.merge(piece.encode().decode("latin-1").translate(self.symbol))]).tobytes()
            if len(piece) <= LONGEST:
                self.pieces[piece] = ids
        return ids

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            plain = _PLAIN.fullmatch(word) and "<|" not in word
            ids = b"".join(map(self._piece, _PIECES.findall(word.lower()))) if plain else self._whole(word)
        if len(word) <= LONGEST:
            at = hash(word) & (SEEN - 1)
            if self.seen[at]:
                self[word] = ids
            self.seen[at] = 1
        return ids

    def forget(self) -> None:
        self.clear(), self.pieces.clear()
        self.old, self.seen = {}, bytearray(SEEN)

    def of_texts(self, texts: list[str | None]) -> list[bytes]:
        if len(self) > MOST_WORDS:
            self.old, self.seen = dict(self), bytearray(SEEN)
            self.clear()
        if len(self.pieces) > MOST_WORDS:
            self.pieces.clear()
        ids = self.__getitem__
        return [b"" if not t else b"".join(map(ids, _SPACES.split(t) if _ODD_SPACE.search(t) else t.split())) for t in texts]


_ids: dict[str, WordIds] = {}


def pack(docs: DataFrame, vocabulary: str, length: int = 4096, end_id: int = 1, open_bins: int = 512) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of
    every row of docs (columns doc_id and text; others are ignored).

    vocabulary: path of a tokenizers .json file on every executor, whose tokens white
    space separates. A document is the ids of its text, then end_id; a null or empty
    text is end_id alone. Only documents over `length` are cut, into pieces of
    `length`; whole pieces are sequences of their own. Each task keeps `open_bins` bins and
    places pieces in the order in which they come; equal lengths go to the bin opened last.
    Repeated rows are packed each, a null doc_id is kept as null; an empty table gives an
    empty result. The rows are written to the shared folder once, so sequence numbers are
    settled before they are read."""
    capacity, kind = length, docs.schema["doc_id"].dataType.simpleString()

    def rows(frames):
        ids = _ids.get(vocabulary) or _ids.setdefault(vocabulary, WordIds(vocabulary))
        first = TaskContext.get().partitionId() << 32
        bins, tail, step = BestFit(capacity, open_bins), np.array([end_id], "<u4").tobytes(), 4 * capacity
        for frame in frames:
            of, cuts = [], []
            for i, own in enumerate(ids.of_texts(frame["text"].tolist())):
                own += tail
                if len(own) <= step:
                    of.append(i), cuts.append(own)
                else:
                    cuts += [own[b : b + step] for b in range(0, len(own), step)]
                    of += [i] * (len(cuts) - len(of))
            of, n = np.array(of, np.int64), [len(c) // 4 for c in cuts]
            placed = np.array([bins.place(m) for m in n], np.int64).reshape(-1, 2)
            piece = np.arange(len(of)) - np.searchsorted(of, of)
            yield pd.DataFrame({
                "doc_id": frame["doc_id"].take(of).array, "piece": piece, "start": piece * capacity, "length": n,
                "ids_crc32": list(map(zlib.crc32, cuts)), "sequence_id": placed[:, 0] + first, "offset": placed[:, 1],
            })
        ids.forget()

    packed = stored(in_slices(docs.select("doc_id", "text"), rows, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"))
    moved = _repacked(packed, capacity, open_bins)
    out = packed.join(moved, ["sequence_id", "offset"], "left")
    return out.select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("into", "sequence_id").alias("sequence_id"), F.when(F.col("into").isNotNull(), F.col("at")).otherwise(F.col("offset")).alias("offset"),
    )


def _repacked(packed: DataFrame, capacity: int, open_bins: int) -> DataFrame:
    """(sequence_id, offset, into, at): new places of the pieces of sequences filled to LEFT at most,
    which are what tasks left behind at their end (best-fit fills the others). They are placed again,
    longest first, a task taking the sequences of so many tasks as give it GATHERED. New sequences
    have negative numbers."""
    left = packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter(F.col("n") <= LEFT * capacity).select("sequence_id")
    tasks = max(1, left.count() // GATHERED)

    def rows(frames):
        bins, first = BestFit(capacity, open_bins), -1 - (TaskContext.get().partitionId() << 32)
        for frame in frames:
            placed = np.array([bins.place(n) for n in frame["length"].tolist()], np.int64).reshape(-1, 2)
            yield pd.DataFrame({"sequence_id": frame["sequence_id"], "offset": frame["offset"], "into": first - placed[:, 0], "at": placed[:, 1]})

    pieces = packed.select("sequence_id", "offset", "length").join(left, "sequence_id", "left_semi")
    dealt = pieces.repartition(tasks, "sequence_id").sortWithinPartitions(F.col("length").desc(), "sequence_id", "offset")
    return in_slices(dealt, rows, "sequence_id long, offset long, into long, at long")


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, n_pieces, n_tokens and the pieces in order, of pack()'s rows; a
    sequence holds at most as many pieces as it has tokens. Null doc_ids stay null; an
    empty table gives an empty result."""
    return pieces.groupBy("sequence_id").agg(
        F.count("*").alias("n_pieces"), F.sum("length").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "length"))).alias("pieces"),
    )

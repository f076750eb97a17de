"""Token counts by byte-pair merging with a heap and a linked list.

A word's symbols form a doubly linked list; a heap holds the adjacent pairs by rank.
The lowest-rank pair is popped and merged until none is left; the number of tokens is
the number of symbols minus the number of merges. No token gets an identifier.
"""

from __future__ import annotations

import heapq
import json

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import in_slices

#: The split of text into words that byte-level BPE files with "use_regex" mean.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces of a generation whose counts a worker remembers (it keeps the one before too), and the
#: longest of them in characters: text without spaces is long pieces that seldom come again.
MOST_WORDS, LONGEST = 300_000, 64
#: The same as regex reads it: that module counts \x1c-\x1f as white space, the tokenizers library does not.
_SPACE, _OTHER = r"[^\S\x1c-\x1f]", r"[\S\x1c-\x1f]"
_SPLIT_HERE = (
    SPLIT.replace(r"[^\s\p{L}\p{N}]", rf"(?:(?!{_SPACE})[^\p{{L}}\p{{N}}])").replace(r"(?!\S)", f"(?!{_OTHER})").replace(r"\s", _SPACE)
)
#: Pairs that show a run of white space with a space inside or at its end.
_RUNS = tuple(chr(c) + " " for c in range(0x3001) if regex.match(_SPACE, chr(c)))
#: A run of white space up to its last space, if that begins a word; else words and runs whole.
_PIECES = regex.compile(rf" ?{_OTHER}+|{_SPACE}+(?= {_OTHER})|{_SPACE}+{_OTHER}*")


def byte_symbols() -> list[str]:
    """The printable character that byte-level BPE files write for each byte: printable
    Latin-1 ones stand for themselves, the others for U+0100 onwards in order."""
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = [], 0x100
    for b in range(256):
        out.append(chr(b if b in kept else extra))
        extra += b not in kept
    return out


class PairCounter(dict):
    """Pieces to token counts, filled as they are met. When MOST_WORDS are held a new
    generation begins, which takes over from the old one what it meets again."""

    def __init__(self, path: str):
        self.old: dict[str, int] = {}
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.symbol = dict(enumerate(byte_symbols()))
        self.split = regex.compile(_SPLIT_HERE)
        special = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None

    def merged(self, symbols: list[str]) -> int:
        """How many tokens the symbols of one word become."""
        n = len(symbols)
        rank, heap = self.rank, []
        after = [*range(1, n), -1]
        before = [*range(-1, n - 1)]
        for i in range(n - 1):
            r = rank.get((symbols[i], symbols[i + 1]))
            if r is not None:
                heap.append((r, i, symbols[i], symbols[i + 1]))
        heapq.heapify(heap)
        count = n
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if j < 0 or symbols[i] != a or symbols[j] != b:  # one of them has been merged since
                continue
            symbols[i], symbols[j] = a + b, ""
            k = after[i] = after[j]
            count -= 1
            if k >= 0:
                before[k] = i
                r = rank.get((symbols[i], symbols[k]))
                if r is not None:
                    heapq.heappush(heap, (r, i, symbols[i], symbols[k]))
            h = before[i]
            if h >= 0:
                r = rank.get((symbols[h], symbols[i]))
                if r is not None:
                    heapq.heappush(heap, (r, h, symbols[h], symbols[i]))
        return count

    def of_piece(self, piece: str) -> int:
        return sum(self.merged(list(word.encode("utf-8", "replace").decode("latin-1").translate(self.symbol))) for word in self.split.findall(piece))

    def __missing__(self, piece: str) -> int:
        """Of a piece of text that no word crosses into or out of; special strings in it count one."""
        n = self.old.get(piece)
        if n is not None:
            pass
        elif self.special and "<|" in piece:
            parts = self.special.split(piece)
            n = len(parts) - 1 + sum(self.of_piece(p) for p in parts if p)
        else:
            n = self.of_piece(piece)
        if len(piece) <= LONGEST:
            if len(self) >= MOST_WORDS:
                self.old = dict(self)
                self.clear()
            self[piece] = n
        return n

    def of_text(self, text: str) -> int:
        """Words begin at a space that follows no white space, so the text is cut there. A run
        of white space is one word up to its last character, whatever it is made of."""
        if not text:
            return 0
        if any(map(text.__contains__, _RUNS)):
            parts = self.special.split(text) if self.special and "<|" in text else [text]
            return len(parts) - 1 + sum(self[p] for part in parts for p in _PIECES.findall(part))
        first, *rest = text.split(" ")
        return (self[first] if first else 0) + sum(map(self.__getitem__, [" " + w for w in rest]))


_counters: dict[str, PairCounter] = {}


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of docs (columns doc_id and
    text; others are ignored).

    vocabulary: path of a byte-level BPE .json file, present on every executor. Special
    strings in a text count as one token each, as that library does by default. A null
    text counts as empty: 0 bytes and tokens. Repeated rows are all returned; an empty
    table gives an empty result. Texts are read whole; a worker remembers at most
    2 * MOST_WORDS counts of pieces up to LONGEST characters."""

    def rows(batches):
        counter = _counters.setdefault(vocabulary, None) or PairCounter(vocabulary)
        _counters[vocabulary] = counter
        for batch in batches:
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "n_bytes": batch["n_bytes"],
                "n_tokens": [counter.of_text(t) if t else 0 for t in batch["text"]],
            })

    kind = docs.schema["doc_id"].dataType.simpleString()
    sized = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    counted = in_slices(sized, rows, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

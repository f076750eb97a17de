"""Language ID: script ranges narrow the candidates, then Viterbi over per-word scores
with a switching penalty labels the spans of a text.

The model holds log-probabilities of letter trigrams by language and which scripts a
language uses. It is learned from at most `per_language` labelled documents of each
language, taken by a hash of their doc_id; prediction reads texts alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import fresh, in_slices, runs, stored

LOG_BUCKETS = 16
#: A script for each UTF-8 lead byte. 0 none, 1 Latin (ASCII letters and
#: U+0080-024F), 2 IPA and marks, 3 Greek, 4 Cyrillic and Armenian, 5 Hebrew, 6 Arabic,
#: 7 South and South-East Asian, 8 U+1000-1FFF, 9 kana and CJK marks, 10 Han, 11 Hangul, 12 beyond.
SCRIPT_RANGES = (
    (0x41, 0x5A, 1), (0x61, 0x7A, 1), (0xC2, 0xC9, 1), (0xCA, 0xCC, 2), (0xCD, 0xCF, 3), (0xD0, 0xD5, 4), (0xD6, 0xD7, 5),
    (0xD8, 0xDF, 6), (0xE0, 0xE0, 7), (0xE1, 0xE1, 8), (0xE3, 0xE3, 9), (0xE4, 0xE9, 10), (0xEA, 0xED, 11), (0xF0, 0xF4, 12),
)
SCRIPTS = 13
_SCRIPT = np.zeros(256, np.uint8)
for _low, _high, _script in SCRIPT_RANGES:
    _SCRIPT[_low : _high + 1] = _script
#: Letters as features see them: lower-case ASCII letters, bytes from 0x80 on, all else 0.
_CODE = np.zeros(256, np.uint32)
_CODE[0x61:0x7B] = _CODE[0x41:0x5B] = np.arange(0x61, 0x7B)
_CODE[0x80:] = np.arange(0x80, 0x100)
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[0x41:0x5B] = _ASCII_LETTER[0x61:0x7B] = True
_LETTER = regex.compile(r"\p{L}")
#: A share of a language's letters from which it uses a script; what a word costs a language that does not.
USED, FOREIGN = 0.001, 30.0
#: Trigrams overlap, so their log-probabilities count half.
WEIGHT = 0.5
#: Words that are labelled together: bounds what a worker holds, whatever comes in a batch.
_TOGETHER = 400_000


@dataclass
class Model:
    """languages; scores: bucket x language, about each bucket's mean; common: those means
    over even odds for all buckets; uses: script x language."""

    languages: list[str]
    scores: np.ndarray
    common: np.ndarray
    uses: np.ndarray


def _features(texts: list[bytes]):
    """Of all words of the texts, one text after the other: trigram buckets of all
    letters, where each word's letters start and end in them, each text's first word,
    and each word's script."""
    raw = np.frombuffer(b"\n".join([b"", *texts, b""]), np.uint8)
    code = _CODE[raw]
    at = np.flatnonzero(code)
    tri = code[at - 1] * np.uint32(0x9E3779B1) + code[at] * np.uint32(0x85EBCA77) + code[at + 1] * np.uint32(0xC2B2AE3D)
    tri ^= tri >> np.uint32(15)
    tri *= np.uint32(0x2C1B3C6D)
    bucket = tri >> np.uint32(32 - LOG_BUCKETS)
    first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
    text_at = np.cumsum([1, *(len(t) + 1 for t in texts)])
    script = np.maximum.reduceat(_SCRIPT[raw[at]], first) if len(first) else np.empty(0, np.uint8)
    return bucket, first, np.append(first[1:], len(at)), np.searchsorted(at[first], text_at), script


def learn(docs: DataFrame, per_language: int = 4000) -> Model:
    """A model of the languages in docs (columns doc_id, text, lang); rows of null
    doc_id, text or lang are left out. A language of more documents than
    `per_language` is learned from a share of them by a hash of doc_id, spread over
    all tasks. What comes to the driver is a count for each language and bucket."""
    known = docs.filter("doc_id is not null and text is not null and lang is not null").select("doc_id", "text", "lang")
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # a row for each language
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros((1 << LOG_BUCKETS, 0), np.float32), np.zeros(1 << LOG_BUCKETS, np.float32), np.zeros((SCRIPTS, 0), bool))
    share = F.create_map(*(x for k in languages for x in (F.lit(k), F.lit(min(1.0, per_language / counts[k])))))[F.col("lang")]
    sample = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20))
    width = (1 << LOG_BUCKETS) + SCRIPTS

    def count(batches):
        sums = np.zeros((len(languages), width), np.int64)
        nth = {k: i for i, k in enumerate(languages)}
        for batch in batches:
            for lang, part in batch.groupby("lang"):
                for _, _, texts in runs(part["text"].tolist()):
                    bucket, first, end, _, script = _features(texts)
                    sums[nth[lang], : 1 << LOG_BUCKETS] += np.bincount(bucket, minlength=1 << LOG_BUCKETS)
                    sums[nth[lang], 1 << LOG_BUCKETS :] += np.bincount(script, end - first, SCRIPTS).astype(np.int64)
        lang, bucket = np.nonzero(sums)
        yield pd.DataFrame({"lang": lang.astype(np.int32), "bucket": bucket.astype(np.int32), "n": sums[lang, bucket]})

    got = in_slices(sample, count, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    sums = np.zeros((width, len(languages)))
    sums[got["bucket"], got["lang"]] = got["n"]
    grams, scripts = sums[: 1 << LOG_BUCKETS], sums[1 << LOG_BUCKETS :]
    scores = np.log((grams + 0.3) / (grams.sum(0) + 0.3 * (1 << LOG_BUCKETS)))
    mean = scores.mean(1, keepdims=True)
    common = (WEIGHT * (mean[:, 0] + np.log(1 << LOG_BUCKETS))).astype(np.float32)
    return Model(languages, (WEIGHT * (scores - mean)).astype(np.float32), common, scripts >= USED * np.maximum(scripts.sum(0), 1))


def _emissions(model: Model, texts: list[bytes]):
    """Scores (word x language), letters of each word, each text's first word, and what
    the model's `common` adds to a word's scores, alike for all languages."""
    bucket, first, end, word_at, script = _features(texts)
    out = np.add.reduceat(model.scores[bucket], first, axis=0) if len(first) else np.empty((0, len(model.languages)), np.float32)
    uses = model.uses[script]
    out -= FOREIGN * (~uses & uses.any(1, keepdims=True))
    common = np.add.reduceat(model.common[bucket], first) if len(first) else np.empty(0, np.float32)
    return out, (end - first).astype(np.int64), word_at, common


def viterbi(emissions: np.ndarray, first: np.ndarray, end: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of each word, of texts whose words are first[i]..end[i]: labels
    maximise the sum of emissions less `penalty` for each change. All texts take a step together."""
    order = np.argsort(first - end, kind="stable")
    start, length = first[order], (end - first)[order]
    kind = np.uint8 if emissions.shape[1] <= 256 else np.uint16  # of a label
    labels, cols = np.zeros(len(emissions), kind), np.ascontiguousarray(emissions.T)
    steps = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(steps), "left")  # texts longer than t
    score = np.zeros((cols.shape[0], len(order)), np.float64)
    best_of, stays = [], []
    for t in range(steps):
        n = active[t]
        s = score[:, :n]
        if t:
            best = s.max(0)
            best_of.append(s.argmax(0).astype(kind))
            floor = best - penalty
            stays.append(s >= floor)
            np.maximum(s, floor, out=s)
        s += cols[:, start[:n] + t]
    state = np.zeros(len(order), np.intp)
    for t in range(steps - 1, -1, -1):
        n = active[t]
        m = active[t + 1] if t + 1 < steps else 0
        state[m:n] = score[:, m:n].argmax(0)
        labels[start[:n] + t] = state[:n]
        if t:
            stay = stays[t - 1][state[:n], np.arange(n)]
            state[:n] = np.where(stay, state[:n], best_of[t - 1])
    return labels


def identify(docs: DataFrame, model: Model, penalty: float = 8.0, spans: bool = False, keep: tuple[str, ...] = ("doc_id",), fit: bool = False) -> DataFrame:
    """The columns `keep`, lang_pred, score, and spans and fit if asked for, of every row of docs
    (column text and those of keep; a kept column of one of those names is replaced).

    lang_pred is the language of most letters on the best path, `und` where the text is
    null or has no letter, or nothing was learned. score is those letters' share, times
    the softmax of the languages' total scores: 0 to 1, 0 for `und`. spans is an array
    of (lang, words), words being runs of letters. fit is the mean score of a letter on
    the best path, over letters at random (even odds for all buckets): above 0 where the
    labels' languages explain the text, however many they are, and 0 for `und`. Repeated rows are all returned; an
    empty table gives an empty result."""
    kinds = len(model.languages)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**LOG_BUCKETS floats a language

    def label(model: Model, waiting: list, pred: list, score: list, found: list, fits: list) -> None:
        emissions = np.concatenate([w[0] for w in waiting])
        letters = np.concatenate([w[1] for w in waiting])
        shift = np.cumsum([0, *(len(w[1]) for w in waiting)])
        first = np.concatenate([w[2][:-1] + s for w, s in zip(waiting, shift, strict=False)])
        end = np.concatenate([w[2][1:] + s for w, s in zip(waiting, shift, strict=False)])
        common = np.concatenate([w[3] for w in waiting])
        texts = [t for w in waiting for t in w[4]]
        labels = viterbi(emissions, first, end, penalty)
        tally, totals = np.zeros((len(first), kinds)), np.zeros((len(first), kinds))
        owner = np.repeat(np.arange(len(first)), end - first)
        np.add.at(tally, (owner, labels), letters)
        path = np.bincount(owner, emissions[np.arange(len(labels)), labels] + common, len(first)) / np.maximum(tally.sum(1), 1)
        full = np.flatnonzero(end > first)
        if len(full):
            totals[full] = np.add.reduceat(emissions, first[full], axis=0, dtype=np.float64)
        for i, text in enumerate(texts):
            raw = np.frombuffer(text, np.uint8)
            if not _ASCII_LETTER[raw].any() and not _LETTER.search(text.decode("utf-8", "replace")):
                pred.append("und"), score.append(0.0), found.append([]), fits.append(0.0)
                continue
            best = int(tally[i].argmax())
            share = tally[i, best] / max(tally[i].sum(), 1)
            odds = np.exp(np.minimum(totals[i] - totals[i, best], 50))
            pred.append(model.languages[best]), score.append(float(share / odds.sum())), fits.append(float(path[i]))
            if spans:
                own = labels[first[i] : end[i]]
                cut = np.flatnonzero(np.diff(own.astype(np.int64), prepend=-1))
                found.append([(model.languages[own[c]], int(n)) for c, n in zip(cut, np.diff(cut, append=len(own)), strict=True)])

    kind = "struct<lang_pred:string,score:double" + ",spans:array<struct<lang:string,words:bigint>>" * spans + ",fit:double" * fit + ">"

    @F.pandas_udf(kind)
    def labelled(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for texts in batches:
            pred, score, found, fits, waiting, words = [], [], [], [], [], 0
            for _, _, part in runs(texts.tolist()) if kinds else ():
                waiting.append((*_emissions(model, part), part))
                words += len(waiting[-1][1])
                if words >= _TOGETHER:
                    label(model, waiting, pred, score, found, fits)
                    waiting, words = [], 0
            if waiting:
                label(model, waiting, pred, score, found, fits)
            if not kinds:
                pred, score, found, fits = ["und"] * len(texts), [0.0] * len(texts), [[]] * len(texts), [0.0] * len(texts)
            out = pd.DataFrame({"lang_pred": pred, "score": score})
            if spans:
                out["spans"] = [[{"lang": k, "words": n} for k, n in f] for f in found]
            if fit:
                out["fit"] = fits
            yield out

    out = docs.select(*(c for c in keep), labelled("text").alias("_found"))
    more = ["lang_pred", "score", *["spans"] * spans, *["fit"] * fit]
    return out.select(*(c for c in keep if c not in more), *(F.col("_found")[c].alias(c) for c in more))


def held_out(doc_id):
    """Documents that no model of this module learns from: crc32 of the id as text is 1 modulo 3; null is not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def predict_languages(docs: DataFrame, per_language: int = 4000, penalty: float = 8.0) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of docs (columns doc_id, text and
    lang; others are ignored), from a model of its rows that are not held out. Null,
    empty and letterless texts are `und` with score 0; rows of null doc_id are not held out and not
    learned from. Repeated rows are all returned; ties go to the language first by name.
    An empty table gives an empty result."""
    model = learn(docs.filter(~held_out(F.col("doc_id"))), per_language)
    out = identify(docs, model, penalty)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, per_language: int = 4000, penalty: float = 8.0) -> DataFrame:
    """docs without the rows whose language is `und` (null, empty and letterless texts) and
    those that no learned languages explain better than letters at random; columns as in
    docs. A text may be of any number of languages, and very long ones are read whole. Rows
    of null doc_id and repeated rows are judged by their text alike; a table without any
    lang keeps nothing, an empty table gives an empty result."""
    model = learn(docs.filter(~held_out(F.col("doc_id"))), per_language)
    text = F.coalesce(F.col("text"), F.lit(""))
    known = {"hash": F.xxhash64(text), "crc": F.crc32(text), "bytes": F.octet_length(text)}
    judged = identify(docs.select("text", *(c.alias(k) for k, c in known.items())), model, penalty, keep=tuple(known), fit=True)
    names = fresh(docs, *(f"gone_{k}" for k in known))
    gone = stored(judged.filter((F.col("lang_pred") == "und") | (F.col("fit") <= 0)).select(*(F.col(k).alias(n) for k, n in zip(known, names, strict=True))).distinct())
    same = reduce(lambda a, b: a & b, (c == F.col(n) for c, n in zip(known.values(), names, strict=True)))
    return docs.join(gone, same, "left_anti")

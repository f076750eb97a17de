"""N-gram Jaccard join by a size-aware heavy-light join.

Documents become sets of hashed word shingles. Small sets are joined on all their
subsets of the one size that a similar pair of their sizes must share; large sets
by scanning inverted lists of their rarest shingles. The boundary is the size up to
which subsets cost no more rows than lists of the mean length.

No pair is lost, and no list is expanded into all its pairs:

* Lists use prefix filtering: with sets in one order of shingles, a pair of Jaccard
  t shares one of the first n - ceil(t * n) + 1 shingles of each set. The order is by
  how often a shingle occurs, counted exactly: those of one set come first and need no
  list, so a set of many shingles of its own has no lists at all, and a set's place in a
  list tells how much it can still share. Counted are SAMPLED of 256 hash classes of the
  shingles, more than a prefix needs; the others follow them in the order, and last come
  shingles that a merged counting sketch holds for very frequent. Only sets with too few
  counted shingles get to those.
* Equal sets are one node. In each round a list has one head, the node for which its shingle
  stands foremost (it has the least of its own, so the others of a group of near copies
  are likely linked with it), in the last round a node of the last component; and a node has one
  candidate, the head that it meets in most lists and was not held against before. Verified
  links are merged into components, and only lists of several components go on, so a
  group of near copies is settled by links in proportion to its size. What is left then is
  compared in pairs of different components. Sizes, places and signatures drop pairs that
  cannot link; pairs of long sets are held against finer signatures before sets travel.
"""

from __future__ import annotations

from itertools import combinations
from math import ceil, comb, isqrt

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import collect_garbage, components, fold, fresh, gram_hashes, in_slices, mix, runs, stored, word_hashes

#: Counters of the sketch that finds very frequent shingles, and how many travel in one row.
SKETCH_LOG, PIECE_LOG = 24, 16
#: Hash classes of 256 whose shingles are counted.
SAMPLED = 104
#: 64-bit words of a set's signature: each shingle flips one bit, so two signatures
#: differ in no more bits than the sets have elements that the other lacks.
SIGNATURE = 8
#: Short signatures of long sets have every bit at random. Sets over LONG_SET have one of
#: FINE words too, which is kept by node and meets distinct pairs only.
FINE, LONG_SET = 32, 256
#: No subsets are enumerated above this size, whatever lists cost: a set of it has 16 to 137 subsets, one of twice the size thousands.
MOST_SMALL = 16
#: As many document ids are broadcast at most, 8 bytes each; more are joined by a shuffle.
MOST_BROADCAST = 1_000_000
#: Least hashes that a task gives to estimate how many distinct shingles there are.
LEAST_HASHES = 1024
#: Sets whose entries a task remembers to have made, so that a group of copies makes them once a task.
MOST_SEEN = 100_000


def shingle_sets(texts: list[str | None], n: int):
    """The set of each text as a sorted array of 64-bit hashes; texts of fewer words
    have their whole word sequence as one shingle, texts without words an empty set."""
    for _, _, part in runs(texts):
        words, at = word_hashes(part, lower=True)
        grams = gram_hashes(words, n)
        for i in range(len(part)):
            own = at[i + 1] - at[i]
            if own >= n:
                yield np.unique(grams[at[i] : at[i + 1] - n + 1])
            elif own:
                yield gram_hashes(words[at[i] : at[i + 1]], own, seed=own)
            else:
                yield np.empty(0, np.uint64)


def signature(hashes: np.ndarray, words: int = SIGNATURE) -> np.ndarray:
    bits = np.bincount((hashes >> np.uint64(20)).astype(np.int64) % (64 * words), minlength=64 * words) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def least_shared(n: int, m: int, num: int, den: int) -> int:
    """The smallest intersection with which sets of n and m reach Jaccard num / den."""
    return -(-num * (n + m) // (num + den))


def subset_sizes(n: int, most: int, num: int, den: int) -> list[int]:
    """Sizes of the subsets that a set of n shares with similar sets of up to most."""
    return sorted({least_shared(n, m, num, den) for m in range(-(-num * n // den), min(n * den // num, most) + 1)})


def boundary(sizes: dict[int, int], list_length: float, num: int, den: int) -> int:
    """The largest set size for which subsets cost no more than inverted lists, for
    it and all smaller ones. A subset is one row; a list entry is a row and a scan
    of the list's length. sizes: how many sets have each size; sizes that do not
    occur cost nothing."""
    best = 0
    for n in range(1, MOST_SMALL + 1):
        subsets = sum(comb(n, c) for c in subset_sizes(n, n, num, den))
        lists = (n - ceil(num * n / den) + 1) * (1 + list_length)
        if sizes.get(n, 0) * subsets > sizes.get(n, 0) * lists:
            break
        best = n
    return best


def _sets_and_sketch(docs: DataFrame, n: int) -> DataFrame:
    """Rows (doc_id, digest, n_shingles, node, bits, fine) for documents, and rows (piece, counts) with
    each task's counters of all shingles and, at piece -1, its least hashes; one pass writes all."""
    blank = {"doc_id": None, "digest": None, "n_shingles": None, "node": None, "bits": None, "fine": None}

    def rows(frames):
        counts, least = np.zeros(1 << SKETCH_LOG, np.uint16), np.empty(0, np.uint64)
        for frame in frames:
            size, node, bits, fine, seen = [], [], [], [], []
            for hashes in shingle_sets(frame["text"].tolist(), n):
                size.append(len(hashes))
                node.append(fold(hashes))
                bits.append(signature(hashes))
                fine.append(signature(hashes, FINE) if len(hashes) > LONG_SET else None)
                seen.append(hashes)
                if len(seen) == 500:
                    least = _count(counts, seen, least)
                    seen = []
            least = _count(counts, seen, least)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "digest": frame["digest"], "n_shingles": size, "node": node, "bits": bits, "fine": fine, "piece": None, "counts": None})
        pack = zstandard.ZstdCompressor(level=1).compress
        yield pd.DataFrame({**blank, "piece": [-1], "counts": [least.tobytes()]})
        for piece in range(1 << (SKETCH_LOG - PIECE_LOG)):
            part = counts[piece << PIECE_LOG : (piece + 1) << PIECE_LOG]
            if part.any():
                yield pd.DataFrame({**blank, "piece": [piece], "counts": [pack(part.tobytes())]})

    return in_slices(docs.select(F.col("doc_id").cast("long"), "text", _digest().alias("digest")), rows, "doc_id long, digest long, n_shingles long, node long, bits array<long>, fine array<long>, piece int, counts binary")


def _count(counts: np.ndarray, sets: list[np.ndarray], least: np.ndarray) -> np.ndarray:
    """Counts the shingles of the sets; the least of all hashes so far."""
    if not sets:
        return least
    hashes = np.concatenate(sets)
    at, n = np.unique(hashes >> np.uint64(64 - SKETCH_LOG), return_counts=True)
    counts[at] = np.minimum(counts[at] + n, 65535)
    some = hashes if len(least) < LEAST_HASHES else hashes[hashes < least[-1]]
    return np.unique(np.concatenate([least, some]))[:LEAST_HASHES]


def _distinct(least: DataFrame) -> float:
    """About how many distinct shingles there are, from the least hashes of all tasks (3 % off)."""

    def each(batches):
        for batch in batches:
            yield pd.DataFrame({"h": np.concatenate([np.frombuffer(c, np.uint64) >> np.uint64(1) for c in batch["counts"]] or [np.empty(0, np.uint64)]).astype(np.int64)})

    got = least.select("counts").mapInPandas(each, "h long").distinct().orderBy("h").limit(LEAST_HASHES).collect()  # LEAST_HASHES rows
    return len(got) if len(got) < LEAST_HASHES else (LEAST_HASHES - 1) * 2.0**63 / max(got[-1].h, 1)


def _frequent(pieces: DataFrame, total: int) -> np.ndarray:
    """One bit for each counter of the merged sketch that stands out from the mean load:
    2**SKETCH_LOG bits whatever the input, eight a byte. A shingle of more than a few millionths of all
    entries is surely among them, so no list of a counted shingle is longer."""
    mean = total >> SKETCH_LOG
    limit = mean + 6 * isqrt(mean) + 24

    def merge(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, counts in zip(batch["piece"], batch["counts"], strict=True):
                own = np.frombuffer(unpack(counts), np.uint16)
                sums[piece] = sums.get(piece, 0) + own.astype(np.uint64)
        for piece, own in sums.items():
            yield pd.DataFrame({"piece": [piece], "bits": [np.packbits(own > limit).tobytes()]})

    out = np.zeros(1 << (SKETCH_LOG - 3), np.uint8)
    for piece, bits in pieces.repartition(32, "piece").mapInPandas(merge, "piece int, bits binary").collect():  # 2**(SKETCH_LOG - PIECE_LOG) rows
        out[piece << (PIECE_LOG - 3) : (piece + 1) << (PIECE_LOG - 3)] = np.frombuffer(bits, np.uint8)
    return out


def _entries(docs: DataFrame, n: int, frequent: np.ndarray, small: int, num: int, den: int) -> DataFrame:
    """(token, node, n, pos, counted): subset keys of small sets (pos -1) and, of the
    others, all counted shingles (pos null; counted: how many the set has) and those that
    fill up a prefix after them (pos: place in the order)."""
    frequent = docs.sparkSession.sparkContext.broadcast(frequent)

    def rows(frames):
        bits, seen = frequent.value, set()
        for frame in frames:
            token, node, size, pos, counted = [], [], [], [], []

            def add(keys, name, k, places, known, to=(token, node, size, pos, counted)):
                for out, x, kind in zip(to, (keys, name, k, places, known), (np.int64, np.int64, np.int32, np.int32, np.int32), strict=True):
                    out.append(np.broadcast_to(np.asarray(x, kind), len(keys)))

            for hashes in shingle_sets(frame["text"].tolist(), n):
                k, name = len(hashes), fold(hashes)
                if not k or name in seen:
                    continue
                if len(seen) >= MOST_SEEN:
                    seen.clear()
                seen.add(name)
                if k <= small:
                    picks = [p for c in subset_sizes(k, small, num, den) for p in combinations(range(k), c)]
                    add([fold(hashes[list(p)]) for p in picks], name, k, -1, 0)
                if k * den > small * num:  # it may resemble a set above the boundary
                    prefix = k - ceil(num * k / den) + 1
                    cell = (hashes >> np.uint64(64 - SKETCH_LOG)).astype(np.int64)
                    rare = (bits[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 0
                    known = rare & ((hashes & np.uint64(255)) < SAMPLED)
                    rest = np.concatenate([hashes[rare & ~known], hashes[~rare]])[: max(0, prefix - int(known.sum()))]
                    add(hashes[known].view(np.int64), name, k, -2, known.sum())
                    add(rest.view(np.int64), name, k, known.sum() + np.arange(len(rest)), 0)
            if token:
                yield pd.DataFrame({"token": np.concatenate(token), "node": np.concatenate(node), "n": np.concatenate(size), "pos": np.concatenate(pos), "counted": np.concatenate(counted)})

    return in_slices(docs.select("text"), rows, "token long, node long, n int, pos int, counted int")


def _lists(entries: DataFrame, num: int, den: int) -> DataFrame:
    """(token, node, n, pos): the subset keys, and the inverted lists of each set's prefix. A
    counted shingle of one set alone stands before all others and has no list."""
    spark = entries.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = Window.partitionBy("token")  # at most a few millionths of all entries, as frequent ones are not counted
    met = entries.filter("pos = -2").repartition(parts, "token").select(
        "token", "node", "n", "counted", F.count("*").over(own).alias("sets"), F.min("node").over(own).alias("low"), F.max("node").over(own).alias("high")
    ).filter("low <> high")
    order = Window.partitionBy("node")  # a set's shingles
    met = met.repartition(parts, "node").dropDuplicates(["node", "token"])
    placed = met.select(
        "token", "node", "n", (F.col("counted") - F.count("*").over(order) + F.row_number().over(order.orderBy("sets", "token")) - 1).cast("int").alias("pos")
    )
    prefix = F.expr(f"n - ({num} * n + {den - 1}) div {den} + 1")
    return placed.filter(F.col("pos") < prefix).unionByName(entries.filter("pos > -2").select("token", "node", "n", "pos").distinct())


def _may_differ(x: str, y: str, num: int, den: int):
    """Whether signatures x and y differ in no more bits than sets of na and nb that reach num / den."""
    need = F.expr(f"({num} * (na + nb) + {num + den - 1}) div {num + den}")
    apart = F.aggregate(F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda t, n: t + n)
    return apart <= F.col("na") + F.col("nb") - 2 * need


def _close(pairs: DataFrame, first: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) but those whose signatures show that they cannot link."""
    a = first.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("bits").alias("ba"), F.col("fine").alias("fa"))
    b = first.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bb"), F.col("fine").alias("fb"))
    unknown = F.col("fa").isNull() | F.col("fb").isNull()
    near = _may_differ("ba", "bb", num, den) & (unknown | _may_differ("fa", "fb", num, den))
    return pairs.join(a, "a").join(b, "b").filter(near).select("a", "b")


def _can_reach(num: int, den: int):
    """Whether a and b, met in a list, may reach num / den by size and by what can follow."""
    need = F.expr(f"({num} * (na + nb) + {num + den - 1}) div {num + den}")
    rest = F.least(F.col("na") - F.greatest("pa", F.lit(0)), F.col("nb") - F.greatest("pb", F.lit(0)))
    return (F.least("na", "nb") * den >= F.greatest("na", "nb") * num) & ((F.col("pa") < 0) | (rest >= need))


def _verified(pairs: DataFrame, docs: DataFrame, first: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sets reach num / den. Only texts of these nodes'
    first documents are hashed again; what else has their ids, the joins drop. A pair
    takes one set along to the other's, which may belong to very many pairs."""
    members = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct().join(first, "node")
    ids = stored(members.select(F.col("doc_id").alias("member")).distinct())
    ids = F.broadcast(ids) if ids.count() <= MOST_BROADCAST else ids
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(ids, F.col("doc_id").eqNullSafe(F.col("member")), "left_semi")

    def hashed(frames):
        for frame in frames:
            sets = [s for s in shingle_sets(frame["text"].tolist(), n) if len(s)]
            yield pd.DataFrame({"node": [fold(s) for s in sets], "hashes": [s.view(np.int64) for s in sets]})

    sets = in_slices(texts.select("text"), hashed, "node long, hashes array<long>")
    a = sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha"))
    b = sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb"))
    both = F.size(F.array_intersect("ha", "hb"))
    return pairs.join(b, "b").join(a, "a").withColumn("both", both).filter(
        F.col("both") * (den + num) >= num * (F.size("ha") + F.size("hb"))
    ).select("a", "b").distinct()


def ngram_links(docs: DataFrame, n: int = 5, num: int = 4, den: int = 5) -> tuple[DataFrame, DataFrame]:
    """(sets, links): sets is (doc_id, n_shingles, node, digest) of every row of docs; links
    is (node, component) for nodes linked with others by Jaccard >= num / den."""
    both = stored(_sets_and_sketch(docs, n))
    full = both.filter("piece is null and n_shingles > 0")
    sets = both.filter("piece is null").select("doc_id", "n_shingles", "node", "digest")
    sizes = {r[0]: r[1] for r in full.filter(F.col("n_shingles") <= MOST_SMALL).groupBy("n_shingles").count().collect()}
    total = full.agg(F.sum("n_shingles")).first()[0] or 0
    frequent = _frequent(both.filter("piece >= 0").select("piece", "counts"), total)
    small = boundary(sizes, total / max(_distinct(both.filter("piece = -1")), 1), num, den)

    first = stored(full.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.any_value("bits").alias("bits"), F.any_value("fine").alias("fine"), F.any_value("n_shingles").alias("n")))
    lists = stored(_lists(_entries(docs, n, frequent, small, num, den), num, den))
    collect_garbage(docs.sparkSession)
    links, tried, cluster = None, None, None
    for turn, (order, head) in enumerate((("pos", F.min), ("pos", F.min), ("component", F.max))):
        left = _in_components(lists, cluster)
        ends = [F.min("component").alias("low"), F.max("component").alias("high")]
        heads = left.groupBy("token").agg(head(F.struct(order, *(c for c in ("pos", "component", "node", "n") if c != order))).alias("h"), *ends).filter("low <> high").select(
            "token", F.col("h.node").alias("b"), F.col("h.n").alias("nb"), F.col("h.pos").alias("pb"), F.col("h.component").alias("cb"))
        star = left.select("token", *_side("a")).join(heads, "token").filter("ca <> cb").filter(_can_reach(num, den)).groupBy("a", "b").count()
        if tried is not None:
            star = star.join(tried.unionByName(tried.select(F.col("a").alias("b"), F.col("b").alias("a"))), ["a", "b"], "left_anti")
        star = star.groupBy("a").agg(F.max_by("b", F.struct("count", F.col("b"))).alias("b"))
        star = stored(star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        tried = star if tried is None else tried.unionByName(star)
        found = stored(_verified(stored(_close(star, first, num, den)), docs, first, n, num, den))
        links = found if links is None else links.unionByName(found)
        collect_garbage(docs.sparkSession)
        cluster = components(links) if turn != 1 else cluster  # the second round's links are few; they count from the last round on

    left = stored(_unsettled(lists, cluster))
    rest = left.select("token", *_side("a")).join(left.select("token", *_side("b")), "token").filter("ca < cb").filter(_can_reach(num, den))
    rest = rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
    found = stored(_verified(stored(_close(rest, first, num, den)), docs, first, n, num, den))
    return sets, cluster if found.isEmpty() else components(links.unionByName(found))


def _side(s: str) -> list:
    return [F.col(x).alias(f"{y}{s}" if y else s) for x, y in (("node", ""), ("n", "n"), ("pos", "p"), ("component", "c"))]


def _in_components(lists: DataFrame, cluster: DataFrame | None) -> DataFrame:
    """Entries of lists with their nodes' components."""
    if cluster is None:
        return lists.withColumn("component", F.col("node"))
    return lists.join(cluster, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _unsettled(lists: DataFrame, cluster: DataFrame | None) -> DataFrame:
    """Entries of lists whose nodes are not all of one component."""
    left = _in_components(lists, cluster)
    mixed = left.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("token")
    return left.join(mixed, "token", "left_semi")


def _grouped(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(doc_id, n_shingles, digest, component_id) of every row of docs; digest: a hash of the text."""
    sets, linked = ngram_links(docs, n, num, den)
    nodes = sets.filter("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("low"))
    nodes = nodes.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    low = nodes.groupBy("component").agg(F.min("low").alias("component_id"))
    nodes = nodes.join(low, "component").select("node", "component_id")
    with_words, without = sets.filter("n_shingles > 0"), sets.filter("n_shingles = 0")
    return (
        with_words.join(nodes, "node").withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
        .select("doc_id", "n_shingles", "digest", "component_id")
        .unionByName(without.select("doc_id", "n_shingles", "digest", F.col("doc_id").alias("component_id")))
    )


def ngram_components(docs: DataFrame, n: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest doc_id reachable over links of
    Jaccard >= num / den, for every row of docs (columns doc_id and text; others are
    ignored).

    Null and word-less texts have an empty set and link with nothing, their
    component is their own doc_id. Rows of equal sets are linked. Rows that share a
    doc_id are all returned, each with its own set. A null doc_id gets a null
    component and names none. An empty table gives an empty result."""
    return _grouped(docs, n, num, den).select("doc_id", "n_shingles", "component_id")


def ngram_dedup(docs: DataFrame, n: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """docs with one document of each group: the one of the smallest doc_id; columns as in
    docs. Rows of empty sets (null, empty and word-less texts) and of null doc_id stay; of
    rows that share a doc_id in one group all stay, and rows that share a doc_id in different
    groups are judged each by its own text. An empty table gives an empty result."""
    found = _grouped(docs, n, num, den)
    name, digest = fresh(docs, "gone_id", "gone_text")
    gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias(name), F.col("digest").alias(digest)).distinct()
    return docs.join(gone, (F.col("doc_id").cast("long") == F.col(name)) & (_digest() == F.col(digest)), "left_anti")


def _digest():
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))

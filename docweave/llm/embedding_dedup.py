"""Embedding near-dedup: cross-polytope hashing after fast Hadamard rotations, with
multiprobe buckets and verified pairs.

In each of several tables a vector gets a key for each probe: pseudo-random sign flips
and Hadamard transforms rotate it, and the nearest signed axes name buckets. A bucket's
vectors are compared in blocks by their exact cosine, a pair counting in the first
bucket that it shares. Large buckets are cut into chunks whose pairs of chunks are
separate tasks, so no bucket is one task's. Equal vectors are one class, which enters with
its number of ids, so copies of a vector cost no comparisons.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import _stream, components, in_slices, stored

#: Vectors of a bucket that are compared in one task.
CHUNK = 2048


def _hadamard(x: np.ndarray) -> np.ndarray:
    """The unnormalised Walsh-Hadamard transform of the rows; their length is a power of two."""
    n, h = x.shape[1], 1
    x = x.copy()
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], 2).reshape(len(x), n)
        h *= 2
    return x


def bucket_keys(vectors: np.ndarray, tables: int, hashes: int, probes: int, seed: int = 1) -> np.ndarray:
    """Keys (vector x table * probe) of unit vectors. A table's key joins `hashes`
    cross-polytope hashes; the probes are the best joint choices of near axes, the
    nearest first, in the order of what they lose."""
    n, dim = vectors.shape
    width = 1 << max(0, dim - 1).bit_length()
    padded = np.zeros((n, width))
    padded[:, :dim] = vectors
    out = np.empty((n, tables, probes), np.int64)
    near = min(probes, width)
    rows = np.arange(n)[:, None]
    for t in range(tables):
        loss, key = np.zeros((n, 1)), np.zeros((n, 1), np.int64)
        for k in range(hashes):
            x = padded
            for turn in range(3):
                signs = 1.0 - 2.0 * (_stream(width, ((seed * 1000 + t) * 10 + k) * 100 + turn << 16) & np.uint64(1))
                x = _hadamard(x * signs) / np.sqrt(width)
            size = np.abs(x)
            axis = np.argsort(-size, 1, kind="stable")[:, :near] if near > 1 else size.argmax(1)[:, None]
            lost = size.max(1)[:, None] - size[rows, axis]
            name = axis * 2 + (x[rows, axis] < 0)
            loss = (loss[:, :, None] + lost[:, None, :]).reshape(n, -1)
            key = (key[:, :, None] * (2 * width) + name[:, None, :]).reshape(n, -1)
            best = np.argsort(loss, 1, kind="stable")[:, :probes]
            loss, key = loss[rows, best], key[rows, best]
        out[:, t] = key * tables + t
    return out.reshape(n, -1)


def _usable(column: str = "embedding"):
    """Not null, not empty, only finite numbers, not all zero."""
    v = F.col(column).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(column).isNotNull() & (F.size(column) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _keyed(vectors: DataFrame, tables: int, hashes: int, probes: int) -> DataFrame:
    """(id, v, ids, keys) of usable vectors (id, v, ids)."""

    def rows(batches):
        for batch in batches:
            if not len(batch):
                continue
            v = [np.asarray(x, np.float64) for x in batch["v"]]
            dims = np.array([len(x) for x in v])
            keys: list = [None] * len(v)
            for dim in np.unique(dims):  # vectors of other lengths never meet
                own = np.flatnonzero(dims == dim)
                for at in range(0, len(own), 2000):
                    part = own[at : at + 2000]
                    x = np.stack([v[i] for i in part])
                    x /= np.abs(x).max(1, keepdims=True)
                    x /= np.linalg.norm(x, axis=1, keepdims=True)
                    k = bucket_keys(x, tables, hashes, probes, seed=int(dim))
                    for i, own_keys in zip(part, k, strict=True):
                        keys[i] = own_keys * 65536 + int(dim) % 65536
            yield pd.DataFrame({"id": batch["id"], "v": batch["v"], "ids": batch["ids"], "keys": keys})

    kind = vectors.schema["v"].dataType.simpleString()
    return in_slices(vectors, rows, f"id long, v {kind}, ids long, keys array<long>")


def _compare(blocks: DataFrame, least: float, probes: int) -> DataFrame:
    """(id, n, low) for vectors of each block (key, i, j): how many ids it links with in pairs whose
    first shared bucket this is, and the smallest id that links reach in the block."""

    def links(key: int, side: np.ndarray, ids: np.ndarray, many: np.ndarray, v: list, keys: np.ndarray) -> pd.DataFrame | None:
        if len(ids) < 2:
            return None
        x = np.stack(v).astype(np.float64)
        x /= np.abs(x).max(1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        if side.any():
            left, right = np.flatnonzero(side != 2), np.flatnonzero(side != 1)
        else:
            left = right = np.arange(len(ids))
        a, b = [], []
        for at in range(0, len(left), 512):
            i, j = np.nonzero(x[left[at : at + 512]] @ x[right].T >= least)
            a.append(left[at : at + 512][i]), b.append(right[j])
        a, b = np.concatenate(a), np.concatenate(b)
        one_way = ids[a] < ids[b] if not side.any() else ids[a] != ids[b]
        a, b = a[one_way], b[one_way]
        if not len(a):
            return None
        first = np.empty(len(a), bool)
        table = keys.reshape(len(ids), -1, probes)
        for at in range(0, len(a), 20_000):
            p, q = table[a[at : at + 20_000]], table[b[at : at + 20_000]]
            same = (p[:, :, :, None] == q[:, :, None, :]).any(3)
            first[at : at + 20_000] = np.where(same, p, np.iinfo(np.int64).max).min((1, 2)) == key
        n = np.zeros(len(ids), np.int64)
        np.add.at(n, a[first], many[b[first]])
        np.add.at(n, b[first], many[a[first]])
        low = ids.copy()
        while True:
            before = low.copy()
            np.minimum.at(low, a, low[b])
            np.minimum.at(low, b, low[a])
            if (low == before).all():
                break
        some = (n > 0) | (low != ids)
        return pd.DataFrame({"id": ids[some], "n": n[some], "low": low[some]})

    def rows(batches):
        rest = None
        for batch in batches:
            batch = pd.concat([rest, batch]) if rest is not None and len(rest) else batch
            place = batch[["key", "i", "j"]].to_numpy(np.int64)
            cut = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]).any(1)]) if len(place) else np.empty(0, int)
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                yield from group(place[a, 0], batch.iloc[a:b])
            rest = batch.iloc[cut[-1] :] if len(cut) else batch
        if rest is not None and len(rest):
            yield from group(rest["key"].iloc[0], rest)

    def group(key, part):
        found = links(int(key), part["side"].to_numpy(np.int64), part["id"].to_numpy(np.int64), part["ids"].to_numpy(np.int64), part["v"].tolist(), np.stack(part["keys"].tolist()) if len(part) > 1 else None)
        if found is not None:
            yield found

    return in_slices(blocks, rows, "id long, n long, low long")


def near_vectors(
    vectors: DataFrame, least: float = 0.9, tables: int = 6, hashes: int = 2, probes: int = 4, chunk: int = CHUNK
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of vectors (columns vec_id and
    embedding; others are ignored).

    Two vectors link if they share a bucket and their cosine in double precision is
    `least` or more; none below links. With the defaults pairs of cosine 0.9 are found
    with a chance over 0.95, closer ones more surely. n_links counts other vectors
    linked directly, component_id is the smallest vec_id that links reach. Vectors
    that are null, empty, zero or hold null or non-finite numbers, and those of a null
    vec_id, link with nothing; a null vec_id has a null component and kept false. Equal rows count as one vector; other rows that share a
    vec_id add up their links. An empty table gives an empty result."""
    tag = [F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(7), "v").alias("h2")]  # 128 bits tell vectors apart
    usable = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("v")).filter(F.col("id").isNotNull() & _usable("v")).select("id", "v", *tag)
    members = stored(usable.select("id", "h1", "h2").distinct())
    classes = stored(members.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("ids")))
    named = classes.withColumnRenamed("rep", "id")
    keyed = _keyed(usable.join(named, ["id", "h1", "h2"]).dropDuplicates(["id", "h1", "h2"]).select("id", "v", "ids"), tables, hashes, probes)
    keyed = stored(keyed)
    placed = keyed.select("id", "v", "ids", "keys", F.explode("keys").alias("key"))
    sizes = keyed.select(F.explode("keys").alias("key")).groupBy("key").count()
    hot = sizes.filter(F.col("count") > chunk).select("key", F.ceil(F.col("count") / chunk).cast("int").alias("chunks"))
    placed = placed.join(hot, "key", "left").withColumn("own", F.when(F.col("chunks").isNotNull(), F.pmod(F.xxhash64("id"), F.col("chunks"))).cast("int"))
    # A vector of chunk c meets chunk o in block (min, max); side 1 is the smaller chunk's, 0 a block of one chunk.
    placed = placed.withColumn("other", F.explode(F.coalesce(F.sequence(F.lit(0), F.col("chunks") - 1), F.array(F.lit(0)))))
    own = F.coalesce("own", F.lit(0))
    blocks = placed.select(
        "key", F.least(own, "other").alias("i"), F.greatest(own, "other").alias("j"),
        F.when(own == F.col("other"), 0).when(own < F.col("other"), 1).otherwise(2).alias("side"), "id", "ids", "v", "keys",
    )
    n = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = stored(_compare(blocks.repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j"), least, probes))

    counts = found.groupBy(F.col("id").alias("rep")).agg(F.sum("n").alias("n"))
    each = members.join(classes, ["h1", "h2"]).join(counts, "rep", "left").select("id", "rep", (F.col("ids") - 1 + F.coalesce("n", F.lit(0))).alias("n"))
    # An id of several vectors joins their classes.
    several = each.groupBy("id").agg(F.min("rep").alias("b"), F.max("rep").alias("a"), F.count("*").alias("k")).filter("k > 1 and a <> b").select("id", "b")
    edges = found.select(F.col("id").alias("a"), F.col("low").alias("b")).unionByName(each.join(several, "id").select(F.col("rep").alias("a"), "b"))
    linked = components(stored(edges))
    settled = each.join(linked, F.col("rep") == F.col("node"), "left").groupBy("id").agg(F.sum("n").alias("n_links"), F.min(F.coalesce("component", "rep")).alias("component"))
    out = vectors.select(F.col("vec_id").cast("long").alias("vec_id")).join(settled, F.col("vec_id") == F.col("id"), "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )

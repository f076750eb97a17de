"""Approximate nearest neighbours with a robust-pruned directed graph for each shard.

Different vectors are dealt to shards by a hash. A shard's graph grows in batches: a greedy beam search of
the graph so far proposes neighbours for each new vector; of these, nearest first, a neighbour stays unless
one that stays is so near to it that `alpha` times their distance is no more than its own distance to the
vector. Neighbours link back, and a list that grows too long is pruned alike. The index is a table with one
row for each shard (and vector length), so it outlives executors and serves any number of query sets. Each
block of queries searches each shard with a beam, and each query's nearest of all shards are its answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .embedding_dedup import _usable
from .shared import _stream, in_slices, stored

#: Vectors of a shard on average at most, and numbers in them.
SHARD, SHARD_VALUES = 8192, 1 << 21
#: Queries of a block.
QUERIES = 256
#: Vectors that a batch adds to a graph at most.
BATCH = 256
#: Places that a search starts from.
STARTS = 16
INDEX = "shard int, dim int, n int, degree int, starts binary, vectors binary, links binary, ends binary, ids binary"


def _distances(x: np.ndarray, norms: np.ndarray, of: np.ndarray, q: np.ndarray, q_norms: np.ndarray) -> np.ndarray:
    """Squared distances of each query (rows of q) to its own places `of` in x."""
    return norms[of] - 2 * np.matmul(x[of], q[:, :, None])[:, :, 0] + q_norms[:, None]


def beam_search(x: np.ndarray, norms: np.ndarray, links: np.ndarray, starts: np.ndarray, q: np.ndarray, beam: int, expand: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """(places, squared distances) of the `beam` nearest that greedy searches from `starts` find for each query,
    nearest first, -1 and inf where there are fewer. Each step follows the links of the `expand` nearest places
    of each beam that it has not followed yet, until none is left."""
    b, n = len(q), len(x)
    q_norms = (q * q).sum(1)
    seen = np.zeros((b, n + 1), bool)
    seen[:, n] = True  # where a list is shorter its links are n
    place = np.full((b, beam), n)
    dist = np.full((b, beam), np.inf, x.dtype)
    done = np.ones((b, beam), bool)
    starts = starts[:beam]
    from_all = np.broadcast_to(starts, (b, len(starts)))
    place[:, : len(starts)], done[:, : len(starts)], seen[:, starts] = starts, False, True
    dist[:, : len(starts)] = _distances(x, norms, from_all, q, q_norms)
    live = np.arange(b)
    while len(live):
        nearest = np.argsort(np.where(done[live], np.inf, dist[live]), 1, kind="stable")[:, :expand]
        row = live[:, None]
        follow = np.where(done[row, nearest], n, place[row, nearest])
        done[row, nearest] = True
        to = np.sort(links[follow].reshape(len(live), -1), 1)
        new = ~seen[row, to]
        new[:, 1:] &= to[:, 1:] != to[:, :-1]
        to = np.where(new, to, n)
        width = max(1, int(new.sum(1).max()))
        to = np.sort(to, 1)[:, :width]  # n is the largest: new ones stand in front
        seen[row, to] = True
        far = np.where(to < n, _distances(x, norms, np.minimum(to, n - 1), q[live], q_norms[live]), np.inf).astype(x.dtype)
        every, far = np.concatenate([place[live], to], 1), np.concatenate([dist[live], far], 1)
        order = np.argsort(far, 1, kind="stable")[:, :beam]
        place[live], dist[live] = np.take_along_axis(every, order, 1), np.take_along_axis(far, order, 1)
        done[live] = np.take_along_axis(np.concatenate([done[live], to == n], 1), order, 1)
        live = live[~done[live].all(1)]
    return np.where(np.isfinite(dist), place, -1), dist


def robust_prune(x: np.ndarray, norms: np.ndarray, of: np.ndarray, near: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each place `of` its links among the places `near` (-1: none): at most `degree`, nearest first, each
    dropped if a link before it is nearer to it, by `alpha` times the distance, than the place itself. len(x) fills up."""
    n = len(x)
    to = np.where((near < 0) | (near == of[:, None]), n, near)
    to = np.sort(to, 1)
    to[:, 1:] = np.where(to[:, 1:] == to[:, :-1], n, to[:, 1:])
    held = np.minimum(to, n - 1)
    own = np.where(to < n, np.maximum(_distances(x, norms, held, x[of], norms[of]), 0), np.inf)
    order = np.argsort(own, 1, kind="stable")
    to, held, own = (np.take_along_axis(a, order, 1) for a in (to, held, own))
    v = x[held]
    apart = np.maximum(norms[held][:, :, None] + norms[held][:, None, :] - 2 * np.matmul(v, v.transpose(0, 2, 1)), 0)
    covers = alpha * alpha * apart <= own[:, None, :]
    alive = np.isfinite(own)
    out = np.full((len(of), degree), n)
    row = np.arange(len(of))
    for k in range(degree):
        some = alive.any(1)
        if not some.any():
            break
        first = alive.argmax(1)
        out[some, k] = to[row, first][some]
        alive &= ~covers[row, first]
        alive[row, first] = False
    return out


def build_graph(x: np.ndarray, degree: int, beam: int, alpha: float, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(links, starts): each vector's links, len(x) where there are fewer, and the places that searches start from,
    the vector nearest the mean and STARTS - 1 at random, so that a dense cluster around the mean holds no search. Lists may grow by a half before they are pruned back to `degree`."""
    n = len(x)
    norms = (x * x).sum(1)
    room = degree + degree // 2
    links = np.full((n + 1, room), n)
    count = np.zeros(n + 1, np.int64)
    start = int(((x - x.mean(0)) ** 2).sum(1).argmin())
    order = np.argsort(_stream(n, seed << 32), kind="stable")
    order = np.concatenate([[start], order[order != start]])
    starts, at = order[:STARTS], 1
    while at < n:
        new = order[at : at + min(BATCH, at)]
        at += len(new)
        near, _ = beam_search(x, norms, links, starts[: at - len(new)], x[new], beam)
        own = robust_prune(x, norms, new, near, degree, alpha)
        links[new, :degree], links[new, degree:] = own, n
        count[new] = (own < n).sum(1)
        back_from, back_to = np.repeat(new, degree), own.ravel()
        real = back_to < n
        back_from, back_to = back_from[real], back_to[real]
        by = np.lexsort((back_from, back_to))
        back_from, back_to = back_from[by], back_to[by]
        to, first, many = np.unique(back_to, return_index=True, return_counts=True)
        nth = np.arange(len(back_to)) - np.repeat(first, many)
        fits = np.repeat(count[to] + many <= room, many)
        links[back_to[fits], (count[back_to] + nth)[fits]] = back_from[fits]
        few = count[to] + many <= room
        count[to[few]] += many[few]
        over = np.flatnonzero(~few)
        for part in np.array_split(over, max(1, -(-len(over) // 128))):
            if len(part):
                wide = np.full((len(part), room + int(many[part].max())), -1)
                wide[:, :room] = np.where(links[to[part]] < n, links[to[part]], -1)
                for i, p in enumerate(part):
                    wide[i, room : room + many[p]] = back_from[first[p] : first[p] + many[p]]
                own = robust_prune(x, norms, to[part], wide, degree, alpha)
                links[to[part], :degree], links[to[part], degree:] = own, n
                count[to[part]] = (own < n).sum(1)
    return _reachable(x, norms, links, starts, beam)[:n], starts


def _reachable(x: np.ndarray, norms: np.ndarray, links: np.ndarray, starts: np.ndarray, beam: int) -> np.ndarray:
    """links with one more, from the nearest vector that a search finds, to each vector that pruning has cut off."""
    n = len(x)
    while True:
        seen = np.zeros(n + 1, bool)
        seen[n] = True
        front = starts
        while len(front):
            seen[front] = True
            front = np.unique(links[front])
            front = front[~seen[front]]
        lost = np.flatnonzero(~seen)[:BATCH]
        if not len(lost):
            return links
        near, _ = beam_search(x, norms, links, starts, x[lost], beam)
        for place, by in zip(lost, near[:, 0], strict=True):
            free = np.flatnonzero(links[by] == n)
            if not len(free):
                links = np.pad(links, ((0, 0), (0, 1)), constant_values=n)
                free = [links.shape[1] - 1]
            links[by, free[0]] = place


def _classes(rows: DataFrame, ids: int) -> DataFrame:
    """(h1, h2, v, ids): different vectors of rows (id, h1, h2, v), each with its `ids` smallest ids. A vector of
    very many ids keeps the smallest of each salt before its ids meet."""
    salt = F.pmod(F.xxhash64("id"), F.lit(64))
    first = lambda df, *by: df.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy("id"))).filter(F.col("_n") <= ids).drop("_n")
    few = first(first(rows.select("id", "h1", "h2", salt.alias("salt")).distinct(), "h1", "h2", "salt"), "h1", "h2")
    few = few.groupBy("h1", "h2").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return rows.groupBy("h1", "h2").agg(F.first("v").alias("v")).join(few, ["h1", "h2"])


def build_index(vectors: DataFrame, k: int = 10, degree: int = 32, beam: int = 64, alpha: float = 1.2, shard: int = SHARD) -> DataFrame:
    """The index of vectors (columns vec_id and embedding): a row for each shard and vector length, stored. Every row
    with an id and a usable vector is in it; of equal vectors the k + 1 smallest ids, which are all that an answer of
    k can name. It is fitted on all rows, no sample."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("v")).filter(F.col("id").isNotNull() & _usable("v"))
    rows = rows.select("id", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(7), "v").alias("h2"))
    classes = stored(_classes(rows, k + 1))
    n, values = classes.agg(F.count("*"), F.coalesce(F.sum(F.size("v").cast("long")), F.lit(0))).first()
    shards = max(1, -(-n // shard), -(-values // SHARD_VALUES))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        frame = frame.sort_values(["h1", "h2"])
        dims = frame["v"].map(len).to_numpy()
        for dim in np.unique(dims):
            own = frame[dims == dim]
            v = np.stack(own["v"].tolist()).astype(np.float64)
            links, starts = build_graph(_searchable(v)[0], degree, beam, alpha)
            ids = [np.asarray(i, np.int64) for i in own["ids"]]
            ends = np.cumsum([len(i) for i in ids]).astype(np.int64)
            out.append((int(frame["shard"].iloc[0]), int(dim), len(v), links.shape[1], starts.astype(np.int64).tobytes(), v.tobytes(), links.astype(np.int32).tobytes(), ends.tobytes(), np.concatenate(ids).tobytes()))
        return pd.DataFrame(out, columns=[c.split(" ")[0] for c in INDEX.split(", ")])

    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # not fewer: a shard is little to read and much to do
    return stored(classes.withColumn("shard", F.pmod("h2", F.lit(shards)).cast("int")).repartition(tasks, "shard").groupBy("shard").applyInPandas(build, INDEX), rows_per_file=8)


def _searchable(v: np.ndarray, *more: np.ndarray) -> list[np.ndarray]:
    """Vectors for the search alone: moved and scaled as one, in single precision unless some are so far off that it
    would not tell the others apart."""
    every = [a - v.mean(0) for a in (v, *more)]
    sizes = [max(np.abs(a).max(), 1e-300) for a in every]
    kind = np.float64 if max(sizes) > 1000 * sizes[0] else np.float32
    return [(a / max(sizes)).astype(kind) for a in every]


def search_index(index: DataFrame, queries: DataFrame, k: int = 10, beam: int = 192) -> DataFrame:
    """(query_id, rank, vec_id, score) of queries (columns vec_id and embedding): see nearest()."""
    rows = queries.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("v")).filter(F.col("id").isNotNull() & _usable("v"))
    rows = stored(rows.groupBy("id", F.xxhash64("v").alias("h")).agg(F.first("v").alias("v")))
    many = max(1, -(-rows.count() // QUERIES))
    blocks = rows.groupBy(F.size("v").alias("dim"), F.pmod(F.xxhash64("id", "h"), F.lit(many)).alias("block")).agg(F.collect_list(F.struct("id", "h", "v")).alias("queries"))
    to = index.groupBy("dim").agg(F.collect_list("shard").alias("shards"))
    units = index.join(blocks.join(to, "dim").select("dim", F.explode("shards").alias("shard"), "queries"), ["dim", "shard"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                x = np.frombuffer(r.vectors).reshape(r.n, r.dim)
                links = np.full((r.n + 1, r.degree), r.n)
                links[: r.n] = np.frombuffer(r.links, np.int32).reshape(r.n, r.degree)
                ends, ids = np.frombuffer(r.ends, np.int64), np.frombuffer(r.ids, np.int64)
                q = np.stack([np.asarray(y["v"], np.float64) for y in r.queries])
                small, asked = _searchable(x, q)
                place, _ = beam_search(small, (small * small).sum(1), links, np.frombuffer(r.starts, np.int64), asked, max(beam, k + 1))
                answers = [_answers(x, ends, ids, y["id"], own, v, k) for y, own, v in zip(r.queries, place, q, strict=True)]
                sizes = [len(a[0]) for a in answers]
                yield pd.DataFrame({"query_id": np.repeat([y["id"] for y in r.queries], sizes), "h": np.repeat([y["h"] for y in r.queries], sizes), "vec_id": np.concatenate([a[0] for a in answers]), "score": np.concatenate([a[1] for a in answers])})

    found = stored(in_slices(units, run, "query_id long, h long, vec_id long, score double"))
    best = Window.partitionBy("query_id", "h").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _answers(x: np.ndarray, ends: np.ndarray, ids: np.ndarray, query: int, place: np.ndarray, v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """A query's k nearest ids of a shard by exact distance, its own left out, and their distances."""
    place = place[place >= 0]
    first = np.where(place > 0, ends[place - 1], 0)
    many = ends[place] - first
    own = ids[np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())]
    score = np.repeat(distances(x[place], v), many)
    keep = own != query
    own, score = own[keep], score[keep]
    order = np.lexsort((own, score))[:k]
    return own[order], score[order]


def distances(x: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to v in double precision."""
    return np.sqrt(((x - v) ** 2).sum(1))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, degree: int = 32, build_beam: int = 64, beam: int = 192, alpha: float = 1.2, shard: int = SHARD) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of queries its k nearest rows of vectors that the search finds,
    by Euclidean distance in double precision, nearest first, ties to the smaller vec_id (both tables have columns
    vec_id and embedding; others are ignored). Rows of the query's own vec_id are no candidates.

    Vectors that are null, empty, zero or hold null or non-finite numbers, and those of a null vec_id, take no part.
    Only vectors of one length meet. Equal rows count once; a vec_id of several vectors is several candidates and, as a
    query, several queries, whose answers share its query_id. A query with no candidate has no row. An empty table
    gives an empty result. Scores are exact; that no nearer row was missed is likely, not sure."""
    return search_index(build_index(vectors, k, degree, build_beam, alpha, shard), queries, k, beam)

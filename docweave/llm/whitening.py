"""Embedding whitening from exact integer scatter.

Entries become integers, floor(scale * c). Each task subtracts a shift, its first vector, from its
distinct vectors and multiplies them in blocks whose products are exact: entries are cut into digits
so small that a block's sums stay below 2**53. Sums and cross-products go back to shift 0 as integers
of any length and travel as signed digits of 32 bits, which Spark adds up as longs. Only n * C - S * S'
is turned into floats, by one correctly rounded division, and decomposed by eigh. So neither the
order of rows nor the cut into tasks changes a bit of the fit. Only a matrix of one vector length meets
in a task; the fitted axes are joined to the rows, never collected.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import SLICE_BYTES, _give_back, stored

#: Bits of a digit of an entry, and of the digits that sums travel in.
DIGIT, LIMB = 20, 32
#: Rows of a block: their digit products add up to less than 2**53.
BLOCK = 1 << (52 - 2 * DIGIT)
#: An axis counts if its variance is over this part of the largest one.
FLAT = 1e-13
#: Numbers of fitted axes that are broadcast at most, 8 bytes each; more are joined under salts.
MOST_BROADCAST, SALTS = 1 << 20, 64
_MODEL = ["dim", "n", "sums", "e", "axes"]


def quantised(v: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * v) as 64-bit integers, held at their range's ends where it is beyond."""
    with np.errstate(over="ignore"):
        f = np.floor(v * scale)
    x = np.where(np.abs(f) < 2.0**63, f, 0.0).astype(np.int64)
    return np.where(f >= 2.0**63, np.iinfo(np.int64).max, np.where(f < -(2.0**63), np.iinfo(np.int64).min, x))


def packed(x: np.ndarray) -> list[bytes]:
    """Each row as bytes: the width of its integers, the narrowest that holds all of them, then the integers."""
    need = np.where((x == np.iinfo(np.int64).min).any(1), np.iinfo(np.int64).max, np.abs(x).max(1))
    width = np.select([need < 1 << 7, need < 1 << 15, need < 1 << 31], [1, 2, 4], 8)
    out: list = [None] * len(x)
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        for i, row in zip(at, x[at].astype(f"<i{w}"), strict=True):
            out[i] = bytes([w]) + row.tobytes()
    return out


def unpacked(rows: list[bytes]) -> np.ndarray:
    """The integers of packed() rows of one length."""
    return np.stack([np.frombuffer(r, f"<i{r[0]}", offset=1) for r in rows]).astype(np.int64)


def _lengths(rows: list[bytes]) -> np.ndarray:
    return np.array([(len(r) - 1) // r[0] for r in rows], np.int64)


def _quantise(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, dim, x) of vectors that are not null nor empty and hold finite numbers alone; x as packed()."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            step = max(1, whole.num_rows * SLICE_BYTES // max(whole.nbytes, 1))
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                v = batch.column(1)
                dims = v.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                flat = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become NaN
                ends = np.cumsum(dims)
                bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
                good = (dims > 0) & (bad[ends] == bad[ends - dims])
                xs: list = [None] * len(dims)
                for dim in np.unique(dims[good]):
                    own = np.flatnonzero(good & (dims == dim))
                    for i, x in zip(own, packed(quantised(flat[(ends[own] - dim)[:, None] + np.arange(dim)], scale)), strict=True):
                        xs[i] = x
                keep = pa.array(good)
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), pa.array(dims, pa.int32()).filter(keep), pa.array(xs, pa.binary()).filter(keep)], ["vec_id", "dim", "x"])
        _give_back()

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).mapInArrow(rows, "vec_id long, dim int, x binary")


def exact_products(y: np.ndarray) -> np.ndarray:
    """y'y of integers as Python integers, exactly. y's entries are below 2**63 in size."""
    n, dim = y.shape
    out = np.zeros((dim, dim), object)
    for at in range(0, n, BLOCK):
        rest, digits = y[at : at + BLOCK], []
        while rest.any():
            low = rest & ((1 << DIGIT) - 1) if np.abs(rest).max() >> DIGIT else rest
            digits.append(low.astype(np.float64))
            rest = (rest - low) >> DIGIT
        for i, a in enumerate(digits):
            for j, b in enumerate(digits):
                out += (a.T @ b).astype(np.int64).astype(object) << (DIGIT * (i + j))
    return out


def scatter_of(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, cross-products) of the rows as Python integers, by way of a shift to the first row."""
    shift = x[0].astype(object)
    wide = np.abs(x).max() >> 62 or (x == np.iinfo(np.int64).min).any()
    y = None if wide else x - x[0]
    if wide:  # differences may leave 64 bits: integers of any length
        own = x.astype(object) - shift
        s, c = own.sum(0), own.T.dot(own)
    else:
        s, c = y.astype(object).sum(0) if np.abs(y).max() >> 40 else y.sum(0).astype(object), exact_products(y)
    n = len(x)
    across = np.outer(shift, s)
    return s + n * shift, c + across + across.T + n * np.outer(shift, shift)


def _limbs(values: np.ndarray) -> list[np.ndarray]:
    """Signed integers as digits of LIMB bits, all but the last not negative."""
    out, rest = [], values
    while not all(-(1 << LIMB) < v < 1 << LIMB for v in rest):
        out.append((rest & ((1 << LIMB) - 1)).astype(np.int64))
        rest = rest >> LIMB
    return [*out, rest.astype(np.int64)]


def _scatter(distinct: DataFrame) -> DataFrame:
    """(dim, i, j, limb, v): sums of sums (i = -1), cross-products (j <= i) and counts (i = -2)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for whole in batches:
            step = max(1, whole.num_rows * SLICE_BYTES // max(whole.nbytes, 1))
            for at in range(0, whole.num_rows, step):
                xs = whole.column("x").slice(at, step).to_pylist()
                dims = _lengths(xs)
                for dim in np.unique(dims).tolist():
                    own = unpacked([x for x, d in zip(xs, dims, strict=True) if d == dim])
                    s, c = scatter_of(own)
                    have = total.setdefault(dim, [0, 0, 0])
                    have[0], have[1], have[2] = have[0] + len(own), have[1] + s, have[2] + c
        for dim, (n, s, c) in total.items():
            i, j = np.tril_indices(dim)
            at_i = np.concatenate([[-2], np.full(dim, -1), i])
            at_j = np.concatenate([[0], np.arange(dim), j])
            for k, v in enumerate(_limbs(np.concatenate([np.array([n], object), s, c[i, j]]))):
                some = v != 0
                yield from pa.Table.from_pydict({"dim": pa.array(np.full(some.sum(), dim), pa.int32()), "i": pa.array(at_i[some], pa.int32()), "j": pa.array(at_j[some], pa.int32()), "limb": pa.array(np.full(some.sum(), k), pa.int32()), "v": pa.array(v[some], pa.int64())}).to_batches(max_chunksize=1 << 17)
        _give_back()

    return distinct.select("x").mapInArrow(rows, "dim int, i int, j int, limb int, v long").groupBy("dim", "i", "j", "limb").agg(F.sum("v").alias("v"))


def decomposed(n: int, s: np.ndarray, c: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(variances falling, axes as rows, trace) of the covariance (n * C - S * S') / n**2. Axes of no variance are
    left out; an axis's entry of largest size is positive."""
    m = n * c - np.outer(s, s)
    v = np.array([float(a / (n * n)) if a else 0.0 for a in m.ravel()]).reshape(m.shape)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u.T[::-1]
    keep = (e[:most] > max(e[0], 0.0) * FLAT) & (e[:most] > 0)
    e, u = e[:most][keep], u[:most][keep]
    u = u * np.where(np.take_along_axis(u, np.abs(u).argmax(1)[:, None], 1) < 0, -1.0, 1.0) if len(u) else u
    return e, u, float(np.trace(m) / (n * n)) if n else 0.0


def _fit(scatter: DataFrame, components: int) -> DataFrame:
    """(dim, n, sums, e, axes, trace): sums as decimal text, axes one after the other."""

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        dim = int(rows["dim"].iloc[0])
        n, s, c = 0, np.zeros(dim, object), np.zeros((dim, dim), object)
        for i, j, limb, v in rows[["i", "j", "limb", "v"]].itertuples(index=False):
            add = int(v) << (LIMB * int(limb))
            if i == -2:
                n += add
            elif i == -1:
                s[j] += add
            else:
                c[i, j] += add
        c += np.tril(c, -1).T
        e, u, trace = decomposed(n, s, c, components)
        return pd.DataFrame({"dim": [dim], "n": [n], "sums": [[str(x) for x in s]], "e": [e], "axes": [u.ravel()], "trace": [trace]})

    return scatter.groupBy("dim").applyInPandas(fit, "dim int, n long, sums array<string>, e array<double>, axes array<double>, trace double")


def projected(x: np.ndarray, n: int, s: list[int], e: np.ndarray, axes: np.ndarray) -> tuple[list[int], np.ndarray]:
    """(sum over dimensions of (n * x - S)**2, whitened rows): x - S / n is y + q / n for y = x - r, where r is S / n
    cut to an integer and q = n * r - S, so nothing is rounded before it is multiplied."""
    r = np.array([a // n for a in s], object)
    q = n * r - np.array(s, object)
    low, high, deepest = int(x.min()), int(x.max()), int(max(map(abs, r)))
    y = x - r.astype(np.int64) if max(abs(low), abs(high), deepest) < 1 << 61 else x.astype(object) - r
    most = max(abs(low), abs(high)) + deepest
    small = len(s) * most * max(most, n) < 1 << 62
    a, b = ((y * y).sum(1), y @ q.astype(np.int64)) if small else ((y.astype(object) ** 2).sum(1), y.astype(object).dot(q))
    own = int((q * q).sum())
    deviation = [n * n * int(i) + 2 * n * int(j) + own for i, j in zip(a, b, strict=True)]
    centred = y.astype(np.float64) + np.array([float(k / n) if k else 0.0 for k in q])
    return deviation, centred @ axes.T / np.sqrt(e)


def _project(rows: DataFrame, model: DataFrame) -> DataFrame:
    """(vec_id, dim, n, deviation, whitened, explained, identity_error) of rows (vec_id, dim, x) whose length has
    axes. A small model goes to the tasks as it is; a large one is joined under salts, as one length may be all rows'."""
    own = [*_MODEL, "explained", "identity_error"]
    size = model.agg(F.sum(F.col("dim").cast("long") * (F.size("e") + 1))).first()[0] or 0
    known = {}
    if size <= MOST_BROADCAST:
        known = {r["dim"]: r.asDict() for r in model.select(*own).collect()}
        frame = rows.select("vec_id", "dim", "x")
    else:
        salts = model.select(*own).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        frame = rows.select("vec_id", "dim", "x", F.pmod(F.xxhash64("x"), F.lit(SALTS)).cast("int").alias("_salt")).join(salts, ["dim", "_salt"]).drop("_salt")
    held = rows.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            step = max(1, whole.num_rows * SLICE_BYTES // max(whole.nbytes, 1))
            for at in range(0, whole.num_rows, step):
                yield from part(whole.slice(at, step))
        _give_back()

    def part(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        dims = batch.column("dim").to_numpy()
        xs = batch.column("x").to_pylist()
        for dim in np.unique(dims).tolist():
            at = np.flatnonzero(dims == dim)
            if held.value and dim not in held.value:
                continue
            m = held.value.get(dim) or {c: batch.column(c)[int(at[0])].as_py() for c in own}
            e = np.array(m["e"], np.float64)
            deviation, z = projected(unpacked([xs[i] for i in at]), m["n"], [int(s) for s in m["sums"]], e, np.array(m["axes"], np.float64).reshape(len(e), dim))
            lists = lambda v: pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * len(e), pa.int32()), pa.array(v, pa.float64()))
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(at)), pa.array(dims[at], pa.int32()), pa.array(np.full(len(at), m["n"]), pa.int64()), pa.array([Decimal(d) if d < 10**38 else None for d in deviation], pa.decimal128(38, 0)),
                lists(np.ascontiguousarray(z).ravel()), lists(np.tile(m["explained"], len(at))), pa.array(np.full(len(at), m["identity_error"], np.float64)),
            ], ["vec_id", "dim", "n", "deviation", "whitened", "explained", "identity_error"])

    return frame.mapInArrow(run, "vec_id long, dim int, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double")


def whiten(vectors: DataFrame, components: int = 4, scale: int = 256) -> DataFrame:
    """Rows (vec_id, component, n, deviation decimal(38,0), whitened, explained, identity_error) of each row of
    vectors (columns vec_id and embedding; others are ignored) and component up to `components`, numbered from 1.

    x is floor(scale * c) of each entry c as double. The fit is over the n distinct x, S their sums; its axes are
    unit eigenvectors of their covariance by falling eigenvalue e. deviation: sum over dimensions of (n * x - S)**2,
    exact, null from 10**38 on; whitened: x - S / n along the axis over sqrt(e); explained: e over the sum of all
    eigenvalues; identity_error: the largest entry of the whitened fit list's covariance less the identity.

    Rows whose vector is null, empty or holds null or non-finite entries are left out. Rows of a null or repeated
    vec_id are rows like others. Vectors of several lengths are fitted length by length, each among its own. Axes
    without variance (one distinct vector, or fewer than `components` dimensions) cannot be whitened and have no rows.
    Entries beyond 64 bits count as the nearest such integer. An empty table gives an empty result."""
    rows = _quantise(vectors, scale)
    distinct = stored(rows.select("dim", "x").distinct())
    model = stored(_fit(_scatter(distinct), components).filter(F.size("e") > 0))
    shares = F.transform("e", lambda e: e / F.col("trace"))

    white = _project(distinct.withColumn("vec_id", F.lit(None).cast("long")), model.withColumns({"explained": shares, "identity_error": F.lit(0.0)}))
    pairs = [(i, j) for i in range(components) for j in range(i + 1)]
    spread = white.groupBy("dim").agg(*(F.covar_pop(F.get("whitened", F.lit(i)), F.get("whitened", F.lit(j))).alias(f"c{i}_{j}") for i, j in pairs))
    errors = F.array(*(F.abs(F.col(f"c{i}_{j}") - F.lit(float(i == j))) for i, j in pairs))
    whole = stored(model.join(spread.select("dim", F.array_max(errors).alias("identity_error")), "dim").withColumn("explained", shares))

    each = _project(rows, whole).select("vec_id", "n", "deviation", F.posexplode(F.arrays_zip("whitened", "explained")).alias("k", "z"), "identity_error")
    return each.select("vec_id", (F.col("k") + 1).alias("component"), "n", "deviation", "z.whitened", "z.explained", "identity_error")

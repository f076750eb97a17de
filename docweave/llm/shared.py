"""What several operators of this subpackage need: word hashing in numpy, a
shared folder for intermediate tables, fixed-size bit sets, components.
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: A word is a run of bytes outside space and \t \n \v \f \r. Java syntax.
WORD = r"[^\x20\x09-\x0D]+"

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Texts are hashed in runs of about so many bytes, so that a batch of long texts needs little memory.
_RUN_BYTES = 1 << 18
#: A worker makes pandas frames of about so many bytes of the Arrow batches that it gets.
SLICE_BYTES = 1 << 22


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64's finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _stream(n: int, seed: int) -> np.ndarray:
    return mix((np.arange(n, dtype=np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15))


_BYTE = _stream(256, 1 << 20)
_BASE = np.uint64(0xD1342543DE82EF8B)  # 3 modulo 8
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(str(base))
    if have is None or len(have) < n:
        steps = np.full(max(n, _RUN_BYTES + (1 << 18)), base, np.uint64)
        steps[0] = 1
        have = _powers[str(base)] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def runs(texts: list[str | None]) -> Iterator[tuple[int, int, list[bytes]]]:
    """(first, end, UTF-8 texts) of consecutive runs of a batch; null counts as empty."""
    first, got, size = 0, [], 0
    for i, text in enumerate(texts):
        got.append(b"" if text is None else text.encode("utf-8", "surrogatepass"))
        size += len(got[-1])
        if size >= _RUN_BYTES:
            yield first, i + 1, got
            first, got, size = i + 1, [], 0
    if got:
        yield first, first + len(got), got


def word_hashes(texts: list[bytes], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts, one text after the other, and the
    offsets of each text's words in them. lower: A-Z count as a-z."""
    raw = np.frombuffer(b"\n".join([b"", *texts, b""]), np.uint8)
    space = _SPACE[raw]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    start, end = edge[0::2], edge[1::2]
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[_LOWER[raw] if lower else raw] * _power(_BASE, len(raw)), out=total[1:])
    words = mix((total[end] - total[start]) * _power(_BASE_INV, len(raw))[start] + (end - start).astype(np.uint64))
    at = np.cumsum([1, *(len(t) + 1 for t in texts)])
    return words, np.searchsorted(start, at)


def gram_hashes(words: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hashes of all n consecutive words; the result is n - 1 shorter."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    factor = _stream(n, (seed + 2) << 24) | np.uint64(1)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out += words[k : k + len(out)] * factor[k]
    return mix(out)


def fold(hashes: np.ndarray) -> int:
    """A 64-bit hash of a set of hashes, as a signed integer."""
    total = mix(hashes ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64, keepdims=True)
    return int(mix(total ^ mix(np.array([len(hashes)])))[0].astype(np.int64))


def in_slices(df: DataFrame, rows: Callable, schema: str) -> DataFrame:
    """df.mapInPandas(rows, schema) with frames of about SLICE_BYTES. Spark bounds an Arrow
    batch by bytes (64 MB unless the session says otherwise); Python objects are made of
    one slice of it at a time. Integers stay integers beside nulls."""
    kind = to_arrow_schema(StructType.fromDDL(schema))
    whole = {pa.int64(): pd.Int64Dtype(), pa.int32(): pd.Int32Dtype()}

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            step = max(1, batch.num_rows * SLICE_BYTES // max(batch.nbytes, 1))
            for at in range(0, batch.num_rows, step):
                yield batch.slice(at, step).to_pandas(types_mapper=whole.get)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in rows(frames(batches)):
            yield from pa.Table.from_pandas(frame, kind, preserve_index=False).to_batches()
        _give_back()

    return df.mapInArrow(run, schema)


def _give_back() -> None:
    """Returns freed memory to the system: a worker that has ended a task may stay idle for long."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def shared_path(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share. Only a
    local session may leave that unset, as in tests: it gets a temporary folder."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        top = "file://" + os.path.join(tempfile.gettempdir(), "docweave")
    return f"{top.rstrip('/')}/docweave-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def delete_stored(spark: SparkSession) -> None:
    """Deletes what stored() wrote for this session's application. Frames made of it must have been read."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(os.path.dirname(shared_path(spark)))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of SLICE_BYTES while a job of this module's runs; the session's own limit comes back after it."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(SLICE_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def stored(df: DataFrame, rows_per_file: int = 0) -> DataFrame:
    """The rows written once to the shared folder and read from there: later jobs
    start from files that outlive executors. rows_per_file bounds files of very wide rows."""
    path = shared_path(df.sparkSession)
    with _small_batches(df.sparkSession):
        df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def collect_garbage(spark: SparkSession) -> None:
    """Lets the driver collect what ended rounds have left: plans, results of tasks, broadcasts. An operator of
    very many jobs else grows the driver's heap to its limit, and the shuffle files of ended rounds stay as long."""
    spark._jvm.System.gc()


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many _ before it as keep it apart from the columns of df."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def own_columns(df: DataFrame, *but: str) -> list:
    """The columns of df as they are, whatever characters their names hold, without `but`."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns if c not in but]


def bit_words(df: DataFrame, column: str, log_bits: int, probes: int = 2) -> np.ndarray:
    """A Bloom filter of a long column as at most 2**(log_bits - 6) 64-bit words.
    The size is fixed, so what the driver gathers and broadcasts is bounded;
    with more values only more of the others pass."""
    key = F.col(column)
    bits = F.explode(F.array(*(F.pmod(F.xxhash64(key, F.lit(p)), F.lit(1 << log_bits)) for p in range(probes))))
    words = (
        df.select(bits.alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
        .toPandas()
    )
    out = np.zeros(1 << (log_bits - 6), np.int64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return out


def in_bits(df: DataFrame, column: str, words: np.ndarray, probes: int = 2):
    """Rows whose long column may be in bit_words(); the test runs in numpy."""
    words = df.sparkSession.sparkContext.broadcast(words)
    log_bits = int(words.value.size).bit_length() - 1 + 6

    @F.pandas_udf("boolean")
    def passes(*bits: pd.Series) -> pd.Series:
        ok = np.ones(len(bits[0]), bool)
        for b in bits:
            b = b.to_numpy(np.int64)
            ok &= (words.value[b >> 6] >> (b & 63)) & 1 == 1
        return pd.Series(ok)

    return df.filter(passes(*(F.pmod(F.xxhash64(F.col(column), F.lit(p)), F.lit(1 << log_bits)) for p in range(probes))))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable over edges (a, b), for each
    node of an edge. Nodes alternately hand their smallest neighbour to larger
    and to smaller neighbours; each round is a few shuffles over edges, is
    written to the shared folder, and no node's neighbours are gathered. Edges are read
    several times: those that are not cheap to make are stored() first."""
    edges = edges.filter("a <> b and a is not null and b is not null").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    for _ in range(max_rounds):
        low = edges.groupBy("a").agg(F.min("b").alias("low"))  # a node without smaller neighbours has no row, it is its own smallest
        large = edges.join(low.select(F.col("a").alias("b"), "low"), "b", "left").select("a", F.coalesce("low", "b").alias("b")).unionByName(
            low.select("a", F.col("low").alias("b")))
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
            .unionByName(low.select("a", F.col("low").alias("b")))
            .filter("a <> b").distinct()
        )
        edges = stored(small)
        ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
        )
        # Settled: every node has one edge up, or is the smallest of its component.
        ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        unsettled = ends.agg(F.coalesce(F.max(F.expr("up > 1 or (up = 1 and down = 1)")), F.lit(False))).first()[0]
        collect_garbage(edges.sparkSession)
        if not unsettled:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )

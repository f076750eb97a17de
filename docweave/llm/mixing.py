"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Targets come from water-filling the weights below each source's ceiling. Equal-token
blocks go to sources, then to each source's shards, by highest quotients. Within a
shard, documents lie in a seeded order and a seeded permutation of its blocks picks
what its quota asks for; whole passes come first. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .apportion import sainte_lague
from .shared import WORD, fresh, own_columns

#: Primes above any number of blocks in a shard; a multiplier of the blocks' permutation is one of them.
PRIMES = (2147483659, 2147483693, 2147483713, 2147483743, 2147483777, 2147483783, 2147483813, 2147483857)
#: Shards of a source at the most: one task apportions a source's blocks to its shards.
MOST_SHARDS = 1 << 16


def _placed(
    docs: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, ceiling: int = 2,
    block: int = 64, shard: int = 1 << 17, seed: int = 17,
) -> DataFrame:
    """Every row's place in its shard's seeded order (words start to end), and what the
    shard takes: `passes` whole ones, then `rest` of its n blocks, which are `partial` words."""
    sized = docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = Window.partitionBy(F.lit(0))  # one row a source
    by_name = every.orderBy(F.col("source").asc_nulls_last())
    nth = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))).cast("int")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), nth + 1)
    t = totals.withColumn("weight", weight).withColumn("cap", (ceiling * F.col("source_size")).cast("double"))
    t = t.withColumn("ratio", F.col("cap") / F.col("weight"))
    upto = every.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("want", share * F.sum("source_size").over(every))
    t = t.withColumn("level", (F.col("want") - F.coalesce(F.sum("cap").over(upto), F.lit(0.0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0))))
    # The level of the first source, by ratio, that it leaves below its ceiling; all before it are full.
    level = F.min_by(F.when(F.col("level") <= F.col("ratio"), F.col("level")), F.when(F.col("level") <= F.col("ratio"), F.col("ratio"))).over(every)
    t = t.withColumn("target", F.coalesce(F.least("cap", level * F.col("weight")), F.col("cap")))
    t = t.withColumn("blocks", F.round(F.sum("target").over(every) / block).cast("long"))
    quotas = sainte_lague(t.select("source", "source_size", "target", "blocks"), [], ["source"], "target", "blocks").withColumnRenamed("quota", "source_quota")
    quotas = quotas.withColumn("shards", F.greatest(F.lit(1), F.least(F.ceil(F.col("source_size") / shard), F.lit(MOST_SHARDS))).cast("long"))

    q = quotas.alias("q")
    placed = sized.alias("d").join(q, F.col("d.source").eqNullSafe(F.col("q.source"))).select(
        "d.doc_id", "d.source", "d.size", "q.source_size", "q.target", "q.source_quota",
        F.pmod(F.xxhash64(F.lit(seed), "d.doc_id"), F.col("q.shards")).alias("shard"),
    )
    sums = placed.groupBy("source", "shard", "source_quota").agg(F.sum("size").alias("shard_size"))
    parts = sainte_lague(sums, ["source"], ["shard"], "shard_size", "source_quota").select(
        F.col("source").alias("s"), F.col("shard").alias("k"), F.col("quota"))
    line = Window.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id"), "doc_id", "size")
    placed = (
        placed.withColumn("end", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("shard_size", F.sum("size").over(Window.partitionBy("source", "shard")))
        .join(parts, F.col("source").eqNullSafe(F.col("s")) & (F.col("shard") == F.col("k")))
    )
    n = F.greatest(F.ceil(F.col("shard_size") / block), F.lit(1)).cast("long")
    placed = placed.withColumn("n", n).withColumn("quota", F.least("quota", ceiling * F.col("n")))
    placed = placed.withColumn("passes", F.expr("quota div n")).withColumn("rest", F.expr("quota % n"))
    prime = F.element_at(F.array(*(F.lit(p) for p in PRIMES)), F.pmod(F.xxhash64(F.lit(seed + 2), "source", "shard"), F.lit(len(PRIMES))).cast("int") + 1)
    placed = placed.withColumn("prime", prime).withColumn("turn", F.pmod(F.xxhash64(F.lit(seed + 3), "source", "shard"), F.col("n")))
    placed = placed.withColumn("start", F.col("end") - F.col("size"))
    return placed.withColumn("block", F.lit(block)).withColumn("partial", F.col("rest") * block)


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row of docs (columns doc_id,
    text and source; others are ignored).

    size is the number of words of the text (null: 0). Sources by code point, null
    last, weigh `weights`, repeating, and share `share` times all sizes; a target
    stops at `ceiling` times its source's size and the excess is shared again by
    weight. taken is how many words of the document the mix takes: whole passes, and
    the words of chosen blocks of `block` words. It is at most ceiling * size. The
    choice depends on the rows and the seed alone; equal doc_ids are told apart by size
    only, so repeated rows take places in any order. Rows of null doc_id are one shard of their source, whatever their
    number. Sources without words have target 0. An empty table gives an empty result."""
    placed = _placed(docs, **options)
    some = F.expr(
        """CASE WHEN size = 0 OR rest = 0 THEN 0L ELSE aggregate(
            filter(sequence(start div block, (end - 1) div block), b -> pmod(b * prime + turn, n) < rest), 0L,
            (t, b) -> t + least(end, (b + 1) * block) - greatest(start, b * block)) END"""
    )
    return placed.select(
        "doc_id", "size", "source_size", "target", (F.col("passes") * F.col("size") + some).alias("taken")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """docs as the mix takes them (options as of mix_sources): a document comes once for
    each whole pass of its shard, and once more if its middle word, in the shard's seeded
    order, is among as many words as the pass that is not whole takes. So a shard's kept
    words differ from its quota by half of one document and a block at most. Columns as
    in docs. Documents without words (null and empty texts) stay once; rows that share a
    doc_id come alike. An empty table gives an empty result."""
    again = (F.col("start") + F.col("end") <= 2 * F.col("partial")).cast("int")
    times = F.when(F.col("size") == 0, 1).otherwise(F.col("passes") + again).cast("int")
    name, count, copy = fresh(docs, "taken_id", "taken_times", "taken_copy")
    took = _placed(docs, **options).groupBy(F.col("doc_id").alias(name)).agg(F.max(times).alias(count))
    joined = docs.join(took, F.col("doc_id").eqNullSafe(F.col(name))).filter(F.col(count) > 0)
    return joined.withColumn(copy, F.explode(F.sequence(F.lit(1), count))).select(*own_columns(docs))

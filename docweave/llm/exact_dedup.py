"""Exact dedup by content sort.

Sampled splitters range-partition the normalised texts, each partition sorts its
texts externally, and equal texts, now adjacent, are compared in full by the window
over the sorted rows. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import fresh

#: A group of more copies than this, and than a ten-thousandth of the rows, is spread over SPREAD keys.
HOT_COPIES, SPREAD = 500, 32


def lower_ascii(text: Column) -> Column:
    """A-Z as a-z, all else unchanged."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def exact_groups(docs: DataFrame, keep: str = "largest", partitions: int | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of docs (columns
    doc_id and text; others are ignored).

    Texts are equal when identical after lower-casing A-Z; null counts as empty.
    keep: 'largest' or 'smallest' doc_id stays. Of rows that share text and doc_id
    each counts, and each has kept true where it carries keep_id. A null doc_id is
    never kept unless its whole group has none; keep_id is then null. An empty table gives an empty result.

    A text of very many copies is known from its digest, counted first, and is sorted
    under several salts, so that it spans several partitions; its size and the id that
    stays are aggregated by its full text before any shuffle. Only such texts' digests are broadcast: one
    needs over a ten-thousandth of the rows, so there are fewer than 10,000."""
    best = F.max if keep == "largest" else F.min
    rows = docs.select("doc_id", lower_ascii(F.coalesce("text", F.lit(""))).alias("norm"))
    total = docs.count()
    hot = (
        rows.select(F.xxhash64("norm").alias("h")).groupBy("h").count()
        .filter(F.col("count") > max(HOT_COPIES, total // 10_000)).select("h", F.lit(True).alias("hot"))
    )
    rows = rows.withColumn("h", F.xxhash64("norm")).join(F.broadcast(hot), "h", "left")
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id"), F.lit(SPREAD))).otherwise(-1).alias("salt")
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Splitters are sampled from leading text and a hash, so that long texts do not travel to the driver as samples.
    lead = F.substring("norm", 1, 32).alias("lead")
    ordered = rows.select(lead, "h", salt, "doc_id", "norm").repartitionByRange(n, "lead", "h", "salt").sortWithinPartitions("lead", "h", "salt", "norm")
    same = Window.partitionBy("lead", "h", "salt", "norm")
    found = ordered.select(
        "doc_id", F.sha2("norm", 256).alias("text_sha256"), best("doc_id").over(same).alias("keep_id"), F.count("*").over(same).alias("group_size"),
    )
    whole = (
        rows.filter("hot").groupBy("norm").agg(best("doc_id").alias("k"), F.count("*").alias("g"))
        .select(F.sha2("norm", 256).alias("text_sha256"), "k", "g")
    )
    out = found.select("doc_id", "text_sha256", "keep_id", "group_size").join(F.broadcast(whole), "text_sha256", "left")
    keep_id = F.when(F.col("g").isNotNull(), F.col("k")).otherwise(F.col("keep_id"))
    return out.select(
        "doc_id", keep_id.alias("keep_id"), F.coalesce("g", "group_size").alias("group_size"),
        F.equal_null("doc_id", keep_id).alias("kept"), "text_sha256",
    )


def exact_dedup(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """docs with the rows that exact_groups() keeps, all columns as they are: one row of each
    group of equal texts, or all that share its doc_id and text. Null texts count as empty;
    of a group without any doc_id all rows stay. An empty table gives an empty result."""
    name, digest = fresh(docs, "gone_id", "gone_text")
    gone = exact_groups(docs, keep).filter("not kept").select(F.col("doc_id").alias(name), F.col("text_sha256").alias(digest)).distinct()
    sha = F.sha2(lower_ascii(F.coalesce(F.col("text"), F.lit(""))), 256)
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col(name)) & (sha == F.col(digest)), "left_anti")

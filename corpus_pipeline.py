"""A corpus pipeline of five stages over the documents table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docweave.llm.exact_dedup import exact_dedup
from docweave.llm.language import keep_identified
from docweave.llm.mixing import mixed_documents
from docweave.llm.ngram_join import ngram_dedup
from docweave.llm.packing import pack
from docweave.llm.queries import _vocabulary
from docweave.llm.shared import stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in an identified language."""
    return keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingles."""
    return ngram_dedup(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, packed into sequences."""
    return pack(docs, _vocabulary("word_bpe_49k.json"))


STAGES = [("language", language), ("exact_dedup", exact), ("ngram_join", near), ("mixing", mix), ("packing", packing)]

#: No SQL: language models, the link components and the packing have none.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES over documents; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

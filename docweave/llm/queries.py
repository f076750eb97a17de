"""The thirteen operators as queries over the driver's tables, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_pairs import count_tokens
from .embedding_dedup import near_vectors
from .exact_dedup import exact_groups
from .graph_search import nearest
from .language import predict_languages
from .line_dedup import dedup_lines
from .mixing import mix_sources
from .ngram_join import ngram_components
from .oracles import ORACLE_SQL  # noqa: F401
from .packing import pack
from .periodic_runs import periodic_runs, planted, run_digest
from .substring_dedup import remove_repeats
from .url_filter import filter_urls
from .whitening import whiten


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_read(spark, sf_dir, "embeddings"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(_read(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_read(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_read(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_read(spark, sf_dir, "documents")).drop("kept")


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_read(spark, sf_dir, "documents"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(_read(spark, sf_dir, "pages"), _read(spark, sf_dir, "labels"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_read(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_languages(_read(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(_read(spark, sf_dir, "documents"), least_chars=0)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_read(spark, sf_dir, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digest(periodic_runs(planted(_read(spark, sf_dir, "documents"))))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter("vec_id % 100 = 0"))


QUERIES = {
    f.__name__: f
    for f in (op1_embedding_near_dedup, op2_ngram_jaccard_join, op3_token_counts, op4_best_fit_packing, op5_substring_dedup, op6_mix_sources, op7_url_filters, op8_exact_dedup, op9_language_id, op10_line_dedup, op11_embedding_whitening, op12_periodic_runs, op13_nearest_neighbours)
}

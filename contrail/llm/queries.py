"""Registered queries of the operators; each reads whole tables and returns all rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import (decontaminate, embedding_dedup, html_cut, language_id, license_scan, mixing,
                          ngram_join, prefix_trie, quality_rules, ranked_search, token_count, toxicity, warc_zip)
from contrail.session import apply_settings

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

# --- production parameters of the mixture --------------------------------
# relative weights; nodes that are not listed weigh 1
MIX_WEIGHTS = {"domain": {"hub": 2, "web": 3}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 2}}
MIX_SHARE = (3, 4)
MIX_SEED = 2024


def query(function: Query) -> Query:
    """Register under the function's name."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        apply_settings(spark)
        return function(spark, folder)

    _QUERIES[function.__name__] = run
    return run


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def with_domain(docs: DataFrame) -> DataFrame:
    """The domain of a source: src0 is the hub, other sources are the web."""
    return docs.withColumn("domain", F.when(F.col("source") == "src0", "hub").otherwise("web"))


@query
def op1_ngram_jaccard_join(spark, folder):
    return ngram_join.near_duplicates(table(spark, folder, "documents")).drop("sid")


@query
def op2_source_mixture(spark, folder):
    return mixing.mixture(with_domain(table(spark, folder, "documents")), MIX_WEIGHTS,
                          seed=MIX_SEED, share=MIX_SHARE)


@query
def op3_license_scan(spark, folder):
    return license_scan.license_report(table(spark, folder, "documents"))


@query
def op4_token_counts(spark, folder):
    import public_tokenizers

    return token_count.token_counts(
        table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op5_toxicity(spark, folder):
    return toxicity.toxicity_scores(
        table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op6_benchmark_decontamination(spark, folder):
    return decontaminate.decontamination_report(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op7_html_extraction(spark, folder):
    return html_cut.extract(table(spark, folder, "pages"))


@query
def op8_quality_rules(spark, folder):
    return quality_rules.quality_digest(
        table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op9_language_id(spark, folder):
    return language_id.languages(table(spark, folder, "documents"))


@query
def op10_warc_zip(spark, folder):
    return warc_zip.archive_digest(table(spark, folder, "pages"))


@query
def op11_embedding_near_dedup(spark, folder):
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


@query
def op12_ranked_search(spark, folder):
    return ranked_search.ranked_search(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op13_prefix_trie(spark, folder):
    return prefix_trie.prefix_trie(table(spark, folder, "conversations"))


@query
def pipeline(spark, folder):
    """All stages of the corpus pipeline; it is imported here because it uses this module."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)

"""From raw documents to a training mixture in five stages.

Each stage is written as Parquet and read again by the next one; its decisions
hold for everything that follows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from contrail.llm import decontaminate, mixing, ngram_join, quality_rules, toxicity
from contrail.llm.queries import MIX_SEED, MIX_SHARE, MIX_WEIGHTS, table, with_domain
from contrail.session import apply_settings, cut_lineage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def of_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the certified quality rules keep."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, similarity 0.8."""
    return ngram_join.keep_one(docs, size=5, threshold=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mixture takes of which document in which epoch."""
    return mixing.mixture(with_domain(docs), MIX_WEIGHTS, seed=MIX_SEED, share=MIX_SHARE)


STAGES = [
    ("toxicity", without_toxic),
    ("quality rules", of_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", decontaminated),
    ("source mixture", mixed),
]
# a trained classifier and a graph search are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    apply_settings(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir).select(*COLUMNS))
    return STAGES[-1][1](spark, docs, sf_dir)

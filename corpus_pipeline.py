"""The corpus pipeline: documents to a sharded training mixture, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skytables.llm.budgets import mixed_rows
from skytables.llm.hilbert import hilbert_shards
from skytables.llm.outliers import keep_regular
from skytables.llm.queries import corpus_tree
from skytables.llm.signature_join import drop_near_duplicates
from skytables.llm.winnowing import drop_contaminated
from skytables.session import materialise


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outlier in their language and source."""
    return keep_regular(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return drop_near_duplicates(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten-word span with an item of ``benchmark``."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by target weights: natural shares flattened by a power of 0.9, with the least budget that reads every leaf
    once in whole. No document is lost; those of small leaves may come a second time."""
    return mixed_rows(docs, levels=corpus_tree(), exponent=0.9, max_epochs=2)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with their shard and slot along the Hilbert curve."""
    return hilbert_shards(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("sharding", sharding),
]

# Connected components have no fixed depth, so SQL cannot state the near-duplicate stage; the stages are held against
# brute force in the tests.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each writes its result for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""A training-corpus pipeline over ``documents``: each stage keeps the columns of documents for the next one.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which the caller writes as Parquet and reads back as the
next stage's docs.  ``run`` does so in the shared scratch folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratum.llm import decontaminate, exact_dedup, language_id, mixing, ngram_join
from stratum.llm.common import stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no recognisable language."""
    return language_id.drop_unidentified(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row per group of equal texts."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document per group of near duplicates: five-word shingles, similarity 0.8 or more."""
    return ngram_join.keep_one_per_component(docs, ngram_join.Rule(5, 80, 100))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples documents so that sources, languages and topics reach their target shares."""
    return mixing.sample(docs)


STAGES = [("language", language), ("exact_copies", exact_copies), ("near_copies", near_copies),
          ("benchmark_passages", benchmark_passages), ("mixture", mixture)]

#: The fitted classifier and the seeds cannot be expressed in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

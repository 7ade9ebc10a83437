"""Reading the driver tables.

Parquet is the default format: the reader prunes columns (``ReadSchema``) and
pushes filters (``PushedFilters``) so callers should select/filter right after
``load`` and let Catalyst push both into the scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Load one table; ``columns`` keeps only those (pruned at the scan)."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df

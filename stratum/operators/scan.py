"""Positions and running sums in a global order, without a task that sees a whole group.

Rows are range-partitioned by group and order and stored, so that every later
step sees the same partitions.  Inside a partition a row's place follows from
the sort; across partitions only one row per (partition, group) is summed up:
its counts and sums are the prefix that the next partition starts from.  A group
may therefore hold any share of the table, and no window runs without a bounded
partition key over the rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.session import scratch_path

#: Prefix tables up to so many rows are broadcast; larger ones meet the rows by shuffle.
BROADCAST_ROWS = 100_000


def _stored(df: DataFrame, label: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, f"{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def range_scan(df: DataFrame, group: Sequence[str], order: Sequence[Column], index: str, size: str | None = None,
               sums: Mapping[str, Column] | None = None) -> DataFrame:
    """``df`` with each row's 0-based place in its group (``index``), the group's row count (``size``) and running sums.

    ``order`` should settle ties.  ``sums`` maps a name to the value summed from
    the group's first row up to this one; null values add nothing.  Nulls in
    ``group`` form one group; an empty table stays empty.
    """
    sums = dict(sums or {})
    keys = [*[F.col(g).asc_nulls_first() for g in group], *order]
    rows = df.withColumns({f"_s_{n}": c for n, c in sums.items()}) if sums else df
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_scan_at", F.monotonically_increasing_id())
    rows = _stored(rows, "range-scan").withColumn("_scan_key", F.struct(F.shiftright("_scan_at", 33).alias("pid"), F.struct(F.lit(0), *group).alias("g")))
    counts = rows.groupBy("_scan_key").agg(F.min("_scan_at").alias("first"), F.count(F.lit(1)).alias("c"),
                                      *[F.sum(f"_s_{n}").alias(f"t_{n}") for n in sums])
    whole = Window.partitionBy("_scan_key.g")                   # one row per partition that the group reaches
    before = whole.orderBy("_scan_key.pid").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("_scan_key", (F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("first")).alias("_scan_base"),
                         F.sum("c").over(whole).alias("_scan_size"), *[F.sum(f"t_{n}").over(before).alias(f"_b_{n}") for n in sums])
    base = _stored(base, "range-scan-prefix")
    if base.count() <= BROADCAST_ROWS:
        base = F.broadcast(base)
    out = rows.join(base, "_scan_key").withColumn(index, F.col("_scan_at") + F.col("_scan_base"))
    if sums:
        inside = Window.partitionBy("_scan_key").orderBy("_scan_at").rowsBetween(Window.unboundedPreceding, 0)
        out = out.withColumns({n: F.coalesce(F.col(f"_b_{n}"), F.lit(0)) + F.coalesce(F.sum(f"_s_{n}").over(inside), F.lit(0)) for n in sums})
    cols = [*df.columns, index, *([F.col("_scan_size").alias(size)] if size else []), *sums]
    return out.select(*cols)

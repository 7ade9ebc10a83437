"""Error metrics and rankings: algebraic aggregates, two-pass medians and range scans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.operators.quantiles import grouped_medians
from stratum.operators.scan import range_scan
from stratum.session import cut_lineage


def sq_err(y: str, p: str):
    return F.pow(F.col(y) - F.col(p), 2)


def entity_rmse(df: DataFrame, entity: str, y: str, p: str) -> DataFrame:
    return df.groupBy(entity).agg(F.sqrt(F.avg(sq_err(y, p))).alias("rmse"),
                                  F.count(F.lit(1)).alias("n_rows"))


def pooled_rmse(df: DataFrame, entity: str, y: str, p: str) -> DataFrame:
    """Pooled RMSE over all rows, median of per-entity RMSE, counts."""
    # sums per entity, stored: the pooled figure and the median's two passes read a row per entity
    per = cut_lineage(df.groupBy(entity).agg(F.sum(sq_err(y, p)).alias("_ss"), F.count(sq_err(y, p)).alias("_m"),
                                             F.count(F.lit(1)).alias("_n")))
    pooled = per.agg(F.sqrt(F.sum("_ss") / F.nullif(F.sum("_m"), F.lit(0))).alias("rmse"), F.sum("_n").alias("n_rows"),
                     F.count(F.lit(1)).alias("n_entities"))
    med = grouped_medians(per, [], {"median_entity_rmse": F.sqrt(F.col("_ss") / F.nullif(F.col("_m"), F.lit(0)))})
    return pooled.crossJoin(med).select("rmse", "n_rows", "median_entity_rmse", "n_entities")  # 1 x 1 rows


def best_worst_k(per_entity: DataFrame, entity: str, score: str, k: int = 5) -> DataFrame:
    """k lowest and k highest scores (TakeOrdered on each side; ties by key)."""
    best = per_entity.orderBy(F.col(score).asc(), F.col(entity).asc()).limit(k)
    worst = per_entity.orderBy(F.col(score).desc(), F.col(entity).asc()).limit(k)
    return (best.select(F.lit("best").alias("side"), entity, score)
            .unionByName(worst.select(F.lit("worst").alias("side"), entity, score)))


def accuracy(df: DataFrame, y: str, p: str) -> DataFrame:
    return df.agg(F.avg((F.col(y) == F.col(p)).cast("double")).alias("accuracy"),
                  F.count(F.lit(1)).alias("n_rows"))


def running_share(per_entity: DataFrame, entity: str, err: str) -> DataFrame:
    """Entities by error desc: cumulative share of squared error vs share of entities.

    Rank and running sum come from a range scan, so the number of entities may be large.
    """
    sq = F.pow(F.col(err), 2)
    s = range_scan(per_entity.select(entity, err), [], [F.col(err).desc(), F.col(entity).asc()], "_i", "_n", {"_cum": sq})
    total = s.agg(F.sum(sq).alias("_tot"))               # one row
    return s.crossJoin(F.broadcast(total)).select(
        entity, err, (F.col("_i") + 1).alias("rank"), ((F.col("_i") + 1) / F.col("_n")).alias("entity_share"),
        (F.col("_cum") / F.col("_tot")).alias("sq_err_share"))

"""Equi-joins and set operations as the reference uses them.

Join strategy is left to Catalyst + AQE: a side is broadcast only when it is
a constant-size dimension (explicit hint) or when AQE measures it under the
broadcast threshold at runtime; otherwise the sort-merge plan stays, and AQE
splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_reconcile(expected: DataFrame, preds: DataFrame, key: str) -> DataFrame:
    return expected.join(preds, key, "left")


def inner_suffix(a: DataFrame, b: DataFrame, key: str, suffixes=("_1", "_2")) -> DataFrame:
    """Inner join; columns present on both sides (other than the key) get suffixes."""
    common = (set(a.columns) & set(b.columns)) - {key}
    a2 = a.select(*[F.col(c).alias(c + suffixes[0]) if c in common else F.col(c) for c in a.columns])
    b2 = b.select(*[F.col(c).alias(c + suffixes[1]) if c in common else F.col(c) for c in b.columns])
    return a2.join(b2, key)


def inner_strict(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Inner join plus one aggregate of three counts; ``ok`` iff no row is lost on either side."""
    j = a.join(b, key)
    na = a.agg(F.count(F.lit(1)).alias("n_left"))
    nb = b.agg(F.count(F.lit(1)).alias("n_right"))
    nj = j.agg(F.count(F.lit(1)).alias("n_joined"))
    return na.crossJoin(nb).crossJoin(nj).withColumn(
        "ok", (F.col("n_joined") == F.col("n_left")) & (F.col("n_joined") == F.col("n_right")))


def lookup_map(df: DataFrame, dim: DataFrame, key: str, dim_key: str, value: str, out: str,
               fallback=None, small_dim: bool = False) -> DataFrame:
    """Dictionary lookup with fallback; ``small_dim`` marks a constant-size dimension for broadcast."""
    d = dim.select(F.col(dim_key).alias("_k"), F.col(value).alias("_v"))
    if small_dim:
        d = F.broadcast(d)
    j = df.join(d, df[key] == d["_k"], "left")
    res = F.coalesce(F.col("_v"), F.lit(fallback)) if fallback is not None else F.col("_v")
    return j.withColumn(out, res).drop("_k", "_v")


def feature_join(df: DataFrame, extra: DataFrame, key: str, feat: str, base: str, out: str) -> DataFrame:
    """Left join an extra feature; null -> base value; plus the delta to the base."""
    j = df.join(extra.select(key, feat), key, "left")
    return (j.withColumn(out, F.coalesce(F.col(feat).cast("double"), F.col(base)))
            .withColumn(f"{out}_delta", F.col(out) - F.col(base)))


def semi_overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.join(b.select(key), key, "left_semi")


def anti_extra(preds: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    return preds.join(expected.select(key), key, "left_anti")


def union_tagged(a: DataFrame, b: DataFrame, tag: str = "_src", labels=("tr", "te")) -> DataFrame:
    return (a.withColumn(tag, F.lit(labels[0]))
            .unionByName(b.withColumn(tag, F.lit(labels[1])), allowMissingColumns=True))


def split_tagged(df: DataFrame, tag: str = "_src", labels=("tr", "te")) -> tuple[DataFrame, DataFrame]:
    return (df.filter(F.col(tag) == labels[0]).drop(tag), df.filter(F.col(tag) == labels[1]).drop(tag))


def except_ids(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).subtract(b.select(key))


def intersect_ids(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).intersect(b.select(key))


def prompt_text_join(turns: DataFrame, conv: str, turn: str, text: str, first_turn: int = 0) -> DataFrame:
    """Attach the first-turn text of each conversation to every turn of it."""
    prompts = turns.filter(F.col(turn) == first_turn).select(conv, F.col(text).alias("prompt_text"))
    return turns.join(prompts, conv, "left")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out

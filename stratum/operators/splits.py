"""Leak-controlled splits: stratified folds, group folds, seeded group permutations.

Seeded orders use ``md5(seed || '|' || key)`` so every engine reproduces them.
Positions inside a class are numbered in two levels (class, md5 prefix
chunk): the dominant class of a skewed target is spread over thousands of
tasks instead of one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.operators.sequence import join_by_key, row_index


def seeded_hash(seed, *keys) -> Column:
    parts = [F.lit(str(seed))]
    for k in keys:
        parts += [F.lit("|"), F.col(k).cast("string") if isinstance(k, str) else k.cast("string")]
    return F.md5(F.concat(*parts))


def _position(df: DataFrame, part: str, order: Column, out: str) -> DataFrame:
    df = df.withColumn("_h", order)
    return row_index(df, part, ["_h"], out, chunk=F.substring("_h", 1, 3)).drop("_h")


def stratified_kfold(df: DataFrame, id_col: str, y: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """fold = (position within class in seeded order) mod k."""
    pos = _position(df, y, seeded_hash(seed, id_col), "_p")
    return pos.withColumn(out, (F.col("_p") % k).cast("long")).drop("_p")


def stratified_holdout(df: DataFrame, id_col: str, y: str, frac: float = 0.2, seed: int = 42,
                       max_levels: int = 20, out: str = "is_holdout") -> DataFrame:
    """Seeded holdout of ceil(frac * n) rows per class; unstratified when y has > max_levels values."""
    levels = df.agg(F.countDistinct(y).alias("_lv"))  # one row, stays lazy
    d = df.crossJoin(F.broadcast(levels)).withColumn(
        "_cls", F.when(F.col("_lv") <= max_levels, F.col(y).cast("string")).otherwise(F.lit("all"))).drop("_lv")
    pos = _position(d, "_cls", seeded_hash(seed, id_col), "_p")
    n = pos.groupBy("_cls").agg(F.count(F.lit(1)).alias("_n"))
    pos = join_by_key(pos, n, ["_cls"])      # a null class is a class of its own
    cut = F.ceil(F.col("_n") * F.lit(frac) - F.lit(1e-9))
    return pos.withColumn(out, F.col("_p") < cut).drop("_p", "_n", "_cls")


def group_sizes(df: DataFrame, group: str) -> DataFrame:
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("size"))


def group_kfold(df: DataFrame, group: str, k: int = 5, out: str = "fold") -> DataFrame:
    """Deterministic group folds balanced by size.

    Groups are ranked by (size desc, id) and dealt in a snake order
    (0..k-1, k-1..0, ...).  Returns one row per group; the ranking runs on the
    per-group table, not on the rows.
    """
    g = group_sizes(df, group).withColumn("_all", F.lit(0))
    # global rank over the per-group table, numbered in two levels: chunks follow the order (size
    # descending, id ascending), and ids are cut further so that the commonest size is many chunks
    numeric = isinstance(g.schema[group].dataType, T.NumericType)
    part = F.floor(F.col(group) / 4096) if numeric else F.substring(F.col(group).cast("string"), 1, 6)
    r = row_index(g, "_all", [F.col("size").desc(), F.col(group)], "_r",
                  chunk=F.struct((-F.col("size")).alias("s"), part.alias("p"))).drop("_all")
    q, m = F.floor(F.col("_r") / k), F.col("_r") % k
    return r.select(group, "size", F.when(q % 2 == 0, m).otherwise(F.lit(k - 1) - m).cast("long").alias(out))


def random_group_kfold(df: DataFrame, group: str, k: int = 5, seed: int = 42, repeats: int = 1,
                       out: str = "fold") -> DataFrame:
    """Per repeat: groups permuted by md5(seed|rep|group), fold = position mod k."""
    g = df.select(group).distinct()
    reps = df.sparkSession.range(repeats).select(F.col("id").alias("rep"))
    gr = g.crossJoin(F.broadcast(reps))  # groups x R, R a small constant
    pos = _position(gr, "rep", seeded_hash(seed, "rep", group), "_p")
    return pos.select("rep", group, (F.col("_p") % k).cast("long").alias(out))


def leakage_check(assign: DataFrame, group: str, fold: str) -> DataFrame:
    per = assign.groupBy(group).agg(F.countDistinct(fold).alias("_nf"))
    return per.agg(F.count(F.lit(1)).alias("n_groups"),
                   F.count_if(F.col("_nf") > 1).alias("n_leaky")).withColumn("ok", F.col("n_leaky") == 0)


def cv_summary(scores: DataFrame, fold: str, score: str) -> DataFrame:
    """Per-fold score with the mean and population std over folds (small table)."""
    w = Window.partitionBy()
    return scores.select(fold, score, F.avg(score).over(w).alias("cv_mean"),
                         F.stddev_pop(score).over(w).alias("cv_std"))


def fold_standardize(df: DataFrame, fold: str, cols, min_std: float = 1e-6) -> DataFrame:
    """z-score every row of fold f with mean/std (ddof 0) of the rows outside f.

    One pass: per-fold sums, totals, and train stats = totals - own fold.
    """
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in cols:
        aggs += [F.sum(c).alias(f"_s1_{c}"), F.sum(F.col(c) * F.col(c)).alias(f"_s2_{c}")]
    per = df.groupBy(fold).agg(*aggs)
    w = Window.partitionBy()  # over the per-fold table (k rows)
    st = per.select(fold, *[(F.sum(x).over(w) - F.col(x)).alias(x) for x in per.columns if x != fold])
    sel = [fold]
    for c in cols:
        mean = F.col(f"_s1_{c}") / F.col("_n")
        var = F.greatest(F.col(f"_s2_{c}") / F.col("_n") - mean * mean, F.lit(0.0))
        sd = F.sqrt(var)
        sel += [mean.alias(f"_mu_{c}"), F.when(sd < min_std, F.lit(1.0)).otherwise(sd).alias(f"_sd_{c}")]
    stats = st.select(*sel)
    j = df.join(F.broadcast(stats), fold)  # k rows
    for c in cols:
        j = j.withColumn(f"z_{c}", (F.col(c) - F.col(f"_mu_{c}")) / F.col(f"_sd_{c}")).drop(f"_mu_{c}", f"_sd_{c}")
    return j


def global_standardize(df: DataFrame, cols) -> tuple[DataFrame, DataFrame]:
    """z-score with full-set mean and sample std; returns (scaled, stats) for inversion."""
    stats = df.agg(*[F.avg(c).alias(f"mu_{c}") for c in cols], *[F.stddev_samp(c).alias(f"sd_{c}") for c in cols])
    j = df.crossJoin(F.broadcast(stats))
    for c in cols:
        j = j.withColumn(f"z_{c}", (F.col(c) - F.col(f"mu_{c}")) / F.col(f"sd_{c}"))
    return j.drop(*[x for x in stats.columns]), stats


def global_unstandardize(df: DataFrame, stats: DataFrame, cols) -> DataFrame:
    j = df.crossJoin(F.broadcast(stats))
    for c in cols:
        j = j.withColumn(f"inv_{c}", F.col(f"z_{c}") * F.col(f"sd_{c}") + F.col(f"mu_{c}"))
    return j.drop(*stats.columns)


def oof_target_encode(df: DataFrame, cat: str, target: str, fold: str, out: str) -> DataFrame:
    """Category -> mean target over the other folds; unseen there -> other-fold prior."""
    per = df.groupBy(cat, fold).agg(F.sum(target).alias("_s"), F.count(target).alias("_c"))
    tot = per.groupBy(cat).agg(F.sum("_s").alias("_ts"), F.sum("_c").alias("_tc"))
    fsum = df.groupBy(fold).agg(F.sum(target).alias("_fs"), F.count(target).alias("_fc"))
    allsum = fsum.agg(F.sum("_fs").alias("_as"), F.sum("_fc").alias("_ac"))
    prior = fsum.crossJoin(allsum).select(fold, ((F.col("_as") - F.col("_fs")) /
                                                 F.nullif(F.col("_ac") - F.col("_fc"), F.lit(0))).alias("_prior"))
    j = (df.join(per, [cat, fold], "left").join(tot, cat, "left").join(F.broadcast(prior), fold, "left"))
    num, den = F.col("_ts") - F.col("_s"), F.col("_tc") - F.col("_c")
    return (j.withColumn(out, F.when(den > 0, num / den).otherwise(F.col("_prior")))
            .drop("_s", "_c", "_ts", "_tc", "_prior"))

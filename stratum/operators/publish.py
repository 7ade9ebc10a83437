"""Publishing checks: reconciliation against expected ids, audits, fingerprints, reports.

Every check is a single aggregation producing one row (or one row per
weight); nothing is collected row-by-row to the driver.  The content
fingerprint is order-insensitive (a sum of per-row md5 prefixes), so it is
computed with partial aggregation instead of concatenating the table into a
single string.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions.scalar import finite
from stratum.operators.quantiles import grouped_quantiles


def dedupe_first(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Keep the first row per key by an explicit order (ties broken by the listed columns).

    ``min_by`` over a struct is an algebraic aggregate: partial per task, so a
    key repeated across a third of the table still deduplicates map-side.
    """
    others = [c for c in df.columns if c != key]
    ordkey = F.struct(*[F.col(c) for c in order])
    g = df.groupBy(key).agg(F.min_by(F.struct(*[F.col(c) for c in others]), ordkey).alias("_r"))
    return g.select(key, *[F.col(f"_r.{c}").alias(c) for c in others])


def row_fingerprint(cols: Sequence[str]) -> Column:
    h = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("decimal(38,0)")


def fingerprint(df: DataFrame, cols: Sequence[str]) -> Column:
    """Order-insensitive content hash (aggregate expression)."""
    return F.sum(row_fingerprint(cols)).cast("string")


def reconcile_submission(expected: DataFrame, preds: DataFrame, id_col: str, value: str,
                         order: Sequence[str], fallback: DataFrame) -> DataFrame:
    """dedupe -> left join expected -> fill missing with the training fallback -> counts.

    ``fallback`` is one row with column ``fallback`` (see ``global_fallback``): a
    statistic of the training data, so that what is filled in does not depend
    on which predictions happened to arrive.

    Returns one row per expected id: value, ``filled`` flag, and the report
    columns n_expected, n_missing, n_extra, n_dupes, ok (same on every row).
    """
    dd = dedupe_first(preds.select(id_col, value, *[c for c in order if c not in (id_col, value)]), id_col, order)
    fallback = fallback.select(F.col("fallback").cast("double").alias("_fb"))
    j = expected.select(id_col).join(dd.select(id_col, value), id_col, "left")
    extra = dd.join(expected.select(id_col), id_col, "left_anti").agg(F.count(F.lit(1)).alias("n_extra"))
    dupes = preds.agg((F.count(F.lit(1)) - F.countDistinct(id_col)).alias("n_dupes"))
    out = (j.crossJoin(F.broadcast(fallback))
           .withColumn("filled", F.col(value).isNull())
           .withColumn(value, F.coalesce(F.col(value).cast("double"), F.col("_fb"))).drop("_fb"))
    rep = (out.agg(F.count(F.lit(1)).alias("n_expected"), F.count_if("filled").alias("n_missing"),
                   F.count_if(F.col(value).isNull()).alias("_n_null"))
           .crossJoin(extra).crossJoin(dupes))
    rep = rep.withColumn("ok", F.col("_n_null") == 0).drop("_n_null")
    return out.crossJoin(F.broadcast(rep))


def global_fallback(df: DataFrame, entity: str, value: str) -> DataFrame:
    return df.groupBy(entity).agg(F.avg(value).alias("_m")).agg(F.avg("_m").alias("fallback"))


def assert_no_nulls(df: DataFrame) -> DataFrame:
    """Null count per table (one pass): n_null and ok."""
    total = sum(F.count_if(F.col(c).isNull()) for c in df.columns)
    return df.agg(total.cast("long").alias("n_null"), F.count(F.lit(1)).alias("n_rows")).withColumn(
        "ok", F.col("n_null") == 0)


def validate_frame(df: DataFrame, id_col: str, value: str, required: Sequence[str]) -> DataFrame:
    """Required columns present, id as string / value as double, all values finite."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        return df.sparkSession.createDataFrame(
            [(0, 0, False, ",".join(missing))], "n_rows long, n_nonfinite long, ok boolean, missing string")
    v = df.select(F.col(id_col).cast("string").alias("id"), F.col(value).cast("double").alias("v"))
    return (v.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~finite("v")).alias("n_nonfinite"))
            .withColumn("ok", F.col("n_nonfinite") == 0).withColumn("missing", F.lit("")))


def audit_output(df: DataFrame, expected: DataFrame, id_col: str, value: str) -> DataFrame:
    """columns, rows, id sets equal, finite, min/max/mean/std (ddof 0), fingerprint."""
    v = F.col(value).cast("double")
    stats = df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(id_col).alias("n_ids"),
                   F.count_if(~finite(v)).alias("n_nonfinite"), F.min(v).alias("min"), F.max(v).alias("max"),
                   F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"),
                   fingerprint(df, [id_col, value]).alias("fingerprint"))
    a = df.select(id_col).distinct()
    b = expected.select(id_col).distinct()
    diff = (a.join(b, id_col, "left_anti").agg(F.count(F.lit(1)).alias("_x"))
            .crossJoin(b.join(a, id_col, "left_anti").agg(F.count(F.lit(1)).alias("_y"))))
    return (stats.crossJoin(diff).withColumn("n_columns", F.lit(len(df.columns)).cast("long"))
            .withColumn("ids_match", (F.col("_x") == 0) & (F.col("_y") == 0)).drop("_x", "_y"))


def cross_weights(df: DataFrame, weights: Sequence[float], col: str = "w") -> DataFrame:
    """Every row x every candidate weight (the weight list is a small constant)."""
    wdf = df.sparkSession.createDataFrame([(float(w),) for w in weights], f"{col} double")
    return df.crossJoin(F.broadcast(wdf))


def blend_report(df: DataFrame, a: str, b: str, baseline: str, weights: Sequence[float]) -> DataFrame:
    """Per weight w of blend = w*a + (1-w)*b: rows, mean, std (ddof 1), RMSE vs baseline, p95 |diff|."""
    x = cross_weights(df, weights).withColumn("_p", F.col("w") * F.col(a) + (1 - F.col("w")) * F.col(b))
    d = F.col("_p") - F.col(baseline)
    stats = x.groupBy("w").agg(F.count(F.lit(1)).alias("n_rows"), F.avg("_p").alias("mean"),
                               F.stddev_samp("_p").alias("std"), F.sqrt(F.avg(d * d)).alias("rmse_vs_base"))
    return stats.join(grouped_quantiles(x, ["w"], {"p95_abs_diff": (F.abs(d), 0.95)}), "w")


def run_leaderboard(runs: DataFrame, keys: Sequence[str], score: str, higher_is_better: bool = True) -> DataFrame:
    best = F.max(score) if higher_is_better else F.min(score)
    return runs.filter(F.col(score).isNotNull()).groupBy(*keys).agg(best.alias("best_score"),
                                                                    F.count(F.lit(1)).alias("n_runs"))


def score_trajectory(runs: DataFrame, loop: str, score: str, higher_is_better: bool = True) -> DataFrame:
    """Best score per loop and the running best up to that loop (one row per loop)."""
    from pyspark.sql import Window
    best = F.max(score) if higher_is_better else F.min(score)
    per = runs.groupBy(loop).agg(best.alias("best_score"))
    w = Window.orderBy(loop).rowsBetween(Window.unboundedPreceding, 0)  # one row per loop
    run = F.max("best_score") if higher_is_better else F.min("best_score")
    return per.withColumn("running_best", run.over(w))


def finalist_gap(runs: DataFrame, key: str, cv: str, holdout: str, higher_is_better: bool = True) -> DataFrame:
    """CV vs holdout per finalist; rank on holdout, ties by CV then key."""
    from pyspark.sql import Window
    o = (lambda c: F.col(c).desc()) if higher_is_better else (lambda c: F.col(c).asc())
    return runs.select(key, cv, holdout, (F.col(cv) - F.col(holdout)).alias("gap"),
                       F.rank().over(Window.orderBy(o(holdout), o(cv), F.col(key))).cast("long").alias("holdout_rank"),
                       F.rank().over(Window.orderBy(o(cv), F.col(key))).cast("long").alias("cv_rank"))

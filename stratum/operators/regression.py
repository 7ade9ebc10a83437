"""Per-entity regressions expressed as grouped moments.

Every fit is one ``groupBy`` of algebraic aggregates (``avg``, ``var_pop``,
``covar_pop``, ``regr_*``): Spark computes them map-side (partial
aggregation), so a hot entity never lands whole in one task.  Closed-form
solves then run as column expressions on the small coefficient table, which
is joined back (AQE turns that join into a broadcast after measuring it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ols2_coefficients(known: DataFrame, entity: str, x1: str, x2: str, y: str) -> DataFrame:
    """OLS ``y = a*x1 + b*x2 + c`` per entity.

    Singular design (|det| tiny relative to the variances) falls back to the
    simple regression on ``x1``; fewer than 2 rows or no variance in ``x1``
    falls back to the mean of ``y``.
    """
    m = known.groupBy(entity).agg(
        F.count(y).alias("_nk"), F.avg(x1).alias("_m1"), F.avg(x2).alias("_m2"), F.avg(y).alias("_my"),
        F.var_pop(x1).alias("_v11"), F.var_pop(x2).alias("_v22"), F.covar_pop(x1, x2).alias("_v12"),
        F.covar_pop(x1, y).alias("_c1"), F.covar_pop(x2, y).alias("_c2"))
    det = F.col("_v11") * F.col("_v22") - F.col("_v12") * F.col("_v12")
    full = (F.col("_nk") >= 2) & (det > F.lit(1e-12) * F.col("_v11") * F.col("_v22")) & (det > 0)
    simple = (F.col("_nk") >= 2) & (F.col("_v11") > 0)
    a = (F.when(full, (F.col("_c1") * F.col("_v22") - F.col("_c2") * F.col("_v12")) / det)
         .when(simple, F.col("_c1") / F.col("_v11")).otherwise(F.lit(0.0)))
    b = F.when(full, (F.col("_c2") * F.col("_v11") - F.col("_c1") * F.col("_v12")) / det).otherwise(F.lit(0.0))
    m = m.withColumn("a", a).withColumn("b", b)
    m = m.withColumn("c", F.col("_my") - F.col("a") * F.col("_m1") - F.col("b") * F.col("_m2"))
    return m.select(entity, "a", "b", "c", F.col("_nk").alias("n_known"))


def group_ols_2(df: DataFrame, entity: str, x1: str, x2: str, y: str, known: Column | str,
                out: str = "pred") -> DataFrame:
    """Fit on known rows of each entity, predict its eval rows."""
    kcol = F.col(known) if isinstance(known, str) else known
    coef = ols2_coefficients(df.filter(kcol), entity, x1, x2, y)
    ev = df.filter(~kcol)
    pred = F.col("a") * F.col(x1) + F.col("b") * F.col(x2) + F.col("c")
    return ev.join(coef, entity, "left").withColumn(out, pred).drop("a", "b", "c", "n_known")


def group_slope(df: DataFrame, entity: str, x: str, y: str, out: str = "slope",
                min_rows: int = 2, min_std: float = 1e-6) -> DataFrame:
    """Degree-1 slope of y on x over finite pairs; <min_rows or std(x)<min_std -> 0."""
    ok = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(x) & ~F.isnan(y))
    g = ok.groupBy(entity).agg(F.count(F.lit(1)).alias("_n"), F.stddev_pop(x).alias("_sx"),
                               F.regr_slope(y, x).alias("_s"))
    return g.select(entity, F.when((F.col("_n") >= min_rows) & (F.col("_sx") >= min_std), F.col("_s"))
                    .otherwise(F.lit(0.0)).alias(out))

"""Per-entity linear prior: mask split -> OLS -> per-entity and pooled RMSE."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratum.operators import metrics, regression
from stratum.plans import views
from stratum.plans.registry import register


def prior_predictions(spark, sf_dir):
    s = views.seq(spark, sf_dir)
    return regression.group_ols_2(s, "entity", "pos", "k", "y_in", "known", "pred")


@register("mask_split", sql="""
SELECT entity, i, CASE WHEN y_in IS NULL THEN 'eval' ELSE 'known' END AS zone FROM seq""")
def q_mask_split(spark, sf_dir):
    s = views.seq(spark, sf_dir)
    return s.select("entity", "i", F.when(F.col("y_in").isNull(), "eval").otherwise("known").alias("zone"))


# Oracle: the same closed form written independently over DuckDB moments.
OLS_SQL = """
mom AS (
  SELECT entity, count(y_in) AS nk, avg(pos) AS m1, avg(k) AS m2, avg(y_in) AS my,
         var_pop(pos) AS v11, var_pop(k) AS v22, covar_pop(pos, k) AS v12,
         covar_pop(pos, y_in) AS c1, covar_pop(k, y_in) AS c2
  FROM seq WHERE known GROUP BY entity),
co AS (
  SELECT entity, m1, m2, my,
         CASE WHEN nk >= 2 AND v11 * v22 - v12 * v12 > 1e-12 * v11 * v22 AND v11 * v22 - v12 * v12 > 0
              THEN (c1 * v22 - c2 * v12) / (v11 * v22 - v12 * v12)
              WHEN nk >= 2 AND v11 > 0 THEN c1 / v11 ELSE 0.0 END AS a,
         CASE WHEN nk >= 2 AND v11 * v22 - v12 * v12 > 1e-12 * v11 * v22 AND v11 * v22 - v12 * v12 > 0
              THEN (c2 * v11 - c1 * v12) / (v11 * v22 - v12 * v12) ELSE 0.0 END AS b
  FROM mom),
pr AS (
  SELECT s.entity, s.i, s.sig, co.a * s.pos + co.b * s.k + (co.my - co.a * co.m1 - co.b * co.m2) AS pred
  FROM seq AS s LEFT JOIN co ON s.entity = co.entity WHERE NOT s.known)"""


@register("group_ols_2", dbl=["pred"], sql=f"WITH {OLS_SQL} SELECT entity, i, pred FROM pr")
def q_group_ols_2(spark, sf_dir):
    return prior_predictions(spark, sf_dir).select("entity", "i", "pred")


@register("entity_rmse", dbl=["rmse"], sql=f"""
WITH {OLS_SQL} SELECT entity, sqrt(avg((sig - pred) * (sig - pred))) AS rmse, count(*) AS n_rows
FROM pr GROUP BY entity""")
def q_entity_rmse(spark, sf_dir):
    return metrics.entity_rmse(prior_predictions(spark, sf_dir), "entity", "sig", "pred")


@register("pooled_rmse", dbl=["rmse", "median_entity_rmse"], sql=f"""
WITH {OLS_SQL},
per AS (SELECT entity, sqrt(avg((sig - pred) * (sig - pred))) AS r FROM pr GROUP BY entity)
SELECT (SELECT sqrt(avg((sig - pred) * (sig - pred))) FROM pr) AS rmse,
       (SELECT count(*) FROM pr) AS n_rows,
       (SELECT median(r) FROM per) AS median_entity_rmse,
       (SELECT count(*) FROM per) AS n_entities""")
def q_pooled_rmse(spark, sf_dir):
    return metrics.pooled_rmse(prior_predictions(spark, sf_dir), "entity", "sig", "pred")


@register("best_worst_k", stored=True, dbl=["rmse"], sql=f"""
WITH {OLS_SQL},
per AS (SELECT entity, round(sqrt(avg((sig - pred) * (sig - pred))) + 1e-9, 6) AS rmse FROM pr GROUP BY entity)
(SELECT 'best' AS side, entity, rmse FROM per ORDER BY rmse ASC, entity ASC LIMIT 5)
UNION ALL
(SELECT 'worst' AS side, entity, rmse FROM per ORDER BY rmse DESC, entity ASC LIMIT 5)""")
def q_best_worst_k(spark, sf_dir):
    per = metrics.entity_rmse(prior_predictions(spark, sf_dir), "entity", "sig", "pred")
    per = per.withColumn("rmse", F.round(F.col("rmse") + F.lit(1e-9), 6))
    return metrics.best_worst_k(per, "entity", "rmse", 5)

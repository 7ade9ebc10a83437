"""Reconciliation, audits, blend reports and run-log reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratum.operators import publish as PB
from stratum.plans import views
from stratum.plans.registry import register
from stratum.sources.tables import load


def _preds(spark, sf):
    """Predictions with duplicates (toxic rows repeated, flipped, later source) and extras."""
    lab = load(spark, sf, "labels", ["doc_id", "quality", "toxic"])
    base = lab.select("doc_id", F.col("quality").cast("double").alias("pred"), F.lit(0).alias("src"))
    dup = lab.filter("toxic = 1").select("doc_id", (1 - F.col("quality")).cast("double").alias("pred"), F.lit(1).alias("src"))
    extra = lab.filter("toxic = 1").select((F.col("doc_id") + 1000000).alias("doc_id"),
                                           F.col("quality").cast("double").alias("pred"), F.lit(0).alias("src"))
    return base.unionByName(dup).unionByName(extra)


PREDS_SQL = """
pr AS (SELECT doc_id, CAST(quality AS DOUBLE) AS pred, 0 AS src FROM labels
       UNION ALL SELECT doc_id, CAST(1 - quality AS DOUBLE), 1 FROM labels WHERE toxic = 1
       UNION ALL SELECT doc_id + 1000000, CAST(quality AS DOUBLE), 0 FROM labels WHERE toxic = 1),
dd AS (SELECT doc_id, pred FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY src) AS r FROM pr) AS t WHERE r = 1)"""


@register("reconcile_submission", dbl=["pred"], sql=f"""
WITH {PREDS_SQL},
fb AS (SELECT avg(m) AS fb FROM (SELECT source, avg(quality) AS m FROM docs WHERE is_train GROUP BY source) AS _t),
j AS (SELECT d.doc_id, dd.pred AS p0 FROM documents AS d LEFT JOIN dd ON d.doc_id = dd.doc_id),
o AS (SELECT doc_id, coalesce(p0, fb) AS pred, p0 IS NULL AS filled FROM j CROSS JOIN fb)
SELECT doc_id, pred, filled, (SELECT count(*) FROM o) AS n_expected, (SELECT count(*) FILTER (WHERE filled) FROM o) AS n_missing,
       (SELECT count(*) FROM dd WHERE doc_id NOT IN (SELECT doc_id FROM documents)) AS n_extra,
       (SELECT count(*) - count(DISTINCT doc_id) FROM pr) AS n_dupes,
       (SELECT count(*) FILTER (WHERE pred IS NULL) FROM o) = 0 AS ok
FROM o""")
def q_reconcile_submission(spark, sf):
    exp = load(spark, sf, "documents", ["doc_id"])
    train = views.docs(spark, sf).filter("is_train")
    return PB.reconcile_submission(exp, _preds(spark, sf), "doc_id", "pred", ["src"],
                                   PB.global_fallback(train, "source", "quality"))


@register("global_fallback", dbl=["fallback"], sql="""
SELECT avg(m) AS fallback FROM (SELECT user_id, avg(value) AS m FROM events GROUP BY user_id) AS t""")
def q_global_fallback(spark, sf):
    return PB.global_fallback(load(spark, sf, "events", ["user_id", "value"]), "user_id", "value")


@register("assert_no_nulls", sql="""
SELECT CAST(count(*) FILTER (WHERE doc_id IS NULL) + count(*) FILTER (WHERE lang IS NULL) + count(*) FILTER (WHERE source IS NULL)
       + count(*) FILTER (WHERE n_chars IS NULL) + count(*) FILTER (WHERE quality IS NULL) + count(*) FILTER (WHERE toxic IS NULL) AS BIGINT) AS n_null,
       count(*) AS n_rows,
       count(*) FILTER (WHERE doc_id IS NULL) + count(*) FILTER (WHERE lang IS NULL) + count(*) FILTER (WHERE source IS NULL)
       + count(*) FILTER (WHERE n_chars IS NULL) + count(*) FILTER (WHERE quality IS NULL) + count(*) FILTER (WHERE toxic IS NULL) = 0 AS ok
FROM docs""")
def q_assert_no_nulls(spark, sf):
    return PB.assert_no_nulls(views.docs(spark, sf).select("doc_id", "lang", "source", "n_chars", "quality", "toxic"))


@register("validate_frame", sql="""
SELECT count(*) AS n_rows, count(*) FILTER (WHERE NOT (CAST(quality AS DOUBLE) IS NOT NULL AND isfinite(CAST(quality AS DOUBLE)))) AS n_nonfinite,
       count(*) FILTER (WHERE NOT (CAST(quality AS DOUBLE) IS NOT NULL AND isfinite(CAST(quality AS DOUBLE)))) = 0 AS ok, '' AS missing
FROM labels""")
def q_validate_frame(spark, sf):
    return PB.validate_frame(load(spark, sf, "labels"), "doc_id", "quality", ["doc_id", "quality"])


@register("audit_output", dbl=["min", "max", "mean", "std"], sql="""
WITH s AS (SELECT count(*) AS n_rows, count(DISTINCT doc_id) AS n_ids,
                  count(*) FILTER (WHERE NOT isfinite(CAST(quality AS DOUBLE))) AS n_nonfinite,
                  min(CAST(quality AS DOUBLE)) AS min, max(CAST(quality AS DOUBLE)) AS max, avg(CAST(quality AS DOUBLE)) AS mean,
                  stddev_pop(CAST(quality AS DOUBLE)) AS std,
                  CAST(sum(CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '|' || CAST(quality AS VARCHAR)), 1, 15)) AS BIGINT)::HUGEINT) AS VARCHAR) AS fingerprint
           FROM labels)
SELECT s.*, CAST(3 AS BIGINT) AS n_columns,
       (SELECT count(*) FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)) = 0
       AND (SELECT count(*) FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)) = 0 AS ids_match
FROM s""")
def q_audit_output(spark, sf):
    lab = load(spark, sf, "labels")
    return PB.audit_output(lab, load(spark, sf, "documents", ["doc_id"]), "doc_id", "quality")


@register("blend_report", dbl=["w", "mean", "std", "rmse_vs_base", "p95_abs_diff"], sql="""
WITH x AS (SELECT w.w, w.w * (l_extendedprice / l_quantity) + (1 - w.w) * (l_extendedprice / l_quantity * (1 - l_discount)) AS p,
                  l_extendedprice / l_quantity * (1 - l_discount) * (1 + l_tax) AS base
           FROM lineitem CROSS JOIN (VALUES (0.0), (0.3), (0.55), (0.7), (1.0)) AS w(w))
SELECT w, count(*) AS n_rows, avg(p) AS mean, stddev_samp(p) AS std, sqrt(avg((p - base) * (p - base))) AS rmse_vs_base,
       quantile_cont(abs(p - base), 0.95) AS p95_abs_diff FROM x GROUP BY w""")
def q_blend_report(spark, sf):
    li = load(spark, sf, "lineitem", ["l_extendedprice", "l_quantity", "l_discount", "l_tax"])
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    li = li.select(unit.alias("a"), (unit * (1 - F.col("l_discount"))).alias("b"),
                   (unit * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("base"))
    return PB.blend_report(li, "a", "b", "base", [0.0, 0.3, 0.55, 0.7, 1.0])


@register("run_leaderboard", stored=True, dbl=["best_score"], sql="""
SELECT stage, variant, model_family, min(cv_mean) AS best_score, count(*) AS n_runs FROM runs
WHERE cv_mean IS NOT NULL GROUP BY stage, variant, model_family""")
def q_run_leaderboard(spark, sf):
    return PB.run_leaderboard(views.runs(spark, sf), ["stage", "variant", "model_family"], "cv_mean", higher_is_better=False)


@register("score_trajectory", stored=True, dbl=["best_score", "running_best"], sql="""
WITH p AS (SELECT loop, min(cv_mean) AS best_score FROM runs GROUP BY loop)
SELECT loop, best_score, min(best_score) OVER (ORDER BY loop ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_best FROM p""")
def q_score_trajectory(spark, sf):
    return PB.score_trajectory(views.runs(spark, sf), "loop", "cv_mean", higher_is_better=False)


@register("finalist_gap", stored=True, dbl=["cv", "holdout", "gap"], sql="""
WITH f AS (SELECT variant, avg(cv_mean) AS cv, avg(holdout_score) AS holdout FROM runs GROUP BY variant)
SELECT variant, cv, holdout, cv - holdout AS gap,
       rank() OVER (ORDER BY round(holdout + 1e-9, 6) ASC, round(cv + 1e-9, 6) ASC, variant) AS holdout_rank,
       rank() OVER (ORDER BY round(cv + 1e-9, 6) ASC, variant) AS cv_rank FROM f""")
def q_finalist_gap(spark, sf):
    r = views.runs(spark, sf).groupBy("variant").agg(F.avg("cv_mean").alias("cv"), F.avg("holdout_score").alias("holdout"))
    r = r.withColumn("cv", F.round(F.col("cv") + F.lit(1e-9), 6)).withColumn("holdout", F.round(F.col("holdout") + F.lit(1e-9), 6))
    return PB.finalist_gap(r, "variant", "cv", "holdout", higher_is_better=False)


@register("fold_score_table", stored=True, dbl=["m_last", "m_mean", "m_ols"], sql="""
SELECT fold, max(CASE WHEN model = 'last' THEN rmse END) AS m_last, max(CASE WHEN model = 'mean' THEN rmse END) AS m_mean,
       max(CASE WHEN model = 'ols' THEN rmse END) AS m_ols FROM fold_scores GROUP BY fold""")
def q_fold_score_table(spark, sf):
    fs = views.fold_scores(spark, sf)
    p = fs.groupBy("fold").pivot("model", ["last", "mean", "ols"]).agg(F.first("rmse"))
    p = p.withColumnsRenamed({"last": "m_last", "mean": "m_mean", "ols": "m_ols"})
    return p.orderBy(F.col("m_ols") + F.col("m_last") + F.col("m_mean"))


@register("constant_baseline", dbl=["accuracy"], sql="""
SELECT avg(CAST(quality = 0 AS DOUBLE)) AS accuracy, count(*) AS n_rows FROM labels""")
def q_constant_baseline(spark, sf):
    from stratum.operators.metrics import accuracy
    return accuracy(load(spark, sf, "labels", ["quality"]).withColumn("p", F.lit(0)), "quality", "p")


@register("rule_baseline", dbl=["accuracy"], sql="""
SELECT avg(CAST(quality = CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS DOUBLE)) AS accuracy, count(*) AS n_rows FROM docs WHERE is_train""")
def q_rule_baseline(spark, sf):
    from stratum.operators.metrics import accuracy
    d = views.docs(spark, sf).filter("is_train").withColumn("p", F.when(F.col("lang") == "en", 1).otherwise(0))
    return accuracy(d, "quality", "p")

"""Leak-controlled splits and cross-validation summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratum.operators import splits as SP
from stratum.plans import views
from stratum.plans.registry import register
from stratum.sources.tables import load

GROUP_KFOLD_SQL = """
gs AS (SELECT user_id AS g, count(*) AS sz FROM events GROUP BY user_id),
gr AS (SELECT g, sz, row_number() OVER (ORDER BY sz DESC, g) - 1 AS r FROM gs),
gf AS (SELECT g, sz, CASE WHEN (r // 5) % 2 = 0 THEN r % 5 ELSE 4 - r % 5 END AS fold FROM gr)"""


@register("stratified_kfold", sql="""
SELECT doc_id, quality, (row_number() OVER (PARTITION BY quality ORDER BY md5('42|' || CAST(doc_id AS VARCHAR))) - 1) % 5 AS fold
FROM labels""")
def q_stratified_kfold(spark, sf):
    return SP.stratified_kfold(load(spark, sf, "labels", ["doc_id", "quality"]), "doc_id", "quality", 5, 42)


@register("stratified_holdout", sql="""
WITH p AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5('42|' || CAST(doc_id AS VARCHAR))) - 1 AS p,
                  count(*) OVER (PARTITION BY quality) AS n FROM labels)
SELECT doc_id, quality, p < ceil(n * 0.2 - 1e-9) AS is_holdout FROM p""")
def q_stratified_holdout(spark, sf):
    return SP.stratified_holdout(load(spark, sf, "labels", ["doc_id", "quality"]), "doc_id", "quality", 0.2, 42)


@register("group_kfold", sql=f"WITH {GROUP_KFOLD_SQL} SELECT g AS user_id, sz AS size, fold FROM gf")
def q_group_kfold(spark, sf):
    return SP.group_kfold(load(spark, sf, "events", ["user_id"]), "user_id", 5)


@register("random_group_kfold", sql="""
WITH g AS (SELECT DISTINCT user_id FROM events), r AS (SELECT range AS rep FROM range(3))
SELECT rep, user_id, (row_number() OVER (PARTITION BY rep ORDER BY md5('42|' || CAST(rep AS VARCHAR) || '|' || CAST(user_id AS VARCHAR))) - 1) % 5 AS fold
FROM g CROSS JOIN r""")
def q_random_group_kfold(spark, sf):
    return SP.random_group_kfold(load(spark, sf, "events", ["user_id"]), "user_id", 5, 42, repeats=3)


@register("leakage_check", sql=f"""
WITH {GROUP_KFOLD_SQL},
rows_f AS (SELECT e.user_id, gf.fold FROM events AS e JOIN gf ON e.user_id = gf.g),
per AS (SELECT user_id, count(DISTINCT fold) AS nf FROM rows_f GROUP BY user_id)
SELECT count(*) AS n_groups, count(*) FILTER (WHERE nf > 1) AS n_leaky, count(*) FILTER (WHERE nf > 1) = 0 AS ok FROM per""")
def q_leakage_check(spark, sf):
    e = load(spark, sf, "events", ["user_id"])
    assign = e.join(SP.group_kfold(e, "user_id", 5).select("user_id", "fold"), "user_id")
    return SP.leakage_check(assign, "user_id", "fold")


@register("cv_summary", stored=True, dbl=["rmse", "cv_mean", "cv_std"], sql="""
SELECT fold, rmse, avg(rmse) OVER () AS cv_mean, stddev_pop(rmse) OVER () AS cv_std FROM fold_scores WHERE model = 'ols'""")
def q_cv_summary(spark, sf):
    fs = views.fold_scores(spark, sf).filter(F.col("model") == "ols")
    return SP.cv_summary(fs, "fold", "rmse")


def _lineitem_folds(spark, sf):
    li = load(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice"])
    f = SP.group_kfold(li, "l_suppkey", 5).select("l_suppkey", "fold")
    return li.join(f, "l_suppkey")


LI_FOLDS_SQL = """
gs AS (SELECT l_suppkey AS g, count(*) AS sz FROM lineitem GROUP BY l_suppkey),
gr AS (SELECT g, row_number() OVER (ORDER BY sz DESC, g) - 1 AS r FROM gs),
gf AS (SELECT g, CASE WHEN (r // 5) % 2 = 0 THEN r % 5 ELSE 4 - r % 5 END AS fold FROM gr),
lf AS (SELECT l.*, gf.fold FROM lineitem AS l JOIN gf ON l.l_suppkey = gf.g)"""


@register("fold_standardize", dbl=["z_l_quantity", "z_l_extendedprice"], sql=f"""
WITH {LI_FOLDS_SQL},
st AS (SELECT f.fold, avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_extendedprice) AS mp, stddev_pop(l_extendedprice) AS sp
       FROM (SELECT DISTINCT fold FROM lf) AS f JOIN lf ON lf.fold <> f.fold GROUP BY f.fold)
SELECT lf.l_orderkey, lf.l_linenumber, lf.fold,
       (l_quantity - mq) / CASE WHEN sq < 1e-6 THEN 1.0 ELSE sq END AS z_l_quantity,
       (l_extendedprice - mp) / CASE WHEN sp < 1e-6 THEN 1.0 ELSE sp END AS z_l_extendedprice
FROM lf JOIN st ON lf.fold = st.fold""")
def q_fold_standardize(spark, sf):
    r = SP.fold_standardize(_lineitem_folds(spark, sf), "fold", ["l_quantity", "l_extendedprice"])
    return r.select("l_orderkey", "l_linenumber", "fold", "z_l_quantity", "z_l_extendedprice")


@register("global_standardize", dbl=["z_l_quantity", "inv_l_quantity"], sql="""
WITH s AS (SELECT avg(l_quantity) AS m, stddev_samp(l_quantity) AS sd FROM lineitem)
SELECT l_orderkey, l_linenumber, (l_quantity - m) / sd AS z_l_quantity, ((l_quantity - m) / sd) * sd + m AS inv_l_quantity
FROM lineitem CROSS JOIN s""")
def q_global_standardize(spark, sf):
    li = load(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"])
    z, stats = SP.global_standardize(li, ["l_quantity"])
    return SP.global_unstandardize(z, stats, ["l_quantity"]).select(
        "l_orderkey", "l_linenumber", "z_l_quantity", "inv_l_quantity")


@register("oof_target_encode", dbl=["source_te"], sql="""
WITH d AS (SELECT doc_id, source, quality FROM docs WHERE is_train),
f AS (SELECT d.*, (row_number() OVER (PARTITION BY quality ORDER BY md5('42|' || CAST(doc_id AS VARCHAR))) - 1) % 5 AS fold FROM d)
SELECT a.doc_id, a.fold,
       coalesce((SELECT avg(b.quality) FROM f AS b WHERE b.source = a.source AND b.fold <> a.fold),
                (SELECT avg(c.quality) FROM f AS c WHERE c.fold <> a.fold)) AS source_te
FROM f AS a""")
def q_oof_target_encode(spark, sf):
    d = views.docs(spark, sf).filter("is_train").select("doc_id", "source", "quality")
    f = SP.stratified_kfold(d, "doc_id", "quality", 5, 42)
    return SP.oof_target_encode(f, "source", "quality", "fold", "source_te").select("doc_id", "fold", "source_te")

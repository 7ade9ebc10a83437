"""Models through pyspark.ml, plus the clustering helpers that have SQL oracles."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from stratum.operators import models as MD
from stratum.operators import splits as SP
from stratum.plans import views
from stratum.plans.catalog import splits as SPL
from stratum.plans.catalog.blending import CENTRED_SQL, EVAL_SQL, MEANS_SQL, eval_frame, nonnegative_sql
from stratum.plans.registry import register
from stratum.session import cut_lineage
from stratum.sources.tables import load

NUM = ["n_chars", "n_words", "n_lines"]
CAT = ["lang", "source"]


def doc_features(spark, sf):
    """Per document: length features over the whole text, language, source and the label."""
    d = load(spark, sf, "documents", ["doc_id", "text", "lang", "source", "n_chars"])
    lab = load(spark, sf, "labels", ["doc_id", "quality"])
    d = d.select("doc_id", "lang", "source",
                 F.when(F.col("doc_id") % 7 != 0, F.col("n_chars")).cast("double").alias("n_chars"),
                 F.size(F.split(F.trim("text"), r"\s+")).cast("double").alias("n_words"),
                 F.size(F.split("text", "\n")).cast("double").alias("n_lines"))
    return d.join(lab, "doc_id", "left").withColumn("is_train", F.col("quality").isNotNull())


def _train_test(spark, sf):
    d = doc_features(spark, sf)
    return d.filter("is_train").withColumn("quality", F.col("quality").cast("double")), d.filter("NOT is_train")


@register("preprocess_pipeline")
def q_preprocess_pipeline(spark, sf):
    tr, te = _train_test(spark, sf)
    _, _, out = MD.preprocess_pipeline(tr, te, NUM, CAT)
    return out.select("doc_id", vector_to_array("features").alias("features"))


@register("gbt_classify_cv", dbl=["accuracy", "cv_mean", "cv_std"])
def q_gbt_classify_cv(spark, sf):
    tr, _ = _train_test(spark, sf)
    f = SP.stratified_kfold(tr, "doc_id", "quality", 5, 42)
    return MD.gbt_classify_cv(f, "quality", NUM, CAT, "fold")


@register("final_fit_predict", dbl=["prediction"])
def q_final_fit_predict(spark, sf):
    # the out-of-fold features: nothing in them is computed from the label of the row;
    # the entities of the first fold play the test set
    e = cut_lineage(_oof(spark, sf))  # train and test rows read it
    return MD.final_fit_predict(e.filter("fold <> 0"), e.filter("fold = 0"), "sig", OOF_FEATURES, [], ["entity", "i"], task="regression")


def _oof(spark, sf):
    """The global model's per-row features on the eval zone: position, depth proxy, the per-entity
    linear prior, distance from the known boundary, eval-zone fraction and known-zone size."""
    e = eval_frame(spark, sf).withColumn("since", F.col("pos") - F.col("last_pos")).withColumn("nk", F.col("nk").cast("double"))
    e = e.withColumn("zone_frac", (F.col("i") - F.col("nkn") + 1) / (F.col("n") - F.col("nkn")))
    folds = SP.group_kfold(views.seq(spark, sf), "entity", 5).select("entity", "fold")
    return e.join(folds, "entity")


OOF_FEATURES = ["pos", "k", "pred", "last_sig", "since", "zone_frac", "nk"]


@register("gbt_regress_oof", stored=True, dbl=["sig", "oof_pred"])
def q_gbt_regress_oof(spark, sf):
    return MD.gbt_regress_oof(_oof(spark, sf), "sig", OOF_FEATURES, "fold", ["entity", "i"])


STACK_W = " + ".join(["{0}.w0", *[f"{{0}}.w{i} * s{i}" for i in (1, 2, 3)]])


@register("stacking", stored=True, dbl=["sig", "m_last", "m_mean", "m_ols", "stack_pred", "refit_pred", "fold_rmse", "overall_rmse"], sql=f"""
WITH {EVAL_SQL},
mn AS (SELECT entity, avg(sig) AS mean_sig FROM seq WHERE known GROUP BY entity), {SPL.GROUP_KFOLD_SQL},
o AS (SELECT ef.entity, ef.i, ef.sig AS y, ef.last_sig AS s1, mn.mean_sig AS s2, ef.pred AS s3, gf.fold
      FROM ef JOIN mn ON ef.entity = mn.entity JOIN gf ON ef.entity = gf.g),
c AS (SELECT f.fold, {CENTRED_SQL}, {MEANS_SQL} FROM o JOIN (SELECT DISTINCT fold FROM gf) AS f ON o.fold <> f.fold GROUP BY f.fold
      UNION ALL SELECT -1, {CENTRED_SQL}, {MEANS_SQL} FROM o),
p AS (SELECT fold, g11 + 1.0 AS g11, g22 + 1.0 AS g22, g33 + 1.0 AS g33, g12, g13, g23, b1, b2, b3 FROM c),
w AS ({nonnegative_sql("p", "fold")}),
x AS (SELECT w.*, my - m1 * w1 - m2 * w2 - m3 * w3 AS w0 FROM w JOIN c ON w.fold = c.fold),
t AS (SELECT o.*, {STACK_W.format("x")} AS sp, {STACK_W.format("a")} AS rp FROM o JOIN x ON o.fold = x.fold CROSS JOIN (SELECT * FROM x WHERE fold = -1) AS a)
SELECT entity, i, y AS sig, s1 AS m_last, s2 AS m_mean, s3 AS m_ols, fold, sp AS stack_pred, rp AS refit_pred,
       sqrt(avg((y - sp) * (y - sp)) OVER (PARTITION BY fold)) AS fold_rmse, sqrt(avg((y - sp) * (y - sp)) OVER ()) AS overall_rmse
FROM t""")
def q_stacking(spark, sf):
    ev = views.eval_predictions(spark, sf)
    p = ev.groupBy("entity", "i", "sig").pivot("model", ["last", "mean", "ols"]).agg(F.first("p"))
    p = p.withColumnsRenamed({"last": "m_last", "mean": "m_mean", "ols": "m_ols"})
    folds = SP.group_kfold(views.seq(spark, sf), "entity", 5).select("entity", "fold")
    # stored: the Gram sums, the scores and the result read it
    return MD.stacking(cut_lineage(p.join(folds, "entity")), ["m_last", "m_mean", "m_ols"], "sig", "fold", alpha=1.0)


EMB_DIMS = 64
EMB_F = [f"e{j}" for j in range(EMB_DIMS)]


def emb_points(spark, sf):
    """Embeddings as one column per dimension, with the label as group."""
    e = load(spark, sf, "embeddings", ["vec_id", "label", "embedding"])
    return e.select("vec_id", F.col("label").cast("long").alias("grp"),
                    *[F.col("embedding")[j].cast("double").alias(c) for j, c in enumerate(EMB_F)])


@register("kmeans_features", dbl=["cluster_dist"])
def q_kmeans_features(spark, sf):
    p = emb_points(spark, sf)
    folds = SP.group_kfold(p, "grp", 5).select("grp", "fold")
    return MD.kmeans_features(p.join(folds, "grp"), EMB_F, "fold", 4, "vec_id")


@register("elbow_scan", dbl=["inertia"], digits=3)
def q_elbow_scan(spark, sf):
    return MD.elbow_scan(emb_points(spark, sf), EMB_F, range(2, 16))


def binned_sse_curve(spark, sf, ks=range(2, 16)):
    """Within-bin sum of squares of events.value for k equal-width bins (an elbow-shaped curve)."""
    e = load(spark, sf, "events", ["value"])
    mm = e.agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    kdf = spark.createDataFrame([(int(k),) for k in ks], "k long")
    x = e.crossJoin(F.broadcast(mm)).crossJoin(F.broadcast(kdf))  # 14 k values
    b = F.least(F.floor((F.col("value") - F.col("_lo")) / ((F.col("_hi") - F.col("_lo")) / F.col("k"))).cast("long"), F.col("k") - 1)
    s = x.groupBy("k", b.alias("bin")).agg(
        (F.sum(F.col("value") * F.col("value")) - F.sum("value") * F.sum("value") / F.count(F.lit(1))).alias("sse"))
    return s.groupBy("k").agg(F.sum("sse").alias("inertia"))


@register("knee_point", dbl=["inertia", "dist"], digits=4, sql="""
WITH ks AS (SELECT range AS k FROM range(2, 16)),
mm AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
b AS (SELECT ks.k, least(CAST(floor((value - lo) / ((hi - lo) / ks.k)) AS BIGINT), ks.k - 1) AS bin, value FROM events CROSS JOIN mm CROSS JOIN ks),
s AS (SELECT k, bin, sum(value * value) - sum(value) * sum(value) / count(*) AS sse FROM b GROUP BY k, bin),
cv AS (SELECT k, sum(sse) AS inertia FROM s GROUP BY k),
n AS (SELECT k, inertia, (k - min(k) OVER ()) / (max(k) OVER () - min(k) OVER ()) AS nx,
             (inertia - min(inertia) OVER ()) / (max(inertia) OVER () - min(inertia) OVER ()) AS ny FROM cv),
f AS (SELECT nx AS x1, ny AS y1 FROM n ORDER BY k LIMIT 1), l AS (SELECT nx AS x2, ny AS y2 FROM n ORDER BY k DESC LIMIT 1),
dd AS (SELECT n.*, abs((x2 - x1) * (ny - y1) - (y2 - y1) * (nx - x1)) / sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) AS dist FROM n, f, l)
SELECT k, inertia, dist, k = (SELECT k FROM dd ORDER BY dist DESC, k LIMIT 1) AS is_knee FROM dd""")
def q_knee_point(spark, sf):
    return MD.knee_point(binned_sse_curve(spark, sf), "k", "inertia")


@register("assign_nearest_centroid", dbl=["centroid_dist"], sql="""
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
u AS (SELECT label, unnest(v) AS x, unnest(range(len(v))) AS j FROM e),
c AS (SELECT label, list(m ORDER BY j) AS cv FROM (SELECT label, j, avg(x) AS m FROM u GROUP BY label, j) AS t GROUP BY label),
d AS (SELECT e.vec_id, e.label, c.label AS cl,
             sqrt(list_reduce(list_transform(list_zip(e.v, c.cv), lambda p: (p[1] - p[2]) * (p[1] - p[2])), lambda a, b: a + b)) AS dist
      FROM e CROSS JOIN c)
SELECT vec_id, label, cl AS nearest_label, dist AS centroid_dist FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, cl) AS r FROM d) AS t WHERE r = 1""")
def q_assign_nearest_centroid(spark, sf):
    e = load(spark, sf, "embeddings", ["vec_id", "label", "embedding"]).select(
        "vec_id", "label", F.transform("embedding", lambda v: v.cast("double")).alias("v"))
    px = e.select("label", F.posexplode("v").alias("j", "x"))
    cen = (px.groupBy("label", "j").agg(F.avg("x").alias("m"))
           .groupBy("label").agg(F.sort_array(F.collect_list(F.struct("j", "m"))).alias("_s"))
           .select("label", F.col("_s.m").alias("cv")))
    return MD.assign_nearest_centroid(e, "v", cen, "label", "cv").select("vec_id", "label", "nearest_label", "centroid_dist")


@register("param_search", dbl=["rmse"])
def q_param_search(spark, sf):
    p = emb_points(spark, sf)
    return MD.param_search(p, [c for c in EMB_F if c != "e2"], "e2", "grp", [2, 4, 6])


def _fitted_doc_model(spark, sf):
    tr, _ = _train_test(spark, sf)
    h = SP.stratified_holdout(tr, "doc_id", "quality", 0.2, 42)
    fit_rows, hold = h.filter("NOT is_holdout"), h.filter("is_holdout")
    fit_rows, hold = MD.fill_categoricals(fit_rows, hold, CAT)
    clf = GBTClassifier(labelCol="quality", featuresCol="features", maxIter=20, maxDepth=3, seed=42)
    model = Pipeline(stages=MD.preprocess_stages(NUM, CAT) + [clf]).fit(fit_rows)
    return model, fit_rows, hold


@register("permutation_importance", dbl=["base_acc", "mean_drop", "std_drop"])
def q_permutation_importance(spark, sf):
    model, _, hold = _fitted_doc_model(spark, sf)
    return MD.permutation_importance(model, hold, "quality", "doc_id", NUM + CAT, repeats=10)


@register("native_importance", dbl=["importance"])
def q_native_importance(spark, sf):
    model, fit_rows, _ = _fitted_doc_model(spark, sf)
    return MD.native_importance(model, model.transform(fit_rows))

"""Models as Spark jobs (``pyspark.ml``): preprocessing, folds, OOF, stacking, clustering, importances.

Every fit is a distributed MLlib job over the fold's rows; per-fold loops
run on the driver only over the k fold ids.  Out-of-fold tables are unions
of the per-fold validation predictions, keyed by the row id.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import (Imputer, OneHotEncoder, StandardScaler, StringIndexer,
                                VectorAssembler)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.operators import tabular as T
from stratum.operators.scan import range_scan
from stratum.session import cut_lineage


def preprocess_stages(numeric: Sequence[str], categorical: Sequence[str], out: str = "features") -> list:
    """median-impute + standardise numerics; index + one-hot categoricals (unknown -> all zeros)."""
    stages = []
    imp = [f"{c}__imp" for c in numeric]
    if numeric:
        stages.append(Imputer(strategy="median", inputCols=list(numeric), outputCols=imp))
        stages.append(VectorAssembler(inputCols=imp, outputCol="__num", handleInvalid="keep"))
        stages.append(StandardScaler(inputCol="__num", outputCol="__num_s", withMean=True, withStd=True))
    ohe = []
    for c in categorical:
        # the indexer gives unseen values one extra index (the last); dropping the
        # encoder's last slot then encodes an unseen category as all zeros while
        # every seen category keeps its own slot
        stages.append(StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep", stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCol=f"{c}__idx", outputCol=f"{c}__ohe", handleInvalid="error", dropLast=True))
        ohe.append(f"{c}__ohe")
    stages.append(VectorAssembler(inputCols=(["__num_s"] if numeric else []) + ohe, outputCol=out))
    return stages


def fill_categoricals(train: DataFrame, other: DataFrame, categorical: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Most-frequent fill fitted on ``train`` (ties -> smallest), applied to both."""
    if not categorical:
        return train, other
    return (T.simple_impute(train, train, [], categorical), T.simple_impute(train, other, [], categorical))


def preprocess_pipeline(train: DataFrame, other: DataFrame, numeric, categorical) -> tuple[PipelineModel, DataFrame, DataFrame]:
    tr, ot = fill_categoricals(train, other, categorical)
    model = Pipeline(stages=preprocess_stages(numeric, categorical)).fit(tr)
    return model, model.transform(tr), model.transform(ot)


def _fold_ids(df: DataFrame, fold: str) -> list:
    return sorted(r[0] for r in df.select(fold).distinct().collect())  # k small values


def gbt_classify_cv(df: DataFrame, label: str, numeric, categorical, fold: str, seed: int = 42,
                    max_iter: int = 20, max_depth: int = 3) -> DataFrame:
    """Accuracy per fold with mean and population std over folds."""
    rows = []
    df = cut_lineage(df)  # every fold and every boosting pass rereads it
    for f in _fold_ids(df, fold):
        tr, va = df.filter(F.col(fold) != f), df.filter(F.col(fold) == f)
        trf, vaf = fill_categoricals(tr, va, categorical)
        clf = GBTClassifier(labelCol=label, featuresCol="features", maxIter=max_iter, maxDepth=max_depth, seed=seed)
        model = Pipeline(stages=preprocess_stages(numeric, categorical) + [clf]).fit(trf)
        acc = model.transform(vaf).agg(F.avg((F.col("prediction") == F.col(label)).cast("double")).alias("a"),
                                       F.count(F.lit(1)).alias("n")).first()
        rows.append((int(f), float(acc["a"]), int(acc["n"])))
    res = df.sparkSession.createDataFrame(rows, f"{fold} long, accuracy double, n_val long")
    w = Window.partitionBy()
    return res.select("*", F.avg("accuracy").over(w).alias("cv_mean"), F.stddev_pop("accuracy").over(w).alias("cv_std"))


def final_fit_predict(train: DataFrame, test: DataFrame, label: str, numeric, categorical, id_cols: Sequence[str],
                      task: str = "classification", seed: int = 42, max_iter: int = 20, max_depth: int = 3) -> DataFrame:
    """Refit on every train row, predict the test rows, composite id ``a_b``."""
    train, test = cut_lineage(train), cut_lineage(test)  # every stage of the fit rereads the rows
    trf, tef = fill_categoricals(train, test, categorical)
    est = (GBTClassifier if task == "classification" else GBTRegressor)(
        labelCol=label, featuresCol="features", maxIter=max_iter, maxDepth=max_depth, seed=seed)
    model = Pipeline(stages=preprocess_stages(numeric, categorical) + [est]).fit(trf)
    p = model.transform(tef)
    pid = F.concat_ws("_", *[F.col(c).cast("string") for c in id_cols])
    return p.select(pid.alias("id"), F.col("prediction"))


def gbt_regress_oof(df: DataFrame, label: str, features: Sequence[str], fold: str, id_cols: Sequence[str],
                    seed: int = 42, max_iter: int = 20, max_depth: int = 4) -> DataFrame:
    """Grouped out-of-fold predictions of a boosted regressor.

    MLlib trees have no native missing-value split: nulls are imputed with
    the train-fold median and an indicator column is added per feature.
    """
    flags = [f"{c}__isnull" for c in features]
    d = cut_lineage(df.withColumns({fl: F.col(c).isNull().cast("double") for c, fl in zip(features, flags)}))
    outs = []
    for f in _fold_ids(d, fold):
        tr, va = d.filter(F.col(fold) != f), d.filter(F.col(fold) == f)
        stages = [Imputer(strategy="median", inputCols=list(features), outputCols=[f"{c}__imp" for c in features]),
                  VectorAssembler(inputCols=[f"{c}__imp" for c in features] + flags, outputCol="features", handleInvalid="keep"),
                  GBTRegressor(labelCol=label, featuresCol="features", maxIter=max_iter, maxDepth=max_depth, seed=seed)]
        model = Pipeline(stages=stages).fit(tr)
        outs.append(model.transform(va).select(*id_cols, fold, label, F.col("prediction").alias("oof_pred")))
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


def oof_rmse(oof: DataFrame, label: str, pred: str, fold: str) -> DataFrame:
    e = F.col(label) - F.col(pred)
    per = oof.groupBy(fold).agg(F.sqrt(F.avg(e * e)).alias("fold_rmse"), F.sum(e * e).alias("_sse"),
                                F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy()
    return per.select(fold, "fold_rmse", F.sqrt(F.sum("_sse").over(w) / F.sum("_n").over(w)).alias("overall_rmse"))


def stacking(oof: DataFrame, cols: Sequence[str], label: str, fold: str, alpha: float = 1.0) -> DataFrame:
    """Non-negative ridge meta-model on the raw OOF matrix.

    Adds stack_pred (weights from the other folds), fold_rmse (its error on the
    row's fold), overall_rmse, and refit_pred (weights from all rows, the model
    that goes on).  One pass adds up the Gram sums per fold; the solves are on
    fixed-size matrices.
    """
    from stratum.operators.blending import gram, ridge_weights
    per = gram(oof, cols, label, fold).collect()  # k rows of fixed size
    tot = {c: sum(r[c] for r in per) for c in per[0].asDict() if c != fold}
    whole, whole_icpt = ridge_weights(tot, cols, alpha, positive=True)
    rows = []
    for r in per:
        coef, icpt = ridge_weights({c: tot[c] - r[c] for c in tot}, cols, alpha, positive=True)
        rows.append((r[fold], *[float(v) for v in coef], float(icpt)))
    wdf = oof.sparkSession.createDataFrame(rows, [fold, *[f"w_{c}" for c in cols], "w_icpt"])
    pred = sum(F.col(c) * F.col(f"w_{c}") for c in cols) + F.col("w_icpt")
    refit = sum(F.col(c) * F.lit(float(v)) for c, v in zip(cols, whole)) + F.lit(float(whole_icpt))
    out = oof.join(F.broadcast(wdf), fold).withColumn("stack_pred", pred).drop(*wdf.columns[1:]).withColumn("refit_pred", refit)
    return out.join(F.broadcast(oof_rmse(out, label, "stack_pred", fold)), fold)


def scaling(df: DataFrame, features: Sequence[str], min_std: float = 1e-6) -> dict[str, tuple[float, float]]:
    """feature -> (mean, population std; below ``min_std`` -> 1), one row of sums."""
    row = df.agg(*[f(c).alias(f"{n}_{j}") for j, c in enumerate(features)
                   for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    return {c: (float(row[f"m_{j}"] or 0.0), float(row[f"s_{j}"]) if (row[f"s_{j}"] or 0.0) >= min_std else 1.0)
            for j, c in enumerate(features)}


def standardised(df: DataFrame, stats: dict[str, tuple[float, float]], out: str = "__z") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.array(*[(F.col(c).cast("double") - m) / s for c, (m, s) in stats.items()])))


def best_kmeans(z: DataFrame, k: int, seed: int, starts: int, max_iter: int):
    """The k-means model of least cost over ``starts`` seeded starts on column __z, fitted side by side."""
    def fit(s):
        return KMeans(featuresCol="__z", predictionCol="cluster", k=k, seed=seed + s, maxIter=max_iter).fit(z)

    with ThreadPoolExecutor(starts) as pool:      # each fit is many small jobs that leave the cluster idle
        fits = list(pool.map(fit, range(starts)))
    return min(fits, key=lambda m: m.summary.trainingCost)


def kmeans_features(df: DataFrame, features: Sequence[str], fold: str, k: int, id_col: str, seed: int = 42,
                    starts: int = 5, max_iter: int = 20) -> DataFrame:
    """Per fold: scaling and k-means fitted on the train rows; cluster and distance to its centre for
    the train rows (part = train) and the held-out rows (part = valid)."""
    df = cut_lineage(df)
    outs = []
    for f in _fold_ids(df, fold):
        stats = scaling(df.filter(F.col(fold) != f), features)
        z = standardised(df, stats).withColumn("part", F.when(F.col(fold) == f, "valid").otherwise("train"))
        m = best_kmeans(z.filter("part = 'train'"), k, seed, starts, max_iter)
        cdf = df.sparkSession.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(m.clusterCenters())],
                                              "cluster int, __c array<double>")  # k rows
        p = m.transform(z).join(F.broadcast(cdf), "cluster")
        dist = F.sqrt(F.aggregate(F.zip_with(vector_to_array("__z"), "__c", lambda a, b: (a - b) * (a - b)),
                                  F.lit(0.0), lambda s, v: s + v))
        outs.append(p.select(id_col, F.lit(f).cast("long").alias(fold), "part", F.col("cluster").cast("long"), dist.alias("cluster_dist")))
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


def elbow_scan(df: DataFrame, features: Sequence[str], ks=range(2, 16), seed: int = 42, starts: int = 5,
               max_iter: int = 20) -> DataFrame:
    """Least k-means inertia over ``starts`` starts for each k, on features scaled by mean and population std."""
    z = standardised(df, scaling(df, features)).select("__z").cache()
    rows = [(int(k), float(best_kmeans(z, k, seed, starts, max_iter).summary.trainingCost)) for k in ks]
    z.unpersist()
    return df.sparkSession.createDataFrame(rows, "k long, inertia double")


def knee_point(curve: DataFrame, x: str, y: str) -> DataFrame:
    """Normalise both axes to [0, 1]; distance of each point from the first-last chord; knee = argmax."""
    w = Window.partitionBy()  # the curve is one small table
    nx = (F.col(x) - F.min(x).over(w)) / (F.max(x).over(w) - F.min(x).over(w))
    ny = (F.col(y) - F.min(y).over(w)) / (F.max(y).over(w) - F.min(y).over(w))
    c = curve.select(x, y, nx.alias("_nx"), ny.alias("_ny"))
    first = c.orderBy(x).limit(1).select(F.col("_nx").alias("_x1"), F.col("_ny").alias("_y1"))
    last = c.orderBy(F.col(x).desc()).limit(1).select(F.col("_nx").alias("_x2"), F.col("_ny").alias("_y2"))
    j = c.crossJoin(first).crossJoin(last)
    lx, ly = F.col("_x2") - F.col("_x1"), F.col("_y2") - F.col("_y1")
    dist = F.abs(lx * (F.col("_ny") - F.col("_y1")) - ly * (F.col("_nx") - F.col("_x1"))) / F.sqrt(lx * lx + ly * ly)
    j = j.withColumn("dist", dist)
    best = j.select(F.min_by(F.col(x), F.struct(-F.col("dist"), F.col(x))).alias("_knee"))
    return j.crossJoin(best).select(x, y, "dist", (F.col(x) == F.col("_knee")).alias("is_knee"))


def permuted(place: Column, n: int, seed: Column, rounds: int = 4) -> Column:
    """A seeded bijection on 0 .. n-1, evaluated for one place by itself: no sort and no table of the permutation.

    A Feistel network mixes the two digits of the place in base a = ceil(sqrt(n)).
    It permutes a * a numbers; one that comes out at n or above goes in again,
    which follows its cycle back into the range.
    """
    a = max(1, math.isqrt(max(n, 1) - 1) + 1)
    keys = F.array(*[F.lit(k) for k in range(rounds)])

    def once(x: Column) -> Column:
        start = F.struct(F.floor(x / a).cast("long").alias("l"), F.pmod(x, F.lit(a)).cast("long").alias("r"))
        return F.aggregate(keys, start, lambda s, k: F.struct(
            s["r"].alias("l"), F.pmod(s["l"] + F.pmod(F.xxhash64(seed, k, s["r"]), F.lit(a)), F.lit(a)).cast("long").alias("r")),
            lambda s: s["l"] * a + s["r"])
    outside = 1 - n / (a * a)                             # so many steps that none stays outside, but for one in 2^64
    steps = 1 if outside <= 0 else math.ceil(64 * math.log(2) / -math.log(outside))
    x = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), once(place), lambda x, _: F.when(x < n, x).otherwise(once(x)))
    return F.when(x < n, x).otherwise(F.raise_error(F.lit("permutation did not return")).cast("long"))


def permutation_importance(model: PipelineModel, holdout: DataFrame, label: str, id_col: str, features: Sequence[str],
                           repeats: int = 10, seed: int = 42) -> DataFrame:
    """Mean accuracy drop when one feature is shuffled among the holdout rows (``repeats`` seeded shuffles).

    Rows are numbered once; a keyed bijection names each row's donor in each
    repeat.  Only the donors' feature values move, once per repeat; the copy
    with one feature replaced is made next to the model that scores it.
    """
    rows = range_scan(holdout, [], [F.col(id_col).asc()], "_p")
    n = rows.count()
    donor = {f: f"_d_{i}" for i, f in enumerate(features)}
    given = rows.select(F.col("_p").alias("_q"), *[F.col(f).alias(d) for f, d in donor.items()])
    asked = rows.withColumn("_rep", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    asked = asked.withColumn("_q", permuted(F.col("_p"), n, F.concat(F.lit(f"{seed}|"), F.col("_rep").cast("string"))))
    x = asked.join(given, "_q").withColumn("_feature", F.explode(F.array(*[F.lit(f) for f in features])))
    x = x.withColumns({f: F.when(F.col("_feature") == f, F.col(d)).otherwise(F.col(f)) for f, d in donor.items()})
    acc = F.avg((F.col("prediction") == F.col(label)).cast("double"))
    base_acc = model.transform(holdout).agg(acc.alias("base_acc"))
    perm = model.transform(x.drop("_q", "_p", *donor.values())).groupBy("_feature", "_rep").agg(acc.alias("_acc"))
    drop = F.col("base_acc") - F.col("_acc")
    return (perm.crossJoin(base_acc).groupBy(F.col("_feature").alias("feature"), "base_acc")
            .agg(F.avg(drop).alias("mean_drop"), F.stddev_pop(drop).alias("std_drop")))


def native_importance(model: PipelineModel, transformed: DataFrame, features_col: str = "features", top: int = 20) -> DataFrame:
    """Named feature importances of the fitted tree model (assembler metadata), top ``top``."""
    meta = transformed.schema[features_col].metadata.get("ml_attr", {}).get("attrs", {})
    names = {}
    for group in meta.values():
        for a in group:
            names[a["idx"]] = a["name"]
    imp = model.stages[-1].featureImportances.toArray()
    rows = [(names.get(i, f"f{i}"), float(v)) for i, v in enumerate(imp)]
    rows.sort(key=lambda t: (-t[1], t[0]))
    return transformed.sparkSession.createDataFrame(rows[:top], "feature string, importance double")


def assign_nearest_centroid(df: DataFrame, vec: str, centroids: DataFrame, label: str, cvec: str,
                            block: int = 2000) -> DataFrame:
    """Nearest centroid label and Euclidean distance; ties -> smallest label.

    Any number of centroids: they are broadcast in blocks of about ``block``
    (one block for an ordinary model), and each row keeps the best of the
    blocks so far, so no row moves and no broadcast exceeds a block.
    """
    blocks = max(1, -(-centroids.count() // block))
    out = df.withColumn("_b", F.lit(None).cast(f"struct<dist:double,lab:{dict(centroids.dtypes)[label]}>"))
    for k in range(blocks):
        part = centroids.filter(F.pmod(F.xxhash64(label), F.lit(blocks)) == k)
        packed = part.agg(F.collect_list(F.struct(F.col(label).alias("lab"), F.col(cvec).alias("c"))).alias("_cs"))
        d = F.transform("_cs", lambda c: F.struct(
            F.sqrt(F.aggregate(F.zip_with(F.col(vec), c["c"], lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)).alias("dist"),
            c["lab"].alias("lab")))
        out = out.crossJoin(F.broadcast(packed)).withColumn("_b", F.least(F.col("_b"), F.array_min(d))).drop("_cs")
    return out.select(*df.columns, F.col("_b.lab").alias("nearest_label"), F.col("_b.dist").alias("centroid_dist"))


def param_search(df: DataFrame, features: Sequence[str], target: str, group: str, candidates: Sequence[int],
                 seed: int = 42) -> DataFrame:
    """Cheap 3-fold grouped score for each candidate k, best confirmed with 5 folds.

    Score: RMSE of a linear model on the features plus one-hot k-means cluster
    (scaling and k-means fitted on the train fold only).  Returns the run table.
    """
    from stratum.operators.splits import random_group_kfold

    def score(k, n_folds):
        folds = random_group_kfold(df, group, n_folds, seed).select(group, "fold")
        d = cut_lineage(df.join(folds, group))
        errs = []
        for f in range(n_folds):
            tr, va = d.filter(F.col("fold") != f), d.filter(F.col("fold") == f)
            stats = scaling(tr, features)
            tr, va = standardised(tr, stats), standardised(va, stats)
            pipe = Pipeline(stages=[
                KMeans(featuresCol="__z", predictionCol="__cl", k=k, seed=seed, maxIter=20),
                OneHotEncoder(inputCol="__cl", outputCol="__clv", dropLast=False, handleInvalid="keep"),
                VectorAssembler(inputCols=["__z", "__clv"], outputCol="__f"),
                LinearRegression(featuresCol="__f", labelCol=target, regParam=1e-3)])
            m = pipe.fit(tr)
            e = F.col(target) - F.col("prediction")
            errs.append(m.transform(va).agg(F.sum(e * e).alias("s"), F.count(F.lit(1)).alias("n")).first())
        return float(np.sqrt(sum(r["s"] for r in errs) / sum(r["n"] for r in errs)))

    import numpy as np
    rows = [(int(k), "search", 3, score(k, 3)) for k in candidates]
    best = min(rows, key=lambda r: (r[3], r[0]))[0]
    rows.append((best, "confirm", 5, score(best, 5)))
    return df.sparkSession.createDataFrame(rows, "k long, stage string, n_folds long, rmse double")

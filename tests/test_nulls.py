"""Nulls in keys, order columns, signals and queries: no row lost, no value invented, no effect of the block size."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stratum.operators import aggregates as A
from stratum.operators import blending as B
from stratum.operators import matching as MT
from stratum.operators import sequence as Q
from stratum.operators import spatial as SPT
from stratum.operators import splits as SP


def test_row_index_keeps_null_keys_and_orders(spark):
    rows = [("a", 3, 1), ("a", None, 2), ("a", 1, 3), (None, 5, 4), (None, None, 5), ("b", None, 6)]
    df = spark.createDataFrame(rows, "e string, t long, id long")
    out = Q.row_index(df, "e", ["t", "id"], "i", chunk=F.floor(F.col("t") / 2), count_col="n").collect()
    assert sorted((r["id"], r["i"], r["n"]) for r in out) == [(1, 2, 3), (2, 0, 3), (3, 1, 3), (4, 1, 2), (5, 0, 2), (6, 0, 1)]
    assert Q.entity_count(df, "e").count() == 6


def test_splits_keep_null_classes(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else i % 2) for i in range(40)], "id long, y long")
    f = SP.stratified_kfold(df, "id", "y", 5, 42)
    assert f.count() == 40 and f.where("y IS NULL").groupBy("fold").count().collect()[0]["count"] == 2
    h = SP.stratified_holdout(df, "id", "y", 0.2, 42)
    assert h.count() == 40 and h.where("y IS NULL AND is_holdout").count() == 2


def _signal(n=40, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=n).round(3)
    x[rng.random(n) < .3] = np.nan
    x[-3:] = np.nan
    return x


@pytest.mark.parametrize("block", [8, 11, 1 << 18])
def test_lag_lead_equals_pandas(spark, block):
    rows, want = [], []
    for e, n in (("a", 40), ("b", 3), (None, 12)):
        x = pd.Series(_signal(n, n))
        rows += [(e, i, None if math.isnan(v) else float(v)) for i, v in enumerate(x)]
        cols = [f(x) for k in (1, 5, 7) for f in (lambda s, k=k: s.shift(k).bfill(), lambda s, k=k: s.shift(-k).ffill())]
        want += [(e, i, *(None if math.isnan(c[i]) else float(c[i]) for c in cols)) for i in range(n)]
    df = spark.createDataFrame(rows, "e string, i long, x double")
    got = Q.lag_lead_filled(df, "e", "i", "x", (1, 5, 7), block).select("e", "i", "lag1", "lead1", "lag5", "lead5", "lag7", "lead7").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("block", [12, 1 << 18])
def test_windows_keep_their_length(spark, block):
    x = _signal(30, 3)
    rows = [(0, i, 30, None if math.isnan(v) else float(v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "e long, i long, n long, x double")
    for r in Q.window_tensor(df, "e", "i", "n", ["x"], 4, block).collect():
        want = [x[min(max(r["i"] + d, 0), 29)] for d in range(-4, 5)]
        assert [v for v in r["tensor"][0]] == [None if math.isnan(v) else v for v in want]


@pytest.mark.parametrize("block", [20, 1 << 18])
def test_savgol_smooths_from_the_right_neighbours(spark, block):
    x = np.random.default_rng(1).normal(size=60).cumsum()
    rows = [(0, i, 60, None if i == 30 else float(v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "e long, i long, n long, x double")
    whole = spark.createDataFrame([(0, i, 60, float(v)) for i, v in enumerate(x)], df.schema)
    a, b = ([r["s"] for r in B.savgol_smooth(d, "e", "i", "n", "x", "s", 9, 3, block).orderBy("i").collect()] for d in (df, whole))
    for i in range(60):
        assert a[i] is None if abs(i - 30) <= 4 else a[i] == pytest.approx(b[i])


def test_null_queries_find_nothing(spark):
    ref = spark.createDataFrame([("a", float(i), 10.0 * i) for i in range(1, 6)], "k string, x double, y double")
    q = spark.createDataFrame([(0, "a", None), (1, "a", float("nan")), (2, "a", 2.5), (3, None, 2.0)], "id long, k string, q double")
    got = [r["v"] for r in MT.interp_lookup(q, ref, "k", F.col("q"), "x", "y", "v").orderBy("id").collect()]
    assert got == [None, None, 25.0, None]
    near = [(r["nx"], r["ny"]) for r in MT.nearest_key(q, ref, "k", F.col("q"), "x", "y", "nx", "ny").orderBy("id").collect()]
    assert near == [(None, None), (None, None), (2.0, 20.0), (None, None)]


def test_idw_answers_every_query(spark):
    pts = spark.createDataFrame([(i, 1, float(i), float(i % 3), 2.0 * i) for i in range(6)], "id long, g long, x double, y double, v double")
    got = SPT.knn_idw_impute(pts, pts.select("id", "x", "y", "g"), "g", "id", "x", "y", "v", "id", "x", "y", "g").collect()
    assert len(got) == 6 and all(r["idw_mean"] == 5.0 and r["idw_std"] == 0.0 and r["idw_dist"] is None for r in got)


def test_weighted_offset_of_a_long_entity_is_finite(spark):
    df = spark.range(50_000).selectExpr("0 AS e", "id AS i", "CAST(id % 7 AS DOUBLE) AS y", "0.0D AS z", "0.0D AS s")
    r = A.segment_offsets(df, "e", "i", F.lit(True), "y", "z", "s").first()
    j = np.arange(50_000)
    w = np.exp(0.02 * (j - j[-1]))
    assert r["b_wls"] == pytest.approx((w * (j % 7)).sum() / w.sum())

"""Halo blocks, segmented scans and chunked numbering equal their entity-wide definitions."""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from stratum.operators import sequence as Q


def _seq(spark, n_ent=3, n=40, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for e in range(n_ent):
        for i in range(n + 7 * e):
            v = None if rng.random() < 0.3 else float(np.round(rng.normal(50, 10), 2))
            rows.append((e, i, v, float(i) * 1.5, float(np.round(rng.normal(0, 1), 3))))
    rows.append((9, 0, None, 0.0, 1.0))  # an entity whose signal is all null
    rows.append((9, 1, None, 1.0, 2.0))
    return spark.createDataFrame(rows, "e long, i long, v double, pos double, x double")


def test_row_index_chunked(spark):
    df = _seq(spark).withColumn("ts", F.col("pos"))
    a = Q.row_index(df.drop("i"), "e", ["ts"], "i").select("e", "ts", "i")
    b = Q.row_index(df.drop("i"), "e", ["ts"], "i", chunk=F.floor(F.col("ts") / 7)).select("e", "ts", "i")
    assert sorted(a.collect()) == sorted(b.collect())


def test_halo_rolling_matches_entity_window(spark):
    df = _seq(spark)
    small = Q.rolling_centered(df, "e", "i", "v", (5, 21), block=16).orderBy("e", "i").collect()
    w = Window.partitionBy("e").orderBy("i")
    ref = df.select("e", "i", F.avg("v").over(w.rowsBetween(-10, 10)).alias("m"),
                    F.coalesce(F.stddev_samp("v").over(w.rowsBetween(-10, 10)), F.lit(0.0)).alias("s")).orderBy("e", "i").collect()
    for a, b in zip(small, ref):
        assert (a["roll_mean21"] is None and b["m"] is None) or abs(a["roll_mean21"] - b["m"]) < 1e-9
        assert abs(a["roll_std21"] - b["s"]) < 1e-9


def test_lag_lead_and_tensor_blocks(spark):
    df = _seq(spark).withColumn("sig", F.coalesce("v", F.lit(0.0)))
    n = df.groupBy("e").agg(F.count(F.lit(1)).alias("n"))
    d = df.join(n, "e")
    a = Q.lag_lead_filled(d, "e", "i", "sig", (1, 5), block=8).orderBy("e", "i").collect()
    b = Q.lag_lead_filled(d, "e", "i", "sig", (1, 5)).orderBy("e", "i").collect()
    assert [(r["lag5"], r["lead5"]) for r in a] == [(r["lag5"], r["lead5"]) for r in b]
    t1 = Q.window_tensor(d, "e", "i", "n", ["sig"], 6, block=8).orderBy("e", "i").collect()
    t2 = Q.window_tensor(d, "e", "i", "n", ["sig"], 6).orderBy("e", "i").collect()
    assert [r["tensor"] for r in t1] == [r["tensor"] for r in t2]
    assert all(len(r["tensor"][0]) == 13 for r in t1)


def test_gap_interpolate_numpy_and_idempotent(spark):
    df = _seq(spark)
    g = Q.gap_interpolate(df, "e", "i", "v", "f", fallback=-1.0, block=8)
    got = g.orderBy("e", "i").toPandas()
    for e, part in got.groupby("e"):
        s = pd.Series(part["v"].values, dtype=float)
        exp = s.interpolate(limit_direction="both").fillna(-1.0).values
        assert np.allclose(part["f"].values, exp)
    again = Q.gap_interpolate(g.select("e", "i", F.col("f").alias("v")), "e", "i", "v", "f2", block=8)
    assert again.filter(F.abs(F.col("v") - F.col("f2")) > 1e-12).count() == 0


def test_axis_derivative_zero_step(spark):
    df = spark.createDataFrame([(0, 0, 0.0, 1.0), (0, 1, 0.0, 2.0), (0, 2, 2.0, 6.0)], "e long, i long, pos double, z double")
    r = Q.axis_derivative(df, "e", "i", "pos", ["z"]).orderBy("i").collect()
    assert r[0]["dz_dpos"] is None and r[1]["dz_dpos"] is None and r[2]["dz_dpos"] == 2.0


def test_even_subsample_linspace(spark):
    rows = [(e, i, 100 + e) for e in range(3) for i in range(100 + e)] + [(7, i, 5) for i in range(5)]
    df = spark.createDataFrame(rows, "e long, i long, n long")
    got = Q.even_subsample(df, "e", "i", "n", 60).groupBy("e").agg(F.sort_array(F.collect_list("i")).alias("ix"))
    for r in got.collect():
        n = 100 + r["e"] if r["e"] < 7 else 5
        assert r["ix"] == sorted(set(np.linspace(0, n - 1, min(60, n)).astype(int).tolist()))

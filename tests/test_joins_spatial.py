"""Range / as-of / nearest joins and the KNN against brute force on small inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.operators import matching as MT
from stratum.operators import spatial as SPT


def _curve(spark):
    xs = [0.0, 0.5, 1.0, 3.0, 3.5, 7.0, 7.25, 12.0]
    ys = [5.0, 4.0, 6.0, 6.0, 1.0, 2.0, 2.0, 9.0]
    rows = [("a", x, y) for x, y in zip(xs, ys)] + [("short", 1.0, 1.0)]
    return spark.createDataFrame(rows, "tid string, x double, y double"), np.array(xs), np.array(ys)


def test_interp_lookup_matches_numpy(spark):
    ref, xs, ys = _curve(spark)
    qs = [-3.0, 0.0, 0.25, 1.0, 2.0, 3.4, 7.1, 11.0, 12.0, 40.0]
    q = spark.createDataFrame([(i, "a", v) for i, v in enumerate(qs)], "id long, tid string, q double")
    got = MT.interp_lookup(q, ref, "tid", F.col("q"), "x", "y", "v").orderBy("id").collect()
    assert np.allclose([r["v"] for r in got], np.interp(qs, xs, ys))


def test_nearest_key_ties_go_low(spark):
    ref, xs, _ = _curve(spark)
    q = spark.createDataFrame([(0, "a", 2.0), (1, "a", 0.75), (2, "a", -1.0), (3, "a", 99.0)], "id long, tid string, q double")
    got = MT.nearest_key(q, ref, "tid", F.col("q"), "x", "y", "nx", "ny").orderBy("id").collect()
    assert [r["nx"] for r in got] == [1.0, 0.5, 0.0, 12.0]  # 2.0 is 1.0 from both 1.0 and 3.0 -> lower


def test_range_nearest_edges(spark):
    ref, _, _ = _curve(spark)
    rows = [(0, "a", 3.2, 6.0), (1, "a", 3.2, None), (2, "a", 50.0, 1.0), (3, "short", 1.0, 1.0), (4, "a", 7.1, 2.0)]
    q = spark.createDataFrame(rows, "id long, tid string, p double, g double")
    got = MT.range_nearest(q, ref, "tid", "p", "g", "out", w=1.0).orderBy("id").collect()
    # y=6 at x=3.0 (x=1 is outside [2.2,4.2]); null signal, empty range and a 1-point curve keep p;
    # tie (x=7.0 and 7.25 both y=2) -> lowest x
    assert [r["out"] for r in got] == [3.0, 3.2, 50.0, 1.0, 7.0]


def test_knn_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    pts = rng.normal(size=(300, 2)) * [3.0, 0.5]
    pts[:20] += 40.0  # a far cluster
    grp = rng.integers(0, 4, 300)
    rows = [(i, float(x), float(y), int(g)) for i, ((x, y), g) in enumerate(zip(pts, grp))]
    df = spark.createDataFrame(rows, "id long, x double, y double, g long")
    r = df.select(F.col("id").alias("rid"), F.col("x").alias("rx"), F.col("y").alias("ry"), F.col("g").alias("rg"))
    got = SPT.knn_join(df, r, 7, "id", "rid", "x", "y", "rx", "ry", qgrp="g", rgrp="rg").toPandas()
    for qi in [0, 5, 25, 150, 299]:
        d = np.hypot(pts[:, 0] - pts[qi, 0], pts[:, 1] - pts[qi, 1])
        cand = [j for j in np.lexsort((np.arange(300), d)) if grp[j] != grp[qi]][:7]
        mine = got[got.id == qi].sort_values("rank")["rid"].tolist()
        assert mine == cand


def test_knn_exclude_self_and_few_refs(spark):
    df = spark.createDataFrame([(0, 0.0, 0.0), (1, 1.0, 0.0), (2, 5.0, 5.0)], "id long, x double, y double")
    r = df.select(F.col("id").alias("rid"), F.col("x").alias("rx"), F.col("y").alias("ry"))
    got = SPT.knn_join(df, r, 5, "id", "rid", "x", "y", "rx", "ry", exclude_self_id=True).toPandas()
    assert sorted(got.groupby("id").size().tolist()) == [2, 2, 2]  # fewer refs than k: all others


def _layout(name, n, rng):
    """Point sets that break a fixed grid, with the groups they come in."""
    pts, grp = rng.normal(size=(n, 2)) * [3.0, 0.5], rng.integers(0, 4, n)
    if name == "far_reference":
        pts[0] = [1e9, -1e9]
    elif name == "dense_spot":
        pts[: n // 2] = rng.normal(size=(n // 2, 2)) * 1e-6 + 7.0
    elif name == "one_spot":
        pts[: n // 2] = [2.0, 2.0]
    elif name == "groups_apart":
        pts += grp[:, None] * 50.0
    elif name == "line":
        pts[:, 1] = 1.0
    return pts, grp


@pytest.mark.parametrize("name,grouped", [("far_reference", True), ("dense_spot", True), ("one_spot", True), ("one_spot", False),
                                          ("groups_apart", True), ("line", False)])
def test_knn_layouts(spark, name, grouped):
    """Brute-force agreement, ties by id included; one query lies far away, one has no coordinates, one no group."""
    n, k = 700, 6
    rng = np.random.default_rng(11)
    pts, grp = _layout(name, n, rng)
    q = [(i, float(x), float(y), int(g)) for i, ((x, y), g) in enumerate(zip(pts, grp))]
    q += [(n, 1e7, 3e7, 1), (n + 1, None, 0.0, 1), (n + 2, float("nan"), 0.0, 1), (n + 3, 0.1, 0.1, None)]
    df = spark.createDataFrame(q, "id long, x double, y double, g long").repartition(3)
    r = df.filter("id < 700").select(F.col("id").alias("rid"), F.col("x").alias("rx"), F.col("y").alias("ry"), F.col("g").alias("rg"))
    kw = dict(qgrp="g", rgrp="rg") if grouped else dict(exclude_self_id=True)
    got = SPT.knn_join(df, r, k, "id", "rid", "x", "y", "rx", "ry", cap=16, **kw).toPandas()
    got = {i: list(zip(g["rid"], g["dist"])) for i, g in got.sort_values("rank").groupby("id")}
    assert n + 1 not in got and n + 2 not in got
    for i, x, y, g in q:
        if x is None or np.isnan(x):
            continue
        du, dv = x - pts[:, 0], y - pts[:, 1]
        d = np.sqrt(du * du + dv * dv)
        ok = (np.ones(n, bool) if g is None else grp != g) if grouped else np.arange(n) != i
        want = [j for j in np.lexsort((np.arange(n), d)) if ok[j]][:k]
        assert [j for j, _ in got[i]] == want, i
        assert np.allclose([x for _, x in got[i]], d[want])


@pytest.mark.parametrize("name", ["far_reference", "dense_spot", "groups_apart"])
def test_knn_probes_stay_few(spark, name):
    """Candidates per query stay few as points grow, whatever their layout."""
    mean = []
    for n in (800, 3200):
        pts, grp = _layout(name, n, np.random.default_rng(5))
        rows = [(i, float(x), float(y), int(g)) for i, ((x, y), g) in enumerate(zip(pts, grp))]
        rows += [(n, 1e7, 3e7, 1)]
        df = spark.createDataFrame(rows, "id long, x double, y double, g long")
        r = df.select(F.col("id").alias("rid"), F.col("x").alias("rx"), F.col("y").alias("ry"), F.col("g").alias("rg"))
        cand = SPT.knn_candidates(df, r, 5, "id", "rid", "x", "y", "rx", "ry", "g", "rg", cap=16)
        per = [x["count"] for x in cand.groupBy("_qid").count().collect()]
        mean.append(sum(per) / n)
    # a far cluster shows its edge: the square root of its tiles
    assert mean[1] < 200 and mean[1] < 2 * mean[0] + 20


def test_knn_several_levels(spark):
    """More than sixteen tiles of tiles: the descent passes through inner nodes."""
    rng = np.random.default_rng(2)
    pts = rng.random((6000, 2))
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(pts)], "id long, x double, y double")
    r = df.select(F.col("id").alias("rid"), F.col("x").alias("rx"), F.col("y").alias("ry"))
    got = SPT.knn_join(df.filter("id % 50 = 0"), r, 3, "id", "rid", "x", "y", "rx", "ry", exclude_self_id=True, cap=4).toPandas()
    for i, g in got.groupby("id"):
        d = np.hypot(pts[:, 0] - pts[i, 0], pts[:, 1] - pts[i, 1])
        d[i] = np.inf
        assert g.sort_values("rank")["rid"].tolist() == np.argsort(d, kind="stable")[:3].tolist()


def test_subseq_match_sse_numpy(spark):
    rng = np.random.default_rng(5)
    tx = np.round(np.arange(0, 60, 0.5), 2)
    ty = np.round(np.sin(tx / 3) * 10 + 20, 2)
    n = 25
    sig = np.round(np.interp(np.linspace(10, 30, n), tx, ty) + rng.normal(0, 0.3, n), 2)
    prior = np.linspace(9, 31, n)
    sig[4] = np.nan
    ev = spark.createDataFrame([(0, i, "t", float(prior[i]), None if np.isnan(sig[i]) else float(sig[i])) for i in range(n)],
                               "entity long, e long, tid string, prior double, s double")
    ref = spark.createDataFrame([("t", float(a), float(b)) for a, b in zip(tx, ty)], "tid string, x double, y double")
    got = MT.subseq_match_sse(ev, ref, "entity", "e", "tid", "prior", "s", half=5, search=8.0).orderBy("e").toPandas()
    known = [j for j in range(n) if not np.isnan(sig[j])]
    smooth = np.interp(range(n), known, sig[known])
    for row in range(n):
        near = [j for j in range(n) if abs(j - row) <= 5]
        options = []
        for start in range(len(tx)):
            stretch = range(start, start + len(near))
            if stretch[-1] >= len(tx) or not (prior[row] - 8.0 <= tx[start] and tx[stretch[-1]] < prior[row] + 8.0):
                continue
            cost = sum((ty[r] - smooth[j]) ** 2 for r, j in zip(stretch, near))
            options.append((cost, start))
        cost, start = min(options)
        assert abs(got.loc[row, "match_x"] - tx[start + near.index(row)]) < 1e-9
        assert abs(got.loc[row, "err"] - cost / len(near)) < 1e-9


def test_subseq_match_sse_searches_100_on_either_side(spark, tmp_path):
    """The query finds a stretch 50 to 60 away from the priors, and not a better one beyond 100; DuckDB agrees."""
    import duckdb
    import pyarrow as pa
    import pyarrow.parquet as pq

    import __spark_entry__ as E
    from compare import same_result
    n, known = 40, 28
    value = [20.0 + (i * i * 3) % 17 for i in range(n)]
    kind = ["error" if i == known + 4 else "view" for i in range(n)]
    events = {"event_id": range(n), "ts": pa.array([i * 3_600_000_000 for i in range(n)], pa.timestamp("us")), "user_id": [0] * n,
              "event_type": kind, "value": value, "props": ['{"k": 1}'] * n}
    size = [1 + j * 7 % 5 for j in range(180)]
    for e, v in enumerate(value[known:]):
        size[60 + e] = int(v) + e % 2      # within reach of each row, with a small error
        size[150 + e] = int(v)             # beyond it, without
    part = {"p_partkey": range(180), "p_brand": ["Brand#1"] * 180, "p_retailprice": [900.0 + j for j in range(180)],
            "p_size": pa.array(size, pa.int32()), "p_type": ["t"] * 180}
    con = duckdb.connect()
    for name, columns in (("events", events), ("part", part)):
        pq.write_table(pa.table({c: v if isinstance(v, pa.Array) else pa.array(v) for c, v in columns.items()}), f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet')")
    found = E.queries()["subseq_match_sse"](spark, str(tmp_path)).toArrow()
    same_result(found, con.sql(E.oracle_sql()["subseq_match_sse"]).to_arrow_table())
    got = {r["i"] - known: r for r in found.to_pylist()}
    signal = value[known:]
    signal[4] = (signal[3] + signal[5]) / 2
    assert len(got) == len(signal)
    for e in range(len(signal)):
        prior = 900 + value[known + e] / 5
        near = [j for j in range(len(signal)) if abs(j - e) <= 5]
        options = []
        for start in range(len(size) - len(near) + 1):
            if prior - 100 <= 900 + start and 900 + start + len(near) - 1 < prior + 100:
                options.append((sum((size[start + k] - signal[j]) ** 2 for k, j in enumerate(near)), start))
        cost, start = min(options)
        assert got[e]["match_x"] == 900 + start + near.index(e) == 960 + e
        assert got[e]["err"] == pytest.approx(cost / len(near), abs=1e-6)

"""Curve pieces: bounded arrays on dense, sparse and repeated points, and both ways of finding a piece."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.operators import curves as C
from stratum.operators import matching as MT


def curve(name, n=500):
    rng = np.random.default_rng(4)
    x = {"dense": rng.random(n), "sparse": np.sort(rng.random(n // 10)) * 1e9, "repeats": rng.integers(0, 6, n).astype(float),
         "mixed": np.concatenate([rng.random(n), [1e7, -1e7]])}[name]
    return np.round(x, 6), np.round(rng.normal(size=len(x)), 6)


def frames(spark, x, y, q):
    ref = spark.createDataFrame([("a", float(a), float(b)) for a, b in zip(x, y)] + [("b", 1.0, 2.0)], "k string, x double, y double")
    rows = [(i, "a", float(v)) for i, v in enumerate(q)] + [(900, "a", None), (901, "none", 1.0), (902, "b", 7.0), (903, None, 1.0), (904, "a", float("nan"))]
    return ref.repartition(3), spark.createDataFrame(rows, "id long, k string, q double")


@pytest.fixture(params=["broadcast", "one order"])
def way(request, monkeypatch):
    if request.param != "broadcast":
        monkeypatch.setattr(C, "BROADCAST_ROWS", 0)


@pytest.mark.parametrize("name", ["dense", "sparse", "repeats", "mixed"])
def test_lookups(spark, way, name):
    x, y = curve(name)
    rng = np.random.default_rng(1)
    q = np.concatenate([rng.choice(x, 20), rng.uniform(x.min() - 1, x.max() + 1, 20), [x.min(), x.max(), x.min() - 5, x.max() + 5]])
    ref, df = frames(spark, x, y, q)
    pieces = C.curve_pieces(ref, "k", "x", "y", 16, tail=5)
    sizes = pieces.select(F.size("_pts").alias("n"), F.size("_after").alias("m")).collect()
    assert max(r["n"] for r in sizes) <= 16 and max(r["m"] for r in sizes) <= 5
    assert len(sizes) == 1 + -(-len(x) // 16)                      # no piece for a gap
    order = np.lexsort((y, x))
    xs, ys = x[order], y[order]
    got = {r["id"]: r["v"] for r in MT.interp_lookup(df, ref, "k", F.col("q"), "x", "y", "v", pieces).collect()}
    assert len(got) == len(q) + 5 and got[900] is None and got[901] is None and got[902] == 2.0 and got[903] is None and got[904] is None
    near = {r["id"]: (r["nx"], r["ny"]) for r in MT.nearest_key(df, ref, "k", F.col("q"), "x", "y", "nx", "ny").collect()}
    for i, v in enumerate(q):
        at = np.searchsorted(xs, v, side="right") - 1
        if at >= 0 and xs[at] == v:
            want = ys[at]
        elif at < 0:
            want = ys[0]
        elif at == len(xs) - 1:
            want = ys[-1]
        else:
            want = ys[at] + (ys[at + 1] - ys[at]) / (xs[at + 1] - xs[at]) * (v - xs[at])
        assert got[i] == pytest.approx(want, abs=1e-9)
        assert abs(near[i][0] - v) == pytest.approx(np.abs(x - v).min())


@pytest.mark.parametrize("name", ["dense", "repeats", "mixed"])
def test_ranges_over_many_pieces(spark, way, name):
    """Windows that hold far more points than a piece, and windows with none."""
    x, y = curve(name)
    rng = np.random.default_rng(2)
    p = rng.uniform(x[:-2].min() - 1, x[:-2].max() + 1, 40)
    g = rng.normal(size=40)
    ref, _ = frames(spark, x, y, p)
    df = spark.createDataFrame([(i, "a", float(a), float(b)) for i, (a, b) in enumerate(zip(p, g))], "id long, k string, p double, g double")
    got = {r["id"]: r["out"] for r in MT.range_nearest(df, ref, "k", "p", "g", "out", 0.4).collect()}
    for i, (a, b) in enumerate(zip(p, g)):
        inside = (x >= a - 0.4) & (x <= a + 0.4)
        want = min(((abs(v - b), u) for u, v in zip(x[inside], y[inside])), default=(0, a))[1]
        assert got[i] == want


def test_offsets_meet_a_piece_once(spark, way):
    x, y = curve("dense", 300)
    ref, _ = frames(spark, x * 100, y, [])
    df = spark.createDataFrame([(i, "a", float(i), 5.0 * i) for i in range(20)] + [(50, "none", 1.0, 1.0), (51, "a", 1.0, None)],
                               "id long, k string, s double, p double")
    offs = [-80, -7, 0, 7, 80]
    got = MT.interp_offsets(df, ref, "k", ["id"], "s", {"u": (F.col("p"), offs), "v": (F.col("p") * 0 + 50, offs)}, "x", "y")
    assert got.columns == ["id", *[f"{a}_{n}" for a in "uv" for n in ("m80", "m7", "p0", "p7", "p80")]]
    rows = {r["id"]: r for r in got.collect()}
    order = np.argsort(x)
    for i in range(20):
        want = [i - np.interp(c + o, x[order] * 100, y[order]) for c in (5.0 * i, 50.0) for o in offs]
        assert np.allclose(list(rows[i])[1:], want)
    assert set(list(rows[50])[1:]) == {None} and rows[51]["u_p0"] is None and len(rows) == 22


def _both_ways(monkeypatch, make):
    """Sorted rows by broadcast curves and by joined pieces."""
    from stratum.operators import curves as CV
    out = []
    for limit in (CV.CURVE_POINTS, 0):
        monkeypatch.setattr(CV, "CURVE_POINTS", limit)
        df = make()
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert ("MapInArrow" in plan) == (limit > 0)
        out.append(sorted(map(repr, df.collect())))
    return out


def test_offsets_by_broadcast_and_by_pieces(spark, monkeypatch):
    ref = spark.createDataFrame([(f"k{i % 3}", float(i % 40), float(i * i % 17)) for i in range(150)]
                                + [("k0", None, 1.0), ("k1", 5.0, None), ("k2", float("nan"), 2.0), (None, 1.0, 1.0)], "k string, x double, y double")
    rows = [(i, f"k{i % 4}", None if i % 11 == 0 else i / 3, i / 2 - 10) for i in range(120)]
    rows += [(200, None, 1.0, 1.0), (201, "k1", 1.0, None), (202, "k1", 1.0, float("nan")), (203, "k1", float("nan"), 3.0), (203, "k1", 1.0, 3.0)]
    df = spark.createDataFrame(rows, "id long, k string, s double, p double")
    offs = [-15.0, 0.0, 0.25, 30.0]
    a, b = _both_ways(monkeypatch, lambda: MT.interp_offsets(df, ref, "k", ["id"], "s", {"u": (F.col("p"), offs[:2]), "v": (F.col("p") + 1, offs[2:])}, "x", "y"))
    assert a == b and len(a) == len(rows)


def test_window_match_by_broadcast_and_by_pieces(spark, monkeypatch):
    ref = spark.createDataFrame([(f"k{i % 3}", float(i // 3) / 4, float(i // 12 % 5)) for i in range(240)] + [("few", 1.0, 1.0)], "k string, x double, y double")
    rows = [(e, i, "few" if e == 3 else f"k{e}", None if i == 7 else 4.0 + i / 3, None if (i % 9 == 4 or e == 4) else float(i % 5) / 2) for e in range(6) for i in range(30)]
    ev = spark.createDataFrame(rows, "entity long, e long, k string, prior double, s double")
    a, b = _both_ways(monkeypatch, lambda: MT.subseq_match_sse(ev, ref, "entity", "e", "k", "prior", "s", half=3, search=4.0, sse_digits=5))
    assert a == b and len(a) == len(rows) and any("match_x=None" not in r for r in a)


def test_window_match_on_many_pieces(spark, monkeypatch):
    """Pieces smaller than a row's reach, dealt to several tasks and cut by Arrow batches, find what whole curves find."""
    rng = np.random.default_rng(3)
    ref = spark.createDataFrame([(f"k{i % 3}", float(x), float(y)) for i, (x, y) in enumerate(zip(rng.integers(0, 400, 600) / 4, rng.integers(0, 6, 600)))]
                                + [("few", 1.0, 1.0)], "k string, x double, y double")
    rows = [(e, i, "few" if e == 4 else None if e == 5 else f"k{e % 3}", None if i == 7 else float("nan") if i == 8 else i * 4.0 - 20,
             float("nan") if (e, i) == (1, 20) else None if i % 9 == 4 else float(rng.integers(0, 12)) / 2) for e in range(6) for i in range(40)]
    ev = spark.createDataFrame(rows, "entity long, e long, k string, prior double, s double")
    monkeypatch.setattr(MT, "SSE_POINTS", 16)
    monkeypatch.setattr(MT, "SSE_ROWS", 10)
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    spark.conf.set(batch, "7")
    try:
        a, b = _both_ways(monkeypatch, lambda: MT.subseq_match_sse(ev.filter("NOT (entity = 1 AND e BETWEEN 17 AND 23)"), ref, "entity", "e", "k", "prior", "s",
                                                                   half=3, search=30.0, sse_digits=5))
        _, c = _both_ways(monkeypatch, lambda: MT.subseq_match_sse(ev, ref, "entity", "e", "k", "prior", "s", half=3, search=30.0, sse_digits=5))
    finally:
        spark.conf.set(batch, before)
    assert a == b and sum("match_x=None" not in r for r in a) > 100
    assert len(c) == len(rows) and sum("err=nan" in r for r in c) == 7      # a NaN signal: windows that hold it have no error

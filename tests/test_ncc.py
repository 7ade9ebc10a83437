"""The bounded window search against plain numpy, over several chunks and runs, and how much it spares."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.operators import matching as MT

HALF = 6


def series(n, seed):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    return np.round(np.sin(t / 7.0) * 4 + np.sin(t / 23.0) * 9 + rng.normal(0, 0.5, n), 4)


def smoothed(x):
    return np.array([x[max(0, i - 2):i + 3].mean() for i in range(len(x))])


def plain(known, labels, ev):
    win, s, e = 2 * HALF + 1, smoothed(known), smoothed(ev)
    def z(v):
        return (v - v.mean()) / (v.std() + 1e-6)
    if len(known) < win + 1:
        return [(labels[-1], 0.0)] * len(ev)
    cands = [(k, z(s[k:k + win])) for k in range(0, len(known) - win + 1, 3)]
    out = []
    for i in range(len(ev)):
        h = z(np.array([e[min(max(j, 0), len(e) - 1)] for j in range(i - HALF, i + HALF + 1)]))
        score, k = max(((float(h @ c) / win, -k) for k, c in cands))
        out.append((labels[-k + HALF], score))
    return out


@pytest.fixture(scope="module")
def data(spark):
    kn, ev, raw = [], [], {}
    for entity, (nk, ne) in enumerate([(400, 150), (60, 20), (10, 5), (14, 3)]):
        x = series(nk + ne, entity)
        labels = np.round(np.cumsum(np.ones(nk)) * 1.5, 3)
        kn += [(entity, i, float(x[i]), float(labels[i])) for i in range(nk)]
        ev += [(entity, i, float(x[nk + i]), nk + i) for i in range(ne)]
        raw[entity] = (x[:nk], labels, x[nk:])
    return (spark.createDataFrame(kn, "entity long, kp long, sig double, lab double").repartition(3),
            spark.createDataFrame(ev, "entity long, ep long, sig double, row long").repartition(3), raw)


@pytest.mark.parametrize("chunk,runs", [(1024, 1 << 13), (8, 16)])
def test_same_argmax(spark, data, monkeypatch, chunk, runs):
    monkeypatch.setattr(MT, "NCC_EVAL_ROWS", runs)
    kn, ev, raw = data
    got = MT.subseq_match_ncc(kn, ev, "entity", "kp", "ep", "sig", "sig", "lab", half=HALF, chunk=chunk)
    got = {(r["entity"], r["ep"]): (r["ncc_label"], r["ncc_score"]) for r in got.collect()}
    for entity, (x, labels, e) in raw.items():
        for i, (label, score) in enumerate(plain(x, labels, e)):
            assert got[entity, i][1] == pytest.approx(score, abs=1e-9)
            assert got[entity, i][0] == label


def test_bound_holds_and_spares_scoring(spark):
    """Few of many candidates are scored in full, and the best is the best of all."""
    rng = np.random.default_rng(3)
    n = 31
    walk = np.cumsum(rng.normal(size=3000))
    wins = [walk[i:i + n] for i in range(0, 2900, 10)]
    z = [(w - w.mean()) / (w.std() + 1e-6) for w in wins]
    waves = MT._waves(n, 6)
    basis = np.array(waves)
    assert np.allclose(basis @ basis.T, np.eye(6), atol=1e-12)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(z)], "start long, z array<double>")
    cands = (df.select("start", MT._signature(F.col("z"), waves).alias("s"), (F.col("start") * 1.0).alias("label"))
             .agg(F.sort_array(F.collect_list(F.struct("start", "s", "label"))).alias("cands")))
    asked = [walk[i:i + n] + rng.normal(0, 0.2, n) for i in range(5, 2900, 97)]
    asked = [(q - q.mean()) / (q.std() + 1e-6) for q in asked]
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "id long, z array<double>")
    rows = (q.crossJoin(cands).select("id", MT._best_match(MT._signature(F.col("z"), waves), F.col("cands"), n).alias("b"))
            .select("id", "b.*").collect())
    for r in rows:
        scores = [float(asked[r["id"]] @ c) / n for c in z]
        assert r["score"] == pytest.approx(max(scores)) and -r["neg_start"] == int(np.argmax(scores))
    assert sum(r["scored"] for r in rows) < 0.5 * len(rows) * len(z)


def test_pairs_do_not_cross_the_network(spark, data):
    """After the join of rows and chunks only one row's best is exchanged."""
    kn, ev, _ = data
    out = MT.subseq_match_ncc(kn, ev, "entity", "kp", "ep", "sig", "sig", "lab", half=HALF)
    lines = out._jdf.queryExecution().executedPlan().toString().splitlines()
    join = next(i for i, x in enumerate(lines) if "Join" in x and "_run" in x)
    above = [x for x in lines[:join] if "Exchange" in x]
    assert above and not any("_cands" in x or "_sig" in x for x in above)
    assert "RoundRobin" not in "".join(lines[:join])

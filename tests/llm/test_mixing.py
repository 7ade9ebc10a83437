"""Raking against a dense table, and the calibration of the sample."""

import numpy as np
import pytest

from stratum.llm import mixing as M


def dense_rake(t, goals, sweeps=200):
    w = t / t.sum()
    for _ in range(sweeps):
        for axis, g in enumerate(goals):
            have = w.sum(axis=tuple(a for a in range(3) if a != axis))
            f = np.where(have > 0, g / np.where(have > 0, have, 1), 0)
            w = w * f.reshape([-1 if a == axis else 1 for a in range(3)])
    return w


def cells_of(spark, t):
    rows = [(f"s{i}", f"l{j}", f"t{k}", float(t[i, j, k])) for i, j, k in np.ndindex(*t.shape) if t[i, j, k] > 0]
    return spark.createDataFrame(rows, "source string, lang string, topic string, tokens double")


def test_rake_matches_a_dense_table(spark):
    rng = np.random.default_rng(0)
    t = rng.integers(0, 50, (3, 2, 2)).astype(float) + 1
    t[0, 1, 0] = 0
    goals = [rng.dirichlet(np.ones(n)) for n in t.shape]
    targets = {a: spark.createDataFrame([(f"{a[0]}{i}", float(x)) for i, x in enumerate(g)] + [("absent", 0.0)], "value string, share double")
               for a, g in zip(M.AXES, goals)}
    got = M.rake(cells_of(spark, t), targets, tolerance=1e-9).collect()
    want = dense_rake(t, goals)
    for r in got:
        assert r["fitted"] == pytest.approx(want[int(r["source"][1:]), int(r["lang"][1:]), int(r["topic"][1:])], abs=1e-6)


def test_rate_meets_the_budget(spark):
    rng = np.random.default_rng(1)
    t, w = rng.integers(1, 1000, 40).astype(float), rng.dirichlet(np.ones(40))
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(t, w)], "tokens double, fitted double")
    for share in (0.1, 0.5, 0.9, 1.0):
        rate = M.sampling_rate(df, share * t.sum())
        assert np.minimum(t, rate * w).sum() == pytest.approx(share * t.sum(), rel=1e-4)


def test_rate_meets_the_budget_beside_nearly_empty_cells(spark):
    rng = np.random.default_rng(7)
    t, w = rng.integers(1, 1000, 40).astype(float), rng.dirichlet(np.ones(40))
    for tiny in (1e-12, 1e-300):
        v = np.where(np.arange(40) % 4 == 0, w * tiny, w)
        df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(t, v)], "tokens double, fitted double")
        for share in (0.3, 0.99):
            rate = M.sampling_rate(df, share * t.sum())
            assert np.minimum(t, rate * v).sum() == pytest.approx(share * t.sum(), rel=1e-9)
    assert M.sampling_rate(df, 0.0) == 0.0


def test_rate_meets_the_budget_under_targets_that_no_weights_meet(spark):
    # s0 holds l0 only and wants more than l0 may have, so the cell (s1, l0) shrinks with every sweep
    t = np.array([[700.0, 0], [400, 900]]).reshape(2, 2, 1)
    goals = {"source": [("s0", 0.7), ("s1", 0.3)], "lang": [("l0", 0.1), ("l1", 0.9)]}
    fitted = M.rake(cells_of(spark, t), {a: spark.createDataFrame(g, "value string, share double") for a, g in goals.items()}, max_sweeps=9, tolerance=0.0)
    rows = fitted.collect()
    w, n = np.array([r["fitted"] for r in rows]), np.array([r["tokens"] for r in rows])
    rate = M.sampling_rate(fitted, 0.5 * n.sum())
    assert 0 < w.min() < 1e-9 and np.minimum(n, rate * w).sum() == pytest.approx(0.5 * n.sum(), rel=1e-9)


def test_mix_is_calibrated_and_keeps_every_row(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = M.mix(docs, budget_share=0.4).collect()
    assert len(out) == docs.count()
    tokens = np.array([r["n_tokens"] for r in out], float)
    p = np.array([r["probability"] for r in out])
    assert (p * tokens).sum() == pytest.approx(0.4 * tokens.sum(), rel=1e-3) and ((p >= 0) & (p <= 1)).all()
    taken = np.array([r["sampled"] for r in out])
    assert abs((taken * tokens).sum() - (p * tokens).sum()) < 5 * np.sqrt((p * (1 - p) * tokens ** 2).sum())
    w = np.array([r["weight"] for r in out]) * tokens / tokens.sum()
    share = {}
    for r, x in zip(out, tokens):
        share[r["lang"]] = share.get(r["lang"], 0) + x / tokens.sum()
    z = sum(np.sqrt(x) for x in share.values())
    for lang, x in share.items():
        assert w[[r["lang"] == lang for r in out]].sum() == pytest.approx(np.sqrt(x) / z, abs=2e-3)
    assert M.sample(docs, budget_share=0.4).count() == taken.sum()


def test_nulls_repeats_empty_table_and_clashing_columns(spark):
    rows = [(1, "a b c", "en", "s", 9), (1, "a b c", "en", "s", 9), (None, None, None, None, None), (2, "", "fr", None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, weight long")
    out = M.mix(df)
    assert out.columns[:5] == df.columns and "weight_" in out.columns and out.count() == 4
    same = [r["sampled"] for r in out.where("doc_id = 1").collect()]
    assert same[0] == same[1]
    assert M.mix(df.limit(0)).count() == 0
    assert M.sample(df, budget_share=1.0).count() == 4


def test_both_forms_of_the_sums_agree(spark, monkeypatch):
    rows = [("s0", "l0", "t0", 5.0), ("s0", "l0", "t0", 5.0), ("s1", "l0", "t1", 7.0), ("s1", "l1", "t0", 1.0), ("s2", "l1", "t1", 4.0),
            (None, "l0", "t0", 3.0), ("s0", None, "t1", 2.0)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens double")
    targets = {"source": [("s0", 0.5), ("s1", 0.5)], "lang": [("l0", 0.3), ("l1", 0.7), ("l9", 0.4)], "topic": [("t0", 0.5), ("t1", 0.5)]}
    targets = {a: spark.createDataFrame(t, "value string, share double") for a, t in targets.items()}

    def fitted():
        out = M.rake(cells, targets, max_sweeps=6, tolerance=0.0)
        assert sorted(out.columns) == ["fitted", "lang", "source", "tokens", "topic"]
        return sorted((r["source"], r["lang"], r["topic"], r["tokens"], r["fitted"]) for r in out.collect())

    few = fitted()
    monkeypatch.setattr(M, "FEW_CELLS", 0)
    many = fitted()
    assert len(few) == 5 and [r[:4] for r in few] == [r[:4] for r in many]
    assert [r[4] for r in few] == pytest.approx([r[4] for r in many], rel=1e-9)


def test_sweeps_over_few_cells_take_few_jobs(spark):
    rng = np.random.default_rng(3)
    cells = cells_of(spark, rng.integers(1, 50, (3, 2, 2)).astype(float))
    targets = {a: spark.createDataFrame([(f"{a[0]}{i}", float(x)) for i, x in enumerate(rng.dirichlet(np.ones(n)))], "value string, share double")
               for a, n in zip(M.AXES, (3, 2, 2))}

    def jobs(sweeps):
        spark.sparkContext.setJobGroup(f"sweeps-{sweeps}", "")
        try:
            M.rake(cells, targets, max_sweeps=sweeps, tolerance=0.0)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"sweeps-{sweeps}"))

    assert jobs(3) - jobs(1) <= 8                   # a write, a sum and the two of release for each sweep; 26 when each axis was shuffled

"""FTRL against its published update, held-out accuracy, and odd texts."""

import math
import random

import numpy as np

from stratum.llm import toxicity as T


def test_update_follows_the_published_rule():
    rng = np.random.default_rng(0)
    m = T.Ftrl(bits=4, alpha=0.3, beta=0.7, l1=0.2, l2=0.4)
    z, n = [0.0] * 17, [0.0] * 17
    for _ in range(200):
        x, y, c = rng.integers(0, 16, 5), int(rng.integers(2)), float(rng.uniform(0.5, 2))
        at = [*sorted(set(x.tolist())), 16]
        w = {}
        for i in at:
            l1 = 0.0 if i == 16 else 0.2
            w[i] = 0.0 if abs(z[i]) <= l1 else -(z[i] - math.copysign(l1, z[i])) / ((0.7 + math.sqrt(n[i])) / 0.3 + 0.4)
        p = 1 / (1 + math.exp(-sum(w.values())))
        for i in at:
            g = c * (p - y)
            s = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / 0.3
            z[i] += g - s * w[i]
            n[i] += g * g
        m.learn(x, y, c)
    assert np.allclose(m.z, z) and np.allclose(m.n, n)


def corpus(n=1200):
    rng = random.Random(5)
    plain, bad = [f"w{i}" for i in range(300)], ["vile", "scum", "rotten"]
    rows = []
    for i in range(n):
        w = rng.choices(plain, k=rng.randint(5, 80))
        y = int(rng.random() < .2)
        if y:
            for _ in range(2):
                w.insert(rng.randrange(len(w)), rng.choice(bad))
        rows.append((i, " ".join(w), y))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = {r["doc_id"]: r for r in T.scored(df.select("doc_id", "text"), df.select("doc_id", "toxic")).collect()}
    held = [(got[i]["predicted"], y) for i, _, y in rows if got[i]["held_out"]]
    assert len(held) > 200 and np.mean([p == y for p, y in held]) > 0.97


def test_model_is_sparse_and_bounded_samples_are_weighted(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string, toxic int")
    m = T.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"), positives=100, negatives=150)
    assert 0 < len(m) < 2000 and m[-1] < 0


def test_nulls_repeats_empty_tables_and_other_columns(spark):
    rows = corpus(200) + [(7, None, 1), (None, "scum", 1), (8, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").withColumn("score", T.F.lit("x"))
    got = T.scored(df.select("doc_id", "text"), df.select("doc_id", "toxic")).collect()
    assert len(got) == 203 and all(0 <= r["score"] <= 1 for r in got)
    empty = T.scored(df.select("doc_id", "text"), df.select("doc_id", "toxic").limit(0)).collect()
    assert {r["score"] for r in empty} == {0.5}
    assert T.scored(df.select("doc_id", "text").limit(0), df.select("doc_id", "toxic")).count() == 0

"""Two-pass selection against numpy, with brackets small enough to leave most rows out."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.operators.quantiles import grouped_medians, grouped_quantiles

def wanted():
    return {"q10": ("v", 0.1), "q50": ("v", 0.5), "q95": ("v", 0.95), "w50": (F.col("w") * 2, 0.5), "lo": ("v", 0.0), "hi": ("v", 1.0)}


def table(spark, n, seed):
    """One group has most rows, one has few values repeated very often, one has one row, one has only nulls, one is null."""
    rng = np.random.default_rng(seed)
    rows = [("hot", float(x), float(y)) for x, y in zip(rng.normal(size=n), rng.integers(0, 5, n))]
    rows += [("ties", float(x), float(x)) for x in rng.integers(0, 3, n // 2)]
    rows += [("one", 4.0, None), ("nulls", None, None), ("nulls", None, None), (None, 1.0, 2.0), (None, 2.0, 3.0)]
    rows += [(f"g{i % 40}", float(x), None if i % 3 else float(i)) for i, x in enumerate(rng.exponential(size=n // 4))]
    return rows, spark.createDataFrame(rows, "g string, v double, w double").repartition(5)


def expected(rows):
    groups = {}
    for g, v, w in rows:
        groups.setdefault(g, []).append((v, w))
    def q(xs, p):
        xs = [x for x in xs if x is not None]
        return None if not xs else float(np.quantile(xs, p))
    return {g: (q([v for v, _ in r], .1), q([v for v, _ in r], .5), q([v for v, _ in r], .95),
                q([None if w is None else 2 * w for _, w in r], .5), q([v for v, _ in r], 0), q([v for v, _ in r], 1)) for g, r in groups.items()}


@pytest.mark.parametrize("accuracy", [20, 100, 10_000])
def test_against_numpy(spark, accuracy):
    rows, df = table(spark, 6000, accuracy)
    got = {r["g"]: tuple(r)[1:] for r in grouped_quantiles(df, ["g"], wanted(), accuracy).collect()}
    want = expected(rows)
    assert got.keys() == want.keys()
    for g in want:
        assert got[g] == pytest.approx(want[g], abs=1e-12), g


def test_whole_table_empty_table_and_two_keys(spark):
    rows, df = table(spark, 2000, 1)
    (r,) = grouped_medians(df, [], {"m": "v"}, 50).collect()
    assert r["m"] == pytest.approx(np.median([v for _, v, _ in rows if v is not None]), abs=1e-12)
    assert grouped_medians(df.limit(0), ["g"], {"m": "v"}).count() == 0
    two = df.withColumn("h", F.col("v") > 1)
    got = {(r["g"], r["h"]): r["m"] for r in grouped_medians(two, ["g", "h"], {"m": "v"}, 30).collect()}
    hot = [v for g, v, _ in rows if g == "hot"]
    assert got["hot", True] == pytest.approx(np.median([v for v in hot if v > 1]), abs=1e-12) and got["nulls", None] is None


def test_second_pass_moves_few_rows(spark):
    """Of a large group only the bracket's values reach the window."""
    df = spark.range(200_000).select(F.lit("a").alias("g"), F.xxhash64("id").cast("double").alias("v"))
    out = grouped_medians(df, ["g"], {"m": "v"}, 500)
    assert out.first()["m"] == pytest.approx(float(np.median([r["v"] for r in df.collect()])))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile(" not in plan.replace("approx_percentile(", "").replace("percentile_approx(", "") and "median(" not in plan


def test_few_groups_are_not_shuffled(spark):
    """Brackets of few groups go to the rows, whatever the broadcast threshold: no task reads a whole group."""
    from stratum.operators.quantiles import grouped_medians
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = grouped_medians(spark.range(100).selectExpr("id % 2 AS g", "id AS v"), ["g"], {"m": "v"})
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan
        assert sorted(map(tuple, out.collect())) == [(0, 49.0), (1, 50.0)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)

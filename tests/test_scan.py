"""Range scans against a plain sort, with groups spread over many partitions."""

import random

import pytest
from pyspark.sql import functions as F

from stratum.operators import scan
from stratum.operators.metrics import running_share


def rows(n):
    rng = random.Random(3)
    return [(rng.choice(["hot", "hot", "hot", "b", None]), rng.randrange(n), i, rng.choice([None, 1.5, -2.0])) for i in range(n)]


@pytest.mark.parametrize("limit", [100_000, 0])
def test_places_sizes_and_sums(spark, monkeypatch, limit):
    monkeypatch.setattr(scan, "BROADCAST_ROWS", limit)
    data = rows(3000)
    df = spark.createDataFrame(data, "g string, k long, id long, v double").repartition(7)
    got = scan.range_scan(df, ["g"], [F.col("k").desc(), F.col("id").asc()], "i", "n", {"cum": F.col("v")})
    assert got.columns == ["g", "k", "id", "v", "i", "n", "cum"]
    got = {r["id"]: (r["i"], r["n"], r["cum"]) for r in got.collect()}
    groups = {}
    for g, k, i, v in data:
        groups.setdefault(g, []).append((-k, i, v))
    for members in groups.values():
        cum = 0.0
        for place, (_, i, v) in enumerate(sorted(members, key=lambda m: m[:2])):
            cum += v or 0.0
            assert got[i] == (place, len(members), pytest.approx(cum))


def test_whole_table_empty_table(spark):
    df = spark.range(500).withColumn("v", F.col("id") * 2.0)
    got = scan.range_scan(df, [], [F.col("id").desc()], "i", "n", {"s": F.col("v")}).orderBy("id").collect()
    assert [r["i"] for r in got] == list(range(499, -1, -1)) and got[0]["s"] == 499 * 500.0 and got[0]["n"] == 500
    assert scan.range_scan(df.limit(0), [], [F.col("id").asc()], "i").count() == 0


def test_running_share_needs_no_global_window(spark):
    per = spark.range(40).select(F.col("id").alias("entity"), (F.col("id") % 7).cast("double").alias("rmse"))
    out = running_share(per, "entity", "rmse")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan or "_scan_key" in plan
    rows = out.orderBy("rank").collect()
    assert rows[0]["rmse"] == 6.0 and rows[-1]["sq_err_share"] == pytest.approx(1.0) and rows[-1]["entity_share"] == 1.0

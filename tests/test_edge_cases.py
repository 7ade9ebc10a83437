"""Edge cases every operator family must handle (FIXTURES §4)."""

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from stratum.functions import scalar as S
from stratum.operators import models as MD
from stratum.operators import publish as PB
from stratum.operators import regression as R
from stratum.operators import tabular as T


def test_ols_fallbacks(spark):
    rows = [(0, float(i), float(i % 3), 2.0 * i + 1.0, i < 6) for i in range(9)]      # full fit
    rows += [(1, 0.0, 0.0, 5.0, True), (1, 1.0, 0.0, 0.0, False)]                   # 1 known row -> its mean
    rows += [(2, 0.0, 1.0, 1.0, False)]                                            # no known rows -> null
    rows += [(3, float(i), 7.0, 3.0 * i, i < 4) for i in range(6)]                  # constant x2 -> simple fit on x1
    rows += [(4, float(i), 1.0, 2.0, True) for i in range(3)]                       # no eval rows -> no output
    df = spark.createDataFrame(rows, "e long, x1 double, x2 double, y double, known boolean")
    out = {(r["e"], r["x1"]): r["pred"] for r in R.group_ols_2(df, "e", "x1", "x2", "y", "known").collect()}
    assert abs(out[(0, 8.0)] - 17.0) < 1e-9
    assert out[(1, 1.0)] == 5.0 and out[(2, 0.0)] is None
    assert abs(out[(3, 5.0)] - 15.0) < 1e-9
    assert not any(k[0] == 4 for k in out)


def test_mode_ties_take_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), ("c",)], "v string")
    assert {r["v"] for r in T.mode_fill(df, "v").collect()} == {"a", "b", "c"}
    assert T.mode_value(df, "v").first()["_mode"] == "a"


def test_collapse_rules_and_nulls(spark):
    df = spark.createDataFrame([("Mr",), ("Dr",), (None,), ("Jonkheer",)], "t string")
    got = df.select(S.collapse_listed("t", ["Dr", "Jonkheer"]).alias("a"), S.collapse_unlisted("t", ["Mr"]).alias("b")).collect()
    assert [r["a"] for r in got] == ["Mr", "Rare", None, "Rare"]      # listed rule: null stays null
    assert [r["b"] for r in got] == ["Mr", "Rare", "Rare", "Rare"]    # unlisted rule: null -> Rare
    b = df.select(S.bin_right_closed(F.lit(0.0), [0, 1, 4, 100], ["alone", "small", "large"]).alias("x")).first()
    assert b["x"] == "nan"                                            # outside every bin


def test_reconcile_duplicate_missing_extra(spark):
    exp = spark.createDataFrame([(i,) for i in range(5)], "id long")
    preds = spark.createDataFrame([(0, 1.0, 0), (0, 9.0, 1), (1, 3.0, 0), (7, 5.0, 0)], "id long, p double, src long")
    train = spark.createDataFrame([(6.5,)], "fallback double")
    out = PB.reconcile_submission(exp, preds, "id", "p", ["src"], train).orderBy("id").collect()
    assert [r["p"] for r in out] == [1.0, 3.0, 6.5, 6.5, 6.5]       # first by src; missing -> the training fallback
    r0 = out[0]
    assert (r0["n_expected"], r0["n_missing"], r0["n_extra"], r0["n_dupes"], r0["ok"]) == (5, 3, 1, 1, True)


def test_unseen_category_encodes_as_zeros(spark):
    tr = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (3.0, "a")], "x double, c string")
    te = spark.createDataFrame([(1.5, "zzz")], "x double, c string")
    model = Pipeline(stages=MD.preprocess_stages(["x"], ["c"])).fit(tr)
    v = model.transform(te).select(vector_to_array("features").alias("f")).first()["f"]
    assert v[1:] == [0.0, 0.0]
    seen = [r["f"][1:] for r in model.transform(tr).select(vector_to_array("features").alias("f")).collect()]
    assert seen == [[1.0, 0.0], [0.0, 1.0], [1.0, 0.0]]


def test_min_support_and_in_range(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 2.0), (1, 5.0)], "k long, v double")
    assert T.min_support_filter(df, "k", 2).count() == 2
    ref = spark.createDataFrame([(0, 1.5), (0, 2.0)], "k long, r double")
    assert [r["v"] for r in T.in_range_filter(df, ref, "k", "v", "r").collect()] == [2.0]

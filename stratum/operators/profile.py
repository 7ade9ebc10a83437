"""Table profiles: one aggregation pass per table, unpivoted with ``stack``.

Exact distinct counts of all columns take one narrow shuffle: cells become
(column number, 128-bit value digest), repeated cells fall away map-side, and
what is left is counted.  Rows are never copied whole per column, as several
``countDistinct`` in one aggregate would.  Pass ``approx=True`` to switch to
HyperLogLog sketches, whose size does not depend on the number of values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from stratum.operators.quantiles import grouped_quantiles


def _stack(df: DataFrame, names: Sequence[str], cols_per: Sequence[Sequence[str]], out: Sequence[str]) -> DataFrame:
    parts = []
    for n, cols in zip(names, cols_per):
        parts.append("'" + n + "'")
        parts.extend(f"`{c}`" for c in cols)
    expr = f"stack({len(names)}, {', '.join(parts)}) as ({', '.join(out)})"
    return df.selectExpr(expr)


def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """(column_name, n_unique): distinct non-null values per column; a column without any has 0."""
    if approx:
        agg = df.agg(*[F.approx_count_distinct(c).cast("long").alias(f"u_{c}") for c in cols])
        return _stack(agg, cols, [[f"u_{c}"] for c in cols], ["column_name", "n_unique"])
    cells = F.array(*[F.when(F.col(c).isNotNull(), F.struct(F.lit(i).alias("c"), F.xxhash64(c).alias("h1"),
                                                            F.xxhash64(F.lit("second"), c).alias("h2"))) for i, c in enumerate(cols)])
    seen = df.select(F.explode(cells).alias("cell")).where("cell IS NOT NULL").select("cell.*").distinct()
    names = df.sparkSession.createDataFrame(list(enumerate(cols)), "c int, column_name string")     # a row per column
    return (names.join(seen.groupBy("c").agg(F.count(F.lit(1)).alias("n")), "c", "left")
            .select("column_name", F.coalesce("n", F.lit(0)).cast("long").alias("n_unique")))


def distinct_profile(df: DataFrame, approx: bool = False) -> DataFrame:
    return distinct_counts(df, df.columns, approx)


TYPE_NAMES = {Ty.LongType: "long", Ty.IntegerType: "int", Ty.DoubleType: "double", Ty.StringType: "string",
              Ty.BooleanType: "bool", Ty.FloatType: "float", Ty.TimestampNTZType: "timestamp",
              Ty.TimestampType: "timestamp"}


def type_name(dt) -> str:
    return TYPE_NAMES.get(type(dt), dt.simpleString())


def profile_table(df: DataFrame, approx: bool = False) -> DataFrame:
    """Per column: type, n_unique, missing, missing % (2 dp); sorted by missing desc."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in cols:
        aggs.append(F.count_if(F.col(c).isNull()).cast("long").alias(f"m_{c}"))
    agg = df.agg(*aggs)
    types = {f.name: type_name(f.dataType) for f in df.schema.fields}
    parts = []
    for c in cols:
        parts += [f"'{c}'", f"'{types[c]}'", f"`m_{c}`"]
    st = agg.selectExpr("_n", f"stack({len(cols)}, {', '.join(parts)}) as (column_name, dtype, missing)")
    return st.join(distinct_counts(df, cols, approx), "column_name").select("column_name", "dtype", "n_unique", "missing",
                     F.round(F.col("missing") * 100.0 / F.col("_n"), 2).alias("missing_pct"))


def missing_pattern(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count of rows per null pattern (bit string, '1' = null)."""
    pat = F.concat(*[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in cols])
    return df.groupBy(pat.alias("pattern")).agg(F.count(F.lit(1)).alias("n_rows"))


def classify_columns(df: DataFrame, exclude: Sequence[str], max_levels: int = 12) -> DataFrame:
    """numeric vs low-cardinality categorical (<= max_levels distinct) vs other."""
    cols = [c for c in df.columns if c not in set(exclude)]
    prof = distinct_profile(df.select(*cols))
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, Ty.NumericType) and f.name in cols]
    return prof.withColumn(
        "kind", F.when(F.col("column_name").isin(numeric), F.lit("numeric"))
        .when(F.col("n_unique") <= max_levels, F.lit("categorical")).otherwise(F.lit("other")))


def adjusted_skewness(c: str):
    n = F.count(c)
    return F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2)


def quality_flags(df: DataFrame, numeric: Sequence[str], other: Sequence[str], skew_limit: float = 1.5,
                  missing_limit: float = 0.05, levels_limit: int = 30) -> DataFrame:
    """Per column: |adjusted skew| > 1.5, missing share > 5 %, non-numeric n_unique > 30."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in numeric:
        aggs += [adjusted_skewness(c).alias(f"s_{c}"), F.count_if(F.col(c).isNull()).alias(f"m_{c}")]
    for c in other:
        aggs += [F.lit(None).cast("double").alias(f"s_{c}"), F.count_if(F.col(c).isNull()).alias(f"m_{c}")]
    agg = df.agg(*aggs)
    cols = list(numeric) + list(other)
    parts = []
    for c in cols:
        parts += [f"'{c}'", "true" if c in numeric else "false", f"`s_{c}`", f"`m_{c}`"]
    st = agg.selectExpr("_n", f"stack({len(cols)}, {', '.join(parts)}) as (column_name, is_numeric, skew, missing)")
    st = st.join(distinct_counts(df, cols), "column_name")
    return st.select(
        "column_name", "skew",
        (F.col("is_numeric") & (F.abs(F.col("skew")) > skew_limit)).alias("skewed"),
        (F.col("missing") / F.col("_n") > missing_limit).alias("high_missing"),
        (~F.col("is_numeric") & (F.col("n_unique") > levels_limit)).alias("high_cardinality"))


def class_balance(df: DataFrame, target: str) -> DataFrame:
    cnt = df.groupBy(target).agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy()  # over the per-class table (one row per class)
    return cnt.select(target, "count", (F.col("count") / F.sum("count").over(w)).alias("share"),
                      (F.max("count").over(w) / F.min("count").over(w)).alias("imbalance_ratio"))


def histogram(df: DataFrame, c: str, bins: int = 40) -> DataFrame:
    """Equal-width bins over [min, max]; the max falls in the last bin."""
    mm = df.agg(F.min(c).alias("_lo"), F.max(c).alias("_hi"))
    j = df.select(c).filter(F.col(c).isNotNull()).crossJoin(F.broadcast(mm))
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.least(F.floor((F.col(c) - F.col("_lo")) / F.when(width > 0, width).otherwise(F.lit(1.0))),
                F.lit(bins - 1)).cast("long")
    return (j.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"), F.first("_lo").alias("_lo"),
                                          F.first("_hi").alias("_hi"))
            .select("bin", (F.col("_lo") + F.col("bin") * (F.col("_hi") - F.col("_lo")) / bins).alias("bin_lo"),
                    "count"))


def rate_by_category(df: DataFrame, cat: str, target: str, z: float = 1.96) -> DataFrame:
    """Mean target per category with a normal-approximation 95 % interval and the base rate."""
    base = df.agg(F.avg(target).alias("base_rate"))
    g = df.groupBy(cat).agg(F.avg(target).alias("rate"), F.count(F.lit(1)).alias("n"))
    half = F.lit(z) * F.sqrt(F.col("rate") * (1 - F.col("rate")) / F.col("n"))
    return g.crossJoin(F.broadcast(base)).select(
        cat, "rate", "n", (F.col("rate") - half).alias("ci_lo"), (F.col("rate") + half).alias("ci_hi"),
        "base_rate", (F.col("rate") - F.col("base_rate")).alias("lift"))


def box_stats_by_class(df: DataFrame, cls: str, c: str) -> DataFrame:
    """Quartiles and 1.5*IQR whiskers per class (whisker = most extreme value within the fence)."""
    q = grouped_quantiles(df, [cls], {"q1": (c, 0.25), "q2": (c, 0.5), "q3": (c, 0.75)})
    j = df.join(q, cls)
    iqr = F.col("q3") - F.col("q1")
    lo = F.min(F.when(F.col(c) >= F.col("q1") - 1.5 * iqr, F.col(c)))
    hi = F.max(F.when(F.col(c) <= F.col("q3") + 1.5 * iqr, F.col(c)))
    return j.groupBy(cls, "q1", "q2", "q3").agg(lo.cast("double").alias("whisker_lo"),
                                                hi.cast("double").alias("whisker_hi"))


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation for every column pair, in one aggregation, unpivoted."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    agg = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    parts = []
    for a, b in pairs:
        parts += [f"'{a}'", f"'{b}'", f"`{a}__{b}`"]
    return agg.selectExpr(f"stack({len(pairs)}, {', '.join(parts)}) as (col_a, col_b, corr)")


def target_correlation_rank(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    agg = df.agg(*[F.corr(f, target).alias(f) for f in features])
    parts = []
    for f in features:
        parts += [f"'{f}'", f"`{f}`"]
    st = agg.selectExpr(f"stack({len(features)}, {', '.join(parts)}) as (feature, corr)")
    w = Window.orderBy(F.abs(F.col("corr")).desc(), F.col("feature"))  # one row per feature
    return st.withColumn("rank", F.row_number().over(w).cast("long"))

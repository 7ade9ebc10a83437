"""Exact grouped quantiles by two-pass selection.

An aggregate such as ``median`` or ``percentile`` keeps a map of all distinct
values of a group in one task.  Here a first pass brackets each quantile with
mergeable summaries of fixed size (``approx_percentile``: partial aggregates of
at most ``accuracy`` entries, whatever the group's size), and counts the group.
A second pass keeps what lies inside the brackets, collapses everything below
them to one count per task, and reads the two order statistics off the running
counts of the distinct values left: about 4/``accuracy`` of a large group's rows.
A group of up to 4 * ``accuracy`` rows has its whole range as bracket.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.operators.scan import BROADCAST_ROWS
from stratum.session import cut_lineage

ACCURACY = 10_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def grouped_quantiles(df: DataFrame, keys: Sequence[str], wanted: Mapping[str, tuple[Column | str, float]],
                      accuracy: int = ACCURACY) -> DataFrame:
    """One row per group of ``keys``: a column per entry of ``wanted``, name -> (value, quantile in [0, 1]).

    Linear interpolation between the two nearest order statistics, like
    ``percentile``; nulls are left out, a group without values has null, null
    keys form a group, no ``keys`` means one row over the whole table.  The
    result is exact: a rank outside its bracket raises an error.  ``df`` is read
    twice, so materialise what is costly to compute.
    """
    exprs: dict[str, int] = {}
    parts = []                                        # (name, number of its value, quantile)
    for name, (value, q) in wanted.items():
        parts.append((name, exprs.setdefault(str(_col(value)._jc), len(exprs)), float(q)))
    values: list[Column | None] = [None] * len(exprs)
    for (value, _), (_, i, _) in zip(wanted.values(), parts):
        values[i] = _col(value)
    rows = df.select(F.struct(F.lit(0), *keys).alias("_g"), *[v.cast("double").alias(f"_v{i}") for i, v in enumerate(values)])

    margin = 2.0 / accuracy
    first = []
    for i in range(len(values)):
        asked = [p for _, j, q in parts if j == i for p in (max(q - margin, 0.0), min(q + margin, 1.0))]
        first += [F.count(f"_v{i}").alias(f"_n{i}"), F.min(f"_v{i}").alias(f"_min{i}"), F.max(f"_v{i}").alias(f"_max{i}"),
                  F.approx_percentile(f"_v{i}", F.array(*map(F.lit, asked)), accuracy).alias(f"_a{i}")]
    fitted = rows.groupBy("_g").agg(*first)
    place = {i: 0 for i in range(len(values))}
    brackets = []
    for t, (_, i, q) in enumerate(parts):
        small = F.col(f"_n{i}") <= 4 * accuracy
        a, k = F.col(f"_a{i}"), place[i]
        place[i] += 2
        rank = (F.col(f"_n{i}") - 1) * F.lit(q)
        brackets.append(F.struct(F.when(small, F.col(f"_min{i}")).otherwise(a[k]).alias("lo"),
                                 F.when(small, F.col(f"_max{i}")).otherwise(a[k + 1]).alias("hi"),
                                 rank.alias("rank")).alias(f"_b{t}"))
    # stored: one row per group; few groups go to the rows, so that a group's rows never meet in one task
    fitted = cut_lineage(fitted.select("_g", *brackets))
    inside = rows.join(F.broadcast(fitted) if fitted.count() <= BROADCAST_ROWS else fitted, "_g")
    cells = [F.struct(F.lit(t).alias("t"), F.col(f"_v{i}").alias("v"), F.col(f"_b{t}").alias("b")) for t, (_, i, _) in enumerate(parts)]
    cell = (inside.select("_g", F.explode(F.array(*cells)).alias("c")).where("c.v <= c.b.hi")
            .select("_g", F.col("c.t").alias("t"), F.when(F.col("c.v") >= F.col("c.b.lo"), F.col("c.v")).alias("x"),
                    F.col("c.b.rank").alias("rank")))
    counted = cell.groupBy("_g", "t", "rank", "x").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy("_g", "t", "rank").orderBy(F.col("x").asc_nulls_first())
    upto = F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0))
    at = counted.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("c"))
    low = F.floor("rank")

    def statistic(k: Column) -> Column:               # the value of rank k, if this row holds it
        return F.when((F.col("before") <= k) & (k < F.col("upto")), F.when(
            F.col("x").isNull(), F.raise_error(F.lit("rank below its bracket")).cast("double")).otherwise(F.col("x")))

    share = F.col("rank") - low
    at = at.select("_g", "t", share.alias("share"), statistic(low).alias("x0"), F.when(share > 0, statistic(low + 1)).alias("x1"))
    at = at.where("x0 IS NOT NULL OR x1 IS NOT NULL")
    found = at.groupBy("_g", "t").agg(F.max("x0").alias("x0"), F.max("x1").alias("x1"), F.max("share").alias("share"))
    both = F.when(F.col("x0").isNull() | ((F.col("share") > 0) & F.col("x1").isNull()),
                  F.raise_error(F.lit("rank above its bracket")).cast("double"))
    value = F.coalesce(both, F.when(F.col("share") > 0, F.col("x0") * (1 - F.col("share")) + F.col("x1") * F.col("share")).otherwise(F.col("x0")))
    wide = found.groupBy("_g").agg(*[F.max(F.when(F.col("t") == t, value)).alias(name) for t, (name, _, _) in enumerate(parts)])
    names = [p[0] for p in parts]
    # a group without any value has no row in ``wide``
    out = fitted.select(F.col("_g").alias("_k")).join(wide, F.col("_k") == F.col("_g"), "left")
    return out.select(*[F.col(f"_k.{c}").alias(c) for c in keys], *names)


def grouped_medians(df: DataFrame, keys: Sequence[str], values: Mapping[str, Column | str], accuracy: int = ACCURACY) -> DataFrame:
    """``grouped_quantiles`` at one half: name -> value."""
    return grouped_quantiles(df, keys, {name: (v, 0.5) for name, v in values.items()}, accuracy)

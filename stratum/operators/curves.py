"""Reference curves cut by point count, and the search for the piece a value falls in.

A curve (the points of one key, sorted by x) is cut into pieces of ``points``
points by a range scan, so a dense stretch has many pieces, a sparse one few, a
gap none, and every array is bounded.  A piece also carries the last point
before it and the first points after it.

Values find their piece in one of two ways with the same result: while the
table of piece starts is small, measured, it is broadcast as one sorted array
per key and searched by bisection; beyond that the starts and the values are
put in one global order and each value counts the starts before it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.operators.scan import BROADCAST_ROWS, range_scan
from stratum.session import cut_lineage

POINTS = 64
POINT = "struct<x:double,y:double>"


def last_true(n: Column, holds, most: int) -> Column:
    """The largest i < n for which ``holds(i)``, a condition that is true up to some i and false after it; -1 if none.

    Bisection by halving steps; ``most`` bounds n.
    """
    steps = F.array(*[F.lit(1 << b) for b in range(max(most, 1).bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(-1), lambda at, step: F.when((at + step < n) & holds(at + step), at + step).otherwise(at))


def curve_pieces(ref: DataFrame, key: str, x: str, y: str, points: int = POINTS, tail: int = 1) -> DataFrame:
    """Per (key, _p): _pts (points sorted by x), _from (their first x), _before (the point before), _after (``tail`` points after).

    Points with a null or NaN coordinate are left out.  ``tail`` is at most ``points``.
    """
    if tail > points:
        raise ValueError("a piece must hold at least as many points as its tail")
    t = (ref.select(F.col(key).alias("_key"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
         .filter(F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x")))
    t = range_scan(t, ["_key"], [F.col("x").asc(), F.col("y").asc()], "_r")
    pieces = (t.groupBy(F.struct("_key").alias("_k"), F.floor(F.col("_r") / points).alias("_p"))
              .agg(F.sort_array(F.collect_list(F.struct("x", "y"))).alias("_pts")))
    pieces = cut_lineage(pieces)
    before = pieces.select("_k", (F.col("_p") + 1).alias("_p"), F.element_at("_pts", -1).alias("_before"))
    after = pieces.select("_k", (F.col("_p") - 1).alias("_p"), F.slice("_pts", 1, tail).alias("_after"))
    out = pieces.join(before, ["_k", "_p"], "left").join(after, ["_k", "_p"], "left")
    return cut_lineage(out.select(F.col("_k._key").alias(key), "_p", "_pts", F.col("_pts")[0]["x"].alias("_from"), "_before",
                                  F.coalesce("_after", F.array().cast(f"array<{POINT}>")).alias("_after")))


CURVE_POINTS = 1 << 19     # curves with up to so many points in all are broadcast whole (8 MB)
Curves = dict              # key -> (x, y), sorted by x, then y


def small_curves(ref: DataFrame, key: str, x: str, y: str) -> tuple[Broadcast | None, DataFrame]:
    """The curves as broadcast ``Curves`` while they are measured as small, else None; and ``ref``, stored.

    Points with a null or NaN coordinate are left out, as in ``curve_pieces``.
    """
    ref = cut_lineage(ref.select(key, x, y))
    if dict(ref.dtypes)[key] not in ("string", "tinyint", "smallint", "int", "bigint") or ref.count() > CURVE_POINTS:
        return None, ref
    t = (ref.select(F.col(key).alias("k"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
         .filter(F.col("k").isNotNull() & F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x"))).toArrow().combine_chunks()
    xs, ys = (t.column(c).to_numpy() for c in ("x", "y"))
    curves = {}
    for k, rows in groups_of(t.column("k")):
        rows = rows[np.lexsort((ys[rows], xs[rows]))]
        curves[k] = (xs[rows], ys[rows])
    return ref.sparkSession.sparkContext.broadcast(curves), ref


def groups_of(keys: pa.Array | pa.ChunkedArray) -> Iterator[tuple]:
    """(key, its row numbers) for each key that is not null."""
    d = (keys.combine_chunks() if isinstance(keys, pa.ChunkedArray) else keys).dictionary_encode()
    code = d.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    order = np.argsort(code, kind="stable")
    ends = np.searchsorted(code[order], np.arange(len(d.dictionary) + 1))
    for k, lo, hi in zip(d.dictionary.to_pylist(), ends, ends[1:]):
        yield k, order[lo:hi]


def deal_out(df: DataFrame) -> DataFrame:
    """Rows dealt out evenly: for work that costs much more time than its bytes suggest."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def with_row_id(df: DataFrame, spread: bool = False) -> DataFrame:
    """``df`` stored with a unique number per row (``_id``).

    ``spread`` deals the rows out evenly first: for work that costs much more
    time than its bytes suggest, which adaptive execution would pack into few tasks.
    """
    if spread:
        df = deal_out(df)
    return cut_lineage(df.withColumn("_id", F.monotonically_increasing_id()))


def locate(df: DataFrame, pieces: DataFrame, key: str, values: Sequence[Column], strict: Sequence[bool] | None = None) -> DataFrame:
    """Adds ``_ps``: for each of ``values`` the number of the last piece that starts at or before it (``strict``: before it).

    Values before the whole curve get its first piece; null or NaN values and
    keys without a curve get null.  Without a unique stored ``_id`` in ``df`` one
    is added where the second way needs it.
    """
    strict = list(strict or [False] * len(values))
    qs = F.array(*[F.nullif(v.cast("double"), F.lit(float("nan"))) for v in values])
    n = pieces.count()
    if n <= BROADCAST_ROWS:
        starts = pieces.groupBy(F.col(key).alias("_key")).agg(F.sort_array(F.collect_list("_from")).alias("_starts"))
        d = df.join(F.broadcast(starts), F.col(key) == F.col("_key"), "left").withColumn("_qs", qs)

        def number(i: int) -> Column:
            v, s = F.col("_qs")[i], F.col("_starts")
            at = last_true(F.size(s), lambda k: F.get(s, k) < v if strict[i] else F.get(s, k) <= v, n)
            return F.when(v.isNotNull() & s.isNotNull(), F.greatest(at, F.lit(0)).cast("long"))
        return d.withColumn("_ps", F.array(*[number(i) for i in range(len(values))])).drop("_key", "_starts", "_qs")
    if "_id" not in df.columns:
        df = with_row_id(df)
    # one order over starts and values: of equal ones the starts come first, unless the value wants those before it only
    asked = df.select("_id", F.col(key).alias("_key"), F.posexplode(qs).alias("_n", "_v")).filter("_v IS NOT NULL")
    late = F.array(*[F.lit(0 if s else 2) for s in strict])[F.col("_n")]
    both = (asked.select("_key", "_v", late.alias("_o"), "_id", "_n", F.lit(0).alias("_is"))
            .unionByName(pieces.select(F.col(key).alias("_key"), F.col("_from").alias("_v"), F.lit(1).alias("_o"),
                                       F.lit(None).cast("long").alias("_id"), F.lit(None).cast("int").alias("_n"), F.lit(1).alias("_is"))))
    seen = range_scan(both, ["_key"], [F.col("_v").asc(), F.col("_o").asc()], "_place", None, {"_c": F.col("_is")})
    have = pieces.select(F.col(key).alias("_key")).distinct()
    seen = seen.filter("_is = 0").join(have, "_key", "left_semi")
    found = seen.groupBy("_id").agg(*[F.max(F.when(F.col("_n") == i, F.greatest(F.col("_c") - 1, F.lit(0)))).alias(f"_p{i}")
                                      for i in range(len(values))])
    return (df.join(found, "_id", "left").withColumn("_ps", F.array(*[F.col(f"_p{i}") for i in range(len(values))]))
            .drop(*[f"_p{i}" for i in range(len(values))]))


def bracket(q: Column, points: int = POINTS) -> Column:
    """struct(L, R) on a joined piece: the nearest points at or below and at or above ``q``; null where the curve has none."""
    pts = F.col("_pts")
    at = last_true(F.size(pts), lambda k: F.get(pts, k)["x"] <= q, points)

    def ends(i: Column) -> Column:
        low = F.when(i >= 0, F.get(pts, i)).otherwise(F.col("_before"))
        high = F.coalesce(F.get(pts, i + 1), F.get(F.col("_after"), F.lit(0)))
        return F.struct(low.alias("L"), F.when(low["x"] == q, low).otherwise(high).alias("R"))
    return F.transform(F.array(at), ends)[0]


def interpolated(q: Column, points: int = POINTS) -> Column:
    """The curve's value at ``q`` on a joined piece: linear between its brackets, flat outside the curve."""
    def value(lr: Column) -> Column:
        xl, yl, xr, yr = lr["L"]["x"], lr["L"]["y"], lr["R"]["x"], lr["R"]["y"]
        return (F.when(lr["L"].isNull(), yr).when(lr["R"].isNull(), yl).when(xr == xl, yl)
                .otherwise((yr - yl) / (xr - xl) * (q - xl) + yl))
    return F.transform(F.array(bracket(q, points)), value)[0]

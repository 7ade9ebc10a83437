"""Range, nearest, interpolated as-of and sub-sequence joins against reference curves.

Spark plans a range predicate as a nested loop or as an equi-join plus a
residual filter, so every operator here adds an equi-key: the reference curve is
cut into pieces of a fixed number of points (``curves``), a query finds the
numbers of the pieces it needs and meets just those.  Ranges of any width take as
many pieces as they hold points, one row each, reduced per query; no array grows
with the curve.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.functions.scalar import let, znorm_fixed
from stratum.operators.curves import bracket, Curves, curve_pieces, deal_out, groups_of, interpolated, locate, small_curves, with_row_id
from stratum.operators.quantiles import grouped_medians
from stratum.operators.sequence import DEFAULT_BLOCK, gap_interpolate, halo_blocks, own_rows
from stratum.session import cut_lineage


def _cpu_partitions(df: DataFrame) -> int:
    """Partition count for compute-heavy row-wise array work."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def _values(col: str, frame) -> Column:
    """The frame's values in order, nulls kept (``collect_list`` alone would drop them and shift the rest)."""
    return F.transform(F.collect_list(F.struct(F.col(col).alias("v"))).over(frame), lambda s: s["v"])


def interp_lookup(df: DataFrame, ref: DataFrame, key: str, q: Column, ref_x: str, ref_y: str, out: str,
                  pieces: DataFrame | None = None) -> DataFrame:
    """Piecewise-linear y(q) from the reference curve of the same key; flat outside its range."""
    pieces = pieces if pieces is not None else curve_pieces(ref, key, ref_x, ref_y)
    j = _on_piece(df, pieces, key, q)
    return j.withColumn(out, F.when(F.col("_q").isNotNull(), interpolated(F.col("_q")))).select(*_others(df, out), out)


def nearest_key(df: DataFrame, ref: DataFrame, key: str, q: Column, ref_x: str, ref_y: str, out_x: str, out_y: str) -> DataFrame:
    """Nearest reference x to q (equal distance -> the lower x) and its y."""
    j = _on_piece(df, curve_pieces(ref, key, ref_x, ref_y), key, q)

    def pick(lr):
        dl, dr = F.abs(lr["L"]["x"] - F.col("_q")), F.abs(lr["R"]["x"] - F.col("_q"))
        return F.when(lr["R"].isNull() | (lr["L"].isNotNull() & (dl <= dr)), lr["L"]).otherwise(lr["R"])
    j = j.withColumn("_pick", F.when(F.col("_q").isNotNull(), let(bracket(F.col("_q")), pick)))
    return j.withColumn(out_x, F.col("_pick.x")).withColumn(out_y, F.col("_pick.y")).select(*_others(df, out_x, out_y), out_x, out_y)


def _others(df: DataFrame, *out: str) -> list[str]:
    return [c for c in df.columns if c not in out]


def _on_piece(df: DataFrame, pieces: DataFrame, key: str, q: Column) -> DataFrame:
    """Rows with ``_q`` (NaN as null) and the columns of the piece it falls in."""
    d = locate(df.withColumn("_q", F.nullif(q.cast("double"), F.lit(float("nan")))), pieces, key, [F.col("_q")])
    return d.withColumn("_p", F.col("_ps")[0]).join(pieces, [key, "_p"], "left")


def interp_offsets(df: DataFrame, ref: DataFrame, key: str, row_id: Sequence[str], sig: str,
                   anchors: dict[str, tuple[Column, Sequence[float]]], ref_x: str, ref_y: str) -> DataFrame:
    """For each anchor and offset o: sig - interp(anchor + o); one column per (anchor, offset).

    Curves that are measured as small are broadcast, and no row moves.  Else
    all offsets of a row are searched at once and the row meets each piece that
    any of them falls in, usually a few, once; the values found on different
    pieces are put together by ``max`` (all but one are null).
    """
    names = [f"{a}_{'m' if o < 0 else 'p'}{abs(int(o))}" for a, (_, offs) in anchors.items() for o in offs]
    at = {a: f"_a{i}" for i, a in enumerate(anchors)}
    curves, ref = small_curves(ref, key, ref_x, ref_y)
    if curves is not None:
        asked = df.select(*row_id, F.col(key).alias("_k"), F.col(sig).cast("double").alias("_s"),
                          *[c.cast("double").alias(at[a]) for a, (c, _) in anchors.items()])
        offsets = [(at[a], float(o)) for a, (_, offs) in anchors.items() for o in offs]
        schema = T.StructType([*df.select(*row_id).schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]])
        ids = list(row_id)
        return deal_out(asked).mapInArrow(lambda it: _differences(it, curves.value, ids, offsets, names), schema)
    d = with_row_id(df.select(*row_id, key, sig, *[c.cast("double").alias(at[a]) for a, (c, _) in anchors.items()]), spread=True)
    qs = [F.col(at[a]) + F.lit(float(o)) for a, (_, offs) in anchors.items() for o in offs]
    pieces = curve_pieces(ref, key, ref_x, ref_y)
    d = locate(d, pieces, key, qs)
    need = d.withColumn("_p", F.explode_outer(F.array_distinct(F.filter("_ps", lambda p: p.isNotNull())))).join(pieces, [key, "_p"], "left")
    values = [F.when(F.col("_ps")[i] == F.col("_p"), interpolated(q)).alias(n) for i, (n, q) in enumerate(zip(names, qs))]
    met = need.select("_id", *row_id, sig, *values)
    met = met.groupBy("_id", *row_id, sig).agg(*[F.max(n).alias(n) for n in names])
    return met.select(*row_id, *[(F.col(sig) - F.col(n)).alias(n) for n in names])


def _differences(batches: Iterator[pa.RecordBatch], curves: Curves, row_id: list[str], offsets: list[tuple[str, float]],
                 names: list[str]) -> Iterator[pa.RecordBatch]:
    """``row_id`` columns and, per (column, offset), _s - curve(column + offset); null where there is no curve or no place on it."""
    for b in batches:
        sig = b.column("_s").to_numpy(zero_copy_only=False)
        known = b.column("_s").is_valid().to_numpy(zero_copy_only=False)
        groups = [(rows, *curves[k]) for k, rows in groups_of(b.column("_k")) if k in curves]
        at = {a: b.column(a).to_numpy(zero_copy_only=False) for a, _ in offsets}
        out = []
        for a, o in offsets:
            v, ok = np.zeros(b.num_rows), np.zeros(b.num_rows, bool)
            for rows, xs, ys in groups:
                q = at[a][rows] + o
                there = ~np.isnan(q)
                rows, q = rows[there], q[there]
                left = np.searchsorted(xs, q, "right") - 1
                lo, hi = np.maximum(left, 0), np.minimum(left + 1, len(xs) - 1)
                xl, yl, xr, yr = xs[lo], ys[lo], xs[hi], ys[hi]
                flat = (left < 0) | (hi == left) | (xl == q)     # before the curve, after it, on a point of it
                with np.errstate(divide="ignore", invalid="ignore"):
                    v[rows] = sig[rows] - np.where(flat, yl, (yr - yl) / (xr - xl) * (q - xl) + yl)
                ok[rows] = True
            out.append(pa.array(v, pa.float64(), mask=~(ok & known)))
        yield pa.RecordBatch.from_arrays([*b.select(row_id).columns, *out], names=[*row_id, *names])


def _reached(df: DataFrame, pieces: DataFrame, key: str, lo: Column, hi: Column, hi_strict: bool) -> DataFrame:
    """Rows once per piece that may hold points from ``lo`` up to ``hi``, with the piece's number ``_p``."""
    d = locate(df, pieces, key, [lo, hi], [True, hi_strict])
    span = F.when(F.col("_ps")[0].isNotNull() & F.col("_ps")[1].isNotNull(), F.sequence(F.col("_ps")[0], F.greatest(F.col("_ps")[0], F.col("_ps")[1])))
    return d.withColumn("_p", F.explode(span)).drop("_ps")


def _ranged(df: DataFrame, pieces: DataFrame, key: str, lo: Column, hi: Column, hi_strict: bool) -> DataFrame:
    """``_reached`` rows with the columns of the piece."""
    return _reached(df, pieces, key, lo, hi, hi_strict).join(pieces, [key, "_p"])


def _long_enough(ref: DataFrame, key: str, least: int) -> DataFrame:
    keep = ref.groupBy(key).agg(F.count(F.lit(1)).alias("_nr")).filter(F.col("_nr") >= least).select(key)
    return ref.join(keep, key, "left_semi")


def range_nearest(df: DataFrame, ref: DataFrame, key: str, p: str, g: str, out: str, w: float,
                  ref_x: str = "x", ref_y: str = "y", min_ref: int = 2) -> DataFrame:
    """Among reference points with x in the closed [p-w, p+w], the x whose y is closest to g.

    Ties -> lowest x.  Null g, no candidate, or a reference curve with fewer
    than ``min_ref`` points -> p unchanged.
    """
    r = ref.select(key, ref_x, ref_y).dropna()
    pieces = curve_pieces(_long_enough(r, key, min_ref) if min_ref > 1 else r, key, ref_x, ref_y)
    d = with_row_id(df, spread=True)
    lo, hi = F.col(p) - F.lit(float(w)), F.col(p) + F.lit(float(w))
    asked = d.filter(F.col(g).isNotNull()).select("_id", key, lo.alias("_lo"), hi.alias("_hi"), F.col(g).alias("_g"))
    met = _ranged(asked, pieces, key, F.col("_lo"), F.col("_hi"), False)
    cand = F.filter("_pts", lambda pt: (pt["x"] >= F.col("_lo")) & (pt["x"] <= F.col("_hi")))
    best = F.array_min(F.transform(cand, lambda pt: F.struct(F.abs(pt["y"] - F.col("_g")).alias("d"), pt["x"].alias("x"))))
    best = met.select("_id", best.alias("_b")).filter("_b IS NOT NULL").groupBy("_id").agg(F.min("_b").alias("_b"))
    return (d.join(best, "_id", "left").withColumn(out, F.coalesce(F.col("_b.x"), F.col(p))).select(*_others(df, out), out))


def asof_cross_copy(df: DataFrame, other: DataFrame, key: str, axis: str, value: str, out: str) -> DataFrame:
    """Value of another copy of the same entity, interpolated by axis (not by row index)."""
    return interp_lookup(df, other, key, F.col(axis), axis, value, out)


# ---- sub-sequence matching ---------------------------------------------------------------------

def subseq_match_sse(ev: DataFrame, ref: DataFrame, entity: str, pos: str, key: str, prior: str, sig: str,
                     half: int = 5, search: float = 100.0, min_ref: int | None = None, sse_digits: int | None = None,
                     block: int = DEFAULT_BLOCK) -> DataFrame:
    """Windowed shape match of each eval row against the reference curve.

    ``ev`` holds the eval rows of each entity with ``pos`` = 0-based position
    in the eval zone.  The eval signal is gap-filled by position (an entity
    whose eval signal is all null is not matched).  Each row's truncated
    window (±half rows, length L >= 3) slides over the reference points with
    x in the half-open [prior - search, prior + search); the minimum-SSE start
    (first on ties) gives x at start + the row's offset in its window, and
    err = SSE / L.  Rows with fewer than L candidate points are not matched.
    Returns ev columns plus match_x and err (null when unmatched).  Curves that
    are measured as small are broadcast, and the search moves no row; larger
    ones are cut into pieces, and a row goes to each piece in its reach.
    """
    min_ref = min_ref if min_ref is not None else 2 * half + 1
    filled = gap_interpolate(ev, entity, pos, sig, "_g", None, block)
    h = halo_blocks(filled, pos, half, block)
    fr = Window.partitionBy(entity, "_blk").orderBy(pos).rowsBetween(-half, half)
    h = h.withColumn("_loc", _values("_g", fr)).withColumn("_nn", F.count("_g").over(fr))
    h = h.withColumn("_cnt", F.count(F.lit(1)).over(fr))
    # narrow rows, stored: the search reads those with a whole window, the result all of them
    win = own_rows(h).withColumn("_off", F.least(F.col(pos), F.lit(half)).cast("int")).drop("_g")
    whole_window = (F.size("_loc") >= 3) & (F.col("_nn") == F.col("_cnt"))
    w = F.lit(float(search))
    slack = 0.0 if sse_digits is None else 10.0 ** -sse_digits

    def rated(v: Column) -> Column:
        return F.struct((F.round(v["sse"], sse_digits) if sse_digits is not None else v["sse"]).alias("key"), v["s"], v["sse"], v["x"])
    curves, ref = small_curves(ref.select(key, "x", "y").dropna(), key, "x", "y")
    if curves is not None:
        asked = win.select(*ev.columns, F.col(key).alias("_k"), F.when(whole_window, F.col("_loc")).alias("_w"), "_off",
                           (F.col(prior) - w).cast("double").alias("_lo"), (F.col(prior) + w).cast("double").alias("_hi"))
        schema = T.StructType([*ev.schema.fields, T.StructField("_near", T.ArrayType(MATCH)), T.StructField("_len", T.IntegerType())])
        columns = ev.columns
        near = deal_out(asked).mapInArrow(lambda it: _near_matches(it, curves.value, columns, min_ref, slack), schema)
        found = near.select(*ev.columns, F.array_min(F.transform("_near", rated)).alias("_b"), "_len")
        return found.select(*ev.columns, F.col("_b.x").alias("match_x"), (F.col("_b.sse") / F.col("_len")).alias("err"))
    win = with_row_id(win, spread=True)
    ok = win.filter(whole_window).select("_id", key, F.col("_loc").alias("_w"), "_off", (F.col(prior) - w).cast("double").alias("_lo"),
                                         (F.col(prior) + w).cast("double").alias("_hi"))
    points = max(SSE_POINTS, 2 * half)
    near = _piece_matches(ok, curve_pieces(_long_enough(ref, key, min_ref), key, "x", "y", points, tail=2 * half), key, points, slack)
    best = near.groupBy("_id").agg(F.min(rated(F.struct(*MATCH.names))).alias("_b"))
    j = win.join(best, "_id", "left").withColumn("match_x", F.col("_b.x")).withColumn("err", F.col("_b.sse") / F.size("_loc"))
    return j.drop("_id", "_loc", "_nn", "_cnt", "_off", "_b")


MATCH = T.StructType().add("s", "long").add("sse", "double").add("x", "double")
SSE_CELLS = 1 << 18        # (row, start) pairs that are scored at once
SSE_POINTS = 1 << 12       # points of a piece of a large curve
SSE_ROWS = 1 << 16         # rows that meet a piece in one task, about


class _Windows:
    """The columns of a batch as arrays: each row's window (``size`` values from ``begin``), its place in it, and its reach."""

    def __init__(self, b: pa.RecordBatch):
        w = b.column("_w")
        self.size = w.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.values, self.begin = w.flatten().to_numpy(zero_copy_only=False), np.cumsum(self.size) - self.size
        self.lo, self.hi = (b.column(c).to_numpy(zero_copy_only=False) for c in ("_lo", "_hi"))
        self.off = b.column("_off").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.asked = (self.size > 0) & ~np.isnan(self.lo) & ~np.isnan(self.hi)


def _near_starts(xs: np.ndarray, ys: np.ndarray, own: int, w: _Windows, members: np.ndarray, slack: float) -> Iterator[tuple]:
    """(rows, starts, squared errors, x) of the starts before ``own`` within ``slack`` of the row's least error (of equal ones the first)."""
    members = members[w.asked[members]]
    for length in np.unique(w.size[members]).tolist():
        rows = members[w.size[members] == length]
        first = np.searchsorted(xs, w.lo[rows], "left")
        n = np.minimum(np.searchsorted(xs, w.hi[rows], "left") - length + 1, own) - first
        order = np.argsort(n, kind="stable")
        order = order[n[order] > 0]
        while len(order):                      # most starts first: what is left needs no more than these
            take = max(1, SSE_CELLS // int(n[order[-1]]))
            some, order = order[-take:], order[:-take]
            at = first[some][:, None] + np.arange(n[some].max())
            there = np.arange(at.shape[1]) < n[some][:, None]
            at = np.where(there, at, first[some][:, None])
            sse = np.zeros(at.shape)
            for j in range(length):
                sse += np.square(ys[at + j] - w.values[w.begin[rows[some]] + j][:, None])
            sse[np.isnan(sse)] = np.inf        # NaN counts as largest
            sse[~there] = np.inf
            r, c = np.nonzero((sse <= sse.min(axis=1)[:, None] + slack) & there)
            keep = np.lexsort((c, sse[r, c], r))
            r, c = r[keep], c[keep]
            e = sse[r, c]
            new = np.concatenate([[True], (r[1:] != r[:-1]) | (e[1:] != e[:-1])])
            r, c, e = r[new], c[new], e[new]
            s, row = at[r, c], rows[some][r]
            yield row, s, e, xs[s + w.off[row]]


def _joined(parts: list[tuple]) -> tuple:
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
    return tuple(np.concatenate(z) for z in zip(none, *parts))


def _near_matches(batches: Iterator[pa.RecordBatch], curves: Curves, columns: list[str], min_ref: int, slack: float) -> Iterator[pa.RecordBatch]:
    """``columns``, the starts that ``_near_starts`` finds, and the window's length."""
    for b in batches:
        w = _Windows(b)
        parts: list[tuple] = []
        for k, members in groups_of(b.column("_k")):
            xs, ys = curves.get(k, (None, None))
            if xs is not None and len(xs) >= min_ref:
                parts.extend(_near_starts(xs, ys, len(xs), w, members, slack))
        row, s, e, x = _joined(parts)
        order = np.argsort(row, kind="stable")
        ends = np.cumsum([0, *np.bincount(row, minlength=b.num_rows)])
        found = pa.StructArray.from_arrays([pa.array(s[order], pa.int64()), pa.array(e[order]), pa.array(x[order])], names=["s", "sse", "x"])
        yield pa.RecordBatch.from_arrays([*b.select(columns).columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found),
                                          pa.array(w.size, pa.int32())], names=[*columns, "_near", "_len"])


def _piece_matches(asked: DataFrame, pieces: DataFrame, key: str, points: int, slack: float) -> DataFrame:
    """``_id`` and ``MATCH`` columns: of each piece in a row's reach the starts that ``_near_starts`` finds; stored.

    The points of a piece and its rows stream through one task, the points
    first, so none of them is copied per row; a piece that many rows reach goes to several tasks.
    """
    pieces = with_row_id(pieces).withColumnRenamed("_id", "_piece")
    met = _reached(asked, pieces, key, F.col("_lo"), F.col("_hi"), True).join(pieces.select(key, "_p", "_piece"), [key, "_p"])
    met = met.select("_piece", "_id", "_w", "_off", "_lo", "_hi")
    tasks = met.groupBy("_piece").agg(F.ceil(F.count(F.lit(1)) / SSE_ROWS).alias("_tasks"))
    rows = met.join(tasks, "_piece").withColumn("_task", F.pmod(F.xxhash64("_id"), "_tasks")).drop("_tasks")
    pts = pieces.join(tasks, "_piece").withColumn("_task", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_tasks") - 1)))
    pts = pts.select("_piece", "_task", (F.col("_p") * points).alias("_from"), F.size("_pts").alias("_own"),
                     F.posexplode(F.concat("_pts", "_after")).alias("_at", "_pt"))
    both = pts.select("_piece", "_task", "_from", "_own", "_at", "_pt.x", "_pt.y").unionByName(rows, allowMissingColumns=True)
    # an explicit count: adaptive execution would pack the scoring by its few bytes into few tasks
    both = both.repartition(_cpu_partitions(both), "_piece", "_task").sortWithinPartitions("_piece", "_task", F.col("_at").asc_nulls_last())
    return cut_lineage(both.mapInArrow(lambda it: _streamed_matches(it, slack), T.StructType([T.StructField("_id", T.LongType()), *MATCH.fields])))


def _streamed_matches(batches: Iterator[pa.RecordBatch], slack: float) -> Iterator[pa.RecordBatch]:
    """For rows that follow the points of their piece, those with ``_at``."""
    xs, ys, own, start = np.zeros(0), np.zeros(0), 0, 0
    for b in batches:
        if not b.num_rows:
            continue
        w = _Windows(b)
        point = b.column("_at").is_valid().to_numpy(zero_copy_only=False)
        opens = b.column("_at").fill_null(-1).to_numpy(zero_copy_only=False) == 0
        x, y = (b.column(c).to_numpy(zero_copy_only=False) for c in ("x", "y"))
        cuts = np.flatnonzero(opens | np.concatenate([[True], point[1:] != point[:-1]]))
        parts: list[tuple] = []
        for lo, hi in zip(cuts, [*cuts[1:], b.num_rows]):
            if not point[lo]:
                parts.extend((row, s + start, e, at) for row, s, e, at in _near_starts(xs, ys, own, w, np.arange(lo, hi), slack))
            elif opens[lo]:
                xs, ys, own, start = x[lo:hi], y[lo:hi], b.column("_own")[lo].as_py(), b.column("_from")[lo].as_py()
            else:                                  # a piece that began in the batch before
                xs, ys = np.concatenate([xs, x[lo:hi]]), np.concatenate([ys, y[lo:hi]])
        row, s, e, at = _joined(parts)
        unknown = np.bincount(np.repeat(np.arange(b.num_rows), w.size)[np.isnan(w.values)], minlength=b.num_rows) > 0
        e[unknown[row]] = np.nan
        yield pa.RecordBatch.from_arrays([b.column("_id").take(pa.array(row)), pa.array(s, pa.int64()), pa.array(e), pa.array(at)],
                                         names=["_id", *MATCH.names])


def median_gate(df: DataFrame, entity: str, err: str, cand: str, prior: str, out: str, slack: float = 1.5) -> DataFrame:
    """Accept a match when err <= slack * the entity's median valid err, else keep the prior.

    ``df`` is stored first: the match behind it is computed once, not once per pass.
    """
    df = cut_lineage(df)
    med = grouped_medians(df, [entity], {"_med": err})
    j = df.join(med, entity, "left")
    keep = F.col(err).isNotNull() & (F.col(err) <= F.col("_med") * F.lit(slack))
    return j.withColumn(out, F.when(keep, F.col(cand)).otherwise(F.col(prior))).drop("_med")


NCC_WAVES = 6              # transform coefficients that bound a correlation
NCC_EVAL_ROWS = 1 << 13    # eval rows that meet a chunk of known windows in one task


def _waves(n: int, m: int) -> list[list[float]]:
    """The first ``m`` non-constant vectors of the orthonormal cosine basis of length ``n``."""
    return [[math.sqrt(2.0 / n) * math.cos(math.pi * k * (2 * t + 1) / (2 * n)) for t in range(n)] for k in range(1, m + 1)]


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def _signature(z: Column, waves: list[list[float]]) -> Column:
    """struct(z, c, r): a window, its first transform coefficients, and the norm of all that they leave out."""
    def signed(v: Column) -> Column:
        coefficients = F.array(*[_dot(v, F.array(*map(F.lit, w))) for w in waves])
        return let(coefficients, lambda c: F.struct(v.alias("z"), c.alias("c"),
                                                    F.sqrt(F.greatest(_dot(v, v) - _dot(c, c), F.lit(0.0))).alias("r")))
    return let(z, signed)


def _best_match(sig: Column, cands: Column, n: int) -> Column:
    """The candidate of the highest correlation (first of equal ones): struct(score, neg_start, label, scored).

    By Cauchy-Schwarz a correlation is at most the product of the known
    coefficients plus that of the left-out norms.  Only a candidate whose bound
    reaches the best score so far is scored in full; ``scored`` counts those.
    """
    none = F.struct(F.lit(None).cast("double").alias("score"), F.lit(None).cast("long").alias("neg_start"),
                    F.lit(None).cast("double").alias("label"), F.lit(0).alias("scored"))

    def step(best: Column, cand: Column) -> Column:
        bound = (_dot(sig["c"], cand["s"]["c"]) + sig["r"] * cand["s"]["r"]) / n + 1e-9

        def better(score: Column) -> Column:
            wins = best["score"].isNull() | (score > best["score"])
            return F.struct(F.when(wins, score).otherwise(best["score"]).alias("score"),
                            F.when(wins, -cand["start"]).otherwise(best["neg_start"]).alias("neg_start"),
                            F.when(wins, cand["label"]).otherwise(best["label"]).alias("label"), (best["scored"] + 1).alias("scored"))
        return F.when(best["score"].isNotNull() & (bound < best["score"]), best).otherwise(let(_dot(sig["z"], cand["s"]["z"]) / n, better))
    return F.aggregate(cands, none, step)


def subseq_match_ncc(kn: DataFrame, ev: DataFrame, entity: str, kpos: str, epos: str, ksig: str, esig: str,
                     klabel: str, half: int, stride: int = 3, smooth: int = 2, chunk: int = 1024,
                     block: int = DEFAULT_BLOCK) -> DataFrame:
    """Z-normalised cross-correlation of each eval window with the known-zone windows.

    Known windows (length 2*half+1, every ``stride`` rows) and eval windows
    (edge-padded, both signals smoothed by a centred mean of radius
    ``smooth``) are z-normalised (std + 1e-6); the best known window's centre
    label is returned with its score.  Entities whose known zone is shorter
    than window + 1 get the last known label and score 0.

    The argmax is exact.  Known windows are packed in chunks; eval rows meet the
    chunks of their entity under a key that also holds the run of eval rows, so
    a long entity spreads over tasks, each side crosses the network before the
    join only (a chunk once per run), and what is left of a pair is one row's
    best.  Bounds from a few transform coefficients spare most of the scoring.
    """
    win = 2 * half + 1
    waves = _waves(win, min(NCC_WAVES, win - 1))
    # smoothed known signal + window starts, with the label of the window's centre
    kh = halo_blocks(kn, kpos, win + smooth, block)
    sm = Window.partitionBy(entity, "_blk").orderBy(kpos)
    kh = kh.withColumn("_s", F.avg(ksig).over(sm.rowsBetween(-smooth, smooth)))
    kh = kh.withColumn("_w", _values("_s", sm.rowsBetween(0, win - 1))).withColumn("_clab", F.lead(klabel, half).over(sm))
    nk = kn.groupBy(entity).agg(F.count(F.lit(1)).alias("_nk"), F.max_by(klabel, kpos).alias("_lastlab"))
    kw = own_rows(kh).filter(F.col(kpos) % stride == 0).join(nk, entity).filter((F.col(kpos) <= F.col("_nk") - win) & (F.col("_nk") >= win + 1))
    kw = kw.filter(~F.exists("_w", lambda v: v.isNull()))
    kw = kw.select(entity, F.col(kpos).cast("long").alias("start"), _signature(znorm_fixed("_w", win), waves).alias("s"),
                   F.col("_clab").cast("double").alias("label"))
    ne = ev.groupBy(entity).agg(F.count(F.lit(1)).alias("_ne"))
    runs = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_ne") - 1) / NCC_EVAL_ROWS)))
    chunks = (kw.groupBy(entity, F.floor(F.col("start") / (stride * chunk)).alias("_chunk"))
              .agg(F.sort_array(F.collect_list(F.struct("start", "s", "label"))).alias("_cands"))
              .join(ne, entity).withColumn("_run", runs).select(F.col(entity).alias("_e"), "_run", "_cands"))
    # eval windows: smoothed, edge padded
    eh = halo_blocks(ev, epos, half + smooth, block)
    sm2 = Window.partitionBy(entity, "_blk").orderBy(epos)
    eh = eh.withColumn("_s", F.avg(esig).over(sm2.rowsBetween(-smooth, smooth)))
    eh = eh.withColumn("_raw", _values("_s", sm2.rowsBetween(-half, half)))
    eh = eh.withColumn("_first", F.first("_s").over(sm2.rowsBetween(Window.unboundedPreceding, 0)))
    eh = eh.withColumn("_last", F.last("_s").over(sm2.rowsBetween(0, Window.unboundedFollowing)))
    ew = own_rows(eh).join(ne, entity)
    pre = F.array_repeat("_first", F.greatest(F.lit(half) - F.col(epos), F.lit(0)).cast("int"))
    post = F.array_repeat("_last", F.greatest(F.col(epos) + half - (F.col("_ne") - 1), F.lit(0)).cast("int"))
    # a window with a gap wider than the smoothing has no score and falls back to the last label
    ew = ew.withColumn("_h", F.concat(pre, "_raw", post))
    ew = ew.withColumn("_sig", F.when(~F.exists("_h", lambda v: v.isNull()), _signature(znorm_fixed("_h", win), waves)))
    ew = ew.select(*ev.columns, "_sig", F.floor(F.col(epos) / NCC_EVAL_ROWS).alias("_run"))
    # an explicit count: adaptive execution would pack the scoring by its few bytes into few tasks
    ew = ew.repartition(_cpu_partitions(ew), entity, "_run")
    pairs = ew.join(chunks, (F.col(entity) == F.col("_e")) & (ew["_run"] == chunks["_run"]), "left")
    best = F.when(F.col("_sig").isNotNull() & F.col("_cands").isNotNull(), _best_match(F.col("_sig"), F.col("_cands"), win))
    red = pairs.select(*ev.columns, best.alias("_best")).groupBy(*ev.columns).agg(F.max("_best").alias("_best"))
    red = red.join(nk.select(entity, "_lastlab"), entity, "left")
    return red.select(*ev.columns,
                      F.coalesce(F.col("_best.label"), F.col("_lastlab")).alias("ncc_label"),
                      F.coalesce(F.col("_best.score"), F.lit(0.0)).alias("ncc_score"))

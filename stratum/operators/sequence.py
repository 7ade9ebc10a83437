"""Ordered-sequence primitives: row index, halo blocks, bounded windows.

Scale notes
-----------
* A plain ``Window.partitionBy(entity)`` puts one whole entity in one task.
  When one entity holds a large share of the rows that task dominates the job.
  ``row_index`` therefore numbers rows in two levels: rows are counted per
  ``(entity, chunk)`` (``chunk`` is any monotone function of the order key,
  e.g. the day of a timestamp), chunk offsets are prefix-summed over the
  small count table, and ``row_number`` runs per ``(entity, chunk)``.
* Bounded frames (rolling ±h, lag/lead k) only need ``h`` neighbours, so
  ``halo_blocks`` splits each entity into blocks of ``block`` rows and copies
  the ``h`` edge rows into the neighbouring block.  Windows then partition by
  ``(entity, block)`` and every task is bounded by ``block + 2h`` rows, however
  long the entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BLOCK = 1 << 18  # rows per halo block (bounded task size for hot entities)


def row_index(df: DataFrame, entity: str, order: list[str], out: str = "i",
              chunk: Column | None = None, count_col: str | None = None) -> DataFrame:
    """0-based position of each row inside its entity (``cumcount``).

    With ``chunk`` the numbering is two-level (see module notes); with
    ``count_col`` the entity length is attached as well, taken from the same
    per-chunk count table (no second pass over the rows).
    """
    if chunk is None:
        w = Window.partitionBy(entity).orderBy(*order)
        res = df.withColumn(out, (F.row_number().over(w) - 1).cast("long"))
        return entity_count(res, entity, count_col) if count_col else res
    # the key is a struct: null entities and null chunks compare equal in it, so no row is lost,
    # and the numbering window reuses the join's partitioning
    df = df.withColumn("_key", F.struct(F.col(entity).alias("e"), chunk.alias("c")))
    counts = df.groupBy("_key").agg(F.count(F.lit(1)).alias("_c"))
    whole = Window.partitionBy("_key.e")
    before = whole.orderBy("_key.c").rowsBetween(Window.unboundedPreceding, -1)
    cols = ["_key", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off")]
    if count_col:
        cols.append(F.sum("_c").over(whole).alias(count_col))
    offs = counts.select(*cols)
    w = Window.partitionBy("_key").orderBy(*order)
    return (df.join(offs, "_key")
            .withColumn(out, (F.col("_off") + F.row_number().over(w) - 1).cast("long"))
            .drop("_key", "_off"))


def join_by_key(df: DataFrame, small: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which nulls are equal (the keys meet as one struct)."""
    right = small.select(F.struct(*keys).alias("_key"), *[c for c in small.columns if c not in keys])
    return df.withColumn("_key", F.struct(*keys)).join(right, "_key", how).drop("_key")


def entity_count(df: DataFrame, entity: str, out: str = "n") -> DataFrame:
    """Attach the entity row count (partial aggregation + join back; skew-safe, null entities included)."""
    return join_by_key(df, df.groupBy(entity).agg(F.count(F.lit(1)).alias(out)), [entity])


def halo_blocks(df: DataFrame, idx: str, halo: int, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Replicate edge rows into neighbouring blocks; adds ``_blk`` and ``_own``.

    Window over ``partitionBy(entity, "_blk").orderBy(idx)`` and keep ``_own``
    rows: results equal an entity-wide window for any frame within ±halo.
    """
    if halo >= block:
        raise ValueError("halo must be smaller than the block size")
    b = F.floor(F.col(idx) / block)
    r = F.col(idx) % block
    targets = F.array(b, F.when(r < halo, b - 1), F.when(r >= block - halo, b + 1))
    return (df.withColumn("_home", b)
            .withColumn("_blk", F.explode(F.filter(targets, lambda t: t.isNotNull() & (t >= 0))))
            .withColumn("_own", F.col("_blk") == F.col("_home"))
            .drop("_home"))


def block_of(idx: str, block: int = DEFAULT_BLOCK) -> Column:
    """The number of the block that a row belongs to; its metadata says how blocks were cut."""
    return F.floor(F.col(idx) / block).cast("long").alias("_blk", metadata={"idx": idx, "block": block})


def with_block(df: DataFrame, idx: str, block: int = DEFAULT_BLOCK) -> DataFrame:
    """``df`` with ``_blk``; a stored sequence that is cut this way already keeps its partitioning."""
    if "_blk" in df.columns and df.schema["_blk"].metadata == {"idx": idx, "block": block}:
        return df
    return df.withColumn("_blk", block_of(idx, block))


def bounded_window(entity: str, idx: str, lo: int, hi: int) -> Window:
    """Row frame [lo, hi] around each row inside a halo block."""
    return Window.partitionBy(entity, "_blk").orderBy(idx).rowsBetween(lo, hi)


def ordered_window(entity: str, idx: str) -> Window:
    return Window.partitionBy(entity, "_blk").orderBy(idx)


def own_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("_own")).drop("_blk", "_own")


# ---- windows over halo blocks ---------------------------------------------------------------

def _w(entity: str, idx: str, lo, hi) -> Window:
    return Window.partitionBy(entity, "_blk").orderBy(idx).rowsBetween(lo, hi)


def rolling_centered(df: DataFrame, entity: str, idx: str, value: str, widths=(5, 21, 51, 101),
                     block: int = DEFAULT_BLOCK, prefix: str = "roll") -> DataFrame:
    """Centered rolling mean and sample std (std of < 2 values -> 0), min_periods=1."""
    h = max((w - 1) // 2 for w in widths)
    d = halo_blocks(df, idx, h, block)
    cols = {}
    for w in widths:
        r = (w - 1) // 2
        cols[f"{prefix}_mean{w}"] = F.avg(value).over(_w(entity, idx, -r, r))
        cols[f"{prefix}_std{w}"] = F.coalesce(F.stddev_samp(value).over(_w(entity, idx, -r, r)), F.lit(0.0))
    return own_rows(d.withColumns(cols))


def rolling_max(df: DataFrame, entity: str, idx: str, value: str, width: int = 21, out: str = "roll_max",
                block: int = DEFAULT_BLOCK) -> DataFrame:
    r = (width - 1) // 2
    d = halo_blocks(df, idx, r, block)
    return own_rows(d.withColumn(out, F.max(value).over(_w(entity, idx, -r, r))))


def rolling_rms(df: DataFrame, entity: str, idx: str, value: str, width: int = 21, out: str = "roll_rms",
                block: int = DEFAULT_BLOCK) -> DataFrame:
    r = (width - 1) // 2
    d = halo_blocks(df, idx, r, block)
    return own_rows(d.withColumn(out, F.sqrt(F.avg(F.col(value) * F.col(value)).over(_w(entity, idx, -r, r)))))


def lag_lead_filled(df: DataFrame, entity: str, idx: str, value: str, lags=(1, 5, 15, 30),
                    block: int = DEFAULT_BLOCK, n: str | None = None) -> DataFrame:
    """lag_k: the column shifted down by k and then back-filled; lead_k: shifted up by k and then forward-filled.

    So a null or missing x[i-k] takes the next known value at or after it, as far as
    the shifted column reaches, and a null x[i+k] the last known one at or
    before it.  Known neighbours come from the segmented scan, so the result does
    not depend on the block size.  ``n`` names a column with the entity's length.
    """
    base = df if n else entity_count(df, entity, "_len")
    length = F.col(n or "_len")
    nb = neighbours(base, entity, idx, value, block)
    nb = nb.withColumn("_after", F.struct("_ni", "_nv")).withColumn("_before", F.struct("_pi", "_pv"))
    d = halo_blocks(nb, idx, max(lags), block)
    o = Window.partitionBy(entity, "_blk").orderBy(idx)
    head = F.first("_after").over(_w(entity, idx, Window.unboundedPreceding, 0))
    tail = F.last("_before").over(_w(entity, idx, 0, Window.unboundedFollowing))
    shifted, cols = {}, {}
    for k in lags:
        shifted[f"_a{k}"] = F.when(F.col(idx) >= k, F.lag("_after", k).over(o)).otherwise(head)
        shifted[f"_b{k}"] = F.when(F.col(idx) + k < length, F.lead("_before", k).over(o)).otherwise(tail)
        cols[f"lag{k}"] = F.when(F.col(f"_a{k}")["_ni"] <= length - 1 - k, F.col(f"_a{k}")["_nv"])
        cols[f"lead{k}"] = F.when(F.col(f"_b{k}")["_pi"] >= k, F.col(f"_b{k}")["_pv"])
    return own_rows(d.withColumns(shifted)).withColumns(cols).select(*df.columns, *cols)


def diff_1_2(df: DataFrame, entity: str, idx: str, value: str, block: int = DEFAULT_BLOCK) -> DataFrame:
    """First and second differences; undefined edges -> 0."""
    d = halo_blocks(df, idx, 2, block)
    o = Window.partitionBy(entity, "_blk").orderBy(idx)
    x, x1, x2 = F.col(value), F.lag(value, 1).over(o), F.lag(value, 2).over(o)
    return own_rows(d.withColumns({"d1": F.coalesce(x - x1, F.lit(0.0)),
                                   "d2": F.coalesce(x - 2 * x1 + x2, F.lit(0.0))}))


def axis_derivative(df: DataFrame, entity: str, idx: str, axis: str, cols, block: int = DEFAULT_BLOCK) -> DataFrame:
    """d(col)/d(axis) between consecutive rows; a zero axis step -> null."""
    d = halo_blocks(df, idx, 1, block)
    o = Window.partitionBy(entity, "_blk").orderBy(idx)
    dm = F.nullif(F.col(axis) - F.lag(axis).over(o), F.lit(0.0))
    return own_rows(d.withColumns({f"d{c}_d{axis}": F.try_divide(F.col(c) - F.lag(c).over(o), dm) for c in cols}))


def window_tensor(df: DataFrame, entity: str, idx: str, n: str, channels, half: int = 20,
                  block: int = DEFAULT_BLOCK, out: str = "tensor") -> DataFrame:
    """Per row an edge-clamped window of 2*half+1 rows for each channel (array of arrays).

    Built from bounded ``collect_list`` frames inside halo blocks; the frame
    is padded with the entity's first / last value where it runs off an end.
    """
    d = halo_blocks(df, idx, half, block)
    fr = _w(entity, idx, -half, half)
    first_all = _w(entity, idx, Window.unboundedPreceding, 0)
    last_all = _w(entity, idx, 0, Window.unboundedFollowing)
    i, nn = F.col(idx), F.col(n)
    arrs = []
    for c in channels:
        pre = F.array_repeat(F.first(c).over(first_all), F.greatest(F.lit(half) - i, F.lit(0)).cast("int"))
        post = F.array_repeat(F.last(c).over(last_all), F.greatest(i + half - (nn - 1), F.lit(0)).cast("int"))
        # collect_list drops nulls, a struct around them does not: windows keep their length
        inner = F.transform(F.collect_list(F.struct(F.col(c).alias("v"))).over(fr), lambda s: s["v"])
        arrs.append(F.concat(pre, inner, post))
    return own_rows(d.withColumn(out, F.array(*arrs)))


# ---- segmented scans (unbounded reach, bounded tasks) --------------------------------------------

def neighbours(df: DataFrame, entity: str, idx: str, value: str, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Previous and next non-null (idx, value) of every row (inclusive of the row itself).

    Two-level scan: per-block first/last non-null, carried across blocks on
    the small per-block table, then a within-block scan.  Adds _pi,_pv,_ni,_nv.
    """
    d = with_block(df, idx, block)
    nn = F.when(F.col(value).isNotNull(), F.struct(F.col(idx).alias("i"), F.col(value).alias("v")))
    per = d.groupBy(entity, "_blk").agg(F.max(nn).alias("_bl"), F.min(nn).alias("_bf"))
    bw = Window.partitionBy(entity).orderBy("_blk")
    per = per.select(entity, "_blk",
                     F.last("_bl", ignorenulls=True).over(bw.rowsBetween(Window.unboundedPreceding, -1)).alias("_cin"),
                     F.first("_bf", ignorenulls=True).over(bw.rowsBetween(1, Window.unboundedFollowing)).alias("_cout"))
    w = Window.partitionBy(entity, "_blk").orderBy(idx)
    prev = F.coalesce(F.last(nn, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.col("_cin"))
    nxt = F.coalesce(F.first(nn, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)), F.col("_cout"))
    j = join_by_key(d, per, [entity, "_blk"]).withColumn("_p", prev).withColumn("_n", nxt)
    return j.select(*df.columns, F.col("_p.i").alias("_pi"), F.col("_p.v").alias("_pv"),
                    F.col("_n.i").alias("_ni"), F.col("_n.v").alias("_nv"))


def gap_interpolate(df: DataFrame, entity: str, idx: str, value: str, out: str, fallback=None,
                    block: int = DEFAULT_BLOCK) -> DataFrame:
    """Linear fill of null runs by row position; ends held flat; all-null entity -> fallback."""
    nb = neighbours(df, entity, idx, value, block)
    pi, pv, ni, nv = F.col("_pi"), F.col("_pv"), F.col("_ni"), F.col("_nv")
    lerp = pv + (nv - pv) * (F.col(idx) - pi) / (ni - pi)
    filled = (F.when(pi.isNotNull() & ni.isNotNull(), F.when(ni == pi, pv).otherwise(lerp))
              .when(pi.isNotNull(), pv).when(ni.isNotNull(), nv))
    if fallback is not None:
        filled = F.coalesce(filled, fallback if not isinstance(fallback, (int, float)) else F.lit(float(fallback)))
    return nb.withColumn(out, filled).drop("_pi", "_pv", "_ni", "_nv")


def smooth_mean(df: DataFrame, entity: str, idx: str, value: str, radius: int, out: str, fallback=None,
                block: int = DEFAULT_BLOCK) -> DataFrame:
    """Gap-fill, then centered mean of radius r (r = 0 -> gap-filled values)."""
    g = gap_interpolate(df, entity, idx, value, "_g", fallback, block)
    if radius <= 0:
        return g.withColumnRenamed("_g", out)
    d = halo_blocks(g, idx, radius, block)
    return own_rows(d.withColumn(out, F.avg("_g").over(_w(entity, idx, -radius, radius)))).drop("_g")


def entity_arrays(df: DataFrame, entity: str, idx: str, cols, chunk_rows: int = DEFAULT_BLOCK) -> DataFrame:
    """Ordered arrays per entity, in chunks of at most ``chunk_rows`` rows.

    One row per (entity, chunk): a long entity never becomes a single
    unbounded row.  Arrays are sorted by ``idx`` inside each chunk.
    """
    d = df.withColumn("chunk", F.floor(F.col(idx) / chunk_rows).cast("long"))
    st = F.sort_array(F.collect_list(F.struct(F.col(idx), *[F.col(c) for c in cols])))
    g = d.groupBy(entity, "chunk").agg(st.alias("_a"))
    return g.select(entity, "chunk", F.col(f"_a.{idx}").alias(idx), *[F.col(f"_a.{c}").alias(c) for c in cols])


def even_subsample(df: DataFrame, entity: str, idx: str, n_rows: str, m: int = 60) -> DataFrame:
    """Keep rows at linspace(0, len-1, min(m, len)) truncated to int, per entity.

    The index set is generated per entity (at most ``m`` rows each) and joined
    back on (entity, idx): no window, no collect.
    """
    ent = df.select(entity, n_rows).distinct()
    mm = F.least(F.lit(m), F.col(n_rows))
    step = (F.col(n_rows) - 1).cast("double") / F.greatest(mm - 1, F.lit(1)).cast("double")
    gen = ent.select(entity, n_rows, F.explode(F.sequence(F.lit(0), (mm - 1).cast("long"))).alias("_j"), step.alias("_st"),
                     mm.alias("_m"))
    keep = gen.select(entity, F.when(F.col("_j") == F.col("_m") - 1, F.col(n_rows) - 1)
                      .otherwise(F.floor(F.col("_j") * F.col("_st"))).cast("long").alias(idx)).distinct()
    return df.join(keep, [entity, idx], "left_semi")


def running_count(df: DataFrame, entity: str, idx: str, flag: Column, out: str, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Inclusive running count of ``flag`` rows in ``idx`` order per entity, in bounded tasks.

    Per-block totals are prefix-summed on the small per-block table; the
    within-block running sum adds that carry.
    """
    d = with_block(df, idx, block).withColumn("_f", flag.cast("long"))
    per = d.groupBy(entity, "_blk").agg(F.sum("_f").alias("_bs"))
    bw = Window.partitionBy(entity).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(entity, "_blk", F.coalesce(F.sum("_bs").over(bw), F.lit(0)).alias("_carry"))
    w = Window.partitionBy(entity, "_blk").orderBy(idx).rowsBetween(Window.unboundedPreceding, 0)
    return (join_by_key(d, per, [entity, "_blk"]).withColumn(out, (F.col("_carry") + F.sum("_f").over(w)).cast("long"))
            .drop("_blk", "_f", "_carry"))

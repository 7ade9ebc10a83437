"""Per-entity statistics over sequences and candidate sets.

Everything here is a grouped aggregate or a narrow projection: no entity is
materialised as a Python object.  Exact medians go through
``quantiles.grouped_medians``; Spark's holistic ``median`` is left to subsets
of fixed size (the last k rows of an entity).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.operators.quantiles import grouped_medians
from stratum.session import cut_lineage


def entity_summary(df: DataFrame, entity: str, cols: Sequence[str]) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"),
                 (F.max(c) - F.min(c)).alias(f"span_{c}"), F.stddev_pop(c).alias(f"std_{c}")]
    return df.groupBy(entity).agg(*aggs)


def boundary_row(df: DataFrame, entity: str, idx: str, cols: Sequence[str], known: Column | None = None,
                 prefix: str = "last_") -> DataFrame:
    """Last (max ``idx``) row of each entity, optionally among ``known`` rows."""
    src = df.filter(known) if known is not None else df
    st = F.max_by(F.struct(*[F.col(c) for c in [idx, *cols]]), F.col(idx)).alias("_r")
    g = src.groupBy(entity).agg(st)
    return g.select(entity, *[F.col(f"_r.{c}").alias(f"{prefix}{c}") for c in [idx, *cols]])


def known_position(df: DataFrame, entity: str, idx: str, known: Column, desc: bool = False,
                   out: str = "_j", n_known: str | None = None) -> DataFrame:
    """0-based position among the entity's known rows (ascending or descending).

    ``n_known`` names a column with the number of known rows where these are
    the first rows of the entity: then the position is arithmetic on ``idx``.
    Otherwise it is a two-level running count (``sequence.running_count``).
    Either way no window holds a whole entity.
    """
    if n_known:
        pos = F.col(n_known) - 1 - F.col(idx) if desc else F.col(idx)
        return df.filter(known).withColumn(out, pos)
    from stratum.operators.sequence import join_by_key, running_count
    c = running_count(df, entity, idx, known, "_kc").filter(known)
    if not desc:
        return c.withColumn(out, F.col("_kc") - 1).drop("_kc")
    nk = c.groupBy(entity).agg(F.count(F.lit(1)).alias("_nk"))
    return join_by_key(c, nk, [entity]).withColumn(out, F.col("_nk") - F.col("_kc")).drop("_kc", "_nk")


def tail_steps(df: DataFrame, entity: str, idx: str, known: Column, k: int, cols: Sequence[str],
               n_known: str | None = None) -> DataFrame:
    """Steps (differences) between consecutive rows of the last ``k`` known rows."""
    tail = known_position(df, entity, idx, known, desc=True, n_known=n_known).filter(F.col("_j") < k)
    w = Window.partitionBy(entity).orderBy(idx)
    return tail.select(entity, idx, *[(F.col(c) - F.lag(c).over(w)).alias(f"d_{c}") for c in cols])


def tail_rate(df: DataFrame, entity: str, idx: str, known: Column, y: str, z: str, axis: str,
              k: int = 30, min_valid: int = 3, out: str = "tail_rate", n_known: str | None = None) -> DataFrame:
    """Median of (dy + dz) / daxis over steps with daxis > 0 among the last k known rows."""
    st = tail_steps(df, entity, idx, known, k, [y, z, axis], n_known)
    ok = F.col(f"d_{axis}") > 0
    g = st.groupBy(entity).agg(
        F.count(F.when(ok, F.lit(1))).alias("_nv"),
        F.median(F.when(ok, (F.col(f"d_{y}") + F.col(f"d_{z}")) / F.col(f"d_{axis}"))).alias("_med"))
    return g.select(entity, F.when(F.col("_nv") >= min_valid, F.col("_med")).otherwise(F.lit(0.0)).alias(out))


def group_velocity_ols(df: DataFrame, entity: str, idx: str, known: Column, y: str, z: str, axis: str,
                       min_steps: int = 10, n_known: str | None = None) -> DataFrame:
    """OLS of dy/daxis on dz/daxis over known steps with daxis > 0.

    Returns beta, icpt and the residual std (floored at 0.001); fewer than
    ``min_steps`` valid steps -> (-1, 0, 0.1).
    """
    from stratum.operators.sequence import halo_blocks, own_rows
    kn = halo_blocks(known_position(df, entity, idx, known, n_known=n_known), "_j", 1)
    w = Window.partitionBy(entity, "_blk").orderBy("_j")
    st = kn.select(entity, "_own", (F.col(y) - F.lag(y).over(w)).alias("_dy"), (F.col(z) - F.lag(z).over(w)).alias("_dz"),
                   (F.col(axis) - F.lag(axis).over(w)).alias("_dm"))
    st = own_rows(st)
    st = st.filter(F.col("_dm") > 0).select(entity, (F.col("_dz") / F.col("_dm")).alias("_vz"),
                                            (F.col("_dy") / F.col("_dm")).alias("_vt"))
    g = st.groupBy(entity).agg(F.count(F.lit(1)).alias("_n"), F.avg("_vz").alias("_mz"), F.avg("_vt").alias("_mt"),
                               F.var_pop("_vz").alias("_vzz"), F.covar_pop("_vz", "_vt").alias("_czt"),
                               F.var_pop("_vt").alias("_vtt"))
    beta = F.when(F.col("_vzz") > 0, F.col("_czt") / F.col("_vzz")).otherwise(F.lit(0.0))
    g = g.withColumn("_b", beta).withColumn("_a", F.col("_mt") - F.col("_b") * F.col("_mz"))
    # residual variance of an OLS fit = var(vt) - beta * cov(vz, vt)
    resid = F.sqrt(F.greatest(F.col("_vtt") - F.col("_b") * F.col("_czt"), F.lit(0.0)))
    ok = F.col("_n") >= min_steps
    return g.select(entity,
                    F.when(ok, F.col("_b")).otherwise(F.lit(-1.0)).alias("beta"),
                    F.when(ok, F.col("_a")).otherwise(F.lit(0.0)).alias("icpt"),
                    F.when(ok, F.greatest(resid, F.lit(0.001))).otherwise(F.lit(0.1)).alias("zsig"))


def segment_offsets(df: DataFrame, entity: str, idx: str, known: Column, y: str, z: str, surface: str,
                    tail: int = 50, growth: float = 0.02, n_known: str | None = None) -> DataFrame:
    """Offsets b = y + z - surface over the known zone.

    b_full: median; b_early/b_mid/b_late: medians of the first third, middle
    third and last ``tail`` rows; b_wls: exp(growth * j)-weighted mean.
    """
    kn = known_position(df, entity, idx, known, n_known=n_known)
    if n_known:
        kn = kn.withColumn("_n", F.col(n_known))
    else:
        kn = kn.join(kn.groupBy(entity).agg(F.count(F.lit(1)).alias("_n")), entity)
    # narrow and stored: the weighted mean and the medians' two passes read it
    kn = cut_lineage(kn.select(entity, "_j", "_n", (F.col(y) + F.col(z) - F.col(surface)).alias("_b")))
    t1 = F.floor(F.col("_n") / 3)
    t2 = F.floor(F.col("_n") * 2 / 3)
    j = F.col("_j")
    late = F.exp(F.lit(growth) * (j - (F.col("_n") - 1)))
    # relative to the last row: the same ratio, and no weight exceeds 1
    g = kn.groupBy(F.struct(entity).alias("_e")).agg(F.max("_n").alias("_n"), (F.sum(late * F.col("_b")) / F.sum(late)).alias("b_wls"))
    med = grouped_medians(kn, [entity], {
        "b_full": "_b",
        "_late": F.when(j >= F.greatest(F.col("_n") - tail, F.lit(0)), F.col("_b")),
        "_early": F.when(j < F.greatest(t1, F.lit(1)), F.col("_b")),
        "_mid": F.when((j >= t1) & (j < F.greatest(t1 + 1, t2)), F.col("_b"))})
    g = med.join(g, F.struct(entity) == F.col("_e"))
    n_ = F.col("_n")
    return g.select(
        entity, "b_full",
        F.when(F.floor(n_ / 3) > 0, F.col("_early")).otherwise(F.col("b_full")).alias("b_early"),
        F.when(F.floor(n_ * 2 / 3) > F.floor(n_ / 3), F.col("_mid")).otherwise(F.col("b_full")).alias("b_mid"),
        F.when(n_ >= 5, F.col("_late")).otherwise(F.col("b_full")).alias("b_late"),
        "b_wls")


def candidate_path_offset(df: DataFrame, entity: str, idx: str, known: Column, y: str, z: str,
                          surface: str, n_known: str | None = None) -> DataFrame:
    """Path -z + surface + b_full for every row, plus known-zone residual RMSE and bias."""
    off = segment_offsets(df, entity, idx, known, y, z, surface, n_known=n_known).select(entity, "b_full")
    j = df.join(off, entity).withColumn("path", -F.col(z) + F.col(surface) + F.col("b_full"))
    res = F.when(known, F.col(y) - F.col("path"))
    stats = j.groupBy(entity).agg(F.sqrt(F.avg(res * res)).alias("path_rmse"), F.avg(res).alias("path_bias"))
    return j.join(stats, entity).drop("b_full")


def consensus_stats(df: DataFrame, cols: Sequence[str], prefix: str = "cons_") -> DataFrame:
    """Across candidate columns in a row: mean, std (ddof 0), median, max-min."""
    arr = F.array_sort(F.array(*[F.col(c).cast("double") for c in cols]))
    k = len(cols)
    mean = sum(F.col(c) for c in cols) / k
    var = sum((F.col(c) - F.col(f"{prefix}mean")) * (F.col(c) - F.col(f"{prefix}mean")) for c in cols) / k
    med = arr[k // 2] if k % 2 else (arr[k // 2 - 1] + arr[k // 2]) / 2
    return (df.withColumn(f"{prefix}mean", mean).withColumn(f"{prefix}std", F.sqrt(var))
            .withColumn(f"{prefix}median", med)
            .withColumn(f"{prefix}range", F.array_max(arr) - F.array_min(arr)))


def likelihood_weighted_mean(df: DataFrame, group: str, score: str, pred: str,
                             scales: Sequence[float] = (3.0, 5.0, 8.0, 12.0)) -> DataFrame:
    """Softmax of (score - max) / scale over each group's candidates, weighted mean of ``pred``."""
    g = df.groupBy(group).agg(F.max(score).alias("_mx"))
    j = df.join(g, group).withColumn("_ln", F.col(score) - F.col("_mx"))
    aggs = []
    for s in scales:
        w = F.exp(F.col("_ln") / F.lit(float(s)))
        aggs.append((F.sum(w * F.col(pred)) / F.sum(w)).alias(f"w_scale_{s:g}"))
    aggs.append(F.avg(pred).alias("w_mean"))
    return j.groupBy(group).agg(*aggs)


def ensemble_quality(df: DataFrame, group: str, score: str, pred: str) -> DataFrame:
    return df.groupBy(group).agg((F.max(score) / F.count(F.lit(1))).alias("best_per_n"),
                                 F.stddev_pop(score).alias("score_spread"),
                                 F.stddev_pop(pred).alias("pred_std"))


def score_weighted_blend(df: DataFrame, values: Sequence[str], scores: Sequence[str], temp: float = 3.0,
                         out: str = "blend") -> DataFrame:
    """Row-wise exp(temp * score) weights across candidate values."""
    ws = [F.exp(F.lit(temp) * F.col(s)) for s in scores]
    tot = sum(ws) + F.lit(1e-9)
    return df.withColumn(out, sum(F.col(v) * w for v, w in zip(values, ws)) / tot)


def contact_offset_reconstruct(seq_df: DataFrame, tmpl_df: DataFrame, entity: str, tid: str, y: str, z: str,
                               surface: str, known: Column, ref_label: str, tx: str = "x",
                               tlab: str = "lab") -> DataFrame:
    """Reconstruct y = ref_x - (z - surface) + mean offset.

    ``ref_x`` is the template's smallest x carrying ``ref_label``; when the
    template lacks it the first label present (smallest x) is used instead.
    """
    t = tmpl_df.filter(F.col(tlab).isNotNull())
    ref = t.groupBy(tid).agg(F.min(F.when(F.col(tlab) == ref_label, F.col(tx))).alias("_ref"),
                             F.min_by(F.col(tlab), F.struct(F.col(tx), F.col(tlab))).alias("_first"))
    fb = t.join(ref.select(tid, "_first"), tid).filter(F.col(tlab) == F.col("_first")) \
        .groupBy(tid).agg(F.min(tx).alias("_fb"))
    ref = ref.join(fb, tid, "left").select(tid, F.coalesce("_ref", "_fb").alias("ref_x"))
    j = seq_df.join(ref, tid)
    base = F.col("ref_x") - (F.col(z) - F.col(surface))
    off = j.filter(known).groupBy(entity).agg(F.avg(F.col(y) - base).alias("offset"))
    return j.join(off, entity, "left").withColumn("recon", base + F.col("offset"))

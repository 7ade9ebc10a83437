"""Ensembling and post-processing.

Weight fitting reduces the data to a k x k Gram matrix (XᵀX, Xᵀy) in one
aggregation — a fixed-size result however many rows — and solves the small
system on the driver (k is the number of blended signals, at most a
handful).  Per-entity polynomial fits likewise reduce each entity to a
fixed-size vector of weighted power sums; the small per-entity systems are
solved row-wise on that summary table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.operators.matching import interp_lookup
from stratum.operators.quantiles import grouped_medians
from stratum.operators.sequence import DEFAULT_BLOCK, halo_blocks, own_rows
from stratum.session import cut_lineage


# ---- fixed-weight and column-expression post-processing ---------------------------------------

def linear_blend(df: DataFrame, cols: Sequence[str], weights: Sequence[float], out: str) -> DataFrame:
    return df.withColumn(out, sum(F.col(c) * F.lit(float(w)) for c, w in zip(cols, weights)))


def hold_mix(df: DataFrame, base: str, alt: str, last: str, beam_w: Column, hold_w: Column, out: str) -> DataFrame:
    mixed = (F.lit(1.0) - beam_w) * F.col(base) + beam_w * F.col(alt)
    return df.withColumn(out, (F.lit(1.0) - hold_w) * mixed + hold_w * F.col(last))


def warmup_damp(df: DataFrame, delta: str, dist: str, tau: float, out: str) -> DataFrame:
    if tau <= 1e-6:
        return df.withColumn(out, F.col(delta))
    f = F.lit(1.0) - F.exp(-F.greatest(F.col(dist), F.lit(0.0)) / F.lit(float(tau)))
    return df.withColumn(out, F.col(delta) * f)


def trust_hybrid(df: DataFrame, ref_a: str, ref_b: str, n: str, out: str, denom: float = 200.0, cap: float = 0.6) -> DataFrame:
    t = F.least(F.greatest(F.col(n) / F.lit(denom), F.lit(0.0)), F.lit(cap))
    return df.withColumn(out, (F.lit(1.0) - t) * F.col(ref_a) + t * F.col(ref_b))


def signal_disagreement(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    return df.withColumns({f"{a}_vs_{b}": F.col(a) - F.col(b) for a, b in pairs})


# ---- Gram-matrix weight fitting ----------------------------------------------------------------

def gram(df: DataFrame, cols: Sequence[str], y: str, group: str | None = None) -> DataFrame:
    """XᵀX, Xᵀy, yᵀy and n in one aggregation (per ``group`` when given)."""
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(F.col(y) * F.col(y)).alias("yy")]
    for i, a in enumerate(cols):
        aggs.append(F.sum(F.col(a) * F.col(y)).alias(f"xy_{a}"))
        aggs.append(F.sum(a).alias(f"sx_{a}"))
        for b in cols[i:]:
            aggs.append(F.sum(F.col(a) * F.col(b)).alias(f"xx_{a}__{b}"))
    aggs.append(F.sum(y).alias("sy"))
    return (df.groupBy(group) if group else df).agg(*aggs)


def _mats(row, cols):
    k = len(cols)
    A = np.zeros((k, k))
    b = np.zeros(k)
    for i, a in enumerate(cols):
        b[i] = row[f"xy_{a}"]
        for j in range(i, k):
            A[i, j] = A[j, i] = row[f"xx_{a}__{cols[j]}"]
    return A, b


def nnls_solve(A: np.ndarray, b: np.ndarray, tol: float = 1e-12, max_iter: int = 200) -> np.ndarray:
    """Lawson-Hanson active set on the normal equations (A = XᵀX, b = Xᵀy).

    ``tol`` is relative: gradients are judged against the largest entry of b,
    weights against the largest weight that one signal alone would get.  Raises
    if the active set has not settled after ``max_iter`` changes.
    """
    k = len(b)
    x = np.zeros(k)
    slope = tol * max(float(np.abs(b).max(initial=0.0)), 1e-300)
    diag = np.where(np.diag(A) > 0, np.diag(A), 1.0)
    tol = tol * max(float(np.abs(b / diag).max(initial=0.0)), 1e-300)
    passive = np.zeros(k, dtype=bool)
    for _ in range(max_iter):
        grad = b - A @ x
        if passive.all() or grad[~passive].max(initial=-np.inf) <= slope:
            return x
        j = int(np.argmax(np.where(passive, -np.inf, grad)))
        passive[j] = True
        while True:
            z = np.zeros(k)
            idx = np.where(passive)[0]
            z[idx] = np.linalg.lstsq(A[np.ix_(idx, idx)], b[idx], rcond=None)[0]
            if (z[idx] > tol).all():
                x = z
                break
            neg = idx[z[idx] <= tol]
            alpha = np.min(x[neg] / (x[neg] - z[neg] + 1e-300))
            x = x + alpha * (z - x)
            passive &= x > tol
    raise RuntimeError("non-negative least squares did not settle")


def nnls_blend(df: DataFrame, cols: Sequence[str], y: str) -> DataFrame:
    """Non-negative least-squares weights, no intercept: one row per signal."""
    row = gram(df, cols, y).first()  # one fixed-size row (k x k sums)
    A, b = _mats(row, cols)
    w = nnls_solve(A, b)
    return df.sparkSession.createDataFrame([(c, float(v)) for c, v in zip(cols, w)], "signal string, weight double")


def ridge_weights(row, cols, alpha: float, positive: bool = False):
    """Ridge with an unpenalised intercept from the Gram sums.

    Plain: on standardised signals (population std, below 1e-6 taken as 1).
    ``positive``: on the raw signals, with weights of at least zero.
    """
    n = row["n"]
    k = len(cols)
    A, b = _mats(row, cols)
    mx = np.array([row[f"sx_{c}"] / n for c in cols])
    my = row["sy"] / n
    C = A / n - np.outer(mx, mx)
    cy = b / n - mx * my
    if positive:
        coef = nnls_solve(C * n + alpha * np.eye(k), cy * n)
        return coef, float(my - mx @ coef)
    sd = np.sqrt(np.maximum(np.diag(C), 0.0))
    sd = np.where(sd < 1e-6, 1.0, sd)
    Cz = C / np.outer(sd, sd) * n + alpha * np.eye(k)
    cz = cy / sd * n
    coef = np.linalg.solve(Cz, cz) / sd
    return coef, float(my - mx @ coef)


def ridge_blend(df: DataFrame, cols: Sequence[str], y: str, alpha: float = 1.0, positive: bool = False) -> DataFrame:
    row = gram(df, cols, y).first()
    coef, icpt = ridge_weights(row, cols, alpha, positive)
    rows = [(c, float(v)) for c, v in zip(cols, coef)] + [("intercept", icpt)]
    return df.sparkSession.createDataFrame(rows, "signal string, weight double")


def heldout_blend_rmse(df: DataFrame, cols: Sequence[str], y: str, fold: str, method: str = "nnls",
                       alpha: float = 1.0) -> DataFrame:
    """Weights fitted on the other folds (Gram = total - own fold), scored on each fold.

    One pass builds the per-fold Grams; the k-fold solves are on k small
    matrices; scoring is one more aggregation.  Returns per fold the weights,
    fold RMSE and the pooled RMSE.
    """
    per = gram(df, cols, y, fold).collect()  # k rows of fixed size
    tot = {c: sum(r[c] for r in per) for c in per[0].asDict() if c != fold}
    rows = []
    for r in per:
        rest = {c: tot[c] - r[c] for c in tot}
        if method == "nnls":
            A, b = _mats(rest, cols)
            w, icpt = nnls_solve(A, b), 0.0
        else:
            w, icpt = ridge_weights(rest, cols, alpha, positive=(method == "ridge_pos"))
        rows.append((r[fold], *[float(v) for v in w], float(icpt)))
    wdf = df.sparkSession.createDataFrame(rows, [fold, *[f"w_{c}" for c in cols], "w_icpt"])
    pred = sum(F.col(c) * F.col(f"w_{c}") for c in cols) + F.col("w_icpt")
    j = df.join(F.broadcast(wdf), fold)  # k rows
    e = (F.col(y) - pred)
    sc = j.groupBy(fold).agg(F.sum(e * e).alias("_sse"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy()
    return wdf.join(sc, fold).select(fold, *[f"w_{c}" for c in cols], "w_icpt",
                                     F.sqrt(F.col("_sse") / F.col("_n")).alias("fold_rmse"),
                                     F.sqrt(F.sum("_sse").over(w) / F.sum("_n").over(w)).alias("pooled_rmse"))


def paired_repeat_test(errors: DataFrame, rep: str, method: str, score: str, a: str, b: str) -> DataFrame:
    """Paired difference a - b over repeats: mean, std (ddof 0), t = mean / (std / sqrt(R))."""
    p = errors.groupBy(rep).agg((F.max(F.when(F.col(method) == a, F.col(score)))
                                 - F.max(F.when(F.col(method) == b, F.col(score)))).alias("_d"))
    g = p.agg(F.avg("_d").alias("mean_diff"), F.stddev_pop("_d").alias("std_diff"), F.count(F.lit(1)).alias("n_repeats"))
    return g.withColumn("t_stat", F.col("mean_diff") / (F.col("std_diff") / F.sqrt(F.col("n_repeats"))))


# ---- Savitzky-Golay ----------------------------------------------------------------------------

@lru_cache(maxsize=None)
def savgol_hat(wl: int, deg: int) -> np.ndarray:
    """Rows of the least-squares hat matrix for a polynomial of ``deg`` on ``wl`` equally spaced points."""
    h = (wl - 1) / 2.0
    t = (np.arange(wl) - h) / max(h, 1.0)
    X = np.vander(t, deg + 1, increasing=True)
    return X @ np.linalg.pinv(X)


def savgol_table(spark, window: int, deg: int) -> DataFrame:
    """(wl, r, coef array) for every odd window length deg+2..window (a small constant table)."""
    rows = []
    for wl in range(deg + 2, window + 1):
        if wl % 2 == 0:
            continue
        H = savgol_hat(wl, deg)
        for r in range(wl):
            rows.append((wl, r, [float(v) for v in H[r]]))
    return spark.createDataFrame(rows, "wl int, r int, coef array<double>")


def savgol_smooth(df: DataFrame, entity: str, idx: str, n: str, value: str, out: str, window: int = 17,
                  deg: int = 3, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Per-entity Savitzky-Golay filter; ends use the polynomial of the end window.

    wl = min(window, n) made odd; wl < deg + 2 leaves the values unchanged.
    A row whose window holds a null has no smoothed value.
    ``idx`` is the 0-based position in the entity and ``n`` its length.
    """
    wl = F.least(F.lit(window), F.col(n))
    wl = F.when(wl % 2 == 0, wl - 1).otherwise(wl).cast("int")
    d = df.withColumn("_wl", wl)
    d = d.withColumn("_st", F.least(F.greatest(F.col(idx) - (F.col("_wl") - 1) / 2, F.lit(0)), F.col(n) - F.col("_wl")).cast("long"))
    d = d.withColumn("_r", (F.col(idx) - F.col("_st")).cast("int"))
    h = halo_blocks(d, idx, window - 1, block)
    fr = Window.partitionBy(entity, "_blk").orderBy(idx).rowsBetween(-(window - 1), window - 1)
    # structs keep the nulls, so a null cannot shift the values behind it; a window that holds one gives null
    held = F.transform(F.collect_list(F.struct(F.col(value).alias("v"))).over(fr), lambda s: s["v"])
    h = h.withColumn("_vals", held).withColumn("_i0", F.min(idx).over(fr))
    o = own_rows(h)
    tab = savgol_table(df.sparkSession, window, deg)
    o = o.join(F.broadcast(tab), (o["_wl"] == tab["wl"]) & (o["_r"] == tab["r"]), "left")  # bounded constant table
    seg = F.slice("_vals", (F.col("_st") - F.col("_i0") + 1).cast("int"), F.col("_wl"))
    dot = F.aggregate(F.zip_with(seg, F.col("coef"), lambda a, c: a * c), F.lit(0.0), lambda s, v: s + v)
    ok = (F.col("_wl") >= deg + 2) & F.col("coef").isNotNull()
    return o.withColumn(out, F.when(ok, dot).otherwise(F.col(value))).drop(
        "_wl", "_st", "_r", "_vals", "_i0", "wl", "r", "coef")


# ---- robust polynomial projection ----------------------------------------------------------------

def _solve_rows(sums: DataFrame, key: str, deg: int) -> DataFrame:
    """Solve each entity's (deg+1)x(deg+1) weighted normal equations; returns key, c0..c_deg."""
    k = deg + 1
    if deg == 1:
        s0, s1, s2, t0, t1 = (F.col(c) for c in ("_p0", "_p1", "_p2", "_q0", "_q1"))
        det = s0 * s2 - s1 * s1
        c1 = (s0 * t1 - s1 * t0) / det
        return sums.select(key, ((t0 - c1 * s1) / s0).alias("c0"), c1.alias("c1"))
    schema = sums.select(key).schema
    for j in range(k):
        schema = schema.add(f"c{j}", "double")

    def solve(it):
        import pandas as pd
        for pdf in it:
            a = np.stack([np.stack([pdf[f"_p{i + j}"].to_numpy() for j in range(k)], -1) for i in range(k)], -2)
            b = np.stack([pdf[f"_q{i}"].to_numpy() for i in range(k)], -1)
            # one stacked pseudo-inverse: the least-squares solution also where a system is singular
            sol = (np.linalg.pinv(a, rcond=np.finfo(float).eps * k) @ b[..., None])[..., 0]
            yield pd.DataFrame({key: pdf[key].to_numpy(), **{f"c{j}": sol[:, j] for j in range(k)}})
    return sums.select(key, *[f"_p{j}" for j in range(2 * deg + 1)], *[f"_q{j}" for j in range(k)]).mapInPandas(solve, schema)


def _fit_coefficients(d: DataFrame, key: str, s: str, y: str, w: Column | None, deg: int) -> DataFrame:
    """(key, c0 .. c_deg): the weighted least-squares polynomial of y on s per key, from power sums."""
    ww = w if w is not None else F.lit(1.0)
    aggs = [F.sum(ww * F.pow(F.col(s), j)).alias(f"_p{j}") for j in range(2 * deg + 1)]
    aggs += [F.sum(ww * F.pow(F.col(s), j) * F.col(y)).alias(f"_q{j}") for j in range(deg + 1)]
    return _solve_rows(d.groupBy(key).agg(*aggs), key, deg)


def robust_poly_project(df: DataFrame, entity: str, s: str, y: str, out: str, deg: int = 4, rounds: int = 4,
                        raw_share: float = 0.25, eligible: Column | None = None) -> DataFrame:
    """Iteratively reweighted polynomial fit of y on s per entity, blended with the raw values.

    The first fit is unweighted; each of ``rounds`` refits uses weights
    (1 / (1 + (r / (2 * 1.4826 * MAD)))^2)^2 — the square because residual
    weights apply to unsquared residuals.  Output = raw_share * y +
    (1 - raw_share) * fit; entities with fewer than deg + 2 rows (or failing
    ``eligible``) keep y.

    The rows are stored once, narrow.  What a round hands on is one row per
    entity, coefficients and MAD; residuals are recomputed from it.
    """
    n = df.groupBy(entity).agg(F.count(F.lit(1)).alias("_n"))
    d = df.join(n, entity)
    ok = F.col("_n") >= deg + 2
    if eligible is not None:
        ok = ok & eligible
    d = d.withColumn("_ok", ok)
    base = cut_lineage(d.filter("_ok").select(entity, F.col(s).alias("_s"), F.col(y).alias("_y")))
    fit = sum(F.col(f"c{j}") * F.pow(F.col("_s"), j) for j in range(deg + 1))
    state = cut_lineage(_fit_coefficients(base, entity, "_s", "_y", None, deg))
    for _ in range(rounds):
        res = base.join(state, entity).select(entity, "_s", "_y", (F.col("_y") - fit).alias("_res"))
        mad = grouped_medians(res, [entity], {"_mad": F.abs("_res")})
        state = cut_lineage(state.join(mad, entity))
        sc = F.col("_mad") * 1.4826 + F.lit(1e-6)
        w1 = F.lit(1.0) / (F.lit(1.0) + F.pow((F.col("_y") - fit) / (F.lit(2.0) * sc), 2))
        weighted = base.join(state, entity).withColumn("_w", w1 * w1).select(entity, "_s", "_y", "_w")
        state = cut_lineage(_fit_coefficients(weighted, entity, "_s", "_y", F.col("_w"), deg))
    fitted = d.filter("_ok").join(state, entity).withColumn("_s", F.col(s))
    res = fitted.withColumn(out, F.lit(raw_share) * F.col(y) + F.lit(1.0 - raw_share) * fit)
    keep = [c for c in df.columns] + [out]
    skipped = d.filter(~F.col("_ok")).withColumn(out, F.col(y))
    return res.select(*keep).unionByName(skipped.select(*keep))


def learned_residual(df: DataFrame, fold: str, residual: str, x: str, base: str, out: str) -> DataFrame:
    """``base`` plus the residual that a line in ``x``, fitted on the rows of all other folds, predicts.

    One pass adds up five sums per fold; a fold's line comes from the totals
    less its own sums, so nothing is fitted twice and a hot fold costs no more.
    """
    known = F.col(residual).isNotNull() & F.col(x).isNotNull()
    vals = {"n": F.lit(1.0), "x": F.col(x), "y": F.col(residual), "xx": F.col(x) * F.col(x), "xy": F.col(x) * F.col(residual)}
    per = df.groupBy(fold).agg(*[F.sum(F.when(known, v)).alias(f"_{k}") for k, v in vals.items()])
    total = per.agg(*[F.sum(f"_{k}").alias(f"_t{k}") for k in vals])               # one row
    rest = {k: F.col(f"_t{k}") - F.coalesce(F.col(f"_{k}"), F.lit(0.0)) for k in vals}
    sxx = rest["xx"] - rest["x"] * rest["x"] / rest["n"]
    slope = (rest["xy"] - rest["x"] * rest["y"] / rest["n"]) / F.nullif(sxx, F.lit(0.0))
    line = per.crossJoin(F.broadcast(total)).filter(rest["n"] > 0).withColumn("_slope", slope)
    line = line.select(F.col(fold), "_slope", ((rest["y"] - F.col("_slope") * rest["x"]) / rest["n"]).alias("_start"))
    return (df.join(line, fold, "left").withColumn(out, F.col(base) + F.col("_start") + F.col("_slope") * F.col(x))
            .drop("_slope", "_start"))


# ---- guarded override ----------------------------------------------------------------------------

def guarded_override(rows: DataFrame, ref: DataFrame, entity: str, axis: str, label: str, known: str, blend: str,
                     out: str, min_valid: int = 100, min_compare: int = 50,
                     max_rmse: float = 1.0) -> DataFrame:
    """Replace ``blend`` by the reference copy's value (interpolated by axis) only where it is verified.

    Per entity: the reference copy needs >= min_valid rows; the known rows
    of this copy inside the reference range (>= min_compare of them) must
    agree with it to RMSE <= max_rmse; then rows inside the range are
    overridden.  Adds ``verdict`` (OK / SKIP + reason) per entity.
    """
    rg = ref.groupBy(entity).agg(F.count(F.lit(1)).alias("_nv"), F.min("x").alias("_lo"), F.max("x").alias("_hi"))
    ph = interp_lookup(rows, ref, entity, F.col(axis), "x", "y", "_phys").join(rg, entity, "left")
    inr = F.col(axis).between(F.col("_lo"), F.col("_hi"))
    cmp = F.col(known) & inr
    d = F.col("_phys") - F.col(label)
    ck = ph.groupBy(entity).agg(F.first("_nv", ignorenulls=True).alias("_nv"), F.count_if(cmp).alias("_ncmp"),
                                F.sqrt(F.avg(F.when(cmp, d * d))).alias("_rk"))
    verdict = (F.when(F.coalesce(F.col("_nv"), F.lit(0)) < min_valid, F.lit("SKIP too few valid rows"))
               .when(F.col("_ncmp") < min_compare, F.lit("SKIP too few comparable rows"))
               .when(F.col("_rk").isNull() | (F.col("_rk") > max_rmse), F.lit("SKIP prefix rmse"))
               .otherwise(F.lit("OK")))
    ck = ck.select(entity, verdict.alias("verdict"))
    j = ph.join(ck, entity)
    return j.withColumn(out, F.when((F.col("verdict") == "OK") & inr, F.col("_phys")).otherwise(F.col(blend))).drop(
        "_phys", "_nv", "_lo", "_hi")

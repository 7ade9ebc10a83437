"""Window and sequence functions over the entity sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratum.operators import aggregates as A
from stratum.operators import metrics as M
from stratum.operators import regression as R
from stratum.operators import sequence as Q
from stratum.plans import views
from stratum.plans.catalog.baseline import OLS_SQL, prior_predictions
from stratum.plans.registry import register


def _seq(spark, sf):
    return views.seq(spark, sf)


@register("row_in_group", sql="""
SELECT user_id AS entity, event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS i FROM events""")
def q_row_in_group(spark, sf):
    return _seq(spark, sf).select("entity", "event_id", "i")


@register("zone_fraction", dbl=["zone_pos", "frac", "frac2", "sqrt_frac"], sql="""
WITH s AS (SELECT *, count(*) FILTER (WHERE known) OVER (PARTITION BY entity) AS nk FROM seq)
SELECT entity, i, (i - nk + 1) / (n - nk) AS zone_pos, (i - nk) / greatest(n - nk - 1, 1) AS frac,
       ((i - nk) / greatest(n - nk - 1, 1)) * ((i - nk) / greatest(n - nk - 1, 1)) AS frac2,
       sqrt((i - nk) / greatest(n - nk - 1, 1)) AS sqrt_frac
FROM s WHERE NOT known""")
def q_zone_fraction(spark, sf):
    s = _seq(spark, sf).filter("NOT known").withColumnRenamed("nkn", "nk")
    frac = (F.col("i") - F.col("nk")) / F.greatest(F.col("n") - F.col("nk") - 1, F.lit(1))
    return s.select("entity", "i", ((F.col("i") - F.col("nk") + 1) / (F.col("n") - F.col("nk"))).alias("zone_pos"), frac.alias("frac"),
                    (frac * frac).alias("frac2"), F.sqrt(frac).alias("sqrt_frac"))


def _boundary(s):
    return A.boundary_row(s, "entity", "i", ["pos", "k", "sig", "prior"], F.col("known"))


@register("dist_from_boundary", dbl=["dist"], sql="""
WITH b AS (SELECT entity, arg_max(pos, i) AS last_pos FROM seq WHERE known GROUP BY entity),
f AS (SELECT entity, min(pos) AS first_eval FROM seq WHERE NOT known GROUP BY entity)
SELECT s.entity, s.i, s.pos - coalesce(b.last_pos, f.first_eval) AS dist
FROM seq AS s LEFT JOIN b ON s.entity = b.entity LEFT JOIN f ON s.entity = f.entity WHERE NOT s.known""")
def q_dist_from_boundary(spark, sf):
    s = _seq(spark, sf)
    b = _boundary(s).select("entity", "last_pos")
    f = s.filter("NOT known").groupBy("entity").agg(F.min("pos").alias("first_eval"))
    e = s.filter("NOT known").join(b, "entity", "left").join(f, "entity", "left")
    return e.select("entity", "i", (F.col("pos") - F.coalesce("last_pos", "first_eval")).alias("dist"))


@register("offset_from_boundary", dbl=["dx", "dy", "dz", "dxy"], sql="""
WITH b AS (SELECT entity, arg_max(pos, i) AS lp, arg_max(k, i) AS lk, arg_max(prior, i) AS lz FROM seq WHERE known GROUP BY entity)
SELECT s.entity, s.i, s.pos - b.lp AS dx, s.k - b.lk AS dy, s.prior - b.lz AS dz,
       sqrt((s.pos - b.lp) * (s.pos - b.lp) + (s.k - b.lk) * (s.k - b.lk)) AS dxy
FROM seq AS s JOIN b ON s.entity = b.entity WHERE NOT s.known""")
def q_offset_from_boundary(spark, sf):
    s = _seq(spark, sf)
    e = s.filter("NOT known").join(_boundary(s), "entity")
    dx, dy = F.col("pos") - F.col("last_pos"), F.col("k") - F.col("last_k")
    return e.select("entity", "i", dx.alias("dx"), dy.alias("dy"), (F.col("prior") - F.col("last_prior")).alias("dz"),
                    F.sqrt(dx * dx + dy * dy).alias("dxy"))


GAP_SQL = """
nb AS (SELECT entity, i, sig_gap, prior,
  last_value(CASE WHEN sig_gap IS NOT NULL THEN i END IGNORE NULLS) OVER (PARTITION BY entity ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pi,
  last_value(sig_gap IGNORE NULLS) OVER (PARTITION BY entity ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
  first_value(CASE WHEN sig_gap IS NOT NULL THEN i END IGNORE NULLS) OVER (PARTITION BY entity ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ni,
  first_value(sig_gap IGNORE NULLS) OVER (PARTITION BY entity ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv
  FROM seq),
gf AS (SELECT entity, i, coalesce(CASE WHEN pi IS NOT NULL AND ni IS NOT NULL THEN CASE WHEN ni = pi THEN pv ELSE pv + (nv - pv) * (i - pi) / (ni - pi) END
                                       WHEN pi IS NOT NULL THEN pv WHEN ni IS NOT NULL THEN nv END, prior) AS filled FROM nb)"""


@register("gap_interpolate", dbl=["filled"], sql=f"WITH {GAP_SQL} SELECT entity, i, filled FROM gf")
def q_gap_interpolate(spark, sf):
    s = _seq(spark, sf).select("entity", "i", "sig_gap", "prior")
    return Q.gap_interpolate(s, "entity", "i", "sig_gap", "filled", F.col("prior")).select("entity", "i", "filled")


ROLL_W = (5, 21, 51, 101)


@register("rolling_centered", dbl=[f"roll_{s}{w}" for w in ROLL_W for s in ("mean", "std")], sql="""
SELECT entity, i, """ + ",\n".join(
    f"avg(sig_gap) OVER (PARTITION BY entity ORDER BY i ROWS BETWEEN {(w - 1) // 2} PRECEDING AND {(w - 1) // 2} FOLLOWING) AS roll_mean{w}, "
    f"coalesce(stddev_samp(sig_gap) OVER (PARTITION BY entity ORDER BY i ROWS BETWEEN {(w - 1) // 2} PRECEDING AND {(w - 1) // 2} FOLLOWING), 0.0) AS roll_std{w}"
    for w in ROLL_W) + " FROM seq")
def q_rolling_centered(spark, sf):
    s = _seq(spark, sf).select("entity", "i", "sig_gap")
    return Q.rolling_centered(s, "entity", "i", "sig_gap", ROLL_W).drop("sig_gap")


@register("rolling_max", dbl=["roll_max"], sql="""
SELECT entity, i, max(sig) OVER (PARTITION BY entity ORDER BY i ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING) AS roll_max FROM seq""")
def q_rolling_max(spark, sf):
    return Q.rolling_max(_seq(spark, sf).select("entity", "i", "sig"), "entity", "i", "sig").drop("sig")


@register("rolling_rms", dbl=["roll_rms"], sql="""
SELECT entity, i, sqrt(avg(sig * sig) OVER (PARTITION BY entity ORDER BY i ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING)) AS roll_rms FROM seq""")
def q_rolling_rms(spark, sf):
    return Q.rolling_rms(_seq(spark, sf).select("entity", "i", "sig"), "entity", "i", "sig").drop("sig")


@register("smooth_mean", dbl=["smooth"], sql=f"""
WITH {GAP_SQL} SELECT entity, i, avg(filled) OVER (PARTITION BY entity ORDER BY i ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS smooth FROM gf""")
def q_smooth_mean(spark, sf):
    s = _seq(spark, sf).select("entity", "i", "sig_gap", "prior")
    return Q.smooth_mean(s, "entity", "i", "sig_gap", 2, "smooth", F.col("prior")).select("entity", "i", "smooth")


LAGS = (1, 5, 15, 30)


@register("lag_lead_filled", dbl=[f"{d}{k}" for k in LAGS for d in ("lag", "lead")], sql="""
WITH f AS (SELECT entity, i, n,
  first_value(CASE WHEN sig_gap IS NOT NULL THEN i END IGNORE NULLS) OVER nx AS ni, first_value(sig_gap IGNORE NULLS) OVER nx AS nv,
  last_value(CASE WHEN sig_gap IS NOT NULL THEN i END IGNORE NULLS) OVER pv AS pi, last_value(sig_gap IGNORE NULLS) OVER pv AS pv
  FROM seq WINDOW nx AS (PARTITION BY entity ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
                  pv AS (PARTITION BY entity ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT r.entity, r.i, """ + ",\n".join(
    f"(SELECT CASE WHEN s.ni <= r.n - 1 - {k} THEN s.nv END FROM f AS s WHERE s.entity = r.entity AND s.i = greatest(r.i - {k}, 0)) AS lag{k}, "
    f"(SELECT CASE WHEN s.pi >= {k} THEN s.pv END FROM f AS s WHERE s.entity = r.entity AND s.i = least(r.i + {k}, r.n - 1)) AS lead{k}"
    for k in LAGS) + " FROM f AS r")
def q_lag_lead_filled(spark, sf):
    s = _seq(spark, sf).select("entity", "i", "n", "sig_gap")
    return Q.lag_lead_filled(s, "entity", "i", "sig_gap", LAGS, n="n").drop("sig_gap", "n")


@register("diff_1_2", dbl=["d1", "d2"], sql="""
SELECT entity, i, coalesce(sig - lag(sig) OVER w, 0.0) AS d1, coalesce(sig - 2 * lag(sig) OVER w + lag(sig, 2) OVER w, 0.0) AS d2
FROM seq WINDOW w AS (PARTITION BY entity ORDER BY i)""")
def q_diff_1_2(spark, sf):
    return Q.diff_1_2(_seq(spark, sf).select("entity", "i", "sig"), "entity", "i", "sig").drop("sig")


@register("axis_derivative", dbl=["dk_dpos", "dsig_dpos", "dprior_dpos"], sql="""
SELECT entity, i, (k - lag(k) OVER w) / nullif(pos - lag(pos) OVER w, 0) AS dk_dpos,
       (sig - lag(sig) OVER w) / nullif(pos - lag(pos) OVER w, 0) AS dsig_dpos,
       (prior - lag(prior) OVER w) / nullif(pos - lag(pos) OVER w, 0) AS dprior_dpos
FROM seq WINDOW w AS (PARTITION BY entity ORDER BY i)""")
def q_axis_derivative(spark, sf):
    s = _seq(spark, sf).select("entity", "i", "pos", "k", "sig", "prior")
    return Q.axis_derivative(s, "entity", "i", "pos", ["k", "sig", "prior"]).select(
        "entity", "i", "dk_dpos", "dsig_dpos", "dprior_dpos")


@register("linear_extrapolate", dbl=["ext_all", "ext_50"], sql="""
WITH kn AS (SELECT entity, i, pos, sig, row_number() OVER (PARTITION BY entity ORDER BY i DESC) AS r FROM seq WHERE known),
sl AS (SELECT entity, arg_max(sig, i) AS ls, arg_max(pos, i) AS lp,
  CASE WHEN count(*) >= 2 AND stddev_pop(pos) >= 1e-6 THEN regr_slope(sig, pos) ELSE 0.0 END AS s_all,
  CASE WHEN count(CASE WHEN r <= 50 THEN 1 END) >= 2 AND stddev_pop(CASE WHEN r <= 50 THEN pos END) >= 1e-6
       THEN regr_slope(CASE WHEN r <= 50 THEN sig END, CASE WHEN r <= 50 THEN pos END) ELSE 0.0 END AS s_50 FROM kn GROUP BY entity)
SELECT s.entity, s.i, sl.ls + sl.s_all * (s.pos - sl.lp) AS ext_all, sl.ls + sl.s_50 * (s.pos - sl.lp) AS ext_50
FROM seq AS s JOIN sl ON s.entity = sl.entity WHERE NOT s.known""")
def q_linear_extrapolate(spark, sf):
    s = _seq(spark, sf)
    every = R.group_slope(s.filter("known"), "entity", "pos", "sig", "s_all")
    last50 = A.known_position(s, "entity", "i", F.col("known"), desc=True, n_known="nkn").filter(F.col("_j") < 50)
    sl = every.join(R.group_slope(last50, "entity", "pos", "sig", "s_50"), "entity").join(_boundary(s), "entity")
    e = s.filter("NOT known").join(sl, "entity")
    base = F.col("last_sig")
    dpos = F.col("pos") - F.col("last_pos")
    return e.select("entity", "i", (base + F.col("s_all") * dpos).alias("ext_all"), (base + F.col("s_50") * dpos).alias("ext_50"))


TENSOR = ("sig", "k", "sig_gap", "pos", "prior")
_FRAME = "PARTITION BY entity ORDER BY i ROWS BETWEEN 20 PRECEDING AND 20 FOLLOWING"
_ALL = "PARTITION BY entity ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"


@register("window_tensor", dbl=[f"cs_{c}" for c in TENSOR], digits=3, sql="""
WITH w AS (SELECT entity, i, n, """ + ",\n".join(
    f"list({c}) OVER ({_FRAME}) AS w_{c}, first_value({c}) OVER ({_ALL}) AS f_{c}, last_value({c}) OVER ({_ALL}) AS l_{c}" for c in TENSOR) + """ FROM seq),
p AS (SELECT entity, i, """ + ",\n".join(
    f"list_concat(list_transform(range(greatest(20 - i, 0)), lambda z: f_{c}), w_{c}, list_transform(range(greatest(i + 20 - (n - 1), 0)), lambda z: l_{c})) AS t_{c}"
    for c in TENSOR) + """ FROM w)
SELECT entity, i, CAST(len(t_sig) AS INTEGER) AS width, """ + ",\n".join(
    f"list_sum(list_transform(t_{c}, lambda x, j: coalesce(x, 0.0) * j)) AS cs_{c}" for c in TENSOR) + " FROM p")
def q_window_tensor(spark, sf):
    s = _seq(spark, sf).select("entity", "i", "n", *TENSOR)
    t = Q.window_tensor(s, "entity", "i", "n", TENSOR, 20)

    def checksum(a):
        weighted = F.zip_with(a, F.sequence(F.lit(1), F.size(a)), lambda x, j: F.coalesce(x, F.lit(0.0)) * j)
        return F.aggregate(weighted, F.lit(0.0), lambda acc, v: acc + v)
    return t.select("entity", "i", F.size(F.col("tensor")[0]).alias("width"),
                    *[checksum(F.col("tensor")[j]).alias(f"cs_{c}") for j, c in enumerate(TENSOR)])


@register("entity_arrays", dbl=["sig_5", "sig_last"], sql="""
SELECT entity, CAST(0 AS BIGINT) AS chunk, CAST(count(*) AS INTEGER) AS n_items, list(sig ORDER BY i)[6] AS sig_5,
       list(sig ORDER BY i)[-1] AS sig_last FROM seq GROUP BY entity""")
def q_entity_arrays(spark, sf):
    a = Q.entity_arrays(_seq(spark, sf), "entity", "i", ["sig"])
    return a.select("entity", "chunk", F.size("sig").alias("n_items"), F.col("sig")[5].alias("sig_5"),
                    F.element_at("sig", -1).alias("sig_last"))


@register("even_subsample", sql="""
WITH e AS (SELECT DISTINCT entity, n FROM seq),
g AS (SELECT entity, n, least(60, n) AS m, unnest(range(least(60, n))) AS j FROM e),
k AS (SELECT DISTINCT entity, CAST(CASE WHEN j = m - 1 THEN n - 1 ELSE floor(j * (CAST(n - 1 AS DOUBLE) / CAST(greatest(m - 1, 1) AS DOUBLE))) END AS BIGINT) AS i FROM g)
SELECT s.entity, s.i FROM seq AS s JOIN k ON s.entity = k.entity AND s.i = k.i""")
def q_even_subsample(spark, sf):
    s = _seq(spark, sf).select("entity", "i", "n")
    return Q.even_subsample(s, "entity", "i", "n", 60).select("entity", "i")


@register("running_share", stored=True, dbl=["rmse", "entity_share", "sq_err_share"], sql=f"""
WITH {OLS_SQL},
per AS (SELECT entity, sqrt(avg((sig - pred) * (sig - pred))) AS rmse FROM pr GROUP BY entity)
SELECT entity, rmse, row_number() OVER (ORDER BY rmse DESC, entity) AS rank,
       row_number() OVER (ORDER BY rmse DESC, entity) / count(*) OVER () AS entity_share,
       sum(rmse * rmse) OVER (ORDER BY rmse DESC, entity ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(rmse * rmse) OVER () AS sq_err_share
FROM per""")
def q_running_share(spark, sf):
    per = M.entity_rmse(prior_predictions(spark, sf), "entity", "sig", "pred").select("entity", "rmse")
    return M.running_share(per, "entity", "rmse")


@register("last_value_baseline", dbl=["rmse"], sql="""
WITH b AS (SELECT entity, arg_max(sig, i) AS ls FROM seq WHERE known GROUP BY entity)
SELECT s.entity, sqrt(avg((s.sig - b.ls) * (s.sig - b.ls))) AS rmse, count(*) AS n_rows
FROM seq AS s JOIN b ON s.entity = b.entity WHERE NOT s.known GROUP BY s.entity""")
def q_last_value_baseline(spark, sf):
    s = _seq(spark, sf)
    e = s.filter("NOT known").join(_boundary(s).select("entity", "last_sig"), "entity")
    return M.entity_rmse(e, "entity", "sig", "last_sig")

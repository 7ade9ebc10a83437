"""Group statistics attached to rows, fills, per-entity sequence statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratum.operators import aggregates as A
from stratum.operators import metrics as M
from stratum.operators import regression as R
from stratum.operators import tabular as T
from stratum.plans import views
from stratum.plans.registry import register
from stratum.sources.tables import load


@register("group_count_broadcast", sql="""
SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_orderkey) AS grp_size FROM lineitem""")
def q_group_count_broadcast(spark, sf):
    li = load(spark, sf, "lineitem", ["l_orderkey", "l_linenumber"])
    return T.group_count(li, "l_orderkey", "grp_size")


@register("share_per_member", dbl=["per_member"], sql="""
SELECT o_orderkey, o_totalprice / greatest(count(*) OVER (PARTITION BY o_custkey), 1) AS per_member FROM orders""")
def q_share_per_member(spark, sf):
    o = load(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_totalprice"])
    o = T.group_count(o, "o_custkey", "_size")
    return T.share_per_member(o, "o_totalprice", "_size", "per_member").select("o_orderkey", "per_member")


@register("group_median_fill", dbl=["balance"], sql="""
WITH c AS (SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS bal FROM customer)
SELECT c_custkey, coalesce(bal, median(bal) OVER (PARTITION BY c_mktsegment)) AS balance FROM c""")
def q_group_median_fill(spark, sf):
    c = load(spark, sf, "customer", ["c_custkey", "c_mktsegment", "c_acctbal"])
    c = c.withColumn("balance", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))
    return T.group_median_fill(c, "c_mktsegment", "balance").select("c_custkey", "balance")


def _docs_with_gaps(spark, sf):
    d = views.docs(spark, sf)
    return (d.withColumn("n_chars", F.when(F.col("doc_id") % 7 != 0, F.col("n_chars")))
            .withColumn("lang", F.when(F.col("doc_id") % 5 != 0, F.col("lang"))))


DOCS_GAPS_SQL = """
dg AS (SELECT doc_id, source, is_train, quality,
              CASE WHEN doc_id % 7 <> 0 THEN n_chars END AS n_chars,
              CASE WHEN doc_id % 5 <> 0 THEN lang END AS lang FROM docs)"""


@register("train_median_fill", dbl=["n_chars"], sql=f"""
WITH {DOCS_GAPS_SQL},
g AS (SELECT source, median(n_chars) AS gm FROM dg WHERE is_train GROUP BY source),
a AS (SELECT median(n_chars) AS am FROM dg WHERE is_train)
SELECT dg.doc_id, coalesce(dg.n_chars, g.gm, a.am) AS n_chars FROM dg LEFT JOIN g ON dg.source = g.source CROSS JOIN a""")
def q_train_median_fill(spark, sf):
    d = _docs_with_gaps(spark, sf)
    return T.train_median_fill(d, "source", "n_chars", "is_train").select("doc_id", "n_chars")


@register("mode_fill", sql="""
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS pr FROM orders),
m AS (SELECT pr FROM o WHERE pr IS NOT NULL GROUP BY pr ORDER BY count(*) DESC, pr ASC LIMIT 1)
SELECT o_orderkey, coalesce(o.pr, m.pr) AS priority FROM o CROSS JOIN m""")
def q_mode_fill(spark, sf):
    o = load(spark, sf, "orders", ["o_orderkey", "o_orderstatus", "o_orderpriority"])
    o = o.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("priority"))
    return T.mode_fill(o, "priority")


@register("simple_impute", dbl=["n_chars"], sql=f"""
WITH {DOCS_GAPS_SQL},
fn AS (SELECT median(n_chars) AS m FROM dg WHERE is_train),
fl AS (SELECT lang FROM dg WHERE is_train AND lang IS NOT NULL GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1)
SELECT dg.doc_id, coalesce(dg.n_chars, fn.m) AS n_chars, coalesce(dg.lang, fl.lang) AS lang
FROM dg CROSS JOIN fn CROSS JOIN fl WHERE NOT dg.is_train""")
def q_simple_impute(spark, sf):
    d = _docs_with_gaps(spark, sf).select("doc_id", "n_chars", "lang", "is_train")
    tr, te = d.filter("is_train"), d.filter("NOT is_train")
    return T.simple_impute(tr, te, ["n_chars"], ["lang"]).select("doc_id", "n_chars", "lang")


@register("value_counts", dbl=["share"], sql="""
SELECT event_type, count(*) AS count, count(*) / (SELECT count(*) FROM events) AS share FROM events GROUP BY event_type""")
def q_value_counts(spark, sf):
    return T.value_counts(load(spark, sf, "events", ["event_type"]), "event_type")


@register("group_stat_table", dbl=["max", "mean"], sql="""
SELECT event_type, max(value) AS max, avg(value) AS mean, count(value) AS count FROM events GROUP BY event_type""")
def q_group_stat_table(spark, sf):
    return T.group_stat_table(load(spark, sf, "events", ["event_type", "value"]), "event_type", "value")


@register("entity_summary", dbl=["min_sig", "max_sig", "span_sig", "std_sig", "min_pos", "max_pos", "span_pos", "std_pos"],
          sql="""
SELECT entity, count(*) AS n, min(sig) AS min_sig, max(sig) AS max_sig, max(sig) - min(sig) AS span_sig,
       stddev_pop(sig) AS std_sig, min(pos) AS min_pos, max(pos) AS max_pos, max(pos) - min(pos) AS span_pos,
       stddev_pop(pos) AS std_pos
FROM seq GROUP BY entity""")
def q_entity_summary(spark, sf):
    return A.entity_summary(views.seq(spark, sf), "entity", ["sig", "pos"])


@register("boundary_row", dbl=["last_pos", "last_k", "last_sig"], sql="""
SELECT entity, i AS last_i, pos AS last_pos, k AS last_k, sig AS last_sig FROM (
  SELECT *, row_number() OVER (PARTITION BY entity ORDER BY i DESC) AS r FROM seq WHERE known) AS t WHERE r = 1""")
def q_boundary_row(spark, sf):
    return A.boundary_row(views.seq(spark, sf), "entity", "i", ["pos", "k", "sig"], F.col("known"))


@register("tail_rate", dbl=["tail_rate"], sql="""
WITH t AS (SELECT entity, i, sig, k, pos, row_number() OVER (PARTITION BY entity ORDER BY i DESC) AS r FROM seq WHERE known),
d AS (SELECT entity, sig - lag(sig) OVER w AS dy, k - lag(k) OVER w AS dz, pos - lag(pos) OVER w AS dm
      FROM t WHERE r <= 30 WINDOW w AS (PARTITION BY entity ORDER BY i))
SELECT entity, CASE WHEN count(CASE WHEN dm > 0 THEN 1 END) >= 3
                    THEN median(CASE WHEN dm > 0 THEN (dy + dz) / dm END) ELSE 0.0 END AS tail_rate
FROM d GROUP BY entity""")
def q_tail_rate(spark, sf):
    return A.tail_rate(views.seq(spark, sf), "entity", "i", F.col("known"), "sig", "k", "pos", n_known="nkn")


@register("group_slope", dbl=["slope_all", "slope_50"], sql="""
WITH kn AS (SELECT entity, pos, sig, row_number() OVER (PARTITION BY entity ORDER BY i DESC) AS r FROM seq WHERE known)
SELECT entity,
  CASE WHEN count(*) >= 2 AND stddev_pop(pos) >= 1e-6 THEN regr_slope(sig, pos) ELSE 0.0 END AS slope_all,
  CASE WHEN count(CASE WHEN r <= 50 THEN 1 END) >= 2 AND stddev_pop(CASE WHEN r <= 50 THEN pos END) >= 1e-6
       THEN regr_slope(CASE WHEN r <= 50 THEN sig END, CASE WHEN r <= 50 THEN pos END) ELSE 0.0 END AS slope_50
FROM kn GROUP BY entity""")
def q_group_slope(spark, sf):
    s = views.seq(spark, sf)
    every = R.group_slope(s.filter("known"), "entity", "pos", "sig", "slope_all")
    last50 = A.known_position(s, "entity", "i", F.col("known"), desc=True, n_known="nkn").filter(F.col("_j") < 50)
    return every.join(R.group_slope(last50, "entity", "pos", "sig", "slope_50"), "entity")


@register("group_velocity_ols", dbl=["beta", "icpt", "zsig"], sql="""
WITH d AS (SELECT entity, sig - lag(sig) OVER w AS dy, k - lag(k) OVER w AS dz, pos - lag(pos) OVER w AS dm
           FROM seq WHERE known WINDOW w AS (PARTITION BY entity ORDER BY i)),
v AS (SELECT entity, dz / dm AS vz, dy / dm AS vt FROM d WHERE dm > 0),
g AS (SELECT entity, count(*) AS n, avg(vz) AS mz, avg(vt) AS mt, var_pop(vz) AS vzz,
             covar_pop(vz, vt) AS czt, var_pop(vt) AS vtt FROM v GROUP BY entity),
b AS (SELECT *, CASE WHEN vzz > 0 THEN czt / vzz ELSE 0.0 END AS beta0 FROM g)
SELECT entity, CASE WHEN n >= 10 THEN beta0 ELSE -1.0 END AS beta,
       CASE WHEN n >= 10 THEN mt - beta0 * mz ELSE 0.0 END AS icpt,
       CASE WHEN n >= 10 THEN greatest(sqrt(greatest(vtt - beta0 * czt, 0.0)), 0.001) ELSE 0.1 END AS zsig
FROM b""")
def q_group_velocity_ols(spark, sf):
    return A.group_velocity_ols(views.seq(spark, sf), "entity", "i", F.col("known"), "sig", "k", "pos", n_known="nkn")


SEGMENT_SQL = """
kn AS (SELECT entity, sig + k - prior AS b, row_number() OVER (PARTITION BY entity ORDER BY i) - 1 AS j,
              count(*) OVER (PARTITION BY entity) AS n FROM seq WHERE known),
g AS (SELECT entity, any_value(n) AS n, median(b) AS b_full,
             median(CASE WHEN j >= greatest(n - 50, 0) THEN b END) AS late,
             median(CASE WHEN j < greatest(n // 3, 1) THEN b END) AS early,
             median(CASE WHEN j >= n // 3 AND j < greatest(n // 3 + 1, (n * 2) // 3) THEN b END) AS mid,
             sum(exp(0.02 * j) * b) / sum(exp(0.02 * j)) AS b_wls FROM kn GROUP BY entity),
so AS (SELECT entity, b_full, CASE WHEN n // 3 > 0 THEN early ELSE b_full END AS b_early,
              CASE WHEN (n * 2) // 3 > n // 3 THEN mid ELSE b_full END AS b_mid,
              CASE WHEN n >= 5 THEN late ELSE b_full END AS b_late, b_wls FROM g)"""


@register("segment_offsets", dbl=["b_full", "b_early", "b_mid", "b_late", "b_wls"],
          sql=f"WITH {SEGMENT_SQL} SELECT * FROM so")
def q_segment_offsets(spark, sf):
    return A.segment_offsets(views.seq(spark, sf), "entity", "i", F.col("known"), "sig", "k", "prior", n_known="nkn")


@register("candidate_path_offset", dbl=["path", "path_rmse", "path_bias"], sql=f"""
WITH {SEGMENT_SQL},
p AS (SELECT s.entity, s.i, s.known, s.sig, -s.k + s.prior + so.b_full AS path FROM seq AS s JOIN so ON s.entity = so.entity),
st AS (SELECT entity, sqrt(avg(CASE WHEN known THEN (sig - path) * (sig - path) END)) AS path_rmse,
              avg(CASE WHEN known THEN sig - path END) AS path_bias FROM p GROUP BY entity)
SELECT p.entity, p.i, p.path, st.path_rmse, st.path_bias FROM p JOIN st ON p.entity = st.entity""")
def q_candidate_path_offset(spark, sf):
    r = A.candidate_path_offset(views.seq(spark, sf), "entity", "i", F.col("known"), "sig", "k", "prior", n_known="nkn")
    return r.select("entity", "i", "path", "path_rmse", "path_bias")


@register("consensus_stats", dbl=["cons_mean", "cons_std", "cons_median", "cons_range"], sql="""
WITH a AS (SELECT vec_id, [s1, s2, s3, s4, s5, s6] AS v FROM pts)
SELECT vec_id, list_avg(v) AS cons_mean,
       sqrt(list_sum(list_transform(v, lambda x: (x - list_avg(v)) * (x - list_avg(v)))) / 6) AS cons_std,
       list_median(v) AS cons_median, list_max(v) - list_min(v) AS cons_range FROM a""")
def q_consensus_stats(spark, sf):
    p = views.pts(spark, sf)
    return A.consensus_stats(p, ["s1", "s2", "s3", "s4", "s5", "s6"]).select(
        "vec_id", "cons_mean", "cons_std", "cons_median", "cons_range")


@register("contact_offset_reconstruct", dbl=["recon"], sql="""
WITH t AS (SELECT * FROM tmpl WHERE lab IS NOT NULL),
r AS (SELECT tid, min(CASE WHEN lab = 'PROMO' THEN x END) AS rx, arg_min(lab, x) AS first_lab FROM t GROUP BY tid),
f AS (SELECT t.tid, min(t.x) AS fx FROM t JOIN r ON t.tid = r.tid AND t.lab = r.first_lab GROUP BY t.tid),
ref AS (SELECT r.tid, coalesce(r.rx, f.fx) AS ref_x FROM r LEFT JOIN f ON r.tid = f.tid),
j AS (SELECT s.entity, s.i, s.known, s.sig, ref.ref_x - (s.k - s.prior) AS base FROM seq AS s JOIN ref ON s.tid = ref.tid),
o AS (SELECT entity, avg(sig - base) AS off FROM j WHERE known GROUP BY entity)
SELECT j.entity, j.i, j.base + o.off AS recon FROM j LEFT JOIN o ON j.entity = o.entity""")
def q_contact_offset_reconstruct(spark, sf):
    r = A.contact_offset_reconstruct(views.seq(spark, sf), views.tmpl(spark, sf), "entity", "tid", "sig", "k",
                                     "prior", F.col("known"), "PROMO")
    return r.select("entity", "i", "recon")


def _candidates(spark, sf):
    o = load(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_totalprice"])
    return o.select("o_custkey", (-F.abs(F.col("o_totalprice") - 250000.0) / 50000.0).alias("score"),
                    (F.col("o_totalprice") / 1000.0).alias("pred"))


CAND_SQL = """cand AS (SELECT o_custkey, -abs(o_totalprice - 250000.0) / 50000.0 AS score, o_totalprice / 1000.0 AS pred FROM orders)"""


@register("likelihood_weighted_mean", stored=True, dbl=["w_scale_3", "w_scale_5", "w_scale_8", "w_scale_12", "w_mean"], sql=f"""
WITH {CAND_SQL},
j AS (SELECT o_custkey, pred, score - max(score) OVER (PARTITION BY o_custkey) AS ln FROM cand)
SELECT o_custkey,
  sum(exp(ln / 3.0) * pred) / sum(exp(ln / 3.0)) AS w_scale_3, sum(exp(ln / 5.0) * pred) / sum(exp(ln / 5.0)) AS w_scale_5,
  sum(exp(ln / 8.0) * pred) / sum(exp(ln / 8.0)) AS w_scale_8, sum(exp(ln / 12.0) * pred) / sum(exp(ln / 12.0)) AS w_scale_12,
  avg(pred) AS w_mean FROM j GROUP BY o_custkey""")
def q_likelihood_weighted_mean(spark, sf):
    return A.likelihood_weighted_mean(_candidates(spark, sf), "o_custkey", "score", "pred")


@register("ensemble_quality", stored=True, dbl=["best_per_n", "score_spread", "pred_std"], sql=f"""
WITH {CAND_SQL}
SELECT o_custkey, max(score) / count(*) AS best_per_n, stddev_pop(score) AS score_spread, stddev_pop(pred) AS pred_std
FROM cand GROUP BY o_custkey""")
def q_ensemble_quality(spark, sf):
    return A.ensemble_quality(_candidates(spark, sf), "o_custkey", "score", "pred")


@register("score_weighted_blend", stored=True, dbl=["blend"], sql="""
SELECT vec_id, (s1 * exp(3.0 * s4) + s2 * exp(3.0 * s5) + s3 * exp(3.0 * s6))
               / (exp(3.0 * s4) + exp(3.0 * s5) + exp(3.0 * s6) + 1e-9) AS blend FROM pts""")
def q_score_weighted_blend(spark, sf):
    p = views.pts(spark, sf)
    return A.score_weighted_blend(p, ["s1", "s2", "s3"], ["s4", "s5", "s6"]).select("vec_id", "blend")


@register("accuracy", dbl=["accuracy"], sql="""
SELECT avg(CAST(quality = CAST(n_chars > 2000 AS INTEGER) AS DOUBLE)) AS accuracy, count(*) AS n_rows
FROM docs WHERE is_train""")
def q_accuracy(spark, sf):
    d = views.docs(spark, sf).filter("is_train").withColumn("p", (F.col("n_chars") > 2000).cast("int"))
    return M.accuracy(d, "quality", "p")


@register("distinct_profile", sql="""
SELECT * FROM (VALUES ('c_custkey', (SELECT count(DISTINCT c_custkey) FROM customer)),
                      ('c_name', (SELECT count(DISTINCT c_name) FROM customer)),
                      ('c_nationkey', (SELECT count(DISTINCT c_nationkey) FROM customer)),
                      ('c_acctbal', (SELECT count(DISTINCT c_acctbal) FROM customer)),
                      ('c_mktsegment', (SELECT count(DISTINCT c_mktsegment) FROM customer))) AS t(column_name, n_unique)""")
def q_distinct_profile(spark, sf):
    from stratum.operators.profile import distinct_profile
    return distinct_profile(load(spark, sf, "customer"))

"""Ensembling and post-processing over the baseline predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratum.functions import scalar as S
from stratum.operators import blending as B
from stratum.operators import splits as SP
from stratum.operators import tabular as T
from stratum.operators.aggregates import boundary_row
from stratum.plans import views
from stratum.plans.catalog.baseline import OLS_SQL
from stratum.plans.registry import register
from stratum.sources.tables import load


def eval_frame(spark, sf):
    """Eval rows with the linear-prior prediction and the boundary (last known) row."""
    from stratum.operators import regression
    s = views.seq(spark, sf)
    ols = regression.group_ols_2(s, "entity", "pos", "k", "y_in", "known", "pred")
    b = boundary_row(s, "entity", "i", ["pos", "k", "sig"], F.col("known"))
    return ols.join(b, "entity").withColumn("nk", F.col("nkn"))


EVAL_SQL = OLS_SQL + """,
lk AS (SELECT entity, arg_max(pos, i) AS last_pos, arg_max(k, i) AS last_k, arg_max(sig, i) AS last_sig, count(*) AS nk
       FROM seq WHERE known GROUP BY entity),
ef AS (SELECT s.entity, s.i, s.pos, s.k, s.sig, s.prior, pr.pred, lk.last_pos, lk.last_k, lk.last_sig, lk.nk
       FROM seq AS s JOIN pr ON s.entity = pr.entity AND s.i = pr.i JOIN lk ON s.entity = lk.entity)"""


@register("linear_blend", stored=True, dbl=["blend"], sql=f"WITH {EVAL_SQL} SELECT entity, i, 0.3 * pred + 0.7 * last_sig AS blend FROM ef")
def q_linear_blend(spark, sf):
    return B.linear_blend(eval_frame(spark, sf), ["pred", "last_sig"], [0.3, 0.7], "blend").select("entity", "i", "blend")


@register("hold_mix", stored=True, dbl=["mixed"], sql=f"""
WITH {EVAL_SQL},
g AS (SELECT entity, CAST(sum(CAST(NOT known AS BIGINT)) AS DOUBLE) AS n_eval,
             coalesce(max(CASE WHEN NOT known THEN k END) - min(CASE WHEN NOT known THEN k END), 0.0) AS z_span FROM seq GROUP BY entity),
c AS (SELECT entity, CAST(n_eval > 20 AS BIGINT) + 2 * (CAST(z_span >= 80.0 AS BIGINT) + CAST(z_span >= 95.0 AS BIGINT)) AS code FROM g),
v AS (SELECT entity, string_split(CASE code WHEN 0 THEN 'pf_scale_5_hold_0.2' WHEN 1 THEN 'pf_scale_3_hold_0.15'
                 WHEN 2 THEN 'pf_scale_12_beam_0.2_hold_0.15' WHEN 3 THEN 'pf_scale_5_hold_0.15'
                 WHEN 4 THEN 'pf_scale_5_beam_0.05_hold_0.05' WHEN 5 THEN 'pf_scale_12_beam_0.2_hold_0.05'
                 ELSE 'pf_scale_8_hold_0.2' END, '_') AS parts FROM c),
p AS (SELECT entity,
  CASE WHEN list_position(parts, 'beam') > 0 THEN coalesce(TRY_CAST(parts[list_position(parts, 'beam') + 1] AS DOUBLE), 0.0) ELSE 0.0 END AS bw,
  CASE WHEN list_position(parts, 'hold') > 0 THEN coalesce(TRY_CAST(parts[list_position(parts, 'hold') + 1] AS DOUBLE), 0.0) ELSE 0.0 END AS hw FROM v)
SELECT ef.entity, ef.i, (1.0 - p.hw) * ((1.0 - p.bw) * ef.prior + p.bw * ef.pred) + p.hw * ef.last_sig AS mixed
FROM ef JOIN p ON ef.entity = p.entity""")
def q_hold_mix(spark, sf):
    s = views.seq(spark, sf)
    var = T.bin_code_variant(s, "entity", ~F.col("known"), "k", 20, (80.0, 95.0)).select(
        "entity", S.parse_spec_field("variant", "beam").alias("bw"), S.parse_spec_field("variant", "hold").alias("hw"))
    e = eval_frame(spark, sf).join(var, "entity")
    return B.hold_mix(e, "prior", "pred", "last_sig", F.col("bw"), F.col("hw"), "mixed").select("entity", "i", "mixed")


@register("warmup_damp", stored=True, dbl=["damped"], sql=f"""
WITH {EVAL_SQL} SELECT entity, i, last_sig + (pred - last_sig) * (1.0 - exp(-greatest(pos - last_pos, 0.0) / 85.0)) AS damped FROM ef""")
def q_warmup_damp(spark, sf):
    e = eval_frame(spark, sf).withColumn("_delta", F.col("pred") - F.col("last_sig")).withColumn("_d", F.col("pos") - F.col("last_pos"))
    e = B.warmup_damp(e, "_delta", "_d", 85.0, "_damp")
    return e.select("entity", "i", (F.col("last_sig") + F.col("_damp")).alias("damped"))


@register("trust_hybrid", stored=True, dbl=["hybrid"], sql=f"""
WITH {EVAL_SQL} SELECT entity, i, (1.0 - least(greatest(nk / 200.0, 0.0), 0.6)) * prior + least(greatest(nk / 200.0, 0.0), 0.6) * last_sig AS hybrid FROM ef""")
def q_trust_hybrid(spark, sf):
    return B.trust_hybrid(eval_frame(spark, sf), "prior", "last_sig", "nk", "hybrid").select("entity", "i", "hybrid")


@register("signal_disagreement", stored=True, dbl=["pred_vs_last_sig", "pred_vs_prior", "last_sig_vs_prior"], sql=f"""
WITH {EVAL_SQL} SELECT entity, i, pred - last_sig AS pred_vs_last_sig, pred - prior AS pred_vs_prior, last_sig - prior AS last_sig_vs_prior FROM ef""")
def q_signal_disagreement(spark, sf):
    e = B.signal_disagreement(eval_frame(spark, sf), ["pred", "last_sig", "prior"])
    return e.select("entity", "i", "pred_vs_last_sig", "pred_vs_prior", "last_sig_vs_prior")


def _savgol_sql(window=17):
    """The least-squares cubic of every window from its moments: on centred positions t the even
    and odd coefficients separate into two 2 x 2 systems."""
    return f"""
WITH {EVAL_SQL},
e AS (SELECT entity, i, pred, row_number() OVER (PARTITION BY entity ORDER BY i) - 1 AS e, count(*) OVER (PARTITION BY entity) AS ne FROM ef),
w AS (SELECT *, CASE WHEN least({window}, ne) % 2 = 0 THEN least({window}, ne) - 1 ELSE least({window}, ne) END AS wl FROM e),
st AS (SELECT *, least(greatest(e - (wl - 1) // 2, 0), ne - wl) AS s0 FROM w),
pt AS (SELECT a.entity, a.i, a.wl, a.pred, a.e - a.s0 - (a.wl - 1) / 2.0 AS t0, b.e - a.s0 - (a.wl - 1) / 2.0 AS t, b.pred AS y
       FROM st AS a JOIN e AS b ON b.entity = a.entity AND b.e BETWEEN a.s0 AND a.s0 + a.wl - 1),
mo AS (SELECT entity, i, any_value(wl) AS wl, any_value(pred) AS pred, any_value(t0) AS t0, CAST(count(*) AS DOUBLE) AS c0, sum(t * t) AS c2,
              sum(power(t, 4)) AS c4, sum(power(t, 6)) AS c6, sum(y) AS m0, sum(t * y) AS m1, sum(t * t * y) AS m2, sum(t * t * t * y) AS m3
       FROM pt GROUP BY entity, i)
SELECT entity, i, CASE WHEN wl < 5 THEN pred ELSE
         (c4 * m0 - c2 * m2) / (c0 * c4 - c2 * c2) + (c0 * m2 - c2 * m0) / (c0 * c4 - c2 * c2) * t0 * t0
         + (c6 * m1 - c4 * m3) / (c2 * c6 - c4 * c4) * t0 + (c2 * m3 - c4 * m1) / (c2 * c6 - c4 * c4) * power(t0, 3) END AS smooth
FROM mo"""


@register("savgol_smooth", stored=True, dbl=["smooth"], sql=_savgol_sql())
def q_savgol_smooth(spark, sf):
    e = eval_frame(spark, sf).select("entity", "i", "pred", (F.col("i") - F.col("nkn")).alias("e"),
                                     (F.col("n") - F.col("nkn")).alias("ne"))
    return B.savgol_smooth(e, "entity", "e", "ne", "pred", "smooth", 17, 3).select("entity", "i", "smooth")


def _projection_input(spark, sf):
    s = views.seq(spark, sf)
    end = s.groupBy("entity").agg(F.max("pos").alias("end_pos"))
    e = eval_frame(spark, sf).join(end, "entity")
    anchor = F.col("last_sig") + F.col("last_k")
    e = e.withColumn("s", (F.col("pos") - F.col("last_pos")) / F.greatest(F.col("end_pos") - F.col("last_pos"), F.lit(1e-6)))
    return e.withColumn("u", F.col("pred") + F.col("k") - anchor).withColumn("anchor", anchor)


def _projected(spark, sf, deg):
    e = _projection_input(spark, sf).select("entity", "i", "s", "u", "anchor", "k", "pred", "nk")
    r = B.robust_poly_project(e, "entity", "s", "u", "u_fit", deg=deg, rounds=4, raw_share=0.0,
                              eligible=F.col("nk") >= 5)
    return r.select("entity", "i", (F.lit(0.25) * F.col("pred") + F.lit(0.75) * (F.col("anchor") + F.col("u_fit") - F.col("k"))).alias("projected"))


def _irls_sql():
    parts = ["p0 AS (SELECT entity, i, s, u, 1.0 AS w FROM pin)"]
    prev = "p0"
    for rnd in range(5):
        parts.append(f"""f{rnd} AS (SELECT entity, sum(w) AS s0, sum(w * s) AS s1, sum(w * s * s) AS s2, sum(w * u) AS t0, sum(w * s * u) AS t1 FROM {prev} GROUP BY entity),
c{rnd} AS (SELECT entity, (s0 * t1 - s1 * t0) / (s0 * s2 - s1 * s1) AS c1, t0, s1, s0 FROM f{rnd}),
d{rnd} AS (SELECT entity, (t0 - c1 * s1) / s0 AS c0, c1 FROM c{rnd}),
r{rnd} AS (SELECT p.entity, p.i, p.s, p.u, p.u - (d.c0 + d.c1 * p.s) AS res, d.c0 + d.c1 * p.s AS fit FROM pin AS p JOIN d{rnd} AS d ON p.entity = d.entity)""")
        if rnd < 4:
            parts.append(f"""m{rnd} AS (SELECT entity, median(abs(res)) * 1.4826 + 1e-6 AS sc FROM r{rnd} GROUP BY entity),
q{rnd + 1} AS (SELECT r.entity, r.i, r.s, r.u, power(1.0 / (1.0 + power(r.res / (2.0 * m.sc), 2)), 2) AS w FROM r{rnd} AS r JOIN m{rnd} AS m ON r.entity = m.entity)""")
            prev = f"q{rnd + 1}"
    return ",\n".join(parts)


@register("robust_poly_project", stored=True, dbl=["projected"])
def q_robust_poly_project(spark, sf):
    return _projected(spark, sf, 4)


@register("robust_poly_project_linear", stored=True, dbl=["projected"], sql=f"""
WITH {EVAL_SQL},
en AS (SELECT entity, max(pos) AS end_pos FROM seq GROUP BY entity),
pin0 AS (SELECT ef.*, (ef.pos - ef.last_pos) / greatest(en.end_pos - ef.last_pos, 1e-6) AS s, ef.pred + ef.k - (ef.last_sig + ef.last_k) AS u,
                ef.last_sig + ef.last_k AS anchor FROM ef JOIN en ON ef.entity = en.entity),
cnt AS (SELECT entity, count(*) AS n FROM pin0 GROUP BY entity),
pin AS (SELECT pin0.* FROM pin0 JOIN cnt ON pin0.entity = cnt.entity WHERE cnt.n >= 3 AND pin0.nk >= 5),
{_irls_sql()}
SELECT p.entity, p.i, 0.25 * p.pred + 0.75 * (p.anchor + coalesce(r4.fit, p.u) - p.k) AS projected
FROM pin0 AS p LEFT JOIN r4 ON p.entity = r4.entity AND p.i = r4.i""")
def q_robust_poly_project_linear(spark, sf):
    return _projected(spark, sf, 1)


# ---- Gram-based weight fitting (rows-only: small driver-side solves) -------------------------------

def _li_signals(spark, sf):
    li = load(spark, sf, "lineitem", ["l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return li.select("l_suppkey", (F.col("l_quantity") * 950.0).alias("s_qty"),
                     (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("s_disc"),
                     (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("s_tax"),
                     F.col("l_extendedprice").alias("y"))


SIGNALS = ["s_qty", "s_disc", "s_tax"]


LI_SQL = """li AS (SELECT l_suppkey, l_quantity * 950.0 AS s1, l_extendedprice * (1 - l_discount) AS s2, l_extendedprice * (1 + l_tax) AS s3,
                  l_extendedprice AS y FROM lineitem)"""
GRAM_SQL = ", ".join(f"sum(s{i} * s{j}) AS g{i}{j}" for i in (1, 2, 3) for j in (1, 2, 3) if i <= j) + ", " + ", ".join(
    f"sum(s{i} * y) AS b{i}" for i in (1, 2, 3))
CENTRED_SQL = ", ".join(f"count(*) * covar_pop(s{i}, s{j}) AS g{i}{j}" for i in (1, 2, 3) for j in (1, 2, 3) if i <= j) + ", " + ", ".join(
    f"count(*) * covar_pop(s{i}, y) AS b{i}" for i in (1, 2, 3))


def _g(i: int, j: int) -> str:
    return f"g{min(i, j)}{max(i, j)}"


def _solved(used: tuple[int, ...]) -> list[str]:
    """Cramer's rule for the normal equations of some of the three signals; the others have weight 0."""
    def det(m: list[list[str]]) -> str:
        if len(m) == 1:
            return m[0][0]
        return "(" + " ".join(f"{'+' if c % 2 == 0 else '-'} {m[0][c]} * {det([r[:c] + r[c + 1:] for r in m[1:]])}" for c in range(len(m))) + ")"
    rows = [[_g(i, j) for j in used] for i in used]
    return [f"{det([r[:used.index(k)] + [f'b{i}'] + r[used.index(k) + 1:] for r, i in zip(rows, used)])} / {det(rows)}" if k in used else "0.0"
            for k in (1, 2, 3)]


def nonnegative_sql(src: str, keys: str = "") -> str:
    """Least squares with weights of at least zero, by trying every subset of the signals: the best one that has no negative weight."""
    lead = f"{keys}, " if keys else ""
    subsets = [tuple(k for k in (1, 2, 3) if m >> (k - 1) & 1) for m in range(8)]
    tried = " UNION ALL ".join(f"SELECT {src}.*, {w[0]} AS w1, {w[1]} AS w2, {w[2]} AS w3 FROM {src}" for w in map(_solved, subsets))
    loss = " + ".join(f"{'' if i == j else '2 * '}w{i} * w{j} * {_g(i, j)}" for i in (1, 2, 3) for j in (1, 2, 3) if i <= j) + "".join(
        f" - 2 * w{i} * b{i}" for i in (1, 2, 3))
    return (f"SELECT {lead}w1, w2, w3 FROM (SELECT *, row_number() OVER ({'PARTITION BY ' + keys if keys else ''} ORDER BY {loss}) AS r "
            f"FROM ({tried}) AS t WHERE w1 >= 0 AND w2 >= 0 AND w3 >= 0) AS u WHERE r = 1")


@register("nnls_blend", dbl=["weight"], sql=f"""
WITH {LI_SQL}, g AS (SELECT {GRAM_SQL} FROM li), w AS ({nonnegative_sql("g")})
""" + " UNION ALL ".join(f"SELECT '{c}' AS signal, w{i} AS weight FROM w" for i, c in enumerate(SIGNALS, 1)))
def q_nnls_blend(spark, sf):
    return B.nnls_blend(_li_signals(spark, sf), SIGNALS, "y")


ALPHA = 1.66
MEANS_SQL = ", ".join(f"avg(s{i}) AS m{i}" for i in (1, 2, 3)) + ", avg(y) AS my, " + ", ".join(f"stddev_pop(s{i}) AS d{i}" for i in (1, 2, 3))


@register("ridge_blend", dbl=["weight"], sql=f"""
WITH {LI_SQL}, c AS (SELECT {CENTRED_SQL}, {MEANS_SQL} FROM li),
z AS (SELECT m1, m2, m3, my, d1, d2, d3, {", ".join(f"{_g(i, j)} / (d{i} * d{j}) {'+ ' + str(ALPHA) if i == j else ''} AS {_g(i, j)}"
                                                     for i in (1, 2, 3) for j in (1, 2, 3) if i <= j)},
             {", ".join(f"b{i} / d{i} AS b{i}" for i in (1, 2, 3))} FROM c),
s AS (SELECT {", ".join(f"{e} / d{i} AS w{i}" for i, e in enumerate(_solved((1, 2, 3)), 1))} FROM z),
p AS (SELECT {", ".join(f"{_g(i, j)} {'+ ' + str(ALPHA) if i == j else ''} AS {_g(i, j)}" for i in (1, 2, 3) for j in (1, 2, 3) if i <= j)}, b1, b2, b3 FROM c),
n AS ({nonnegative_sql("p")}),
forms AS (SELECT 'standardised' AS form, * FROM s UNION ALL SELECT 'non-negative', * FROM n)
""" + " UNION ALL ".join(f"SELECT form, '{x}' AS signal, w{i} AS weight FROM forms" for i, x in enumerate(SIGNALS, 1))
    + " UNION ALL SELECT form, 'intercept', my - m1 * w1 - m2 * w2 - m3 * w3 FROM forms CROSS JOIN c")
def q_ridge_blend(spark, sf):
    li = _li_signals(spark, sf)
    return (B.ridge_blend(li, SIGNALS, "y", alpha=ALPHA).select(F.lit("standardised").alias("form"), "signal", "weight")
            .unionByName(B.ridge_blend(li, SIGNALS, "y", alpha=ALPHA, positive=True).select(F.lit("non-negative").alias("form"), "signal", "weight")))


@register("heldout_blend_rmse", dbl=["fold_rmse", "pooled_rmse"] + [f"w_{c}" for c in SIGNALS] + ["w_icpt"], sql=f"""
WITH {LI_SQL},
gs AS (SELECT l_suppkey AS k, count(*) AS sz FROM li GROUP BY l_suppkey),
gr AS (SELECT k, row_number() OVER (ORDER BY sz DESC, k) - 1 AS r FROM gs),
gf AS (SELECT k, CASE WHEN (r // 5) % 2 = 0 THEN r % 5 ELSE 4 - r % 5 END AS fold FROM gr),
lf AS (SELECT li.*, gf.fold FROM li JOIN gf ON li.l_suppkey = gf.k),
g AS (SELECT f.fold, {GRAM_SQL} FROM lf JOIN (SELECT DISTINCT fold FROM gf) AS f ON lf.fold <> f.fold GROUP BY f.fold),
w AS ({nonnegative_sql("g", "fold")}),
e AS (SELECT lf.fold, sum(power(y - w1 * s1 - w2 * s2 - w3 * s3, 2)) AS sse, count(*) AS n FROM lf JOIN w ON lf.fold = w.fold GROUP BY lf.fold)
SELECT w.fold, {", ".join(f"w{i} AS w_{c}" for i, c in enumerate(SIGNALS, 1))}, CAST(0 AS DOUBLE) AS w_icpt, sqrt(sse / n) AS fold_rmse,
       sqrt(sum(sse) OVER () / sum(n) OVER ()) AS pooled_rmse
FROM w JOIN e ON w.fold = e.fold""")
def q_heldout_blend_rmse(spark, sf):
    li = _li_signals(spark, sf)
    f = SP.group_kfold(li, "l_suppkey", 5).select("l_suppkey", "fold")
    return B.heldout_blend_rmse(li.join(f, "l_suppkey"), SIGNALS, "y", "fold", "nnls")


@register("paired_repeat_test", stored=True, dbl=["mean_diff", "std_diff", "t_stat"], sql=f"""
WITH {EVAL_SQL},
g AS (SELECT DISTINCT user_id FROM events), rp AS (SELECT range AS rep FROM range(10)),
rf AS (SELECT rep, user_id AS entity, (row_number() OVER (PARTITION BY rep ORDER BY md5('42|' || CAST(rep AS VARCHAR) || '|' || CAST(user_id AS VARCHAR))) - 1) % 5 AS fold
       FROM g CROSS JOIN rp),
lg AS (SELECT entity, sig, 'ols' AS model, pred AS p FROM ef UNION ALL SELECT entity, sig, 'last', last_sig FROM ef),
fe AS (SELECT rf.rep, rf.fold, lg.model, sqrt(avg((lg.sig - lg.p) * (lg.sig - lg.p))) AS rmse FROM lg JOIN rf ON lg.entity = rf.entity
       GROUP BY rf.rep, rf.fold, lg.model),
rm AS (SELECT rep, model, avg(rmse) AS score FROM fe GROUP BY rep, model),
d AS (SELECT rep, max(CASE WHEN model = 'ols' THEN score END) - max(CASE WHEN model = 'last' THEN score END) AS d FROM rm GROUP BY rep)
SELECT avg(d) AS mean_diff, stddev_pop(d) AS std_diff, count(*) AS n_repeats, avg(d) / (stddev_pop(d) / sqrt(count(*))) AS t_stat FROM d""")
def q_paired_repeat_test(spark, sf):
    ev = views.eval_predictions(spark, sf).filter(F.col("model").isin("ols", "last"))
    folds = SP.random_group_kfold(views.seq(spark, sf), "entity", 5, 42, repeats=10)
    e = ev.join(folds, "entity")
    d = F.col("sig") - F.col("p")
    fe = e.groupBy("rep", "fold", "model").agg(F.sqrt(F.avg(d * d)).alias("rmse"))
    rm = fe.groupBy("rep", "model").agg(F.avg("rmse").alias("score"))
    return B.paired_repeat_test(rm, "rep", "model", "score", "ols", "last")


# ---- model-output tables -------------------------------------------------------------------------

@register("oof_matrix", stored=True, dbl=["sig", "m_last", "m_mean", "m_ols"], sql=f"""
WITH {EVAL_SQL},
mn AS (SELECT entity, avg(sig) AS mean_sig FROM seq WHERE known GROUP BY entity)
SELECT ef.entity, ef.i, ef.sig, ef.last_sig AS m_last, mn.mean_sig AS m_mean, ef.pred AS m_ols FROM ef JOIN mn ON ef.entity = mn.entity""")
def q_oof_matrix(spark, sf):
    ev = views.eval_predictions(spark, sf)
    p = ev.groupBy("entity", "i", "sig").pivot("model", ["last", "mean", "ols"]).agg(F.first("p"))
    return p.withColumnsRenamed({"last": "m_last", "mean": "m_mean", "ols": "m_ols"})


@register("model_bag", stored=True, dbl=["bagged"], sql=f"""
WITH {EVAL_SQL},
mn AS (SELECT entity, avg(sig) AS mean_sig FROM seq WHERE known GROUP BY entity)
SELECT ef.entity, ef.i, (ef.pred + ef.last_sig + mn.mean_sig) / 3 AS bagged FROM ef JOIN mn ON ef.entity = mn.entity""")
def q_model_bag(spark, sf):
    ev = views.eval_predictions(spark, sf)
    return ev.groupBy("entity", "i").agg(F.avg("p").alias("bagged"))


@register("residual_target", stored=True, dbl=["residual", "restored"], sql=f"""
WITH {EVAL_SQL},
r AS (SELECT entity, i, entity % 5 AS fold, sig - last_sig AS residual, pos - last_pos AS reach, last_sig FROM ef),
m AS (SELECT f.fold, regr_slope(r.residual, r.reach) AS b, regr_intercept(r.residual, r.reach) AS a
      FROM r JOIN (SELECT DISTINCT fold FROM r) AS f ON r.fold <> f.fold GROUP BY f.fold)
SELECT r.entity, r.i, r.residual, r.last_sig + m.a + m.b * r.reach AS restored FROM r LEFT JOIN m USING (fold)""")
def q_residual_target(spark, sf):
    # the target is y - last_known; what is learned of it on the other folds' entities is added back
    e = eval_frame(spark, sf).select("entity", "i", "last_sig", (F.col("entity") % 5).alias("fold"),
                                     (F.col("sig") - F.col("last_sig")).alias("residual"), (F.col("pos") - F.col("last_pos")).alias("reach"))
    return B.learned_residual(e, "fold", "residual", "reach", "last_sig", "restored").select("entity", "i", "residual", "restored")


def _probas(spark, sf):
    d = views.docs(spark, sf).filter("is_train")
    return d.select("doc_id", "quality", F.least(F.col("n_chars") / 5000.0, F.lit(1.0)).alias("p_len"),
                    F.when(F.col("lang") == "en", 0.8).otherwise(0.4).alias("p_lang"),
                    (F.col("toxic") * 0.3 + 0.5).alias("p_tox"))


PROBA_SQL = """pb AS (SELECT doc_id, quality, least(n_chars / 5000.0, 1.0) AS p_len, CASE WHEN lang = 'en' THEN 0.8 ELSE 0.4 END AS p_lang,
                 toxic * 0.3 + 0.5 AS p_tox FROM docs WHERE is_train)"""


@register("voting", stored=True, dbl=["proba"], sql=f"""
WITH {PROBA_SQL} SELECT doc_id, (p_len + p_lang + p_tox) / 3 AS proba, CAST((p_len + p_lang + p_tox) / 3 >= 0.5 AS INTEGER) AS label FROM pb""")
def q_voting(spark, sf):
    p = _probas(spark, sf)
    avg = (F.col("p_len") + F.col("p_lang") + F.col("p_tox")) / 3
    return p.select("doc_id", avg.alias("proba"), (avg >= 0.5).cast("int").alias("label"))


LABEL_METRICS = ("accuracy", "f1", "precision", "recall")


@register("label_vs_probability", stored=True, dbl=["value"], sql=f"""
WITH {PROBA_SQL}, m AS (SELECT * FROM (VALUES ('accuracy'), ('log_loss')) AS t(metric))
SELECT doc_id, metric, CASE WHEN metric IN ('accuracy', 'f1', 'precision', 'recall')
                            THEN CAST((p_len + p_lang + p_tox) / 3 >= 0.5 AS DOUBLE) ELSE (p_len + p_lang + p_tox) / 3 END AS value
FROM pb CROSS JOIN m""")
def q_label_vs_probability(spark, sf):
    p = _probas(spark, sf)
    avg = (F.col("p_len") + F.col("p_lang") + F.col("p_tox")) / 3
    m = spark.createDataFrame([("accuracy",), ("log_loss",)], "metric string")
    x = p.crossJoin(F.broadcast(m))  # two metric names
    return x.select("doc_id", "metric", F.when(F.col("metric").isin(*LABEL_METRICS), (avg >= 0.5).cast("double"))
                    .otherwise(avg).alias("value"))

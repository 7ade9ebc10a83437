"""Range, nearest, as-of, sub-sequence and spatial joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratum.operators import aggregates as A
from stratum.operators import matching as MT
from stratum.operators import sequence as Q
from stratum.operators import spatial as SPT
from stratum.operators.sequence import row_index
from stratum.plans import views
from stratum.plans.registry import register

# The four grids of offsets around an anchor.
LAST_OFFS = [-80, -40, -20, -10, -5, 0, 5, 10, 20, 40, 80]       # around the last known label
BEAM_OFFS = [-40, -20, -10, -5, -3, 0, 3, 5, 10, 20, 40]         # around the decoded path
SELF_OFFS = [-30, -15, -8, -4, -2, 0, 2, 4, 8, 15, 30]           # around the self-match
CLOUD_OFFS = [-30, -15, -8, -4, -2, 0, 2, 4, 8, 15, 30]          # around the weighted candidates

W = 10.0        # search half-width on the template axis at this data scale
REACH = 100.0   # search half-width of the window match: the operator's own


def _eval(spark, sf):
    return views.seq(spark, sf).filter("NOT known")


@register("range_nearest", dbl=["pred"], sql="""
WITH tv AS (SELECT tid, x, y FROM tmpl WHERE x IS NOT NULL AND y IS NOT NULL),
tk AS (SELECT tid FROM tv GROUP BY tid HAVING count(*) >= 2),
c AS (SELECT s.entity, s.i, t.x, abs(t.y - s.sig_gap) AS d FROM seq AS s JOIN tv AS t ON t.tid = s.tid
      AND t.x BETWEEN s.prior - 10.0 AND s.prior + 10.0
      WHERE NOT s.known AND s.sig_gap IS NOT NULL AND s.tid IN (SELECT tid FROM tk)),
b AS (SELECT entity, i, x FROM (SELECT *, row_number() OVER (PARTITION BY entity, i ORDER BY d, x) AS r FROM c) AS t WHERE r = 1)
SELECT s.entity, s.i, coalesce(b.x, s.prior) AS pred FROM seq AS s LEFT JOIN b ON s.entity = b.entity AND s.i = b.i WHERE NOT s.known""")
def q_range_nearest(spark, sf):
    r = MT.range_nearest(_eval(spark, sf), views.tmpl(spark, sf), "tid", "prior", "sig_gap", "pred", W)
    return r.select("entity", "i", "pred")


INTERP_SQL = """
iq AS (SELECT entity, i, tid, prior AS q FROM seq),
il AS (SELECT iq.entity, iq.i, iq.tid, iq.q, t.x AS xl, t.y AS yl FROM iq ASOF LEFT JOIN tmpl AS t ON iq.tid = t.tid AND iq.q >= t.x),
ir AS (SELECT il.*, t.x AS xr, t.y AS yr FROM il ASOF LEFT JOIN tmpl AS t ON il.tid = t.tid AND il.q <= t.x)"""


@register("interp_lookup", dbl=["tv"], sql=f"""
WITH {INTERP_SQL}
SELECT entity, i, CASE WHEN xl IS NULL THEN yr WHEN xr IS NULL THEN yl WHEN xr = xl THEN yl
                       ELSE (yr - yl) / (xr - xl) * (q - xl) + yl END AS tv FROM ir""")
def q_interp_lookup(spark, sf):
    s = views.seq(spark, sf).select("entity", "i", "tid", "prior")
    return MT.interp_lookup(s, views.tmpl(spark, sf), "tid", F.col("prior"), "x", "y", "tv").select("entity", "i", "tv")


@register("nearest_key", dbl=["near_x", "near_y"], sql=f"""
WITH {INTERP_SQL}
SELECT entity, i, CASE WHEN xr IS NULL OR (xl IS NOT NULL AND abs(xl - q) <= abs(xr - q)) THEN xl ELSE xr END AS near_x,
                  CASE WHEN xr IS NULL OR (xl IS NOT NULL AND abs(xl - q) <= abs(xr - q)) THEN yl ELSE yr END AS near_y FROM ir""")
def q_nearest_key(spark, sf):
    s = views.seq(spark, sf).select("entity", "i", "tid", "prior")
    return MT.nearest_key(s, views.tmpl(spark, sf), "tid", F.col("prior"), "x", "y", "near_x", "near_y").select(
        "entity", "i", "near_x", "near_y")


# anchor -> (offsets, SQL): the last known prior, the curve's nearest point to the prior, the prior, halfway between last and prior
ANCHORS = {"last": (LAST_OFFS, "lk.lp"), "beam": (BEAM_OFFS, "nk.nx"), "self": (SELF_OFFS, "s.prior"), "cloud": (CLOUD_OFFS, "(s.prior + lk.lp) / 2")}
_OFF = [(f"{a}_{'m' if o < 0 else 'p'}{abs(o)}", a, o) for a, (offs, _) in ANCHORS.items() for o in offs]


@register("interp_offsets", stored=True, dbl=[n for n, _, _ in _OFF], sql=f"""
WITH {INTERP_SQL},
nk AS (SELECT entity, i, CASE WHEN xr IS NULL OR (xl IS NOT NULL AND abs(xl - q) <= abs(xr - q)) THEN xl ELSE xr END AS nx FROM ir),
lk AS (SELECT entity, arg_max(prior, i) AS lp FROM seq WHERE known GROUP BY entity),
o AS (SELECT * FROM (VALUES """ + ", ".join(f"('{n}', '{a}', {float(o)})" for n, a, o in _OFF) + """) AS t(name, anchor, off)),
oq AS (SELECT s.entity, s.i, s.tid, s.sig, o.name, CASE o.anchor """ + " ".join(f"WHEN '{a}' THEN {e}" for a, (_, e) in ANCHORS.items()) + """ END + o.off AS q
       FROM seq AS s JOIN lk ON s.entity = lk.entity JOIN nk ON s.entity = nk.entity AND s.i = nk.i CROSS JOIN o),
ol AS (SELECT oq.*, t.x AS xl, t.y AS yl FROM oq ASOF LEFT JOIN tmpl AS t ON oq.tid = t.tid AND oq.q >= t.x),
oo AS (SELECT ol.*, t.x AS xr, t.y AS yr FROM ol ASOF LEFT JOIN tmpl AS t ON ol.tid = t.tid AND ol.q <= t.x),
v AS (SELECT entity, i, name, sig - CASE WHEN xl IS NULL THEN yr WHEN xr IS NULL THEN yl WHEN xr = xl THEN yl
                                   ELSE (yr - yl) / (xr - xl) * (q - xl) + yl END AS d FROM oo)
SELECT entity, i, """ + ", ".join(f"max(CASE WHEN name = '{n}' THEN d END) AS {n}" for n, _, _ in _OFF) + """
FROM v GROUP BY entity, i""")
def q_interp_offsets(spark, sf):
    from stratum.operators.aggregates import boundary_row
    s = views.seq(spark, sf)
    t = views.tmpl(spark, sf)
    lp = boundary_row(s, "entity", "i", ["prior"], F.col("known")).select("entity", "last_prior")
    s = MT.nearest_key(s.select("entity", "i", "tid", "sig", "prior"), t, "tid", F.col("prior"), "x", "y", "near_x", "near_y")
    s = s.join(lp, "entity")
    at = {"last": F.col("last_prior"), "beam": F.col("near_x"), "self": F.col("prior"), "cloud": (F.col("prior") + F.col("last_prior")) / 2}
    return MT.interp_offsets(s, t, "tid", ["entity", "i"], "sig", {a: (at[a], offs) for a, (offs, _) in ANCHORS.items()}, "x", "y")


def _copies(spark, sf):
    s = views.seq(spark, sf).select("entity", "i", "pos", "sig", "known", "prior", "k")
    return s.filter(F.col("i") % 2 == 0), s.filter(F.col("i") % 2 == 1)


@register("asof_cross_copy", stored=True, dbl=["other_sig"], sql="""
WITH e AS (SELECT entity, i, pos FROM seq WHERE i % 2 = 0), o AS (SELECT entity, pos AS x, sig AS y FROM seq WHERE i % 2 = 1),
l AS (SELECT e.*, o.x AS xl, o.y AS yl FROM e ASOF LEFT JOIN o ON e.entity = o.entity AND e.pos >= o.x),
r AS (SELECT l.*, o.x AS xr, o.y AS yr FROM l ASOF LEFT JOIN o ON l.entity = o.entity AND l.pos <= o.x)
SELECT entity, i, CASE WHEN xl IS NULL THEN yr WHEN xr IS NULL THEN yl WHEN xr = xl THEN yl
                       ELSE (yr - yl) / (xr - xl) * (pos - xl) + yl END AS other_sig FROM r""")
def q_asof_cross_copy(spark, sf):
    even, odd = _copies(spark, sf)
    return MT.asof_cross_copy(even.select("entity", "i", "pos"), odd, "entity", "pos", "sig", "other_sig").select(
        "entity", "i", "other_sig")


# ---- prefix statistics against the template ----------------------------------------------------

def _known_vs_template(spark, sf):
    s = views.seq(spark, sf).filter("known").select("entity", "i", "tid", "prior", "sig_gap")
    return MT.interp_lookup(s, views.tmpl(spark, sf), "tid", F.col("prior"), "x", "y", "tw")


KVT_SQL = """
iq AS (SELECT entity, i, tid, prior AS q, sig_gap FROM seq WHERE known),
il AS (SELECT iq.*, t.x AS xl, t.y AS yl FROM iq ASOF LEFT JOIN tmpl AS t ON iq.tid = t.tid AND iq.q >= t.x),
ir AS (SELECT il.*, t.x AS xr, t.y AS yr FROM il ASOF LEFT JOIN tmpl AS t ON il.tid = t.tid AND il.q <= t.x),
kv AS (SELECT entity, i, sig_gap, CASE WHEN xl IS NULL THEN yr WHEN xr IS NULL THEN yl WHEN xr = xl THEN yl
                              ELSE (yr - yl) / (xr - xl) * (q - xl) + yl END AS tw FROM ir)"""


@register("noise_scale", dbl=["noise"], sql=f"""
WITH {KVT_SQL}
SELECT entity, CASE WHEN count(sig_gap) < 20 THEN 30.0 ELSE greatest(least(stddev_pop(sig_gap - tw), 60.0), 10.0) END AS noise
FROM kv GROUP BY entity""")
def q_noise_scale(spark, sf):
    from stratum.functions.scalar import clip
    kv = _known_vs_template(spark, sf)
    g = kv.groupBy("entity").agg(F.count("sig_gap").alias("_n"), F.stddev_pop(F.col("sig_gap") - F.col("tw")).alias("_sd"))
    return g.select("entity", F.when(F.col("_n") < 20, F.lit(30.0)).otherwise(clip("_sd", 10.0, 60.0)).alias("noise"))


@register("affine_calibrate", dbl=["gain", "cal_offset"], sql=f"""
WITH {KVT_SQL},
g AS (SELECT entity, count(*) FILTER (WHERE sig_gap IS NOT NULL AND tw IS NOT NULL) AS n,
             stddev_pop(CASE WHEN sig_gap IS NOT NULL THEN tw END) AS sd, regr_slope(sig_gap, tw) AS a, regr_intercept(sig_gap, tw) AS b,
             avg(CASE WHEN tw IS NOT NULL THEN sig_gap END) - avg(CASE WHEN sig_gap IS NOT NULL THEN tw END) AS md FROM kv GROUP BY entity)
SELECT entity, CASE WHEN n < 20 OR sd < 1e-6 THEN 1.0 ELSE a END AS gain,
       CASE WHEN n < 20 OR sd < 1e-6 THEN coalesce(md, 0.0) ELSE b END AS cal_offset FROM g""")
def q_affine_calibrate(spark, sf):
    kv = _known_vs_template(spark, sf)
    v = F.col("sig_gap").isNotNull() & F.col("tw").isNotNull()
    g = kv.groupBy("entity").agg(
        F.count_if(v).alias("_n"), F.stddev_pop(F.when(F.col("sig_gap").isNotNull(), F.col("tw"))).alias("_sd"),
        F.regr_slope("sig_gap", "tw").alias("_a"), F.regr_intercept("sig_gap", "tw").alias("_b"),
        (F.avg(F.when(F.col("tw").isNotNull(), F.col("sig_gap"))) - F.avg(F.when(F.col("sig_gap").isNotNull(), F.col("tw")))).alias("_md"))
    fb = (F.col("_n") < 20) | (F.col("_sd") < 1e-6)
    return g.select("entity", F.when(fb, F.lit(1.0)).otherwise(F.col("_a")).alias("gain"),
                    F.when(fb, F.coalesce("_md", F.lit(0.0))).otherwise(F.col("_b")).alias("cal_offset"))


@register("prefix_rmse", dbl=["prefix_rmse"], sql=f"""
WITH {KVT_SQL} SELECT entity, sqrt(avg((sig_gap - tw) * (sig_gap - tw))) AS prefix_rmse FROM kv GROUP BY entity""")
def q_prefix_rmse(spark, sf):
    kv = _known_vs_template(spark, sf)
    d = F.col("sig_gap") - F.col("tw")
    return kv.groupBy("entity").agg(F.sqrt(F.avg(d * d)).alias("prefix_rmse"))


# ---- sub-sequence matching -----------------------------------------------------------------------

def _eval_positions(spark, sf):
    return _eval(spark, sf).select("entity", "i", "tid", "prior", "sig_gap", (F.col("i") - F.col("nkn")).alias("e"))


def _sse_sql(w: float) -> str:
    return f"""
ev AS (SELECT entity, i, tid, prior, sig_gap, row_number() OVER (PARTITION BY entity ORDER BY i) - 1 AS e FROM seq WHERE NOT known),
nb AS (SELECT *, last_value(CASE WHEN sig_gap IS NOT NULL THEN e END IGNORE NULLS) OVER (PARTITION BY entity ORDER BY e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pi,
  last_value(sig_gap IGNORE NULLS) OVER (PARTITION BY entity ORDER BY e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
  first_value(CASE WHEN sig_gap IS NOT NULL THEN e END IGNORE NULLS) OVER (PARTITION BY entity ORDER BY e ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ni,
  first_value(sig_gap IGNORE NULLS) OVER (PARTITION BY entity ORDER BY e ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv FROM ev),
gf AS (SELECT entity, i, e, tid, prior, CASE WHEN pi IS NOT NULL AND ni IS NOT NULL THEN CASE WHEN ni = pi THEN pv ELSE pv + (nv - pv) * (e - pi) / (ni - pi) END
                                           WHEN pi IS NOT NULL THEN pv WHEN ni IS NOT NULL THEN nv END AS g FROM nb),
wn AS (SELECT entity, i, e, tid, prior, list(g) OVER (PARTITION BY entity ORDER BY e ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS loc,
              count(g) OVER (PARTITION BY entity ORDER BY e ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS nn,
              count(*) OVER (PARTITION BY entity ORDER BY e ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS cnt, least(e, 5) AS off FROM gf),
tv AS (SELECT tid, x, y FROM tmpl WHERE x IS NOT NULL AND y IS NOT NULL),
tk AS (SELECT tid FROM tv GROUP BY tid HAVING count(*) >= 11),
sg AS (SELECT w.entity, w.i, w.loc, len(w.loc) AS L, w.off, t.x, t.y,
              row_number() OVER (PARTITION BY w.entity, w.i ORDER BY t.x) - 1 AS s, count(*) OVER (PARTITION BY w.entity, w.i) AS m
       FROM wn AS w JOIN tv AS t ON t.tid = w.tid AND t.x >= w.prior - {w} AND t.x < w.prior + {w}
       WHERE w.nn = w.cnt AND len(w.loc) >= 3 AND w.tid IN (SELECT tid FROM tk)),
st AS (SELECT a.entity, a.i, a.s AS st, a.L, a.off,
              sum((b.y - a.loc[b.s - a.s + 1]) * (b.y - a.loc[b.s - a.s + 1])) AS sse
       FROM sg AS a JOIN sg AS b ON a.entity = b.entity AND a.i = b.i AND b.s >= a.s AND b.s < a.s + a.L
       WHERE a.s <= a.m - a.L AND a.m >= a.L GROUP BY a.entity, a.i, a.s, a.L, a.off),
bs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity, i ORDER BY round(sse, 5), st) AS r FROM st) AS t WHERE r = 1),
mt AS (SELECT bs.entity, bs.i, sg.x AS match_x, bs.sse / bs.L AS err FROM bs JOIN sg ON sg.entity = bs.entity AND sg.i = bs.i AND sg.s = bs.st + bs.off)"""


def _sse(spark, sf, search: float):
    ev = _eval_positions(spark, sf)
    return MT.subseq_match_sse(ev, views.tmpl(spark, sf), "entity", "e", "tid", "prior", "sig_gap",
                               half=5, search=search, sse_digits=5)


@register("subseq_match_sse", stored=True, dbl=["match_x", "err"], sql=f"""
WITH {_sse_sql(REACH)} SELECT ev.entity, ev.i, mt.match_x, mt.err FROM ev LEFT JOIN mt ON ev.entity = mt.entity AND ev.i = mt.i""")
def q_subseq_match_sse(spark, sf):
    # every eval row; match_x / err are null where no window could be matched
    return _sse(spark, sf, REACH).select("entity", "i", "match_x", "err")


@register("median_gate", stored=True, dbl=["pred"], sql=f"""
WITH {_sse_sql(W)},
md AS (SELECT entity, median(err) AS med FROM mt GROUP BY entity)
SELECT ev.entity, ev.i, CASE WHEN mt.err IS NOT NULL AND mt.err <= md.med * 1.5 THEN mt.match_x ELSE ev.prior END AS pred
FROM ev LEFT JOIN mt ON ev.entity = mt.entity AND ev.i = mt.i LEFT JOIN md ON ev.entity = md.entity""")
def q_median_gate(spark, sf):
    return MT.median_gate(_sse(spark, sf, W), "entity", "err", "match_x", "prior", "pred").select("entity", "i", "pred")


HALF_WIDTHS = (8, 15, 25)      # fixed values: the three scales of the search


def _ncc_sql(hw: int) -> str:
    win = 2 * hw + 1
    return f"""
kn AS (SELECT entity, row_number() OVER (PARTITION BY entity ORDER BY i) - 1 AS kp, sig, prior, count(*) OVER (PARTITION BY entity) AS nk FROM seq WHERE known),
ks AS (SELECT *, avg(sig) OVER (PARTITION BY entity ORDER BY kp ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS s FROM kn),
kw AS (SELECT entity, kp, nk, list(s) OVER (PARTITION BY entity ORDER BY kp ROWS BETWEEN CURRENT ROW AND {win - 1} FOLLOWING) AS w FROM ks),
kc AS (SELECT entity, kp AS st, least(kp + {hw}, nk - 1) AS cpos, w, list_reduce(w, lambda a, b: a + b) / {win} AS m FROM kw
       WHERE kp % 3 = 0 AND kp <= nk - {win} AND nk >= {win + 1}),
kz AS (SELECT entity, st, cpos, list_transform(w, lambda v: (v - m) / (sqrt(list_reduce(list_transform(w, lambda u: (u - m) * (u - m)), lambda a, b: a + b) / {win}) + 1e-6)) AS cn FROM kc),
kl AS (SELECT kz.entity, kz.st, kz.cn, kn.prior AS lab FROM kz JOIN kn ON kz.entity = kn.entity AND kz.cpos = kn.kp),
ev AS (SELECT entity, i, row_number() OVER (PARTITION BY entity ORDER BY i) - 1 AS ep, sig, count(*) OVER (PARTITION BY entity) AS ne FROM seq WHERE NOT known),
es AS (SELECT *, avg(sig) OVER (PARTITION BY entity ORDER BY ep ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS s FROM ev),
ew AS (SELECT entity, i, ep, ne, list(s) OVER (PARTITION BY entity ORDER BY ep ROWS BETWEEN {hw} PRECEDING AND {hw} FOLLOWING) AS raw,
              first_value(s) OVER (PARTITION BY entity ORDER BY ep) AS fs,
              last_value(s) OVER (PARTITION BY entity ORDER BY ep ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS ls FROM es),
eh AS (SELECT entity, i, list_concat(list_transform(range(greatest({hw} - ep, 0)), lambda z: fs), raw,
                                     list_transform(range(greatest(ep + {hw} - (ne - 1), 0)), lambda z: ls)) AS h FROM ew),
em AS (SELECT *, list_reduce(h, lambda a, b: a + b) / {win} AS m FROM eh),
ez AS (SELECT entity, i, list_transform(h, lambda v: (v - m) / (sqrt(list_reduce(list_transform(h, lambda u: (u - m) * (u - m)), lambda a, b: a + b) / {win}) + 1e-6)) AS hn FROM em),
sc AS (SELECT ez.entity, ez.i, kl.st, kl.lab,
              list_reduce(list_transform(list_zip(ez.hn, kl.cn), lambda p: p[1] * p[2]), lambda a, b: a + b) / {win} AS score
       FROM ez JOIN kl ON ez.entity = kl.entity),
bt AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity, i ORDER BY score DESC, st) AS r FROM sc) AS t WHERE r = 1),
ll AS (SELECT entity, arg_max(prior, kp) AS lastlab FROM kn GROUP BY entity),
ncc AS (SELECT ev.entity, ev.i, coalesce(bt.lab, ll.lastlab) AS ncc_label, coalesce(bt.score, 0.0) AS ncc_score
        FROM ev LEFT JOIN bt ON ev.entity = bt.entity AND ev.i = bt.i LEFT JOIN ll ON ev.entity = ll.entity)"""


_NCC_W = {h: f"exp(3.0 * n{h}.ncc_score)" for h in HALF_WIDTHS}


@register("subseq_match_ncc", stored=True, dbl=[f"{c}_{h}" for h in HALF_WIDTHS for c in ("label", "score")] + ["ensemble"], sql=(
    "WITH " + ",\n".join(f"n{h} AS (WITH {_ncc_sql(h)} SELECT * FROM ncc)" for h in HALF_WIDTHS)
    + f"\nSELECT n{HALF_WIDTHS[0]}.entity, n{HALF_WIDTHS[0]}.i, "
    + ", ".join(f"n{h}.ncc_label AS label_{h}, n{h}.ncc_score AS score_{h}" for h in HALF_WIDTHS)
    + ", (" + " + ".join(f"n{h}.ncc_label * {w}" for h, w in _NCC_W.items()) + ") / (" + " + ".join(_NCC_W.values()) + " + 1e-9) AS ensemble"
    + f" FROM n{HALF_WIDTHS[0]} " + " ".join(
        f"JOIN n{h} ON n{h}.entity = n{HALF_WIDTHS[0]}.entity AND n{h}.i = n{HALF_WIDTHS[0]}.i" for h in HALF_WIDTHS[1:])))
def q_subseq_match_ncc(spark, sf):
    s = views.seq(spark, sf)
    kn = s.filter("known").select("entity", "i", "sig", "prior", F.col("i").alias("kp"))
    ev = s.filter("NOT known").select("entity", "i", "sig", (F.col("i") - F.col("nkn")).alias("ep"))
    out = None
    for h in HALF_WIDTHS:
        r = MT.subseq_match_ncc(kn, ev, "entity", "kp", "ep", "sig", "sig", "prior", half=h, stride=3)
        r = r.select("entity", "i", F.col("ncc_label").alias(f"label_{h}"), F.col("ncc_score").alias(f"score_{h}"))
        out = r if out is None else out.join(r, ["entity", "i"])
    return A.score_weighted_blend(out, [f"label_{h}" for h in HALF_WIDTHS], [f"score_{h}" for h in HALF_WIDTHS], 3.0, "ensemble")


# ---- guarded override -------------------------------------------------------------------------

@register("guarded_override", stored=True, dbl=["pred"], sql="""
WITH tr AS (SELECT entity, pos AS x, pos + k * CASE WHEN entity % 4 = 0 THEN 1.0 ELSE 0.001 END AS y FROM seq WHERE i % 2 = 1),
te AS (SELECT entity, i, pos, known, prior FROM seq WHERE i % 2 = 0),
rg AS (SELECT entity, count(*) AS nv, min(x) AS lo, max(x) AS hi FROM tr GROUP BY entity),
l AS (SELECT te.*, tr.x AS xl, tr.y AS yl FROM te ASOF LEFT JOIN tr ON te.entity = tr.entity AND te.pos >= tr.x),
r AS (SELECT l.*, tr.x AS xr, tr.y AS yr FROM l ASOF LEFT JOIN tr ON l.entity = tr.entity AND l.pos <= tr.x),
v AS (SELECT r.*, rg.nv, rg.lo, rg.hi, CASE WHEN xl IS NULL THEN yr WHEN xr IS NULL THEN yl WHEN xr = xl THEN yl
                               ELSE (yr - yl) / (xr - xl) * (pos - xl) + yl END AS phys FROM r JOIN rg ON r.entity = rg.entity),
ck AS (SELECT entity, any_value(nv) AS nv, count(*) FILTER (WHERE known AND pos BETWEEN lo AND hi) AS ncmp,
              sqrt(avg(CASE WHEN known AND pos BETWEEN lo AND hi THEN (phys - pos) * (phys - pos) END)) AS rk FROM v GROUP BY entity),
vd AS (SELECT entity, CASE WHEN nv < 20 THEN 'SKIP too few valid rows' WHEN ncmp < 10 THEN 'SKIP too few comparable rows'
                            WHEN rk IS NULL OR rk > 1.0 THEN 'SKIP prefix rmse' ELSE 'OK' END AS verdict FROM ck)
SELECT v.entity, v.i, CASE WHEN vd.verdict = 'OK' AND v.pos BETWEEN v.lo AND v.hi THEN v.phys ELSE v.prior END AS pred, vd.verdict
FROM v JOIN vd ON v.entity = vd.entity WHERE NOT v.known""")
def q_guarded_override(spark, sf):
    from stratum.operators.blending import guarded_override
    even, odd = _copies(spark, sf)
    tr = odd.select("entity", F.col("pos").alias("x"),
                    (F.col("pos") + F.col("k") * F.when(F.col("entity") % 4 == 0, 1.0).otherwise(0.001)).alias("y"))
    te = even.select("entity", "i", "pos", "known", "prior", F.col("pos").alias("label"))
    r = guarded_override(te, tr, "entity", "pos", "label", "known", "prior", "pred",
                         min_valid=20, min_compare=10, max_rmse=1.0)
    return r.filter("NOT known").select("entity", "i", "pred", "verdict")


# ---- spatial -----------------------------------------------------------------------------------

SURF = ["s1", "s2", "s3", "s4", "s5", "s6"]


def _plane_sql():
    cols = []
    for s in SURF:
        cxf = f"(rx_{s} - sx1 * r1_{s} / s1)"
        cyf = f"(ry_{s} - sy1 * r1_{s} / s1)"
        a = f"(({cxf} * cyy - {cyf} * cxy) / det)"
        b = f"(({cyf} * cxx - {cxf} * cxy) / det)"
        cols.append(f"CASE WHEN s1 IS NULL THEN m_{s} ELSE {a} * (qx - sx1 / s1) + {b} * (qy - sy1 / s1) + r1_{s} / s1 END AS plane_{s}")
    sums = ", ".join(f"sum(w * cx * f_{s}) AS rx_{s}, sum(w * cy * f_{s}) AS ry_{s}, sum(w * f_{s}) AS r1_{s}" for s in SURF)
    return f"""
WITH c AS (SELECT grp, median(x) AS cx, median(y) AS cy, {", ".join(f"median({s}) AS f_{s}" for s in SURF)} FROM pts GROUP BY grp),
sc AS (SELECT CASE WHEN stddev_pop(cx) < 1e-3 THEN 1.0 ELSE stddev_pop(cx) END AS sx,
              CASE WHEN stddev_pop(cy) < 1e-3 THEN 1.0 ELSE stddev_pop(cy) END AS sy FROM c),
pr AS (SELECT p.vec_id, c.*, sqrt((p.x / sc.sx - c.cx / sc.sx) * (p.x / sc.sx - c.cx / sc.sx) + (p.y / sc.sy - c.cy / sc.sy) * (p.y / sc.sy - c.cy / sc.sy)) AS dist
       FROM pts AS p JOIN c ON c.grp <> p.grp CROSS JOIN sc),
nb AS (SELECT *, 1.0 / (dist + 1e-3) AS w FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, grp) AS rk FROM pr) AS t WHERE rk <= 10),
g AS (SELECT vec_id, sum(w * cx * cx) AS sxx, sum(w * cx * cy) AS sxy, sum(w * cx) AS sx1, sum(w * cy * cy) AS syy, sum(w * cy) AS sy1,
             sum(w) AS s1, min(dist) AS min_dist, {sums} FROM nb GROUP BY vec_id),
mm AS (SELECT {", ".join(f"avg(f_{s}) AS m_{s}" for s in SURF)} FROM c),
q0 AS (SELECT p.vec_id, p.x AS qx, p.y AS qy, g.* EXCLUDE (vec_id), mm.* FROM pts AS p LEFT JOIN g ON p.vec_id = g.vec_id CROSS JOIN mm),
q1 AS (SELECT *, sxx - sx1 * sx1 / s1 + 1e-9 AS cxx, syy - sy1 * sy1 / s1 + 1e-9 AS cyy, sxy - sx1 * sy1 / s1 AS cxy FROM q0),
q AS (SELECT *, cxx * cyy - cxy * cxy AS det FROM q1)
SELECT vec_id, {", ".join(cols)}, min_dist FROM q"""


@register("knn_plane_impute", dbl=[f"plane_{s}" for s in SURF] + ["min_dist"], digits=5, sql=_plane_sql())
def q_knn_plane_impute(spark, sf):
    p = views.pts(spark, sf)
    return SPT.knn_plane_impute(p, p.select("vec_id", "x", "y", "grp"), "grp", "x", "y", SURF, "vec_id", "x", "y", "grp", k=10)


def _pts_subsample(spark, sf, m=60):
    p = views.pts(spark, sf)
    p = row_index(p, "grp", ["vec_id"], "j", chunk=F.floor(F.col("vec_id") / 4096), count_col="n")
    return Q.even_subsample(p, "grp", "j", "n", m)


@register("knn_idw_impute", dbl=["idw_mean", "idw_std", "idw_dist"], sql="""
WITH r0 AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY vec_id) - 1 AS j, count(*) OVER (PARTITION BY grp) AS n FROM pts),
e AS (SELECT DISTINCT grp, n FROM r0),
g AS (SELECT grp, n, least(60, n) AS m, unnest(range(least(60, n))) AS jj FROM e),
kp AS (SELECT DISTINCT grp, CAST(CASE WHEN jj = m - 1 THEN n - 1 ELSE floor(jj * (CAST(n - 1 AS DOUBLE) / CAST(greatest(m - 1, 1) AS DOUBLE))) END AS BIGINT) AS j FROM g),
rf AS (SELECT r0.vec_id, r0.grp, r0.x, r0.y, r0.s1 FROM r0 JOIN kp ON r0.grp = kp.grp AND r0.j = kp.j),
sc AS (SELECT CASE WHEN stddev_pop(x) < 1e-3 THEN 1.0 ELSE stddev_pop(x) END AS sx, CASE WHEN stddev_pop(y) < 1e-3 THEN 1.0 ELSE stddev_pop(y) END AS sy,
              avg(s1) AS gm FROM rf),
pr AS (SELECT q.vec_id AS qid, r.vec_id AS rid, r.s1,
              sqrt((q.x / sc.sx - r.x / sc.sx) * (q.x / sc.sx - r.x / sc.sx) + (q.y / sc.sy - r.y / sc.sy) * (q.y / sc.sy - r.y / sc.sy)) AS dist
       FROM pts AS q JOIN rf AS r ON r.grp <> q.grp CROSS JOIN sc),
nb AS (SELECT *, 1.0 / (dist + 1e-3) AS w FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, rid) AS rk FROM pr) AS t WHERE rk <= 20),
ag AS (SELECT qid, sum(w) AS sw, sum(w * s1) AS swa, min(dist) AS idw_dist FROM nb GROUP BY qid),
mn AS (SELECT p.vec_id AS qid, ag.idw_dist, CASE WHEN coalesce(sw, 0) < 1e-9 THEN sc.gm ELSE swa / sw END AS idw_mean,
              CASE WHEN sw < 1e-9 THEN 1.0 ELSE sw END AS safe FROM pts AS p LEFT JOIN ag ON p.vec_id = ag.qid CROSS JOIN sc),
vr AS (SELECT nb.qid, sum(nb.w * power(nb.s1 - mn.idw_mean, 2)) / any_value(mn.safe) AS var FROM nb JOIN mn ON nb.qid = mn.qid GROUP BY nb.qid)
SELECT mn.qid AS vec_id, mn.idw_mean, sqrt(greatest(vr.var, 0.0)) AS idw_std, mn.idw_dist FROM mn LEFT JOIN vr ON mn.qid = vr.qid""")
def q_knn_idw_impute(spark, sf):
    p = views.pts(spark, sf)
    refs = _pts_subsample(spark, sf, 60)
    return SPT.knn_idw_impute(refs, p.select("vec_id", "x", "y", "grp"), "grp", "vec_id", "x", "y", "s1",
                              "vec_id", "x", "y", "grp", k=20)


@register("top_k_per_key", dbl=["dist"], sql="""
SELECT qid AS vec_id, rid AS nbr_id, dist, rank FROM (
  SELECT q.vec_id AS qid, r.vec_id AS rid, sqrt((q.x - r.x) * (q.x - r.x) + (q.y - r.y) * (q.y - r.y)) AS dist,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY sqrt((q.x - r.x) * (q.x - r.x) + (q.y - r.y) * (q.y - r.y)), r.vec_id) AS rank
  FROM pts AS q JOIN pts AS r ON q.vec_id <> r.vec_id) AS t WHERE rank <= 5""")
def q_top_k_per_key(spark, sf):
    p = views.pts(spark, sf).select("vec_id", "x", "y")
    nb = SPT.knn_join(p, p.select(F.col("vec_id").alias("rid"), F.col("x").alias("rx"), F.col("y").alias("ry")), 5,
                      "vec_id", "rid", "x", "y", "rx", "ry", exclude_self_id=True)
    return nb.select("vec_id", F.col("rid").alias("nbr_id"), "dist", "rank")


@register("self_exclude", dbl=["dist"], sql="""
SELECT qid AS vec_id, rid AS nbr_id, dist FROM (
  SELECT q.vec_id AS qid, r.vec_id AS rid, sqrt((q.x - r.x) * (q.x - r.x) + (q.y - r.y) * (q.y - r.y)) AS dist,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY sqrt((q.x - r.x) * (q.x - r.x) + (q.y - r.y) * (q.y - r.y)), r.vec_id) AS rank
  FROM pts AS q JOIN pts AS r ON q.grp <> r.grp) AS t WHERE rank = 1""")
def q_self_exclude(spark, sf):
    p = views.pts(spark, sf).select("vec_id", "x", "y", "grp")
    r = p.select(F.col("vec_id").alias("rid"), F.col("x").alias("rx"), F.col("y").alias("ry"), F.col("grp").alias("rgrp"))
    nb = SPT.knn_join(p, r, 1, "vec_id", "rid", "x", "y", "rx", "ry", qgrp="grp", rgrp="rgrp")
    return nb.select("vec_id", F.col("rid").alias("nbr_id"), "dist")

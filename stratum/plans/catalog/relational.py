"""Equi-joins, set operations and sorts / top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratum.operators import joins as J
from stratum.operators import profile as P
from stratum.operators import publish as PB
from stratum.plans import views
from stratum.plans.registry import register
from stratum.sources.tables import load


def _docs_ids(spark, sf):
    return load(spark, sf, "documents", ["doc_id", "lang", "n_chars"])


@register("left_reconcile", sql="SELECT d.doc_id, l.quality FROM documents AS d LEFT JOIN labels AS l ON d.doc_id = l.doc_id")
def q_left_reconcile(spark, sf):
    return J.left_reconcile(_docs_ids(spark, sf).select("doc_id"), load(spark, sf, "labels", ["doc_id", "quality"]), "doc_id")


@register("inner_suffix", dbl=["price_1", "price_2"], sql="""
SELECT o.o_orderkey AS key, o.o_totalprice AS price_1, l.l_extendedprice AS price_2, l.l_linenumber
FROM orders AS o JOIN lineitem AS l ON o.o_orderkey = l.l_orderkey""")
def q_inner_suffix(spark, sf):
    o = load(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price"))
    li = load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_extendedprice").alias("price"),
                                            "l_linenumber")
    return J.inner_suffix(o, li, "key")


@register("inner_strict", sql="""
SELECT (SELECT count(*) FROM labels) AS n_left, (SELECT count(*) FROM labels WHERE toxic = 0) AS n_right,
       (SELECT count(*) FROM labels AS a JOIN (SELECT doc_id FROM labels WHERE toxic = 0) AS b ON a.doc_id = b.doc_id) AS n_joined,
       (SELECT count(*) FROM labels AS a JOIN (SELECT doc_id FROM labels WHERE toxic = 0) AS b ON a.doc_id = b.doc_id) = (SELECT count(*) FROM labels)
       AND (SELECT count(*) FROM labels AS a JOIN (SELECT doc_id FROM labels WHERE toxic = 0) AS b ON a.doc_id = b.doc_id) = (SELECT count(*) FROM labels WHERE toxic = 0) AS ok""")
def q_inner_strict(spark, sf):
    lab = load(spark, sf, "labels", ["doc_id", "quality", "toxic"])
    return J.inner_strict(lab.select("doc_id", "quality"), lab.filter("toxic = 0").select("doc_id"), "doc_id")


@register("lookup_map", sql="""
SELECT c.c_custkey, coalesce(n.n_name, 'UNKNOWN') AS nation FROM customer AS c
LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) AS n ON c.c_nationkey = n.n_nationkey""")
def q_lookup_map(spark, sf):
    c = load(spark, sf, "customer", ["c_custkey", "c_nationkey"])
    n = load(spark, sf, "nation", ["n_nationkey", "n_name"]).filter(F.col("n_nationkey") < 20)
    # nation is a fixed 25-row dimension: broadcast is bounded by construction
    return J.lookup_map(c, n, "c_nationkey", "n_nationkey", "n_name", "nation", "UNKNOWN", small_dim=True).select(
        "c_custkey", "nation")


@register("feature_join", dbl=["base", "feat", "feat_delta"], sql="""
SELECT d.doc_id, d.n_chars / 10000.0 AS base, coalesce(CAST(l.quality AS DOUBLE), d.n_chars / 10000.0) AS feat,
       coalesce(CAST(l.quality AS DOUBLE), d.n_chars / 10000.0) - d.n_chars / 10000.0 AS feat_delta
FROM documents AS d LEFT JOIN labels AS l ON d.doc_id = l.doc_id""")
def q_feature_join(spark, sf):
    d = _docs_ids(spark, sf).select("doc_id", (F.col("n_chars") / 10000.0).alias("base"))
    return J.feature_join(d, load(spark, sf, "labels", ["doc_id", "quality"]), "doc_id", "quality", "base", "feat").select(
        "doc_id", "base", "feat", "feat_delta")


@register("semi_overlap", sql="SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def q_semi_overlap(spark, sf):
    return J.semi_overlap(_docs_ids(spark, sf).select("doc_id", "lang"), load(spark, sf, "labels", ["doc_id"]), "doc_id")


@register("prompt_text_join", sql="""
SELECT c.conv_id, c.turn, c.role, md5(p.text) AS prompt_md5, length(c.text) AS n_chars
FROM conversations AS c LEFT JOIN (SELECT conv_id, text FROM conversations WHERE turn = 0) AS p ON c.conv_id = p.conv_id""")
def q_prompt_text_join(spark, sf):
    c = load(spark, sf, "conversations", ["conv_id", "turn", "role", "text"])
    j = J.prompt_text_join(c, "conv_id", "turn", "text")
    return j.select("conv_id", "turn", "role", F.md5("prompt_text").alias("prompt_md5"),
                    F.length("text").cast("long").alias("n_chars"))


@register("anti_extra", sql="""
SELECT doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang <> 'de')""")
def q_anti_extra(spark, sf):
    exp = _docs_ids(spark, sf).filter(F.col("lang") != "de")
    return J.anti_extra(load(spark, sf, "labels", ["doc_id"]), exp, "doc_id")


@register("cross_weights", dbl=["w", "blend"], sql="""
SELECT l.doc_id, w.w, w.w * l.quality + (1 - w.w) * l.toxic AS blend
FROM labels AS l CROSS JOIN (VALUES (0.0), (0.25), (0.5), (0.75), (1.0)) AS w(w)""")
def q_cross_weights(spark, sf):
    lab = load(spark, sf, "labels", ["doc_id", "quality", "toxic"])
    x = PB.cross_weights(lab, [0.0, 0.25, 0.5, 0.75, 1.0])
    return x.select("doc_id", "w", (F.col("w") * F.col("quality") + (1 - F.col("w")) * F.col("toxic")).alias("blend"))


# ---- set operations ----------------------------------------------------------------------------

@register("union_tagged", sql="""
SELECT d.doc_id, l.quality, 'tr' AS _src FROM documents AS d JOIN labels AS l ON d.doc_id = l.doc_id
UNION ALL SELECT doc_id, CAST(NULL AS INTEGER), 'te' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def q_union_tagged(spark, sf):
    d = _docs_ids(spark, sf).select("doc_id")
    lab = load(spark, sf, "labels", ["doc_id", "quality"])
    tr = d.join(lab, "doc_id")
    te = d.join(lab, "doc_id", "left_anti")
    # the union and back: the parts that come out of the tagged table are the ones that went in
    tr, te = J.split_tagged(J.union_tagged(tr, te))
    return tr.select("doc_id", "quality", F.lit("tr").alias("_src")).unionByName(te.select("doc_id", "quality", F.lit("te").alias("_src")))


@register("union_entities", dbl=["sig"], sql="SELECT entity, i, sig FROM seq")
def q_union_entities(spark, sf):
    s = views.seq(spark, sf).select("entity", "i", "sig", "known")
    return J.union_all([s.filter("known"), s.filter("NOT known")]).select("entity", "i", "sig")


@register("except_ids", sql="SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def q_except_ids(spark, sf):
    return J.except_ids(_docs_ids(spark, sf), load(spark, sf, "labels", ["doc_id"]), "doc_id")


@register("intersect_ids", sql="SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels")
def q_intersect_ids(spark, sf):
    return J.intersect_ids(_docs_ids(spark, sf), load(spark, sf, "labels", ["doc_id"]), "doc_id")


@register("dedupe_first", sql="""
SELECT doc_id, text_md5 FROM (SELECT doc_id, md5(text) AS text_md5, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r
                              FROM documents) AS t WHERE r = 1""")
def q_dedupe_first(spark, sf):
    d = load(spark, sf, "documents", ["doc_id", "text"])
    dd = PB.dedupe_first(d.select("text", "doc_id"), "text", ["doc_id"])
    return dd.select("doc_id", F.md5("text").alias("text_md5"))


# ---- sorts and top-k ---------------------------------------------------------------------------

@register("sort_rows", dbl=["y"], sql="SELECT tid, x, y, lab FROM tmpl ORDER BY tid, x")
def q_sort_rows(spark, sf):
    return views.tmpl(spark, sf).orderBy("tid", "x")


@register("leaderboard_top", sql="""
SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS score FROM events
WHERE event_type <> 'error' ORDER BY score DESC, event_id LIMIT 15""")
def q_leaderboard_top(spark, sf):
    e = load(spark, sf, "events", ["event_id", "event_type", "value"])
    e = e.select("event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("score"))
    return e.dropna(subset=["score"]).orderBy(F.col("score").desc(), "event_id").limit(15)


PTS_COLS = ["x", "y", "s1", "s2", "s3", "s4", "s5", "s6"]


@register("top_abs", dbl=["corr"], sql="""
WITH c AS (""" + "\nUNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}, {b}) AS corr FROM pts"
    for i, a in enumerate(PTS_COLS) for b in PTS_COLS[i + 1:]) + """)
SELECT col_a, col_b, corr FROM c ORDER BY abs(corr) DESC, col_a, col_b LIMIT 20""")
def q_top_abs(spark, sf):
    cm = P.correlation_matrix(views.pts(spark, sf), PTS_COLS)
    return cm.orderBy(F.abs("corr").desc(), "col_a", "col_b").limit(20)


@register("tail_k", dbl=["sig"], sql="SELECT entity, i, sig FROM seq WHERE i >= n - 10")
def q_tail_k(spark, sf):
    # the row index and entity length are known, so the tail is a filter, not a window
    s = views.seq(spark, sf)
    return s.filter(F.col("i") >= F.col("n") - 10).select("entity", "i", "sig")

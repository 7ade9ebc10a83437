"""Projections, predicates, scalar functions and row-attached group statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratum.functions import scalar as S
from stratum.operators import tabular as T
from stratum.plans import views
from stratum.plans.registry import register
from stratum.sources.tables import load


def _t(spark, sf, name, cols=None):
    return load(spark, sf, name, cols)


@register("project", sql="""
SELECT c_custkey AS cust_id, c_nationkey AS nation_key, c_acctbal AS balance, c_mktsegment AS segment
FROM customer""")
def q_project(spark, sf):
    c = _t(spark, sf, "customer")
    return (c.withColumnsRenamed({"c_custkey": "cust_id", "c_nationkey": "nation_key",
                                  "c_acctbal": "balance", "c_mktsegment": "segment"})
            .drop("c_name"))


@register("arith_feature", dbl=["qty_plus", "unit_price"], sql="""
SELECT l_orderkey, l_linenumber, l_quantity + l_discount + 1 AS qty_plus,
       l_extendedprice / nullif(l_quantity, 0) AS unit_price FROM lineitem""")
def q_arith_feature(spark, sf):
    li = _t(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_extendedprice"])
    return li.select("l_orderkey", "l_linenumber",
                     (F.col("l_quantity") + F.col("l_discount") + 1).alias("qty_plus"),
                     S.safe_div("l_extendedprice", "l_quantity").alias("unit_price"))


@register("bool_flag", sql="""
SELECT l_orderkey, l_linenumber, CAST(l_linenumber = 1 AS INTEGER) AS is_first FROM lineitem""")
def q_bool_flag(spark, sf):
    li = _t(spark, sf, "lineitem", ["l_orderkey", "l_linenumber"])
    return li.select("l_orderkey", "l_linenumber", S.bool_flag(F.col("l_linenumber") == 1).alias("is_first"))


@register("bin_right_closed", sql="""
SELECT p_partkey, CASE WHEN p_size > 0 AND p_size <= 10 THEN 'small'
                       WHEN p_size > 10 AND p_size <= 25 THEN 'medium'
                       WHEN p_size > 25 AND p_size <= 40 THEN 'large' ELSE 'nan' END AS size_bucket
FROM part""")
def q_bin_right_closed(spark, sf):
    p = _t(spark, sf, "part", ["p_partkey", "p_size"])
    return p.select("p_partkey", S.bin_right_closed("p_size", [0, 10, 25, 40],
                                                    ["small", "medium", "large"]).alias("size_bucket"))


@register("bin_searchsorted_right", sql="""
SELECT o_orderkey, CAST((o_totalprice >= 100000)::INT + (o_totalprice >= 200000)::INT
                        + (o_totalprice >= 300000)::INT + (o_totalprice >= 400000)::INT AS BIGINT) AS price_bin
FROM orders""")
def q_bin_searchsorted_right(spark, sf):
    o = _t(spark, sf, "orders", ["o_orderkey", "o_totalprice"])
    return o.select("o_orderkey", S.bin_searchsorted_right("o_totalprice", [100000, 200000, 300000, 400000])
                    .alias("price_bin"))


@register("bin_code_variant", dbl=["z_span"], sql="""
WITH g AS (SELECT entity, CAST(sum(CAST(NOT known AS BIGINT)) AS DOUBLE) AS n_eval,
                  coalesce(max(CASE WHEN NOT known THEN k END) - min(CASE WHEN NOT known THEN k END), 0.0) AS z_span
           FROM seq GROUP BY entity),
c AS (SELECT *, CAST(n_eval > 20 AS BIGINT) + 2 * (CAST(z_span >= 80.0 AS BIGINT) + CAST(z_span >= 95.0 AS BIGINT)) AS code FROM g)
SELECT entity, n_eval, z_span, code,
       CASE code WHEN 0 THEN 'pf_scale_5_hold_0.2' WHEN 1 THEN 'pf_scale_3_hold_0.15'
                 WHEN 2 THEN 'pf_scale_12_beam_0.2_hold_0.15' WHEN 3 THEN 'pf_scale_5_hold_0.15'
                 WHEN 4 THEN 'pf_scale_5_beam_0.05_hold_0.05' WHEN 5 THEN 'pf_scale_12_beam_0.2_hold_0.05'
                 ELSE 'pf_scale_8_hold_0.2' END AS variant
FROM c""")
def q_bin_code_variant(spark, sf):
    s = views.seq(spark, sf)
    return T.bin_code_variant(s, "entity", ~F.col("known"), "k", 20, (80.0, 95.0))


@register("clip", dbl=["balance"], sql="""
SELECT c_custkey, greatest(least(c_acctbal, 5000.0), 0.0) AS balance FROM customer""")
def q_clip(spark, sf):
    c = _t(spark, sf, "customer", ["c_custkey", "c_acctbal"])
    return c.select("c_custkey", S.clip("c_acctbal", 0.0, 5000.0).alias("balance"))


PRIORITY_MAP = {"1-URGENT": "URGENT", "2-HIGH": "HIGH", "5-LOW": "LOW"}


@register("map_values", sql="""
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'URGENT' WHEN '2-HIGH' THEN 'HIGH'
                        WHEN '5-LOW' THEN 'LOW' ELSE o_orderpriority END AS priority
FROM orders""")
def q_map_values(spark, sf):
    o = _t(spark, sf, "orders", ["o_orderkey", "o_orderpriority"])
    return o.select("o_orderkey", S.map_values("o_orderpriority", PRIORITY_MAP).alias("priority"))


@register("collapse_listed", sql="""
SELECT p_partkey, CASE WHEN p_type IN ('PROMO', 'STANDARD') THEN 'Rare' ELSE p_type END AS type_c FROM part""")
def q_collapse_listed(spark, sf):
    p = _t(spark, sf, "part", ["p_partkey", "p_type"])
    return p.select("p_partkey", S.collapse_listed("p_type", ["PROMO", "STANDARD"]).alias("type_c"))


@register("collapse_unlisted", sql="""
SELECT p_partkey, CASE WHEN nullif(p_type, 'MEDIUM') IN ('ECONOMY', 'SMALL', 'LARGE') THEN p_type ELSE 'Rare' END AS type_c
FROM part""")
def q_collapse_unlisted(spark, sf):
    p = _t(spark, sf, "part", ["p_partkey", "p_type"]).withColumn("p_type", F.nullif("p_type", F.lit("MEDIUM")))
    return p.select("p_partkey", S.collapse_unlisted("p_type", ["ECONOMY", "SMALL", "LARGE"]).alias("type_c"))


@register("collapse_infrequent", sql="""
SELECT p_partkey, CASE WHEN count(*) OVER (PARTITION BY p_name) < 25 THEN 'Rare' ELSE p_name END AS name_c FROM part""")
def q_collapse_infrequent(spark, sf):
    p = _t(spark, sf, "part", ["p_partkey", "p_name"])
    return T.collapse_infrequent(p, "p_name", 25, "name_c").select("p_partkey", "name_c")


@register("drop_missing", dbl=["y"], sql="""
SELECT tid, x, y, lab FROM (SELECT tid, x, y, nullif(lab, 'SMALL') AS lab FROM tmpl) AS t WHERE lab IS NOT NULL""")
def q_drop_missing(spark, sf):
    t = views.tmpl(spark, sf).withColumn("lab", F.nullif("lab", F.lit("SMALL")))
    return T.drop_missing(t, ["lab"])


def _dirty_value():
    return (F.when(F.col("event_type") == "error", F.lit(float("nan")))
            .when(F.col("event_type") == "signup", F.lit(None).cast("double"))
            .when((F.col("event_type") == "click") & (F.col("value") > 400), F.lit(float("inf")))
            .otherwise(F.col("value")))


@register("finite_filter", sql="""
SELECT event_id, v FROM (
  SELECT event_id, CASE WHEN event_type = 'error' THEN CAST('NaN' AS DOUBLE)
                        WHEN event_type = 'signup' THEN NULL
                        WHEN event_type = 'click' AND value > 400 THEN CAST('Infinity' AS DOUBLE)
                        ELSE value END AS v FROM events) AS e
WHERE v IS NOT NULL AND isfinite(v)""")
def q_finite_filter(spark, sf):
    e = _t(spark, sf, "events", ["event_id", "event_type", "value"]).select("event_id", _dirty_value().alias("v"))
    return T.finite_filter(e, ["v"])


@register("in_range_filter", sql="""
WITH r AS (SELECT o_custkey, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders
           WHERE o_orderstatus = 'F' GROUP BY o_custkey)
SELECT o.o_orderkey, o.o_custkey, o.o_totalprice FROM orders AS o JOIN r ON o.o_custkey = r.o_custkey
WHERE o.o_orderstatus = 'O' AND o.o_totalprice BETWEEN r.lo AND r.hi""")
def q_in_range_filter(spark, sf):
    o = _t(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"])
    ref = o.filter(F.col("o_orderstatus") == "F")
    cand = o.filter(F.col("o_orderstatus") == "O")
    return T.in_range_filter(cand, ref, "o_custkey", "o_totalprice", "o_totalprice").select(
        "o_orderkey", "o_custkey", "o_totalprice")


@register("min_support_filter", sql="""
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) >= 12)""")
def q_min_support_filter(spark, sf):
    o = _t(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    return T.min_support_filter(o, "o_custkey", 12)


def _spec_col():
    beam = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("_beam_0."), (F.col("p_size") % 10).cast("string"))
                  ).otherwise(F.lit(""))
    hold = F.when(F.col("p_size") % 3 != 0, F.concat(F.lit("_hold_0."), (F.col("p_partkey") % 20).cast("string"))
                  ).otherwise(F.lit(""))
    return F.concat(F.lit("pf_scale_"), (F.col("p_size") % 13).cast("string"), beam, hold)


@register("parse_spec_string", dbl=["scale", "beam", "hold"], sql="""
WITH s AS (SELECT p_partkey, 'pf_scale_' || CAST(p_size % 13 AS VARCHAR)
              || CASE WHEN p_size % 2 = 0 THEN '_beam_0.' || CAST(p_size % 10 AS VARCHAR) ELSE '' END
              || CASE WHEN p_size % 3 <> 0 THEN '_hold_0.' || CAST(p_partkey % 20 AS VARCHAR) ELSE '' END AS spec
           FROM part),
p AS (SELECT p_partkey, spec, string_split(spec, '_') AS parts FROM s)
SELECT p_partkey, spec,
       CASE WHEN list_position(parts, 'scale') > 0 THEN coalesce(TRY_CAST(parts[list_position(parts, 'scale') + 1] AS DOUBLE), 0.0) ELSE 0.0 END AS scale,
       CASE WHEN list_position(parts, 'beam') > 0 THEN coalesce(TRY_CAST(parts[list_position(parts, 'beam') + 1] AS DOUBLE), 0.0) ELSE 0.0 END AS beam,
       CASE WHEN list_position(parts, 'hold') > 0 THEN coalesce(TRY_CAST(parts[list_position(parts, 'hold') + 1] AS DOUBLE), 0.0) ELSE 0.0 END AS hold
FROM p""")
def q_parse_spec_string(spark, sf):
    p = _t(spark, sf, "part", ["p_partkey", "p_size"]).select("p_partkey", _spec_col().alias("spec"))
    return p.select("p_partkey", "spec", S.parse_spec_field("spec", "scale").alias("scale"),
                    S.parse_spec_field("spec", "beam").alias("beam"),
                    S.parse_spec_field("spec", "hold").alias("hold"))


@register("align_columns", sql="""
SELECT doc_id, n_chars, CAST(0.0 AS DOUBLE) AS n_words, CAST(0.0 AS DOUBLE) AS quality FROM documents""")
def q_align_columns(spark, sf):
    d = _t(spark, sf, "documents", ["doc_id", "n_chars", "lang"])
    return T.align_columns(d, ["doc_id", "n_chars", "n_words", "quality"], 0.0)


@register("select_except", sql="SELECT lang, source FROM documents")
def q_select_except(spark, sf):
    d = _t(spark, sf, "documents")
    return T.select_except(d, ["doc_id", "text"], prefix="n_")


@register("optional_column", sql="""
SELECT o_orderkey, o_totalprice, CAST(NULL AS VARCHAR) AS o_comment FROM orders""")
def q_optional_column(spark, sf):
    o = _t(spark, sf, "orders", ["o_orderkey", "o_totalprice"])
    return T.optional_column(T.optional_column(o, "o_totalprice"), "o_comment", "string")


@register("ordinal_encode", sql="""
SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS BIGINT) AS priority_code FROM orders""")
def q_ordinal_encode(spark, sf):
    o = _t(spark, sf, "orders", ["o_orderkey", "o_orderpriority"])
    return T.ordinal_encode(o, "o_orderpriority", "priority_code").select("o_orderkey", "priority_code")


@register("interaction_features", dbl=["l_quantity_x_l_discount", "l_extendedprice_x_l_tax"], sql="""
SELECT l_orderkey, l_linenumber, l_quantity * l_discount AS l_quantity_x_l_discount,
       l_extendedprice * l_tax AS l_extendedprice_x_l_tax FROM lineitem""")
def q_interaction_features(spark, sf):
    li = _t(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_extendedprice", "l_tax"])
    return T.interaction_features(li, [("l_quantity", "l_discount"), ("l_extendedprice", "l_tax")]).select(
        "l_orderkey", "l_linenumber", "l_quantity_x_l_discount", "l_extendedprice_x_l_tax")


@register("skew_transform", dbl=["value"], sql="SELECT event_id, ln(1 + value) AS value FROM events")
def q_skew_transform(spark, sf):
    return T.skew_transform(_t(spark, sf, "events", ["event_id", "value"]), ["value"])


# ---- scalar functions -------------------------------------------------------------------------

@register("regex_extract_trim", sql=r"""
SELECT doc_id, nullif(trim(regexp_extract(text, ',\s*([^\.]+)\.', 1)), '') AS title FROM documents""")
def q_regex_extract_trim(spark, sf):
    d = _t(spark, sf, "documents", ["doc_id", "text"])
    return d.select("doc_id", S.regex_extract_trim("text").alias("title"))


@register("first_char_default", sql="""
SELECT doc_id, substr(coalesce(nullif(lang, 'de'), 'U'), 1, 1) AS lang_initial FROM documents""")
def q_first_char_default(spark, sf):
    d = _t(spark, sf, "documents", ["doc_id", "lang"])
    return d.select("doc_id", S.first_char_default(F.nullif("lang", F.lit("de"))).alias("lang_initial"))


@register("compose_id", sql="SELECT CAST(entity AS VARCHAR) || '_' || CAST(i AS VARCHAR) AS id, sig FROM seq")
def q_compose_id(spark, sf):
    s = views.seq(spark, sf)
    return s.select(S.compose_id("entity", "i").alias("id"), "sig")


@register("split_id", sql="""
WITH c AS (SELECT CAST(entity AS VARCHAR) || '_' || CAST(i AS VARCHAR) AS id FROM seq)
SELECT id, CAST(regexp_extract(id, '^(.*)_[^_]*$', 1) AS BIGINT) AS entity,
       CAST(regexp_extract(id, '_([^_]*)$', 1) AS BIGINT) AS row_idx FROM c""")
def q_split_id(spark, sf):
    s = views.seq(spark, sf).select(S.compose_id("entity", "i").alias("id"))
    return s.select("id", S.split_id_entity("id").cast("long").alias("entity"), S.split_id_row("id").alias("row_idx"))


@register("file_stem_id", sql="""
WITH p AS (SELECT event_id, '/data/train/' || CAST(user_id AS VARCHAR) || '__signal.csv' AS path FROM events)
SELECT event_id, split_part(string_split(path, '/')[-1], '__', 1) AS stem FROM p""")
def q_file_stem_id(spark, sf):
    e = _t(spark, sf, "events", ["event_id", "user_id"])
    e = e.select("event_id", F.concat(F.lit("/data/train/"), F.col("user_id").cast("string"),
                                      F.lit("__signal.csv")).alias("path"))
    return e.select("event_id", S.file_stem_id("path").alias("stem"))


@register("math_exprs", dbl=["sq", "ex", "lg", "ab", "pw", "cl"], sql="""
SELECT event_id, sqrt(value) AS sq, exp(value / 100) AS ex, ln(value) AS lg, abs(value - 100) AS ab,
       CAST(floor(value) AS BIGINT) AS fl, power(value, 1.5) AS pw, greatest(least(value, 300.0), 10.0) AS cl
FROM events""")
def q_math_exprs(spark, sf):
    e = _t(spark, sf, "events", ["event_id", "value"])
    v = F.col("value")
    return e.select("event_id", F.sqrt(v).alias("sq"), F.exp(v / 100).alias("ex"), F.log(v).alias("lg"),
                    F.abs(v - 100).alias("ab"), F.floor(v).cast("long").alias("fl"),
                    F.pow(v, 1.5).alias("pw"), S.clip(v, 10.0, 300.0).alias("cl"))


@register("elementwise_cond", dbl=["out"], sql="SELECT entity, i, CASE WHEN known THEN sig ELSE prior END AS out FROM seq")
def q_elementwise_cond(spark, sf):
    s = views.seq(spark, sf)
    return s.select("entity", "i", F.when(F.col("known"), F.col("sig")).otherwise(F.col("prior")).alias("out"))


@register("null_coalesce", dbl=["out"], sql="SELECT entity, i, coalesce(sig_gap, prior) AS out FROM seq")
def q_null_coalesce(spark, sf):
    s = views.seq(spark, sf)
    return s.select("entity", "i", F.coalesce("sig_gap", "prior").alias("out"))


@register("array_dot_norm", dbl=["norm", "dot_next", "l2_next", "z0"], sql="""
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
z AS (SELECT vec_id, v, list_avg(v) AS m, sqrt(list_sum(list_transform(v, lambda x: x * x)) / len(v) - 0) AS dummy FROM e)
SELECT a.vec_id,
       sqrt(list_sum(list_transform(a.v, lambda x: x * x))) AS norm,
       list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS dot_next,
       sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS l2_next,
       (a.v[1] - list_avg(a.v)) / sqrt(list_sum(list_transform(a.v, lambda x: (x - list_avg(a.v)) * (x - list_avg(a.v)))) / len(a.v)) AS z0
FROM e AS a LEFT JOIN e AS b ON b.vec_id = a.vec_id + 1""")
def q_array_dot_norm(spark, sf):
    e = _t(spark, sf, "embeddings", ["vec_id", "embedding"]).select("vec_id", S.to_double_array("embedding").alias("v"))
    b = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("v").alias("w"))
    m, sd = S.array_moments("v")
    j = e.join(b, "vec_id", "left").withColumn("_m", m).withColumn("_sd", sd)
    return j.select("vec_id", S.array_l2_norm("v").alias("norm"), S.array_dot("v", "w").alias("dot_next"),
                    S.array_l2_distance("v", "w").alias("l2_next"),
                    S.array_znorm("v", F.col("_m"), F.col("_sd"))[0].alias("z0"))


@register("round_percent", sql="""
SELECT lang, round(avg(quality) * 100, 2) AS pct FROM docs WHERE is_train GROUP BY lang""")
def q_round_percent(spark, sf):
    d = views.docs(spark, sf).filter("is_train")
    return d.groupBy("lang").agg(S.round_percent(F.avg("quality")).alias("pct"))

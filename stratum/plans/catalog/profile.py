"""Exploratory table profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratum.operators import profile as P
from stratum.plans import views
from stratum.plans.registry import register
from stratum.sources.tables import load


def _docs(spark, sf):
    return views.docs(spark, sf).select("doc_id", "lang", "source", "n_chars", "quality", "toxic")


@register("profile_table", sql="""
WITH d AS (SELECT doc_id, lang, source, n_chars, quality, toxic FROM docs), n AS (SELECT count(*) AS n FROM d),
p AS (
  SELECT 'doc_id' AS column_name, 'long' AS dtype, count(DISTINCT doc_id) AS n_unique, count(*) FILTER (WHERE doc_id IS NULL) AS missing FROM d
  UNION ALL SELECT 'lang', 'string', count(DISTINCT lang), count(*) FILTER (WHERE lang IS NULL) FROM d
  UNION ALL SELECT 'source', 'string', count(DISTINCT source), count(*) FILTER (WHERE source IS NULL) FROM d
  UNION ALL SELECT 'n_chars', 'long', count(DISTINCT n_chars), count(*) FILTER (WHERE n_chars IS NULL) FROM d
  UNION ALL SELECT 'quality', 'int', count(DISTINCT quality), count(*) FILTER (WHERE quality IS NULL) FROM d
  UNION ALL SELECT 'toxic', 'int', count(DISTINCT toxic), count(*) FILTER (WHERE toxic IS NULL) FROM d)
SELECT column_name, dtype, n_unique, missing, round(CAST(missing AS DOUBLE) * 100 / n, 2) AS missing_pct FROM p, n""")
def q_profile_table(spark, sf):
    return P.profile_table(_docs(spark, sf))


@register("missing_pattern", sql="""
SELECT (CASE WHEN quality IS NULL THEN '1' ELSE '0' END) || (CASE WHEN toxic IS NULL THEN '1' ELSE '0' END)
       || (CASE WHEN doc_id % 5 = 0 THEN '1' ELSE '0' END) AS pattern, count(*) AS n_rows
FROM docs GROUP BY 1""")
def q_missing_pattern(spark, sf):
    d = _docs(spark, sf).withColumn("lang", F.when(F.col("doc_id") % 5 != 0, F.col("lang")))
    return P.missing_pattern(d, ["quality", "toxic", "lang"])


@register("classify_columns", sql="""
SELECT column_name, n_unique, CASE WHEN column_name IN ('o_custkey', 'o_totalprice') THEN 'numeric'
                                   WHEN n_unique <= 12 THEN 'categorical' ELSE 'other' END AS kind
FROM (SELECT 'o_custkey' AS column_name, count(DISTINCT o_custkey) AS n_unique FROM orders
      UNION ALL SELECT 'o_orderstatus', count(DISTINCT o_orderstatus) FROM orders
      UNION ALL SELECT 'o_totalprice', count(DISTINCT o_totalprice) FROM orders
      UNION ALL SELECT 'o_orderdate', count(DISTINCT o_orderdate) FROM orders
      UNION ALL SELECT 'o_orderpriority', count(DISTINCT o_orderpriority) FROM orders) AS t""")
def q_classify_columns(spark, sf):
    return P.classify_columns(load(spark, sf, "orders"), exclude=["o_orderkey"])


@register("quality_flags", dbl=["skew"], sql="""
WITH e AS (SELECT value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, event_type, props FROM events),
s AS (SELECT count(*) AS n, skewness(value) AS sv, skewness(k) AS sk, count(DISTINCT event_type) AS ue,
             count(DISTINCT props) AS up, count(*) FILTER (WHERE value IS NULL) AS mv, count(*) FILTER (WHERE k IS NULL) AS mk,
             count(*) FILTER (WHERE event_type IS NULL) AS me, count(*) FILTER (WHERE props IS NULL) AS mp FROM e)
SELECT 'value' AS column_name, sv AS skew, abs(sv) > 1.5 AS skewed, mv / n > 0.05 AS high_missing, false AS high_cardinality FROM s
UNION ALL SELECT 'k', sk, abs(sk) > 1.5, mk / n > 0.05, false FROM s
UNION ALL SELECT 'event_type', CAST(NULL AS DOUBLE), false, me / n > 0.05, ue > 30 FROM s
UNION ALL SELECT 'props', CAST(NULL AS DOUBLE), false, mp / n > 0.05, up > 30 FROM s""")
def q_quality_flags(spark, sf):
    e = load(spark, sf, "events", ["value", "props", "event_type"]).withColumn(
        "k", F.get_json_object("props", "$.k").cast("double"))
    return P.quality_flags(e, ["value", "k"], ["event_type", "props"])


@register("class_balance", dbl=["share", "imbalance_ratio"], sql="""
WITH c AS (SELECT quality, count(*) AS count FROM labels GROUP BY quality)
SELECT quality, count, count / sum(count) OVER () AS share, max(count) OVER () / min(count) OVER () AS imbalance_ratio FROM c""")
def q_class_balance(spark, sf):
    return P.class_balance(load(spark, sf, "labels", ["quality"]), "quality")


@register("histogram", dbl=["bin_lo"], sql="""
WITH mm AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
b AS (SELECT CAST(least(floor((o_totalprice - lo) / CASE WHEN (hi - lo) / 40 > 0 THEN (hi - lo) / 40 ELSE 1.0 END), 39) AS BIGINT) AS bin, lo, hi
      FROM orders CROSS JOIN mm)
SELECT bin, lo + bin * (hi - lo) / 40 AS bin_lo, count(*) AS count FROM b GROUP BY bin, lo, hi""")
def q_histogram(spark, sf):
    return P.histogram(load(spark, sf, "orders", ["o_totalprice"]), "o_totalprice", 40)


@register("rate_by_category", dbl=["rate", "ci_lo", "ci_hi", "base_rate", "lift"], sql="""
WITH d AS (SELECT lang, quality FROM docs WHERE is_train), b AS (SELECT avg(quality) AS base_rate FROM d),
g AS (SELECT lang, avg(quality) AS rate, count(*) AS n FROM d GROUP BY lang)
SELECT lang, rate, n, rate - 1.96 * sqrt(rate * (1 - rate) / n) AS ci_lo, rate + 1.96 * sqrt(rate * (1 - rate) / n) AS ci_hi,
       base_rate, rate - base_rate AS lift FROM g CROSS JOIN b""")
def q_rate_by_category(spark, sf):
    return P.rate_by_category(views.docs(spark, sf).filter("is_train"), "lang", "quality")


@register("box_stats_by_class", dbl=["q1", "q2", "q3", "whisker_lo", "whisker_hi"], sql="""
WITH d AS (SELECT quality, n_chars FROM docs WHERE is_train),
q AS (SELECT quality, quantile_cont(n_chars, 0.25) AS q1, median(n_chars) AS q2, quantile_cont(n_chars, 0.75) AS q3 FROM d GROUP BY quality)
SELECT q.quality, q1, q2, q3,
       CAST(min(CASE WHEN n_chars >= q1 - 1.5 * (q3 - q1) THEN n_chars END) AS DOUBLE) AS whisker_lo,
       CAST(max(CASE WHEN n_chars <= q3 + 1.5 * (q3 - q1) THEN n_chars END) AS DOUBLE) AS whisker_hi
FROM d JOIN q ON d.quality = q.quality GROUP BY q.quality, q1, q2, q3""")
def q_box_stats_by_class(spark, sf):
    return P.box_stats_by_class(views.docs(spark, sf).filter("is_train"), "quality", "n_chars")


LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("correlation_matrix", dbl=["corr"], sql="""
SELECT 'l_quantity' AS col_a, 'l_extendedprice' AS col_b, corr(l_quantity, l_extendedprice) AS corr FROM lineitem
UNION ALL SELECT 'l_quantity', 'l_discount', corr(l_quantity, l_discount) FROM lineitem
UNION ALL SELECT 'l_quantity', 'l_tax', corr(l_quantity, l_tax) FROM lineitem
UNION ALL SELECT 'l_extendedprice', 'l_discount', corr(l_extendedprice, l_discount) FROM lineitem
UNION ALL SELECT 'l_extendedprice', 'l_tax', corr(l_extendedprice, l_tax) FROM lineitem
UNION ALL SELECT 'l_discount', 'l_tax', corr(l_discount, l_tax) FROM lineitem""")
def q_correlation_matrix(spark, sf):
    return P.correlation_matrix(load(spark, sf, "lineitem", LI_NUM), LI_NUM)


@register("target_correlation_rank", dbl=["corr"], sql="""
WITH c AS (SELECT 'l_quantity' AS feature, corr(l_quantity, l_extendedprice) AS corr FROM lineitem
           UNION ALL SELECT 'l_discount', corr(l_discount, l_extendedprice) FROM lineitem
           UNION ALL SELECT 'l_tax', corr(l_tax, l_extendedprice) FROM lineitem)
SELECT feature, corr, row_number() OVER (ORDER BY abs(corr) DESC, feature) AS rank FROM c""")
def q_target_correlation_rank(spark, sf):
    return P.target_correlation_rank(load(spark, sf, "lineitem", LI_NUM), ["l_quantity", "l_discount", "l_tax"],
                                     "l_extendedprice")

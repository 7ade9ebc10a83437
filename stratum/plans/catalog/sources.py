"""Sources and sinks over files derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratum.operators import publish as PB
from stratum.plans import views
from stratum.plans.registry import register
from stratum.sources import files as FS
from stratum.sources.tables import load

CUSTOMER_SCHEMA = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@register("scan_table", dbl=["c_acctbal"], sql="SELECT * FROM customer")
def q_scan_table(spark, sf):
    path = FS.fresh_dir(spark, "customer-csv")
    FS.sink_table(load(spark, sf, "customer"), path)
    return FS.scan_table(spark, path, CUSTOMER_SCHEMA)


@register("scan_multiline_csv", sql="SELECT doc_id, md5(text) AS text_md5, length(text) AS n_len FROM documents")
def q_scan_multiline_csv(spark, sf):
    path = FS.fresh_dir(spark, "documents-csv")
    d = load(spark, sf, "documents", ["doc_id", "text"])
    d.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)
    r = FS.scan_multiline_csv(spark, path, "doc_id long, text string")
    return r.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("n_len"))


@register("scan_entity_files", dbl=["value"], sql="SELECT CAST(user_id AS VARCHAR) AS entity, event_id, value FROM events")
def q_scan_entity_files(spark, sf):
    root = FS.fresh_dir(spark, "entity-files")
    e = load(spark, sf, "events", ["user_id", "event_id", "value"])
    # one folder per entity (``wid=<id>``); the reader takes the id from the path
    FS.sink_entity_files(e.withColumn("wid", F.col("user_id")), root, "wid")
    r = FS.scan_entity_files(spark, root, ".csv", "user_id long, event_id long, value double",
                             entity_pattern=r"/wid=([^/]+)/")
    return r.select("entity", "event_id", "value")


@register("scan_projected", sql="""
SELECT l_orderkey, l_quantity, l_discount FROM lineitem WHERE l_orderkey IS NOT NULL AND l_quantity IS NOT NULL AND l_discount IS NOT NULL""")
def q_scan_projected(spark, sf):
    return FS.scan_projected(load(spark, sf, "lineitem"), ["l_orderkey", "l_quantity", "l_discount"])


@register("scan_paired", sql="SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def q_scan_paired(spark, sf):
    return FS.scan_paired(load(spark, sf, "documents", ["doc_id", "lang"]), load(spark, sf, "labels", ["doc_id"]), "doc_id")


@register("scan_tolerant", sql="""
SELECT CAST(user_id AS VARCHAR) AS entity, count(*) AS n_rows, count(*) FILTER (event_type = 'error') AS n_corrupt,
       CAST(sum(CASE WHEN event_type <> 'error' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END) AS BIGINT) AS sum_k,
       CASE WHEN count(*) FILTER (event_type = 'error') > 0 THEN 'corrupt' END AS failure
FROM events GROUP BY user_id
UNION ALL SELECT 'never-written', 0, 0, NULL, 'missing'""")
def q_scan_tolerant(spark, sf):
    path = FS.fresh_dir(spark, "events-json")
    e = load(spark, sf, "events", ["event_id", "user_id", "event_type", "props"])
    # error events are written as truncated JSON: the reader must quarantine, not fail
    line = F.when(F.col("event_type") == "error", F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "k": ')))\
        .otherwise(F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "k": '),
                            F.get_json_object("props", "$.k"), F.lit("}")))
    rows = e.select(line.alias("value"), F.col("user_id").alias("entity"))
    FS.sink_entity_files(rows, path, "entity", "text")
    wanted = rows.select(F.col("entity").cast("string")).distinct().union(spark.createDataFrame([("never-written",)], "entity string"))
    r = FS.scan_entities_tolerant(spark, path, "event_id long, k long", "entity")
    return FS.entity_failures(r, wanted, "entity", "k").select("entity", "n_rows", "n_corrupt", F.col("total").alias("sum_k"), "failure")


@register("scan_limit_entities", sql="""
WITH ids AS (SELECT DISTINCT user_id FROM events),
f AS (SELECT user_id FROM ids ORDER BY user_id LIMIT 20),
s AS (SELECT user_id FROM ids ORDER BY md5('7|' || CAST(user_id AS VARCHAR)), user_id LIMIT 20)
SELECT 'first' AS mode, event_id, user_id FROM events WHERE user_id IN (SELECT user_id FROM f)
UNION ALL SELECT 'sample', event_id, user_id FROM events WHERE user_id IN (SELECT user_id FROM s)""")
def q_scan_limit_entities(spark, sf):
    e = load(spark, sf, "events", ["event_id", "user_id"])
    first = FS.scan_limit_entities(e, "user_id", 20).withColumn("mode", F.lit("first"))
    samp = FS.scan_limit_entities(e, "user_id", 20, seed=7).withColumn("mode", F.lit("sample"))
    return first.unionByName(samp).select("mode", "event_id", "user_id")


@register("sink_table", dbl=["rmse"], sql="SELECT model, fold, rmse, n_rows FROM fold_scores")
def q_sink_table(spark, sf):
    path = FS.fresh_dir(spark, "sink")
    r = views.fold_scores(spark, sf)
    FS.sink_table(r, path)
    return spark.read.schema("model string, fold long, rmse double, n_rows long").option("header", True).csv(path)


@register("sink_fanout", dbl=["w", "mean_blend"], sql="""
SELECT w.w, count(*) AS n_rows, avg(w.w * quality + (1 - w.w) * toxic) AS mean_blend
FROM labels CROSS JOIN (VALUES (0.0), (0.25), (0.5), (0.75), (1.0)) AS w(w) GROUP BY w.w""")
def q_sink_fanout(spark, sf):
    path = FS.fresh_dir(spark, "fanout")
    lab = load(spark, sf, "labels", ["doc_id", "quality", "toxic"])
    x = PB.cross_weights(lab, [0.0, 0.25, 0.5, 0.75, 1.0]).withColumn(
        "blend", F.col("w") * F.col("quality") + (1 - F.col("w")) * F.col("toxic"))
    FS.sink_fanout(x.select("doc_id", "w", "blend"), path, "w")
    back = spark.read.parquet(path)
    return back.groupBy("w").agg(F.count(F.lit(1)).alias("n_rows"), F.avg("blend").alias("mean_blend"))


@register("append_run_log", stored=True, dbl=["score"], sql="""
WITH r AS (SELECT 'loop-' || CAST(loop AS VARCHAR) AS run_date, variant || ' ' || model_family || ' ' || stage AS message,
                  cv_mean AS score, 'complete' AS status, loop < 3 AS first_batch FROM runs)
SELECT CAST(row_number() OVER (ORDER BY first_batch DESC, run_date, message) - 1 AS BIGINT) AS seq, run_date, message, score, status FROM r""")
def q_append_run_log(spark, sf):
    path = FS.fresh_dir(spark, "runlog")
    runs = views.runs(spark, sf)
    rows = runs.select(F.concat(F.lit("loop-"), F.col("loop").cast("string")).alias("run_date"),
                       F.concat_ws(" ", "variant", "model_family", "stage").alias("message"),
                       F.col("cv_mean").alias("score"), F.lit("complete").alias("status"))
    FS.append_run_log(spark, path, rows.filter(F.col("loop") < 3))
    return FS.append_run_log(spark, path, rows.filter(F.col("loop") >= 3))

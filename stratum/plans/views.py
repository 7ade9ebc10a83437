"""Binding views: the reference's data model expressed over the driver tables.

* ``seq``  — entity sequences from ``events``: one row per (entity, i).
* ``tmpl`` — template curves from ``part``: (tid, x, y, lab) per brand.
* ``pts``  — spatial points from ``embeddings``: (grp, x, y, s1..s6).
* ``docs`` — ``documents`` left-joined to ``labels`` (train = has a label).
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators.sequence import block_of, row_index
from stratum.session import scratch_path
from stratum.sources.tables import load

EPOCH = "2024-01-01 00:00:00"


def hours_since_epoch(ts: str) -> F.Column:
    """Hours since 2024-01-01, computed on TIMESTAMP_NTZ (no time-zone shift)."""
    start = F.lit(EPOCH).cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", start, F.col(ts).cast("timestamp_ntz")) / F.lit(3.6e9)


_stored: ContextVar[dict | None] = ContextVar("stored", default=None)


@contextmanager
def stored_views():
    """Inside, ``seq`` is written once and every branch of a query reads the stored copy."""
    token = _stored.set({})
    try:
        yield
    finally:
        _stored.reset(token)


def store_sequence(df: DataFrame, entity: str, idx: str) -> DataFrame:
    """``df`` as a table bucketed and sorted by (entity, block of ``idx``): scans by block need no exchange.

    A long entity has many blocks, so it fills many buckets.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"stratum_sequence_{uuid.uuid4().hex}"
    (df.withColumn("_blk", block_of(idx)).repartition(n, entity, "_blk").write.bucketBy(n, entity, "_blk").sortBy(entity, "_blk", idx)
     .option("path", scratch_path(spark, name)).format("parquet").saveAsTable(name))
    return spark.table(name)


def seq(spark: SparkSession, sf_dir: str, blocks: bool = False) -> DataFrame:
    """Entity sequence view, stored once per query inside ``stored_views``.

    ``blocks`` keeps the block column of the stored table, by which scans over
    ``i`` find their rows already together.
    """
    held = _stored.get()
    if held is None:
        return _seq(spark, sf_dir)
    if sf_dir not in held:
        held[sf_dir] = store_sequence(_seq(spark, sf_dir), "entity", "i")
    return held[sf_dir] if blocks else held[sf_dir].drop("_blk")


def _seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequence, numbered.

    Columns: entity, event_id, i, n, nkn, pos, k, sig, sig_gap, known, y_in, tid, prior.
    ``known`` is the first 70 % of each entity (``10*i < 7*n``), a prefix of ``nkn``
    rows, so positions in either zone need no window; ``y_in`` is the label
    masked to the known zone (null defines the eval zone).
    """
    ev = load(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    ev = ev.select(
        F.col("user_id").alias("entity"), "event_id", "ts",
        hours_since_epoch("ts").alias("pos"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        F.col("value").alias("sig"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("sig_gap"),
        F.concat(F.lit("Brand#"), (F.col("user_id") % 25 + 1).cast("string")).alias("tid"),
        (F.lit(900.0) + F.col("value") / 5).alias("prior"),
    )
    # two-level numbering: chunks are calendar days of the order key
    ev = row_index(ev, "entity", ["ts", "event_id"], "i", chunk=F.to_date("ts"), count_col="n")
    known = (F.col("i") * 10) < (F.col("n") * 7)
    return ev.select("entity", "event_id", "i", "n", F.floor((F.col("n") * 7 + 9) / 10).alias("nkn"), "pos", "k", "sig", "sig_gap",
                     known.alias("known"), F.when(known, F.col("sig")).alias("y_in"),
                     "tid", "prior")


def tmpl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Template curves: per (brand, price) the mean size and the smallest type."""
    p = load(spark, sf_dir, "part", ["p_brand", "p_retailprice", "p_size", "p_type"])
    return (p.groupBy(F.col("p_brand").alias("tid"), F.col("p_retailprice").alias("x"))
            .agg(F.avg("p_size").alias("y"), F.min("p_type").alias("lab")))


def pts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spatial points: first 8 embedding dimensions as (x, y, s1..s6)."""
    e = load(spark, sf_dir, "embeddings", ["vec_id", "label", "embedding"])
    cols = [F.col("embedding")[j].cast("double").alias(n)
            for j, n in enumerate(["x", "y", "s1", "s2", "s3", "s4", "s5", "s6"])]
    return e.select("vec_id", F.col("label").cast("long").alias("grp"), *cols)


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with labels attached; ``is_train`` = has a label."""
    d = load(spark, sf_dir, "documents", ["doc_id", "lang", "source", "n_chars"])
    lab = load(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"])
    return (d.join(lab, "doc_id", "left")
            .withColumn("is_train", F.col("quality").isNotNull()))


# ---- derived run tables: baseline scores per group fold --------------------------------------

def eval_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long table (entity, i, sig, model, p) of three baselines on the eval zone."""
    from stratum.operators import regression
    from stratum.operators.aggregates import boundary_row
    s = seq(spark, sf_dir)
    ols = regression.group_ols_2(s, "entity", "pos", "k", "y_in", "known", "p")
    last = boundary_row(s, "entity", "i", ["sig"], F.col("known")).select("entity", F.col("last_sig"))
    mean = s.filter("known").groupBy("entity").agg(F.avg("sig").alias("mean_sig"))
    ev = ols.select("entity", "i", "sig", "p").join(last, "entity").join(mean, "entity")
    return ev.select("entity", "i", "sig", F.explode(F.array(
        F.struct(F.lit("ols").alias("model"), F.col("p").alias("p")),
        F.struct(F.lit("last").alias("model"), F.col("last_sig").alias("p")),
        F.struct(F.lit("mean").alias("model"), F.col("mean_sig").alias("p")))).alias("_m")
    ).select("entity", "i", "sig", "_m.model", "_m.p")


def fold_scores(spark: SparkSession, sf_dir: str, k: int = 5) -> DataFrame:
    """RMSE per (model, fold) with entity-grouped folds."""
    from stratum.operators.splits import group_kfold
    s = seq(spark, sf_dir)
    folds = group_kfold(s, "entity", k).select("entity", "fold")
    ev = eval_predictions(spark, sf_dir).join(folds, "entity")
    d = F.col("sig") - F.col("p")
    return ev.groupBy("model", "fold").agg(F.sqrt(F.avg(d * d)).alias("rmse"), F.count(F.lit(1)).alias("n_rows"))


def runs(spark: SparkSession, sf_dir: str, k: int = 5) -> DataFrame:
    """Run log: per (variant, loop = held-out fold) the CV mean/std over the other folds and the holdout score."""
    from pyspark.sql import Window
    fs = fold_scores(spark, sf_dir, k)
    w = Window.partitionBy("model")  # k rows per model
    s1 = F.sum("rmse").over(w) - F.col("rmse")
    s2 = F.sum(F.col("rmse") * F.col("rmse")).over(w) - F.col("rmse") * F.col("rmse")
    m = s1 / (k - 1)
    return fs.select(
        F.col("model").alias("variant"),
        F.when(F.col("model") == "ols", F.lit("linear")).otherwise(F.lit("naive")).alias("model_family"),
        F.lit("cv").alias("stage"), F.col("fold").alias("loop"), m.alias("cv_mean"),
        F.sqrt(F.greatest(s2 / (k - 1) - m * m, F.lit(0.0))).alias("cv_std"),
        F.col("rmse").alias("holdout_score"))

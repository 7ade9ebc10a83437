"""File sources and sinks: CSV (incl. multi-line), per-entity files, tolerant JSON.

Sinks write under a caller-given folder; tests and the registered queries
use a fresh folder under the session's shared checkpoint location
(``spark.checkpoint.dir``), never a machine-local path on a cluster.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.session import scratch_path


def fresh_dir(spark: SparkSession, tag: str) -> str:
    return scratch_path(spark, f"{tag}-{uuid.uuid4().hex[:12]}")


def scan_table(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "csv") -> DataFrame:
    """Typed read: a declared schema, no inference; CSV with a header row."""
    r = spark.read.schema(schema)
    if fmt == "csv":
        return r.option("header", True).option("mode", "FAILFAST").csv(path)
    return r.format(fmt).load(path)


def scan_multiline_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV whose quoted fields contain newlines and doubled quotes."""
    return (spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("quote", '"').option("escape", '"').csv(path))


def scan_entity_files(spark: SparkSession, root: str, suffix: str, schema: T.StructType | str,
                      entity_pattern: str | None = None) -> DataFrame:
    """Read every ``*{suffix}`` file under ``root``; the entity id comes from the file path.

    Partition discovery is off (``recursiveFileLookup``) so the id is taken
    from the path itself, as the per-entity file layout defines it.
    """
    pat = entity_pattern or r"([^/=]+)" + suffix.replace(".", r"\.")
    df = (spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True)
          .option("pathGlobFilter", f"*{suffix}").csv(root))
    return df.withColumn("entity", F.regexp_extract(F.col("_metadata.file_path"), pat, 1))


def entity_ids(df: DataFrame, entity: str = "entity") -> DataFrame:
    """Sorted distinct entity ids."""
    return df.select(entity).distinct().orderBy(entity)


def scan_projected(df: DataFrame, cols) -> DataFrame:
    """Only the listed columns (pruned at the scan), rows with a null dropped."""
    return df.select(*cols).dropna()


def scan_paired(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keep only entities present in both inputs."""
    return a.join(b.select(key).distinct(), key, "left_semi")


def scan_tolerant_json(spark: SparkSession, path: str, schema: T.StructType, corrupt_col: str = "_corrupt") -> DataFrame:
    """PERMISSIVE JSON read: unparseable lines are kept in ``corrupt_col`` instead of failing the job."""
    sch = schema.add(T.StructField(corrupt_col, T.StringType(), True))
    return (spark.read.schema(sch).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col)
            .json(path))


def scan_entities_tolerant(spark: SparkSession, path: str, schema: T.StructType | str, entity: str, corrupt_col: str = "_corrupt") -> DataFrame:
    """JSON files of one folder per entity (``entity=...``): rows that cannot be parsed are kept in ``corrupt_col``.

    Files that cannot be read at all give no rows instead of failing the job;
    ``entity_failures`` names their entities.
    """
    base = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    sch = T.StructType([*base.fields, T.StructField(corrupt_col, T.StringType()), T.StructField(entity, T.StringType())])
    return (spark.read.schema(sch).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col)
            .option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).option("basePath", path).json(path))


def entity_failures(rows: DataFrame, wanted: DataFrame, entity: str, value: str, corrupt_col: str = "_corrupt") -> DataFrame:
    """Per wanted entity: n_rows, n_corrupt, the ``total`` of ``value`` over sound rows, and why it failed (null if it did not).

    ``missing``: no readable row at all (no file, an empty or an unreadable one); ``corrupt``: some rows could not be parsed.
    """
    bad = F.col(corrupt_col).isNotNull()
    seen = rows.groupBy(F.col(entity).alias("_e")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(bad).alias("n_corrupt"), F.sum(F.when(~bad, F.col(value))).cast("long").alias("total"))
    j = wanted.select(entity).join(seen, F.col(entity) == F.col("_e"), "left")
    n, c = F.coalesce("n_rows", F.lit(0)), F.coalesce("n_corrupt", F.lit(0))
    return j.select(entity, n.cast("long").alias("n_rows"), c.cast("long").alias("n_corrupt"), "total",
                    F.when(n == 0, "missing").when(c > 0, "corrupt").alias("failure"))


def quarantine_report(df: DataFrame, corrupt_col: str = "_corrupt") -> DataFrame:
    """Rows parsed vs quarantined.  A data column is referenced too: Spark refuses
    queries over raw JSON/CSV that read only the corrupt-record column."""
    data = [c for c in df.columns if c != corrupt_col][0]
    return (df.groupBy(F.col(corrupt_col).isNotNull().alias("is_corrupt"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count(data).alias("n_with_value")))


def scan_limit_entities(df: DataFrame, entity: str, n: int, seed: int | None = None) -> DataFrame:
    """Rows of the first ``n`` entities by id, or of ``n`` entities in seeded md5 order."""
    ids = df.select(entity).distinct()
    order = F.md5(F.concat(F.lit(f"{seed}|"), F.col(entity).cast("string"))) if seed is not None else F.col(entity)
    chosen = ids.orderBy(order, F.col(entity)).limit(n)  # n entity ids: the limit is the feature
    return df.join(chosen, entity, "left_semi")


def sink_table(df: DataFrame, path: str, fmt: str = "csv") -> str:
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def sink_fanout(df: DataFrame, path: str, by: str, fmt: str = "parquet") -> str:
    """One output folder per value of ``by`` (e.g. per candidate weight)."""
    df.write.mode("overwrite").partitionBy(by).format(fmt).save(path)
    return path


def sink_entity_files(df: DataFrame, path: str, entity: str, fmt: str = "csv", file_rows: int = 1 << 20) -> str:
    """One folder per entity (``entity=<id>``), with one file unless the entity has more than ``file_rows`` rows.

    The rows of an entity meet before they are written, else each task would
    open a file per entity; those of a long entity are dealt out to several
    tasks.  Tasks move their finished files into place themselves (commit
    algorithm 2): algorithm 1 leaves that to the driver, file by file.
    """
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    long = df.groupBy(F.col(entity).alias("_e")).agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_c") > file_rows)
    long = long.select("_e", F.ceil(F.col("_c") / file_rows).alias("_files"))    # at most one in file_rows of the rows
    dealt = (df.withColumn("_part", F.spark_partition_id()).join(F.broadcast(long), F.col(entity) == F.col("_e"), "left")
             .withColumn("_file", F.pmod("_part", F.coalesce("_files", F.lit(1)))))
    # an explicit count: adaptive execution would pack very many small files by their few bytes into few tasks
    w = dealt.repartition(n, entity, "_file").select(*df.columns).write.mode("overwrite").partitionBy(entity)
    w = w.option("mapreduce.fileoutputcommitter.algorithm.version", 2)
    (w.option("header", True) if fmt == "csv" else w).format(fmt).save(path)
    return path


RUN_LOG_SCHEMA = "seq long, run_date string, message string, score double, status string"


def append_run_log(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """Append rows (run_date, message, score, status) to a run log; created on first use.

    ``seq`` numbers rows after the existing ones so reads come back oldest first.
    """
    try:
        prev = spark.read.schema(RUN_LOG_SCHEMA).option("header", True).csv(path)
        start = prev.agg(F.coalesce(F.max("seq"), F.lit(-1)).alias("_m"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":       # only a missing log is a first write
            raise
        start = spark.createDataFrame([(-1,)], "_m long")
    from stratum.operators.scan import range_scan
    placed = range_scan(rows.select("run_date", "message", "score", "status"), [], [F.col("run_date").asc(), F.col("message").asc()], "_i")
    new = placed.crossJoin(F.broadcast(start)).select(
        (F.col("_m") + F.col("_i") + 1).cast("long").alias("seq"), "run_date", "message", "score", "status")
    new.write.mode("append").option("header", True).csv(path)
    return spark.read.schema(RUN_LOG_SCHEMA).option("header", True).csv(path).orderBy("seq")


"""Entity-file sources: batch scan and the incremental (streaming) path agree."""

import os
import tempfile

from pyspark.sql import functions as F

from stratum.operators.aggregates import entity_summary
from stratum.sources import files as FS
from stratum.streaming import apply_to_new_entity_files


def test_entity_files_batch_and_stream(spark):
    root = tempfile.mkdtemp(prefix="stratum-ent-")
    rows = [(e, i, float(i * (e + 1))) for e in range(4) for i in range(10)]
    df = spark.createDataFrame(rows, "user_id long, event_id long, value double")
    df.withColumn("wid", F.col("user_id")).write.mode("overwrite").partitionBy("wid").option("header", True).csv(root)
    schema = "user_id long, event_id long, value double"
    b = FS.scan_entity_files(spark, root, ".csv", schema, entity_pattern=r"/wid=([^/]+)/")
    assert sorted(r[0] for r in FS.entity_ids(b).collect()) == ["0", "1", "2", "3"]
    out = os.path.join(tempfile.mkdtemp(prefix="stratum-out-"), "o")
    ck = os.path.join(tempfile.mkdtemp(prefix="stratum-sck-"), "c")
    apply_to_new_entity_files(spark, root, schema, lambda d: entity_summary(d, "entity", ["value"]), out, ck)
    got = spark.read.parquet(out).select("entity", "n", "max_value").orderBy("entity").collect()
    assert [(r["entity"], r["n"], r["max_value"]) for r in got] == [("0", 10, 9.0), ("1", 10, 18.0), ("2", 10, 27.0), ("3", 10, 36.0)]


def test_tolerant_json(spark):
    from pyspark.sql import types as T
    path = tempfile.mkdtemp(prefix="stratum-json-")
    spark.createDataFrame([('{"a": 1}',), ('{"a": ',), ('{"a": 3}',)], "value string").write.mode("overwrite").text(path)
    r = FS.scan_tolerant_json(spark, path, T.StructType([T.StructField("a", T.LongType())]))
    rep = {x["is_corrupt"]: x["n_rows"] for x in FS.quarantine_report(r).collect()}
    assert rep == {False: 2, True: 1}


def test_failed_entities_are_named(spark, tmp_path):
    """A truncated, an empty, an unreadable and a missing file are reported; the sound ones are read."""
    def write(entity, name, data):
        d = tmp_path / f"entity={entity}"
        d.mkdir(exist_ok=True)
        (d / name).write_bytes(data)
    write("good", "a.json", b'{"event_id": 1, "k": 4}\n{"event_id": 2, "k": 5}\n')
    write("truncated", "a.json", b'{"event_id": 1, "k": 7}\n{"event_id": 2, "k"')
    write("empty", "a.json", b"")
    write("unreadable", "a.json.gz", b"\x1f\x8b\x08 this is no gzip stream")
    write("both", "a.json", b'{"event_id": 1, "k": 1}\n')
    write("both", "b.json.gz", b"\x1f\x8b\x08 nor is this")
    wanted = spark.createDataFrame([(e,) for e in ("good", "truncated", "empty", "unreadable", "both", "absent")], "entity string")
    rows = FS.scan_entities_tolerant(spark, str(tmp_path), "event_id long, k long", "entity")
    got = {r["entity"]: tuple(r)[1:] for r in FS.entity_failures(rows, wanted, "entity", "k").collect()}
    assert got == {"good": (2, 0, 9, None), "truncated": (2, 1, 7, "corrupt"), "empty": (0, 0, None, "missing"),
                   "unreadable": (0, 0, None, "missing"), "both": (1, 0, 1, None), "absent": (0, 0, None, "missing")}


def test_entity_files_are_few(spark, tmp_path):
    """One file per entity, however many tasks hold its rows; a long entity gets several."""
    df = spark.range(0, 400, 1, 8).selectExpr("id % 5 AS wid", "id AS event_id")
    df = df.unionByName(spark.createDataFrame([(None, 1000)], "wid long, event_id long"))
    short, long = str(tmp_path / "short"), str(tmp_path / "long")
    FS.sink_entity_files(df, short, "wid")
    FS.sink_entity_files(df, long, "wid", file_rows=40)
    files = {p: sum(n.endswith(".csv") for _, _, names in os.walk(p) for n in names) for p in (short, long)}
    assert files[short] == 6 and files[long] > 6
    for p in (short, long):
        got = FS.scan_entity_files(spark, p, ".csv", "event_id long", entity_pattern=r"/wid=([^/]+)/")
        want = [(str(i % 5), i) for i in range(400)] + [("__HIVE_DEFAULT_PARTITION__", 1000)]
        assert sorted(map(tuple, got.select("entity", "event_id").collect())) == sorted(want)


def test_tolerant_query_moves_no_file_on_the_driver(spark, monkeypatch):
    """The query writes its entity files through the clustered sink."""
    import __spark_entry__ as E
    calls, sink = [], FS.sink_entity_files
    monkeypatch.setattr(FS, "sink_entity_files", lambda *a: calls.append(a[2]) or sink(*a))
    E.queries()["scan_tolerant"](spark, "/root/testdata/sf0.001")
    assert calls == ["entity"]

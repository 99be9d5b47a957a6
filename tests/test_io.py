"""Sources and sinks: replays, failures, and stores outside Spark."""

import json

import pytest
from pyspark.sql import functions as F

from millrace import session
from millrace.operators import sinks
from millrace.streaming import live
from millrace.sources import custom, logs, tables


def test_upsert_replay_changes_nothing(spark):
    path = session.scratch(spark, "keyed")
    first = spark.createDataFrame([("a", 1, 1), ("b", 2, 2), ("a", 3, 3)], "id STRING, at BIGINT, vc INT")
    later = spark.createDataFrame([("b", 4, 9), ("c", 5, 5)], "id STRING, at BIGINT, vc INT")
    for batch_id, batch in [(0, first), (1, later), (1, later)]:
        sinks.upsert(batch, batch_id, path, "id", "at")
    want = {("a", 3, 3), ("b", 4, 9), ("c", 5, 5)}
    assert {tuple(r) for r in sinks.upserted(spark, path, "id", "at").collect()} == want
    for batch_id, vc in ((2, 0), (3, 7)):
        sinks.compact(spark, path, "id", "at")
        sinks.upsert(spark.createDataFrame([("c", 4 + batch_id, vc)], "id STRING, at BIGINT, vc INT"), batch_id, path, "id", "at")
    want = {("a", 3, 3), ("b", 4, 9), ("c", 7, 7)}
    table = sinks.upserted(spark, path, "id", "at")
    assert {tuple(r) for r in table.collect()} == want
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert any(p.startswith("isnotnull(batch") for p in plan.split("PartitionFilters: [")[1:])  # only later batches are read


def test_sql_upsert_sends_newest_in_batches(spark, tmp_path):
    folder = str(tmp_path)

    class FakeConnection:
        """A DB-API connection that appends what it is told to a file."""

        def __init__(self, folder):
            import uuid
            self.file = open(f"{folder}/{uuid.uuid4().hex}", "w")

        def cursor(self):
            return self

        def executemany(self, statement, parameters):
            self.file.write(json.dumps([statement, parameters]) + "\n")

        def commit(self):
            self.file.flush()

        def close(self):
            self.file.close()

    df = spark.range(1000).select((F.col("id") % 10).alias("k"), F.col("id").alias("at"), (F.col("id") * 2).alias("vc"))
    connect, put, close = sinks.sql_upsert(lambda: FakeConnection(folder), "UPSERT", ["k", "vc"])
    sinks.upsert_external(df, "k", "at", connect, put, close, batch_size=2)
    calls = [json.loads(line) for f in tmp_path.iterdir() for line in f.read_text().splitlines()]
    assert all(statement == "UPSERT" and len(rows) <= 2 for statement, rows in calls)
    assert sorted(tuple(r) for _, rows in calls for r in rows) == [(k, 2 * (990 + k)) for k in range(10)]


def test_csv_table_fails_on_a_bad_number(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("a,1,2\nb,x,3\n")
    df = logs.csv_table(spark, str(tmp_path), "id STRING, ts BIGINT, vc INT", "bad_sensor")
    with pytest.raises(Exception, match="MALFORMED_RECORD|BAD_DATA"):
        df.collect()


def test_folder_of_text_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\n")
    (tmp_path / "b.txt").write_text("three\n\nfour")
    assert sorted(r.value for r in logs.text_lines(spark, str(tmp_path)).collect()) == ["", "four", "one", "three", "two"]


def _values(spark, path):
    return sorted(r.value for r in spark.read.format("record_log").option("path", path).load().collect())


def _append(df, path, mode="append"):
    df.write.format("record_log").mode(mode).option("path", path).save()


def test_only_committed_files_count(spark, sf, tmp_path):
    custom.register(spark)
    path = str(tmp_path / "out")
    df = tables.events(spark, sf).select(F.col("event_id").cast("string").alias("value"))
    _append(df, path)
    failing = tables.events(spark, sf).select(F.when(F.col("event_id") > 5, F.raise_error(F.lit("no"))).otherwise("x").alias("value"))
    with pytest.raises(Exception, match="no"):
        _append(failing, path)
    assert len(_values(spark, path)) == 1000
    _append(df, path)
    assert len(_values(spark, path)) == 2000
    _append(spark.createDataFrame([("é\nx",), ("",)], "value STRING"), path, "overwrite")
    assert _values(spark, path) == ["", "é\nx"]


def test_record_stream_reads_each_commit_once(spark, tmp_path):
    """Also if its files' names sort before those read earlier."""
    custom.register(spark)
    path, checkpoint, out = (str(tmp_path / x) for x in ("log", "progress", "emitted"))
    for i in range(4):
        _append(spark.createDataFrame([(f"r{i}",), (f"s{i}",)], "value STRING"), path)
        stream = spark.readStream.format("record_log").option("path", path).load()
        got = live.drain(stream, "append", checkpoint=checkpoint, out=out)
    assert sorted(r.value for r in got.collect()) == sorted(f"{c}{i}" for c in "rs" for i in range(4))


def test_committed_stream_batch_counts_once(tmp_path):
    folder = custom.Folder(str(tmp_path))
    for files in (["a"], ["b"]):
        folder.commit(files, batch=3)
    assert folder.live() == ["a"]


def test_shared_folder_is_required_on_a_cluster():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(Session())

"""Hand-worked and brute-force answers for single operators."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.functions import udfs
from millrace.operators import joins, patterns, rows, running, uniques, windows
from millrace.sources import records, tables
from millrace.streaming import live, processors

T0 = datetime(2024, 1, 1)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def timed(spark, data, schema="k STRING, kind STRING, s INT, n INT"):
    return spark.createDataFrame(data, schema).withColumn(
        "ts", F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, s)")
    )


def test_words(spark):
    lines = ["a b", " a  b ", "", "   ", "x  "]
    got = spark.createDataFrame([(x,) for x in lines], "v STRING").select("v", rows.words(F.col("v")).alias("w"))
    assert {r.v: r.w for r in got.collect()} == {
        "a b": ["a", "b"], " a  b ": ["", "a", "", "b"], "": [""], "   ": [], "x  ": ["x"],
    }


def test_table_function_splits_alike(spark):
    spark.udtf.register("split_words", udfs.word_table())
    for line in ["a b", " a  b ", "", "   ", "x  "]:
        df = spark.createDataFrame([(line,)], "v STRING")
        plain = df.select(F.explode(rows.words(F.col("v")))).count()
        assert spark.sql("SELECT w.* FROM {d}, LATERAL split_words(v) w", d=df).count() == plain


def test_word_count(spark):
    text = ["hello java", "hello flow", "hello data", "word count", "java flow"]
    df = spark.createDataFrame([(x,) for x in text], "v STRING")
    counts = {r.word: r.ct for r in running.final_count(rows.explode_words(df, "v"), "word").collect()}
    assert counts == {"hello": 3, "java": 2, "flow": 2, "data": 1, "word": 1, "count": 1}


def test_records_keep_empty_fields_and_ignore_extra(spark):
    df = spark.createDataFrame([("7,create,,100,x",)], "value STRING")
    assert tuple(records.parse(df, records.ORDER).first()) == (7, "create", "", 100)


def test_malformed_number_fails(spark):
    df = spark.createDataFrame([("a,notanumber,3",)], "value STRING")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        records.parse(df, records.SENSOR).collect()


def test_split_output_leaves_null_out(spark):
    df = spark.createDataFrame([("a", 30), ("b", 29), ("c", None)], "id STRING, vc INT")
    main, side = rows.split_output(df, F.col("vc") >= 30, [F.col("id")], [F.col("id"), F.col("vc")])
    assert [tuple(r) for r in main.collect()] == [("a",)]
    assert [tuple(r) for r in side.collect()] == [("b", 29)]


def test_resource_is_closed(spark, tmp_path):
    marks = str(tmp_path)

    def setup():
        import uuid
        return f"{marks}/{uuid.uuid4().hex}"

    def teardown(name):
        open(name, "w").close()

    df = rows.map_with_resource(
        spark.range(100), "id BIGINT", setup, lambda _, b: b, teardown)
    assert df.count() == 100
    assert list(tmp_path.iterdir())


def test_substring(spark):
    df = spark.createDataFrame([("sensor",)], "s STRING")
    udfs.register_substring(spark)
    assert df.select(udfs.substring_range(F.col("s"), 1, 3)).first()[0] == "en"
    assert spark.sql("SELECT substring_range(s, 0, 4) FROM {d}", d=df).first()[0] == "sens"
    assert df.select(udfs.substring_batches(2, 3)("s")).first()[0] == "n"


@pytest.mark.parametrize("form", ["native", "sql", "batches"])
def test_substring_out_of_range_fails(spark, form):
    df = spark.createDataFrame([("abc",)], "s STRING")
    udfs.register_substring(spark)
    build = {
        "native": lambda: df.select(udfs.substring_range(F.col("s"), 1, 9)),
        "sql": lambda: spark.sql("SELECT substring_range(s, 1, 9) FROM {d}", d=df),
        "batches": lambda: df.select(udfs.substring_batches(1, 9)("s")),
    }[form]
    with pytest.raises(Exception, match="out of range"):
        build().collect()


def test_bitmap_offset_sees_six_characters(spark):
    ids = ["1234567", "9234567", "234567", "7"]
    df = spark.createDataFrame([(x,) for x in ids], "u STRING")
    got = [r[0] for r in df.select(uniques.bitmap_offset(F.col("u"))).collect()]
    assert got == [659217143, 659217143, 659217143, 55]


def test_sessions_merge_at_exactly_the_gap(spark):
    df = timed(spark, [("a", "", 0, 1), ("a", "", 5, 2), ("a", "", 11, 3)])
    got = windows.sessions(df, "ts", "5 seconds", ["k"], {"ct": F.count(F.lit(1))}).orderBy("window_start").collect()
    assert [(r.window_start, r.window_end, r.ct) for r in got] == [(at(0), at(10), 2), (at(11), at(16), 1)]


def test_window_starts(spark):
    df = timed(spark, [("a", "", s, s) for s in (0, 5, 11)])
    got = windows.sliding(df, "ts", "5 seconds", "3 seconds", ["k"], F.count(F.lit(1)).alias("ct"))
    panes = windows.sliding_count(df, "ts", "2 seconds", 3, ["k"])
    native = windows.sliding(df, "ts", "6 seconds", "2 seconds", ["k"], F.count(F.lit(1)).alias("ct"))
    # 2024-01-01 is a whole number of three-second slides from the epoch.
    assert {(r.window_start - T0).total_seconds() for r in got.collect()} == {-3.0, 0.0, 3.0, 9.0}
    assert sorted(map(repr, panes.collect())) == sorted(map(repr, native.collect()))


def test_max_row_ties(spark):
    df = spark.createDataFrame([("a", 1, 5, 10), ("a", 2, 5, 20), ("a", 3, 4, 30)], "id STRING, i INT, vc INT, t INT")
    newer = running.running_max_row(df, "id", "vc", ["t"], "i").orderBy("i").collect()
    older = running.running_max_row(df, "id", "vc", ["t"], "i", first=True).orderBy("i").collect()
    assert [r.max_t for r in newer] == [10, 20, 20]
    assert [r.max_t for r in older] == [10, 10, 10]


def test_repeat_is_adjacent_and_below_the_limit(spark):
    data = [("a", "fail", 0, 0), ("a", "fail", 4, 1), ("a", "ok", 5, 2), ("a", "fail", 6, 3),
            ("a", "fail", 11, 4), ("b", "fail", 0, 5), ("b", "fail", 5, 6)]
    got = patterns.repeated(timed(spark, data), "k", ["ts", "n"], F.col("kind") == "fail", 2, "5 seconds").collect()
    assert [(r.k, r.start_ts, r.end_ts) for r in got] == [("a", at(0), at(4))]


def test_followed_by(spark):
    data = [("a", "create", 0, 0), ("a", "create", 3, 1), ("a", "other", 4, 2), ("a", "pay", 9, 3),
            ("b", "pay", 0, 4), ("b", "create", 1, 5), ("c", "create", 0, 6), ("c", "pay", 10, 7)]
    kind = F.col("kind")
    got = patterns.followed_by(timed(spark, data), "k", ["ts", "n"], kind == "create", kind == "pay", "10 seconds")
    assert {(r.k, r.start_ts, r.end_ts, r.outcome) for r in got.collect()} == {
        ("a", at(0), at(9), "match"), ("a", at(3), at(9), "match"),
        ("b", at(1), at(11), "timeout"), ("c", at(0), at(10), "timeout"),
    }


def waiting_slot(rows_, wait_right, wait_left):
    """The reconciliation rule row by row: one waiting row per key."""
    out, slot = [], {}
    single = {True: lambda s: (s, None), False: lambda s: (None, s)}
    for key, s, left, _ in sorted(rows_, key=lambda r: (r[1], r[2], r[3])):
        held = slot.pop(key, None)
        if held is not None:
            since, was_left = held
            if was_left != left and s <= since + (wait_right if was_left else wait_left):
                out.append((key, since, s) if was_left else (key, s, since))
                continue
            out.append((key, *single[was_left](since)))
        slot[key] = (s, left)
    return out + [(k, *single[left](s)) for k, (s, left) in slot.items()]


@pytest.mark.parametrize("hot_rows", [None, 10])
def test_reconcile_against_brute_force(spark, hot_rows):
    rng = random.Random(5)
    data = [(rng.choice("aaab"), rng.randrange(400), rng.random() < 0.5, i) for i in range(300)]
    df = timed(spark, [(k, "L" if left else "R", s, i) for k, s, left, i in data])
    got = joins.reconcile(
        df.where("kind = 'L'"), df.where("kind = 'R'"), "k", "ts", "10 seconds", "5 seconds", "n", hot_rows=hot_rows)

    def when(s):
        return None if s is None else at(s)

    want = sorted(repr((k, when(a), when(b))) for k, a, b in waiting_slot(data, 10, 5))
    assert sorted(repr((r.k, r.left_ts, r.right_ts)) for r in got.collect()) == want


def test_mean_with_null_key(spark):
    df = spark.createDataFrame([(None, 1), (None, 3), (5, 10)], "k BIGINT, v BIGINT")
    assert {(r.k, r.mean) for r in udfs.mean_by_key(df, "k", "v").collect()} == {(None, 2.0), (5, 10.0)}


def test_null_and_nan_keys_stay_apart(spark):
    rows = [(None, 3.0), (float("nan"), 1.0), (float("nan"), 5.0), (2.0, 4.0), (None, 5.0)]
    df = spark.createDataFrame(rows, "k DOUBLE, v DOUBLE").repartition(4)
    got = udfs.mean_by_key(df, "k", "v").collect()
    assert sorted((repr(r.k), r.mean) for r in got) == [("2.0", 4.0), ("None", 4.0), ("nan", 3.0)]


def test_interval_join_of_no_width(spark):
    left = spark.sql("SELECT 1 AS k, TIMESTAMP_NTZ '2024-01-01 00:00:05' AS t UNION ALL SELECT 1, TIMESTAMP_NTZ '2024-01-01 00:00:06'")
    right = spark.sql("SELECT 1 AS rk, TIMESTAMP_NTZ '2024-01-01 00:00:05' AS rt")
    assert joins.interval_join(left, right, ("k", "rk"), ("t", "rt"), 0, 0).count() == 1


def test_clock_stream_reads_all_files(spark, tmp_path):
    """A timer longer than a batch must not end the run before the last file is read."""
    feed = str(tmp_path / "feed")
    for i in range(2):
        spark.range(i * 500, i * 500 + 500).selectExpr("id AS event_id", "id % 7 AS id").coalesce(1).write.mode("append").parquet(feed)
    rows = spark.readStream.schema("event_id BIGINT, id BIGINT").option("maxFilesPerTrigger", 1).parquet(feed)
    fired = rows.withColumn("salt", F.lit(0)).groupBy("id", "salt").transformWithState(
        processors.ClockTimer(6_000), "id BIGINT, salt INT, seen BIGINT", "append", "ProcessingTime")
    assert live.run_until_quiet(fired, "append").agg({"seen": "sum"}).first()[0] == 1000


def test_append_mode_refuses_an_updating_query(spark, sf):
    counts = tables.event_stream(spark, sf).groupBy("event_type").count()
    with pytest.raises(Exception, match="append"):
        live.drain(counts, "append")

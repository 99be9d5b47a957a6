"""Streams that come in several files: state, waits and late rows across batches."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from millrace.operators import joins, patterns
from millrace.plans import matching
from millrace.plans.registry import HOUR_US
from millrace.session import scratch
from millrace.sources import tables
from millrace.streaming import batched, live
from millrace.streaming import processors as state

FILES = 3


@pytest.fixture(scope="module")
def feed(spark, sf):
    """The events in three files, each up to an hour out of order with the next."""
    folder = scratch(spark, "feed")
    events = tables.events(spark, sf)
    jitter = F.pmod(F.hash("event_id"), F.lit(3600))
    place = F.unix_timestamp(F.col("ts").cast("timestamp")) + jitter
    placed = events.withColumn("place", place)
    low, high = placed.agg(F.min("place"), F.max("place")).first()
    part = F.floor((F.col("place") - low) * FILES / (high - low + 1))
    for i in range(FILES):
        placed.where(part == i).drop("place").coalesce(1).write.mode("append").parquet(folder)
    return folder


def ended(spark, feed):
    end = live.event_end(spark)
    events = spark.readStream.schema(tables.EVENTS_SCHEMA).option("maxFilesPerTrigger", 1).parquet(feed)
    both = events.withColumn("ts", F.col("ts").cast("timestamp")).unionByName(end.stream())
    return both.withWatermark("ts", "2 hours"), end


def same(got, want):
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(*got.columns).collect()))


def real(emitted):
    assert emitted.select("batch").distinct().count() > 2
    return emitted.where("user_id >= 0").drop("batch")


def test_followed_by_over_batches(spark, sf, feed):
    events, end = ended(spark, feed)
    kind = F.col("event_type")
    stage = F.when(kind == "signup", "start").when(kind.isin("purchase", "end"), "then")
    got = end.drain(state.in_order(events, "user_id", stage, state.FollowedBy(24 * HOUR_US)), "append")
    want = patterns.followed_by(
        tables.events(spark, sf), "user_id", ["ts", "event_id"], kind == "signup", kind == "purchase", "1 day")
    same(real(got), want)


def test_reconcile_over_batches(spark, sf, feed):
    events, end = ended(spark, feed)
    kind = F.col("event_type")
    side = F.when(kind.isin("purchase", "end"), "left").when(kind == "click", "right")
    got = end.drain(state.in_order(events, "user_id", side, state.Reconcile(10 * HOUR_US, 5 * HOUR_US)), "append")
    stored = tables.events(spark, sf)
    want = joins.reconcile(
        stored.where("event_type = 'purchase'"), stored.where("event_type = 'click'"),
        "user_id", "ts", "10 hours", "5 hours", "event_id")
    same(real(got), want)


def test_salted_state_over_batches(spark, sf, feed):
    readings = spark.readStream.schema(tables.EVENTS_SCHEMA).option("maxFilesPerTrigger", 1).parquet(feed).select(
        F.col("user_id").alias("id"), "event_id", F.floor("value").alias("vc"))
    parts = live.newest(live.drain(state.salted_state(readings, "id", state.Averaged()), "update"), ["id", "salt"])
    got = parts.groupBy("id").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    want = tables.sensor(tables.events(spark, sf)).groupBy("id").agg(
        F.sum("vc").alias("total"), F.count(F.lit(1)).alias("n"))
    same(got, want)


def test_running_again_goes_on(spark, feed):
    """A second run from the same checkpoint finds nothing new and keeps what was emitted."""
    events = spark.readStream.schema(tables.EVENTS_SCHEMA).parquet(feed).select("event_id")
    checkpoint, out = scratch(spark, "progress"), scratch(spark, "emitted")
    first = live.drain(events, "append", checkpoint=checkpoint, out=out).count()
    assert live.drain(events, "append", checkpoint=checkpoint, out=out).count() == first == 1000


def test_empty_source(spark, tmp_path):
    nothing = spark.readStream.schema(tables.EVENTS_SCHEMA).parquet(str(tmp_path))
    got = live.drain(nothing.select("event_id"), "append")
    assert got.count() == 0 and "event_id" in got.columns


def test_interval_join_drops_old_state(spark, feed):
    """Rows that no later row can join leave the join's state."""
    events = spark.readStream.schema(tables.EVENTS_SCHEMA).parquet(feed)
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "0 seconds")
    pairs = matching.interval_pairs(matching.of_type(timed, "purchase"), matching.of_type(timed, "click"))
    query = pairs.writeStream.foreachBatch(lambda batch, n: batch.count()).option(
        "checkpointLocation", scratch(spark, "progress")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sum(p.stateOperators[0].numRowsRemoved for p in query.recentProgress) > 300


@pytest.mark.parametrize("hot_rows", [None, 5])
def test_followed_by_scanned_per_batch(spark, sf, feed, hot_rows):
    end = live.event_end(spark)
    kind = F.col("event_type")
    events = spark.readStream.schema(tables.EVENTS_SCHEMA).option("maxFilesPerTrigger", 1).parquet(feed)
    both = events.withColumn("ts", F.col("ts").cast("timestamp")).unionByName(end.stream())
    sequence = (kind == "signup", kind == "purchase", "1 day")
    step = batched.FollowedBy(
        scratch(spark, "open"), "user_id", ["ts", "event_id"], *sequence, "2 hours", hot_rows=hot_rows)
    got = end.drain(both, "append", step)
    assert got.select("batch").distinct().count() > 2
    want = patterns.followed_by(tables.events(spark, sf), "user_id", ["ts", "event_id"], *sequence)
    same(live.plain_time(got.drop("batch"), "start_ts", "end_ts"), want)


def test_a_window_that_ends_drops_its_bitmap(spark, sf):
    """Each first sighting comes out once; pages are kept for the windows that are open, after the end mark for none but the mark's own."""
    end = live.event_end(spark, "view")
    events = tables.event_stream(spark, sf).unionByName(end.stream()).withWatermark("ts", "0 seconds").where("event_type = 'view'")
    seen = state.first_bits(events, "ts", 3_600_000, F.col("user_id"))
    checkpoint, out = scratch(spark, "progress"), scratch(spark, "emitted")
    first = live.drain(seen, "append", None, checkpoint, out)
    windows = first.select("window_ms").distinct().count()
    assert windows > 20 and 0 < state.stored_state(spark, checkpoint, "page").count() < windows / 4
    end.write()
    got = live.drain(seen, "append", None, checkpoint, out)
    assert got.count() == got.select("window_ms", "bit").distinct().count()
    assert state.stored_state(spark, checkpoint, "page").count() <= 1


def test_clock_windows_leave_nothing(spark, sf):
    """All windows have closed when the stream is quiet, and a window holds what came in its time only."""
    windows = live.run_until_quiet(state.clock_windows(tables.event_stream(spark, sf), "user_id", 2_000, 1_000), "append").collect()
    assert sum(r.ct for r in windows) == 2 * spark.read.parquet(f"{sf}/events.parquet").count()
    assert all(r.window_ms % 1_000 == 0 for r in windows) and len({r.window_ms for r in windows}) >= 2


def test_counted_rows_of_a_hot_key_are_few(spark, tmp_path):
    """A task sends a row per key, not per row; null keys count as well, over several blocks too."""
    spark.range(30_000).selectExpr("if(id % 3 = 0, null, id % 2) AS id", "0 AS salt").coalesce(1).write.parquet(str(tmp_path / "in"))
    rows = spark.readStream.schema("id BIGINT, salt INT").parquet(str(tmp_path / "in"))
    got = live.drain(state.counted(rows, "id", "salt"), "append").drop("batch")
    assert sorted(map(repr, map(tuple, got.collect()))) == ["(0, 0, 10000)", "(1, 0, 10000)", "(None, 0, 10000)"]


def test_clock_windows_keep_one_state_per_key(spark, sf):
    emitted = live.run_until_quiet(state.clock_windows(tables.event_stream(spark, sf), "user_id", 2_000, 1_000), "append")
    assert emitted.count() == emitted.select("id", "window_ms").distinct().count()


class Kept:
    """State of one key, as a processor sees it; counts the timers that are set."""

    def __init__(self):
        self.values, self.timers, self.set, self.alarm = [], set(), 0, One()

    def getListState(self, *_):
        return self

    def getValueState(self, *_):
        return self.alarm

    def get(self):
        return iter(self.values)

    def appendValue(self, value):
        self.values.append(value)

    def put(self, values):
        self.values = list(values)

    def clear(self):
        self.values = []

    def registerTimer(self, at):
        self.timers.add(at)
        self.set += 1

    def deleteTimer(self, at):
        self.timers.remove(at)


class One:
    def __init__(self):
        self.value = None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


def test_a_key_keeps_one_timer():
    """Timers of many rows of a key wait in its state; the store holds the next one alone."""
    def fire(now):
        due = [t for t in kept.timers if t <= now]
        kept.timers -= set(due)
        clock = TimerValues(-1, now)
        return [r["fired_ms"] for t in due for r in timers.handleExpiredTimer((1,), clock, ExpiredTimerInfo(t))]

    kept = Kept()
    timers = state.KeyTimers(1_000)
    timers.init(kept)
    for ms in ([5, 900, 5], range(20_000, 50_000), [3, 5]):  # a later batch has an earlier row
        list(timers.handleInputRows((1,), iter([{"us": m * 1000 + 7} for m in ms]), None))
        assert len(kept.timers) == 1
    assert fire(1_002) == [] and fire(1_003) == [1_003]
    assert fire(2_000) == [1_005, 1_900]
    assert fire(21_000) == [21_000] and fire(60_000) == list(range(21_001, 51_000))
    assert not kept.timers and not kept.values and kept.alarm.value is None and kept.set < 10

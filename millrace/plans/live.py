"""The streaming forms, each run over the whole table to its end."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import eventtime, joins, ranking, rows, uniques, windows
from millrace.plans import aggregates, jobs, matching
from millrace.plans import windows as bounded
from millrace.plans.registry import HOUR_US, ORACLES, SENSOR_SQL, WORDS_SQL, bucket, query
from millrace.session import scratch
from millrace.sources import records, tables
from millrace.streaming import batched, live, resumed
from millrace.streaming import processors as state

BOUNDS = windows.BOUNDS
DOCUMENTS = "doc_id BIGINT, text STRING"


def _events(spark, sf, delay="0 seconds"):
    return tables.event_stream(spark, sf).withWatermark("ts", delay)


def _ended(spark, sf, event_type="end"):
    """The event stream and the mark that closes it; the mark's type passes the query's filter."""
    end = live.event_end(spark, event_type)
    return tables.event_stream(spark, sf).unionByName(end.stream()).withWatermark("ts", "0 seconds"), end


def _real(emitted, key):
    return emitted.drop("batch").where(F.col(key) != live.END_KEY)


# Aggregates and windows

def _word_counts(spark, sf):
    docs = tables.stream(spark, sf, "documents", DOCUMENTS)
    lines = docs.select(F.explode(F.split("text", "\n")).alias("line"))
    return rows.explode_words(lines, "line").groupBy("word").agg(F.count(F.lit(1)).alias("ct"))


_WORD_COUNT_SQL = f"WITH {WORDS_SQL} SELECT word, count(*) AS ct FROM w GROUP BY word"


@query("word_count_live", _WORD_COUNT_SQL)
def word_count_live(spark, sf):
    return live.newest(live.drain(_word_counts(spark, sf), "update"), ["word"])


@query("restart_word_count", f"""WITH p AS (SELECT * FROM documents), {WORDS_SQL}
SELECT word, 2 * count(*) AS ct FROM w GROUP BY word""")
def restart_word_count(spark, sf):
    """Stopped after all documents and started again when they come a second time: counts go on."""
    feed = scratch(spark, "feed")
    docs = tables.table(spark, sf, "documents").select("doc_id", "text")
    checkpoint, out = scratch(spark, "progress"), scratch(spark, "emitted")
    for _ in range(2):
        docs.write.mode("append").parquet(feed)
        lines = spark.readStream.schema(DOCUMENTS).parquet(feed).select(F.explode(F.split("text", "\n")).alias("line"))
        counts = rows.explode_words(lines, "line").groupBy("word").agg(F.count(F.lit(1)).alias("ct"))
        emitted = live.drain(counts, "update", checkpoint=checkpoint, out=out)
    return live.newest(emitted, ["word"])


@query("running_count_live", "SELECT 2 * count(*) AS seen FROM events")
def running_count_live(spark, sf):
    """The count of all rows so far, kept through a stop and a new start."""
    feed, checkpoint, out = scratch(spark, "feed"), scratch(spark, "progress"), scratch(spark, "emitted")
    events = tables.events(spark, sf).select("event_id")
    for _ in range(2):
        events.write.mode("append").parquet(feed)
        seen = spark.readStream.schema(events.schema).parquet(feed).agg(F.count(F.lit(1)).alias("seen"))
        emitted = live.drain(seen, "update", checkpoint=checkpoint, out=out)
    return emitted.agg(F.max_by("seen", "batch").alias("seen"))


@query("rowtime_live", f"""WITH r AS (SELECT date_trunc('second', ts) AS rt FROM events),
w AS (SELECT {bucket(HOUR_US, "rt")} AS window_start, count(*) AS ct FROM r GROUP BY ALL)
SELECT window_start, ct FROM w WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(rt) - INTERVAL 5 SECOND FROM r)""")
def rowtime_live(spark, sf):
    """Hourly counts by a time computed from CSV messages, given out once the watermark, five seconds behind, closes the hour."""
    readings = tables.sensor(tables.event_stream(spark, sf))
    text = F.concat_ws(",", "id", F.unix_timestamp("ts"), "vc").alias("value")
    timed = eventtime.with_event_time(records.parse(readings.select(text), records.SENSOR), "ts", delay="5 seconds")
    counts = windows.tumbling(timed, "rt", "1 hour", [], F.count(F.lit(1)).alias("ct"))
    return live.plain_time(live.drain(counts, "append").select("window_start", "ct"), "window_start")


@query("win_tumbling_sum_live", bounded.TUMBLING_SUM_SQL)
def win_tumbling_sum_live(spark, sf):
    sums = windows.tumbling(
        tables.sensor(_events(spark, sf)), "ts", "5 hours", ["id"],
        F.sum("vc").alias("sum_vc"), F.min_by("ts", "event_id").alias("first_ts"),
    )
    return live.plain_time(live.newest(live.drain(sums, "update"), [*BOUNDS, "id"]), *BOUNDS, "first_ts")


@query("win_sliding_sum_live", bounded.SLIDING_SUM_SQL)
def win_sliding_sum_live(spark, sf):
    sums = windows.sliding(
        tables.sensor(_events(spark, sf)), "ts", "5 hours", "2 hours", ["id"], F.sum("vc").alias("sum_vc")
    )
    return live.plain_time(live.newest(live.drain(sums, "update"), [*BOUNDS, "id"]), *BOUNDS)


@query("win_session_sum_live", bounded.SESSION_SUM_SQL)
def win_session_sum_live(spark, sf):
    events, end = _ended(spark, sf)
    sums = windows.live_sessions(
        tables.sensor(events), "ts", "8 hours", ["id"], F.sum("vc").alias("sum_vc"), F.count(F.lit(1)).alias("ct")
    )
    return live.plain_time(_real(end.drain(sums, "append"), "id"), *BOUNDS)


_PER_USER_SQL = "SELECT user_id AS id, CAST({times} * count(*) AS BIGINT) AS ct FROM events GROUP BY user_id"


def _by_clock(windowed):
    """Run clock windows until all are closed and nothing is kept, and add up what each user's windows hold."""
    return live.run_until_quiet(windowed, "append").groupBy("id").agg(F.sum("ct").alias("ct"))


@query("win_tumbling_count_live", _PER_USER_SQL.format(times=1))
def win_tumbling_count_live(spark, sf):
    """Two-second windows by the clock; every row is in one."""
    return _by_clock(state.clock_windows(tables.event_stream(spark, sf), "user_id", 2_000))


@query("win_sliding_count_live", _PER_USER_SQL.format(times=2))
def win_sliding_count_live(spark, sf):
    """Two-second windows by the clock that slide by one; every row is in two."""
    return _by_clock(state.clock_windows(tables.event_stream(spark, sf), "user_id", 2_000, 1_000))


@query("win_session_count_live", _PER_USER_SQL.format(times=1))
def win_session_count_live(spark, sf):
    """Sessions by the clock, over when no row has come for two seconds."""
    return _by_clock(state.clock_sessions(tables.event_stream(spark, sf), "user_id", 2_000))


_FEEDS = 3
_HOT = 20  # so that keys of small tables are cut too


def _resumed(spark, sf, operator):
    """Run a resumed scan over events that arrive in three parts by time, and then the row that ends the stream."""
    feed, checkpoint, out = scratch(spark, "feed"), scratch(spark, "progress"), scratch(spark, "emitted")
    events = tables.events(spark, sf)
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    low, span = F.unix_timestamp(F.lit(first).cast("timestamp")), max(1.0, (last - first).total_seconds() + 1)
    part = F.floor((seconds - low) * _FEEDS / F.lit(span))
    end = live.event_end(spark).row().withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    for rows_ in (*[events.where(part == n) for n in range(_FEEDS)], end):
        rows_.write.mode("append").parquet(feed)
        stream = spark.readStream.schema(events.schema).parquet(feed)
        emitted = live.drain(stream, "append", operator, checkpoint, out)
    return emitted.drop("batch")


@query("win_count_tumbling_live", ORACLES["win_count_tumbling"].replace("AS sum_vc", "AS total"))
def win_count_tumbling_live(spark, sf):
    """Numbers go on from batch to batch, and open groups are carried."""
    order, value = ["ts", "event_id"], F.floor("value")
    sums = resumed.CountTumbling(
        scratch(spark, "carried"), "user_id", order, 5, ["value"], [F.sum(value).alias("total")], "0 seconds", hot_rows=_HOT)
    return _resumed(spark, sf, sums).withColumnRenamed("user_id", "id")


@query("changelog_count_live", f"""WITH {SENSOR_SQL}, c AS (
  SELECT id, ts, row_number() OVER (PARTITION BY id ORDER BY ts, event_id) AS ct FROM s)
SELECT id, ts, true AS op, ct FROM c UNION ALL SELECT id, ts, false, ct - 1 FROM c WHERE ct > 1""")
def changelog_count_live(spark, sf):
    changes = resumed.Changes(scratch(spark, "carried"), "user_id", ["ts", "event_id"], [], "0 seconds", hot_rows=_HOT)
    return _resumed(spark, sf, changes).select(F.col("user_id").alias("id"), "ts", "op", "ct")


_PARTS = 4
_BATCHES_SQL = f"""{SENSOR_SQL}, a AS (SELECT *, event_id + (event_id * 7919) % 97 AS arrival FROM s),
b AS (SELECT *, arrival * {_PARTS} // (SELECT max(arrival) + 1 FROM a) AS part, {bucket(HOUR_US)} AS window_start FROM a),
m AS (SELECT part, max(ts) AS mx FROM b GROUP BY part),
w AS (SELECT b.*, (SELECT max(mx) FROM m WHERE m.part < b.part) - INTERVAL 2 HOUR - INTERVAL 1 MILLISECOND AS wm FROM b)"""


_CLASSED_SQL = f"""{_BATCHES_SQL}, c AS (SELECT *,
  CASE WHEN wm IS NULL OR window_start + INTERVAL 1 HOUR - INTERVAL 1 MILLISECOND > wm THEN 'on_time'
       WHEN window_start + INTERVAL 3 HOUR - INTERVAL 1 MILLISECOND > wm THEN 'allowed' ELSE 'too_late' END AS class
FROM w)"""


def _in_parts(spark, sf, run):
    """Call ``run`` on the stream of readings each time another quarter of them has arrived, in a made-up order."""
    feed = scratch(spark, "feed")
    arrivals = aggregates.arrivals(spark, sf).select("event_id", "id", "ts", "vc", "arrival")
    ends = arrivals.agg((F.max("arrival") + 1).alias("n")).first()["n"]
    for part in range(_PARTS):
        here = arrivals.where(F.floor(F.col("arrival") * _PARTS / F.lit(ends)) == part)
        here.write.mode("append").parquet(feed)
        out = run(spark.readStream.schema(arrivals.schema).parquet(feed))
    return out


def _run_batches(spark, sf, each):
    checkpoint = scratch(spark, "progress")

    def whole(batch, n):
        kept = batch.persist()
        try:
            each(kept, n)
        finally:
            kept.unpersist()

    _in_parts(spark, sf, lambda stream: stream.writeStream.foreachBatch(whole).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())


def _classed(spark, sf):
    out = scratch(spark, "classed")
    split = batched.LateSplit(
        scratch(spark, "watermark"), "ts", "1 hour", "2 hours", "2 hours",
        lambda classed, n: classed.write.mode("overwrite").parquet(f"{out}/batch={n}"),
    )
    _run_batches(spark, sf, split)
    return spark.read.parquet(out)


@query("late_classes_live", f"WITH {_CLASSED_SQL} SELECT event_id, id, window_start, class FROM c")
def late_classes_live(spark, sf):
    """Late rows of a stream that arrives in four files, classed batch by batch."""
    return _classed(spark, sf).select("event_id", "id", "window_start", "class")


@query("win_late_sum_live", f"""WITH {_CLASSED_SQL}
SELECT id, window_start, CAST(sum(vc) AS BIGINT) AS sum_vc FROM c WHERE class <> 'too_late' GROUP BY id, window_start""")
def win_late_sum_live(spark, sf):
    """Window sums over the rows a stream still accepts."""
    kept = _classed(spark, sf).where("class <> 'too_late'")
    return kept.groupBy("id", "window_start").agg(F.sum("vc").alias("sum_vc"))


@query("win_late_refires_live", f"""WITH {_CLASSED_SQL}, k AS (SELECT * FROM c WHERE class <> 'too_late')
SELECT DISTINCT id, window_start, part, CAST(sum(vc) OVER (PARTITION BY id, window_start ORDER BY part) AS BIGINT) AS sum_vc FROM k""")
def win_late_refires_live(spark, sf):
    """Window sums in state: given out when rows come, and again, corrected, when accepted late rows do.

    A window is open until the watermark is the allowed lateness past its end; rows of closed windows are dropped.
    """
    checkpoint, out = scratch(spark, "progress"), scratch(spark, "emitted")

    def run(stream):
        rows_ = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "4 hours")
        sums = windows.tumbling(rows_, "ts", "1 hour", ["id"], F.sum("vc").alias("sum_vc"))
        return live.drain(sums, "update", checkpoint=checkpoint, out=out)

    emitted = _in_parts(spark, sf, run)
    part = F.dense_rank().over(Window.partitionBy(F.lit(1)).orderBy("batch"))
    batches = emitted.select("batch").distinct().withColumn("part", (part - 1).cast("bigint"))  # as many as there are parts
    return live.plain_time(emitted.join(batches, "batch").select("id", "window_start", "part", "sum_vc"), "window_start")


@query("uv_running_live", f"""WITH {_BATCHES_SQL}, f AS (
  SELECT window_start, id, arg_min(event_id, part * 100000000000 + event_id) AS event_id, min(part) AS part
  FROM b GROUP BY window_start, id)
SELECT window_start, id, event_id, row_number() OVER (PARTITION BY window_start ORDER BY part, event_id) AS uv FROM f""")
def uv_running_live(spark, sf):
    """A row for each user first seen in an hour, over a stream of four files."""
    out = scratch(spark, "sightings")
    _run_batches(spark, sf, batched.RunningUnique(out, "ts", "1 hour", "id", "event_id"))
    return spark.read.parquet(out).select("window_start", "id", "event_id", "uv")


# Analytics jobs

@query("pv_hourly_live", jobs.PV_SQL)
def pv_hourly_live(spark, sf):
    views = jobs.views(_events(spark, sf))
    counts = windows.tumbling(views, "ts", "1 hour", [], F.count(F.lit(1)).alias("pv"))
    return live.plain_time(live.newest(live.drain(counts, "update"), BOUNDS), *BOUNDS)


@query("uv_exact_live", jobs.UV_SQL)
def uv_exact_live(spark, sf):
    events, end = _ended(spark, sf, "view")
    counts = uniques.live_exact(jobs.views(events), "ts", "1 hour", "user_id")
    emitted = end.drain(counts, "append").drop("batch")
    return live.plain_time(emitted, *BOUNDS).where(f"window_start < TIMESTAMP_NTZ '{live.END_OF_TIME}'")


@query("uv_bitmap_live", ORACLES["uv_bitmap"])
def uv_bitmap_live(spark, sf):
    """A row out of the bitmap of its hour at each first sighting; the rows of an hour are its visitors."""
    events, end = _ended(spark, sf, "view")
    seen = state.first_bits(jobs.views(events), "ts", HOUR_US // 1000, uniques.bitmap_offset(F.col("user_id")))
    counts = end.drain(seen, "append").groupBy("window_ms").agg(F.count(F.lit(1)).alias("uv"))
    start = F.timestamp_millis("window_ms")
    found = counts.select(start.alias(BOUNDS[0]), (start + F.expr("INTERVAL 1 HOUR")).alias(BOUNDS[1]), "uv")
    return live.plain_time(found, *BOUNDS).where(f"window_start < TIMESTAMP_NTZ '{live.END_OF_TIME}'")


@query("uv_rollup_live", """
WITH d AS (SELECT date_trunc('day', ts) AS window_start FROM events WHERE event_type = 'view') SELECT DISTINCT CAST(window_start AS TIMESTAMP) AS window_start, true AS near FROM d""")
def uv_rollup_live(spark, sf):
    """Hourly sketches of a stream, stored and merged to days; ``near`` tells whether a day is within 5 % of its exact count."""
    hourly = uniques.sketched(jobs.views(_events(spark, sf)), "ts", "1 hour", "user_id")
    stored = live.newest(live.drain(hourly, "update"), BOUNDS)
    days = live.plain_time(uniques.rolled_up(stored, "1 day"), *BOUNDS)
    exact = uniques.exact(jobs.views(tables.events(spark, sf)), "ts", "1 day", "user_id").select(BOUNDS[0], F.col("uv").alias("exact"))
    near = F.abs(F.col("uv") - F.col("exact")) * 100 <= F.greatest(F.lit(100), 5 * F.col("exact"))
    return days.join(exact, BOUNDS[0]).select(BOUNDS[0], near.alias("near"))


@query("item_top_n_live", jobs.TOP_SQL)
def item_top_n_live(spark, sf):
    events, end = _ended(spark, sf, "view")
    counts = ranking.live_item_counts(jobs.views(events))
    return live.plain_time(_real(end.drain(counts, "append", lambda batch, _: ranking.top_n(batch)), "item"), "window_end")


# Matching

@query("interval_join_live", matching.INTERVAL_SQL)
def interval_join_live(spark, sf):
    left = matching.of_type(_events(spark, sf), "purchase")
    right = matching.of_type(_events(spark, sf), "click")
    return live.drain(matching.interval_pairs(left, right), "append").drop("batch")


_OUTER_SQL = f"""WITH m AS ({matching.INTERVAL_SQL})
SELECT user_id, left_id, right_id FROM m
UNION ALL SELECT user_id, event_id, NULL FROM events WHERE event_type = 'purchase' AND event_id NOT IN (SELECT left_id FROM m)
UNION ALL SELECT user_id, NULL, event_id FROM events WHERE event_type = 'click' AND event_id NOT IN (SELECT right_id FROM m)"""


@query("interval_join_outer_live", _OUTER_SQL)
def interval_join_outer_live(spark, sf):
    """Both sides with different delays, under both ways of joining two watermarks: the same rows come out, matched or not."""
    found = [_outer_pairs(spark, sf, policy) for policy in ("min", "max")]
    both = found[0].withColumn("_in", F.lit(1)).unionByName(found[1].withColumn("_in", F.lit(2)))
    # Counted in both runs, so that one without the other would show as a row too many or too few.
    counted = both.groupBy("user_id", "left_id", "right_id").agg(F.count_distinct("_in").alias("_runs"), F.count(F.lit(1)).alias("_rows"))
    return counted.withColumn("_n", F.when(F.col("_runs") == 2, F.col("_rows") / 2).otherwise(0)).withColumn(
        "_n", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int")))).drop("_n", "_runs", "_rows")


def _outer_pairs(spark, sf, policy):
    name = "spark.sql.streaming.multipleWatermarkPolicy"
    before = spark.conf.get(name)
    ends = [live.event_end(spark, kind) for kind in ("purchase", "click")]
    sides = []
    for end, kind, delay, prefix in zip(ends, ("purchase", "click"), ("0 seconds", "2 hours"), ("left", "right")):
        rows_ = matching.of_type(tables.event_stream(spark, sf).unionByName(end.stream()), kind).withWatermark("ts", delay)
        sides.append(rows_.select(F.col("user_id").alias(f"{prefix}_user"), F.col("event_id").alias(f"{prefix}_id"), F.col("ts").alias(f"{prefix}_ts")))
    pairs = joins.outer_interval_join(*sides, ("left_user", "right_user"), ("left_ts", "right_ts"), 5 * matching.H, 10 * matching.H)
    spark.conf.set(name, policy)
    try:
        emitted = live.drain_ended(pairs, "append", ends)
    finally:
        spark.conf.set(name, before)
    return emitted.select(F.coalesce("left_user", "right_user").alias("user_id"), "left_id", "right_id").where(F.col("user_id") != live.END_KEY)


@query("reconcile_live", matching.RECONCILE_EVENTS_SQL)
def reconcile_live(spark, sf):
    kind = F.col("event_type")
    matched = resumed.Reconciled(
        scratch(spark, "carried"), "user_id", ["ts", "event_id"], kind == "purchase", kind == "click", "10 hours", "5 hours",
        "0 seconds", hot_rows=_HOT)
    return _resumed(spark, sf, matched)


def _strict(spark, sf, stages, within):
    found = resumed.Strict(scratch(spark, "carried"), "user_id", ["ts", "event_id"], stages, within, "0 seconds", hot_rows=_HOT)
    return _resumed(spark, sf, found)


@query("pat_repeat_live", ORACLES["pat_repeat"])
def pat_repeat_live(spark, sf):
    return _strict(spark, sf, [F.col("event_type") == "error"] * 2, "6 hours")


@query("pat_repeat_three_live", ORACLES["pat_repeat_three"])
def pat_repeat_three_live(spark, sf):
    return _strict(spark, sf, [F.col("event_type") == "error"] * 3, "48 hours")


@query("pat_next_live", ORACLES["pat_next"])
def pat_next_live(spark, sf):
    return _strict(spark, sf, [F.col("event_type") == "view", F.col("event_type") == "click"], "12 hours")


@query("pat_live", matching.PAT_SQL)
def pat_live(spark, sf):
    """Matches and timeouts of a relaxed sequence, told apart by ``outcome``."""
    events, end = _ended(spark, sf)
    kind = F.col("event_type")
    stage = F.when(kind == "signup", "start").when(kind.isin("purchase", "end"), "then")
    return _real(end.drain(state.in_order(events, "user_id", stage, state.FollowedBy(24 * HOUR_US)), "append"), "user_id")


@query("pat_batches_live", matching.PAT_SQL)
def pat_batches_live(spark, sf):
    """The same by a scan per batch, which splits a hot key."""
    end = live.event_end(spark)
    kind = F.col("event_type")
    events = tables.event_stream(spark, sf).unionByName(end.stream()).select("user_id", "ts", "event_id", "event_type")
    step = batched.FollowedBy(
        scratch(spark, "open"), "user_id", ["ts", "event_id"], kind == "signup", kind == "purchase", "1 day", "0 seconds"
    )
    return live.plain_time(end.drain(events, "append", step).drop("batch"), "start_ts", "end_ts")


_CONTROL_PARTS = 8


@query("control_switch_live", f"""
WITH p AS (SELECT event_id, event_type, event_id * {_CONTROL_PARTS} // (SELECT max(event_id) + 1 FROM events) AS part FROM events),
c AS (SELECT r.part, arg_max(event_id % 3, event_id) AS setting
      FROM range({_CONTROL_PARTS}) r(part) LEFT JOIN p ON event_type = 'error' AND p.part < r.part GROUP BY r.part)
SELECT event_id, event_type || CASE setting WHEN 1 THEN '{matching.SWITCHES["1"]}' WHEN 2 THEN '{matching.SWITCHES["2"]}'
  ELSE '{matching.OTHERWISE}' END AS value
FROM p JOIN c USING (part) WHERE event_type <> 'error'""")
def control_switch_live(spark, sf):
    """Main rows and control values arrive in turn; a batch is handled by the last value that came before it."""
    stored, feed = scratch(spark, "control"), scratch(spark, "feed")
    events = tables.events(spark, sf).select("event_id", "event_type")
    ends = events.agg((F.max("event_id") + 1).alias("n")).first()["n"]
    part = F.floor(F.col("event_id") * _CONTROL_PARTS / F.lit(ends))
    control = events.where("event_type = 'error'").select("event_id", (F.col("event_id") % 3).cast("string").alias("setting"))
    control.where("false").write.parquet(stored)

    def apply(batch, _):
        now = batched.controlled_batch(batch, lambda: spark.read.parquet(stored), "event_id", "setting")
        return now.select("event_id", F.concat("event_type", matching.switched(F.col("setting"))).alias("value"))

    checkpoint, out = scratch(spark, "progress"), scratch(spark, "emitted")
    for n in range(_CONTROL_PARTS):
        events.where("event_type <> 'error'").where(part == n).write.mode("append").parquet(feed)
        main = spark.readStream.schema(events.schema).parquet(feed)
        emitted = live.drain(main, "append", apply, checkpoint, out)
        control.where(part == n).write.mode("append").parquet(stored)
    return emitted.drop("batch")


# Keyed state and timers

def _state(spark, sf, processor):
    readings = tables.event_stream(spark, sf).select(
        "event_id", F.col("user_id").alias("id"), F.floor("value").alias("vc"), "event_type",
        F.unix_micros("ts").alias("us"),
    )
    return live.drain(state.salted_state(readings, "id", processor), "update")


@query("state_value", f"WITH {SENSOR_SQL} SELECT id, arg_max(vc, event_id) AS vc FROM s GROUP BY id")
def state_value(spark, sf):
    parts = live.newest(_state(spark, sf, state.LastValue()), ["id", "salt"])
    return parts.groupBy("id").agg(F.max_by("vc", "arrival").alias("vc"))


@query("state_list", f"""WITH {SENSOR_SQL} SELECT id, count(*) AS n, CAST(sum(vc) AS BIGINT) AS total,
  array_to_string(list_sort(list(vc)), ',') AS contents FROM s GROUP BY id""")
def state_list(spark, sf):
    """The values kept for each key, as text, smallest first."""
    parts = _state(spark, sf, state.Collected())  # each value once, in the batch that brought it
    whole = parts.groupBy("id").agg(F.sort_array(F.flatten(F.collect_list("contents"))).alias("v"))
    total = F.aggregate("v", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return whole.select("id", F.size("v").cast("bigint").alias("n"), total.alias("total"), F.array_join(F.col("v").cast("array<string>"), ",").alias("contents"))


@query("state_clear", f"""WITH {SENSOR_SQL}
SELECT id, CASE WHEN arg_max(event_type, event_id) <> 'error' THEN arg_max(vc, event_id) END AS vc FROM s GROUP BY id""")
def state_clear(spark, sf):
    """The value of a key's last row, unless an error has cleared it."""
    parts = live.newest(_state(spark, sf, state.Cleared("error")), ["id", "salt"])
    return parts.groupBy("id").agg(F.max(F.struct("arrival", "vc"))["vc"].alias("vc"))


@query("state_map", f"WITH {SENSOR_SQL} SELECT id, event_type, count(*) AS ct FROM s GROUP BY id, event_type")
def state_map(spark, sf):
    readings = state.counted(tables.event_stream(spark, sf).select(F.col("user_id").alias("id"), "event_type"), "id", "event_type")
    emitted = live.drain(state.salted_state(readings, "id", state.CountByField(), salts=1), "update")
    parts = live.newest(emitted, ["id", "salt", "event_type"])
    return parts.groupBy("id", "event_type").agg(F.sum("ct").alias("ct"))


@query("state_reduce", f"WITH {SENSOR_SQL} SELECT id, arg_max(ts, event_id) AS ts, arg_min(vc, event_id) AS vc FROM s GROUP BY id")
def state_reduce(spark, sf):
    """Newest time, oldest value."""
    parts = live.newest(_state(spark, sf, state.Reduced()), ["id", "salt"])
    merged = parts.groupBy("id").agg(F.max_by("us", "last_arrival").alias("us"), F.min_by("vc", "first_arrival").alias("vc"))
    return merged.select("id", F.timestamp_micros("us").cast("timestamp_ntz").alias("ts"), "vc")


@query("state_aggregate", f"WITH {SENSOR_SQL} SELECT id, CAST(sum(vc) AS DOUBLE) / count(*) AS mean FROM s GROUP BY id")
def state_aggregate(spark, sf):
    parts = live.newest(_state(spark, sf, state.Averaged()), ["id", "salt"])
    return parts.groupBy("id").agg((F.sum("total") / F.sum("n")).alias("mean"))


@query("state_ttl", "SELECT user_id AS id, count(*) AS ct FROM events GROUP BY user_id")
def state_ttl(spark, sf):
    """Counts in state that is forgotten four seconds after a key's last row: when all rows come a second time
    after that, they are counted from nothing."""
    feed, checkpoint, out = scratch(spark, "feed"), scratch(spark, "progress"), scratch(spark, "emitted")
    rows_ = tables.events(spark, sf).select("event_id", F.col("user_id").alias("id"))
    for _ in range(2):
        rows_.write.mode("append").parquet(feed)
        readings = spark.readStream.schema(rows_.schema).parquet(feed)
        counts = state.salted_state(readings, "id", state.Expiring(4_000), time_mode="ProcessingTime")
        emitted = live.run_until_quiet(counts, "update", checkpoint, out)
    return live.newest(emitted, ["id", "salt"]).groupBy("id").agg(F.sum("ct").alias("ct"))


@query("state_migrated", "SELECT user_id AS id, 2 * count(*) AS ct FROM events GROUP BY user_id")
def state_migrated(spark, sf):
    """A second query, with other partitions and a checkpoint of its own, starts from the counts that a first one left."""
    name = "spark.sql.shuffle.partitions"
    before, initial = spark.conf.get(name), None
    readings = tables.event_stream(spark, sf).select("event_id", F.col("user_id").alias("id"))
    try:
        for more in (0, 1):
            spark.conf.set(name, int(before) + more)
            checkpoint = scratch(spark, "progress")
            counts = state.salted_state(readings, "id", state.Counting(), initial=initial)
            emitted = live.drain(counts, "update", checkpoint=checkpoint)
            initial = state.stored_state(spark, checkpoint, "ct")
    finally:
        spark.conf.set(name, before)
    return live.newest(emitted, ["id", "salt"]).groupBy("id").agg(F.sum("ct").alias("ct"))


@query("timer_event", """
SELECT DISTINCT user_id AS id, epoch_us(ts) // 1000 + 86400000 AS fired_ms FROM events
WHERE epoch_us(ts) // 1000 + 86400000 <= (SELECT epoch_us(max(ts)) // 1000 FROM events)""")
def timer_event(spark, sf):
    """A timer a day after each row; those past the last watermark do not fire."""
    readings = _events(spark, sf).select(F.col("user_id").alias("id"), "ts", F.unix_micros("ts").alias("us"))
    fired = readings.groupBy("id").transformWithState(
        state.KeyTimers(86_400_000), "id BIGINT, fired_ms BIGINT", "append", "EventTime"
    )
    return live.drain(fired, "append").drop("batch")


@query("timer_processing", "SELECT user_id AS id, count(*) AS seen FROM events GROUP BY user_id")
def timer_processing(spark, sf):
    """A clock timer a second after a key's rows, on a stream that runs until all have fired."""
    readings = tables.sensor(tables.event_stream(spark, sf)).withColumn("salt", F.lit(0))  # counted in tasks, a hot key is not spread
    fired = state.counted(readings, "id", "salt").groupBy("id", "salt").transformWithState(
        state.ClockTimer(1_000, "n"), "id BIGINT, salt INT, seen BIGINT", "append", "ProcessingTime"
    )
    return live.run_until_quiet(fired, "append").groupBy("id").agg(F.sum("seen").alias("seen"))

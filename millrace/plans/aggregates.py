"""Running aggregates, watermarks, late rows, over windows and changelogs."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import changelog, eventtime, running, scan
from millrace.plans.registry import HOUR_US, SENSOR_SQL, WORDS_SQL, bucket, query
from millrace.plans.rows import document_words, sensors
from millrace.sources import records, tables

ARRIVAL = ["arrival", "event_id"]
DELAY, LATENESS = "2 hours", "2 hours"


@query("word_count", f"WITH {WORDS_SQL} SELECT word, count(*) AS ct FROM w GROUP BY word")
def word_count(spark, sf):
    return running.final_count(document_words(spark, sf), "word")


@query("word_count_running", f"""WITH {WORDS_SQL}
SELECT doc_id, line_no, pos, word,
       count(*) OVER (PARTITION BY word ORDER BY doc_id, line_no, pos ROWS UNBOUNDED PRECEDING) AS ct
FROM w""")
def word_count_running(spark, sf):
    return scan.keyed_scan(
        document_words(spark, sf), ["word"], ["doc_id", "line_no", "pos"], scan.running_count("ct")
    )


@query("table_group_count", f"WITH {SENSOR_SQL} SELECT id, count(id) AS ct, CAST(sum(vc) AS BIGINT) AS sum_vc FROM s WHERE vc >= 20 GROUP BY id")
def table_group_count(spark, sf):
    return sensors(spark, sf).where("vc >= 20").groupBy("id").agg(F.count("id").alias("ct"), F.sum("vc").alias("sum_vc"))


@query("running_max", f"""WITH {SENSOR_SQL}
SELECT event_id, id, max(vc) OVER w AS max_vc, first(ts) OVER w AS first_ts
FROM s WINDOW w AS (PARTITION BY id ORDER BY event_id ROWS UNBOUNDED PRECEDING)""")
def running_max(spark, sf):
    return running.running_max(sensors(spark, sf), "id", "vc", ["ts"], ["event_id"]).drop("ts", "vc")


@query("running_max_final", f"WITH {SENSOR_SQL} SELECT id, max(vc) AS max_vc, arg_min(ts, event_id) AS first_ts FROM s GROUP BY id")
def running_max_final(spark, sf):
    return sensors(spark, sf).groupBy("id").agg(F.max("vc").alias("max_vc"), F.min_by("ts", "event_id").alias("first_ts"))


def _max_by_sql(place: str) -> str:
    return f"""WITH {SENSOR_SQL}
SELECT event_id, id, m.vc AS max_vc, m.ts AS max_ts FROM (
  SELECT event_id, id, max({{'vc': vc, 'p': {place}, 'ts': ts}})
         OVER (PARTITION BY id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS m FROM s)"""


@query("running_max_by", _max_by_sql("event_id"))
def running_max_by(spark, sf):
    rows = running.running_max_row(sensors(spark, sf), "id", "vc", ["ts"], "event_id")
    return rows.select("event_id", "id", "max_vc", "max_ts")


@query("running_max_by_first", _max_by_sql("-event_id"))
def running_max_by_first(spark, sf):
    """On a tie the older row wins."""
    rows = running.running_max_row(sensors(spark, sf), "id", "vc", ["ts"], "event_id", first=True)
    return rows.select("event_id", "id", "max_vc", "max_ts")


@query("running_reduce", f"""WITH {SENSOR_SQL}
SELECT event_id, id, last(ts) OVER w AS last_ts, max(vc) OVER w AS max_vc
FROM s WINDOW w AS (PARTITION BY id ORDER BY event_id ROWS UNBOUNDED PRECEDING)""")
def running_reduce(spark, sf):
    return running.running_reduce(sensors(spark, sf), "id", "ts", "vc", ["event_id"]).drop("ts", "vc")


@query("running_count", "SELECT event_id, row_number() OVER (ORDER BY event_id) AS seen FROM events")
def running_count(spark, sf):
    return running.running_total(tables.events(spark, sf).select("event_id"), ["event_id"])


# Event time

def arrivals(spark, sf):
    """Sensor readings in a made-up arrival order, so that some are late."""
    return sensors(spark, sf).withColumn("arrival", tables.disordered_arrival())


_ARRIVALS = f"{SENSOR_SQL}, a AS (SELECT *, event_id + (event_id * 7919) % 97 AS arrival FROM s)"
_LATE = f"""{_ARRIVALS}, t AS (
  SELECT *, max(ts) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
            - INTERVAL 2 HOUR - INTERVAL 1 MILLISECOND AS wm,
         {bucket(HOUR_US)} AS window_start FROM a),
c AS (SELECT *, window_start + INTERVAL 1 HOUR AS window_end,
  CASE WHEN wm IS NULL OR window_start + INTERVAL 1 HOUR - INTERVAL 1 MILLISECOND > wm THEN 'on_time'
       WHEN window_start + INTERVAL 3 HOUR - INTERVAL 1 MILLISECOND > wm THEN 'allowed'
       ELSE 'too_late' END AS class FROM t)"""


@query("watermark_trace", f"""WITH {_ARRIVALS}
SELECT event_id, max(ts) OVER (ORDER BY arrival, event_id ROWS UNBOUNDED PRECEDING) - INTERVAL 2 HOUR AS watermark FROM a""")
def watermark_trace(spark, sf):
    return eventtime.watermark_trace(arrivals(spark, sf), ARRIVAL, "ts", DELAY).select("event_id", "watermark")


def classed(spark, sf):
    return eventtime.late_classes(arrivals(spark, sf), ARRIVAL, "ts", "1 hour", DELAY, LATENESS)


@query("late_classes", f"WITH {_LATE} SELECT event_id, id, window_start, window_end, class FROM c")
def late_classes(spark, sf):
    return classed(spark, sf).select("event_id", "id", "window_start", "window_end", "class")


@query("late_rows", f"WITH {_LATE} SELECT event_id, id, ts, vc FROM c WHERE class = 'too_late'")
def late_rows(spark, sf):
    return classed(spark, sf).where("class = 'too_late'").select("event_id", "id", "ts", "vc")


@query("win_late_sum", f"""WITH {_LATE}
SELECT id, window_start, CAST(sum(vc) AS BIGINT) AS sum_vc FROM c WHERE class <> 'too_late' GROUP BY id, window_start""")
def win_late_sum(spark, sf):
    kept = classed(spark, sf).where("class <> 'too_late'")
    return kept.groupBy("id", "window_start").agg(F.sum("vc").alias("sum_vc"))


@query("win_late_refires", f"""WITH {_LATE}
SELECT event_id, id, window_start, sum_vc FROM (
  SELECT event_id, id, window_start, class, CAST(sum(vc) OVER (
    PARTITION BY id, window_start ORDER BY arrival, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS sum_vc
  FROM c WHERE class <> 'too_late') WHERE class = 'allowed'""")
def win_late_refires(spark, sf):
    """The corrected sum a window gives again at each late row it still accepts."""
    kept = classed(spark, sf).where("class <> 'too_late'")
    sums = scan.keyed_scan(kept, ["id", "window_start"], ARRIVAL, scan.running_sum("sum_vc", F.col("vc")))
    return sums.where("class = 'allowed'").select("event_id", "id", "window_start", "sum_vc")


@query("proctime_column", "SELECT event_id, true AS has_pt FROM events")
def proctime_column(spark, sf):
    timed = eventtime.with_processing_time(tables.events(spark, sf).select("event_id"))
    return timed.select("event_id", F.col("pt").isNotNull().alias("has_pt"))


@query("rowtime_column", "SELECT event_id, date_trunc('second', ts) AS rt FROM events")
def rowtime_column(spark, sf):
    """Event time computed from a CSV message's epoch seconds, with its watermark."""
    text = F.concat_ws(",", "id", F.unix_timestamp(F.col("ts").cast("timestamp")), "vc").alias("value")
    parsed = records.parse(sensors(spark, sf).select(text, "event_id"), records.SENSOR, keep=("event_id",))
    timed = eventtime.with_event_time(parsed, "ts", delay="5 seconds")
    return timed.select("event_id", F.col("rt").cast("timestamp_ntz").alias("rt"))


# Over windows

@query("over_unbounded", f"""WITH {SENSOR_SQL}
SELECT event_id, id, CAST(sum(vc) OVER (PARTITION BY id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS sum_vc FROM s""")
def over_unbounded(spark, sf):
    rows = scan.keyed_scan(sensors(spark, sf), ["id"], ["ts", "event_id"], scan.running_sum("sum_vc", F.col("vc")))
    return rows.select("event_id", "id", "sum_vc")


@query("over_rows", f"""WITH {SENSOR_SQL}
SELECT event_id, id, CAST(sum(vc) OVER w AS BIGINT) AS sum_vc, count(id) OVER w AS ct
FROM s WINDOW w AS (PARTITION BY id ORDER BY ts, event_id ROWS 2 PRECEDING)""")
def over_rows(spark, sf):
    rows = scan.keyed_scan(
        sensors(spark, sf), ["id"], ["ts", "event_id"], scan.previous_rows("_prev", F.struct("vc"), 2)
    )
    return rows.select(
        "event_id", "id",
        F.aggregate("_prev", F.col("vc"), lambda a, r: a + r["vc"]).alias("sum_vc"),
        (F.size("_prev") + 1).cast("bigint").alias("ct"),
    )


_OVER_SQL = """
WITH carry AS (
  SELECT {keys} _chunk, sum(sum_vc) OVER c AS sum_vc, sum(ct) OVER c AS ct
  FROM (SELECT {keys} _chunk, sum(vc) AS sum_vc, count(id) AS ct FROM {view} WHERE _chunk IS NOT NULL GROUP BY {keys} _chunk)
  WINDOW c AS ({partition} ORDER BY _chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), inner_sums AS (
  SELECT event_id, id, _chunk, sum(vc) OVER w AS sum_vc, count(id) OVER w AS ct
  FROM {view} WINDOW w AS (PARTITION BY {keys} _chunk ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
)
SELECT /*+ BROADCAST(carry) */ event_id, s.id, s.sum_vc + coalesce(carry.sum_vc, 0) AS sum_vc, s.ct + coalesce(carry.ct, 0) AS ct
FROM inner_sums s LEFT JOIN carry ON {same_key} s._chunk = carry._chunk
"""


@query("sql_over_named", f"""WITH {SENSOR_SQL}
SELECT event_id, id, CAST(sum(vc) OVER w AS BIGINT) AS sum_vc, count(id) OVER w AS ct
FROM s WINDOW w AS (PARTITION BY id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def sql_over_named(spark, sf):
    """Two aggregates on one named window, in SQL over a view whose hot ids are cut in chunks.

    The carry has a row per chunk of a hot id, at most ``scan.MAX_CUTS`` and the hot ids.
    """
    scan.chunked(sensors(spark, sf), ["id"], ["ts", "event_id"]).createOrReplaceTempView("sensor_by_id")
    return spark.sql(_OVER_SQL.format(
        view="sensor_by_id", keys="id,", partition="PARTITION BY id", same_key="s.id <=> carry.id AND",
    ))


@query("sql_over_global", f"""WITH {SENSOR_SQL}
SELECT event_id, id, CAST(sum(vc) OVER w AS BIGINT) AS sum_vc, count(id) OVER w AS ct
FROM s WINDOW w AS (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def sql_over_global(spark, sf):
    """The same over the whole table: only the chunk sums meet in one task."""
    scan.chunked(sensors(spark, sf), [], ["ts", "event_id"]).createOrReplaceTempView("sensor_in_order")
    return spark.sql(_OVER_SQL.format(view="sensor_in_order", keys="", partition="", same_key=""))


# Changelog

@query("changelog_count", f"""WITH {SENSOR_SQL}, c AS (
  SELECT event_id, id, row_number() OVER (PARTITION BY id ORDER BY event_id) AS ct FROM s)
SELECT event_id, id, true AS op, ct FROM c
UNION ALL SELECT event_id, id, false, ct - 1 FROM c WHERE ct > 1""")
def changelog_count(spark, sf):
    return changelog.count_changes(sensors(spark, sf).select("event_id", "id"), "id", ["event_id"])

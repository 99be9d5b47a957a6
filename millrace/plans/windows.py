"""Time, session and count windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import windows
from millrace.plans.registry import HOUR_US, SENSOR_SQL, bucket, hop, query
from millrace.plans.rows import sensors
from millrace.sources import tables

CT = "ct"


def _ct():
    return F.count(F.lit(1)).alias(CT)


def _tumble_sql(key: str, us: int, aggs: str, hours: int) -> str:
    return f"""WITH {SENSOR_SQL}
SELECT {key}, {bucket(us)} AS window_start, {bucket(us)} + INTERVAL {hours} HOUR AS window_end, {aggs}
FROM s GROUP BY ALL"""


def _slide_sql(key: str, slide_h: int, size_h: int, aggs: str) -> str:
    """Every window start on the slide that is at most the size before the row."""
    us, size = slide_h * HOUR_US, size_h * HOUR_US
    panes = -(-size_h // slide_h)
    return f"""WITH {SENSOR_SQL}, h AS ({hop(us, panes, 's', f'{key}, event_id, vc')})
SELECT {key}, window_start, window_start + INTERVAL {size_h} HOUR AS window_end, {aggs}
FROM h WHERE epoch_us(ts) - epoch_us(window_start) < {size} GROUP BY {key}, window_start"""


def session_sql(key: str, gap: str, aggs: str) -> str:
    return f"""WITH {SENSOR_SQL}, p AS (
  SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL {gap} THEN 1 ELSE 0 END AS opens
  FROM s WINDOW w AS (PARTITION BY {key} ORDER BY ts, event_id)),
n AS (SELECT *, sum(opens) OVER (PARTITION BY {key} ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS no FROM p)
SELECT {key}, min(ts) AS window_start, max(ts) + INTERVAL {gap} AS window_end, {aggs} FROM n GROUP BY {key}, no"""


def _typed(spark, sf):
    return tables.events(spark, sf).select("event_id", "ts", "event_type", F.floor("value").alias("vc"))


@query("win_tumbling_count", _tumble_sql("event_type", 5 * HOUR_US, "count(*) AS ct", 5))
def win_tumbling_count(spark, sf):
    return windows.tumbling(_typed(spark, sf), "ts", "5 hours", ["event_type"], _ct())


@query("win_full_list", _tumble_sql("event_type", 5 * HOUR_US, "CAST(len(list(vc)) AS BIGINT) AS size", 5))
def win_full_list(spark, sf):
    """Size of the list of all rows of a window, found without building the list."""
    return windows.tumbling(_typed(spark, sf), "ts", "5 hours", ["event_type"], F.count(F.lit(1)).alias("size"))


@query("win_sliding_count", _slide_sql("event_type", 3, 5, "count(*) AS ct"))
def win_sliding_count(spark, sf):
    return windows.sliding(_typed(spark, sf), "ts", "5 hours", "3 hours", ["event_type"], _ct())


@query("win_session_count", session_sql("event_type", "30 MINUTE", "count(*) AS ct"))
def win_session_count(spark, sf):
    return windows.sessions(_typed(spark, sf), "ts", "30 minutes", ["event_type"], {"ct": F.count(F.lit(1))})


TUMBLING_SUM_SQL = _tumble_sql(
    "id", 5 * HOUR_US, "CAST(sum(vc) AS BIGINT) AS sum_vc, arg_min(ts, event_id) AS first_ts", 5
)
SLIDING_SUM_SQL = _slide_sql("id", 2, 5, "CAST(sum(vc) AS BIGINT) AS sum_vc")
SESSION_SUM_SQL = session_sql("id", "8 HOUR", "CAST(sum(vc) AS BIGINT) AS sum_vc, count(*) AS ct")


@query("win_tumbling_sum", TUMBLING_SUM_SQL)
def win_tumbling_sum(spark, sf):
    return windows.tumbling(
        sensors(spark, sf), "ts", "5 hours", ["id"],
        F.sum("vc").alias("sum_vc"), F.min_by("ts", "event_id").alias("first_ts"),
    )


@query("win_sliding_sum", SLIDING_SUM_SQL)
def win_sliding_sum(spark, sf):
    return windows.sliding(sensors(spark, sf), "ts", "5 hours", "2 hours", ["id"], F.sum("vc").alias("sum_vc"))


@query("win_session_sum", SESSION_SUM_SQL)
def win_session_sum(spark, sf):
    return windows.sessions(
        sensors(spark, sf), "ts", "8 hours", ["id"], {"sum_vc": F.sum("vc"), "ct": F.count(F.lit(1))}
    )


_COUNT_TUMBLE_SQL = f"""WITH {SENSOR_SQL}, n AS (
  SELECT *, (row_number() OVER (PARTITION BY id ORDER BY event_id) - 1) // 5 AS group_no FROM s)
SELECT id, group_no, count(*) AS ct, CAST(sum(vc) AS BIGINT) AS sum_vc FROM n GROUP BY id, group_no HAVING count(*) = 5"""


def _count_slide_sql(fires: str) -> str:
    return f"""WITH {SENSOR_SQL}, n AS (
  SELECT id, row_number() OVER (PARTITION BY id ORDER BY event_id) AS rn, count(*) OVER w AS ct,
         CAST(sum(vc) OVER w AS BIGINT) AS total
  FROM s WINDOW w AS (PARTITION BY id ORDER BY event_id ROWS 4 PRECEDING))
SELECT id, rn, ct, total FROM n WHERE {fires}"""


def _count_tumbling(spark, sf):
    return windows.count_tumbling(
        sensors(spark, sf), "id", ["event_id"], 5, _ct(), F.sum("vc").alias("sum_vc")
    )


@query("win_count_tumbling", _COUNT_TUMBLE_SQL)
def win_count_tumbling(spark, sf):
    return _count_tumbling(spark, sf)


@query("win_count_sliding", _count_slide_sql("rn % 2 = 0"))
def win_count_sliding(spark, sf):
    return windows.count_sliding(sensors(spark, sf), "id", ["event_id"], 5, 2, "vc")


# Table and SQL group windows

@query("tw_tumble", _tumble_sql("id", 5 * HOUR_US, "count(id) AS ct", 5))
def tw_tumble(spark, sf):
    return windows.tumbling(sensors(spark, sf), "ts", "5 hours", ["id"], F.count("id").alias(CT))


@query("tw_slide", _slide_sql("id", 2, 5, "count(id) AS ct"))
def tw_slide(spark, sf):
    return windows.sliding(sensors(spark, sf), "ts", "5 hours", "2 hours", ["id"], F.count("id").alias(CT))


@query("tw_session", session_sql("id", "5 HOUR", "count(id) AS ct"))
def tw_session(spark, sf):
    return windows.sessions(sensors(spark, sf), "ts", "5 hours", ["id"], {CT: F.count("id")})


@query("tw_count_tumble", _COUNT_TUMBLE_SQL)
def tw_count_tumble(spark, sf):
    return _count_tumbling(spark, sf)


@query("tw_count_slide", _count_slide_sql("rn >= 5 AND (rn - 5) % 2 = 0"))
def tw_count_slide(spark, sf):
    """The first result comes with the fifth row."""
    return windows.count_sliding(sensors(spark, sf), "id", ["event_id"], 5, 2, "vc", full_only=True)


def _sql(spark, sf, text):
    return spark.sql(text, s=sensors(spark, sf))


@query("sql_tumble", f"""WITH {SENSOR_SQL}
SELECT id, count(id) AS ct, {bucket(5 * HOUR_US)} AS window_start FROM s GROUP BY id, window_start""")
def sql_tumble(spark, sf):
    return _sql(spark, sf, """
        SELECT id, count(id) AS ct, w.start AS window_start
        FROM (SELECT id, window(ts, '5 hours') AS w FROM {s}) GROUP BY id, w""")


@query("sql_hop", f"SELECT id, ct, window_start FROM ({_slide_sql('id', 2, 5, 'count(id) AS ct')})")
def sql_hop(spark, sf):
    return _sql(spark, sf, """
        SELECT id, count(id) AS ct, window.start AS window_start
        FROM {s} GROUP BY id, window(ts, '5 hours', '2 hours')""")


@query("sql_session", f"SELECT id, ct, window_start FROM ({session_sql('id', '5 HOUR', 'count(id) AS ct')})")
def sql_session(spark, sf):
    """SQL session windows. Sessions of a key are merged within each task before the shuffle."""
    spark.conf.set("spark.sql.sessionWindow.merge.sessions.in.local.partition", "true")
    return _sql(spark, sf, """
        SELECT id, count(id) AS ct, session_window.start AS window_start
        FROM {s} GROUP BY id, session_window(ts, '5 hours')""")

"""Joins of two streams and sequence patterns, on bounded tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import joins, patterns
from millrace.plans.registry import query
from millrace.sources import tables

H = 3600
ORDER = ["ts", "event_id"]

INTERVAL_SQL = """
SELECT l.user_id, l.event_id AS left_id, r.event_id AS right_id
FROM events l JOIN events r ON l.user_id = r.user_id
 AND r.ts BETWEEN l.ts - INTERVAL 5 HOUR AND l.ts + INTERVAL 10 HOUR
WHERE l.event_type = 'purchase' AND r.event_type = 'click'"""


def of_type(events, kind: str):
    return events.where(F.col("event_type") == kind)


def interval_pairs(purchases, clicks):
    left = purchases.select("user_id", F.col("event_id").alias("left_id"), F.col("ts").alias("left_ts"))
    right = clicks.select(
        F.col("user_id").alias("right_user"), F.col("event_id").alias("right_id"), F.col("ts").alias("right_ts")
    )
    pairs = joins.interval_join(left, right, ("user_id", "right_user"), ("left_ts", "right_ts"), 5 * H, 10 * H)
    return pairs.select("user_id", "left_id", "right_id")


@query("interval_join", INTERVAL_SQL)
def interval_join(spark, sf):
    events = tables.events(spark, sf)
    return interval_pairs(of_type(events, "purchase"), of_type(events, "click"))


_RECONCILE_SQL = """
WITH r AS (SELECT l_orderkey, min(l_shipdate) AS right_ts FROM lineitem GROUP BY l_orderkey),
j AS (
  SELECT coalesce(o_orderkey, l_orderkey) AS k, o_orderdate AS left_ts, right_ts
  FROM orders FULL OUTER JOIN r ON o_orderkey = l_orderkey
   AND right_ts BETWEEN o_orderdate - INTERVAL 365 DAY AND o_orderdate + INTERVAL 730 DAY)
SELECT k, left_ts, right_ts,
  CASE WHEN right_ts IS NULL THEN 'left_only' WHEN left_ts IS NULL THEN 'right_only' ELSE 'matched' END AS outcome
FROM j"""


def _reconciled(spark, sf):
    orders = tables.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_orderdate").alias("ts"), F.lit(0).alias("n")
    )
    receipts = tables.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(
        F.min("l_shipdate").alias("ts"), F.lit(0).alias("n")
    )
    return joins.reconcile(orders, receipts, "k", "ts", "730 days", "365 days", "n")


@query("reconcile", _RECONCILE_SQL)
def reconcile(spark, sf):
    return _reconciled(spark, sf)


@query("reconcile_left_only", f"SELECT k, left_ts FROM ({_RECONCILE_SQL}) WHERE outcome = 'left_only'")
def reconcile_left_only(spark, sf):
    return _reconciled(spark, sf).where("outcome = 'left_only'").select("k", "left_ts")


@query("reconcile_right_only", f"SELECT k, right_ts FROM ({_RECONCILE_SQL}) WHERE outcome = 'right_only'")
def reconcile_right_only(spark, sf):
    return _reconciled(spark, sf).where("outcome = 'right_only'").select("k", "right_ts")


# Rows next to each other that fit are linked; each run of linked rows pairs off from its start.
RECONCILE_EVENTS_SQL = """
WITH b AS (
  SELECT user_id, ts, event_id, event_type = 'purchase' AS is_left FROM events WHERE event_type IN ('purchase', 'click')),
p AS (SELECT *, row_number() OVER w AS rn, lag(is_left) OVER w AS prev_left, lag(ts) OVER w AS prev_ts
      FROM b WINDOW w AS (PARTITION BY user_id ORDER BY ts, is_left, event_id)),
f AS (SELECT *, prev_left IS NOT NULL AND prev_left <> is_left AND
        ts <= prev_ts + CASE WHEN prev_left THEN INTERVAL 10 HOUR ELSE INTERVAL 5 HOUR END AS fits FROM p),
c AS (SELECT *, max(CASE WHEN fits THEN NULL ELSE rn END) OVER (PARTITION BY user_id ORDER BY rn) AS chain FROM f),
g AS (SELECT user_id, max(ts) FILTER (is_left) AS left_ts, max(ts) FILTER (NOT is_left) AS right_ts
      FROM c GROUP BY user_id, rn - (rn - chain) % 2)
SELECT user_id, left_ts, right_ts,
  CASE WHEN right_ts IS NULL THEN 'left_only' WHEN left_ts IS NULL THEN 'right_only' ELSE 'matched' END AS outcome
FROM g"""


@query("reconcile_events", RECONCILE_EVENTS_SQL)
def reconcile_events(spark, sf):
    """Purchases and clicks of a user, whose keys repeat."""
    events = tables.events(spark, sf)
    return joins.reconcile(
        of_type(events, "purchase"), of_type(events, "click"), "user_id", "ts", "10 hours", "5 hours", "event_id"
    )


# What each control value appends to a row, and what any other value does.
SWITCHES = {"1": "读取了广播状态，切换1", "2": "读取了广播状态，切换2"}
OTHERWISE = "读取了广播状态，切换其他"


@query("control_switch", f"""
WITH t AS (
  SELECT event_id, event_type, last_value(CASE WHEN event_type = 'error' THEN CAST(event_id % 3 AS VARCHAR) END IGNORE NULLS)
    OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS setting FROM events)
SELECT event_id, event_type || CASE setting WHEN '1' THEN '{SWITCHES["1"]}' WHEN '2' THEN '{SWITCHES["2"]}' ELSE '{OTHERWISE}' END AS value
FROM t WHERE event_type <> 'error'""")
def control_switch(spark, sf):
    """Errors act as control rows that switch how the rows after them are handled."""
    events = tables.events(spark, sf).select("event_id", F.col("event_type").alias("value"))
    control = events.where("value = 'error'").select("event_id", (F.col("event_id") % 3).cast("string").alias("setting"))
    rows = joins.controlled(events.where("value <> 'error'"), control, "event_id", "value", "setting")
    return rows.select("event_id", F.concat("value", switched(F.col("setting"))).alias("value"))


def switched(setting):
    text = F.lit(OTHERWISE)
    for value, suffix in SWITCHES.items():
        text = F.when(setting == value, F.lit(suffix)).otherwise(text)
    return text


REPEAT_SQL = """
WITH p AS (SELECT user_id, ts, event_type, lag(event_type) OVER w AS pt, lag(ts) OVER w AS pts
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, pts AS start_ts, ts AS end_ts FROM p
WHERE event_type = '{second}' AND pt = '{first}' AND ts - pts < INTERVAL {within}"""


@query("pat_repeat", REPEAT_SQL.format(first="error", second="error", within="6 HOUR"))
def pat_repeat(spark, sf):
    return patterns.repeated(tables.events(spark, sf), "user_id", ORDER, F.col("event_type") == "error", 2, "6 hours")


@query("pat_repeat_three", """
WITH p AS (SELECT user_id, ts, event_type = 'error' AND lag(event_type) OVER w = 'error' AND lag(event_type, 2) OVER w = 'error' AS hit,
                  lag(ts, 2) OVER w AS pts
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, pts AS start_ts, ts AS end_ts FROM p WHERE hit AND ts - pts < INTERVAL 48 HOUR""")
def pat_repeat_three(spark, sf):
    return patterns.repeated(tables.events(spark, sf), "user_id", ORDER, F.col("event_type") == "error", 3, "48 hours")


@query("pat_next", REPEAT_SQL.format(first="view", second="click", within="12 HOUR"))
def pat_next(spark, sf):
    kind = F.col("event_type")
    return patterns.strict(tables.events(spark, sf), "user_id", ORDER, [kind == "view", kind == "click"], "12 hours")


PAT_SQL = """
WITH p AS (SELECT user_id, ts, event_type,
    min(CASE WHEN event_type = 'purchase' THEN ts END) OVER (
      PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS pay
  FROM events)
SELECT user_id, ts AS start_ts,
  CASE WHEN pay < ts + INTERVAL 1 DAY THEN pay ELSE ts + INTERVAL 1 DAY END AS end_ts,
  CASE WHEN pay < ts + INTERVAL 1 DAY THEN 'match' ELSE 'timeout' END AS outcome
FROM p WHERE event_type = 'signup'"""


def _followed(spark, sf):
    kind = F.col("event_type")
    return patterns.followed_by(
        tables.events(spark, sf), "user_id", ORDER, kind == "signup", kind == "purchase", "1 day"
    )


@query("pat_followed_by", f"SELECT user_id, start_ts, end_ts FROM ({PAT_SQL}) WHERE outcome = 'match'")
def pat_followed_by(spark, sf):
    return _followed(spark, sf).where("outcome = 'match'").drop("outcome")


@query("pat_timeout", f"SELECT user_id, start_ts, end_ts FROM ({PAT_SQL}) WHERE outcome = 'timeout'")
def pat_timeout(spark, sf):
    return _followed(spark, sf).where("outcome = 'timeout'").drop("outcome")

"""Analytics jobs: page views, unique visitors and hot items, on bounded tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import ranking, running, uniques, windows
from millrace.plans.registry import HOUR_US, bucket, query
from millrace.sources import tables

VIEWS_SQL = "v AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item FROM events WHERE event_type = 'view')"
_HOUR = f"{bucket(HOUR_US)} AS window_start, {bucket(HOUR_US)} + INTERVAL 1 HOUR AS window_end"


def views(events):
    return tables.behavior(events).where("behavior = 'view'")


def _views(spark, sf):
    return views(tables.events(spark, sf))


PV_SQL = f"WITH {VIEWS_SQL} SELECT {_HOUR}, count(*) AS pv FROM v GROUP BY ALL"
UV_SQL = f"WITH {VIEWS_SQL} SELECT {_HOUR}, count(DISTINCT user_id) AS uv FROM v GROUP BY ALL"


@query("pv_hourly", PV_SQL)
def pv_hourly(spark, sf):
    return windows.tumbling(_views(spark, sf), "ts", "1 hour", [], F.count(F.lit(1)).alias("pv"))


@query("pv_salted", PV_SQL)
def pv_salted(spark, sf):
    """The same in two phases over eight salts, giving each window's final sum once."""
    window = F.window("ts", "1 hour")
    counts = running.salted_agg(
        _views(spark, sf), [window["start"], window["end"]], F.pmod(F.hash("event_id"), F.lit(8)),
        [F.count(F.lit(1)).alias("n")], [F.sum("n").alias("pv")],
    )
    return counts.select(F.col("_g0").alias("window_start"), F.col("_g1").alias("window_end"), "pv")


@query("uv_exact", UV_SQL)
def uv_exact(spark, sf):
    return uniques.exact(_views(spark, sf), "ts", "1 hour", "user_id")


@query("uv_bitmap", f"""WITH {VIEWS_SQL}, o AS (
  SELECT event_id, ts,
         CAST(sum(ascii(substr(u, k, 1)) * (32 ** (length(u) - k))) AS BIGINT) & 1073741823 AS bit
  FROM (SELECT event_id, ts, CAST(user_id AS VARCHAR) AS u FROM v), (SELECT CAST(unnest(range(1, 20)) AS INTEGER) AS k)
  WHERE k > length(u) - 6 AND k <= length(u) GROUP BY event_id, ts)
SELECT {_HOUR}, count(DISTINCT bit) AS uv FROM o GROUP BY ALL""")
def uv_bitmap(spark, sf):
    return uniques.by_bitmap(_views(spark, sf), "ts", "1 hour", "user_id")


@query("uv_hll", f"SELECT window_start, window_end, true AS close FROM ({UV_SQL})")
def uv_hll(spark, sf):
    """Whether each window's estimate lies within one visitor or 5 % of the exact count."""
    views = _views(spark, sf)
    exact = uniques.exact(views, "ts", "1 hour", "user_id").withColumnRenamed("uv", "exact")
    both = uniques.by_sketch(views, "ts", "1 hour", "user_id").join(exact, ["window_start", "window_end"])
    off = F.abs(F.col("uv") - F.col("exact"))
    return both.select("window_start", "window_end", (off <= F.greatest(F.lit(1), F.col("exact") * 0.05)).alias("close"))


@query("uv_running", f"""WITH {VIEWS_SQL}, f AS (
  SELECT {bucket(HOUR_US)} AS window_start, user_id, min(event_id) AS event_id FROM v GROUP BY ALL)
SELECT window_start, user_id, event_id, row_number() OVER (PARTITION BY window_start ORDER BY event_id) AS uv FROM f""")
def uv_running(spark, sf):
    return uniques.running(_views(spark, sf), "ts", "1 hour", "user_id", "event_id")


_COUNTS_SQL = f"""{VIEWS_SQL}, h AS (
  SELECT make_timestamp((epoch_us(ts) // 300000000 - i) * 300000000) AS window_start, item FROM v, range(12) r(i)),
c AS (SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, item, count(*) AS ct FROM h GROUP BY ALL)"""
TOP_SQL = f"""WITH {_COUNTS_SQL}
SELECT window_end, rank, item, ct FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY ct DESC, item) AS rank FROM c) WHERE rank <= 5"""


@query("item_counts", f"WITH {_COUNTS_SQL} SELECT window_start, window_end, item, ct FROM c")
def item_counts(spark, sf):
    return ranking.item_counts(_views(spark, sf))


@query("item_top_n", TOP_SQL)
def item_top_n(spark, sf):
    return ranking.top_n(ranking.item_counts(_views(spark, sf)))

"""Operators must give the same rows whether or not a hot key is cut into chunks."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import changelog, eventtime, joins, patterns, running, scan, uniques, windows
from millrace.sources import tables

ORDER = ["ts", "event_id"]


@pytest.fixture(scope="module")
def events(spark, sf):
    """Events of which a third belong to one user."""
    hot = F.when(F.pmod(F.hash("event_id"), F.lit(3)) == 0, F.lit(0)).otherwise(F.col("user_id"))
    return tables.events(spark, sf).withColumn("user_id", hot)


def sensor(events):
    return tables.sensor(events)


def arrivals(events):
    return tables.sensor(events).withColumn("arrival", tables.disordered_arrival())


def is_(kind):
    return F.col("event_type") == kind


OPERATORS = {
    "running_max": lambda e, kw: running.running_max(sensor(e), "id", "vc", ["ts"], ["event_id"], **kw),
    "running_max_row": lambda e, kw: running.running_max_row(sensor(e), "id", "vc", ["ts"], "event_id", **kw),
    "running_reduce": lambda e, kw: running.running_reduce(sensor(e), "id", "ts", "vc", ["event_id"], **kw),
    "sessions": lambda e, kw: windows.sessions(sensor(e), "ts", "2 hours", ["id"], {"ct": F.count(F.lit(1))}, **kw),
    "count_tumbling": lambda e, kw: windows.count_tumbling(
        sensor(e), "id", ["event_id"], 5, F.sum("vc").alias("s"), **kw),
    "count_sliding": lambda e, kw: windows.count_sliding(sensor(e), "id", ["event_id"], 5, 2, "vc", **kw),
    "reconcile": lambda e, kw: joins.reconcile(
        e.where(is_("purchase")), e.where(is_("click")), "user_id", "ts", "10 hours", "5 hours", "event_id", **kw),
    "repeated": lambda e, kw: patterns.repeated(e, "user_id", ORDER, is_("error"), 3, "2 days", **kw),
    "followed_by": lambda e, kw: patterns.followed_by(
        e, "user_id", ORDER, is_("signup"), is_("purchase"), "1 day", **kw),
    "changelog": lambda e, kw: changelog.count_changes(sensor(e).select("event_id", "id"), "id", ["event_id"], **kw),
    "uv_running": lambda e, kw: uniques.running(e, "ts", "1 day", "user_id", "event_id", **kw),
    "late_classes": lambda e, kw: eventtime.late_classes(
        arrivals(e), ["arrival", "event_id"], "ts", "1 hour", "2 hours", "2 hours", **kw),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_cut_or_whole(events, name):
    whole = sorted(map(repr, OPERATORS[name](events, {}).collect()))
    cut = sorted(map(repr, OPERATORS[name](events, {"hot_rows": 40}).collect()))
    assert whole and cut == whole


def test_interval_join_spreads_a_hot_key(events):
    """Every pair once, against a plain range join; the join keys include a time bucket."""
    left = events.where(is_("purchase")).select("user_id", F.col("event_id").alias("a"), F.col("ts").alias("lt"))
    right = events.where(is_("click")).select(
        F.col("user_id").alias("ru"), F.col("event_id").alias("b"), F.col("ts").alias("rt"))
    got = joins.interval_join(left, right, ("user_id", "ru"), ("lt", "rt"), 5 * 3600, 10 * 3600)
    plain = left.join(right, (F.col("user_id") == F.col("ru"))
                      & F.expr("rt BETWEEN lt - INTERVAL 5 HOURS AND lt + INTERVAL 10 HOURS"))
    pairs = sorted((r.a, r.b) for r in got.collect())
    assert len(pairs) == len(set(pairs)) > 0
    assert pairs == sorted((r.a, r.b) for r in plain.collect())
    assert "_rbucket" in got._jdf.queryExecution().optimizedPlan().toString()


def test_filter_on_a_chunk_stays_small(events):
    """A predicate pushed through the chunk search must not copy it many times."""
    rows = scan.chunked(events, [], ORDER, hot_rows=3).where(f"{scan.CHUNK} > 1")
    assert len(rows._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    assert rows.count() > 0

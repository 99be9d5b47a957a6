"""Keyed scans with a small ``hot_rows``, so that the cut path runs on small tables too."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import joins, patterns, running, scan
from millrace.plans import aggregates, matching  # noqa: F401  (their SQL is shared)
from millrace.plans.matching import ORDER, of_type
from millrace.plans.registry import ORACLES, query
from millrace.plans.rows import document_words, sensors
from millrace.sources import tables

HOT = 20


@query("word_count_running_cut", ORACLES["word_count_running"])
def word_count_running_cut(spark, sf):
    return scan.keyed_scan(
        document_words(spark, sf), ["word"], ["doc_id", "line_no", "pos"], scan.running_count("ct"), hot_rows=10 * HOT
    )


@query("running_max_cut", ORACLES["running_max"])
def running_max_cut(spark, sf):
    return running.running_max(sensors(spark, sf), "id", "vc", ["ts"], ["event_id"], hot_rows=HOT).drop("ts", "vc")


@query("over_unbounded_cut", ORACLES["over_unbounded"])
def over_unbounded_cut(spark, sf):
    rows = scan.keyed_scan(
        sensors(spark, sf), ["id"], ["ts", "event_id"], scan.running_sum("sum_vc", F.col("vc")), hot_rows=HOT)
    return rows.select("event_id", "id", "sum_vc")


@query("reconcile_cut", ORACLES["reconcile_events"])
def reconcile_cut(spark, sf):
    events = tables.events(spark, sf)
    return joins.reconcile(
        of_type(events, "purchase"), of_type(events, "click"), "user_id", "ts", "10 hours", "5 hours", "event_id", hot_rows=5)


@query("pat_followed_by_cut", ORACLES["pat_followed_by"])
def pat_followed_by_cut(spark, sf):
    kind = F.col("event_type")
    found = patterns.followed_by(
        tables.events(spark, sf), "user_id", ORDER, kind == "signup", kind == "purchase", "1 day", hot_rows=5)
    return found.where("outcome = 'match'").drop("outcome")

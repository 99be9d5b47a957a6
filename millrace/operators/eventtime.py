"""Watermarks and late rows, row-exact on bounded tables.

A live watermark moves once per micro-batch. Here it is traced per row over the arrival
order, as a prefix maximum of the event time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import scan


def interval(text: str) -> Column:
    return F.expr(f"INTERVAL {text}")


def watermark_trace(df: DataFrame, order: Sequence[str], ts: str, delay: str, **kw) -> DataFrame:
    """The watermark after each arriving row: largest event time so far less ``delay``."""
    rows = scan.keyed_scan(df, [], order, scan.running_max("_max", F.col(ts)), **kw)
    return rows.withColumn("watermark", F.col("_max") - interval(delay)).drop("_max")


def late_classes(
    df: DataFrame, order: Sequence[str], ts: str, size: str, delay: str, lateness: str, **kw
) -> DataFrame:
    """Class of each row for tumbling windows of ``size``: on_time, allowed or too_late.

    The watermark met by a row is the one left by the rows before it, one millisecond below
    the largest time less the delay. A window's last instant is its end less a millisecond.
    """
    rows = scan.keyed_scan(df, [], order, scan.running_max("_max", F.col(ts), inclusive=False), **kw)
    ms = interval("1 millisecond")
    watermark = F.col("_max") - interval(delay) - ms
    last = F.col("window_end") - ms
    return (
        rows.withColumn("window_start", F.window(ts, size)["start"])
        .withColumn("window_end", F.col("window_start") + interval(size))
        .withColumn(
            "class",
            F.when(F.col("_max").isNull() | (last > watermark), "on_time")
            .when(last + interval(lateness) > watermark, "allowed")
            .otherwise("too_late"),
        )
        .drop("_max")
    )


def with_event_time(df: DataFrame, seconds: str, name: str = "rt", delay: str | None = None) -> DataFrame:
    """Event time from epoch seconds; with ``delay`` also declares the live watermark."""
    timed = df.withColumn(name, F.timestamp_seconds(F.col(seconds)))
    return timed.withWatermark(name, delay) if delay else timed


def with_processing_time(df: DataFrame, name: str = "pt") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())

"""Sequence patterns over the time-ordered rows of a key.

Every start row begins its own match and matches may overlap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import scan
from millrace.operators.eventtime import interval


def repeated(df: DataFrame, key: str, order: Sequence[str], holds: Column, times: int, within: str, **kw) -> DataFrame:
    """``times`` adjacent rows of a key that all satisfy ``holds``, first to last in less than ``within``."""
    return strict(df, key, order, [holds] * times, within, **kw)


def strict(df: DataFrame, key: str, order: Sequence[str], stages: Sequence[Column], within: str, **kw) -> DataFrame:
    """Adjacent rows of a key that satisfy the stages in turn, in less than ``within``."""
    ts, n = order[0], len(stages)
    flags = F.struct(F.col(ts).alias("t"), *[c.alias(f"s{i}") for i, c in enumerate(stages[:-1])])
    rows = scan.keyed_scan(
        df.withColumn("_ends", stages[-1]), [key], order, scan.previous_rows("_prev", flags, n - 1), **kw
    )
    matched = F.col("_ends") & (F.size("_prev") == n - 1)
    for i in range(n - 1):
        matched &= F.get("_prev", F.lit(i))[f"s{i}"]
    start = F.get("_prev", F.lit(0))["t"]
    return rows.where(matched & (F.col(ts) < start + interval(within))).select(
        key, start.alias("start_ts"), F.col(ts).alias("end_ts")
    )


def with_follower(
    df: DataFrame, key: str, order: Sequence[str], start: Column, then: Column, **kw
) -> DataFrame:
    """The start rows, with the time of the first later ``then`` row of their key in ``next_ts``.

    One backward scan; only rows of the two kinds are shuffled.
    """
    kinds = df.where(start | then).withColumn("_start", start).withColumn("_at", F.when(then, F.col(order[0])))
    rows = scan.keyed_scan(
        kinds, [key], order, scan.running_last("next_ts", F.col("_at"), inclusive=False), reverse=True, bound=df, **kw
    )
    return rows.where("_start").drop("_start", "_at")


def outcomes(starts: DataFrame, key: str, ts: str, within: str) -> DataFrame:
    """``match`` for a start whose follower comes in less than ``within``, else ``timeout``."""
    due = F.col(ts) + interval(within)
    matched = F.coalesce(F.col("next_ts") < due, F.lit(False))
    return starts.select(
        key,
        F.col(ts).alias("start_ts"),
        F.when(matched, F.col("next_ts")).otherwise(due).alias("end_ts"),
        F.when(matched, "match").otherwise("timeout").alias("outcome"),
    )


def followed_by(
    df: DataFrame, key: str, order: Sequence[str], start: Column, then: Column, within: str, **kw
) -> DataFrame:
    """Each start row with the first later ``then`` row, whatever lies between.

    ``outcome`` is ``match`` when that comes in less than ``within``, else ``timeout`` with
    the time the wait ended.
    """
    return outcomes(with_follower(df, key, order, start, then, **kw), key, order[0], within)

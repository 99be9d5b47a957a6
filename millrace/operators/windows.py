"""Tumbling, sliding, session and count windows.

Time windows are half-open and aligned to the epoch. The functions take bounded tables and
streams alike unless a docstring says otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import scan
from millrace.operators.eventtime import interval

BOUNDS = ["window_start", "window_end"]


def _bounds(grouped: DataFrame) -> DataFrame:
    rest = [c for c in grouped.columns if c != "window"]
    return grouped.select(F.col("window.start").alias(BOUNDS[0]), F.col("window.end").alias(BOUNDS[1]), *rest)


def tumbling(df: DataFrame, ts: str, size: str, keys: Sequence[str], *aggs: Column) -> DataFrame:
    return _bounds(df.groupBy(F.window(ts, size), *keys).agg(*aggs))


def sliding(df: DataFrame, ts: str, size: str, slide: str, keys: Sequence[str], *aggs: Column) -> DataFrame:
    """Each row counts in every window that covers it.

    Rows are copied once per covering window before the map-side aggregate; for windows that
    overlap many times use :func:`sliding_count`.
    """
    return _bounds(df.groupBy(F.window(ts, size, slide), *keys).agg(*aggs))


def sliding_count(
    df: DataFrame, ts: str, slide: str, panes: int, keys: Sequence[str], name: str = "ct"
) -> DataFrame:
    """Counts in windows of ``panes`` slides each, on a bounded table.

    Counts once per slide-long pane and key and then copies the pane counts, not the rows,
    to the windows that cover them.
    """
    per_pane = tumbling(df, ts, slide, keys, F.count(F.lit(1)).alias("n"))
    back = F.transform(F.sequence(F.lit(0), F.lit(panes - 1)), lambda i: F.col(BOUNDS[0]) - i * interval(slide))
    covered = per_pane.select(*keys, "n", F.explode(back).alias(BOUNDS[0]))
    return covered.groupBy(BOUNDS[0], *keys).agg(F.sum("n").alias(name)).select(
        BOUNDS[0], (F.col(BOUNDS[0]) + panes * interval(slide)).alias(BOUNDS[1]), *keys, name
    )


def sessions(df: DataFrame, ts: str, gap: str, keys: Sequence[str], sums: dict[str, Column], **kw) -> DataFrame:
    """Sessions of a bounded table: rows at most ``gap`` apart share one; it ends a gap after its last row.

    All rows of a key within one gap-long slot are in the same session, so rows are first
    summed per slot. What is put in order per key is then at most one row per slot, however
    many rows a hot key has.
    """
    slots = df.groupBy(*keys, F.window(ts, gap).alias("_slot")).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), *[c.alias(n) for n, c in sums.items()]
    ).drop("_slot")
    cuts = scan.cut_points(slots, keys, ["_first"], bound=df, **kw)
    after = scan.keyed_scan(
        slots, keys, ["_first"], scan.running_max("_prev", F.col("_last"), inclusive=False), cuts=cuts
    )
    opens = F.col("_prev").isNull() | (F.col("_first") > F.col("_prev") + interval(gap))
    numbered = scan.keyed_scan(
        after.withColumn("_opens", opens.cast("int")), keys, ["_first"],
        scan.running_sum("_session", F.col("_opens")), cuts=cuts,
    )
    return numbered.groupBy(*keys, "_session").agg(
        F.min("_first").alias(BOUNDS[0]),
        (F.max("_last") + interval(gap)).alias(BOUNDS[1]),
        *[F.sum(n).alias(n) for n in sums],
    ).drop("_session")


def live_sessions(df: DataFrame, ts: str, gap: str, keys: Sequence[str], *aggs: Column) -> DataFrame:
    """Sessions of a stream; needs a watermark and append mode."""
    return _bounds(df.groupBy(F.session_window(ts, gap).alias("window"), *keys).agg(*aggs))


def count_tumbling(df: DataFrame, key: str, order: Sequence[str], n: int, *aggs: Column, **kw) -> DataFrame:
    """One result per ``n`` rows of a key; an unfilled last group gives none."""
    rows = scan.keyed_scan(df, [key], order, scan.running_count("_rn"), **kw)
    numbered = rows.withColumn("group_no", F.floor((F.col("_rn") - 1) / n))
    grouped = numbered.groupBy(key, "group_no").agg(F.count(F.lit(1)).alias("_n"), *aggs)
    return grouped.where(F.col("_n") == n).drop("_n")


def count_sliding(
    df: DataFrame, key: str, order: Sequence[str], size: int, slide: int, col: str, full_only: bool = False, **kw
) -> DataFrame:
    """Every ``slide``-th row of a key, with count and sum of ``col`` over its last ``size`` rows.

    ``full_only`` holds the first result back until ``size`` rows are there and counts the
    slides from that row.
    """
    rows = scan.keyed_scan(
        df, [key], order,
        scan.running_count("rn"), scan.previous_rows("_prev", F.struct(F.col(col).alias("v")), size - 1), **kw,
    )
    rn = F.col("rn")
    fires = (rn >= size) & ((rn - size) % slide == 0) if full_only else rn % slide == 0
    return rows.where(fires).select(
        key, "rn",
        (F.size("_prev") + 1).cast("bigint").alias("ct"),
        F.aggregate("_prev", F.col(col), lambda a, r: a + r["v"]).alias("total"),
    )

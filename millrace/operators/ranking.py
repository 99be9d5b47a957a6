"""Counts per item and window, and the top items of each window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.windows import BOUNDS, sliding, sliding_count


def item_counts(views: DataFrame, ts: str = "ts", item: str = "item", slide: str = "5 minutes", panes: int = 12):
    """Views per item in sliding windows of ``panes`` slides."""
    return sliding_count(views, ts, slide, panes, [item])


def top_n(counts: DataFrame, n: int = 5, item: str = "item", count: str = "ct") -> DataFrame:
    """The ``n`` largest counts per window end, ties by item.

    The rank filter is pushed below the shuffle as a per-task limit, so a window sends at
    most ``n`` rows from each task.
    """
    w = Window.partitionBy(BOUNDS[1]).orderBy(F.col(count).desc(), F.col(item).asc())
    ranked = counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    return ranked.select(BOUNDS[1], F.col("rank").cast("bigint").alias("rank"), item, count)


def live_item_counts(views: DataFrame, ts: str = "ts", item: str = "item", size="1 hour", slide="5 minutes"):
    """Stream form of the counts: views are counted per slide-long pane first, and only a pane's
    count is copied to the windows over it. In append mode all counts of a window come in one batch, so
    :func:`top_n` on each batch gives the final ranking without a second state."""
    panes = views.groupBy(F.window(ts, slide).alias("pane"), item).agg(F.count(F.lit(1)).alias("n"))
    panes = panes.select(F.window_time("pane").alias("pane_time"), item, "n")
    return sliding(panes, "pane_time", size, slide, [item], F.sum("n").alias("ct"))

"""Live operators that look at one micro-batch at a time.

What a batch needs from earlier ones is a small stored value, written per batch, so a batch
that is run again reads the same value and overwrites its own output.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import patterns, uniques
from millrace.operators.eventtime import interval


class LateSplit:
    """Class each row against the watermark that the batches before it left.

    A live watermark moves once per batch: rows are late only against earlier batches. The
    largest event time up to each batch is kept under ``path``. Use as a ``foreachBatch``
    function; ``emit(classed, batch_id)`` gets the rows with their ``class``.
    """

    def __init__(self, path: str, ts: str, size: str, delay: str, lateness: str,
                 emit: Callable[[DataFrame, int], None]) -> None:
        self.path, self.ts, self.size, self.delay, self.lateness, self.emit = path, ts, size, delay, lateness, emit

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        so_far = None
        if batch_id > 0:
            so_far = spark.read.parquet(f"{self.path}/batch={batch_id - 1}").first()["max_ts"]
        ms = interval("1 millisecond")
        last = F.col("window_start") + interval(self.size) - ms
        watermark = F.lit(so_far).cast(batch.schema[self.ts].dataType) - interval(self.delay) - ms
        classed = batch.withColumn("window_start", F.window(self.ts, self.size)["start"]).withColumn(
            "class",
            F.when(watermark.isNull() | (last > watermark), "on_time")
            .when(last + interval(self.lateness) > watermark, "allowed")
            .otherwise("too_late"),
        )
        self.emit(classed, batch_id)
        newest = batch.agg(F.max(self.ts).alias("m")).select(
            F.greatest("m", F.lit(so_far).cast(batch.schema[self.ts].dataType)).alias("max_ts")
        )
        newest.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")


class RunningUnique:
    """One row per user first seen in a window, with the window's count so far, batch by batch.

    First sightings are kept under ``path``; a batch looks only at those of windows no older
    than its own. Use as a ``foreachBatch`` function; the rows of all batches are the result.
    """

    def __init__(self, path: str, ts: str, size: str, user: str, arrival: str) -> None:
        self.path, self.ts, self.size, self.user, self.arrival = path, ts, size, user, arrival

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        found = uniques.running(batch, self.ts, self.size, self.user, self.arrival)
        if batch_id > 0:
            found = self._beyond(batch, batch_id)
        found.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def _beyond(self, batch: DataFrame, batch_id: int) -> DataFrame:
        start = F.window(self.ts, self.size)["start"]
        oldest = batch.agg(F.min(start).alias("w")).first()["w"]
        known = batch.sparkSession.read.parquet(self.path).where(
            (F.col("batch") < batch_id) & (F.col("window_start") >= F.lit(oldest))
        )
        placed = batch.withColumn("window_start", start)
        new = placed.join(known.select("window_start", self.user), ["window_start", self.user], "left_anti")
        counted = uniques.running(new.drop("window_start"), self.ts, self.size, self.user, self.arrival)
        before = known.groupBy("window_start").agg(F.max("uv").alias("_before"))
        joined = counted.join(before, "window_start", "left")
        return joined.withColumn("uv", F.col("uv") + F.coalesce("_before", F.lit(0))).drop("_before")


class FollowedBy:
    """The relaxed sequence of ``patterns.followed_by`` on a stream, as one bounded scan per batch.

    For keys too hot for per-key state in one task: each batch scans its rows together with
    those left open before, and the scan splits a hot key. Rows are in order once the
    watermark (largest time so far less ``delay``) has passed them; rows that come after that
    are dropped. What stays open is stored per batch under ``path``: rows the watermark has
    not passed, and starts still waiting. Use as ``per_batch`` of ``live.drain``.
    """

    def __init__(self, path: str, key: str, order: Sequence[str], start: Column, then: Column,
                 within: str, delay: str, **scan_options: int) -> None:
        self.path, self.key, self.order, self.start, self.then = path, key, list(order), start, then
        self.within, self.delay, self.scan_options = within, delay, scan_options

    def __call__(self, batch: DataFrame, batch_id: int) -> DataFrame:
        spark, ts = batch.sparkSession, self.order[0]
        type_ = batch.schema[ts].dataType
        rows = batch.where(self.start | self.then)
        passed = None
        if batch_id > 0:
            passed = spark.read.parquet(f"{self.path}/watermark/batch={batch_id - 1}").first()["at"]
            on_time = rows if passed is None else rows.where(F.col(ts) >= F.lit(passed))
            rows = on_time.unionByName(spark.read.parquet(f"{self.path}/open/batch={batch_id - 1}"))
        reached = batch.agg((F.max(ts) - interval(self.delay)).alias("m")).select(
            F.greatest("m", F.lit(passed).cast(type_)).alias("at")
        )
        reached.write.mode("overwrite").parquet(f"{self.path}/watermark/batch={batch_id}")
        now = F.lit(spark.read.parquet(f"{self.path}/watermark/batch={batch_id}").first()["at"]).cast(type_)

        closed = F.coalesce(F.col(ts) < now, F.lit(False))
        starts = patterns.with_follower(
            rows.where(closed), self.key, self.order, self.start, self.then, **self.scan_options
        )
        over = F.col("next_ts").isNotNull() | (F.col(ts) + interval(self.within) <= now)
        waiting = rows.where(~closed).unionByName(starts.where(~over).drop("next_ts"))
        waiting.write.mode("overwrite").parquet(f"{self.path}/open/batch={batch_id}")
        return patterns.outcomes(starts.where(over), self.key, ts, self.within)


def controlled_batch(
    batch: DataFrame, control: Callable[[], DataFrame], order: str, setting: str
) -> DataFrame:
    """A batch with the control value in force when it runs: one row, so it is broadcast."""
    now = control().agg(F.max_by(setting, order).alias(setting))
    return batch.withColumn(setting, now.scalar())

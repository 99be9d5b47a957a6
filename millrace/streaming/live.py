"""Run a stream over stored data to its end and hand back what it emitted."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import scratch

# A time past every event: a row there moves the watermark over all open windows and timers.
END_OF_TIME = "2100-01-01 00:00:00"
END_KEY = -1


def drain(
    df: DataFrame,
    mode: str,
    per_batch: Callable[[DataFrame, int], DataFrame] | None = None,
    checkpoint: str | None = None,
    out: str | None = None,
) -> DataFrame:
    """Run ``df`` until its sources are used up and return everything it emitted.

    ``per_batch`` turns a batch and its number into what is emitted. Each micro-batch overwrites its own folder, so a batch that is run again after a failure
    is not counted twice. ``batch`` numbers the batches. Running again with the same
    ``checkpoint`` and ``out`` goes on where the last run ended.
    """
    spark = df.sparkSession
    out = out or scratch(spark, "emitted")
    checkpoint = checkpoint or scratch(spark, "progress")

    def write(batch: DataFrame, batch_id: int) -> None:
        if per_batch is None:
            batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
            return
        kept = batch.persist()  # looked at more than once
        try:
            per_batch(kept, batch_id).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        finally:
            kept.unpersist()

    query = (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()
    return _emitted(df, out, per_batch)


def _emitted(df: DataFrame, out: str, per_batch: Callable[[DataFrame, int], DataFrame] | None = None) -> DataFrame:
    """All that was emitted below ``out``; an empty source gives no batch and so no folder."""
    spark = df.sparkSession
    try:
        return spark.read.parquet(out)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    none = spark.createDataFrame([], df.schema)
    schema = (per_batch(none, 0) if per_batch else none).schema
    return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("batch", T.IntegerType())]))


def run_until_quiet(df: DataFrame, mode: str, checkpoint: str | None = None, out: str | None = None) -> DataFrame:
    """Run a clock-driven stream until its input is read and its state is empty.

    State on processing time gives a batch at every trigger, so such a stream never comes to
    an end of its own. It is over when a batch finds no new rows and leaves neither a value nor a timer
    behind; what it does with its state must come to an end, by a timer or by expiry.
    """
    spark = df.sparkSession
    out = out or scratch(spark, "emitted")
    query = (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint or scratch(spark, "progress"))
        .trigger(processingTime="1 second")
        .foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch={n}"))
        .start()
    )
    while query.isActive and not _empty(query.lastProgress):
        time.sleep(0.1)
    if query.exception() is not None:
        raise query.exception()
    query.stop()
    return _emitted(df, out)


def _empty(progress) -> bool:
    """Whether a batch read nothing and left no state."""
    return (
        progress is not None and progress["numInputRows"] == 0
        and all(s["numRowsTotal"] == 0 for s in progress["stateOperators"])
    )


def newest(emitted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Last value of each key of an update-mode run."""
    rest = [c for c in emitted.columns if c not in (*keys, "batch")]
    last = emitted.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_row"))
    return last.select(*keys, *[F.col(f"_row.{c}") for c in rest])


class EndMark:
    """A one-row side source that closes every window once the real input is used up.

    Unlike a bounded job, a stream keeps its last windows and timers open. Union
    :meth:`stream` into the input before ``withWatermark`` and run with :meth:`drain`: the
    first run reads the input with this source still empty, the second goes on from the same
    checkpoint with the end row as its only new data.
    """

    def __init__(self, spark: SparkSession, schema: str, **values: str) -> None:
        self.spark, self.schema, self.values = spark, schema, values
        self.folder = scratch(spark, "end")
        self._write(empty=True)

    def row(self) -> DataFrame:
        return self.spark.range(1).selectExpr(
            *[f"CAST({self.values.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}"
              for f in self.fields()]
        )

    def _write(self, empty: bool) -> None:
        row = self.row()
        (row.where("false") if empty else row).coalesce(1).write.mode("append").parquet(self.folder)

    def fields(self):
        return self.spark.createDataFrame([], self.schema).schema.fields

    def stream(self) -> DataFrame:
        return self.spark.readStream.schema(self.schema).parquet(self.folder)

    def drain(self, df: DataFrame, mode: str, per_batch=None) -> DataFrame:
        checkpoint, out = scratch(self.spark, "progress"), scratch(self.spark, "emitted")
        drain(df, mode, per_batch, checkpoint, out)
        self.write()
        return drain(df, mode, per_batch, checkpoint, out)

    def write(self) -> None:
        """Let the end row come."""
        self._write(empty=False)


def drain_ended(df: DataFrame, mode: str, ends: Sequence[EndMark]) -> DataFrame:
    """:meth:`EndMark.drain` for a stream of several inputs, each with its own mark."""
    checkpoint, out = scratch(df.sparkSession, "progress"), scratch(df.sparkSession, "emitted")
    drain(df, mode, None, checkpoint, out)
    for end in ends:
        end.write()
    return drain(df, mode, None, checkpoint, out)


def event_end(spark: SparkSession, event_type: str = "end") -> EndMark:
    """End mark for the event stream: a row of user -1 in the far future."""
    return EndMark(
        spark,
        "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
        event_id="-1", ts=f"TIMESTAMP '{END_OF_TIME}'", user_id=str(END_KEY),
        event_type=f"'{event_type}'", value="0", props="""'{"k": -1}'""",
    )


def plain_time(df: DataFrame, *cols: str) -> DataFrame:
    """Zoned times back to zone-less ones, as the stored tables have them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})

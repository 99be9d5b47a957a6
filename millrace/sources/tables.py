"""Readers for the stored tables and the event views built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The stored events carry a zone-less timestamp; streams need a zoned one for watermarks.
EVENTS_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def stream(spark: SparkSession, sf_dir: str, name: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """A stored table as a live stream, read file by file."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # A glob, since a stream takes a folder or a glob but not one file's name.
    return reader.parquet(f"{sf_dir}/{name}.parque[t]")


def tasks(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read_tasks(spark: SparkSession) -> int | None:
    """How many tasks to deal a stored table to before heavy work per row; unset leaves it as it is read."""
    n = spark.conf.get("millrace.read.tasks", None)
    return int(n) if n else None


def spread(stored: DataFrame, n: int | None) -> DataFrame:
    """A stored table over ``n`` tasks, if a number is given: for a table of few, large files."""
    return stored.repartition(n) if n else stored


def event_stream(spark: SparkSession, sf_dir: str, files_per_batch: int | None = None) -> DataFrame:
    """The events table as a live stream, its time column ready for ``withWatermark``."""
    events = stream(spark, sf_dir, "events", EVENTS_SCHEMA, files_per_batch)
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def sensor(events: DataFrame) -> DataFrame:
    """Sensor readings: ``id``, event time, an integer measure, and the arrival order."""
    return events.select(
        F.col("event_id"), F.col("user_id").alias("id"), F.col("ts"), F.floor("value").alias("vc")
    )


def item() -> Column:
    """The item a behaviour event is about."""
    return F.get_json_object("props", "$.k").cast("bigint")


def behavior(events: DataFrame) -> DataFrame:
    return events.select("event_id", "user_id", item().alias("item"), F.col("event_type").alias("behavior"), "ts")


def document_lines(documents: DataFrame) -> DataFrame:
    """One row per line of each document, numbered in reading order."""
    return documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def disordered_arrival() -> Column:
    """A made-up arrival order for events: up to 96 places late, the same rule as the checks use."""
    return F.col("event_id") + F.pmod(F.col("event_id") * 7919, F.lit(97))

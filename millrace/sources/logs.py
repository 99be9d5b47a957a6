"""Message-log and text sources and the named table registry.

The log transport is an option: ``kafka`` reads and writes topics and needs Spark's Kafka
connector on the cluster; ``files`` is a folder of text files, one message per line.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a text file, or of every file in a folder, as ``value``."""
    return spark.read.option("lineSep", "\n").text(path)


def live_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines of files as they appear in a folder."""
    reader = spark.readStream.option("lineSep", "\n")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a socket, for demonstrations: the source keeps no offsets."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


@dataclass(frozen=True)
class Log:
    """A message log: ``transport`` is ``kafka`` or ``files``, ``topic`` its name or folder."""

    topic: str
    transport: str = "kafka"
    servers: str = ""
    group: str = ""
    start: str = "earliest"
    options: dict[str, str] = field(default_factory=dict)

    def _kafka(self, io):
        io = io.format("kafka").option("kafka.bootstrap.servers", self.servers)
        for name, value in self.options.items():
            io = io.option(name, value)
        return io

    def read_stream(self, spark: SparkSession) -> DataFrame:
        """Messages as strings in ``value``. A folder is read from its first file; only a topic can start later."""
        if self.transport == "files" and self.start != "earliest":
            raise ValueError("a folder of messages has no other start than the earliest")
        if self.transport == "files":
            return live_lines(spark, self.topic)
        reader = self._kafka(spark.readStream).option("subscribe", self.topic).option("startingOffsets", self.start)
        if self.group:
            reader = reader.option("kafka.group.id", self.group)
        return reader.load().select(F.col("value").cast("string"))

    def read(self, spark: SparkSession) -> DataFrame:
        if self.transport == "files":
            return text_lines(spark, self.topic)
        reader = self._kafka(spark.read).option("subscribe", self.topic)
        return reader.load().select(F.col("value").cast("string"))

    def write(self, messages: DataFrame, mode: str = "append") -> None:
        if self.transport == "files":
            messages.select("value").write.mode(mode).option("lineSep", "\n").text(self.topic)
        else:
            self._kafka(messages.select("value").write).option("topic", self.topic).save()

    def write_stream(self, messages: DataFrame, checkpoint: str, **trigger):
        writer = messages.select("value").writeStream.outputMode("append").option("checkpointLocation", checkpoint)
        if self.transport == "files":
            writer = writer.format("text").option("path", self.topic)
        else:
            writer = self._kafka(writer).option("topic", self.topic)
        return writer.trigger(**trigger).start()


def csv_values(messages: DataFrame, schema: str) -> DataFrame:
    """Typed columns from CSV messages; a malformed message fails the job."""
    parsed = F.from_csv("value", schema, {"mode": "FAILFAST"})
    return messages.select(parsed.alias("r")).select("r.*")


def json_values(rows: DataFrame) -> DataFrame:
    """Rows as JSON messages."""
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))


def to_csv_values(rows: DataFrame) -> DataFrame:
    return rows.select(F.to_csv(F.struct(*rows.columns)).alias("value"))


def csv_table(spark: SparkSession, path: str, schema: str, name: str, delimiter: str = ",") -> DataFrame:
    """A delimited file with a declared schema, registered as a view."""
    df = spark.read.schema(schema).option("sep", delimiter).option("mode", "FAILFAST").csv(path)
    df.createOrReplaceTempView(name)
    return df


class Tables:
    """Named sources and sinks: what connector options would declare, as Python calls."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self._sinks: dict[str, Callable[[DataFrame], object]] = {}

    def source(self, name: str, load: Callable[[SparkSession], DataFrame]) -> DataFrame:
        df = load(self.spark)
        df.createOrReplaceTempView(name)
        return df

    def sink(self, name: str, save: Callable[[DataFrame], object]) -> None:
        self._sinks[name] = save

    def insert(self, name: str, query: str) -> object:
        """Run ``query`` over the registered sources and hand the result to a sink."""
        return self._sinks[name](self.spark.sql(query))

    def __iter__(self) -> Iterator[str]:
        return iter(self._sinks)

"""Keyed upserts and appends.

A keyed write first reduces its rows to the newest per key, which combines on the map side,
so a hot key costs one row per task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F


def newest_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key along ``order``."""
    rest = [c for c in df.columns if c != key]
    last = df.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return last.select(key, *[F.col(f"_row.{c}") for c in rest])


def upsert(batch: DataFrame, batch_id: int, path: str, key: str, order: str) -> None:
    """Add a batch to a keyed table, last write wins.

    Only the batch's newest row per key is written, to the batch's own folder: no stored
    data is rewritten, and a batch that is run again replaces itself.
    """
    newest_per_key(batch, key, order).write.mode("overwrite").parquet(f"{path}/batches/batch={batch_id}")


def _pointer(spark: SparkSession, path: str) -> Row | None:
    """The newest pointer: its ``version`` names a snapshot, which holds the batches ``upto`` a number."""
    try:
        return spark.read.parquet(f"{path}/pointers").orderBy(F.col("version").desc()).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def upserted(spark: SparkSession, path: str, key: str, order: str) -> DataFrame:
    """The keyed table as it stands: newest row per key over the last snapshot and the batches after it."""
    stored = spark.read.parquet(f"{path}/batches")
    point = _pointer(spark, path)
    if point is not None:
        snapshot = spark.read.parquet(f"{path}/snapshots/{point['version']}").withColumn("batch", F.lit(-1))
        stored = stored.where(F.col("batch") > point["upto"]).unionByName(snapshot)
    at = F.struct(F.col(order).alias("o"), F.col("batch").alias("b"))
    kept = stored.withColumn("_at", at).drop("batch")
    return newest_per_key(kept, key, "_at").drop("_at")


def compact(spark: SparkSession, path: str, key: str, order: str) -> None:
    """Write the table as it stands as a new snapshot, then point readers to it.

    The pointer is a new file that appears when it is complete, so a reader sees the old snapshot or the new one.
    One compaction runs at a time; batches may be added meanwhile.
    """
    point = _pointer(spark, path)
    version = 1 if point is None else point["version"] + 1
    upto = spark.read.parquet(f"{path}/batches").select(F.max("batch")).first()[0]
    seen = f"{path}/snapshots/{version}"
    upserted(spark, path, key, order).write.mode("overwrite").parquet(seen)
    spark.createDataFrame([(upto,)], "upto INT").coalesce(1).write.parquet(f"{path}/pointers/version={version}")


def upsert_external(
    df: DataFrame,
    key: str,
    order: str,
    connect: Callable[[], object],
    put: Callable[[object, list[Row]], None],
    close: Callable[[object], None],
    batch_size: int = 1000,
) -> None:
    """Send the newest row per key to an outside store in batches, one connection per task.

    ``put`` must be an upsert (hash field, document by id, insert-or-update statement), so
    that a task run again leaves the same result.
    """
    def send(rows: Iterator[Row]) -> None:
        store = connect()
        try:
            while batch := list(islice(rows, batch_size)):
                put(store, batch)
        finally:
            close(store)

    newest_per_key(df, key, order).foreachPartition(send)


def sql_upsert(connect: Callable[[], object], statement: str, columns: list[str]):
    """``put`` for a DB-API connection: ``statement`` takes ``columns`` as parameters."""
    def put(connection: object, rows: list[Row]) -> None:
        cursor = connection.cursor()
        cursor.executemany(statement, [tuple(r[c] for c in columns) for r in rows])
        connection.commit()

    return connect, put, lambda connection: connection.close()


def append_documents(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def append_csv(df: DataFrame, path: str, delimiter: str = ",") -> None:
    df.write.mode("append").option("sep", delimiter).csv(path)

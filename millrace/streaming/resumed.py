"""Ordered operators on streams as bounded scans that go on where the last batch ended.

Each batch is one keyed scan over its rows and what earlier batches left: rows that the watermark had not
passed, and a carry of a few rows per key. So a hot key is cut into chunks as on a stored table and no key is ever in one
task's memory. Rows are in order once the watermark (the largest time so far less ``delay``) has passed them; rows that come
after that are dropped, as Spark's own stateful operators drop them.

Watermark, waiting rows and carry are written per batch under ``path``; a batch that is run again reads those of the batch
before it and overwrites its own. The carry has the keys that may still matter: patterns and matches forget a
key when its time is over, counts keep one row per key. Use the operators as ``per_batch`` of ``live.drain``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators import joins, patterns, scan
from millrace.operators.eventtime import interval


def last_rows(df: DataFrame, key: str, order: Sequence[str], n: int) -> DataFrame:
    """The last ``n`` rows of each key; a task sends no more than that of a key."""
    latest = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_nth", F.row_number().over(latest)).where(F.col("_nth") <= n).drop("_nth")


class Resumed:
    """A scan in ``order``, whose first column is the event time, over the rows that :meth:`prepared` gives."""

    def __init__(self, path: str, key: str, order: Sequence[str], delay: str, **scan_options: int) -> None:
        self.path, self.key, self.order, self.delay, self.options = path, key, list(order), delay, scan_options

    def prepared(self, batch: DataFrame) -> DataFrame:
        """The rows that play a part, with the columns they need."""
        raise NotImplementedError

    def no_carry(self, rows: DataFrame) -> DataFrame:
        """An empty carry."""
        raise NotImplementedError

    def step(self, rows: DataFrame, carry: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
        """What is emitted for the rows passed by the watermark ``now``, and the next carry."""
        raise NotImplementedError

    def __call__(self, batch: DataFrame, batch_id: int) -> DataFrame:
        spark, ts = batch.sparkSession, self.order[0]
        type_ = batch.schema[ts].dataType
        rows, passed = self.prepared(batch), None
        carry = self.no_carry(rows)
        if batch_id > 0:
            passed = self._read(spark, "watermark", batch_id - 1).first()["at"]
            on_time = rows if passed is None else rows.where(F.col(ts) >= F.lit(passed))
            rows = on_time.unionByName(self._read(spark, "waiting", batch_id - 1))
            carry = self._read(spark, "carry", batch_id - 1)
        reached = batch.agg((F.max(ts) - interval(self.delay)).alias("m")).select(F.greatest("m", F.lit(passed).cast(type_)).alias("at"))
        now = F.lit(self._written(reached, "watermark", batch_id).first()["at"]).cast(type_)
        closed = F.coalesce(F.col(ts) < now, F.lit(False))
        self._written(rows.where(~closed), "waiting", batch_id)
        emitted, after = self.step(rows.where(closed), carry, now)
        self._written(after, "carry", batch_id)
        return emitted

    def _written(self, df: DataFrame, name: str, batch_id: int) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.path}/{name}/batch={batch_id}")
        return self._read(df.sparkSession, name, batch_id)

    def _read(self, spark, name: str, batch_id: int) -> DataFrame:
        return spark.read.parquet(f"{self.path}/{name}/batch={batch_id}")


class Strict(Resumed):
    """``patterns.strict``: adjacent rows of a key that satisfy the stages in turn. Carries the last rows but one stage."""

    def __init__(self, path: str, key: str, order: Sequence[str], stages: Sequence[Column], within: str, delay: str, **scan_options: int) -> None:
        super().__init__(path, key, order, delay, **scan_options)
        self.stages, self.within = list(stages), within

    def prepared(self, batch: DataFrame) -> DataFrame:
        return batch.select(self.key, *self.order, *[s.alias(f"_m{i}") for i, s in enumerate(self.stages)])

    def no_carry(self, rows: DataFrame) -> DataFrame:
        return rows.where("false")

    def step(self, rows: DataFrame, carry: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
        both = carry.withColumn("_new", F.lit(False)).unionByName(rows.withColumn("_new", F.lit(True)))
        stages = [F.col(f"_m{i}") for i in range(len(self.stages))]
        stages[-1] = stages[-1] & F.col("_new")
        found = patterns.strict(both, self.key, self.order, stages, self.within, **self.options)
        # A match ends less than `within` after it starts, and what comes next is not before the watermark.
        alive = both.where(F.col(self.order[0]) + interval(self.within) > now)
        return found, last_rows(alive, self.key, self.order, len(self.stages) - 1).drop("_new")


class Reconciled(Resumed):
    """``joins.reconcile`` of the rows of two kinds. Carries the row of a key that still waits for one of the other side."""

    def __init__(self, path: str, key: str, order: Sequence[str], left: Column, right: Column, wait_right: str, wait_left: str,
                 delay: str, **scan_options: int) -> None:
        super().__init__(path, key, order, delay, **scan_options)
        self.left, self.right, self.waits = left, right, (wait_right, wait_left)

    def prepared(self, batch: DataFrame) -> DataFrame:
        return batch.where(self.left | self.right).select(self.key, *self.order, self.left.alias("_left"))

    def no_carry(self, rows: DataFrame) -> DataFrame:
        return rows.where("false")

    def step(self, rows: DataFrame, carry: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
        ts, tie = self.order
        by = [ts, "_left", tie]
        # A row that is matched needs no carry: the row after it begins a chain, which is where the pairing would go on.
        chained = joins.chained(rows.unionByName(carry), self.key, by, *self.waits, **self.options)
        due = F.col(ts) + F.when(F.col("_left"), interval(self.waits[0])).otherwise(interval(self.waits[1]))
        last = last_rows(chained, self.key, by, 1)
        waiting = last.where((F.col("_pair") == F.col("_rn")) & (due >= now))
        held = waiting.select(F.col(self.key).alias("_k"), F.col("_pair").alias("_p"))
        pairs = joins.paired(chained, self.key, ts)
        done = pairs.join(held, F.col(self.key).eqNullSafe(F.col("_k")) & (F.col("_pair") == F.col("_p")), "left_anti")
        return joins.outcomes(done, self.key), waiting.select(*carry.columns)


class Counted(Resumed):
    """A scan that goes on from a row count per key: a carried row without a time comes first and brings the count before it."""

    def __init__(self, path: str, key: str, order: Sequence[str], columns: Sequence[str], delay: str, **scan_options: int) -> None:
        super().__init__(path, key, order, delay, **scan_options)
        self.columns = list(columns)

    def prepared(self, batch: DataFrame) -> DataFrame:
        return batch.select(self.key, *self.order, *self.columns)

    def no_carry(self, rows: DataFrame) -> DataFrame:
        return rows.where("false").withColumn("_base", F.lit(0).cast("long"))

    def numbered(self, rows: DataFrame, carry: DataFrame) -> DataFrame:
        """Rows and carried rows with ``_rn``, their number in the key over all batches; 0-row keys give null-timed rows."""
        both = rows.withColumn("_base", F.lit(None).cast("long")).unionByName(carry)
        counted = F.when(F.col(self.order[0]).isNotNull(), 1).otherwise(0)
        seen = scan.keyed_scan(
            both, [self.key], self.order, scan.running_sum("_n", counted), scan.running_max("_before", F.col("_base")), **self.options)
        return seen.withColumn("_rn", F.col("_n") + F.coalesce("_before", F.lit(0))).drop("_n", "_before", "_base")

    def bases(self, numbered: DataFrame, base: Column) -> DataFrame:
        """The carried row of each key."""
        empty = [F.lit(None).cast(numbered.schema[c].dataType).alias(c) for c in (*self.order, *self.columns)]
        return numbered.groupBy(self.key).agg(F.max("_rn").alias("_rn")).select(self.key, *empty, base.cast("long").alias("_base"))


class Changes(Counted):
    """``changelog.count_changes``: the old and the new count at each row."""

    def step(self, rows: DataFrame, carry: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
        seen = self.numbered(rows, carry)
        new = F.struct(F.lit(True).alias("op"), F.col("_rn").alias("ct"))
        old = F.struct(F.lit(False).alias("op"), (F.col("_rn") - 1).alias("ct"))
        changes = F.when(F.col("_rn") == 1, F.array(new)).otherwise(F.array(old, new))
        emitted = seen.where(F.col(self.order[0]).isNotNull()).select(self.key, *self.order, F.explode(changes).alias("c"))
        return emitted.select(self.key, *self.order, "c.op", "c.ct"), self.bases(seen, F.col("_rn"))


class CountTumbling(Counted):
    """``windows.count_tumbling``: one result per ``size`` rows of a key. Carries the rows of the open group."""

    def __init__(self, path: str, key: str, order: Sequence[str], size: int, columns: Sequence[str], aggs: Sequence[Column],
                 delay: str, **scan_options: int) -> None:
        super().__init__(path, key, order, columns, delay, **scan_options)
        self.size, self.aggs = size, list(aggs)

    def step(self, rows: DataFrame, carry: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
        seen = self.numbered(rows, carry)
        real = seen.where(F.col(self.order[0]).isNotNull()).withColumn("group_no", F.floor((F.col("_rn") - 1) / self.size))
        grouped = real.groupBy(self.key, "group_no").agg(F.count(F.lit(1)).alias("ct"), *self.aggs).where(F.col("ct") == self.size)
        full = F.floor(F.col("_rn") / self.size) * self.size
        open_ = last_rows(real, self.key, self.order, self.size - 1)
        total = F.max("_rn").over(Window.partitionBy(self.key))  # at most size - 1 rows of a key
        open_ = open_.withColumn("_t", total).where(F.col("_rn") > F.floor(F.col("_t") / self.size) * self.size)
        after = self.bases(seen, full).unionByName(
            open_.select(self.key, *self.order, *self.columns, F.lit(None).cast("long").alias("_base")))
        return grouped, after

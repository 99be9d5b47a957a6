"""Audit of how filters act together, kept up to date by retraction while files stream in.

Each text gets a mask of the filters it fails: A too few words, B too few distinct words, C too many capitals, D symbols,
E identical to the text of a smaller id. All but E depend on the text alone. For E a stream keeps, per text (by
its SHA-256), the smallest id so far and what its rows count for. When a smaller id arrives, the rows that were
thought the first are taken back from the counters of their part without E, and counted again with E. So the sum of
all changes is right after every micro-batch, whatever order the files come in.

Before the shuffle each task folds the rows of equal texts it sees: a text that a third of all rows hold sends the rows
of its smallest id and counts of the others, one row per task and ``FOLD`` texts. State is one small value per
distinct text, in RocksDB. The changes of a batch are summed per part, mask and flags before they are
written, in a folder per batch that a repeated batch overwrites.

The report needs these counters only: at most 128 per part.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.llm.words import batches_of, texts, tidied
from millrace.session import ROCKSDB, scratch

LETTERS = "ABCDE"
COPY = 1 << LETTERS.index("E")
GOOD, TOXIC = 1, 2  # flags of a row
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITALS_PERCENT, SYMBOLS = 200, 50, 3, b"#$%&*|"
LAST_ID = (1 << 63) - 1  # stands for a null id: no id is larger
FOLD = 50_000  # texts a task folds at a time
CORE_BYTES = 32 << 20  # bytes of files a micro-batch takes for each core

COUNTS = "array<struct<part: string, mask: int, flags: int, n: bigint>>"
MARKED = "doc_id BIGINT, has_id BOOLEAN, deal BIGINT, part STRING, mask INT, text_sha BINARY"
# Of one text: its mask without E, the smallest id among some rows, what the rows of that id count for and what the others do.
FOLDED = f"text_sha BINARY, mask INT, least BIGINT, first {COUNTS}, others {COUNTS}"
CHANGES = "part STRING, mask INT, flags INT, n BIGINT"

_CAPITALS = bytes(range(0x41, 0x5B))
_CONTINUES = bytes(range(0x80, 0xC0))
_COUNT_TYPE = pa.list_(pa.struct([("part", pa.string()), ("mask", pa.int32()), ("flags", pa.int32()), ("n", pa.int64())]))

Key = tuple[str, int, int]


def mask(text: bytes) -> int:
    """The filters a text fails by itself."""
    words = text.split()
    points = len(text) if text.isascii() else len(text.translate(None, _CONTINUES))
    fails = (
        len(words) < MIN_WORDS,
        100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words),
        100 * (len(text) - len(text.translate(None, _CAPITALS))) > MAX_CAPITALS_PERCENT * points,
        len(text.translate(None, SYMBOLS)) < len(text),
    )
    return sum(1 << i for i, failed in enumerate(fails) if failed)


def marked(documents: DataFrame, part: str = "lang") -> DataFrame:
    """Each row's id, part, own mask and text digest; the text stays behind. ``deal`` is the id, or some number for rows without one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, 16 << 20):
            found = [t or b"" for t in texts(batch)]
            deal = pc.if_else(batch.column("has_id"), batch.column("doc_id"), pa.array(range(batch.num_rows), pa.int64()))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("has_id"), deal, batch.column("part"),
                pa.array(map(mask, found), pa.int32()), pa.array([hashlib.sha256(t).digest() for t in found], pa.binary()),
            ], names=["doc_id", "has_id", "deal", "part", "mask", "text_sha"])

    return documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc_id"), F.col("doc_id").isNotNull().alias("has_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col("text").cast("string").alias("text"),
    ).mapInArrow(tidied(run), MARKED)


def flags(labels: DataFrame) -> DataFrame:
    """``_id`` and ``_flags`` of the labelled ids that have any; of several labels of an id any counts."""
    bit = F.max(F.when(F.col("quality") == 1, GOOD).otherwise(0)) + F.max(F.when(F.col("toxic") == 1, TOXIC).otherwise(0))
    by_id = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_id"))
    return by_id.agg(bit.alias("_flags")).where("_flags > 0")


def flagged(rows: DataFrame, by_id: DataFrame) -> DataFrame:
    """``rows`` with ``flags``; a row without a label or an id has none."""
    joined = rows.join(by_id, (F.col("deal") == F.col("_id")) & F.col("has_id"), "left")
    return joined.select("doc_id", "part", "mask", "text_sha", F.coalesce("_flags", F.lit(0)).cast("int").alias("flags"))


class Held:
    """What is known of the rows of one text."""

    __slots__ = ("mask", "least", "first", "others")

    def __init__(self, mask: int, least: int, first: dict[Key, int], others: dict[Key, int]) -> None:
        self.mask, self.least, self.first, self.others = mask, least, first, others

    def add(self, least: int, first: dict[Key, int]) -> None:
        """More rows of one id. Those of the larger id fail E; rows that repeat an id are alike."""
        if least == self.least:
            _into(self.first, first)
            return
        late = first if least > self.least else self.first
        _into(self.others, {(p, m | COPY, f): n for (p, m, f), n in late.items()})
        if least < self.least:
            self.least, self.first = least, dict(first)


def _into(sums: dict[Key, int], more: dict[Key, int]) -> None:
    for k, n in more.items():
        sums[k] = sums.get(k, 0) + n


def _listed(counts: dict[Key, int]) -> list[dict]:
    return [{"part": p, "mask": m, "flags": f, "n": n} for (p, m, f), n in counts.items()]


def folded(rows: DataFrame) -> DataFrame:
    """Rows of equal texts of a task as one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, Held] = {}

        def out() -> pa.RecordBatch:
            found = list(held.items())
            columns = [
                pa.array([k for k, _ in found], pa.binary()), pa.array([h.mask for _, h in found], pa.int32()),
                pa.array([h.least for _, h in found], pa.int64()),
                *[pa.array([_listed(c) for c in cs], _COUNT_TYPE) for cs in ([h.first for _, h in found], [h.others for _, h in found])],
            ]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=["text_sha", "mask", "least", "first", "others"])

        for batch in batches:
            for sha, m, i, p, f in zip(*[batch.column(c).to_pylist() for c in ("text_sha", "mask", "doc_id", "part", "flags")]):
                one = {(p, m, f): 1}
                if (known := held.get(sha)) is None:
                    held[sha] = Held(m, i, one, {})
                else:
                    known.add(i, one)
            if len(held) >= FOLD:
                yield out()
        if held:
            yield out()

    return rows.mapInArrow(tidied(run), FOLDED)


class Firsts(StatefulProcessor):
    """Keeps the smallest id of a text and gives out the changes of the counters."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("first", f"least BIGINT, first {COUNTS}")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self.state.get()
        counted: dict[Key, int] = {}
        known = None
        if before is not None:
            known = Held(0, before[0], {(p, m, f): n for p, m, f, n in before[1]}, {})
            _into(counted, {k: -n for k, n in known.first.items()})
        old = None if known is None else (known.least, dict(known.first))
        for r in rows:
            first = {(c["part"], c["mask"], c["flags"]): c["n"] for c in r["first"]}
            if known is None:
                known = Held(r["mask"], r["least"], first, {})
            else:
                known.add(r["least"], first)
            _into(known.others, {(c["part"], c["mask"], c["flags"]): c["n"] for c in r["others"]})
        _into(counted, known.first)
        _into(counted, known.others)
        if old != (known.least, known.first):
            self.state.update((known.least, [(p, m, f, n) for (p, m, f), n in known.first.items()]))
        for (p, m, f), n in counted.items():
            if n:
                yield Row(part=p, mask=m, flags=f, n=n)

    def close(self) -> None:
        pass


def changes(documents: DataFrame, by_id: DataFrame, part: str = "lang") -> DataFrame:
    """The stream of changes of the counters for a stream of documents and the :func:`flags` of ids."""
    rows = folded(flagged(marked(documents, part), by_id))
    return rows.groupBy("text_sha").transformWithState(Firsts(), CHANGES, "Append", "none")


_STATE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else each partition takes megabytes ahead
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


def counters(documents: DataFrame, labels: DataFrame, part: str = "lang", folder: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Run a stream of documents to its end and return ``part``, ``mask``, ``flags`` and ``n`` rows of each.

    With the ``folder`` and ``checkpoint`` of an earlier run it goes on from there, with the files that are new.
    """
    spark = documents.sparkSession
    folder, checkpoint = folder or scratch(spark, "audit-changes"), checkpoint or scratch(spark, "audit-progress")
    path = scratch(spark, "audit-flags")
    flags(labels).write.parquet(path)  # once, not for every micro-batch
    by_id = spark.read.parquet(path)

    def write(batch: DataFrame, number: int) -> None:
        batch.groupBy("part", "mask", "flags").agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    before = {k: spark.conf.get(k, None) for k in _STATE}
    try:
        for k, v in _STATE.items():
            spark.conf.set(k, v)
        # A stream keeps the settings it starts with.
        run = (changes(documents, by_id, part).writeStream.outputMode("append").option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).foreachBatch(write).start())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    run.awaitTermination()
    try:
        found = spark.read.parquet(folder)
    except AnalysisException as error:  # no file, no batch, no folder
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CHANGES)
    return found.groupBy("part", "mask", "flags").agg(F.sum("n").alias("n")).where("n <> 0")


def stream(spark: SparkSession, path: str, core_bytes: int = CORE_BYTES, files: int | None = None) -> DataFrame:
    """A stored table as a stream whose micro-batches grow with the cluster, or take a number of files."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    else:
        reader = reader.option("maxBytesPerTrigger", core_bytes * max(1, spark.sparkContext.defaultParallelism))
    # A glob, since a stream takes a folder or a glob but not one file's name.
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def report(counts: DataFrame) -> DataFrame:
    """What each filter does at each step of each order of the filters, per part; see ``op11`` for the columns.

    A part without rows, and so an empty table, gives none.
    """
    def bit(letter: str) -> int:
        return 1 << LETTERS.index(letter)

    steps = F.array(*[
        F.struct(F.lit("".join(order)).alias("filter_order"), F.lit(i + 1).alias("step"), F.lit(bit(order[i])).alias("own"),
                 F.lit(sum(map(bit, order[:i]))).alias("earlier"))
        for order in itertools.permutations(LETTERS) for i in range(len(LETTERS))
    ])
    flat = counts.withColumn("_s", F.explode(steps)).select("part", "mask", "flags", "n", "_s.*")
    fails, gone = F.col("mask").bitwiseAND(F.col("own")) != 0, F.col("mask").bitwiseAND(F.col("earlier")) != 0
    removed = fails & ~gone

    def total(condition):
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    done = flat.groupBy("part", "filter_order", "step", "own").agg(
        total(~fails & ~gone).alias("kept"), total(removed).alias("removed"), total(fails & gone).alias("redundant"),
        total(F.col("mask") == F.col("own")).alias("unique_fails"),
        total(removed & (F.col("flags").bitwiseAND(GOOD) != 0)).alias("good_lost"),
        total(removed & (F.col("flags").bitwiseAND(TOXIC) != 0)).alias("toxic_lost"))
    shares = done.groupBy(F.col("part").alias("_part"), F.col("own").alias("_own")).agg(F.sum("removed").alias("shapley"))
    joined = done.join(shares, (F.col("part") == F.col("_part")) & (F.col("own") == F.col("_own")))
    return joined.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")

"""Exact dedup by sorting contents.

Texts are equal if they are so after every run of blanks has become one space. Rows are dealt to tasks by
ranges whose splitters Spark samples, then each task sorts its range (Spark's sort spills to disk), so that equal
texts are neighbours, and compares each text in full with the one before it. The first of a run of equal texts, which has
the smallest id, stays.

The order is: the first ``HEAD`` bytes of the text, its digest, the whole text, the id. Ranges are cut by head,
digest and id only, so a sampled splitter is small whatever the texts, and copies of one text that a third of all
rows hold are cut by their ids into many ranges. A run that goes on over the end of a range is put together again from
one row per end: the texts at the ends are compared in full with their neighbours there, and ids and counts of the
pieces are joined to the rows of those runs only. There are at most two such pieces per range.

A null text counts as empty. Null ids come last: such a row stays only if no equal text has an id. Of rows
that repeat both id and text one stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.words import batches_of, tidied
from millrace.session import scratch

HEAD = 64  # bytes of a text that a splitter may hold
ROWS_OUT = 50_000  # rows given out at a time
ROWS = "doc_id BIGINT, keep_id BIGINT, group_size BIGINT, kept BOOLEAN, text_sha256 STRING, part INT, run BIGINT, first_text BINARY, last_text BINARY"


def normalised(text: Column) -> Column:
    """A text with each run of blanks as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _ordered(documents: DataFrame, ranges: int | None) -> DataFrame:
    text = documents.select(F.col("doc_id").cast("long"), normalised(F.col("text")).cast("binary").alias("text"))
    keyed = text.select(
        F.substring("text", 1, HEAD).alias("head"), F.unhex(F.sha2("text", 256)).alias("digest"), "text",
        F.col("doc_id").isNull().alias("last"), "doc_id")
    by = ["head", "digest", "last", "doc_id"]
    dealt = keyed.repartitionByRange(ranges, *by) if ranges else keyed.repartitionByRange(*by)
    return dealt.sortWithinPartitions("head", "digest", "text", "last", "doc_id").select("doc_id", "text", "digest")


class _Run:
    """A run of equal texts of one range; its ids wait until the count is known, eight bytes each."""

    def __init__(self, number: int, text: pa.Scalar, digest: bytes) -> None:
        self.number, self.text, self.digest, self.ids, self.size = number, text, digest, [], 0

    def add(self, ids: pa.Array) -> None:
        self.ids.append(ids)
        self.size += len(ids)


def _starts(text: pa.Array) -> np.ndarray:
    """Places of a batch whose text differs from the one before it, the first aside."""
    return np.flatnonzero(~pc.equal(text[1:], text[:-1]).to_numpy(zero_copy_only=False)) + 1


def _columns(size: int, keep: object, n: int, first: bool, sha: str, part: int, number: int, ends: tuple[object, object]) -> list[pa.Array]:
    """What the rows of a run share; ``first`` tells whether the first of these rows begins the run."""
    kept = np.zeros(size, bool)
    kept[:1] = first
    only = pa.nulls(max(size - 1, 0), pa.binary())
    return [
        pa.repeat(pa.scalar(keep, pa.int64()), size), pa.repeat(pa.scalar(n, pa.int64()), size), pa.array(kept),
        pa.repeat(pa.scalar(sha), size), pa.repeat(pa.scalar(part, pa.int32()), size), pa.repeat(pa.scalar(number, pa.int64()), size),
        *[pa.concat_arrays([pa.array([e], pa.binary()), only]) for e in ends],
    ]


def _rows(run: _Run, part: int, last: bool) -> Iterator[list[pa.Array]]:
    """The rows of a run. The first row of the first and last run of a range carries its text."""
    keep, first = run.ids[0][0].as_py(), True
    for ids in run.ids:
        ends = (run.text.as_py() if first and run.number == 0 else None, run.text.as_py() if first and last else None)
        yield [ids, *_columns(len(ids), keep, run.size, first, run.digest.hex(), part, run.number, ends)]
        first = False


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal neighbours of one sorted range."""
    names = [f.split()[0] for f in ROWS.split(", ")]
    part, run, waiting, held = TaskContext.get().partitionId(), None, [], 0

    def flushed() -> Iterator[pa.RecordBatch]:
        if waiting:
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in zip(*waiting)], names=names)
            waiting.clear()

    for batch in batches_of(batches, 16 << 20):
        if not batch.num_rows:
            continue
        ids, text, digest = batch.column("doc_id"), batch.column("text"), batch.column("digest")
        bounds = [0, *_starts(text).tolist(), batch.num_rows]
        for a, b in zip(bounds, bounds[1:]):
            if run is None or a or text[0] != run.text:
                if run is not None:
                    waiting.extend(_rows(run, part, False))
                    held += run.size
                run = _Run(run.number + 1 if run else 0, text[a], digest[a].as_py())
            # A copy, so that the ids do not hold the batch with its texts.
            run.add(pa.array(ids[a:b].to_numpy(zero_copy_only=False) if not ids[a:b].null_count else ids[a:b].to_pylist(), pa.int64()))
            if held >= ROWS_OUT:
                yield from flushed()
                held = 0
        run.text = pa.scalar(run.text.as_py(), run.text.type)
    if run is not None:
        waiting.extend(_rows(run, part, True))
    yield from flushed()


def _joined_ends(rows: DataFrame) -> DataFrame:
    """For each first and last run of a range: id and size of the whole run it is a piece of, and whether it begins that."""
    first = rows.where("first_text IS NOT NULL").select("part", F.col("first_text").alias("text"), "keep_id", "group_size")
    last = rows.where("last_text IS NOT NULL").select("part", "run", F.col("last_text").alias("text"), "keep_id", "group_size")
    # The ranges that hold rows, numbered without their texts; then each is compared with the end of the one before.
    numbered = first.select("part", F.row_number().over(Window.orderBy("part")).alias("at"))
    before = last.join(numbered, "part").select((F.col("at") + 1).alias("at"), F.col("text").alias("_text"))
    goes_on = first.join(numbered, "part").join(before, "at", "left").select(
        "part", F.coalesce(F.col("text") == F.col("_text"), F.lit(False)).alias("goes_on"))
    pieces = first.select("part", F.lit(0).cast("long").alias("run"), "keep_id", "group_size").join(goes_on, "part")
    pieces = pieces.unionByName(
        last.where("run > 0").select("part", "run", "keep_id", "group_size", F.lit(False).alias("goes_on")))
    along = Window.orderBy("part", "run")
    chained = pieces.withColumn("whole", F.sum(F.when(F.col("goes_on"), 0).otherwise(1)).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    whole = Window.partitionBy("whole")
    return chained.select(
        F.col("part").alias("_part"), F.col("run").alias("_run"), F.first("keep_id").over(whole.orderBy("part", "run")).alias("_keep"),
        F.sum("group_size").over(whole).alias("_size"), (~F.col("goes_on")).alias("_begins"))


def classes(documents: DataFrame, ranges: int | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``keep_id`` (of the row that stays), ``group_size``, ``kept`` and
    ``text_sha256``, of the normalised text in UTF-8. Other columns are not read; an empty table gives no rows.

    ``ranges`` is the number of ranges sorted apart; by default Spark's number of shuffle partitions.
    """
    spark = documents.sparkSession
    path = scratch(spark, "sorted")
    _ordered(documents, ranges).mapInArrow(tidied(_marked), ROWS).write.parquet(path)
    rows = spark.read.parquet(path)
    ends = scratch(spark, "sorted-ends")
    _joined_ends(rows).write.parquet(ends)
    pieces = F.broadcast(spark.read.parquet(ends))  # two rows a range at most
    joined = rows.join(pieces, (F.col("part") == F.col("_part")) & (F.col("run") == F.col("_run")), "left")
    inside = F.col("_part").isNull()
    return joined.select(
        "doc_id", F.when(inside, F.col("keep_id")).otherwise(F.col("_keep")).alias("keep_id"),
        F.when(inside, F.col("group_size")).otherwise(F.col("_size")).alias("group_size"),
        (F.col("kept") & F.coalesce("_begins", F.lit(True))).alias("kept"), "text_sha256")


def kept(documents: DataFrame, ranges: int | None = None) -> DataFrame:
    """The rows of ``documents`` that stay, with all their columns.

    Rows of one id and equal texts are told apart by nothing here, so of those any one stays; so does one of the rows
    without an id if no equal text has one.
    """
    text = normalised(F.col("text"))
    stay = classes(documents, ranges).where("kept").select(F.col("doc_id").alias("_stay"), F.col("text_sha256").alias("_sha"))
    numbered = Window.partitionBy("_id", "_digest").orderBy(F.lit(0))
    keyed = documents.withColumns({"_id": F.col("doc_id").cast("long"), "_digest": F.sha2(text.cast("binary"), 256)})
    found = keyed.join(stay, F.col("_id").eqNullSafe(F.col("_stay")) & (F.col("_digest") == F.col("_sha")))
    once = found.withColumn("_nth", F.row_number().over(numbered)).where("_nth = 1")
    return once.select(*[F.col(f"`{c}`") for c in documents.columns])

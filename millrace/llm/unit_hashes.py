"""Substring dedup by hashing lines, paragraphs or passages.

A unit is a line, a paragraph (what empty lines part) or a passage. Passages part a text, whatever its lines, before
the words at which the hash of three words is the least of those up to ``REACH`` words away. Cuts thus depend on
the words around them only: what two texts share is cut alike in both, so a shared run inside longer lines or over
several is found but for its ends, and a changed word costs the passages next to it. A unit is normalised to its words, A-Z
lower-cased, with single spaces, and hashed to 128 bits. Of all units with one digest the earliest,
by document id and place, stays; the others are removed. Units of fewer than ``min_words`` words
are left alone.

:func:`runs` joins repeated units that adjoin here and in the earlier text to passages and keeps those of many words. The shared words before the first whole
unit and after the last belong to units that are shared in part only, so a run is given if it and the
units at its ends together may hold ``min_words`` words and ``SURE`` of them lie in whole repeated units. The units given are all
repeated, and a passage of that many words is lost only if it holds no two fit cuts.

A digest that a third of all rows hold is counted on the map side first, and its earliest place is one row. Digests of more
than one in ``HOT`` units number fewer than that and are sent to the tasks; others are joined by shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.words import WordHashes, batches_of, hashed, run_hashes, tidied
from millrace.session import scratch

UNITS = "doc_id BIGINT, unit INT, start BIGINT, n_chars BIGINT, n_words INT, before INT, after INT, high BIGINT, low BIGINT"
MIN_WORDS = 5
SURE = 0.4  # of the words of a run, in whole repeated units
HOT = 10_000
REACH = 4  # a passage has more words than this, but for the ends of a text, and about twice as many
_WORD = re.compile(r"[^\x20\x09-\x0d]+")
_PARTS = {"line": r"\n", "paragraph": r"\n[\x20\x09\x0b-\x0d]*\n\s*"}


def _digest(words: list[bytes]) -> tuple[int, int]:
    """Both halves of the digest of a unit."""
    raw = xxhash.xxh3_128_digest(b" ".join(words))
    return int.from_bytes(raw[:8], "big", signed=True), int.from_bytes(raw[8:], "big", signed=True)


def places(text: str, part: re.Pattern) -> Iterator[tuple[int, int]]:
    """Start and end of each unit, in characters."""
    at = 0
    for gap in part.finditer(text):
        yield at, gap.start()
        at = gap.end()
    yield at, len(text)


def cuts(h: np.ndarray) -> np.ndarray:
    """Numbers of the words that begin a passage, other than the first; of equal hashes near each other none, or the first."""
    v = run_hashes(h, [0, 1, 2])
    if not len(v):
        return np.empty(0, np.int64)
    most = np.full(REACH, np.iinfo(np.uint64).max)
    least = np.lib.stride_tricks.sliding_window_view(np.concatenate([most, v, most]), REACH).min(axis=1)
    found = np.flatnonzero((v < least[:len(v)]) & (v <= least[REACH + 1:]))
    return found[found > 0]


Unit = tuple[int, int, list[bytes]]


def passages(text: str, memo: WordHashes) -> list[Unit]:
    """Start and end of each passage, in characters, and its words."""
    spans = [m.span() for m in _WORD.finditer(text)]
    if not spans:
        return []
    words = text.encode().lower().split()
    bounds = [0, *cuts(hashed(words, memo)).tolist(), len(spans)]
    return [(spans[a][0], spans[b - 1][1], words[a:b]) for a, b in zip(bounds, bounds[1:])]


def units(documents: DataFrame, by: str = "line", min_words: int = MIN_WORDS) -> DataFrame:
    """The units of every text that has an id, with their place, their words' number and that of both neighbours, and digest."""
    part = re.compile(_PARTS[by]) if by != "passage" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches_of(batches, 4 << 20):
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if doc is None or not text:
                    continue
                found = passages(text, memo) if part is None else [(a, b, text[a:b].encode().lower().split()) for a, b in places(text, part)]
                sizes = [0, *(len(w) for _, _, w in found), 0]
                rows += [(doc, i, a, b - a, sizes[i + 1], sizes[i], sizes[i + 2], *_digest(w))
                         for i, (a, b, w) in enumerate(found) if len(w) >= min_words]
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                             names=[f.split()[0] for f in UNITS.split(", ")])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidied(run), UNITS)


def _repeated(documents: DataFrame, by: str, min_words: int) -> DataFrame:
    """The units that repeat an earlier one, with the number, document and start of that."""
    spark = documents.sparkSession
    path, counted = scratch(spark, "units"), scratch(spark, "unit-firsts")
    units(documents, by, min_words).write.parquet(path)
    found = spark.read.parquet(path)
    first = found.groupBy("high", "low").agg(
        F.min(F.struct("doc_id", "unit", "start")).alias("first"), F.max(F.struct("doc_id", "unit", "start")).alias("last"), F.count(F.lit(1)).alias("n"))
    first.where("first <> last").select(
        "high", "low", "n", F.col("first.doc_id").alias("first_doc_id"), F.col("first.unit").alias("first_unit"),
        F.col("first.start").alias("first_start")).write.parquet(counted)
    first = spark.read.parquet(counted)
    share = found.count() // HOT
    hot = F.broadcast(first.where(F.col("n") > share).drop("n"))  # fewer than HOT rows
    on = ["high", "low"]
    ordinary = found.join(hot, on, "left_anti").join(first.where(F.col("n") <= share).drop("n"), on)
    joined = found.join(hot, on).unionByName(ordinary)
    return joined.where("doc_id <> first_doc_id OR unit <> first_unit")


def repeats(documents: DataFrame, by: str = "line", min_words: int = MIN_WORDS) -> DataFrame:
    """The units to remove: ``doc_id``, ``unit``, ``start`` and ``n_chars`` in the text as it was, and
    ``first_doc_id`` and ``first_unit`` of the occurrence that stays.

    Null and empty texts and null ids have no units. Rows that repeat a document are one document.
    Other columns are not read.
    """
    joined = _repeated(documents, by, min_words)
    return joined.select("doc_id", "unit", "start", "n_chars", "first_doc_id", "first_unit").distinct()


def runs(documents: DataFrame, min_words: int = 50, by: str = "passage") -> DataFrame:
    """Repeated passages of about ``min_words`` words or more: ``doc_id``, ``start`` and ``n_chars`` in the text as it was,
    ``n_words``, and ``first_doc_id`` and ``first_start``, where the words at its start first occur.

    Edge cases are those of :func:`repeats`. A passage that occurs twice in one document is given the second time.
    """
    found = _repeated(documents, by, 1).dropDuplicates(["doc_id", "unit"])
    along = Window.partitionBy("doc_id").orderBy("unit")  # one document's units
    # Units follow each other if they do so in the earlier text too. One between two that do, but known from elsewhere, belongs to them.
    source = F.struct(F.col("first_doc_id").alias("doc"), (F.col("unit") - F.col("first_unit")).alias("shift"))
    placed = found.withColumn("_source", source)
    before, after = F.lag(F.struct("unit", "_source")).over(along), F.lead(F.struct("unit", "_source")).over(along)
    between = (before["unit"] == F.col("unit") - 1) & (after["unit"] == F.col("unit") + 1) & (before["_source"] == after["_source"])
    placed = placed.withColumn("_from", F.when(between, before["_source"]).otherwise(F.col("_source")))
    rows = placed.withColumn("_run", F.col("unit") - F.row_number().over(Window.partitionBy("doc_id", "_from").orderBy("unit")))
    joined = rows.groupBy("doc_id", "_from", "_run").agg(
        F.min("start").alias("start"), F.max(F.col("start") + F.col("n_chars")).alias("_end"), F.sum("n_words").alias("n_words"),
        F.min_by("before", "unit").alias("_before"), F.max_by("after", "unit").alias("_after"),
        F.min_by("first_doc_id", "unit").alias("first_doc_id"), F.min_by("first_start", "unit").alias("first_start"))
    enough = (F.col("n_words") >= SURE * min_words) & (F.col("n_words") + F.col("_before") + F.col("_after") >= min_words)
    return joined.where(enough).select(
        "doc_id", "start", (F.col("_end") - F.col("start")).alias("n_chars"), "n_words", "first_doc_id", "first_start")


def cleaned(documents: DataFrame, by: str = "line", min_words: int = MIN_WORDS) -> DataFrame:
    """``documents`` without repeated units and the separators that followed them, and ``removed``: the
    (start, n_chars) of what was cut, in the text as it was. A column named ``removed`` is replaced."""
    spans = repeats(documents, by, min_words).groupBy(F.col("doc_id").alias("_doc")).agg(
        F.sort_array(F.collect_list(F.struct("start", "n_chars"))).alias("removed"))
    kept = documents.drop("removed")
    joined = kept.join(spans, F.col("doc_id").cast("long") == F.col("_doc"), "left").drop("_doc")
    # What stays between one cut and the next; a cut takes the line end after it along.
    ends = F.transform("removed", lambda s: s["start"] + s["n_chars"] + 1)
    starts = F.transform("removed", lambda s: s["start"])
    pieces = F.zip_with(
        F.concat(F.array(F.lit(0).cast("long")), ends),
        F.concat(starts, F.array(F.length("text").cast("long"))),
        lambda a, b: F.substring(F.col("text"), (a + 1).cast("int"), F.greatest(b - a, F.lit(0)).cast("int")))
    text = F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.array_join(pieces, ""))
    return joined.withColumn("text", text).withColumn("removed", F.coalesce("removed", F.expr("array()").cast("array<struct<start:bigint,n_chars:bigint>>")))

"""Benchmark decontamination by spaced seeds.

A mask names the places of a span of tokens that are hashed; the others may differ. Every start of
every item and document is hashed under a few fixed masks. Documents emit only starts whose hash
passes a Bloom filter of the items' hashes (a fixed ``FILTER_BITS``, so safe to send to all tasks),
each with as many token hashes around it as the longest item has; those join the items' hashes. Each hit sets
a diagonal, on all of which the tokens of both sides are compared: an overlap is the longest stretch of it of at
least ``min_tokens`` (or the whole item, if shorter) that begins and ends with equal tokens and of which
at least ``percent`` in a hundred are equal. Substituted tokens are thus tolerated.

With at least 80 percent of at least ``SPAN`` tokens equal, every overlap holds a seed of some mask (a longer
one than 33 tokens holds a shorter one, and tests enumerate the rest). Items shorter than ``SPAN`` tokens
must be met whole: they have masks of their own length, such that one is left by any substitutions that ``percent``
allows. Items shorter than ``SHORT`` tokens say too little and are not looked for.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import WordHashes, batches_of, hashed, lists, mixed, run_hashes, texts, tidied, words
from millrace.session import scratch

# Places of a span of 7 to 11 tokens that each mask reads: six of them, spread so that no overlap misses all masks.
MASKS = (
    (0, 1, 2, 4, 5, 6),
    (0, 1, 3, 6, 9, 10),
    (0, 1, 3, 7, 9, 10),
)
SHORT = 5
FILTER_BITS = 1 << 24
LEAST_PERCENT = 80
SPAN = 13  # the masks are for overlaps of so many tokens or more
PIECE = 1024  # hits of a document over so many tokens, or four longest items, have a stretch of tokens of their own

SEEDS = "item_id BIGINT, tokens ARRAY<BIGINT>, at ARRAY<INT>, hash ARRAY<BIGINT>"
STRETCHES = "doc_id BIGINT, offset BIGINT, n_tokens BIGINT, tokens ARRAY<BIGINT>, at ARRAY<INT>, hash ARRAY<BIGINT>"


def _seeds(h: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(starts, hashes) of each mask that fits."""
    out = []
    for i, mask in enumerate(MASKS):
        found = run_hashes(h, list(mask)) + np.uint64(i + 1)
        out.append((np.arange(len(found)), mixed(found)))
    return out


def short_masks(n: int, percent: int) -> list[tuple[int, ...]]:
    """Masks as long as an item of ``n`` tokens: both ends, and the inner tokens in blocks, two more than
    may differ, of which each mask reads two."""
    differ = n * (100 - percent) // 100
    blocks = np.array_split(np.arange(1, n - 1), max(1, min(n - 2, differ + 2))) if differ else [np.arange(1, n - 1)]
    read = max(0, len(blocks) - differ)
    return [(0, *map(int, np.concatenate([*some, []])), n - 1) for some in itertools.combinations(blocks, read)]


def _short_seeds(h: np.ndarray, n: int, percent: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(starts, hashes) of each mask for items of ``n`` tokens."""
    out = []
    for i, mask in enumerate(short_masks(n, percent)):
        found = run_hashes(h, list(mask)) + np.uint64(1000 * n + i)
        out.append((np.arange(len(found)), mixed(found)))
    return out


def item_seeds(items: DataFrame, percent: int = 80) -> DataFrame:
    """Tokens of each item with the starts and hashes of its seeds; null ids and texts give no row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            out = []
            for item, text in zip(batch.column("item_id").to_pylist(), texts(batch)):
                h = hashed(words(text), memo)
                if item is not None and len(h) >= SHORT:
                    seeds = _seeds(h) if len(h) >= SPAN else _short_seeds(h, len(h), percent)
                    out.append((item, h, np.concatenate([s for s, _ in seeds]), np.concatenate([f for _, f in seeds])))
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in out], pa.int64()), lists([r[1].view(np.int64) for r in out], pa.int64()),
                lists([r[2].astype(np.int32) for r in out], pa.int32()), lists([r[3].view(np.int64) for r in out], pa.int64()),
            ], names=["item_id", "tokens", "at", "hash"])

    return items.select(F.col("item_id").cast("long"), "text").mapInArrow(tidied(run), SEEDS)


def _bits(hashes: np.ndarray) -> list[np.ndarray]:
    """Two bit numbers per hash."""
    h = hashes.view(np.uint64)
    return [h % np.uint64(FILTER_BITS), (h >> np.uint64(32)) % np.uint64(FILTER_BITS)]


def _filter(seeds: DataFrame) -> np.ndarray:
    """Bloom filter of all seed hashes, joined from one filter per task: fixed size, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS, bool)
        for batch in batches:
            for b in _bits(batch.column("hash").to_numpy(zero_copy_only=False)):
                bits[b.astype(np.int64)] = True
        set_ = np.flatnonzero(bits)
        # As set bits, so that few seeds make few rows.
        yield pa.RecordBatch.from_arrays([pa.array(set_, pa.int64())], names=["bit"])

    bits = np.zeros(FILTER_BITS, bool)
    found = seeds.select("hash").mapInArrow(tidied(run), "bit BIGINT").distinct()
    for batch in found.groupBy(F.floor(F.col("bit") / 65536).alias("part")).agg(F.collect_list("bit").alias("bits")).toLocalIterator():
        bits[batch.bits] = True
    return np.packbits(bits)


def _stretches(documents: DataFrame, packed: np.ndarray, lengths: list[int], percent: int, around: int) -> DataFrame:
    """Stretches of a document's tokens with the starts and hashes of possible seeds in them, and ``around`` more on each side."""
    shipped = documents.sparkSession.sparkContext.broadcast(packed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(shipped.value).view(bool)
        memo = WordHashes()
        for batch in batches_of(batches):
            out: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                h = hashed(words(text), memo)
                if doc is None or len(h) < SHORT:
                    continue
                seeds = _seeds(h)
                for n in lengths:  # items too short for the masks
                    seeds += _short_seeds(h, n, percent)
                starts = np.concatenate([s for s, _ in seeds])
                found = np.concatenate([f for _, f in seeds])
                a, b = _bits(found)
                hit = bits[a.astype(np.int64)]
                hit[hit] = bits[b[hit].astype(np.int64)]
                if not hit.any():
                    continue
                starts, found = starts[hit], found[hit]
                order = np.argsort(starts, kind="stable")
                starts, found = starts[order], found[order]
                for part in np.split(np.arange(len(starts)), np.flatnonzero(np.diff(starts) > 2 * around) + 1):
                    # A long run of hits is cut as well, each piece with its own surroundings.
                    for piece in np.split(part, np.flatnonzero(np.diff((starts[part] - starts[part[0]]) // max(PIECE, 4 * around))) + 1):
                        lo = max(0, int(starts[piece[0]]) - around)
                        hi = int(starts[piece[-1]]) + around
                        out.append((doc, lo, len(h), h[lo:hi].view(np.int64), (starts[piece] - lo).astype(np.int32), found[piece].view(np.int64)))
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.int64()),
                lists([r[3] for r in out], pa.int64()), lists([r[4] for r in out], pa.int32()), lists([r[5] for r in out], pa.int64()),
            ], names=["doc_id", "offset", "n_tokens", "tokens", "at", "hash"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidied(run), STRETCHES)


def longest_overlap(equal: np.ndarray, least: int, percent: int) -> tuple[int, int] | None:
    """Ends of the first longest stretch with enough equal tokens, itself ending in equal ones.

    With gain 100 - percent for an equal token and -percent for another, a stretch qualifies if its
    gains sum to zero or more.
    """
    left = np.flatnonzero(equal)
    if not len(left):
        return None
    gain = np.concatenate([[0], np.cumsum(np.where(equal, 100 - percent, -percent))])
    # The greatest gain at this or a later end falls from end to end; the last that suffices is itself an end's.
    greatest = np.maximum.accumulate(gain[left + 1][::-1])
    last = len(left) - 1 - np.searchsorted(greatest, gain[left])
    sizes = left[last] + 1 - left
    best = int(sizes.argmax())
    return (int(left[best]), int(left[last[best]]) + 1) if sizes[best] >= least else None


def _exploded(rows: DataFrame, *ids: str) -> DataFrame:
    seeds = rows.select(*ids, F.explode(F.arrays_zip("at", "hash")).alias("_seed"))
    return seeds.select(*ids, F.col("_seed.at").alias("at"), F.col("_seed.hash").alias("hash")).distinct()


def overlaps(documents: DataFrame, items: DataFrame, min_tokens: int = 13, percent: int = 80) -> DataFrame:
    """One row per document and item that overlap: ``doc_id``, ``item_id``, the overlap's first token and
    length in the document (``start``, ``n_tokens``), and ``n_equal`` of them; of several the longest,
    then the first. Null ids, null, empty and blank texts overlap with nothing; repeated rows count
    once. Other columns are not read. ``percent`` must be at least 80, which the masks are made for.
    """
    if percent < LEAST_PERCENT:
        raise ValueError(f"the masks miss overlaps of less than {LEAST_PERCENT} percent equal tokens")
    spark = documents.sparkSession
    stored = scratch(spark, "seed-items")
    item_seeds(items, percent).write.parquet(stored)
    stored = spark.read.parquet(stored)
    seeds = _exploded(stored, "item_id").withColumnRenamed("at", "item_at")
    short = stored.select(F.size("tokens").alias("n")).where(F.col("n") < SPAN).distinct()
    lengths = sorted(r.n for r in short.collect())  # fewer than SPAN numbers
    longest = stored.agg(F.max(F.size("tokens"))).first()[0] or 0
    found = scratch(spark, "seed-stretches")
    _stretches(documents, _filter(seeds), lengths, percent, longest).write.parquet(found)
    found = spark.read.parquet(found)
    hits = _exploded(found, "doc_id", "offset").join(seeds, "hash")
    # Hits on one diagonal of a stretch are verified together, on all tokens that both sides have there.
    place = ["doc_id", "offset", "item_id", "diagonal"]
    diagonals = hits.withColumn("diagonal", F.col("at") - F.col("item_at")).select(*place).distinct()
    joined = diagonals.join(stored.select("item_id", F.col("tokens").alias("item")).dropDuplicates(["item_id"]), "item_id")
    joined = joined.join(found.select("doc_id", "offset", F.col("tokens").alias("own")).distinct(), ["doc_id", "offset"])
    skipped = F.greatest(-F.col("diagonal"), F.lit(0))
    first = F.greatest(F.col("diagonal"), F.lit(0))
    size = F.least(F.size("item") - skipped, F.size("own") - first)
    joined = joined.select(
        "doc_id", "item_id", (F.col("offset") + first).alias("start"), F.size("item").alias("n"),
        F.slice("item", skipped + 1, size).alias("item"), F.slice("own", first + 1, size).alias("own"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            own, item = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("own", "item"))
            ends = np.cumsum([0, *batch.column("own").value_lengths().to_pylist()])
            same = own == item
            for i, (doc, item_id, start, n) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "item_id", "start", "n")))):
                equal = same[ends[i]:ends[i + 1]]
                best = longest_overlap(equal, min(min_tokens, n), percent)
                if best:
                    rows.append((doc, item_id, start + best[0], best[1] - best[0], int(equal[best[0]:best[1]].sum())))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in rows], pa.int64()) for i in range(5)],
                names=["doc_id", "item_id", "start", "n_tokens", "n_equal"])

    checked = joined.mapInArrow(tidied(run), "doc_id BIGINT, item_id BIGINT, start BIGINT, n_tokens BIGINT, n_equal BIGINT")
    best = checked.groupBy("doc_id", "item_id").agg(F.max(F.struct("n_tokens", (-F.col("start")).alias("s"), "n_equal")).alias("best"))
    return best.select("doc_id", "item_id", (-F.col("best.s")).alias("start"), "best.n_tokens", "best.n_equal")


def kept(documents: DataFrame, items: DataFrame, min_tokens: int = 13, percent: int = 80) -> DataFrame:
    """``documents`` without those that overlap with an item; rows without an id stay."""
    hit = overlaps(documents, items, min_tokens, percent).select(F.col("doc_id").alias("_doc")).distinct()
    return documents.join(hit, F.col("doc_id") == F.col("_doc"), "left_anti")

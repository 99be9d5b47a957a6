"""Near-duplicate documents by bottom-k sketches of one hash function.

1. A task hashes the word shingles of each whole text with one function; the set's size, a 128-bit
   digest of the set and its ``FIRST`` smallest values are kept. Texts with equal sets form a class;
   only its smallest ``doc_id`` goes on, and only if others share enough of its first values. Of
   those texts the smallest values are taken (all of a set up to ``FULL``, else ``K``).
2. Inverted lists of retained values generate overlaps. Two sets of similarity s share each of the
   smallest values of their union with probability s, so a pair above the threshold shares at
   least ``need`` values of its sketches (surely, if both are whole; else but for about one pair
   in 10^8). A document with fewer values that any other holds is out. The others list only their
   rarest values: with c values that others hold too, the rarest c - need + 1 meet any partner. At the
   rarest value that a pair shares, both must have enough shared values left for the threshold.
   A common passage is thus no key unless it fills most of a text.
3. In each list every member is compared with the most typical member first (the one with the
   fewest values of its own). What these links leave in different components, and could still
   reach the threshold by size and number of shared values, is then compared within its list, cut
   into blocks; pairs that are already connected are not compared again.
4. Candidates pass if the bottom-k sketch of their union, made from both, allows the threshold;
   then the full sets are intersected. Components follow by repeated minimum labels.

Nothing of a list or component goes to the driver but counts. Tables between steps are written
below ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import WordHashes, batches_of, hashed, lists, mixed, shingles, texts, tidied, words
from millrace.session import scratch

K = 256
FULL = 1024
FIRST = 16  # smallest values that the first, cheap round looks at
SLACK = 6.5  # standard deviations granted to a sketch
MOST_BROADCAST = 1 << 19  # ids of documents to read again that are sent to all tasks
BLOCK_ROWS = 4096  # list members that one side of a block holds, about

SIGNATURE = "doc_id BIGINT, n_shingles BIGINT, digest BINARY, first ARRAY<BIGINT>"
SKETCH = "doc BIGINT, n BIGINT, sketch ARRAY<BIGINT>"


def _digest(values: np.ndarray) -> bytes:
    """Of a sorted set: two independent 64-bit sums, and its size."""
    values = values.view(np.uint64)
    with np.errstate(over="ignore"):
        a, b = mixed(values).sum(dtype=np.uint64), mixed(values ^ np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)
    return a.tobytes() + b.tobytes() + len(values).to_bytes(8, "little")


def signatures(documents: DataFrame, width: int = 5) -> DataFrame:
    """Size, digest and smallest values of each row's set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches_of(batches):
            sets = [shingles(hashed(words(t), memo), width) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_digest(s) for s in sets], pa.binary()), lists([s[:FIRST] for s in sets], pa.int64()),
            ], names=["doc_id", "n_shingles", "digest", "first"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidied(run), SIGNATURE)


def sketches(documents: DataFrame, width: int = 5) -> DataFrame:
    """The bottom-k sketch of each row; all of a small set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches_of(batches):
            sets = [shingles(hashed(words(t), memo), width) for t in texts(batch)]
            kept = [s if len(s) <= FULL else s[:K] for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), lists(kept, pa.int64())], names=["doc", "n", "sketch"])

    return documents.mapInArrow(tidied(run), SKETCH)


def _texts_of(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts of some ids, one of each: the ids go to all tasks if they are few, else both sides are shuffled."""
    ids = ids.sparkSession.read.parquet(_written(ids.select("doc_id"), "near-wanted"))
    few = ids.count() <= MOST_BROADCAST  # 8 bytes each
    return documents.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")


def _full_sets(documents: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches_of(batches, 8 << 20):
            sets = [shingles(hashed(words(t), memo), width) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists(sets, pa.int64())], names=["_id", "_set"])

    return documents.mapInArrow(tidied(run), "_id BIGINT, _set ARRAY<BIGINT>")


def least(k: int, percent: int) -> int:
    """Values that the union sketch of k values shares at the threshold, less the slack."""
    s = percent / 100
    return max(1, math.floor(k * s - SLACK * math.sqrt(k * s * (1 - s))))


def _need(percent: int, n: str) -> Column:
    """Values that a sketch shares with that of any partner at the threshold."""
    whole = F.ceil(F.col(n) * percent / 100)
    # A whole set may meet a partner of which only K values are known.
    mixed = F.least(whole, F.lit(least(K, percent)))
    return F.when(F.col(n) <= math.floor(FULL * percent / 100), whole).otherwise(
        F.when(F.col(n) <= FULL, mixed).otherwise(F.lit(least(K, percent)))).cast("int")


def _both_pass(percent: int, a: str, b: str) -> Column:
    """Size and position bounds of a pair: |A & B| >= p (|A| + |B|) / (100 + p).

    At the rarest value that both hold, all they share is yet to come on either side.
    """
    na, nb = F.col(f"{a}n"), F.col(f"{b}n")
    sizes = (na * 100 >= nb * percent) & (nb * 100 >= na * percent)
    wanted = (na + nb) * percent
    whole = (na <= FULL) & (nb <= FULL)
    most = F.least(F.col(f"{a}ahead"), F.col(f"{b}ahead")) * (100 + percent)
    return sizes & (~whole | (most >= wanted))


def _alive(base: DataFrame) -> DataFrame:
    """(doc, n) of the class representatives that share enough of their smallest values with any other."""
    reps = base.where("doc_id = rep").dropDuplicates(["doc_id"])
    first = reps.select(F.col("doc_id").alias("doc"), F.col("n_shingles").alias("n"), F.explode("first").alias("value"))
    held = first.groupBy("value").count().where("count > 1").select("value")
    hits = first.join(held, "value").groupBy("doc").agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("hits"))
    # Of FIRST values a pair shares two at least, or one of a set that small.
    return hits.where((F.col("hits") >= 2) | (F.col("n") < FIRST)).select("doc", "n")


def _lists(alive: DataFrame, percent: int) -> DataFrame:
    """(value, doc, n, lone, ahead) of the rarest values of each document that may have a partner.

    ``lone``: values that no other holds; ``ahead``: shared values from this one on, by rarity.
    """
    values = alive.select("doc", "n", F.explode("sketch").alias("value"))
    counts = values.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = values.join(counts, "value").groupBy("doc").agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "value"))).alias("held"))
    shared = shared.withColumn("shared", F.size("held")).withColumn("need", _need(percent, "n"))
    shared = shared.where("shared >= need")
    rare = F.slice("held", F.lit(1), F.col("shared") - F.col("need") + 1)
    placed = shared.select("doc", "n", "shared", F.posexplode(rare["value"]).alias("at", "value"))
    return placed.select("doc", "n", "value", (F.col("n") - F.col("shared")).alias("lone"), (F.col("shared") - F.col("at")).alias("ahead"))


def _verified(pairs: DataFrame, reps: DataFrame, documents: DataFrame, percent: int, width: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold."""
    sketch = reps.select("doc", "n", "sketch")
    left = sketch.select(F.col("doc").alias("a"), F.col("n").alias("an"), F.col("sketch").alias("asketch"))
    right = sketch.select(F.col("doc").alias("b"), F.col("n").alias("bn"), F.col("sketch").alias("bsketch"))
    spark = reps.sparkSession
    both = pairs.select("a", "b").distinct().join(left, "a").join(right, "b")
    both = both.withColumn("common", F.size(F.array_intersect("asketch", "bsketch")))
    whole = (F.col("an") <= FULL) & (F.col("bn") <= FULL)
    exact = F.col("common") * (100 + percent) >= (F.col("an") + F.col("bn")) * percent
    both = spark.read.parquet(_written(both.where(F.when(whole, exact).otherwise(F.col("common") >= least(K, percent))), "near-common"))
    # Of the union's smallest values both sketches know those up to the smaller of their ends.
    none = F.lit(2 ** 63 - 1)
    end = F.least(
        F.when(F.col("an") > FULL, F.element_at("asketch", -1)).otherwise(none),
        F.when(F.col("bn") > FULL, F.element_at("bsketch", -1)).otherwise(none))

    def estimate(e: Column) -> Column:
        known = F.size(F.filter(F.array_union("asketch", "bsketch"), lambda x: x <= e))
        hits = F.size(F.filter(F.array_intersect("asketch", "bsketch"), lambda x: x <= e))
        s = percent / 100
        return hits >= known * s - SLACK * F.sqrt(known * s * (1 - s))

    # The end is bound once for each pair, not for each value.
    allowed = F.get(F.transform(F.array(end), estimate), F.lit(0))
    possible = both.where(~whole).where(allowed).select("a", "b")
    large = spark.read.parquet(_written(possible, "near-large"))
    wanted = large.select(F.col("a").alias("doc_id")).unionByName(large.select(F.col("b").alias("doc_id"))).distinct()
    sets = spark.read.parquet(_written(_full_sets(_texts_of(documents, wanted).dropDuplicates(["doc_id"]), width), "near-sets"))
    sa, sb = sets.select(F.col("_id").alias("a"), F.col("_set").alias("aset")), sets.select(F.col("_id").alias("b"), F.col("_set").alias("bset"))
    full = large.join(sa, "a").join(sb, "b")
    size = F.size(F.array_intersect("aset", "bset"))
    checked = full.where(size * (100 + percent) >= (F.size("aset") + F.size("bset")) * percent)
    return both.where(whole).select("a", "b").unionByName(checked.select("a", "b"))


def _written(df: DataFrame, label: str) -> str:
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return path


def components(links: DataFrame) -> DataFrame:
    """(doc, component) of every end of a link (a, b); the component is its smallest member.

    Labels fall along links and, by pointer jumping, along labels; each round is written, and the
    rounds end when no label falls any more.
    """
    spark = links.sparkSession
    links = spark.read.parquet(_written(links.select("a", "b").distinct(), "links"))
    ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = ends.groupBy(F.col("a").alias("doc")).agg(F.min("b").alias("low"))
    labels = labels.select("doc", F.least("doc", "low").alias("component"))
    labels = spark.read.parquet(_written(labels, "labels"))
    while True:
        heard = ends.join(labels, F.col("a") == F.col("doc")).groupBy(F.col("b").alias("to")).agg(F.min("component").alias("low"))
        jump = labels.select(F.col("doc").alias("via"), F.col("component").alias("far"))
        new = labels.join(heard, F.col("doc") == F.col("to")).select(
            "doc", F.col("component").alias("old"), F.least("component", "low").alias("component"))
        new = new.join(jump, F.col("component") == F.col("via"), "left").select(
            "doc", "old", F.least("component", F.coalesce("far", "component")).alias("component"))
        new = spark.read.parquet(_written(new, "labels"))
        labels = new.select("doc", "component")
        if new.where("component < old").isEmpty():
            return labels


def linked(documents: DataFrame, percent: int = 85, width: int = 5) -> DataFrame:
    """One row per row of ``documents``: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    Two texts are linked if 100 * |A & B| >= ``percent`` * |A | B| for their sets of
    ``width``-word shingles; a shorter text is one shingle; null, empty and blank texts have none
    and are linked with nothing. ``component_id`` is the smallest ``doc_id`` reachable, ``kept``
    tells whether it is the row's own. Rows that share a ``doc_id`` must share a text; they get
    equal results. A null ``doc_id`` is linked with nothing and kept. Other columns are not read.
    """
    spark = documents.sparkSession
    slim = spark.read.parquet(_written(signatures(documents, width), "near-signatures"))
    usable = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    classes = slim.where(usable).groupBy("digest").agg(F.min("doc_id").alias("rep"))
    rows = slim.join(classes, "digest", "left").withColumn("rep", F.when(usable, F.col("rep")))
    first = F.when(F.col("doc_id") == F.col("rep"), F.col("first")).alias("first")
    base = spark.read.parquet(_written(rows.select("doc_id", "n_shingles", "rep", first), "near-classes"))
    own = base.where("doc_id = rep")
    alive = _texts_of(documents, _alive(base).select(F.col("doc").alias("doc_id")))
    if not own.groupBy("doc_id").count().where("count > 1").isEmpty():  # rows that repeat an id
        alive = alive.dropDuplicates(["doc_id"])
    reps = spark.read.parquet(_written(sketches(alive, width), "near-reps"))
    indexed = spark.read.parquet(_written(_lists(reps, percent), "near-lists"))

    top = indexed.groupBy("value").agg(F.min(F.struct("lone", "doc", "n", "ahead")).alias("top"), F.count(F.lit(1)).alias("size"))
    top = top.where("size > 1").select("value", F.col("top.doc").alias("a"), F.col("top.n").alias("an"), F.col("top.ahead").alias("aahead"))
    b = indexed.select("value", F.col("doc").alias("b"), F.col("n").alias("bn"), F.col("ahead").alias("bahead"))
    stars = b.join(top, "value").where("a <> b").where(_both_pass(percent, "a", "b"))
    stars = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    tried = spark.read.parquet(_written(stars.distinct(), "near-stars"))
    links = spark.read.parquet(_written(_verified(tried, reps, documents, percent, width), "near-links"))
    parts = components(links)

    # Members of a list that are still apart, if any other component could reach them.
    labelled = indexed.join(parts, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    spread = labelled.groupBy("value").agg(
        F.min("component").alias("lowest"), F.max("component").alias("highest"), F.count(F.lit(1)).alias("size"),
    ).where("lowest < highest").select("value", F.ceil(F.col("size") / BLOCK_ROWS).cast("int").alias("blocks"))
    open_ = labelled.join(spread, "value")
    open_ = open_.withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
    left = open_.select("value", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
                        F.col("doc").alias("a"), F.col("n").alias("an"), F.col("ahead").alias("aahead"), F.col("component").alias("ac"))
    right = open_.select("value", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("block").alias("other"),
                         F.col("doc").alias("b"), F.col("n").alias("bn"), F.col("ahead").alias("bahead"), F.col("component").alias("bc"))
    rest = left.join(right, ["value", "block", "other"]).where("a < b AND ac <> bc").where(_both_pass(percent, "a", "b"))
    rest = rest.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti")
    rest = spark.read.parquet(_written(rest, "near-rest"))
    more = _verified(rest, reps, documents, percent, width)
    more = spark.read.parquet(_written(more, "near-more"))
    if not more.isEmpty():
        parts = components(links.unionByName(more))

    joined = base.drop("first").join(parts, F.col("rep") == F.col("doc"), "left")
    component = F.coalesce("component", "rep", "doc_id")
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def kept(documents: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """``documents`` with one document of each group left: the one of the smallest ``doc_id``."""
    dropped = linked(documents, percent, width).where("NOT kept").select(F.col("doc_id").alias("_doc")).distinct()
    return documents.join(dropped, F.col("doc_id") == F.col("_doc"), "left_anti")

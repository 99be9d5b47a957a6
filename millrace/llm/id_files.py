"""Token-id files: documents in ascending id order, coded by :mod:`range_coder`, written and read by tasks.

Documents are dealt out by ranges of ``doc_id`` and sorted within them, so file names in order hold
them in order. A file ends after the document that fills ``FILE_IDS`` ids; a document is never split
between files. Files are written under a name of the attempt and then renamed, so a task that runs
again replaces its files by equal ones. They are read with Spark's binary reader.

File: a header length, the number of documents, a null flag, an id and a length for each, all as
little-endian 64-bit numbers, then the coded stream.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.range_coder import packed, unpacked
from millrace.llm.words import batches_of, tidied

FILE_IDS = 1 << 22
TEXT_BYTES = 1 << 20  # given to the tokenizer at once
MEMO = 400_000  # units whose ids a task remembers
MEMO_CHARS = 64  # longer units are not remembered
GROUP = 1024  # new words given to the tokenizer as one text

_BLANKS = " \t\n\r"
_LETTERS, _SIGNS = r"[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u02af\u0400-\u0481]", r"[!-/:-@\[-`{-~\x00-\x08\x0e-\x1b\x7f]"
# A run of letters, digits or signs ends before ASCII of another kind; what may go on in a rarer character stays whole.
_UNITS = re.compile(
    rf" ?(?:{_LETTERS}++|[0-9]++)(?![^\x00-\x7f])|'(?:[stmd]|re|ve|ll)|(?: |(?!')){_SIGNS}++(?![^\x00-\x7f])"
    r"| ?[^ \t\n\r]+|[ \t\n\r]+(?![^ \t\n\r])|[ \t\n\r]").findall
_ODD = re.compile(r"[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]").search  # blanks to some
_ODD_ASCII = "\x0b\x0c\x1c\x1d\x1e\x1f"


def _odd(text: str) -> bool:
    return any(c in text for c in _ODD_ASCII) if text.isascii() else _ODD(text) is not None


class Units(dict):
    """Ids of units of a text, as bytes; short units are remembered.

    A unit is a run of letters, digits or signs with the one space before it, a word of rarer characters, or blanks. A byte-level
    tokenizer with the usual split always cuts between units, so the ids of a text are those of its units, which repeat. Units that
    are new go to the tokenizer many in a text: one with a space begins with its only space, and so does its first id; others
    have a line end, which no unit holds, after each. Texts with rarer blanks or an added token in them, and all texts under
    other tokenizers, go to the tokenizer whole.
    """

    def __init__(self, model) -> None:
        from tokenizers.models import BPE
        from tokenizers.pre_tokenizers import ByteLevel

        self.model, pre = model, model.pre_tokenizer
        parts = (model.normalizer, model.post_processor, model.truncation, model.padding)
        self.cuts = (isinstance(pre, ByteLevel) and pre.use_regex and not pre.add_prefix_space and all(x is None for x in parts)
                     and isinstance(model.model, BPE) and not model.model.dropout)
        self.added = [t.content for t in model.get_added_tokens_decoder().values()]
        names = model.get_vocab()
        self.spaced = np.zeros(max(names.values(), default=0) + 1, bool)
        self.spaced[[i for name, i in names.items() if name.startswith("\u0120")]] = True
        self.line_end = names.get("\u010a", -1)

    def encoded(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as bytes, little-endian 32-bit numbers."""
        apart = [self.cuts and not _odd(t) and not any(a in t for a in self.added) for t in texts]
        split = [_UNITS(t) if x else [] for t, x in zip(texts, apart)]
        self._learn(split)
        whole = iter(self._coded([t for t, x in zip(texts, apart) if not x]))
        return [b"".join(map(self.__getitem__, units)) if x else next(whole) for units, x in zip(split, apart)]

    def _coded(self, texts: list[str]) -> list[bytes]:
        return [np.array(c.ids, "<u4").tobytes() for c in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, split: list[list[str]]) -> None:
        fresh = set(filterfalse(self.__contains__, chain.from_iterable(split)))
        if len(self) + len(fresh) > MEMO:
            self.clear()
            fresh = set().union(*split)
        fresh = [u for u in fresh if len(u) <= MEMO_CHARS]
        spaced = [u for u in fresh if u[0] == " " and u[-1] not in _BLANKS]
        raw, ids = self._together(spaced, "")
        starts = np.flatnonzero(self.spaced[ids])
        self._keep(spaced, raw, starts, np.append(starts[1:], len(ids)))
        bare = [u for u in fresh if u[0] not in _BLANKS]
        raw, ids = self._together(bare, "\n")
        ends = np.flatnonzero(ids == self.line_end)
        self._keep(bare, raw, np.append(0, ends[:-1] + 1), ends)
        others = [u for u in fresh if u not in self]
        self.update(zip(others, self._coded(others)))

    def _together(self, units: list[str], end: str) -> tuple[bytes, np.ndarray]:
        """Ids of units given many in a text, each with ``end`` after it, as bytes and as numbers."""
        raw = b"".join(self._coded(["".join(u + end for u in units[a:a + GROUP]) for a in range(0, len(units), GROUP)]))
        return raw, np.frombuffer(raw, "<u4")

    def _keep(self, units: list[str], raw: bytes, starts: np.ndarray, ends: np.ndarray) -> None:
        if units and len(units) == len(ends):
            self.update((u, raw[a:b]) for u, a, b in zip(units, (4 * starts).tolist(), (4 * ends).tolist()))

    def __missing__(self, unit: str) -> bytes:
        return self._coded([unit])[0]


def file_bytes(docs: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    header = np.array([len(docs), *(d is None for d in docs), *(d or 0 for d in docs), *lengths], "<i8").tobytes()
    return len(header).to_bytes(8, "little") + header + packed(ids)


def file_parts(raw: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, lengths and all ids of a file."""
    size = int.from_bytes(raw[:8], "little")
    header = np.frombuffer(raw, "<i8", size // 8, 8)
    n = int(header[0])
    none, docs, lengths = header[1:n + 1], header[n + 1:2 * n + 1], header[2 * n + 1:]
    return [None if x else int(d) for x, d in zip(none, docs)], lengths, unpacked(raw[8 + size:])


def write(documents: DataFrame, folder: str, tokenizer: str, end: int = 2) -> DataFrame:
    """Write the ids of ``documents`` below ``folder``; gives (file, docs, ids) when it is run.

    ``tokenizer`` is the path of a tokenizers file that every executor has; ``end`` follows each text.
    Null and empty texts are the end alone; null ids come first; repeated rows all count. ``folder``
    is shared: a path or URI of a store that pyarrow can write to.
    """
    place = folder if re.match(r"\w+:", folder) else "file://" + os.path.abspath(folder)
    place = re.sub(r"^file:/+", "file:///", place)
    shared, folder_path = fs.FileSystem.from_uri(place)
    shared.create_dir(folder_path, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        units, last = Units(Tokenizer.from_file(tokenizer)), np.array([end], "<u4").tobytes()
        store, top = fs.FileSystem.from_uri(place)
        part, number = TaskContext.get().partitionId(), 0
        docs: list[int | None] = []
        arrays: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            nonlocal number
            name = f"part-{part:06d}-{number:06d}.ids"
            raw = file_bytes(docs, [len(a) for a in arrays], np.concatenate(arrays))
            own = f"{top}/_{name}-{uuid.uuid4().hex[:8]}"
            with store.open_output_stream(own) as out:
                out.write(raw)
            store.move(own, f"{top}/{name}")
            number += 1
            total = sum(map(len, arrays))
            made = pa.RecordBatch.from_pydict({"file": [name], "docs": [len(docs)], "ids": [total]})
            docs.clear()
            arrays.clear()
            return made

        held = 0
        for batch in batches_of(batches, TEXT_BYTES):
            coded = units.encoded([t or "" for t in batch.column("text").to_pylist()])
            for doc, raw in zip(batch.column("doc_id").to_pylist(), coded):
                docs.append(doc)
                arrays.append(np.frombuffer(raw + last, "<u4"))
                held += len(arrays[-1])
                if held >= FILE_IDS:
                    yield close()
                    held = 0
        if docs:
            yield close()

    ordered = documents.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return ordered.mapInArrow(tidied(run), "file STRING, docs BIGINT, ids BIGINT")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(file, at, doc_id, ids) of every document below ``folder``; ``at`` is its place in the file's ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, raw in zip(batch.column("path").to_pylist(), batch.column("content")):
                docs, lengths, ids = file_parts(raw.as_buffer().to_pybytes())
                ends = np.cumsum(lengths)
                # A few documents at a time; a file may hold many.
                for a in range(0, len(docs), 1024):
                    b = min(len(docs), a + 1024)
                    start = int(ends[a] - lengths[a])
                    offsets = np.concatenate([[0], ends[a:b] - start])
                    lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(ids[start:ends[b - 1]], pa.int64()))
                    yield pa.RecordBatch.from_arrays([
                        pa.array([path.rsplit("/", 1)[-1]] * (b - a)), pa.array(ends[a:b] - lengths[a:b], pa.int64()),
                        pa.array(docs[a:b], pa.int64()), lists.cast(pa.list_(pa.int64()))], names=["file", "at", "doc_id", "ids"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.ids").load(folder).select("path", "content")
    return files.mapInArrow(tidied(run), "file STRING, at BIGINT, doc_id BIGINT, ids ARRAY<BIGINT>")


def summaries(spark: SparkSession, folder: str) -> DataFrame:
    """(file, at, doc_id, n_tokens, ids_crc32) of every document, without giving out its ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, raw in zip(batch.column("path").to_pylist(), batch.column("content")):
                docs, lengths, ids = file_parts(raw.as_buffer().to_pybytes())
                ends = np.cumsum(lengths)
                raw_ids = memoryview(ids.astype("<u4").tobytes())
                sums = [zlib.crc32(raw_ids[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array([path.rsplit("/", 1)[-1]] * len(docs)), pa.array(ends - lengths, pa.int64()),
                    pa.array(docs, pa.int64()), pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())],
                    names=["file", "at", "doc_id", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.ids").load(folder).select("path", "content")
    return files.mapInArrow(tidied(run), "file STRING, at BIGINT, doc_id BIGINT, n_tokens BIGINT, ids_crc32 BIGINT")


def starts(found: DataFrame) -> DataFrame:
    """Add ``start``: all ids before a document, over all files in order.

    Sums run over files within a part, then over parts; a part is a task's, so neither list is long.
    """
    part = F.split_part("file", F.lit("-"), F.lit(2))
    files = found.groupBy("file").agg(F.sum("n_tokens").alias("_n")).withColumn("_part", part)
    parts = files.groupBy("_part").agg(F.sum("_n").alias("_all"))
    before = F.coalesce(F.sum("_all").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("_part", before.alias("_parts"))
    within = Window.partitionBy("_part").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("_files", F.coalesce(F.sum("_n").over(within), F.lit(0))).join(parts, "_part")
    files = files.select(F.col("file").alias("_file"), (F.col("_parts") + F.col("_files")).alias("_before"))
    joined = found.join(files, F.col("file") == F.col("_file"))
    return joined.withColumn("start", F.col("_before") + F.col("at")).drop("_file", "_before")

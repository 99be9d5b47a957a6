"""SentencePiece encoding and decoding by a max-plus scan.

The pieces and scores of a SentencePiece model file are read as a unigram table: the encoding of a
text is a segmentation with the greatest sum of scores (among equals the one whose last piece is
longest). A character without a piece of its own becomes its bytes' pieces, at ten below the least score.
As in the library, a text gets a space before it, and a space and the mark U+2581 are the same.

A text longer than ``CHUNK`` characters is cut anywhere. The state at a cut is how many characters
the piece across it reaches into the next chunk. For each chunk a task computes its transfer matrix:
the best score from each state at its start to each state at its end. Matrices combine
associatively under (max, +), ``FAN`` neighbours at a time and level by level; from the top down they
then give the state at every cut, and each chunk is traced back between its two states by itself. Within a
chunk the scan uses the places that every segmentation must cut, as before a space: there the
matrix has rank one, so the middle of a chunk is a sum over units, and units repeat and are remembered.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import batches_of, lists, tidied
from millrace.session import scratch

CHUNK = 16_384
FAN = 64
MEMO = 800_000  # units whose encoding a task remembers
MEMO_CHARS = 64  # longer units are not remembered
GROUP = 16_384  # units searched together
NONE = -np.inf

CHUNKS = "row BIGINT, doc_id BIGINT, chunks INT, chunk INT, text STRING, ahead STRING"
ENCODED = "row BIGINT, doc_id BIGINT, chunks INT, chunk INT, score DOUBLE, ids ARRAY<INT>"
COLUMNS = ["row", "doc_id", "chunks", "chunk", "score", "ids"]


class Pieces:
    """The vocabulary of a model file, with spaces for marks."""

    def __init__(self, path: str) -> None:
        import sentencepiece as spm

        model = spm.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.bytes = [b""] * model.get_piece_size()
        self.of_byte = [0] * 256
        self.scores = np.zeros(model.get_piece_size())
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.of_byte[int(piece[3:5], 16)] = i
                self.bytes[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                piece = piece.replace("▁", " ")
                self.ids[piece] = i
                self.bytes[i] = piece.encode()
                self.scores[i] = model.get_score(i)
        self.score = {p: float(self.scores[i]) for p, i in self.ids.items()}
        self.longest = max(map(len, self.ids), default=1)
        self.unknown = min(self.score.values(), default=0.0) - 10
        # A character's first byte carries its score, the rest none.
        for b, i in enumerate(self.of_byte):
            self.scores[i] = 0.0 if 0x80 <= b < 0xC0 else self.unknown
        self.starts = {p[:k] for p in self.ids for k in range(1, len(p))}
        spaces = any(" " in p.lstrip(" ") for p in self.ids)
        lines = any("\n" in p for p in self.ids)
        # Between two units of a text every segmentation has a cut.
        self.units = re.compile(r"(?s).+" if spaces or lines else r" *[^ \n]+| +|\n").findall

    def paths(self, text: str, size: int, at: int = 0) -> tuple[list[float], list[int]]:
        """Best score of each place from ``at`` on, and where the last piece of its path starts.

        Pieces start before ``size``; ``text`` may be longer.
        """
        score, starts, unknown, longest = self.score, self.starts, self.unknown, self.longest
        end = len(text)
        best, back = [NONE] * (end + 1), [0] * (end + 1)
        best[at] = 0.0
        for i in range(at, size):
            here = best[i]
            if here == NONE:
                continue
            part = text[i]
            found = here + score.get(part, unknown)
            if found > best[i + 1]:
                best[i + 1], back[i + 1] = found, i
            j = i + 1
            last = min(end, i + longest)
            while part in starts and j < last:
                j += 1
                part = text[i:j]
                if part in score:
                    found = here + score[part]
                    if found > best[j]:
                        best[j], back[j] = found, i
        return best, back

    def trace(self, text: str, size: int) -> bytes:
        """Ids (as int32) of the best path to the end of ``text`` with pieces that start before ``size``."""
        _, back = self.paths(text, size)
        out: list[int] = []
        j = len(text)
        while j:
            i = back[j]
            part = text[i:j]
            if part in self.ids:
                out.append(self.ids[part])
            else:
                out.extend(self.of_byte[b] for b in reversed(part.encode()))
            j = i
        return np.array(out[::-1], np.int32).tobytes()


def marked(text: str | None) -> str:
    return " " + text.replace("▁", " ") if text else ""


class Trie:
    """Pieces as a tree of characters, in arrays, to walk many units at once."""

    def __init__(self, table: Pieces) -> None:
        edges: dict[tuple[int, int], int] = {}
        self.piece = [-1]
        for text, i in table.ids.items():
            node = 0
            for c in map(ord, text):
                following = edges.setdefault((node, c), len(self.piece))
                if following == len(self.piece):
                    self.piece.append(-1)
                node = following
            self.piece[node] = i
        self.piece = np.array(self.piece)
        self.score = np.where(self.piece >= 0, table.scores[self.piece], NONE)
        self.bits = max(8, 2 * len(edges) - 1).bit_length() + 1
        self.keys, self.nodes = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int64)
        keys = np.array([n << 21 | c for n, c in edges], np.int64)
        nodes = np.array(list(edges.values()), np.int64)
        slots = self._slot(keys)
        while len(keys):  # open addressing: the first to come to a free slot has it
            free = self.keys[slots] < 0
            self.keys[slots[free]] = keys[free]
            placed = self.keys[slots] == keys
            self.nodes[slots[placed]] = nodes[placed]
            keys, nodes, slots = keys[~placed], nodes[~placed], (slots[~placed] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def step(self, nodes: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """The node that a character leads to, or -1."""
        keys = nodes << 21 | chars
        slots = self._slot(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.nodes[slots], -1)
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & (len(self.keys) - 1)
            found = self.keys[slots[open_]]
            out[open_] = np.where(found == keys[open_], self.nodes[slots[open_]], -1)
            open_ = open_[(found != keys[open_]) & (found >= 0)]
        return out


class Encoder(dict):
    """Ids of a unit, as bytes; short units are remembered."""

    def __init__(self, table: Pieces) -> None:
        self.table = table
        self.trie: Trie | None = None

    def texts(self, found: list[str], beyond: list[int] | None = None) -> list[np.ndarray]:
        """Ids of texts, in whose last ``beyond`` characters no piece may start; the units that are new are searched together."""
        split = [self.table.units(t) for t in found]
        lasts = [b""] * len(split)
        for k, b in enumerate(beyond or []):
            if b:
                last = split[k].pop()
                lasts[k] = self.table.trace(last, len(last) - b)
        self.learn(split)
        return [np.frombuffer(b"".join(map(self.__getitem__, units)) + last, np.int32) for units, last in zip(split, lasts)]

    def learn(self, split: list[list[str]]) -> None:
        """Search the units that are new, together."""
        units = set().union(*split)
        fresh = units - self.keys()
        if len(self) + len(fresh) > MEMO:
            self.clear()
            fresh = units
        fresh = [u for u in fresh if len(u) <= MEMO_CHARS]
        ordered = sorted(fresh, key=len, reverse=True)
        for a in range(0, len(ordered), GROUP):
            self._learn(ordered[a:a + GROUP])

    def _learn(self, units: list[str]) -> None:
        """The search of :meth:`Pieces.paths` for units from long to short, place by place in all of them."""
        trie = self.trie = self.trie or Trie(self.table)
        n, longest = len(units), len(units[0])
        sizes = np.array([len(u) for u in units])
        chars = np.zeros((longest, n), np.int64)
        flat = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        row = np.repeat(np.arange(n), sizes)
        chars[np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes), row] = flat
        best = np.full((longest + 1, n), NONE)
        back, piece = np.zeros((longest + 1, n), np.int64), np.full((longest + 1, n), -1)
        best[0] = 0.0
        strange = np.zeros(n, bool)  # units with a character that is no piece
        for i in range(longest):
            lanes = np.arange(np.searchsorted(-sizes, -i, side="left"))  # those longer than i
            nodes = trie.step(np.zeros(len(lanes), np.int64), chars[i, lanes])
            unknown = (nodes < 0) | (trie.piece[nodes] < 0)
            strange[lanes[unknown]] = True
            j = i + 1
            while len(lanes):
                kept = nodes >= 0
                lanes, nodes = lanes[kept], nodes[kept]
                found = best[i, lanes] + trie.score[nodes]
                better = found > best[j, lanes]
                at = lanes[better]
                best[j, at], back[j, at], piece[j, at] = found[better], i, trie.piece[nodes[better]]
                kept = sizes[lanes] > j
                lanes, nodes = lanes[kept], nodes[kept]
                if len(lanes):
                    nodes = trie.step(nodes, chars[j, lanes])
                j += 1
        ids = np.zeros((n, longest), np.int32)
        used, place, lanes = np.full(n, longest), sizes.copy(), np.flatnonzero(~strange)
        while len(lanes):
            used[lanes] -= 1
            ids[lanes, used[lanes]] = piece[place[lanes], lanes]
            place[lanes] = back[place[lanes], lanes]
            lanes = lanes[place[lanes] > 0]
        raw, width, starts = ids.tobytes(), 4 * longest, (4 * used).tolist()
        for k, (unit, odd) in enumerate(zip(units, strange.tolist())):
            self[unit] = self.table.trace(unit, len(unit)) if odd else raw[k * width + starts[k]:(k + 1) * width]

    def __missing__(self, unit: str) -> bytes:
        ids = self.table.trace(unit, len(unit))
        if len(unit) <= MEMO_CHARS:
            if len(self) >= MEMO:
                self.clear()
            self[unit] = ids
        return ids

    def stretch(self, text: str, beyond: int = 0) -> np.ndarray:
        """Ids of a text whose last ``beyond`` characters no piece may start in."""
        units = self.table.units(text)
        if not beyond:
            return np.frombuffer(b"".join(map(self.__getitem__, units)), np.int32)
        last = self.table.trace(units[-1], len(units[-1]) - beyond)
        return np.frombuffer(b"".join(map(self.__getitem__, units[:-1])) + last, np.int32)

    def matrix(self, text: str, ahead: str, units: list[str] | None = None) -> np.ndarray:
        """Transfer matrix of a chunk that ``ahead`` follows; ``units`` are the chunk's, if they are known."""
        t, size = self.table, len(text)
        out = np.full((t.longest, t.longest), NONE)
        units = units or t.units(text)
        head = units[0]
        if len(units) == 1:
            for i in range(t.longest):
                if i < size:
                    reached = t.paths(text + ahead, size, i)[0][size:size + t.longest]
                    out[i, :len(reached)] = reached
                elif i - size <= len(ahead):
                    out[i, i - size] = 0.0  # the piece from before covers the whole chunk
            return out
        into = np.array([t.paths(head, len(head), i)[0][-1] if i <= len(head) else NONE for i in range(t.longest)])
        middle = t.scores[np.frombuffer(b"".join(map(self.__getitem__, units[1:-1])), np.int32)].sum() if len(units) > 2 else 0.0
        reached = t.paths(units[-1] + ahead, len(units[-1]))[0][len(units[-1]):][:t.longest]
        out[:, :len(reached)] = into[:, None] + middle + np.array(reached)[None]
        return out


def _chunks(documents: DataFrame, size: int, longest: int) -> DataFrame:
    """The chunks of long texts, each with the ``longest`` characters after it, as far as a piece may reach; ``row`` tells rows
    apart, also those of one id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches_of(batches, 8 << 20):
            out = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                text = marked(text)
                n = -(-len(text) // size)
                out += [(row, doc, n, k, text[k * size:(k + 1) * size], text[(k + 1) * size:(k + 1) * size + longest]) for k in range(n)]
                row += 1
            yield _batch(out, CHUNKS)

    return documents.mapInArrow(tidied(run), CHUNKS)


_KINDS = {"BIGINT": pa.int64(), "INT": pa.int32(), "STRING": pa.string(), "DOUBLE": pa.float64(), "BINARY": pa.binary(), "ARRAY<DOUBLE>": pa.list_(pa.float64())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split(" ") for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], _KINDS[k]) for i, (_, k) in enumerate(fields)], names=[n for n, _ in fields])


def _matrices(chunks: DataFrame, path: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Pieces(path))
        for batch in batches_of(batches, 4 << 20):
            split = [encoder.table.units(t) for t in batch.column("text").to_pylist()]
            encoder.learn(split)
            rows = [(r["row"], r["chunk"], encoder.matrix(r["text"], r["ahead"], u).tobytes()) for r, u in zip(batch.to_pylist(), split)]
            yield _batch(rows, "row BIGINT, node INT, matrix BINARY")

    return chunks.mapInArrow(tidied(run), "row BIGINT, node INT, matrix BINARY")


def _square(raw: bytes) -> np.ndarray:
    flat = np.frombuffer(raw)
    side = int(len(flat) ** 0.5)
    return flat.reshape(side, side)


def _combined(group: pa.Table) -> pa.Table:
    """The product of neighbouring matrices."""
    rows = sorted(group.to_pylist(), key=lambda r: r["node"])
    out = _square(rows[0]["matrix"])
    for r in rows[1:]:
        out = (out[:, :, None] + _square(r["matrix"])[None]).max(axis=1)
    return pa.Table.from_batches([_batch([(rows[0]["row"], rows[0]["parent"], out.tobytes())], "row BIGINT, node INT, matrix BINARY")])


STATES = "row BIGINT, node INT, entry ARRAY<DOUBLE>, into INT, out INT"


def _descended(group: pa.Table) -> pa.Table:
    """Entry scores and both states of each node below one whose own are known."""
    rows = sorted(group.to_pylist(), key=lambda r: r["node"])
    entry = np.array(rows[0]["entry"])
    entries = []
    for r in rows:
        entries.append(entry)
        entry = (entry[:, None] + _square(r["matrix"])).max(axis=0)
    state, done = rows[0]["out"], []
    for r, entry in zip(rows[::-1], entries[::-1]):
        before = int((entry + _square(r["matrix"])[:, state]).argmax())
        done.append((r["row"], r["node"], entry.tolist(), before, state))
        state = before
    return pa.Table.from_batches([_batch(done, STATES)])


def cut_states(matrices: DataFrame, longest: int, most: int) -> DataFrame:
    """(row, node, into, out): the states at both ends of every chunk on a best path; ``most`` is the last chunk's number."""
    spark = matrices.sparkSession
    levels = [matrices]
    while True:
        path = scratch(spark, "scan-level")
        levels[-1].withColumn("parent", F.floor(F.col("node") / FAN).cast("int")).write.parquet(path)
        levels[-1] = spark.read.parquet(path)
        most //= FAN
        if not most:
            break
        levels.append(levels[-1].groupBy("row", "parent").applyInArrow(_combined, "row BIGINT, node INT, matrix BINARY"))
    start = F.array(F.lit(0.0), *[F.lit(float("-inf"))] * (longest - 1))
    known = levels[-1].select("row").distinct().select("row", F.lit(0).alias("node"), start.alias("entry"), F.lit(0).alias("out"))
    for level in levels[::-1]:
        above = known.select("row", F.col("node").alias("parent"), "entry", "out")
        known = level.join(above, ["row", "parent"]).groupBy("row", "parent").applyInArrow(_descended, STATES)
    return known.select("row", "node", "into", "out")


def _encoded_batch(rows: list[tuple], table: Pieces) -> pa.RecordBatch:
    """Rows (row, doc_id, chunks, chunk, ids) with their scores."""
    ids = [r[4] for r in rows]
    columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32()))]
    scores = [float(table.scores[i].sum()) for i in ids]
    return pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.float64()), lists(ids, pa.int32())], names=["row", "doc_id", "chunks", "chunk", "score", "ids"])


def encoded(documents: DataFrame, model: str, chunk: int = CHUNK) -> DataFrame:
    """Ids of each row's text, a row per chunk: ``row`` (one number for each text of several chunks),
    ``doc_id``, ``chunks``, ``chunk``, ``score``, ``ids``, and ``whole``: whether it is all of a text.

    Null and empty texts have one chunk without ids. Repeated rows and null ids are encoded like any
    other. Other columns are not read. ``model`` is the path of a model file that every executor has.
    """
    spark = documents.sparkSession
    longest = Pieces(model).longest
    rows = documents.select(F.col("doc_id").cast("long"), "text")
    long_ = F.coalesce(F.length("text") >= chunk, F.lit(False))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Pieces(model))
        for batch in batches_of(batches, 4 << 20):
            ids = encoder.texts([marked(text) for text in batch.column("text").to_pylist()])
            yield _encoded_batch([(-1, doc, 1, 0, i) for doc, i in zip(batch.column("doc_id").to_pylist(), ids)], encoder.table)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Pieces(model))
        for batch in batches_of(batches, 4 << 20):
            rows = batch.to_pylist()
            # A piece from before may cover a whole chunk, which then has none of its own.
            inside = [r["into"] < len(r["text"]) for r in rows]
            found = [r["text"][r["into"]:] + r["ahead"][:r["out"]] if x else "" for r, x in zip(rows, inside)]
            ids = encoder.texts(found, [r["out"] if x else 0 for r, x in zip(rows, inside)])
            yield _encoded_batch([(r["row"], r["doc_id"], r["chunks"], r["chunk"], i) for r, i in zip(rows, ids)], encoder.table)

    path = scratch(spark, "scan-chunks")
    _chunks(rows.where(long_), chunk, longest).write.parquet(path)
    chunks = spark.read.parquet(path)
    last = chunks.agg(F.max("chunk")).first()[0] or 0
    states = cut_states(_matrices(chunks, model), longest, last).withColumnRenamed("node", "chunk")
    # ``whole`` is a constant of each side, so a reader of one side does not run the other.
    return rows.where(~long_).mapInArrow(tidied(whole), ENCODED).withColumn("whole", F.lit(True)).unionByName(
        chunks.join(states, ["row", "chunk"]).mapInArrow(tidied(part), ENCODED).withColumn("whole", F.lit(False)))


def joined_pieces(ids: pa.ListArray, pieces: pa.LargeBinaryArray) -> tuple[pa.Array, pa.Array]:
    """The pieces of each row one after the other, and their number; a null row has none."""
    counts = pc.fill_null(pc.list_value_length(ids), 0).cast(pa.int64())
    flat = ids.flatten()
    sizes = pc.binary_length(pieces).to_numpy()[flat.to_numpy()]
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts.to_numpy())])]
    raw = pieces.take(flat).buffers()[2] or pa.py_buffer(b"")
    parts = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(ends.astype(np.int64)), raw])
    return parts.cast(pa.binary()), counts


def decoded(encodings: DataFrame, model: str) -> DataFrame:
    """(doc_id, text, n_pieces, chunks, score) per text that :func:`encoded` has encoded.

    A text of one chunk is decoded where it is; the chunks of longer ones meet by ``row``.
    """
    schema = "row BIGINT, doc_id BIGINT, chunks INT, chunk INT, score DOUBLE, n_pieces BIGINT, part BINARY"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pa.array(Pieces(model).bytes, pa.large_binary())
        for batch in batches_of(batches, 4 << 20):
            parts, counts = joined_pieces(batch.column("ids"), pieces)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row", "doc_id", "chunks", "chunk", "score")), counts, parts],
                names=["row", "doc_id", "chunks", "chunk", "score", "n_pieces", "part"])

    text = F.decode(F.col("part"), "UTF-8")
    alone = encodings.where("whole").select(*COLUMNS).mapInArrow(tidied(run), schema).select("doc_id", text.alias("text"), "n_pieces", "chunks", "score")
    ordered = F.sort_array(F.collect_list(F.struct("chunk", "part")))["part"]
    parts = encodings.where("NOT whole").select(*COLUMNS).mapInArrow(tidied(run), schema)
    joined = parts.groupBy("row", "doc_id").agg(
        ordered.alias("parts"), F.sum("n_pieces").alias("n_pieces"), F.max("chunks").alias("chunks"), F.sum("score").alias("score"))
    joined = joined.select("doc_id", F.decode(F.aggregate("parts", F.lit(b""), lambda a, b: F.concat(a, b)), "UTF-8").alias("text"), "n_pieces", "chunks", "score")
    # The space before a text is no part of it.
    return alone.unionByName(joined).withColumn("text", F.substring("text", 2, 2 ** 31 - 1))

"""Toxicity: a small convolutional text classifier, trained here in numpy.

A word is embedded by two hashes, of the whole word and of its first five bytes, so that forms
of one stem share a part. Filters over one, two and three neighbouring words are maximised over
the whole text, and a logistic layer gives a logit; Platt scaling on a fold that training has not
seen turns it into a probability at the labels' own class balance. On the same fold a threshold
is chosen for each language. A language never enters a score, only the decision.

The model is fitted on every labelled text, whole. Tasks turn the texts into table rows of their words; these lie in
at most ``Fit.shards`` partitions. In a round each partition trains its own copy of the model on its rows, in chunks of
``CHUNK`` words; what the copies have learned is averaged, for a table row over those that moved it, in ``SLICES``
slices, of which only the sums (the size of the model) reach the driver. Calibration counts the logits of the whole fold
in steps of 1 / ``STEPS``. Scoring reads every text whole, in blocks of words, in tasks that hold only the fixed tables
and one batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import batches_of, texts, tidied, words

BUCKETS = 1 << 18
DIM = 4  # per hash; an embedding has two parts
STEM = 5
WIDTHS = (1, 2, 3)
FILTERS = 8  # per width
TAPS = sum(WIDTHS)
POOLED = len(WIDTHS) * FILTERS
BLOCK = 1 << 15  # words convolved at a time
MEMO = 60_000  # words whose projections a task remembers, before it starts anew
CHUNK = 4_000_000  # words of training rows that a task holds and shuffles
SLICES = 16  # of what is averaged
STEPS = 1000  # of a logit, in calibration
MOST = 30  # a logit's size
MOST_BROADCAST = 1 << 20  # labels; more are joined by shuffle
PAD = max(WIDTHS) - 1  # empty words after a text, so that any text has a window
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())


@dataclass(frozen=True)
class Fit:
    """Settings of the training."""

    shard: int = 6000  # rows that a copy of the model has at least, if there are so many
    shards: int = 32
    epochs: int = 6  # for a shard of that size; larger ones are gone over less often, twice at least
    steps: int = 600  # at least; a small table is gone over more often
    batch: int = 64
    rate: float = 0.15
    calibration: int = 5  # one row in so many is kept for calibration
    language_rows: int = 30  # fewer rows of a class in a language leave it the common threshold
    seed: int = 7

    def passes(self, rows: int) -> int:
        """How often to go over the rows of a shard."""
        if rows > self.shard:
            return max(2, -(-self.epochs * self.shard // rows))
        return max(self.epochs, -(-self.steps * self.batch // max(1, rows)))


@dataclass
class Model:
    whole: np.ndarray
    stem: np.ndarray
    taps: np.ndarray  # embedding x (tap, filter)
    bias: np.ndarray
    out: np.ndarray
    shift: float
    scale: tuple[float, float] = (1.0, 0.0)
    threshold: float = 0.5
    by_language: dict[str, float] = field(default_factory=dict)

    def probability(self, logits: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * logits + b, -30, 30)))


def buckets(word: bytes) -> tuple[int, int]:
    """The two table rows of a lower-cased word, without the marks around it."""
    bare = word.strip(_MARKS)
    return xxhash.xxh3_64_intdigest(bare) % BUCKETS, xxhash.xxh3_64_intdigest(bare[:STEM], 1) % BUCKETS


def _convolved(projected: np.ndarray) -> Iterator[np.ndarray]:
    """Filter values at each place, for each width; ``projected`` has taps x filters per word."""
    at = 0
    for width in WIDTHS:
        out = projected[:, at * FILTERS:(at + 1) * FILTERS].copy()
        for k in range(1, width):
            tap = slice((at + k) * FILTERS, (at + k + 1) * FILTERS)
            out[:-k] += projected[k:, tap]
        at += width
        yield out


class Scorer:
    """Logits of whole texts."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.rows: dict[bytes, int] = {}
        self.used = 0
        # Room for the words of one more block; pages that no word fills are never touched.
        self.table = np.zeros((MEMO + 2 * BLOCK + 1024, TAPS * FILTERS), np.float32)
        self._learn([b""])

    def _learn(self, fresh: list[bytes]) -> None:
        """Give words a row each: their embedding, seen through every tap of every filter."""
        pairs = np.array([buckets(w) for w in fresh])
        embedded = np.concatenate([self.model.whole[pairs[:, 0]], self.model.stem[pairs[:, 1]]], axis=1)
        end = self.used + len(fresh)
        self.table[self.used:end] = embedded @ self.model.taps
        self.rows.update(zip(fresh, range(self.used, end)))
        self.used = end

    def _block(self, parts: list[list[bytes]], windows: list[int]) -> np.ndarray:
        """Largest filter values of some runs of words, over the windows at each run's first places."""
        if self.used > MEMO:
            self._forget()
        ends = [b""] * PAD
        joined = [w for part in parts for w in (*part, *ends)] if len(parts) > 1 else [*parts[0], *ends]
        fresh = list(set(joined) - self.rows.keys())
        if fresh:
            self._learn(fresh)
        projected = self.table[np.fromiter(map(self.rows.__getitem__, joined), np.int64, len(joined))]
        lengths = np.array([len(p) for p in parts])
        starts = np.cumsum(lengths + PAD) - lengths - PAD
        spans = np.stack([starts, starts + windows], axis=1).ravel()
        return np.concatenate([np.maximum.reduceat(c, spans, axis=0)[::2] for c in _convolved(projected)], axis=1)

    def logits(self, found: list[bytes | None]) -> np.ndarray:
        """Texts are convolved in blocks of words; a long text spans blocks that overlap by a window."""
        pooled = np.full((len(found), POOLED), -np.inf, np.float32)
        waiting: list[tuple[int, list[bytes], int]] = []
        size = 0

        def flush() -> None:
            nonlocal size
            if waiting:
                best = self._block([p for _, p, _ in waiting], [n for _, _, n in waiting])
                np.maximum.at(pooled, [i for i, _, _ in waiting], best)
                waiting.clear()
                size = 0

        for i, text in enumerate(found):
            all_words = words(text) or [b""]
            for at in range(0, len(all_words), BLOCK):
                part = all_words[at:at + BLOCK + PAD]
                waiting.append((i, part, min(BLOCK, len(all_words) - at)))
                size += len(part) + PAD
                if size >= BLOCK:
                    flush()
        flush()
        return np.maximum(pooled + self.model.bias, 0) @ self.model.out + self.model.shift


def _weights(labels: np.ndarray, rows: np.ndarray, share: float) -> np.ndarray:
    """Weights of groups of rows that give them the class balance of all labels."""
    own = np.average(labels, weights=rows)
    return rows * np.where(labels == 1, share / max(own, 1e-9), (1 - share) / max(1 - own, 1e-9))


def _platt(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * logits + b, -30, 30)))
        g = weights * (p - labels)
        h = weights * p * (1 - p) + 1e-9
        grad = np.array([(g * logits).sum() + 0.02 * (a - 1), g.sum() + 0.02 * b])
        hess = np.array([[(h * logits * logits).sum() + 0.02, (h * logits).sum()], [(h * logits).sum(), h.sum() + 0.02]])
        step = np.linalg.solve(hess, grad)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
    return max(a, 0.05), b


def _best_threshold(p: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The middle of the cut with the least weighted error; of equal cuts the widest."""
    order = np.argsort(p)
    p, labels, weights = p[order], labels[order], weights[order]
    missed = np.concatenate([[0], np.cumsum(weights * labels)])
    false = np.concatenate([(weights * (1 - labels))[::-1].cumsum()[::-1], [0]])
    edges = np.concatenate([[0], p, [1]])
    gaps = edges[1:] - edges[:-1]
    cost = missed + false
    best = np.lexsort((-gaps, np.round(cost, 9)))[0]
    return float(np.clip((edges[best] + edges[best + 1]) / 2, 0.02, 0.98))


def encoded(text: bytes | None, memo: dict[bytes, tuple[int, int]]) -> np.ndarray:
    """The two rows of each word of a text, and of the empty words after it, in one table: whole words, then stems."""
    pairs = []
    for word in [*(words(text) or [b""]), *[b""] * PAD]:
        if word not in memo:
            whole, stem = buckets(word)
            memo[word] = whole, BUCKETS + stem
        pairs.append(memo[word])
    return np.array(pairs, np.int32)


class Copy:
    """A copy of the model in training, with the squares of its gradients."""

    def __init__(self, table: np.ndarray, dense: np.ndarray, squares: np.ndarray, dense_squares: np.ndarray) -> None:
        self.table, self.dense, self.squares, self.dense_squares = table, dense, squares, dense_squares

    @classmethod
    def new(cls, fit: Fit) -> Copy:
        rng = np.random.default_rng(fit.seed)
        table = rng.normal(0, 0.05, (2 * BUCKETS, DIM)).astype(np.float32)
        taps = rng.normal(0, 0.3, 2 * DIM * TAPS * FILTERS)
        out = np.where(np.arange(POOLED) % 2, -0.3, 0.3)
        dense = np.concatenate([taps, np.zeros(POOLED), out, [0.0]]).astype(np.float32)
        return cls(table, dense, np.full_like(table, 1e-3), np.full_like(dense, 1e-3))

    def copied(self) -> Copy:
        return Copy(*[x.copy() for x in (self.table, self.dense, self.squares, self.dense_squares)])

    def parts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Taps, bias, output weights and shift, as views."""
        taps, bias, out, shift = np.split(self.dense, np.cumsum([2 * DIM * TAPS * FILTERS, POOLED, POOLED]))
        return taps.reshape(2 * DIM, TAPS * FILTERS), bias, out, shift

    def tops(self, texts_: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Largest value of each filter over each text and the place of its window, found in blocks of words."""
        taps = self.parts()[0]
        pooled, places = np.full((len(texts_), POOLED), -np.inf, np.float32), np.zeros((len(texts_), POOLED), np.int64)
        waiting: list[tuple[int, int, np.ndarray]] = []
        size = 0
        for i, text in enumerate(texts_):
            for at in range(0, len(text) - PAD, BLOCK):
                waiting.append((i, at, text[at:at + BLOCK + PAD]))
                size += len(waiting[-1][2])
                if size >= BLOCK:
                    self._block(taps, waiting, pooled, places)
                    waiting, size = [], 0
        if waiting:
            self._block(taps, waiting, pooled, places)
        return pooled, places

    def _block(self, taps: np.ndarray, parts: list[tuple[int, int, np.ndarray]], pooled: np.ndarray, places: np.ndarray) -> None:
        flat = np.concatenate([p for _, _, p in parts])
        values = np.concatenate(list(_convolved(self.table[flat].reshape(len(flat), 2 * DIM) @ taps)), axis=1)
        start, each = 0, np.arange(POOLED)
        for i, at, part in parts:
            own = values[start:start + len(part) - PAD]
            best = own.argmax(axis=0)
            top = own[best, each]
            more = top > pooled[i]
            pooled[i, more], places[i, more] = top[more], at + best[more]
            start += len(part)

    def logits(self, texts_: list[np.ndarray]) -> np.ndarray:
        _, bias, out, shift = self.parts()
        return np.maximum(self.tops(texts_)[0] + bias, 0) @ out + shift

    def step(self, texts_: list[np.ndarray], labels: np.ndarray, rate: float) -> None:
        """One step of Adagrad on a batch."""
        taps, bias, out, shift = self.parts()
        pooled, places = self.tops(texts_)
        active = np.maximum(pooled + bias, 0)
        p = 1 / (1 + np.exp(-np.clip(active @ out + shift, -30, 30)))
        g = ((p - labels) / len(labels)).astype(np.float32)
        g_pool = g[:, None] * out * (active > 0)
        g_taps, rows, grads, at = np.zeros_like(taps), [], [], 0
        for i, width in enumerate(WIDTHS):
            span = slice(i * FILTERS, (i + 1) * FILTERS)
            for k in range(width):
                cols = slice((at + k) * FILTERS, (at + k + 1) * FILTERS)
                hit = np.stack([t[pl + k] for t, pl in zip(texts_, places[:, span])])  # texts x filters x 2 rows
                g_taps[:, cols] = np.einsum("df,dfe->ef", g_pool[:, span], self.table[hit].reshape(*hit.shape[:2], 2 * DIM))
                rows.append(hit.ravel())
                grads.append((g_pool[:, span][:, :, None] * taps[:, cols].T[None]).reshape(-1, DIM))
            at += width
        ids, back = np.unique(np.concatenate(rows), return_inverse=True)
        grad = np.zeros((len(ids), DIM), np.float32)
        np.add.at(grad, back, np.concatenate(grads))
        self.squares[ids] += grad * grad
        self.table[ids] -= rate * grad / np.sqrt(self.squares[ids])
        dense = np.concatenate([g_taps.ravel(), g_pool.sum(axis=0), active.T @ g, [g.sum()]]).astype(np.float32)
        self.dense_squares += dense * dense
        self.dense -= rate / 3 * dense / np.sqrt(self.dense_squares)

    def learn(self, rows: list[tuple[np.ndarray, int]], passes: int, fit: Fit, rng: np.random.Generator) -> None:
        order = np.arange(len(rows))
        for _ in range(passes):
            rng.shuffle(order)
            for start in range(0, len(order), fit.batch):
                ids = order[start:start + fit.batch]
                self.step([rows[i][0] for i in ids], np.array([rows[i][1] for i in ids], np.float32), fit.rate)

    def model(self, seen: np.ndarray) -> Model:
        """Words never seen say nothing."""
        taps, bias, out, shift = self.parts()
        table = np.where(seen[:, None], self.table, np.float32(0))
        return Model(table[:BUCKETS], table[BUCKETS:], taps.copy(), bias.copy(), out.copy(), float(shift[0]))


def _constant(p: float) -> Model:
    """A model that has nothing to learn from."""
    p = float(np.clip(p, 0.001, 0.999))
    none = np.zeros((BUCKETS, DIM), np.float32)
    return Model(none, none, np.zeros((2 * DIM, TAPS * FILTERS), np.float32), np.zeros(POOLED, np.float32), np.zeros(POOLED, np.float32), 0.0,
                 (0.0, float(np.log(p / (1 - p)))))


def calibrate(model: Model, logits: np.ndarray, labels: np.ndarray, languages: np.ndarray, rows: np.ndarray, share: float, fit: Fit) -> None:
    """Set scale and thresholds from groups of ``rows`` rows each."""
    weights = _weights(labels, rows, share)
    model.scale = _platt(logits, labels, weights)
    p = model.probability(logits)
    model.threshold = _best_threshold(p, labels, weights)
    for lang in sorted(set(languages) - {""}):
        own = languages == lang
        if min(rows[own & (labels == 1)].sum(), rows[own & (labels == 0)].sum()) >= fit.language_rows:
            model.by_language[str(lang)] = _best_threshold(p[own], labels[own], weights[own])


def train(rows: list[tuple[bytes | None, int, str | None]], share: float, fit: Fit = Fit()) -> Model:
    """Fit on (text, label, language) rows held here, as one shard; ``share`` is the share of label 1 among all labels."""
    labels = np.array([r[1] for r in rows], np.float64)
    if len(set(labels)) < 2:  # the plain share of the one class
        return _constant(labels.mean() if len(labels) else share)
    memo: dict[bytes, tuple[int, int]] = {}
    texts_ = [encoded(r[0], memo) for r in rows]
    held = np.arange(len(rows)) % fit.calibration == 0
    if len(set(labels[~held])) < 2 or len(set(labels[held])) < 2:
        held[:] = False
    copy, seen = Copy.new(fit), np.zeros(2 * BUCKETS, bool)
    own = [(texts_[i], rows[i][1]) for i in np.flatnonzero(~held)]
    for text, _ in own:
        seen[text] = True
    copy.learn(own, fit.passes(len(own)), fit, np.random.default_rng(fit.seed))
    model = copy.model(seen)
    check = np.flatnonzero(held) if held.any() else np.arange(len(rows))
    copy.table[~seen] = 0
    languages = np.array([rows[i][2] or "" for i in check])
    calibrate(model, copy.logits([texts_[i] for i in check]), labels[check], languages, np.ones(len(check)), share, fit)
    return model


ROWS = "doc_id BIGINT, label INT, lang STRING, n BIGINT, ids BINARY"
MOVED = "slice INT, rows BINARY, moved BINARY"
MOVES = 2 * DIM  # what a table row has moved by, and its squares


def _encoded_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer, memo = zstandard.ZstdCompressor(1), {}
    for batch in batches_of(batches, 8 << 20):
        if len(memo) > MEMO:
            memo.clear()
        ids = [encoded(t, memo) for t in texts(batch)]
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id").cast(pa.int64()), batch.column("label").cast(pa.int32()), batch.column("lang").cast(pa.string()),
            pa.array([len(x) for x in ids], pa.int64()), pa.array([packer.compress(x.tobytes()) for x in ids], pa.binary())],
            names=["doc_id", "label", "lang", "n", "ids"])


def _unpacked(ids: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(ids), np.int32).reshape(-1, 2)


def _slices(rows: np.ndarray, moved: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    of = rows % SLICES
    for n in range(SLICES):
        yield n, rows[of == n].tobytes(), moved[of == n].tobytes()


def _moved_batch(rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["slice", "rows", "moved"])


def _averaged(key: tuple, group: pa.Table) -> pa.Table:
    """What the copies moved: a table row by the mean of those that moved it, the dense part by the mean of all; seen rows as they are."""
    slice_ = key[0].as_py()
    parts = [(np.frombuffer(r, np.int32), np.frombuffer(m, np.float32)) for r, m in
             sorted(zip(group.column("rows").to_pylist(), group.column("moved").to_pylist()))]
    if slice_ == SLICES:
        out = np.empty(0, np.int32), np.mean([m for _, m in parts], axis=0, dtype=np.float64)
    elif slice_ > SLICES:
        out = np.unique(np.concatenate([r for r, _ in parts])), np.empty(0)
    else:
        rows, back, copies = np.unique(np.concatenate([r for r, _ in parts]), return_inverse=True, return_counts=True)
        total = np.zeros((len(rows), MOVES))
        np.add.at(total, back, np.concatenate([m.reshape(-1, MOVES) for _, m in parts]))
        out = rows, total / copies[:, None]
    return pa.Table.from_batches([_moved_batch([(slice_, out[0].astype(np.int32).tobytes(), out[1].astype(np.float32).tobytes())])])


def _round(learned: DataFrame, copy: Copy, seen: np.ndarray, number: int, passes: int, fit: Fit) -> None:
    """Train a copy in each partition and move ``copy`` by what they learned."""
    shipped = learned.sparkSession.sparkContext.broadcast(copy)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, rows, held, any_ = shipped.value, [], 0, False
        own, met = start.copied(), np.zeros(2 * BUCKETS, bool)
        rng = np.random.default_rng([fit.seed, number, TaskContext.get().partitionId()])
        for batch in batches:
            for label, ids in zip(batch.column("label").to_pylist(), batch.column("ids")):
                rows.append((_unpacked(ids.as_py()), label))
                held, any_ = held + len(rows[-1][0]), True
                met[rows[-1][0]] = True
                if held >= CHUNK:
                    own.learn(rows, passes, fit, rng)
                    rows, held = [], 0
        if not any_:
            return
        own.learn(rows, passes, fit, rng)
        hit = np.flatnonzero((own.squares != start.squares).any(axis=1)).astype(np.int32)
        moved = np.concatenate([own.table[hit] - start.table[hit], own.squares[hit] - start.squares[hit]], axis=1)
        out = list(_slices(hit, moved))
        out.append((SLICES, b"", np.concatenate([own.dense - start.dense, own.dense_squares - start.dense_squares]).tobytes()))
        if number == 0:
            out.append((SLICES + 1, np.flatnonzero(met).astype(np.int32).tobytes(), b""))
        yield _moved_batch(out)

    for r in learned.mapInArrow(tidied(run), MOVED).groupBy("slice").applyInArrow(_averaged, MOVED).collect():
        rows, moved = np.frombuffer(r["rows"], np.int32), np.frombuffer(r["moved"], np.float32)
        if r["slice"] == SLICES:
            copy.dense += moved[:len(copy.dense)]
            copy.dense_squares += moved[len(copy.dense):]
        elif r["slice"] > SLICES:
            seen[rows] = True
        else:
            both = moved.reshape(-1, MOVES)
            copy.table[rows] += both[:, :DIM]
            copy.squares[rows] += both[:, DIM:]
    shipped.destroy()


def _counted_logits(rows: DataFrame, copy: Copy) -> DataFrame:
    """Numbers of rows by language, label and logit."""
    shipped = rows.sparkSession.sparkContext.broadcast(copy)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logits = [float(shipped.value.logits([_unpacked(x.as_py())])[0]) for x in batch.column("ids")]
            steps = np.round(np.clip(logits, -MOST, MOST) * STEPS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("lang"), pa.array(steps)], names=["label", "lang", "step"])

    found = rows.select("label", "lang", "ids").mapInArrow(tidied(run), "label INT, lang STRING, step INT")
    return found.groupBy("label", "lang", "step").agg(F.count(F.lit(1)).alias("rows"))


def fitted(documents: DataFrame, labels: DataFrame, fold: F.Column, fit: Fit = Fit()) -> Model:
    """Train on all labelled documents whose ``fold`` (a condition on ``doc_id``) holds, over their whole texts.

    Null labels and ids, other label values and null texts are left out; repeated labels and documents count once.
    """
    usable = labels.select("doc_id", F.col("toxic").cast("int").alias("label"))
    usable = usable.where(fold & F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).dropDuplicates(["doc_id"])
    share, n = usable.agg(F.avg("label"), F.count(F.lit(1))).first()
    share, shards = share if share is not None else 0.0, int(min(fit.shards, max(1, n // fit.shard)))
    if n <= MOST_BROADCAST:
        usable = F.broadcast(usable)
    found = documents.select("doc_id", "text", "lang").where("text IS NOT NULL").join(usable, "doc_id")
    # A partition is a shard. Copies of a document in it are next to each other.
    once = found.repartition(shards, "doc_id").groupBy("doc_id").agg(F.min(F.struct("text", "lang", "label")).alias("r"))
    ids = once.select("doc_id", "r.*").sortWithinPartitions(F.xxhash64("doc_id"), "doc_id").mapInArrow(tidied(_encoded_rows), ROWS)
    held = F.pmod(F.xxhash64("doc_id", F.lit(fit.seed)), F.lit(fit.calibration)) == 0
    rows = ids.withColumn("held", held).persist(StorageLevel.DISK_ONLY)
    try:
        groups = rows.groupBy("held", "label").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n")).collect()
        classes = {g["label"] for g in groups}
        if len(classes) < 2:
            return _constant(classes.pop() if classes else share)
        apart = len(groups) == 4
        learned = rows.where(~F.col("held")) if apart else rows
        own = [g for g in groups if not (apart and g["held"])]
        passes = fit.passes(sum(g["rows"] for g in own) // shards)
        rounds = 1 if shards == 1 and sum(g["n"] for g in own) <= CHUNK else min(passes, fit.epochs)
        copy, seen = Copy.new(fit), np.zeros(2 * BUCKETS, bool)
        for number in range(rounds):
            _round(learned.select("label", "ids"), copy, seen, number, -(-passes // rounds), fit)
        model = copy.model(seen)
        copy.table[~seen] = 0
        check = _counted_logits(rows.where("held") if apart else rows, copy).collect()
    finally:
        rows.unpersist()
    calibrate(model, np.array([r["step"] / STEPS for r in check]), np.array([r["label"] for r in check], np.float64),
              np.array([r["lang"] or "" for r in check]), np.array([r["rows"] for r in check], np.float64), share, fit)
    return model


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` with ``score`` and ``toxic`` (score at or above its language's threshold).

    A null or empty text has the score of a text without words. Other columns pass unread; columns
    named like the two new ones are replaced.
    """
    kept = documents.drop("score", "toxic")
    schema = kept.select("*", F.lit(0.0).alias("score"), F.lit(False).alias("toxic")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, p, toxic in _judged(batches, model):
            columns = [*batch.columns, pa.array(p, pa.float64()), pa.array(toxic, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "score", "toxic"])

    return kept.mapInArrow(tidied(run), schema)


def clean(documents: DataFrame, model: Model) -> DataFrame:
    """The rows of ``documents`` below their language's threshold, with all their columns whatever these are called."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, toxic in _judged(batches, model):
            yield batch.filter(pa.array(~toxic))

    return documents.mapInArrow(tidied(run), documents.schema)


def _judged(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches with the probability of each row and whether it is too high."""
    scorer = Scorer(model)
    for batch in batches_of(batches, 8 << 20):
        p = model.probability(scorer.logits(texts(batch)))
        limits = [model.by_language.get(x, model.threshold) for x in batch.column("lang").to_pylist()]
        yield batch, p, p >= np.array(limits)

"""Language-model scores from a hierarchical Pitman-Yor model.

A word is drawn in the restaurant of its context, the word before it (the end of a text, as a word, stands before the
first); every word that occurs has a restaurant of its own. All context restaurants share one parent, whose own
base is even over the training words and one for the unknown. Every customer is a training token;
the tables of a context are customers of the parent. Seatings are sampled by Gibbs: each word's
customers of a restaurant leave and sit down again one by one given all others (from ``SINGLY`` on in
growing blocks), contexts and parent in turn. The predictive probabilities of ``SAMPLES`` seatings are averaged.

How it is spread out:

1. Tasks cut the texts into splits of ``SPLIT`` tokens. A split keeps its tokens as places in its list of words, and
   sends the words, with their counts, to ranges of their hashes.
2. Each range numbers its words, which are words and contexts alike, and answers each split. The number of times a
   word was learned is also the number of customers of its context.
3. Each split sums its (word, context) pairs and sends them to the range of the word. The pairs of a frequent word
   (more than one in ``SHARES`` tokens, so at most that many words) go to the ranges of their contexts.
4. Ranges seat the customers of their pairs, sweep by sweep. Between sweeps each range sends the tables of its pairs,
   summed by context, to the contexts' homes, of one or several ranges, and gets back their sums over all ranges. A pair learned once has
   one table in any seating; such pairs are counted once for all. What the parent shares, and the tables of
   the frequent words, at most ``SHARES`` + 2 numbers, pass the driver. Within a sweep these sums stand still.
5. Each split gets the counts and tables of its pairs and of its words; sums by document follow.

No sum is estimated, and no context stands for another. Sizes: a split is bounded, a range by the number of documents to
a range, a word's pairs by the share of a frequent word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import WordHashes, batches_of, hashed, texts, tidied, tidied_groups, words
from millrace.session import scratch

CONTEXTS = 4096  # of a Range that is not told how many it has
SPLIT = 2_000_000
BLOCK = 1 << 18  # pairs of a split that are scored at a time
SHARES = 4096
LEAST_FREQUENT = 100_000  # tokens of a frequent word
HOMES = 8  # contexts are summed in this many places for each root of the number of ranges
SINGLY = 64
BURN_IN, SAMPLES = 3, 4
DISCOUNT = (0.85, 0.85)  # of contexts and of the parent
STRENGTH = (1.0, 1.0)
ADDED = 0.1  # of the base score
END = np.uint64(0x6E64)  # the end of a text, as a word

# Of a split or range (key), from one (source).
ROWS = "key BIGINT, kind INT, source BIGINT, payload BINARY"
WORDS, TOKENS, RANKS, COUNTS, PAIRS, TWICE, ONCE, SUMS, TABLES, SERVED, SAMPLE, STATS, HOME, ALL, ANSWER = range(15)
SCORES = "row BIGINT, doc_id BIGINT, held_out BOOLEAN, n_tokens BIGINT, n_known BIGINT, base_score DOUBLE, score DOUBLE"


def blob(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value; whole numbers are stored byte plane by byte plane."""
    out = [len(arrays).to_bytes(4, "little")]
    for a in arrays:
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T
        raw = zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)
        out += [a.dtype.str.encode().ljust(4), len(a).to_bytes(8, "little"), len(raw).to_bytes(8, "little"), raw]
    return b"".join(out)


def unblob(raw: bytes) -> list[np.ndarray]:
    out, at = [], 4
    for _ in range(int.from_bytes(raw[:4], "little")):
        kind = np.dtype(raw[at:at + 4].decode().strip())
        n, size = int.from_bytes(raw[at + 4:at + 12], "little"), int.from_bytes(raw[at + 12:at + 20], "little")
        planes = np.frombuffer(zstandard.decompress(raw[at + 20:at + 20 + size]), np.uint8).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += 20 + size
    return out


def counted(*arrays: np.ndarray) -> bytes:
    """:func:`blob` of whole numbers from 0 on, in no more bytes than the largest needs; :func:`read` gives them back."""
    return blob(*[a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0)) for a in arrays])


def read(raw: bytes) -> list[np.ndarray]:
    return [a.astype(np.int64) for a in unblob(raw)]


def by_frequency(places: np.ndarray, n: int) -> list[np.ndarray]:
    """Places below ``n`` as ranks, the commonest first, of which most need two bytes; :func:`from_frequency` gives them back."""
    seen = np.bincount(places, minlength=n)
    rank = np.empty(n, np.uint32)
    rank[np.argsort(-seen, kind="stable")] = np.arange(n, dtype=np.uint32)
    ranks = rank[places]
    short = ranks < 1 << 16
    return [seen.astype(np.uint32), np.packbits(short), ranks[short].astype(np.uint16), ranks[~short]]


def from_frequency(seen: np.ndarray, short: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    ranks = np.empty(len(low) + len(high), np.uint32)
    bits = np.unpackbits(short, count=len(ranks)).astype(bool)
    ranks[bits], ranks[~bits] = low, high
    return np.argsort(-seen.astype(np.int64), kind="stable")[ranks]


def steps(rows: list[np.ndarray]) -> np.ndarray:
    """Rows of equal length as the first and the differences to the row before, all from 0 on; :func:`from_steps` gives them back."""
    d = np.diff(np.stack(rows).astype(np.int64), axis=0, prepend=0)
    return (d << 1 ^ d >> 63).ravel()


def from_steps(flat: np.ndarray, rows: int) -> np.ndarray:
    return np.cumsum((flat >> 1 ^ -(flat & 1)).reshape(rows, -1), axis=0)


def _rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"BIGINT": pa.int64(), "INT": pa.int32(), "BINARY": pa.binary(), "DOUBLE": pa.float64(), "BOOLEAN": pa.bool_()}
    fields = [f.split(" ") for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)], names=[n for n, _ in fields])


def _table(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_batches([_rows(ROWS, rows)])


def _of(table: pa.Table, kind: int) -> list[tuple[int, bytes]]:
    """(source, payload) of the rows of a kind, by source."""
    return sorted((s, p) for k, s, p in zip(*(table.column(c).to_pylist() for c in ("kind", "source", "payload"))) if k == kind)


def _split(number: int, pieces: list[tuple], buckets: int) -> pa.RecordBatch:
    """Rows of one split: its words for each range, and its texts as places of words.

    A piece is (row, doc_id, held out, hashes, hash before them); a text longer than a split has several.
    """
    tokens = np.concatenate([p[3] for p in pieces])
    sizes = np.array([len(p[3]) for p in pieces], np.int64)
    distinct, place = np.unique(np.append(tokens, np.array([p[4] for p in pieces], np.uint64)), return_inverse=True)
    word, before = place[:len(tokens)], place[len(tokens):]
    learned = np.repeat(np.array([not p[2] for p in pieces]), sizes)
    counts = np.bincount(word[learned], minlength=len(distinct))
    bucket = ((distinct >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    ends = np.searchsorted(bucket, np.arange(buckets + 1))
    rows = [(int(b), WORDS, number, blob(distinct[a:z], counts[a:z].astype(np.uint32)))
            for b, a, z in zip(range(buckets), ends, ends[1:]) if a < z]
    ids = np.array([p[1] if p[1] is not None else 0 for p in pieces], np.int64)
    flags = np.array([2 * (p[1] is None) + p[2] for p in pieces], np.uint8)
    rows.append((number, TOKENS, -1, blob(np.array([p[0] for p in pieces], np.int64), ids, flags, sizes, before, *by_frequency(word, len(distinct)))))
    return _rows(ROWS, rows)


def splits(documents: DataFrame, held_out: Column, buckets: int) -> DataFrame:
    """Words and tokens of all splits of the texts, from ``doc_id`` and ``text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        task = TaskContext.get().partitionId() << 40
        row = number = 0
        pieces: list[tuple] = []
        held = 0
        for batch in batches_of(batches, 8 << 20):
            for doc, text, out in zip(batch.column("doc_id").to_pylist(), texts(batch), batch.column("held").to_pylist()):
                h = np.append(hashed(words(text), memo), END)
                for a in range(0, len(h), SPLIT):
                    pieces.append((task + row, doc, out, h[a:a + SPLIT], h[a - 1] if a else END))
                    held += len(pieces[-1][3])
                    if held >= SPLIT:
                        yield _split(task + number, pieces, buckets)
                        pieces, held, number = [], 0, number + 1
                row += 1
        if pieces:
            yield _split(task + number, pieces, buckets)

    return documents.select(F.col("doc_id").cast("long"), "text", held_out.alias("held")).mapInArrow(tidied(run), ROWS)


def numbered(key: tuple, table: pa.Table) -> pa.Table:
    """The place of each split's words among all words of a range, and how often each was learned."""
    asks = [(s, unblob(p)) for s, p in _of(table, WORDS)]
    known, place = np.unique(np.concatenate([w for _, (w, _) in asks]), return_inverse=True)
    counts = np.bincount(place, np.concatenate([c for _, (_, c) in asks]), len(known)).astype(np.int64)
    own = np.split(place, np.cumsum([len(w) for _, (w, _) in asks])[:-1])
    bucket = key[0].as_py()
    return _table([(s, RANKS, bucket, counted(p)) for (s, _), p in zip(asks, own)] + [(bucket, COUNTS, 0, counted(counts))])


class Vocabulary(NamedTuple):
    """Words by number: those of range b begin at ``starts[b]``; the frequent ones, in order; what was learned.

    Tables of contexts are summed in homes of ``width`` ranges each.
    """

    starts: np.ndarray
    frequent: np.ndarray
    tokens: int
    kinds: int
    width: int

    def codes(self, numbers: np.ndarray) -> np.ndarray:
        """The number of each word; frequent words follow after all others."""
        at = np.searchsorted(self.frequent, numbers)
        found = self.frequent[np.minimum(at, len(self.frequent) - 1)] == numbers if len(self.frequent) else np.zeros(len(numbers), bool)
        return np.where(found, self.starts[-1] + at, numbers)

    def is_frequent(self, codes: np.ndarray) -> np.ndarray:
        return codes >= self.starts[-1]

    def size(self, bucket: int) -> int:
        return int(self.starts[bucket + 1] - self.starts[bucket])

    def ranges(self, home: int) -> range:
        return range(home * self.width, min((home + 1) * self.width, len(self.starts) - 1))

    def by_home(self, contexts: np.ndarray) -> list[tuple[int, int, slice]]:
        """The homes of some contexts, in order, with the first number there and which of the contexts are there."""
        firsts = self.starts[:-1:self.width]
        homes, first = np.unique(np.searchsorted(firsts, contexts, side="right") - 1, return_index=True)
        return [(int(h), int(firsts[h]), slice(a, z)) for h, a, z in zip(homes, first, np.append(first[1:], len(contexts)))]


def vocabulary(ranks: DataFrame, buckets: int) -> Vocabulary:
    """From the counts of all ranges; a few numbers a range and at most ``SHARES`` words pass the driver."""
    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, payload in zip(batch.column("key").to_pylist(), batch.column("payload").to_pylist()):
                counts = read(payload)[0]
                yield _rows("key BIGINT, size BIGINT, tokens BIGINT, kinds BIGINT", [(bucket, len(counts), int(counts.sum()), np.count_nonzero(counts))])

    rows = ranks.where(F.col("kind") == COUNTS)
    found = rows.mapInArrow(sizes, "key BIGINT, size BIGINT, tokens BIGINT, kinds BIGINT").collect()
    starts = np.zeros(buckets + 1, np.int64)
    for r in found:
        starts[r["key"] + 1] = r["size"]
    starts, tokens = np.cumsum(starts), sum(r["tokens"] for r in found)
    least = max(tokens // SHARES, LEAST_FREQUENT)

    def most(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, payload in zip(batch.column("key").to_pylist(), batch.column("payload").to_pylist()):
                yield _rows("number BIGINT", [(int(starts[bucket] + r),) for r in np.flatnonzero(read(payload)[0] > least)])

    frequent = np.array(sorted(r[0] for r in rows.mapInArrow(most, "number BIGINT").collect()), np.int64)
    return Vocabulary(starts, frequent, tokens, sum(r["kinds"] for r in found), max(1, int(buckets ** 0.5) // HOMES))


def _pairs(before: np.ndarray, sizes: np.ndarray, word: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The word and context of each distinct pair of a split of ``n`` words, and each token's pair."""
    context = np.empty(len(word), np.int64)
    context[1:] = word[:-1]
    context[np.cumsum(sizes) - sizes] = before
    pair, place = np.unique(word * n + context, return_inverse=True)
    return *np.divmod(pair, n), place


def _dealt(word: np.ndarray, context: np.ndarray, home: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs in the order they are dealt in, and the range of each: that of its word, or of its context if the word is frequent."""
    to = np.where(often[word], home[context], home[word])
    order = np.argsort(2 * to + often[word], kind="stable")
    return order, to[order]


def asked(vocabulary: Vocabulary) -> Callable[[tuple, pa.Table], pa.Table]:
    """What a split asks of each range: its words there, and its pairs dealt there with their learned counts."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        split, ranks = key[0].as_py(), [(b, read(p)[0]) for b, p in _of(table, RANKS)]
        _, _, flags, sizes, before, *token = unblob(_of(table, TOKENS)[0][1])
        numbers = np.concatenate([vocabulary.starts[b] + r for b, r in ranks])
        home = np.repeat([b for b, _ in ranks], [len(r) for _, r in ranks])
        codes = vocabulary.codes(numbers)
        word, context, place = _pairs(before, sizes, from_frequency(*token), len(numbers))
        counts = np.bincount(place[np.repeat(flags % 2 == 0, sizes)], minlength=len(word))
        often = vocabulary.is_frequent(codes)
        order, to = _dealt(word, context, home, often)
        word, context, counts = word[order], numbers[context[order]], counts[order]
        rows, at = [], 0
        for b, own in ranks:
            a, z = np.searchsorted(to, (b, b + 1))
            here, rare = word[a:z], ~often[word[a:z]]
            each = np.bincount(here[rare] - at, minlength=len(own))
            frequent, each_frequent = np.unique(codes[here[~rare]] - vocabulary.starts[-1], return_counts=True)
            first = np.flatnonzero(np.append(True, np.diff(here) != 0)[:z - a])
            gaps = np.diff(context[a:z], prepend=0)  # the contexts of a word rise
            gaps[first] = context[a:z][first]
            rows.append((b, PAIRS, split, counted(own, each, frequent, each_frequent, gaps, counts[a:z])))
            at += len(own)
        return _table(rows)

    return tidied_groups(run)


def seated(customers: np.ndarray, fresh: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables that customers of the same word take when they sit down one after the other.

    ``fresh`` is the weight of a new table. The j-th finds weight j - discount * tables at old ones.
    Beyond ``SINGLY`` they come in blocks of an eighth of those seated.
    """
    order = np.argsort(-customers, kind="stable")
    c, x = customers[order], fresh[order]
    tables = np.minimum(c, 1).astype(np.float64)
    j = 1
    while len(c) and j < c[0]:
        n = np.searchsorted(-c, -j, side="left")  # those with more than j customers
        block = 1 if j < SINGLY else j // 8
        t = tables[:n]
        if block == 1:
            t += rng.random(n) * (x[:n] + j - discount * t) < x[:n]
        else:
            sitting = np.minimum(block, c[:n] - j)
            p = x[:n] / (x[:n] + np.maximum(j + sitting / 2 - discount * t, 1e-9))
            t += rng.binomial(sitting, np.clip(p, 0, 1))
        j += block
    out = np.empty(len(c))
    out[order] = tables
    return out


def in_parent(served: np.ndarray, parent: np.ndarray, customers: float, taken: float, kinds: float) -> np.ndarray:
    """Probability of words in the parent, from their customers and tables there and those of all words."""
    return (served - DISCOUNT[1] * parent + (STRENGTH[1] + DISCOUNT[1] * taken) / (kinds + 1)) / (STRENGTH[1] + customers)


def in_context(counts: np.ndarray, tables: np.ndarray, customers: np.ndarray, seats: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Probability of words in contexts, from a pair's customers and tables, its context's, and the word's in the parent."""
    return (counts - DISCOUNT[0] * tables + (STRENGTH[0] + DISCOUNT[0] * seats) * word) / (STRENGTH[0] + customers)


def parent_seated(served: np.ndarray, customers: float, taken: float, kinds: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """New tables of words in the parent, and the words' probabilities there."""
    fresh = (STRENGTH[1] + DISCOUNT[1] * taken) / (kinds + 1)
    parent = seated(served.astype(np.int64), np.full(len(served), fresh), DISCOUNT[1], rng)
    return parent, in_parent(served, parent, customers, taken, kinds)


class Range:
    """All pairs of the words in one range, and, if it is the only one, samples of their seatings."""

    def __init__(self, asks: list[list[np.ndarray]], bucket: int, buckets: int, contexts: int = CONTEXTS) -> None:
        self.buckets, self.contexts = buckets, contexts
        self.rng = np.random.default_rng(bucket)
        self.words = np.unique(np.concatenate([a[0] for a in asks]))
        codes = [np.repeat(np.searchsorted(self.words, a[0]), a[1]) * contexts + a[2] for a in asks]
        self.pairs, place = np.unique(np.concatenate(codes), return_inverse=True)
        self.places = np.split(place, np.cumsum([len(c) for c in codes])[:-1])
        self.counts = np.bincount(place, np.concatenate([a[3] for a in asks]), len(self.pairs)).astype(np.int64)
        self.owner, self.context = np.divmod(self.pairs, contexts)
        self.per_word = np.bincount(self.owner, self.counts, len(self.words)).astype(np.int64)
        self.learned = np.flatnonzero(self.counts)

    def sums(self, tables: np.ndarray, parent: np.ndarray) -> np.ndarray:
        """[context or parent, (customers, tables, tokens, words)]; tokens and words are the parent's."""
        out = np.zeros((self.contexts + 1, 4), np.int64)
        out[:-1, 0] = np.bincount(self.context, self.counts, self.contexts)
        out[:-1, 1] = np.bincount(self.context, tables, self.contexts)
        out[-1] = tables.sum(), parent.sum(), self.per_word.sum(), np.count_nonzero(self.per_word)
        return out

    def seatings(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(tables of each pair, tables of each word in the parent) before the first sweep and after each."""
        if self.buckets > 1:
            raise ValueError("the sums of one range are not those of all")
        c, owner, context = self.counts[self.learned], self.owner[self.learned], self.context[self.learned]
        spread = np.minimum(self.counts, 1).astype(np.float64)
        served = np.bincount(self.owner, spread, len(self.words))
        parent = np.minimum(served, 1)
        yield spread, parent
        for _ in range(BURN_IN + SAMPLES):
            total = self.sums(spread, parent)
            customers, taken, _, kinds = total[-1]
            parent, p = parent_seated(served, customers, taken, kinds, self.rng)
            spread = np.zeros(len(self.pairs))
            spread[self.learned] = seated(c, (STRENGTH[0] + DISCOUNT[0] * total[context, 1]) * p[owner], DISCOUNT[0], self.rng)
            served = np.bincount(self.owner, spread, len(self.words))
            parent = np.minimum(parent, served)
            yield spread, parent

    def samples(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The seatings that count."""
        return islice(self.seatings(), BURN_IN + 1, None)


def predicted(own: Range, totals: Sequence[np.ndarray]) -> np.ndarray:
    """Average over samples of the probability of each pair's word in its context; ``totals`` are the sums after each sample."""
    mean = np.zeros(len(own.pairs))
    for (tables, parent), total in zip(own.samples(), totals):
        customers, taken, _, kinds = total[-1]
        word = in_parent(np.bincount(own.owner, tables, len(own.words)), parent, customers, taken, kinds)
        mean += in_context(own.counts, tables, total[own.context, 0], total[own.context, 1], word[own.owner])
    return mean / SAMPLES


def _range(vocabulary: Vocabulary, table: pa.Table, bucket: int, buckets: int) -> tuple[list[int], list[np.ndarray], np.ndarray, Range]:
    """The splits that ask a range, their words there, all contexts of its pairs, and the pairs."""
    splits, ranks, asks = [], [], []
    for s, p in _of(table, PAIRS):
        own, each, frequent, each_frequent, gaps, counts = read(p)
        each = np.append(each, each_frequent)
        runs = each[each > 0]
        upto, first = np.cumsum(gaps), np.cumsum(runs) - runs
        splits.append(s)
        ranks.append(own)
        asks.append([np.append(vocabulary.starts[bucket] + own, vocabulary.starts[-1] + frequent), each,
                     upto - np.repeat(upto[first] - gaps[first], runs), counts])
    contexts, place = np.unique(np.concatenate([a[2] for a in asks]), return_inverse=True)
    for a, p in zip(asks, np.split(place, np.cumsum([len(a[2]) for a in asks])[:-1])):
        a[2] = p
    return splits, ranks, contexts, Range(asks, bucket, buckets, max(1, len(contexts)))


class Served(NamedTuple):
    """Which of a range's pairs serve which word in the parent: its own words, or the frequent ones."""

    often: np.ndarray
    place: np.ndarray  # of a pair's word among the range's own or the frequent ones

    @classmethod
    def of(cls, vocabulary: Vocabulary, bucket: int, codes: np.ndarray) -> Served:
        often = vocabulary.is_frequent(codes)
        return cls(often, codes - np.where(often, vocabulary.starts[-1], vocabulary.starts[bucket]))

    def sums(self, tables: np.ndarray, own: int, frequent: int) -> tuple[np.ndarray, np.ndarray]:
        return (np.bincount(self.place[~self.often], tables[~self.often], own).astype(np.int64),
                np.bincount(self.place[self.often], tables[self.often], frequent).astype(np.int64))


def merged(vocabulary: Vocabulary, buckets: int) -> Callable[[tuple, pa.Table], pa.Table]:
    """The learned pairs of a range: those learned more than once, and of the others the sums. Every pair starts with one table."""
    group = max(1, int(buckets ** 0.5))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        _, _, contexts, own = _range(vocabulary, table, bucket, buckets)
        size, codes = vocabulary.size(bucket), own.words[own.owner]
        once, twice = own.counts == 1, own.counts > 1
        one = Served.of(vocabulary, bucket, codes[once]).sums(np.ones(once.sum()), size, len(vocabulary.frequent))
        two = Served.of(vocabulary, bucket, codes[twice]).sums(np.ones(twice.sum()), size, len(vocabulary.frequent))
        at, context = np.unique(own.context[twice], return_inverse=True)
        word, each = np.unique(codes[twice], return_counts=True)
        ones = np.bincount(own.context[once], minlength=len(contexts))
        twos = np.bincount(context, minlength=len(at))
        rows = [(bucket, TWICE, 0, counted(word, each, context, own.counts[twice], contexts[at], *one))]
        both = np.zeros(len(contexts), np.int64)
        both[at] = 1
        for h, first, part in vocabulary.by_home(contexts):
            rows.append((h, ONCE, bucket, counted(contexts[part] - first, ones[part], both[part])))
        rows += [(h, SUMS, bucket, counted(twos[part])) for h, _, part in vocabulary.by_home(contexts[at])]
        served = one[0] + two[0]
        rows.append((bucket, SERVED, 0, counted(served)))
        rows.append((bucket % group, STATS, bucket, counted(one[1] + two[1], np.array([served.sum(), np.count_nonzero(served)]))))
        return _table(rows)

    return tidied_groups(run)


def home(vocabulary: Vocabulary) -> Callable[[tuple, pa.Table], pa.Table]:
    """Of the contexts of a home: the tables of pairs learned once, and whose sums of the other pairs will come from where."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        at, found = key[0].as_py(), [(s, read(p)) for s, p in _of(table, ONCE)]
        tables = np.zeros(sum(map(vocabulary.size, vocabulary.ranges(at))), np.int64)
        for _, (ranks, ones, _) in found:
            tables[ranks] += ones
        rows = [(at, HOME, -1, counted(tables))]
        return _table(rows + [(at, HOME, s, counted(ranks[both > 0])) for s, (ranks, _, both) in found if both.any()])

    return run


def _totals(homes: pa.Table, sent: pa.Table) -> tuple[dict[int, np.ndarray], np.ndarray]:
    """Which contexts of a home each range has pairs of, and the tables of all of them."""
    found = {s: read(p)[0] for s, p in _of(homes, HOME)}
    tables = found.pop(-1)
    for s, p in _of(sent, SUMS):
        tables[found[s]] += read(p)[0]
    return found, tables


def tables_of(key: tuple, homes: pa.Table, sent: pa.Table) -> pa.Table:
    """The tables of contexts, for the ranges that have pairs of them."""
    found, tables = _totals(homes, sent)
    return _table([(s, TABLES, key[0].as_py(), counted(tables[ranks])) for s, ranks in found.items()])


def all_tables(vocabulary: Vocabulary, sample: int) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    """The tables of all contexts, for the ranges they are words of, after a sample."""
    def run(key: tuple, homes: pa.Table, sent: pa.Table) -> pa.Table:
        buckets, tables = vocabulary.ranges(key[0].as_py()), _totals(homes, sent)[1]
        parts = np.split(tables, np.cumsum([vocabulary.size(b) for b in buckets])[:-1])
        return _table([(b, ALL, sample, counted(part)) for b, part in zip(buckets, parts) if len(part)])

    return run


class Parent(NamedTuple):
    """The parent's customers and tables of all words, and those of the frequent words."""

    customers: int
    taken: int
    served: np.ndarray
    tables: np.ndarray


def swept(vocabulary: Vocabulary, buckets: int, sweep: int, parent: Parent, frequent: np.ndarray) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    """One sweep over a range's pairs, given the sums before it and the probabilities of frequent words."""
    group = max(1, int(buckets ** 0.5))

    def run(key: tuple, pairs: pa.Table, sent: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        word, each, context, counts, contexts, once, once_frequent = read(_of(pairs, TWICE)[0][1])
        seats = np.concatenate([np.empty(0, np.int64), *[read(p)[0] for _, p in _of(sent, TABLES)]])
        served = read(_of(sent, SERVED)[0][1])[0]
        rng = np.random.default_rng([bucket, sweep])
        own, p = parent_seated(served, parent.customers, parent.taken, vocabulary.kinds, rng)
        to = Served.of(vocabulary, bucket, np.repeat(word, each))
        chance = np.empty(len(context))
        chance[to.often], chance[~to.often] = frequent[to.place[to.often]], p[to.place[~to.often]]
        tables = seated(counts, (STRENGTH[0] + DISCOUNT[0] * seats[context]) * chance, DISCOUNT[0], rng).astype(np.int64)
        served, often = to.sums(tables, len(served), len(frequent))
        served, often = served + once, often + once_frequent
        own = np.minimum(own, served).astype(np.int64)
        sums = np.bincount(context, tables, len(contexts)).astype(np.int64)
        rows = [(h, SUMS, bucket, counted(sums[part])) for h, _, part in vocabulary.by_home(contexts)]
        rows.append((bucket, SERVED, 0, counted(served)))
        rows.append((bucket % group, STATS, bucket, counted(often, np.array([served.sum(), own.sum()]))))
        if sweep > BURN_IN:
            rows.append((bucket, SAMPLE, sweep, counted(tables, served, own)))
        return _table(rows)

    return run


def parent_sums(rows: DataFrame) -> tuple[np.ndarray, int, int]:
    """Customers of the frequent words, and customers and tables of the other words, in the parent; about the root of the ranges' number are added up at a time."""
    def add(key: tuple, table: pa.Table) -> pa.Table:
        found = [read(p) for _, p in _of(table, STATS)]
        return _table([(key[0].as_py(), STATS, 0, counted(*[sum(f[i] for f in found) for i in (0, 1)]))])

    found = [read(bytes(r["payload"])) for r in rows.where(F.col("kind") == STATS).groupBy("key").applyInArrow(add, ROWS).collect()]
    often, (served, own) = [sum(f[i] for f in found) for i in (0, 1)] if found else (np.empty(0, np.int64), (0, 0))
    return often, int(served), int(own)


def answered(vocabulary: Vocabulary, buckets: int, parents: Sequence[Parent]) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    """For each split: counts of its pairs in a range and their tables, summed over samples; of its words there the counts,
    whether they are frequent, and by sample the tables as contexts, and customers and tables in the parent."""
    def run(key: tuple, asks: pa.Table, sent: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        numbers, ranks, _, own = _range(vocabulary, asks, bucket, buckets)
        counts = read(_of(sent, COUNTS)[0][1])[0]
        codes = vocabulary.codes(vocabulary.starts[bucket] + np.arange(len(counts)))
        often = vocabulary.is_frequent(codes)
        tables = np.where(own.counts == 1, SAMPLES, 0)
        by_sample = []
        for (_, seats), (_, sample), parent in zip(_of(sent, ALL), _of(sent, SAMPLE), parents):
            twice, served, above = read(sample)
            tables[own.counts > 1] += twice
            served[often], above[often] = parent.served[codes[often] - vocabulary.starts[-1]], parent.tables[codes[often] - vocabulary.starts[-1]]
            by_sample.append((read(seats)[0], served, above))
        return _table([(s, ANSWER, bucket, counted(own.counts[place], tables[place], counts[r], often[r].astype(np.int64), *[
            steps([x[i][r] for x in by_sample]) for i in range(3)])) for s, r, place in zip(numbers, ranks, own.places)])

    return tidied_groups(run)


def looked_up(vocabulary: Vocabulary, parents: Sequence[Parent]) -> Callable[[tuple, pa.Table], pa.Table]:
    """Scores of the texts, or pieces of texts, of a split."""
    def run(_: tuple, table: pa.Table) -> pa.Table:
        row, ids, flags, sizes, before, *token = unblob(_of(table, TOKENS)[0][1])
        answers = [(b, unblob(p)) for b, p in _of(table, ANSWER)]
        home = np.repeat([b for b, _ in answers], [len(a[2]) for _, a in answers])
        known, often = [np.concatenate([a[i] for _, a in answers]).astype(np.int64) for i in (2, 3)]
        seats, served, above = [np.concatenate([from_steps(a[i].astype(np.int64), SAMPLES) for _, a in answers], axis=1) for i in (4, 5, 6)]
        token = from_frequency(*token)
        word, context, place = _pairs(before, sizes, token, len(known))
        order, _ = _dealt(word, context, home, often > 0)
        counts, tables = [np.concatenate([a[i] for _, a in answers]) for i in (0, 1)]
        del answers
        above = [in_parent(served[s], above[s], p.customers, p.taken, vocabulary.kinds) for s, p in enumerate(parents)]
        logs = np.empty(len(order))
        for at in range(0, len(order), BLOCK):
            part = order[at:at + BLOCK]
            c, t, w, u = counts[at:at + BLOCK], tables[at:at + BLOCK] / SAMPLES, word[part], context[part]
            logs[part] = np.log10(sum(in_context(c, t, known[u], seats[s, u], above[s][w]) for s in range(SAMPLES)) / SAMPLES)
        del word, context, order, counts, tables
        base = np.log10((known + ADDED) / (vocabulary.tokens + ADDED * (vocabulary.kinds + 1)))
        starts = np.cumsum(sizes) - sizes
        parts = [np.add.reduceat(values, starts) for values in ((known[token] > 0).astype(np.int64), base[token], logs[place])]
        return pa.Table.from_batches([pa.RecordBatch.from_arrays([
            pa.array(row), pa.array(ids, mask=flags >= 2), pa.array(flags % 2 == 1), pa.array(sizes), *map(pa.array, parts)],
            names=[f.split(" ")[0] for f in SCORES.split(", ")])])

    return tidied_groups(run)


RANGE_ROWS = 5_000  # documents for each hash range of words
LEAST_RANGES = 8


def scored(documents: DataFrame, held_out: Column) -> DataFrame:
    """One row per row of ``documents``: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` and ``score``.

    The model learns from the rows whose ``held_out`` is false. A null or empty text is its end alone. Repeated rows
    are learned from and scored one by one; a null id is scored like any other. With nothing to learn from, both
    scores are those of one unknown word, probability one. Other columns are not read.
    """
    spark = documents.sparkSession
    buckets = max(LEAST_RANGES, -(-documents.count() // RANGE_ROWS))  # of the data, not of the session: scores depend on it

    def stored(rows: DataFrame, label: str, schema: str = ROWS) -> DataFrame:
        path = scratch(spark, label)
        rows.write.parquet(path)
        return spark.read.schema(schema).parquet(path)

    def of(rows: DataFrame, *kinds: int) -> DataFrame:
        return rows.where(F.col("kind").isin(*kinds))

    kept: list[DataFrame] = []

    def keep(rows: DataFrame) -> DataFrame:
        """Dealt out by key, for more than one use: no shuffle follows."""
        kept.append(rows.repartition(buckets, "key").persist(StorageLevel.DISK_ONLY))
        return kept[-1]

    def together(rows: DataFrame, sent: DataFrame, run: Callable) -> DataFrame:
        return rows.groupBy("key").cogroup(sent.groupBy("key")).applyInArrow(run, ROWS)

    try:
        parts = stored(splits(documents, held_out, buckets), "lm-splits")
        ranks = stored(of(parts, WORDS).groupBy("key").applyInArrow(numbered, ROWS), "lm-words")
        known = vocabulary(ranks, buckets)
        asks = keep(of(parts, TOKENS).unionByName(of(ranks, RANKS)).groupBy("key").applyInArrow(asked(known), ROWS))
        rows = keep(asks.groupBy("key").applyInArrow(merged(known, buckets), ROWS))
        pairs, homes = of(rows, TWICE), keep(of(rows, ONCE).groupBy("key").applyInArrow(home(known), ROWS))
        often, served, own = parent_sums(rows)
        parent = Parent(served + int(often.sum()), own + np.count_nonzero(often), often, np.minimum(often, 1))
        parents, samples = [], of(ranks, COUNTS)
        for sweep in range(1, BURN_IN + SAMPLES + 1):
            tables, chance = parent_seated(parent.served, parent.customers, parent.taken, known.kinds, np.random.default_rng([buckets, sweep]))
            sent = together(homes, of(rows, SUMS), tables_of).unionByName(of(rows, SERVED))
            rows = stored(together(pairs, sent, swept(known, buckets, sweep, parent, chance)), "lm-sweep")
            often, served, own = parent_sums(rows)
            tables = np.minimum(tables, often).astype(np.int64)
            parent = Parent(served + int(often.sum()), own + int(tables.sum()), often, tables)
            if sweep > BURN_IN:
                parents.append(parent)
                samples = samples.unionByName(of(rows, SAMPLE)).unionByName(together(homes, of(rows, SUMS), all_tables(known, sweep)))
        answers = together(asks, samples, answered(known, buckets, parents))
        found = stored(of(parts, TOKENS).unionByName(answers).groupBy("key").applyInArrow(looked_up(known, parents), SCORES), "lm-scores", SCORES)
    finally:
        for rows in kept:
            rows.unpersist()
    # The pieces of a text that spans splits.
    whole = found.groupBy("row", "doc_id", "held_out").agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
    return whole.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(known.tokens).cast("long").alias("train_tokens"), "base_score", "score")

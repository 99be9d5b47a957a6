"""Adaptive context-mixing range coder for token ids.

Ids are coded in blocks of ``BLOCK``; every model starts anew in a block, and each block has a checksum.
The probability of the next id mixes three predictions, all learned within the block:

- order 2 and order 1: the id that last followed the two ids before, or the one before, with a
  confidence that grows while it is right and falls when it is not. What share of the mix a
  confidence earns is learned too, from how often it has been right;
- order 0: counts of id classes (ids ranked by their frequency in the stream, four classes a doubling),
  even within a class; every id keeps some share. The ranking stands before the blocks.

The mix is made of whole numbers that sum to 2 ** ``BITS``, so coder and decoder agree on any machine. It drives
a carry-less range coder with a 64-bit state that gives out 32-bit words. The blocks of a group are
coded in lock step, one id of each at a time, as numpy vectors.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 4096
LANES = 1024  # blocks coded together
SLOTS = 4096  # of each context table
LEVELS = 16  # of confidence
REFRESH = 16  # ids between two looks at the class counts
STEP = 24  # weight of one id in its class's count
BITS = 22
IDS = 1 << 16
CLASS_BITS = 12
SHARE = 1 << 12  # unit of a share
RATE = 5

_32 = np.uint64(32)
_WORD = np.uint64((1 << 32) - 1)


def _classes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each id; first id and size of each class, as a power of two."""
    ids = np.arange(IDS)
    shift = np.maximum(np.frexp(ids)[1] - 3, 0)
    cls = np.where(ids < 8, ids, 4 * shift + (ids >> shift)).astype(np.int64)
    size = np.bincount(cls)
    return cls, np.concatenate([[0], np.cumsum(size)]).astype(np.int64), np.log2(size).astype(np.int64)


CLASS, FIRST, SHIFT = _classes()
CLASSES = len(SHIFT)
# Confidence after a wrong and after a right guess.
NEXT = np.concatenate([np.maximum(np.arange(LEVELS) >> 1, 1), np.minimum(np.arange(LEVELS) + 1, LEVELS - 1)])


def _at(values: np.ndarray, places: np.ndarray) -> np.ndarray:
    """``values[places]`` for places that are known to fit."""
    return values.take(places, mode="clip")


class Mixer:
    """The models of a group of blocks."""

    def __init__(self, lanes: int) -> None:
        self.lanes = lanes
        at = np.arange(lanes)
        self.slot_base, self.level_base, self.class_base = at * SLOTS, at * LEVELS, at * CLASSES
        self.bound_base = at * (CLASSES + 1)
        self.one, self.two = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)  # the id before that times a factor
        self.tables = [np.zeros(lanes * SLOTS, np.int32) for _ in range(2)]  # id and confidence in one number
        start = np.arange(LEVELS) * SHARE // (LEVELS + 4)
        self.rates = [np.tile(start, lanes) for _ in range(2)]
        self.counts = np.ones(lanes * CLASSES, np.int64)
        self.at = 0

    def predict(self) -> None:
        if self.at % REFRESH == 0:
            ends = np.cumsum(self.counts.reshape(self.lanes, CLASSES), axis=1)
            bounds = np.zeros((self.lanes, CLASSES + 1), np.int64)
            # Whole numbers far below 2 ** 53: a double's quotient rounds down to the exact one, and is found faster.
            bounds[:, 1:] = (ends << CLASS_BITS) / ends[:, -1:]
            self.bounds = bounds.ravel()
        self.at += 1
        one = self.one * 40503
        mixed = self.one * 30011
        mixed += self.two
        mixed ^= mixed >> 11
        mixed &= SLOTS - 1
        mixed += self.slot_base
        after = one >> 5
        after &= SLOTS - 1
        after += self.slot_base
        self.slots, self.two = [mixed, after], one
        left = np.full(self.lanes, (1 << BITS) - (1 << BITS - 4), np.int64)
        self.guess, self.level, self.place, self.rate, self.given = [], [], [], [], []
        for table, rates, slot in zip(self.tables, self.rates, self.slots):
            held = _at(table, slot).astype(np.int64)
            level = held & (LEVELS - 1)
            place = self.level_base + level
            rate = _at(rates, place)
            given = left * rate >> 12
            left -= given
            self.guess.append(held >> 4)
            self.level.append(level)
            self.place.append(place)
            self.rate.append(rate)
            self.given.append(given)
        # What order 0 divides, beyond one for each id.
        self.spare = left + ((1 << BITS - 4) - IDS)

    def span(self, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where a class begins among order 0's frequencies, and its width."""
        at = self.bound_base + cls
        first, low = _at(FIRST, cls), self.spare * _at(self.bounds, at) >> CLASS_BITS
        low += first
        at += 1
        high = self.spare * _at(self.bounds, at) >> CLASS_BITS
        high += _at(FIRST, cls + 1)
        high -= low
        return low, high

    def order0(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of an id among order 0's frequencies."""
        cls = _at(CLASS, ids)
        low, width = self.span(cls)
        shift, at = _at(SHIFT, cls), ids - _at(FIRST, cls)
        part = width * at
        width += part
        part >>= shift
        width >>= shift
        part += low
        width += low
        return part, width

    def interval(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and size of an id in the whole mix."""
        return self.beside(ids, *self.order0(ids))

    def beside(self, ids: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`interval` of an id whose place among order 0's frequencies is known."""
        size = high - low
        self.right = []
        for guess, given in zip(self.guess, self.given):
            right = guess == ids
            low = low + given * (guess < ids)
            size += given * right
            self.right.append(right)
        return low, size

    def find(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The id whose interval holds a value, and its begin and size."""
        (one, two), (g_one, g_two) = self.guess, self.given
        a, b = np.minimum(one, two), np.maximum(one, two)
        ga = np.where(one > two, g_two, g_one)
        gb = g_one + g_two - ga
        low_a, end_a = self.order0(a)
        low_b, end_b = self.order0(b)
        past_a = value >= end_a
        is_a = past_a & (value < end_a + ga)
        value = value - ga * (past_a & ~is_a)
        past_b = ~is_a & past_a & (value >= end_b)
        is_b = past_b & (value < end_b + gb)
        value = value - gb * (past_b & ~is_b)
        cls = np.zeros(self.lanes, np.int64)
        for step in (32, 16, 8, 4, 2, 1):
            further = cls + step
            if 64 - step >= CLASSES:
                np.minimum(further, CLASSES - 1, out=further)
            bound = _at(self.bounds, self.bound_base + further)
            bound *= self.spare
            bound >>= CLASS_BITS
            bound += _at(FIRST, further)
            cls = np.where(bound <= value, further, cls)
        low, width = self.span(cls)
        shift = _at(SHIFT, cls)
        ids = ((value - low + 1 << shift) - 1) // np.maximum(width, 1)
        part = width * ids
        ids += _at(FIRST, cls)
        width += part
        ids = np.where(is_a, a, np.where(is_b, b, ids))
        begin = np.where(is_a, low_a, np.where(is_b, low_b, low + (part >> shift)))
        end = np.where(is_a, end_a, np.where(is_b, end_b, low + (width >> shift)))
        return ids, *self.beside(ids, begin, end)

    def learn(self, ids: np.ndarray) -> None:
        """Take in an id whose interval was asked for last."""
        for table, rates, slot, guess, level, place, rate, right in zip(
                self.tables, self.rates, self.slots, self.guess, self.level, self.place, self.rate, self.right):
            target = right * (SHARE - SHARE // 32)
            target -= rate
            target >>= RATE
            target += rate
            rates[place] = target
            new = _at(NEXT, level + LEVELS * right)
            # A right guess is the id.
            new |= np.where(level > 1, guess, ids) << 4
            table[slot] = new
        self.counts[self.class_base + _at(CLASS, ids)] += STEP
        self.one = ids


def encode(blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of each row of ids (one after the other), and their number."""
    lanes, n = blocks.shape
    mixer = Mixer(lanes)
    low, size = np.zeros(lanes, np.uint64), np.full(lanes, 2 ** 64 - 1, np.uint64)
    words, used = np.empty((lanes, n + 2), np.uint32), np.zeros(lanes, np.int64)
    columns = np.ascontiguousarray(blocks.T).astype(np.int64)
    for ids in columns:
        mixer.predict()
        begin, share = mixer.interval(ids)
        unit = size >> np.uint64(BITS)
        low += begin.astype(np.uint64) * unit
        size = share.astype(np.uint64) * unit
        short = np.flatnonzero(size <= _WORD)
        if len(short):
            at, left = low[short], size[short]
            across = (at ^ (at + left)) > _WORD
            left = np.where(across, -at & _WORD, left)
            words[short, used[short]] = at >> _32
            used[short] += 1
            low[short], size[short] = at << _32, left << _32
        mixer.learn(ids)
    for part in (low >> _32, low & _WORD):
        words[np.arange(lanes), used] = part
        used += 1
    return words[np.arange(n + 2) < used[:, None]], used


def decode(words: np.ndarray, used: np.ndarray, n: int) -> np.ndarray:
    """Rows of ``n`` ids from what :func:`encode` gave."""
    lanes = len(used)
    mixer = Mixer(lanes)
    at = np.cumsum(used) - used
    stop = len(words) - 1
    words = words.astype(np.uint64)
    low, size = np.zeros(lanes, np.uint64), np.full(lanes, 2 ** 64 - 1, np.uint64)
    code = (words[at] << _32) | words[at + 1]
    at += 2
    out = np.empty((n, lanes), np.int64)
    for k in range(n):
        mixer.predict()
        unit = size >> np.uint64(BITS)
        value = np.minimum((code - low) // unit, np.uint64((1 << BITS) - 1)).astype(np.int64)
        ids, begin, share = mixer.find(value)
        low += begin.astype(np.uint64) * unit
        size = share.astype(np.uint64) * unit
        short = np.flatnonzero(size <= _WORD)
        if len(short):
            here, left = low[short], size[short]
            across = (here ^ (here + left)) > _WORD
            left = np.where(across, -here & _WORD, left)
            low[short], size[short] = here << _32, left << _32
            code[short] = (code[short] << _32) | words[np.minimum(at[short], stop)]
            at[short] += 1
        mixer.learn(ids)
        out[k] = ids
    return out.T


MAGIC = b"MRIDS\x01\x00\x00"


def _checksums(ids: np.ndarray) -> np.ndarray:
    return np.array([zlib.crc32(ids[a:a + BLOCK].astype("<u4").tobytes()) for a in range(0, len(ids), BLOCK)], "<u4")


def packed(ids: np.ndarray) -> bytes:
    """A coded stream: magic, number of ids and of distinct ids, the distinct ids by falling frequency,
    words and checksum of each block, then the words.

    Checksums are crc32 of a block's ids as little-endian 32-bit numbers. Ids are 0 to 2 ** 32 - 1, at
    most ``IDS`` of them distinct.
    """
    ids = np.asarray(ids, np.int64)
    if len(ids) and (ids.min() < 0 or ids.max() >= 1 << 32):
        raise ValueError("an id does not fit")
    if len(ids) and ids.max() < IDS:  # counted, not sorted
        counts = np.bincount(ids)
        distinct = np.flatnonzero(counts)
        ranks, counts = (np.cumsum(counts > 0) - 1)[ids], counts[distinct]
    else:
        distinct, ranks, counts = np.unique(ids, return_inverse=True, return_counts=True)
    if len(distinct) > IDS:
        raise ValueError("too many distinct ids")
    order = np.argsort(-counts, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    blocks = -(-len(ids) // BLOCK)
    rows = np.zeros(blocks * BLOCK, np.int64)
    rows[:len(ids)] = place[ranks]
    rows = rows.reshape(blocks, BLOCK)
    parts = [encode(rows[a:a + LANES]) for a in range(0, blocks, LANES)]
    used = np.concatenate([np.empty(0, np.int64), *(n for _, n in parts)]).astype("<u4")
    return b"".join([
        MAGIC, np.array([len(ids), len(distinct)], "<u8").tobytes(), distinct[order].astype("<u4").tobytes(),
        used.tobytes(), _checksums(ids).tobytes(), *(w.astype("<u4").tobytes() for w, _ in parts)])


def unpacked(raw: bytes) -> np.ndarray:
    """The ids of a coded stream; raises ValueError if a block's checksum does not match."""
    if raw[:8] != MAGIC:
        raise ValueError("not a coded stream")
    n, kinds = np.frombuffer(raw, "<u8", 2, 8).tolist()
    blocks = -(-n // BLOCK)
    at = 24 + 4 * kinds
    ranked = np.frombuffer(raw, "<u4", kinds, 24).astype(np.int64)
    used = np.frombuffer(raw, "<u4", blocks, at).astype(np.int64)
    sums = np.frombuffer(raw, "<u4", blocks, at + 4 * blocks)
    words = np.frombuffer(raw, "<u4", int(used.sum()), at + 8 * blocks)
    ends = np.cumsum(used)
    out = [np.empty(0, np.int64)]
    for a in range(0, blocks, LANES):
        b = min(blocks, a + LANES)
        out.append(decode(words[ends[a] - used[a]:ends[b - 1]], used[a:b], BLOCK).ravel())
    ranks = np.concatenate(out)[:n]
    # A damaged block may give ranks that no id has.
    ids = ranked[np.minimum(ranks, kinds - 1)] if kinds else ranks
    bad = np.flatnonzero(_checksums(ids) != sums)
    if len(bad):
        raise ValueError(f"blocks {bad[:5].tolist()} are damaged")
    return ids

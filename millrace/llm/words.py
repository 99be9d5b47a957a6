"""Words of a text and 64-bit hashes of words and word runs, for use inside tasks.

A word is a run of bytes other than space and the control characters 9 to 13; only A-Z are
lower-cased. Both are what ``bytes.lower`` and ``bytes.split`` do.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

MEMO_WORDS = 150_000  # words whose hash a task remembers; beyond it the memory starts anew

_STEP = np.uint64(0xD6E8FEB86659FD93)
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)


class WordHashes(dict):
    """Hash of a word, computed once for as long as it is remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def words(text: bytes | None) -> list[bytes]:
    """Lower-cased words; none for a null text."""
    return text.lower().split() if text else []


def hashed(found: list[bytes], memo: WordHashes) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, found), np.uint64, len(found))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of each value (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_A
    x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


def run_hashes(h: np.ndarray, places: list[int]) -> np.ndarray:
    """One hash per start: of the words at ``places`` after it. Empty if the text is too short."""
    n = len(h) - places[-1]
    if n <= 0:
        return h[:0]
    out = np.zeros(n, np.uint64)
    for p in places:
        out = out * _STEP + h[p:p + n]
    return mixed(out)


def shingles(h: np.ndarray, width: int) -> np.ndarray:
    """Distinct 63-bit hashes of all runs of ``width`` words, sorted; a shorter text is one run."""
    if len(h) == 0:
        return h.view(np.int64)
    return np.unique(run_hashes(h, list(range(min(width, len(h))))) >> np.uint64(1)).view(np.int64)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    return batch.column(name).cast(pa.large_binary()).to_pylist()


def lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """Arrays as one list column."""
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int64)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.LargeListArray.from_arrays(pa.array(ends), pa.array(flat, kind)).cast(pa.list_(kind))


def batches_of(found: Iterator[pa.RecordBatch], most_bytes: int = 32 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most_bytes`` at most, whatever the batches read; a row stays whole."""
    for batch in found:
        parts = max(1, -(-batch.nbytes // most_bytes))
        step = max(1, -(-batch.num_rows // parts))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def give_back() -> None:
    """Hand memory that is no longer used to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:
        trim(0)


def tidied(run: Task) -> Task:
    """``run``, giving back what it took when its task ends: the same worker serves later tasks, or waits for some."""
    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidy


def tidied_groups(run: Callable) -> Callable:
    """:func:`tidied` for a function of a key and a group, or of a key and two groups."""
    def tidy(*given) -> pa.Table:
        try:
            return run(*given)
        finally:
            give_back()

    # Spark goes by the number of arguments.
    return (lambda key, group: tidy(key, group)) if run.__code__.co_argcount == 2 else (lambda key, group, other: tidy(key, group, other))

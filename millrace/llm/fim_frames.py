"""Fill-in-middle on texts kept as seekable compressed frames.

:func:`stored` keeps each text as zstandard frames of ``FRAME`` bytes that are compressed independently of one another, each with
the units (lines, or code points) and code points that come before it. So the place of any unit is found from these
counts and in one frame.

:func:`transformed` cuts a text into prefix, middle and suffix and puts them in another order with markers before them. It
opens only the frames that hold a cut; all other frames are taken over as they are. The output is again a row of frames, and the
frames one after another are a valid zstandard stream. :func:`digests` and :func:`restored` read frames in order, one at a time.

A text is one row, compressed; no task holds more of it than that and one open frame. Nothing is shuffled.

A null text counts as empty, and an empty text stays plain. So does a text that holds one of the markers, since it could not
be told from them when the text is put together again. A null id draws its cuts as the empty string does. Repeated rows
are treated alike, ties of both cuts give an empty middle, other columns are not read, and an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import batches_of, tidied

FRAME = 1 << 16  # bytes of text in a frame, but for a character at its end
LEVEL = 3
MARKERS = (b"<P>", b"<S>", b"<M>")
_OVERLAP = max(map(len, MARKERS)) - 1

FRAMES = "array<struct<units: bigint, chars: bigint, bytes: bigint, data: binary>>"
STORED = f"doc_id BIGINT, n BIGINT, n_chars BIGINT, marked BOOLEAN, frames {FRAMES}"
OUTPUT = f"doc_id BIGINT, n BIGINT, form STRING, prefix_chars BIGINT, middle_chars BIGINT, frames {FRAMES}"

_FRAME_TYPE = pa.struct([("units", pa.int64()), ("chars", pa.int64()), ("bytes", pa.int64()), ("data", pa.binary())])
_CONTINUES = bytes(range(0x80, 0xC0))  # bytes inside a character of UTF-8


def n_chars(raw: bytes) -> int:
    return len(raw) if raw.isascii() else len(raw.translate(None, _CONTINUES))


def _char_end(raw: bytes, chars: int) -> int:
    """Number of bytes of the first ``chars`` characters."""
    return chars if raw.isascii() else len(raw.decode("utf-8", "surrogateescape")[:chars].encode("utf-8", "surrogateescape"))


class Unit:
    """What a text is cut by. ``ended`` counts the units that end in a piece of text, ``end`` finds the end of one there."""

    def ended(self, raw: bytes) -> int:
        raise NotImplementedError

    def end(self, raw: bytes, nth: int) -> int:
        """Bytes up to the end of the ``nth`` unit, from 1, that ends in ``raw``."""
        raise NotImplementedError

    def last(self, raw: bytes) -> int:
        """Units of the whole text that no unit end closes, given its last piece: 0 or 1."""
        return 0


class Lines(Unit):
    def ended(self, raw: bytes) -> int:
        return raw.count(b"\n")

    def end(self, raw: bytes, nth: int) -> int:
        at = 0
        for _ in range(nth):
            at = raw.index(b"\n", at) + 1
        return at

    def last(self, raw: bytes) -> int:
        return int(bool(raw) and not raw.endswith(b"\n"))


class Chars(Unit):
    def ended(self, raw: bytes) -> int:
        return n_chars(raw)

    def end(self, raw: bytes, nth: int) -> int:
        return _char_end(raw, nth)


UNITS = {"line": Lines, "char": Chars}


def pieces(raw: bytes, size: int) -> Iterator[bytes]:
    """``raw`` in pieces of about ``size`` bytes that end with a character."""
    at = 0
    while at < len(raw):
        to = min(at + size, len(raw))
        while to < len(raw) and raw[to] & 0xC0 == 0x80:
            to += 1
        yield raw[at:to]
        at = to


class Frames:
    """A growing row of frames and its cumulative counts."""

    def __init__(self, unit: Unit, pack: zstandard.ZstdCompressor) -> None:
        self.unit, self.pack = unit, pack
        self.units = self.chars = 0
        self.rows: list[dict] = []

    def add(self, raw: bytes) -> None:
        if raw:
            self.take(self.unit.ended(raw), n_chars(raw), len(raw), self.pack.compress(raw))

    def take(self, units: int, chars: int, size: int, data: bytes) -> None:
        """A frame that is compressed already, and what it holds."""
        self.rows.append({"units": self.units, "chars": self.chars, "bytes": size, "data": data})
        self.units += units
        self.chars += chars


class Seek:
    """The frames of one text, opened one at a time."""

    def __init__(self, rows: Sequence[dict], unit: Unit, n: int, chars: int, open_: zstandard.ZstdDecompressor) -> None:
        self.rows, self.unit, self.n, self.total, self.open = rows, unit, n, chars, open_

    def raw(self, i: int) -> bytes:
        return self.open.decompress(self.rows[i]["data"], max_output_size=self.rows[i]["bytes"])

    def held(self, i: int) -> tuple[int, int]:
        """Units that end in a frame and characters in it."""
        if i + 1 < len(self.rows):
            return self.rows[i + 1]["units"] - self.rows[i]["units"], self.rows[i + 1]["chars"] - self.rows[i]["chars"]
        return self.unit.ended(self.raw(i)), self.total - self.rows[i]["chars"]

    def place(self, units: int) -> tuple[int, int, int]:
        """Where the first ``units`` units end: frame, bytes into it, and code points before it."""
        if units == 0:
            return 0, 0, 0
        if units >= self.n:
            return len(self.rows), 0, self.total
        low, high = 0, len(self.rows)
        while high - low > 1:  # the last frame before which fewer units have ended
            middle = (low + high) // 2
            low, high = (middle, high) if self.rows[middle]["units"] < units else (low, middle)
        raw = self.raw(low)
        at = self.unit.end(raw, units - self.rows[low]["units"])
        return low, at, self.rows[low]["chars"] + n_chars(raw[:at])

    def copy(self, out: Frames, start: tuple[int, int, int], end: tuple[int, int, int]) -> None:
        """Append what lies between two places: whole frames as they are, cut ones anew."""
        (i, a, _), (j, b, _) = start, end
        for k in range(i, min(j + 1, len(self.rows))):
            left, right = (a if k == i else 0), (b if k == j else self.rows[k]["bytes"])
            if left == 0 and right == self.rows[k]["bytes"]:
                out.take(*self.held(k), right, self.rows[k]["data"])
            elif left < right:
                out.add(self.raw(k)[left:right])


def stored(documents: DataFrame, unit: str = "line", frame: int = FRAME) -> DataFrame:
    """Each text as frames: ``doc_id``, ``n`` units, ``n_chars``, ``marked`` (holds a marker) and ``frames``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, pack = UNITS[unit](), zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches_of(batches):
            rows = []
            for raw in batch.column("text").cast(pa.large_binary()):
                whole = raw.as_py() or b""
                out = Frames(kind, pack)
                for piece in pieces(whole, frame):
                    out.add(piece)
                rows.append((out.units + kind.last(whole), out.chars, any(m in whole for m in MARKERS), out.rows))
            yield _batch(STORED, batch.column("doc_id"), rows, (pa.int64(), pa.int64(), pa.bool_()))

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tidied(run), STORED)


def _batch(schema: str, ids: pa.Array, rows: list[tuple], kinds: Sequence[pa.DataType]) -> pa.RecordBatch:
    kinds = [*kinds, pa.list_(_FRAME_TYPE)]
    columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
    names = [f.split()[0] for f in schema.split(f" {FRAMES}")[0].split(", ")]
    return pa.RecordBatch.from_arrays([ids, *columns], names=names)


def draws(seed: int, id_: Column) -> list[Column]:
    """Four numbers from the checksum of seed and id: 32 bits each."""
    sha = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(sha, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def transformed(store: DataFrame, seed: int = 7, percent: int = 100, spm_percent: int = 50, unit: str = "line") -> DataFrame:
    """Each text of :func:`stored` rearranged: ``doc_id``, ``n``, ``form`` (plain, psm or spm), ``prefix_chars`` and
    ``middle_chars`` (null if plain), and ``frames`` of the output.

    Two numbers drawn from the id say after how many units prefix and middle end; a third leaves texts plain
    unless below ``percent`` in a hundred, a fourth chooses between both orders. ``unit`` must be that of the store.
    """
    h = draws(seed, F.col("doc_id"))
    cut = [F.pmod(x, F.col("n") + 1) for x in h[:2]]
    plain = (F.col("n") == 0) | F.col("marked") | (F.pmod(h[2], F.lit(100)) >= percent)
    form = F.when(plain, "plain").when(F.pmod(h[3], F.lit(100)) < spm_percent, "spm").otherwise("psm")
    chosen = store.select(
        "doc_id", "n", "n_chars", form.alias("form"), F.least(*cut).alias("first"), F.greatest(*cut).alias("second"), "frames")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, pack, open_ = UNITS[unit](), zstandard.ZstdCompressor(level=LEVEL), zstandard.ZstdDecompressor()
        for batch in batches_of(batches):
            rows = []
            for r in _rows(batch):
                if r["form"] == "plain":
                    rows.append((r["n"], "plain", None, None, r["frames"]))
                    continue
                text, out = Seek(r["frames"], kind, r["n"], r["n_chars"], open_), Frames(kind, pack)
                a, b = text.place(r["first"]), text.place(r["second"])
                parts = {b"<P>": (text.place(0), a), b"<M>": (a, b), b"<S>": (b, text.place(r["n"]))}
                for marker in (b"<P>", b"<S>", b"<M>") if r["form"] == "psm" else (b"<S>", b"<P>", b"<M>"):
                    out.add(marker)
                    text.copy(out, *parts[marker])
                rows.append((r["n"], r["form"], a[2], b[2] - a[2], out.rows))
            yield _batch(OUTPUT, batch.column("doc_id"), rows, (pa.int64(), pa.string(), pa.int64(), pa.int64()))

    return chosen.mapInArrow(tidied(run), OUTPUT)


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows of a batch as Python values, one at a time."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def opened(rows: Sequence[dict], open_: zstandard.ZstdDecompressor) -> Iterator[bytes]:
    """The contents of frames, in order."""
    for r in rows:
        yield open_.decompress(r["data"], max_output_size=r["bytes"])


def marks(rows: Sequence[dict], open_: zstandard.ZstdDecompressor) -> dict[bytes, int]:
    """Where the first of each marker starts in a stream of frames, in bytes; a marker may lie in two frames."""
    found: dict[bytes, int] = {}
    before, at = b"", 0
    for raw in opened(rows, open_):
        view = before + raw
        for m in MARKERS:
            if m not in found and (i := view.find(m)) >= 0:
                found[m] = at - len(before) + i
        at += len(raw)
        before = view[-_OVERLAP:]
    return found


def original(rows: Sequence[dict], form: str, open_: zstandard.ZstdDecompressor) -> Iterator[bytes]:
    """The text that an output of this form was made from, in pieces."""
    if form == "plain":
        yield from opened(rows, open_)
        return
    at = marks(rows, open_)
    total = sum(r["bytes"] for r in rows)
    ends = dict(zip(sorted(at, key=at.get), [*sorted(at.values())[1:], total]))
    for m in (b"<P>", b"<M>", b"<S>"):
        place, start, end = 0, at[m] + len(m), ends[m]
        for r in rows:
            low, high = max(start - place, 0), min(end - place, r["bytes"])
            if low < high:
                yield open_.decompress(r["data"], max_output_size=r["bytes"])[low:high]
            place += r["bytes"]


def digests(output: DataFrame) -> DataFrame:
    """The rows of :func:`transformed` with ``output_sha256`` of the output and ``restored_sha256`` of the text
    put together again from output and form, instead of the frames."""
    schema = f"{OUTPUT.split(', frames ')[0]}, output_sha256 STRING, restored_sha256 STRING"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        for batch in batches_of(batches):
            shas: tuple[list, list] = ([], [])
            for r in _rows(batch.select(["form", "frames"])):
                for to, parts in zip(shas, (opened(r["frames"], open_), original(r["frames"], r["form"], open_))):
                    sha = hashlib.sha256()
                    for raw in parts:
                        sha.update(raw)
                    to.append(sha.hexdigest())
            kept = batch.drop_columns(["frames"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, *map(pa.array, shas)], names=[*kept.schema.names, "output_sha256", "restored_sha256"])

    return output.mapInArrow(tidied(run), schema)


def restored(output: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, put together again from the output and its form."""
    return _texts(output, lambda r, open_: original(r["frames"], r["form"], open_), ["doc_id", "form", "frames"])


def texts(framed: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` of what the frames of a store or of an output hold."""
    return _texts(framed, lambda r, open_: opened(r["frames"], open_), ["doc_id", "frames"])


def _texts(framed: DataFrame, parts, columns: list[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        for batch in batches_of(batches, 4 << 20):
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                raw = b"".join(parts(next(_rows(one)), open_))
                yield pa.RecordBatch.from_arrays(
                    [one.column("doc_id"), pa.array([raw], pa.large_binary()).cast(pa.large_string())], names=["doc_id", "text"])

    return framed.select(*columns).mapInArrow(tidied(run), "doc_id BIGINT, text STRING")

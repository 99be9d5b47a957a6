"""Per-key state on streams, where no built-in streaming operator has the semantics.

Times are microseconds. Rows of a key reach one task: order within a key is what these
operators are about. State that merges (:func:`salted_state`) is kept per salted key
instead, so a hot key is spread and its parts are merged when the result is read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

BLOCK = 10_000  # rows sent to the state store at a time
COUNTED = 1_000_000  # rows of a task that are counted at a time
PAGE_BITS = 65_536  # of a bitmap: 8 KB
PAIR = "start_ts BIGINT, end_ts BIGINT, outcome STRING"


class Named(StatefulProcessor):
    """Gives output rows the column names the stream was planned with."""

    columns: Sequence[str] = ()

    def row(self, *values: object) -> Row:
        return Row(**dict(zip(self.columns, values)))

    def close(self) -> None:
        pass


class InOrder(Named):
    """Hands rows to :meth:`on_row` in time order once the watermark has passed them.

    A row waits in list state until then. One timer per key is set, for the next waiting row
    or the next end of a wait; everything due is handled when it fires. Meanwhile ``held`` is
    what the operator keeps for the key, as (time, text) pairs; it is stored afterwards.
    """

    schema = ""
    times: Sequence[str] = ()

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", "us BIGINT, event_id BIGINT, kind STRING")
        self.waiting = handle.getListState("waiting", "us BIGINT, kind STRING")
        self.alarm = handle.getValueState("alarm", "at BIGINT")

    def on_row(self, us: int, kind: str) -> Iterator[tuple]:
        raise NotImplementedError

    def on_time(self, now: int) -> Iterator[tuple]:
        return iter(())

    def next_end(self) -> int | None:
        return None

    def _set_alarm(self, us: int | None) -> None:
        if us is None:
            return
        at = us // 1000 + 1
        if self.alarm.exists():
            old = self.alarm.get()[0]
            if old <= at:
                return
            self.handle.deleteTimer(old)
        self.handle.registerTimer(at)
        self.alarm.update((at,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        earliest = None
        while block := [(r["us"], r["event_id"], r["kind"]) for r in islice(rows, BLOCK)]:
            self.pending.appendList(block)
            first = min(block)[0]
            earliest = first if earliest is None else min(earliest, first)
        self._set_alarm(earliest)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        self.alarm.clear()
        before = list(self.waiting.get()) if self.waiting.exists() else []
        self.held = list(before)
        rows = sorted(self.pending.get()) if self.pending.exists() else []
        ready = [r for r in rows if r[0] < now]
        later = rows[len(ready):]
        for us, _, kind in ready:
            for out in self.on_row(us, kind):
                yield self.row(*key, *out)
        for out in self.on_time(now):
            yield self.row(*key, *out)
        if self.held and self.held != before:
            self.waiting.put(self.held)
        elif before and not self.held:
            self.waiting.clear()
        if later:
            self.pending.put(later)
        else:
            self.pending.clear()
        ends = [t for t in (later[0][0] if later else None, self.next_end()) if t is not None]
        self._set_alarm(min(ends) if ends else None)


class FollowedBy(InOrder):
    """``start`` rows wait for the next ``then`` row of their key; see ``patterns.followed_by``."""

    schema, times = PAIR, ("start_ts", "end_ts")

    def __init__(self, within: int) -> None:
        self.within = within

    def on_time(self, now: int) -> Iterator[tuple]:
        # A follower at the very end of the wait is too late, so the wait is over by then.
        over = [r for r in self.held if r[0] + self.within <= now]
        self.held = self.held[len(over):]
        for us, _ in over:
            yield us, us + self.within, "timeout"

    def on_row(self, us: int, kind: str) -> Iterator[tuple]:
        yield from self.on_time(us)
        if kind == "start":
            self.held.append((us, kind))
        else:
            for start, _ in self.held:
                yield start, us, "match"
            self.held = []

    def next_end(self) -> int | None:
        return self.held[0][0] + self.within if self.held else None


class Repeated(InOrder):
    """``times`` adjacent rows of kind ``hit``; see ``patterns.repeated``."""

    schema, times = PAIR, ("start_ts", "end_ts")

    def __init__(self, times: int, within: int) -> None:
        self.n, self.within = times, within

    def on_row(self, us: int, kind: str) -> Iterator[tuple]:
        if kind != "hit":
            self.held = []
            return
        if len(self.held) == self.n - 1 and us - self.held[0][0] < self.within:
            yield self.held[0][0], us, "match"
        self.held = [*self.held, (us, kind)][-(self.n - 1):]


class Reconcile(InOrder):
    """One waiting row per key; see ``joins.reconcile``. The state is cleared as a row leaves it."""

    schema = "left_ts BIGINT, right_ts BIGINT, outcome STRING"
    times = ("left_ts", "right_ts")

    def __init__(self, wait_right: int, wait_left: int) -> None:
        self.wait = {"left": wait_right, "right": wait_left}

    @staticmethod
    def _single(us: int, kind: str) -> tuple:
        return (us, None, "left_only") if kind == "left" else (None, us, "right_only")

    def on_row(self, us: int, kind: str) -> Iterator[tuple]:
        for since, side in self.held:
            if side != kind and us <= since + self.wait[side]:
                yield (since, us, "matched") if side == "left" else (us, since, "matched")
                self.held = []
                return
            yield self._single(since, side)
        self.held = [(us, kind)]

    def on_time(self, now: int) -> Iterator[tuple]:
        for since, side in self.held:
            if since + self.wait[side] < now:
                yield self._single(since, side)
                self.held = []

    def next_end(self) -> int | None:
        return self.held[0][0] + self.wait[self.held[0][1]] if self.held else None


class CountTumbling(InOrder):
    """One result per ``size`` rows of a key; ``kind`` carries the number to add up."""

    schema = "group_no BIGINT, ct BIGINT, total BIGINT"

    def __init__(self, size: int) -> None:
        self.size = size

    def on_row(self, us: int, kind: str) -> Iterator[tuple]:
        # The first pair counts the groups given so far.
        (done, _), *rows = [*(self.held or [(0, "groups")]), (us, kind)]
        if len(rows) == self.size:
            yield done, len(rows), sum(int(v) for _, v in rows)
            done, rows = done + 1, []
        self.held = [(done, "groups"), *rows]


class CountChanges(InOrder):
    """The changelog of a count; see ``changelog.count_changes``."""

    schema, times = "ts BIGINT, op BOOLEAN, ct BIGINT", ("ts",)

    def on_row(self, us: int, kind: str) -> Iterator[tuple]:
        n = self.held[0][0] if self.held else 0
        if n:
            yield us, False, n
        yield us, True, n + 1
        self.held = [(n + 1, "rows")]


def _columns(schema: str) -> list[str]:
    return [f.split(" ")[0] for f in schema.split(", ")]


def in_order(df: DataFrame, key: str, kind: Column, processor: InOrder) -> DataFrame:
    """Run an :class:`InOrder` processor over a stream with a watermark on ``ts``.

    Rows whose ``kind`` is null play no part and are not shuffled. A key's rows newer than
    the watermark wait in its state, so limit the size of a batch when reading old data.
    """
    rows = df.select(key, "ts", F.unix_micros("ts").alias("us"), "event_id", kind.cast("string").alias("kind"))
    key_type = dict(df.dtypes)[key]
    processor.columns = [key, *_columns(processor.schema)]
    out = rows.where("kind IS NOT NULL").groupBy(key).transformWithState(
        processor, f"{key} {key_type}, {processor.schema}", "append", "EventTime"
    )
    return out.withColumns({n: F.timestamp_micros(F.col(n)).cast("timestamp_ntz") for n in processor.times})


class KeyTimers(Named):
    """An event-time timer ``delay_ms`` after each row; emits its time when it fires.

    A key's times wait in list state, up to ``BLOCK`` in a value. The store holds a timer for the next one alone;
    when it fires, all that are due are given out.
    """

    columns = ("id", "fired_ms")

    def __init__(self, delay_ms: int) -> None:
        self.delay_ms = delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "times BINARY")
        self.alarm = handle.getValueState("alarm", "at BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self.alarm.get()
        earliest = before[0] if before else None
        while block := [row["us"] // 1000 + self.delay_ms for row in islice(rows, BLOCK)]:
            times = np.unique(np.array(block, np.int64))
            self.waiting.appendValue((times.tobytes(),))
            earliest = int(times[0]) if earliest is None else min(earliest, int(times[0]))
        if before is None or earliest < before[0]:
            if before:
                self.handle.deleteTimer(before[0])
            self._wake(earliest)
        return iter(())

    def _wake(self, at: int) -> None:
        self.handle.registerTimer(at)
        self.alarm.update((at,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        times = np.unique(np.concatenate([np.frombuffer(block, np.int64) for (block,) in self.waiting.get()]))
        n = np.searchsorted(times, timerValues.getCurrentWatermarkInMs(), side="right")
        later = times[n:]
        if len(later):
            self.waiting.put([(later[i:i + BLOCK].tobytes(),) for i in range(0, len(later), BLOCK)])
            self._wake(int(later[0]))
        else:
            self.waiting.clear()
            self.alarm.clear()
        for at in times[:n].tolist():
            yield self.row(*key, at)


def counted(df: DataFrame, *keys: str) -> DataFrame:
    """Numbers ``n`` of rows by ``keys`` on a stream, to be added up: a task sends a row of a key per ``COUNTED`` rows, also of a hot one."""
    def folded(held: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        found = pa.Table.from_batches(held).group_by(list(keys)).aggregate([([], "count_all")])
        return found.select([*keys, "count_all"]).rename_columns([*keys, "n"]).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= COUNTED:
                yield from folded(held)
                held, size = [], 0
        if held:
            yield from folded(held)

    rows = df.select(*keys)
    return rows.mapInArrow(run, rows.withColumn("n", F.lit(0).cast("long")).schema)


class ClockTimer(Named):
    """A clock timer some time after a key's rows; counts the rows seen until it fires, or adds up what ``n`` says each stands for."""

    columns = ("id", "salt", "seen")

    def __init__(self, delay_ms: int, n: str | None = None) -> None:
        self.delay_ms, self.n = delay_ms, n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "n BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self.seen.get()
        self.seen.update(((before[0] if before else 0) + sum(r[self.n] if self.n else 1 for r in rows),))
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.delay_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.seen.exists():
            yield self.row(*key, self.seen.get()[0])
            self.seen.clear()


class ClockWindow(Named):
    """Adds up the ``n`` of a key and window; the window is given out and forgotten when the clock passes its end."""

    columns = ("id", "salt", "window_ms", "ct")

    def __init__(self, size_ms: int) -> None:
        self.size_ms = size_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", "n BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self.count.get()
        self.count.update(((before[0] if before else 0) + sum(r["n"] for r in rows),))
        if before is None:
            self.handle.registerTimer(key[2] + self.size_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield self.row(*key, self.count.get()[0])
        self.count.clear()


class ClockSession(Named):
    """Counts the rows of a key until none has come for ``gap_ms``; then the session is given out and forgotten."""

    columns = ("id", "salt", "start_ms", "ct")

    def __init__(self, gap_ms: int) -> None:
        self.gap_ms = gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.session = handle.getValueState("session", "start BIGINT, last BIGINT, n BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now, before = timerValues.getCurrentProcessingTimeInMs(), self.session.get()
        start, last, n = before or (now, None, 0)
        if last is not None:
            self.handle.deleteTimer(last + self.gap_ms)
        self.session.update((start, now, n + sum(1 for _ in rows)))
        self.handle.registerTimer(now + self.gap_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        start, _, n = self.session.get()
        self.session.clear()
        yield self.row(*key, start, n)


def clock_windows(df: DataFrame, key: str, size_ms: int, slide_ms: int | None = None, salts: int = 1) -> DataFrame:
    """Tumbling or sliding windows of a stream by the clock of its micro-batches, without a watermark: counts per
    ``id``, ``salt`` and ``window_ms``, the window's start. Rows are counted in their tasks before they are shuffled and copied to
    windows, so a hot key needs no ``salts``; with more than one, add up its parts."""
    slide = slide_ms or size_ms
    latest = F.floor(F.unix_millis(F.current_timestamp()) / slide) * slide  # the same for a whole batch, also if it runs again
    starts = F.transform(F.sequence(F.lit(0), F.lit(size_ms // slide - 1)), lambda i: latest - i * slide)
    salt = F.pmod(F.hash("event_id"), F.lit(salts)) if salts > 1 else F.lit(0)
    rows = counted(df.select(F.col(key).alias("id"), salt.alias("salt")), "id", "salt")
    placed = rows.select("id", "salt", "n", F.explode(starts).alias("window_ms"))
    return placed.groupBy("id", "salt", "window_ms").transformWithState(
        ClockWindow(size_ms), f"id {dict(df.dtypes)[key]}, salt INT, window_ms BIGINT, ct BIGINT", "append", "ProcessingTime")


def clock_sessions(df: DataFrame, key: str, gap_ms: int) -> DataFrame:
    """Sessions of a stream by the clock: counts per ``id`` and ``start_ms``. A key is not spread, since any of its rows goes on with its session."""
    placed = df.select(F.col(key).alias("id"), F.lit(0).alias("salt"))
    return placed.groupBy("id", "salt").transformWithState(
        ClockSession(gap_ms), f"id {dict(df.dtypes)[key]}, salt INT, start_ms BIGINT, ct BIGINT", "append", "ProcessingTime")


class SeenBits(Named):
    """A page of a window's bitmap: gives out each row whose bit is not set yet, at once, and drops the page when the window ends."""

    columns = ("window_ms", "page", "event_id", "bit")

    def __init__(self, size_ms: int) -> None:
        self.size_ms = size_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.page = handle.getValueState("page", "bits BINARY")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self.page.get()
        bits, fresh = bytearray(before[0]) if before else bytearray(PAGE_BITS // 8), False
        for r in rows:
            byte, mask = r["bit"] >> 3, 1 << (r["bit"] & 7)
            if not bits[byte] & mask:
                bits[byte] |= mask
                fresh = True
                yield self.row(*key, r["event_id"], r["bit"])
        if before is None:
            self.handle.registerTimer(key[0] + self.size_ms)
        if fresh:
            self.page.update((bytes(bits),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.page.clear()
        return iter(())


def first_bits(df: DataFrame, ts: str, size_ms: int, offset: Column) -> DataFrame:
    """The first row of each bit of a window's bitmap on a stream with a watermark, as it comes: ``window_ms``, ``event_id``, ``bit``.

    The bitmap lies in pages of ``PAGE_BITS`` bits, each the state of its own key, of which a batch reads and writes those it
    touches. Rows that repeat a bit within a block of a task are dropped before the shuffle, so a hot user sends a row per block.
    """
    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = np.stack([batch.column("window_ms").to_numpy(), batch.column("offset").to_numpy()], axis=1)
            _, first = np.unique(pairs, axis=0, return_index=True)
            yield batch.take(pa.array(np.sort(first)))

    placed = df.select(ts, (F.floor(F.unix_millis(ts) / size_ms) * size_ms).alias("window_ms"), offset.cast("long").alias("offset"), "event_id")
    # The map keeps the event time's watermark only on the stream itself, so it comes before.
    kept = placed.where("offset IS NOT NULL").mapInArrow(once, placed.schema)
    paged = kept.select("window_ms", F.floor(F.col("offset") / PAGE_BITS).alias("page"), F.pmod("offset", F.lit(PAGE_BITS)).cast("int").alias("bit"), "event_id", ts)
    seen = paged.groupBy("window_ms", "page").transformWithState(
        SeenBits(size_ms), "window_ms BIGINT, page BIGINT, event_id BIGINT, bit INT", "append", "EventTime")
    return seen.select("window_ms", "event_id", (F.col("page") * PAGE_BITS + F.col("bit")).alias("bit"))


class Stateful(Named):
    """State updated by each row; emits what changed after each batch of rows."""

    schema = ""


class LastValue(Stateful):
    """Value state: the value that arrived last."""

    schema = "arrival BIGINT, vc BIGINT"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("last", self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last = self.state.get() if self.state.exists() else None
        for row in rows:
            if last is None or row["event_id"] > last[0]:
                last = (row["event_id"], row["vc"])
        self.state.update(tuple(last))
        yield self.row(*key, *last)


class Collected(Stateful):
    """List state: every value, kept; emits what is new, in blocks, not the list."""

    schema = "contents ARRAY<BIGINT>"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getListState("values", "vc BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        while block := [(r["vc"],) for r in islice(rows, BLOCK)]:
            self.state.appendList(block)
            yield self.row(*key, [vc for (vc,) in block])


class Cleared(Stateful):
    """Value state that an event clears: the value since, or none."""

    schema = "arrival BIGINT, vc BIGINT"

    def __init__(self, clears: str) -> None:
        self.clears = clears

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("value", self.schema)
        self.last = handle.getValueState("last", "arrival BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # Whatever came before, the last row alone decides: it clears the value or sets it.
        seen = self.last.get()
        arrival, kind, vc = max((r["event_id"], r["event_type"], r["vc"]) for r in rows)
        if seen is None or arrival > seen[0]:
            self.last.update((arrival,))
            if kind == self.clears:
                self.state.clear()
            else:
                self.state.update((arrival, vc))
        value = self.state.get()
        yield self.row(*key, self.last.get()[0], value[1] if value else None)


class CountByField(Stateful):
    """Map state: a count per sub-key, of rows from :func:`counted`."""

    schema = "event_type STRING, ct BIGINT"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getMapState("counts", "event_type STRING", "ct BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        counts, more = {tuple(sub): n[0] for sub, n in self.state.iterator()}, Counter()
        for row in rows:
            more[(row["event_type"],)] += row["n"]
        for sub, n in more.items():
            counts[sub] = counts.get(sub, 0) + n
            self.state.updateValue(sub, (counts[sub],))
        for (sub,), n in counts.items():
            yield self.row(*key, sub, n)


class Reduced(Stateful):
    """Reducing state: the newest time with the oldest value."""

    schema = "first_arrival BIGINT, vc BIGINT, last_arrival BIGINT, us BIGINT"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("reduced", self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        acc = tuple(self.state.get()) if self.state.exists() else None
        for row in rows:
            at = row["event_id"]
            first = (at, row["vc"]) if acc is None or at < acc[0] else acc[:2]
            last = (at, row["us"]) if acc is None or at > acc[2] else acc[2:]
            acc = (*first, *last)
        self.state.update(acc)
        yield self.row(*key, *acc)


class Averaged(Stateful):
    """Aggregating state: the accumulator of an average."""

    schema = "total BIGINT, n BIGINT"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("acc", self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        total, n = self.state.get() if self.state.exists() else (0, 0)
        for row in rows:
            total, n = total + row["vc"], n + 1
        self.state.update((total, n))
        yield self.row(*key, total, n)


class Counting(Stateful):
    """Value state: a count, which may start from what another query has left."""

    schema = "ct BIGINT"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("ct", self.schema)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.state.update((initialState["ct"],))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self.state.get()
        n = (before[0] if before else 0) + sum(1 for _ in rows)
        self.state.update((n,))
        yield self.row(*key, n)


class Expiring(Stateful):
    """Value state that is forgotten ``ttl_ms`` after its last write."""

    schema = "ct BIGINT"

    def __init__(self, ttl_ms: int) -> None:
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("ct", self.schema, ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        n = self.state.get()[0] if self.state.exists() else 0
        n += sum(1 for _ in rows)
        self.state.update((n,))
        yield self.row(*key, n)


def salted_state(
    df: DataFrame, key: str, processor: Stateful, salts: int = 8, time_mode: str = "None", initial: DataFrame | None = None
) -> DataFrame:
    """State per (key, salt), in update mode. Merge the parts of a key when reading. Rows from :func:`counted` need one salt.

    ``initial`` has the columns of key, salt and state, as from :func:`stored_state`; a new query starts from it.
    """
    spread = df.withColumn("salt", F.pmod(F.hash("event_id"), F.lit(salts)) if salts > 1 else F.lit(0))
    key_type = dict(df.dtypes)[key]
    processor.columns = [key, "salt", *_columns(processor.schema)]
    return spread.groupBy(key, "salt").transformWithState(
        processor, f"{key} {key_type}, salt INT, {processor.schema}", "update", time_mode,
        initialState=None if initial is None else initial.groupBy(key, "salt"),
    )


def stored_state(spark: SparkSession, checkpoint: str, variable: str) -> DataFrame:
    """The value state of a query that has ended, from its checkpoint: the columns of key and value."""
    kept = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", variable).load()
    return kept.select("key.*", "value.*")

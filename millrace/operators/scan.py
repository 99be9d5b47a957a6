"""Running values per key, in an order, without a whole key in one task.

``Window.partitionBy(key)`` sends each key to a single task, and without a key the whole
table. :func:`keyed_scan` gives the same rows, but first cuts any key that is too big into
chunks of its order:

1. the rows are counted, which for a stored table reads no column: if they are not above ``hot_rows``, no key is.
   Otherwise a count-min sketch of ``BUCKETS`` counters, by hash of the key, rules out the keys of all small counters, and
   the others are counted exactly. Hot keys get cut points from a sample of their order columns, picked by
   hash. The choice moves work between tasks and never changes a result;
2. each row of a hot key is given its chunk: the key's range is parted into equal steps, and a second join says how many
   cuts lie before the row's step and which in it, mostly one or none; a row carries only those;
3. aggregate each (key, chunk), and carry the aggregate of the earlier chunks forward;
4. run the window inside each (key, chunk) and merge the carry into its result.

There is a cut point for about every ``hot_rows`` rows of a hot key, and ``MAX_CUTS`` in all; beyond that
chunks grow with the input. So the cuts and the carries, the only broadcast tables, are bounded.
Keys below ``hot_rows`` are one chunk and carry nothing. Without a key the sample is ``SAMPLES_PER_CUT`` rows a
cut, whatever the input, since its share follows from the count of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT_ROWS = 4_000_000  # rows of one key that one task may hold
SAMPLES_PER_CUT = 32
CHUNK_ROWS = 1000  # without a key: rows that are worth a task of their own
MAX_CUTS = 65_536
BUCKETS = 65_536  # counters of the sketch of keys
STEPS_PER_CUT = 2

CHUNK = "_chunk"
_SLOT = "_scan_slot"
_SLOT_COLUMNS = (_SLOT, "_scan_low", "_scan_scale", "_scan_steps")
_STEP_COLUMNS = ("_scan_of", "_scan_nth", "_scan_first", "_scan_within")
_UNBOUNDED = Window.unboundedPreceding


@dataclass(frozen=True)
class Running:
    """One running output.

    ``over`` gives the value within a window, ``partial`` the aggregate of a whole chunk,
    ``fold`` combines the partials of earlier chunks, ``finish`` merges that carry (or None)
    with the windowed value. ``tail`` asks for a flag on each chunk's last rows.
    """

    name: str
    over: Callable[[WindowSpec], Column]
    partial: Callable[[Column, bool], Column]
    fold: Callable[[Column, WindowSpec], Column]
    finish: Callable[[Column | None, Column], Column]
    tail: int = 0


def _frame(w: WindowSpec, inclusive: bool) -> WindowSpec:
    return w.rowsBetween(_UNBOUNDED, 0 if inclusive else -1)


def _before(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(_UNBOUNDED, -1)


def _either(carry: Column | None, inner: Column, both: Callable[[Column, Column], Column]) -> Column:
    if carry is None:
        return inner
    return F.when(carry.isNull(), inner).when(inner.isNull(), carry).otherwise(both(carry, inner))


def running_sum(name: str, col: Column) -> Running:
    return Running(
        name,
        over=lambda w: F.sum(col).over(_frame(w, True)),
        partial=lambda pos, reverse: F.sum(col),
        fold=lambda part, w: F.sum(part).over(_before(w)),
        finish=lambda carry, inner: _either(carry, inner, lambda a, b: a + b),
    )


def running_count(name: str, col: Column | None = None) -> Running:
    counted = F.lit(1) if col is None else col
    return Running(
        name,
        over=lambda w: F.count(counted).over(_frame(w, True)),
        partial=lambda pos, reverse: F.count(counted),
        fold=lambda part, w: F.sum(part).over(_before(w)),
        finish=lambda carry, inner: _either(carry, inner, lambda a, b: a + b),
    )


def running_max(name: str, col: Column, inclusive: bool = True) -> Running:
    """Largest non-null value so far; structs compare field by field."""
    return Running(
        name,
        over=lambda w: F.max(col).over(_frame(w, inclusive)),
        partial=lambda pos, reverse: F.max(col),
        fold=lambda part, w: F.max(part).over(_before(w)),
        finish=lambda carry, inner: _either(carry, inner, F.greatest),
    )


def running_first(name: str, col: Column) -> Running:
    """The value on the key's first row, null or not."""
    boxed = F.struct(col.alias("v"))
    return Running(
        name,
        over=lambda w: F.first(boxed).over(_frame(w, True)),
        partial=lambda pos, reverse: F.max_by(boxed, pos) if reverse else F.min_by(boxed, pos),
        fold=lambda part, w: F.first(part).over(_before(w)),
        finish=lambda carry, inner: (inner if carry is None else F.coalesce(carry, inner))["v"],
    )


def running_last(name: str, col: Column, inclusive: bool = True) -> Running:
    """The latest non-null value so far."""
    def partial(pos: Column, reverse: bool) -> Column:
        at = F.when(col.isNotNull(), pos)
        return F.min_by(col, at) if reverse else F.max_by(col, at)

    return Running(
        name,
        over=lambda w: F.last(col, ignorenulls=True).over(_frame(w, inclusive)),
        partial=partial,
        fold=lambda part, w: F.last(part, ignorenulls=True).over(_before(w)),
        finish=lambda carry, inner: inner if carry is None else F.coalesce(inner, carry),
    )


def previous_rows(name: str, row: Column, n: int) -> Running:
    """Array of up to ``n`` rows before this one, oldest first. ``row`` is a struct."""
    def partial(pos: Column, reverse: bool) -> Column:
        kept = F.collect_list(F.when(F.col(_tail(n)), F.struct(pos.alias("p"), row.alias("r"))))
        return F.sort_array(kept, asc=not reverse)["r"]

    def finish(carry: Column | None, inner: Column) -> Column:
        if carry is None:
            return inner
        rows = F.concat(carry, inner)
        latest = F.when(F.size(rows) > n, F.slice(rows, -n, n)).otherwise(rows)
        return F.when(carry.isNull(), inner).otherwise(latest)

    return Running(
        name,
        over=lambda w: F.filter(
            F.array(*[F.lag(row, i).over(w) for i in range(n, 0, -1)]), lambda r: r.isNotNull()
        ),
        partial=partial,
        # Every chunk has a row, so the last n chunks hold the last n rows.
        fold=lambda part, w: F.flatten(F.collect_list(part).over(w.rowsBetween(-n, -1))),
        finish=finish,
        tail=n,
    )


def _tail(n: int) -> str:
    return f"_tail{n}"


def _position(order: Sequence[str]) -> Column:
    if len(order) == 1:
        return F.col(order[0])
    return F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])


def _null_safe(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])


@dataclass(frozen=True)
class Cuts:
    """Cut points of hot keys: ``slots`` numbers the keys and gives the steps of their ranges, ``steps`` has the cuts by slot and step.

    Without a key there is one slot, and ``whole`` has its steps: start, steps per unit and number.
    """

    slots: DataFrame
    steps: DataFrame
    whole: tuple[float, float, int]


def cut_points(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], hot_rows: int | None = None, bound: DataFrame | None = None
) -> Cuts | None:
    """Cut points of the hot keys; None when no key needs cutting.

    ``bound`` is a table with no fewer rows that is cheaper to count. Give the result to :func:`keyed_scan` as ``cuts``
    when several scans go over the same rows.
    """
    limit = hot_rows or HOT_ROWS
    least = limit if keys else min(limit, CHUNK_ROWS)
    if bound is not None and bound.count() <= least:
        return None
    total = df.count()
    if total <= least:
        return None
    rows = df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], _position(order).alias("_at"), _leading(df, order[0]).alias("_lead"))
    names = [f"_k{i}" for i in range(len(keys))]
    return _keyed_cuts(rows, names, total, limit) if keys else _global_cuts(rows, total, limit)


def _keyed_cuts(rows: DataFrame, names: Sequence[str], total: int, limit: int) -> Cuts | None:
    spark = rows.sparkSession
    # A counter holds total / BUCKETS rows of small keys; one key must stand out from that.
    limit = max(limit, 4 * total // BUCKETS)
    bucket = F.pmod(F.xxhash64(*names), F.lit(BUCKETS))
    full = rows.groupBy(bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
    full = [r["_b"] for r in full.select("_b").collect()]  # less than a quarter of BUCKETS
    if not full:
        return None
    step = max(1, limit // SAMPLES_PER_CUT)
    buckets = spark.createDataFrame([(b,) for b in full], "_full BIGINT")
    possible = rows.withColumn("_b", bucket).join(F.broadcast(buckets), F.col("_b") == F.col("_full"), "left_semi")
    picked = F.when(F.pmod(F.xxhash64("_at"), F.lit(step)) == 0, F.struct("_at", "_lead"))
    counts = possible.groupBy(*names, picked.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.groupBy(*names).agg(F.sum("_n").alias("_n"), F.sort_array(F.collect_list("_p")).alias("_points")).where(F.col("_n") > limit)
    thin = max(1, limit // step)
    found = hot.select(*names, F.filter("_points", lambda x, i: (i % thin) == thin - 1).alias("_points"))
    # A point per hot_rows rows; a local copy keeps the cuts the same for every reader.
    return _cuts(found, [r for r in found.collect() if r["_points"]])


def _global_cuts(rows: DataFrame, total: int, limit: int) -> Cuts | None:
    """Cuts of the whole table, from a sample that is the same size for any table."""
    tasks = max(1, rows.sparkSession.sparkContext.defaultParallelism)
    size = min(limit, max(CHUNK_ROWS, total // tasks))
    wanted = min(-(-total // size), MAX_CUTS)
    step = max(1, total // (wanted * SAMPLES_PER_CUT))
    sample = rows.where(F.pmod(F.xxhash64("_at"), F.lit(step)) == 0)
    nth = F.row_number().over(Window.orderBy("_at"))  # SAMPLES_PER_CUT rows a cut
    every = max(1, total // (step * wanted))
    kept = sample.withColumn("_nth", nth).where(F.col("_nth") % every == 0).orderBy("_at")
    points = [r["_p"] for r in kept.select(F.struct("_at", "_lead").alias("_p")).collect()]
    kind = T.StructType([T.StructField("_points", T.ArrayType(kept.select(F.struct("_at", "_lead").alias("_p")).schema["_p"].dataType))])
    return _cuts(rows.sparkSession.createDataFrame([], kind), [(points,)]) if points else None


def _cuts(shape: DataFrame, found: list) -> Cuts | None:
    """The tables of cuts from rows of keys and sorted points; ``shape`` has their columns."""
    spark = shape.sparkSession
    if not found:
        return None
    every = -(-sum(len(r[-1]) for r in found) // MAX_CUTS)
    slots, steps = [], []
    for slot, r in enumerate(found):
        points = r[-1][every - 1::every]
        low, scale, n = _steps([p["_lead"] for p in points])
        slots.append((*r[:-1], slot, low, scale, n))
        places, first = [_step(p["_lead"], low, scale, n) for p in points], 0
        for step in range(n + 2):
            last = first
            while last < len(points) and places[last] == step:
                last += 1
            steps.append((slot, step, first, [p["_at"] for p in points[first:last]]))
            first = last
    number, real = T.IntegerType(), T.DoubleType()
    at = shape.schema["_points"].dataType.elementType["_at"].dataType
    slot_schema = T.StructType([*shape.schema.fields[:-1], *[T.StructField(n, t) for n, t in zip(_SLOT_COLUMNS, (number, real, real, number))]])
    step_schema = T.StructType([T.StructField(n, t) for n, t in zip(_STEP_COLUMNS, (number, number, number, T.ArrayType(at)))])
    return Cuts(
        spark.createDataFrame(slots, slot_schema, verifySchema=False), spark.createDataFrame(steps, step_schema, verifySchema=False),
        slots[0][-3:])


def _steps(leads: Sequence[float | None]) -> tuple[float, float, int]:
    """Equal steps over the range of some sorted values: start, steps per unit and number."""
    known = [x for x in leads if x is not None and abs(x) < float("inf")]
    low, high = (known[0], known[-1]) if known else (0.0, 0.0)
    n = STEPS_PER_CUT * max(1, len(leads))
    return low, n / (high - low) if high > low and n / (high - low) < float("inf") else 0.0, n


def _step(x: float | None, low: float, scale: float, n: int) -> int:
    """The same as in :func:`_with_chunks`: 0 below the range, 1 to n in it, n + 1 at its end and above."""
    if x is None or x < low:
        return 0
    place = (x - low) * scale if x < float("inf") else float("inf")
    return 1 + int(min(place, n)) if place == place else 1


def _leading(df: DataFrame, name: str) -> Column:
    """A number that never falls along a column's order; null comes first, as in the order."""
    kind, col = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(F.isnan(col), F.lit(float("inf"))).otherwise(col.cast("double"))
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return col.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col).cast("double")
    if isinstance(kind, T.TimestampNTZType):  # by its fields, in no zone
        days, seconds = F.unix_date(col.cast("date")), F.hour(col) * 3600 + F.minute(col) * 60 + F.second(col)
        return (days.cast("double") * 86_400 + seconds)
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(col.cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")
    return F.when(col.isNotNull(), F.lit(0.0))


def chunked(df: DataFrame, keys: Sequence[str], order: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """Add ``_chunk``: null for ordinary keys, 0, 1, .. along ``order`` within a hot key.

    ``order`` must tell the rows of a key apart; its hash picks the sample for the cuts.
    """
    cuts = cut_points(df, keys, order, hot_rows)
    if cuts is None:
        return df.withColumn(CHUNK, F.lit(None).cast("int"))
    return _with_chunks(df, keys, order, cuts)


def _with_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str], cuts: Cuts) -> DataFrame:
    if keys:
        pairs = [(k, f"_k{i}") for i, k in enumerate(keys)]
        joined = df.join(F.broadcast(cuts.slots), _null_safe(df, cuts.slots, pairs), "left")
    else:
        joined = df.withColumns(dict(zip(_SLOT_COLUMNS, map(F.lit, (0, *cuts.whole)))))
    here, lead, n = _position(order), _leading(df, order[0]), F.col("_scan_steps").cast("double")
    place = F.when(lead == float("inf"), n).otherwise(F.nanvl((lead - F.col("_scan_low")) * F.col("_scan_scale"), F.lit(0.0)))
    step = F.when(lead.isNull() | (lead < F.col("_scan_low")), 0).otherwise(1 + F.least(place, n).cast("int"))
    placed = joined.withColumn("_scan_step", F.when(F.col(_SLOT).isNotNull(), step))
    found = placed.join(F.broadcast(cuts.steps), (F.col(_SLOT) == F.col("_scan_of")) & (F.col("_scan_step") == F.col("_scan_nth")), "left")
    chunk = F.col("_scan_first") + _below(F.col("_scan_within"), here)
    return found.select(*[df[c] for c in df.columns], chunk.alias(CHUNK))


def _below(points: Column, here: Column) -> Column:
    """How many of some sorted points are less than ``here``, mostly of none or one; no lambda, so that it is compiled with the joins."""
    n = F.size(points)
    place = F.array_position(F.sort_array(F.concat(points, F.array(here))), here).cast("int") - 1
    one = F.when(F.get(points, F.lit(0)) < here, 1).otherwise(0)
    return F.when(n == 0, 0).when(n == 1, one).when(here.isNull(), 0).otherwise(place)


def keyed_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *outputs: Running,
    reverse: bool = False,
    hot_rows: int | None = None,
    cuts: Cuts | str | None = "find",
    bound: DataFrame | None = None,
) -> DataFrame:
    """``df`` with each running output added, per ``keys`` along ``order`` (or against it).

    ``keys`` may be empty: the scan then runs over the whole table. ``order`` must tell the
    rows of a key apart. ``hot_rows`` overrides the size at which a key is cut; ``cuts``
    takes what :func:`cut_points` found before; ``bound`` is as there.
    """
    keys, order = list(keys), list(order)
    directed = [F.col(c).desc() if reverse else F.col(c).asc() for c in order]
    if cuts == "find":
        cuts = cut_points(df, keys, order, hot_rows, bound)
    if cuts is None:
        w = Window.partitionBy(*keys).orderBy(*directed)
        return df.select("*", *[o.finish(None, o.over(w)).alias(o.name) for o in outputs])

    rows = _with_chunks(df, keys, order, cuts)
    w = Window.partitionBy(*keys, CHUNK).orderBy(*directed)
    names = {k: f"_c{i}" for i, k in enumerate([*keys, CHUNK])}
    hot = rows.where(F.col(CHUNK).isNotNull())
    tails = {o.tail for o in outputs if o.tail}
    if tails:
        hot = hot.withColumns({_tail(n): F.lead(F.lit(1), n).over(w).isNull() for n in tails})
    parts = hot.groupBy(*[F.col(k).alias(c) for k, c in names.items()]).agg(
        *[o.partial(_position(order), reverse).alias(f"_p{i}") for i, o in enumerate(outputs)]
    )
    chunk = F.col(names[CHUNK])
    wc = Window.partitionBy(*[names[k] for k in keys]).orderBy(chunk.desc() if reverse else chunk.asc())
    carry = parts.select(
        *names.values(), *[o.fold(F.col(f"_p{i}"), wc).alias(f"_f{i}") for i, o in enumerate(outputs)]
    )
    windowed = rows.select("*", *[o.over(w).alias(f"_w{i}") for i, o in enumerate(outputs)])
    joined = windowed.join(F.broadcast(carry), _null_safe(windowed, carry, list(names.items())), "left")
    return joined.select(
        *[windowed[c] for c in df.columns],
        *[o.finish(F.col(f"_f{i}"), F.col(f"_w{i}")).alias(o.name) for i, o in enumerate(outputs)],
    )

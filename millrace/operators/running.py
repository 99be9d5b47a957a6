"""Running and final keyed aggregates outside windows.

Every input row gives one updated row. ``order`` is the arrival order of the rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import scan

NAN = float("nan")  # one object, so that a dict finds it again


def final_count(df: DataFrame, *keys: str, name: str = "ct") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def salted_agg(df: DataFrame, keys: Sequence[Column], salt: Column, partial: list[Column], final: list[Column]):
    """Aggregate per (keys, salt) first and per keys after, so a hot key is split."""
    names = [f"_g{i}" for i in range(len(keys))]
    first = df.groupBy(*[k.alias(n) for k, n in zip(keys, names)], salt.alias("_salt")).agg(*partial)
    return first.groupBy(*names).agg(*final)


def running_max(df: DataFrame, key: str, col: str, frozen: Sequence[str], order: Sequence[str], **kw) -> DataFrame:
    """Running maximum of one field; the other fields stay those of the key's first row."""
    return scan.keyed_scan(
        df, [key], order,
        scan.running_max(f"max_{col}", F.col(col)),
        *[scan.running_first(f"first_{c}", F.col(c)) for c in frozen], **kw,
    )


def running_max_row(
    df: DataFrame, key: str, col: str, keep: Sequence[str], arrival: str, first: bool = False, **kw
) -> DataFrame:
    """The row holding the maximum so far; on a tie the newer row, or the older if ``first``."""
    place = -F.col(arrival) if first else F.col(arrival)
    best = F.struct(F.col(col).alias("m"), place.alias("a"), *[F.col(c) for c in keep])
    rows = scan.keyed_scan(df, [key], [arrival], scan.running_max("_best", best), **kw)
    return rows.select(*df.columns, F.col("_best.m").alias(f"max_{col}"), *[
        F.col(f"_best.{c}").alias(f"max_{c}") for c in keep
    ])


def running_reduce(df: DataFrame, key: str, latest: str, largest: str, order: Sequence[str], **kw) -> DataFrame:
    """Fold rows of a key into one: latest of one field, largest of another."""
    return scan.keyed_scan(
        df, [key], order,
        scan.running_last(f"last_{latest}", F.col(latest)),
        scan.running_max(f"max_{largest}", F.col(largest)), **kw,
    )


def running_total(df: DataFrame, order: Sequence[str], name: str = "seen", **kw) -> DataFrame:
    """How many rows have arrived in all, at each row."""
    return scan.keyed_scan(df, [], order, scan.running_count(name), **kw)


def user_aggregate(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    create: Callable[[], Any],
    add: Callable[[Any, pd.DataFrame], Any],
    merge: Callable[[Any, Any], Any],
    result: Callable[[Any], Any],
    name: str = "result",
    type_: str = "double",
    flush: int = 100_000,
) -> DataFrame:
    """A user aggregate from create / add / merge / result functions.

    Each task folds its rows into one accumulator per key before anything is shuffled, so a
    hot key reaches the merge as one row per task. Accumulators travel pickled; ``flush``
    bounds how many a task holds. As in ``groupBy``, null is a key and NaN is another.
    """
    key_type = dict(df.dtypes)[key]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[Any, Any] = {}

        def packed(type_of_key: pa.DataType) -> pa.RecordBatch:
            accs = [pickle.dumps(a) for a in held.values()]
            return pa.RecordBatch.from_arrays([pa.array(held, type_of_key), pa.array(accs, pa.binary())], [key, "acc"])

        kind = None
        for batch in batches:
            kind = batch.schema.field(key).type
            frame = batch.to_pandas(integer_object_nulls=True)
            none = batch.column(key).is_null().to_numpy(zero_copy_only=False)
            for k, rows in frame[~none].groupby(key, dropna=False):
                k = NAN if k != k else k
                held[k] = add(held.get(k, create()), rows)
            if none.any():
                held[None] = add(held.get(None, create()), frame[none])
            if len(held) >= flush:
                yield packed(kind)
                held.clear()
        if held:
            yield packed(kind)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Partials come sorted by key, so one accumulator is held at a time.
        def rows(done: list[tuple]) -> pa.RecordBatch:
            ks, values = zip(*done)
            return pa.RecordBatch.from_arrays([pa.array(ks, kind), pa.array(values)], [key, name])

        current: tuple | None = None
        kind = None
        for batch in batches:
            kind, done = batch.schema.field(key).type, []
            for k, packed in zip(batch[key].to_pylist(), batch["acc"].to_pylist()):
                acc = pickle.loads(packed)
                if current is not None and (current[0] == k or current[0] != current[0] and k != k):
                    current = (k, merge(current[1], acc))
                    continue
                if current is not None:
                    done.append((current[0], result(current[1])))
                current = (k, acc)
            if done:
                yield rows(done)
        if current is not None:
            yield rows([(current[0], result(current[1]))])

    partials = df.select(key, *columns).mapInArrow(fold, f"{key} {key_type}, acc binary")
    sorted_ = partials.repartition(key).sortWithinPartitions(key)
    return sorted_.mapInArrow(finish, f"{key} {key_type}, {name} {type_}")

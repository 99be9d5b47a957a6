"""Row transforms: projection, splitting, filtering, unions and partition layout."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the suffix the mapping example appends.
MAP_SUFFIX = "-myMap"


def words(line: Column) -> Column:
    """Words of a line split on single spaces.

    Trailing empty words go, leading and inner ones stay; an empty line is one empty word
    and a line of spaces only has none.
    """
    kept = F.rtrim(line)
    return F.when((line != "") & (kept == ""), F.array().cast("array<string>")).otherwise(F.split(kept, " "))


def explode_words(df: DataFrame, line: str, *keep: str) -> DataFrame:
    """One row per word with its place in the line."""
    return df.select(*keep, F.posexplode(words(F.col(line))).alias("pos", "word"))


def append_suffix(df: DataFrame, col: str, suffix: str = MAP_SUFFIX) -> DataFrame:
    return df.withColumn(col, F.concat(col, F.lit(suffix)))


def map_with_resource(
    df: DataFrame,
    schema: str,
    setup: Callable[[], object],
    apply: Callable[[object, pd.DataFrame], pd.DataFrame],
    teardown: Callable[[object], None] = lambda resource: None,
) -> DataFrame:
    """Map batches with something opened once per task and closed whatever happens."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = setup()
        try:
            for batch in batches:
                yield apply(resource, batch)
        finally:
            teardown(resource)

    return df.mapInPandas(run, schema)


def split_output(df: DataFrame, condition: Column, main: list[Column], side: list[Column]):
    """Main and side output of one input; a row whose condition is null goes to neither."""
    return df.where(condition).select(*main), df.where(~condition).select(*side)


def connect(left: DataFrame, right: DataFrame, on_left: Column, on_right: Column, name: str) -> DataFrame:
    """Two differently typed inputs as one, each through its own expression."""
    return left.select(F.lit("left").alias("side"), on_left.alias(name)).unionByName(
        right.select(F.lit("right").alias("side"), on_right.alias(name))
    )


def by_key(df: DataFrame, n: int, *keys: str) -> DataFrame:
    return df.repartition(n, *keys)


def spread_random(df: DataFrame, n: int, seed: int = 0) -> DataFrame:
    return df.repartition(n, F.rand(seed))


def spread_evenly(df: DataFrame, n: int) -> DataFrame:
    return df.repartition(n)


def rescale(df: DataFrame, n: int) -> DataFrame:
    """Fewer partitions, merged locally without a shuffle."""
    return df.coalesce(n)


def replicate(df: DataFrame, n: int, consumer: str = "consumer") -> DataFrame:
    """Every row once for each of ``n`` consumers."""
    return df.withColumn(consumer, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def to_one(aggregated: DataFrame) -> DataFrame:
    """All rows in one partition: for results that are already aggregated."""
    return aggregated.repartition(1)

"""Unique visitors per window: exact, by bitmap position, by sketch, and running."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import scan
from millrace.operators.windows import BOUNDS, tumbling

# Bitmap size in bits, and the growth of the hash with each character.
BITMAP_BITS = 1 << 30
HASH_FACTOR = 32


def exact(df: DataFrame, ts: str, size: str, user: str) -> DataFrame:
    return tumbling(df, ts, size, [], F.count_distinct(user).alias("uv"))


def live_exact(df: DataFrame, ts: str, size: str, user: str) -> DataFrame:
    """Stream form: each user kept once per window, then counted; append mode."""
    first = df.select(F.window(ts, size).alias("window"), user).dropDuplicates(["window", user])
    return first.groupBy("window").agg(F.count(F.lit(1)).alias("uv")).select(
        F.col("window.start").alias(BOUNDS[0]), F.col("window.end").alias(BOUNDS[1]), "uv"
    )


def bitmap_offset(user: Column) -> Column:
    """The bit a user falls on. Only the last six characters reach it, so long ids collide."""
    codes = F.transform(F.split(user.cast("string"), ""), lambda c: F.ascii(c).cast("bigint"))
    # The low bits alone decide the result, so the sum is cut back at every step.
    return F.aggregate(codes, F.lit(0).cast("bigint"), lambda h, c: (h * HASH_FACTOR + c).bitwiseAND(BITMAP_BITS - 1))


def by_bitmap(df: DataFrame, ts: str, size: str, user: str) -> DataFrame:
    return tumbling(df, ts, size, [], F.count_distinct(bitmap_offset(F.col(user))).alias("uv"))


def by_sketch(df: DataFrame, ts: str, size: str, user: str, rsd: float = 0.02) -> DataFrame:
    return tumbling(df, ts, size, [], F.approx_count_distinct(user, rsd).alias("uv"))


def sketched(df: DataFrame, ts: str, size: str, user: str, bits: int = 14) -> DataFrame:
    """A mergeable sketch of the users of each window, for tables and streams; see :func:`rolled_up`."""
    return tumbling(df, ts, size, [], F.hll_sketch_agg(user, bits).alias("sketch"))


def rolled_up(sketches: DataFrame, size: str) -> DataFrame:
    """Users of longer windows from the stored sketches of shorter ones, without another look at the rows."""
    return tumbling(sketches, BOUNDS[0], size, [], F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("uv"))


def running(df: DataFrame, ts: str, size: str, user: str, arrival: str, **kw) -> DataFrame:
    """One row for each user first seen in a window, with the window's count so far."""
    first = df.groupBy(F.window(ts, size)["start"].alias(BOUNDS[0]), user).agg(F.min(arrival).alias(arrival))
    return scan.keyed_scan(first, [BOUNDS[0]], [arrival], scan.running_count("uv"), bound=df, **kw)

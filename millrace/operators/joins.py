"""Joins of two event streams on a key and a time interval."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import scan
from millrace.operators.eventtime import interval


def interval_join(
    left: DataFrame, right: DataFrame, key: tuple[str, str], times: tuple[str, str], before_s: int, after_s: int
) -> DataFrame:
    """Pairs with equal keys and ``left - before_s <= right <= left + after_s``, ends included.

    The key is refined by time buckets as long as the interval. A left row looks into the
    two buckets its interval can touch and a right row lives in one, so a hot key is spread
    over its time span and each pair is still found exactly once. Works on streams whose two
    sides have watermarks.
    """
    (lk, rk), (lt, rt) = key, times
    width = max(1, before_s + after_s)
    low = F.col(lt) - interval(f"{before_s} seconds")
    high = F.col(lt) + interval(f"{after_s} seconds")
    spread = left.withColumn("_bucket", F.explode(F.sequence(_bucket(low, width), _bucket(high, width))))
    placed = right.withColumn("_rbucket", _bucket(F.col(rt), width))
    on = (
        (F.col(lk) == F.col(rk))
        & (F.col("_bucket") == F.col("_rbucket"))
        & (F.col(rt) >= low)
        & (F.col(rt) <= high)
    )
    return spread.join(placed, on).drop("_bucket", "_rbucket")


def outer_interval_join(
    left: DataFrame, right: DataFrame, key: tuple[str, str], times: tuple[str, str], before_s: int, after_s: int
) -> DataFrame:
    """As :func:`interval_join`, with the rows of both sides that have no partner.

    On streams a row without a partner comes out when the watermark drops it from the join's state. A key is one task's: its
    time buckets would give a row without a partner once per bucket.
    """
    (lk, rk), (lt, rt) = key, times
    low = F.col(lt) - interval(f"{before_s} seconds")
    high = F.col(lt) + interval(f"{after_s} seconds")
    return left.join(right, (F.col(lk) == F.col(rk)) & (F.col(rt) >= low) & (F.col(rt) <= high), "full_outer")


def _bucket(ts: Column, width_s: int) -> Column:
    return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(width_s * 1_000_000))


def reconcile(
    left: DataFrame, right: DataFrame, key: str, ts: str, wait_right: str, wait_left: str, order: str, **kw
) -> DataFrame:
    """Match two streams one to one per key, and report what stays unmatched.

    A left row waits ``wait_right`` for a right row, a right row waits ``wait_left`` for a
    left one; each key holds one waiting row. In time order a row takes the waiting row of
    the other side if that is still in time. A waiting row that times out, or is replaced by
    a newer row of its own side, is unmatched. Every row ends in exactly one output row.

    Expressed as a scan: rows next to each other that fit form chains, and a chain pairs off
    from its start. No pairs beyond the matches are made, even for a repeated key. ``order``
    tells apart rows of a key at one time.
    """
    both = left.select(key, ts, order, F.lit(True).alias("_left")).unionByName(
        right.select(key, ts, order, F.lit(False).alias("_left"))
    )
    rows = chained(both, key, [ts, "_left", order], wait_right, wait_left, **kw)
    return outcomes(paired(rows, key, ts), key)


def chained(both: DataFrame, key: str, by: Sequence[str], wait_right: str, wait_left: str, **kw) -> DataFrame:
    """Rows of both sides with their number ``_rn`` in the key, and that of the row that begins their ``_pair``.

    ``by`` is the time, ``_left`` and the column that tells rows apart.
    """
    ts = by[0]
    cuts = scan.cut_points(both, [key], by, **kw)
    seen = scan.keyed_scan(
        both, [key], by,
        scan.running_count("_rn"), scan.previous_rows("_prev", F.struct("_left", ts), 1), cuts=cuts,
    )
    prev = F.get("_prev", F.lit(0))
    due = prev[ts] + F.when(prev["_left"], interval(wait_right)).otherwise(interval(wait_left))
    fits = F.coalesce((prev["_left"] != F.col("_left")) & (F.col(ts) <= due), F.lit(False))
    linked = scan.keyed_scan(
        seen.withColumn("_start", F.when(~fits, F.col("_rn"))).drop("_prev"), [key], by,
        scan.running_max("_chain", F.col("_start")), cuts=cuts,
    )
    return linked.withColumn("_pair", F.col("_rn") - (F.col("_rn") - F.col("_chain")) % 2).drop("_start", "_chain")


def paired(rows: DataFrame, key: str, ts: str) -> DataFrame:
    return rows.groupBy(key, "_pair").agg(
        F.max(F.when(F.col("_left"), F.col(ts))).alias("left_ts"),
        F.max(F.when(~F.col("_left"), F.col(ts))).alias("right_ts"),
    )


def outcomes(pairs: DataFrame, key: str) -> DataFrame:
    outcome = (
        F.when(F.col("right_ts").isNull(), "left_only")
        .when(F.col("left_ts").isNull(), "right_only")
        .otherwise("matched")
    )
    return pairs.select(key, "left_ts", "right_ts", outcome.alias("outcome"))


def controlled(main: DataFrame, control: DataFrame, order: str, value: str, setting: str, **kw) -> DataFrame:
    """Each main row with the latest control value that arrived before it.

    Both inputs share the arrival column ``order``.
    """
    tagged = main.select(order, F.col(value), F.lit(None).cast("string").alias(setting), F.lit(1).alias("_main"))
    switches = control.select(
        order, F.lit(None).cast(dict(main.dtypes)[value]).alias(value), F.col(setting), F.lit(0).alias("_main")
    )
    rows = scan.keyed_scan(
        tagged.unionByName(switches), [], [order, "_main"], scan.running_last("_now", F.col(setting)), **kw
    )
    return rows.where("_main = 1").select(order, value, F.col("_now").alias(setting))

"""Scans that go on from batch to batch must give what one bounded scan of all rows gives."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import changelog, joins, patterns, windows
from millrace.streaming import resumed

ORDER = ["ts", "i"]
SCHEMA = "k BIGINT, ts TIMESTAMP_NTZ, i BIGINT, kind STRING, v BIGINT"
START = dt.datetime(2024, 1, 1)


class _Is(dict):
    """The condition on a kind; columns need a session."""

    def __missing__(self, kind):
        return F.col("kind") == kind


IS = _Is()


@pytest.fixture(scope="module")
def rows():
    """Key 0 and a null key hold most rows; times repeat; some keys appear in one batch only."""
    rng = random.Random(9)
    return [(rng.choice([0, 0, 0, None, 1, 2, 3 + i // 60]), START + dt.timedelta(minutes=rng.randrange(300) + i), i, rng.choice("aabbc"), i % 7)
            for i in range(420)]


def by_batches(spark, tmp_path, rows, operator, batches=3):
    """Batches by arrival; times are up to five hours out of order, so the watermark is that far behind."""
    out, size = [], -(-len(rows) // batches)
    parts = [rows[n:n + size] for n in range(0, len(rows), size)]
    for n, part in enumerate([*parts, [(-1, START + dt.timedelta(days=900), 10 ** 6, "end", 0)]]):
        found = operator(spark.createDataFrame(part, SCHEMA), n)
        out += [tuple(r) for r in found.collect() if r.k != -1]
        columns = found.columns
    return sorted(out, key=repr), columns


def whole(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


OPERATORS = {
    "repeated": (lambda p, kw: resumed.Strict(p, "k", ORDER, [IS["a"]] * 3, "5 hours", "6 hours", **kw),
                 lambda df: patterns.strict(df, "k", ORDER, [IS["a"]] * 3, "5 hours")),
    "next": (lambda p, kw: resumed.Strict(p, "k", ORDER, [IS["a"], IS["b"]], "20 minutes", "6 hours", **kw),
             lambda df: patterns.strict(df, "k", ORDER, [IS["a"], IS["b"]], "20 minutes")),
    "reconcile": (lambda p, kw: resumed.Reconciled(p, "k", ORDER, IS["a"], IS["b"], "30 minutes", "2 hours", "6 hours", **kw),
                  lambda df: joins.reconcile(df.where(IS["a"]), df.where(IS["b"]), "k", "ts", "30 minutes", "2 hours", "i")),
    "changes": (lambda p, kw: resumed.Changes(p, "k", ORDER, [], "6 hours", **kw),
                lambda df: changelog.count_changes(df, "k", ORDER)),
    "groups": (lambda p, kw: resumed.CountTumbling(p, "k", ORDER, 4, ["v"], [F.sum("v").alias("total")], "6 hours", **kw),
               lambda df: windows.count_tumbling(df, "k", ORDER, 4, F.sum("v").alias("total")).withColumn("ct", F.lit(4).cast("long"))),
    "single": (lambda p, kw: resumed.CountTumbling(p, "k", ORDER, 1, ["v"], [F.sum("v").alias("total")], "6 hours", **kw),
               lambda df: windows.count_tumbling(df, "k", ORDER, 1, F.sum("v").alias("total")).withColumn("ct", F.lit(1).cast("long"))),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_batches_give_what_the_table_gives(spark, tmp_path, rows, name):
    make, plain = OPERATORS[name]
    got, columns = by_batches(spark, tmp_path, rows, make(str(tmp_path), {}))
    want = whole(plain(spark.createDataFrame(rows, SCHEMA)), columns)
    assert want and got == want


@pytest.mark.parametrize("name", ["repeated", "reconcile", "groups"])
def test_hot_keys_are_cut(spark, tmp_path, rows, name):
    make, plain = OPERATORS[name]
    got, columns = by_batches(spark, tmp_path, rows, make(str(tmp_path), {"hot_rows": 10}), batches=2)
    assert got == whole(plain(spark.createDataFrame(rows, SCHEMA)), columns)


def test_late_rows_are_dropped_and_a_batch_can_run_again(spark, tmp_path):
    def at(minutes, i, kind="a"):
        return (1, START + dt.timedelta(minutes=minutes), i, kind, 1)

    changes = resumed.Changes(str(tmp_path), "k", ORDER, [], "0 seconds")
    batches = [[at(0, 0), at(10, 1)], [at(5, 2), at(20, 3)], [at(30, 4)]]
    seen = []
    for n, part in enumerate(batches):
        for _ in range(2):
            found = sorted((r.i, r.op, r.ct) for r in changes(spark.createDataFrame(part, SCHEMA), n).collect())
        seen.append(found)
    # Row 2 comes when the watermark is at ten minutes already.
    assert seen == [[(0, True, 1)], [(1, False, 1), (1, True, 2)], [(3, False, 2), (3, True, 3)]]


def test_carry_is_forgotten(spark, tmp_path, rows):
    """Patterns keep nothing of a key once its time is over; an empty batch changes nothing."""
    found = resumed.Strict(str(tmp_path), "k", ORDER, [IS["a"]] * 2, "5 hours", "0 seconds")
    found(spark.createDataFrame(rows[:50], SCHEMA), 0)
    found(spark.createDataFrame([(77, START + dt.timedelta(days=9), 10 ** 6, "a", 0)], SCHEMA), 1)
    assert spark.read.parquet(f"{tmp_path}/carry/batch=1").count() == 0
    assert found(spark.createDataFrame([], SCHEMA), 2).count() == 0
    assert spark.read.parquet(f"{tmp_path}/waiting/batch=2").count() == 1

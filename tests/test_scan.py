"""Cut keys must give what one window per key gives."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import scan


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 0 (null in places) holds a third of the rows; order values repeat but for ``i``."""
    return spark.range(3000).select(
        F.col("id").alias("i"),
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 40).alias("k"),
        F.floor(F.col("id") / 7).alias("t"),
        F.when(F.pmod(F.hash("id"), F.lit(5)) > 0, F.pmod(F.xxhash64("id"), F.lit(1000))).alias("v"),
    )


SPECS = {
    "sum": (lambda: scan.running_sum("x", F.col("v")), lambda w: F.sum("v").over(w)),
    "count": (lambda: scan.running_count("x"), lambda w: F.count(F.lit(1)).over(w)),
    "count_col": (lambda: scan.running_count("x", F.col("v")), lambda w: F.count("v").over(w)),
    "max": (lambda: scan.running_max("x", F.col("v")), lambda w: F.max("v").over(w)),
    "first": (lambda: scan.running_first("x", F.col("v")), lambda w: F.first("v").over(w)),
    "last": (lambda: scan.running_last("x", F.col("v")), lambda w: F.last("v", True).over(w)),
}


@pytest.mark.parametrize("reverse", [False, True])
@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("name", SPECS)
def test_running(skewed, name, keys, reverse):
    make, plain = SPECS[name]
    order = [F.col(c).desc() if reverse else F.col(c).asc() for c in ("t", "i")]
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    want = {r.i: r.x for r in skewed.select("i", plain(w).alias("x")).collect()}
    got_df = scan.keyed_scan(skewed, keys, ["t", "i"], make(), reverse=reverse, hot_rows=100)
    got = {r.i: r.x for r in got_df.collect()}
    assert got == want


@pytest.mark.parametrize("reverse", [False, True])
@pytest.mark.parametrize("inclusive", [False, True])
def test_exclusive(skewed, reverse, inclusive):
    order = [F.col(c).desc() if reverse else F.col(c).asc() for c in ("t", "i")]
    w = Window.partitionBy("k").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    want = {r.i: (r.m, r.l) for r in skewed.select(
        "i", F.max("v").over(w).alias("m"), F.last("v", True).over(w).alias("l")).collect()}
    got = {r.i: (r.m, r.l) for r in scan.keyed_scan(
        skewed, ["k"], ["t", "i"], scan.running_max("m", F.col("v"), inclusive),
        scan.running_last("l", F.col("v"), inclusive), reverse=reverse, hot_rows=100).collect()}
    assert got == want


@pytest.mark.parametrize("reverse", [False, True])
@pytest.mark.parametrize("hot_rows", [3, 100, None])
@pytest.mark.parametrize("n", [1, 4])
def test_previous_rows(skewed, n, hot_rows, reverse):
    rows = sorted(((r.k if r.k is not None else -1, r.t, r.i, r.v) for r in skewed.collect()), reverse=reverse)
    want, seen = {}, {}
    for k, _t, i, v in rows:
        want[i] = list(seen.get(k, []))[-n:]
        seen.setdefault(k, []).append(v)
    got = scan.keyed_scan(
        skewed, ["k"], ["t", "i"], scan.previous_rows("p", F.struct(F.col("v").alias("v")), n),
        reverse=reverse, hot_rows=hot_rows)
    assert {r.i: [x.v for x in r.p] for r in got.collect()} == want


def test_hot_key_is_split(skewed):
    sizes = scan.chunked(skewed, ["k"], ["t", "i"], hot_rows=100).groupBy("k", scan.CHUNK).count()
    rows = sizes.collect()
    assert sum(r["count"] for r in rows) == 3000
    hot = [r for r in rows if r.k is None]
    assert len(hot) > 5 and max(r["count"] for r in hot) < 500
    assert all(r[scan.CHUNK] is None for r in rows if r.k is not None)


def test_whole_table_has_no_single_partition_sort(skewed):
    df = scan.keyed_scan(skewed, [], ["t", "i"], scan.running_count("x"), hot_rows=100)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # The only single-partition exchange orders the chunk aggregates.
    assert plan.count("SinglePartition") <= 2


def test_chunks_are_found_without_lambdas(skewed):
    """A lambda would keep the joins that find a row's chunk from being compiled."""
    rows = scan.chunked(skewed, ["k"], ["t", "i"], hot_rows=100)
    assert "lambda" not in rows._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("kind, values", [
    ("double", [None, float("-inf"), -1.5, -0.0, 0.0, 2.0, float("nan")]),
    ("string", [None, "", "a", "ab", "b"]),
    ("struct<o0:bigint,o1:string>", [(None, None), (None, "a"), (1, None), (1, "a"), (1, "b"), (2, "")]),
])
def test_points_below(spark, kind, values):
    known = [v for v in values if v is not None]
    rows = [(here, known[a:a + n]) for here in values for n in range(4) for a in range(len(known) - n + 1)]
    df = spark.createDataFrame([*rows, (known[0], None)], f"here {kind}, points array<{kind}>")
    want = F.size(F.filter("points", lambda p: p < F.col("here")))
    got = df.select(scan._below(F.col("points"), F.col("here")).alias("got"), F.when(F.col("points").isNotNull(), want).alias("want")).collect()
    assert [r.got for r in got] == [r.want for r in got]

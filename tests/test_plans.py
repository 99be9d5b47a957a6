"""What the plans must look like to hold at scale."""

import pytest

import __spark_entry__ as entry_point
from millrace.operators import scan
from millrace.sources import tables

QUERIES = entry_point.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


BOUNDED = [
    "word_count", "running_max", "running_max_by", "win_tumbling_sum", "win_sliding_sum", "win_session_sum",
    "win_count_tumbling", "over_unbounded", "over_rows", "interval_join", "reconcile", "pat_repeat",
    "pat_followed_by", "pv_hourly", "pv_salted", "uv_exact", "uv_bitmap", "uv_running", "item_top_n",
    "changelog_count", "running_count", "late_classes", "sql_over_global", "sql_over_named", "control_switch",
]


@pytest.mark.parametrize("name", BOUNDED)
def test_no_python_and_no_cartesian(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"):
        assert word not in text


@pytest.mark.parametrize("name", ["running_max", "pat_repeat", "win_count_tumbling", "reconcile", "win_session_sum"])
def test_a_key_is_shuffled_once(spark, sf, name):
    """Scans on one key and the grouping after them share an exchange."""
    exchanges = plan(QUERIES[name](spark, sf)).count("Exchange hashpartitioning")
    assert exchanges <= (2 if name in ("reconcile", "win_session_sum") else 1)


def test_filter_and_columns_reach_the_scan(spark, sf):
    text = formatted(QUERIES["pv_hourly"](spark, sf))
    assert "EqualTo(event_type,view)" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in text


def test_top_n_limits_before_the_shuffle(spark, sf):
    text = plan(QUERIES["item_top_n"](spark, sf))
    assert text.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("name", ["running_count", "watermark_trace", "late_classes", "sql_over_global", "control_switch"])
def test_whole_table_scans_only_gather_chunks(spark, sf, name):
    """A single-partition exchange may only come after an aggregate per chunk; a table too small to sample is one chunk."""
    lines = plan(QUERIES[name](spark, sf.replace("sf0.001", "sf0.01"))).splitlines()
    at = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    assert at
    assert all("HashAggregate" in lines[i + 1] or "SortAggregate" in lines[i + 1] for i in at)


def test_cut_keys_use_bounded_broadcasts(spark, sf):
    """Cuts and carries are hash joins; the rows themselves are shuffled once, by key and chunk."""
    readings = tables.sensor(tables.events(spark, sf))
    df = scan.keyed_scan(readings, ["id"], ["event_id"], scan.running_count("ct"), hot_rows=10)
    text = plan(df)
    assert "NestedLoop" not in text and "SortMergeJoin" not in text
    assert text.count("BroadcastHashJoin") >= 2
    assert "hashpartitioning(id" in text and "_chunk" in text

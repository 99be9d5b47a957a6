"""Named queries and, where plain SQL can say the same, the SQL to check them with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

HOUR_US = 3_600_000_000

SENSOR_SQL = "s AS (SELECT event_id, user_id AS id, ts, CAST(floor(value) AS BIGINT) AS vc, event_type FROM events)"
LINES_SQL = """l AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no,
         unnest(string_split(text, chr(10))) AS line
  FROM documents)"""
WORDS_SQL = LINES_SQL + """, w AS (
  SELECT doc_id, line_no, generate_subscripts(ws, 1) - 1 AS pos, unnest(ws) AS word
  FROM (SELECT doc_id, line_no, string_split(rtrim(line, ' '), ' ') AS ws
        FROM l WHERE line = '' OR rtrim(line, ' ') <> ''))"""


def query(name: str, sql: str | None = None):
    """Register a query under ``name``."""
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def bucket(us: int, col: str = "ts") -> str:
    """SQL for the start of the epoch-aligned bucket of a time."""
    return f"make_timestamp((epoch_us({col}) // {us}) * {us})"


def hop(us: int, panes: int, source: str, cols: str) -> str:
    """SQL giving each row of ``source`` once per sliding window of ``panes`` slides of ``us``."""
    return f"""SELECT {cols},
      make_timestamp((epoch_us(ts) // {us} - i) * {us}) AS window_start,
      ts
    FROM {source}, range({panes}) r(i)"""

"""User functions: scalar, table and aggregate."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.running import user_aggregate

OUT_OF_RANGE = "substring out of range"


def substring_range(s: Column, begin: int, end: int) -> Column:
    """Characters ``begin`` to ``end - 1``, counted from 0; out of range is an error."""
    bad = (F.length(s) < end) | F.lit(begin < 0 or begin > end)
    return F.when(bad, F.raise_error(F.lit(OUT_OF_RANGE)).cast("string")).otherwise(
        F.substring(s, begin + 1, max(0, end - begin))
    )


def register_substring(spark: SparkSession, name: str = "substring_range") -> None:
    """The same function by name, for SQL. Its body is SQL, so it is planned like built-ins."""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING, b INT, e INT) RETURNS STRING
        RETURN CASE WHEN b < 0 OR b > e OR e > length(s) THEN CAST(raise_error('{OUT_OF_RANGE}') AS STRING)
                    ELSE substring(s, b + 1, e - b) END
    """)


def substring_batches(begin: int, end: int):
    """The function as a user would write it in Python, over Arrow batches."""
    @F.pandas_udf("string")
    def cut(s: pd.Series) -> pd.Series:
        if begin < 0 or begin > end or (s.str.len() < end).any():
            raise IndexError(OUT_OF_RANGE)
        return s.str.slice(begin, end)

    return cut


class SplitWords:
    """Words of a line; see ``rows.words``."""

    def eval(self, line: str) -> Iterator[tuple[int, str]]:
        if line is None:
            return
        kept = line.rstrip(" ")
        if kept or not line:
            yield from enumerate(kept.split(" "))


def word_table():
    return F.udtf(SplitWords, returnType="pos INT, word STRING")


class SplitTable:
    """Words of the lines of a table, a batch of rows at a time: ``doc_id``, ``line_no``, ``pos`` and ``word``."""

    def eval(self, rows: pa.RecordBatch) -> Iterator[pa.Table]:
        line = rows.column("line")
        kept = pc.utf8_rtrim(line, " ")
        worded = pc.or_(pc.not_equal(kept, ""), pc.equal(line, ""))
        rows, kept = rows.filter(worded), kept.filter(worded)  # a null line is neither
        words = pc.split_pattern(kept, " ")
        parent = pc.list_parent_indices(words).to_numpy()
        starts = np.searchsorted(parent, np.arange(rows.num_rows))
        yield pa.table({
            "doc_id": rows.column("doc_id").take(pa.array(parent)), "line_no": rows.column("line_no").take(pa.array(parent)),
            "pos": pa.array(np.arange(len(parent)) - starts[parent], pa.int32()), "word": pc.list_flatten(words),
        })


def words_of_table():
    """A table function over a table: its state would be that of a partition, as given by ``PARTITION BY``."""
    return F.arrow_udtf(SplitTable, returnType="doc_id BIGINT, line_no INT, pos INT, word STRING")


def mean_by_key(df: DataFrame, key: str, col: str, name: str = "mean") -> DataFrame:
    """A mean written as a user aggregate over (sum, count)."""
    return user_aggregate(
        df, key, [col],
        create=lambda: (0, 0),
        add=lambda acc, rows: (acc[0] + int(rows[col].sum()), acc[1] + len(rows)),
        merge=lambda a, b: (a[0] + b[0], a[1] + b[1]),
        result=lambda acc: acc[0] / acc[1] if acc[1] else None,
        name=name,
    )


def count_by_key(df: DataFrame, key: str, name: str = "ct") -> DataFrame:
    """A count written as a user aggregate."""
    return user_aggregate(
        df, key, [],
        create=lambda: 0,
        add=lambda acc, rows: acc + len(rows),
        merge=lambda a, b: a + b,
        result=int,
        name=name,
        type_="bigint",
    )

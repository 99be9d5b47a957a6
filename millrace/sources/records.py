"""Delimited text records to typed rows.

An empty field of a string column stays the empty string; a malformed number fails the job;
extra trailing fields are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The record layouts, in field order. Event times are epoch seconds.
SENSOR = "id STRING, ts BIGINT, vc INT"
BEHAVIOR = "user_id BIGINT, item_id BIGINT, category_id INT, behavior STRING, ts BIGINT"
LOGIN = "user_id BIGINT, ip STRING, event_type STRING, ts BIGINT"
ORDER = "order_id BIGINT, event_type STRING, tx_id STRING, ts BIGINT"
RECEIPT = "tx_id STRING, pay_channel STRING, ts BIGINT"


def parse(lines: DataFrame, layout: str, line: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """One typed row per line; ANSI casts make a bad number an error."""
    fields = F.split(F.col(line), ",")
    columns = []
    for i, field in enumerate(layout.split(", ")):
        name, type_ = field.split(" ")
        columns.append(F.element_at(fields, i + 1).cast(type_).alias(name))
    return lines.select(*keep, *columns)


def from_rows(spark, rows: list[tuple], layout: str) -> DataFrame:
    """Rows given in the program."""
    return spark.createDataFrame(rows, layout)

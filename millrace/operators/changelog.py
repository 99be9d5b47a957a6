"""Changelogs: an updated result as a retraction of the old row and the new row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import scan


def count_changes(df: DataFrame, key: str, order: Sequence[str], **kw) -> DataFrame:
    """Changes of a count per key: ``(false, old)`` then ``(true, new)`` at each arriving row."""
    rows = scan.keyed_scan(df, [key], order, scan.running_count("ct"), **kw)
    new = F.struct(F.lit(True).alias("op"), F.col("ct").alias("ct"))
    old = F.struct(F.lit(False).alias("op"), (F.col("ct") - 1).alias("ct"))
    changes = F.when(F.col("ct") == 1, F.array(new)).otherwise(F.array(old, new))
    return rows.select(*order, key, F.explode(changes).alias("c")).select(*order, key, "c.op", "c.ct")

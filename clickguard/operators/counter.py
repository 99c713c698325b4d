"""Per-key running totals of the counter rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def counter_totals(rows: DataFrame) -> DataFrame:
    """`(key, total, first, last)`: sum, min and max of `value` per key.

    A single key may hold every row; the partial aggregate before the
    shuffle reduces each map task to one row per key, so the final task
    sees one row per map task, not the key's rows.
    """
    return rows.groupBy("key").agg(
        F.sum("value").alias("total"),
        F.min("value").alias("first"),
        F.max("value").alias("last"))

"""The event aggregate `(clicks, watches, firstEvent, lastEvent)`.

It is a semigroup: counts add, times take the null-safe min / max. Built
from declarative aggregates, so Spark runs it as partial + final hash
aggregation (map-side combine) in batch and in streaming state alike.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_aggregation(action: str | Column = "action",
                      event_time: str | Column = "eventTime") -> Column:
    """Aggregate column: struct of clicks, watches, first and last event time.

    Rows of an unknown action add nothing to the counts but do move the
    first / last times.
    """
    a, t = _c(action), _c(event_time)
    return F.struct(
        F.count_if(a == "click").alias("clicks"),
        F.count_if(a == "watch").alias("watches"),
        F.min(t).alias("firstEvent"),
        F.max(t).alias("lastEvent"),
    )


def aggregation_columns(action: str | Column = "action",
                        event_time: str | Column = "eventTime") -> list[Column]:
    """The same aggregate as four top-level columns."""
    a, t = _c(action), _c(event_time)
    return [
        F.count_if(a == "click").alias("clicks"),
        F.count_if(a == "watch").alias("watches"),
        F.min(t).alias("firstEvent"),
        F.max(t).alias("lastEvent"),
    ]


def merge_aggregation(prefix: str = "") -> list[Column]:
    """Aggregate columns that combine partial aggregates (columns
    `clicks, watches, firstEvent, lastEvent`, optionally below a struct
    `prefix`). `sum` / `min` / `max` skip nulls, which makes the time merge
    null-safe."""
    p = f"{prefix}." if prefix else ""
    return [
        F.sum(f"{p}clicks").cast("long").alias("clicks"),
        F.sum(f"{p}watches").cast("long").alias("watches"),
        F.min(f"{p}firstEvent").alias("firstEvent"),
        F.max(f"{p}lastEvent").alias("lastEvent"),
    ]


def combine(x: str | Column, y: str | Column) -> Column:
    """Row-level combine of two aggregate structs (the semigroup operation)."""
    x, y = _c(x), _c(y)
    return F.struct(
        (x.getField("clicks") + y.getField("clicks")).alias("clicks"),
        (x.getField("watches") + y.getField("watches")).alias("watches"),
        F.least(x.getField("firstEvent"), y.getField("firstEvent")).alias("firstEvent"),
        F.greatest(x.getField("lastEvent"), y.getField("lastEvent")).alias("lastEvent"),
    )

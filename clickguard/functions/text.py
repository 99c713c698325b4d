"""Rendering of times inside reason texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the seconds-precision pattern of the typed detectors.
SECONDS_PATTERN = "yyyy-MM-dd HH:mm:ss"


def time_text(t: Column, time_format: str | None = None) -> Column:
    """A timestamp as text: the cast form (fraction trimmed) by default, or
    `date_format` with a pattern. Both use the session time zone."""
    if time_format is None:
        return t.cast("string")
    return F.date_format(t, time_format)

"""Plan inspection: what tests and the bench assert about physical plans."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """``df.explain(mode)`` captured as a string."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def count_shuffles(df: DataFrame) -> int:
    """Shuffle exchanges in the physical plan (before AQE re-planning)."""
    text = plan_text(df, "simple")
    return sum(1 for line in text.splitlines()
               if "Exchange " in line and "ReusedExchange" not in line
               and "BroadcastExchange" not in line)

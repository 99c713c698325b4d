"""The detector as one Spark SQL statement.

Thresholds, durations and the fixed texts are named parameters, bound as
literals by the analyzer - no string interpolation of values, and Catalyst
folds them like any constant. Windows are selected by the numbers alone; the
reason is put together for those that remain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickguard.config import DetectorConfig
from clickguard.operators.incidents import LOW_RATE, TOO_MANY

INCIDENTS_SQL = """
WITH per_window AS (
  SELECT ip,
         count_if(action = 'click') AS n_click,
         count_if(action = 'watch') AS n_watch,
         min(eventTime) AS first_at,
         max(eventTime) AS last_at
  FROM {events}
  WHERE eventTime IS NOT NULL
  GROUP BY ip, window(eventTime, :window, :slide)
),
measured AS (
  SELECT *, n_click + n_watch AS n,
         coalesce(try_divide(n_watch, n_click), double(n_watch)) AS per_click
  FROM per_window
)
SELECT ip, last_at AS lastEvent,
       format_string('%s%s from %s to %s',
                     if(n >= :max_events, :many, :low),
                     if(n >= :max_events, string(n), string(per_click)),
                     string(first_at), string(last_at)) AS reason
FROM measured
WHERE n > :min_events AND (n >= :max_events OR per_click <= :min_rate)
"""


def sql_args(conf: DetectorConfig) -> dict:
    return {
        "window": conf.window_str,
        "slide": conf.slide_str,
        "min_events": conf.min_events,
        "max_events": conf.max_events,
        "min_rate": float(conf.min_rate),
        "many": TOO_MANY,
        "low": LOW_RATE,
    }


def find_incidents_sql(spark: SparkSession, events: DataFrame,
                       conf: DetectorConfig) -> DataFrame:
    """The detector as SQL over `events` (batch or stream; a stream gets
    its watermark before it enters the statement)."""
    src = events.withWatermark("eventTime", conf.watermark_str)
    return spark.sql(INCIDENTS_SQL, args=sql_args(conf), events=src)

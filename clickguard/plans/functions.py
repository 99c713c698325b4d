"""The detector as SQL functions: temporary functions of a session, which any
SQL statement can call. Scalar functions hold the rules, a table function the
detector over a view of events; Spark inlines both, so a statement that calls
them has the plan of the written-out form."""

from __future__ import annotations

from pyspark.sql import SparkSession

from clickguard.config import DetectorConfig
from clickguard.operators.incidents import LOW_RATE, TOO_MANY

_RATE = """
CREATE OR REPLACE TEMPORARY FUNCTION watch_rate(clicks BIGINT, watches BIGINT)
RETURNS DOUBLE COMMENT 'Watches per click; without clicks the watches.'
RETURN coalesce(try_divide(watches, clicks), double(watches))
"""
_SUSPICIOUS = """
CREATE OR REPLACE TEMPORARY FUNCTION is_suspicious(clicks BIGINT, watches BIGINT)
RETURNS BOOLEAN COMMENT 'Whether a window with these counts is an incident.'
RETURN clicks + watches > {least}
   AND (clicks + watches >= {most} OR watch_rate(clicks, watches) <= {rate}D)
"""
_REASON = """
CREATE OR REPLACE TEMPORARY FUNCTION incident_reason(clicks BIGINT, watches BIGINT, first TIMESTAMP, last TIMESTAMP)
RETURNS STRING COMMENT 'What is reported for a window that is an incident.'
RETURN concat(if(clicks + watches >= {most}, concat('{many}', string(clicks + watches)),
                 concat('{low}', string(watch_rate(clicks, watches)))),
              ' from ', string(first), ' to ', string(last))
"""
_WINDOWS = """
CREATE OR REPLACE TEMPORARY FUNCTION event_windows()
RETURNS TABLE (ip STRING, window_start TIMESTAMP, window_end TIMESTAMP,
               clicks BIGINT, watches BIGINT, first TIMESTAMP, last TIMESTAMP)
COMMENT 'Counts of every ip and sliding window.'
RETURN SELECT ip, window.start, window.end, count_if(action = 'click'), count_if(action = 'watch'),
              min(eventTime), max(eventTime)
       FROM {view} WHERE eventTime IS NOT NULL GROUP BY ip, window(eventTime, '{window}', '{slide}')
"""
_INCIDENTS = """
CREATE OR REPLACE TEMPORARY FUNCTION incidents_since(since TIMESTAMP)
RETURNS TABLE (ip STRING, lastEvent TIMESTAMP, reason STRING)
COMMENT 'Incidents of windows that start at a time or later; NULL for all.'
RETURN SELECT ip, last, incident_reason(clicks, watches, first, last)
       FROM event_windows()
       WHERE is_suspicious(clicks, watches) AND (incidents_since.since IS NULL OR window_start >= incidents_since.since)
"""


def create_functions(spark: SparkSession, conf: DetectorConfig, view: str = "click_events") -> None:
    """Defines `watch_rate`, `is_suspicious`, `incident_reason`,
    `event_windows()` and `incidents_since(time)` in the session, with the
    thresholds and windows of `conf`, over the temporary view `view` of
    (ip, action, eventTime)."""
    values = {"view": view, "least": conf.min_events, "most": conf.max_events, "rate": float(conf.min_rate),
              "many": TOO_MANY, "low": LOW_RATE, "window": conf.window_str, "slide": conf.slide_str}
    for statement in (_RATE, _SUSPICIOUS, _REASON, _WINDOWS, _INCIDENTS):
        spark.sql(statement.format(**values))

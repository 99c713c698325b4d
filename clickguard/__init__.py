"""clickguard: a Spark-native click-fraud detector.

Events (ip, action, eventTime) are grouped per ip over sliding windows of
event time or arrival time; windows with too many events or too low a
watch-to-click rate become incidents, and incidents become ban records.
Everything is expressed with DataFrame / SQL / Structured Streaming
built-ins so Catalyst plans it and whole-stage codegen runs it.
"""

from clickguard.config import DetectorConfig
from clickguard.operators.incidents import (
    classify_windows,
    find_incidents,
    find_incidents_struct,
)
from clickguard.operators.windows import window_event_stats
from clickguard.plans.sql import find_incidents_sql

__all__ = [
    "DetectorConfig",
    "classify_windows",
    "find_incidents",
    "find_incidents_sql",
    "find_incidents_struct",
    "window_event_stats",
]

"""Column-level building blocks: parsing, the event aggregate, reason text."""

from clickguard.functions.aggregate import event_aggregation, merge_aggregation
from clickguard.functions.parse import (
    extract_key,
    parse_lenient,
    parse_strict,
    quarantine,
)
from clickguard.functions.text import time_text

__all__ = [
    "event_aggregation",
    "extract_key",
    "merge_aggregation",
    "parse_lenient",
    "parse_strict",
    "quarantine",
    "time_text",
]

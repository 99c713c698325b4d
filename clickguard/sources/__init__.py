"""Sources: batch tables, Kafka(-shaped) records, spool directories, counter."""

from clickguard.sources.tables import click_events, read_table, to_click_events
from clickguard.sources.kafka import kafka_records, kafka_stream, with_message

__all__ = [
    "click_events",
    "kafka_records",
    "kafka_stream",
    "with_message",
    "read_table",
    "to_click_events",
]

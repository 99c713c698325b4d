"""Row contracts shared by sources, detectors and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Body of a click-log message (JSON). from_json makes every field nullable.
MESSAGE = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("ip", T.StringType()),
        T.StructField("unix_time", T.LongType()),
        T.StructField("url", T.StringType()),
    ]
)

# Detector input: one click or watch (anything else counts as unknown).
EVENT = T.StructType(
    [
        T.StructField("ip", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("eventTime", T.TimestampType()),
    ]
)

# Detector output.
INCIDENT = T.StructType(
    [
        T.StructField("ip", T.StringType()),
        T.StructField("lastEvent", T.TimestampType()),
        T.StructField("reason", T.StringType()),
    ]
)

# Detector output that names the window (the slide) it was judged at.
SLIDE_INCIDENT = T.StructType(
    [
        T.StructField("ip", T.StringType()),
        T.StructField("windowEnd", T.TimestampType()),
        T.StructField("lastEvent", T.TimestampType()),
        T.StructField("reason", T.StringType()),
    ]
)

# The per-window aggregate; also the value type of event_aggregation().
AGGREGATE = T.StructType(
    [
        T.StructField("clicks", T.LongType()),
        T.StructField("watches", T.LongType()),
        T.StructField("firstEvent", T.TimestampType()),
        T.StructField("lastEvent", T.TimestampType()),
    ]
)

# Columns of a Kafka record as the kafka source delivers them.
KAFKA_RECORD = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# One ban: ip banned until `period` (epoch milliseconds).
BAN_RECORD = T.StructType(
    [
        T.StructField("ip", T.StringType()),
        T.StructField("period", T.LongType()),
        T.StructField("reason", T.StringType()),
    ]
)

# The ban log as `BanLogWriter` lays it out: one write per row, partitioned
# by write day, run and batch.
BAN_LOG = T.StructType(
    list(BAN_RECORD.fields)
    + [
        T.StructField("written_at", T.TimestampType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("expires_at", T.TimestampType()),
        T.StructField("written_date", T.DateType()),
        T.StructField("run", T.StringType()),
        T.StructField("batch", T.IntegerType()),
    ]
)

# Rows of the demo counter source.
COUNTER_ROW = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.LongType()),
        T.StructField("topic", T.StringType()),
        T.StructField("offset", T.LongType()),
    ]
)


# Running totals per key.
COUNTER_TOTAL = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("total", T.LongType()),
        T.StructField("first", T.LongType()),
        T.StructField("last", T.LongType()),
    ]
)


def require_columns(df: DataFrame, *names: str) -> None:
    """Fail early, on the driver, when an input lacks a column."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")

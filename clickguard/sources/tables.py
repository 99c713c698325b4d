"""Batch tables and the mapping of the driver's `events` table to detector
input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickguard.schema import require_columns


# Declared schemas of the driver tables this engine reads. Reading with a
# declared schema skips footer-based inference (one less pass over file
# metadata per query, and no drift across thousands of files).
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    r = spark.read.schema(schema) if schema else spark.read
    return r.parquet(path)


def action_of(event_type: Column) -> Column:
    """`click` stays `click`, `view` becomes `watch`; any other type is kept
    as is and counts as an unknown action."""
    return F.when(event_type == "view", F.lit("watch")).otherwise(event_type)


def to_click_events(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """`events(event_id, ts, user_id, event_type, ...)` as detector input
    `(ip, action, eventTime)`.

    `ts` is TIMESTAMP_NTZ; it is cast to TIMESTAMP because watermarks need
    it. Only the three source columns (plus `keep`) are read, so the scan
    prunes the rest.
    """
    require_columns(events, "user_id", "event_type", "ts", *keep)
    return events.select(
        F.col("user_id").cast("string").alias("ip"),
        action_of(F.col("event_type")).alias("action"),
        F.col("ts").cast("timestamp").alias("eventTime"),
        *keep,
    )


def click_events(spark: SparkSession, sf_dir: str,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    return to_click_events(read_table(spark, sf_dir, "events"), keep)

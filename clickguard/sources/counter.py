"""The demo counter source: each micro-batch emits the next ten ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def counter_stream(spark: SparkSession, rows_per_batch: int = 10,
                   partitions: int | None = None) -> DataFrame:
    """Rows `(key="key", value=id, topic="topic", offset=id)`; batch n holds
    ids ``[n*rows, (n+1)*rows)``. Built on the `rate-micro-batch` source,
    whose offsets live in the checkpoint like any other source's."""
    r = (spark.readStream.format("rate-micro-batch")
         .option("rowsPerBatch", str(rows_per_batch)))
    if partitions:
        r = r.option("numPartitions", str(partitions))
    return to_counter_rows(r.load(), "value")


def to_counter_rows(df: DataFrame, id_col: str, key: str | None = "key",
                    topic: str = "topic") -> DataFrame:
    return df.select(
        (F.lit(key) if key is not None else F.col("key")).alias("key"),
        F.col(id_col).cast("long").alias("value"),
        F.lit(topic).alias("topic"),
        F.col(id_col).cast("long").alias("offset"),
    )


def events_as_counter_rows(events: DataFrame) -> DataFrame:
    """`events` as counter rows keyed by event type (value = offset = id)."""
    return events.select(
        F.col("event_type").alias("key"),
        F.col("event_id").alias("value"),
        F.lit("events").alias("topic"),
        F.col("event_id").alias("offset"),
    )

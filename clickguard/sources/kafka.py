"""Kafka source and Kafka-shaped records.

The `kafka` format is a deployment dependency (spark-sql-kafka on the
classpath). Every job takes its input as a DataFrame, so the same job runs
on a Kafka stream in production and on Kafka-shaped parquet in tests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickguard.schema import KAFKA_RECORD
from clickguard.sources.tables import action_of

TOPIC = "clicks"


def kafka_stream(spark: SparkSession, brokers: str, topics: list[str] | str,
                 starting_offsets: str = "earliest",
                 max_offsets_per_trigger: int | None = 1_000_000,
                 **options: str) -> DataFrame:
    """`readStream.format("kafka")` with the reference's options.

    `maxOffsetsPerTrigger` bounds one micro-batch over all partitions, so a
    backlog is worked off in bounded batches instead of one huge one.
    """
    if not isinstance(topics, str):
        topics = ",".join(t.strip() for t in topics)
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", brokers)
         .option("subscribe", topics)
         .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()


def kafka_stream_from(spark: SparkSession, conf) -> DataFrame:
    """`kafka_stream` from a `KafkaConfig`."""
    opts = {"groupIdPrefix": conf.group_id_prefix, **conf.options}
    return kafka_stream(spark, conf.brokers, list(conf.topics), conf.starting_offsets,
                        conf.max_offsets_per_trigger, **opts)


def _record_kind(k: Column) -> Column:
    """Which form the message of an event takes, chosen by the event's
    own `props.k` (0-99): a few percent are broken in each way the parser
    must handle."""
    forms = {3: "text", 6: "no_url", 9: "quoted_time", 10: "number_ip", 11: "object_url",
             12: "junk_after", 13: "two_objects", 14: "single_quotes", 15: "far_time", 16: "null_ip"}
    kind = F.lit("json")
    for below, name in sorted(forms.items(), reverse=True):
        kind = F.when(k < below, F.lit(name)).otherwise(kind)
    return kind


def _message_parts(events: DataFrame) -> DataFrame:
    """The fields of each event's message, each computed once (the record
    kind is read by every branch of the body; as its own column it is not
    inlined back, since it is neither cheap nor used once)."""
    k = events.select("*", F.get_json_object("props", "$.k").try_cast("int").alias("_k"))
    return k.select(
        *events.columns,
        F.col("user_id").cast("string").alias("_ip"),
        action_of(F.col("event_type")).alias("_type"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("_unix_time"),
        F.concat(F.lit("/ad/"), F.col("event_id").cast("string")).alias("_url"),
        _record_kind(F.col("_k")).alias("_kind"),
    )


def _body() -> Column:
    typ, ip, ut, url, kind = (F.col(c) for c in ("_type", "_ip", "_unix_time", "_url", "_kind"))

    def json(**other: Column | None) -> Column:
        fields = {"type": typ, "ip": ip, "unix_time": ut, "url": url} | other
        return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items() if c is not None]),
                         {"ignoreNullFields": "false"})

    # in milliseconds of milliseconds: beyond any calendar
    return (
        F.when(kind == "text", F.concat_ws(" ", typ, ip, ut.cast("string"), url))
        .when(kind == "no_url", json(url=None))
        .when(kind == "quoted_time", json(unix_time=ut.cast("string")))
        .when(kind == "number_ip", json(ip=ip.cast("long")))
        .when(kind == "object_url", json(url=F.struct(url.alias("path"))))
        .when(kind == "junk_after", F.concat(json(), F.lit(" end")))
        .when(kind == "two_objects", F.concat(json(), json()))
        .when(kind == "single_quotes", F.translate(json(), '"', "'"))
        .when(kind == "far_time", json(unix_time=ut * F.lit(1_000_000)))
        .when(kind == "null_ip", json(ip=F.lit(None).cast("string")))
        .otherwise(json())
    )


def with_message(events: DataFrame, name: str = "value") -> DataFrame:
    """`events` plus the JSON body a click-log agent would send for each row."""
    return _message_parts(events).select(*events.columns, _body().alias(name))


def kafka_records(events: DataFrame, topic: str = TOPIC,
                  partitions: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """`events` as the records a keyed click-log topic would hold:
    key = ip, value = JSON body, offset = event id, timestamp = the
    broker's append time (event time plus the event's delivery lag).
    `keep` names columns of `events` to have besides."""
    return _message_parts(events).select(
        F.col("_ip").cast("binary").alias("key"),
        _body().cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.hash(F.col("_ip")), F.lit(partitions)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        arrival_time(F.col("ts").cast("timestamp"), F.col("value")).alias("timestamp"),
        *keep,
    )


def arrival_time(event_time: Column, lag_units: Column,
                 minutes_per_unit: float = 10.0) -> Column:
    """When the broker received an event: event time plus a delivery lag of
    `lag_units` x 10 minutes (the `value` column of `events`)."""
    lag_us = F.floor(lag_units * F.lit(minutes_per_unit * 60_000_000)).cast("long")
    return F.timestamp_micros(F.unix_micros(event_time) + lag_us)


def kafka_shaped_stream(spark: SparkSession, path: str,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream over Kafka-shaped parquet files (tests, replays)."""
    r = spark.readStream.schema(KAFKA_RECORD)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path)

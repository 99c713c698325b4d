"""Stream replays: the streaming jobs run end to end over the driver's
`events` table (read as a file stream), their sink read back as a
DataFrame. Checkpoints and outputs go below the cluster's shared folder
(``spark.checkpoint.dir``)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickguard.config import EVENTS_CONFIG as C
from clickguard.config import duration_us
from clickguard.functions.parse import parse_lenient
from clickguard.operators.bans import current_bans
from clickguard.operators.once import find_incidents_of_topics
from clickguard.schema import COUNTER_TOTAL, INCIDENT, KAFKA_RECORD, SLIDE_INCIDENT
from clickguard.session import ensure_utc, scratch_path, session_conf
from clickguard.sources.counter import events_as_counter_rows
from clickguard.sources.kafka import TOPIC, kafka_records, kafka_shaped_stream
from clickguard.sources.tables import TABLE_SCHEMAS, read_table, to_click_events
from clickguard.streaming.jobs import archive_job, ban_job, counter_job, detect
from clickguard.streaming.progress import BatchReport, measured, read_report
from clickguard.streaming.sinks import archive_sink, latest_state, read_ban_log, read_upsert_log
from clickguard.streaming.state import open_windows


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The `events` table as a file stream (declared schema).

    `events.parquet` may be one file or a folder of part files (as a large
    table is); the path is a glob matching exactly that name (``[.]``), which
    the file source accepts for both - a plain file path is refused, and a
    name filter on the parent folder would skip the part files.
    """
    d = sf_dir.rstrip("/")
    return spark.readStream.schema(TABLE_SCHEMAS["events"]).parquet(f"{d}/events[.]parquet")


def _finish(q) -> None:
    try:
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    finally:
        if q.isActive:
            q.stop()


def stream_incidents_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive job (append mode): incidents of windows the watermark has
    closed, written to parquet and read back."""
    ensure_utc(spark)
    out = scratch_path(spark, "archive")
    ckpt = scratch_path(spark, "checkpoints", "archive")
    records = kafka_records(events_stream(spark, sf_dir))
    _finish(archive_job(spark, records, C, out, ckpt, trigger="availableNow"))
    return spark.read.schema(INCIDENT).parquet(out).select(*INCIDENT.names)


def stream_bans_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ban job (update mode, SQL detector) into the ban log; the current
    bans read back (written now, so all are in force)."""
    ensure_utc(spark)
    out = scratch_path(spark, "bans")
    ckpt = scratch_path(spark, "checkpoints", "bans")
    records = kafka_records(events_stream(spark, sf_dir))
    _finish(ban_job(spark, records, C, out, ckpt, detector="sql",
                    trigger="availableNow"))
    # open only the days a ban written now-or-earlier can still be in force
    since = (dt.datetime.now(dt.timezone.utc)
             - dt.timedelta(microseconds=duration_us(C.ban_time))).date().isoformat()
    log = read_ban_log(spark, out, since=since)
    return current_bans(log, horizon=C.ban_time).select("ip", "period", "reason")


def stream_bans_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ban job into the row sink: the lines of its files read back, one per
    ban that the update-mode stream emitted, each with its expiry ahead."""
    ensure_utc(spark)
    out = scratch_path(spark, "ban-rows")
    ckpt = scratch_path(spark, "checkpoints", "ban-rows")
    records = kafka_records(events_stream(spark, sf_dir))
    _finish(ban_job(spark, records, C, out, ckpt, sink="rows", trigger="availableNow"))
    lines = spark.read.schema("ip string, period long, reason string, expires long").json(f"{out}/*/*")
    ahead = F.timestamp_millis("expires") > F.current_timestamp()
    return lines.select("ip", "period", "reason", ahead.alias("in_force"))


def stream_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter job (update mode) over `events` keyed by type; the final
    totals read back from its upsert log."""
    ensure_utc(spark)
    out = scratch_path(spark, "counter")
    ckpt = scratch_path(spark, "checkpoints", "counter")
    rows = events_as_counter_rows(events_stream(spark, sf_dir))
    _finish(counter_job(spark, rows, ckpt, path=out, trigger="availableNow"))
    return latest_state(read_upsert_log(spark, out, COUNTER_TOTAL), ["key"])


def stream_incidents_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain click events (no message layer) through the archive path."""
    ensure_utc(spark)
    out = scratch_path(spark, "archive-events")
    ckpt = scratch_path(spark, "checkpoints", "archive-events")
    from clickguard.operators.incidents import find_incidents

    inc = find_incidents(to_click_events(events_stream(spark, sf_dir)), C)
    _finish(archive_sink(inc, out, ckpt).trigger(availableNow=True).start())
    return spark.read.schema(INCIDENT).parquet(out).select(*INCIDENT.names)


BATCHES = 4


def _quarter() -> Column:
    return F.floor((F.dayofmonth("ts") - 1) / 8)


def write_deliveries(events: DataFrame, folder: str, topic: str = TOPIC) -> None:
    """Appends the events as records to `folder`, those of each value of their
    `batch` to a folder of its own, all in one pass over them."""
    # a writer per folder instead of a sort of the records by folder
    with session_conf(events.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": str(BATCHES)}):
        (kafka_records(events, topic, keep=("batch",)).write.mode("append")
         .partitionBy("batch").parquet(folder))
    none = events.sparkSession.createDataFrame([], KAFKA_RECORD)
    for i in range(BATCHES):   # a delivery without records is one too
        none.write.mode("append").parquet(f"{folder}/batch={i}")


def delivered(spark: SparkSession, folder: str, batch: int) -> DataFrame:
    """The records of `write_deliveries` that have come with `batch`, as a stream."""
    come = ",".join(str(i) for i in range(batch + 1))
    return kafka_shaped_stream(spark, f"{folder}/batch={{{come}}}")


def in_batches(spark: SparkSession, sf_dir: str, run, again_every: int | None = None) -> None:
    """The events as records that come in `BATCHES` batches, `run(records)` once
    per batch on all that has come, from one checkpoint: a job that is stopped
    and started again between batches. An event comes with the quarter of its
    month, one batch later if its `props.k` is under 20: such records lag the
    others by a week, and more than the watermark waits for. With `again_every`
    the records of every so manyth event are delivered again in the next batch
    (twice in the last)."""
    topic = scratch_path(spark, "topic")
    events = read_table(spark, sf_dir, "events")
    lag = (F.get_json_object("props", "$.k").try_cast("int") < 20).cast("int")
    batch = F.least(_quarter() + F.coalesce(lag, F.lit(0)), F.lit(BATCHES - 1))
    write_deliveries(events.withColumn("batch", batch), topic)
    if again_every:
        again = events.where(F.col("event_id") % again_every == 0)
        write_deliveries(again.withColumn("batch", F.least(batch + 1, F.lit(BATCHES - 1))), topic)
    for i in range(BATCHES):
        _finish(run(delivered(spark, topic, i)))


def stream_bans_by_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ban job over arrival time (strict parse, ms) in update mode, in several
    batches: each batch judges the windows it changes, records later than the
    watermark are dropped, the newest batch that bans an ip counts."""
    ensure_utc(spark)
    out = scratch_path(spark, "bans-arrival")
    ckpt = scratch_path(spark, "checkpoints", "bans-arrival")
    in_batches(spark, sf_dir, lambda records: ban_job(
        spark, records, C, out, ckpt, time="arrival", parse="strict", precision="ms",
        trigger="availableNow"))
    return current_bans(read_ban_log(spark, out)).select("ip", "period", "reason")


def stream_incidents_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive job (append mode) in several batches with late records: a
    window is written once, when the watermark passes its end, without the
    records that came after that."""
    ensure_utc(spark)
    out = scratch_path(spark, "archive-late")
    ckpt = scratch_path(spark, "checkpoints", "archive-late")
    in_batches(spark, sf_dir, lambda records: archive_job(
        spark, records, C, out, ckpt, trigger="availableNow"))
    return spark.read.schema(INCIDENT).parquet(out).select(*INCIDENT.names)


def stream_incidents_by_slide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrival-time windows from one ring of panes per ip, in several batches
    with late records: every slide that the watermark reaches judges each ip
    that is still in its window, once."""
    ensure_utc(spark)
    out = scratch_path(spark, "archive-slides")
    ckpt = scratch_path(spark, "checkpoints", "archive-slides")
    in_batches(spark, sf_dir, lambda records: archive_job(
        spark, records, C, out, ckpt, time="arrival", emit="slide", trigger="availableNow"))
    return spark.read.schema(SLIDE_INCIDENT).parquet(out).select(*SLIDE_INCIDENT.names)


def stream_open_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stopped archive job of `stream_incidents_late` still holds:
    every open (ip, window) with its counts, read from the checkpoint."""
    ensure_utc(spark)
    out = scratch_path(spark, "archive-open")
    ckpt = scratch_path(spark, "checkpoints", "archive-open")
    in_batches(spark, sf_dir, lambda records: archive_job(
        spark, records, C, out, ckpt, trigger="availableNow"))
    return open_windows(spark, ckpt)


def stream_incidents_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive job with equal incidents of overlapping windows once: a
    deduplication within the watermark behind the aggregate."""
    ensure_utc(spark)
    out = scratch_path(spark, "archive-distinct")
    ckpt = scratch_path(spark, "checkpoints", "archive-distinct")

    in_batches(spark, sf_dir, lambda records: archive_job(
        spark, records, C, out, ckpt, distinct=True, trigger="availableNow"))
    return spark.read.schema(INCIDENT).parquet(out).select(*INCIDENT.names)


def stream_incidents_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic that delivers a tenth of its records twice, counted once by
    (topic, partition, offset)."""
    ensure_utc(spark)
    out = scratch_path(spark, "archive-redelivered")
    ckpt = scratch_path(spark, "checkpoints", "archive-redelivered")

    in_batches(spark, sf_dir, lambda records: archive_job(
        spark, records, C, out, ckpt, once=True, trigger="availableNow"), again_every=10)
    return spark.read.schema(INCIDENT).parquet(out).select(*INCIDENT.names)


def stream_incidents_two_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two topics with their own watermarks, the events of odd ids a week behind
    the others, under both policies: `min` waits for the slow topic, `max`
    follows the fast one and drops what the slow one brings too late."""
    ensure_utc(spark)
    events = read_table(spark, sf_dir, "events")
    topics = [scratch_path(spark, "topic") for _ in (0, 1)]
    for n, topic in enumerate(topics):
        mine = events.where(F.col("event_id") % 2 == n)
        write_deliveries(mine.withColumn("batch", F.least(_quarter() + n, F.lit(BATCHES - 1))), topic, f"clicks-{n}")
    found = None
    for policy in ("min", "max"):
        out = scratch_path(spark, "archive-topics")
        ckpt = scratch_path(spark, "checkpoints", "archive-topics")
        with session_conf(spark, {"spark.sql.streaming.multipleWatermarkPolicy": policy}):
            for i in range(BATCHES):
                streams = [parse_lenient(delivered(spark, t, i)) for t in topics]
                _finish(archive_sink(find_incidents_of_topics(streams, C), out, ckpt)
                        .trigger(availableNow=True).start())
        got = spark.read.schema(INCIDENT).parquet(out).select(F.lit(policy).alias("policy"), *INCIDENT.names)
        found = got if found is None else found.unionByName(got)
    return found


def stream_batch_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of the batches of `stream_incidents_late` read, how many rows
    came too late for their window and how many incidents it emitted, as the
    job's listener wrote it down."""
    ensure_utc(spark)
    out = scratch_path(spark, "archive-report")
    ckpt = scratch_path(spark, "checkpoints", "archive-report")
    report = BatchReport(spark, scratch_path(spark, "report"), out="incidents")
    runs: list[str] = []

    def run(records):
        found = detect(spark, measured(records, "records"), C, "plain")
        q = archive_sink(measured(found, "incidents"), out, ckpt).trigger(availableNow=True).start()
        runs.append(str(q.runId))
        q.awaitTermination()
        report.wait(q)
        return q

    spark.streams.addListener(report)
    try:
        in_batches(spark, sf_dir, run)
    finally:
        spark.streams.removeListener(report)
    report.flush()
    order = spark.createDataFrame(list(enumerate(runs)), "delivery int, run string")
    return (read_report(spark, report.path).join(F.broadcast(order), "run").groupBy("delivery")
            .agg(F.sum("input").alias("input"), F.sum("late").alias("late"), F.sum("emitted").alias("emitted"),
                 F.max_by("state_rows", "batch").alias("state_rows")))


def stream_queries() -> dict:
    return {
        "stream_incidents_append": stream_incidents_append,
        "stream_incidents_event_time": stream_incidents_event_time,
        "stream_bans_upsert": stream_bans_upsert,
        "stream_bans_rows": stream_bans_rows,
        "stream_counter": stream_counter,
        "stream_bans_by_arrival": stream_bans_by_arrival,
        "stream_incidents_late": stream_incidents_late,
        "stream_incidents_by_slide": stream_incidents_by_slide,
        "stream_open_windows": stream_open_windows,
        "stream_incidents_distinct": stream_incidents_distinct,
        "stream_incidents_redelivered": stream_incidents_redelivered,
        "stream_incidents_two_topics": stream_incidents_two_topics,
        "stream_batch_report": stream_batch_report,
    }

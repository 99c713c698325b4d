"""The streaming jobs. Each takes its source as a DataFrame (a Kafka
stream in production, Kafka-shaped files in tests) and returns a started
`StreamingQuery`.

Run from the command line, e.g.::

    python -m clickguard.streaming.jobs bans --brokers host:9092 \
        --ban-path s3://.../bans --checkpoint s3://.../ckpt/bans
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickguard.config import DetectorConfig
from clickguard.functions.parse import extract_key, judged, parse_lenient, parse_strict, quarantine
from clickguard.operators.arrival import find_incidents_by_arrival, with_batch_arrival
from clickguard.operators.arrival import skip_old as skip_old_events
from clickguard.operators.bans import ban_records
from clickguard.operators.counter import counter_totals
from clickguard.operators.incidents import (
    classify_windows,
    find_incidents,
    find_incidents_struct,
    find_incidents_typed,
    find_incidents_typed_aggregator,
)
from clickguard.operators.once import RECORD, find_distinct_incidents, find_incidents_once
from clickguard.plans.sql import find_incidents_sql
from clickguard.session import ROCKSDB_STATE, apply_base_conf, session_conf
from clickguard.sources.spool import FILE, file_report, with_file
from clickguard.streaming.slides import slide_stats
from clickguard.streaming.sinks import (
    BanLogWriter,
    JsonLinesForeachWriter,
    UpsertLogWriter,
    archive_sink,
    console_sink,
    read_ban_log,
    run_key,
)

DETECTORS = {
    "plain": lambda spark, df, conf: find_incidents(df, conf),
    "sql": lambda spark, df, conf: find_incidents_sql(spark, df, conf),
    "struct": lambda spark, df, conf: find_incidents_struct(df, conf),
    "typed": lambda spark, df, conf: find_incidents_typed(df, conf),
    "aggregator": lambda spark, df, conf: find_incidents_typed_aggregator(df, conf),
}


def _start(writer, trigger: str | None, explain_df: DataFrame | None = None):
    """Start the query; with `explain_df`, print that streaming frame's
    extended plan, then the running query's (its last executed micro-batch;
    a just-started query may have none yet)."""
    if explain_df is not None:
        explain_df.explain(True)
    q = _trigger(writer, trigger).start()
    if explain_df is not None:
        q.explain(True)
    return q


def _trigger(writer, trigger: str | None):
    if trigger is None:
        return writer
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def detect(spark: SparkSession, records: DataFrame, conf: DetectorConfig,
           detector: str = "sql", time: str = "event",
           parse: str = "lenient", skip_old: bool = False,
           emit: str = "change", once: bool = False, distinct: bool = False) -> DataFrame:
    """Kafka-shaped records -> incidents.

    `time="event"`: event-time windows with watermark; `time="arrival"`:
    windows over the record timestamp (the broker's append time), which may be
    as late as the watermark says; `time="batch"`: windows over the
    micro-batch time, which is never late. `skip_old` drops events older than
    a window at their arrival.

    `emit="change"` keeps the windows in state, for update mode (a window is
    judged whenever it changes) or append mode (once, when it closes).
    `emit="slide"` keeps panes: every ip still in a window is judged once per
    slide, with the window's end, in append mode.

    `once` counts a record that is delivered again (same topic, partition and
    offset) once, `distinct` reports equal incidents of overlapping windows
    once; both are for event time and append mode.
    """
    keep = ("timestamp", *(RECORD if once else ()))
    if parse == "lenient":
        events = parse_lenient(records, keep=keep)
    elif parse == "strict":
        events = parse_strict(records, keep=keep)
    else:
        raise ValueError(f"parse must be lenient or strict, not {parse!r}")
    if once or distinct:
        if time != "event" or emit != "change" or skip_old or (once and distinct):
            raise ValueError("once or distinct is for time='event', emit='change', without skip_old")
        return find_incidents_once(events, conf) if once else find_distinct_incidents(events, conf)
    if emit == "slide":
        return _by_slide(events, conf, time, skip_old)
    if emit != "change":
        raise ValueError(f"emit must be change or slide, not {emit!r}")
    if time == "arrival":
        arrived = events.withColumnRenamed("timestamp", "arrival")
        return find_incidents_by_arrival(arrived, conf, skip_old_events=skip_old)
    if time == "batch":
        return find_incidents_by_arrival(with_batch_arrival(events.drop("timestamp")), conf,
                                         skip_old_events=skip_old, delay="0 seconds")
    if skip_old:
        raise ValueError("skip_old needs an arrival: time='arrival' or 'batch'")
    events = events.drop("timestamp")
    return DETECTORS[detector](spark, events, conf)


def _by_slide(events: DataFrame, conf: DetectorConfig, time: str, skip_old: bool) -> DataFrame:
    group, delay = {"event": ("eventTime", None), "arrival": ("arrival", None),
                    "batch": ("arrival", "0 seconds")}[time]
    if time == "batch":
        events = with_batch_arrival(events)
    elif time == "arrival":
        events = events.withColumnRenamed("timestamp", "arrival")
    if skip_old:
        if time == "event":
            raise ValueError("skip_old needs an arrival: time='arrival' or 'batch'")
        events = skip_old_events(events, conf)
    stats = slide_stats(events, conf, "eventTime", group, delay)
    return classify_windows(stats.withColumn("windowEnd", F.col("window.end")), conf, keep=("windowEnd",))


def ban_job(spark: SparkSession, records: DataFrame, conf: DetectorConfig,
            ban_path: str, checkpoint: str, detector: str = "sql",
            time: str = "event", parse: str = "lenient", precision: str = "s",
            trigger: str | None = None, run_id: str | None = None,
            explain: bool = False, skip_old: bool = False,
            options: dict[str, str] | None = None, sink: str = "log",
            emit: str = "change"):
    """Records -> incidents -> ban records upserted with a TTL of the ban
    time (update mode; a window is judged again whenever it changes, or with
    ``emit="slide"`` once per slide, in append mode).

    `options` (`ban.columns`, `ban.ttl`; see `validate_ban_sink_options`)
    override the table's column names and TTL. ``sink="rows"`` writes JSON
    lines row by row instead of the log.
    """
    incidents = detect(spark, records, conf, detector, time, parse, skip_old, emit)
    bans = ban_records(incidents, conf, precision)
    w = bans.writeStream.outputMode("append" if emit == "slide" else "update").option("checkpointLocation", checkpoint)
    settings = {"ban.columns": "ip,period,reason", "ban.ttl": str(conf.ban_us // 1_000_000),
                **(options or {}), "ban.path": ban_path}
    writer = BanLogWriter.from_options(settings, run_id, checkpoint)
    if sink == "rows":
        w = w.foreach(JsonLinesForeachWriter(spark, ban_path, checkpoint, writer.ttl_s))
    elif sink == "log":
        w = w.foreachBatch(writer)
    else:
        raise ValueError(f"sink must be log or rows, not {sink!r}")
    with session_conf(spark, ROCKSDB_STATE if emit == "slide" else {}):
        return _start(w, trigger, bans if explain else None)


def archive_job(spark: SparkSession, records: DataFrame, conf: DetectorConfig,
                path: str, checkpoint: str, partition_by: str = "day",
                trigger: str | None = None, explain: bool = False,
                files_per_partition: int | None = None,
                time: str = "event", emit: str = "change",
                once: bool = False, distinct: bool = False):
    """Records -> incidents appended to parquet once their window closes
    (watermark past the window end); with ``emit="slide"`` with that end.
    `once` and `distinct` as in `detect`."""
    incidents = detect(spark, records, conf, "plain", time, emit=emit, once=once, distinct=distinct)
    with session_conf(spark, ROCKSDB_STATE if emit == "slide" else {}):
        return _start(archive_sink(incidents, path, checkpoint, partition_by,
                                      files_per_partition), trigger,
                      incidents if explain else None)


def console_job(spark: SparkSession, records: DataFrame, conf: DetectorConfig,
                checkpoint: str, trigger: str | None = None, explain: bool = True):
    """Records -> incidents (typed form, times to the second) on the
    console, 50 rows per batch, untruncated."""
    incidents = detect(spark, records, conf, "typed")
    w = console_sink(incidents).option("checkpointLocation", checkpoint)
    return _start(w, trigger, incidents if explain else None)


def counter_job(spark: SparkSession, rows: DataFrame, checkpoint: str,
                path: str | None = None, trigger: str | None = "10 seconds",
                explain: bool = False):
    """Running totals per key (update mode) to the console or, with
    `path`, to an upsert log."""
    totals = counter_totals(rows)
    if path is None:
        w = console_sink(totals)
    else:
        w = (totals.writeStream.outputMode("update")
             .foreachBatch(UpsertLogWriter(path, checkpoint=checkpoint)))
    return _start(w.option("checkpointLocation", checkpoint), trigger,
                  totals if explain else None)


def keyed_lines(lines: DataFrame) -> DataFrame:
    """Spool lines -> `(key, value)` with the ip the agent extracts as key."""
    return lines.select(extract_key("value").alias("key"), F.col("value"))


def spool_ingest_job(spark: SparkSession, lines: DataFrame, path: str,
                     quarantine_path: str, checkpoint: str,
                     trigger: str | None = None,
                     topic: dict[str, str] | None = None,
                     report_path: str | None = None, error_path: str | None = None):
    """Spool lines -> keyed records, as parquet that `keyed_stream` reads or,
    with `topic` (options of Spark's kafka sink: `kafka.bootstrap.servers`,
    `topic`), on a topic that the other jobs read; lines the strict parser
    rejects also go to quarantine. A record's timestamp is when it was read.

    With `report_path`, `lines` having the columns of `with_file`, each batch
    adds a row per file read (`file_report`). With `error_path` too, the files
    that have any rejected line are set aside: all their lines, as they were, in
    a folder that the report's `aside` names."""
    files = FILE if report_path else ()
    keyed = (lines.select(extract_key("value").alias("key"), "value", *files)
             .withColumn("timestamp", F.current_timestamp()))

    def report(batch: DataFrame, folder: str) -> None:
        status = file_report(judged(batch, keep=FILE), F.col("reason").isNotNull())
        aside = F.concat(F.lit(f"{error_path}/{folder}/file_id="), F.md5("file")) if error_path else F.lit(None)
        status = status.withColumn("aside", F.when(F.col("status") == "error", aside.cast("string")))
        status.write.mode("overwrite").parquet(f"{report_path}/{folder}")
        if error_path:
            bad = (spark.read.schema(status.schema).parquet(f"{report_path}/{folder}")
                   .where("status = 'error'").select(F.col("file").alias("bad_file")))
            (batch.join(bad, F.col("file") == F.col("bad_file"), "left_semi")
             .select("value", F.md5("file").alias("file_id")).write.mode("overwrite")
             .partitionBy("file_id").text(f"{error_path}/{folder}"))

    def write(batch: DataFrame, batch_id: int) -> None:
        run = run_key(spark, checkpoint)   # a replayed batch overwrites itself, a new run never does
        batch.persist()
        try:
            if topic:
                batch.select("key", "value").write.format("kafka").options(**topic).save()
            else:
                (batch.select("key", "value", "timestamp").write.mode("overwrite")
                 .parquet(f"{path}/run={run}/batch={batch_id}"))
            (quarantine(batch, keep=("key",)).write.mode("overwrite")
             .parquet(f"{quarantine_path}/run={run}/batch={batch_id}"))
            if report_path:
                report(batch, f"run={run}/batch={batch_id}")
        finally:
            batch.unpersist()

    w = (keyed.writeStream.foreachBatch(write)
         .option("checkpointLocation", checkpoint))
    return _start(w, trigger)


def compact_job(spark: SparkSession, ban_path: str, out: str, before: str,
                snapshot: str | None = None, snapshot_cut: str | None = None) -> None:
    """Batch job: fold the ban log's days before `before` (and a previous
    snapshot cut at `snapshot_cut`, if given) into a new snapshot at `out`.
    Views then read `with_snapshot(snapshot, log, before)`; the old days
    stay in place (nothing is deleted) and are skipped at the scan. The
    output is a pure function of its inputs, so a run lost half way is
    simply run again (the write overwrites `out`)."""
    from clickguard.operators.bans import compact_bans, with_snapshot

    if snapshot is not None and snapshot.rstrip("/") == out.rstrip("/"):
        raise ValueError("the new snapshot must go to another path than the one it reads")
    if snapshot is None:
        log = read_ban_log(spark, ban_path)
    else:
        if snapshot_cut is None:
            raise ValueError("a previous snapshot needs its cut day")
        # only the days between the two cuts are opened
        last = (dt.date.fromisoformat(before) - dt.timedelta(days=1)).isoformat()
        days = read_ban_log(spark, ban_path, since=snapshot_cut, until=last)
        log = with_snapshot(spark.read.parquet(snapshot), days, snapshot_cut)
    compact_bans(log, before).write.mode("overwrite").parquet(out)


def main(argv: list[str] | None = None) -> None:
    from clickguard.config import KafkaConfig
    from clickguard.sources.counter import counter_stream
    from clickguard.sources.kafka import kafka_stream_from
    from clickguard.sources.spool import keyed_stream, spool_stream

    ap = argparse.ArgumentParser(prog="clickguard.streaming.jobs")
    ap.add_argument("job", choices=["bans", "archive", "console", "counter", "spool", "compact"])
    ap.add_argument("--brokers", default=KafkaConfig.brokers)
    ap.add_argument("--topic", action="append")
    ap.add_argument("--starting-offsets", default="earliest")
    ap.add_argument("--group", default=KafkaConfig.group_id_prefix,
                    help="consumer group name prefix")
    ap.add_argument("--max-offsets", type=int, default=1_000_000)
    ap.add_argument("--fetch-bytes", type=int,
                    help="kafka.max.partition.fetch.bytes per partition")
    ap.add_argument("--checkpoint", help="required by every streaming job")
    ap.add_argument("--ban-path")
    ap.add_argument("--archive-path")
    ap.add_argument("--archive-partition", default="day", choices=["day", "ip"])
    ap.add_argument("--archive-files", type=int,
                    help="write tasks per archive partition and batch "
                         "(default: the state partitions)")
    ap.add_argument("--snapshot-out", help="compact: where the new snapshot is written")
    ap.add_argument("--before", help="compact: first day (YYYY-MM-DD, UTC) not compacted")
    ap.add_argument("--snapshot", help="compact: previous snapshot to fold in")
    ap.add_argument("--snapshot-cut", help="compact: the previous snapshot's cut day")
    ap.add_argument("--spool-dir")
    ap.add_argument("--spool-archive")
    ap.add_argument("--max-files", type=int,
                    help="spool: files per micro-batch (maxFilesPerTrigger)")
    ap.add_argument("--keyed-path", help="spool: where keyed records go; with --from-spool "
                                         "bans, archive and console read them from there")
    ap.add_argument("--from-spool", action="store_true")
    ap.add_argument("--spool-topic", help="spool: put the records on this topic instead")
    ap.add_argument("--quarantine-path")
    ap.add_argument("--report-path", help="spool: a row per file read, finished or error")
    ap.add_argument("--error-path", help="spool: where files with rejected lines are set aside")
    ap.add_argument("--detector", default="sql", choices=sorted(DETECTORS))
    ap.add_argument("--time", default="event", choices=["event", "arrival", "batch"])
    ap.add_argument("--emit", default="change", choices=["change", "slide"],
                    help="bans and archive: judge windows when they change (or close), "
                         "or every ip once per slide")
    ap.add_argument("--parse", default="lenient", choices=["lenient", "strict"])
    ap.add_argument("--precision", default="s", choices=["s", "ms"])
    ap.add_argument("--once", action="store_true",
                    help="archive: count records that are delivered again once")
    ap.add_argument("--distinct", action="store_true",
                    help="archive: report equal incidents of overlapping windows once")
    ap.add_argument("--skip-old", action="store_true",
                    help="bans by arrival: drop events older than a window at arrival")
    ap.add_argument("--ban-sink", default="log", choices=["log", "rows"])
    ap.add_argument("--ban-columns", help="what ip, period and reason are called in the table")
    ap.add_argument("--ban-ttl", help="seconds; default: the ban time")
    ap.add_argument("--window", default=DetectorConfig.window)
    ap.add_argument("--slide", default=DetectorConfig.slide)
    ap.add_argument("--watermark", default=DetectorConfig.watermark)
    ap.add_argument("--min-events", type=int, default=DetectorConfig.min_events)
    ap.add_argument("--max-events", type=int, default=DetectorConfig.max_events)
    ap.add_argument("--min-rate", type=float, default=DetectorConfig.min_rate)
    ap.add_argument("--ban-time", default=DetectorConfig.ban_time)
    ap.add_argument("--trigger", help="processing-time interval, 'once' or 'availableNow'")
    ap.add_argument("--explain", action="store_true")
    ap.add_argument("--shuffle-partitions", type=int,
                    help="state partitions of a new checkpoint (fixed afterwards); "
                         "see clickguard.session.shuffle_partitions_for")
    a = ap.parse_args(argv)
    if a.job != "compact" and not a.checkpoint:
        ap.error(f"{a.job} needs --checkpoint")
    if a.job == "compact" and not (a.ban_path and a.snapshot_out and a.before):
        ap.error("compact needs --ban-path, --snapshot-out and --before")
    spark = SparkSession.builder.appName(f"clickguard-{a.job}").getOrCreate()
    apply_base_conf(spark)
    if a.job == "compact":
        compact_job(spark, a.ban_path, a.snapshot_out, a.before, a.snapshot, a.snapshot_cut)
        return
    if a.shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(a.shuffle_partitions))
    conf = DetectorConfig(window=a.window, slide=a.slide, watermark=a.watermark,
                          min_events=a.min_events, max_events=a.max_events,
                          min_rate=a.min_rate, ban_time=a.ban_time)
    opts = {"kafka.max.partition.fetch.bytes": str(a.fetch_bytes)} if a.fetch_bytes else {}
    kconf = KafkaConfig(brokers=a.brokers, topics=tuple(a.topic or KafkaConfig.topics),
                        starting_offsets=a.starting_offsets, group_id_prefix=a.group,
                        max_offsets_per_trigger=a.max_offsets, options=opts)
    if a.job == "counter":
        q = counter_job(spark, counter_stream(spark), a.checkpoint,
                        trigger=a.trigger or "10 seconds", explain=a.explain)
    elif a.job == "spool":
        lines = spool_stream(spark, a.spool_dir, max_files_per_trigger=a.max_files,
                             archive_dir=a.spool_archive)
        if a.report_path:
            lines = with_file(lines)
        q = spool_ingest_job(spark, lines, a.keyed_path, a.quarantine_path, a.checkpoint,
                             trigger=a.trigger, report_path=a.report_path, error_path=a.error_path, topic=a.spool_topic and {
                                 "kafka.bootstrap.servers": a.brokers, "topic": a.spool_topic})
    else:
        records = (keyed_stream(spark, a.keyed_path, a.max_files) if a.from_spool
                   else kafka_stream_from(spark, kconf))
        if a.job == "bans":
            given = {"ban.columns": a.ban_columns, "ban.ttl": a.ban_ttl}
            q = ban_job(spark, records, conf, a.ban_path, a.checkpoint, a.detector,
                        a.time, a.parse, a.precision, trigger=a.trigger, explain=a.explain,
                        skip_old=a.skip_old, sink=a.ban_sink, emit=a.emit,
                        options={k: v for k, v in given.items() if v is not None})
        elif a.job == "archive":
            q = archive_job(spark, records, conf, a.archive_path, a.checkpoint,
                            a.archive_partition, trigger=a.trigger, explain=a.explain,
                            files_per_partition=a.archive_files, time=a.time, emit=a.emit,
                            once=a.once, distinct=a.distinct)
        else:
            q = console_job(spark, records, conf, a.checkpoint, trigger=a.trigger)
    q.awaitTermination()


if __name__ == "__main__":
    main()

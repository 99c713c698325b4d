"""The registered queries: each takes (spark, sf_dir) and returns a
DataFrame over the driver's tables. `__spark_entry__.queries()` exposes
them; `clickguard.oracle` holds the DuckDB SQL each is checked against.

All run over the whole `events` table with `EVENTS_CONFIG` (1-day windows
sliding by 6 hours, min 2, max 5, rate 0.5, ban 1 day).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickguard.config import EVENTS_CONFIG as C
from clickguard.functions.parse import extract_key, judged, parse_lenient, parse_strict, quarantine
from clickguard.operators import bans
from clickguard.operators.archive import archive_lookup as _archive_lookup
from clickguard.operators.archive import spark_rows, write_clustered
from clickguard.operators.arrival import find_incidents_by_arrival, with_arrival_lag
from clickguard.operators.ban_table import BanTable
from clickguard.operators.counter import counter_totals as _counter_totals
from clickguard.operators.incidents import (
    find_incidents,
    find_incidents_struct,
    find_incidents_typed,
    find_incidents_typed_aggregator,
)
from clickguard.operators.rollup import Rollup
from clickguard.operators.windows import (
    merge_partials,
    window_event_stats as _window_event_stats,
)
from clickguard.plans.functions import create_functions
from clickguard.plans.sql import find_incidents_sql
from clickguard.session import ensure_utc, scratch_path
from clickguard.streaming.sinks import read_ban_log
from clickguard.sources.counter import events_as_counter_rows
from clickguard.sources.kafka import kafka_records
from clickguard.sources.spool import FILE, file_report, spool_batch, with_file
from clickguard.sources.tables import click_events, read_table

Query = Callable[[SparkSession, str], DataFrame]


def _events(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    ensure_utc(spark)
    return click_events(spark, sf_dir, keep)


def window_event_stats(spark, sf_dir):
    return _window_event_stats(_events(spark, sf_dir), C)


def incidents(spark, sf_dir):
    return find_incidents(_events(spark, sf_dir), C)


def incidents_sql(spark, sf_dir):
    return find_incidents_sql(spark, _events(spark, sf_dir), C)


def incidents_struct(spark, sf_dir):
    return find_incidents_struct(_events(spark, sf_dir), C)


def incidents_formatted(spark, sf_dir):
    return find_incidents_typed(_events(spark, sf_dir), C)


def incidents_require_action(spark, sf_dir):
    return find_incidents_typed_aggregator(_events(spark, sf_dir), C)


def _events_with_nulls(spark, sf_dir):
    """The events with nulls in each detector column, by the event's id."""
    ev = _events(spark, sf_dir, keep=("event_id",))

    def holes(c, every):
        return F.when(F.col("event_id") % every != 0, F.col(c)).alias(c)

    return ev.select(holes("ip", 13), holes("action", 7), holes("eventTime", 11))


def incidents_nulls(spark, sf_dir):
    """Nulls kept: events without ip are one more address, an unknown action
    moves first and last only, an event without time is in no window."""
    return find_incidents(_events_with_nulls(spark, sf_dir), C)


def incidents_nulls_typed(spark, sf_dir):
    """Rows without ip or time are dropped first."""
    return find_incidents_typed(_events_with_nulls(spark, sf_dir), C)


def incidents_nulls_aggregator(spark, sf_dir):
    """Rows without ip or action are dropped first."""
    return find_incidents_typed_aggregator(_events_with_nulls(spark, sf_dir), C)


def incidents_distinct_sorted(spark, sf_dir):
    return find_incidents(_events(spark, sf_dir), C).distinct().sort("lastEvent", "reason")


def incidents_panes(spark, sf_dir):
    return find_incidents(_events(spark, sf_dir), C, strategy="panes")


def window_event_stats_panes(spark, sf_dir):
    return _window_event_stats(_events(spark, sf_dir), C, strategy="panes")


def incidents_hourly_slide(spark, sf_dir):
    """1-day windows sliding hourly: a fan-out of 24, where `auto` picks
    pane pre-aggregation."""
    return find_incidents(_events(spark, sf_dir), C.with_(slide="1 hour"))


def incidents_by_batch_time(spark, sf_dir):
    """Arrival-time windows with arrivals rounded up to hourly micro-batch
    times, as a micro-batch engine with a 1-hour interval sees them."""
    return find_incidents_by_arrival(_arrivals(spark, sf_dir), C.with_(batch="1 hour"),
                                     quantize_to_batch=True, with_window=True)


def _arrivals(spark, sf_dir):
    return with_arrival_lag(_events(spark, sf_dir, keep=("value",))).drop("value")


def incidents_by_arrival(spark, sf_dir):
    return find_incidents_by_arrival(_arrivals(spark, sf_dir), C, with_window=True)


def incidents_by_arrival_skip_old(spark, sf_dir):
    return find_incidents_by_arrival(_arrivals(spark, sf_dir), C, skip_old_events=True,
                                     with_window=True)


def ban_records(spark, sf_dir):
    return bans.ban_records(find_incidents(_events(spark, sf_dir), C), C, precision="s")


def ban_records_ms(spark, sf_dir):
    return bans.ban_records(find_incidents(_events(spark, sf_dir), C), C, precision="ms")


def current_bans(spark, sf_dir):
    """Bans in force at the newest write of the replayed log. The log is
    first written as a parquet table in the shared folder, as a live ban
    table would be, so the as-of subquery (one column) and the per-ip pick
    both scan it instead of recomputing the detector twice."""
    path = scratch_path(spark, "ban-log-replay")
    log = bans.replay_ban_log(find_incidents(_events(spark, sf_dir), C), C)
    log.write.parquet(path)
    return bans.current_bans(spark.read.schema(log.schema).parquet(path))


def current_bans_compacted(spark, sf_dir):
    """`current_bans` read through a compacted log: the replayed log is
    written partitioned by write date, every day before the newest is
    compacted into a snapshot (last write per ip, expired ones dropped), and
    the view reads the snapshot plus the newest day. Equals `current_bans`."""
    ensure_utc(spark)
    path = scratch_path(spark, "ban-log-replay")
    (bans.replay_ban_log(find_incidents(_events(spark, sf_dir), C), C)
     .withColumn("written_date", bans.utc_day(F.col("written_at")))
     .write.partitionBy("written_date").parquet(path))
    log = read_ban_log(spark, path)
    # the cut is one scalar: the newest write day (a daily compaction job
    # takes it from the calendar instead); any day does for an empty log
    newest = log.agg(F.max("written_date")).first()[0]
    cut = newest.isoformat() if newest else "1970-01-01"
    snap = scratch_path(spark, "ban-snapshot")
    old = bans.compact_bans(log, cut)
    old.write.parquet(snap)
    # the view opens only the days from the cut on (older folders unlisted)
    recent = read_ban_log(spark, path, since=cut, until=cut)
    return bans.current_bans(bans.with_snapshot(spark.read.schema(old.schema).parquet(snap), recent, cut))


def _records(spark, sf_dir):
    ensure_utc(spark)
    return kafka_records(read_table(spark, sf_dir, "events"))


def parse_lenient_q(spark, sf_dir):
    return parse_lenient(_records(spark, sf_dir), keep=("offset",))


def parse_strict_q(spark, sf_dir):
    return parse_strict(_records(spark, sf_dir), keep=("offset",))


def parse_quarantine(spark, sf_dir):
    return quarantine(_records(spark, sf_dir), keep=("offset",))


def key_extract(spark, sf_dir):
    recs = _records(spark, sf_dir)
    return recs.select("offset", extract_key("value").alias("key"))


def incidents_from_messages(spark, sf_dir):
    """The Kafka -> detector -> ban path in batch: lenient parse, SQL
    detector, ban records to whole seconds."""
    parsed = parse_lenient(_records(spark, sf_dir))
    return bans.ban_records(find_incidents_sql(spark, parsed, C), C, precision="s")


def incidents_from_messages_strict(spark, sf_dir):
    """The micro-batch job's path in batch: strict parse, arrival = the
    record timestamp, arrival-time windows, ban records in ms."""
    parsed = parse_strict(_records(spark, sf_dir), keep=("timestamp",))
    inc = find_incidents_by_arrival(parsed.withColumnRenamed("timestamp", "arrival"), C)
    return bans.ban_records(inc, C, precision="ms")


def incidents_from_spool_lines(spark, sf_dir):
    """The spool path: message lines (one per `events` row), keyed by the
    agent's ip regex, parsed leniently (ip from that key), detector, ban
    records."""
    from clickguard.sources.kafka import with_message
    from clickguard.streaming.jobs import keyed_lines

    ensure_utc(spark)
    lines = keyed_lines(with_message(read_table(spark, sf_dir, "events"), "_msg")
                        .select(F.col("_msg").alias("value")))
    parsed = parse_lenient(lines)
    return bans.ban_records(find_incidents(parsed, C), C, precision="s")


def incidents_from_spool_files(spark, sf_dir):
    """As `incidents_from_spool_lines`, through files: the lines are written
    to a spool folder and read from it."""
    from clickguard.sources.kafka import with_message
    from clickguard.streaming.jobs import keyed_lines

    ensure_utc(spark)
    folder = scratch_path(spark, "spool")
    (with_message(read_table(spark, sf_dir, "events"), "_msg")
     .select(F.col("_msg").alias("value")).write.text(folder))
    parsed = parse_lenient(keyed_lines(spool_batch(spark, folder, "*.txt")))
    return bans.ban_records(find_incidents(parsed, C), C, precision="s")


def incidents_sql_functions(spark, sf_dir):
    """The detector as a call of SQL functions only."""
    _events(spark, sf_dir).createOrReplaceTempView("click_events")
    create_functions(spark, C, "click_events")
    return spark.sql("SELECT * FROM incidents_since(NULL)")


def suspicious_windows_sql(spark, sf_dir):
    """A statement of a user's own over the same functions: per ip, how many
    windows are suspicious, of how many, and the lowest rate of one."""
    _events(spark, sf_dir).createOrReplaceTempView("click_events")
    create_functions(spark, C, "click_events")
    return spark.sql("""
        SELECT ip, count(*) AS windows, count_if(is_suspicious(clicks, watches)) AS suspicious,
               min(watch_rate(clicks, watches)) AS lowest_rate
        FROM event_windows() GROUP BY ip""")


def _ban_table(spark, sf_dir, conf=C) -> BanTable:
    """The replayed ban log written to a keyed table week by week, so that runs
    are merged on the way."""
    ensure_utc(spark)
    path = scratch_path(spark, "ban-log-replay")
    log = bans.replay_ban_log(find_incidents(_events(spark, sf_dir), conf), conf)
    log.write.parquet(path)
    log = spark.read.schema(log.schema).parquet(path)
    table = BanTable(spark, scratch_path(spark, "ban-table"), buckets=16, fanout=2)
    week = F.floor((F.dayofmonth("written_at") - 1) / 8)
    for i in range(4):
        table.append(log.where(week == i))
    return table


def bans_of(spark, sf_dir):
    """The bans in force of every twentieth address, looked up in the keyed
    table; bans last 14 days here."""
    asked = _events(spark, sf_dir).where("ip % 20 = 0").select("ip").distinct()
    return _ban_table(spark, sf_dir, C.with_(ban_time="14 days")).bans_of(asked)


def current_bans_keyed(spark, sf_dir):
    """All bans in force, from the keyed table."""
    return _ban_table(spark, sf_dir).bans()


def incidents_from_rollup(spark, sf_dir):
    """Incidents from a materialised rollup: all days but the last two are rolled
    up first, then those two, whose update renews only the windows they touch."""
    events = _events(spark, sf_dir)
    days = sorted(r[0] for r in events.select(bans.utc_day(F.col("eventTime"))).distinct().collect() if r[0])
    rollup = Rollup(spark, scratch_path(spark, "rollup"), C)
    for some in (days[:-2], days[-2:]):
        rollup.update(events, some)
    return rollup.incidents() if days else find_incidents(events, C)


def _archive(spark, sf_dir, files: int = 32) -> str:
    path = scratch_path(spark, "clustered-archive")
    write_clustered(find_incidents(_events(spark, sf_dir), C), path, files)
    return path


def archive_lookup(spark, sf_dir):
    """The incidents of the address that has most of them, and those of the last
    day, found in the clustered archive through its files' rectangles."""
    path = _archive(spark, sf_dir)
    rows = spark_rows(spark, path)
    top = (rows.groupBy("ip").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "ip").first())
    last = rows.agg(F.max("lastEvent")).first()[0]
    if top is None:
        return rows.select(F.lit("ip").alias("asked"), "ip", "lastEvent", "reason")
    day = last.replace(hour=0, minute=0, second=0, microsecond=0)
    parts = {"ip": _archive_lookup(spark, path, ip=top.ip), "day": _archive_lookup(spark, path, since=day),
             "both": _archive_lookup(spark, path, ip=top.ip, since=day)}
    out = None
    for asked, found in parts.items():
        found = found.select(F.lit(asked).alias("asked"), "*")
        out = found if out is None else out.unionByName(found)
    return out


def spool_file_report(spark, sf_dir):
    """Lines, rejects and status of every file of a spool folder: one file per
    value of the events' `props.k`, which says what form their messages have."""
    from clickguard.sources.kafka import with_message

    ensure_utc(spark)
    folder = scratch_path(spark, "spool")
    k = F.coalesce(F.get_json_object("props", "$.k").try_cast("int"), F.lit(-1))
    (with_message(read_table(spark, sf_dir, "events").withColumn("k", k), "_msg")
     .select(F.col("_msg").alias("value"), "k").repartition("k").write.partitionBy("k").text(folder))
    lines = with_file(spool_batch(spark, folder, "*.txt").select("value", "_metadata"))
    report = file_report(judged(lines, keep=FILE), F.col("reason").isNotNull())
    return report.select(F.regexp_extract("file", r"k=(-?\d+)", 1).cast("int").alias("k"),
                         "lines", "rejects", "status")


def merge_partial_aggregates(spark, sf_dir):
    """Partial aggregates per (ip, window, event type), as if each type
    came from its own topic, merged into per-(ip, window) aggregates."""
    ev = _events(spark, sf_dir, keep=("event_type",))
    from clickguard.functions.aggregate import aggregation_columns

    partials = (ev.groupBy("ip", F.window("eventTime", C.window_str, C.slide_str)
                           .alias("window"), "event_type")
                .agg(*aggregation_columns()))
    merged = merge_partials(partials, ["ip", "window"])
    return merged.select("ip", F.col("window.start").alias("window_start"),
                         F.col("window.end").alias("window_end"),
                         "clicks", "watches", "firstEvent", "lastEvent")


def counter_totals(spark, sf_dir):
    ensure_utc(spark)
    return _counter_totals(events_as_counter_rows(read_table(spark, sf_dir, "events")))


def queries() -> dict[str, Query]:
    from clickguard.streaming import replay

    return {
        "window_event_stats": window_event_stats,
        "incidents": incidents,
        "incidents_sql": incidents_sql,
        "incidents_struct": incidents_struct,
        "incidents_formatted": incidents_formatted,
        "incidents_require_action": incidents_require_action,
        "incidents_nulls": incidents_nulls,
        "incidents_nulls_typed": incidents_nulls_typed,
        "incidents_nulls_aggregator": incidents_nulls_aggregator,
        "incidents_distinct_sorted": incidents_distinct_sorted,
        "incidents_panes": incidents_panes,
        "window_event_stats_panes": window_event_stats_panes,
        "incidents_hourly_slide": incidents_hourly_slide,
        "incidents_by_batch_time": incidents_by_batch_time,
        "incidents_by_arrival": incidents_by_arrival,
        "incidents_by_arrival_skip_old": incidents_by_arrival_skip_old,
        "ban_records": ban_records,
        "ban_records_ms": ban_records_ms,
        "current_bans": current_bans,
        "current_bans_compacted": current_bans_compacted,
        "parse_lenient": parse_lenient_q,
        "parse_strict": parse_strict_q,
        "parse_quarantine": parse_quarantine,
        "key_extract": key_extract,
        "incidents_from_messages": incidents_from_messages,
        "incidents_from_messages_strict": incidents_from_messages_strict,
        "incidents_from_spool_lines": incidents_from_spool_lines,
        "incidents_from_spool_files": incidents_from_spool_files,
        "merge_partial_aggregates": merge_partial_aggregates,
        "incidents_sql_functions": incidents_sql_functions,
        "suspicious_windows_sql": suspicious_windows_sql,
        "bans_of": bans_of,
        "current_bans_keyed": current_bans_keyed,
        "incidents_from_rollup": incidents_from_rollup,
        "archive_lookup": archive_lookup,
        "spool_file_report": spool_file_report,
        "counter_totals": counter_totals,
        **replay.stream_queries(),
    }

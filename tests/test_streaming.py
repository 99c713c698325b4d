"""Structured Streaming: late data, append archive, update-mode bans,
counter source, spool ingest, stream == batch on closed windows."""

import datetime as dt
import json
import os
import time

import pytest

from pyspark.sql import functions as F

from clickguard.config import DetectorConfig
from clickguard.operators.incidents import find_incidents
from clickguard.operators.windows import window_event_stats
from clickguard.schema import EVENT
from conftest import at

CONF = DetectorConfig(window="10 seconds", slide="1 second", watermark="20 seconds",
                      min_events=2, max_events=4, min_rate=0.5)
IP = "10.10.10.10"

FILES = [
    [("watch", n) for n in range(5)],
    [("click", 100)],
    [("click", 101)],
    [("watch", 1)],      # late: the watermark is T+81 by now
    [("click", 102)],
]


def write_files(d, files):
    os.makedirs(d, exist_ok=True)
    base = time.time() - 1000
    for i, rows in enumerate(files):
        p = f"{d}/batch-{i:03d}.json"
        with open(p, "w") as f:
            for action, sec in rows:
                f.write(json.dumps({"ip": IP, "action": action,
                                    "eventTime": at(sec).isoformat()}) + "\n")
        os.utime(p, (base + i, base + i))


def event_stream(spark, d):
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).json(d)


def run_available(writer):
    q = writer.trigger(availableNow=True).start()
    assert q.awaitTermination(300)
    assert q.exception() is None
    return q


def test_late_row_dropped_by_watermark(spark, scratch):
    write_files(f"{scratch}/in", FILES)
    stats = window_event_stats(event_stream(spark, f"{scratch}/in"), CONF)
    q = run_available(stats.writeStream.outputMode("append").format("parquet")
                      .option("path", f"{scratch}/out")
                      .option("checkpointLocation", f"{scratch}/ckpt"))
    dropped = [(p["numInputRows"], sum(s.get("numRowsDroppedByWatermark", 0)
                                       for s in p["stateOperators"]))
               for p in q.recentProgress]
    # the late watch is dropped as ten window rows (10 s window, 1 s slide)
    assert (1, 10) in dropped
    assert sum(d for _, d in dropped) == 10


def test_append_archive_keeps_closed_windows(spark, scratch):
    write_files(f"{scratch}/in", FILES)
    stats = (window_event_stats(event_stream(spark, f"{scratch}/in"), CONF)
             .filter(F.col("watches") >= 4))
    run_available(stats.writeStream.outputMode("append").format("parquet")
                  .option("path", f"{scratch}/out")
                  .option("checkpointLocation", f"{scratch}/ckpt"))
    assert spark.read.parquet(f"{scratch}/out").count() == 8


def test_stream_equals_batch_on_closed_windows(spark, scratch):
    files = [[("watch", n) for n in range(5)] + [("click", 2), ("click", 3)],
             [("click", 200)]]
    write_files(f"{scratch}/in", files)
    inc = find_incidents(event_stream(spark, f"{scratch}/in"), CONF)
    run_available(inc.writeStream.outputMode("append").format("parquet")
                  .option("path", f"{scratch}/out")
                  .option("checkpointLocation", f"{scratch}/ckpt"))
    streamed = spark.read.parquet(f"{scratch}/out")
    batch = find_incidents(spark.read.schema(EVENT).json(f"{scratch}/in"), CONF)
    closed = batch.filter(F.col("lastEvent") < F.lit(at(150)))
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, closed.collect()))


def test_update_mode_ban_job(spark, scratch):
    from clickguard.operators.bans import current_bans
    from clickguard.sources.kafka import kafka_records, kafka_shaped_stream
    from clickguard.streaming.jobs import ban_job

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    kafka_records(events).write.parquet(f"{scratch}/topic")
    records = kafka_shaped_stream(spark, f"{scratch}/topic")
    from clickguard.config import EVENTS_CONFIG

    q = ban_job(spark, records, EVENTS_CONFIG, f"{scratch}/bans", f"{scratch}/ckpt",
                detector="plain", trigger="availableNow")
    assert q.awaitTermination(300) and q.exception() is None
    bans = current_bans(spark.read.parquet(f"{scratch}/bans"))
    assert bans.count() > 0
    assert bans.groupBy("ip").count().filter("count > 1").count() == 0


def test_arrival_time_ban_job(spark, scratch):
    from clickguard.config import EVENTS_CONFIG
    from clickguard.sources.kafka import kafka_records, kafka_shaped_stream
    from clickguard.streaming.jobs import ban_job

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    kafka_records(events).write.parquet(f"{scratch}/topic")
    q = ban_job(spark, kafka_shaped_stream(spark, f"{scratch}/topic"), EVENTS_CONFIG,
                f"{scratch}/bans", f"{scratch}/ckpt", time="arrival", parse="strict",
                precision="ms", trigger="availableNow")
    assert q.awaitTermination(300) and q.exception() is None
    assert spark.read.parquet(f"{scratch}/bans").count() > 0


def test_counter_source_totals(spark, scratch):
    from clickguard.operators.counter import counter_totals
    from clickguard.sources.counter import counter_stream
    from clickguard.streaming.sinks import UpsertLogWriter

    q = (counter_totals(counter_stream(spark, 10)).writeStream.outputMode("update")
         .foreachBatch(UpsertLogWriter(f"{scratch}/out", run_id="r"))
         .option("checkpointLocation", f"{scratch}/ckpt")
         .trigger(processingTime="0 seconds").start())
    try:
        deadline = time.time() + 120
        while time.time() < deadline:
            done = [p for p in q.recentProgress if p["numInputRows"] > 0]
            if len(done) >= 3:
                break
            time.sleep(0.2)
    finally:
        q.stop()
    log = spark.read.parquet(f"{scratch}/out")
    got = [(r["total"], r["first"], r["last"])
           for r in log.filter("batch < 3").orderBy("batch").collect()]
    assert got == [(45, 0, 9), (190, 0, 19), (435, 0, 29)]


def test_spool_ingest_job(spark, scratch):
    from clickguard.sources.spool import spool_stream
    from clickguard.streaming.jobs import spool_ingest_job

    os.makedirs(f"{scratch}/spool")
    with open(f"{scratch}/spool/a.log", "w") as f:
        f.write('{"type":"click","ip":"1.1.1.1","unix_time":1514800800,"url":"/a"}\n'
                "oops\n"
                '{"type": "watch", "ip": "2.2.2.2"}\n')
    q = spool_ingest_job(spark, spool_stream(spark, f"{scratch}/spool"), f"{scratch}/keyed",
                         f"{scratch}/quarantine", f"{scratch}/ckpt", trigger="availableNow")
    assert q.awaitTermination(300) and q.exception() is None
    keys = sorted((r["key"] or "") for r in spark.read.parquet(f"{scratch}/keyed").collect())
    assert keys == ["", "1.1.1.1", "2.2.2.2"]
    reasons = sorted(r["reason"] for r in spark.read.parquet(f"{scratch}/quarantine").collect())
    assert reasons == ["malformed json", "missing field: unix_time"]


def test_foreach_row_writer(spark, scratch):
    from clickguard.streaming.sinks import JsonLinesForeachWriter

    write_files(f"{scratch}/in", FILES[:1])
    q = (event_stream(spark, f"{scratch}/in").writeStream
         .foreach(JsonLinesForeachWriter(spark, f"{scratch}/rows", f"{scratch}/ckpt", ttl_s=60))
         .option("checkpointLocation", f"{scratch}/ckpt").trigger(availableNow=True).start())
    assert q.awaitTermination(300) and q.exception() is None
    n = 0
    for root, _, files in os.walk(f"{scratch}/rows"):
        for fn in files:
            with open(os.path.join(root, fn)) as f:
                rows = [json.loads(line) for line in f]
                assert all(r["expires"] > time.time() * 1000 for r in rows)
                n += len(rows)
    assert n == 5


def test_console_job_prints_plan_and_runs(spark, scratch, capsys):
    from clickguard.config import EVENTS_CONFIG
    from clickguard.sources.kafka import kafka_records, kafka_shaped_stream
    from clickguard.streaming.jobs import console_job

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    kafka_records(events).write.parquet(f"{scratch}/topic")
    q = console_job(spark, kafka_shaped_stream(spark, f"{scratch}/topic"), EVENTS_CONFIG,
                    f"{scratch}/ckpt", trigger="availableNow", explain=True)
    assert q.awaitTermination(300) and q.exception() is None
    assert "Physical Plan" in capsys.readouterr().out


def test_batch_time_ban_job(spark, scratch):
    from clickguard.config import EVENTS_CONFIG
    from clickguard.sources.kafka import kafka_records, kafka_shaped_stream
    from clickguard.streaming.jobs import ban_job

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    kafka_records(events).write.parquet(f"{scratch}/topic")
    q = ban_job(spark, kafka_shaped_stream(spark, f"{scratch}/topic"), EVENTS_CONFIG,
                f"{scratch}/bans", f"{scratch}/ckpt", time="batch", parse="strict",
                precision="ms", trigger="availableNow")
    assert q.awaitTermination(300) and q.exception() is None
    # one batch holds every event, so every ip with enough events is judged once
    bans = spark.read.parquet(f"{scratch}/bans")
    assert bans.count() > 0


def test_cli_spool_job(spark, scratch):
    from clickguard.streaming.jobs import main

    os.makedirs(f"{scratch}/spool")
    for i, ip in enumerate(["1.1.1.1", "2.2.2.2"]):
        with open(f"{scratch}/spool/{'ab'[i]}.log", "w") as f:
            f.write('{"type":"click","ip":"%s","unix_time":1514800800,"url":"/a"}\n' % ip)
    main(["spool", "--spool-dir", f"{scratch}/spool", "--keyed-path", f"{scratch}/keyed",
          "--quarantine-path", f"{scratch}/q", "--checkpoint", f"{scratch}/ckpt",
          "--trigger", "availableNow", "--max-files", "1"])
    got = spark.read.parquet(f"{scratch}/keyed").collect()
    assert sorted(r["key"] for r in got) == ["1.1.1.1", "2.2.2.2"]
    assert len({r["batch"] for r in got}) == 2          # one file per micro-batch


def test_kafka_config_validation():
    import pytest as _pytest

    from clickguard.config import KafkaConfig

    assert KafkaConfig().max_offsets_per_trigger == 1_000_000
    with _pytest.raises(ValueError):
        KafkaConfig(starting_offsets="middle")


def test_update_mode_ban_is_not_withdrawn(spark, scratch):
    """A window judged suspicious in one batch stays banned even when a later
    batch's events would clear it (update mode judges every change)."""
    from clickguard.operators.bans import current_bans
    from clickguard.streaming.jobs import ban_job

    conf = DetectorConfig(window="10 seconds", slide="10 seconds", watermark="1 hour",
                          min_events=2, max_events=10, min_rate=0.5)
    batches = [[("watch", 0), ("click", 1), ("click", 2)],   # rate 0.5 -> banned
               [("watch", 3), ("watch", 4)]]                  # rate 1.5 -> would clear
    os.makedirs(f"{scratch}/in")
    base = time.time() - 1000
    for i, rows in enumerate(batches):
        p = f"{scratch}/in/b{i}.json"
        with open(p, "w") as f:
            for action, sec in rows:
                unix_time = int((at(sec) - dt.datetime(1970, 1, 1)).total_seconds())
                body = json.dumps({"type": action, "ip": IP, "unix_time": unix_time,
                                   "url": "/a"})
                f.write(json.dumps({"key": IP, "value": body,
                                    "timestamp": at(sec).isoformat()}) + "\n")
        os.utime(p, (base + i, base + i))
    records = (spark.readStream.schema("key string, value string, timestamp timestamp")
               .option("maxFilesPerTrigger", 1).json(f"{scratch}/in"))
    q = ban_job(spark, records, conf, f"{scratch}/bans", f"{scratch}/ckpt",
                detector="plain", trigger="availableNow")
    assert q.awaitTermination(300) and q.exception() is None
    log = spark.read.parquet(f"{scratch}/bans")
    assert [r["reason"].split(" from ")[0] for r in log.collect()] == \
        ["too suspicious rate: 0.5"]
    assert current_bans(log).count() == 1
    fed = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    assert fed == [3, 2]


def test_spool_files_are_archived_after_reading(spark, scratch):
    from clickguard.sources.spool import spool_stream

    os.makedirs(f"{scratch}/spool")
    base = time.time() - 1000
    for i in range(3):
        p = f"{scratch}/spool/f{i}.log"
        with open(p, "w") as f:
            f.write('{"type":"click","ip":"1.1.1.%d","unix_time":1514800800,"url":"/a"}\n' % i)
        os.utime(p, (base + i, base + i))
    lines = spool_stream(spark, f"{scratch}/spool", max_files_per_trigger=1,
                         archive_dir=f"{scratch}/done")
    q = (lines.writeStream.format("parquet").option("path", f"{scratch}/out")
         .option("checkpointLocation", f"{scratch}/ckpt").trigger(availableNow=True).start())
    assert q.awaitTermination(300) and q.exception() is None
    assert spark.read.parquet(f"{scratch}/out").count() == 3
    # archiving happens a batch after a file was read: the first file is gone
    assert not os.path.exists(f"{scratch}/spool/f0.log")
    archived = [fn for _, _, fs in os.walk(f"{scratch}/done") for fn in fs]
    assert "f0.log" in archived


def test_archive_partitioned_by_ip(spark, scratch):
    from clickguard.streaming.sinks import archive_sink

    write_files(f"{scratch}/in", FILES)
    inc = find_incidents(event_stream(spark, f"{scratch}/in"), CONF)
    q = archive_sink(inc, f"{scratch}/out", f"{scratch}/ckpt", partition_by="ip") \
        .trigger(availableNow=True).start()
    assert q.awaitTermination(300) and q.exception() is None
    assert os.listdir(f"{scratch}/out") and any(d.startswith("ip=") for d in os.listdir(f"{scratch}/out"))
    out = spark.read.parquet(f"{scratch}/out")
    # eight windows hold four or five of the watches; three distinct incidents
    assert out.count() == 8 and out.distinct().count() == 3


@pytest.mark.parametrize("k", [1, 4])
def test_archive_day_written_by_salted_tasks(spark, scratch, k):
    from clickguard.config import EVENTS_CONFIG
    from clickguard.session import ensure_utc
    from clickguard.sources.tables import to_click_events
    from clickguard.streaming.replay import events_stream
    from clickguard.streaming.sinks import archive_sink

    ensure_utc(spark)
    inc = find_incidents(to_click_events(events_stream(spark, "/root/testdata/sf0.01")),
                         EVENTS_CONFIG)
    q = archive_sink(inc, f"{scratch}/out", f"{scratch}/ckpt", files_per_partition=k) \
        .trigger(availableNow=True).start()
    assert q.awaitTermination(300) and q.exception() is None
    batches = len(q.recentProgress)
    days = [d for d in os.listdir(f"{scratch}/out") if d.startswith("day=")]
    per_day = [len([f for f in os.listdir(f"{scratch}/out/{d}") if f.endswith(".parquet")])
               for d in days]
    # each batch writes at most k files into a day
    assert len(days) > 1 and max(per_day) <= k * batches
    if k > 1:
        assert max(per_day) > batches      # a day is spread over several tasks


def test_ban_job_replayed_batch_overwrites_its_folder(spark, scratch):
    """A crash after a batch's write but before its commit: the restarted
    query replays that batch into the same folder, not a new one."""
    from clickguard.config import EVENTS_CONFIG
    from clickguard.operators.bans import current_bans
    from clickguard.sources.kafka import kafka_records, kafka_shaped_stream
    from clickguard.streaming.jobs import ban_job

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    kafka_records(events).write.parquet(f"{scratch}/topic")

    def run():
        q = ban_job(spark, kafka_shaped_stream(spark, f"{scratch}/topic"), EVENTS_CONFIG,
                    f"{scratch}/bans", f"{scratch}/ckpt", trigger="availableNow")
        assert q.awaitTermination(300) and q.exception() is None

    def folders():
        return sorted(os.path.relpath(d, f"{scratch}/bans").split("/", 1)[1]
                      for d, _, fs in os.walk(f"{scratch}/bans")
                      if any(f.endswith(".parquet") for f in fs))

    def files():
        return {f for _, _, fs in os.walk(f"{scratch}/bans") for f in fs if f.endswith(".parquet")}

    run()
    before, before_files = folders(), files()
    view = sorted(current_bans(spark.read.parquet(f"{scratch}/bans")).collect())
    commits = sorted(int(f) for f in os.listdir(f"{scratch}/ckpt/commits") if f.isdigit())
    for f in (f"{commits[-1]}", f".{commits[-1]}.crc"):      # the lost commit
        if os.path.exists(f"{scratch}/ckpt/commits/{f}"):
            os.remove(f"{scratch}/ckpt/commits/{f}")
    run()
    assert folders() == before and len(before) >= 1
    assert files() != before_files                            # the batch did run again
    assert sorted(current_bans(spark.read.parquet(f"{scratch}/bans")).collect()) == view


def test_latest_state_orders_runs_by_write_time(spark, scratch):
    """A run on a new checkpoint starts at batch 0 again; its rows are still
    the newest."""
    from clickguard.streaming.sinks import UpsertLogWriter, latest_state

    old, new = UpsertLogWriter(f"{scratch}/log", "old"), UpsertLogWriter(f"{scratch}/log", "new")
    rows = lambda *r: spark.createDataFrame(list(r), "key string, total bigint")
    old(rows(("a", 1), ("b", 1)), 0)
    old(rows(("a", 7)), 5)
    time.sleep(0.01)
    new(rows(("a", 2)), 0)
    got = latest_state(spark.read.parquet(f"{scratch}/log"), ["key"])
    assert got.columns == ["key", "total"]
    assert sorted(tuple(r) for r in got.collect()) == [("a", 2), ("b", 1)]


def test_events_stream_reads_a_folder_of_part_files(spark, scratch):
    from clickguard.streaming.replay import events_stream

    src = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src.repartition(3).write.parquet(f"{scratch}/tables/events.parquet")
    for d in (f"{scratch}/tables", "/root/testdata/sf0.001"):
        q = (events_stream(spark, d).writeStream.format("parquet")
             .option("path", f"{scratch}/out/{len(d)}")
             .option("checkpointLocation", f"{scratch}/ckpt/{len(d)}")
             .trigger(availableNow=True).start())
        assert q.awaitTermination(300) and q.exception() is None
        assert spark.read.parquet(f"{scratch}/out/{len(d)}").count() == 1000


GOOD = '{"type":"click","ip":"%s","unix_time":%d,"url":"/a"}'


def topic_files(d, batches):
    """Kafka-shaped JSON files, one per micro-batch: (ip, broker second)."""
    os.makedirs(d)
    base = time.time() - 1000
    for i, rows in enumerate(batches):
        with open(f"{d}/b{i}.json", "w") as f:
            for ip, sec in rows:
                unix_time = int((at(sec) - dt.datetime(1970, 1, 1)).total_seconds())
                f.write(json.dumps({"key": ip, "value": GOOD % (ip, unix_time),
                                    "timestamp": at(sec).isoformat()}) + "\n")
        os.utime(f"{d}/b{i}.json", (base + i, base + i))


def topic(spark, d):
    return (spark.readStream.schema("key string, value string, timestamp timestamp")
            .option("maxFilesPerTrigger", 1).json(d))


def test_arrival_stream_keeps_a_lagging_partition(spark, scratch):
    """A key whose partition lags the others by less than the watermark is
    judged as in the batch form; no row is dropped."""
    from clickguard.functions.parse import parse_strict
    from clickguard.operators.arrival import find_incidents_by_arrival
    from clickguard.streaming.jobs import ban_job

    conf = DetectorConfig(window="10 seconds", slide="1 second", watermark="10 minutes",
                          min_events=2, max_events=4, min_rate=0.5)
    topic_files(f"{scratch}/in", [[("fast", 100 + n) for n in range(5)], [("fast", 105)],
                                  [("slow", 30 + n) for n in range(6)], [("fast", 106)]])
    q = ban_job(spark, topic(spark, f"{scratch}/in"), conf, f"{scratch}/bans", f"{scratch}/ckpt",
                time="arrival", parse="strict", trigger="availableNow")
    q.awaitTermination()
    assert sum(s.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress
               for s in p["stateOperators"]) == 0
    records = spark.read.schema("key string, value string, timestamp timestamp").json(f"{scratch}/in")
    batch = find_incidents_by_arrival(
        parse_strict(records, keep=("timestamp",)).withColumnRenamed("timestamp", "arrival"), conf)
    want = {r["reason"] for r in batch.where("ip = 'slow'").collect()}
    got = {r["reason"] for r in spark.read.parquet(f"{scratch}/bans").where("ip = 'slow'").collect()}
    assert got and got <= want


def test_a_checkpoint_made_anew_keeps_the_older_run(spark, scratch):
    """The same checkpoint path with another query behind it: batch ids start
    at 0 again, and nothing of the first run is overwritten."""
    from clickguard.sources.spool import spool_stream
    from clickguard.streaming.jobs import spool_ingest_job

    for run in "ab":
        os.makedirs(f"{scratch}/{run}")
        with open(f"{scratch}/{run}/x.log", "w") as f:
            f.write(GOOD % (run, 1514800800) + "\n")
        q = spool_ingest_job(spark, spool_stream(spark, f"{scratch}/{run}"), f"{scratch}/keyed",
                             f"{scratch}/quarantine", f"{scratch}/ckpt", trigger="availableNow")
        q.awaitTermination()
        os.rename(f"{scratch}/ckpt", f"{scratch}/ckpt-{run}")
    assert sorted(r["key"] for r in spark.read.parquet(f"{scratch}/keyed").collect()) == ["a", "b"]


def test_a_replay_after_midnight_finds_its_folder(spark, scratch, monkeypatch):
    from clickguard.streaming import sinks

    batch = spark.createDataFrame([("1.1.1.1", 5, "why")], "ip string, period bigint, reason string")
    seen = []
    for day in (0, 1):  # a new writer, as after a restart, a day later
        monkeypatch.setattr(sinks.time, "time_ns", lambda d=day: (1_700_000_000 + 86_400 * d) * 10**9)
        sinks.BanLogWriter(f"{scratch}/log", 3600, run_id="r")(batch, 4)
        seen.append([tuple(r) for r in spark.read.parquet(f"{scratch}/log").collect()])
    assert seen[0] == seen[1] and len(seen[1]) == 1


@pytest.mark.parametrize("schema", ["reason string, ip string, period bigint", "a string, b bigint",
                                    "a string, b bigint, c string, d string"])
def test_ban_columns_that_do_not_fit_raise(spark, scratch, schema):
    from clickguard.streaming.sinks import BanLogWriter

    with pytest.raises(ValueError):
        BanLogWriter(f"{scratch}/log", 0)(spark.createDataFrame([], schema), 0)


def test_ban_table_with_other_column_names(spark, scratch):
    from clickguard.streaming.sinks import BanLogWriter

    writer = BanLogWriter.from_options({"ban.path": f"{scratch}/log", "ban.columns": "addr,until,why"})
    writer(spark.createDataFrame([("a", 5, "x"), ("a", 6, "y")], "i string, p bigint, r string"), 0)
    row = spark.read.parquet(f"{scratch}/log").collect()
    assert [(r["addr"], r["until"], r["why"], r["expires_at"]) for r in row] == [("a", 6, "y", None)]


def test_small_batches_make_one_file(spark, scratch):
    from clickguard.streaming.sinks import BanLogWriter

    rows = spark.range(200).selectExpr("string(id) ip", "id period", "'r' reason").repartition(16)
    w = BanLogWriter(f"{scratch}/log", 0, run_id="r")
    w(rows, 0)
    w(rows.limit(0), 1)
    files = [f for d, _, fs in os.walk(f"{scratch}/log") for f in fs if f.endswith(".parquet")]
    assert len(files) <= 2 and spark.read.parquet(f"{scratch}/log").count() == 200


def test_spool_to_bans_from_the_command_line(spark, scratch):
    """Lines, keyed records, bans: what the spool job writes the ban job reads."""
    from clickguard.operators.bans import current_bans
    from clickguard.streaming.jobs import main

    os.makedirs(f"{scratch}/spool")
    with open(f"{scratch}/spool/a.log", "w") as f:
        for n in range(6):
            f.write(GOOD % ("1.1.1.1", 1514800800 + n) + "\n")
        f.write(GOOD % ("2.2.2.2", 1514800800) + "\n")
        f.write(GOOD % ("1.1.1.1", 2**62) + "\n")  # a time that no calendar has
    keyed = ["--keyed-path", f"{scratch}/keyed", "--trigger", "availableNow"]
    main(["spool", "--spool-dir", f"{scratch}/spool", "--quarantine-path", f"{scratch}/q",
          "--checkpoint", f"{scratch}/c1", *keyed])
    main(["bans", "--from-spool", "--ban-path", f"{scratch}/bans", "--checkpoint", f"{scratch}/c2",
          "--min-events", "2", "--max-events", "5", *keyed])
    got = current_bans(spark.read.parquet(f"{scratch}/bans")).collect()
    assert [r["ip"] for r in got] == ["1.1.1.1"] and got[0]["reason"].startswith("too much events: 6 from")
    main(["bans", "--from-spool", "--ban-path", f"{scratch}/bans3", "--checkpoint", f"{scratch}/c3",
          "--time", "batch", "--detector", "aggregator", "--skip-old", *keyed])


def test_jobs_apply_the_session_settings(spark):
    from clickguard.session import BASE_CONF, apply_base_conf

    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        apply_base_conf(spark)  # the session was started with the zone set
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    key = "spark.sql.streaming.stateStore.providerClass"
    assert spark.conf.get(key) == BASE_CONF[key]


def test_registered_queries_on_a_table_without_incidents(spark, scratch):
    """Five events: no incident, no ban, no failure."""
    import __spark_entry__ as entry
    from clickguard import catalog

    src = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src.limit(5).withColumn("user_id", F.col("event_id")).coalesce(1).write.parquet(f"{scratch}/events.parquet")
    for name, query in catalog.queries().items():
        rows = query(spark, scratch).count()
        assert name in entry.queries()
        if "incident" in name or "ban" in name:
            assert rows == 0, name

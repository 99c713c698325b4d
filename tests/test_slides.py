"""Windows by slide from pane rings, state read back, deliveries counted once."""

import os
import random
import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from clickguard.config import DetectorConfig
from clickguard.operators.once import delivered_once, find_distinct_incidents, find_incidents_once
from clickguard.operators.windows import windowed_aggregates
from clickguard.schema import EVENT
from clickguard.streaming.slides import PaneRing, merge, slide_aggregates, slide_stats
from clickguard.streaming.state import RINGS, open_rings, open_windows, read_state, state_operators
from conftest import at

CONF = DetectorConfig(window="10 seconds", slide="2 seconds", watermark="6 seconds",
                      min_events=2, max_events=5, min_rate=0.5)


def brute(panes, w, s, after, until):
    out = []
    for start in range((min(panes) - w) // s * s, until, s) if panes else ():
        total = None
        for p in sorted(panes):
            if start <= p < start + w:
                total = merge(total, panes[p])
        if total is not None and after < start + w <= until:
            out.append((start, total))
    return out


@pytest.mark.parametrize("w,s,pane", [(10, 2, 2), (10, 3, 1), (6, 6, 6), (9, 6, 3), (1, 1, 1)])
def test_two_stacks_equal_plain_windows(w, s, pane):
    r = random.Random(w * s)
    for _ in range(200):
        panes = {}
        for p in (r.randrange(-60, 200) // pane * pane for _ in range(r.randrange(1, 25))):
            t = r.randrange(p, p + pane)
            panes[p] = merge(panes.get(p), (r.randrange(2), 1, r.choice([None, t]), t))
        after = r.randrange(-80, 200)
        until = after + r.randrange(0, 200)
        assert list(slide_aggregates(panes, w, s, after, until)) == brute(panes, w, s, after, until)
    assert list(slide_aggregates({}, w, s, 0, 100)) == []


def feed(spark, folder, batches, make):
    """Runs `make(stream)` once per batch of (ip, action, seconds) rows."""
    for rows in batches:
        (spark.createDataFrame([(i, a, at(t) if t is not None else None) for i, a, t in rows], EVENT)
         .coalesce(1).write.mode("append").parquet(folder))
        q = make(spark.readStream.schema(EVENT).parquet(folder)).trigger(availableNow=True).start()
        assert q.awaitTermination(300) and q.exception() is None
    return q


def writer(df, scratch, name):
    return (df.writeStream.format("parquet").option("path", f"{scratch}/{name}")
            .option("checkpointLocation", f"{scratch}/ckpt-{name}").outputMode("append"))


def batches(seed=1, n=5):
    r = random.Random(seed)
    out = []
    for b in range(n):
        rows = [(r.choice("abc"), r.choice(["click", "watch", "other", None]), 12 * b + r.randrange(0, 14))
                for _ in range(25)]
        rows += [("late", "click", 12 * b - r.randrange(0, 25)), ("a", "click", None), (None, "watch", 12 * b)]
        rows += [("hot", "watch", 12 * b + k % 3) for k in range(40)]
        out.append(rows)
    return out


def test_slide_stats_equal_the_built_in_windows(spark, scratch):
    def both(stream):
        return writer(slide_stats(stream, CONF), scratch, "rings")

    feed(spark, f"{scratch}/in", batches(), both)
    q = feed(spark, f"{scratch}/in2", batches(), lambda s: writer(windowed_aggregates(s, CONF), scratch, "windows"))
    rows = [sorted(map(str, spark.read.parquet(f"{scratch}/{n}").select(
        "ip", "window", "clicks", "watches", "firstEvent", "lastEvent").collect())) for n in ("rings", "windows")]
    assert rows[0] == rows[1] and len(rows[0]) > 40
    # one state row for each ip that is still in a window, in place of one per window
    rings = read_state(spark, f"{scratch}/ckpt-rings", RINGS, stateVarName="ring")
    windows = open_windows(spark, f"{scratch}/ckpt-windows")
    ips = windows.select("ip").distinct().count()
    assert rings.count() == ips and windows.count() >= 4 * ips
    # the panes add up to the open windows
    panes = open_rings(spark, f"{scratch}/ckpt-rings")
    w = windows.alias("w").join(panes.alias("p"), F.col("w.ip").eqNullSafe(F.col("p.ip"))
                                & (F.col("pane") >= F.col("window_start")) & (F.col("pane") < F.col("window_end")))
    summed = w.groupBy("w.ip", "window_start").agg(F.sum("p.clicks").alias("clicks"), F.sum("p.watches").alias("watches"))
    assert sorted(map(str, summed.collect())) == sorted(map(str, windows.select(
        "ip", "window_start", "clicks", "watches").collect()))
    assert {r.operatorName for r in state_operators(spark, f"{scratch}/ckpt-windows").collect()} == {"stateStoreSave"}
    with pytest.raises(ValueError):
        read_state(spark, f"{scratch}/ckpt-windows", "dedupe")
    assert q.exception() is None


def test_an_ip_is_judged_once_per_slide_while_in_the_window(spark, scratch):
    """Events at 0..2 s are judged at each of the five slides of their window,
    in one batch or many; an idle ip has no state."""
    first = [("x", "click", t) for t in (0, 1, 2)]
    quiet = [[("y", "watch", t)] for t in (12, 20, 40)]
    feed(spark, f"{scratch}/in", [first, *quiet], lambda s: writer(slide_stats(s, CONF), scratch, "out"))
    got = spark.read.parquet(f"{scratch}/out").where("ip = 'x'").orderBy("window.end").collect()
    ends = [int((r.window.end - at(0)).total_seconds()) for r in got]
    assert ends == [2, 4, 6, 8, 10, 12]
    assert [r.clicks for r in got] == [2, 3, 3, 3, 3, 1]
    left = {r.ip for r in open_rings(spark, f"{scratch}/ckpt-out").collect()}
    assert left == {"y"}


def test_ban_job_by_slide(spark, scratch):
    from clickguard.config import EVENTS_CONFIG
    from clickguard.sources.kafka import kafka_records, kafka_shaped_stream
    from clickguard.streaming.jobs import ban_job, detect

    kafka_records(spark.read.parquet("/root/testdata/sf0.001/events.parquet")).write.parquet(f"{scratch}/topic")
    records = kafka_shaped_stream(spark, f"{scratch}/topic")
    q = ban_job(spark, records, EVENTS_CONFIG, f"{scratch}/bans", f"{scratch}/ckpt", time="arrival", emit="slide",
                skip_old=True, trigger="availableNow")
    assert q.awaitTermination(300) and q.exception() is None
    assert spark.read.parquet(f"{scratch}/bans").count() > 0
    for wrong in ({"emit": "never"}, {"once": True, "time": "arrival"}, {"distinct": True, "emit": "slide"},
                  {"once": True, "distinct": True}):
        with pytest.raises(ValueError):
            detect(spark, records, EVENTS_CONFIG, **wrong)


def test_archive_job_by_slide_under_the_default_state_store(spark, scratch):
    """Spark's default store cannot hold rings: the job brings its own, and the
    session's is what it was."""
    from clickguard.config import EVENTS_CONFIG
    from clickguard.schema import SLIDE_INCIDENT
    from clickguard.sources.kafka import kafka_records, kafka_shaped_stream
    from clickguard.sources.tables import TABLE_SCHEMAS
    from clickguard.streaming.jobs import archive_job

    rows = [(i, at(i).replace(tzinfo=None), 7, "click", 0.0, '{"k": 50}') for i in range(6)]
    rows.append((9, at(9 * 86_400).replace(tzinfo=None), 8, "view", 0.0, '{"k": 50}'))
    kafka_records(spark.createDataFrame(rows, TABLE_SCHEMAS["events"])).write.parquet(f"{scratch}/topic")
    key = "spark.sql.streaming.stateStore.providerClass"
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    before = spark.conf.get(key)
    spark.conf.set(key, default)
    try:
        q = archive_job(spark, kafka_shaped_stream(spark, f"{scratch}/topic"), EVENTS_CONFIG, f"{scratch}/out",
                        f"{scratch}/ckpt", time="arrival", emit="slide", trigger="availableNow")
        assert spark.conf.get(key) == default
        assert q.awaitTermination(300) and q.exception() is None
    finally:
        spark.conf.set(key, before)
    got = spark.read.schema(SLIDE_INCIDENT).parquet(f"{scratch}/out").collect()
    assert {r.ip for r in got} == {"7"} and len({r.windowEnd for r in got}) == len(got) == 4


def test_workers_need_not_import_the_package():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    load = "import pickle, sys; pickle.load(sys.stdin.buffer); assert 'clickguard' not in sys.modules"
    subprocess.run([sys.executable, "-c", load], input=cloudpickle.dumps(PaneRing(10, 2)), cwd="/", env=env, check=True)


def test_redelivered_records_count_once(spark, scratch):
    schema = "ip string, action string, eventTime timestamp, topic string, partition int, offset long"
    rows = [("a", "click", at(t), "t", 0, t) for t in range(8)]
    batch = spark.createDataFrame(rows + rows[::2] + [("a", "click", None, "t", 0, 99)], schema)
    assert delivered_once(batch, CONF).count() == 8
    folder = f"{scratch}/in"
    for part in (rows[:5] + rows[:2], rows[3:], [("z", "watch", at(100), "t", 1, 0)], rows[:1]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
        found = find_incidents_once(spark.readStream.schema(schema).parquet(folder), CONF)
        q = writer(found, scratch, "out").trigger(availableNow=True).start()
        assert q.awaitTermination(300) and q.exception() is None
    once = find_incidents_once(spark.createDataFrame(rows, schema), CONF)
    assert sorted(map(str, spark.read.parquet(f"{scratch}/out").collect())) == sorted(map(str, once.collect()))


def test_distinct_incidents(spark, scratch):
    conf = CONF.with_(watermark="8 seconds")
    rows = [("a", "click", t) for t in (4, 5, 5)] + [("b", "watch", 90)]
    feed(spark, f"{scratch}/in", [rows[:2], rows[2:3], rows[3:]],
         lambda s: writer(find_distinct_incidents(s, conf), scratch, "out"))
    got = spark.read.parquet(f"{scratch}/out")
    assert got.count() == got.distinct().count() == 1
    events = spark.read.schema(EVENT).parquet(f"{scratch}/in")
    assert sorted(map(str, find_distinct_incidents(events, conf).collect())) == sorted(map(str, got.collect()))
    with pytest.raises(ValueError):
        find_distinct_incidents(spark.readStream.schema(EVENT).parquet(f"{scratch}/in"), CONF)

"""Arrival-time windows: the reference's micro-batch cases as a table.

Batch k (k = 1..n) arrives at T+k; the output after batch k is the window
that ends at T+k+1, i.e. the last 10 one-second batches.
"""

import datetime as dt

from pyspark.sql import functions as F

from clickguard.config import DetectorConfig
from clickguard.operators.arrival import find_incidents_by_arrival, skip_old
from conftest import at

CONF = DetectorConfig(window="10 seconds", slide="1 second", watermark="20 seconds",
                      min_events=2, max_events=4, min_rate=0.5)
IP = "10.10.10.10"


def jdbc(t):
    return t.strftime("%Y-%m-%d %H:%M:%S")


def per_batch(spark, batches):
    rows = [(IP, action, t, at(k)) for k, (action, t) in enumerate(batches, start=1)]
    df = spark.createDataFrame(rows, "ip string, action string, eventTime timestamp, "
                                     "arrival timestamp")
    out = find_incidents_by_arrival(df, CONF, with_window=True)
    got = {}
    for r in out.collect():
        got.setdefault(r["windowEnd"], []).append((r["ip"], r["lastEvent"], r["reason"]))
    return [sorted(got.get(at(k + 1), [])) for k in range(1, len(batches) + 1)]


def test_too_much_events_per_batch(spark):
    batches = [("watch", at(n)) for n in range(5)]
    assert per_batch(spark, batches) == [
        [], [], [],
        [(IP, at(3), f"too much events: 4 from {jdbc(at(0))} to {jdbc(at(3))}")],
        [(IP, at(4), f"too much events: 5 from {jdbc(at(0))} to {jdbc(at(4))}")],
    ]


def test_too_small_rate_per_batch(spark):
    batches = [("watch", at(0)), ("click", at(1)), ("click", at(2))]
    assert per_batch(spark, batches) == [
        [], [],
        [(IP, at(2), f"too suspicious rate: 0.5 from {jdbc(at(0))} to {jdbc(at(2))}")],
    ]


def test_event_time_does_not_choose_the_window(spark):
    # all events carry old event times but arrive together: one window holds them
    rows = [(IP, "watch", at(-1000 + n), at(1)) for n in range(5)]
    df = spark.createDataFrame(rows, "ip string, action string, eventTime timestamp, "
                                     "arrival timestamp")
    out = find_incidents_by_arrival(df, CONF).distinct().collect()
    assert {r["reason"].split(" from ")[0] for r in out} == {"too much events: 5"}


def test_skip_old_is_judged_on_arrival(spark):
    rows = [(IP, "watch", at(0), at(5)),      # 5 s late: kept
            (IP, "watch", at(0), at(10)),     # exactly one window late: kept
            (IP, "watch", at(0), at(10.5))]   # older than one window: dropped
    df = spark.createDataFrame(rows, "ip string, action string, eventTime timestamp, "
                                     "arrival timestamp")
    kept = skip_old(df, CONF).collect()
    assert sorted(r["arrival"] for r in kept) == [at(5), at(10)]


def test_quantize_to_batch_time(spark):
    from clickguard.operators.arrival import batch_time

    df = spark.createDataFrame([(at(0),), (at(0.2),), (at(1),), (at(59.9),)], "a timestamp")
    got = [r[0] for r in df.select(batch_time(F.col("a"), 60_000_000)).collect()]
    assert got == [at(0), at(60), at(60), at(60)]
    assert isinstance(got[0], dt.datetime)

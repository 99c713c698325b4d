"""Ban records, the ban log and its current view, sink options."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clickguard.config import DetectorConfig
from clickguard.operators.bans import ban_log_rows, ban_records, current_bans
from clickguard.streaming.sinks import BanLogWriter, validate_ban_sink_options

CONF = DetectorConfig(ban_time="1 day")
T = dt.datetime(2018, 1, 1, 10, 0, 0)


def incidents(spark, rows):
    return spark.createDataFrame(rows, "ip string, lastEvent timestamp, reason string")


def test_period_seconds_vs_millis(spark):
    inc = incidents(spark, [("a", T + dt.timedelta(milliseconds=900), "r")])
    assert ban_records(inc, CONF, "s").collect()[0]["period"] == 1514887200000
    assert ban_records(inc, CONF, "ms").collect()[0]["period"] == 1514887200900
    with pytest.raises(ValueError):
        ban_records(inc, CONF, "ns")


def log(spark, rows, ttl_s=86400):
    df = spark.createDataFrame(rows, "ip string, period bigint, reason string, "
                                     "written_at timestamp, batch_id bigint")
    return ban_log_rows(df, F.col("written_at"), ttl_s, F.col("batch_id"))


def test_last_write_wins_and_expires(spark):
    h = dt.timedelta(hours=1)
    rows = [("a", 1, "old", T, 0), ("a", 2, "new", T + h, 1),
            ("b", 5, "x", T, 0), ("b", 9, "y", T, 0),          # same write: higher period
            ("c", 3, "z", T - 30 * h, 0)]                       # expired by as_of
    got = current_bans(log(spark, rows), as_of=T + 2 * h)
    assert sorted((r["ip"], r["reason"]) for r in got.collect()) == [("a", "new"), ("b", "y")]


def test_as_of_ignores_later_writes(spark):
    h = dt.timedelta(hours=1)
    rows = [("a", 1, "old", T, 0), ("a", 2, "new", T + 5 * h, 1)]
    got = current_bans(log(spark, rows), as_of=T + h).collect()
    assert [(r["ip"], r["reason"]) for r in got] == [("a", "old")]


def test_default_as_of_is_newest_write(spark):
    h = dt.timedelta(hours=1)
    rows = [("a", 1, "r", T, 0), ("b", 1, "r", T + 30 * h, 0)]
    got = current_bans(log(spark, rows)).collect()
    assert [r["ip"] for r in got] == ["b"]


def test_ttl_zero_never_expires(spark):
    bans = spark.createDataFrame([("a", 1, "r")], "ip string, period bigint, reason string")
    rows = ban_log_rows(bans, F.lit(T).cast("timestamp"), 0)
    assert rows.collect()[0]["expires_at"] is None
    got = current_bans(rows, as_of=F.lit(T + dt.timedelta(days=999)).cast("timestamp"))
    assert got.count() == 1


def test_sink_options_report_every_error():
    with pytest.raises(ValueError) as e:
        validate_ban_sink_options({"ban.ttl": "x"})
    msg = str(e.value)
    assert "ban.path" in msg and "ban.columns" in msg and "ban.ttl" in msg
    o = validate_ban_sink_options({"ban.path": "/p", "ban.columns": "ip, period, reason",
                                   "ban.ttl": "86400"})
    assert o.columns == ("ip", "period", "reason") and o.ttl == 86400


def test_ban_log_writer_is_idempotent_per_batch(spark, scratch):
    w = BanLogWriter(scratch + "/bans", 86400, run_id="r1")
    batch = spark.createDataFrame([("a", 10, "x"), ("a", 20, "y"), ("b", 5, "z")],
                                  "ip string, period bigint, reason string")
    w(batch, 0)
    w(batch, 0)  # replayed batch replaces itself
    logged = spark.read.parquet(scratch + "/bans")
    assert logged.count() == 2
    assert sorted((r["ip"], r["period"]) for r in current_bans(logged).collect()) == \
        [("a", 20), ("b", 5)]


def test_horizon_prunes_old_days(spark, scratch):
    from clickguard.plans.explain import plan_text

    h = dt.timedelta(hours=1)
    rows = [("a", 1, "old", T - 50 * h, 0), ("a", 2, "new", T, 1), ("b", 3, "x", T - 40 * h, 0)]
    df = log(spark, rows).withColumn("written_date", F.to_date("written_at"))
    df.write.partitionBy("written_date").parquet(scratch + "/log")
    stored = spark.read.parquet(scratch + "/log")
    as_of = F.lit(T + h).cast("timestamp")
    got = current_bans(stored, as_of=as_of, horizon="1 day")
    assert sorted((r["ip"], r["reason"]) for r in got.collect()) == [("a", "new")]
    assert got.collect() == current_bans(stored, as_of=as_of).collect()
    text = plan_text(got)
    assert "PartitionFilters: [isnotnull(written_date" in text


def test_ban_log_writer_partitions_by_write_date(spark, scratch):
    w = BanLogWriter(scratch + "/bans", 86400, run_id="r1")
    w(spark.createDataFrame([("a", 10, "x")], "ip string, period bigint, reason string"), 3)
    log = spark.read.parquet(scratch + "/bans")
    assert {"written_date", "run", "batch"} <= set(log.columns)
    r = current_bans(log, horizon="1 day").collect()
    assert [(x["ip"], x["period"]) for x in r] == [("a", 10)]


def test_columns_are_paired_by_position(spark, scratch):
    opts = {"ban.path": scratch + "/bans", "ban.columns": "period, ip, reason", "ban.ttl": "60"}
    w = BanLogWriter.from_options(opts, run_id="r")
    w(spark.createDataFrame([(7, "a", "x")], "p bigint, who string, why string"), 0)
    r = spark.read.parquet(scratch + "/bans").collect()[0]
    assert (r["ip"], r["period"], r["reason"]) == ("a", 7, "x")
    with pytest.raises(ValueError):
        validate_ban_sink_options({"ban.path": "/p", "ban.columns": "ip, IP, reason"})


@pytest.mark.parametrize("ttl_s", [0, 3600, 86400])
def test_compacted_view_equals_view_over_whole_log(spark, scratch, ttl_s):
    import random

    from clickguard.operators.bans import compact_bans, with_snapshot

    rnd = random.Random(ttl_s)
    start = dt.datetime(2018, 1, 1)
    rows = []
    for i in range(600):
        ip = "hot" if i % 3 == 0 else f"ip{rnd.randrange(40)}"   # one ip holds a third
        at = start + dt.timedelta(seconds=rnd.randrange(5 * 86400))
        rows.append((ip, rnd.randrange(1000), rnd.choice("xyz"), at, rnd.randrange(3)))
    (log(spark, rows, ttl_s).withColumn("written_date", F.to_date("written_at"))
     .write.partitionBy("written_date").parquet(f"{scratch}/log"))
    whole = spark.read.parquet(f"{scratch}/log")
    cut = "2018-01-03"
    compact_bans(whole, cut).write.parquet(f"{scratch}/snap")
    snap = spark.read.parquet(f"{scratch}/snap")
    if ttl_s:
        # nothing expired at the cut survives into the snapshot
        assert snap.filter(F.col("expires_at") <= F.lit(cut).cast("timestamp")).count() == 0
    assert snap.groupBy("ip").count().filter("count > 1").count() == 0
    view = with_snapshot(snap, whole, cut)
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "written_date" in plan
    for as_of in [None, "2018-01-03 00:00:00", "2018-01-03 07:30:00", "2018-01-04 12:00:00",
                  "2018-01-09 00:00:00"]:
        want = current_bans(whole, as_of=as_of)
        got = current_bans(view, as_of=as_of)
        assert sorted(got.collect()) == sorted(want.collect()), as_of


def test_cli_compacts_incrementally(spark, scratch):
    from clickguard.operators.bans import with_snapshot
    from clickguard.streaming.jobs import main

    h = dt.timedelta(hours=1)
    start = dt.datetime(2018, 1, 1, 6)
    rows = [("a", 1, "r", start, 0), ("a", 2, "s", start + 30 * h, 0),
            ("b", 3, "r", start + 50 * h, 0), ("c", 4, "r", start + 90 * h, 0),
            ("a", 5, "t", start + 95 * h, 0)]
    (log(spark, rows, 0).withColumn("written_date", F.to_date("written_at"))
     .write.partitionBy("written_date").parquet(f"{scratch}/log"))
    main(["compact", "--ban-path", f"{scratch}/log", "--snapshot-out", f"{scratch}/s1",
          "--before", "2018-01-03"])
    main(["compact", "--ban-path", f"{scratch}/log", "--snapshot-out", f"{scratch}/s2",
          "--before", "2018-01-05", "--snapshot", f"{scratch}/s1", "--snapshot-cut", "2018-01-03"])
    whole = spark.read.parquet(f"{scratch}/log")
    s2 = spark.read.parquet(f"{scratch}/s2")
    assert sorted((r["ip"], r["reason"]) for r in s2.collect()) == [("a", "s"), ("b", "r")]
    got = current_bans(with_snapshot(s2, whole, "2018-01-05"))
    assert sorted(got.collect()) == sorted(current_bans(whole).collect())
    with pytest.raises(SystemExit):
        main(["compact", "--ban-path", f"{scratch}/log"])
    with pytest.raises(ValueError):
        main(["compact", "--ban-path", f"{scratch}/log", "--snapshot-out", f"{scratch}/s2",
              "--before", "2018-01-06", "--snapshot", f"{scratch}/s2/", "--snapshot-cut", "2018-01-05"])
    # a rerun (e.g. after a lost driver) rewrites the same snapshot
    main(["compact", "--ban-path", f"{scratch}/log", "--snapshot-out", f"{scratch}/s1",
          "--before", "2018-01-03"])
    assert spark.read.parquet(f"{scratch}/s1").count() == 1


def test_read_ban_log_opens_only_the_days_in_range(spark, scratch):
    from clickguard.streaming.sinks import read_ban_log

    h = dt.timedelta(hours=1)
    start = dt.datetime(2018, 1, 1, 6)
    rows = [("a", 1, "r", start + 24 * n * h, 0) for n in range(5)]     # Jan 1 .. Jan 5
    for i, r in enumerate(rows):
        day = (start + 24 * i * h).date().isoformat()
        log(spark, [r]).write.parquet(f"{scratch}/log/written_date={day}/run=x/batch={i}")
    got = read_ban_log(spark, f"{scratch}/log", since="2018-01-04", until="2018-01-09")
    assert all("written_date=2018-01-0" in f and f.split("written_date=")[1][:10] >= "2018-01-04"
               for f in got.inputFiles())
    assert sorted(r["written_date"].isoformat() for r in got.collect()) == ["2018-01-04", "2018-01-05"]
    assert set(got.columns) >= {"ip", "written_at", "written_date", "run", "batch"}
    empty = read_ban_log(spark, f"{scratch}/log", since="2019-01-01", until="2019-01-02")
    assert empty.count() == 0 and current_bans(empty).count() == 0
    assert read_ban_log(spark, f"{scratch}/log").count() == 5
    wide = read_ban_log(spark, f"{scratch}/log", since="2015-01-01", until="2018-01-02")
    assert sorted(r["written_date"].isoformat() for r in wide.collect()) == ["2018-01-01", "2018-01-02"]


def test_compaction_and_horizon_in_a_session_east_of_utc(spark, scratch):
    """Folders are UTC days; the cut and the horizon must be UTC too, or
    writes between local and UTC midnight fall between snapshot and log."""
    from clickguard.operators.bans import compact_bans, utc_day, with_snapshot

    h = dt.timedelta(hours=1)
    day = dt.datetime(2018, 1, 3)
    rows = [("a", 1, "r", day - 5 * h, 0),       # Jan 2 19:00 UTC = Jan 3 06:00 in Sydney
            ("b", 2, "r", day - 30 * h, 0),
            ("c", 3, "r", day + 2 * h, 0)]
    (log(spark, rows, 0).withColumn("written_date", utc_day(F.col("written_at")))
     .write.partitionBy("written_date").parquet(f"{scratch}/log"))
    spark.conf.set("spark.sql.session.timeZone", "Australia/Sydney")
    try:
        whole = spark.read.parquet(f"{scratch}/log")
        compact_bans(whole, "2018-01-03").write.parquet(f"{scratch}/snap")
        snap = spark.read.parquet(f"{scratch}/snap")
        assert sorted(r["ip"] for r in snap.collect()) == ["a", "b"]
        view = with_snapshot(snap, whole, "2018-01-03")
        assert sorted(current_bans(view).collect()) == sorted(current_bans(whole).collect())
        assert len(current_bans(view).collect()) == 3
        # horizon: as_of Jan 3 12:00 UTC, 1 day -> every write after Jan 2 12:00 UTC is kept
        got = current_bans(whole, as_of=F.timestamp_micros(F.lit(
            int((day + 12 * h - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1)))),
            horizon="1 day")
        assert sorted(r["ip"] for r in got.collect()) == ["a", "c"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_utc_day_and_midnight_ignore_the_session_zone(spark):
    from clickguard.operators.bans import utc_day, utc_midnight

    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        micros = [-1, 0, 86_399_999_999, 86_400_000_000,
                  int((dt.datetime(2024, 1, 30, 23, 30) - dt.datetime(1970, 1, 1))
                      / dt.timedelta(microseconds=1))]
        df = spark.createDataFrame([(m,) for m in micros], "m long")
        got = [r[0].isoformat() for r in
               df.select(utc_day(F.timestamp_micros("m"))).collect()]
        assert got == ["1969-12-31", "1970-01-01", "1970-01-01", "1970-01-02", "2024-01-30"]
        row = spark.range(1).select(F.unix_micros(utc_midnight("2024-01-30")).alias("u")).first()
        assert row["u"] == 19752 * 86_400_000_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")

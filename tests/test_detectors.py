"""The reference's detector cases, run through every detector form."""

import pytest
from pyspark.sql import functions as F

from clickguard.config import DetectorConfig
from clickguard.operators.incidents import (
    find_incidents,
    find_incidents_struct,
    find_incidents_typed,
    find_incidents_typed_aggregator,
)
from clickguard.plans.sql import find_incidents_sql
from conftest import at, events_df

CONF = DetectorConfig(window="10 seconds", slide="1 second", watermark="20 seconds",
                      min_events=2, max_events=4, min_rate=0.5)
IP = "10.10.10.10"

VARIANTS = {
    "plain": lambda s, df, c: find_incidents(df, c),
    "panes": lambda s, df, c: find_incidents(df, c, strategy="panes"),
    "sql": lambda s, df, c: find_incidents_sql(s, df, c),
    "struct": lambda s, df, c: find_incidents_struct(df, c),
    "typed": lambda s, df, c: find_incidents_typed(df, c),
    "typed_aggregator": lambda s, df, c: find_incidents_typed_aggregator(df, c),
}


def fmt(t):
    return t.strftime("%Y-%m-%d %H:%M:%S")


def run(spark, variant, rows, conf=CONF):
    out = VARIANTS[variant](spark, events_df(spark, rows), conf)
    assert out.columns == ["ip", "lastEvent", "reason"]
    return [tuple(r) for r in out.distinct().sort("lastEvent", "reason").collect()]


@pytest.mark.parametrize("variant", sorted(VARIANTS))
def test_too_much_events(spark, variant):
    rows = [(IP, "watch", at(n)) for n in range(5)]
    assert run(spark, variant, rows) == [
        (IP, at(3), f"too much events: 4 from {fmt(at(0))} to {fmt(at(3))}"),
        (IP, at(4), f"too much events: 4 from {fmt(at(1))} to {fmt(at(4))}"),
        (IP, at(4), f"too much events: 5 from {fmt(at(0))} to {fmt(at(4))}"),
    ]


@pytest.mark.parametrize("variant", sorted(VARIANTS))
def test_too_suspicious_rate(spark, variant):
    rows = [(IP, "watch", at(0)), (IP, "click", at(1)), (IP, "click", at(2))]
    assert run(spark, variant, rows) == [
        (IP, at(2), f"too suspicious rate: 0.5 from {fmt(at(0))} to {fmt(at(2))}"),
    ]


RATE_CASE = [(IP, "watch", at(0)), (IP, "click", at(1)), (IP, "click", at(2))]


@pytest.mark.parametrize("variant", ["plain", "panes", "sql", "struct"])
def test_unknown_action_moves_last_event(spark, variant):
    rows = RATE_CASE + [(IP, "blablabla", at(5))]
    assert run(spark, variant, rows) == [
        (IP, at(2), f"too suspicious rate: 0.5 from {fmt(at(0))} to {fmt(at(2))}"),
        (IP, at(5), f"too suspicious rate: 0.5 from {fmt(at(0))} to {fmt(at(5))}"),
    ]


@pytest.mark.parametrize("variant", sorted(VARIANTS))
def test_null_time_is_ignored(spark, variant):
    rows = RATE_CASE + [(IP, "click", None)]
    assert run(spark, variant, rows) == [
        (IP, at(2), f"too suspicious rate: 0.5 from {fmt(at(0))} to {fmt(at(2))}"),
    ]


@pytest.mark.parametrize("variant", ["plain", "panes", "sql", "struct"])
def test_null_ip_without_filter_forms_a_group(spark, variant):
    rows = [(None, "click", at(0))] * 3
    assert run(spark, variant, rows) == [
        (None, at(0), f"too suspicious rate: 0.0 from {fmt(at(0))} to {fmt(at(0))}"),
    ]


@pytest.mark.parametrize("variant", ["typed", "typed_aggregator"])
def test_typed_forms_drop_null_ip(spark, variant):
    rows = [(None, "click", at(0))] * 3
    assert run(spark, variant, rows) == []


def test_typed_aggregator_drops_null_action(spark):
    rows = RATE_CASE + [(IP, None, at(5))]
    assert run(spark, "typed_aggregator", rows) == run(spark, "typed", RATE_CASE)
    # the plain form keeps it as an unknown action that moves lastEvent
    assert len(run(spark, "plain", rows)) == 2


@pytest.mark.parametrize("variant", ["plain", "panes", "sql", "struct"])
def test_sub_second_times_in_reason(spark, variant):
    rows = [(IP, "watch", at(0.5)), (IP, "click", at(1.25)), (IP, "click", at(2))]
    assert run(spark, variant, rows) == [
        (IP, at(2), "too suspicious rate: 0.5 from 2018-01-01 10:00:00.5 "
                    "to 2018-01-01 10:00:02"),
    ]


def test_thresholds_are_strict_and_max_wins(spark):
    # total == min_events -> nothing; total >= max with a low rate -> "too much"
    conf = CONF.with_(min_events=3)
    three = [(IP, "click", at(n)) for n in range(3)]
    assert run(spark, "plain", three, conf) == []
    four = [(IP, "click", at(n)) for n in range(4)]
    got = run(spark, "plain", four, conf)
    assert got and all(r[2].startswith("too much events: 4") for r in got)


def test_zero_clicks_rate_is_watch_count(spark):
    # 3 watches, no click: rate = 3.0 > 0.5 -> no incident below max
    rows = [(IP, "watch", at(n)) for n in range(3)]
    assert run(spark, "plain", rows) == []
    got = run(spark, "plain", rows, CONF.with_(min_rate=3.0))
    assert got and got[0][2].startswith("too suspicious rate: 3.0")


def test_variants_agree_on_events_table(spark):
    from clickguard.config import EVENTS_CONFIG
    from clickguard.sources.tables import click_events

    ev = click_events(spark, "/root/testdata/sf0.001")
    base = sorted(map(tuple, find_incidents(ev, EVENTS_CONFIG).collect()))
    assert len(base) == 58
    for name in ("panes", "sql", "struct"):
        got = sorted(map(tuple, VARIANTS[name](spark, ev, EVENTS_CONFIG).collect()))
        assert got == base, name


def test_missing_column_fails_early(spark):
    df = spark.createDataFrame([(IP, at(0))], "ip string, eventTime timestamp")
    with pytest.raises(ValueError, match="action"):
        find_incidents(df, CONF)


@pytest.mark.parametrize("slide", ["1 hour", "6 hours"])
@pytest.mark.parametrize("strategy", ["expand", "panes"])
def test_times_without_a_zone_are_read_in_the_session_zone(spark, strategy, slide):
    conf = DetectorConfig(window="1 day", slide=slide, min_events=0, max_events=1)
    with_zone = spark.createDataFrame([("a", "click", at(0)), ("a", "watch", at(9))],
                                      "ip string, action string, eventTime timestamp")
    bare = with_zone.withColumn("eventTime", F.col("eventTime").cast("timestamp_ntz"))
    got, want = (sorted(map(tuple, find_incidents(e, conf, strategy=strategy).collect()))
                 for e in (bare, with_zone))
    assert got == want and want


def test_no_incident_without_a_time(spark):
    """Arrivals whose message had no readable time: counted, never reported."""
    from clickguard.operators.arrival import find_incidents_by_arrival

    rows = [("a", "click", None, at(n)) for n in range(9)] + [("b", "click", at(n), at(n)) for n in range(9)]
    df = spark.createDataFrame(rows, "ip string, action string, eventTime timestamp, arrival timestamp")
    conf = DetectorConfig(window="10 seconds", slide="10 seconds", min_events=2, max_events=5)
    got = find_incidents_by_arrival(df, conf).collect()
    assert {r["ip"] for r in got} == {"b"} and all(r["reason"] and r["lastEvent"] for r in got)

"""Parsing: lenient and strict policies, quarantine reasons, key extraction."""

import datetime as dt

from clickguard.functions.parse import extract_key, parse_lenient, parse_strict, quarantine

GOOD = '{"type":"click","ip":"1.1.1.1","unix_time":1514800800,"url":"/a"}'
T0 = dt.datetime(2018, 1, 1, 10, 0, 0)

MATRIX = [
    ("k1", GOOD),
    ("k2", "not json"),
    ("k3", '{"type":"click","ip":"1.1.1.1","unix_time":1514800800}'),
    ("k4", '{"type":"click","ip":"1.1.1.1","unix_time":"abc","url":"/a"}'),
    ("k5", '{"type":"click","ip":"1.1.1.1","unix_time":"1514800800","url":"/a"}'),
    ("k6", None),
    ("k7", '{"type":"blablabla","ip":"1.1.1.1","unix_time":1514800800,"url":"/a"}'),
]


# JSON whose fields have other types, or that is not one object.
ILL = [
    ('{"type":"click","ip":12345,"unix_time":1514800800,"url":"/a"}', "invalid field: ip"),
    ('{"type":"click","ip":"1.1.1.1","unix_time":1514800800,"url":true}', "invalid field: url"),
    ('{"type":"click","ip":"1.1.1.1","unix_time":1514800800,"url":{"a":1}}', "invalid field: url"),
    ('{"type":"click","ip":"1.1.1.1","unix_time":1514800800.0,"url":"/a"}', "invalid field: unix_time"),
    ('{"type":"click","ip":null,"unix_time":1514800800,"url":"/a"}', "missing field: ip"),
    ("{'type':'click','ip':'1.1.1.1','unix_time':1514800800,'url':'/a'}", "malformed json"),
    (GOOD + " junk", "malformed json"),
    (GOOD + GOOD, "malformed json"),
    (GOOD + "," + GOOD, "malformed json"),
    (GOOD + "] x", "malformed json"),
    (GOOD + ",1] x", "malformed json"),
    (GOOD + "} {", "malformed json"),
    ("[" + GOOD + "]", "malformed json"),
    ('"' + "text" + '"', "malformed json"),
    ("", "malformed json"),
] + [('{"type":"click","ip":"1.1.1.1","unix_time":%d,"url":"/a"}' % t, "invalid field: unix_time")
     for t in (9223372036854775807, 9223372036854, -9223372036855, 253402300800000, 253402300800)]


def test_strict_rejects_what_is_not_well_typed(spark):
    df = spark.createDataFrame([("k", v) for v, _ in ILL], "key string, value string")
    assert parse_strict(df).count() == 0
    got = {r["raw"]: r["reason"] for r in quarantine(df).collect()}
    assert got == dict(ILL)


def test_times_of_any_size_do_not_fail_a_job(spark):
    from clickguard.config import DetectorConfig
    from clickguard.operators.bans import ban_records
    from clickguard.operators.incidents import find_incidents
    from clickguard.plans.sql import find_incidents_sql

    times = [9223372036854775807, 9223372036854, -9223372036855, 253402300800000, 253402300799,
             -62135596800, -62135596801]
    df = spark.createDataFrame([("k", '{"type":"click","ip":"i","unix_time":%d,"url":"/"}' % t)
                                for t in times], "key string, value string")
    events = parse_lenient(df)
    assert [r["eventTime"] is None for r in events.select("eventTime").selectExpr(
        "string(eventTime) eventTime").collect()] == [True] * 4 + [False] * 2 + [True]
    conf = DetectorConfig(min_events=0, max_events=1)
    for inc in (find_incidents(events, conf, strategy="expand"), find_incidents(events, conf, strategy="panes"),
                find_incidents_sql(spark, events, conf)):
        assert ban_records(inc, conf).count() == 20  # two times, ten windows each


def records(spark):
    return spark.createDataFrame(MATRIX, "key string, value string")


def test_lenient(spark):
    got = {r["ip"]: (r["action"], r["eventTime"])
           for r in parse_lenient(records(spark)).collect()}
    assert got == {
        "k1": ("click", T0),
        "k2": (None, None),
        "k3": ("click", T0),
        "k4": ("click", None),
        "k5": ("click", None),
        "k6": (None, None),
        "k7": ("blablabla", T0),
    }


def test_strict_keeps_only_complete_known_messages(spark):
    got = [tuple(r) for r in parse_strict(records(spark), keep=("key",)).collect()]
    assert got == [("k1", "1.1.1.1", "click", T0)]


def test_quarantine_reasons(spark):
    got = {r["key"]: r["reason"] for r in quarantine(records(spark), keep=("key",)).collect()}
    assert got == {
        "k2": "malformed json",
        "k3": "missing field: url",
        "k4": "invalid field: unix_time",
        "k5": "invalid field: unix_time",
        "k6": "empty message",
        "k7": "unknown type: blablabla",
    }


def test_binary_values_are_decoded(spark):
    df = spark.createDataFrame([(b"1.1.1.1", GOOD.encode())], "key binary, value binary")
    assert parse_lenient(df).collect()[0]["ip"] == "1.1.1.1"


def test_spool_lines_key(spark, scratch):
    from clickguard.sources.spool import spool_batch

    with open(f"{scratch}/a.log", "w") as f:
        f.write(GOOD + "\n" + "oops\n" + '{"type": "watch", "ip": "2.2.2.2"}\n')
    with open(f"{scratch}/ignored.txt", "w") as f:
        f.write(GOOD + "\n")
    lines = spool_batch(spark, scratch)
    assert sorted((r[0] or "") for r in lines.select(extract_key()).collect()) == \
        ["", "1.1.1.1", "2.2.2.2"]
    keys = [r[0] for r in lines.select(extract_key().alias("k")).collect()]
    assert keys.count(None) == 1


def test_normalise_action(spark):
    from clickguard.functions.parse import normalise_action

    df = spark.createDataFrame([("click",), ("watch",), ("view",), (None,)], "action string")
    assert [r[0] for r in df.select(normalise_action()).collect()] == \
        ["click", "watch", "unknown", "unknown"]

"""Detector forms against a brute-force reimplementation on random inputs,
including window / slide pairs that do not divide each other."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from clickguard.config import DetectorConfig
from clickguard.operators.incidents import find_incidents, find_incidents_struct
from clickguard.plans.sql import find_incidents_sql
from conftest import T, events_df

EPOCH = dt.datetime(1970, 1, 1)


def text(t: dt.datetime) -> str:
    s = t.strftime("%Y-%m-%d %H:%M:%S")
    if t.microsecond:
        s += ("." + f"{t.microsecond:06d}").rstrip("0")
    return s


def us(t: dt.datetime) -> int:
    return (t - EPOCH) // dt.timedelta(microseconds=1)


def brute(rows, w_s, s_s, min_e, max_e, min_rate):
    w, s = w_s * 1_000_000, s_s * 1_000_000
    out = []
    timed = [r for r in rows if r[2] is not None]
    starts = set()
    for _, _, t in timed:
        x = us(t)
        first = x - x % s
        k = 0
        while first - k * s + w > x:
            starts.add(first - k * s)
            k += 1
    for ip in {r[0] for r in timed}:
        for start in starts:
            inside = [r for r in timed if r[0] == ip and start <= us(r[2]) < start + w]
            if not inside:
                continue
            clicks = sum(1 for r in inside if r[1] == "click")
            watches = sum(1 for r in inside if r[1] == "watch")
            first_t = min(r[2] for r in inside)
            last_t = max(r[2] for r in inside)
            total = clicks + watches
            if total <= min_e:
                continue
            rate = watches / clicks if clicks > 0 else float(watches)
            span = f" from {text(first_t)} to {text(last_t)}"
            if total >= max_e:
                out.append((ip, last_t, f"too much events: {total}{span}"))
            elif rate <= min_rate:
                out.append((ip, last_t, f"too suspicious rate: {rate!r}{span}"))
    return sorted(out)


row = st.tuples(st.sampled_from(["1.1.1.1", "2.2.2.2"]),
                st.sampled_from(["click", "click", "watch", "other"]),
                st.one_of(st.none(), st.integers(min_value=0, max_value=40_000).map(
                    lambda ms: T + dt.timedelta(milliseconds=ms * 1))))
shape = st.sampled_from([(10, 1), (10, 3), (7, 2), (6, 6), (12, 4)])


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(row, min_size=1, max_size=25), ws=shape,
       min_e=st.integers(0, 3), max_e=st.integers(2, 6),
       min_rate=st.sampled_from([0.0, 0.5, 1.0, 2.0]))
def test_forms_equal_brute_force(spark, rows, ws, min_e, max_e, min_rate):
    w, s = ws
    conf = DetectorConfig(window=f"{w} seconds", slide=f"{s} seconds",
                          watermark="1 minute", min_events=min_e, max_events=max_e,
                          min_rate=min_rate)
    expected = brute(rows, w, s, min_e, max_e, min_rate)
    df = events_df(spark, rows)
    forms = {
        "expand": find_incidents(df, conf, strategy="expand"),
        "panes": find_incidents(df, conf, strategy="panes"),
        "sql": find_incidents_sql(spark, df, conf),
        "struct": find_incidents_struct(df, conf),
    }
    for name, out in forms.items():
        assert sorted(map(tuple, out.collect())) == expected, name

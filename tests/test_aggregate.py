"""The event aggregate is a semigroup: merging is associative and any split
of the rows into partial aggregates merges to the direct aggregate."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickguard.functions.aggregate import aggregation_columns, combine, merge_aggregation
from clickguard.schema import AGGREGATE

EPOCH = dt.datetime(1970, 1, 1)
# long counts kept small enough that sums stay in range under ANSI mode
counts = st.integers(min_value=-(2 ** 40), max_value=2 ** 40)
times = st.one_of(st.none(), st.integers(min_value=0, max_value=4_000_000_000_000).map(
    lambda ms: EPOCH + dt.timedelta(milliseconds=ms)))
aggs = st.tuples(counts, counts, times, times)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(aggs, aggs, aggs), min_size=1, max_size=8))
def test_combine_is_associative(spark, triples):
    rows = [(a, b, c) for a, b, c in triples]
    df = spark.createDataFrame(rows, f"a {AGGREGATE.simpleString()}, "
                                     f"b {AGGREGATE.simpleString()}, "
                                     f"c {AGGREGATE.simpleString()}")
    left = combine(combine("a", "b"), "c")
    right = combine("a", combine("b", "c"))
    out = df.select(left.alias("l"), right.alias("r")).collect()
    assert all(r["l"] == r["r"] for r in out)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]),
                          st.sampled_from(["click", "watch", "other", None]),
                          times, st.integers(min_value=0, max_value=3)),
                min_size=1, max_size=40))
def test_partial_then_merge_equals_direct(spark, rows):
    df = spark.createDataFrame(rows, "ip string, action string, eventTime timestamp, "
                                     "part int")
    direct = df.groupBy("ip").agg(*aggregation_columns())
    partial = df.groupBy("ip", "part").agg(*aggregation_columns())
    merged = partial.groupBy("ip").agg(*merge_aggregation())
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, merged.collect()))


def test_struct_aggregate_matches_columns(spark):
    from clickguard.functions.aggregate import event_aggregation

    df = spark.range(100).select(
        (F.col("id") % 3).cast("string").alias("ip"),
        F.when(F.col("id") % 4 == 0, "click").when(F.col("id") % 4 == 1, "watch")
        .otherwise("x").alias("action"),
        F.timestamp_seconds(F.col("id")).alias("eventTime"))
    a = df.groupBy("ip").agg(event_aggregation().alias("g")).select("ip", "g.*")
    b = df.groupBy("ip").agg(*aggregation_columns())
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))

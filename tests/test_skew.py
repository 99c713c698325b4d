"""A single ip holding a third of all events must not land in one task."""

import pytest
from pyspark.sql import functions as F

from clickguard.config import EVENTS_CONFIG
from clickguard.operators.windows import windowed_aggregates
from clickguard.plans.explain import plan_text
from clickguard.sources.tables import click_events


@pytest.fixture
def no_aqe(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def hot_events(spark):
    ev = click_events(spark, "/root/testdata/sf0.01", keep=("user_id",))
    # users 0..499 of 1500 all share one address: a third of all rows
    return ev.withColumn("ip", F.when(F.col("user_id") < 500, F.lit("hot"))
                         .otherwise(F.col("ip"))).drop("user_id")


@pytest.mark.parametrize("strategy", ["expand", "panes"])
def test_hot_ip_spreads_over_partitions(spark, no_aqe, strategy):
    ev = hot_events(spark)
    total = ev.count()
    hot = ev.filter("ip = 'hot'").count()
    assert hot * 4 > total  # really skewed
    agg = windowed_aggregates(ev, EVENTS_CONFIG, strategy=strategy)
    text = plan_text(agg, "simple")
    assert "partial_" in text  # pre-aggregated before every shuffle
    parts = (agg.filter("ip = 'hot'").select(F.spark_partition_id().alias("p"))
             .distinct().count())
    assert parts >= 6  # 8 shuffle partitions; the hot ip's windows are spread
    # and no window of the hot ip was lost
    n_windows = agg.filter("ip = 'hot'").count()
    expected = (ev.filter("ip = 'hot'")
                .select(F.window("eventTime", "1 day", "6 hours").alias("w"))
                .distinct().count())
    assert n_windows == expected

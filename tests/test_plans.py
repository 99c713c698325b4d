"""Physical-plan properties that matter at scale."""

import re

import pytest

from clickguard import catalog
from clickguard.config import EVENTS_CONFIG
from clickguard.operators.incidents import find_incidents
from clickguard.plans.explain import count_shuffles, plan_text
from clickguard.sources.tables import click_events

SF = "/root/testdata/sf0.001"
BATCH = [n for n in catalog.queries() if not n.startswith("stream_")]


def test_scan_is_pruned_and_filter_pushed(spark):
    text = plan_text(find_incidents(click_events(spark, SF), EVENTS_CONFIG))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in text
    assert "PushedFilters: [IsNotNull(ts)]" in text


def test_expand_form_has_one_shuffle(spark):
    df = find_incidents(click_events(spark, SF), EVENTS_CONFIG)
    assert count_shuffles(df) == 1
    text = plan_text(df, "simple")
    assert "Expand" in text and "partial_count" in text


def test_panes_form_fans_out_aggregates_not_rows(spark):
    df = find_incidents(click_events(spark, SF), EVENTS_CONFIG, strategy="panes")
    text = plan_text(df, "simple")
    assert "Expand" not in text and "Generate explode" in text
    assert count_shuffles(df) == 2
    # the second shuffle routes pane aggregates to (ip, block of window
    # starts); the fan-out to windows and the merge run after it, locally
    lines = text.splitlines()
    routed = [i for i, line in enumerate(lines) if "REPARTITION_BY_COL" in line]
    assert len(routed) == 1 and re.search(r"hashpartitioning\(ip#\d+, blk#\d+L?", lines[routed[0]])
    assert not any("Exchange" in line for line in lines[:routed[0]])


def test_panes_form_keeps_no_window_in_a_hash_table(spark):
    """A task that held a row per window of its panes grew with window / slide."""
    conf = EVENTS_CONFIG.with_(slide="10 minutes")
    found = find_incidents(click_events(spark, SF), conf)
    keys = re.findall(r"Aggregate\(keys=\[([^\]]*)\]", plan_text(found, "simple"))
    assert keys and not any("ws#" in k for k in keys)
    # windows of 7 hours each 3: no whole number of slides, and gaps between an ip's panes
    odd = EVENTS_CONFIG.with_(window="7 hours", slide="3 hours", min_events=0, max_events=1)
    want, got = (find_incidents(click_events(spark, SF), odd, strategy=x).collect() for x in ("expand", "panes"))
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and got


@pytest.mark.parametrize("name", BATCH)
def test_no_python_no_pairs_no_driver(spark, name):
    text = plan_text(catalog.queries()[name](spark, SF), "simple")
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                "BroadcastNestedLoopJoin", "FlatMapGroupsInPandas", "Window ["):
        assert bad not in text, (name, bad)


def test_auto_strategy_by_fan_out(spark):
    from clickguard.config import DetectorConfig
    from clickguard.operators.windows import choose_strategy

    ev = click_events(spark, SF)
    assert choose_strategy(ev, DetectorConfig(window="1 day", slide="6 hours")) == "expand"
    assert choose_strategy(ev, DetectorConfig(window="1 day", slide="1 hour")) == "panes"
    stream = spark.readStream.schema(ev.schema).parquet("/root/testdata/sf0.001")
    assert choose_strategy(stream, DetectorConfig(window="1 day", slide="1 hour")) == "expand"


def test_panes_equal_expand_at_high_fan_out(spark):
    from clickguard.config import DetectorConfig

    ev = click_events(spark, SF)
    conf = DetectorConfig(window="1 day", slide="1 hour", watermark="1 day",
                          min_events=2, max_events=5, min_rate=0.5)
    a = find_incidents(ev, conf, strategy="expand").collect()
    b = find_incidents(ev, conf, strategy="panes").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) and len(a) > 0


def test_shuffle_partition_sizing():
    from clickguard.session import shuffle_partitions_for

    assert shuffle_partitions_for(0, cores=8) == 16
    # 5 TB shuffled after map-side combine, 256 MB partitions, 8000 cores
    assert shuffle_partitions_for(5 << 40, cores=8000) == 20_480
    assert shuffle_partitions_for(1 << 50, cores=8) == 1 << 22

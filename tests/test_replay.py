"""Deliveries of a replay: every event comes once, in its batch's folder, in one pass."""

import datetime as dt

import pytest

from clickguard.sources.tables import TABLE_SCHEMAS
from clickguard.streaming import replay

K_OLD, K_NEW = '{"k": 5}', '{"k": 50}'


def events(spark, folder):
    """(event id, day, props): all four quarters but the third, rows without a time."""
    rows = [(0, 1, K_NEW), (1, 1, K_OLD), (2, 9, K_NEW), (3, 9, None), (4, 25, K_OLD), (10, 25, K_NEW), (20, None, K_NEW)]
    rows = [(i, day and dt.datetime(2024, 1, day, 12), 7, "click", 1.0, k) for i, day, k in rows]
    spark.createDataFrame(rows, TABLE_SCHEMAS["events"]).write.parquet(f"{folder}/events.parquet")


class Ended:
    """A streaming query that has ended."""

    isActive = False

    def awaitTermination(self):
        return True

    def exception(self):
        return None


@pytest.mark.parametrize("again_every", [None, 10])
def test_deliveries_are_written_in_one_pass(spark, scratch, monkeypatch, again_every):
    events(spark, scratch)
    passes, come, topic = [], [], f"{scratch}/topic"
    records = replay.kafka_records
    monkeypatch.setattr(replay, "kafka_records", lambda *a, **k: passes.append(1) or records(*a, **k))
    monkeypatch.setattr(replay, "scratch_path", lambda *a, **k: topic)

    def run(stream):
        assert stream.isStreaming and "batch" not in stream.columns
        n = len(come)
        q = (stream.writeStream.format("parquet").option("path", f"{scratch}/out")
             .option("checkpointLocation", f"{scratch}/ckpt").trigger(availableNow=True).start())
        assert q.awaitTermination(300) and q.exception() is None
        assert q.lastProgress is not None, n   # a delivery without records is a batch too
        come.append(sorted(r.offset for r in spark.read.parquet(f"{scratch}/out").collect()))
        return Ended()

    replay.in_batches(spark, scratch, run, again_every=again_every)
    assert len(passes) == (1 if again_every is None else 2)
    new = [[0], [1, 2, 3], [], [4, 10, 20]]
    again = [[], [0], [], [10, 20]] if again_every else [[]] * 4
    assert come == [sorted(sum(new[:i + 1] + again[:i + 1], [])) for i in range(4)]

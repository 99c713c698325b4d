"""Each incident, and each delivered record, once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickguard.config import DetectorConfig
from clickguard.operators.incidents import classify_windows
from clickguard.operators.windows import windowed_aggregates

#: What a delivered record is known by.
RECORD = ("topic", "partition", "offset")


def find_distinct_incidents(events: DataFrame, conf: DetectorConfig) -> DataFrame:
    """Incidents `(ip, lastEvent, reason)`, equal ones of overlapping windows
    once. On a stream in append mode the aggregate is followed by a
    deduplication whose state lives as long as the watermark waits, which must
    cover the windows that share an event: window - slide at least."""
    if not events.isStreaming:
        return classify_windows(windowed_aggregates(events, conf), conf).distinct()
    if conf.watermark_us < conf.window_us - conf.slide_us:
        raise ValueError("the watermark must wait for window - slide or more")
    stats = windowed_aggregates(events, conf).withColumn("closed", F.window_time("window"))
    found = classify_windows(stats, conf, keep=("closed",))
    return found.dropDuplicatesWithinWatermark(["ip", "lastEvent", "reason"]).drop("closed")


def delivered_once(events: DataFrame, conf: DetectorConfig, keys: Sequence[str] = RECORD) -> DataFrame:
    """`events` (with `keys` and eventTime) without records that come again.

    On a stream the result has its watermark; a copy that comes later than the
    watermark waits is late, as its first delivery would be, so nothing is
    counted twice. Rows without an eventTime, which are in no window, go; rows
    with null keys are copies of each other. In batch of several copies any one
    stays: they are equal.
    """
    timed = events.where(F.col("eventTime").isNotNull())
    if not events.isStreaming:
        return timed.dropDuplicates(list(keys))
    return timed.withWatermark("eventTime", conf.watermark_str).dropDuplicatesWithinWatermark(list(keys))


def find_incidents_once(events: DataFrame, conf: DetectorConfig, keys: Sequence[str] = RECORD) -> DataFrame:
    """The detector over records that may be delivered several times."""
    return classify_windows(windowed_aggregates(delivered_once(events, conf, keys), conf, watermark=False), conf)


def find_incidents_of_topics(topics: Sequence[DataFrame], conf: DetectorConfig,
                             delays: Sequence[str] | None = None) -> DataFrame:
    """The detector over several streams of events, each with a watermark of its
    own (`delays`, default the configured one). Which of them closes windows is
    the session's `spark.sql.streaming.multipleWatermarkPolicy` when the query
    starts: ``min``, the slowest topic, so that none is late for another's
    sake, or ``max``, the fastest."""
    marked = [t.withWatermark("eventTime", d) for t, d in
              zip(topics, delays or [conf.watermark_str] * len(topics), strict=True)]
    union = marked[0]
    for t in marked[1:]:
        union = union.unionByName(t)
    return classify_windows(windowed_aggregates(union, conf, watermark=False), conf)

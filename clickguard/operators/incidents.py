"""Incident classification and the event-time detectors.

Rules (first match wins), on a window with `total = clicks + watches`:

* nothing unless ``total > min_events``;
* ``total >= max_events``  -> "too much events: N from A to B";
* ``rate <= min_rate``     -> "too suspicious rate: R from A to B".
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickguard.config import DetectorConfig
from clickguard.functions.aggregate import event_aggregation
from clickguard.functions.text import time_text
from clickguard.operators.windows import rate_columns, windowed_aggregates

# The reason prefixes.
TOO_MANY = "too much events: "
LOW_RATE = "too suspicious rate: "


def reason_column(conf: DetectorConfig, time_format: str | None = None,
                  total=None, rate=None):
    total = F.col("total_events") if total is None else total
    rate = F.col("rate") if rate is None else rate
    span = [F.lit(" from "), time_text(F.col("firstEvent"), time_format),
            F.lit(" to "), time_text(F.col("lastEvent"), time_format)]
    return (F.when(total >= F.lit(conf.max_events),
                   F.concat(F.lit(TOO_MANY), total.cast("string"), *span))
            .when(rate <= F.lit(conf.min_rate),
                  F.concat(F.lit(LOW_RATE), rate.cast("string"), *span)))


def classify_windows(stats: DataFrame, conf: DetectorConfig,
                     time_format: str | None = None,
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """Window aggregates -> incidents `(ip, lastEvent, reason)`.

    The filter is the numeric form of the rules, so it lands right above the
    final aggregate and the reason text is built only for the windows that
    fire.
    """
    cols = rate_columns()
    total, rate = cols["total_events"], cols["rate"]
    # a window whose events have no time would have no reason text
    fires = (F.col("firstEvent").isNotNull() & (total > F.lit(conf.min_events))
             & ((total >= F.lit(conf.max_events)) | (rate <= F.lit(conf.min_rate))))
    return (stats.filter(fires)
            .select("ip", *keep, "lastEvent",
                    reason_column(conf, time_format, total, rate).alias("reason")))


def find_incidents(events: DataFrame, conf: DetectorConfig,
                   require: tuple[str, ...] = (), time_format: str | None = None,
                   strategy: str = "auto") -> DataFrame:
    """The detector over event time. Works unchanged on a batch table and
    on a stream (watermark applied before grouping).

    `require` drops rows with nulls in the named columns first (the typed
    variants use ``("ip", "eventTime")`` and ``("ip", "action")``);
    `time_format` renders the times of the reason with a pattern instead of
    the cast form.
    """
    stats = windowed_aggregates(events, conf, require=require, strategy=strategy)
    return classify_windows(stats, conf, time_format)


def find_incidents_struct(events: DataFrame, conf: DetectorConfig,
                          require: tuple[str, ...] = (),
                          time_format: str | None = None) -> DataFrame:
    """The detector with the aggregate as one struct-valued column."""
    df = events
    for c in require:
        df = df.filter(F.col(c).isNotNull())
    agg = (df.withWatermark("eventTime", conf.watermark_str)
           .groupBy(F.col("ip"), F.window("eventTime", conf.window_str,
                                          conf.slide_str).alias("window"))
           .agg(event_aggregation("action", "eventTime").alias("aggregation")))
    flat = agg.select("ip", "window", "aggregation.*")
    return classify_windows(flat, conf, time_format)


def find_incidents_typed(events: DataFrame, conf: DetectorConfig) -> DataFrame:
    """The typed variant: rows without ip or time are dropped, reason times
    rendered to the second."""
    return find_incidents(events, conf, require=("ip", "eventTime"),
                          time_format="yyyy-MM-dd HH:mm:ss")


def find_incidents_typed_aggregator(events: DataFrame,
                                    conf: DetectorConfig) -> DataFrame:
    """The typed-aggregator variant: rows without ip or action are dropped,
    window kept as a named column, reason times rendered to the second."""
    return find_incidents_struct(events, conf, require=("ip", "action"),
                                 time_format="yyyy-MM-dd HH:mm:ss")

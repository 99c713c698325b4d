"""Detector over arrival (processing) time.

A micro-batch engine with a 1-minute batch and a 10-minute window sliding
by 1 minute re-judges, at every slide, the events that *arrived* in the
last 10 minutes, whatever their event time. Given an arrival column this
is an ordinary sliding-window aggregate over arrival time; first/last are
still event times. The stream form uses the record timestamp (or
``current_timestamp()`` of the micro-batch) as arrival.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickguard.config import DetectorConfig, duration_us
from clickguard.operators.incidents import classify_windows
from clickguard.operators.windows import windowed_aggregates


def batch_time(arrival: Column, batch_us: int) -> Column:
    """The end of the batch interval an arrival falls into, i.e. the time
    of the micro-batch that carries it: batch b covers ``(T - batch, T]``."""
    a = F.unix_micros(arrival)
    return F.timestamp_micros(a + F.pmod(-a, F.lit(batch_us)))


def skip_old(events: DataFrame, conf: DetectorConfig,
             arrival: str = "arrival") -> DataFrame:
    """Drop events older than one window at their arrival:
    ``eventTime < arrival - window``. Evaluated once, on arrival."""
    barrier = F.timestamp_micros(F.unix_micros(F.col(arrival)) - F.lit(conf.window_us))
    return events.filter(~(F.col("eventTime") < barrier))


def find_incidents_by_arrival(events: DataFrame, conf: DetectorConfig,
                              arrival: str = "arrival", skip_old_events: bool = False,
                              quantize_to_batch: bool = False,
                              with_window: bool = False,
                              delay: str | None = None) -> DataFrame:
    """Incidents of every arrival-time window `(ip, lastEvent, reason)`.

    The same incident is reported again in every window that still holds
    the ip's events, as the micro-batch job re-emits it at every slide.
    With `with_window` the window end (the emitting batch's time) is kept.

    On a stream, `delay` is how late an arrival time may be (default: the
    configured watermark). Partitions of a topic progress unevenly and a
    producer may set record times, so it is zero only where arrival is the
    micro-batch's own time.
    """
    df = events
    if quantize_to_batch:
        df = df.withColumn(arrival, batch_time(F.col(arrival), duration_us(conf.batch)))
    if skip_old_events:
        df = skip_old(df, conf, arrival)
    stats = windowed_aggregates(df, conf, time_col="eventTime", group_time=arrival,
                                watermark=df.isStreaming, watermark_delay=delay)
    keep = ("windowEnd",) if with_window else ()
    if with_window:
        stats = stats.withColumn("windowEnd", F.col("window.end"))
    return classify_windows(stats, conf, keep=keep)


def with_batch_arrival(events: DataFrame, arrival: str = "arrival") -> DataFrame:
    """Arrival = the micro-batch's time (``current_timestamp()`` is fixed
    per batch), i.e. windows over batches as a DStream job forms them."""
    return events.withColumn(arrival, F.current_timestamp())


def with_arrival_lag(events: DataFrame, lag_minutes_per_unit: float = 10.0,
                     lag_col: str = "value") -> DataFrame:
    """Arrival = event time + a delivery lag taken from a numeric column of
    the row (`value` x 10 minutes for the driver's `events`): most events
    arrive within hours, a tail arrives more than a day late."""
    from clickguard.sources.kafka import arrival_time

    return events.withColumn(
        "arrival", arrival_time(F.col("eventTime"), F.col(lag_col), lag_minutes_per_unit))

"""A materialised rollup: pane aggregates per day, and the windows made of them.

Below `path`, `panes/day=...` holds one row per (ip, pane) of a UTC day, pane =
gcd(window, slide), and `windows/day=...` the windows that start on a day. A day
that comes, or comes anew, overwrites its own panes and the windows that it can
be in, which start at most a window before it; their panes are read from the days
around, never the events. Each update adds a row per day to `manifest`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from math import gcd

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickguard.config import DetectorConfig
from clickguard.functions.aggregate import aggregation_columns, merge_aggregation
from clickguard.operators.bans import utc_day
from clickguard.operators.incidents import classify_windows

DAY_US = 86_400_000_000
_STATS = "clicks bigint, watches bigint, firstEvent timestamp, lastEvent timestamp"
PANES = f"ip string, pane bigint, {_STATS}, day date"
WINDOWS = f"ip string, start bigint, {_STATS}, day date"
MANIFEST = "day date, kind string, rows bigint, updated_at timestamp"


class Rollup:
    def __init__(self, spark: SparkSession, path: str, conf: DetectorConfig):
        self.spark, self.path, self.conf = spark, path.rstrip("/"), conf
        self.pane = gcd(conf.window_us, conf.slide_us)
        if DAY_US % self.pane:
            raise ValueError("panes must divide a day")
        #: How many days before and after its own a pane's windows reach.
        self.reach = -(-conf.window_us // DAY_US)

    def update(self, events: DataFrame, days: Sequence[dt.date]) -> None:
        """Takes the given UTC days from `events` (ip, action, eventTime), which
        must hold all of their rows, and renews the windows they touch. A run
        that is lost half way is run again."""
        days = sorted(set(days))
        if not days:
            return
        t = F.unix_micros("eventTime")
        mine = events.where(F.col("eventTime").isNotNull() & utc_day(F.col("eventTime")).isin(days))
        panes = (mine.groupBy("ip", (t - F.pmod(t, F.lit(self.pane))).alias("pane"))
                 .agg(*aggregation_columns("action", "eventTime"))
                 .withColumn("day", utc_day(F.timestamp_micros("pane"))))
        self._overwrite(panes, "panes", days)
        touched = sorted({d - dt.timedelta(n) for d in days for n in range(self.reach + 1)})
        self._overwrite(self._windows_of(touched), "windows", touched)

    def _overwrite(self, rows: DataFrame, kind: str, days: Sequence[dt.date]) -> None:
        """Replaces the folders of the days. Each gets a row of nulls besides, so
        that a day left without rows is replaced too; `read` skips it."""
        none = self.spark.createDataFrame([(d,) for d in days], "day date")
        rows = rows.unionByName(none, allowMissingColumns=True)
        (rows.repartition("day", F.pmod(F.xxhash64("ip"), F.lit(16))).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{self.path}/{kind}"))
        done = (self.read(kind, days).groupBy("day").agg(F.count("*").alias("rows"))
                .select("day", F.lit(kind).alias("kind"), "rows", F.current_timestamp().alias("updated_at")))
        done.coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")

    def read(self, kind: str, days: Sequence[dt.date] | None = None) -> DataFrame:
        """The panes or windows, of some days only those folders."""
        rows = self.spark.read.schema(PANES if kind == "panes" else WINDOWS).parquet(f"{self.path}/{kind}")
        rows = rows.where(F.col("clicks").isNotNull())
        return rows if days is None else rows.where(F.col("day").isin(list(days)))

    def manifest(self) -> DataFrame:
        return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest")

    def _windows_of(self, days: Sequence[dt.date]) -> DataFrame:
        """The windows that start on the given days, from the panes of these
        days and those that their windows reach into."""
        w, s = self.conf.window_us, self.conf.slide_us
        around = sorted({d + dt.timedelta(n) for d in days for n in range(self.reach + 1)})
        pane = F.col("pane")
        last = pane - F.pmod(pane, F.lit(s))
        first = pane - F.lit(w - s) - F.pmod(pane - F.lit(w), F.lit(s))
        fanned = (self.read("panes", around).drop("day")
                  .select("*", F.explode(F.sequence(first, last, F.lit(s))).alias("start"))
                  .where(utc_day(F.timestamp_micros("start")).isin(list(days))))
        return (fanned.groupBy("ip", "start").agg(*merge_aggregation())
                .withColumn("day", utc_day(F.timestamp_micros("start"))))

    def incidents(self, days: Sequence[dt.date] | None = None) -> DataFrame:
        """Incidents `(ip, lastEvent, reason)` of all windows, or of those that
        start on the given days."""
        return classify_windows(self.read("windows", days), self.conf)

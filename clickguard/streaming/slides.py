"""Sliding windows on a stream with one ring of panes per ip.

The built-in windowed aggregate keeps a state row for each of the w/s windows
that an event is in, and in update mode judges a window whenever it changes.
Here an ip has one state row, its panes (pane = gcd(w, s)), and a timer at the
end of its next window. When the watermark reaches window ends, each of them
is emitted once, from the panes, by two stacks: panes are pushed on one stack
with a running aggregate and moved to the other, as aggregates of all that
follow, when the first has to leave, so a slide costs a constant number of
merges however many panes a window has. An ip without panes has no state.

Before the shuffle on ip every task merges its rows into (ip, pane) aggregates,
so an ip with a third of all events sends one row per pane and task.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from math import gcd

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from clickguard.config import DetectorConfig
from clickguard.schema import require_columns

# the workers need pyarrow, but not this package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PANE = "ip string, pane bigint, clicks bigint, watches bigint, first bigint, last bigint"
_RING = ("panes array<bigint>, clicks array<bigint>, watches array<bigint>, "
         "firsts array<bigint>, lasts array<bigint>, upto bigint")


def merge(a, b):
    """Two (clicks, watches, first, last); None is the aggregate of nothing."""
    if a is None or b is None:
        return a or b
    first = min((x for x in (a[2], b[2]) if x is not None), default=None)
    last = max((x for x in (a[3], b[3]) if x is not None), default=None)
    return a[0] + b[0], a[1] + b[1], first, last


class TwoStacks:
    """A queue of (pane, aggregate) that knows the aggregate of all it holds."""

    def __init__(self):
        self.front: list = []  # the oldest on top, each with the aggregate from it on
        self.back: list = []
        self.back_total = None

    def push(self, pane, aggregate):
        self.back.append((pane, aggregate))
        self.back_total = merge(self.back_total, aggregate)

    def drop_before(self, start):
        while True:
            if not self.front:
                total = None
                while self.back:
                    pane, aggregate = self.back.pop()
                    total = merge(aggregate, total)
                    self.front.append((pane, total))
                self.back_total = None
            if not self.front or self.front[-1][0] >= start:
                return
            self.front.pop()

    def total(self):
        return merge(self.front[-1][1] if self.front else None, self.back_total)


def slide_aggregates(panes: dict, w: int, s: int, after: int, until: int) -> Iterator[tuple]:
    """(window start, aggregate) of the windows [start, start + w) at multiples
    of s that hold a pane and end in (after, until], in order. Stretches without
    a pane are skipped."""
    queue, todo = TwoStacks(), sorted(panes)
    i, start = 0, -((w - after - 1) // s) * s  # the first that ends after `after`
    while start + w <= until:
        while i < len(todo) and todo[i] < start + w:
            queue.push(todo[i], panes[todo[i]])
            i += 1
        queue.drop_before(start)
        total = queue.total()
        if total is not None:
            yield start, total
            start += s
        elif i < len(todo):
            start = max(start + s, -((w - todo[i] - 1) // s) * s)
        else:
            return


class PaneRing(StatefulProcessor):
    """State of an ip: its panes, and up to when windows have been emitted."""

    def __init__(self, window_us: int, slide_us: int):
        self.w, self.s = window_us, slide_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ring = handle.getValueState("ring", _RING)

    def close(self) -> None:
        pass

    def _load(self, now: int):
        if not self.ring.exists():
            return {}, now
        at, clicks, watches, firsts, lasts, upto = self.ring.get()
        return dict(zip(at, zip(clicks, watches, firsts, lasts))), upto

    def _last_end(self, pane: int) -> int:
        return pane // self.s * self.s + self.w

    def _next_end(self, panes: dict, upto: int) -> int:
        """The end of the first window after `upto` that holds a pane."""
        first = min(panes)
        start = max(-((self.w - first - 1) // self.s), -((self.w - upto - 1) // self.s)) * self.s
        while not any(start <= p < start + self.w for p in panes):
            start += self.s
        return start + self.w

    def _store(self, panes: dict, upto: int) -> None:
        panes = {p: a for p, a in panes.items() if self._last_end(p) > upto}
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if not panes:
            self.ring.clear()
            return
        at = sorted(panes)
        self.ring.update((at, *(list(c) for c in zip(*(panes[p] for p in at))), upto))
        # a timer is due when the watermark is past it, a window when it is reached
        self.handle.registerTimer(-(-self._next_end(panes, upto) // 1000) - 1)

    def handleInputRows(self, key, rows, timerValues):
        panes, upto = self._load(max(timerValues.getCurrentWatermarkInMs(), 0) * 1000)
        for r in rows:
            if self._last_end(r.pane) > upto:
                panes[r.pane] = merge(panes.get(r.pane), (r.clicks, r.watches, r.first, r.last))
        self._store(panes, upto)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentWatermarkInMs() * 1000
        panes, upto = self._load(now)
        out = [Row(ip=key[0], start=start, clicks=a[0], watches=a[1], first=a[2], last=a[3])
               for start, a in slide_aggregates(panes, self.w, self.s, upto, now)]
        self._store(panes, max(upto, now))
        return iter(out)


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows merged by (ip, pane), a batch at a time."""
    names = ["clicks", "watches", "first", "last"]
    how = ["sum", "sum", "min", "max"]
    for b in batches:
        t = pa.Table.from_batches([b]).group_by(["ip", "pane"]).aggregate(list(zip(names, how)))
        t = t.select(["ip", "pane", *(f"{n}_{h}" for n, h in zip(names, how))]).rename_columns(["ip", "pane", *names])
        yield from t.combine_chunks().to_batches()


def slide_stats(events: DataFrame, conf: DetectorConfig, time_col: str = "eventTime",
                group_time: str | None = None, delay: str | None = None) -> DataFrame:
    """Of a stream `(ip, action, time)`: `(ip, window, clicks, watches,
    firstEvent, lastEvent)`, each window of `group_time` (default `time_col`)
    that holds events of the ip once, when the watermark reaches its end.

    A window whose end the watermark has reached takes no more rows; a late row
    still counts in its later windows. For append mode. Rows without a
    `group_time` are in no window; a null ip is an address like any other.
    """
    group_time = group_time or time_col
    require_columns(events, "ip", "action", time_col, group_time)
    w, s = conf.window_us, conf.slide_us
    t = F.unix_micros(group_time)
    first = F.unix_micros(time_col)
    # the time column itself stays behind: Spark would drop a row whose own time
    # is late, though windows that hold it are open
    rows = (events.withWatermark(group_time, delay or conf.watermark_str)
            .where(F.col(group_time).isNotNull())
            .select("ip", (t - F.pmod(t, F.lit(gcd(w, s)))).alias("pane"),
                    F.coalesce((F.col("action") == "click").cast("long"), F.lit(0).cast("long")).alias("clicks"),
                    F.coalesce((F.col("action") == "watch").cast("long"), F.lit(0).cast("long")).alias("watches"),
                    first.alias("first"), first.alias("last")))
    rings = (rows.mapInArrow(_combined, _PANE).groupBy("ip")
             .transformWithState(PaneRing(w, s),
                                 "ip string, start bigint, clicks bigint, watches bigint, first bigint, last bigint",
                                 outputMode="Append", timeMode="EventTime"))
    return rings.select(
        "ip", F.struct(F.timestamp_micros("start").alias("start"),
                       F.timestamp_micros(F.col("start") + F.lit(w)).alias("end")).alias("window"),
        "clicks", "watches", F.timestamp_micros("first").alias("firstEvent"),
        F.timestamp_micros("last").alias("lastEvent"))

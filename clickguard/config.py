"""Detector settings and duration handling."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

_UNIT_US = {
    "us": 1,
    "microsecond": 1,
    "ms": 1_000,
    "millisecond": 1_000,
    "s": 1_000_000,
    "second": 1_000_000,
    "m": 60_000_000,
    "min": 60_000_000,
    "minute": 60_000_000,
    "h": 3_600_000_000,
    "hour": 3_600_000_000,
    "d": 86_400_000_000,
    "day": 86_400_000_000,
    "w": 604_800_000_000,
    "week": 604_800_000_000,
}

_PART = re.compile(r"\s*(\d+)\s*([a-zA-Z]+)\s*")


def duration_us(text: str | int | float) -> int:
    """Parse ``"10m"``, ``"1d"``, ``"10 minutes"``, ``"1 hour 30 minutes"``
    (or a number of seconds) into microseconds."""
    if isinstance(text, (int, float)):
        return int(round(text * 1_000_000))
    s = text.strip().lower()
    if s.startswith("interval"):
        s = s[len("interval"):]
    total, pos = 0, 0
    for m in _PART.finditer(s):
        if m.start() != pos:
            break
        unit = m.group(2)
        if unit not in _UNIT_US and unit.endswith("s") and unit[:-1] in _UNIT_US:
            unit = unit[:-1]
        if unit not in _UNIT_US:
            raise ValueError(f"unknown duration unit in {text!r}")
        total += int(m.group(1)) * _UNIT_US[unit]
        pos = m.end()
    if pos != len(s) or pos == 0:
        raise ValueError(f"cannot parse duration {text!r}")
    return total


def spark_interval(us: int) -> str:
    """Microseconds as an interval string that ``window()`` and
    ``withWatermark()`` accept."""
    if us % 1_000_000 == 0:
        return f"{us // 1_000_000} seconds"
    if us % 1_000 == 0:
        return f"{us // 1_000} milliseconds"
    return f"{us} microseconds"


@dataclass(frozen=True)
class DetectorConfig:
    """Thresholds and window settings of the detector.

    Defaults are the reference application's settings.
    """

    window: str = "10 minutes"
    slide: str = "1 minute"
    watermark: str = "10 minutes"
    min_events: int = 5
    max_events: int = 100
    min_rate: float = 0.8
    ban_time: str = "1 day"
    batch: str = "1 minute"

    def __post_init__(self):
        for name in ("window", "slide", "watermark", "ban_time", "batch"):
            duration_us(getattr(self, name))
        if self.window_us <= 0 or self.slide_us <= 0:
            raise ValueError("window and slide must be positive")
        if self.slide_us > self.window_us:
            raise ValueError("slide must not exceed window")
        if self.min_events < 0 or self.max_events < 0:
            raise ValueError("event thresholds must be >= 0")

    @property
    def window_us(self) -> int:
        return duration_us(self.window)

    @property
    def slide_us(self) -> int:
        return duration_us(self.slide)

    @property
    def watermark_us(self) -> int:
        return duration_us(self.watermark)

    @property
    def ban_us(self) -> int:
        return duration_us(self.ban_time)

    @property
    def window_str(self) -> str:
        return spark_interval(self.window_us)

    @property
    def slide_str(self) -> str:
        return spark_interval(self.slide_us)

    @property
    def watermark_str(self) -> str:
        return spark_interval(self.watermark_us)

    def with_(self, **kw) -> "DetectorConfig":
        return replace(self, **kw)


@dataclass(frozen=True)
class KafkaConfig:
    """Where the click log is read from and how fast.

    `max_offsets_per_trigger` caps one micro-batch over all partitions; the
    Kafka source keeps its offsets in the query checkpoint (no consumer
    group commits are needed for exactly-once replay). `group_id_prefix`
    only names the consumers (Spark adds a unique suffix per query, so two
    queries never share a group).
    """

    brokers: str = "127.0.0.1:9092"
    topics: tuple[str, ...] = ("clicks",)
    starting_offsets: str = "earliest"
    max_offsets_per_trigger: int = 1_000_000
    group_id_prefix: str = "clickguard"
    options: dict = field(default_factory=dict, compare=False)

    def __post_init__(self):
        if self.starting_offsets not in ("earliest", "latest") \
                and not self.starting_offsets.startswith("{"):
            raise ValueError("starting_offsets must be earliest, latest or a JSON offset map")
        if self.max_offsets_per_trigger is not None and self.max_offsets_per_trigger <= 0:
            raise ValueError("max_offsets_per_trigger must be positive")


# Settings used by the registered queries over the driver's `events` table
# (one month of data): 1-day windows sliding every 6 hours.
EVENTS_CONFIG = DetectorConfig(
    window="1 day",
    slide="6 hours",
    watermark="1 day",
    min_events=2,
    max_events=5,
    min_rate=0.5,
    ban_time="1 day",
)

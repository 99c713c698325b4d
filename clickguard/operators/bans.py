"""Ban records and the current-ban view.

The reference upserts `(ip, period, reason)` into a keyed table with a
TTL. Here the table is an append-only log (each write stamped with
`written_at`, `batch_id`, `expires_at`) plus a view that picks, per ip,
the last write and keeps it while it has not expired. The log is
idempotent per (run, batch) and the view is a single aggregate with
map-side combine - no window function, so a hot ip never lands whole in
one task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickguard.config import DetectorConfig


def utc_midnight(day: str) -> Column:
    """The instant `day` (``YYYY-MM-DD``) begins in UTC, whatever the
    session zone: log folders are named by UTC write day."""
    d = dt.date.fromisoformat(day)
    return F.timestamp_micros(F.lit((d - dt.date(1970, 1, 1)).days * 86_400_000_000))


def utc_day(ts: Column) -> Column:
    """The UTC calendar day of an instant (zone-free, unlike `to_date`)."""
    return F.date_from_unix_date(F.floor(F.unix_micros(ts) / F.lit(86_400_000_000)).cast("int"))


def ban_period(last_event: Column, ban_us: int, precision: str = "s") -> Column:
    """Epoch milliseconds until which the ip is banned.

    ``"s"``: whole seconds of `lastEvent` plus the ban, times 1000 (the
    structured jobs); ``"ms"``: `lastEvent` in ms plus the ban (the
    micro-batch job).
    """
    if precision == "s":
        return (last_event.cast("long") + F.lit(ban_us // 1_000_000)) * F.lit(1000)
    if precision == "ms":
        return F.unix_millis(last_event) + F.lit(ban_us // 1_000)
    raise ValueError(f"precision must be 's' or 'ms', not {precision!r}")


def ban_records(incidents: DataFrame, conf: DetectorConfig,
                precision: str = "s") -> DataFrame:
    """Incidents -> `(ip, period, reason)`."""
    return incidents.select(
        "ip", ban_period(F.col("lastEvent"), conf.ban_us, precision).alias("period"),
        "reason")


def ban_log_rows(bans: DataFrame, written_at: Column, ttl_s: int,
                 batch_id: int | Column = 0) -> DataFrame:
    """Ban records stamped for the log. A TTL of 0 never expires."""
    bid = batch_id if isinstance(batch_id, Column) else F.lit(batch_id).cast("long")
    expires = (F.lit(None).cast("timestamp") if ttl_s == 0
               else F.timestamp_micros(F.unix_micros(written_at)
                                       + F.lit(ttl_s * 1_000_000)))
    return bans.select("ip", "period", "reason",
                       written_at.alias("written_at"),
                       bid.alias("batch_id"),
                       expires.alias("expires_at"))


def replay_ban_log(incidents: DataFrame, conf: DetectorConfig,
                   precision: str = "s") -> DataFrame:
    """The log a live job would have written had it run in event time:
    each ban is written at its `lastEvent` and lives for the ban time."""
    bans = incidents.select(
        "ip", ban_period(F.col("lastEvent"), conf.ban_us, precision).alias("period"),
        "reason", "lastEvent")
    return ban_log_rows(bans, F.col("lastEvent"), conf.ban_us // 1_000_000)


def latest_per_ip(log: DataFrame, order: list[str]) -> DataFrame:
    """Per ip, the whole row that is greatest by `order` (ties broken by
    every remaining column), as one aggregate."""
    rest = [c for c in log.columns if c != "ip"]
    best = F.max_by(F.struct(*[F.col(c) for c in rest]),
                    F.struct(*[F.col(c) for c in order + [c for c in rest if c not in order]]))
    return log.groupBy("ip").agg(best.alias("_b")).select("ip", "_b.*")


def current_bans(log: DataFrame, as_of: Column | str | None = None,
                 horizon: str | None = None) -> DataFrame:
    """Bans in force at `as_of`: per ip the last write made at or before
    `as_of` (later batch, then higher period and reason win ties), kept if
    it has not expired. `as_of=None` means the newest write in the log -
    a scalar subquery over the log, so nothing passes through the driver;
    every write is then at or before it and that filter is skipped.

    `horizon` (the longest TTL the log was written with) bounds the scan: a
    write older than ``as_of - horizon`` has expired, and if it is an ip's
    latest the ip has no ban, so such writes are skipped - on a log
    partitioned by `written_date` whole days are pruned. Only valid when
    every write expires (TTL > 0).
    """
    order = ["written_at", "batch_id", "period", "reason"]
    if as_of is None:
        as_of_col = log.select(F.max("written_at")).scalar()
    else:
        as_of_col = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    if horizon is not None:
        from clickguard.config import duration_us

        h_us = duration_us(horizon)
        floor = F.timestamp_micros(F.unix_micros(as_of_col) - F.lit(h_us))
        recent = F.col("written_at") > floor
        if "written_date" in log.columns:
            recent = (F.col("written_date") >= utc_day(floor)) & recent
        log = log.filter(recent)
    if as_of is not None:
        log = log.filter(F.col("written_at") <= as_of_col)
    last = latest_per_ip(log.drop(*[c for c in ("written_date", "run", "batch")
                                    if c in log.columns]), order)
    return (last.filter(F.col("expires_at").isNull() | (F.col("expires_at") > as_of_col))
            .select("ip", "period", "reason", "written_at", "expires_at"))


def dedupe_batch(bans: DataFrame) -> DataFrame:
    """Within one micro-batch several windows of an ip may fire; keep the
    highest (period, reason) so the write is deterministic."""
    return latest_per_ip(bans, ["period", "reason"])


_LOG_PARTITIONS = ("written_date", "run", "batch")


def compact_bans(log: DataFrame, before: str) -> DataFrame:
    """The writes of `log` made before day `before` (``YYYY-MM-DD``, UTC),
    reduced to the last write per ip, without those expired by then.

    The view's pick is a maximum under a total order, so the last write of
    (snapshot + every later write) is the last write of the whole log; a
    write expired at the cut is expired at any later `as_of`, so dropping it
    changes nothing from the cut on. The snapshot is bounded by the ips with
    a live ban (by all ips ever banned when the TTL is 0) and replaces the
    days before the cut: `with_snapshot` reads it plus the newer days. One
    aggregate with map-side combine, shuffled on ip. A previous snapshot
    can be folded in: ``compact_bans(with_snapshot(old, log, old_cut), cut)``.
    """
    cut = utc_midnight(before)
    old = log.filter(F.col("written_at") < cut)
    if "written_date" in log.columns:
        old = log.filter((F.col("written_date") < F.lit(before).cast("date"))
                         & (F.col("written_at") < cut))
    last = latest_per_ip(old.drop(*[c for c in _LOG_PARTITIONS if c in log.columns]),
                         ["written_at", "batch_id", "period", "reason"])
    return last.filter(F.col("expires_at").isNull() | (F.col("expires_at") > cut))


def with_snapshot(snapshot: DataFrame, log: DataFrame, since: str) -> DataFrame:
    """A compacted snapshot plus the writes of `log` from day `since` on
    (whole days pruned at the scan on a log partitioned by `written_date`);
    `current_bans` over it equals `current_bans` over the whole log for any
    `as_of` at or after `since`."""
    recent = log.filter(F.col("written_at") >= utc_midnight(since))
    if "written_date" in log.columns:
        recent = log.filter((F.col("written_date") >= F.lit(since).cast("date"))
                            & (F.col("written_at") >= utc_midnight(since)))
    return snapshot.unionByName(recent.select(*snapshot.columns))

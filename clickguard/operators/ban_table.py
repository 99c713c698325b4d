"""The keyed ban table: look up the bans of given ips without a scan.

Every write is a run: its last write per ip, in hash buckets of ip, sorted by ip,
with a parquet bloom filter on ip. Runs are kept in tiers. When a tier has
`fanout` runs they are merged into one run of the next tier, so a write is
rewritten once per tier, log(writes) times in all, and a compaction reads one
tier only. A lookup opens, in each of the few runs, the buckets of its ips, and
there the row groups whose bloom filter has them.

Which runs make up the table is a manifest, one small parquet folder per version;
a version is written once and never changed, so readers see whole versions, a
second writer of the same version fails, and a run that was written but not
committed is not seen. Merged runs stay in place; removing them is the storage's
retention policy.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickguard.operators.bans import latest_per_ip
from clickguard.schema import BAN_LOG

ORDER = ["written_at", "batch_id", "period", "reason"]
_ROWS = T.StructType([f for f in BAN_LOG.fields if f.name in ("ip", "expires_at", *ORDER)])
_STORED = T.StructType([*_ROWS.fields, T.StructField("bucket", T.IntegerType())])
_MANIFEST = "run string, tier int, rows bigint, newest timestamp, buckets int"


class BanTable:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, fanout: int = 4):
        """`buckets` holds for a new table; an old one keeps its own."""
        if buckets < 1 or fanout < 2:
            raise ValueError("buckets must be 1 or more, fanout 2 or more")
        self.spark, self.path, self.fanout = spark, path.rstrip("/"), fanout
        self.version, self.runs = self._newest()
        self.buckets = self.runs[0]["buckets"] if self.runs else buckets

    # --- manifest

    def _read(self, version: int) -> list[dict] | None:
        try:
            rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/_manifest/v={version}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return None
        return [r.asDict() for r in rows.collect()]  # a few rows a tier

    def _newest(self) -> tuple[int, list[dict]]:
        """Versions have no gaps: double the step, then halve it."""
        low, step, found = 0, 1, []
        while (runs := self._read(low + step)) is not None:
            low, step, found = low + step, step * 2, runs
        while step > 1:
            step //= 2
            if (runs := self._read(low + step)) is not None:
                low, found = low + step, runs
        return low, sorted(found, key=lambda r: (r["tier"], r["run"]))

    def _commit(self, runs: list[dict]) -> None:
        rows = [tuple(r[c] for c in ("run", "tier", "rows", "newest", "buckets")) for r in runs]
        (self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("errorifexists")
         .parquet(f"{self.path}/_manifest/v={self.version + 1}"))
        self.version, self.runs = self.version + 1, runs

    # --- writing

    def bucket(self, ip: Column) -> Column:
        return F.pmod(F.xxhash64(ip), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, tier: int) -> dict | None:
        """Writes a run of one row per ip; None if there are none."""
        run = uuid.uuid4().hex
        found = F.col("ip")
        (rows.select(*_ROWS.names).withColumn("bucket", self.bucket(found))
         .repartition("bucket").sortWithinPartitions("bucket", "ip")
         .write.partitionBy("bucket").option("parquet.bloom.filter.enabled#ip", "true")
         .parquet(f"{self.path}/run={run}"))
        n, newest = self._open([run]).agg(F.count("*"), F.max("written_at")).first()
        return {"run": run, "tier": tier, "rows": n, "newest": newest, "buckets": self.buckets} if n else None

    def append(self, log: DataFrame) -> None:
        """Adds the writes of `log` (columns of the ban log), then merges each
        tier that is full."""
        new = self._write(latest_per_ip(log.select(*_ROWS.names), ORDER), 0)
        if new is None:
            return
        runs = [*self.runs, new]
        for tier in range(max(r["tier"] for r in runs) + 1):
            full = [r for r in runs if r["tier"] == tier]
            if len(full) >= self.fanout:
                rest = [r for r in runs if r["tier"] != tier]
                merged = self._write(self._merged(full, oldest=all(r["tier"] < tier for r in rest)), tier + 1)
                runs = rest + ([merged] if merged else [])
        self._commit(runs)

    def _merged(self, runs: list[dict], oldest: bool) -> DataFrame:
        """The last write per ip. An expired one hides older writes, so it goes
        only where there are none."""
        last = latest_per_ip(self._open([r["run"] for r in runs]).drop("bucket"), ORDER)
        if not oldest:
            return last
        newest = max(r["newest"] for r in runs)
        return last.where(F.col("expires_at").isNull() | (F.col("expires_at") > F.lit(newest)))

    # --- reading

    def _open(self, runs: list[str]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], _STORED)
        # the bucket folders of each run, one relation a run
        parts = [self.spark.read.schema(_STORED).parquet(f"{self.path}/run={r}") for r in runs]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def _current(self, rows: DataFrame, as_of: Column | None) -> DataFrame:
        if as_of is None:
            as_of = F.lit(max((r["newest"] for r in self.runs), default=None)).cast("timestamp")
        last = latest_per_ip(rows.where(F.col("written_at") <= as_of).drop("bucket"), ORDER)
        return (last.where(F.col("expires_at").isNull() | (F.col("expires_at") > as_of))
                .select("ip", "period", "reason", "written_at", "expires_at"))

    def bans(self) -> DataFrame:
        """All bans in force at the newest write."""
        return self._current(self._open([r["run"] for r in self.runs]), None)

    def bans_of(self, ips: Iterable[str] | DataFrame) -> DataFrame:
        """The bans in force, at the newest write, of some ips: a few given by
        name, whose buckets are then all that is opened, or a DataFrame with a
        column `ip` of any size, joined by bucket and ip (the buckets are pruned
        at run time where they are few). Ips without a ban give no row, repeated
        and null ones are as given once and not at all."""
        rows = self._open([r["run"] for r in self.runs])
        if isinstance(ips, DataFrame):
            asked = (ips.select(F.col("ip").cast("string")).where("ip IS NOT NULL").distinct()
                     .withColumn("bucket", self.bucket(F.col("ip"))))
            return self._current(rows.join(asked, ["bucket", "ip"], "left_semi"), None)
        names = sorted({str(i) for i in ips if i is not None})
        if not names:
            return self._current(rows.limit(0), None)
        asked = self.spark.createDataFrame([(n,) for n in names], "ip string")
        buckets = sorted({r[0] for r in asked.select(self.bucket(F.col("ip"))).collect()})
        return self._current(rows.where(F.col("bucket").isin(buckets) & F.col("ip").isin(names)), None)

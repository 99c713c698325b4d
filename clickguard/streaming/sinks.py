"""Stream sinks.

* ban table (update mode): `foreachBatch` into an append-only parquet log,
  one directory per (write date, run, batch) written with overwrite, so a
  replayed batch replaces itself (idempotent) and a new run never touches
  an older one. `clickguard.operators.bans.current_bans` is the keyed view
  on it; with a TTL horizon it prunes every day older than the horizon.
* parquet archive (append mode), console, and a row-wise `foreach` writer.
"""

from __future__ import annotations

import calendar
import datetime as dt
import json
import os
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickguard.operators.bans import ban_log_rows, dedupe_batch, utc_day
from clickguard.schema import BAN_LOG, BAN_RECORD
from clickguard.session import is_local_path, local_fs_path, shared_dir

#: Rows that a file of a micro-batch's log holds, about.
ROWS_PER_FILE = 1_000_000


def run_key(spark: SparkSession, checkpoint: str) -> str:
    """The log folder key of a streaming query: the query's id, which Spark
    keeps in its checkpoint before the first batch runs.

    A query restarted from its checkpoint (after a driver or executor loss)
    replays its unfinished batch under the same id and batch number, so it
    overwrites that batch's own folder. A checkpoint that was cleared and
    made anew, at the same path or another, has another id: its batches start
    again at 0 and touch nothing of the older run.
    """
    meta = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(meta)["id"].replace("-", "")


class _RunWriter:
    """What `foreachBatch` functions share: the folder, and the run's key,
    taken from the checkpoint at the first batch."""

    def __init__(self, path: str, run_id: str | None = None, checkpoint: str | None = None):
        self.path = path.rstrip("/")
        self.checkpoint = checkpoint
        self.run_id = run_id or (None if checkpoint else uuid.uuid4().hex)

    def run(self, spark: SparkSession) -> str:
        if self.run_id is None:
            self.run_id = run_key(spark, self.checkpoint)
        return self.run_id


def write_sized(rows: DataFrame, path: str) -> int:
    """Writes a batch's rows with about `ROWS_PER_FILE` a file, whatever the
    number of state partitions (adaptive execution does not coalesce inside a
    micro-batch), and returns their number. An empty batch writes no files."""
    rows.persist()
    try:
        n = rows.count()
        rows.coalesce(max(1, -(-n // ROWS_PER_FILE))).write.mode("overwrite").parquet(path)
        return n
    finally:
        rows.unpersist()


@dataclass(frozen=True)
class BanSinkOptions:
    path: str
    columns: tuple[str, ...]
    ttl: int = 0


def validate_ban_sink_options(options: dict[str, str]) -> BanSinkOptions:
    """The sink's settings from text options: `ban.path` (a folder),
    `ban.columns` (what ip, period and reason are called in the table) and
    `ban.ttl` (seconds; 0, the default, keeps bans for good). One `ValueError`
    lists all that is unusable."""
    unusable = {}
    path = (options.get("ban.path") or "").strip()
    if not path:
        unusable["ban.path"] = "no folder given"
    columns = tuple(c.strip() for c in (options.get("ban.columns") or "").split(","))
    if len(columns) != 3 or not all(columns) or len({c.lower() for c in columns}) != 3:
        unusable["ban.columns"] = "three different names, separated by commas, are needed"
    ttl = str(options.get("ban.ttl", "0")).strip()
    if not ttl.isdecimal():
        unusable["ban.ttl"] = f"{ttl!r} is no whole number of seconds"
    if unusable:
        raise ValueError("; ".join(f"{k}: {why}" for k, why in unusable.items()))
    return BanSinkOptions(path=path, columns=columns, ttl=int(ttl))


class BanLogWriter(_RunWriter):
    """`foreachBatch` function that upserts ban records into the log.

    The batch's three columns are paired by position with the table's
    `columns` (default ``ip, period, reason``). Those three in another order
    say which is which; other names are what ip, period and reason are called
    in the table. Another number of columns or other types raise. Within a batch, several windows of one ip may fire; the highest
    (period, reason) is kept so the write is deterministic.
    """

    def __init__(self, path: str, ttl_s: int, run_id: str | None = None,
                 columns: tuple[str, ...] | None = None, checkpoint: str | None = None):
        super().__init__(path, run_id, checkpoint)
        self.ttl_s = ttl_s
        self.columns = tuple(columns or BAN_RECORD.names)
        self.seen = False

    @classmethod
    def from_options(cls, options: dict[str, str], run_id: str | None = None,
                     checkpoint: str | None = None):
        o = validate_ban_sink_options(options)
        return cls(o.path, o.ttl, run_id, o.columns, checkpoint)

    def _written_before(self, spark: SparkSession, batch_id: int) -> int | None:
        """The write time of this batch if an earlier attempt wrote it. Only a
        writer's first batch can be a replay."""
        if self.seen:
            return None
        old = _open_log(spark, self.path, f"written_date=*/run={self.run(spark)}/batch={batch_id}")
        return old.agg(F.max(F.unix_micros("written_at"))).first()[0]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        own = sorted(self.columns) == sorted(BAN_RECORD.names)
        roles = self.columns if own else tuple(BAN_RECORD.names)
        if [f.dataType for f in batch.schema.fields] != [BAN_RECORD[r].dataType for r in roles]:
            raise ValueError(f"{batch.schema.simpleString()} does not hold {', '.join(roles)}")
        spark = batch.sparkSession
        bans = batch.toDF(*roles).select(*BAN_RECORD.names)
        # One write time per batch, known here so it can name the folder: the
        # log is partitioned by write date, which lets the current view prune
        # every day older than the TTL horizon. A replay keeps the first
        # attempt's time, so it finds that folder again and no ban lives longer.
        now_us = self._written_before(spark, batch_id) or time.time_ns() // 1_000
        self.seen = True
        day = dt.datetime.fromtimestamp(now_us / 1e6, dt.timezone.utc).date().isoformat()
        written = F.timestamp_micros(F.lit(now_us))
        rows = ban_log_rows(dedupe_batch(bans), written, self.ttl_s, batch_id)
        rows = rows.withColumnsRenamed({} if own else dict(zip(roles, self.columns)))
        write_sized(rows, f"{self.path}/written_date={day}/run={self.run(spark)}/batch={batch_id}")


def _open_log(spark, base: str, folders: str = "") -> DataFrame:
    """The log's folders by its declared schema; none give an empty log."""
    from pyspark.errors import AnalysisException

    r = spark.read.schema(BAN_LOG).option("basePath", base)
    try:
        return r.parquet(f"{base}/{folders}" if folders else base)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
    return spark.createDataFrame([], BAN_LOG)


def day_globs(first: dt.date, last: dt.date) -> list[str]:
    """Names that match the days from `first` to `last`: whole years and months
    as one name each, so their number hardly grows with the range."""
    names, day = [], first
    while day <= last:
        month_end = day.replace(day=calendar.monthrange(day.year, day.month)[1])
        year_end = day.replace(month=12, day=31)
        if day.day == day.month == 1 and year_end <= last:
            names.append(f"{day.year:04d}-*")
            day = year_end
        elif day.day == 1 and month_end <= last:
            names.append(f"{day.year:04d}-{day.month:02d}-*")
            day = month_end
        else:
            names.append(day.isoformat())
        day += dt.timedelta(days=1)
    return names


def read_ban_log(spark, path: str, since: str | None = None,
                 until: str | None = None) -> DataFrame:
    """The ban log at `path`, or only its days from `since` to `until`
    (``YYYY-MM-DD``, inclusive; `until` defaults to today, UTC).

    With `since` the day folders are named by a glob built from the date
    range, so older days are neither listed nor read: the open costs the
    days in range (the TTL horizon, or the days after a compaction cut),
    not the whole history. A log without folders (in the range, or at all:
    no batch has written yet) is empty.
    """
    base = path.rstrip("/")
    if since is None:
        return _open_log(spark, base)
    last = (dt.date.fromisoformat(until) if until
            else dt.datetime.now(dt.timezone.utc).date())
    names = day_globs(dt.date.fromisoformat(since), last)
    if not names:
        return spark.createDataFrame([], BAN_LOG)
    return _open_log(spark, base, f"written_date={{{','.join(names)}}}")


class UpsertLogWriter(_RunWriter):
    """`foreachBatch` function for any update-mode result: each batch's
    changed rows go to ``<path>/run=<id>/batch=<n>`` (overwrite), stamped
    with the batch's write time. The latest row per key is the table (see
    `latest_state`)."""

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        written = F.timestamp_micros(F.lit(time.time_ns() // 1_000))
        write_sized(batch.withColumn("written_at", written),
                    f"{self.path}/run={self.run(batch.sparkSession)}/batch={batch_id}")


def read_upsert_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An `UpsertLogWriter` log of rows of `schema`, which may be empty."""
    return spark.read.schema(T.StructType(
        [*schema.fields, T.StructField("written_at", T.TimestampType()),
         T.StructField("run", T.StringType()), T.StructField("batch", T.IntegerType())])).parquet(path)


def latest_state(log: DataFrame, keys: list[str]) -> DataFrame:
    """Per key, the row of the newest write of an `UpsertLogWriter` log:
    by write time, then batch id (a run on a new checkpoint starts its
    batch ids at 0 again, so the id alone does not order runs)."""
    meta = ("run", "batch", "written_at")
    value_cols = [c for c in log.columns if c not in keys and c not in meta]
    order = F.struct(*[F.col(c) for c in ("written_at", "batch") if c in log.columns])
    best = F.max_by(F.struct(*value_cols), order)
    return log.groupBy(*keys).agg(best.alias("_v")).select(*keys, "_v.*")


class JsonLinesForeachWriter:
    """Row-wise `foreach` sink: one JSON line per row into
    ``<path>/run=<query id>/epoch=<e>/part-<partition>.jsonl``, with the time
    it expires (epoch ms, null without a TTL).

    `open` always accepts (duplicates are tolerated: the file of a
    replayed (run, epoch, partition) is rewritten whole). `path` and
    `checkpoint` must be below the cluster's shared folder, mounted on every
    executor; off a local master anything else raises.
    """

    def __init__(self, spark: SparkSession, path: str, checkpoint: str, ttl_s: int = 0):
        for p in (path, checkpoint):
            if not is_local_path(p):
                raise ValueError(f"{p}: the row writer needs a mounted folder")
            if not spark.sparkContext.master.startswith("local"):
                base = local_fs_path(shared_dir(spark)).lstrip("/") + "/"
                if not local_fs_path(p).lstrip("/").startswith(base):
                    raise ValueError(f"{p} is not below the shared folder")
        self.path, self.checkpoint = local_fs_path(path), local_fs_path(checkpoint)
        self.ttl_s = ttl_s
        self._f = None

    def open(self, partition_id: int, epoch_id: int) -> bool:
        with open(os.path.join(self.checkpoint, "metadata"), encoding="utf-8") as f:
            run = json.load(f)["id"].replace("-", "")
        d = os.path.join(self.path, f"run={run}", f"epoch={epoch_id}")
        os.makedirs(d, exist_ok=True)
        self._expires = int(time.time() + self.ttl_s) * 1000 if self.ttl_s else None
        self._f = open(os.path.join(d, f"part-{partition_id:05d}.jsonl"), "w",
                       encoding="utf-8")
        return True

    def process(self, row) -> None:
        self._f.write(json.dumps(row.asDict() | {"expires": self._expires}, default=str) + "\n")

    def close(self, error) -> None:
        if self._f is not None:
            self._f.close()
            self._f = None


def archive_sink(incidents: DataFrame, path: str, checkpoint: str,
                 partition_by: str = "day", files_per_partition: int | None = None,
                 rows_per_file: int = ROWS_PER_FILE):
    """Append-mode parquet archive of incidents. Partitioned by the UTC day
    of `lastEvent` (bounded directory count) or, as an option, by ip.

    Rows are hash-partitioned on the partition column plus a salt (a hash of
    the row) before the write, so a day holding every incident of a batch is
    written by as many tasks as there are state partitions, each with files
    of at most `rows_per_file` rows. `files_per_partition` takes fewer salt
    values, for fewer files where batches are known to be small.
    """
    tasks = files_per_partition or int(
        incidents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df = incidents
    if partition_by == "day":
        df = df.withColumn("day", utc_day(F.col("lastEvent")))   # UTC, as the ban log
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in incidents.columns]),
                  F.lit(tasks))
    df = df.repartition(F.col(partition_by), salt)
    return (df.writeStream.outputMode("append").format("parquet")
            .option("path", path).option("checkpointLocation", checkpoint)
            .option("maxRecordsPerFile", str(rows_per_file)).partitionBy(partition_by))


def console_sink(df: DataFrame, num_rows: int = 50, truncate: bool = False,
                 output_mode: str = "update"):
    return (df.writeStream.outputMode(output_mode).format("console")
            .option("numRows", str(num_rows)).option("truncate", str(truncate).lower()))

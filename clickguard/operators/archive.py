"""The incident archive clustered by ip and time at once.

A day layout finds a day without opening others, and an ip only by opening all
files. Here rows are placed on a Z-order curve: the bits of a hash of ip and of
the time's place between the first and last are interleaved, rows range
partitioned by that number and sorted by it, so a file holds a small rectangle of
(ip hash, time). `files` lists each file's rectangle; a lookup by ip, by time or
by both opens the files whose rectangle it meets.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickguard.schema import INCIDENT

BITS = 16
_FILES = "file string, low_hash int, high_hash int, first timestamp, last timestamp, rows bigint"


def ip_hash(ip: Column) -> Column:
    """A number of BITS bits."""
    return F.pmod(F.xxhash64(ip), F.lit(1 << BITS)).cast("int")


def _spread(x: Column) -> Column:
    """The bits of a 16-bit number at the even places of a 32-bit one."""
    x = x.cast("long")
    # fixed values: the masks of a bit spread by halves
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
    return x


def z_order(a: Column, b: Column) -> Column:
    """The place of (a, b), numbers of BITS bits, on the Z-order curve."""
    return F.shiftleft(_spread(a), 1).bitwiseOR(_spread(b))


def write_clustered(incidents: DataFrame, path: str, files: int) -> None:
    """Writes incidents `(ip, lastEvent, reason)` in about `files` files below
    `path`/rows, and their rectangles to `path`/files. Rows without a time are
    placed at the first. Many rows of one ip are cut by time, many of one time
    by ip, and many of both by a hash of the row."""
    path = path.rstrip("/")
    us = F.unix_micros("lastEvent")
    low, high = incidents.agg(F.min(us), F.max(us)).first()
    low, span = low or 0, max(1, (high or 0) - (low or 0))
    place = F.coalesce(F.floor((us - F.lit(low)) / F.lit(span) * F.lit((1 << BITS) - 1)), F.lit(0))
    rows = (incidents.select(*INCIDENT.names, ip_hash(F.col("ip")).alias("ip_hash"))
            .withColumn("z", z_order(F.col("ip_hash"), place)))
    (rows.repartitionByRange(files, "z", F.xxhash64(*INCIDENT.names)).sortWithinPartitions("z").drop("z")
     .write.parquet(f"{path}/rows"))
    stored = spark_rows(incidents.sparkSession, path)
    (stored.groupBy(F.col("_metadata.file_path").alias("file"))
     .agg(F.min("ip_hash").alias("low_hash"), F.max("ip_hash").alias("high_hash"),
          F.min("lastEvent").alias("first"), F.max("lastEvent").alias("last"), F.count("*").alias("rows"))
     .write.parquet(f"{path}/files"))


def spark_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{_ddl()}, ip_hash int").parquet(f"{path.rstrip('/')}/rows")


def _ddl() -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in INCIDENT.fields)


def files_of(spark: SparkSession, path: str, ip: str | None = None, since: dt.datetime | None = None,
             until: dt.datetime | None = None) -> list[str]:
    """The files whose rectangle meets the ip and the time from `since` up to,
    not including, `until`: what a lookup opens."""
    files = spark.read.schema(_FILES).parquet(f"{path.rstrip('/')}/files")
    if ip is not None:
        h = ip_hash(F.lit(ip))
        files = files.where((F.col("low_hash") <= h) & (F.col("high_hash") >= h))
    if since is not None:
        files = files.where(F.col("last") >= F.lit(since))
    if until is not None:
        files = files.where(F.col("first") < F.lit(until))
    return [r.file for r in files.select("file").collect()]


def archive_lookup(spark: SparkSession, path: str, ip: str | None = None, since: dt.datetime | None = None,
                   until: dt.datetime | None = None) -> DataFrame:
    """Incidents of an ip, of a time, or of both."""
    names = files_of(spark, path, ip, since, until)
    if not names:
        return spark.createDataFrame([], INCIDENT)
    rows = spark.read.schema(f"{_ddl()}, ip_hash int").parquet(*names)
    if ip is not None:
        rows = rows.where((F.col("ip_hash") == ip_hash(F.lit(ip))) & (F.col("ip") == F.lit(ip)))
    if since is not None:
        rows = rows.where(F.col("lastEvent") >= F.lit(since))
    if until is not None:
        rows = rows.where(F.col("lastEvent") < F.lit(until))
    return rows.select(*INCIDENT.names)

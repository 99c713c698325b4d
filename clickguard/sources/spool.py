"""Spool-directory ingest: JSON lines dropped as files into a folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The columns that name the file a line is from.
FILE = ("file", "modified", "size")


def spool_stream(spark: SparkSession, directory: str, pattern: str = "*.log",
                 max_files_per_trigger: int | None = None,
                 archive_dir: str | None = None) -> DataFrame:
    """Each file of `directory` matching `pattern` is read once, line by line
    (column `value`). With `archive_dir` finished files are moved there
    (Spark archives a file one batch after it was read)."""
    r = spark.readStream.option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive_dir:
        r = (r.option("cleanSource", "archive")
             .option("sourceArchiveDir", archive_dir))
    return r.text(directory)


def spool_batch(spark: SparkSession, directory: str,
                pattern: str = "*.log") -> DataFrame:
    return spark.read.option("pathGlobFilter", pattern).text(directory)


def with_file(lines: DataFrame) -> DataFrame:
    """`lines` of a spool folder with the file each is from: its path, when it
    was last changed and its bytes (columns `FILE`, from the hidden `_metadata`
    of the file source, so only where lines come straight from files)."""
    return lines.select("*", F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_modification_time").alias("modified"),
                        F.col("_metadata.file_size").alias("size"))


def file_report(lines: DataFrame, rejected: Column) -> DataFrame:
    """(file, modified, size, lines, rejects, status) per file of `with_file`:
    how many lines it has, how many of them are `rejected`, and whether it is
    finished or, with any reject, an error. Files without lines are not seen.
    One aggregate with map-side combine, so a large file is one row a task."""
    n = F.count_if(F.coalesce(rejected, F.lit(False)))
    return lines.groupBy(*FILE).agg(
        F.count("*").alias("lines"), n.alias("rejects"),
        F.when(n > 0, "error").otherwise("finished").alias("status"))


def keyed_stream(spark: SparkSession, path: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """The keyed records that the spool job writes to `path`, as the topic
    would hold them: (key, value, timestamp). The folder must exist."""
    r = spark.readStream.schema("key string, value string, timestamp timestamp")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(f"{path.rstrip('/')}/run=*/batch=*")

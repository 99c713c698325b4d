"""Helpers shared by the operators: tables in the shared folder, byte-bounded
slabs of Arrow batches, free column names."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from clickguard.session import scratch_path

SLAB_BYTES = 2 << 20
#: Rows of an Arrow batch where rows are whole texts.
BATCH_ROWS = 1000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written once below the cluster's shared folder and read back with
    its own schema (so an empty table reads back too). Cuts the lineage: a
    lost executor costs the reading tasks only."""
    path = scratch_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_texts(rows: DataFrame, run, schema: str) -> DataFrame:
    """`rows.mapInArrow(run, schema)` in batches of at most `BATCH_ROWS`: the
    default of 10,000 is meant for short rows. A lower setting of the session
    stays."""
    conf, key = rows.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return rows.mapInArrow(run, schema)


def fresh(name: str, taken: Iterable[str]) -> str:
    """`name`, or `name` with underscores in front until no column of `taken`
    has it (Spark compares names without case)."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def slabs(batches: Iterator[pa.RecordBatch], text: str,
          max_bytes: int = SLAB_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of a slab hold at most `max_bytes`
    (a longer text is a slab of its own)."""
    for b in batches:
        size = pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False)
        total, start = np.cumsum(size, dtype=np.int64), 0
        while start < b.num_rows:
            before = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, before + max_bytes, "right")))
            yield b.slice(start, stop - start)
            start = stop


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ranges start..start+length-1 of every row."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)

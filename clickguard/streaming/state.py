"""The state of a stopped or running job, read from its checkpoint as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickguard.schema import AGGREGATE as AGGREGATE_TYPE

#: What Spark calls the operator that keeps a windowed aggregate's state.
AGGREGATE = "stateStoreSave"
#: And the one that keeps pane rings.
RINGS = "transformWithStateInPySparkExec"


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(operatorId, operatorName, stateStoreName, numPartitions, minBatchId,
    maxBatchId, operatorProperties) per state store of the checkpoint."""
    return spark.read.format("state-metadata").load(checkpoint)


def read_state(spark: SparkSession, checkpoint: str, operator: str, batch: int | None = None,
               **options: str) -> DataFrame:
    """The state store of the one operator of that name, after the newest
    committed batch or after `batch`; raises where there is none or several.
    Reads one file set per state partition, in as many tasks."""
    found = [r.operatorId for r in state_operators(spark, checkpoint)
             .where(F.col("operatorName") == operator).select("operatorId").distinct().collect()]
    if len(found) != 1:
        raise ValueError(f"{checkpoint} has {len(found)} operators {operator}")
    r = spark.read.format("statestore").option("operatorId", found[0])
    if batch is not None:
        r = r.option("batchId", batch)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(checkpoint)


def open_windows(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """(ip, window_start, window_end, clicks, watches, firstEvent, lastEvent) of
    the windows that a detector job still holds open."""
    state = read_state(spark, checkpoint, AGGREGATE, batch)
    # Spark names the fields by their functions, both counts alike: by place
    value = F.col("value").cast(AGGREGATE_TYPE)
    return state.select("key.ip", F.col("key.window.start").alias("window_start"),
                        F.col("key.window.end").alias("window_end"), value.alias("v")).select(
        "ip", "window_start", "window_end", "v.*")


def open_rings(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """(ip, pane, clicks, watches, firstEvent, lastEvent) of the panes that a job
    with ``emit="slide"`` holds."""
    state = read_state(spark, checkpoint, RINGS, batch, stateVarName="ring")
    v = F.col("value")
    panes = F.arrays_zip(v["panes"].alias("pane"), v["clicks"].alias("clicks"), v["watches"].alias("watches"),
                         v["firsts"].alias("first"), v["lasts"].alias("last"))
    return (state.select(F.col("key.ip").alias("ip"), F.explode(panes).alias("p"))
            .select("ip", F.timestamp_micros("p.pane").alias("pane"), "p.clicks", "p.watches",
                    F.timestamp_micros("p.first").alias("firstEvent"), F.timestamp_micros("p.last").alias("lastEvent")))

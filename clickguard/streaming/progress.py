"""A job's progress as rows: what each micro-batch read, dropped and emitted."""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

REPORT = ("query string, run string, batch bigint, at string, input bigint, late bigint, "
          "state_rows bigint, emitted bigint, measures map<string,bigint>")


def measured(df: DataFrame, name: str, **measures: Column) -> DataFrame:
    """`df` with counts that Spark takes of the rows that pass (`observe`), as
    `name`.`measure` in the batch's progress; `rows` always is among them."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *[c.cast("long").alias(n) for n, c in measures.items()])


class BatchReport(StreamingQueryListener):
    """Listener that keeps a row of `REPORT` per micro-batch that did something.

    late: rows that the state operators dropped as behind the watermark (for a
    windowed aggregate an ip's rows of one window are one by then). emitted:
    rows of the measure named `out`, where there is one, else what the sink
    reports. Rows are written by `flush`, which a job's driver calls after each
    trigger or at its end; progress is a few rows a batch, whatever its size.
    """

    def __init__(self, spark: SparkSession, path: str, out: str | None = None):
        self.spark, self.path, self.out = spark, path, out
        self.rows: list[tuple] = []
        self.lock, self.ended = threading.Lock(), threading.Condition()
        self.done: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        measures = {f"{name}.{k}": v for name, row in p.observedMetrics.items()
                    for k, v in row.asDict().items() if isinstance(v, int)}
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        emitted = measures.get(f"{self.out}.rows", 0) if self.out else p.sink.numOutputRows
        with self.lock:
            self.rows.append((str(p.id), str(p.runId), p.batchId, p.timestamp, p.numInputRows, late,
                              sum(s.numRowsTotal for s in p.stateOperators), emitted, measures))

    def onQueryTerminated(self, event) -> None:
        with self.ended:
            self.done.add(str(event.runId))
            self.ended.notify_all()

    def wait(self, query, timeout: float = 60) -> None:
        """Until all events of an ended query have come: they are sent after it."""
        with self.ended:
            if not self.ended.wait_for(lambda: str(query.runId) in self.done, timeout):
                raise TimeoutError(f"no end event of query run {query.runId}")

    def flush(self) -> None:
        """Appends the rows that have come to the table at `path`."""
        with self.lock:
            rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, REPORT).coalesce(1).write.mode("append").parquet(self.path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REPORT).parquet(path)

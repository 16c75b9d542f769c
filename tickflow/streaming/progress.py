"""Query progress (T9): a look at the latest micro-batches, and the complete
progress log.

``recentProgress`` holds the latest entries only.  ``ProgressLog`` is a
listener that writes every entry, as the engine reports it, to a folder all
machines see; ``read_progress`` reads the log as a table.
"""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tickflow.schemas import METRICS_RECORD, PROGRESS_ENTRY


def progress_records(spark: SparkSession, queries: list[StreamingQuery]) -> DataFrame:
    """One metrics record per retained progress entry of each query: rows in
    the batch and its trigger time in seconds.  ``recentProgress`` holds at
    most spark.sql.streaming.numRecentProgressUpdates entries per query, so
    this list is bounded regardless of the data."""
    rows = []
    for q in queries:
        for p in q.recentProgress:
            dur = (p.get("durationMs") or {}).get("triggerExecution", 0) / 1000.0
            rows.append(("streaming", int(p["batchId"]), p.get("name") or str(q.id), int(p["batchId"]),
                         float(p.get("numInputRows", 0)), dur, 0, None, None, None))
    return spark.createDataFrame(rows, METRICS_RECORD)


class ProgressLog(StreamingQueryListener):
    """Writes every progress entry of the session's queries under ``path``.

    An entry is one small file named by run and batch, written by the file
    system of ``path`` without a job: a repeated entry replaces itself, a
    micro-batch waits for nothing, and what is written survives the driver.
    Use as a context manager around the queries, or ``start``/``stop``.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._ended: set[str] = set()
        self._error: Exception | None = None
        self._changed = threading.Condition()
        hadoop = spark.sparkContext._jvm.org.apache.hadoop
        self._file = hadoop.fs.Path
        self._fs = hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        try:
            out = self._fs.create(self._file(f"{self.path}/{p.runId}-{p.batchId}.json"), True)
            try:
                out.write(bytearray(p.json.replace("\n", " ").encode()))
            finally:
                out.close()
        except Exception as e:  # raised by wait(), in the caller's thread
            self._error = e

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def start(self) -> ProgressLog:
        self._fs.mkdirs(self._file(self.path))
        self.spark.streams.addListener(self)
        return self

    def wait(self, queries: list[StreamingQuery], timeout_s: float = 60) -> None:
        """Until the entries of these ended queries have all been written: the
        engine reports a query's end after its last progress."""
        runs = {str(q.runId) for q in queries}
        deadline = time.monotonic() + timeout_s
        with self._changed:
            while not runs <= self._ended:
                left = deadline - time.monotonic()
                if left <= 0:
                    raise TimeoutError(f"no end reported for {sorted(runs - self._ended)}")
                self._changed.wait(left)
        if self._error is not None:
            raise self._error

    def stop(self) -> None:
        self.spark.streams.removeListener(self)

    def __enter__(self) -> ProgressLog:
        return self.start()

    def __exit__(self, *_) -> None:
        self.stop()


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The progress log: one row per micro-batch with its query's name, run,
    batch, input rows, trigger time (ms), watermark, and over all stateful operators
    the rows in state, updated, and dropped for being late."""
    p = spark.read.schema(PROGRESS_ENTRY).json(path)

    def over_state(field):
        return F.coalesce(F.aggregate(f"stateOperators.{field}", F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0))
    return p.select(F.col("name").alias("query"), "runId", F.col("batchId").alias("batch_id"),
                    F.col("timestamp").alias("triggered"), F.col("numInputRows").alias("input_rows"),
                    F.col("durationMs.triggerExecution").alias("trigger_ms"), F.col("eventTime.watermark").alias("watermark"),
                    over_state("numRowsTotal").alias("state_rows"), over_state("numRowsUpdated").alias("state_updated"),
                    over_state("numRowsDroppedByWatermark").alias("late_rows"))

"""Every progress report of a stream as rows of a table."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidewater.session import scratch_path

PROGRESS = (
    "run_id string, batch_id bigint, at string, input_rows bigint, input_rate double, processed_rate double, batch_ms bigint,"
    " watermark string, state_rows bigint, state_bytes bigint, late_rows bigint, sources string"
)
HELD = 200  # reports that the driver holds before it writes them


class ProgressTable(StreamingQueryListener):
    """Writes each report of the session's streams below `path`, `HELD` at a time and at the end of a stream.

    Spark itself remembers the last hundred only.  Reports of one batch without data
    (which moves the watermark) are rows too.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or scratch_path(spark, "progress-table")
        self._rows: list[tuple] = []
        self._ended: set[str] = set()
        self._changed = threading.Condition()

    def _write(self) -> None:
        rows, self._rows = self._rows, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        state = p.get("stateOperators") or []
        rate = lambda name: p.get(name) if isinstance(p.get(name), (int, float)) else None
        self._rows.append((
            p["runId"], p["batchId"], p["timestamp"], p["numInputRows"], rate("inputRowsPerSecond"), rate("processedRowsPerSecond"), p.get("batchDuration"),
            (p.get("eventTime") or {}).get("watermark"), sum(s["numRowsTotal"] for s in state), sum(s.get("memoryUsedBytes", 0) for s in state),
            sum(s.get("numRowsDroppedByWatermark", 0) for s in state), json.dumps([s["description"] for s in p.get("sources", [])]),
        ))
        if len(self._rows) >= HELD:
            self._write()

    def onQueryTerminated(self, event) -> None:
        self._write()
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def of(self, query: StreamingQuery, seconds: float = 60) -> DataFrame:
        """All reports of a stream that has ended; waits until the last one has arrived."""
        with self._changed:
            if not self._changed.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError("the stream has not ended")
        return self.spark.read.schema(PROGRESS).parquet(self.path).where(F.col("run_id") == str(query.runId))


def summary(reports: DataFrame) -> DataFrame:
    """Batches with rows, input rows, late rows, the newest watermark, the rows left in state, and the rate over all batches."""
    newest = F.max_by("state_rows", "batch_id")
    seconds = F.sum("batch_ms") / 1000
    return reports.agg(
        F.count_if(F.col("input_rows") > 0).alias("batches"), F.coalesce(F.sum("input_rows"), F.lit(0)).alias("input_rows"),
        F.coalesce(F.sum("late_rows"), F.lit(0)).alias("late_rows"), F.max("watermark").alias("watermark"),
        F.coalesce(newest, F.lit(0)).alias("state_rows"), F.try_divide(F.sum("input_rows"), seconds).alias("rows_a_second"))

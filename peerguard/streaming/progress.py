"""The progress of streaming queries as a table, kept by a listener."""

from __future__ import annotations

import json
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = ("run string, query string, batch_id long, at string, rows long, rejects long, seconds double, input_rows_per_second double")


class ProgressTable(StreamingQueryListener):
    """Writes a row for each micro-batch of every query of the session, under
    ``run=<run id>/batch=<id>``: a run's batch has one place, so that a repeated
    report rewrites it. ``errors`` of the observed ``audit_counts`` are the
    rejects. Register with ``spark.streams.addListener``; runs that ended earlier
    stay in the table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._seen: dict[str, set[int]] = {}
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.batchId < 0:
            return
        counts = p.observedMetrics.get("audit_counts")
        row = {"run": str(p.runId), "query": p.name or str(p.id), "batch_id": p.batchId, "at": p.timestamp, "rows": p.numInputRows,
               "rejects": int(counts["errors"] or 0) if counts is not None else None, "seconds": p.batchDuration / 1000,
               "input_rows_per_second": p.inputRowsPerSecond}
        if p.numInputRows or counts is not None:
            self._write(row)
        with self._change:
            self._seen.setdefault(str(p.runId), set()).add(p.batchId)
            self._change.notify_all()

    def _write(self, row: dict) -> None:
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{row['run']}-{row['batch_id']}.json")
        out = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
        try:
            out.write(bytearray(json.dumps(row).encode()))
        finally:
            out.close()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def wait(self, query, seconds: float = 60) -> None:
        """Until the reports of an ended query have arrived (they come later than
        the end)."""
        want = {p.batchId for p in query.recentProgress}
        until = time.monotonic() + seconds
        with self._change:
            while not want <= self._seen.get(str(query.runId), set()):
                if not self._change.wait(max(0.0, until - time.monotonic())):
                    raise TimeoutError("progress reports are missing")

    def read(self) -> DataFrame:
        from ..session import path_exists
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).json(self.path)

"""Figures of streams as tables: what each batch read, how long it took and what its state holds, and what pages cost."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

FIGURES = "query string, run string, batch long, at string, rows long, trigger_ms long, sink_ms long, state_rows long, state_bytes long, late_rows long"


class BatchFigures(StreamingQueryListener):
    """One row a batch of every query of a session, kept until `table` takes them; `failed` has the errors of runs.

    Rows count as often as a sink reads its batch.
    """

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.ended: set[str] = set()
        self.failed: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        told = json.loads(event.progress.json)
        states = told.get("stateOperators") or []
        sums = [sum(int(s.get(name) or 0) for s in states) for name in ("numRowsTotal", "memoryUsedBytes", "numRowsDroppedByWatermark")]
        spent = told.get("durationMs") or {}
        rows = sum(int(s.get("numInputRows") or 0) for s in told.get("sources") or [])
        self.rows.append((told["id"], told["runId"], int(told["batchId"]), told["timestamp"], rows, spent.get("triggerExecution"), spent.get("addBatch"), *sums))

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))
        if event.exception:
            self.failed[str(event.runId)] = event.exception

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, FIGURES)

    def wait(self, query: StreamingQuery, seconds: float = 30) -> None:
        """Until the session has told of the end of `query`, as it tells its listeners later."""
        until = time.time() + seconds
        while str(query.runId) not in self.ended and time.time() < until:
            time.sleep(0.05)


def with_figures(spark: SparkSession) -> BatchFigures:
    """A listener on all queries of the session; write its `table` where the figures shall stay."""
    found = BatchFigures()
    spark.streams.addListener(found)
    return found

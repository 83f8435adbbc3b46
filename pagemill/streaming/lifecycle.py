"""The task lifecycle as a stateful processor: a row of state for each task, and timers for what no event ends.

An event table (key, ts, event) is folded by `step` as it streams. A task that runs for longer than `lease` without
an event has broken off and counts a failure (W6); a done one is forgotten after `keep`. Both are event-time timers: they fire
when the watermark passes them, whether or not the task gets another event. The state can be read as a table from
the checkpoint, whole or by key, without starting the stream.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .buckets import NULL_BUCKET, Alarms, bucket_of
from .schedule import step

TASK = "status string, failures long"
OUT = "key long, status string, failures long, cause string"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class TaskLifecycle(StatefulProcessor):
    """W2 to W7. `lease_ms` and `keep_ms`: how long a task may run and a done one is remembered; None for ever.

    Spark's key is a bucket of tasks; each task has its own row of state.
    """

    def __init__(self, lease_ms: int | None = None, keep_ms: int | None = None, max_failures: int = 2):
        self.wait = {"running": lease_ms, "done": keep_ms}
        self.max_failures = max_failures

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.tasks = handle.getMapState("task", "key long", TASK)
        self.alarms = Alarms(handle, "long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        events = pd.concat(list(rows)).sort_values(["key", "ts", "seq"])
        at = events["ts"].astype("datetime64[ms]").astype("int64")
        due, out = self.alarms.load(), []
        for task, group in groupby(zip(events["key"].tolist(), at.tolist(), events["event"].tolist(), strict=True), itemgetter(0)):
            status, failures = self.tasks.getValue((task,)) or ("pending", 0)
            for _, last, event in group:
                status, failures = step(status, failures, event, self.max_failures)
            self.tasks.updateValue((task,), (status, failures))
            due.pop(task, None)
            if self.wait.get(status) is not None:
                due[task] = last + self.wait[status]
            out.append((task, status, failures, "event"))
        self.alarms.save(due)
        yield _told(key[0], out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due, out = self.alarms.load(), []
        for task in self.alarms.due(due, timerValues.getCurrentWatermarkInMs()):
            status, failures = self.tasks.getValue((task,))
            if status == "done":
                self.tasks.removeKey((task,))
                out.append((task, "forgotten", 0, "kept"))
            else:
                status, failures = step(status, failures, "fail", self.max_failures)
                self.tasks.updateValue((task,), (status, failures))
                out.append((task, status, failures, "broke off"))
        self.alarms.save(due)
        yield _told(key[0], out)

    def close(self) -> None:
        pass


def _told(bucket: int, rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["key", "status", "failures", "cause"])
    return out.assign(key=None) if bucket == NULL_BUCKET else out


def task_lifecycle(events: DataFrame, delay: str, lease_ms: int | None = None, keep_ms: int | None = None, max_failures: int = 2) -> DataFrame:
    """OUT rows of the streaming `events` (key long, ts timestamp, seq long, event); events later than `delay` don't count.

    Its session needs `with_state_store`.
    """
    # Pandas would turn keys beside a null one into floats, so its bucket tells the null key.
    rows = events.withWatermark("ts", delay).select(bucket_of(F.col("key")).alias("bucket"), F.coalesce("key", F.lit(0)).alias("key"), "ts", "seq", "event").groupBy("bucket")
    return rows.transformWithStateInPandas(TaskLifecycle(lease_ms, keep_ms, max_failures), OUT, "Update", "EventTime")


def with_state_store(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session of its own whose stateful queries use the store that processors need."""
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    if partitions:
        session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return session


def task_states(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Key, status, failures of all tasks that the stream holds; filter by key for one."""
    rows = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "task").load()
    key = F.when(F.col("key.bucket") != NULL_BUCKET, F.col("user_map_key.key")).alias("key")
    return rows.select(key, "user_map_value.status", "user_map_value.failures")

"""The task table as files: buckets by key, of which a change rewrites those that it touches.

A task lives in the bucket that the hash of its (kind, url) names, a folder of the table. A change reads the buckets of its
keys, makes their new rows and writes them to a folder of their own; once that is complete they take the place of
the old buckets by dynamic partition overwrite. Files of other buckets stay as they are. A job that breaks off before the
new rows are complete has changed nothing; one that breaks off after it is finished by the next `open`. A change with a
token is made once, however often it is asked for. One writer at a time, as a stream or a driver is; readers between two
changes see whole changes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tasks as T
from .storage import children, exists, make_folder, remove, written

BUCKETS = 64
#: How the folders of changes without a token begin.
UNNAMED = "once-"
SCHEMA = f"{T.TASKS}, bucket int"


class TaskStore:
    """K3, Q1, Q5, Q6, J12, W2 to W7 over files in `path`. The number of buckets is fixed by whoever makes the store."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.open()

    def bucket(self, kind: Column, url: Column) -> Column:
        return F.pmod(F.xxhash64(kind, url), F.lit(self.buckets)).cast("int")

    def open(self) -> None:
        """Finish changes that broke off after their rows were complete; drop those that weren't."""
        for stage in children(self.spark, f"{self.path}/changes"):
            if exists(self.spark, f"{stage}/_SUCCESS"):
                self._finish(stage)
            else:
                remove(self.spark, stage)

    def stored(self) -> DataFrame:
        """All tasks, with their bucket."""
        if not exists(self.spark, f"{self.path}/tasks"):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(f"{self.path}/tasks")

    def read(self) -> DataFrame:
        return self.stored().drop("bucket")

    def task(self, kind: str, url: str) -> DataFrame:
        """The row of one key, read from its bucket alone."""
        hit = (F.col("bucket") == self.bucket(F.lit(kind), F.lit(url))) & (F.col("kind") == kind) & (F.col("url") == url)
        return self.stored().where(hit).drop("bucket")

    def apply(self, keys: DataFrame, change: Callable[[DataFrame], DataFrame], token: str | None = None) -> list[int]:
        """`change` the rows of all buckets that `keys` (kind, url) touch; the touched buckets, at most BUCKETS numbers."""
        if token is not None and exists(self.spark, f"{self.path}/made/{token}"):
            return []
        touched = sorted(r[0] for r in keys.where("kind is not null and url is not null").select(self.bucket(F.col("kind"), F.col("url"))).distinct().collect())
        if touched:
            stage = f"{self.path}/changes/{token or UNNAMED + uuid.uuid4().hex}"
            rows = change(self.stored().where(F.col("bucket").isin(touched)).drop("bucket"))
            rows = rows.withColumn("bucket", self.bucket(F.col("kind"), F.col("url")))
            rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(stage)
            self._finish(stage)
        return touched

    def _finish(self, stage: str) -> None:
        """New rows that are complete take the place of the old ones. Doing so again changes nothing."""
        self._swap(stage)
        name = stage.rsplit("/", 1)[-1]
        if not name.startswith(UNNAMED):
            make_folder(self.spark, f"{self.path}/made/{name}")
        remove(self.spark, stage)

    def _swap(self, stage: str) -> None:
        new = self.spark.read.schema(SCHEMA).parquet(stage)
        new.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{self.path}/tasks")

    def add(self, found: DataFrame, order: list[str], now: str) -> list[int]:
        """J14, Q5"""
        return self.apply(found, lambda old: T.add_tasks(old, found, order, now))

    def change(self, changes: DataFrame, order: list[str], now: str) -> list[int]:
        """K3, Q6"""
        return self.apply(changes, lambda old: T.changed_tasks(old, changes, order, now))

    def heal(self, visited: DataFrame, now: str) -> list[int]:
        """Give it the URLs that are new since the last call."""
        return self.apply(visited.select(F.lit("article").alias("kind"), "url"), lambda old: T.healed(old, visited, now))

    def advance(self, events: DataFrame, now: str, order: list[str] | None = None, token: str | None = None) -> list[int]:
        """W2 to W5"""
        return self.apply(events, lambda old: T.advanced(old, events, now, order), token)

    def recover(self, now: str) -> list[int]:
        """Only buckets that hold a running task are read in full."""
        running = self.stored().where("status = 'running'").select("kind", "url")
        return self.apply(running, lambda old: T.recovered(old, now))

    def retry(self, *urls: str) -> int:
        """How many tasks of these URLs are pending again."""
        hit = written(self.stored().where(F.col("url").isin(*urls) & (F.col("status") != "done")).select("kind", "url"), "retried")
        self.apply(hit, lambda old: T.retried(old, *urls)[0])
        return hit.count()

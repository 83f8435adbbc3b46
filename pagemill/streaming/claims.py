"""First claims on a stream: which row of a URL counts, whatever the batches that the rows come in.

Of the rows (url, ts, seq, site, channel) of a URL the first by (ts, seq) claims it (T1, T3). It is given out by an event-time
timer once the watermark has passed its time, as no earlier row can come then; later rows are ignored (W1). Only rows
that come later than the delay allows could have changed a claim, and Spark drops those.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .buckets import Alarms, bucket_of

CLAIMS = "url string, ts timestamp, seq long, site string, channel string"
CLAIM = "at long, seq long, site string, channel string, told boolean"
OUT = "url string, seq long, site string, channel string"


class FirstClaim(StatefulProcessor):
    """Spark's key is a bucket of URLs; each URL has its own row of state."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.claims = handle.getMapState("claim", "url string", CLAIM)
        self.alarms = Alarms(handle, "string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best = None
        for part in rows:
            both = part if best is None else pd.concat([best, part])
            best = both.sort_values(["url", "ts", "seq"]).drop_duplicates("url")
        at = best["ts"].astype("datetime64[us]").astype("int64")
        due = self.alarms.load()
        for url, *mine in zip(*(c.tolist() for c in (best["url"], at, best["seq"].astype("int64"), best["site"], best["channel"])), strict=True):
            held = self.claims.getValue((url,))
            if held is None or not held[4] and tuple(mine[:2]) < tuple(held[:2]):
                self.claims.updateValue((url,), (*mine, False))
                due[url] = mine[0] // 1000
        self.alarms.save(due)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due, out = self.alarms.load(), []
        for url in self.alarms.due(due, timerValues.getCurrentWatermarkInMs()):
            at, seq, site, channel, _ = self.claims.getValue((url,))
            self.claims.updateValue((url,), (at, seq, site, channel, True))
            out.append((url, seq, site, channel))
        self.alarms.save(due)
        yield pd.DataFrame(out, columns=["url", "seq", "site", "channel"])

    def close(self) -> None:
        pass


def first_claims(rows: DataFrame, delay: str) -> DataFrame:
    """OUT rows, one for each URL of the streaming `rows` (CLAIMS), as soon as nothing can come before it.

    Its session needs `lifecycle.with_state_store`.
    """
    by_bucket = rows.where("url is not null").withWatermark("ts", delay).withColumn("bucket", bucket_of(F.col("url"))).groupBy("bucket")
    return by_bucket.transformWithStateInPandas(FirstClaim(), OUT, "Append", "EventTime")


def claims_so_far(spark: SparkSession, checkpoint: str) -> DataFrame:
    """url, seq, site, channel, told: the claims that the stream's state holds, given out or not."""
    rows = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "claim").load()
    return rows.select("user_map_key.url", *[f"user_map_value.{c}" for c in ("seq", "site", "channel", "told")])

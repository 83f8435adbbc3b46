"""From a folder of landed pages to articles: a file stream with several sinks and a log of its batches.

Each batch goes through the round's steps and leaves articles (K1), rejected pages, visited URLs (K2, as lines and as the history that later
batches look up), task states and, last of
all, a line in the log. What a batch has read is kept in a folder of its own until then; its sinks are folders of the batch, which a
repetition overwrites, and its task events are applied once. A batch that breaks off anywhere is repeated by the
stream from its checkpoint under the same number. One in the log is not done again; one that has read its pages goes on
from there; otherwise the tasks that it left running count a failure (W6), and it reads again those that aren't deferred.
So no article is lost or there twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import articles as A
from ..operators import pages as P
from ..operators import rounds as R
from ..operators import tasks as T
from ..operators.history import VisitedHistory
from ..operators.storage import exists, remove, written
from ..operators.task_store import BUCKETS, TaskStore

LANDED = "url string, html string, site string, channel string"
LOG = "batch long, outcome string, reason string, rows long, urls long, peak_mb int, at string"


def history_of(spark: SparkSession, home: str) -> VisitedHistory:
    """The URLs that batches have written, by site and behind filters."""
    return VisitedHistory(spark, f"{home}/history")


def write_batch(found: DataFrame, nameless: DataFrame, home: str, batch_id: int) -> None:
    """K1, K2: the batch's articles, rejects and then the URLs of the articles that were written."""
    articles = found.where("reject_reason is null").select("article.*")
    P.write_articles(articles, f"{home}/articles/batch={batch_id}", "overwrite")
    rejected = found.where("reject_reason is not null").select("page.url", "page.site", "page.channel", "reject_reason")
    rejected = rejected.unionByName(nameless.select("url", "site", "channel", "reject_reason"))
    rejected.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{home}/rejected/batch={batch_id}")
    write_visited(found.sparkSession, home, batch_id)


def write_visited(spark: SparkSession, home: str, batch_id: int) -> None:
    done = spark.read.schema("url string").json(f"{home}/articles/batch={batch_id}").select("url")
    done.write.mode("overwrite").text(f"{home}/visited/batch={batch_id}")
    history_of(spark, home).add(done, batch_id)


def write_log(outcomes: DataFrame, home: str, batch_id: int, now: str) -> None:
    """What became of the batch's rows, by outcome and reason, and the most memory that a worker held for one; its
    folder marks the batch as complete."""
    rows = outcomes.groupBy("outcome", "reason").agg(F.sum("rows").alias("rows"), F.count_distinct("url").alias("urls"), F.max("peak_mb").alias("peak_mb"))
    rows.coalesce(1).withColumn("at", F.lit(now)).write.mode("overwrite").json(f"{home}/log/batch={batch_id}")


def read_batch(batch: DataFrame, batch_id: int, store: TaskStore, home: str, sites: DataFrame, as_of: Column, now: str, **budget: int) -> None:
    """The first half of a batch: its claims, what the tasks say to them, and the pages that are read, all kept."""
    spark, at = batch.sparkSession, f"{home}/batches/batch={batch_id}"
    store.recover(now)
    claims = written(R.claimed(R.named(batch)[0]), "landing-claims")
    visited = history_of(spark, home).seen(claims, batch_id)
    R.sorted_out(claims.drop("html"), store.read(), visited).write.mode("overwrite").parquet(f"{at}/state")
    state = spark.read.parquet(f"{at}/state")
    ready = state.where("why is null").select(F.lit("article").alias("kind"), "url", "site", "channel")
    begin = ready.select("kind", "url", F.lit("begin").alias("event"), F.lit("").alias("error"))
    seen = state.where("why = 'visited'").select("url")
    keys = state.where("why is null or why = 'visited'").select(F.lit("article").alias("kind"), "url")
    store.apply(keys, lambda old: T.advanced(T.add_tasks(T.healed(old, seen, now), ready, [], now), begin, now))
    A.judged(R.ready_pages(claims, state), sites, as_of, **budget).write.mode("overwrite").parquet(f"{at}/found")


def land(batch: DataFrame, batch_id: int, home: str, sites: DataFrame, as_of: Column, now: str, buckets: int = BUCKETS, **budget: int) -> None:
    """One batch, for `foreachBatch`."""
    spark, at = batch.sparkSession, f"{home}/batches/batch={batch_id}"
    if exists(spark, f"{home}/log/batch={batch_id}/_SUCCESS"):
        return
    store = TaskStore(spark, f"{home}/tasks", buckets)
    if not exists(spark, f"{at}/found/_SUCCESS"):
        read_batch(batch, batch_id, store, home, sites, as_of, now, **budget)
    found, state, nameless = spark.read.parquet(f"{at}/found"), spark.read.parquet(f"{at}/state"), R.named(batch)[1]
    write_batch(found, nameless, home, batch_id)
    store.advance(R.events_of(found), now, token=f"batch-{batch_id}")
    write_log(R.outcomes_of(state, found, nameless), home, batch_id, now)
    remove(spark, at)


def landing_stream(spark: SparkSession, landed: str, home: str, sites: DataFrame, as_of: Column, now: str, files_per_batch: int = 1_000, buckets: int = BUCKETS, **budget: int) -> StreamingQuery:
    """Start the stream over the Parquet files of `landed` (LANDED); it ends when it has read what there is, and goes on
    from there when it is started again with the same `home`."""
    pages = spark.readStream.schema(LANDED).option("maxFilesPerTrigger", files_per_batch).parquet(landed)

    def each(batch: DataFrame, batch_id: int) -> None:
        land(batch, batch_id, home, sites, as_of, now, buckets, **budget)

    return pages.writeStream.foreachBatch(each).option("checkpointLocation", f"{home}/checkpoint").trigger(availableNow=True).start()


def written_counts(spark: SparkSession, home: str) -> DataFrame:
    """A5: articles by the category, site and channel of the folders that hold them, with subtotals; `level` is the number of
    columns that a row sums over and n_files that of the files. Only files are counted, no articles are read but their lines."""
    rows = spark.read.schema("url string, batch long, p_category string, p_site string, p_channel string").json(f"{home}/articles")
    rows = rows.select("p_category", "p_site", "p_channel", F.col("_metadata.file_path").alias("file"))
    counted = rows.rollup("p_category", "p_site", "p_channel").agg(F.count(F.lit(1)).alias("n_articles"), F.count_distinct("file").alias("n_files"), F.grouping_id().alias("gid"))
    return counted.select(F.col("p_category").alias("category"), F.col("p_site").alias("site"), F.col("p_channel").alias("channel"), F.bit_count("gid").alias("level"), "n_articles", "n_files")


def log_of(spark: SparkSession, home: str) -> DataFrame:
    return spark.read.schema(LOG).json(f"{home}/log")

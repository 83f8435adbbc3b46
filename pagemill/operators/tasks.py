"""The task table: one row for each (kind, url), merged, healed, listed and queued with DataFrames.

`TASKS` is its schema. A plain Parquet table has no MERGE: each function takes the old table and gives the new one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import placed

KEY = ("kind", "url")
TASKS = "kind string, url string, site string, channel string, status string, phase string, failures int, error string, path string, downloaded int, encoding string, updated string"
#: Columns that a change may set.
SETTABLE = ("status", "phase", "error", "path", "downloaded", "encoding")
MAX_FAILURES = 2
BROKEN_OFF = "previous process interrupted; not proof this URL caused OOM"
DONE = {"status": "done", "phase": "done", "error": "", "path": "", "downloaded": 0, "failures": 0}


def _set(tasks: DataFrame, hit: Column, values: dict[str, object]) -> DataFrame:
    hit = F.coalesce(hit, F.lit(False))
    have = {c: F.when(hit, F.lit(v).cast(tasks.schema[c].dataType)).otherwise(F.col(c)) for c, v in values.items() if c in tasks.columns}
    return tasks.withColumns(have)


def add_tasks(tasks: DataFrame, found: DataFrame, order: list[str], now: str) -> DataFrame:
    """`tasks` and the keys of `found` (kind, url, site, channel, order columns) that it lacks.

    A key that several rows of `found` claim is the first one's by `order`; an old row keeps its site and channel.
    Rows without a kind or a URL are no tasks.
    """
    claim = found.where("kind is not null and url is not null").groupBy(*KEY).agg(F.min(F.struct(*order, "site", "channel")).alias("m"))
    new = claim.join(tasks.select(*KEY), list(KEY), "left_anti").select(*KEY, "m.site", "m.channel")
    fresh = {"status": "pending", "phase": "queued", "failures": 0, "error": "", "path": "", "downloaded": 0, "encoding": "", "updated": now}
    return tasks.unionByName(new.withColumns({c: F.lit(v) for c, v in fresh.items()}))


def changed_tasks(tasks: DataFrame, changes: DataFrame, order: list[str], now: str) -> DataFrame:
    """K3, Q6: `changes` (kind, url, order columns, some of SETTABLE) applied; null leaves a column as it is.

    Of several changes of a key the last that sets a column counts. Changes of unknown keys have no effect; a change
    table with another column raises ValueError.
    """
    names = [c for c in changes.columns if c not in (*KEY, *order)]
    if odd := sorted(set(names) - set(SETTABLE)):
        raise ValueError(f"not settable: {', '.join(odd)}")
    last = changes.groupBy(*KEY).agg(*[F.max(F.when(F.col(c).isNotNull(), F.struct(*order, F.col(c).alias("v"))))["v"].alias(f"__{c}") for c in names], F.lit(True).alias("__hit"))
    out = tasks.join(last, list(KEY), "left")
    values = {c: F.coalesce(f"__{c}", c).cast(tasks.schema[c].dataType) for c in names}
    out = out.withColumns(values | {"updated": F.when(F.col("__hit"), F.lit(now)).otherwise(F.col("updated"))} if "updated" in tasks.columns else values)
    return out.select(*tasks.columns)


def healed(tasks: DataFrame, visited: DataFrame, now: str | None = None) -> DataFrame:
    """Article tasks whose URL is in `visited` (url) and that aren't done become done."""
    seen = visited.select("url").distinct().withColumn("__seen", F.lit(True))
    hit = F.col("__seen") & (F.col("kind") == "article") & ~F.col("status").eqNullSafe("done")
    out = tasks.join(seen, "url", "left").withColumn("__hit", hit)
    return _set(out, F.col("__hit"), DONE if now is None else DONE | {"updated": now}).select(*tasks.columns)


def task(tasks: DataFrame, kind: str, url: str) -> DataFrame:
    """The row of one key, or none."""
    return tasks.where((F.col("kind") == kind) & (F.col("url") == url))


def pending(tasks: DataFrame) -> DataFrame:
    """The pending articles of every (site, channel) with their place there, by `updated`, ties by URL."""
    return placed(tasks.where("kind = 'article' and status = 'pending'").select("site", "channel", "url", "updated"), ["site", "channel"], ["updated", "url"])


def work_list(waiting: DataFrame, discovered: DataFrame) -> DataFrame:
    """Site, channel, url and place of what a run reads.

    `waiting` is the result of `pending`; `discovered` has site, channel, url and place. Waiting articles come before
    new links and don't depend on the channel's page: a channel without new links still has its waiting ones. A URL
    that is in both, or twice on a page, keeps its first place.
    """
    rows = waiting.select("site", "channel", "url", F.lit(0).alias("turn"), "place").unionByName(discovered.select("site", "channel", "url", F.lit(1).alias("turn"), "place"))
    first = rows.groupBy("site", "channel", "url").agg(F.min(F.struct("turn", "place")).alias("m"))
    return placed(first.select("site", "channel", "url", (F.col("m.turn") == 0).alias("waiting"), "m"), ["site", "channel"], ["m", "url"]).drop("m")


def status_counts(tasks: DataFrame) -> DataFrame:
    """A4, Q3, Q9"""
    return tasks.groupBy("status").agg(F.count(F.lit(1)).alias("n_tasks"))


def open_tasks(tasks: DataFrame) -> DataFrame:
    """Q10: what isn't done, oldest change first; ties by kind and URL."""
    return tasks.where("status <> 'done'").select("kind", "url", "status", "phase", "failures", "error", "path", "updated").orderBy("updated", *KEY)


def advanced(tasks: DataFrame, events: DataFrame, now: str, order: list[str] | None = None, max_failures: int = MAX_FAILURES) -> DataFrame:
    """`tasks` after one event each of `events` (kind, url, event, error and order columns).

    begin: a task that is neither running nor deferred runs, its phase is `start`. fail: a failure more, deferred from
    `max_failures` on, else pending. over_limit: a failure more and deferred at once, its phase is `memory_limit`. done:
    done without failures. Of several events of a key the last by `order` counts; unknown keys and events do nothing.
    """
    fields = F.struct(*(order or []), "event", "error")
    last = events.groupBy(*KEY).agg(F.max(fields).alias("__e"))
    rows = tasks.join(last.select(*KEY, F.col("__e.event").alias("__event"), F.col("__e.error").alias("__error")), list(KEY), "left")
    is_ = lambda event: F.coalesce(F.col("__event") == event, F.lit(False))
    begins = is_("begin") & ~F.coalesce(F.col("status").isin("running", "deferred"), F.lit(False))
    fails, over, done = is_("fail"), is_("over_limit"), is_("done")
    more = F.coalesce("failures", F.lit(0)) + 1
    new = {
        "status": F.when(begins, "running").when(over | fails & (more >= max_failures), "deferred").when(fails, "pending").when(done, "done").otherwise(F.col("status")),
        "phase": F.when(begins, "start").when(over, "memory_limit").when(done, "done").otherwise(F.col("phase")),
        "failures": F.when(fails | over, more).when(done, 0).otherwise(F.col("failures")).cast("int"),
        "error": F.when(fails | over, F.coalesce("__error", F.lit(""))).when(done, "").otherwise(F.col("error")),
        "path": F.when(done, "").otherwise(F.col("path")),
        "downloaded": F.when(done, 0).otherwise(F.col("downloaded")).cast("int"),
        "updated": F.when(begins | fails | over | done, F.lit(now)).otherwise(F.col("updated")),
    }
    return rows.select(*[new[c].alias(c) if c in new else F.col(c) for c in tasks.columns])


def startable(tasks: DataFrame) -> DataFrame:
    """The tasks that may begin."""
    return tasks.where(~F.coalesce(F.col("status").isin("running", "deferred"), F.lit(False)))


def recovered(tasks: DataFrame, now: str, max_failures: int = MAX_FAILURES) -> DataFrame:
    """Tasks that a broken-off run left running count a failure and say so."""
    running = F.coalesce(F.col("status") == "running", F.lit(False))
    more = F.coalesce("failures", F.lit(0)) + 1
    new = {"status": F.when(more >= max_failures, "deferred").otherwise("pending"), "failures": more.cast("int"), "error": F.lit(BROKEN_OFF), "updated": F.lit(now)}
    return tasks.select(*[F.when(running, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in tasks.columns])


def retried(tasks: DataFrame, *urls: str, which: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(tasks, one row `retried`): tasks of these URLs, of any kind, or those for which `which` holds, that aren't done
    are pending again, without failures and error. Downloads stay."""
    chosen = F.col("url").isin(*urls) if which is None else which
    hit = F.coalesce(chosen & (F.col("status") != "done"), F.lit(False))
    return _set(tasks, hit, {"status": "pending", "failures": 0, "error": ""}), tasks.agg(F.count_if(hit).alias("retried"))

"""A round over landed pages: claims, visited URLs, tasks, extraction on demand and what becomes of each page.

A round reads each page at most once. What it read is written once, and articles, rejects and task events come from there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from . import articles as A
from . import pages as P
from . import tasks as T
from .storage import placed, written

#: The order in which rows claim a URL and pages of a site are read, where `landed` has these columns.
ORDER = ("site_ord", "ch_ord", "place", "site", "channel")


@dataclass(frozen=True)
class Round:
    """What a round leaves: articles, rejected pages, the task table, the URLs of its articles, and an account of all rows."""

    articles: DataFrame
    rejected: DataFrame
    tasks: DataFrame
    visited: DataFrame
    outcomes: DataFrame


def named(landed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a URL, rows without one with reject_reason); only the first can claim anything."""
    blank = C.blank_to_null(F.col("url")).isNull()
    reason = F.when(F.col("url").isNull(), "missing field").otherwise("blank url")
    return landed.where(~blank), landed.where(blank).drop("html").withColumn("reject_reason", reason)


def claimed(landed: DataFrame, order: tuple[str, ...] = ORDER) -> DataFrame:
    """One row for each URL, the first by `order`, with `claims`, the number of rows that wanted it."""
    order = [c for c in order if c in landed.columns]
    rest = [c for c in landed.columns if c not in ("url", *order)]
    first = F.min(F.struct(*order, F.struct(*rest).alias("rest"))).alias("m")
    return landed.groupBy("url").agg(first, F.count(F.lit(1)).alias("claims")).select("url", *[F.col(f"m.{c}").alias(c) for c in order], "m.rest.*", "claims").select(*landed.columns, "claims")


def sorted_out(claims: DataFrame, tasks: DataFrame, visited: DataFrame) -> DataFrame:
    """`claims` (without html) with `why` a page isn't read (visited, running, deferred, done), null for those that
    may be, and `waits` for those that a round before left over.

    Of the task table and the visited history only rows of claimed URLs go on from their scan, as long as the claims' URLs
    are few enough for Spark to send around; the join with what is left is exact either way.
    """
    urls = claims.select("url")
    known = tasks.where("kind = 'article'").select("url", F.col("status").alias("__status")).join(urls, "url", "left_semi")
    seen = visited.select("url").join(urls, "url", "left_semi").distinct().withColumn("__seen", F.lit(True))
    rows = claims.join(known, "url", "left").join(seen, "url", "left")
    why = F.when(F.col("__seen"), "visited").when(F.col("__status").isin("running", "deferred", "done"), F.col("__status"))
    return rows.withColumns({"why": why, "waits": F.col("__status").isNotNull()}).drop("__status", "__seen")


def extracted(ready: DataFrame, sites: DataFrame, as_of: Column, per_site: int | None = None, **budget: int) -> DataFrame:
    """The pages of `ready` (url, html, site, channel, waits, others) as `judged`, those that the round uses, written.

    Without `per_site` all are read. With it, L1 and W8: each site's pages come in order, waiting ones first, until
    `per_site` articles are found. Steps read of each site as many pages as articles are lacking, twice that in the second
    step, and so on; of what a step reads too much, whatever follows the last needed article isn't used. So at most
    twice as many pages are read as are used, and the number of steps grows with the logarithm of a site's pages.
    """
    read = lambda pages: A.judged(ready.join(pages.select("url", "at"), "url"), sites, as_of, **budget)
    if per_site is None:
        return written(A.judged(ready, sites, as_of, **budget), "round")
    order = [c for c in ORDER if c in ready.columns and c != "site"]
    turns = ready.select("url", "site", *order, F.when(F.col("waits"), 0).otherwise(1).alias("turn"))
    pages = written(placed(turns, ["site"], ["turn", *order, "url"], "at").select("url", "site", "at"), "round-order")
    found, factor = None, 1
    left = pages.groupBy("site").agg(F.max("at").alias("last")).withColumns({"done": F.lit(0), "lacking": F.lit(per_site)})
    while True:
        left = written(left.where("lacking > 0 and done < last"), "round-sites")
        if left.isEmpty():
            break
        upto = F.least("last", F.col("done") + F.col("lacking") * factor)
        asked = left.select(F.col("site").alias("of"), "done", upto.alias("upto"))
        some = pages.join(asked, F.col("site").eqNullSafe(F.col("of"))).where("at > done and at <= upto")
        part = written(read(some.select("url", "at")), "round-part")
        found = part if found is None else found.unionByName(part)
        got = part.groupBy(F.col("page.site").alias("of")).agg(F.count_if(F.col("reject_reason").isNull()).alias("got"))
        moved = left.withColumn("upto", upto).join(got, F.col("site").eqNullSafe(F.col("of")), "left")
        left = moved.select("site", "last", F.col("upto").alias("done"), (F.col("lacking") - F.coalesce("got", F.lit(0))).cast("int").alias("lacking"))
        factor *= 2
    if found is None:
        return written(read(pages.limit(0)), "round")
    before = Window.partitionBy("page.site").orderBy("page.at").rowsBetween(Window.unboundedPreceding, -1)  # what a site was read for
    used = found.withColumn("__got", F.coalesce(F.count_if(F.col("reject_reason").isNull()).over(before), F.lit(0)))
    return used.where(F.col("__got") < per_site).drop("__got")


def events_of(found: DataFrame) -> DataFrame:
    """The event that each read page gives its task. A page without an article is never `done`."""
    reason = F.col("reject_reason")
    event = F.when(reason.isNull(), "done").when(reason == "over limit", "over_limit").otherwise("fail")
    return found.select(F.lit("article").alias("kind"), "page.url", event.alias("event"), F.coalesce(reason, F.lit("")).alias("error"))


def ready_pages(claims: DataFrame, state: DataFrame) -> DataFrame:
    """The pages that may be read, html and all."""
    return claims.join(state.where("why is null").select("url", "waits"), "url")


def outcomes_of(state: DataFrame, found: DataFrame, nameless: DataFrame) -> DataFrame:
    """url, outcome, rows, reason, peak_mb: what became of each landed row, why it is no article, and what reading it took."""
    result = found.select("page.url", F.when(F.col("reject_reason").isNull(), "article").otherwise("rejected").alias("read"), F.col("reject_reason").alias("reason"), "page.peak_mb")
    told = state.join(result, "url", "left").select("url", F.coalesce("why", "read", F.lit("unread")).alias("outcome"), F.lit(1).cast("long").alias("rows"), "reason", "peak_mb")
    told = told.unionByName(state.where("claims > 1").select("url", F.lit("repeated").alias("outcome"), (F.col("claims") - 1).alias("rows")), allowMissingColumns=True)
    blank = nameless.groupBy("url", F.col("reject_reason").alias("reason")).agg(F.count(F.lit(1)).alias("rows"))
    return told.unionByName(blank.select("url", F.lit("rejected").alias("outcome"), "rows", "reason"), allowMissingColumns=True)


def crawl_round(landed: DataFrame, tasks: DataFrame, sites: DataFrame, as_of: Column, now: str, visited: DataFrame | None = None, per_site: int | None = None, **budget: int) -> Round:
    """One round over `landed` (url, html, site, channel, and of ORDER what there is).

    Each URL is claimed once. Visited URLs are skipped and heal their tasks; claims without a task get one;
    pages of running and deferred tasks wait, and so do those beyond `per_site`. Each page that is read ends as done,
    failed or over its limit, and no page ends the round. `outcomes` has url, outcome and rows: each landed row counts
    once in it, as article, rejected, visited, running, deferred, done, unread or repeated.
    """
    spark = landed.sparkSession
    if visited is None:
        visited = spark.createDataFrame([], "url string")
    rows, nameless = named(landed)
    claims = written(claimed(rows), "round-claims")
    state = written(sorted_out(claims.drop("html"), tasks, visited), "round-state")
    found = extracted(ready_pages(claims, state), sites, as_of, per_site, **budget)

    known = T.healed(tasks, visited, now)
    known = T.add_tasks(known, state.where("why is null").select(F.lit("article").alias("kind"), "url", "site", "channel"), [], now)
    events = events_of(found)
    begun = T.advanced(known, events.withColumn("event", F.lit("begin")), now)
    after = T.advanced(begun, events, now)

    rejected = found.where("reject_reason is not null").select(*[F.col(f"page.{c}").alias(c) for c in landed.columns if c != "html"], "reject_reason")
    articles = found.where("reject_reason is null").select("article.*")
    return Round(articles, rejected.unionByName(nameless), after, articles.select("url"), outcomes_of(state, found, nameless))

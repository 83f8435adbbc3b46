"""Pages to links and articles, articles to the canonical schema, links to a frontier, tasks through their lifecycle."""

from __future__ import annotations

import resource
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions import columns as C
from ..sources import html as H

#: Pages that Python holds as trees and objects at a time.
SLICE = 64
#: Bytes of a core's share up to which a table counts as small.
SMALL_BYTES = 32 << 20
FIELDS = ("url", "title", "content", "siteName", "source", "category", "subCategory", "channel", "publishTime", "images", "crawledAt", "docNumber", "indexNumber")
PARTS = "title string, publishTime string, source string, docNumber string, indexNumber string, content string, images array<string>, reject string"
MAX_FAILURES = 2


def spread(pages: DataFrame) -> DataFrame:
    """A small table over all cores, by Spark's own estimate of its size; a large one stays as it lies."""
    if pages.isStreaming:
        return pages
    cores = pages.sparkSession.sparkContext.defaultParallelism
    size = pages._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return pages.repartition(cores) if int(str(size)) < cores * SMALL_BYTES else pages


def _rows(pages: DataFrame, out: str, make: Callable[[dict], object], broken: Callable[[str], object], inputs: tuple[str, ...] = ("url", "html")) -> DataFrame:
    """`pages` (inputs, others) as `row`, with the `out` that `make(inputs)` gives, and A7, peak_mb: the most memory that the
    worker has held when it had read the row's slice.

    A page that can't be read gives `broken(reason)` and never ends the job: "over limit" above its budget, else
    "broken page".
    """
    packed = spread(pages).select(F.struct("*").alias("row"), *inputs)
    schema = packed.select("row", F.lit(None).cast(out).alias("out"), F.lit(0).alias("peak_mb")).schema
    kind = to_arrow_type(schema["out"].dataType)

    def guarded(page: dict) -> object:
        try:
            return make(page)
        except H.OverLimit:
            return broken("over limit")
        except MemoryError:
            return broken("over limit")
        except Exception as e:  # whatever a page holds, the others go on
            return broken(f"broken page: {type(e).__name__}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                batch = whole.slice(start, SLICE)
                values = zip(*(batch.column(c).to_pylist() for c in inputs), strict=True)
                made = [guarded(dict(zip(inputs, v, strict=True))) for v in values]
                peak = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(made, kind), pa.array([peak] * batch.num_rows, pa.int32())], names=["row", "out", "peak_mb"])

    return packed.mapInArrow(run, schema).select("row.*", "out", "peak_mb")


def with_article(pages: DataFrame, title_selectors: tuple[str, ...] = H.TITLE_SELECTORS, content_selectors: tuple[str, ...] = H.CONTENT_SELECTORS, characters: int = H.PAGE_CHARACTERS, items: int = H.PAGE_ITEMS, title_min: int = H.TITLE_MIN) -> DataFrame:
    """`pages` with the struct `out` of article parts; `out.reject` is null for articles.

    Columns `title_selectors` and `content_selectors` (arrays), where `pages` has them, hold for their row; null takes
    the arguments' selectors.
    """
    own = tuple(c for c in ("title_selectors", "content_selectors") if c in pages.columns)

    def make(page: dict) -> dict:
        titles, contents = page.get("title_selectors"), page.get("content_selectors")
        return H.article_of(page["html"] or "", page["url"] or "", title_selectors if titles is None else titles, content_selectors if contents is None else contents, characters, items, title_min)

    return _rows(pages, f"struct<{PARTS.replace(' string', ':string').replace(' array', ':array')}>", make, lambda reason: {"reject": reason}, ("url", "html", *own))


def with_anchors(pages: DataFrame) -> DataFrame:
    """`pages` with `out`, an array of (place, href, text); null for a page that can't be read."""

    def make(page: dict) -> list[dict]:
        return [{"place": p, "href": a, "text": t} for p, a, t in H.anchors_of(H.within_budget(page["html"] or ""), page["url"] or "")]

    return _rows(pages, "array<struct<place:int,href:string,text:string>>", make, lambda reason: None)


def page_events(extracted: DataFrame) -> DataFrame:
    """`extracted` (with `out`) with the task event of each page: done, over_limit or fail, and the error's text."""
    reject = F.col("out.reject")
    event = F.when(reject.isNull(), "done").when(reject == "over limit", "over_limit").otherwise("fail")
    return extracted.withColumns({"event": event, "error": F.coalesce(reject, F.lit(""))})


def links(pages: DataFrame, pattern: Column | None = None, strict_host: bool = False) -> DataFrame:
    """page_id, link and place (its first on the page) of accepted links."""
    one = with_anchors(pages.withColumn("pattern", F.lit(None).cast("string") if pattern is None else pattern)).select("page_id", "url", "pattern", F.explode("out").alias("a"))
    one = one.select("page_id", "url", "pattern", C.clean_url(F.col("a.href")).alias("link"), F.col("a.text").alias("text"), F.col("a.place").alias("place"))
    generic = C.same_site(F.col("url"), F.col("link"), strict_host) & (C.looks_like_article(F.col("link")) | C.page_suffix(F.col("link"), F.col("text")))
    own = F.coalesce(F.regexp_like("link", F.col("pattern")), F.lit(False))
    return one.where(~C.is_asset(F.col("link")) & (own | generic)).groupBy("page_id", "link").agg(F.min("place").alias("place"))


def decoded(raw: DataFrame) -> DataFrame:
    """`raw` (id, data, preferred, declared) with text and encoding; both null where nothing fits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                batch = whole.slice(start, SLICE)
                found = []
                for data, preferred, declared in zip(*(batch.column(c).to_pylist() for c in ("data", "preferred", "declared")), strict=True):
                    try:
                        text, name = H.decode_page(data or b"", preferred, declared)
                        text.encode("utf-8")  # some codecs give halves of characters, which no string column holds
                        found.append((text, name))
                    except ValueError:
                        found.append((None, None))
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([t for t, _ in found], pa.string()), pa.array([n for _, n in found], pa.string())], names=["id", "text", "encoding"])

    kind = raw.schema["id"].dataType.simpleString()
    return raw.select("id", "data", "preferred", "declared").mapInArrow(run, f"id {kind}, text string, encoding string")


def checked(records: DataFrame, *keep: str) -> DataFrame:
    """`keep` columns, the 13 fields of each record and reject_reason, null for valid ones.

    Aliases and site_* columns count where `records` has them.
    """

    def chain(*names: str) -> Column:
        have = [F.col(n) for n in names if n in records.columns]
        return C.first_filled(*have) if have else F.lit(None).cast("string")

    reason = F.when(F.col("url").isNull() | F.col("title").isNull() | F.col("content").isNull(), "missing field").when(C.blank_to_null(F.col("url")).isNull(), "blank url").when(C.blank_to_null(F.col("title")).isNull(), "blank title")
    images = F.coalesce(F.col("images"), F.array().cast("array<string>")) if "images" in records.columns else F.array().cast("array<string>")
    reason = F.coalesce(reason, F.when(F.exists(images, lambda x: x.isNull()), "null image"))
    return records.select(
        *keep, "url", "title", "content", chain("siteName", "site_name", "media_name", "cfg_name").alias("siteName"), chain("source").alias("source"),
        chain("category", "media_category", "cfg_category").alias("category"), chain("subCategory", "sub_category", "cfg_sub_category").alias("subCategory"),
        chain("channel", "cfg_channel").alias("channel"), chain("publishTime", "publish_time").alias("publishTime"), images.alias("images"),
        chain("crawledAt", "crawled_at", "crawl_time").alias("crawledAt"), chain("docNumber", "doc_number").alias("docNumber"),
        chain("indexNumber", "index_number").alias("indexNumber"), reason.alias("reject_reason"),
    )


def canonical(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) as `checked`; rejected rows have reject_reason."""
    out = checked(records)
    return out.where("reject_reason is null").select(*FIELDS), out.where("reject_reason is not null")


def first_seen(candidates: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each `key` by `order`, whatever the partitioning."""
    packed = candidates.groupBy(key).agg(F.min(F.struct(*order, F.struct(*[c for c in candidates.columns if c != key]).alias("row"))).alias("m"))
    return packed.select(key, "m.row.*")


def unseen(candidates: DataFrame, visited: DataFrame, key: str = "url") -> DataFrame:
    """J11, T4"""
    return candidates.join(visited.select(key), key, "left_anti")


def at_most(rows: DataFrame, part: str, order: list[str], n: int) -> DataFrame:
    """L1: the first `n` rows of each `part`; filter successes before."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(part).orderBy(*order))).where(F.col("place") <= n)


def fold_tasks(events: DataFrame, max_failures: int = MAX_FAILURES) -> DataFrame:
    """Key, status and failures after all `events` (key, ts, seq, event).

    Events: begin, fail, over_limit, done, retry. A deferred task ignores everything but retry; a retry of a done task
    changes nothing. As windows: retries cut a key's events into segments, `done` cuts those again, and the first row of
    a segment that defers ends it.
    """
    key = Window.partitionBy("key").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, 0)
    count = lambda name: F.sum((F.col("event") == name).cast("int"))
    rows = events.withColumn("seg", count("retry").over(key))
    in_seg = Window.partitionBy("key", "seg").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("dg", count("done").over(in_seg))
    in_dg = Window.partitionBy("key", "seg", "dg").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("fc", F.sum(F.col("event").isin("fail", "over_limit").cast("int")).over(in_dg))
    defers = (F.col("event") == "over_limit") | ((F.col("event") == "fail") & (F.col("fc") >= max_failures))
    at = F.struct("ts", "seq")
    rows = rows.withColumn("at", at).withColumn("defers", defers)
    segments = rows.groupBy("key", "seg").agg(
        F.min(F.when(F.col("defers"), F.struct("at", "fc"))).alias("deferred"),
        F.max(F.struct("at", "event", "fc")).alias("last"),
        F.max(F.when(F.col("event") == "done", F.col("at"))).alias("done_at"),
        F.count(F.lit(1)).alias("n"),
    )
    # The state at a segment's end, not counting its own retry; `stays` marks a segment that is only a retry.
    status = F.when(F.col("deferred").isNotNull(), "deferred").when(F.col("last.event") == "begin", "running").when(F.col("last.event") == "done", "done").otherwise("pending")
    segments = segments.withColumn("stays", (F.col("n") == 1) & (F.col("last.event") == "retry")).withColumn("status", status)
    segments = segments.withColumn("failures", F.coalesce("deferred.fc", F.when(F.col("stays"), 0).otherwise(F.col("last.fc"))).cast("long"))
    final = segments.groupBy("key").agg(F.max(F.struct("seg", "stays", "status", "failures")).alias("e"), F.max(F.when(~F.col("stays"), F.struct("seg", "status"))).alias("before"))
    kept_done = F.col("e.stays") & (F.col("before.status") == "done")
    return final.select("key", F.when(kept_done, "done").otherwise(F.col("e.status")).alias("status"), F.when(F.coalesce(kept_done, F.lit(False)), 0).otherwise(F.col("e.failures")).cast("long").alias("failures"))


def write_articles(articles: DataFrame, path: str, mode: str = "append") -> None:
    """K1: JSON lines under category, site and channel, with all 13 fields, nulls included."""
    named = articles.withColumns({"p_category": C.path_part(F.col("category")), "p_site": F.replace(C.path_part(F.col("siteName")), F.lit("\n"), F.lit("")), "p_channel": F.col("channel")})
    named.write.mode(mode).partitionBy("p_category", "p_site", "p_channel").option("ignoreNullFields", "false").json(path)


def stamped(articles: DataFrame, as_of: Column) -> DataFrame:
    """publishTime where there is none, and crawledAt, from `as_of`."""
    return articles.withColumns({"publishTime": C.first_filled(F.col("publishTime"), C.day_stamp(as_of)), "crawledAt": C.second_stamp(as_of)})


def pages_only(landed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pages, others) of `landed` (mime and others); others have reject_reason."""
    fits = C.is_page_type(F.col("mime"))
    return landed.where(fits), landed.where(~fits).withColumn("reject_reason", F.concat(F.lit("not a page: "), "mime"))


def article_counts(articles: DataFrame) -> DataFrame:
    """A5: articles by category, site and channel, with subtotals; `level` is the number of columns that a row sums over."""
    counted = articles.rollup("category", "siteName", "channel").agg(F.count(F.lit(1)).alias("n_articles"), F.grouping_id().alias("gid"))
    return counted.select("category", "siteName", "channel", F.bit_count("gid").alias("level"), "n_articles")


def read_visited(spark: SparkSession, path: str) -> DataFrame:
    """The URLs under `path`, one a line, stripped, without blank lines and repeats."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return lines.select(C.stripped(F.col("value")).alias("url")).where("url <> ''").distinct()


def land_batch(articles: DataFrame, batch_id: int, articles_path: str, visited_path: str) -> None:
    """K1, K2: a batch of articles and then its URLs, for `foreachBatch`.

    Each batch has folders of its own that a repetition overwrites, so a batch that broke off between the two writes
    leaves no article twice. The URLs come from the articles that were written, and only after them.
    """
    here = f"{articles_path}/batch={batch_id}"
    write_articles(first_seen(articles, "url", ["title", "content"]).select(*articles.columns), here, "overwrite")
    written = articles.sparkSession.read.schema("url string").json(here)
    written.select("url").distinct().write.mode("overwrite").text(f"{visited_path}/batch={batch_id}")


def observed(df: DataFrame, name: str, *columns: str) -> tuple[DataFrame, Observation]:
    """K6: `df` with metrics of its next run: its rows, and the nulls of `columns`."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]), seen

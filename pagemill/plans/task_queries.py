"""Queries of the task table, the registry's listing, the article counts and a growing frontier, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import pages as P
from ..operators import sites as S
from ..operators import tasks as T

NOW = "2026-01-01 00:00:00"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _old_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a task table: one article for each."""
    o = _table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "O", "pending").otherwise("deferred")
    return o.select(
        F.lit("article").alias("kind"), F.concat(F.lit("u"), "o_orderkey").alias("url"), F.concat(F.lit("s"), F.col("o_custkey") % 50).alias("site"), F.col("o_orderpriority").alias("channel"),
        status.alias("status"), F.lit("start").alias("phase"), (F.col("o_orderkey") % 2).cast("int").alias("failures"), F.lit("").alias("error"), F.lit("").alias("path"),
        F.lit(0).alias("downloaded"), F.lit("").alias("encoding"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("updated"),
    )


OLD_SQL = """
old AS (SELECT 'article' AS kind, 'u' || o_orderkey AS url, 's' || (o_custkey % 50) AS site, o_orderpriority AS channel,
  CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'pending' ELSE 'deferred' END AS status, 'start' AS phase,
  CAST(o_orderkey % 2 AS INTEGER) AS failures, strftime(o_orderdate, '%Y-%m-%d') AS updated FROM orders)
"""


def task_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items claim URLs, of which every third order's is known."""
    old = _old_tasks(spark, sf_dir).where(F.substring("url", 2, 20).cast("long") % 3 == 0)
    line = _table(spark, sf_dir, "lineitem")
    found = line.select(F.lit("article").alias("kind"), F.concat(F.lit("u"), "l_orderkey").alias("url"), F.concat(F.lit("s"), "l_suppkey").alias("site"), F.col("l_returnflag").alias("channel"), F.col("l_suppkey").alias("site_ord"), F.col("l_linenumber").alias("place"))
    return T.add_tasks(old, found, ["site_ord", "place"], NOW).select("kind", "url", "site", "channel", "status", "phase", "failures", "updated")


INSERT_SQL = f"""
WITH {OLD_SQL},
known AS (SELECT * FROM old WHERE CAST(substr(url, 2) AS BIGINT) % 3 = 0),
new AS (SELECT 'u' || l_orderkey AS url, 's' || l_suppkey AS site, l_returnflag AS channel FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_suppkey, l_linenumber, 's' || l_suppkey, l_returnflag) = 1)
SELECT kind, url, site, channel, status, phase, failures, updated FROM known
UNION ALL SELECT 'article', url, site, channel, 'pending', 'queued', 0, '{NOW}' FROM new WHERE url NOT IN (SELECT url FROM known)
"""


def task_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3, Q6: line items change the phases of orders' tasks; the last of a key that says something counts."""
    line = _table(spark, sf_dir, "lineitem")
    changes = line.select(F.lit("article").alias("kind"), F.concat(F.lit("u"), "l_orderkey").alias("url"), F.col("l_linenumber").alias("seq"), F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("phase"), F.when(F.col("l_quantity") > 25, 1).alias("downloaded"))
    return T.changed_tasks(_old_tasks(spark, sf_dir), changes, ["seq"], NOW).select("url", "status", "phase", "downloaded", "updated")


CHANGE_SQL = f"""
WITH {OLD_SQL},
c AS (SELECT 'u' || l_orderkey AS url, max((l_linenumber, l_returnflag)) FILTER (l_returnflag <> 'N') AS p, max(l_linenumber) FILTER (l_quantity > 25) AS d FROM lineitem GROUP BY l_orderkey)
SELECT old.url, status, coalesce(p[2], phase) AS phase, CAST(d IS NOT NULL AS INTEGER) AS downloaded, CASE WHEN c.url IS NULL THEN updated ELSE '{NOW}' END AS updated
FROM old LEFT JOIN c ON c.url = old.url
"""


def task_heal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a returned line item count as visited."""
    visited = _table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.concat(F.lit("u"), "l_orderkey").alias("url"))
    return T.healed(_old_tasks(spark, sf_dir), visited, NOW).select("url", "status", "phase", "failures", "updated")


HEAL_SQL = f"""
WITH {OLD_SQL},
h AS (SELECT *, status <> 'done' AND url IN (SELECT 'u' || l_orderkey FROM lineitem WHERE l_returnflag = 'R') AS hit FROM old)
SELECT url, CASE WHEN hit THEN 'done' ELSE status END AS status, CASE WHEN hit THEN 'done' ELSE phase END AS phase,
  CASE WHEN hit THEN 0 ELSE failures END AS failures, CASE WHEN hit THEN '{NOW}' ELSE updated END AS updated FROM h
"""


def work_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Waiting articles of each channel, then the links that line items give."""
    links = _table(spark, sf_dir, "lineitem").join(_table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    links = links.where("l_shipdate > o_orderdate").select(F.concat(F.lit("s"), F.col("o_custkey") % 50).alias("site"), F.col("o_orderpriority").alias("channel"), F.concat(F.lit("u"), "l_orderkey").alias("url"), F.col("l_partkey").alias("place"))
    return T.work_list(T.pending(_old_tasks(spark, sf_dir)), links)


WORK_SQL = f"""
WITH {OLD_SQL},
w AS (SELECT site, channel, url, 0 AS turn, row_number() OVER (PARTITION BY site, channel ORDER BY updated, url) AS place FROM old WHERE status = 'pending'
  UNION ALL SELECT 's' || (o_custkey % 50), o_orderpriority, 'u' || l_orderkey, 1, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate > o_orderdate),
f AS (SELECT site, channel, url, min((turn, place)) AS m FROM w GROUP BY site, channel, url)
SELECT site, channel, url, m[1] = 0 AS waiting, CAST(row_number() OVER (PARTITION BY site, channel ORDER BY m, url) AS INTEGER) AS place FROM f
"""


def open_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q10"""
    return T.open_tasks(_old_tasks(spark, sf_dir)).select("kind", "url", "status", "failures", "updated")


OPEN_SQL = f"WITH {OLD_SQL} SELECT kind, url, status, failures, updated FROM old WHERE status <> 'done'"


def site_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: suppliers as sites of their nations."""
    s = _table(spark, sf_dir, "supplier")
    return S.site_listing(s.select(F.col("s_name").alias("name"), F.col("s_nationkey").cast("string").alias("category"), F.concat(F.lit("https://s"), "s_suppkey", F.lit(".test")).alias("home_url")))


LISTING_SQL = """
SELECT CAST(s_nationkey AS VARCHAR) AS category, s_name AS name, s_name || ' (https://s' || s_suppkey || '.test)' AS line,
  count(*) OVER (PARTITION BY s_nationkey) AS n_sites FROM supplier
"""


def article_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: documents by language, source and the length's number of digits."""
    d = _table(spark, sf_dir, "documents")
    return P.article_counts(d.select(F.col("lang").alias("category"), F.col("source").alias("siteName"), F.length(F.col("n_chars").cast("string")).cast("string").alias("channel")))


COUNTS_SQL = """
SELECT category, "siteName", channel, CAST(bit_count(CAST(grouping(category, "siteName", channel) AS INTEGER)) AS INTEGER) AS level, count(*) AS n_articles
FROM (SELECT lang AS category, source AS "siteName", CAST(length(CAST(n_chars AS VARCHAR)) AS VARCHAR) AS channel FROM documents)
GROUP BY ROLLUP (category, "siteName", channel)
"""


def page_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types as media types."""
    e = _table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type") == "view", " Text/HTML ; charset=gbk").when(F.col("event_type") == "click", "application/pdf").when(F.col("event_type") == "error", "text/plain").when(F.col("event_type") == "signup", "text/htmlx")
    pages, others = P.pages_only(e.select("event_id", kind.alias("mime")))
    return pages.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(others).select("event_id", "reject_reason")


TYPES_SQL = """
SELECT event_id, CASE event_type WHEN 'click' THEN 'not a page: application/pdf' WHEN 'signup' THEN 'not a page: text/htmlx' END AS reject_reason FROM events
"""


def article_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as JSON objects with their stamps."""
    as_of = F.to_timestamp_ntz(F.lit("2026-09-17 08:05:09"))
    d = _table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("siteName"), "lang", F.lit(None).cast("string").alias("publishTime"), F.array().cast("array<string>").alias("images"))
    return P.stamped(d, as_of).select("doc_id", C.compact_json("doc_id", "siteName", F.lit(None).cast("string").alias("source"), "lang", "publishTime", "images", "crawledAt").alias("json"))


JSON_SQL = """
SELECT doc_id, CAST(json_object('doc_id', doc_id, 'siteName', source, 'source', NULL, 'lang', lang, 'publishTime', '2026-09-17', 'images', CAST([] AS VARCHAR[]), 'crawledAt', '2026-09-17 08:05:09') AS VARCHAR) AS json
FROM documents
"""

def frontier_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1, T3, J11, L1 at any size: lines as links of suppliers, orders of one status visited; both grow with the tables."""
    lines = _table(spark, sf_dir, "lineitem").select(F.concat(F.lit("u"), "l_orderkey").alias("url"), F.col("l_suppkey").alias("site"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("link_ord"))
    visited = _table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "P").select(F.concat(F.lit("u"), "o_orderkey").alias("url"))
    return P.at_most(P.unseen(P.first_seen(lines, "url", ["site", "link_ord"]), visited), "site", ["link_ord"], 5)


FRONTIER_LINES_SQL = """
WITH l AS (SELECT 'u' || l_orderkey AS url, l_suppkey AS site, l_orderkey * 8 + l_linenumber AS link_ord FROM lineitem),
f AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY url ORDER BY site, link_ord) = 1)
SELECT url, site, link_ord, CAST(row_number() OVER (PARTITION BY site ORDER BY link_ord) AS INTEGER) AS place
FROM f WHERE url NOT IN (SELECT 'u' || o_orderkey FROM orders WHERE o_orderstatus = 'P') QUALIFY place <= 5
"""

QUERIES = {
    "task_insert": task_insert,
    "task_change": task_change,
    "task_heal": task_heal,
    "work_list": work_list,
    "open_tasks": open_tasks,
    "site_listing": site_listing,
    "article_counts": article_counts,
    "page_types": page_types,
    "article_json": article_json,
    "frontier_lines": frontier_lines,
}

SQL = {
    "task_insert": INSERT_SQL,
    "task_change": CHANGE_SQL,
    "task_heal": HEAL_SQL,
    "work_list": WORK_SQL,
    "open_tasks": OPEN_SQL,
    "site_listing": LISTING_SQL,
    "article_counts": COUNTS_SQL,
    "page_types": TYPES_SQL,
    "article_json": JSON_SQL,
    "frontier_lines": FRONTIER_LINES_SQL,
}

"""Pages with the settings of their sites to canonical articles, each page an article or a reject."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import pages as P

#: What a site may set, and the name under which a page carries it.
SETTINGS = {"name": "cfg_name", "category": "cfg_category", "sub_category": "cfg_sub_category", "title_selectors": "title_selectors", "content_selectors": "content_selectors"}


def with_settings(pages: DataFrame, sites: DataFrame) -> DataFrame:
    """`pages` (site, others) with the settings of their sites (name and any of SETTINGS); unknown sites have none."""
    have = [F.col(c).alias(to) for c, to in SETTINGS.items() if c in sites.columns and c != "name"]
    one = sites.select("name", *have).dropDuplicates(["name"]).withColumn("cfg_name", F.col("name")).withColumnRenamed("name", "site")
    return pages.join(one, "site", "left")


def judged(pages: DataFrame, sites: DataFrame, as_of: Column, **budget: int) -> DataFrame:
    """Each of `pages` (url, html, site, channel, others) as `page` without its html and with peak_mb, `article` and reject_reason.

    An article has the 13 fields: the extracted parts, the site's name, category and sub-category, the channel, the site's
    name as source and the day of `as_of` as publishing time where the page shows none, and `as_of` as time of reading. Selectors
    of a site hold for its pages. A page that can't be read, or whose record isn't canonical, has a reason and no article.
    """
    columns = [c for c in pages.columns if c != "html"]
    found = P.with_article(with_settings(P.spread(pages), sites), **budget)
    site = [c for c in ("cfg_name", "cfg_category", "cfg_sub_category") if c in found.columns]
    parts = [F.col(f"out.{c}").alias(c) for c in ("title", "content", "publishTime", "docNumber", "indexNumber", "images")]
    flat = found.select(F.struct(*columns, "peak_mb").alias("page"), F.col("out.reject").alias("unread"), "url", "channel", *site, *parts, F.coalesce("out.source", "cfg_name").alias("source"))
    rows = P.checked(P.stamped(flat, as_of), "page", "unread")
    reason = F.coalesce("unread", "reject_reason")
    return rows.select("page", F.when(reason.isNull(), F.struct(*P.FIELDS)).alias("article"), reason.alias("reject_reason"))


def articles_of(pages: DataFrame, sites: DataFrame, as_of: Column, **budget: int) -> tuple[DataFrame, DataFrame]:
    """(articles, rejected) as `judged`: every page is in one of them. Rejected pages keep their columns but the html.

    Both read the pages; write what `judged` gives once where both are needed.
    """
    rows = judged(pages, sites, as_of, **budget)
    return rows.where("reject_reason is null").select("article.*"), rows.where("reject_reason is not null").select(*[F.col(f"page.{c}").alias(c) for c in pages.columns if c != "html"], "reject_reason")

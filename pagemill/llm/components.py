"""Connected components of links by alternating large-star and small-star steps (Kiveris et al., 2014).

Each step is a partial aggregation for the least neighbour and a join with one row on the aggregated side, so a vertex
with very many links is a skewed join that adaptive execution splits, not a group in one task. Every round is written
to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import materialise


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _both(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def large_star(links: DataFrame) -> DataFrame:
    """Neighbours above u move to u's least neighbour."""
    both = _both(links)
    return both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def small_star(links: DataFrame) -> DataFrame:
    """u and its neighbours below it move to the least of them; `links` hold u > v."""
    least = _least(links)
    moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _digest(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every id that `links` (a, b) name; the component is its least id."""
    links = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    links = materialise(links, "links")
    seen = _digest(links)
    while seen[0]:
        links = materialise(small_star(large_star(links)), "links")
        now = _digest(links)
        if now == seen:
            break
        seen = now
    stars = links.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return stars.unionByName(links.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())

"""Operator 3: mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, target / source size. Within a source the
documents are laid out by (size, md5 of doc_id and text, doc_id); the prefix sum of expected copies plus one random
offset of the source is cut at the integers, and a document is emitted once for each integer boundary that it crosses. As
the layout is by size, what is taken follows the target to within a few documents.

Prefix sums need no running total here: with equal expectations e the sum before position r is r * e. Positions come
from counts of (source, size), so no task holds a whole source. That table grows with the documents: rows meet it in a merge
join salted by their md5 (HEX), never in a broadcast. Rows of one source and size that are too many for a task
are split by their md5, and rows alike in everything are counted, numbered together and written out again in portions.

Defined results: a null text has size 0; a null source is a source of its own and comes last; documents of size 0 are
drawn like others but add no words; a source without words has target 0 and nothing is taken. Repeated rows are drawn
one by one; null and repeated ids are ids like others. No document is taken more than `most` times. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import ROWS_PER_BUCKET, materialise, rank_rows, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
SEED = "mix-1"
HEX = "0123456789abcdef"


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """`sizes` (key, source_size; keys are unique) with `target` for each source; keys are ranked in binary order.

    Sources stop at `most` times their size and their excess is shared out again by weight, until none is above. That is
    min(cap, weight * level), and the level rises from round to round as sources reach their cap: each round is an
    aggregation over the sources, and the driver gets two sums of it.
    """
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = rank_rows(sizes, "key", "rank").withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    ranked = materialise(ranked.select("key", "source_size", "weight", "cap"), "mix-sources")
    total, left = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    level, capped = None, 0
    while left:
        new = (total * float(share) - capped) / float(left)
        if new == level:
            break
        level, full = new, F.col("cap") <= F.col("weight") * F.lit(new)
        capped, left = ranked.agg(F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0)), F.sum(F.when(~full, F.col("weight")))).first()
    target = F.col("cap").cast("double") if level is None else F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(level))
    return ranked.select("key", "source_size", target.alias("target"))


def systematic_mix(docs: DataFrame, carry: list[str], weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES, seed: str = SEED, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """`carry` columns of `docs` (doc_id, text, source) with size, source_size, target and copies."""
    ids = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    base = docs.select(
        F.struct(*carry).alias("row"),
        F.col("doc_id").cast("string").alias("id"),
        F.coalesce(F.concat(F.lit("0"), F.col("source")), F.lit("1")).alias("key"),
        word_count(F.col("text")).alias("size"),
        F.md5(F.concat(ids, F.lit("|"), F.coalesce(F.md5(F.col("text").cast("binary")), F.lit(""))).cast("binary")).alias("spread"),
    )
    base = materialise(base.groupBy("key", "size", "spread", "id", "row").agg(F.count(F.lit(1)).alias("alike")), "mix-rows")
    by_size = base.groupBy("key", "size").agg(F.sum("alike").alias("n"))
    by_size = materialise(by_size, "mix-counts")
    targets = source_targets(by_size.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, share, most)
    smaller = Window.partitionBy("key").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    # Hex digits of the md5 by which the rows of a source and size are split; most need none.
    digits = F.greatest(F.lit(0), F.ceil(F.log(16.0, F.col("n") / F.lit(float(rows_per_bucket))))).cast("int")
    starts = by_size.select("key", "size", F.coalesce(F.sum("n").over(smaller), F.lit(0)).alias("start"), digits.alias("digits"))
    starts = materialise(starts.join(targets, "key"), "mix-starts")
    salted = starts.withColumn("salt", F.explode(F.array(*map(F.lit, HEX))))
    placed = base.withColumn("salt", F.substring("spread", 1, 1)).join(salted.hint("merge"), ["key", "size", "salt"]).drop("salt")
    placed = placed.withColumn("bucket", F.substring("spread", F.lit(1), F.col("digits")))
    whole = ["key", "size", "bucket"]
    before = Window.partitionBy("key", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = base.join(starts.where("digits > 0").select("key", "size", "digits"), ["key", "size"]).withColumn("bucket", F.substring("spread", F.lit(1), F.col("digits")))
    offsets = offsets.groupBy(*whole).agg(F.sum("alike").alias("n")).select(*whole, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.coalesce(F.sum("alike").over(Window.partitionBy(*whole).orderBy("spread", "id", "row").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = placed.withColumn("at", F.col("start") + inside).join(materialise(offsets, "mix-offsets"), whole, "left")
    placed = placed.select("row", "key", "size", "source_size", "target", "alike", (F.col("at") + F.coalesce("offset", F.lit(0))).alias("at"))

    def each(df: DataFrame, first: Column, n: Column) -> DataFrame:
        """A row for each of `n` rows alike, from `first` on."""
        return df.withColumn("at", F.explode(F.sequence(first, first + n - 1)))

    few, size = placed.where(F.col("alike") <= rows_per_bucket), F.lit(rows_per_bucket)
    many = placed.where(F.col("alike") > rows_per_bucket).withColumn("portion", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("alike") - 1) / size))))
    many = many.repartition("key", "size", "at", "portion")
    left = F.least(size.cast("long"), F.col("alike") - F.col("portion") * size)
    rows = each(few, F.col("at"), F.col("alike")).unionByName(each(many, F.col("at") + F.col("portion") * size, left).drop("portion"))

    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.col("key")).cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    copies = F.least(F.floor((F.col("at") + 1) * expected + offset) - F.floor(F.col("at") * expected + offset), F.lit(int(most)))
    return rows.select("row.*", F.col("size").alias("__size"), "source_size", "target", copies.cast("long").alias("__copies"))


def op3_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan of the mix: one row for each document, `taken` being the words that the mix takes from it."""
    mix = systematic_mix(table(spark, sf_dir, "documents"), ["doc_id"])
    return mix.select("doc_id", F.col("__size").alias("size"), "source_size", "target", (F.col("__copies") * F.col("__size")).alias("taken"), F.col("__copies").alias("copies"))


OP3_SQL = r"""
WITH base AS (
  SELECT doc_id, COALESCE('0' || source, '1') AS k,
         CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(COALESCE(CAST(doc_id AS VARCHAR), '') || '|' || COALESCE(md5(text), '')) AS spread
  FROM documents),
sources AS (SELECT k, SUM(size) AS source_size FROM base GROUP BY k),
weighted AS (
  SELECT k, source_size, 2 * source_size AS cap,
         CASE (row_number() OVER (ORDER BY k) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sources),
levels AS (
  SELECT *, (CAST(SUM(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE
             - CAST(COALESCE(SUM(cap) OVER (ORDER BY cap / weight::DOUBLE, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
            / CAST(SUM(weight) OVER (ORDER BY cap / weight::DOUBLE, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM weighted),
filled AS (
  SELECT (SELECT level FROM levels WHERE cap > weight * level ORDER BY cap / weight::DOUBLE, k LIMIT 1) AS fill),
targets AS (
  SELECT k, CAST(source_size AS BIGINT) AS source_size,
         COALESCE(LEAST(cap::DOUBLE, weight * fill), cap::DOUBLE) AS target,
         ('0x' || substr(md5('mix-1|' || k), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS shift
  FROM levels, filled),
placed AS (
  SELECT b.doc_id, b.size, t.source_size, t.target, t.shift,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size::DOUBLE ELSE 0.0::DOUBLE END AS e,
         row_number() OVER (PARTITION BY b.k ORDER BY b.size, b.spread, CAST(b.doc_id AS VARCHAR)) - 1 AS r
  FROM base b JOIN targets t USING (k)),
drawn AS (
  SELECT *, LEAST(CAST(floor((r + 1)::DOUBLE * e + shift) - floor(r::DOUBLE * e + shift) AS BIGINT), 2) AS copies FROM placed)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM drawn
"""

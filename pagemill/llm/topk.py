"""Operator 5: exact top-k by inner product with block-at-a-time pruning.

Terms are vector components, as integers floor(1024 * x). Documents are dealt into groups of bounded size, ranges of their
labels; a task holds one group, sorted by (label, id) and cut into ranges of BLOCK documents. Each block and each group
keeps the least and the largest value of each term. For a query the bound of either is the sum over its terms of the
larger of weight * least and weight * largest.

* A query's k-th score starts from a bounded sample of documents (SEED_ROWS, fewer for wide vectors), a valid lower bound,
  found once for each query.
* The bounds of all groups come from a table of their extremes, which tasks hold in parts of SUPER groups while queries
  stream past. A query goes to its best group first, and then only to groups whose bound reaches its k-th score.
* In a group, blocks are visited by falling bound and scored through their forward index (the rows themselves); the query
  stops at the first bound below its k-th score.

Defined results: vectors that are null or hold null or non-finite components take no part; shorter vectors count as
filled up with zeros. Rows that repeat an id are all candidates, but none is one for its own id; as a query the
smallest of them is asked once. Rows with a null id take no part. Ties go to the smaller id. Scores beyond the long
range are cut to it. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import materialise, start_rows, table, tidy
from ._vectors import matrix, runs, usable, widened

#: Documents of a group, and bytes of them as doubles.
GROUP_ROWS, GROUP_BYTES = 2_048, 1 << 26
BLOCK = 256
SEED_ROWS, SEED_BYTES = 2_048, 1 << 23
#: Groups whose extremes one task holds, and queries that pass by them.
SUPER, QUERIES = 4_096, 8_192
LONG = 2**63 - 1


def quantised(vectors: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(vectors * 1024.0), -1.7976931348623157e308, 1.7976931348623157e308)


def exact_products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Integer inner products of `rows` with `query`, as int64."""
    if not rows.size:
        return np.zeros(len(rows), dtype=np.int64)
    with np.errstate(over="ignore"):
        safe = float(np.abs(rows).max()) * float(np.abs(query).max()) * rows.shape[1] < 2.0**53
    if safe:
        return (rows @ query).astype(np.int64)
    q = [int(x) for x in query]
    return np.array([min(LONG, max(-LONG - 1, sum(int(a) * b for a, b in zip(r, q, strict=True)))) for r in rows], dtype=np.int64)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores.astype(object) if scores.min(initial=0) == -LONG - 1 else -scores))[:k]
    return ids[order], scores[order]


def bounds_of(queries: np.ndarray, least: np.ndarray, largest: np.ndarray) -> np.ndarray:
    """For each query and range what no score in the range can exceed.

    A sum of doubles errs by its terms, which may be far larger than the sum where they cancel.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        found = np.maximum(queries, 0) @ largest.T + np.minimum(queries, 0) @ least.T
        terms = np.abs(queries) @ np.maximum(np.abs(least), np.abs(largest)).T
        found = found + terms * ((queries.shape[1] + 4) * 2.0**-52)
        return np.where(np.isnan(found), np.inf, found)


class Blocks:
    """Documents of one group in ranges of BLOCK, with the extremes of each term."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors, self.width = ids, vectors, vectors.shape[1]
        starts = np.arange(0, len(ids), BLOCK)
        self.largest = np.maximum.reduceat(vectors, starts, axis=0) if len(ids) else np.zeros((0, self.width))
        self.least = np.minimum.reduceat(vectors, starts, axis=0) if len(ids) else np.zeros((0, self.width))

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        return bounds_of(queries, self.least, self.largest)

    def search(self, query_id: int, query: np.ndarray, bounds: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """The group's contenders for the query's top k: all of score `floor` or more, k at most."""
        ids, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        limit = floor
        for b in np.argsort(-bounds, kind="stable"):
            if bounds[b] < limit:
                break
            at = slice(b * BLOCK, (b + 1) * BLOCK)
            found = exact_products(self.vectors[at], query)
            keep = (found >= limit) & (self.ids[at] != query_id)
            if keep.any():
                ids, scores = best(np.concatenate([ids, self.ids[at][keep]]), np.concatenate([scores, found[keep]]), k)
                if len(scores) == k:
                    limit = max(limit, int(scores[-1]))
        return ids, scores


def dealt_docs(docs: DataFrame, group_rows: int) -> DataFrame:
    """`docs` (id, vector, ord) with `grp`: neighbouring labels share groups of about `group_rows`, a large label has several."""
    docs = docs.withColumn("label", F.coalesce(F.col("ord").cast("string"), F.lit("")))
    sizes = start_rows(docs.groupBy("label").agg(F.count(F.lit(1)).alias("n")), "label", F.col("n"), "start")
    place = F.col("start") + F.pmod(F.xxhash64("id"), F.col("n"))
    rows = docs.join(materialise(sizes, "topk-labels"), "label").withColumn("grp", F.floor(place / group_rows).cast("int"))
    return materialise(rows.select("grp", "ord", "id", "vector").repartition("grp").sortWithinPartitions("grp", "ord", "id"), "topk-groups")


def extremes_of(dealt: DataFrame) -> DataFrame:
    """grp, least and largest of each term, for each run of a group's rows."""

    @tidy
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, least, largest = None, np.zeros(0), np.zeros(0)

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([least.tolist()], pa.list_(pa.float64())), pa.array([largest.tolist()], pa.list_(pa.float64()))], names=["grp", "least", "largest"])

        for (group,), part in runs(batches, ["grp"]):
            m = quantised(matrix(part.column("vector")))
            low, high = m.min(axis=0), m.max(axis=0)
            if group == at:  # shorter rows are filled up with zeros
                width = max(len(low), len(least))
                low, high, least, largest = (np.pad(x, (0, width - len(x))) for x in (low, high, least, largest))
                least, largest = np.minimum(least, low), np.maximum(largest, high)
                continue
            if at is not None:
                yield told()
            at, least, largest = group, low, high
        if at is not None:
            yield told()

    return dealt.select("grp", "vector").mapInArrow(fold, "grp int, least array<double>, largest array<double>")


def admitted(queries: DataFrame, extremes: DataFrame, seeds, k: int, n_queries: int) -> DataFrame:
    """grp, id, bound, floor: the groups that may hold one of a query's k best, `floor` being the k-th score among the seeds."""
    slices_ = max(1, -(-n_queries // QUERIES))
    nothing = F.lit(None).cast("array<double>")
    held = extremes.select(F.floor(F.col("grp") / SUPER).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.lit(slices_ - 1))).alias("slice"), F.lit(0).alias("side"), F.col("grp").cast("long").alias("id"), "least", "largest")
    parts = (extremes.agg(F.max("grp")).first()[0] or 0) // SUPER  # a query goes once to each SUPER groups
    asked = queries.select(F.explode(F.sequence(F.lit(0), F.lit(parts))).alias("part"), F.pmod(F.xxhash64("id"), F.lit(slices_)).cast("int").alias("slice"), F.lit(1).alias("side"), "id", F.col("vector").alias("least"), nothing.alias("largest"))
    units = held.unionByName(asked).repartition("part", "slice").sortWithinPartitions("part", "slice", "side")

    @tidy
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, groups, least, largest = None, [], [], []
        sample_ids, sample = seeds.value
        for (part_, slice_, side), part in runs(batches, ["part", "slice", "side"]):
            if (part_, slice_) != at:
                at, groups, least, largest = (part_, slice_), [], [], []
            m = matrix(part.column("least"))
            if side == 0:
                groups.append(part.column("id").to_numpy())
                least.append(m)
                largest.append(matrix(part.column("largest")))
                continue
            m, ids = quantised(m), part.column("id").to_numpy()
            width = max([m.shape[1], sample.shape[1], *(x.shape[1] for x in least)])
            low, high = (np.concatenate([widened(x, width) for x in xs]) for xs in (least, largest))
            names, place = np.unique(np.concatenate(groups), return_inverse=True)
            known, m = widened(sample, width), widened(m, width)
            for start in range(0, len(m), BLOCK):
                some, some_ids = m[start : start + BLOCK], ids[start : start + BLOCK]
                bounds = np.full((len(some), len(names)), -np.inf)
                np.maximum.at(bounds.T, place, bounds_of(some, low, high).T)
                out = []
                for i, query in enumerate(some):
                    reached = exact_products(known, query)[sample_ids != some_ids[i]]
                    floor = int(np.partition(reached, len(reached) - k)[len(reached) - k]) if len(reached) >= k else None
                    fits = np.flatnonzero(bounds[i] >= floor) if floor is not None else np.arange(len(names))
                    out.append((names[fits], np.full(len(fits), some_ids[i]), bounds[i][fits], np.full(len(fits), -LONG - 1 if floor is None else floor)))
                columns = [np.concatenate(x) for x in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(columns[0].astype(np.int32)), pa.array(columns[1].astype(np.int64)), pa.array(columns[2].astype(np.float64)), pa.array(columns[3].astype(np.int64))], names=["grp", "id", "bound", "floor"])

    return units.mapInArrow(meet, "grp int, id long, bound double, floor long")


def contenders(dealt: DataFrame, queries: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, score of each visit (grp, id, floor): the group's documents that may be among the query's k best."""
    no = F.lit(None)
    asked = visits.join(queries, "id").select("grp", F.lit(1).alias("side"), no.cast("int").alias("ord"), "id", "vector", "floor")
    docs = dealt.join(visits.select("grp").distinct(), "grp", "left_semi").select("grp", F.lit(0).alias("side"), F.col("ord").cast("int").alias("ord"), "id", "vector", no.cast("long").alias("floor"))
    units = docs.unionByName(asked).repartition("grp").sortWithinPartitions("grp", "side", "ord", "id")

    @tidy
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, vectors, blocks = None, [], [], None
        for (group, side), part in runs(batches, ["grp", "side"]):
            m = quantised(matrix(part.column("vector")))
            if group != at:
                at, ids, vectors, blocks = group, [], [], None
            if side == 0:
                ids.append(part.column("id").to_numpy())
                vectors.append(m)
                continue
            width = max([m.shape[1], *(v.shape[1] for v in vectors)])
            if blocks is None or blocks.width != width:
                blocks = Blocks(np.concatenate(ids), np.concatenate([widened(v, width) for v in vectors]))
            m, query_ids, floors, out = widened(m, width), part.column("id").to_numpy(), part.column("floor").to_numpy(), []
            for start in range(0, len(m), BLOCK):
                bounds = blocks.bounds(m[start : start + BLOCK])
                for i in range(start, min(start + BLOCK, len(m))):
                    found, scores = blocks.search(query_ids[i], m[i], bounds[i - start], k, int(floors[i]))
                    out.append((np.full(len(found), query_ids[i]), found, scores))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*out, strict=True)], names=["query_id", "vec_id", "score"])

    return units.mapInArrow(scan, "query_id long, vec_id long, score long")


def best_k(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(docs: DataFrame, queries: DataFrame, k: int = 10, group_rows: int = GROUP_ROWS, seed_rows: int = SEED_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of `queries` (id, vector) its k best rows of `docs` (id, vector, ord)."""
    spark = docs.sparkSession
    docs, queries = docs.where("id is not null"), queries.where("id is not null")
    docs = docs.where(usable(F.col("vector"))).withColumn("vector", F.col("vector").cast("array<double>"))
    queries = queries.where(usable(F.col("vector"))).groupBy("id").agg(F.min(F.col("vector").cast("array<double>")).alias("vector"))
    queries = materialise(queries, "topk-queries")
    widest = 8 * max(1, docs.agg(F.max(F.size("vector"))).first()[0] or 1)
    dealt = dealt_docs(docs, max(1, min(group_rows, GROUP_BYTES // widest)))
    seed = dealt.select("id", "vector").limit(max(1, min(seed_rows, SEED_BYTES // widest))).toArrow().combine_chunks()  # bounded
    seed_ids = seed.column("id").to_numpy()
    seeds = spark.sparkContext.broadcast((seed_ids, quantised(matrix(seed.column("vector").combine_chunks())) if len(seed_ids) else np.zeros((0, 0))))
    visits = materialise(admitted(queries, materialise(extremes_of(dealt), "topk-extremes"), seeds, k, queries.count()), "topk-visits")

    # The best group of each query first: its k-th score there leaves fewer groups to visit.
    firsts = visits.groupBy("id").agg(F.max(F.struct("bound", "grp", "floor")).alias("v")).select("id", "v.grp", "v.floor")
    firsts = materialise(firsts, "topk-firsts")
    found = materialise(contenders(dealt, queries, firsts, k), "topk-first-found")
    reached = best_k(found, k).where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("kth"))
    rest = visits.join(firsts.select("id", F.col("grp").alias("seen")), "id").where("grp <> seen").join(reached, "id", "left")
    rest = rest.withColumn("floor", F.greatest("floor", F.coalesce("kth", "floor"))).where(F.col("bound") >= F.col("floor"))
    rest = materialise(rest.select("grp", "id", "floor"), "topk-rest")
    return best_k(found.unionByName(contenders(dealt, queries, rest, k)), k)


def block_order(label: Column) -> Column:
    return label.cast("int")


def op5_block_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best rows of `embeddings` for each row whose vec_id is divisible by 100."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), block_order(F.col("label")).alias("ord"))
    return top_k(rows, rows.where(F.col("id") % 100 == 0).select("id", "vector"))


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

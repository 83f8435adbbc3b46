"""Operator 1: exact near-duplicate vectors by dual traversal of cover trees.

Vectors with one label and a cosine of at least the threshold are linked. On the unit sphere that is a distance of at
most eps = sqrt(2 - 2 * threshold), and covering radii bound it.

* Equal vectors are folded into one row first (smallest id, count); the copies come back at the end.
* Labels that a bounded sample (SAMPLE_ROWS, fewer for wide vectors) shows to hold more than a chunk get pivots. A vector
  lives in the cell of its nearest pivot. It also visits a cell with a higher number when the bisector between the two
  pivots is within eps and the pivot is within that cell's covering radius plus eps; no other cell can hold a partner of
  it that it would not meet.
* A cell is cut into chunks of about CHUNK_ROWS, rings around its pivot; a task builds a cover tree over one chunk and
  streams past it, as trees of bounded size, those visitors and rows of the cell's inner rings that are within eps of the ring.
* A tree's levels have halving radii down to single vectors: each node's children are a net of its rows at half its reach,
  the first child's centre being its own. A node with a single row, or with rows that doubles can't tell apart, is a leaf.
* Two trees are traversed together, many pairs of nodes at a time: the distances of all their children's centres come from
  one product of matrices. A pair is pruned when centre distance > both radii + eps, linked as a whole when centre
  distance + both radii <= eps, compared in double precision when both are leaves, and followed otherwise.
* A task gives link counts for each vector and a spanning forest of its links, both linear in its rows.

Vectors without clusters in many dimensions lie equally far from each other: then the tree has one wide level, nothing
prunes above it, and the work is the square of a label's rows, in blocks. `work_of` counts it.

Defined results: vectors that are null, zero or hold null or non-finite components, or whose label is null, link with
nothing: n_links 0, a component of their own, kept. Vectors of different lengths link with nothing of another length.
Rows that repeat an id are rows like others; their component is the smallest id that any of them reaches. Rows with a
null id keep null as component when nothing is linked. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import materialise, scratch, table, tidy
from ._vectors import matrix, runs, usable
from .components import connected_components

THRESHOLD = 0.98
SAMPLE_ROWS, SAMPLE_BYTES = 65_536, 1 << 25
CHUNK_ROWS = 4_096
VISIT_ROWS = 2_048
#: Rings of a cell.
MOST_RINGS = 64
#: Sampled rows for one pivot, and most pivots of a label; both only shape the cells.
ROWS_PER_PIVOT, MOST_PIVOTS = 16, 256
#: Reach at which rows count as one place, far below what the sums of doubles tell apart at eps.
SMALLEST_REACH = 1e-6
#: Added to eps wherever a bound prunes.
SLACK = 1e-7
#: Pairs of centres in one product, and pairs of nodes that are expanded together.
TILE, TOGETHER = 1 << 20, 1 << 15


class Tree:
    """A cover tree over the rows of `unit`. Node k: `centre[k]` (a row), `radius[k]` (to its farthest row), its rows
    `order[low[k]:high[k]]`, and its children, the nodes `first[k]` to `last[k]` (none for a leaf)."""

    def __init__(self, unit: np.ndarray):
        self.unit = unit
        order = np.arange(len(unit))
        away = distances(unit, unit[0]) if len(unit) else np.zeros(0)
        centre, radius, low, high, first, last = [0], [float(away.max(initial=0.0))], [0], [len(unit)], [0], [0]
        level, reach = [(0, away)], 2.0
        while level and reach > SMALLEST_REACH:
            reach /= 2
            below = []
            for node, far in level:
                if radius[node] <= reach:  # the node itself at the smaller reach
                    below.append((node, far))
                    continue
                start, rows = low[node], order[low[node] : high[node]].copy()
                pool, left, at = unit[rows], np.arange(len(rows)), centre[node]
                first[node] = len(centre)
                while len(left):
                    near = far <= reach
                    mine, mine_far = left[near], far[near]
                    order[start : start + len(mine)] = rows[mine]
                    if len(mine) > 1 and mine_far.max() > SMALLEST_REACH:
                        below.append((len(centre), mine_far))
                    for column, value in ((centre, int(at)), (radius, float(mine_far.max())), (low, start), (high, start + len(mine)), (first, 0), (last, 0)):
                        column.append(value)
                    start += len(mine)
                    left = left[~near]
                    if len(left):
                        if 2 * len(left) < len(pool):
                            pool, rows, left = pool[left], rows[left], np.arange(len(left))
                        at = rows[left[0]]
                        far = distances(pool, unit[at])[left]
                        far[0] = 0.0
                last[node] = len(centre)
            level = below
        self.order = order
        self.centre, self.low, self.high, self.first, self.last = (np.array(x, dtype=np.int64) for x in (centre, low, high, first, last))
        self.radius = np.array(radius)

    def rows(self, node: int) -> np.ndarray:
        return self.order[self.low[node] : self.high[node]]

    def below(self, node: int) -> np.ndarray:
        """The node's children; a leaf stands for itself."""
        return np.arange(self.first[node], self.last[node]) if self.last[node] else np.array([node])

    def depth(self) -> int:
        """Levels of nodes that differ."""
        depth, nodes = 0, np.array([0])
        while len(nodes):
            depth += 1
            nodes = nodes[self.last[nodes] > 0]
            nodes = np.concatenate([np.arange(self.first[k], self.last[k]) for k in nodes]) if len(nodes) else nodes
        return depth


def distances(vectors: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (vectors @ centre)))


class Links:
    """A spanning forest of one chunk's links, and how many distances were taken."""

    MOST = 1 << 20

    def __init__(self):
        self.a: list[np.ndarray] = []
        self.b: list[np.ndarray] = []
        self.held = self.compared = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.a.append(a)
        self.b.append(b)
        self.held += len(a)
        if self.held > self.MOST:  # as many as join the same rows
            a, b = forest(*self.taken())
            self.a, self.b, self.held = [a], [b], 0

    def whole(self, ids_a: np.ndarray, ids_b: np.ndarray) -> None:
        """All of a link with all of b."""
        self.add(ids_a, np.full(len(ids_a), ids_b[0]))
        self.add(np.full(len(ids_b), ids_a[0]), ids_b)

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        """The links so far, which go."""
        none = np.zeros(0, dtype=np.int64)
        out = np.concatenate([none, *self.a]), np.concatenate([none, *self.b])
        self.a, self.b, self.held = [], [], 0
        return out


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of each id with the least id that it reaches, from links a - b."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, two, mark = at[: len(a)], at[len(a) :], np.arange(len(ids))
    while True:
        least = np.minimum(mark[one], mark[two])
        new = mark.copy()
        np.minimum.at(new, mark[one], least)
        np.minimum.at(new, mark[two], least)
        np.minimum.at(new, one, least)
        np.minimum.at(new, two, least)
        new = new[new]
        if (new == mark).all():
            break
        mark = new
    far = mark != np.arange(len(ids))
    return ids[far], ids[mark[far]]


class Side:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, weights: np.ndarray):
        self.ids, self.vectors, self.weights = ids, vectors, weights
        self.norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        self.unit = vectors / self.norms[:, None]
        self.counts = np.zeros(len(ids), dtype=np.int64)
        self.tree = Tree(self.unit)


def traverse(one: Side, two: Side, threshold: float, eps: float, links: Links) -> None:
    """Visit the node pairs of both trees; one may be two, and then each pair of nodes is met once."""
    same, x, y = one is two, one.tree, two.tree
    if not len(one.ids) or not len(two.ids):
        return
    stack = [(np.array([0]), np.array([0]))]
    while stack:
        a, b = stack.pop()
        many = np.maximum(x.last[a] - x.first[a], 1) * np.maximum(y.last[b] - y.first[b], 1)
        wide = many > TOGETHER
        for i, j in zip(a[wide].tolist(), b[wide].tolist(), strict=True):
            rows, cols = x.below(i), y.below(j)
            step = max(1, min(TILE // len(cols), len(rows) // 16 if same and i == j else len(rows)))
            for start in range(0, len(rows), step):
                some, others = rows[start : start + step], cols[start:] if same and i == j else cols
                apart = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x.unit[x.centre[some]] @ y.unit[y.centre[others]].T)))
                links.compared += apart.size
                reach = x.radius[some][:, None] + y.radius[others][None, :]
                p, q = np.nonzero(np.triu(apart <= reach + eps + SLACK) if same and i == j else apart <= reach + eps + SLACK)
                settle(one, two, some[p], others[q], apart[p, q], same, threshold, eps, links, stack)
        a, b, many = a[~wide], b[~wide], many[~wide]
        ends = np.cumsum(many)
        at = 0
        while at < len(a):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] - many[at] + TOGETHER, side="right")))
            n = many[at:to]
            pair = np.repeat(np.arange(at, to), n)
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            wide_b = np.maximum(y.last[b] - y.first[b], 1)[pair]
            p = np.where(x.last[a[pair]] > 0, x.first[a[pair]] + place // wide_b, a[pair])
            q = np.where(y.last[b[pair]] > 0, y.first[b[pair]] + place % wide_b, b[pair])
            if same:  # the children of one node meet each other once
                once = (a[pair] != b[pair]) | (p <= q)
                p, q = p[once], q[once]
            apart = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * np.einsum("ij,ij->i", x.unit[x.centre[p]], y.unit[y.centre[q]])))
            links.compared += len(p)
            near = apart <= x.radius[p] + y.radius[q] + eps + SLACK
            settle(one, two, p[near], q[near], apart[near], same, threshold, eps, links, stack)
            at = to


def settle(one: Side, two: Side, p: np.ndarray, q: np.ndarray, apart: np.ndarray, same: bool, threshold: float, eps: float, links: Links, stack: list) -> None:
    """Link, compare or follow pairs of nodes that no bound prunes."""
    x, y = one.tree, two.tree
    if same:
        apart = np.where(p == q, 0.0, apart)
    single = (x.high[p] - x.low[p] == 1) & (y.high[q] - y.low[q] == 1)
    if single.any():
        i, j = x.order[x.low[p[single]]], y.order[y.low[q[single]]]
        compare(one, two, i[i != j] if same else i, j[i != j] if same else j, threshold, links)
    p, q, apart = p[~single], q[~single], apart[~single]
    whole = apart + x.radius[p] + y.radius[q] <= eps - SLACK
    for a, b in zip(p[whole].tolist(), q[whole].tolist(), strict=True):
        rows, cols = x.rows(a), y.rows(b)
        one.counts[rows] += two.weights[cols].sum()
        if same and a == b:
            one.counts[rows] -= one.weights[rows]
        else:
            two.counts[cols] += one.weights[rows].sum()
        links.whole(one.ids[rows], two.ids[cols])
    p, q = p[~whole], q[~whole]
    leaves = (x.last[p] == 0) & (y.last[q] == 0)
    for a, b in zip(p[leaves].tolist(), q[leaves].tolist(), strict=True):
        rows, cols = x.rows(a), y.rows(b)
        for start in range(0, len(rows), max(1, TILE // len(cols))):
            some = rows[start : start + max(1, TILE // len(cols))]
            i, j = np.repeat(some, len(cols)), np.tile(cols, len(some))
            once = i < j if same and a == b else slice(None)
            compare(one, two, i[once], j[once], threshold, links)
    if not leaves.all():
        stack.append((p[~leaves], q[~leaves]))


def compare(one: Side, two: Side, i: np.ndarray, j: np.ndarray, threshold: float, links: Links) -> None:
    """Pairs of rows, each met once, in double precision."""
    for start in range(0, len(i), 1 << 16):
        a, b = i[start : start + (1 << 16)], j[start : start + (1 << 16)]
        links.compared += len(a)
        hit = np.einsum("ij,ij->i", one.vectors[a], two.vectors[b]) / (one.norms[a] * two.norms[b]) >= threshold
        a, b = a[hit], b[hit]
        np.add.at(one.counts, a, two.weights[b])
        np.add.at(two.counts, b, one.weights[a])
        links.add(one.ids[a], two.ids[b])


def pivots_of(sample: list[tuple[str, np.ndarray]], share: float, eps: float, chunk_rows: int = CHUNK_ROWS) -> dict[str, np.ndarray]:
    """For each label (with its sampled vectors, `share` of all) of more than a chunk: pivots by farthest-first traversal."""
    out = {}
    for label, m in sample:
        rows = len(m) / share
        wanted = min(MOST_PIVOTS, len(m) // ROWS_PER_PIVOT, math.ceil(rows / chunk_rows))
        if rows <= chunk_rows or wanted < 2:
            continue
        m = m / np.linalg.norm(m, axis=1)[:, None]
        chosen, away = [0], distances(m, m[0])
        while len(chosen) < wanted and away.max() > 2 * eps:
            chosen.append(int(away.argmax()))
            away = np.minimum(away, distances(m, m[chosen[-1]]))
        if len(chosen) > 1:
            out[label] = m[chosen]
    return out


def sampled(vectors: DataFrame, rows: int) -> tuple[list[tuple[str, np.ndarray]], float]:
    """(vectors by key, their share) of about `rows` rows, fewer where vectors are wide; chosen by hash, so reruns agree."""
    n, widest = vectors.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    wanted = max(1, min(rows, SAMPLE_BYTES // (8 * max(1, widest or 1))))
    share = min(1.0, wanted / max(1, n))
    some = vectors if share == 1.0 else vectors.where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 30)) < int(share * (1 << 30)))
    got = some.select("key", "vector").limit(2 * wanted).toArrow().combine_chunks()  # bounded by 2 * wanted
    if not got.num_rows:
        return [], 1.0
    got = got.sort_by("key")
    keys = np.array(got.column("key").to_pylist(), dtype=object)
    starts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
    vectors_ = got.column("vector").combine_chunks()
    return [(keys[a], matrix(vectors_.slice(a, b - a))) for a, b in zip(starts, starts[1:], strict=False)], share


def in_rings(homes: DataFrame, chunk_rows: int) -> tuple[DataFrame, DataFrame]:
    """(`homes` (key, cell, away, others) with chunk, and for each cell the bounds of its rings).

    A cell's chunks are rings around its pivot, by the distance `away`: two rows within eps of each other differ in it by
    no more. A cell of more than MOST_RINGS chunks has `subs` of them in each ring, dealt by hash.
    """
    cuts = F.percentile_approx("away", F.array(*[F.lit((i + 1) / MOST_RINGS) for i in range(MOST_RINGS - 1)]), F.lit(10_000))
    stats = homes.groupBy("key", "cell").agg(F.ceil(F.count(F.lit(1)) / chunk_rows).cast("int").alias("chunks"), cuts.alias("cuts"))
    stats = stats.withColumns({"n_rings": F.least("chunks", F.lit(MOST_RINGS)), "subs": F.ceil(F.col("chunks") / MOST_RINGS).cast("int")})
    place = F.size(F.filter("cuts", lambda x: x < F.col("away")))
    own = homes.join(stats, ["key", "cell"]).withColumn("ring", F.floor(place * F.col("n_rings") / MOST_RINGS).cast("int"))
    own = own.withColumn("chunk", (F.col("ring") * F.col("subs") + F.pmod(F.xxhash64("id"), F.col("subs"))).cast("int")).drop("cuts", "n_rings", "chunks")
    bounds = own.groupBy("key", "cell", "ring", "subs").agg(F.min("away").alias("low"), F.max("away").alias("high"))
    bounds = bounds.groupBy("key", "cell", "subs").agg(F.collect_list(F.struct("ring", "low", "high")).alias("rings"))
    return own, materialise(bounds, "vector-rings")


def link_vectors(vectors: DataFrame, threshold: float = THRESHOLD, sample_rows: int = SAMPLE_ROWS, chunk_rows: int = CHUNK_ROWS) -> tuple[DataFrame, DataFrame]:
    """`vectors` (id, key, vector, weight), vectors of one key having one length: counts (id, n) and links (a, b)."""
    spark, eps = vectors.sparkSession, math.sqrt(2.0 - 2.0 * threshold)
    pivots = spark.sparkContext.broadcast(pivots_of(*sampled(vectors, sample_rows), eps, chunk_rows))  # bounded by the sample

    @tidy
    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.array(batch.column("key").to_pylist(), dtype=object)
            cells, away = np.zeros(batch.num_rows, dtype=np.int32), np.full(batch.num_rows, 2.0)
            visits: list = [[]] * batch.num_rows
            for key, centres in pivots.value.items():
                at = np.flatnonzero(keys == key)
                if not len(at):
                    continue
                m = matrix(batch.column("vector").take(pa.array(at)))
                m /= np.sqrt(np.einsum("ij,ij->i", m, m))[:, None]
                inner = m @ centres.T
                cell = inner.argmax(axis=1)
                apart = np.sqrt(np.maximum(1e-18, 2.0 - 2.0 * (centres @ centres.T)))
                gap = (inner.max(axis=1)[:, None] - inner) / apart[cell]
                far = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * inner))
                cells[at], away[at] = cell, far[np.arange(len(at)), cell]
                for i, row in enumerate(at):
                    others = np.flatnonzero((gap[i] <= eps + SLACK) & (np.arange(len(centres)) > cell[i]))
                    visits[row] = [{"cell": int(c), "far": float(far[i, c])} for c in others]
            kind = pa.list_(pa.struct([("cell", pa.int32()), ("far", pa.float64())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells), pa.array(away), pa.array(visits, kind)], names=[*batch.schema.names, "cell", "away", "visits"])

    homes = materialise(vectors.select("id", "key", "vector", "weight").mapInArrow(home, "id long, key string, vector array<double>, weight long, cell int, away double, visits array<struct<cell:int,far:double>>"), "vector-homes")
    own, bounds = in_rings(homes, chunk_rows)
    rows = own.select("key", "cell", "chunk", F.lit(0).alias("side"), "id", "vector", "weight")
    near = eps + SLACK
    last = F.array_max(F.transform(F.filter("rings", lambda r: r["low"] <= F.col("away") + near), lambda r: r["ring"]))
    later = own.join(bounds, ["key", "cell", "subs"]).withColumn("last", (last + 1) * F.col("subs") - 1).where("chunk < last")
    later = later.select("key", "cell", F.explode(F.expr("sequence(chunk + 1, last)")).alias("chunk"), F.lit(1).alias("side"), "id", "vector", "weight")
    guests = homes.select("key", "id", "vector", "weight", F.explode("visits").alias("visit")).select("key", F.col("visit.cell").alias("cell"), F.col("visit.far").alias("far"), "id", "vector", "weight")
    met = F.filter("rings", lambda r: (r["low"] <= F.col("far") + near) & (r["high"] >= F.col("far") - near))
    guests = guests.join(bounds, ["key", "cell"]).withColumn("met", F.transform(met, lambda r: r["ring"])).where(F.size("met") > 0)
    guests = guests.select("key", "cell", F.explode(F.flatten(F.transform("met", lambda r: F.sequence(r * F.col("subs"), (r + 1) * F.col("subs") - 1)))).alias("chunk"), F.lit(1).alias("side"), "id", "vector", "weight")
    units = rows.unionByName(later).unionByName(guests).repartition("key", "cell", "chunk").sortWithinPartitions("key", "cell", "chunk", "side")

    @tidy
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def side(parts: list[pa.RecordBatch]) -> Side:
            return Side(*(np.concatenate([f(p) for p in parts]) for f in (lambda p: p.column("id").to_numpy(), lambda p: matrix(p.column("vector")), lambda p: p.column("weight").to_numpy())))

        def told(sides: list[Side], links: Links) -> Iterator[pa.RecordBatch]:
            for s in sides:
                some = s.counts > 0
                if some.any():
                    yield pa.RecordBatch.from_arrays([pa.array(s.ids[some]), pa.array(np.zeros(some.sum(), dtype=np.int64), mask=np.ones(some.sum(), dtype=bool)), pa.array(s.counts[some])], names=["a", "b", "n"])
            if links.a:
                a, b = forest(*links.taken())
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.zeros(len(a), dtype=np.int64))], names=["a", "b", "n"])

        at, parts, chunk, links = None, [], None, Links()
        for key, part in runs(batches, ["key", "cell", "chunk", "side"]):
            if key[:3] != at:
                if parts or chunk:
                    yield from told([chunk or closed(side(parts), threshold, eps, links)], links)
                at, parts, chunk = key[:3], [], None
            if key[3] == 0:
                parts.append(part)
                continue
            if chunk is None:
                chunk = closed(side(parts), threshold, eps, links)
                parts = []
            for start in range(0, part.num_rows, VISIT_ROWS):
                guest = side([part.slice(start, VISIT_ROWS)])
                traverse(chunk, guest, threshold, eps, links)
                yield from told([guest], links)
        if parts or chunk:
            yield from told([chunk or closed(side(parts), threshold, eps, links)], links)

    found = materialise(units.mapInArrow(meet, "a long, b long, n long"), "vector-links")
    counts = found.where("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    return counts, found.where("b is not null").select("a", "b")


def work_of(vectors: np.ndarray, threshold: float = THRESHOLD) -> tuple[int, int, int]:
    """(distances taken, pairs of rows, levels of the tree) for the links within `vectors`."""
    side, links = Side(np.arange(len(vectors)), vectors, np.ones(len(vectors), dtype=np.int64)), Links()
    closed(side, threshold, math.sqrt(2.0 - 2.0 * threshold), links)
    return links.compared, len(vectors) * (len(vectors) - 1) // 2, side.tree.depth()


def closed(chunk: Side, threshold: float, eps: float, links: Links) -> Side:
    """`chunk` after it has met itself."""
    traverse(chunk, chunk, threshold, eps, links)
    return chunk


def near_duplicate_vectors(rows: DataFrame, threshold: float = THRESHOLD, chunk_rows: int = CHUNK_ROWS, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of `rows` (vec_id, label, embedding)."""
    vector = F.col("embedding").cast("array<double>")
    fine = usable(vector) & F.col("label").isNotNull() & F.exists(vector, lambda x: x != 0.0) & F.col("vec_id").isNotNull()
    rows = rows.select("vec_id", F.col("label").cast("string").alias("label"), vector.alias("vector"), F.coalesce(fine, F.lit(False)).alias("fine"))
    rows = rows.withColumn("key", F.when(F.col("fine"), F.concat_ws("|", F.size("vector"), "label")))
    rows = rows.withColumn("vector", F.when(F.col("fine"), F.col("vector")))
    with scratch(rows.sparkSession) as keep:
        told = keep(_told(rows, threshold, chunk_rows, sample_rows), "vectors-told")
    out = rows.where("fine").join(told, ["key", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _told(rows: DataFrame, threshold: float, chunk_rows: int, sample_rows: int) -> DataFrame:
    """key, vector, n_links, component_id of each distinct vector of `rows` (vec_id, key, vector, fine)."""
    folded = rows.where("fine").groupBy("key", "vector").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight"))
    # Rows that repeat an id with other vectors share the id; numbers tell them apart inside.
    folded = materialise(folded.withColumn("rid", F.monotonically_increasing_id()), "vectors-folded")
    counts, links = link_vectors(folded.select(F.col("rid").alias("id"), "key", "vector", "weight"), threshold, sample_rows, chunk_rows)
    counts = counts.withColumnRenamed("id", "rid")
    of_id = folded.select(F.col("rid"), "id")
    by_id = links.join(of_id.select(F.col("rid").alias("a"), F.col("id").alias("ia")), "a").join(of_id.select(F.col("rid").alias("b"), F.col("id").alias("ib")), "b")
    found = connected_components(by_id.select(F.col("ia").alias("a"), F.col("ib").alias("b")))
    told = folded.join(counts, "rid", "left").join(found, "id", "left")
    return told.select("key", "vector", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))


def op1_cover_tree_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All `embeddings`, linked within equal labels at a cosine of 0.98."""
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


OP1_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT r.vec_id, CAST((SELECT COUNT(*) FROM links l WHERE l.a = r.vec_id) AS BIGINT) AS n_links,
       MIN(other) AS component_id, r.vec_id = MIN(other) AS kept
FROM reach r GROUP BY r.vec_id
"""

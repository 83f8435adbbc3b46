"""Operator 2: sharding by best-fit-decreasing bin packing.

Groups (documents with equal text) are indivisible. They are packed largest first; each goes to the bin with the
tightest remaining capacity that still holds it, found in a balanced tree of remaining capacities.

The packing itself is sequential, so the driver packs a bounded summary instead of groups: sizes are rounded up to
SIGNIFICANT_BITS significant bits (below 2**SIGNIFICANT_BITS: exact), which leaves at most
2**(SIGNIFICANT_BITS - 1) classes for each power of two, whatever the number of groups. Groups of one class are
interchangeable, and best fit sends equal items to one bin until it is full, so a class is placed as runs
(class, first position, last position, bin). Executors number the groups of each class and look their run up.

Defined results: a null text has size 1 and forms one group with other null texts, apart from empty texts, which have
size 1 too; `text_crc32` of a null text is null. A group above the mean size gets a shard of its own and the rest is
balanced over the other shards. Repeated rows are copies of one group. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import ROWS_PER_BUCKET, hex_digits, materialise, number_rows, table

SIGNIFICANT_BITS = 12
#: Positions of a class that meet the runs among them in `shard_by_capacity`.
STRIDE = 4_096


class CapacityTree:
    """A treap of (remaining capacity, bin); priorities come from a hash of the bin, so runs repeat."""

    def __init__(self):
        self.root = None

    @staticmethod
    def _priority(bin_id: int) -> int:
        return (bin_id * 0x9E3779B97F4A7C15 + 0x7F4A7C15) % 2**64 * 0xBF58476D1CE4E5B9 % 2**64

    def _split(self, node, key):
        """Nodes below key, and the others."""
        left_end = right_end = None
        left = right = None
        while node is not None:
            if node[0] < key:
                if left_end is None:
                    left = node
                else:
                    left_end[3] = node
                left_end, node = node, node[3]
            else:
                if right_end is None:
                    right = node
                else:
                    right_end[2] = node
                right_end, node = node, node[2]
        if left_end is not None:
            left_end[3] = None
        if right_end is not None:
            right_end[2] = None
        return left, right

    def add(self, remaining: int, bin_id: int) -> None:
        key, priority = (remaining, bin_id), self._priority(bin_id)
        new, parent, side, node = [key, priority, None, None], None, 2, self.root
        while node is not None and node[1] >= priority:
            parent, side = node, 2 if key < node[0] else 3
            node = node[side]
        new[2], new[3] = self._split(node, key)
        if parent is None:
            self.root = new
        else:
            parent[side] = new

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the (remaining, bin) with the least remaining >= size."""
        found, found_parent, found_side = None, None, 2
        parent, side, node = None, 2, self.root
        while node is not None:
            if node[0][0] >= size:
                found, found_parent, found_side = node, parent, side
                parent, side = node, 2
            else:
                parent, side = node, 3
            node = node[side] if parent is not None else None
        if found is None:
            return None
        left, right = found[2], found[3]
        merged_parent, merged_side, merged = None, 2, None
        while left is not None or right is not None:
            pick = left if right is None or (left is not None and left[1] >= right[1]) else right
            if merged_parent is None:
                merged = pick
            else:
                merged_parent[merged_side] = pick
            if pick is left:
                merged_parent, merged_side, left = pick, 3, pick[3]
            else:
                merged_parent, merged_side, right = pick, 2, pick[2]
        if merged_parent is not None:
            merged_parent[merged_side] = None
        if found_parent is None:
            self.root = merged
        else:
            found_parent[found_side] = merged
        return found[0]


@dataclass(frozen=True)
class Run:
    size: int
    first: int
    last: int
    bin: int


def best_fit_decreasing(classes: list[tuple[int, int]], capacity: int, bins: int | None = None) -> tuple[list[Run], int] | None:
    """Pack `classes`, (size, count) with distinct sizes, into bins of `capacity`.

    A size above the capacity gets bins of its own. Returns the runs and the number of bins; None if more than
    `bins` would be needed.
    """
    tree, used, runs = CapacityTree(), 0, []
    for size, count in sorted(classes, reverse=True):
        placed = 0
        while placed < count:
            slot = tree.take_tightest(size)
            if slot is None:
                if bins is not None and used == bins:
                    return None
                slot, used = (max(capacity, size), used), used + 1
            remaining, bin_id = slot
            fits = min(count - placed, remaining // size)
            runs.append(Run(size, placed, placed + fits - 1, bin_id))
            placed += fits
            tree.add(remaining - fits * size, bin_id)
    return runs, used


def pack_into(classes: list[tuple[int, int]], shards: int) -> list[Run]:
    """Best-fit-decreasing into `shards` bins at the least capacity that a bisection finds to suffice.

    Groups above the mean of what is left get bins of their own first, or the capacity would follow the largest.
    """
    left, runs, free = dict(classes), [], list(range(shards))
    while left and len(free) > 1 and (top := max(left)) * len(free) > sum(s * n for s, n in left.items()):
        done = sum(r.last - r.first + 1 for r in runs if r.size == top)
        runs.append(Run(top, done, done, free.pop(0)))
        left[top] -= 1
        if not left[top]:
            del left[top]
    if not left:
        return runs
    total = sum(s * n for s, n in left.items())
    low, high, best = max(max(left), -(-total // len(free))) - 1, total, None
    best = best_fit_decreasing(list(left.items()), high, len(free))
    while high - low > max(1, total >> 24):
        middle = (low + high) // 2
        if found := best_fit_decreasing(list(left.items()), middle, len(free)):
            best, high = found, middle
        else:
            low = middle
    taken = {r.size: 0 for r in runs}
    for r in runs:
        taken[r.size] += r.last - r.first + 1
    return runs + [Run(r.size, r.first + taken.get(r.size, 0), r.last + taken.get(r.size, 0), free[r.bin]) for r in best[0]]


def size_class(size):
    """`size` rounded up to SIGNIFICANT_BITS significant bits, as a Column."""
    drop = F.greatest(F.lit(0), F.length(F.bin(size)) - SIGNIFICANT_BITS)
    step = F.pow(F.lit(2.0), drop).cast("long")
    return F.expr("1L") * F.ceil(size / step).cast("long") * step


def text_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32 and `grp`, 64 hex digits that equal texts share."""
    text = F.col(text_col)
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.coalesce(F.sha2(text.cast("binary"), 256), F.lit("null")).alias("grp"),
    )


def size_classes(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, list[tuple[int, int]]]:
    """The rows with their groups, the groups with their classes (both written), and the number of groups in each class."""
    base = materialise(text_groups(docs, id_col, text_col), "shard-base")
    groups = base.groupBy("grp").agg(F.sum("size").alias("bytes"))
    groups = materialise(groups.select("grp", size_class(F.col("bytes")).alias("class")), "shard-groups")
    histogram = groups.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()  # bounded: see the module's text
    return base, groups, [(r["class"], r.n) for r in histogram]


def table_of_runs(spark: SparkSession, runs: list[Run]) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.LongType() if n != "shard" else T.IntegerType(), False) for n in ("class", "first", "last", "shard")])
    return spark.createDataFrame([(r.size, r.first, r.last, r.bin) for r in runs], schema)


def positions(groups: DataFrame, digits: int) -> DataFrame:
    """`groups` with their number in the class as `position`."""
    return number_rows(groups.withColumn("bucket", F.substring("grp", 1, digits)), ["class"], "bucket", ["grp"], "position")


def shard_by_size(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, grp, shard and slot (gapless from 0 in each shard) of every row of `docs`."""
    base, groups, classes = size_classes(docs, id_col, text_col)
    digits = hex_digits(sum(n for _, n in classes))
    plan = table_of_runs(docs.sparkSession, pack_into(classes, shards))  # a few rows for each class
    placed = positions(groups, digits).join(F.broadcast(plan), "class").where(F.col("position").between(F.col("first"), F.col("last"))).select("grp", "shard")
    return with_slots(base.join(placed, "grp"), digits)


def with_slots(rows: DataFrame, digits: int, portion: int = ROWS_PER_BUCKET) -> DataFrame:
    """`rows` (doc_id, size, text_crc32, grp, shard) with slot, by a hash of id and text, gapless from 0 in each shard.

    Null and repeated ids lie in many buckets as their texts differ. Rows alike in everything are counted, numbered as
    one and written out again, those of a large count in portions.
    """
    names = [*rows.columns]
    bucket = F.substring(F.lower(F.lpad(F.hex(F.xxhash64("doc_id", "grp")), 16, "0")), 1, digits)
    alike = materialise(rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).withColumn("bucket", bucket), "shard-alike")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = alike.groupBy("shard", "bucket").agg(F.sum("n").alias("total")).select("shard", "bucket", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "grp").rowsBetween(Window.unboundedPreceding, -1)
    told = alike.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(offsets, ["shard", "bucket"])
    told = told.select(*names, "n", (F.col("before") + F.col("inside")).alias("start"))
    each = lambda df, first, last: df.withColumn("slot", F.explode(F.sequence(first, last))).select(*names, "slot")
    few = each(told.where(F.col("n") <= portion), F.col("start"), F.col("start") + F.col("n") - 1)
    cut = told.where(F.col("n") > portion).withColumn("from", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1, F.lit(portion).cast("long"))))
    many = each(cut.repartition("grp", "from"), F.col("from"), F.least(F.col("from") + portion, F.col("start") + F.col("n")) - 1)
    return few.unionByName(many)


def shard_by_capacity(docs: DataFrame, capacity: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, grp and shard of every row of `docs`, in as few shards of `capacity` bytes as best fit
    decreasing takes. A group above the capacity gets a shard of its own.

    Runs grow with the number of shards. They are cut at every STRIDE positions and joined on class and stretch, so
    that no run meets all groups of its class and no class is one task's.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    base, groups, classes = size_classes(docs, id_col, text_col)
    runs, _ = best_fit_decreasing(classes, capacity)
    stretch = F.explode(F.sequence(F.floor(F.col("first") / STRIDE), F.floor(F.col("last") / STRIDE)))
    plan = table_of_runs(docs.sparkSession, runs).withColumn("stretch", stretch)
    ranked = positions(groups, hex_digits(sum(n for _, n in classes))).withColumn("stretch", F.floor(F.col("position") / STRIDE))
    placed = ranked.join(plan.hint("merge"), ["class", "stretch"]).where(F.col("position").between(F.col("first"), F.col("last"))).select("grp", "shard")
    return base.join(placed, "grp").select("doc_id", "size", "text_crc32", "grp", "shard")


def op2_best_fit_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All `documents` in shards 0 to 7 of near equal bytes."""
    out = shard_by_size(table(spark, sf_dir, "documents"), 8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))

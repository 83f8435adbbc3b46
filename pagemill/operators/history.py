"""The visited history as files: URLs in parts of their sites, and Bloom filters that say which parts a round has to read.

Each batch of visited URLs is a generation: its URLs in files ordered by part, of which a scan reads only the pages of the parts
that it asks for, and for each part blocks of 32,768 bits. A URL
sets BITS bits of one block, so a lookup meets one block a generation in an equality join, and blocks are rows that Spark
spreads like any others. A candidate whose bits aren't all set hasn't been visited; for the others the parts that hold their
site's URLs are read, and a join decides. Filters never deny a URL that is there, so the result is exact.

A part holds whole sites, but a site lies in `spread` parts, and a large part in several files. Of FANOUT generations of a
level one of the next is made; a URL is so written again once a level, and there are at most FANOUT a level. One writer at a
time; a generation counts from when its filters are complete, and one that broke off is written anew.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import netloc
from .storage import children, exists, fresh_folder, remove, written

#: Bits that a URL sets in its block, and URLs a block is made for: ten bits a URL, under 2 % of others pass.
BITS, PER_BLOCK = 7, 3_276
BLOCK = 32_768
FANOUT = 8
URLS, SIZES, FILTERS = "url string, part int", "part int, n long, blocks long", "part int, block long, bits binary"


def block_of(url: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(url, F.lit("block")), blocks)


def bits_of(url: Column) -> Column:
    """The places in its block that a URL sets, by two hashes."""
    both = F.xxhash64(url, F.lit("bits"))
    start, step = both.bitwiseAND(BLOCK - 1), F.shiftright(both, 15).bitwiseAND(BLOCK - 1).bitwiseOR(1)
    return F.array(*[(start + step * i).bitwiseAND(BLOCK - 1) for i in range(BITS)])


def is_set(bits: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("getbit", byte, (at % 8).cast("int")) == 1


def in_ranges(column: Column, numbers: list[int]) -> Column:
    """`column` is one of `numbers`, as ranges: a scan skips by any number of them, where IN is held against least and greatest."""
    numbers = sorted(numbers)
    starts = [n for i, n in enumerate(numbers) if i == 0 or n != numbers[i - 1] + 1]
    ends = [n for i, n in enumerate(numbers) if i == len(numbers) - 1 or n != numbers[i + 1] - 1]
    tests = [column.between(a, b) for a, b in zip(starts, ends)]
    while len(tests) > 1:  # as a balanced tree
        tests = [reduce(Column.__or__, tests[i : i + 2]) for i in range(0, len(tests), 2)]
    return tests[0]


class VisitedHistory:
    """J11, K2 over files in `path`. `sites` and `spread` are fixed by whoever makes the history; their product bounds the parts."""

    def __init__(self, spark: SparkSession, path: str, sites: int = 128, spread: int = 4):
        self.spark, self.path, self.sites, self.spread = spark, path.rstrip("/"), sites, spread

    def part(self, url: Column) -> Column:
        site = F.pmod(F.xxhash64(F.lower(netloc(url))), F.lit(self.sites))
        return (site * self.spread + F.pmod(F.xxhash64(url), F.lit(self.spread))).cast("int")

    def generations(self) -> list[tuple[int, int, int]]:
        """(first batch, last batch, level) of the complete generations that no other takes in."""
        found = [tuple(map(int, p.rsplit("/", 1)[-1].split("-"))) for p in children(self.spark, self.path)]
        found = [g for g in found if exists(self.spark, f"{self._at(g)}/filters/_SUCCESS")]
        return sorted(g for g in found if not any(o != g and o[0] <= g[0] and g[1] <= o[1] for o in found))

    def _at(self, generation: tuple[int, int, int]) -> str:
        return f"{self.path}/{generation[0]}-{generation[1]}-{generation[2]}"

    def add(self, urls: DataFrame, batch: int) -> None:
        """The URLs (url; null ones aren't any) of a batch; numbers grow from batch to batch. One that is there already is
        written anew, unless a later batch has merged it."""
        merged = [g for g in self.generations() if g[0] <= batch <= g[1] and g[2] > 0]
        if merged:
            return
        self._merge(batch)
        self._write(urls, (batch, batch, 0))

    def _merge(self, before: int) -> None:
        """Of FANOUT generations of a level, all older than `before`, one of the next; what merges took in goes."""
        while True:
            live = self.generations()
            level = next((x for x in sorted({g[2] for g in live}) if sum(g[2] == x and g[1] < before for g in live) >= FANOUT), None)
            if level is None:
                break
            old = [g for g in live if g[2] == level and g[1] < before]
            self._write(reduce(DataFrame.union, [self._urls(g) for g in old]).select("url"), (old[0][0], old[-1][1], level + 1))
        for path in children(self.spark, self.path):
            first, last, _ = map(int, path.rsplit("/", 1)[-1].split("-"))
            if last < before and not any(path.endswith(self._at(g).rsplit("/", 1)[-1]) for g in live) and any(g[0] <= first and last <= g[1] for g in live):
                remove(self.spark, path)

    def _write(self, urls: DataFrame, generation: tuple[int, int, int]) -> None:
        at = self._at(generation)
        remove(self.spark, f"{at}/filters")  # from here on the generation doesn't count until its filters are there again
        kept = fresh_folder(self.spark, "history")
        urls.where("url is not null").select("url").distinct().withColumn("part", self.part(F.col("url"))).write.parquet(kept)
        rows = self.spark.read.schema(URLS).parquet(kept)
        rows.repartitionByRange("part", "url").sortWithinPartitions("part", "url").write.mode("overwrite").parquet(f"{at}/urls")
        counts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
        counts.withColumn("blocks", F.ceil(F.col("n") / PER_BLOCK)).coalesce(1).write.mode("overwrite").parquet(f"{at}/sizes")
        sizes = self.spark.read.schema(SIZES).parquet(f"{at}/sizes")
        placed = rows.join(F.broadcast(sizes), "part").select("part", block_of(F.col("url"), F.col("blocks")).alias("block"), F.explode(bits_of(F.col("url"))).alias("bit"))
        placed.groupBy("part", "block").agg(F.bitmap_construct_agg("bit").alias("bits")).write.mode("overwrite").parquet(f"{at}/filters")
        remove(self.spark, kept)

    def _urls(self, generation: tuple[int, int, int]) -> DataFrame:
        return self.spark.read.schema(URLS).parquet(f"{self._at(generation)}/urls")

    def _all(self, name: str, schema: str, live: list[tuple[int, int, int]]) -> DataFrame:
        tables = [self.spark.read.schema(schema).parquet(f"{self._at(g)}/{name}").withColumn("first", F.lit(g[0]).cast("long")) for g in live]
        return reduce(DataFrame.union, tables) if tables else self.spark.createDataFrame([], f"{schema}, first long")

    def _live(self, before: int | None) -> list[tuple[int, int, int]]:
        live = [g for g in self.generations() if before is None or g[0] < before]
        if any(before is not None and g[1] >= before for g in live):
            raise ValueError(f"batches from {before} on are merged with earlier ones")
        return live

    def maybe(self, candidates: DataFrame, before: int | None = None) -> DataFrame:
        """url, first, part: the candidates that the filters can't deny, with the generation and part that may hold them."""
        return self._met(self._asked(candidates), self._live(before))

    def _asked(self, candidates: DataFrame) -> DataFrame:
        return candidates.where("url is not null").select("url").distinct().withColumn("part", self.part(F.col("url")))

    def _met(self, asked: DataFrame, live: list[tuple[int, int, int]]) -> DataFrame:
        # A row for each part and generation: parts are bounded, generations grow with the logarithm of the batches.
        asked = asked.join(F.broadcast(self._all("sizes", SIZES, live)), "part").withColumn("block", block_of(F.col("url"), F.col("blocks")))
        met = asked.join(self._all("filters", FILTERS, live), ["first", "part", "block"])
        return met.where(F.forall(bits_of(F.col("url")), lambda at: is_set(F.col("bits"), at))).select("url", "first", "part")

    def _whole(self, asked: DataFrame, live: list[tuple[int, int, int]]) -> list[int]:
        """The parts that are read without their filters, as that takes fewer rows: a lookup is a row for each candidate and
        generation, and reading a part has a row for each of its URLs."""
        sizes = self._all("sizes", SIZES, live).groupBy("part").agg(F.sum("n").alias("held"), F.count(F.lit(1)).alias("generations"))
        counts = asked.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
        return [r[0] for r in counts.join(sizes, "part").where("held <= n * generations").select("part").collect()]  # parts are bounded

    def seen(self, candidates: DataFrame, before: int | None = None) -> DataFrame:
        """url: the candidates that batches (those below `before`) have visited, once each."""
        live = self._live(before)
        asked = written(self._asked(candidates), "history-asked")
        whole = self._whole(asked, live)
        rest = asked.where(~F.col("part").isin(whole)) if whole else asked
        maybe = written(self._met(rest, live), "history-maybe")
        touched: dict[int, list[int]] = {}
        for first, part in sorted((r[0], r[1]) for r in maybe.select("first", "part").distinct().collect()):  # bounded as the sizes are
            touched.setdefault(first, []).append(part)
        parts = {g: sorted({*whole, *touched.get(g[0], [])}) for g in live}
        read = [self._urls(g).where(in_ranges(F.col("part"), p)).select("url") for g, p in parts.items() if p]
        found = maybe.select("url").distinct()
        if whole:
            found = found.unionByName(asked.where(F.col("part").isin(whole)).select("url"))
        return found.join(reduce(DataFrame.union, read), "url", "left_semi") if read else found

    def share_read(self, candidates: DataFrame, before: int | None = None) -> float:
        """The share of the history's rows that `seen` reads for these candidates."""
        sizes = self._all("sizes", SIZES, self._live(before))
        touched = self.maybe(candidates, before).select("first", "part").distinct().withColumn("read", F.lit(True))
        n, all_n = sizes.join(touched, ["first", "part"], "left").agg(F.sum(F.when(F.col("read"), F.col("n"))), F.sum("n")).first()
        return (n or 0) / all_n if all_n else 0.0

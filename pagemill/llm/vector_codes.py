"""Operator 13: vectors compressed to one byte a part, with annular norm pruning.

A vector of integers floor(1024 * x) is cut into equal consecutive parts; each part becomes the index of the nearest entry
of its position's codebook. Codebooks start as the parts of the first vectors by id and follow the mean of what they were
given for some rounds; sums and counts are whole numbers, added up by Spark, so reruns agree.

The nearest entry is found exactly. By the triangle inequality an entry whose norm differs from the part's by more
than the distance reached so far can't be nearer. Entries are sorted by norm; a part first meets the NEIGHBOURS entries of
nearest norm, then binary search gives the interval that its distance allows (both ends included, and widened by
the rounding of a square root), and what lies in it is evaluated, interval and distance shrinking from block to block.
Distances are whole numbers below 2**53 in doubles where the components allow, else Python's integers.

What each round sends to the driver and back are the codebooks: parts * ENTRIES vectors, whatever the input.

Defined results: vectors that are null or hold null or non-finite components are left out. Shorter vectors are filled up
with zeros to the longest, rounded up to a multiple of the parts. Components beyond 2**62 are cut to it, sums of
errors beyond the long range to that. Rows that repeat an id are all coded; the codebooks start from the least vector of
each of the smallest ids, and with fewer ids than ENTRIES have fewer entries. A null id is coded, but starts no entry;
without any id code and errors are null. Of several nearest entries the lowest index counts. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import materialise, slices, table, tidy
from ._vectors import matrix, usable

PARTS, ENTRIES, ROUNDS = 4, 256, 4
SCALE = 1024.0
BATCH = 1024
#: Entries of nearest norm that a part meets first, and entries of a block.
NEIGHBOURS, BLOCK = 8, 32
MOST = 2.0**62
LONG = 2**63 - 1
#: Rows of the table of errors by label up to which it is sent to all executors.
FEW_LABELS = 65_536
SALTS = 16


def scaled(vectors: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(vectors * SCALE), -MOST, MOST)


class Codebook:
    """The entries of one part position, by norm."""

    def __init__(self, entries: list[list[int]]):
        self.exact = np.array(entries, dtype=object).reshape(len(entries), -1)
        plain = self.exact.astype(np.float64)
        norms = np.sqrt((plain * plain).sum(axis=1))
        self.order = np.argsort(norms, kind="stable")
        self.norms, self.sorted = norms[self.order], plain[self.order]
        self.squares = (self.sorted * self.sorted).sum(axis=1)
        self.largest = float(np.abs(plain).max(initial=0.0))

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """For each of `rows` the index of the nearest entry, the squared distance and, for all, the entries evaluated."""
        largest = max(self.largest, float(np.abs(rows).max(initial=0.0)))
        if rows.shape[1] * (2 * largest) ** 2 >= 2.0**53:
            return self._nearest_large(rows)
        n, k = len(rows), len(self.norms)
        squares = (rows * rows).sum(axis=1)
        norms = np.sqrt(squares)
        near = min(NEIGHBOURS, k)
        first = np.clip(np.searchsorted(self.norms, norms) - near // 2, 0, k - near)
        some = first[:, None] + np.arange(near)
        found = squares[:, None] - 2 * np.einsum("ij,ikj->ik", rows, self.sorted[some]) + self.squares[some]
        names = self.order[some]
        best = found.min(axis=1)
        index = np.where(found == best[:, None], names, k).min(axis=1)
        evaluated = n * near
        low, high = self.interval(norms, best)
        for start in range(0, k, BLOCK):
            stop = min(start + BLOCK, k)
            hit = np.flatnonzero((low < stop) & (high > start))
            if not len(hit):
                continue
            d = squares[hit, None] - 2 * (rows[hit] @ self.sorted[start:stop].T) + self.squares[start:stop]
            place = np.arange(start, stop)
            inside = (place >= low[hit, None]) & (place < high[hit, None])
            evaluated += int(inside.sum())
            d = np.where(inside, d, np.inf)
            least = d.min(axis=1)
            name = np.where(d == least[:, None], self.order[start:stop], k).min(axis=1)
            nearer = (least < best[hit]) | (least == best[hit]) & (name < index[hit])
            best[hit] = np.where(nearer, least, best[hit])
            index[hit] = np.where(nearer, name, index[hit])
            low[hit], high[hit] = self.interval(norms[hit], best[hit])
        return index, best, evaluated

    def interval(self, norms: np.ndarray, squared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entries that a row of this norm may still be as near to as `squared`, ends included."""
        d = np.sqrt(squared)
        slack = 1e-9 * (norms + d) + 1e-9
        return np.searchsorted(self.norms, norms - d - slack, side="left"), np.searchsorted(self.norms, norms + d + slack, side="right")

    def _nearest_large(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """As `nearest` in Python's integers, row by row, outwards from the entry of nearest norm."""
        index, best, evaluated = np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows), dtype=object), 0
        for i, row in enumerate(rows):
            values = [int(x) for x in row]
            norm = float(np.sqrt((row * row).sum()))
            places = np.argsort(np.abs(self.norms - norm), kind="stable")
            least, name = None, len(self.norms)
            for p in places:
                gap = abs(float(self.norms[p]) - norm)
                if least is not None and gap > float(least) ** 0.5 * (1 + 1e-9) + 1e-9 * norm:
                    break
                e = int(self.order[p])
                d = sum((a - b) ** 2 for a, b in zip(values, self.exact[e], strict=True))
                evaluated += 1
                if least is None or d < least or d == least and e < name:
                    least, name = d, e
            index[i], best[i] = name, least
        return index, best, evaluated


def parts_of(batch: pa.RecordBatch, width: int, parts: int) -> np.ndarray:
    return scaled(matrix(batch.column("vector"), width)).reshape(batch.num_rows, parts, width // parts)


def first_entries(rows: DataFrame, width: int, parts: int, entries: int) -> list[list[list[int]]]:
    """For each part position the parts of the vectors with the smallest ids."""
    ids = [r[0] for r in rows.where("id is not null").select("id").distinct().orderBy("id").limit(entries).collect()]  # ENTRIES at most
    if not ids:
        return [[] for _ in range(parts)]
    firsts = rows.where(F.col("id").isin(ids)).groupBy("id").agg(F.min("vector").alias("vector")).orderBy("id").toArrow().to_batches()
    cut = np.concatenate([parts_of(b, width, parts) for b in firsts if b.num_rows])
    return [[[int(x) for x in v] for v in cut[:, p]] for p in range(parts)]


def next_entries(rows: DataFrame, books: list[list[list[int]]], width: int, parts: int) -> list[list[list[int]]]:
    """The codebooks after a round: each entry the floored mean of the parts nearest to it; unused ones stay."""
    shared = rows.sparkSession.sparkContext.broadcast(books)

    @tidy
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [Codebook(b) for b in shared.value]
        shape = (parts, len(shared.value[0]), width // parts)
        small, large, counts = np.zeros(shape, dtype=np.int64), np.zeros(shape, dtype=object), np.zeros(shape[:2], dtype=np.int64)
        held = 0.0
        for batch in slices(batches, BATCH):
            cut = parts_of(batch, width, parts)
            top = float(np.abs(cut).max(initial=0.0))
            for p, book in enumerate(known):
                index, _, _ = book.nearest(cut[:, p])
                counts[p] += np.bincount(index, minlength=shape[1])
                if top < 2.0**31:
                    np.add.at(small[p], index, cut[:, p].astype(np.int64))
                else:
                    for i, row in zip(index, cut[:, p], strict=True):
                        large[p, i] += np.array([int(x) for x in row], dtype=object)
            held += top * batch.num_rows if top < 2.0**31 else 0.0
            if held > 2.0**61:
                large, small, held = large + small.astype(object), np.zeros_like(small), 0.0
        used = np.argwhere(counts > 0)
        if len(used):
            total = (large + small.astype(object))[used[:, 0], used[:, 1]]
            wide = shape[2]
            columns = [np.repeat(used[:, 0], wide), np.repeat(used[:, 1], wide), np.tile(np.arange(wide), len(used))]
            values = pa.array([int(x) for x in total.reshape(-1)], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([*[pa.array(c.astype(np.int32)) for c in columns], values, pa.array(np.repeat(counts[used[:, 0], used[:, 1]], wide))], names=["part", "entry", "place", "total", "n"])

    sums = rows.select("vector").mapInArrow(add, "part int, entry int, place int, total decimal(38,0), n long")
    sums = sums.groupBy("part", "entry", "place").agg(F.sum("total").cast("decimal(38,0)").alias("total"), F.sum("n").alias("n"))
    out = [[list(e) for e in b] for b in books]
    for r in sums.collect():  # a row for each component of the codebooks
        out[r["part"]][r["entry"]][r["place"]] = int(r["total"]) // r["n"]
    return out


def with_codes(rows: DataFrame, books: list[list[list[int]]], width: int, parts: int) -> DataFrame:
    """`rows` (id, vector, label) as id, label, code, error and evaluated (entries compared for the row's batch, spread over it)."""
    shared = rows.sparkSession.sparkContext.broadcast(books)

    @tidy
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [Codebook(b) for b in shared.value]
        for batch in slices(batches, BATCH):
            cut = parts_of(batch, width, parts)
            names, errors, compared = [], [0] * batch.num_rows, 0
            for p, book in enumerate(known):
                index, squared, evaluated = book.nearest(cut[:, p])
                names.append(index)
                errors = [a + int(b) for a, b in zip(errors, squared, strict=True)]
                compared += evaluated
            codes = [bytes(c).hex() for c in np.array(names).T.astype(np.uint8)]
            share = np.full(batch.num_rows, compared / max(1, batch.num_rows))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(codes), pa.array([min(LONG, e) for e in errors], pa.int64()), pa.array(share)], names=["id", "label", "code", "error", "evaluated"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.select("id", "label", "vector").mapInArrow(code, f"id {kinds['id']}, label {kinds['label']}, code string, error long, evaluated double")


def codebooks_digest(books: list[list[list[int]]]) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


def with_label_errors(coded: DataFrame) -> DataFrame:
    """`coded` with label_error. A large label's rows meet its sum in many tasks."""
    limit = F.lit(LONG).cast("decimal(38,0)")
    sums = coded.groupBy("label").agg(F.least(limit, F.sum(F.col("error").cast("decimal(28,0)"))).cast("long").alias("label_error"))
    sums = materialise(sums.select(F.col("label").alias("of"), "label_error"), "label-errors")
    if sums.count() <= FEW_LABELS:
        return coded.join(F.broadcast(sums), coded["label"].eqNullSafe(sums["of"])).drop("of")
    dealt = sums.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = coded.withColumn("at", F.pmod(F.xxhash64("id", "code"), F.lit(SALTS)).cast("int"))
    return salted.join(dealt, salted["label"].eqNullSafe(dealt["of"]) & (salted["at"] == dealt["salt"])).drop("of", "salt", "at")


def compressed(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[list[list[int]]]]:
    """(`vectors` (id, vector, label) with code, error, label_error and evaluated, the codebooks by part, entry and place)."""
    rows = vectors.where(usable(F.col("vector"))).select("id", "label", F.col("vector").cast("array<double>").alias("vector"))
    widest = rows.agg(F.max(F.size("vector"))).first()[0]
    width = -(-max(1, widest or 0) // parts) * parts
    books = first_entries(rows, width, parts, entries)
    if not books[0]:
        nothing = F.lit(None)
        return rows.select("id", "label", nothing.cast("string").alias("code"), nothing.cast("long").alias("error"), nothing.cast("double").alias("evaluated"), nothing.cast("long").alias("label_error")), books
    for _ in range(rounds):
        books = next_entries(rows, books, width, parts)
    coded = materialise(with_codes(rows, books, width, parts), "vector-codes")
    return with_label_errors(coded), books


def op13_annular_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The codes of all usable rows of `embeddings`."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")
    found, books = compressed(rows)
    return found.select(F.col("id").alias("vec_id"), "code", "error", "label_error", _digest(books).alias("codebooks_sha256"))


def _digest(books: list[list[list[int]]]) -> Column:
    return F.lit(codebooks_digest(books))


def _sql() -> str:
    """The rounds one after the other; each has its assignment and its codebook."""
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""
a{r} AS (
  SELECT p.id, p.part, min(struct_pack(d := CAST(list_sum(list_transform(list_zip(p.x, e.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT), entry := e.entry)) AS m
  FROM cut p JOIN e{r} e USING (part) GROUP BY p.id, p.part)""")
        if r < ROUNDS:
            steps.append(f"""
s{r} AS (
  SELECT part, entry, list(y ORDER BY place) AS x FROM (
    SELECT a.part, a.m.entry AS entry, place, CAST(floor(sum(p.x[place]) / count(*)) AS BIGINT) AS y
    FROM a{r} a JOIN cut p USING (id, part), (SELECT unnest(range(1, {64 // PARTS + 1})) AS place) GROUP BY ALL) GROUP BY part, entry),
e{r + 1} AS (SELECT part, entry, coalesce(s.x, e.x) AS x FROM e{r} e LEFT JOIN s{r} s USING (part, entry))""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS id, vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS MATERIALIZED (SELECT id, vec_id, part, q[part * {64 // PARTS} + 1 : (part + 1) * {64 // PARTS}] AS x FROM v, range({PARTS}) k(part)),
e0 AS (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x
  FROM cut QUALIFY row_number() OVER (PARTITION BY part ORDER BY vec_id) <= {ENTRIES}),{",".join(steps).replace(" AS (", " AS MATERIALIZED (")},
done AS (
  SELECT id, string_agg(lpad(to_hex(m.entry), 2, '0'), '' ORDER BY part) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY id)
SELECT v.vec_id, lower(d.code) AS code, d.error, CAST(sum(d.error) OVER (PARTITION BY v.label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) FROM e{ROUNDS}) AS codebooks_sha256
FROM v JOIN done d USING (id)
"""


OP13_SQL = _sql()

"""Operator 9: near-duplicate documents by Order MinHash.

A document's k-mers are its shingles of SHINGLE words (lower-cased runs of letters, digits and underscores), each labelled
with its occurrence number (Marçais et al., Locality-sensitive hashing for the edit distance, 2019). For each of BANDS
hash functions the ORDER labelled shingles of least hash are taken and kept in text order; their hash is a bucket. Documents of one
bucket are candidates, verified by a banded alignment: labelled shingles that both documents hold are matched, matches
off the diagonal by more than the threshold allows are dropped (no alignment through them can reach it), and the
longest increasing chain L of the others gives the similarity L / (a + b - L), at least SIMILARITY for a link. That is
the Jaccard similarity of the shingles with their order respected. A pair at the threshold shares a bucket of one hash
function with a probability of C(c, 3) / C(u, 3), c of its u shingles being common: 0.40 for u = 5, 0.50 for u = 25, 0.51
beyond. So documents of at most SHORT shingles get SHORT_BANDS hash functions, and no pair at the threshold is without a
common bucket more often than about 2e-5.

Copies (equal words) are folded first, whatever their ids, and all that follows knows each text once. Large groups of near copies never become all pairs: each document is first
verified against one hub, the least document of the buckets that it shares most often. Where a bucket still holds more
than one component, its documents outside the largest one meet all others there: shingles are sent once for each
distinct bucket, large buckets are cut into chunks, a task counts the common shingles of blocks of documents by a
product of 0/1 matrices, and pairs that can reach the threshold and whose components still differ are aligned. So every
candidate pair is verified or lies within one component already, no link between components is lost, and no pairs are
written but links that join components.

Defined results: a text of fewer than SHINGLE words has one shingle, all of its words; a text without words links with
equal texts only; a null text or null id links with nothing (class_id: its own id). Repeated rows get one class; an id
with several texts gets the least of their classes. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import materialise, scratch, slices, table, tidy
from ._vectors import runs
from .components import connected_components

SHINGLE = 5
SIMILARITY = 0.8
ORDER = 3
BANDS = 16
#: Documents of few shingles share fewer buckets at the same similarity.
SHORT, SHORT_BANDS = 16, 24
SEED = 20_190_707
#: Shingles of one chunk of a bucket; documents and columns of one product.
CHUNK_SHINGLES = 1 << 18
GUESTS, HOSTS, COLUMNS = 256, 2_048, 2_048
#: Shingles of a document, and characters of words, that are hashed at a time.
PIECE = 1 << 16
#: Characters of the texts that are taken together.
PORTION = 1 << 20
GOLDEN = np.uint64(0x9E3779B97F4A7C15)

_in_words: np.ndarray | None = None


def in_words() -> np.ndarray:
    """For each code point whether it is a letter, digit or underscore."""
    global _in_words
    if _in_words is None:
        _in_words = np.fromiter((chr(c).isalnum() or c == 0x5F for c in range(0x110000)), dtype=bool, count=0x110000)
    return _in_words


def portions(texts: list[str]) -> Iterator[slice]:
    """Ranges of `texts` of at most PORTION characters, or of one text."""
    start = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > PORTION:
            yield slice(start, i)
            start, held = i, 0
        held += len(text) + 1
    if texts:
        yield slice(start, len(texts))


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str]) -> tuple[list[np.ndarray], list[bytes]]:
    """The hashes of each text's words in text order, and a digest that texts of equal words share.

    A word's hash is the sum of its characters' hashes at their places, mixed with its length.
    """
    lowered = [t.lower() for t in texts]
    points = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    inside = in_words()[points]
    first = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    # Every word has a character behind it, as each text is followed by a line end.
    behind = ~inside & np.concatenate([[False], inside[:-1]])
    sizes = np.flatnonzero(behind) - first
    hashes, ends, at = np.zeros(len(first), dtype=np.uint64), np.cumsum(sizes), 0
    while at < len(first):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] - sizes[at] + PIECE, side="right")))
        n = sizes[at:to]
        begin = np.cumsum(n) - n
        place = np.arange(n.sum()) - np.repeat(begin, n)
        codes = points[np.repeat(first[at:to], n) + place].astype(np.uint64)
        hashes[at:to] = np.add.reduceat(mixed(codes + (place.astype(np.uint64) + np.uint64(1)) * GOLDEN), begin)
        at = to
    hashes = mixed(hashes + sizes.astype(np.uint64))
    stops = np.cumsum([len(t) + 1 for t in lowered]).tolist()
    words = np.searchsorted(first, stops).tolist()
    shown, kept = np.where(inside, points, np.uint32(0x20)), inside | behind
    out, digests, start, word = [], [], 0, 0
    for text, stop, last in zip(texts, stops, words, strict=True):
        if last > word:
            digest = hashlib.blake2b(shown[start:stop][kept[start:stop]].tobytes(), digest_size=16)
        else:
            digest = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16, person=b"no words")
        out.append(hashes[word:last])
        digests.append(digest.digest())
        start, word = stop, last
    return out, digests


def shingles_of(texts: list[str]) -> list[np.ndarray]:
    return [labelled_shingles(h) for h in word_hashes(texts)[0]]


def labelled_shingles(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the shingles of words with these `hashes`, in text order; the same shingle's occurrences differ."""
    if not len(hashes):
        return np.zeros(0, dtype=np.uint64)
    n = max(1, len(hashes) - size + 1)
    out = hashes[:n].copy() if len(hashes) >= size else np.array([len(hashes)], dtype=np.uint64)
    for k in range(1 if len(hashes) >= size else 0, min(size, len(hashes))):
        out = mixed(out) + hashes[k : k + n]
    out = mixed(out)
    order = np.argsort(out, kind="stable")
    same = np.concatenate([[False], out[order][1:] == out[order][:-1]])
    if same.any():
        at = np.arange(n)
        occurrence = at - np.maximum.accumulate(np.where(same, 0, at))
        label = np.zeros(n, dtype=np.uint64)
        label[order] = occurrence.astype(np.uint64)
        out = mixed(out + label * GOLDEN)
    return out


def band_factors(bands: int = BANDS) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(SEED)).integers(0, 2**64, bands, dtype=np.uint64) | np.uint64(1)


def order_minhash(shingles: np.ndarray, factors: np.ndarray, order: int = ORDER, first: int = 0) -> np.ndarray:
    """One bucket for each factor: the hash of the `order` least shingles in text order."""
    least = np.zeros((len(factors), 0), dtype=np.int64)
    for start in range(0, len(shingles), PIECE):
        part = np.arange(start, min(start + PIECE, len(shingles)))
        at = np.concatenate([least, np.broadcast_to(part, (len(factors), len(part)))], axis=1) if least.shape[1] or start else None
        values = shingles[part][None, :] * factors[:, None] if at is None else shingles[at] * factors[:, None]
        take = min(order, values.shape[1])
        chosen = np.argpartition(values, take - 1, axis=1)[:, :take]
        least = chosen + start if at is None else np.take_along_axis(at, chosen, axis=1)
    least = np.sort(least, axis=1)
    bucket = np.arange(first, first + len(factors), dtype=np.uint64)
    for k in range(least.shape[1]):
        bucket = mixed(bucket + shingles[least[:, k]])
    return bucket


def bucket_lists(shingles: list[np.ndarray], factors: np.ndarray, order: int = ORDER, first: int = 0) -> list[np.ndarray]:
    """`order_minhash` of each document, none for those without shingles; documents of middling length go together.
    `first` is the number of the first band."""
    out = [np.zeros(0, dtype=np.uint64)] * len(shingles)
    together = [i for i, x in enumerate(shingles) if order < len(x) <= PIECE]
    made = np.zeros((len(together), len(factors)), dtype=np.uint64)
    if together:
        flat, sizes = np.concatenate([shingles[i] for i in together]), np.array([len(shingles[i]) for i in together])
        begin = np.cumsum(sizes) - sizes
    for band, factor in enumerate(factors if together else ()):
        values, least = flat * factor, []
        for _ in range(order):
            at = np.flatnonzero(values == np.repeat(np.minimum.reduceat(values, begin), sizes))
            values[at] = np.uint64(2**64 - 1)
            least.append(at)
        if any(len(at) != len(together) for at in least):  # two shingles of a document have one hash
            together = []
            break
        bucket = np.full(len(together), first + band, dtype=np.uint64)
        for at in np.sort(np.stack(least), axis=0):
            bucket = mixed(bucket + flat[at])
        made[:, band] = bucket
    for i, buckets in zip(together, made, strict=False):
        out[i] = buckets
    for i in set(range(len(shingles))).difference(together):
        if len(shingles[i]):
            out[i] = order_minhash(shingles[i], factors, order, first)
    return out


def aligned(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether the banded alignment of two labelled shingle sequences reaches `similarity`."""
    total = len(a) + len(b)
    enough = similarity / (1 + similarity) * total - 1e-9
    if not len(a) or not len(b) or min(len(a), len(b)) < enough:
        return False
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    near = np.abs(i - j) <= total - 2 * enough + 1e-6
    if near.sum() < enough:
        return False
    j = j[near][np.argsort(i[near])]
    if (j[1:] > j[:-1]).all():
        return True
    tails: list[int] = []
    for x in j.tolist():
        at = bisect_left(tails, x)
        tails[at:at + 1] = [x]
    return len(tails) >= enough


def sketches(docs: DataFrame) -> DataFrame:
    """`docs` (id, text), both not null: id, tkey (of the text), digest (of the words), n shingles and buckets."""
    packed = docs.select("id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("tkey"), "text")

    @tidy
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = band_factors(SHORT_BANDS)
        for batch in slices(batches):
            digests, counts, buckets = [], [], []
            texts = batch.column("text").to_pylist()
            for some in portions(texts):
                hashes, shown = word_hashes(texts[some])
                shingles = [labelled_shingles(h) for h in hashes]
                digests += shown
                counts += [len(x) for x in shingles]
                lists = bucket_lists(shingles, factors[:BANDS])
                few = [i for i, x in enumerate(shingles) if 0 < len(x) <= SHORT]
                for i, more in zip(few, bucket_lists([shingles[i] for i in few], factors[BANDS:], first=BANDS), strict=True):
                    lists[i] = np.concatenate([lists[i], more])
                buckets += [x.view(np.int64) for x in lists]
            out = [batch.column("id"), batch.column("tkey"), pa.array(digests, pa.binary()), pa.array(counts, pa.int64()), pa.array(buckets, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(out, names=["id", "tkey", "digest", "n", "buckets"])

    return packed.mapInArrow(sketch, "id long, tkey binary, digest binary, n long, buckets array<long>")


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The `pairs` (a, b) whose `texts` (id, text; ids are unique) are aligned."""
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")

    @tidy
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            one, two, keep = batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist(), []
            for some in portions([x + y for x, y in zip(one, two, strict=True)]):
                hubs = list(dict.fromkeys(two[some]))
                known = dict(zip(hubs, shingles_of(hubs), strict=True))
                keep += [aligned(x, known[y], similarity) for x, y in zip(shingles_of(one[some]), two[some], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(keep, pa.bool_())), batch.column("b").filter(pa.array(keep, pa.bool_()))], names=["a", "b"])

    return both.select("a", "b", "text_a", "text_b").mapInArrow(verify, "a long, b long")


class Held:
    """Documents with their components and shingles."""

    def __init__(self, batch: pa.RecordBatch):
        self.ids, self.components = batch.column("id").to_numpy(), batch.column("component").to_numpy()
        lists = batch.column("shingles")
        self.sizes = np.asarray(lists.value_lengths(), dtype=np.int64)
        self.flat = lists.flatten().to_numpy().view(np.uint64)
        self.ends = np.cumsum(self.sizes)
        self.owner = np.repeat(np.arange(len(self.ids)), self.sizes)

    def shingles(self, i: int) -> np.ndarray:
        return self.flat[self.ends[i] - self.sizes[i] : self.ends[i]]

    def dense(self, columns: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(columns, self.flat), len(columns) - 1)
        mine = columns[at] == self.flat
        out = np.zeros((len(self.ids), len(columns)), dtype=np.float32)
        out[self.owner[mine], at[mine]] = 1
        return out


def common_shingles(a: Held, b: Held) -> np.ndarray:
    """How many shingles each document of `a` shares with each of `b`."""
    out = np.zeros((len(a.ids), len(b.ids)), dtype=np.float32)
    columns = np.intersect1d(a.flat, b.flat)
    for start in range(0, len(columns), COLUMNS):
        some = columns[start : start + COLUMNS]
        out += a.dense(some) @ b.dense(some).T
    return out


class Roots(dict):
    """Components that this chunk has joined."""

    def find(self, x: int) -> int:
        while (up := self.get(x, x)) != x:
            self[x] = x = self.get(up, up)
        return x


def join_components(guests: Held, hosts: Held, roots: Roots, similarity: float) -> list[tuple[int, int]]:
    """Verified links between documents whose components differ until then."""
    enough = similarity / (1 + similarity) * (guests.sizes[:, None] + hosts.sizes[None, :])
    common = common_shingles(guests, hosts)
    near = (common >= enough - 1e-3) & (guests.components[:, None] != hosts.components[None, :])
    out = []
    for i in np.flatnonzero(near.any(axis=1)).tolist():
        own = int(guests.components[i])
        hits = np.flatnonzero(near[i])
        for j in hits[np.argsort(-common[i, hits], kind="stable")].tolist():
            other = int(hosts.components[j])
            if roots.find(own) != roots.find(other) and aligned(guests.shingles(i), hosts.shingles(j), similarity):
                roots[roots.find(own)] = roots.find(other)
                out.append((int(guests.ids[i]), int(hosts.ids[j])))
    return out


def links_within(entries: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between the components that meet in a bucket; `entries`: band, bucket, id, n, component."""
    entries = entries.dropDuplicates(["band", "bucket", "id"])
    components = entries.groupBy("band", "bucket", "component").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"))
    buckets = components.groupBy("band", "bucket").agg(
        F.count(F.lit(1)).alias("parts"), F.max(F.struct("size", "component"))["component"].alias("major"),
        F.sum("size").alias("size"), F.ceil(F.sum("n") / CHUNK_SHINGLES).cast("int").alias("chunks"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"),
    ).where("parts > 1")
    # Buckets of the same documents count once.
    buckets = buckets.groupBy("size", "x", "y").agg(F.min(F.struct("band", "bucket", "major", "chunks")).alias("b")).select("b.*")
    seats = entries.join(buckets, ["band", "bucket"]).withColumn("own", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")).withColumn("minor", F.col("component") != F.col("major"))
    # At home in one chunk; documents outside the largest component visit the others.
    seats = seats.select("band", "bucket", "id", "component", "minor", "own", F.explode(F.when(F.col("minor"), F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array("own"))).alias("chunk"))
    seats = materialise(seats.withColumn("visits", F.col("chunk") != F.col("own")).drop("own"), "omh-seats")

    @tidy
    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            lists = [x.view(np.int64) for some in portions(texts) for x in shingles_of(texts[some])]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(lists, pa.list_(pa.int64()))], names=["id", "shingles"])

    sets = texts.join(seats.select("id").distinct(), "id").select("id", "text").mapInArrow(shingle, "id long, shingles array<long>")
    units = seats.join(sets, "id").repartition("band", "bucket", "chunk").sortWithinPartitions("band", "bucket", "chunk", "visits")

    @tidy
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, home, roots = None, [], Roots()

        def told(guests: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for start in range(0, guests.num_rows, GUESTS):
                some = Held(guests.slice(start, GUESTS))
                links = [x for hosts in home for x in join_components(some, hosts, roots, similarity)]
                if links:
                    yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

        def within() -> Iterator[pa.RecordBatch]:
            """The chunk's own documents meet; blocks so far hold batches."""
            nonlocal home
            batch = pa.concat_batches(home)
            home = [Held(batch.slice(k, HOSTS)) for k in range(0, batch.num_rows, HOSTS)]
            yield from told(batch.filter(batch.column("minor")))

        open_ = False
        for key, part in runs(batches, ["band", "bucket", "chunk", "visits"]):
            if key[:3] != at:
                if open_:
                    yield from within()
                at, home, roots, open_ = key[:3], [], Roots(), True
            if not key[3]:
                home.append(part)
                continue
            if open_:
                if home:
                    yield from within()
                open_ = False
            yield from told(part)
        if open_:
            yield from within()

    return units.select("band", "bucket", "chunk", "visits", "id", "component", "minor", "shingles").mapInArrow(meet, "a long, b long")


def _classes(plain: DataFrame, similarity: float, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """id, class_id of each id in `plain` (id, text), written by `keep`."""
    made = materialise(sketches(plain), "omh-sketches")
    # One row for each digest: the least id that has it. `rid` numbers texts, so that neither repeated rows nor ids that
    # several texts share multiply anything below. Written, as every use must see the same numbers.
    folded = made.groupBy("digest").agg(F.min(F.struct("id", "tkey", "n", "buckets")).alias("f")).select("digest", "f.*")
    folded = materialise(folded.withColumn("rid", F.monotonically_increasing_id()), "omh-folded")
    entries = folded.where("n > 0").select(F.col("id").alias("doc"), F.col("rid").alias("id"), "n", F.posexplode("buckets").alias("band", "bucket"))
    shared = entries.groupBy("band", "bucket").agg(F.min(F.struct("doc", "id", "n")).alias("hub"), F.max("id").alias("last"), F.min("id").alias("first")).where("first <> last")
    shared = shared.select("band", "bucket", F.col("hub.id").alias("hub"), F.col("hub.n").alias("hub_n"))
    entries = materialise(entries.drop("doc").join(shared, ["band", "bucket"]), "omh-entries")

    # The text of each document that shares a bucket, once.
    wanted = entries.select("id").distinct().withColumnRenamed("id", "rid").join(folded.select("rid", "id", F.col("tkey").alias("key")), "rid")
    texts = plain.join(wanted, "id").where(F.unhex(F.sha2(F.col("text").cast("binary"), 256)) == F.col("key"))
    texts = materialise(texts.groupBy("id", "rid").agg(F.first("text").alias("text")).select(F.col("rid").alias("id"), "text"), "omh-texts")

    hubs = entries.where((F.col("id") != F.col("hub")) & (F.least("n", "hub_n") >= F.greatest("n", "hub_n") * F.lit(similarity) - 1e-9)).groupBy("id", "hub").agg(F.count(F.lit(1)).alias("times"))
    hubs = hubs.groupBy("id").agg(F.max(F.struct("times", (-F.col("hub")).alias("low")))["low"].alias("low"))
    links = materialise(verified(hubs.select(F.col("id").alias("a"), (-F.col("low")).alias("b")), texts, similarity), "omh-links")
    found = connected_components(links)

    entries = entries.join(found, "id", "left").select("band", "bucket", "id", "n", F.coalesce("component", "id").alias("component"))
    rest = materialise(links_within(entries, texts, similarity), "omh-rest")
    if not rest.isEmpty():
        found = connected_components(found.select(F.col("id").alias("a"), F.col("component").alias("b")).where("a <> b").unionByName(rest))

    # Back to ids: each component's least id, for its digests, for their rows. What is joined with many rows is written
    # first, so that both sides of the join are dealt out for it and adaptive execution can split a hot digest.
    of_digest = folded.select("digest", "id", "rid").join(found.select(F.col("id").alias("rid"), "component"), "rid", "left").withColumn("component", F.coalesce("component", "rid"))
    of_digest = materialise(of_digest, "omh-components")
    least = of_digest.groupBy("component").agg(F.min("id").alias("class_id"))
    told = materialise(of_digest.join(least, "component").select("digest", "class_id"), "omh-classes")
    classes = made.select("id", "digest").join(told, "digest")
    # An id with several texts gets its least class.
    return keep(classes.groupBy("id").agg(F.min("class_id").alias("class_id")), "omh-ids")


def near_duplicate_classes(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id and kept of every row of `docs`; a class's id is the least id in it, and that document is kept."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    plain = rows.where("id is not null and text is not null")
    with scratch(docs.sparkSession) as keep:
        classes = _classes(plain, similarity, keep)
    out = rows.select("id").join(classes, "id", "left")
    return out.select(F.col("id").alias(id_col), F.coalesce("class_id", "id").alias("class_id"), F.coalesce(F.col("class_id") == F.col("id"), F.lit(True)).alias("kept"))


def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate classes of all `documents`."""
    return near_duplicate_classes(table(spark, sf_dir, "documents"))

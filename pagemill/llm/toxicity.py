"""Operator 11: toxicity by a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

A text is lower-cased, runs of anything but letters become one gap, and a gap stands at both ends. Its features are the
n-grams of ORDERS characters and gaps that stand in it, each counted once, hashed into BUCKETS.

* Over all labelled rows that are learnt from, Spark counts for each bucket the texts of either label that hold it. With
  p and q as these counts plus one, each divided by their sum, the bucket's log-count ratio is r = log(p / q).
* Buckets whose ratio is within LEAST_Z standard errors of none are left out.
* A logistic regression (Spark's own, with an L2 penalty) is fitted on the others, each with the value r where
  the text has it. It takes a bounded sample: about SAMPLE_PER_LABEL rows of either label, those whose hashed ids come
  first, and each label weighs as it does among all rows. What scores a text is the sum of weight * r over its buckets.

The label counts, and the features of the sample, are gathered by Spark; the driver holds two numbers for each bucket.
Scores are rounded to six places, below which the order of Spark's sums shows.

Defined results: a null text is an empty one, and an empty text has the score of a text without features, as labels are
distributed. Labels other than 0 and 1 and labels without an id don't count; repeated ones count once, and a
document that has both is learnt with both. Documents with a null id or one that is held out aren't learnt from; the
null id counts as the empty text for the split. Repeated rows are learnt from each by itself (the sample takes the
least text of an id) and get equal scores. Without rows of both labels the score is the share of label 1 among the
labels, 0 if there are none. Whole texts are read, PIECE characters at a time. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import scratch, slices, table, tidy
from .language_id import GAP, letter_table

ORDERS = (3, 4, 5)
BITS = 18
BUCKETS = 1 << BITS
LEAST_Z = 4.0
SAMPLE_PER_LABEL = 8_000
PENALTY, STEPS = 3e-3, 60
#: Characters of a text read at a time, and characters whose n-grams are worked on together.
PIECE, TOGETHER = 1 << 18, 1 << 19
# Odd multipliers of the hash: one for each place in an n-gram, and one that mixes.
PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], dtype=np.uint64)
MIX = np.uint64(0xD6E8FEB86659FD93)


def segments(text: str) -> Iterator[np.ndarray]:
    """Letters and gaps of a text in pieces; each begins with the last characters of the one before."""
    lowered, held = text.lower(), np.array([GAP], dtype=np.uint32)
    for start in range(0, max(1, len(lowered)), PIECE):
        points = np.frombuffer(lowered[start : start + PIECE].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        points = np.concatenate([held, letter_table()[points], np.array([GAP] if start + PIECE >= len(lowered) else [], dtype=np.uint32)])
        keep = np.ones(len(points), dtype=bool)
        keep[1:] = (points[1:] != GAP) | (points[:-1] != GAP)
        points = points[keep]
        yield points
        held = points[-(max(ORDERS) - 1) :]


def buckets_of(points: np.ndarray, segment: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order (places at which an n-gram of one segment begins, its bucket)."""
    points = points.astype(np.uint64)
    hashed = points * PLACES[0]
    for n in range(2, max(ORDERS) + 1):
        hashed = hashed[:-1] + points[n - 1 :] * PLACES[n - 1]
        if n in ORDERS and len(hashed):
            at = np.flatnonzero(segment[: len(hashed)] == segment[n - 1 :])
            mixed = (hashed[at] ^ (hashed[at] >> np.uint64(32)) ^ np.uint64(n)) * MIX
            yield at, (mixed >> np.uint64(64 - BITS)).astype(np.int64)


def features(texts: list[str | None], wanted: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the text, bucket), once each and in order; every text is whole within one of the pairs of arrays.

    `wanted` (a flag for each bucket) leaves the others out.
    """
    keys, held, points, owners = [], 0, [], []

    def work() -> None:
        nonlocal points, owners, held
        if points:
            segment = np.repeat(np.arange(len(points)), [len(p) for p in points])
            owner = np.array(owners, dtype=np.int64)[segment]
            for at, bucket in buckets_of(np.concatenate(points), segment):
                if wanted is not None:
                    fits = wanted[bucket]
                    at, bucket = at[fits], bucket[fits]
                keys.append(np.unique(owner[at] << BITS | bucket))
        points, owners, held = [], [], 0

    for i, text in enumerate(texts):
        for part in segments(text or ""):
            points.append(part)
            owners.append(i)
            held += len(part)
            if held >= TOGETHER:
                work()
        if keys:
            work()
            found = np.unique(np.concatenate(keys))
            keys = []
            yield found >> BITS, found & (BUCKETS - 1)
    work()
    if keys:
        found = np.unique(np.concatenate(keys))
        yield found >> BITS, found & (BUCKETS - 1)


@dataclass(frozen=True)
class Model:
    """`weights` for each bucket, added to `bias`; or a `constant` score where there was nothing to tell apart."""

    weights: np.ndarray
    bias: float
    constant: float | None = None


def split(doc_id: Column) -> Column:
    """True for the held-out fifth."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def label_counts(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Of `labelled` (text, toxic) the texts of label 0 and 1: (how many, how many hold each bucket, 2 x BUCKETS)."""

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, holds = np.zeros(2, dtype=np.int64), np.zeros((2, BUCKETS), dtype=np.int64)
        for batch in slices(batches):
            toxic = batch.column("toxic").to_numpy()
            rows += np.bincount(toxic, minlength=2)
            for text, bucket in features(batch.column("text").to_pylist()):
                for label in (0, 1):
                    holds[label] += np.bincount(bucket[toxic[text] == label], minlength=BUCKETS)
        at = np.flatnonzero(holds.any(axis=0))
        if rows.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), *[pa.array(np.append(holds[label][at], rows[label])) for label in (0, 1)]], names=["bucket", "clean", "toxic"])

    sums = labelled.select("text", F.col("toxic").cast("long").alias("toxic")).mapInArrow(count, "bucket long, clean long, toxic long").groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    rows, holds = np.zeros(2, dtype=np.int64), np.zeros((2, BUCKETS), dtype=np.int64)
    for batch in sums.toArrow().to_batches():  # BUCKETS rows at most
        bucket, values = batch.column("bucket").to_numpy(), np.array([batch.column(c).to_numpy() for c in ("clean", "toxic")])
        holds[:, bucket[bucket >= 0]] = values[:, bucket >= 0]
        rows += values[:, bucket < 0].sum(axis=1).astype(np.int64)
    return rows, holds


def log_count_ratios(holds: np.ndarray, least_z: float = LEAST_Z) -> np.ndarray:
    """r of each bucket; 0 for those that tell too little."""
    q, p = holds.astype(np.float64) + 1
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    return np.where((np.abs(ratio) >= least_z * np.sqrt(1 / p + 1 / q)) & holds.any(axis=0), ratio, 0.0)


def fit(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> Model:
    """The model of `docs` (doc_id, text) whose `labels` (doc_id, toxic) may be learnt from."""
    labels = labels.where("doc_id is not null and toxic in (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct()
    docs = docs.select("doc_id", "text")
    # Labels grow with the documents, so the join never broadcasts them.
    rows, holds = label_counts(docs.join(labels.hint("merge"), "doc_id"))
    if not rows.all():
        return Model(np.zeros(BUCKETS), 0.0, float(rows[1]) / max(1, rows.sum()))
    ratio = log_count_ratios(holds)
    chosen = np.flatnonzero(ratio)
    if not len(chosen):
        return Model(np.zeros(BUCKETS), 0.0, float(rows[1]) / rows.sum())
    # About per_label ids of either label, by their share of the labels' hashes; so few are broadcast.
    n = {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    part = F.when(F.col("toxic") == 1, min(1.0, per_label / n[1])).otherwise(min(1.0, per_label / n[0]))
    ids = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < part * (1 << 30))
    sample = docs.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    place = np.full(BUCKETS, -1, dtype=np.int64)
    place[chosen] = np.arange(len(chosen))

    @tidy
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            toxic, indices = batch.column("toxic").to_numpy(), [[] for _ in range(batch.num_rows)]
            for text, bucket in features(batch.column("text").to_pylist(), place >= 0):
                starts = np.searchsorted(text, np.arange(batch.num_rows + 1))
                for i in np.unique(text):
                    indices[i] = place[bucket[starts[i] : starts[i + 1]]].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(toxic.astype(np.float64)), pa.array(indices, pa.list_(pa.int32()))], names=["label", "indices"])

    with scratch(docs.sparkSession) as keep:
        read_once = keep(sample.mapInArrow(read, "label double, indices array<int>"), "toxicity-sample")
    kept = {int(r["label"]): r["n"] for r in read_once.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(kept) < 2:
        return Model(np.zeros(BUCKETS), 0.0, float(rows[1]) / rows.sum())
    values, width = ratio[chosen], len(chosen)
    vector = F.udf(lambda indices: SparseVector(width, indices, values[indices]), VectorUDT())
    weight = F.when(F.col("label") == 1.0, rows[1] / kept[1]).otherwise(rows[0] / kept[0])
    data = read_once.select("label", vector(F.col("indices")).alias("features"), weight.alias("weight"))
    fitted = LogisticRegression(maxIter=STEPS, regParam=PENALTY, standardization=False, weightCol="weight").fit(data)
    weights = np.zeros(BUCKETS)
    weights[chosen] = fitted.coefficients.toArray() * values
    return Model(weights, float(fitted.intercept))


def with_scores(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` (text and any other columns) in a struct `row`, with score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    packed = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    schema = packed.select("row").withColumns({"score": F.lit(0.0), "predicted": F.lit(0)}).schema

    @tidy
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        wanted = known.weights != 0
        for batch in slices(batches):
            total = np.full(batch.num_rows, known.bias)
            if known.constant is None:
                for text, bucket in features(batch.column("text").to_pylist(), wanted):
                    total += np.bincount(text, weights=known.weights[bucket], minlength=batch.num_rows)
                score = np.round(1 / (1 + np.exp(-np.clip(total, -500, 500))), 6)
            else:
                score = np.full(batch.num_rows, round(known.constant, 6))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["row", "score", "predicted"])

    return packed.mapInArrow(judge, schema)


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learnt from the labels of the four fifths that aren't held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = split(F.col("doc_id"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = fit(docs.where(~held_out), labels.where(~held_out))
    found = with_scores(docs, model)
    return found.select("row.doc_id", split(F.col("row.doc_id")).alias("held_out"), "score", "predicted")

"""Operator 4: language identification by hyperdimensional profiles.

Each letter (and the gap between words) has a random vector of DIMENSIONS signs, drawn from a hash of its code point. A
trigram binds three of them, permuted by position: V(abc) = r(r(L_a)) * r(L_b) * L_c, with r a rotation. A document's
vector bundles (adds) its trigrams; a language's prototype bundles the documents of that language. A document gets the
language whose prototype has the largest cosine with it; `score` is that cosine, cut to 0 to 1.

Vectors that share nothing have cosines of about 1 / sqrt(DIMENSIONS), whatever the number of trigrams. `recognised` holds
for texts whose score is above that noise (NOISE); short ones (fewer than LETTERS letters) get the benefit of the doubt.

Training takes at most SAMPLE_PER_LANGUAGE labelled documents of each language, those whose hashed ids come first. Their
ids, bounded by that, are sent to all executors, which add up the bundles of their own documents; texts don't move.
Bundles are sums of integers, so reruns agree. Whole texts are read; PIECE characters at a time, and neighbouring pieces
share the letters that trigrams across them need.

Defined results: a null text or one without letters gets `und` and score 0, as does everything when nothing is labelled.
Ties go to the language that is first by code point. Documents with a null id aren't learnt from; rows that repeat an id
are learnt from together. A null id counts as the empty text for the split. Repeated rows
get equal predictions. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import slices, table, tidy

DIMENSIONS = 1024
SAMPLE_PER_LANGUAGE = 1_000
#: Most bits of the hash that tell apart the bins of a language.
BIN_BITS = 16
PIECE = 1 << 20
#: Two standard deviations of the cosine of unlike vectors, and letters of a text that is long enough to be rejected for it.
NOISE, LETTERS = 2 / DIMENSIONS**0.5, 20
#: Trigrams whose vectors one worker keeps; they are rebuilt from the letters when more are needed.
KEPT_TRIGRAMS = 20_000
GAP = 0x20

_letters: np.ndarray | None = None
_signs: dict[int, np.ndarray] = {}
_vectors: dict[int, np.ndarray] = {}


def letter_table() -> np.ndarray:
    """For each code point: itself if it is a letter, else GAP."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((c if chr(c).isalpha() else GAP for c in range(0x110000)), dtype=np.uint32, count=0x110000)
    return _letters


def signs(code: int) -> np.ndarray:
    """The letter's vector, -1 and 1."""
    found = _signs.get(code)
    if found is None:
        if len(_signs) >= KEPT_TRIGRAMS:
            _signs.clear()
        found = _signs[code] = np.random.Generator(np.random.PCG64(code)).integers(0, 2, DIMENSIONS).astype(np.float32) * 2 - 1
    return found


def trigram_vectors(codes: np.ndarray) -> np.ndarray:
    rows = []
    for code in codes.tolist():
        v = _vectors.get(code)
        if v is None:
            if len(_vectors) >= KEPT_TRIGRAMS:
                _vectors.clear()
            v = _vectors[code] = (np.roll(signs(code >> 42), 2) * np.roll(signs(code >> 21 & 0x1FFFFF), 1) * signs(code & 0x1FFFFF)).astype(np.int8)
        rows.append(v)
    return np.array(rows, dtype=np.int8).reshape(-1, DIMENSIONS).astype(np.float32)


def trigrams(text: str) -> Iterator[np.ndarray]:
    """Codes of the trigrams of lower-cased letters, runs of anything else being one gap; a gap stands at both ends.

    A piece begins with the last two letters or gaps of the piece before it, so no trigram is lost or made up.
    """
    lowered, held = text.lower(), np.array([GAP], dtype=np.int64)
    for start in range(0, len(lowered), PIECE):
        piece = lowered[start : start + PIECE].encode("utf-32-le", "surrogatepass")
        points = np.concatenate([held, letter_table()[np.frombuffer(piece, dtype=np.uint32)]])
        if start + PIECE >= len(lowered):
            points = np.append(points, GAP)
        keep = np.ones(len(points), dtype=bool)
        keep[1:] = (points[1:] != GAP) | (points[:-1] != GAP)
        points = points[keep].astype(np.int64)
        if len(points) > 2:
            yield points[:-2] << 42 | points[1:-1] << 21 | points[2:]
        held = points[-2:]


def document_vectors(texts: list[str | None]) -> np.ndarray:
    """The bundles of `texts`, one row each; rows of texts without letters are zero.

    A product of single floats covers less than 2**22 trigrams and is exact; the products are added as integers.
    """
    out = np.zeros((len(texts), DIMENSIONS), dtype=np.int64)
    owners, codes = [], []
    held = 0

    def bundle() -> None:
        if not codes:
            return
        known, at = np.unique(np.concatenate(codes), return_inverse=True)
        rows = sorted(set(owners))
        place = {r: i for i, r in enumerate(rows)}
        for start in range(0, len(rows), 64):
            part = rows[start : start + 64]
            mine = [i for i, o in enumerate(owners) if start <= place[o] < start + 64]
            offsets = np.cumsum([0, *(len(c) for c in codes)])
            flat = np.concatenate([at[offsets[i] : offsets[i + 1]] + (place[owners[i]] - start) * len(known) for i in mine])
            counts = np.bincount(flat, minlength=len(part) * len(known)).reshape(len(part), len(known)).astype(np.float32)
            used = np.flatnonzero(counts.any(axis=0))
            for block in range(0, len(used), 2048):
                some = used[block : block + 2048]
                out[part] += (counts[:, some] @ trigram_vectors(known[some])).astype(np.int64)

    for i, text in enumerate(texts):
        for found in trigrams(text or ""):
            owners.append(i)
            codes.append(found)
            held += len(found)
            if held > 1 << 18:
                bundle()
                owners, codes, held = [], [], 0
    bundle()
    return out


def split(doc_id: Column) -> Column:
    """True for the held-out quarter."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def language_prototypes(labelled: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> dict[str, np.ndarray]:
    """Unit prototypes by language from `labelled` (doc_id, text, lang); a bounded sample is read."""
    rows = labelled.select("doc_id", "lang").where("lang is not null and doc_id is not null").distinct().withColumn("h", F.xxhash64("doc_id"))
    # Bins of neighbouring hashes are counted, and only those that the sample needs are ranked.
    bits = min(BIN_BITS, max(4, (4 * rows.count() // per_language).bit_length()))
    rows = rows.withColumn("bin", F.shiftright("h", 64 - bits))
    before = Window.partitionBy("lang").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = rows.groupBy("lang", "bin").agg(F.count(F.lit(1)).alias("n")).withColumn("n", F.coalesce(F.sum("n").over(before), F.lit(0)))
    needed = bins.where(F.col("n") < per_language).groupBy("lang").agg(F.max("bin").alias("last"))
    first = Window.partitionBy("lang").orderBy("h", "doc_id")
    # One row for each language, as the prototypes that are broadcast later.
    chosen = rows.join(F.broadcast(needed), "lang").where("bin <= last").withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_language).select("doc_id", "lang")
    # Bounded: per_language rows for each language.
    sample = labelled.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi").select("lang", "text")

    @tidy
    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            vectors = document_vectors(batch.column("text").to_pylist())
            for lang, v in zip(batch.column("lang").to_pylist(), vectors, strict=True):
                sums[lang] = sums.get(lang, 0) + v
        for lang, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * DIMENSIONS), pa.array(np.arange(DIMENSIONS, dtype=np.int32)), pa.array(v)], names=["lang", "place", "value"])

    # The parts' bundles are added on the executors; one bundle for each language comes to the driver.
    added = sample.mapInArrow(bundles, "lang string, place int, value long").groupBy("lang", "place").agg(F.sum("value").alias("value"))
    total: dict[str, np.ndarray] = {}
    for row in added.collect():
        total.setdefault(row["lang"], np.zeros(DIMENSIONS, dtype=np.int64))[row["place"]] = row["value"]
    return {k: v / np.linalg.norm(v) for k, v in sorted(total.items()) if np.any(v)}


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray]) -> DataFrame:
    """`docs` (text and any other columns) in a struct `row`, with lang_pred and score."""
    names = list(prototypes)
    shared = docs.sparkSession.sparkContext.broadcast(np.array([prototypes[n] for n in names]).reshape(len(names), DIMENSIONS))
    packed = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    schema = packed.select("row").withColumn("lang_pred", F.lit("")).withColumn("score", F.lit(0.0)).schema

    @tidy
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in slices(batches):
            v = document_vectors(batch.column("text").to_pylist()).astype(np.float64)
            norms = np.sqrt(np.einsum("ij,ij->i", v, v))
            if len(names):
                cosines = (v @ known.T) / np.where(norms > 0, norms, 1.0)[:, None]
                best = cosines.argmax(axis=1)
                score = np.clip(cosines[np.arange(len(v)), best], 0.0, 1.0)
                lang = [names[b] if n > 0 else "und" for b, n in zip(best, norms, strict=True)]
                score = np.where(norms > 0, score, 0.0)
            else:
                lang, score = ["und"] * len(v), np.zeros(len(v))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(lang, pa.string()), pa.array(score)], names=["row", "lang_pred", "score"])

    return packed.mapInArrow(predict, schema)


def recognised(text: Column, lang_pred: Column, score: Column) -> Column:
    """Whether a text has letters and is not, by its score, in a language that no prototype stands for."""
    return (lang_pred != "und") & ((score >= NOISE) | (F.regexp_count(text, F.lit(r"\p{L}")) < LETTERS))


def op4_hyperdimensional_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document, learnt from the three quarters that aren't held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    prototypes = language_prototypes(docs.where(~split(F.col("doc_id"))))
    found = identify(docs.select("doc_id", "text"), prototypes)
    return found.select("row.doc_id", split(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score")

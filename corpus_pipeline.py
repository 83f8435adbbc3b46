"""A training corpus from `documents`: language, near-duplicates, personal data, mixture, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's `docs`. All but the last return the columns of `docs`, extra ones included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm._common import materialise, table
from pagemill.llm.language_id import identify, language_prototypes, recognised
from pagemill.llm.minhash_dedup import near_duplicate_classes
from pagemill.llm.mixing import systematic_mix
from pagemill.llm.personal_data import redacted
from pagemill.llm.sentence_pieces import encode_texts
from pagemill.llm.token_counts import public_path

#: SQL can't express hyperdimensional vectors, buckets of hashes, the bootstrap and merges; tests use brute force.
ORACLE_SQL = None


def numbered(docs: DataFrame, label: str) -> DataFrame:
    """`docs` as (key, row), the key unique to the row; written, so that every use sees the same keys."""
    return materialise(docs.select(F.monotonically_increasing_id().alias("key"), F.struct("*").alias("row")), label)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: null texts, texts without letters, and texts that are no nearer to the learnt
    languages than chance (gibberish, other scripts). A null `lang` gets the prediction. Where no document is labelled
    nothing is learnt, and only texts without letters go."""
    prototypes = language_prototypes(docs.select("doc_id", "text", "lang"))
    found = identify(docs, prototypes)
    text = F.col("row.text")
    found = found.where(recognised(text, F.col("lang_pred"), F.col("score")) if prototypes else text.rlike(r"\p{L}"))
    return found.select(*[F.coalesce(F.col("row")[c], F.col("lang_pred")).alias(c) if c == "lang" else F.col("row")[c].alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class stays, that of the least doc_id, a null id being the last. Rows are compared by their texts,
    whatever their ids; null texts are copies only where they share an id."""
    rows = numbered(docs, "dedup-rows")
    classes = near_duplicate_classes(rows.select("key", "row.text"), id_col="key").select("key", "class_id")
    same = F.when(F.col("text").isNull() & F.col("doc_id").isNotNull(), F.col("doc_id").cast("string"))
    ids = rows.select("key", "row.doc_id", "row.text").select("key", "doc_id", same.alias("same")).join(classes, "key")
    ids = ids.withColumn("class_id", F.when(F.col("same").isNull(), F.col("class_id")))
    kept = ids.groupBy("class_id", "same").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key"))["key"].alias("key"))
    kept = materialise(kept.select("key"), "dedup-kept")
    # Kept keys grow with the rows, so the join never broadcasts them.
    return rows.join(kept.hint("merge"), "key", "left_semi").select(*[F.col("row")[c].alias(c) for c in docs.columns])


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by marks; n_chars follows."""
    out = redacted(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns) if "n_chars" in docs.columns else out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it, whatever its doc_id: null and repeated ids and repeated rows are planned row by
    row. A null text counts no words; an empty table stays empty."""
    rows = numbered(docs, "mix-rows")
    plan = systematic_mix(rows.select("key", F.col("key").alias("doc_id"), "row.text", "row.source"), ["key"]).where("__copies > 0").select("key", F.col("__copies").cast("int").alias("copies"))
    taken = rows.join(plan, "key").select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return taken.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text, with digests of the ids and of the text that they decode to. A null text is an empty one and has no
    ids; other columns than doc_id, lang and source end here."""
    out = encode_texts(docs.select("doc_id", "lang", "source", "text"), public_path("piece_bpe_32k.model"))
    return out.select("row.doc_id", "row.lang", "row.source", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("identify_language", identify_language),
    ("drop_near_duplicates", drop_near_duplicates),
    ("redact_personal_data", redact_personal_data),
    ("mix_sources", mix_sources),
    ("tokenise", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to `documents`; the last one's result is not yet computed."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

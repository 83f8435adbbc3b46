"""Every query on tables with nulls in all columns, repeated rows, ties, long texts and columns with clashing names, and on
tables without rows."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pagemill.llm._vectors import usable
from pagemill.llm.registry import QUERIES

TABLES = ("documents", "embeddings", "pages", "labels", "sales", "client_changes")
#: Names that operators use themselves.
CLASHES = (
    "id", "key", "row", "size", "n", "bucket", "class_id", "kept", "rank", "score", "vector", "ord", "grp", "label", "digest", "hits", "spans",
    "batch", "client", "rec", "seen_at", "toxic_m", "code", "error", "label_error", "part", "entry", "salt", "chunk", "predicted", "held_out",
    "copies", "tokens", "host", "path", "verdict", "rule", "fixed", "lang_pred", "target", "shard", "slot", "component_id", "text_m", "at", "copy", "same",
)
SOURCE = "/root/testdata/sf0.001"


def with_clashes(df):
    return df.withColumns({c: F.lit(7) for c in CLASHES if c not in df.columns})


@pytest.fixture(scope="module")
def hard(spark, tmp_path_factory):
    """The rows of the small tables twice, and for each column a row in which it is null; one row of nulls, empty and long texts."""
    out = tmp_path_factory.mktemp("hard")
    for name in TABLES:
        df = spark.read.parquet(f"{SOURCE}/{name}.parquet")
        one = df.limit(1)
        rows = df.unionByName(df)
        for c in df.columns:
            rows = rows.unionByName(one.withColumn(c, F.lit(None).cast(df.schema[c].dataType)))
        rows = rows.unionByName(one.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema]))
        for c in ("text", "url"):
            if c in df.columns:
                rows = rows.unionByName(one.withColumn(c, F.lit(""))).unionByName(one.withColumn(c, F.repeat(F.lit("https://x.org/a1?b=c&"), 20_000)))
                rows = rows.unionByName(one.withColumn(c, F.repeat(F.lit("字"), 50_000)))
        if "embedding" in df.columns:
            for v in ("array()", "array(0f)", "array(float('nan'), 1f)", "array(cast(null as float))"):
                rows = rows.unionByName(one.withColumn("embedding", F.expr(v).cast(df.schema["embedding"].dataType)))
        with_clashes(rows).coalesce(2).write.parquet(f"{out}/{name}.parquet")
    return str(out)


@pytest.fixture(scope="module")
def bare(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("bare")
    for name in TABLES:
        with_clashes(spark.read.parquet(f"{SOURCE}/{name}.parquet").limit(0)).write.parquet(f"{out}/{name}.parquet")
    return str(out)


def ids_of(df, name):
    rows = df.groupBy(name).agg(F.count(F.lit(1)).alias("rows")).collect()
    return {r[name]: r["rows"] for r in rows}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_hard_rows_keep_their_place(spark, hard, name):
    """One row for each row of the table, with its id; searches only answer."""
    found = QUERIES[name](spark, hard)
    places = {"op1": ("embeddings", "vec_id"), "op5": ("embeddings", "vec_id"), "op10": ("pages", "page_id"), "op12": ("sales", "sale_id"), "op13": ("embeddings", "vec_id")}
    table, key = places.get(name.split("_")[0], ("documents", "doc_id"))
    if name.startswith("op5"):
        rows = found.collect()
        assert rows and all(r["query_id"] is not None and r["query_id"] != r["vec_id"] for r in rows)
        return
    if name.startswith("op12"):
        found = found.where("rec = 'sale'").withColumnRenamed("id", "sale_id")
    found, rows = found.cache(), spark.read.parquet(f"{hard}/{table}.parquet")
    if name.startswith("op13"):
        rows = rows.where(usable(F.col("embedding")))
    assert ids_of(found, key) == ids_of(rows, key)
    found.unpersist()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_tables_without_rows(spark, bare, name):
    assert QUERIES[name](spark, bare).collect() == []


def test_pipeline_of_hard_and_no_rows(spark, hard, bare):
    assert corpus_pipeline.run(spark, bare).collect() == []
    ids = {r["doc_id"] for r in spark.read.parquet(f"{hard}/documents.parquet").collect()}
    rows = corpus_pipeline.run(spark, hard).collect()
    assert rows and {r["doc_id"] for r in rows} <= ids

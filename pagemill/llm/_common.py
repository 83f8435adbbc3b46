"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of a batch that Python holds as objects at a time.
SLICE = 256
#: Rows that one task of a numbering window is meant to hold.
ROWS_PER_BUCKET = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`.

    Only where the session names none (tests in one JVM) a temporary folder is made and remembered.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("pagemill.shared.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="pagemill-")
        spark.conf.set("pagemill.shared.dir", found)
    return found.rstrip("/")


#: The lists of tables that open scratch blocks have made, the innermost last.
_scratch: ContextVar[tuple[list[str], ...]] = ContextVar("scratch", default=())


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: lineage is cut and a lost executor costs one task, not the plan."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/pagemill-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    for made in _scratch.get()[-1:]:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables that `materialise` writes inside go at the end. What is given to the block's function is written and stays
    (until the block around it ends, if there is one); nothing lazy that reads the others may leave the block."""
    outer, made = _scratch.get(), []
    token = _scratch.set((*outer, made))

    def keep(df: DataFrame, label: str) -> DataFrame:
        inner = _scratch.set(outer)
        try:
            return materialise(df, label)
        finally:
            _scratch.reset(inner)

    try:
        yield keep
    finally:
        _scratch.reset(token)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in made:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`work` on a task's batches; what it freed goes back to the system, as workers are used again by other tasks."""

    @wraps(work)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return run


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """`batches` in parts of at most `rows` rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def hex_digits(rows: int) -> int:
    """Leading hex digits of a uniform hash that split `rows` rows into buckets of about ROWS_PER_BUCKET; 2 at least."""
    digits = 2
    while rows > ROWS_PER_BUCKET * 16**digits:
        digits += 1
    return digits


def number_rows(df: DataFrame, part: list[str], bucket: str, order: list[str | Column], out: str) -> DataFrame:
    """Add `out`, the row's position (from 0) within `part` when ordered by `bucket`, then `order`.

    A window over all of `part` would put a hot key into one task. Here the window runs inside
    (part, bucket) only; the buckets' offsets come from their counts. `part` and `bucket` hold no nulls.
    """
    keys = [*part, bucket]
    before = Window.partitionBy(*part).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).select(*keys, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = df.withColumn("__inside", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return inside.join(offsets, keys).withColumn(out, F.col("__before") + F.col("__inside") - 1).drop("__n", "__before", "__inside")


def start_rows(df: DataFrame, key: str, amount: Column, out: str) -> DataFrame:
    """Add `out`, the sum of `amount` over the rows before it by the unique `key`; ranges of keys are added up apart.

    What passes through the one unpartitioned window has a row for each partition.
    """
    parts = materialise(df.repartitionByRange(key).withColumns({"__part": F.spark_partition_id(), "__amount": amount}), "ranges")
    before = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("__part").agg(F.sum("__amount").alias("__n")).select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = F.coalesce(F.sum("__amount").over(Window.partitionBy("__part").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return parts.withColumn(out, inside).join(offsets, "__part").withColumn(out, F.col(out) + F.col("__before")).drop("__part", "__amount", "__before")


def rank_rows(df: DataFrame, key: str, out: str) -> DataFrame:
    """Add `out`, the row's position (from 0) by the unique `key`."""
    return start_rows(df, key, F.lit(1), out)

"""Tables that a job writes and reads again, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of one key that one task may put in order.
PART_ROWS = 100_000

def shared_home(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`; a temporary folder only where a local session names none."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("pagemill.shared.home", None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="pagemill-")
        spark.conf.set("pagemill.shared.home", found)
    return found.rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A folder that no other call uses."""
    return f"{shared_home(spark)}/pagemill-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` written and read again: what made it runs once, and a lost executor costs a task of it."""
    path = fresh_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _at(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _at(spark, path)
    return files.exists(at)


def children(spark: SparkSession, path: str) -> list[str]:
    """The paths right under a folder; none if there is no folder."""
    files, at = _at(spark, path)
    return sorted(s.getPath().toString() for s in files.listStatus(at)) if files.exists(at) else []


def make_folder(spark: SparkSession, path: str) -> None:
    files, at = _at(spark, path)
    files.mkdirs(at)


def remove(spark: SparkSession, path: str) -> None:
    files, at = _at(spark, path)
    files.delete(at, True)


def placed(rows: DataFrame, part: list[str], order: list[str], out: str = "place", most: int = PART_ROWS) -> DataFrame:
    """`rows` with `out`, their place from 1 within `part` by `order`; a part of more than `most` rows is numbered by many tasks.

    Where no part is that large, a window numbers them. Otherwise rows are dealt by ranges of (part, order), so a part lies in
    neighbouring ranges; each is numbered by itself, and starts from the counts of those before it, a row for each part
    and range. `part` and `order` tell rows apart, or equal ones may be numbered either way.
    """
    largest = rows.groupBy(*part).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if largest <= most:
        return rows.withColumn(out, F.row_number().over((Window.partitionBy(*part) if part else Window.partitionBy(F.lit(0))).orderBy(*order)))
    dealt = written(rows.repartitionByRange(*part, *order).withColumn("__range", F.spark_partition_id()), "ranges")
    before = (Window.partitionBy(*part) if part else Window.partitionBy(F.lit(0))).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(*part, "__range").agg(F.count(F.lit(1)).alias("__n"))
    starts = counts.select(*[F.col(c).alias(f"__{c}") for c in part], F.col("__range").alias("__at"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = dealt.withColumn("__inside", F.row_number().over(Window.partitionBy("__range", *part).orderBy(*order)))
    same = F.col("__range") == F.col("__at")
    for c in part:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return inside.join(starts, same).select(*rows.columns, (F.col("__start") + F.col("__inside")).cast("int").alias(out))

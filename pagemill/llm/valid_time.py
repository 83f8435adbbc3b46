"""Operator 12: valid-time enrichment of sales by event-time timers.

Sales wait until it is certain that no version of their client that was valid then can still come; versions that no
waiting or later sale can need are pruned. Both follow from one watermark.

* The two tables are cut into batches and written as the folders of two file streams. A stateful streaming query is
  started anew for each batch on one checkpoint, so its state and watermark come back from there every time.
* Each row carries `seen_at`, the largest timestamp of its table up to and including its batch. As it never falls, no row
  is ever late for Spark, and the watermark that Spark takes from it, twelve hours less, is the table's. The policy for
  several watermarks is `min`, so the query's watermark is H. Each batch of each table has one row that only carries
  `seen_at`, so that batches without rows count as well.
* The state is keyed by bucket: clients are dealt to buckets by hash, about BUCKET_ROWS rows each, and one call works on
  the arrays of a bucket. A client of more than CLIENT_ROWS rows is cut into chunks of time, which go to buckets of their
  own, so no client's rows meet in one task. A bucket's timer is the earliest time at which one of its sales is released
  or one of its versions can prune others; a bucket without new rows is only called when its timer fires.
* Within a bucket everything is final for clients of one chunk. Of a client in chunks each chunk keeps its own last pruned
  version, and reports what came and what passed H; from these few rows the client's number of versions, its last
  pruned version and the last version of the chunks before are found once the stream has ended. A version of the
  client's own chunk that is older than the last pruned one counts as pruned.
* After the last batch a row for each bucket releases the sales that still wait.

Defined results: a null sold_at is released at once and finds no version; sales with a null client find none and hold
none; changes with a null client prune nobody; a null valid_at is ignored; repeated rows of changes count once, repeated
rows of sales each by themselves. Null seq or change_id come first in the order of versions, and -2**63 counts as null.
A null arrived_at counts as the first batch, as do days before it. A balance that is null, not finite or beyond 9e15 has no cents. Spark counts watermarks in
milliseconds from 1970 on, so parts of a millisecond don't count against H, and no H is below 1970. Empty tables give no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import materialise, scratch, shared_dir, table

BATCHES, FIRST_DAY, DAYS = 8, 19_723, 152
DELAY_HOURS = 12
#: Rows of a client from which on it is cut into chunks of about that many, and the most chunks of a client.
CLIENT_ROWS, MOST_CHUNKS = 2_000, 4_096
#: Rows of all batches that a bucket is meant to take, and a partition of the state.
BUCKET_ROWS, STATE_ROWS = 8_192, 262_144
SALTS = 16
NONE = -(2**63)
TICK, CHANGE, SALE, FLUSH = 0, 1, 2, 3
LATE, SOLD, PART = 0, 1, 2
FEED = "bucket int, kind byte, client long, chunk int, chunks int, at long, seq long, id long, cents long, op string, mark long, seen_at timestamp"
VERSION = ["client", "chunk", "chunks", "at", "seq", "id", "cents", "op"]
WAITING = ["client", "chunk", "chunks", "at", "id"]
ARRIVING = ["kind", "mark", *VERSION]
OUT = "rec byte, client long, chunk int, chunks int, id long, batch long, at long, n_held long, change_id long, cents long, op string, seq long, version_at long, came long, passed long, passed_at long"
OUT_TYPES = {c: {"byte": "int8", "int": "int32", "long": "int64", "string": object}[t] for c, t in (x.split() for x in OUT.split(", "))}


def micros(ts: Column) -> Column:
    """A timestamp (its wall clock, where it has no zone) in microseconds since 1970, NONE for null."""
    return F.coalesce(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts.cast("timestamp_ntz")), F.lit(NONE))


def cents(balance: Column) -> Column:
    return F.when(balance.between(-9e15, 9e15), F.floor(balance.cast("double") * 100 + 0.5)).cast("long")


def batch_of(day: Column, batches: int = BATCHES, first_day: int = FIRST_DAY, days: int = DAYS) -> Column:
    """The batch of a day since 1970; null and days before the first go to batch 0."""
    return F.greatest(F.lit(0), F.least(F.lit(batches - 1), F.coalesce(F.floor((day - first_day) * batches / float(days)), F.lit(0)))).cast("int")


def day_of(ts: Column) -> Column:
    return F.unix_date(ts.cast("date"))


# The stream's state: what a bucket does with a batch, in arrays by column name.

Rows = dict[str, np.ndarray]


def empty(columns: list[str]) -> Rows:
    return {c: np.zeros(0, dtype=object if c == "op" else bool if c == "passed" else np.int64) for c in columns}


def taken(rows: Rows, which: np.ndarray, columns: list[str] | None = None) -> Rows:
    return {c: rows[c][which] for c in columns or rows}


def joined(a: Rows, b: Rows) -> Rows:
    return {c: np.concatenate([a[c], b[c]]) for c in a}


def packed(rows: Rows) -> bytes:
    batch = pa.RecordBatch.from_pydict({c: pa.array(v, pa.string() if c == "op" else None) for c, v in rows.items()})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(data: bytes) -> Rows:
    batch = pa.ipc.open_stream(data).read_next_batch()
    return {c: v.to_numpy(zero_copy_only=False) for c, v in zip(batch.schema.names, batch.columns, strict=True)}


def told(rec: int, batch: int, n: int, columns: Rows) -> pd.DataFrame:
    """OUT rows; columns that aren't given are NONE."""
    given = columns | {"rec": np.full(n, rec), "batch": np.full(n, batch)}
    return pd.DataFrame({c: given[c] if t is object and c in given else np.full(n, None) if t is object else given.get(c, np.full(n, NONE)).astype(t) for c, t in OUT_TYPES.items()})


def groups_of(rows: Rows) -> np.ndarray:
    """For rows sorted by client and chunk the number of their (client, chunk)."""
    c, k = rows["client"], rows["chunk"]
    return np.cumsum(np.r_[False, (c[1:] != c[:-1]) | (k[1:] != k[:-1])]) if len(c) else np.zeros(0, dtype=np.int64)


def matched(versions: Rows, sales: Rows) -> Rows:
    """`sales` with n_held, version_at, seq, change_id, cents, op of the last version (sorted `versions`) that held then."""
    n, m = len(versions["at"]), len(sales["at"])
    both = {c: np.concatenate([versions[c], sales[c]]) for c in ("client", "chunk", "at")}
    is_version = np.arange(n + m) < n
    order = np.lexsort((~is_version, both["at"], both["chunk"], both["client"]))  # stable: versions keep their order
    both, is_version = taken(both, order), is_version[order]
    group = groups_of(both)
    last = np.maximum.accumulate(np.where(is_version, np.arange(n + m), -1))
    found = (last >= 0) & (group[np.maximum(last, 0)] == group)
    held = np.bincount(group, weights=is_version).astype(np.int64)[group]
    own = both["client"] != NONE
    take = np.where(found & own & (both["at"] != NONE), order[np.maximum(last, 0)], -1)[~is_version]
    out = taken(sales, order[~is_version] - n) | {"n_held": np.where(own, held, 0)[~is_version]}
    for to, c in (("version_at", "at"), ("seq", "seq"), ("change_id", "id"), ("cents", "cents"), ("op", "op")):
        none = None if c == "op" else NONE
        out[to] = np.where(take >= 0, versions[c][np.maximum(take, 0)], none) if n else np.full(m, none)
    return out


def advanced(versions: Rows, waiting: Rows, rows: Rows, h_ms: int | None, batch: int) -> tuple[Rows, Rows, list[pd.DataFrame]]:
    """One batch of a bucket: (versions, waiting sales, output). `h_ms` is None where there is no watermark yet."""
    kind = rows["kind"]
    flush = bool((kind == FLUSH).any())
    out = []
    changes = taken(rows, kind == CHANGE)
    late = (changes["mark"] != NONE) & (changes["at"] < changes["mark"])
    if late.any():
        out.append(told(LATE, batch, int(late.sum()), taken(changes, late, ["client", "chunk", "chunks", "id"])))
    came = int((~late).sum())
    is_new = np.arange(len(versions["at"]) + came) >= len(versions["at"])
    if came:
        versions = joined(versions, taken(changes, ~late, VERSION) | {"passed": np.zeros(came, dtype=bool)})
        order = np.lexsort(tuple(versions[c] for c in ("id", "seq", "at", "chunk", "client")))
        versions, is_new = taken(versions, order), is_new[order]
    waiting = joined(waiting, taken(rows, kind == SALE, WAITING))
    at = waiting["at"]
    free = np.full(len(at), True) if flush else (at == NONE) | (at // 1000 < h_ms) if h_ms is not None else at == NONE
    if free.any():
        out.append(told(SOLD, batch, int(free.sum()), matched(versions, taken(waiting, free))))
        waiting = taken(waiting, ~free)

    group, at, before = groups_of(versions), versions["at"], versions["passed"]
    passed = before | (at // 1000 <= h_ms) if h_ms is not None and not flush else before
    moved = passed & ~before
    if len(at) and (versions["chunks"] > 1).any():
        n = group[-1] + 1
        came_in, passed_in = np.bincount(group, weights=is_new, minlength=n), np.bincount(group, weights=moved, minlength=n)
        last = np.flatnonzero(np.r_[group[1:] != group[:-1], True])
        passed_at = np.full(n, NONE)
        np.maximum.at(passed_at, group, np.where(passed, at, NONE))
        some = ((came_in > 0) | (passed_in > 0)) & (versions["chunks"][last] > 1)
        if some.any():
            rows_ = taken(versions, last[some], ["client", "chunk", "chunks", "seq", "cents", "op"])
            rows_ |= {"version_at": at[last[some]], "change_id": versions["id"][last[some]], "came": came_in[some], "passed": passed_in[some], "passed_at": passed_at[some]}
            out.append(told(PART, batch, int(some.sum()), rows_))
    # Of the versions that H has passed only the last of a (client, chunk) stays; they stand before those it hasn't.
    stays = ~passed | np.r_[(group[1:] != group[:-1]) | ~passed[1:], True][: len(at)]
    return taken(versions | {"passed": passed}, stays), waiting, out


def next_timer(versions: Rows, waiting: Rows) -> int | None:
    """The millisecond that the watermark has to exceed before a sale is released or a version passed."""
    times = [waiting["at"] // 1000, versions["at"][~versions["passed"]] // 1000 - 1]
    least = min((int(t.min()) for t in times if len(t)), default=None)
    return None if least is None else max(1, least)


def enriched_stream(feed: DataFrame, batch: int) -> DataFrame:
    """OUT rows of one batch of `feed` (FEED), stateful by bucket."""

    def advance(key: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        h = state.getCurrentWatermarkMs()
        versions, waiting = (unpacked(x) for x in state.get) if state.exists else (empty([*VERSION, "passed"]), empty(WAITING))
        given = list(parts)
        rows = {c: np.concatenate([p[c].to_numpy() for p in given]) for c in ARRIVING} if given else empty(ARRIVING)
        versions, waiting, out = advanced(versions, waiting, rows, h if h > 0 else None, batch)
        if len(versions["at"]) or len(waiting["at"]):
            state.update((packed(versions), packed(waiting)))
            timer = next_timer(versions, waiting)
            if timer is not None:
                state.setTimeoutTimestamp(max(timer, h))
        elif state.exists:
            state.remove()
        yield from out

    return feed.groupBy("bucket").applyInPandasWithState(advance, OUT, "versions binary, waiting binary", "append", "EventTimeTimeout")


# The feed: batches of the two tables in folders, and the runs of the query.


def with_chunks(rows: DataFrame, hot: DataFrame, buckets: int) -> DataFrame:
    """`rows` (client, at, id and others) with chunk, chunks and bucket; `hot` has client and chunks of large clients."""
    salt = F.pmod(F.xxhash64("id", "at"), F.lit(SALTS)).cast("int")
    dealt = hot.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("salt", salt).join(dealt, ["client", "salt"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    share = (F.col("at") / 86_400_000_000 - FIRST_DAY) / float(DAYS)
    chunk = F.greatest(F.lit(0), F.least(F.col("chunks") - 1, F.floor(share * F.col("chunks")))).cast("int")
    # Rows without a client have nothing to meet and are dealt by their ids; changes stay apart from sales.
    nobody = F.col("client") == NONE
    rows = rows.withColumn("chunk", F.when(nobody & (F.col("kind") == CHANGE), -1).otherwise(chunk))
    home = F.when(nobody, F.xxhash64("id")).otherwise(F.xxhash64("client", "chunk"))
    return rows.withColumn("bucket", F.pmod(home, F.lit(buckets)).cast("int")).drop("salt")


def cut(sales: DataFrame, changes: DataFrame, keep, stage: str, client_rows: int, bucket_rows: int) -> tuple[int, int]:
    """Write both tables in batches under `stage`; (buckets, rows)."""
    spark = sales.sparkSession
    no = F.lit(NONE)
    sold = sales.select(
        F.lit(SALE).cast("byte").alias("kind"), F.coalesce(F.col("client_id").cast("long"), no).alias("client"), micros(F.col("sold_at")).alias("at"), no.alias("seq"),
        F.coalesce(F.col("sale_id").cast("long"), no).alias("id"), no.alias("cents"), F.lit(None).cast("string").alias("op"), batch_of(day_of(F.col("arrived_at"))).alias("batch"),
    )
    arrives = day_of(F.col("valid_at")) + F.crc32(F.coalesce(F.col("change_id").cast("string"), F.lit("")).cast("binary")) % 4
    changes = changes.select("change_id", "client_id", "seq", "op", "valid_at", "source", "segment", "city", "balance").where("valid_at is not null").distinct()
    changed = changes.select(
        F.lit(CHANGE).cast("byte").alias("kind"), F.coalesce(F.col("client_id").cast("long"), no).alias("client"), micros(F.col("valid_at")).alias("at"), F.coalesce(F.col("seq").cast("long"), no).alias("seq"),
        F.coalesce(F.col("change_id").cast("long"), no).alias("id"), F.coalesce(cents(F.col("balance")), no).alias("cents"), "op", batch_of(arrives).alias("batch"),
    )
    rows = materialise(sold.unionByName(changed), "valid-time-rows")
    tops = {(r["kind"], r["batch"]): (r["top"], r["n"]) for r in rows.groupBy("kind", "batch").agg(F.max("at").alias("top"), F.count(F.lit(1)).alias("n")).collect()}  # BATCHES rows a table
    total = sum(n for _, n in tops.values())
    buckets = max(1, -(-total // bucket_rows))
    counts = rows.where(F.col("client") != NONE).groupBy("client").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > client_rows)
    hot = materialise(counts.select("client", F.least(F.lit(MOST_CHUNKS), F.ceil(F.col("n") / float(client_rows))).cast("int").alias("chunks")), "valid-time-large-clients")

    seen, before = {}, {}
    for kind in (SALE, CHANGE):
        top = NONE
        for b in range(BATCHES + 1):
            before[kind, b] = top if top == NONE else top - DELAY_HOURS * 3_600_000_000
            top = max(top, tops.get((kind, b), (NONE, 0))[0])
            seen[kind, b] = max(top, 0)
    pick = lambda of, kind: F.element_at(F.array(*[F.lit(of[kind, b]) for b in range(BATCHES + 1)]), F.col("batch") + 1)
    both = lambda of: F.when(F.col("kind") == SALE, pick(of, SALE)).otherwise(pick(of, CHANGE))
    dealt = with_chunks(rows, hot, buckets).withColumns({"mark": both(before), "seen_at": F.timestamp_micros(both(seen))})
    names = [x.split()[0] for x in FEED.split(", ")]
    for kind, name in ((SALE, "sales"), (CHANGE, "changes")):
        ticks = [(-1, TICK, NONE, 0, 1, NONE, NONE, NONE, NONE, None, NONE, seen[kind, b], b) for b in range(BATCHES + 1)]
        fields = FEED.replace("seen_at timestamp", "seen_at long") + ", batch int"
        extra = spark.createDataFrame(ticks, fields)
        if kind == SALE:
            end = {"bucket": F.col("id").cast("int"), "kind": F.lit(FLUSH).cast("byte"), "chunk": F.lit(0), "chunks": F.lit(1), "op": F.lit(None).cast("string"), "seen_at": F.lit(seen[kind, BATCHES]), "batch": F.lit(BATCHES)}
            extra = extra.unionByName(spark.range(buckets).select(*[end.get(c, F.lit(NONE)).alias(c) for c in [*names, "batch"]]))
        extra = extra.withColumn("seen_at", F.timestamp_micros("seen_at"))
        mine = dealt.where(F.col("kind") == kind).select(*names, "batch")
        mine.unionByName(extra).write.partitionBy("batch").parquet(f"{stage}/{name}")
    return buckets, total


def move(spark: SparkSession, source: str, target: str) -> None:
    """A folder gets another name, on any file system that Spark knows."""
    paths = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target)]
    files = paths[0].getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(paths[1].getParent())
    if not files.rename(*paths):
        raise OSError(f"{source} can't be moved to {target}")


def run_batch(spark: SparkSession, home: str, batch: int) -> None:
    """Feed one batch to the query, which is started for it on its checkpoint and stops when it has been read."""
    for name in ("sales", "changes"):
        move(spark, f"{home}/stage/{name}/batch={batch}", f"{home}/feed/{name}/{batch:05d}")
    streams = [
        spark.readStream.schema(FEED).option("recursiveFileLookup", "true").parquet(f"{home}/feed/{name}").withWatermark("seen_at", f"{DELAY_HOURS} hours")
        for name in ("sales", "changes")
    ]
    found = enriched_stream(streams[0].unionByName(streams[1]), batch)
    query = found.writeStream.format("parquet").option("checkpointLocation", f"{home}/checkpoint").outputMode("append").trigger(availableNow=True).start(f"{home}/out")
    query.awaitTermination()


def valid_time_enrichment(sales: DataFrame, changes: DataFrame, client_rows: int = CLIENT_ROWS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """rec, id, batch, n_held, change_id, balance_cents, op of all `sales` and late `changes`."""
    spark = sales.sparkSession
    home = f"{shared_dir(spark)}/pagemill-{spark.sparkContext.applicationId}/valid-time-{uuid.uuid4().hex}"
    with scratch(spark) as keep:
        _, total = cut(sales, changes, keep, f"{home}/stage", client_rows, bucket_rows)
        # Settings that hold for this query alone: its state's partitions stay as they are at the first start.
        streams = spark.newSession()
        cores = spark.sparkContext.defaultParallelism
        streams.conf.set("spark.sql.shuffle.partitions", str(max(cores, -(-total // STATE_ROWS))))
        streams.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "min")
        streams.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
        for batch in range(BATCHES + 1):
            run_batch(streams, home, batch)
        found = spark.read.schema(OUT).parquet(f"{home}/out")
        return keep(_assembled(found), "valid-time")


def _assembled(found: DataFrame) -> DataFrame:
    """Final rows: those of clients of one chunk as they are, sales of clients in chunks with what other chunks hold."""
    value = lambda c: F.when(F.col(c) != NONE, F.col(c))
    late = found.where(F.col("rec") == LATE).select(F.lit("late").alias("rec"), value("id").alias("id"), "batch", *[F.lit(None).cast("long").alias(c) for c in ("n_held", "change_id", "balance_cents")], F.lit(None).cast("string").alias("op"))
    sold = found.where(F.col("rec") == SOLD)
    final = lambda rows: rows.select(F.lit("sale").alias("rec"), value("id").alias("id"), "batch", "n_held", value("change_id").alias("change_id"), value("cents").alias("balance_cents"), "op")

    parts = materialise(found.where(F.col("rec") == PART).select("client", "chunk", "batch", "came", "passed", "passed_at", "version_at", "seq", "change_id", "cents", "op"), "valid-time-parts")
    large = sold.where("chunks > 1")
    needs = large.select("client", "chunk", "batch").distinct()
    # What came by a batch counts in it and later; what passed in a batch is pruned from the next one on.
    until = parts.withColumn("e", F.explode(F.sequence(F.col("batch"), F.lit(BATCHES).cast("long"))))
    older = F.col("batch") < F.col("e")
    whole = until.groupBy("client", "e").agg(F.sum("came").alias("came"), F.coalesce(F.sum(F.when(older, F.col("passed"))), F.lit(0)).alias("gone"), F.coalesce(F.max(F.when(older, F.col("passed_at"))), F.lit(NONE)).alias("last_passed"))
    whole = whole.withColumn("client_held", F.col("came") - F.col("gone") + F.when(F.col("last_passed") != NONE, 1).otherwise(0))
    last = until.groupBy("client", "e", "chunk").agg(F.max(F.struct("version_at", "seq", "change_id", "cents", "op")).alias("last"))
    before = Window.partitionBy("client", "e").orderBy("chunk").rangeBetween(Window.unboundedPreceding, -1)  # MOST_CHUNKS rows at most, and as many needs
    asked = needs.select("client", F.col("batch").alias("e"), "chunk", F.lit(True).alias("asked"))
    carried = last.join(asked, ["client", "e", "chunk"], "full").withColumn("carry", F.max("last").over(before)).where("asked").select("client", "e", "chunk", "carry")
    info = carried.join(whole, ["client", "e"], "left").withColumnRenamed("e", "batch")
    rows = large.join(info, ["client", "chunk", "batch"], "left")
    own = F.col("version_at") != NONE
    pick = F.when(own, F.struct("version_at", "seq", "change_id", "cents", "op")).otherwise(F.col("carry"))
    holds = (F.col("at") != NONE) & (F.coalesce("last_passed", F.lit(NONE)) <= F.col("at"))
    rows = rows.withColumn("v", F.when(holds, pick)).select("id", "batch", F.coalesce("client_held", F.lit(0)).alias("n_held"), F.coalesce("v.change_id", F.lit(NONE)).alias("change_id"), F.coalesce("v.cents", F.lit(NONE)).alias("cents"), F.col("v.op").alias("op"))
    return late.unionByName(final(sold.where("chunks <= 1"))).unionByName(final(rows))


def op12_valid_time_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All `sales` with their client's version at the time of sale, and the `client_changes` that came too late."""
    return valid_time_enrichment(table(spark, sf_dir, "sales"), table(spark, sf_dir, "client_changes"))


OP12_SQL = """
WITH sold AS (
  SELECT sale_id, client_id, sold_at,
         coalesce(greatest(0, least(7, CAST(floor((date_diff('day', DATE '1970-01-01', CAST(arrived_at AS DATE)) - 19723) * 8 / 152) AS BIGINT))), 0) AS b
  FROM sales),
changed AS (SELECT DISTINCT change_id, client_id, seq, op, valid_at, source, segment, city, balance FROM client_changes WHERE valid_at IS NOT NULL),
crc AS (
  SELECT *, xor(list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(coalesce(CAST(change_id AS VARCHAR), ''), ''), lambda s: CAST(ascii(s) AS BIGINT))),
      lambda a, x: list_reduce(list_prepend(xor(a, x), CAST(range(8) AS BIGINT[])), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)))), CAST(4294967295 AS BIGINT)) % 4 AS delay
  FROM changed),
batched AS (
  SELECT *, greatest(0, least(7, CAST(floor((date_diff('day', DATE '1970-01-01', CAST(valid_at AS DATE)) + delay - 19723) * 8 / 152) AS BIGINT))) AS b FROM crc),
marks AS (
  SELECT k.b, (SELECT max(sold_at) FROM sold WHERE sold.b < k.b) - INTERVAL 12 HOUR AS ws, (SELECT max(valid_at) FROM batched WHERE batched.b < k.b) - INTERVAL 12 HOUR AS wc
  FROM range(8) k(b)),
h AS (SELECT b, wc, CASE WHEN ws IS NULL OR wc IS NULL THEN NULL ELSE least(ws, wc) END AS h FROM marks),
late AS (SELECT c.change_id, c.b FROM batched c JOIN h USING (b) WHERE c.valid_at < h.wc),
held AS (
  SELECT c.*, (SELECT min(x.b) FROM h x WHERE x.b >= c.b AND x.h >= c.valid_at) AS passed
  FROM batched c JOIN h USING (b) WHERE h.wc IS NULL OR c.valid_at >= h.wc),
versions AS (
  SELECT *, greatest(b, min(passed) OVER (PARTITION BY client_id ORDER BY valid_at, seq NULLS FIRST, change_id NULLS FIRST ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)) AS g,
         min(passed) OVER (PARTITION BY client_id ORDER BY valid_at, seq NULLS FIRST, change_id NULLS FIRST ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS follows,
         row_number() OVER (PARTITION BY client_id ORDER BY valid_at, seq NULLS FIRST, change_id NULLS FIRST) AS place
  FROM held),
emitted AS (
  SELECT row_number() OVER () AS r, s.*, coalesce((SELECT min(x.b) FROM h x WHERE x.b >= s.b AND (s.sold_at IS NULL OR s.sold_at < x.h)), 8) AS e FROM sold s),
joined AS (
  SELECT s.r, any_value(s.sale_id) AS sale_id, any_value(s.e) AS e, count(v.client_id) AS n_held,
         max(CASE WHEN v.valid_at <= s.sold_at THEN v.place END) AS best, any_value(s.client_id) AS client_id
  FROM emitted s LEFT JOIN versions v ON v.client_id = s.client_id AND v.b <= s.e AND (v.follows IS NULL OR v.g >= s.e)
  GROUP BY s.r)
SELECT 'sale' AS rec, j.sale_id AS id, CAST(j.e AS BIGINT) AS batch, CAST(j.n_held AS BIGINT) AS n_held, v.change_id,
       CAST(floor(100 * v.balance + 0.5) AS BIGINT) AS balance_cents, v.op
FROM joined j LEFT JOIN versions v ON v.client_id = j.client_id AND v.place = j.best
UNION ALL
SELECT 'late', change_id, CAST(b AS BIGINT), NULL, NULL, NULL, NULL FROM late
"""

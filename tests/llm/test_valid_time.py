import datetime as dt
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from pagemill.llm import valid_time as V

SALES = "sale_id long, client_id long, status string, total double, sold_at timestamp_ntz, arrived_at timestamp_ntz, priority int, batch int"
CHANGES = "change_id long, client_id long, seq long, op string, valid_at timestamp_ntz, source string, segment string, city string, balance double, chunk int"
START = dt.datetime(2024, 1, 1)
LOW = -(2**63)


def simulated(sales, changes):
    """The contract's rules, batch by batch and row by row."""
    batch = lambda day: max(0, min(7, math.floor((day - 19723) * 8 / 152)))
    day = lambda t: (t.date() - dt.date(1970, 1, 1)).days
    changes = [c for c in dict.fromkeys(changes) if c[4] is not None]
    order = lambda c: (c[4], LOW if c[2] is None else c[2], LOW if c[0] is None else c[0])
    sold_in = [0 if s[5] is None else batch(day(s[5])) for s in sales]
    changed_in = [batch(day(c[4]) + zlib.crc32(("" if c[0] is None else str(c[0])).encode()) % 4) for c in changes]
    held, waiting, out = {}, [], []
    top_s = top_c = None

    def emit(sale, b):
        mine = held.get(sale[1], []) if sale[1] is not None else []
        fits = [c for c in mine if sale[4] is not None and c[4] <= sale[4]]
        v = max(fits, key=order) if fits else None
        cents = None if v is None or v[8] is None or not math.isfinite(v[8]) else math.floor(100 * v[8] + 0.5)
        out.append(("sale", sale[0], b, len(mine), v and v[0], cents, v and v[3]))

    for b in range(8):
        less = lambda t: None if t is None else t - dt.timedelta(hours=12)
        own, h = less(top_c), None if top_s is None or top_c is None else less(min(top_s, top_c))
        for c, i in zip(changes, changed_in, strict=True):
            if i == b:
                if own is not None and c[4] < own:
                    out.append(("late", c[0], b, None, None, None, None))
                else:
                    held.setdefault(c[1], []).append(c)
        waiting += [s for s, i in zip(sales, sold_in, strict=True) if i == b]
        for s in waiting:
            if s[4] is None or h is not None and s[4] < h:
                emit(s, b)
        waiting = [s for s in waiting if not (s[4] is None or h is not None and s[4] < h)]
        for client, mine in held.items():
            past = sorted((c for c in mine if h is not None and c[4] <= h), key=order)
            held[client] = [c for c in mine if c not in past[:-1]]
        top_s = max((s[4] for s, i in zip(sales, sold_in, strict=True) if i == b and s[4] is not None), default=None) if top_s is None else max([top_s, *(s[4] for s, i in zip(sales, sold_in, strict=True) if i == b and s[4] is not None)])
        seen = [c[4] for c, i in zip(changes, changed_in, strict=True) if i == b]
        top_c = max(seen, default=None) if top_c is None else max([top_c, *seen])
    for s in waiting:
        emit(s, 8)
    return sorted(out, key=str)


def rows_of(seed, n, empty=()):
    rng = random.Random(seed)
    at = lambda: START + dt.timedelta(hours=rng.choice([rng.randrange(24 * 125), rng.randrange(0, 24 * 125, 24)]))
    maybe = lambda x, p=0.03: None if rng.random() < p else x
    client = lambda: maybe(7 if rng.random() < 0.4 else rng.randrange(6))
    sales, changes = [], []
    for i in range(n):
        sold = at()
        arrived = sold + dt.timedelta(hours=rng.choice([0, 0, 3, 30, 700]))
        sales.append((maybe(i, 0.01), client(), "done", 1.0, maybe(sold), maybe(arrived, 0.01), 1, 5))
        changes.append((maybe(i, 0.01), client(), maybe(rng.randrange(3)), rng.choice("IUD"), maybe(at()), "web", None, None, maybe(rng.choice([1.005, -3.0, 17.25, float("nan")])), 9))
    far = START + dt.timedelta(days=151)
    if "late" not in empty:
        sales.append((n, 7, "x", 0.0, far, far, 1, 5))
    return sales + sales[:3], changes + changes[:5]


def found_of(spark, sales, changes, **sizes):
    out = V.valid_time_enrichment(spark.createDataFrame(sales, SALES), spark.createDataFrame(changes, CHANGES), **sizes)
    return sorted((tuple(r) for r in out.select("rec", "id", "batch", "n_held", "change_id", "balance_cents", "op").collect()), key=str)


@pytest.mark.parametrize(("seed", "sizes"), [(1, {}), (2, {"client_rows": 10, "bucket_rows": 50}), (3, {"client_rows": 40, "bucket_rows": 20})])
def test_equals_the_rules_taken_row_by_row(spark, seed, sizes):
    """Large clients in chunks of time give the same as one chunk."""
    sales, changes = rows_of(seed, 300)
    assert found_of(spark, sales, changes, **sizes) == simulated(sales, [c[:9] for c in changes])


def test_batches_without_rows(spark):
    """Nothing arrives in most batches; the watermark still moves and sales are released."""
    day = lambda n: START + dt.timedelta(days=n)
    sales = [(1, 1, "a", 0.0, day(1), day(1), 1, 1), (2, 1, "a", 0.0, day(30), day(30), 1, 1), (3, 1, "a", 0.0, day(140), day(140), 1, 1)]
    changes = [(1, 1, 0, "I", day(0), None, None, None, 1.0, 1), (2, 1, 1, "U", day(29), None, None, None, 2.0, 1), (3, 1, 2, "U", day(28), None, None, None, 3.0, 1)]
    assert found_of(spark, sales, changes) == simulated(sales, [c[:9] for c in changes])
    assert found_of(spark, sales, []) == simulated(sales, [])
    assert found_of(spark, [], changes) == simulated([], [c[:9] for c in changes])


def test_a_batch_that_broke_off_is_taken_up_again(spark, monkeypatch):
    """A batch fails after its rows were fed; started again on the same checkpoint, nothing is lost or there twice."""
    sales, changes = rows_of(5, 120)
    plain, broken = V.run_batch, []

    def breaks(session, home, batch):
        if batch == 3 and not broken:
            broken.append(1)
            stream = V.enriched_stream
            monkeypatch.setattr(V, "enriched_stream", lambda feed, b: failing(stream(feed, b)))
            with pytest.raises(Exception, match="lost"):
                plain(session, home, batch)
            monkeypatch.setattr(V, "enriched_stream", stream)
            monkeypatch.setattr(V, "move", lambda *a: None)
            plain(session, home, batch)
            monkeypatch.undo()
            monkeypatch.setattr(V, "run_batch", breaks)
            return
        plain(session, home, batch)

    def failing(df):
        return df.withColumn("op", F.when(F.col("batch") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("op")))

    monkeypatch.setattr(V, "run_batch", breaks)
    assert found_of(spark, sales, changes) == simulated(sales, [c[:9] for c in changes])
    assert broken

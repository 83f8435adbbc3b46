"""The visited history against sets of Python."""

import random

import pytest
from pyspark.sql import functions as F

from pagemill.operators import history as H
from pagemill.operators.history import VisitedHistory


def urls(spark, values):
    return spark.createDataFrame([(v,) for v in values], "url string")


def seen_of(history, spark, values, **before):
    return sorted(r.url for r in history.seen(urls(spark, values), **before).collect())


def test_seen_equals_a_set_for_any_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(H, "FANOUT", 2)
    rnd = random.Random(5)
    history, there = VisitedHistory(spark, f"file://{tmp_path}/h", 4, 2), set()
    ask = [f"http://{'hot' if i % 3 else f's{i % 11}'}.test/{i}" for i in range(0, 400, 2)] + [None, "", "no host", "HTTP://HOT.test/4"]
    assert seen_of(history, spark, ask) == []
    for batch in range(8):
        new = [f"http://{'hot' if i % 3 else f's{i % 11}'}.test/{i}" for i in rnd.sample(range(400), 30)] + [None, "", ""][: batch % 4]
        if batch == 4:
            new = []
        if batch % 3 == 2:
            assert seen_of(history, spark, ask, before=batch) == sorted(u for u in ask if u in there and u is not None)
        history.add(urls(spark, new), batch)
        there |= set(new)
    assert seen_of(history, spark, ask) == sorted(u for u in ask if u in there and u is not None)
    assert {g[2] for g in history.generations()} == {0, 1, 2} and len(list(tmp_path.glob("h/*"))) == len(history.generations())
    history.add(urls(spark, ["http://late.test/"]), 1)  # merged since: a repetition changes nothing
    assert seen_of(history, spark, ["http://late.test/"]) == []
    with pytest.raises(ValueError):
        history.seen(urls(spark, ask), before=1)


def test_a_batch_that_breaks_off_does_not_count_until_it_is_written_again(spark, tmp_path, monkeypatch):
    history = VisitedHistory(spark, f"file://{tmp_path}/h", 4, 2)
    history.add(urls(spark, ["http://a.test/1"]), 0)

    def no_bits(url):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(H, "bits_of", no_bits)
        for batch, new in ((0, "http://a.test/2"), (1, "http://a.test/3")):
            with pytest.raises(OSError):
                history.add(urls(spark, [new]), batch)
    assert history.generations() == []
    history.add(urls(spark, ["http://a.test/1"]), 0)
    history.add(urls(spark, ["http://a.test/3"]), 1)
    asked = [f"http://a.test/{i}" for i in range(5)]
    assert seen_of(history, spark, asked) == ["http://a.test/1", "http://a.test/3"]
    assert seen_of(history, spark, asked, before=1) == ["http://a.test/1"]


def test_a_round_reads_the_parts_of_its_sites_only(spark, tmp_path):
    history = VisitedHistory(spark, f"file://{tmp_path}/h")
    page = lambda site, i: F.concat(F.lit("https://s"), site, F.lit(".test/"), i)
    ids = spark.range(60_000)
    history.add(ids.select(page(F.col("id") % 500, F.col("id")).alias("url")), 0)
    fresh = ids.select(page(F.col("id") % 500, F.col("id") + 60_000).alias("url"))
    passed = history.maybe(fresh).count()
    assert passed < 60_000 * 0.02 and history.seen(fresh).count() == 0
    one = ids.where("id % 500 in (7, 8)").select(page(F.col("id") % 500, F.col("id") * 2).alias("url"))
    want = ids.where("id % 500 in (7, 8)").select(page(F.col("id") % 500, F.col("id") * 2).alias("url")).join(ids.select(page(F.col("id") % 500, F.col("id")).alias("url")), "url").count()
    assert history.seen(one).count() == want
    known = ids.where("id % 500 in (7, 8)").select(page(F.col("id") % 500, F.col("id")).alias("url"))
    assert history.seen(known).count() == 240
    assert 0 < history.share_read(known) < 0.04


def test_many_candidates_are_looked_up_in_the_urls_and_few_in_the_filters(spark, tmp_path, monkeypatch):
    """a lookup in the filters is a row for each candidate and generation, more than the URLs themselves."""
    history = VisitedHistory(spark, f"file://{tmp_path}/h", 2, 1)
    for batch in range(2):
        history.add(urls(spark, [f"http://a.test/{i}" for i in range(batch * 100, batch * 100 + 150)] + ["http://b.test/1"]), batch)
    asked = [f"http://a.test/{i}" for i in range(0, 500, 2)] + ["http://none.test/", None, "http://b.test/1"]
    want = sorted([f"http://a.test/{i}" for i in range(0, 250, 2)] + ["http://b.test/1"])
    assert seen_of(history, spark, asked) == want
    assert seen_of(history, spark, ["http://a.test/7", "http://a.test/700"]) == ["http://a.test/7"]
    monkeypatch.setattr(H, "is_set", lambda bits, at: F.lit(False))
    assert seen_of(history, spark, asked) == want
    assert seen_of(history, spark, ["http://a.test/7"]) == []

"""Rounds, stored tasks, streams of landed pages and of task events, open JSON and the index of rules."""

import json
import random
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from pagemill.operators import articles as A
from pagemill.operators import pages as P
from pagemill.operators import records, rounds, storage
from pagemill.operators import sites as S
from pagemill.operators import tasks as T
from pagemill.operators.task_store import TaskStore
from pagemill.plans import queries, stream_queries
from pagemill.streaming import claims, figures, landing, lifecycle
from pagemill.streaming.schedule import step

GOOD = "<h1>Eine Seite {}</h1><article><p>" + "Text der Seite. " * 5 + "</p></article>"
LANDED = "url string, html string, site string, channel string, place int"
NOW = "2026-01-01 00:00:00"
SITES = [("s", "k", None), ("t", "k", "n")]


def as_of():
    return F.to_timestamp_ntz(F.lit("2026-09-17 08:05:09"))


def sites(spark):
    return spark.createDataFrame(SITES, "name string, category string, sub_category string")


def no_tasks(spark):
    return spark.createDataFrame([], T.TASKS)


def landed_rows(n, bad=lambda i: i % 4 == 0):
    return [(f"http://x.test/{i}", "<h1>x</h1>" if bad(i) else GOOD.format(i), "s" if i % 3 else "t", "c", i) for i in range(n)]


def test_every_page_is_an_article_or_a_reject(spark):
    rows = [("u1", GOOD, "s", "c"), (None, GOOD, "s", "c"), (" ", GOOD, "s", "c"), ("u2", "<h1>x</h1>", "s", None), ("u3", GOOD, None, None), ("u4", None, "t", None), ("u1", GOOD, "s", "c")]
    found, rejected = A.articles_of(spark.createDataFrame(rows, "url string, html string, site string, channel string"), sites(spark), as_of())
    assert sorted(r.url for r in found.collect()) == ["u1", "u1", "u3"]
    assert sorted((str(r.url), r.reject_reason) for r in rejected.collect()) == [(" ", "blank url"), ("None", "missing field"), ("u2", "no title"), ("u4", "no title")]


def test_round_accounts_for_every_row(spark):
    rows = [("u1", GOOD, "s", "c", 1), ("u1", "<h1>x</h1>", "s", "c", 0), (None, GOOD, "s", "c", 2), (None, GOOD, "s", "c", 3), ("  ", GOOD, "t", "c", 4), ("u2", GOOD, "t", "c", 5), ("u3", GOOD, "t", "c", 6), ("u4", GOOD, "t", "c", 7), ("u5", GOOD, "t", "c", 8)]
    old = [("article", "u3", "t", "c", "deferred", "start", 2, "e", "", 0, "", "2025"), ("article", "u4", "t", "c", "pending", "start", 1, "e", "", 0, "", "2025")]
    visited = spark.createDataFrame([("u4",), ("elsewhere",)], "url string")
    out = rounds.crawl_round(spark.createDataFrame(rows, LANDED), spark.createDataFrame(old, T.TASKS), sites(spark), as_of(), NOW, visited)
    told = {(r.url, r.outcome): r.rows for r in out.outcomes.collect()}
    assert told == {("u1", "rejected"): 1, ("u1", "repeated"): 1, (None, "rejected"): 2, ("  ", "rejected"): 1, ("u2", "article"): 1, ("u3", "deferred"): 1, ("u4", "visited"): 1, ("u5", "article"): 1}
    assert sum(told.values()) == len(rows)
    state = {r.url: (r.status, r.failures) for r in out.tasks.collect()}
    assert state == {"u1": ("pending", 1), "u2": ("done", 0), "u3": ("deferred", 2), "u4": ("done", 0), "u5": ("done", 0)}
    done = {r.url for r in out.tasks.where("status = 'done' and updated = '2026-01-01 00:00:00'").collect()} - {"u4"}
    assert done == {r.url for r in out.articles.collect()} == {r.url for r in out.visited.collect()}
    assert sorted((str(r.url), r.reject_reason) for r in out.rejected.collect()) == [("  ", "blank url"), ("None", "missing field"), ("None", "missing field"), ("u1", "no title")]


def test_a_round_reads_each_page_once(spark, monkeypatch):
    plans = []
    plain = storage.written

    def watched(df, label):
        plans.append(df._jdf.queryExecution().toString())
        return plain(df, label)

    monkeypatch.setattr(rounds, "written", watched)
    out = rounds.crawl_round(spark.createDataFrame(landed_rows(9), LANDED), no_tasks(spark), sites(spark), as_of(), NOW)
    assert sum("MapInArrow" in p for p in plans) == 1
    assert all("MapInArrow" not in df._jdf.queryExecution().toString() for df in (out.articles, out.rejected, out.tasks, out.outcomes))


@pytest.mark.parametrize("bad", [lambda i: i % 4 == 0, lambda i: i < 40, lambda i: True])
def test_pages_are_read_on_demand(spark, monkeypatch, bad):
    """The first three articles of each site, with fewer pages read than there are, and never twice as many as used."""
    read = spark.sparkContext.accumulator(0)
    plain = P.H.article_of
    rows = landed_rows(120, bad)

    def counted(df, label):
        out = storage.written(df, label)
        if label == "round-part":
            read.add(out.count())
        return out

    monkeypatch.setattr(rounds, "written", counted)
    out = rounds.crawl_round(spark.createDataFrame(rows, LANDED).repartition(4), no_tasks(spark), sites(spark), as_of(), NOW, per_site=3)
    want = {site: [r[0] for r in rows if r[2] == site and not bad(r[4])][:3] for site in ("s", "t")}
    assert sorted(r.url for r in out.articles.collect()) == sorted(want["s"] + want["t"])
    told = {r.outcome: r.n for r in out.outcomes.groupBy("outcome").agg(F.sum("rows").alias("n")).collect()}
    assert sum(told.values()) == 120
    used = told.get("article", 0) + told.get("rejected", 0)
    assert used <= read.value <= 2 * used + 6 and plain is P.H.article_of
    if not all(bad(i) for i in range(120)):
        assert read.value < 100 and out.tasks.where("phase = 'queued'").count() == told["unread"]


@pytest.mark.parametrize("most", [50, 100_000])
def test_placed_numbers_a_large_part_in_many_tasks(spark, most):
    rows = [("a" if i < 900 else None, (i * 7919) % 1000, i) for i in range(1000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that tasks show how rows are dealt
    found = storage.placed(spark.createDataFrame(rows, "part string, x int, i int").repartition(6), ["part"], ["x", "i"], most=most)
    places = {(r.part, r.x, r.i): r.place for r in found.collect()}
    for part in ("a", None):
        mine = sorted((x, i) for p, x, i in rows if p == part)
        assert [places[part, x, i] for x, i in mine] == list(range(1, len(mine) + 1))
    tasks = [r["n"] for r in found.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n")).collect()]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert most > 1000 or (len(tasks) > 2 and max(tasks) < 500)


def test_store_makes_a_change_with_a_token_once(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame(old_tasks(40), T.TASKS)
    path = f"file://{tmp_path}/store"
    store = TaskStore(spark, path, 4)
    store.apply(rows, lambda none: none.unionByName(rows))
    fails = rows.select("kind", "url", F.lit("fail").alias("event"), F.lit("x").alias("error"))
    want = sorted(map(tuple, T.advanced(rows, fails, NOW).collect()))
    monkeypatch.setattr("pagemill.operators.task_store.make_folder", lambda *a: 1 // 0)
    with pytest.raises(ZeroDivisionError):
        store.advance(fails, NOW, token="a")
    monkeypatch.undo()
    store = TaskStore(spark, path, 4)
    assert store.advance(fails, NOW, token="a") == [] and sorted(map(tuple, store.read().collect())) == want


def files_of(store):
    return {str(p.relative_to(store)) for p in Path(store).rglob("*.parquet")}


def old_tasks(n):
    return [("article", f"u{i}", "s", "c", random.Random(i).choice(["pending", "running", "deferred", "done"]), "start", i % 2, "", "", 0, "", "2025") for i in range(n)]


def test_store_rewrites_only_the_buckets_that_a_change_touches(spark, tmp_path):
    store = TaskStore(spark, f"file://{tmp_path}/store", 16)
    rows = spark.createDataFrame(old_tasks(400), T.TASKS)
    assert len(store.apply(rows, lambda none: none.unionByName(rows))) == 16
    before = files_of(tmp_path / "store/tasks")
    changes = spark.createDataFrame([("article", "u5", 1, "saved"), ("article", "unknown", 1, "saved")], "kind string, url string, seq int, phase string")
    touched = store.change(changes, ["seq"], NOW)
    after = files_of(tmp_path / "store/tasks")
    assert len(touched) <= 2 and {f for f in before - after} and all(any(f"bucket={b}/" in f for b in touched) for f in before ^ after)
    want = {r.url: r.asDict() for r in T.changed_tasks(rows, changes, ["seq"], NOW).collect()}
    assert {r.url: r.asDict() for r in store.read().collect()} == want
    assert [r.phase for r in store.task("article", "u5").collect()] == ["saved"] and store.task("article", "none").count() == 0
    plan = store.task("article", "u5")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan


def test_store_equals_whole_table_functions(spark, tmp_path):
    rows = spark.createDataFrame(old_tasks(300), T.TASKS)
    store = TaskStore(spark, f"file://{tmp_path}/store", 8)
    store.apply(rows, lambda none: none.unionByName(rows))
    found = spark.createDataFrame([("article", f"u{i}", "z", "z", i) for i in range(250, 350)] + [(None, "x", "z", "z", 1)], "kind string, url string, site string, channel string, ord int")
    events = spark.createDataFrame([("article", f"u{i}", random.Random(i).choice(["begin", "fail", "over_limit", "done"]), "boom") for i in range(0, 350, 3)], "kind string, url string, event string, error string")
    visited = spark.createDataFrame([(f"u{i}",) for i in range(0, 350, 5)], "url string")
    store.add(found, ["ord"], NOW)
    store.advance(events, NOW)
    store.heal(visited, NOW)
    store.recover("later")
    want, n = T.retried(T.recovered(T.healed(T.advanced(T.add_tasks(rows, found, ["ord"], NOW), events, NOW), visited, NOW), "later"), "u1", "u2", "u3")
    assert store.retry("u1", "u2", "u3") == n.first()[0]
    assert sorted(map(tuple, store.read().collect())) == sorted(map(tuple, want.collect()))


def test_store_finishes_or_drops_what_broke_off(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame(old_tasks(60), T.TASKS)
    path = f"file://{tmp_path}/store"
    store = TaskStore(spark, path, 4)
    store.apply(rows, lambda none: none.unionByName(rows))
    change = lambda phase: spark.createDataFrame([("article", f"u{i}", 1, phase) for i in range(60)], "kind string, url string, seq int, phase string")
    monkeypatch.setattr(TaskStore, "_swap", lambda self, stage: 1 // 0)
    with pytest.raises(ZeroDivisionError):
        store.change(change("one"), ["seq"], NOW)
    monkeypatch.undo()
    assert {r.phase for r in TaskStore(spark, path, 4).read().collect()} == {"one"}  # its rows were complete
    half = tmp_path / "store/changes/half"
    half.mkdir(parents=True)
    (half / "part-0.parquet").write_bytes(b"torn")
    assert {r.phase for r in TaskStore(spark, path, 4).read().collect()} == {"one"} and not half.exists()


def start(spark, home, files=2, **kwargs):
    query = landing.landing_stream(spark, f"{home}/landed", str(home), sites(spark), as_of(), NOW, files_per_batch=files, buckets=4, **kwargs)
    query.awaitTermination()


def landed_files(spark, home, rows, files):
    spark.createDataFrame(rows, LANDED).drop("place").repartition(files).write.mode("append").parquet(f"{home}/landed")


def written_articles(home):
    return sorted(json.loads(line)["url"] for p in Path(home).glob("articles/**/*.json") for line in p.read_text().splitlines())


@pytest.mark.parametrize("at", ["write_visited", "write_log", "write_articles", "advance", "remove"])
def test_a_stream_that_breaks_off_loses_and_repeats_nothing(spark, tmp_path, monkeypatch, at):
    home = f"file://{tmp_path}"
    rows = landed_rows(60) + [(None, GOOD, "s", "c", 0), ("http://x.test/1", GOOD, "t", "c", 0)]
    landed_files(spark, home, rows, 4)
    calls = []
    target = {"write_articles": (P, "write_articles"), "advance": (TaskStore, "advance")}.get(at, (landing, at))
    plain = getattr(*target)

    def breaks(*args, **kwargs):
        calls.append(1)
        if len(calls) == {"remove": 1}.get(at, 2):
            raise RuntimeError("gone")
        return plain(*args, **kwargs)

    monkeypatch.setattr(*target, breaks)
    with pytest.raises(Exception, match="gone"):
        start(spark, home)
    monkeypatch.undo()
    start(spark, home)
    start(spark, home)  # nothing new
    good = sorted({r[0] for r in rows if r[0] and (r[4] % 4 or r[0] == "http://x.test/1")})
    assert written_articles(tmp_path) == good
    assert sorted(x for p in tmp_path.glob("visited/**/*.txt") for x in p.read_text().split()) == good
    tasks = {r.url: r for r in TaskStore(spark, f"{home}/tasks", 4).read().collect()}
    assert {u for u, r in tasks.items() if r.status == "done"} == set(good)
    # Pages of the batch that broke off have failed once more than those of the other.
    assert {r.status for u, r in tasks.items() if u not in good} <= {"pending", "deferred"} and not {r.status for r in tasks.values()} & {"running"}
    log = {r.outcome: r.rows for r in landing.log_of(spark, home).groupBy("outcome").agg(F.sum("rows").alias("rows")).collect()}
    assert sum(log.values()) == len(rows) and log["article"] == len(good)
    counts = landing.written_counts(spark, home).where("level = 3").first()
    assert counts.n_articles == len(good)


def test_visited_pages_of_earlier_batches_are_skipped_and_heal_tasks(spark, tmp_path):
    home = f"file://{tmp_path}"
    landed_files(spark, home, landed_rows(10, lambda i: False), 1)
    start(spark, home)
    store = TaskStore(spark, f"{home}/tasks", 4)
    store.change(spark.createDataFrame([("article", "http://x.test/3", 1, "deferred")], "kind string, url string, seq int, status string"), ["seq"], NOW)
    landed_files(spark, home, landed_rows(12, lambda i: False), 1)
    start(spark, home)
    assert written_articles(tmp_path) == sorted(f"http://x.test/{i}" for i in range(12))
    log = {(r.batch, r.outcome): r.rows for r in landing.log_of(spark, home).collect()}
    assert all(r.peak_mb > 10 for r in landing.log_of(spark, home).where("outcome = 'article'").collect()) and log == {(0, "article"): 10, (1, "article"): 2, (1, "visited"): 10}
    assert {r.status for r in TaskStore(spark, f"{home}/tasks", 4).read().collect()} == {"done"}


def test_figures_of_a_run_with_a_page_over_its_limit(spark, tmp_path):
    home = f"file://{tmp_path}"
    landed_files(spark, home, [*landed_rows(12), ("http://x.test/long", GOOD + "y" * 5000, "s", "c", 0)], 1)
    seen = figures.with_figures(spark)
    query = landing.landing_stream(spark, f"{home}/landed", home, sites(spark), as_of(), NOW, buckets=4, characters=4000)
    query.awaitTermination()
    seen.wait(query)
    spark.streams.removeListener(seen)
    row = seen.table(spark).where("rows > 0").first()
    assert (row.batch, row.rows % 13, row.query) == (0, 0, str(query.id)) and row.trigger_ms >= row.sink_ms > 0 and not seen.failed
    log = {(r.outcome, r.reason): (r.rows, r.peak_mb) for r in landing.log_of(spark, home).collect()}
    assert log["rejected", "over limit"][0] == 1 and log["rejected", "no title"][0] == 3 and log["article", None][0] == 9 and log["rejected", "over limit"][1] > 10
    tasks = {r.url: r for r in TaskStore(spark, f"{home}/tasks", 4).read().collect()}
    assert (tasks["http://x.test/long"].status, tasks["http://x.test/long"].phase, tasks["http://x.test/long"].error) == ("deferred", "memory_limit", "over limit")


EVENTS = "key long, ts timestamp, seq long, event string"


class FakeHandle:
    """A processor's handle over dicts; it holds one key's state."""

    def __init__(self):
        self.rows, self.values, self.timers = {}, {}, []
        self.registerTimer, self.deleteTimer = self.timers.append, self.timers.remove

    def getMapState(self, name, key, value):
        self.getValue, self.updateValue, self.removeKey = self.rows.get, self.rows.__setitem__, self.rows.__delitem__
        return self

    def getValueState(self, name, schema):
        self.get, self.update, self.clear = lambda: self.values.get(name), lambda v: self.values.__setitem__(name, v), self.values.clear
        return self


def lifecycle_run(spark, home, rows, **kwargs):
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(f"{home}/in")
    session = lifecycle.with_state_store(spark, 2)
    feed = session.readStream.schema(EVENTS).parquet(f"{home}/in")
    query = lifecycle.task_lifecycle(feed, "10 minutes", **kwargs).writeStream.outputMode("update").option("checkpointLocation", f"{home}/checkpoint").trigger(availableNow=True)
    got = []
    query = query.foreachBatch(lambda df, n: got.extend(tuple(r) for r in df.collect())).start()
    query.awaitTermination()
    return got, {r.key: (r.status, r.failures) for r in lifecycle.task_states(session, f"{home}/checkpoint").collect()}


def test_lifecycle_state_survives_restarts_and_equals_the_steps(spark, tmp_path):
    import datetime as dt

    rng, rows = random.Random(4), []
    at = dt.datetime(2024, 1, 1)
    for i in range(160):
        at += dt.timedelta(minutes=1)
        rows.append((rng.randrange(9), at, i, rng.choice(["begin", "fail", "over_limit", "done", "retry"])))
    for start_ in range(0, 160, 40):
        _, states = lifecycle_run(spark, f"file://{tmp_path}", rows[start_ : start_ + 40])
    want = {}
    for key, _, _, event in rows:
        want[key] = step(*want.get(key, ("pending", 0)), event)
    assert states == want


def test_lifecycle_timers_end_leases_and_forget_done_tasks(spark, tmp_path):
    import datetime as dt

    at = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    home, wait = f"file://{tmp_path}", {"lease_ms": 30 * 60_000, "keep_ms": 60 * 60_000}
    _, states = lifecycle_run(spark, home, [(1, at(0), 0, "begin"), (2, at(0), 1, "done"), (3, at(0), 2, "fail"), (4, at(5), 3, "begin")], **wait)
    assert states == {1: ("running", 0), 2: ("done", 0), 3: ("pending", 1), 4: ("running", 0)}
    told, states = lifecycle_run(spark, home, [(4, at(44), 4, "done"), (5, at(45), 5, "begin")], **wait)
    assert states[1] == ("pending", 1) and states[4] == ("done", 0) and (1, "pending", 1, "broke off") in told
    told, states = lifecycle_run(spark, home, [(1, at(130), 6, "begin")], **wait)
    assert set(states) == {1, 3, 5} and states[5] == ("pending", 1) and (2, "forgotten", 0, "kept") in told and (4, "forgotten", 0, "kept") in told


def test_lifecycle_is_called_once_a_bucket_for_any_number_of_keys():
    """F8: a call for each task cost milliseconds each. Null keys and keys that floats can't tell apart stay themselves."""
    import datetime as dt

    import pandas as pd

    held = FakeHandle()
    tasks = lifecycle.TaskLifecycle(lease_ms=1000)
    tasks.init(held)
    at, last = dt.datetime(2024, 1, 1), 2**53
    rows = pd.DataFrame([(last + i % 500, at + dt.timedelta(seconds=i), i, "begin" if i < 500 else "fail") for i in range(750)], columns=["key", "ts", "seq", "event"])
    (told,) = tasks.handleInputRows((3,), iter([rows[400:], rows[:400]]), None)
    assert {r.key: (r.status, r.failures) for r in told.itertuples()} == {last + i: ("pending", 1) if i < 250 else ("running", 0) for i in range(500)}
    assert held.timers == [int((at - dt.datetime(1970, 1, 1)).total_seconds() + 251) * 1000]
    (told,) = tasks.handleInputRows((-1,), iter([rows[:1]]), None)
    assert told["key"].tolist() == [None]


def test_lifecycle_keeps_null_keys_and_large_ones_apart(spark, tmp_path):
    import datetime as dt

    rows = [(k, dt.datetime(2024, 1, 1), i, "fail") for i, k in enumerate([None, 0, 2**53, 2**53 + 1, None, -1])]
    told, states = lifecycle_run(spark, f"file://{tmp_path}", rows)
    assert states == {None: ("deferred", 2)} | {k: ("pending", 1) for k in (0, 2**53, 2**53 + 1, -1)}
    assert {t[0]: t[1:3] for t in told} == states


@pytest.mark.parametrize("seed", [1, 2])
def test_first_claims_are_the_same_for_any_batches(spark, tmp_path, seed):
    """Rows come up to ten minutes late in batches of any size; each URL is given out once, and to the first."""
    import datetime as dt

    rng = random.Random(seed)
    rows = [(f"u{rng.randrange(25)}", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), i, f"s{i}", "c") for i in range(150)]
    came = sorted(rows, key=lambda r: (r[1] + dt.timedelta(minutes=rng.random() * 9), r[2]))
    session, got, home = lifecycle.with_state_store(spark, 2), [], f"file://{tmp_path}"
    while came:
        n = rng.randint(20, 80)
        spark.createDataFrame(came[:n], claims.CLAIMS).coalesce(1).write.mode("append").parquet(f"{home}/in")
        came = came[n:]
        out = claims.first_claims(session.readStream.schema(claims.CLAIMS).parquet(f"{home}/in"), "10 minutes")
        query = out.writeStream.outputMode("append").option("checkpointLocation", f"{home}/checkpoint").trigger(availableNow=True).foreachBatch(lambda df, n: got.extend(tuple(r) for r in df.collect())).start()
        query.awaitTermination()
    first = {}
    for r in rows:
        first.setdefault(r[0], (r[0], r[2], r[3], "c"))
    assert len(got) == len({g[0] for g in got}) and all(first[g[0]] == g for g in got) and len(got) > 10
    held = claims.claims_so_far(session, f"{home}/checkpoint").collect()
    assert {r.url: (r.url, r.seq, r.site, r.channel) for r in held} == first and sum(r.told for r in held) == len(got)


def test_open_json(spark):
    good = {"url": "u", "title": "t", "content": ""}
    lines = [good, good | {"url": 5}, good | {"title": None}, good | {"images": ["a", None]}, good | {"images": []}, good | {"images": ["a"], "site_name": "x"}, good | {"docNumber": {"a": 1}}, good | {"siteName": "", "site_name": 7, "media_name": "m"}, [1], good | {"channel": " "}]
    lines = [json.dumps(x) for x in lines] + ['{"url": "u', "", None]
    df = spark.createDataFrame([(i, x, "Ch") for i, x in enumerate(lines)], "i int, value string, cfg_channel string")
    rows = {r.i: r for r in records.typed(df).collect()}
    why = [None, "url is no string", "title is no string", "images aren't strings", None, None, "docNumber is no string", "siteName is no string", "not an object", None, "malformed", "malformed", "malformed"]
    assert [rows[i].reject_reason for i in range(13)] == why and all((rows[i].article is None) == (w is not None) for i, w in enumerate(why))
    assert rows[5].article.siteName == "x" and rows[5].article.images == ["a"] and rows[9].article.channel == "Ch" and rows[4].article.images == []
    articles, rejected = records.canonical_lines(df)
    assert articles.count() == 4 and rejected.count() == 9 and tuple(articles.columns) == P.FIELDS
    with pytest.raises(Exception, match="rejected: "):
        records.canonical_lines(df, strict=True)[0].collect()


def test_contained_equals_all_pairs(spark):
    rng = random.Random(3)
    word = lambda a, b: "".join(rng.choice("ab县市") for _ in range(rng.randint(a, b)))
    texts, parts = {word(0, 9) for _ in range(80)}, {word(0, 5) for _ in range(60)}
    frame = lambda xs, c: spark.createDataFrame([(x,) for x in [*xs, None]], f"{c} string")
    found = S.contained(frame(texts, "t"), "t", frame(parts, "p"), "p")
    assert sorted((r.t, r.p) for r in found.collect()) == sorted((t, p) for t in texts for p in parts if p in t)


def test_many_rules_meet_without_a_nested_loop(spark):
    rules = spark.range(100_000).select(F.element_at(F.array(*[F.lit(t) for t in S.TIERS]), (F.col("id") % len(S.TIERS) + 1).cast("int")).alias("tier"), F.col("id").cast("int").alias("ord"), F.md5(F.col("id").cast("string")).alias("key"), F.lit("u").alias("url"))
    names = spark.range(500).select(F.concat(F.lit("x"), F.md5((F.col("id") * 181).cast("string")), F.lit("y")).alias("name"), F.lit("").alias("url"))
    found = S.resolve(names, rules)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    kinds = {r.source_type.split("_HUB")[0] for r in found.select("source_type").distinct().collect()}
    assert {"MINISTRY_FUZZY", "LOCAL_FUZZY", "PROVINCIAL"} <= kinds


def test_rules_and_names_go_round_in_no_broadcast(spark):
    """Explosion is nothing that Spark estimates: postings of a small file were sent through the driver."""
    part = spark.range(400).select(F.concat(F.lit("red bolt "), "id").alias("name"), F.lit("").alias("url"), F.col("id").cast("int").alias("ord"))
    rules = part.select(F.element_at(F.array(*[F.lit(t) for t in S.TIERS]), (F.col("ord") % len(S.TIERS) + 1).cast("int")).alias("tier"), "ord", F.substring("name", 5, 9).alias("key"), F.lit("u").alias("url"))
    found = S.resolve(part, rules)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortMergeJoin" in plan and plan.count("BroadcastHashJoin") <= 2  # the widths of the keys, at most five rows, and those of the names


def test_long_parts_meet_few_texts(spark):
    """A key is looked up by a gram of eight characters, where it has them: grams of three would meet hundreds of names each."""
    names = spark.range(20_000).select(F.concat(F.lit("red bolt "), "id").alias("t"))
    parts = spark.range(20_000).where("id % 2 = 1").select(F.concat(F.lit("x bolt "), "id").alias("p"))
    grams = lambda df, c: df.select(c, F.explode(S.grams(F.col(c), S.width_of(F.col(c)))).alias("g"))
    each = grams(names, "t").groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    most = grams(parts, "p").join(each, "g", "left").groupBy("p").agg(F.min(F.coalesce("n", F.lit(0))).alias("n")).agg(F.max("n")).first()[0]
    assert most < 50
    assert S.contained(names, "t", parts, "p").count() == 0


def test_manifests_keep_the_order_of_their_files(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"m{i}.json").write_text(json.dumps([{"name": f"n{j % 4}", "category": str(10 * i + j)} for j in range(10)]))
    rows = S.read_manifest(spark, f"{tmp_path}/*.json").collect()
    assert [r.category for r in sorted(rows, key=lambda r: r.ord)] == [str(i) for i in range(30)]
    built = {r.name: (r.ord, r.category) for r in S.build_sites(S.read_manifest(spark, f"{tmp_path}/*.json")).collect()}
    assert built == {"n0": (1, "28"), "n1": (2, "29"), "n2": (3, "26"), "n3": (4, "27")}
    assert S.read_manifest(spark, f"{tmp_path}/none.json").count() == 0


def test_queries_work_in_folders_of_their_own(spark):
    sf = "/root/testdata/sf0.001"
    one, two = (sorted(map(str, stream_queries.sink_counts(spark, sf).collect())) for _ in range(2))
    assert one == two


@pytest.fixture(scope="module")
def odd_pages(spark, tmp_path_factory):
    """The pages of sf0.001 with headings of one to three characters, and pages of other pages' URLs."""
    home = tmp_path_factory.mktemp("odd")
    page = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    short = F.when(F.col("page_id") % 4 == 1, F.regexp_replace("html", "<h1>[^<]*</h1>", "<h1>to.</h1>")).otherwise(F.col("html"))
    again = page.where("page_id % 3 < 2").withColumn("page_id", F.col("page_id") + 1_001)
    page.withColumn("html", short).unionByName(again).coalesce(1).write.parquet(f"{home}/pages.parquet")
    return str(home)


@pytest.mark.parametrize("name", ["article_extract", "article_records", "page_isolation"])
def test_short_headings_are_titles_as_in_sql(spark, odd_pages, name):
    same_as_sql(spark, odd_pages, name)


@pytest.mark.parametrize("name", ["crawl_round", "round_outcomes", "sink_counts"])
def test_pages_of_one_url_all_count_as_in_sql(spark, odd_pages, name):
    same_as_sql(spark, odd_pages, name)


def same_as_sql(spark, home, name):
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW pages AS SELECT * FROM '{home}/pages.parquet/*.parquet'")
        found = db.execute(queries.SQL[name])
        columns, want = [c[0] for c in found.description], found.fetchall()
    got = queries.QUERIES[name](spark, home).select(*columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_first_claims_take_one_call_a_bucket():
    """a call for each URL cost milliseconds each."""
    import datetime as dt

    import pandas as pd

    held, first = FakeHandle(), claims.FirstClaim()
    first.init(held)
    at = dt.datetime(2024, 1, 1)
    rows = pd.DataFrame([(f"u{i % 300}", at + dt.timedelta(seconds=900 - i), i, f"s{i}", None) for i in range(900)], columns=["url", "ts", "seq", "site", "channel"])
    assert list(first.handleInputRows((3,), iter([rows[:500], rows[500:]]), None)) == []
    us = lambda i: int((at - dt.datetime(1970, 1, 1)).total_seconds() + 900 - i) * 1_000_000
    assert held.rows == {(f"u{i % 300}",): (us(i), i, f"s{i}", None, False) for i in range(600, 900)} and held.timers == [us(899) // 1000]

    class Passed:
        getCurrentWatermarkInMs = staticmethod(lambda: us(850) // 1000)

    (told,) = first.handleExpiredTimer((3,), Passed, None)
    assert sorted(told["seq"]) == list(range(850, 900)) and us(849) // 1000 in held.timers
    assert {k[0] for k, v in held.rows.items() if v[4]} == set(told["url"])

import json
import subprocess
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

from pagemill.functions import columns as C
from pagemill.operators import pages as P
from pagemill.operators import sites as S
from pagemill.operators import tasks as T
from pagemill.plans import task_queries as Q
from pagemill.plans.config import RunConfig
from pagemill.streaming import schedule

SF = "/root/testdata/sf0.001"


def task_rows(spark, *rows):
    full = [(k, u, s, "c", st, "start", f, "e", "p", 1, "", up) for k, u, s, st, f, up in rows]
    return spark.createDataFrame(full, T.TASKS)


@pytest.mark.parametrize("name", list(Q.SQL))
def test_queries_equal_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "orders", "lineitem", "supplier", "events"):
        db.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    want = db.sql(Q.SQL[name]).df()
    got = Q.QUERIES[name](spark, SF).toPandas()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    plain = lambda d: sorted(map(str, d[columns].astype(object).where(d[columns].notna(), None).values.tolist()))
    assert plain(got) == plain(want) and len(got)


def test_frontier_of_a_large_table(spark):
    large, db = "/root/testdata/sf0.1", duckdb.connect()
    for table in ("orders", "lineitem"):
        db.sql(f"create view {table} as select * from '{large}/{table}.parquet'")
    want = db.sql(Q.SQL["frontier_lines"]).fetchall()
    got = [tuple(r) for r in Q.QUERIES["frontier_lines"](spark, large).select("url", "site", "link_ord", "place").collect()]
    assert got and sorted(got) == sorted(want) and max(r[3] for r in got) == 5
    assert db.sql("select count(distinct l_orderkey) from lineitem").fetchall()[0][0] > 100_000


def test_add_tasks_keeps_first_owner(spark):
    old = task_rows(spark, ("article", "a", "s1", "deferred", 2, "1"))
    found = spark.createDataFrame([("article", "a", "s2", "c", 0), ("article", "b", "s9", "c", 5), ("article", "b", "s3", "c", 1), ("channel", "b", "s4", "c", 2), ("article", None, "s", "c", 0)], "kind string, url string, site string, channel string, ord int")
    rows = {(r.kind, r.url): (r.site, r.status) for r in T.add_tasks(old, found, ["ord"], "2").collect()}
    assert rows == {("article", "a"): ("s1", "deferred"), ("article", "b"): ("s3", "pending"), ("channel", "b"): ("s4", "pending")}
    assert T.add_tasks(old, found.limit(0), ["ord"], "2").count() == 1


def test_changes_and_healing(spark):
    old = task_rows(spark, ("article", "a", "s", "running", 1, "1"), ("channel", "a", "s", "running", 1, "1"), ("article", "b", "s", "done", 0, "1"))
    changes = spark.createDataFrame([("article", "a", 1, "x"), ("article", "a", 2, None), ("article", "zz", 1, "y")], "kind string, url string, seq int, phase string")
    rows = {(r.kind, r.url): (r.phase, r.updated) for r in T.changed_tasks(old, changes, ["seq"], "9").collect()}
    assert rows == {("article", "a"): ("x", "9"), ("channel", "a"): ("start", "1"), ("article", "b"): ("start", "1")}
    with pytest.raises(ValueError, match="failures"):
        T.changed_tasks(old, changes.withColumn("failures", F.lit(0)), ["seq"], "9")
    visited = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "url string")
    rows = {(r.kind, r.url): (r.status, r.failures, r.path, r.updated) for r in T.healed(old, visited, "9").collect()}
    assert rows == {("article", "a"): ("done", 0, "", "9"), ("channel", "a"): ("running", 1, "p", "1"), ("article", "b"): ("done", 0, "p", "1")}
    assert {r.status: r.n_tasks for r in T.status_counts(T.healed(old, visited)).collect()} == {"done": 2, "running": 1}
    assert T.task(old, "article", "a").count() == 1 and [r.url for r in T.open_tasks(old).collect()] == ["a", "a"]


def test_waiting_articles_come_first(spark):
    old = task_rows(spark, ("article", "late", "s", "pending", 0, "2"), ("article", "early", "s", "pending", 0, "1"), ("article", "x", "s", "done", 0, "0"), ("article", "alone", "t", "pending", 0, "1"))
    links = spark.createDataFrame([("s", "c", "new", 0), ("s", "c", "late", 1), ("s", "c", "new", 7)], "site string, channel string, url string, place int")
    rows = T.work_list(T.pending(old), links).orderBy("site", "place").collect()
    assert [(r.site, r.url, r.waiting) for r in rows] == [("s", "early", True), ("s", "late", True), ("s", "new", False), ("t", "alone", True)]


def test_land_batch_is_repeatable(spark, tmp_path):
    rows = spark.createDataFrame([("u", "t", "c", "k", "s", "ch"), ("u", "t", "c2", "k", "s", "ch"), ("v", "t", "正文", "k", "s", "ch")], "url string, title string, content string, category string, siteName string, channel string")
    out, seen = str(tmp_path / "articles"), str(tmp_path / "visited")
    for _ in range(2):
        P.land_batch(P.canonical(rows)[0], 3, out, seen)
    P.land_batch(P.canonical(rows.where("url = 'v'").withColumn("url", F.lit("w")))[0], 4, out, seen)
    lines = [json.loads(x) for f in (tmp_path / "articles").rglob("part-*.json") for x in f.read_text().splitlines()]
    assert sorted(r["url"] for r in lines) == ["u", "v", "w"] and [r["content"] for r in lines if r["url"] == "u"] == ["c"]
    assert sorted(r.url for r in P.read_visited(spark, seen).collect()) == ["u", "v", "w"]


def test_visited_lines(spark, tmp_path):
    (tmp_path / "visited.txt").write_text("https://test.invalid/first\n\n  https://test.invalid/second \nhttps://test.invalid/first\n")
    assert sorted(r.url for r in P.read_visited(spark, str(tmp_path)).collect()) == ["https://test.invalid/first", "https://test.invalid/second"]


def test_manifest(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text(json.dumps([{"name": "甲", "category": "k", "url": "https://a.test"}, {"name": "乙\n", "category": "k", "other": 1}], ensure_ascii=False, indent=1))
    rows = S.checked_manifest(S.read_manifest(spark, str(path)))
    assert [(r.name, r.url) for r in rows.orderBy("ord").collect()] == [("甲", "https://a.test"), ("乙\n", None)]
    missing = S.read_manifest(spark, str(tmp_path / "none.json"))
    assert missing.count() == 0 and missing.columns == rows.columns
    with pytest.raises(ValueError, match="empty"):
        S.checked_manifest(missing)
    path.write_text('[{"name": "a", "category": ""}]')
    with pytest.raises(ValueError, match="1 of 1"):
        S.checked_manifest(S.read_manifest(spark, str(path)))


def test_listing_types_json(spark):
    sites = spark.createDataFrame([("b", "k", None), ("a", "k", "https://a.test")], "name string, category string, home_url string")
    assert [(r.line, r.n_sites) for r in S.site_listing(sites).orderBy("name").collect()] == [("a (https://a.test)", 2), ("b ()", 2)]
    kinds = [(None, True), ("", True), ("TEXT/html; charset=x", True), ("application/xhtml+xml", True), ("image/png", False), (";x", True)]
    rows = spark.createDataFrame(kinds, "mime string, ok boolean")
    assert rows.where(C.is_page_type(F.col("mime")) != F.col("ok")).isEmpty()
    assert spark.range(1).select(C.compact_json(F.lit("文/\"").alias("a"), F.lit(None).cast("string").alias("b"), F.array().cast("array<string>").alias("c"))).first()[0] == '{"a":"文/\\"","b":null,"c":[]}'


def test_metrics(spark):
    df, seen = P.observed(spark.createDataFrame([(1, None), (2, "x")], "a int, b string"), "m", "a", "b")
    df.collect()
    assert seen.get == {"rows": 2, "null_a": 0, "null_b": 1}


def test_config(spark):
    assert RunConfig().validate().arguments() == ["--all", "--max-articles", "20", "--workers", "8", "--limit", "0"]
    assert RunConfig(name="x", everything=False, list_sites=True).arguments()[:2] == ["--name", "x"] and RunConfig(list_sites=True).arguments()[-1] == "--list-sites"
    odd = [{"rounds": v} for v in (0, -1, True, 1.5)] + [{"name": 5}, {"everything": 1}, {"name": "x"}, {"everything": False}, {"max_articles": 0}, {"workers": True}, {"limit": -1}]
    odd += [{"hour": 24}, {"minute": -1}, {"poll_seconds": 0}, {"poll_seconds": 61}, {"utc_offset_hours": 24}]
    for values in odd:
        with pytest.raises(ValueError):
            RunConfig(**values).validate()
    sites = spark.createDataFrame([("b1", "k", 0), ("b", "k", 1), ("c", "l", 2)], "name string, category string, ord int")
    names = lambda **v: [r.name for r in RunConfig(**v).chosen(sites).orderBy("ord").collect()]
    assert names(name="b", everything=False) == ["b"] and names(category="k", everything=False) == ["b1", "b"] and names(limit=1) == ["b1"]


def test_lock(tmp_path):
    path = str(tmp_path / "locks" / "run")
    other = f"import sys; sys.path.insert(0, '.'); from pagemill.streaming.schedule import run_locked; sys.exit(run_locked({path!r}, lambda: 3))"
    with schedule.driver_lock(path):
        assert subprocess.run([sys.executable, "-c", other], check=False).returncode == schedule.BUSY
    assert subprocess.run([sys.executable, "-c", other], check=False).returncode == 3

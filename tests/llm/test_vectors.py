import math

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pagemill.llm import embedding_dedup as D
from pagemill.llm import registry, topk
from pagemill.llm.components import connected_components

SF = "/root/testdata/sf0.001"


def brute(rows, threshold=0.98):
    """vec_id -> (n_links, component) by all pairs."""
    ok = [i for i, (v, label, e) in enumerate(rows) if v is not None and label is not None and e is not None and all(x is not None and math.isfinite(x) for x in e) and any(e)]
    links = {i: [] for i in range(len(rows))}
    for i in ok:
        for j in ok:
            a, b = (np.array(rows[k][2], dtype=float) for k in (i, j))
            if i != j and rows[i][1] == rows[j][1] and len(a) == len(b) and a @ b / math.sqrt((a @ a) * (b @ b)) >= threshold:
                links[i].append(j)
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out.append((rows[i][0], len(links[i]), min((rows[k][0] for k in seen), default=None) if rows[i][0] is not None else None))
    return sorted(out, key=str)


def clustered(n, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 8))
    return [(i, i % 2, (centres[rng.integers(6)] + rng.normal(size=8) * 0.12).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("chunk", [16, 4096])
def test_links_equal_brute_force(spark, chunk):
    rows = clustered(300, 1) + [(1000 + i, 0, [1.0] * 8) for i in range(40)]
    rows += [(2000, 0, None), (2001, 0, [0.0] * 8), (2002, 0, [float("nan")] * 8), (2003, None, [1.0] * 8), (2004, 0, [None] * 8), (2005, 0, [2.0] * 8), (2006, 0, [1.0] * 4), (2007, 0, [])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, label int, embedding array<float>, weight string")
    found = D.near_duplicate_vectors(df, chunk_rows=chunk).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=str) == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_rings_spare_copies_of_clustered_rows(spark):
    """A row visits only rings that its distance to the pivot admits: far fewer copies than chunks times rows / 2."""
    rng = np.random.default_rng(8)
    away = np.abs(np.concatenate([rng.normal(c, 0.02, 2_500) for c in (0.2, 0.5, 0.8, 1.1)]))
    homes = spark.createDataFrame([(i, "0", 0, float(a)) for i, a in enumerate(away)], "id long, key string, cell int, away double")
    own, bounds = D.in_rings(homes, 250)
    sizes = [r["n"] for r in own.groupBy("chunk").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert 20 <= len(sizes) <= 64 and max(sizes) < 1_000 and sum(sizes) == len(away)
    eps = 0.05
    reach = F.size(F.filter("rings", lambda r: (r["low"] <= F.col("away") + eps) & (r["ring"] > F.col("ring"))))
    copies = own.join(bounds, ["key", "cell"]).agg(F.sum(reach)).first()[0]
    assert copies < 0.4 * len(away) * len(sizes) / 2
    found = {r.id: (r.ring, r.away) for r in own.collect()}
    lows = {r["ring"]: r["low"] for r in bounds.first()["rings"]}
    some = rng.integers(0, len(away), 400)
    for i in some.tolist():
        for j in some.tolist():
            if abs(away[i] - away[j]) <= eps and found[i][0] < found[j][0]:
                assert lows[found[j][0]] <= away[i] + eps


def test_pivots_lose_nothing(spark):
    rows = [(i, 0, e) for i, _, e in clustered(1500, 2)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    assert len(D.pivots_of([("0", np.array([r[2] for r in rows], dtype=float))], 1.0, 0.2, 128)["0"]) > 2
    found = sorted(((r.vec_id, r.n_links, r.component_id) for r in D.near_duplicate_vectors(df, chunk_rows=128).collect()), key=str)
    m = np.array([r[2] for r in rows], dtype=float)
    u = m / np.linalg.norm(m, axis=1)[:, None]
    assert [x[1] for x in sorted(found)] == ((u @ u.T >= 0.98).sum(axis=1) - 1).tolist()


@pytest.mark.parametrize("kind", ["clusters", "random", "line", "scaled"])
def test_cover_tree_is_one(kind):
    rng = np.random.default_rng(7)
    if kind == "clusters":
        m = np.repeat(rng.normal(size=(60, 32)), 20, axis=0) + rng.normal(size=(1200, 32)) * 0.02
    elif kind == "random":
        m = rng.normal(size=(500, 64))
    elif kind == "line":
        m = np.stack([np.cos(np.linspace(0, 1, 700)), np.sin(np.linspace(0, 1, 700))], axis=1)
    else:
        m = np.outer(rng.uniform(1, 9, 300), np.ones(4)) + np.repeat(rng.normal(size=(30, 4)), 10, axis=0) * 1e-3
    side = D.Side(np.arange(len(m)), m, np.ones(len(m), dtype=np.int64))
    t = side.tree
    assert sorted(t.order.tolist()) == list(range(len(m)))
    for k in range(len(t.centre)):
        rows = t.rows(k)
        assert t.centre[k] in rows and np.linalg.norm(side.unit[rows] - side.unit[t.centre[k]], axis=1).max() <= t.radius[k] + 1e-7
        if t.last[k]:
            children = t.below(k)
            assert len(children) > 1 and t.centre[children[0]] == t.centre[k] and np.concatenate([t.rows(c) for c in children]).tolist() == rows.tolist()
            assert t.radius[children].max() <= max(t.radius[k], 1e-9)
        else:
            assert len(rows) == 1 or t.radius[k] <= D.SMALLEST_REACH
    links = D.Links()
    D.closed(side, 0.98, math.sqrt(0.04), links)
    cosine = (m @ m.T) / (side.norms[:, None] * side.norms[None, :])
    want = cosine >= 0.98
    assert side.counts.tolist() == (want.sum(axis=1) - 1).tolist()
    compared, pairs, depth = D.work_of(m)
    assert depth > 1 or kind == "scaled"
    assert kind != "clusters" or compared < 0.1 * pairs
    assert kind != "random" or compared < 1.1 * pairs


def test_forest_joins_what_links_join():
    rng = np.random.default_rng(8)
    a, b = rng.integers(0, 300, 250), rng.integers(0, 300, 250)
    up = {int(x): int(x) for x in np.concatenate([a, b])}
    for x, y in zip(a.tolist(), b.tolist()):
        rx, ry = up[x], up[y]
        up = {k: min(rx, ry) if v in (rx, ry) else v for k, v in up.items()}
    one, two = D.forest(a, b)
    assert dict(zip(one.tolist(), two.tolist())) == {k: v for k, v in up.items() if k != v}


def test_repeated_rows_and_empty_table(spark):
    kind = "vec_id long, label int, embedding array<float>"
    found = D.near_duplicate_vectors(spark.createDataFrame([(7, 1, [1.0, 0.0])] * 3 + [(None, 1, [1.0, 0.0])], kind)).collect()
    assert sorted((str(r.vec_id), r.n_links) for r in found) == [("7", 2)] * 3 + [("None", 0)]
    assert D.near_duplicate_vectors(spark.createDataFrame([], kind)).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 101), (102, 101), (200, 200), (50, 40)] + [(1000, 1000 + i) for i in range(1, 60)]
    found = {r.id: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(31)) and found[102] == 100 and found[50] == 40 and found[1059] == 1000 and 200 not in found


def top(rows, k=10):
    fine = [(i, [math.floor(1024 * float(np.float64(x))) for x in e]) for i, e in rows if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for q, a in sorted(x for x in fine if x[0] % 100 == 0):
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in fine if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return out


@pytest.mark.parametrize("group", [50, 32768])
def test_top_k_equals_brute_force(spark, group):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=5).astype(np.float32).tolist()) for i in range(400)] + [(500 + i, [0.5] * 5) for i in range(30)]
    rows += [(600, None), (700, [None] * 5), (800, [float("inf")] * 5), (900, [0.25] * 5), (None, [9.0] * 5)]
    df = spark.createDataFrame(rows, "id long, vector array<float>").selectExpr("id", "vector", "cast(1 as int) ord")
    found = topk.top_k(df, df.where("id % 100 = 0").select("id", "vector"), group_rows=group, seed_rows=20)
    assert sorted(map(tuple, found.collect())) == top(rows)


def test_top_k_visits_few_groups_of_clusters(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (np.eye(8)[i % 8] * 4 + rng.normal(size=8) * 0.1).tolist(), i % 8) for i in range(1600)]
    df = spark.createDataFrame(rows, "id long, vector array<float>, ord int")
    queries = df.where("id % 100 = 0").select("id", "vector")
    found = sorted(map(tuple, topk.top_k(df, queries, group_rows=100, seed_rows=800).collect()))
    assert found == top([(i, np.float32(e).tolist()) for i, e, _ in rows])
    dealt = topk.dealt_docs(df.withColumn("vector", F.col("vector").cast("array<double>")), 100)
    sizes = [r["count"] for r in dealt.groupBy("grp").count().collect()]
    assert sum(sizes) == 1600 and max(sizes) <= 200
    seed = dealt.limit(800).collect()
    seeds = spark.sparkContext.broadcast((np.array([r.id for r in seed]), topk.quantised(np.array([r.vector for r in seed]))))
    visits = topk.admitted(queries.withColumn("vector", F.col("vector").cast("array<double>")), topk.extremes_of(dealt), seeds, 10, 16).count()
    assert visits < 0.5 * 16 * len(sizes)


def test_top_k_small_tables(spark):
    kind = "id long, vector array<float>, ord int"
    df = spark.createDataFrame([(0, [1.0], None), (1, [2.0], 1)], kind)
    assert list(map(tuple, topk.top_k(df, df.select("id", "vector").where("id = 0")).collect())) == [(0, 1, 1, 2048 * 1024)]
    none = spark.createDataFrame([], kind)
    assert topk.top_k(none, none.select("id", "vector")).count() == 0


def test_products_beyond_doubles():
    rows = np.array([[2.0**60, 1.0], [2.0**40, 3.0]])
    assert topk.exact_products(rows, np.array([4.0, 1.0])).tolist() == [2**62 + 1, 2**42 + 3]


@pytest.mark.parametrize("name", list(registry.SQL))
def test_queries_equal_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "sales", "client_changes"):
        db.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want, got = db.sql(registry.SQL[name]).df(), registry.QUERIES[name](spark, SF).toPandas()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    told = lambda df: sorted((tuple(None if pd.isna(x) else x for x in row) for row in df[columns].astype(object).values.tolist()), key=str)
    same = lambda df: [tuple(float(x) if isinstance(x, int | float) else x for x in row) for row in told(df)]
    assert sorted(same(got), key=str) == sorted(same(want), key=str)


def test_top_k_of_large_components_loses_nothing(spark):
    """Products beyond 2**53, whose terms cancel: the rounding of a bound follows its terms, not its sum."""
    rng = np.random.default_rng(12)
    base = rng.normal(size=(1, 32))
    rows = []
    for i in range(600):
        v = base[0] * rng.choice([-1.0, 1.0]) + rng.normal(size=32) * 1e-4
        rows.append((i, (v * 3.1e5 + rng.random()).tolist(), i % 3))
    queries = []
    for i in range(20):
        q = rng.normal(size=32)
        q -= base[0] * (q @ base[0]) / (base[0] @ base[0])
        queries.append((10_000 + i, (q * 3.3e5).tolist()))
    docs = spark.createDataFrame(rows, "id long, vector array<double>, ord int")
    found = topk.top_k(docs, spark.createDataFrame(queries, "id long, vector array<double>"), 10, group_rows=128, seed_rows=16).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    whole = lambda v: [math.floor(x * 1024) for x in v]
    docs_ = [(i, whole(v)) for i, v, _ in rows]
    for i, q in queries:
        q = whole(q)
        scores = sorted(((-sum(a * b for a, b in zip(v, q, strict=True)), j) for j, v in docs_))[:10]
        assert got[i] == [(j, -s) for s, j in scores]
    assert max(abs(s) for x in got.values() for _, s in x) < 2**63

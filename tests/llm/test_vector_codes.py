import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.llm import vector_codes as C


def plain(rows, parts, entries, rounds):
    """The contract by loops over Python's integers."""
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max([1, *(len(v) for _, v, _ in kept)]) // parts) * parts
    wide = width // parts
    scaled = [[math.floor(x * 1024) for x in v] + [0] * (width - len(v)) for _, v, _ in kept]
    cut = [[s[p * wide : (p + 1) * wide] for p in range(parts)] for s in scaled]
    least = {}
    for (i, v, _), c in sorted(zip(kept, cut, strict=True), key=lambda x: x[0][1]):
        if i is not None:
            least.setdefault(i, c)
    books = [[list(least[i][p]) for i in sorted(least)[:entries]] for p in range(parts)]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda x, book: min((distance(x, e), j) for j, e in enumerate(book))
    for _ in range(rounds):
        for p, book in enumerate(books):
            given = {}
            for c in cut:
                given.setdefault(nearest(c[p], book)[1], []).append(c[p])
            books[p] = [[sum(y) // len(given[j]) for y in zip(*given[j], strict=True)] if j in given else e for j, e in enumerate(book)]
    out = []
    for (i, _, label), c in zip(kept, cut, strict=True):
        near = [nearest(c[p], books[p]) for p in range(parts)]
        out.append((i, label, "".join(f"{j:02x}" for _, j in near), sum(d for d, _ in near)))
    total = {}
    for _, label, _, e in out:
        total[label] = total.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((*o, total[o[1]]) for o in out), key=str), digest


def found_of(spark, rows, kind="array<float>", **sizes):
    df = spark.createDataFrame(rows, f"id long, vector {kind}, label int").repartition(3)
    found, books = C.compressed(df.withColumn("code", F.lit(1)).select("id", "vector", "label"), **sizes)
    return sorted((tuple(r) for r in found.select("id", "label", "code", "error", "label_error").collect()), key=str), C.codebooks_digest(books)


def vectors(n, width, seed, kind=np.float32):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width))
    return [(int(i) * 3 % n, (centres[rng.integers(12)] + rng.normal(size=width) * 0.1).astype(kind).tolist(), int(i % 3) or None) for i in range(n)]


@pytest.mark.parametrize(("n", "width", "entries"), [(200, 8, 16), (150, 10, 256), (60, 4, 5)])
def test_equals_plain_integers(spark, n, width, entries):
    rows = vectors(n, width, n)
    rows += [(1000, None, 1), (1001, [float("nan")] * width, 1), (1002, [None] * width, 1), (1003, [float("inf")], 1), (None, [1.0] * width, None), (1004, [], 2), (1005, [0.5] * 2, 2)]
    rows += rows[:4] + [(0, [9.0] * width, 1)]
    assert found_of(spark, rows, entries=entries) == plain(rows, 4, entries, 4)


def test_large_components_are_exact(spark):
    rows = [(i, [x * 3e4 for x in v], label) for i, v, label in vectors(80, 8, 7, np.float64)]
    assert found_of(spark, rows, "array<double>", entries=9) == plain(rows, 4, 9, 4)


def test_ties_take_the_lower_index_and_pruning_leaves_none_out():
    rng = np.random.default_rng(3)
    entries = rng.integers(-3, 4, size=(100, 3)).tolist()  # many entries are equal or equally far
    rows = rng.integers(-5, 6, size=(500, 3)).astype(np.float64)
    index, squared, _ = C.Codebook(entries).nearest(rows)
    d = ((rows[:, None, :] - np.array(entries)[None]) ** 2).sum(axis=2)
    assert (squared == d.min(axis=1)).all() and (index == d.argmin(axis=1)).all()


def test_pruning_spares_most_entries_where_norms_differ():
    rng = np.random.default_rng(4)
    entries = np.rint(rng.normal(size=(256, 16)) * np.exp(rng.normal(size=(256, 1)) * 2) * 100)
    rows = entries[rng.integers(256, size=2000)] + rng.integers(-3, 4, size=(2000, 16))
    assert C.Codebook(entries.astype(int).tolist()).nearest(rows)[2] < 0.2 * 2000 * 256


def test_no_id_and_no_rows(spark):
    assert found_of(spark, [(None, [1.0, 2.0], 1)])[0] == [(None, 1, None, None, None)]
    assert found_of(spark, [])[0] == []


def test_many_labels_meet_their_sums_in_salted_joins(spark, monkeypatch):
    rows = vectors(120, 8, 9)
    monkeypatch.setattr(C, "FEW_LABELS", 0)
    assert found_of(spark, rows, entries=8) == plain(rows, 4, 8, 4)

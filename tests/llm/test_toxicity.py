import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.llm import toxicity as T


def grams(text):
    """The features as strings."""
    flat = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    flat = re.sub(" +", " ", flat)
    return {flat[i : i + n] for n in T.ORDERS for i in range(len(flat) - n + 1)}


def bucket_of(gram):
    h = sum(ord(c) * int(T.PLACES[j]) for j, c in enumerate(gram)) % 2**64
    return ((h ^ (h >> 32) ^ len(gram)) * int(T.MIX) % 2**64) >> (64 - T.BITS)


@pytest.mark.parametrize("piece", [7, 1 << 18])
def test_features_equal_plain_ngrams(monkeypatch, piece):
    monkeypatch.setattr(T, "PIECE", piece)
    monkeypatch.setattr(T, "TOGETHER", 40)
    rng = random.Random(1)
    texts = [None, "", "a", "Ünïcode—x", "...", "日本語のテキスト 123 abc", " a b "] + ["".join(rng.choice("ab c.é1") for _ in range(rng.randrange(90))) for _ in range(60)]
    found = {}
    for text, bucket in T.features(texts):
        for t, b in zip(text.tolist(), bucket.tolist(), strict=True):
            assert b not in found.setdefault(t, set())
            found[t].add(b)
    for i, text in enumerate(texts):
        assert found.get(i, set()) == {bucket_of(g) for g in grams(text or "")}
    wanted = np.zeros(T.BUCKETS, dtype=bool)
    wanted[::3] = True
    assert {(t, b) for text, bucket in T.features(texts, wanted) for t, b in zip(text.tolist(), bucket.tolist(), strict=True)} == {(t, b) for t, bs in found.items() for b in bs if b % 3 == 0}


def test_counts_and_ratios_equal_plain_ones(spark):
    rng = random.Random(2)
    rows = [(" ".join(rng.choice(["moron", "apple", "pear", "idiot", "the"]) for _ in range(4)), int(rng.random() < 0.4)) for _ in range(200)] + [(None, 0), ("", 1)]
    n, holds = T.label_counts(spark.createDataFrame(rows, "text string, toxic int").repartition(3))
    assert n.tolist() == [sum(y == 0 for _, y in rows), sum(y == 1 for _, y in rows)]
    plain = np.zeros((2, T.BUCKETS), dtype=np.int64)
    for text, y in rows:
        for b in {bucket_of(g) for g in grams(text or "")}:
            plain[y, b] += 1
    assert (plain == holds).all()
    ratio = T.log_count_ratios(holds)
    total = [sum(int(x) + 1 for x in side) for side in plain]
    for b in np.flatnonzero(plain.any(axis=0)):
        r = math.log((plain[1, b] + 1) / total[1]) - math.log((plain[0, b] + 1) / total[0])
        z = abs(r) / math.sqrt(1 / (plain[1, b] + 1) + 1 / (plain[0, b] + 1))
        assert math.isclose(ratio[b], r if z >= T.LEAST_Z else 0.0, abs_tol=1e-12)


def area(pairs):
    """Of pairs (score, label): how often a toxic one has the higher score."""
    s, y = np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])
    more = (s[y == 1][:, None] > s[y == 0][None]).mean()
    return more + 0.5 * (s[y == 1][:, None] == s[y == 0][None]).mean()


def test_held_out_documents(spark):
    """English rows, whose labels follow their words: nearly all toxic ones are found and no clean one is taken for toxic."""
    sf = "/root/testdata/sf0.1"
    found = T.op11_toxicity(spark, sf).where("held_out")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    words = F.regexp_like(F.lower("text"), F.lit("trash|pathetic|idiot|disgusting|worthless|stupid|clown|loser|scum|moron"))
    rows = found.join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", words.alias("words")), "doc_id").join(labels, "doc_id").collect()
    planted = [r for r in rows if r["words"] and r["toxic"] == 1]
    clean = [r for r in rows if r["toxic"] == 0]
    assert len(planted) > 30 and sum(r["predicted"] for r in planted) >= 0.95 * len(planted)
    assert sum(r["predicted"] for r in clean) <= 0.01 * len(clean)
    assert area([(r["score"], r["toxic"]) for r in rows if r["lang"] == "en"]) > 0.95


def test_labels_of_one_kind_and_odd_labels(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "x"), (None, "y"), (3, None)], "doc_id long, text string")
    labels = lambda rows: spark.createDataFrame(rows, "doc_id long, toxic int")
    scores = lambda model: [r["score"] for r in T.with_scores(docs, model).collect()]
    assert scores(T.fit(docs, labels([]))) == [0.0] * 4
    assert scores(T.fit(docs, labels([(1, 0), (2, 0), (None, 1), (9, 1), (3, 7), (1, None)]))) == [0.0] * 4
    assert scores(T.fit(docs, labels([(1, 1), (1, 1)]))) == [1.0] * 4
    assert scores(T.fit(docs, labels([(1, 1), (1, 0), (3, 0)]))) == [pytest.approx(1 / 3, abs=1e-6)] * 4  # nothing tells enough

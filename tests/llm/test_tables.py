import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from pagemill.llm import mixing, sharding, url_filter

KIND = "doc_id long, text string, lang string, source string, n_chars long, size string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, None, s, None, "clash") for i, t, s in rows], KIND)


def plain_best_fit(sizes, capacity):
    bins = []
    for s in sorted(sizes, reverse=True):
        fit = [b for b in bins if b >= s]
        if fit:
            b = min(fit)
            bins.remove(b)
            bins.append(b - s)
        else:
            bins.append(max(capacity, s) - s)
    return sorted(bins)


def test_packing_equals_plain_best_fit():
    random.seed(1)
    for _ in range(200):
        sizes = [random.randint(1, 30) for _ in range(random.randint(0, 60))]
        runs, used = sharding.best_fit_decreasing(list(Counter(sizes).items()), 40)
        left = defaultdict(lambda: 40)
        for r in runs:
            left[r.bin] -= r.size * (r.last - r.first + 1)
        assert sorted(left.values()) == plain_best_fit(sizes, 40) and used == len(left)


def test_tree_gives_the_tightest():
    random.seed(2)
    tree, held = sharding.CapacityTree(), []
    for i in range(2000):
        if random.random() < 0.6:
            held.append((random.randint(0, 100), i))
            tree.add(*held[-1])
        else:
            size = random.randint(0, 110)
            want = min((x for x in held if x[0] >= size), default=None)
            assert tree.take_tightest(size) == want
            if want:
                held.remove(want)


def test_shards(spark):
    random.seed(3)
    rows = [(i, "w" * random.randint(0, 400) + str(i % 700), "a") for i in range(1500)] + [(2000 + i, "copy" * 300, "a") for i in range(40)] + [(3000, None, "a"), (3001, None, "a"), (3002, "", "a"), (3003, "é" * 5, "a"), (5, "w", "a")]
    found = sharding.shard_by_size(docs(spark, rows), 8).collect()
    assert len(found) == len(rows)
    text = {i: t for i, t, _ in rows if i != 5}
    groups, slots, total = defaultdict(set), defaultdict(list), Counter()
    for r in found:
        slots[r.shard].append(r.slot)
        total[r.shard] += r["size"]
        if r.doc_id != 5:
            t = text[r.doc_id]
            groups[t].add(r.shard)
            assert r["size"] == len((t or "").encode()) + 1 and r.text_crc32 == (None if t is None else zlib.crc32(t.encode()))
    assert all(len(g) == 1 for g in groups.values())
    assert set(slots) == set(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    # The copies are the largest group; everything else is spread evenly.
    assert max(total.values()) - min(total.values()) <= max(len("copy" * 300) * 40, 0.02 * sum(total.values()))


def test_shards_are_even_without_large_groups(spark):
    rows = [(i, f"{i}-" + "x" * (i % 97), "a") for i in range(2000)]
    total = Counter()
    for r in sharding.shard_by_size(docs(spark, rows), 8).collect():
        total[r.shard] += r["size"]
    assert max(total.values()) - min(total.values()) < 200
    assert sharding.shard_by_size(docs(spark, []), 8).count() == 0


def test_shards_of_a_capacity(spark, monkeypatch):
    random.seed(4)
    monkeypatch.setattr(sharding, "STRIDE", 16)  # runs pass its borders
    texts = [f"{i:04}" + "z" * random.choice([1, 1, 1, 30, 200]) for i in range(600)]
    rows = [(i, t, "a") for i, t in enumerate(texts)] + [(1000 + i, "copy" * 100, "a") for i in range(7)] + [(2000, None, "a"), (None, None, "a"), (2001, "", "a"), (3, texts[3], "a")]
    found = sharding.shard_by_capacity(docs(spark, rows), 1000).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id) for r in found) == sorted(-1 if i is None else i for i, _, _ in rows)
    groups, held = Counter(), defaultdict(set)
    for r in found:
        groups[r.grp] += r["size"]
        held[r.grp].add(r.shard)
    assert all(len(g) == 1 for g in held.values())
    total = Counter()
    for g, size in groups.items():
        total[min(held[g])] += size
    assert sorted(max(1000, t) - t for t in total.values()) == plain_best_fit(groups.values(), 1000)
    assert [t for t in total.values() if t > 1000] == [7 * 401] and set(total) == set(range(len(total)))
    assert sharding.shard_by_capacity(docs(spark, []), 1000).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_by_capacity(docs(spark, rows), 0)


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    fixed, want = {}, share * sum(sizes.values())
    while True:
        free = [s for s in names if s not in fixed]
        level = (want - sum(fixed.values())) / max(1, sum(w[s] for s in free))
        over = [s for s in free if level * w[s] > most * sizes[s]]
        if not over:
            return {s: fixed.get(s, level * w[s]) for s in names}
        fixed |= {s: most * sizes[s] for s in over}


def test_mix(spark):
    random.seed(4)
    rows = [(i, " ".join(["w"] * random.randint(0, 60)), random.choice(["a", "a", "a", "b", "ç", "z", None])) for i in range(3000)]
    rows += [(9000, None, "a"), (9001, "", "b"), (9002, " \t\u00a0x\n", "z"), (9003, "w", "only"), (7, "w w", "a"), (7, "w w", "a")]
    found = mixing.systematic_mix(docs(spark, rows), ["doc_id", "source"]).collect()
    assert len(found) == len(rows)
    sizes, taken = Counter(), Counter()
    for r in found:
        sizes[r.source] += r["__size"]
        taken[r.source] += r["__size"] * r["__copies"]
        assert 0 <= r["__copies"] <= 2
    want = plain_targets(sizes)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    assert all(abs(taken[s] - want[s]) <= 130 for s in want)
    again = mixing.systematic_mix(docs(spark, rows[::-1]).repartition(7), ["doc_id", "source"]).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    assert mixing.systematic_mix(docs(spark, []), ["doc_id"]).count() == 0


def test_slots_of_null_and_repeated_ids(spark):
    """Slots are gapless whatever repeats; null ids with other texts lie in many buckets, and equal rows go out in portions."""
    rows = [(None, f"t{i % 60}", None) for i in range(300)] + [(7, "same", None)] * 250 + [(i, "x" * (i % 9), None) for i in range(100)] + [(None, None, None)] * 40
    base = sharding.text_groups(docs(spark, rows)).withColumn("shard", F.when(F.col("doc_id") == 7, 0).otherwise(1))
    found = sharding.with_slots(base, 2, portion=16).collect()
    assert len(found) == len(rows)
    for shard in (0, 1):
        mine = sorted(r.slot for r in found if r.shard == shard)
        assert mine == list(range(len(mine)))
    assert Counter((r.doc_id, r.grp) for r in found) == Counter((r.doc_id, r.grp) for r in base.collect())
    buckets = {r[0] for r in base.where("doc_id is null").select(F.substring(F.hex(F.xxhash64("doc_id", "grp")), 1, 2)).collect()}
    assert len(buckets) > 30


def test_mix_splits_large_groups(spark):
    rows = [(i % 50, "w w w", "a") for i in range(900)] + [(None, "w w w", None)] * 400 + [(i, "v " * (i % 5), "b") for i in range(300)]
    one = mixing.systematic_mix(docs(spark, rows), ["doc_id", "source"], rows_per_bucket=16).collect()
    two = mixing.systematic_mix(docs(spark, rows).repartition(5), ["doc_id", "source"]).collect()
    assert sorted(map(str, one)) == sorted(map(str, two)) and len(one) == len(rows)


def test_targets_equal_plain_ones(spark):
    random.seed(7)
    for n in (1, 2, 3, 7, 40):
        sizes = {f"{random.random()}": random.choice([0, 1, 5, 10**random.randint(1, 9)]) for _ in range(n)}
        found = {r.key: r.target for r in mixing.source_targets(spark.createDataFrame(list(sizes.items()), "key string, source_size long")).collect()}
        assert found == pytest.approx(plain_targets(sizes))


URLS = ["http://a.example.net/en/1", "https://NET/x", "https://b.net", "http://x.example.com/de/9?q=/", "http://y.org/fr/1", "http://y.org/en/1", "nothing", "", None, "x://HOST:8/p?a#b", "http://example.com/en/3"]


def test_fixed_rules(spark):
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(df).collect()}
    assert got[0] == ("a.example.net", "/en/1", "example.net/en/", "allow") and got[1] == ("net", "/x", "net/", "block")
    assert got[2][:3] == ("b.net", "", None) and got[3][2:] == ("example.com/de/", "block") and got[4][2:] == ("org/fr/", "allow")
    assert got[6][:3] == got[7][:3] == got[8][:3] == ("", "", None) and got[9][:2] == ("host:8", "/p")
    assert all(v[3] in ("allow", "block") for v in got.values()) and len(got) == len(URLS)
    assert url_filter.judge_urls(df.where("page_id < 0")).count() == 0


def test_mined_rules_equal_apriori(spark):
    random.seed(5)
    baskets = []
    for _ in range(120):
        items = {f"t{random.randint(0, 5)}" for _ in range(4)}
        baskets.append((sorted(items), "block" if {"t0", "t1"} <= items or (random.random() < 0.1) else "allow"))
    rules = url_filter.mine_rules(spark.createDataFrame(baskets, "tokens array<string>, verdict string"), 0.05, 0.8).collect()
    got = {(tuple(r.tokens), r.verdict): (round(r.confidence, 9), round(r.support, 9)) for r in rules}
    want = {}
    for k in range(1, 5):
        for c in combinations([f"t{i}" for i in range(6)], k):
            inside = [v for t, v in baskets if set(c) <= set(t)]
            for v in ("allow", "block"):
                n = inside.count(v)
                if n and n / 120 >= 0.05 and n / len(inside) >= 0.8:
                    want[(c, v)] = (round(n / len(inside), 9), round(n / 120, 9))
    assert got == want and all(r.post in r.tokens for r in rules)


def test_mining_stays_bounded(spark):
    """Thirty tokens that always stand together would make a billion combinations."""
    together = [f"t{i:02}" for i in range(30)]
    rows = [([*together, "bad"], "block")] * 60 + [([*together, "good"], "allow")] * 60
    rules = url_filter.mine_rules(spark.createDataFrame(rows, "tokens array<string>, verdict string"), 0.1, 0.9).collect()
    assert 0 < len(rules) < 2**13 and {(("bad",), "block"), (("good",), "allow")} <= {(tuple(r.tokens), r.verdict) for r in rules}


def test_weak_tokens_make_rules_beside_strong_ones(spark):
    """Twelve tokens tell more than x and y, but only x and y together tell `block` where those are missing."""
    strong = [f"s{i:02}" for i in range(12)]
    rows = [(["x", "y", *strong], "block")] * 100 + [(["x"], "allow")] * 100 + [(["y"], "allow")] * 100
    rules = url_filter.mine_rules(spark.createDataFrame(rows, "tokens array<string>, verdict string"), 0.01, 0.9)
    assert (("x", "y"), "block", 1.0) in {(tuple(r.tokens), r.verdict, r.confidence) for r in rules.collect()}
    urls = spark.createDataFrame([("a", ["x", "y", "z"]), ("b", ["x"]), ("c", ["s07"]), ("d", ["z"])], "url string, tokens array<string>")
    assert {r.url: r.method_verdict for r in url_filter.apply_rules(urls, rules).collect()} == {"a": "block", "c": "block"}


def test_rules_of_long_baskets_equal_apriori(spark):
    """Baskets of more items than FP-growth reads at a time: every rule of up to five tokens is found."""
    random.seed(11)
    names = [f"t{i:02}" for i in range(20)]
    baskets = []
    for _ in range(60):
        items = sorted(random.sample(names, random.choice([3, 17, 19])))
        baskets.append((items, "block" if {"t03", "t11"} <= set(items) else "allow"))
    rules = url_filter.mine_rules(spark.createDataFrame(baskets, "tokens array<string>, verdict string"), 0.45, 0.9).collect()
    got = {(tuple(r.tokens), r.verdict, round(r.confidence, 9)) for r in rules}
    want = set()
    for k in range(1, 6):
        for c in combinations(names, k):
            inside = [v for t, v in baskets if set(c) <= set(t)]
            for v in ("allow", "block"):
                n = inside.count(v)
                if n and n / 60 >= 0.45 and n / len(inside) >= 0.9:
                    want.add((c, v, round(n / len(inside), 9)))
    assert got == want and want


def test_verdicts_equal_a_plain_matcher(spark):
    random.seed(8)
    words = ["win", "news", "free", "sport", "buy", "read"]
    url = lambda: f"http://{random.choice(words)}.{random.choice(['test', 'shop'])}/{random.choice(words)}/{random.choice(words)}?{random.choice('ab')}={random.randint(0, 9)}"
    labelled = [(u := url(), "block" if "win" in u or "free" in u and "shop" in u else "allow") for _ in range(300)]
    urls = [url() for _ in range(200)] + ["http://long.test/" + "x/" * 5000 + "win", "odd", None, ""] + ["http://win.shop/a/b"] * 5
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    known = spark.createDataFrame(labelled, "url string, verdict string")
    tokens = lambda df: url_filter.parse_urls(df).select("url", url_filter.tokens_of(F.col("url"), F.col("host"), F.col("path")).alias("t"))
    trained = [(set(r.t), dict(labelled)[r.url]) for r in tokens(known).collect()]
    rules = {}
    for k in (1, 2, 3, 4, 5):
        for c in {c for t, _ in trained for c in combinations(sorted(t), k)}:
            inside = [v for t, v in trained if t.issuperset(c)]
            for v in ("allow", "block"):
                n = inside.count(v)
                if n / 300 >= 0.02 and n / len(inside) >= 0.9:
                    rules[c, v] = (n / len(inside), n / 300, n / len(inside) / ([x for _, x in trained].count(v) / 300), v == "block", list(c))
    want = {}
    for r in tokens(pages.where("url is not null").select("url").distinct()).collect():
        hits = [(x, v) for (c, v), x in rules.items() if set(c) <= set(r.t)]
        want[r.url] = max(hits)[1] if hits else "allow"
    got = {r.page_id: r.verdict for r in url_filter.judge_urls(pages, rules=(), labelled=known, min_support=0.02).collect()}
    assert [got[i] for i in range(len(urls))] == [want.get(u, "allow") for u in urls] and set(want.values()) == {"allow", "block"}


def test_method_decides_the_rest(spark):
    labelled = spark.createDataFrame([(f"http://spam{i % 9}.test/win/{i}", "block") for i in range(50)] + [(f"http://news{i % 9}.test/read/{i}", "allow") for i in range(50)], "url string, verdict string")
    urls = spark.createDataFrame([(1, "http://other.test/win/5"), (2, "http://other.test/read/5"), (3, "http://other.test/none")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in url_filter.judge_urls(urls, labelled=labelled).collect()} == {1: "block", 2: "allow", 3: "allow"}

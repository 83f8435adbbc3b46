import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from pagemill.llm import language_id, minhash_dedup, mixing, personal_data, registry, sentence_pieces, token_counts

SF = "/root/testdata/sf0.001"
MODEL = token_counts.public_path("piece_bpe_32k.model")
KIND = "doc_id long, text string, lang string, source string, n_chars long, row string"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, None, "s", None, "clash") for i, t in enumerate(texts)], KIND)


def documents():
    return duckdb.sql(f"select doc_id, text, lang from '{SF}/documents.parquet' order by doc_id").fetchall()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


ODD = [None, "", " ", "Hello  world", "▁a", "a" * 3000, "世界 𐍈 \x00 z", "é", "ab" * 400 + " " + "9" * 700, "<s> <0x41>", "x" * 300 + "▁" * 40]


def test_encoding_equals_the_library(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    found = {r.doc_id: r for r in sentence_pieces.encode_texts(docs(spark, ODD), MODEL).select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids").collect()}
    for i, text in enumerate(ODD):
        ids = model.encode(text or "")
        assert found[i].ids == ids and found[i].n_tokens == len(ids) and found[i].ids_sha256 == sha(",".join(map(str, ids))) and found[i].decoded_sha256 == sha(model.decode(ids) if ids else "")


def test_encoding_query_equals_the_library(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    found = {r.doc_id: r for r in registry.QUERIES["op8_sentence_pieces"](spark, SF).collect()}
    for i, text, _ in documents():
        ids = model.encode(text)
        assert (found[i].n_tokens, found[i].ids_sha256, found[i].decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(model.decode(ids)))


def test_random_words_round_trip():
    random.seed(1)
    model, e = sentencepiece.SentencePieceProcessor(model_file=MODEL), sentence_pieces.encoder(MODEL)
    for _ in range(400):
        text = "".join(random.choice("abthErin0 \t▁é世𐍈") for _ in range(random.choice([1, 5, 40, 300, 900])))
        ids = model.encode(text)
        assert e.encode(text) == ids and e.decode(ids) == model.decode(ids)


def test_long_words_equal_the_library():
    random.seed(11)
    model, e = sentencepiece.SentencePieceProcessor(model_file=MODEL), sentence_pieces.encoder(MODEL)
    plain = "".join(t or "" for _, t, _ in documents()[:60]).replace(" ", "").replace("\n", "")
    words = [plain[:30_000], "".join(random.choices("abcdefghijklmnopqrstuvwxyz", k=20_000)), "ab" * 9_000, "a" * 9_001, "the" * 4_000, "-" * 5_000 + "=" * 300, "0123456789" * 900, "世界的人" * 900]
    words += ["".join(random.choices(random.choice(["ab", "aA", "ins", "the ", "er-", "<>=", "éè", "lt"]), k=random.randint(49, 400))) for _ in range(600)]
    for text in words:
        ids = model.encode(text)
        assert e.encode(text) == ids and e.decode(ids) == model.decode(ids)


def test_merging_several_pairs_equals_one_at_a_time():
    random.seed(12)
    model = sentence_pieces.encoder(MODEL).model
    parts = ["".join(random.choices(random.choice(["ab", "in", "the", "es ", "tion", "e-", "aeiou", "▁a"]), k=random.randint(1, 60))) for _ in range(4000)]
    lengths = np.array([len(p) for p in parts])
    one, two = (model.flat_merge(model.symbols("".join(parts)), lengths, several) for several in (False, True))
    assert one[0].tolist() == two[0].tolist() and one[1].tolist() == two[1].tolist()


def test_piece_counts_equal_greedy(spark):
    pieces = set(token_counts.pieces_of(MODEL))
    longest = max(map(len, pieces))

    def greedy(word):
        word, i, n = "▁" + word, 0, 0
        while i < len(word):
            end = next((j for j in range(min(len(word), i + longest), i, -1) if word[i:j] in pieces), None)
            if end is None:
                return 1
            i, n = end, n + 1
        return n

    found = {r.doc_id: r for r in registry.QUERIES["op7_longest_match_counts"](spark, SF).collect()}
    for i, text, _ in documents():
        assert found[i].n_words == len(text.split()) and found[i].n_pieces == sum(map(greedy, text.split()))
    odd = {r.doc_id: r.n_pieces for r in token_counts.count_pieces(docs(spark, ODD), MODEL).collect()}
    assert odd == {i: sum(map(greedy, (t or "").split())) for i, t in enumerate(ODD)}


def test_longest_match_on_small_vocabularies():
    random.seed(2)
    for _ in range(300):
        vocabulary = {"".join(random.choice("ab") for _ in range(random.randint(1, 4))) for _ in range(random.randint(1, 6))}
        automaton = token_counts.LongestMatch(vocabulary)
        for _ in range(20):
            word, i, n = "".join(random.choice("ab") for _ in range(random.randint(1, 10))), 0, 0
            while i < len(word):
                end = next((j for j in range(len(word), i, -1) if word[i:j] in vocabulary), None)
                if end is None:
                    n = 1
                    break
                i, n = end, n + 1
            assert automaton.count(word) == n


def test_language(spark):
    found = registry.QUERIES["op4_hyperdimensional_language"](spark, SF).collect()
    lang = {i: x for i, _, x in documents()}
    held = [r for r in found if r.held_out]
    assert len(found) == len(lang) and held and all(0 <= r.score <= 1 for r in found)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) >= 0.95


def test_language_defined_cases(spark):
    known = language_id.language_prototypes(spark.createDataFrame([(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (3, None, "fr"), (4, "x", None)], "doc_id long, text string, lang string"))
    assert list(known) == ["de", "en"]
    rows = language_id.identify(docs(spark, [None, "", "12 !!", "the dog", "und der " * 200_000]), known).select("row.doc_id", "row.row", "lang_pred", "score").collect()
    assert [r.lang_pred for r in sorted(rows)] == ["und", "und", "und", "en", "de"] and all(r.row == "clash" for r in rows)
    assert [r.lang_pred for r in language_id.identify(docs(spark, ["the"]), {}).collect()] == ["und"]


def plain_bundle(text):
    """The sum of the bound trigrams, one after the other."""
    letters = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    letters = re.sub(" +", " ", letters)
    out = np.zeros(language_id.DIMENSIONS, dtype=np.int64)
    for a, b, c in zip(letters, letters[1:], letters[2:]):
        for k in (out,):
            k += (np.roll(language_id.signs(ord(a)), 2) * np.roll(language_id.signs(ord(b)), 1) * language_id.signs(ord(c))).astype(np.int64)
    return out


def test_language_equals_plain_bundles(spark, monkeypatch):
    rows = documents()[:80] + [(9001, "ohne" * 700, "de"), (9002, "x" * 100, "de"), (9003, "", "en"), (9004, None, "en"), (9002, "x" * 100, "de")]
    monkeypatch.setattr(language_id, "PIECE", 37)
    assert np.array_equal(language_id.document_vectors([t for _, t, _ in rows]), np.array([plain_bundle(t or "") for _, t, _ in rows]))
    monkeypatch.undo()
    known = language_id.language_prototypes(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5))
    sums = {}
    for _, t, lang in rows:
        sums[lang] = sums.get(lang, 0) + plain_bundle(t or "")
    assert list(known) == sorted(sums) and all(np.allclose(known[x], sums[x] / np.linalg.norm(sums[x])) for x in known)
    found = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs(spark, [t for _, t, _ in rows]), known).select("row.doc_id", "lang_pred", "score").collect()}
    for i, (_, t, _) in enumerate(rows):
        v = plain_bundle(t or "")
        cosines = {x: float(v @ known[x]) / max(1e-9, np.linalg.norm(v)) for x in known}
        want = max(sorted(cosines), key=cosines.get) if np.any(v) else "und"
        assert found[i][0] == want and found[i][1] == pytest.approx(min(1, max(0, cosines.get(want, 0))))


def test_language_ties_null_ids_and_no_rows(spark):
    kind = "doc_id long, text string, lang string"
    known = language_id.language_prototypes(spark.createDataFrame([(1, "same words", "b"), (2, "same words", "a"), (None, "other", "c")], kind))
    assert list(known) == ["a", "b"]
    rows = language_id.identify(docs(spark, ["same words"] * 3), known).collect()
    assert {r.lang_pred for r in rows} == {"a"} and len({r.score for r in rows}) == 1 and len(rows) == 3
    none = spark.createDataFrame([], kind)
    assert language_id.language_prototypes(none) == {} and language_id.identify(none, known).count() == 0


def alike(a, b):
    """Jaccard similarity of labelled shingles that keep their order (longest common subsequence)."""
    def shingles(t):
        w, seen, out = re.findall(r"\w+", t.lower()), {}, []
        for k in range(max(1, len(w) - 4)):
            s = tuple(w[k : k + 5])
            seen[s] = seen.get(s, 0) + 1
            out.append((s, seen[s]))
        return out

    x, y = shingles(a), shingles(b)
    line = [0] * (len(y) + 1)
    for s in x:
        before = 0
        for j, t in enumerate(y):
            before, line[j + 1] = line[j + 1], before + 1 if s == t else max(line[j + 1], line[j])
    return line[-1] / (len(x) + len(y) - line[-1])


def classes(texts):
    up = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            a, b = texts[i], texts[j]
            wordless = a is not None and b is not None and not (re.search(r"\w", a) and re.search(r"\w", b))
            if a is not None and b is not None and (a == b if wordless else alike(a, b) >= 0.8):
                ri, rj = up[i], up[j]
                up = [min(ri, rj) if u in (ri, rj) else u for u in up]
    return up


def test_near_duplicates_equal_brute_force(spark):
    random.seed(3)
    texts = []
    for _ in range(12):
        words = [f"w{random.randint(0, 5000)}" for _ in range(random.choice([3, 30, 120]))]
        texts.append(" ".join(words))
        for edits in (1, 2, 4, 8):
            copy = list(words)
            for _ in range(edits):
                copy[random.randrange(len(copy))] = f"e{random.randint(0, 10**6)}"
            texts.append(" ".join(copy))
        texts += [" ".join(words).upper() + "!", " ".join(words[60:] + words[:60])]
    texts += [None, None, "", "", "!!", "!!", "??", "one", "One.", "a b c d", "w " * 300, "w " * 299]
    found = {r.doc_id: r for r in minhash_dedup.near_duplicate_classes(docs(spark, texts)).collect()}
    assert [found[i].class_id for i in range(len(texts))] == classes(texts)
    assert all(r.kept == (r.class_id == r.doc_id) for r in found.values())


def test_large_near_copy_group(spark):
    random.seed(4)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for _ in range(300):
        copy = list(base)
        for _ in range(random.randint(0, 6)):
            copy[random.randrange(150)] = f"e{random.randint(0, 10**6)}"
        texts.append(" ".join(copy))
    found = {r.doc_id: r.class_id for r in minhash_dedup.near_duplicate_classes(docs(spark, texts)).collect()}
    sets = [set(zip(*(t.split()[k:] for k in range(5)))) for t in texts]
    up = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n / (len(sets[i]) + len(sets[j]) - n) >= 0.8 and up[i] != up[j]:
                ri, rj = up[i], up[j]
                up = [min(ri, rj) if u in (ri, rj) else u for u in up]
    assert [found[i] for i in range(len(texts))] == up


def test_near_duplicates_of_repeated_null_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b c d e f g"), (1, "a b c d e f g"), (None, "a b c d e f g"), (2, "a b c d e f g")], "doc_id long, text string")
    found = sorted((str(r.doc_id), str(r.class_id), r.kept) for r in minhash_dedup.near_duplicate_classes(df).collect())
    assert found == [("1", "1", True), ("1", "1", True), ("2", "1", False), ("None", "None", True)]
    assert minhash_dedup.near_duplicate_classes(df.where("doc_id > 5")).count() == 0


def luhn(x):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(x))) % 10 == 0


def base_spans(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for kind, pattern, least, most in (("card", r"[0-9]([\x20-]?[0-9])+", 13, 19), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if least <= len(digits) <= most and (kind == "phone" or luhn(digits)):
                out.append((kind, *m.span()))
    return ",".join("%s:%d:%d" % x for x in out)


def test_base_spans_equal_python(spark):
    random.seed(6)
    texts = [None, "", "a@b.c", "x@y.z%q@r.s.t..", "𐍈 +49 (30) 1234-5678. 4111 1111 1111 1111", "0.0.0.0 256.1.1.1 1.2.3.4.5.6.7.8 00255.1.1.1", "+1 2", "@" * 50, "a." * 5000 + "@b.c"]
    texts += ["".join(random.choice("a@.+-1 2(0)9é%𐍈") for _ in range(random.randint(1, 80))) for _ in range(600)]
    found = {r.doc_id: r for r in personal_data.find_personal_data(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        want = base_spans(t or "")
        assert found[i].base_sha256 == sha(want), (t, found[i].spans, want)
        assert found[i].spans.startswith(want) and found[i].n_email == want.count("email:")


def test_bootstrap_finds_identifiers_behind_learnt_words(spark):
    texts = [f"Bitte kunden nummer: a{i}@b.de schreiben {i}" for i in range(9)] + ["Bitte kunden nummer: K-2024-77x schreiben", "Die ganze zahl K-2024-78x bleibt"] * 2
    found = {r.doc_id: r.spans for r in personal_data.find_personal_data(docs(spark, texts)).collect()}
    assert found[9] == found[11] == "id:21:31" and found[10] == found[12] == ""
    rows = {r.doc_id: r for r in personal_data.redacted(docs(spark, [*texts, None, "+49 30 1234567 x"])).collect()}
    assert rows[9].text == "Bitte kunden nummer: [ID] schreiben" and rows[0].text == "Bitte kunden nummer: [EMAIL] schreiben 0" and rows[13].text is None and rows[14].text == "[PHONE] x" and rows[0].row == "clash"


def test_unseen_identifiers_do_not_speak_against_their_pattern(spark):
    seeds = [f"Bitte kunden nummer: a{i}@b.de schreiben" for i in range(5)] + [f"Am letzten tag a{i}@c.de kommen" for i in range(5)]
    unseen = [f"Bitte kunden nummer: K-2024-{i}x schreiben" for i in range(10, 40)] + [f"Am letzten tag K-2025-{i}x kommen" for i in range(10, 40)]
    short = [f"Am letzten tag {i} kommen" for i in range(20)]
    found = {r.doc_id: r.n_found for r in personal_data.find_personal_data(docs(spark, [*seeds, *unseen, *short])).collect()}
    assert [found[i] for i in range(10, 40)] == [1] * 30
    assert sum(found.values()) == 30


def plain_discoveries(texts, support=3, confidence=0.8):
    """The same graph with dictionaries: document -> discovered spans."""
    def plain(x):
        return re.sub("[1-9]", "0", x.lower())

    def around(text, a, b):
        before, after = plain(text[:a]), plain(text[b:])
        *words, glue = re.split(r"\s+", before) if before else [""]
        words = [w for w in words if w]
        right = [w for w in re.split(r"\s+", re.sub(r"^\S*", "", after)) if w]
        out = [("b", tuple(words[-k:]), glue) for k in (1, 2, 3) if len(words) >= k] + [("a", tuple(right[:k]), "") for k in (1, 2, 3) if len(right) >= k]
        return [c for c in out if any(re.search("[^\\W\\d_]", w) for w in c[1])]

    counts, spots, edges = {}, [], {}
    for i, text in enumerate(texts):
        text = text or ""
        for w in re.split(r"\s+", plain(text)):
            counts[w] = counts.get(w, 0) + 1
        base = [tuple(map(int, x.split(":")[1:])) for x in base_spans(text).split(",") if x]
        spots += [(i, a, b, 1.0, True) for a, b in base]
        for m in re.finditer(r"(?<![^\W_])(?<![._@+-])(?=[A-Za-z._@+-]*[0-9])[A-Za-z0-9._@+-]{6,}", text):
            if all(b <= m.start() or a >= m.end() for a, b in base):
                spots.append((i, *m.span(), 1.0 if re.fullmatch(personal_data.KEY[1:-1], m[0]) else None, False))
    for i, a, b, seed, _ in spots:
        for c in around(texts[i], a, b):
            edge = edges.setdefault(c, {}).setdefault(texts[i][a:b].lower(), [0, None])
            edge[0], edge[1] = edge[0] + 1, seed or edge[1]
    scores, taken = {inst: 1.0 for e in edges.values() for inst, (_, s) in e.items() if s}, {}
    while True:
        new = {}
        for c, e in edges.items():
            hits, unseen = sum(scores.get(x, 0) * n for x, (n, _) in e.items()), sum(n for x, (n, _) in e.items() if x not in scores)
            if c not in taken and sum(x in scores for x in e) >= support:
                rate = min(1, hits / max(1, min(counts.get(w, 0) for w in c[1]) - unseen))
                if rate >= confidence:
                    new[c] = rate
        if not new:
            break
        taken |= new
        scores = {x: max(r for c, r in new.items() if x in edges[c]) for e in edges.values() for x in e if any(x in edges[c] for c in new)} | scores
    return [sorted((a, b) for j, a, b, _, base in spots if j == i and not base and any(c in taken for c in around(texts[i], a, b))) for i in range(len(texts))]


def test_bootstrap_equals_plain_graph(spark):
    random.seed(21)
    words = ["konto", "nummer:", "kunde", "der", "die", "code", "von", "amt", "#", "am"]
    ids = lambda: random.choice([f"a{random.randint(0, 40)}@b.de", f"K-20{random.randint(10, 60)}-x", f"{random.randint(0, 9)}", f"10.0.0.{random.randint(0, 60)}", f"{random.getrandbits(160):040x}"])
    texts = []
    for _ in range(150):
        lead = random.choice(["konto nummer: ", "der ", "kunde von ", "code=", "token = \"", "am amt # ", ""])
        texts.append(" ".join(random.choices(words, k=random.randint(0, 4))) + " " + lead + ids() + random.choice(['" ', ", ", " ", ""]) + " ".join(random.choices(words, k=random.randint(0, 4))))
    # A chain: each pattern is reached through what the one before it found.
    texts += [f"stufe eins a{i}@x.de" for i in range(4)] + [f"stufe eins K-9{i}-1x" for i in range(4)]
    for k in range(1, 7):
        texts += [f"reihe{'q' * k} hier K-9{i}-{k}x" for i in range(4)] + [f"reihe{'q' * k} hier K-9{i}-{k + 1}x" for i in range(4)]
    texts += ["x@y.de,1.2.3.4,K-77-aa1 ende", None, "", " "] + texts[:40]
    found = {r.doc_id: r for r in personal_data.find_personal_data(docs(spark, texts)).collect()}
    want = plain_discoveries(texts)
    for i in range(len(texts)):
        got = sorted(tuple(map(int, x.split(":")[1:])) for x in found[i].spans.split(",") if x.startswith("id:"))
        assert got == want[i], texts[i]
    assert sum(map(len, want)) > 30 and found[150 + 8 + 6 * 8 - 1].n_found == 1


def test_personal_data_of_repeated_and_no_rows(spark):
    df = docs(spark, ["a@b.de x"] * 3)
    assert {(r.n_email, r.n_spans) for r in personal_data.find_personal_data(df).collect()} == {(1, 1)}
    assert personal_data.find_personal_data(df.where("doc_id > 9")).count() == 0 and personal_data.redacted(df.where("doc_id > 9")).count() == 0


def test_pipeline(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["identify_language", "drop_near_duplicates", "redact_personal_data", "mix_sources", "tokenise"]
    out = corpus_pipeline.run(spark, SF).collect()
    texts = dict((i, t) for i, t, _ in documents())
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    kept = {r.doc_id for r in minhash_dedup.near_duplicate_classes(docs(spark, [texts[i] for i in range(len(texts))])).collect() if r.kept}
    assert out and {r.doc_id for r in out} <= kept
    for r in out:
        clean = texts[r.doc_id]
        if not base_spans(clean):
            ids = model.encode(clean)
            assert r.ids == ids and r.decoded_sha256 == sha(model.decode(ids))
        else:
            assert not base_spans(model.decode(r.ids))


@pytest.mark.parametrize("name", ["identify_language", "drop_near_duplicates", "redact_personal_data", "mix_sources"])
def test_stages_keep_columns(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    rows = [(1, "the text of a mail a@b.de for all", "en", "s", 9, "x"), (1, "the text of a mail a@b.de for all", "en", "s", 9, "x"), (None, None, None, None, None, None), (3, "", None, "t", 0, "y")]
    df = spark.createDataFrame(rows, KIND)
    assert stage(spark, df, SF).columns == df.columns
    assert stage(spark, df.where("doc_id = 99"), SF).count() == 0
    if name == "drop_near_duplicates":
        assert sorted(str(r.doc_id) for r in stage(spark, df, SF).collect()) == ["1", "3", "None"]


def test_language_stage_rejects_what_no_language_explains(spark):
    clean = [(i, t, lang, "s", 1, "x") for i, t, lang in documents()]
    strange = ["qwxz kjvq zzxq pqkw vbnx qqzz wxkj zxqv", "ой у лузі червона калина похилилася, зажурилася", "今日は天気がいいですね。明日も晴れるといいですね。", "a" * 300]
    other = [*strange, "今日は", "A.", "12 34", "", None]
    df = spark.createDataFrame(clean + [(9000 + i, t, None, "s", 1, "x") for i, t in enumerate(other)], KIND)
    found = {r.doc_id: r.lang for r in corpus_pipeline.identify_language(spark, df, SF).collect()}
    assert set(found) == {r[0] for r in clean} | {9004, 9005} and None not in found.values()
    known = language_id.language_prototypes(df)
    for text in strange:  # by the definition, one trigram after the other
        v = plain_bundle(text)
        assert max(float(v @ known[x]) for x in known) / np.linalg.norm(v) < 2 / 32
    unlabelled = df.withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.identify_language(spark, unlabelled, SF).collect()
    assert {r.doc_id for r in kept} == {r[0] for r in clean} | {9000 + i for i in range(6)} and {r.lang for r in kept} == {"und"}


def test_mix_takes_rows_without_or_with_shared_ids_by_their_source(spark):
    rows = [(None, f"w{i} " * 20, None, source, None, str(i)) for i in range(400) for source in "abc"]
    rows += [(7, f"v{i} " * 20, None, "c", None, str(i)) for i in range(400)]
    df = spark.createDataFrame(rows, KIND)
    plan = mixing.systematic_mix(df, ["source"]).groupBy("source", "target").sum("__copies").collect()
    taken = {r.source: r["count"] for r in corpus_pipeline.mix_sources(spark, df, SF).groupBy("source").count().collect()}
    assert taken == {r.source: r["sum(__copies)"] for r in plan}
    assert all(abs(taken[r.source] * 20 - r.target) <= 20 for r in plan)


def test_near_duplicates_are_dropped_by_row(spark):
    text = " ".join(f"w{i}" for i in range(40))
    other = " ".join(f"v{i}" for i in range(40))
    rows = [(1, text), (5, text + " more"), (5, other), (None, text.upper()), (None, "a text of its own"), (None, "a text of its own"), (8, None), (8, None), (9, None), (None, None)]
    df = spark.createDataFrame([(i, t, None, "s", None, "clash") for i, t in rows], KIND)
    kept = corpus_pipeline.drop_near_duplicates(spark, df, SF).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in kept) == sorted([("1", text), ("5", other), ("None", "a text of its own"), ("8", "None"), ("9", "None"), ("None", "None")])


def test_word_hashes_and_buckets_equal_plain_ones():
    texts = ["", "...", "a", "b a b a b a b a b", "Ab,cd", "ab cd", " ab  cd!", "x_1 ٣ ½ ünï", "a b c d e f", "a b c d e f g", "one two " * 500, "x" * 100_000]
    hashes, digests = minhash_dedup.word_hashes(texts)
    words = [re.findall(r"\w+", t.lower()) for t in texts]
    assert [len(h) for h in hashes] == [len(w) for w in words]
    by_word = {}
    for w, h in zip(words, hashes, strict=True):
        assert all(by_word.setdefault(x, y) == y for x, y in zip(w, h.tolist(), strict=True))
    assert len(set(by_word.values())) == len(by_word)
    assert len(set(digests)) == len({(tuple(w), t if not w else "") for w, t in zip(words, texts, strict=True)})
    factors = minhash_dedup.band_factors()
    shingles = [minhash_dedup.labelled_shingles(h) for h in hashes]
    for s, buckets in zip(shingles, minhash_dedup.bucket_lists(shingles, factors), strict=True):
        assert buckets.tolist() == (minhash_dedup.order_minhash(s, factors).tolist() if len(s) else [])
    many = ["a" * 2**19] * 5
    assert [x for s in minhash_dedup.portions(many) for x in many[s]] == many


def test_repeated_near_copies_cost_no_pairs(spark):
    words = [f"w{i}" for i in range(60)]
    near = " ".join([*words[:59], "x"])
    rows = [(i, " ".join(words) if i % 2 else near) for i in range(8000)] + [(9000 + i % 3, f"other text number {i} of its own kind") for i in range(300)]
    found = minhash_dedup.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert len(found) == 8300 and {r.class_id for r in found if r.doc_id < 8000} == {0}
    assert sum(r.kept for r in found if r.doc_id < 8000) == 1


def test_short_documents_lose_no_links(spark):
    random.seed(9)
    texts = []
    for i in range(400):
        words = [f"v{i}x{k}" for k in range(random.randint(8, 12))]
        texts += [" ".join(words), " ".join([*words, f"end{i}"])]
    found = {r.doc_id: r.class_id for r in minhash_dedup.near_duplicate_classes(docs(spark, texts)).collect()}
    assert [found[i] for i in range(len(texts))] == [i - i % 2 if alike(texts[i - i % 2], texts[i - i % 2 + 1]) >= 0.8 else i for i in range(len(texts))]

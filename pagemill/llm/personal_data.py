"""Operator 6: personal data by bootstrapped contextual extraction. DataFrame operations only.

Base spans come from the patterns of KINDS; matches that fail their check are dropped without another try. They seed a
bootstrap over the whole corpus, as do tokens whose shape alone tells an access key (KEY). Tokens with digits that no base
span touches are candidates. One to three words before or after a span, with what is glued to its front, are lexical
patterns; patterns and instances form a graph.

A pattern's confidence says how often an identifier stands there: the scores of its known instances, by occurrence, over
all occurrences of its rarest word, those with a candidate that nothing has reached yet left out. So ordinary words behind
the same words speak against a pattern and unseen identifiers don't. Seeds score 1, and an instance that is first reached
gets the confidence of its best pattern. A pattern is taken with MIN_SUPPORT known instances and MIN_CONFIDENCE, and stays;
rounds go on until none is new, so chains of any length are followed. Candidates that stand at a taken pattern are added
as spans of kind `id`. Base spans always stay.

The expressions of KINDS are written for linear time: a token is tried at its start only, or where the last match
ended. Spans depend on the text alone, so equal texts are looked at once after the scan, counted by their copies; positions
come from a window inside one text. Words around a match are looked for up to the third match of its kind before or after it.

Defined results: a null or empty text has no spans. Ids play no part, so repeated rows and null ids get their text's
spans. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import materialise, scratch, table

#: (kind, expression, what a text must contain to be searched), in the order of the output.
KINDS = (
    ("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    ("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    ("card", r"(?<![0-9])[0-9](?:[\x20-]?+[0-9])++", ""),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
)
FOUND = "id"
CANDIDATE = r"(?<![\p{L}\p{N}._@+-])(?=[A-Za-z._@+-]*+[0-9])[A-Za-z0-9._@+-]{6,}+"
#: Candidates that are seeds: 32 to 64 hexadecimal digits, letters and digits among them.
KEY = r"^(?=.*[0-9])(?=.*[A-Fa-f])[0-9A-Fa-f]{32,64}$"
WORDS = 3
BEFORE = rf"(?<!\S)((?:\S++\s++){{0,{WORDS}}}+\S*+)\z"
AFTER = rf"\A\S*+((?:\s++\S++){{0,{WORDS}}}+)"
BYTE_PART = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?)?"
MIN_SUPPORT = 3
MIN_CONFIDENCE = 0.8


def luhn(digits: Column) -> Column:
    doubled = lambda v: v * 2 - F.when(v > 4, 9).otherwise(0)

    def add(total: Column, i: Column) -> Column:
        v = F.substring(digits, -i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, doubled(v)).otherwise(v)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))), F.lit(0), add) % 10 == 0


def passes(kind: Column, match: Column) -> Column:
    """Whether a match passes the check of its kind."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    card = F.when(n.between(13, 19), luhn(digits)).otherwise(False)
    ip = match.rlike(rf"^{BYTE_PART}(?:\.{BYTE_PART}){{3}}$")
    return F.when(kind == "ip", ip).when(kind == "card", card).when(kind == "phone", n.between(9, 15)).otherwise(True)


def text_key(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def matches_of(text: Column, name: str, pattern: str) -> list[Column]:
    return [F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias(f"{name}_m"), F.split(text, pattern, -1).alias(f"{name}_p")]


def _searched() -> list[tuple[str, str, Column]]:
    digits = F.col("text").rlike("[0-9]")
    guards = [(k, p, F.contains(F.col("text"), F.lit(c)) & (digits if c != "@" else F.lit(True)) if c else digits) for k, p, c in KINDS]
    return [*guards, (FOUND, CANDIDATE, digits)]


def plain_words(c: Column) -> Column:
    """Lower-cased, with one digit for all, so that words with numbers are alike."""
    return F.translate(F.lower(c), "123456789", "000000000")


def scan(docs: DataFrame) -> DataFrame:
    """id, key of the text, and `hits`: struct(kind, pos, m, gap, before, after) for each match of each expression."""
    empty = F.array().cast("array<string>")
    rows = docs.select("id", F.col("text"), text_key(F.col("text")).alias("key"))
    wide = rows.select("id", "key", *(F.when(g, c).otherwise(empty).alias(f"{k}_{s}") for k, p, g in _searched() for s, c in zip("mp", matches_of(F.col("text"), k, p), strict=True)))

    def of(kind: str) -> Column:
        m, p = F.col(f"{kind}_m"), F.col(f"{kind}_p")
        # The text around a match, from its gaps and neighbours: what is out of range is empty.
        at = lambda xs, i: F.coalesce(F.get(xs, i), F.lit(""))
        before = lambda i: F.concat(*[x for k in range(WORDS, 0, -1) for x in (F.when(i >= k, at(p, i - k)).otherwise(""), F.when(i >= k, at(m, i - k)).otherwise(""))], at(p, i))
        after = lambda i: F.concat(*[x for k in range(1, WORDS + 1) for x in (at(p, i + k), at(m, i + k))])
        return F.transform(m, lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("pos"), x.alias("m"), F.length(at(p, i)).alias("gap"), plain_words(F.regexp_extract(before(i), BEFORE, 1)).alias("before"), plain_words(F.regexp_extract(after(i), AFTER, 1)).alias("after")))

    return wide.select("id", "key", F.concat(*[of(k) for k, _, _ in _searched()]).alias("hits"))


def spans_of(scanned: DataFrame) -> DataFrame:
    """key, copies, kind, start, end, m, before, after of each match in distinct texts, in code points."""
    distinct = scanned.where(F.size("hits") > 0).groupBy("key").agg(F.first("hits").alias("hits"), F.count(F.lit(1)).alias("copies"))
    one = distinct.select("key", "copies", F.explode("hits").alias("h")).select("key", "copies", "h.*")
    ends = F.sum(F.col("gap") + F.length("m")).over(Window.partitionBy("key", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    return one.withColumn("end", ends.cast("long")).select("key", "copies", "kind", (F.col("end") - F.length("m")).alias("start"), "end", "m", "before", "after")


def untouched(spans: DataFrame) -> DataFrame:
    """The candidates of `spans` that no base span overlaps: none that begins earlier reaches them, none begins in them."""
    base = F.col("kind") != FOUND
    order = Window.partitionBy("key").orderBy("start", F.when(base, 0).otherwise(1), "end")
    reached = F.max(F.when(base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.min(F.when(base, F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    rows = spans.withColumns({"reached": reached, "begins": begins}).where(~base)
    return rows.where((F.coalesce("reached", F.lit(0)) <= F.col("start")) & (F.coalesce("begins", F.col("end")) >= F.col("end"))).drop("reached", "begins")


def contexts(spans: DataFrame) -> DataFrame:
    """`spans` once for each lexical pattern at them: struct ctx(side, words, glue). A pattern's words hold a letter."""
    split = lambda c: F.filter(F.split(c, r"\s+"), lambda x: x != "")
    glue = F.regexp_extract("before", r"(?<!\S)(\S*)\z", 1)
    left, right = split(F.substring(F.col("before"), F.lit(1), F.length("before") - F.length(glue))), split(F.col("after"))
    of = lambda side, xs, glue: [F.when(F.size(xs) >= k, F.struct(F.lit(side).alias("side"), (F.slice(xs, -k, k) if side == "before" else F.slice(xs, 1, k)).alias("words"), glue.alias("glue"))) for k in range(1, WORDS + 1)]
    found = F.filter(F.array(*of("before", left, glue), *of("after", right, F.lit(""))), lambda x: x.isNotNull() & F.exists(x["words"], lambda w: w.rlike(r"\p{L}")))
    return spans.withColumn("ctx", F.explode(found))


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n: how often each word stands in all `docs` (text)."""
    words = docs.select(F.explode(F.split(plain_words(F.col("text")), r"\s+")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def pattern_graph(base: DataFrame, candidates: DataFrame, docs: DataFrame, support: int) -> DataFrame:
    """ctx, inst, seed (1 or null), n (occurrences) and total (of the pattern's rarest word).

    Patterns with fewer than `support` instances of any kind can never be taken and are left out.
    """
    told = lambda df, seed: contexts(df).select("ctx", F.lower("m").alias("inst"), seed.alias("seed"), "copies")
    edges = told(base, F.lit(1.0)).unionByName(told(candidates, F.when(F.col("m").rlike(KEY), F.lit(1.0))))
    edges = materialise(edges.groupBy("ctx", "inst").agg(F.max("seed").alias("seed"), F.sum("copies").alias("n")), "pii-edges")
    often = edges.groupBy("ctx").agg(F.count(F.lit(1)).alias("instances")).where(F.col("instances") >= support).select("ctx")
    often = materialise(often, "pii-contexts")
    needed = often.select("ctx", F.explode(F.array_distinct("ctx.words")).alias("word"))
    totals = needed.join(word_counts(docs), "word").groupBy("ctx").agg(F.min("n").alias("total"), F.count(F.lit(1)).alias("words"))
    totals = totals.where(F.col("words") == F.size(F.array_distinct("ctx.words"))).select("ctx", "total")
    return materialise(edges.join(materialise(totals, "pii-totals"), "ctx"), "pii-graph")


def taken_patterns(graph: DataFrame, support: int = MIN_SUPPORT, confidence: float = MIN_CONFIDENCE) -> DataFrame | None:
    """ctx, confidence of the patterns of `graph` that are taken in any round; None if there are none."""
    scores = graph.where("seed is not null").groupBy("inst").agg(F.max("seed").alias("score"))
    taken = None
    while True:
        judged = graph.join(scores, "inst", "left")
        by = judged.groupBy("ctx").agg(
            F.count("score").alias("known"), F.sum(F.col("score") * F.col("n")).alias("hits"),
            F.coalesce(F.sum(F.when(F.col("score").isNull(), F.col("n"))), F.lit(0)).alias("unseen"), F.max("total").alias("total"),
        )
        by = by.withColumn("confidence", F.least(F.lit(1.0), F.col("hits") / F.greatest(F.col("total") - F.col("unseen"), F.lit(1))))
        new = by.where((F.col("known") >= support) & (F.col("confidence") >= confidence)).select("ctx", "confidence")
        new = materialise(new if taken is None else new.join(taken.select("ctx"), "ctx", "left_anti"), "pii-patterns")
        if new.isEmpty():
            return taken
        taken = new if taken is None else taken.unionByName(new)
        reached = graph.join(new, "ctx").groupBy("inst").agg(F.max("confidence").alias("score")).join(scores.select("inst"), "inst", "left_anti")
        scores = materialise(scores.unionByName(reached), "pii-scores")


def discover(base: DataFrame, candidates: DataFrame, docs: DataFrame, support: int = MIN_SUPPORT, confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """The `candidates` (key, copies, start, end, m, before, after) at patterns that the seeds in `base` (like candidates)
    and among them induce over `docs` (text)."""
    taken = taken_patterns(pattern_graph(base, candidates, docs, support), support, confidence)
    shape = ["key", F.lit(FOUND).alias("kind"), "start", "end", "m"]
    if taken is None:
        return candidates.where(F.lit(False)).select(*shape)
    return contexts(candidates).join(taken.select("ctx"), "ctx", "left_semi").select(*shape).distinct()


def personal_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(scanned, spans): `scanned` has id and key of each row of `docs` (id, text), `spans` key, kind, start, end, m."""
    with scratch(docs.sparkSession) as keep:
        scanned = materialise(scan(docs), "pii-scan")
        spans = materialise(spans_of(scanned).where((F.col("kind") == FOUND) | passes(F.col("kind"), F.col("m"))), "pii-spans")
        base = spans.where(F.col("kind") != FOUND)
        candidates = materialise(untouched(spans), "pii-candidates")
        found = discover(base, candidates, docs.select("text"))
        told = base.select("key", "kind", "start", "end", "m").unionByName(found)
        return keep(scanned.select("id", "key"), "pii-keys"), keep(told, "pii-found")


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found and n_spans of every row of `docs`."""
    scanned, spans = personal_spans(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    place = F.array_position(F.array(*[F.lit(k) for k, _, _ in KINDS], F.lit(FOUND)), F.col("kind"))
    sorted_ = spans.groupBy("key").agg(F.sort_array(F.collect_list(F.struct(place.alias("place"), "start", "end", "kind"))).alias("all"))
    sorted_ = materialise(sorted_, "pii-texts")  # so that a text with very many copies can be split in the join
    out = scanned.join(sorted_, "key", "left").withColumn("all", F.coalesce("all", F.filter(F.array(F.struct(F.lit(0).cast("long").alias("place"), F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end"), F.lit("").alias("kind"))), lambda x: F.lit(False))))
    of = lambda kind: F.size(F.filter("all", lambda s: s["kind"] == kind)).cast("long")
    return out.select(
        F.col("id").alias(id_col),
        *[of(k).alias(f"n_{k}") for k, _, _ in KINDS],
        F.sha2(listed(F.filter("all", lambda s: s["kind"] != FOUND)).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("all")).alias("spans"),
        of(FOUND).alias("n_found"),
        F.size("all").cast("long").alias("n_spans"),
    )


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with personal data replaced by [EMAIL], [IP], [CARD], [PHONE] and [ID]; all columns stay.

    Base kinds are replaced in the row, one kind after the other; what the bootstrap finds comes by a join on the text's key.
    """
    _, spans = personal_spans(docs.select(F.lit(None).cast("long").alias("id"), F.col(text_col).alias("text")))
    found = spans.where(F.col("kind") == FOUND).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    found = materialise(found, "pii-cuts")
    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text")).withColumn("key", text_key(F.col("text")))
    rows = rows.join(found, "key", "left").select("row", "text", "cuts")
    # What was found goes first, while positions hold: the parts between the cuts, joined by the mark.
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform("cuts", lambda c: c["end"]))
    ends = F.concat(F.transform("cuts", lambda c: c["start"]), F.array(F.length("text").cast("long")))
    parts = F.zip_with(starts, ends, lambda a, b: F.substring(F.col("text"), (a + 1).cast("int"), (b - a).cast("int")))
    rows = rows.select("row", F.when(F.col("cuts").isNotNull(), F.array_join(parts, f"[{FOUND.upper()}]")).otherwise(F.col("text")).alias("text"))
    for kind, pattern, must in KINDS:
        rows = rows.select("row", "text", *matches_of(F.col("text"), "x", pattern))
        marked = F.zip_with("x_p", "x_m", lambda p, m: F.concat(p, F.when(m.isNull(), "").when(passes(F.lit(kind), m), f"[{kind.upper()}]").otherwise(m)))  # noqa: B023
        rows = rows.select("row", F.when(F.contains(F.col("text"), F.lit(must)) & (F.size("x_m") > 0), F.array_join(marked, "")).otherwise(F.col("text")).alias("text"))
    return rows.select(*[F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])


def op6_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in the texts of all `documents`."""
    return find_personal_data(table(spark, sf_dir, "documents"))

"""Operator 10: URL filters by association rules. DataFrame operations only.

Fixed rules (host and path prefix) decide first; the longest that fits wins. For the other URLs, Spark's FP-growth mines
token combinations of labelled URLs. Tokens below the support can be in no rule and go first; tokens that stand in exactly
the same labelled URLs are one item, as any of them says the same. FP-growth then proposes the combinations of at most
MOST_IN_RULE items that stand together with a label often enough: a URL of more than MOST_ITEMS items gives several
baskets, so that any MOST_IN_RULE of its items stand together in one of them. No item is left out, and a basket has at
most 2**MOST_ITEMS combinations. What is proposed is counted over the whole labelled URLs. Rules `items => allow` and
`items => block` that pass the support and confidence bounds are kept and matched by an inverted index: each rule is posted
under its rarest item, a URL looks up its own tokens, and the rules found are verified against all of its tokens; it needs
one token of each item. The rule of highest confidence, then support, then lift decides, `block` before `allow` on a tie;
a URL without any rule is allowed.

The query's labelled URLs are those that the fixed rules decide, all of them: the tables label no URL. The operator
takes any labelled URLs.

Defined results: a null URL or one without `://` has an empty host and path, no tokens, and is allowed. Repeated rows
get equal verdicts. Without labelled URLs no rule is mined. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import materialise, table

#: (verdict, host, path); a rule holds for the host and its subdomains and for paths that start with its path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.9
#: Items of a rule, and of a basket that FP-growth reads.
MOST_IN_RULE, MOST_ITEMS = 5, 15
LABEL = "label="


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    return F.translate(F.regexp_extract(F.coalesce(rest, F.lit("")), r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    return F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: host labels and their last two together, path words (digits as one token), query keys."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    words = F.filter(F.split(F.regexp_replace(F.lower(path), "[0-9]+", "#"), r"[^\p{L}#]+"), lambda x: x != "")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    keys = F.filter(F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1)), lambda x: x != "")
    domain = F.when(F.size(labels) > 1, F.array(F.concat(F.lit("domain="), F.array_join(F.slice(labels, -2, 2), ".")))).otherwise(F.array().cast("array<string>"))
    prefix = lambda name, xs: F.transform(xs, lambda x: F.concat(F.lit(f"{name}="), x))
    return F.array_distinct(F.concat(domain, prefix("host", labels), prefix("path", words), prefix("key", keys)))


def parse_urls(urls: DataFrame) -> DataFrame:
    """`urls` (url, any other columns) with host and path."""
    return urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, at, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(at + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def frequent_items(baskets: DataFrame, rows: int, min_support: float) -> DataFrame:
    """item, n, alike: the tokens of `baskets` (id, tokens) that reach the support, those of the same baskets together.

    The tokens are at most (tokens of a URL on average) / `min_support`.
    """
    each = baskets.select("id", F.explode(F.array_distinct("tokens")).alias("token"))
    told = each.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"))
    told = told.where(F.col("n") >= min_support * rows)
    return told.groupBy("n", "x", "y").agg(F.min("token").alias("item"), F.array_sort(F.collect_list("token")).alias("alike")).select("item", "n", "alike")


def narrow_baskets(items: Column, most: int = MOST_ITEMS, in_rule: int = MOST_IN_RULE) -> Column:
    """Baskets of at most `most` of the `items`, in one of which any `in_rule` of them stand together."""
    width = most // in_rule
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / width)), lambda i: F.slice(items, (i * width + 1).cast("int"), width))
    none = F.array(F.array().cast("array<array<string>>"))
    chosen = F.aggregate(blocks, none, lambda sets, block: F.concat(sets, F.transform(F.filter(sets, lambda x: F.size(x) < in_rule), lambda x: F.concat(x, F.array(block)))))
    several = F.transform(F.filter(chosen, lambda x: F.size(x) == in_rule), F.flatten)
    return F.when(F.size(items) <= most, F.array(items)).otherwise(several)


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules (tokens, verdict, confidence, support, lift, post, needs) mined from `labelled` (tokens, verdict).

    `tokens` names each item of a rule by its first token, `needs` has all tokens of each item, and `post` is the rarest
    item, under which the inverted index holds the rule.
    """
    baskets = labelled.where("verdict is not null").select("tokens", "verdict").withColumn("id", F.monotonically_increasing_id())
    baskets = materialise(baskets, "url-baskets")
    rows = baskets.count()
    often = materialise(frequent_items(baskets, max(1, rows), min_support), "url-items")
    names = often.select(F.explode("alike").alias("token"), "item").agg(F.map_from_entries(F.collect_list(F.struct("token", "item"))).alias("names")).withColumn("one", F.lit(1))  # bounded as `often`
    told = F.filter("tokens", lambda t: F.map_contains_key("names", t))
    known = baskets.withColumn("one", F.lit(1)).join(F.broadcast(names), "one")
    known = materialise(known.select(F.array_sort(F.array_distinct(F.transform(told, lambda t: F.element_at("names", t)))).alias("tokens"), "verdict"), "url-known")
    narrow = materialise(known.select(F.explode(narrow_baskets(F.col("tokens"))).alias("items"), "verdict").select(F.concat("items", F.array(F.concat(F.lit(LABEL), "verdict"))).alias("items")), "url-narrow")
    least = min_support * rows / max(1, narrow.count())
    mined = FPGrowth(itemsCol="items", minSupport=min(1.0, least * (1 - 1e-9))).fit(narrow).freqItemsets
    found = mined.select(F.filter("items", lambda x: x.startswith(LABEL)).alias("label"), F.array_sort(F.filter("items", lambda x: ~x.startswith(LABEL))).alias("tokens"))
    found = found.where((F.size("label") == 1) & F.size("tokens").between(1, MOST_IN_RULE)).select("tokens").distinct()
    posts = found.select("tokens", F.explode("tokens").alias("post")).join(often.select(F.col("item").alias("post"), "n", "alike"), "post")
    posts = posts.groupBy("tokens").agg(F.min(F.struct("n", "post"))["post"].alias("post"), F.collect_list("alike").alias("needs"))
    posts = materialise(posts, "url-posts")

    # Over whole baskets: how many have all items of a rule, by label.
    hits = known.withColumn("post", F.explode("tokens")).join(posts.select(F.col("tokens").alias("of"), "post"), "post").where(F.size(F.array_except("of", "tokens")) == 0)
    each = hits.groupBy("of", "verdict").agg(F.count(F.lit(1)).alias("n")).groupBy("of").agg(F.sum("n").alias("all"), F.collect_list(F.struct("verdict", "n")).alias("by"))
    each = each.select(F.col("of").alias("tokens"), "all", F.explode("by").alias("b")).select("tokens", "all", "b.verdict", "b.n")
    labels = baskets.groupBy("verdict").agg(F.count(F.lit(1)).alias("of_label"))
    rules = each.join(F.broadcast(labels), "verdict").select("tokens", "verdict", (F.col("n") / F.col("all")).alias("confidence"), (F.col("n") / F.lit(rows)).alias("support"), (F.col("n") / F.col("all") / (F.col("of_label") / F.lit(rows))).alias("lift"))
    rules = rules.where((F.col("support") >= min_support) & (F.col("confidence") >= min_confidence))
    return materialise(rules.join(posts, "tokens"), "url-rules")


def apply_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """For each distinct url of `urls` (url, tokens) that a rule fits: url, method_verdict, method_rule."""
    posted = rules.withColumnRenamed("tokens", "rule").withColumn("token", F.explode(F.element_at(F.filter("needs", lambda alike: F.array_contains(alike, F.col("post"))), 1)))
    hits = urls.select("url", "tokens", F.explode("tokens").alias("token")).join(posted, "token")
    hits = hits.where(F.forall("needs", lambda alike: F.arrays_overlap(alike, "tokens")))
    best = F.max(F.struct("confidence", "support", "lift", (F.col("verdict") == "block").alias("blocks"), "rule", "verdict"))
    return hits.groupBy("url").agg(best.alias("best")).select("url", F.col("best.verdict").alias("method_verdict"), F.array_join("best.rule", " & ").alias("method_rule"))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, labelled: DataFrame | None = None, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict and method_rule of every row of `pages` (page_id, url).

    `labelled` (url, verdict) trains the method; by default the URLs that `rules` decide.
    """
    parsed = parse_urls(pages.select("page_id", "url")).withColumn("fixed", rule_of(F.col("host"), F.col("path"), rules))
    parsed = materialise(parsed.withColumn("tokens", tokens_of(F.col("url"), F.col("host"), F.col("path"))), "url-parsed")
    if labelled is None:
        train = parsed.where("fixed is not null").select("tokens", F.col("fixed.verdict").alias("verdict"))
    else:
        train = parse_urls(labelled.select("url", "verdict")).select(tokens_of(F.col("url"), F.col("host"), F.col("path")).alias("tokens"), "verdict")
    mined = mine_rules(train, min_support, min_confidence)
    open_urls = parsed.where("fixed is null and url is not null").groupBy("url").agg(F.first("tokens").alias("tokens"))
    found = parsed.join(apply_rules(open_urls, mined), "url", "left")
    verdict = F.coalesce(F.col("fixed.verdict"), F.col("method_verdict"), F.lit("allow"))
    return found.select("page_id", "host", "path", F.col("fixed.rule").alias("rule"), verdict.alias("verdict"), F.when(F.col("fixed").isNull(), F.col("method_rule")).alias("method_rule"))


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every url of `pages`."""
    return judge_urls(table(spark, sf_dir, "pages"))

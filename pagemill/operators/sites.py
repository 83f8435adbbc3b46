"""The site registry: manifest rows resolved by rules into sites with channels.

The rules are data, not code: `rules` has (tier, ord, key, url), tiers GOV, LOCAL, MINISTRY, LOCAL_SPECIFIC, COUNTY and
PROVINCE; `channels` has (name, channel, url, ord).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from .storage import placed

MANIFEST = "name string, category string, url string, raw_url string, sub_category string"
RULES = "tier string, ord int, key string, url string"
CHANNELS = "name string, channel string, url string, ord int"
# Fixed values.
NATIONAL_HUB, DEFAULT_HUB = "https://www.xinhuanet.com", "https://www.news.cn"
DEFAULT_CHANNEL = "综合"
COUNTY_NAME = "[一-龥]{2,6}(县|区|市)"
NEWS_CATEGORIES = ("中央新闻网站和重点理论网站", "中央新闻单位报刊网站", "部委群团报刊网站", "其他单位报刊网站", "地方新闻网站")
EXACT = (("GOV", "GOV_DIRECT", True), ("LOCAL", "LOCAL_PAPER_DIRECT", True), ("MINISTRY", "MINISTRY_DIRECT", False), ("LOCAL_SPECIFIC", "LOCAL_DIRECT", False), ("COUNTY", "COUNTY_GOV_DIRECT", False))

#: Characters of the substrings that the index of names holds.
GRAMS = (8, 3, 2, 1, 0)
FUZZY = ("MINISTRY", "LOCAL_SPECIFIC", "PROVINCE")
TIERS = (*dict.fromkeys([t for t, _, _ in EXACT] + list(FUZZY)),)


def _read_json(spark: SparkSession, path: str, schema: str, *extra: Column) -> DataFrame:
    """The rows of JSON files, arrays or a row a line; none if there is no file."""
    try:
        return spark.read.schema(schema).option("multiLine", True).json(path).select("*", *extra)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema).select("*", *[F.lit("").alias(f"__{i}") for i in range(len(extra))])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The rows of JSON arrays with their order `ord` from 1, by file and place in it; a missing file has none."""
    rows = _read_json(spark, path, MANIFEST, F.col("_metadata.file_path").alias("__0"), F.monotonically_increasing_id().alias("__1"))
    names = [c for c in rows.columns if not c.startswith("__")]
    return placed(rows, [], ["__0", "__1"], "ord").select(*names, "ord")


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of domain rules (tier, ord, key, url); ValueError if a row lacks one or names an unknown tier."""
    return _checked(_read_json(spark, path, RULES), F.col("tier").isin(*TIERS) & (F.col("key") != ""), "domain rules")


def read_channels(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of channel overrides (name, channel, url, ord); ValueError if a row lacks one."""
    return _checked(_read_json(spark, path, CHANNELS), F.col("channel") != "", "channels")


def _checked(rows: DataFrame, fine: Column, what: str) -> DataFrame:
    whole = fine
    for c in rows.columns:
        whole = whole & F.col(c).isNotNull()
    odd = rows.agg(F.count(F.when(~F.coalesce(whole, F.lit(False)), 1))).first()[0]
    if odd:
        raise ValueError(f"{odd} rows of the {what} lack a value or have an unknown one")
    return rows


def checked_manifest(manifest: DataFrame) -> DataFrame:
    """`manifest`, or ValueError if it is empty or a row lacks its name or category."""
    lacks = (F.coalesce("name", F.lit("")) == "") | (F.coalesce("category", F.lit("")) == "")
    n, odd = manifest.agg(F.count(F.lit(1)), F.count(F.when(lacks, 1))).first()
    if not n or odd:
        raise ValueError(f"{odd} of {n} manifest rows lack a name or a category" if n else "the manifest is empty")
    return manifest


def build_sites(manifest: DataFrame) -> DataFrame:
    """One row for each name: the last row's values at the first row's place. `manifest` has ord."""
    rest = [c for c in manifest.columns if c not in ("name", "ord")]
    out = manifest.groupBy("name").agg(F.min("ord").alias("first"), F.max(F.struct("ord", *rest)).alias("last"))
    return out.select("name", F.col("first").alias("ord"), *[F.col("last")[c].alias(c) for c in rest])


def width_of(part: Column) -> Column:
    """The largest of GRAMS that `part` is long enough for."""
    return F.coalesce(*[F.when(F.length(part) >= n, F.lit(n)) for n in GRAMS])


def grams(text: Column, width: Column) -> Column:
    """Hashes of the distinct substrings of `width` characters, at most the text's."""
    last = F.when(width > 0, F.length(text) - width + 1).otherwise(F.lit(1))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), last), lambda at: F.xxhash64(F.substring(text, at, width))))


def contained(texts: DataFrame, text: str, parts: DataFrame, part: str) -> DataFrame:
    """All pairs (text, part) of the distinct strings of two columns where the text contains the part.

    A q-gram index instead of a comparison of all pairs: each text is posted under its grams, of the widths that some part
    needs; a part is looked up by one gram of its own, of its width, the one that the fewest texts hold. What is found is
    verified. Spark sees nothing of what `explode` makes of a text and would send postings around, so joins are by merge.
    """
    texts = texts.select(F.col(text).alias("__text")).where("__text is not null").distinct()
    parts = parts.select(F.col(part).alias("__part")).where("__part is not null").distinct().withColumn("__width", width_of(F.col("__part")))
    wide = texts.select("__text", F.explode(F.array(*[F.lit(n) for n in GRAMS])).alias("__width")).where(F.length("__text") >= F.col("__width"))
    wide = wide.join(F.broadcast(parts.select("__width").distinct()), "__width", "left_semi")  # at most a row for each of GRAMS
    posted = wide.select("__text", F.explode(grams(F.col("__text"), F.col("__width"))).alias("__gram"))
    asked = parts.select("__part", F.explode(grams(F.col("__part"), F.col("__width"))).alias("__gram"))
    often = posted.groupBy("__gram").agg(F.count(F.lit(1)).alias("__n"))
    rarest = asked.join(often.hint("merge"), "__gram", "left").groupBy("__part").agg(F.min(F.struct(F.coalesce("__n", F.lit(0)).alias("n"), F.col("__gram").alias("gram"))).alias("m"))
    rarest = rarest.where("m.n > 0").select("__part", F.col("m.gram").alias("__gram"))  # a gram that no text holds ends the search
    found = posted.join(rarest.hint("merge"), "__gram").where(F.contains("__text", "__part"))
    return found.select(F.col("__text").alias(text), F.col("__part").alias(part))


def substring_hits(names: DataFrame, rules: DataFrame) -> DataFrame:
    """The `names` (clean, asked) with each rule of a tier that they ask for whose key they contain, or, for
    ministries, whose key contains them. Of the rules of a tier with one key only the first by `ord` is there."""
    rules = rules.groupBy("tier", "key").agg(F.min(F.struct("ord", "url")).alias("m")).select("tier", "m.ord", "key", "m.url")
    inside = contained(names, "clean", rules, "key")
    around = contained(rules.where("tier = 'MINISTRY'"), "key", names.where(F.array_contains("asked", "MINISTRY") & (F.col("clean") != "")), "clean").withColumn("only", F.lit("MINISTRY"))
    # An empty name stands in every key; of those only the first rule can win.
    first = rules.where("tier = 'MINISTRY'").groupBy().agg(F.min(F.struct("ord", "url", "key"))["key"].alias("key"))
    empty = first.select(F.lit("").alias("clean"), "key", F.lit("MINISTRY").alias("only")).where("key is not null")
    pairs = inside.withColumn("only", F.lit(None).cast("string")).unionByName(around).unionByName(empty)
    hits = pairs.join(names.hint("merge"), "clean").join(rules.hint("merge"), "key").where(F.array_contains("asked", F.col("tier")) & (F.col("only").isNull() | (F.col("only") == F.col("tier"))))
    return hits.select("clean", "tier", "ord", "url", "key")


def resolve(sites: DataFrame, rules: DataFrame) -> DataFrame:
    """`sites` (name, url, others) with home_url, source_type and is_fallback.

    Exact tiers are two equi-joins with one row for each key, by the clean name and by the name as it is. Only names that
    the exact tiers above leave open meet the rules of a fuzzy tier by substring, once for all tiers; the first rule
    by `ord` wins. Names and rules both grow, so they meet by merge and none goes through the driver.
    """
    rows = sites.withColumns({"clean": C.clean_name(F.col("name")), "given": C.first_filled(F.col("url"), F.col("raw_url")) if "raw_url" in sites.columns else F.col("url")})
    of = lambda tier: F.max_by("url", F.when(F.col("tier") == tier, F.col("ord")))
    keys = rules.where(F.col("tier").isin(*[t for t, _, _ in EXACT])).groupBy("key")
    clean_hits = keys.agg(F.struct(*[of(t).alias(t) for t, _, _ in EXACT]).alias("by_clean"))
    raw_hits = keys.agg(F.struct(*[of(t).alias(t) for t, _, both in EXACT if both]).alias("by_name"))
    rows = rows.join(clean_hits.withColumnRenamed("key", "clean").hint("merge"), "clean", "left").join(raw_hits.withColumnRenamed("key", "name").hint("merge"), "name", "left")
    exact = {t: F.coalesce(F.col(f"by_clean.{t}"), F.col(f"by_name.{t}")) if both else F.col(f"by_clean.{t}") for t, _, both in EXACT}

    valid = ~C.is_invalid_url(F.col("given"))
    unnamed = exact["GOV"].isNull() & exact["LOCAL"].isNull() & exact["MINISTRY"].isNull()
    specific = unnamed & exact["LOCAL_SPECIFIC"].isNull()
    asked = F.when(unnamed, F.array(F.lit("MINISTRY"), F.when(specific, "LOCAL_SPECIFIC"), F.when(specific & exact["COUNTY"].isNull() & ~valid, "PROVINCE")))
    open_names = rows.where(unnamed).groupBy("clean").agg(F.array_distinct(F.flatten(F.collect_set(asked))).alias("asked"))
    met = substring_hits(open_names, rules.where(F.col("tier").isin(*FUZZY)))
    met = met.groupBy("clean").agg(*[F.min(F.when(F.col("tier") == t, F.struct("ord", "url", "key"))).alias(f"f_{t}") for t in FUZZY])
    rows = rows.join(met.hint("merge"), "clean", "left")

    def hit(url: Column, kind: Column | str, fallback: bool = False) -> Column:
        return F.when(url.isNotNull(), F.struct(url.alias("url"), (kind if isinstance(kind, Column) else F.lit(kind)).alias("kind"), F.lit(fallback).alias("fallback")))

    kinds = {t: kind for t, kind, _ in EXACT}
    steps = [hit(exact[t], kinds[t]) for t in ("GOV", "LOCAL", "MINISTRY")]
    steps += [hit(F.col("f_MINISTRY.url"), "MINISTRY_FUZZY"), hit(exact["LOCAL_SPECIFIC"], kinds["LOCAL_SPECIFIC"]), hit(F.col("f_LOCAL_SPECIFIC.url"), "LOCAL_FUZZY")]
    steps += [hit(exact["COUNTY"], kinds["COUNTY"]), hit(F.when(valid, F.col("given")), "ORIGINAL_VALID")]
    steps += [hit(F.col("f_PROVINCE.url"), F.concat(F.lit("PROVINCIAL_HUB_"), F.col("f_PROVINCE.key")), True)]
    steps += [hit(F.when(F.col("clean").rlike(COUNTY_NAME), F.lit(NATIONAL_HUB)), "NATIONAL_HUB_FALLBACK", True), hit(F.lit(DEFAULT_HUB), "DEFAULT_FALLBACK", True)]
    rows = rows.withColumn("r", F.coalesce(*steps))
    keep = [c for c in sites.columns if c not in ("home_url", "source_type", "is_fallback")]
    return rows.select(*keep, F.col("r.url").alias("home_url"), F.col("r.kind").alias("source_type"), F.col("r.fallback").alias("is_fallback"))


def site_config(resolved: DataFrame) -> DataFrame:
    """url_pattern and encoding of each site."""
    return resolved.withColumns({"url_pattern": C.site_pattern(F.col("home_url")), "encoding": C.encoding_hint(F.col("home_url"))})


def site_channels(resolved: DataFrame, channels: DataFrame) -> DataFrame:
    """(name, channel, url, ch_ord); a site without channels of its own has one, its home."""
    own = resolved.select("name", "home_url").join(channels.select("name", "channel", F.col("url").alias("ch_url"), F.col("ord").alias("ch_ord")), "name", "left")
    return own.select("name", F.coalesce("channel", F.lit(DEFAULT_CHANNEL)).alias("channel"), F.coalesce("ch_url", "home_url").alias("url"), F.coalesce("ch_ord", F.lit(0)).alias("ch_ord"))


def by_category(sites: DataFrame, *categories: str) -> DataFrame:
    """F1"""
    return sites.where(F.col("category").isin(*categories))


def news_sites(sites: DataFrame) -> DataFrame:
    """F2"""
    return by_category(sites, *NEWS_CATEGORIES)


def by_name(sites: DataFrame, name: str) -> DataFrame:
    """the site of that name, else those whose names contain it. One plan, decided by one row of its own."""
    found = sites.where(F.contains(F.col("name"), F.lit(name))).withColumn("__one", F.lit(1))
    exact = found.groupBy("__one").agg(F.max(F.col("name") == name).alias("__exact"))
    return found.join(exact, "__one").where((F.col("name") == name) | ~F.col("__exact")).select(*sites.columns)


def category_counts(sites: DataFrame) -> DataFrame:
    """A2"""
    return sites.groupBy("category").agg(F.count(F.lit(1)).alias("n_sites"))


def categories(sites: DataFrame) -> DataFrame:
    """A1: each category once, in binary order; null is none."""
    return sites.where("category is not null").select("category").distinct().orderBy("category")


def site_listing(sites: DataFrame) -> DataFrame:
    """A3: a line `name (home_url)` for each site, and the size of its category. Sites without a category aren't listed."""
    named = sites.select("category", "name", F.concat("name", F.lit(" ("), F.coalesce("home_url", F.lit("")), F.lit(")")).alias("line"))
    return named.join(category_counts(sites), "category")

"""Records as open JSON to the canonical schema: what is there is typed by its value, not by a schema that hides it.

A line is read as a variant. A field of a wrong type is seen as such and rejects its record with a reason, as does a line
that is no JSON or no object. A line in which a key repeats counts as malformed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from .pages import FIELDS

#: The names under which a record may carry a field, and the column of `lines` that stands in for it.
NAMES = {
    "siteName": (("siteName", "site_name", "media_name"), "cfg_name"),
    "source": (("source",), None),
    "category": (("category", "media_category"), "cfg_category"),
    "subCategory": (("subCategory", "sub_category"), "cfg_sub_category"),
    "channel": (("channel",), "cfg_channel"),
    "publishTime": (("publishTime", "publish_time"), None),
    "crawledAt": (("crawledAt", "crawled_at", "crawl_time"), None),
    "docNumber": (("docNumber", "doc_number"), None),
    "indexNumber": (("indexNumber", "index_number"), None),
}
REQUIRED = ("url", "title", "content")


def _value(v: Column, name: str) -> Column:
    """(kind, text) of a member: kind is STRING, another type's name, or null where the member is missing or null."""
    member = F.try_variant_get(v, f"$.{name}", "variant")
    kind = F.nullif(F.schema_of_variant(member), F.lit("VOID"))
    return F.struct(kind.alias("kind"), F.when(kind == "STRING", F.try_variant_get(v, f"$.{name}", "string")).alias("text"))


def _first(values: list[Column]) -> Column:
    """The first that is there and, if a string, not blank."""
    there = F.filter(F.array(*values), lambda x: x["kind"].isNotNull() & ((x["kind"] != "STRING") | C.blank_to_null(x["text"]).isNotNull()))
    return F.try_element_at(there, F.lit(1))


def typed(lines: DataFrame, value: str = "value") -> DataFrame:
    """`lines` (a JSON text in `value`, others) with the 13 fields in `article`, or null and reject_reason.

    Reasons come in the order of the checks: malformed, not an object; a required field that is missing or no string, or
    blank; images that aren't strings; then any other field that is no string. Columns of NAMES, where `lines` has them,
    stand in for fields without a value.
    """
    v = F.try_parse_json(F.col(value))
    rows = lines.withColumn("__v", v)
    fields = {name: _value(F.col("__v"), name) for name in REQUIRED}
    for name, (members, column) in NAMES.items():
        values = [_value(F.col("__v"), m) for m in members]
        if column in lines.columns:
            values.append(F.struct(F.when(F.col(column).isNotNull(), "STRING").alias("kind"), F.col(column).alias("text")))
        fields[name] = _first(values)
    shape = F.schema_of_variant(F.try_variant_get(F.col("__v"), "$.images", "variant"))
    rows = rows.select("*", *[f.alias(f"__{name}") for name, f in fields.items()], F.nullif(shape, F.lit("VOID")).alias("__shape"))
    images = F.try_variant_get(F.col("__v"), "$.images", "array<string>")
    rows = rows.withColumn("__images", F.when(F.col("__shape").isNull(), F.array().cast("array<string>")).otherwise(images))

    reason = F.when(F.col("__v").isNull(), "malformed").when(~F.coalesce(F.schema_of_variant("__v").startswith("OBJECT"), F.lit(False)), "not an object")
    for name in REQUIRED:
        field = F.col(f"__{name}")
        reason = reason.when(~field["kind"].eqNullSafe(F.lit("STRING")), f"{name} is no string")
        if name != "content":
            reason = reason.when(C.blank_to_null(field["text"]).isNull(), f"blank {name}")
    strings = F.col("__shape").isNull() | F.col("__shape").isin("ARRAY<STRING>", "ARRAY<VOID>") & ~F.exists("__images", lambda x: x.isNull())
    reason = reason.when(~F.coalesce(strings, F.lit(False)), "images aren't strings")
    for name in NAMES:
        kind = F.col(f"__{name}")["kind"]
        reason = reason.when(kind.isNotNull() & (kind != "STRING"), f"{name} is no string")
    text = {name: F.col(f"__{name}")["text"] for name in fields}
    text |= {name: C.blank_to_null(text[name]) for name in NAMES} | {"images": F.col("__images")}
    rows = rows.withColumn("reject_reason", reason)
    article = F.when(F.col("reject_reason").isNull(), F.struct(*[text[f].alias(f) for f in FIELDS]))
    return rows.select(*lines.columns, article.alias("article"), "reject_reason")


def canonical_lines(lines: DataFrame, value: str = "value", strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(articles, rejected lines with reject_reason); `strict` ends the job with the reason of a line instead."""
    rows = typed(lines, value)
    if strict:
        rows = rows.withColumn("article", F.when(F.col("reject_reason").isNull(), F.col("article")).otherwise(F.raise_error(F.concat(F.lit("rejected: "), "reject_reason"))))
        return rows.select("article.*"), rows.where("reject_reason is not null").drop("article")
    return rows.where("reject_reason is null").select("article.*"), rows.where("reject_reason is not null").drop("article")

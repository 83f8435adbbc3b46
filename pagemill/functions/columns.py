"""URL and text rules of the page engine as native Columns. Patterns marked fixed values must stay as they are."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
ASSET_EXTENSIONS = (
    ".jpg", ".jpeg", ".png", ".gif", ".webp", ".svg", ".pdf", ".zip", ".rar", ".7z", ".tar", ".gz", ".mp4", ".mp3",
    ".avi", ".flv", ".mov", ".wmv", ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx", ".css", ".js", ".json", ".xml",
)
ARTICLE_URL = r"(?i)\d{4}[/\-_]\d{2}|\d{8}|content_\d+|t\d+_\d+|article|detail|news|node_\d+|/c\.|/c\d+-"
SITE_URL_TAIL = r"(\d{4}[/\-_]\d{2}|\d{8}|content_\d+|t\d+_\d+|article|/c\.|/c\d+-)"
DOC_NUMBER = r"(〔\d{4}〕\d+号|〔\d{4}〕第\d+号|\d{4}第\d+号|[国省市县发办]\d{4}\d+号)"
INDEX_LABEL = "索引号"
INDEX_VALUE = r"[0-9A-Za-z][0-9A-Za-z._/-]{3,}"
PUBLISH_TIME = r"\d{4}[年\-/]\d{1,2}[月\-/]\d{1,2}(\s+\d{1,2}:\d{2}(:\d{2})?)?"
SOURCE_LABEL = r"^(来源|稿源|出处|作者)[:：\s]*"
GBK_HOSTS = ("cnr.cn", "youth.cn")
PAGE_TYPES = ("", "text/html", "application/xhtml+xml", "text/plain")

SPACE = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def stripped(c: Column) -> Column:
    """Without white space at both ends, Unicode's included."""
    return F.regexp_replace(c, rf"^{SPACE}+|{SPACE}+\z", "")


def blank_to_null(c: Column) -> Column:
    """Null for null and blank strings; others untouched."""
    return F.when(stripped(c) != "", c)


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor blank."""
    return F.coalesce(*[blank_to_null(c) for c in columns])


def path_part(c: Column) -> Column:
    """P5: a name as one path segment."""
    return F.translate(c, "/", "_")


def clean_name(c: Column) -> Column:
    """Without line feeds and white space around it."""
    return stripped(F.replace(c, F.lit("\n"), F.lit("")))


def clean_url(u: Column) -> Column:
    """Cut at the first `?`, then at the first `#`."""
    return F.substring_index(F.substring_index(u, "?", 1), "#", 1)


def netloc(u: Column) -> Column:
    return F.regexp_extract(F.coalesce(u, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)


def host_base(u: Column) -> Column:
    """The network location without any `www.`."""
    return F.replace(netloc(u), F.lit("www."), F.lit(""))


def same_site(base: Column, u: Column, strict_host: bool = False) -> Column:
    """U4: the base's host occurs in the URL's; `strict_host`: it is that host or a parent domain of it."""
    host, other = host_base(base), netloc(u)
    inside = (F.replace(other, F.lit("www."), F.lit("")) == host) | other.endswith(F.concat(F.lit("."), host)) if strict_host else F.contains(other, host)
    return (host != "") & inside


def is_asset(u: Column) -> Column:
    """U5"""
    return F.lower(u).rlike("(" + "|".join(e.replace(".", r"\.") for e in ASSET_EXTENSIONS) + r")\z")


def looks_like_article(u: Column) -> Column:
    """U6"""
    return u.rlike(ARTICLE_URL)


def site_pattern(home: Column) -> Column:
    """The pattern for a site's article URLs; every non-word character of the host is escaped."""
    host = F.regexp_replace(host_base(home), r"([^A-Za-z0-9_])", r"\\$1")
    return F.when(host != "", F.concat(host, F.lit("/.*" + SITE_URL_TAIL))).otherwise(F.lit(".*" + SITE_URL_TAIL))


def page_suffix(u: Column, anchor: Column) -> Column:
    """U8"""
    return u.rlike(r"\.(html|htm|shtml)\z") & (F.length(stripped(anchor)) >= 6)


def is_invalid_url(u: Column) -> Column:
    """U9"""
    return F.coalesce(u, F.lit("")).rlike("[一-鿿]") | (F.coalesce(u, F.lit("")) == "") | ~F.contains(netloc(u), F.lit("."))


def encoding_hint(u: Column) -> Column:
    """U10"""
    return F.when(u.rlike("|".join(h.replace(".", r"\.") for h in GBK_HOSTS)), "gbk").otherwise("utf-8")


def is_page_type(content_type: Column) -> Column:
    """The media type, without parameters, is one of pages; null and empty count as such."""
    return F.lower(stripped(F.substring_index(F.coalesce(content_type, F.lit("")), ";", 1))).isin(*PAGE_TYPES)


def publish_time(c: Column) -> Column:
    """H5: the first date in a text, null if there is none."""
    found = F.regexp_extract(c, "(?U)(" + PUBLISH_TIME + ")", 1)
    return F.when(found != "", F.translate(found, "年月/", "---"))


def source_name(c: Column) -> Column:
    """H6: without its label; null if empty or of 40 characters or more."""
    found = F.regexp_replace(c, "(?U)" + SOURCE_LABEL, "")
    return F.when((found != "") & (F.length(found) < 40), found)


def doc_number(c: Column) -> Column:
    """H7"""
    found = F.regexp_extract(c, "(?U)" + DOC_NUMBER, 1)
    return F.when(found != "", found)


def index_number(c: Column) -> Column:
    """H8 within one text node."""
    flat = F.regexp_replace(c, SPACE, "")
    rest = F.regexp_extract(flat, f"{INDEX_LABEL}[:：]*(.*)", 1)
    found = F.regexp_extract(rest, f"^({INDEX_VALUE})", 1)
    return F.when(found != "", found)


def day_stamp(as_of: Column) -> Column:
    """The day of `as_of`, the publishing time of articles that show none."""
    return F.date_format(as_of, "yyyy-MM-dd")


def second_stamp(as_of: Column) -> Column:
    """`as_of` to the second, the time of reading."""
    return F.date_format(as_of, "yyyy-MM-dd HH:mm:ss")


def compact_json(*fields: Column | str) -> Column:
    """An object of `fields` in their order, without spaces; nulls are written, letters are not escaped."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})

"""Choosing what to ingest from stored web pages.

Links are pulled out of stored HTML, resolved against the page URL, kept if their host lies in a
domain, classified by ordered rules (first match wins) and deduplicated by full URL. All of it is
column expressions plus one aggregate for the dedupe; no fetching happens here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The link rules, in order; the first rule whose pattern is found in the URL decides.
# Rule 1 marks a document to ingest; rules 2-5 mark pages whose links are followed.
LINK_RULES = [
    (1, r"\.pdf", "document"),
    (2, r"(\/2\d2\d)\.(html)$", "follow"),
    (3, r"id\/eprint", "follow"),
    (4, r"\/thesis[^\/]*\/$", "follow"),
    (5, r"\/document_subtype/$", "follow"),
]
# Rules 2-5 do not follow URLs whose path ends in one of these extensions.
DENIED_EXTENSIONS = [
    "7z", "7zip", "bz2", "rar", "tar", "tar.gz", "xz", "zip",
    "mng", "pct", "bmp", "gif", "jpg", "jpeg", "png", "pst", "psp", "tif", "tiff", "ai", "drw", "dxf", "eps", "ps",
    "svg", "cdr", "ico", "webp",
    "mp3", "wma", "ogg", "wav", "ra", "aac", "mid", "au", "aiff",
    "3gp", "asf", "asx", "avi", "mov", "mp4", "mpg", "qt", "rm", "swf", "wmv", "m4a", "m4v", "flv", "webm",
    "xls", "xlsm", "xlsx", "xltm", "xltx", "potm", "potx", "ppt", "pptm", "pptx", "pps", "doc", "docb", "docm", "docx",
    "dotm", "dotx", "odt", "ods", "odg", "odp",
    "css", "pdf", "exe", "bin", "rss", "dmg", "iso", "apk", "jar", "sh", "rb", "js", "hta", "bat", "cpl", "msi", "msp",
    "py",
]
# How links are written. Only anchors and image-map areas are links; the value may be in
# double quotes, single quotes or none, in any letter case.
HREF_PATTERN = r"""(?i)<(?:a|area)(?:\s[^>]*?)?\shref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]
SCHEME_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*:"
WEB_PATTERN = r"(?i)^https?:"
ORIGIN_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*"
HOST_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
DIR_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/(?:[^?#]*/)?)"
PATH_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"
TAIL_PATTERN = r"(?s)^[^?#]*(.*)$"
DOTS_PATTERN = r"/\.\.?(?:/|$)"
DENIED_PATTERN = r"(?is)^[^?#]*\.(?:" + "|".join(e.replace(".", r"\.") for e in DENIED_EXTENSIONS) + r")(?:[?#].*)?$"


def href_value(raw: Column) -> Column:
    """The link as meant: without quotes, entities decoded, without its fragment."""
    quoted = F.substring(raw, 1, 1).isin('"', "'")
    value = F.when(quoted, F.expr("substring(raw, 2, length(raw) - 2)")).otherwise(raw)
    for entity, char in ENTITIES:
        value = F.replace(value, F.lit(entity), F.lit(char))
    return F.regexp_replace(F.trim(value), r"(?s)#.*$", "")


def resolve(href: Column, base: Column) -> Column:
    """Absolute URL of ``href`` found on page ``base``: absolute kept, ``//host`` gets the page's
    scheme, ``/path`` the page's origin, ``?query`` the page's path, anything else the page's directory."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    origin = F.regexp_extract(base, ORIGIN_PATTERN, 0)
    folder = F.regexp_extract(base, DIR_PATTERN, 1)
    return (F.when(href.rlike(SCHEME_PATTERN), href)
            .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
            .when(href.startswith("/"), F.concat(origin, href))
            .when(href.startswith("?"), F.concat(F.regexp_extract(base, r"^[^?#]*", 0), href))
            .otherwise(F.concat(origin, F.when(folder == "", F.lit("/")).otherwise(folder), href)))


def without_dots(url: Column) -> Column:
    """The URL with ``.`` and ``..`` segments of its path resolved."""
    path = F.regexp_extract(url, PATH_PATTERN, 1)
    parts = F.split(path, "/")
    walked = F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), F.lit(""), lambda acc, x: F.when(x == ".", acc).when(
        x == "..", F.regexp_replace(acc, r"/[^/]*$", "")).otherwise(F.concat(acc, F.lit("/"), x)))
    folder = F.element_at(parts, -1).isin(".", "..") | (walked == "")
    clean = F.concat(F.regexp_extract(url, ORIGIN_PATTERN, 0), walked, F.when(folder, F.lit("/")).otherwise(F.lit("")),
                     F.regexp_extract(url, TAIL_PATTERN, 1))
    return F.when(path.rlike(DOTS_PATTERN), clean).otherwise(url)


def extract_links(pages: DataFrame) -> DataFrame:
    """``(page_id, link_no, url)`` web links in page order. ``link_no`` is the 1-based number of the
    anchor on its page; anchors to a fragment or another scheme (mail, script) count but are no links."""
    raw = pages.select("page_id", F.col("url").alias("base"),
                       F.posexplode(F.regexp_extract_all("html", F.lit(HREF_PATTERN), F.lit(1))).alias("i", "raw"))
    hrefs = raw.select("page_id", "base", (F.col("i") + 1).cast("bigint").alias("link_no"),
                       href_value(F.col("raw")).alias("href"))
    web = hrefs.filter((F.col("href") != "") & (F.col("href").rlike(WEB_PATTERN) | ~F.col("href").rlike(SCHEME_PATTERN)))
    return web.select("page_id", "link_no", without_dots(resolve(F.col("href"), F.col("base"))).alias("url"))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, HOST_PATTERN, 1))


def in_domain(url: Column, domain: str) -> Column:
    """Host equals ``domain`` or is a subdomain of it."""
    h, d = host_of(url), domain.lower()
    return (h == F.lit(d)) | h.endswith("." + d)


def classify(url: Column) -> tuple[Column, Column]:
    """``(rule, class)``; rule 0 / class ``none`` when no rule matches. Only rule 1 takes URLs with a denied
    extension."""
    rule, cls = None, None
    for n, pat, c in LINK_RULES:
        m = url.rlike(pat) if n == 1 else url.rlike(pat) & ~url.rlike(DENIED_PATTERN)
        rule = F.when(m, F.lit(n)) if rule is None else rule.when(m, F.lit(n))
        cls = F.when(m, F.lit(c)) if cls is None else cls.when(m, F.lit(c))
    return rule.otherwise(F.lit(0)).cast("bigint"), cls.otherwise(F.lit("none"))


def dedupe_urls(links: DataFrame) -> DataFrame:
    """I4: one row per distinct URL, the first occurrence by (page_id, link_no)."""
    return (links.groupBy("url").agg(F.min(F.struct("page_id", "link_no")).alias("f"))
            .select("url", F.col("f.page_id").alias("page_id"), F.col("f.link_no").alias("link_no")))


def select_links(links: DataFrame, domain: str, limit: int) -> DataFrame:
    """I1-I5 chained: of the links in a domain that a rule takes, each URL once, the first ``limit`` in order of
    their first occurrence: ``(doc_id, url, class)`` with ``doc_id`` numbering them from 1. The result is at
    most ``limit`` rows, so numbering it is a window over that many."""
    rule, cls = classify(F.col("url"))
    taken = links.filter(in_domain(F.col("url"), domain) & (rule > 0))
    first = dedupe_urls(taken).orderBy("page_id", "link_no").limit(limit)
    return first.select(F.row_number().over(Window.orderBy("page_id", "link_no")).cast("bigint").alias("doc_id"),
                        "url", cls.alias("class"))


def file_name(doc_id: Column, url: Column) -> Column:
    """I8: ``{doc_id}_{last path segment}``."""
    return F.concat_ws("_", doc_id.cast("string"), F.element_at(F.split(url, "/"), -1))

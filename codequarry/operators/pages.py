"""Fields out of stored web pages and API responses."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.expr import as_col

# The named character references that occur in attribute values.
_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))

# Class names on a repository listing page.
_ITEM = r"""<div\b[^>]*\bclass\s*=\s*["'](?:[^"']*\s)?item(?:\s[^"']*)?["'][^>]*>"""
_TITLE_CLASSES = ("title", "project-namespace-path")


def unescape(c: Column) -> Column:
    for name, char in _ENTITIES:
        c = F.replace(c, F.lit(name), F.lit(char))
    return c


def tag(html, name: str, classes: tuple[str, ...]) -> Column:
    """First start tag ``name`` that has all the classes; '' when there is none."""
    word = "".join(
        rf"""(?=[^>]*\bclass\s*=\s*["'](?:[^"']*\s)?{c}(?:\s[^"']*)?["'])""" for c in classes
    )
    return F.regexp_extract(as_col(html), rf"<{name}\b{word}[^>]*>", 0)


def attribute(start_tag: Column, name: str) -> Column:
    """Attribute value of a start tag, stripped and unescaped; '' when absent."""
    value = F.regexp_extract(start_tag, rf"""\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)')""", 1)
    single = F.regexp_extract(start_tag, rf"""\s{name}\s*=\s*'([^']*)'""", 1)
    return text.strip(unescape(F.when(value != "", value).otherwise(single)))


def listing_items(pages: DataFrame, site: str = "https://gitee.com") -> DataFrame:
    """Repository rows of listing pages: full_name, url, stars, description, language.

    Items without a title link are skipped; a missing count is 0, a missing text ''.
    """
    # Everything before the first item marker is not an item.
    parts = F.split("html", _ITEM, -1)
    items = pages.select(
        *[c for c in pages.columns if c != "html"],
        F.posexplode(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))).alias("item", "html"),
    )
    heading = F.regexp_extract("html", r"<h3\b[^>]*>\s*(<a\b[^>]*>)", 1)
    link = tag(heading, "a", _TITLE_CLASSES)
    stars = attribute(tag("html", "div", ("stars-count",)), "data-count")
    return items.withColumn("link", link).where("link <> ''").select(
        *[c for c in items.columns if c != "html"],
        attribute(F.col("link"), "title").alias("full_name"),
        F.concat(F.lit(site), attribute(F.col("link"), "href")).alias("url"),
        F.coalesce(stars.try_cast("int"), F.lit(0)).alias("stars"),
        attribute(tag("html", "div", ("project-desc",)), "title").alias("description"),
        attribute(tag("html", "a", ("project-language",)), "title").alias("language"),
    )


def page_fields(pages: DataFrame) -> DataFrame:
    """Per page: title, language, first link and number of links."""
    links = F.regexp_extract_all("html", F.lit(r'<a\b[^>]*?\shref="([^"]*)"'), F.lit(1))
    return pages.select(
        "page_id",
        F.regexp_extract("html", r"<title>([^<]*)</title>", 1).alias("title"),
        F.regexp_extract("html", r'<html\b[^>]*\slang="([^"]*)"', 1).alias("lang"),
        F.coalesce(F.get(links, F.lit(0)), F.lit("")).alias("first_link"),
        F.size(links).cast("bigint").alias("links"),
    )


def repos_from_payload(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Repository search responses to (full_name, stargazers_count, language) rows."""
    schema = "items array<struct<full_name: string, stargazers_count: int, language: string>>"
    keys = [c for c in payloads.columns if c != column]
    return payloads.select(*keys, F.inline(F.from_json(column, schema)["items"]))


def license_from_payload(payload, source) -> Column:
    """Licence id of a repository response.

    github: ``license.spdx_id`` as it is. gitee: ``license``, else ``spdx``, in upper case.
    """
    payload, source = as_col(payload), as_col(source)

    def filled(path: str) -> Column:
        return F.nullif(F.get_json_object(payload, path), F.lit(""))

    gitee = F.upper(F.coalesce(filled("$.license"), filled("$.spdx")))
    return F.when(source == "github", filled("$.license.spdx_id")).otherwise(gitee)

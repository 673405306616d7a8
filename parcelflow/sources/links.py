"""Links of web pages held in a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text a browser does not render as markup: comments, scripts, styles.
_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>"
# The target of an anchor, with its quotes if it has any.
_ANCHOR = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
_QUOTED = r"""(?s)^(["'])(.*)\1$"""


def key_of_link(href: Column) -> Column:
    """Text between the last ``-`` of a link and the next ``.``"""
    return F.substring_index(F.substring_index(href, "-", -1), ".", 1)


def extract_links(
    pages: DataFrame,
    contains: str = "valeursfoncieres",
    suffix: str = ".zip",
    key: Column | None = None,
    page: str = "page_id",
    html: str = "html",
) -> DataFrame:
    """Targets of ``<a href>`` that contain a marker and end in a suffix.

    One row per link, with its page, its position in the page and its key.
    """
    markup = F.regexp_replace(F.col(html), _HIDDEN, "")
    hrefs = F.regexp_extract_all(markup, F.lit(_ANCHOR), F.lit(1))
    bare = F.regexp_replace("href", _QUOTED, "$2")
    links = pages.select(page, F.posexplode(hrefs).alias("position", "href")).withColumn(
        "href", F.replace(bare, F.lit("&amp;"), F.lit("&"))
    )
    wanted = links.where(F.col("href").contains(contains) & F.col("href").endswith(suffix))
    return wanted.withColumn("link_key", key_of_link(F.col("href")) if key is None else key)


def latest_per_key(links: DataFrame, page: str = "page_id") -> DataFrame:
    """The last link of every key, in page order then position."""
    place = F.struct(page, "position")
    return links.groupBy("link_key").agg(F.max_by("href", place).alias("href"))

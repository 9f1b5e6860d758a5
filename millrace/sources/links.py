"""From web pages to the files that are still to be landed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.links import hrefs, last_part, stem


def page_links(pages: DataFrame, key: str = "page_id", html: str = "html", marker: str = "") -> DataFrame:
    """One row per kept link: page key, target, file name and stem; repeats stay."""
    links = pages.select(key, F.explode(hrefs(F.col(html))).alias("href"))
    if marker:
        links = links.where(F.col("href").contains(marker))
    name = last_part(F.col("href"))
    return links.select(key, "href", name.alias("file_name"), stem(name).alias("file_stem"))


def not_landed(candidates: DataFrame, landed: DataFrame, on: str | list[str] = "file_name") -> DataFrame:
    """Candidates whose name (or URL) is not in the landing zone yet."""
    return candidates.join(landed, on, "left_anti")

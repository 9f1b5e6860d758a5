"""Links in raw web pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# An `<a>` tag's target, quoted either way or bare.
HREF_PATTERN = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*["']?([^"'\s>]*)"""


def hrefs(html: Column) -> Column:
    """Targets of all `<a>` tags, in page order, repeats kept."""
    return F.regexp_extract_all(html, F.lit(HREF_PATTERN), F.lit(1))


def last_part(url: Column) -> Column:
    """Text after the last slash of a path or URL."""
    return F.substring_index(url, "/", -1)


def stem(name: Column) -> Column:
    """File name up to its first dot."""
    return F.substring_index(name, ".", 1)

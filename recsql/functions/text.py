"""String functions: title parsing, normalisation, tokenising, genre lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour:
# trailing articles moved to the front by the title normaliser.
TRAILING_ARTICLES = "The|A|An|La|Le|Les|Il|El"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def release_year(title) -> Column:
    """First unanchored ``(dddd)`` in the title, else null."""
    y = F.nullif(F.regexp_extract(_c(title), r"\((\d{4})\)", 1), F.lit(""))
    return y.try_cast("int")


def year_suffix(title) -> Column:
    """end-anchored ``(dddd)`` year, else null."""
    y = F.nullif(F.regexp_extract(_c(title), r"\((\d{4})\)\s*$", 1), F.lit(""))
    return y.try_cast("int")


def split_title(title) -> tuple[Column, Column]:
    """``Name (YYYY)`` -> (name, year); titles without a year keep the whole text."""
    t = _c(title)
    m = t.rlike(r"^(.*)\s*\((\d{4})\)$")
    name = F.when(m, F.trim(F.regexp_extract(t, r"^(.*)\s*\((\d{4})\)$", 1))).otherwise(t)
    year = F.when(m, F.regexp_extract(t, r"^(.*)\s*\((\d{4})\)$", 2).try_cast("int"))
    return name, year


def norm_title(title) -> Column:
    """drop the year suffix, move a trailing article to the front,
    lower-case, non-alphanumerics to one space, trim."""
    t = F.trim(F.regexp_replace(_c(title), r"\s*\(\d{4}\)\s*$", ""))
    t = F.regexp_replace(t, rf"(?i)^(.*),\s*({TRAILING_ARTICLES})$", "$2 $1")
    return F.trim(F.regexp_replace(F.lower(t), r"[^a-z0-9]+", " "))


def tokens(text) -> Column:
    """lower-case alphanumeric runs, in order, duplicates kept."""
    return F.regexp_extract_all(F.lower(F.coalesce(_c(text), F.lit(""))), F.lit(r"[a-z0-9]+"), F.lit(0))


def genre_list(text, sep: str = "|") -> Column:
    """split on a literal separator, trim, drop empty entries (null -> [])."""
    import re
    parts = F.split(F.coalesce(_c(text), F.lit("")), re.escape(sep))
    return F.filter(F.transform(parts, lambda g: F.trim(g)), lambda g: g != "")


def genre_set_raw(text, sep: str = "|") -> Column:
    """Untrimmed split used by the diversity metric: the empty string is a genre."""
    import re
    return F.array_distinct(F.split(F.coalesce(_c(text), F.lit("")), re.escape(sep)))


def runtime_int(text) -> Column:
    """digits only -> int, anything else -> null."""
    t = _c(text)
    return F.when(t.rlike(r"^[0-9]+$"), t.try_cast("int"))


def fuse_genres(primary, secondary) -> Column:
    """Sorted union of ``|``- and ``,``-separated genre lists joined by ``|``;
    an empty union keeps the original string."""
    fused = F.array_sort(F.array_union(genre_list(primary, "|"), genre_list(secondary, ",")))
    return F.when(F.size(fused) > 0, F.array_join(fused, "|")).otherwise(F.coalesce(_c(primary), F.lit("")))

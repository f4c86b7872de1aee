"""String functions of the source lists as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartloom.functions.mercator import col

#: A date in a path, as MM-DD-YYYY between slashes.
DATED = r"^(.*?/[0-9]{2}-[0-9]{2}-[0-9]{4})(/.*)$"


def url_prefix(url) -> Column:
    """Everything up to the first date, with it; null without a date."""
    found = F.regexp_extract(col(url), DATED, 1)
    return F.when(found != "", found)


def url_suffix(url) -> Column:
    """Everything after the first date; null without a date."""
    found = F.regexp_extract(col(url), DATED, 2)
    return F.when(found != "", found)


def url_basename(url) -> Column:
    return F.substring_index(col(url), "/", -1)


def http_date(ts) -> Column:
    """A UTC timestamp as HTTP writes it."""
    return F.date_format(col(ts), "EEE, dd MMM yyyy HH:mm:ss 'GMT'")


def text_matches(text, target: str) -> Column:
    """Equal but for case and white space around."""
    return F.lower(F.trim(col(text))) == target.lower()


def name_list(names) -> Column:
    """Trimmed, non-empty names of a comma list."""
    return F.filter(F.transform(F.split(col(names), ","), lambda x: F.trim(x)), lambda x: x != "")


def staged_name(name) -> Column:
    return F.concat(F.lit("_"), col(name), F.lit(".tif"))


#: File ending by format.
ENDINGS = {"png": "png", "jpeg": "jpg", "webp": "webp"}


def tile_path(tileset, z, x, y, fmt: str = "png", root: str | None = None) -> Column:
    if fmt not in ENDINGS:
        raise ValueError(f"unknown tile format {fmt!r}; choose from {', '.join(ENDINGS)}")
    last = F.concat(col(y).cast("string"), F.lit("." + ENDINGS[fmt]))
    parts = [col(tileset), col(z).cast("string"), col(x).cast("string"), last]
    return F.concat_ws("/", *([F.lit(root)] if root else []), *parts)

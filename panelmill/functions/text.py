"""Text columns and small text settings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_GROUP = "Unknown"


def clean_group(col: Column) -> Column:
    """Group label that is safe as a partition value: never null, no spaces."""
    return F.regexp_replace(F.coalesce(col, F.lit(UNKNOWN_GROUP)), " ", "_")


def last_segment(path: Column) -> Column:
    """File name: what follows the last slash."""
    return F.element_at(F.split(path, "/"), -1)


def decode_key(key: Column) -> Column:
    """Undo URL encoding of an object key that arrives as data (plus means space)."""
    return F.url_decode(key)


def parse_names(text: str) -> list[str]:
    """A comma-separated setting as a list of trimmed names."""
    return [name.strip() for name in text.split(",") if name.strip()]

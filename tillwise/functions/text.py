"""Title and key clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_code_prefix(title: Column, only_if_prefixed: bool = False) -> Column:
    """``'397 - SWEETS'`` -> ``'SWEETS'``.

    Everything up to one character past the first dash goes. A title without a
    dash therefore loses its first character, unless ``only_if_prefixed``.
    """
    dash = F.locate("-", title)
    tail = F.substr(title, dash + F.lit(2))
    if only_if_prefixed:
        return F.when(dash > 0, tail).otherwise(title)
    return tail


def sanitize_key(name: Column) -> Column:
    """Letters, digits and white space only: safe as part of a file name."""
    return F.regexp_replace(name, r"[^A-Za-z0-9\s]", "")


def safe_file_name(name: Column) -> Column:
    """Replace the characters file systems refuse by an underscore."""
    return F.regexp_replace(name, r'[\\/:*?"<>|]', "_")

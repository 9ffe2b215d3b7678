"""Small shared column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Python ``str.strip()``: removes Unicode whitespace on both ends (``trim`` only
    removes spaces)."""
    return F.regexp_replace(col_of(c), r"(?U)^\s+|\s+$", "")

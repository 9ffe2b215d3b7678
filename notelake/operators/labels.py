"""Label-set operators: R5, U3, U4 (see routing.labels_meet), U5, L8."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notelake.functions.common import col_of, strip_ws


def parse_labels(raw) -> Column:
    """Comma-separated header text to a label set (split, strip, distinct);
    empty or null text is the empty set."""
    s = col_of(raw)
    parts = F.transform(F.split(s, ","), lambda x: strip_ws(x))
    return F.when(F.coalesce(s, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.array_distinct(parts))


def display_labels(labels, hidden: Sequence[str]) -> Column:
    """U3 + L8: labels minus the hidden ones, sorted."""
    return F.array_sort(F.array_except(col_of(labels), F.array(*[F.lit(h) for h in hidden])))


def union_labels(df: DataFrame, key: Sequence[str], labels: str = "labels", out: str = "labels") -> DataFrame:
    """Union of label sets per key. Explode + distinct first, so the collected
    set per key is bounded by the number of distinct labels, not by the rows."""
    e = df.select(*key, F.explode(labels).alias("_l")).distinct()
    return e.groupBy(*key).agg(F.array_sort(F.collect_set("_l")).alias(out))

"""Order-dependent operators over key groups of any size (W1's positions, W3, W5's
``lag``, W6, W8).

Rows are range-partitioned on ``(keys, order)``, so a group that holds most of the rows
is spread over many partitions, and written once with the number of their partition
(``_range``). From then on the range is a stored value of the row: nothing depends on how
often Spark evaluates the sampling or the exchange. A result inside a group is that inside
the (range, key) slice plus what the slices before it hand on; at most one key crosses
each range border, so what is handed on is a table of at most one row per range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notelake.session import materialise


def _cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def place(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
          num_partitions: int | None = None) -> DataFrame:
    """``df`` with ``_range``, the number of its range of ``(keys, order)``, as a table in the
    shared folder."""
    cols = [*[F.col(k) for k in keys], *_cols(order)]
    spread = df.repartitionByRange(num_partitions, *cols) if num_partitions else df.repartitionByRange(*cols)
    return materialise(spread.withColumn("_range", F.spark_partition_id()), "ranges")


def _handed_on(placed: DataFrame, keys: Sequence[str], slice_value: Column, name: str, fold) -> DataFrame:
    """Per slice, ``fold`` over the values of the slices of the same key before it; only
    slices that have one before them (at most one per range)."""
    slices = placed.groupBy("_range", *keys).agg(slice_value.alias("_v"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    got = slices.withColumn(name, fold(F.col("_v"), before)).drop("_v")
    return got.select(F.col("_range").alias("_h_range"), *[F.col(k).alias(f"_h_{k}") for k in keys], name).filter(F.col(name).isNotNull())


def _join_handed(placed: DataFrame, handed: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = F.col("_range") == F.col("_h_range")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_h_{k}"))
    return placed.join(handed, cond, "left").drop("_h_range", *[f"_h_{k}" for k in keys])


def ordinal_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                   out: str = "ordinal", num_partitions: int | None = None) -> DataFrame:
    """Add ``out``: 0-based position of each row inside its ``keys`` group by ``order``.

    ``order`` must be unique inside a group (add a tiebreaker) for a deterministic
    result. Null keys form one group; with no keys all rows are one group.
    """
    placed = place(df, keys, order, num_partitions)
    handed = _handed_on(placed, keys, F.count(F.lit(1)), "_off", lambda v, w: F.sum(v).over(w))
    inside = Window.partitionBy("_range", *keys).orderBy(*_cols(order))
    return _join_handed(placed, handed, keys) \
        .withColumn(out, F.row_number().over(inside) - 1 + F.coalesce("_off", F.lit(0))).select(*df.columns, out)


def sorted_by(df: DataFrame, order: Sequence[Column | str], position: str | None = None) -> DataFrame:
    """``df`` sorted, or with ``position`` (a column name) unsorted with each row's 0-based place in
    that order, which must be unique then."""
    return df.orderBy(*_cols(order)) if position is None else ordinal_within(df, [], order, out=position)


def last_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], value: Column, out: str,
                include_self: bool = True) -> DataFrame:
    """Add ``out``: the last non-null ``value`` at or (``include_self=False``) before each row
    of its ``keys`` group by ``order``."""
    placed = place(df.withColumn("_value", value), keys, order)
    place_in = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(_cols(order))])
    handed = _handed_on(placed, keys, F.max_by("_value", F.when(F.col("_value").isNotNull(), place_in)), "_carry",
                        lambda v, w: F.last(v, ignorenulls=True).over(w))
    inside = Window.partitionBy("_range", *keys).orderBy(*_cols(order)) \
        .rowsBetween(Window.unboundedPreceding, 0 if include_self else -1)
    return _join_handed(placed, handed, keys) \
        .withColumn(out, F.coalesce(F.last("_value", ignorenulls=True).over(inside), "_carry")) \
        .select(*[c for c in df.columns if c != out], out)


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], value: Column, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` up to and with each row of its ``keys`` group by
    ``order`` (unique in it)."""
    placed = place(df.withColumn("_value", value), keys, order)
    handed = _handed_on(placed, keys, F.sum("_value"), "_off", lambda v, w: F.sum(v).over(w))
    inside = Window.partitionBy("_range", *keys).orderBy(*_cols(order)).rowsBetween(Window.unboundedPreceding, 0)
    return _join_handed(placed, handed, keys) \
        .withColumn(out, F.sum("_value").over(inside) + F.coalesce("_off", F.lit(0))).select(*df.columns, out)

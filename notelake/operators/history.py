"""J4, J5, J13, J14 against a history that grows: a table bucketed by its key.

The history is written once in buckets of the key, sorted in each; a probe by that key shuffles
the new rows to the buckets and reads the history where it lies, so a run costs the new rows and
one scan. New keys are added as more files of the same buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_history(keys: DataFrame, table: str, key: Sequence[str], buckets: int, path: str | None = None) -> None:
    """Add rows to the table ``table`` (made if it is not there, below ``path`` if given), in ``buckets``
    by ``key``; a table that is there must have been made with the same ones."""
    w = keys.repartition(buckets, *key).write.mode("append").bucketBy(buckets, *key).sortBy(*key).format("parquet")
    (w.option("path", path) if path else w).saveAsTable(table)


def known(new: DataFrame, table: str, key: Sequence[str], out: str = "known") -> DataFrame:
    """``new`` with a flag: whether the history holds the row's key (null keys are never known)."""
    had = history(new.sparkSession, table).groupBy(*key).agg(F.lit(True).alias(out))
    return new.join(had.hint("merge"), list(key), "left").withColumn(out, F.coalesce(out, F.lit(False)))


def unknown(new: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """The rows of ``new`` whose key the history does not hold."""
    return new.join(history(new.sparkSession, table).select(*key).hint("merge"), list(key), "left_anti")


def history(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)

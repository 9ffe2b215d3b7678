"""Helpers shared by the operators of this package: input columns and range buckets. Tables
written once come from ``notelake.session``."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read by its path with Spark's own reader."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def full_text(text_col: str) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(text_col), F.lit(""))


LEAST = -(1 << 63)      # stands for a null id in the order of ranges


def split_points(df: DataFrame, id_col: str, buckets: int) -> list[tuple[int, int]]:
    """Ascending (id, tie) points that cut the order of (id, tie) into ranges of about as many rows
    each; ``tie`` is a uniform 64-bit hash. They are the quantiles of the ids over all rows (only the
    id is read); an id that holds several quantiles, null included, is cut into as many ranges by
    its ties. The list is a bounded driver-side value."""
    if buckets < 2:
        return []
    got = df.select(F.percentile_approx(F.coalesce(F.col(id_col), F.lit(LEAST)), [i / buckets for i in range(1, buckets)],
                                        max(10_000, 4 * buckets))).first()[0]
    points = set()
    for value, times in Counter(got or []).items():
        points |= {(value, LEAST + (j << 64) // times) for j in range(times)}
        if times > 1 and value < -LEAST - 1:
            points.add((value + 1, LEAST))
    return sorted(points)


def range_of(id_: Column, tie: Column, points: Sequence[tuple[int, int]]) -> Column:
    """Number of ``points`` that are not after (id, tie): a binary search over literal arrays,
    hence a pure function of the row that stays the same when a task runs again."""
    if not points:
        return F.lit(0)
    key, ids, ties = F.coalesce(id_, F.lit(LEAST)), F.lit([p[0] for p in points]), F.lit([p[1] for p in points])
    middle = lambda s: F.shiftright(s["lo"] + s["hi"], 1)
    reached = lambda s: (F.get(ids, middle(s)) < key) | ((F.get(ids, middle(s)) == key) & (F.get(ties, middle(s)) <= tie))
    found = F.aggregate(
        F.sequence(F.lit(1), F.lit(max(1, len(points).bit_length()))),
        F.struct(F.lit(0).alias("lo"), F.lit(len(points)).alias("hi")),
        lambda s, _: F.when(s["lo"] >= s["hi"], s).when(
            reached(s), F.struct((middle(s) + 1).alias("lo"), s["hi"].alias("hi")),
        ).otherwise(F.struct(s["lo"].alias("lo"), middle(s).alias("hi"))),
        lambda s: s["lo"])
    return found

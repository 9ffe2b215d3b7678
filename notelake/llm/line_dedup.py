"""Line dedup by overlapping three-line windows (DataFrame functions only).

Every run of three consecutive lines of a document is a window, known by two independent
64-bit hashes of its lines. Windows that occur again anywhere in the corpus are found by
one aggregation (first occurrence by ``min``, combined map-side, so a passage found in a
third of the documents arrives as one row per task). Each later occurrence covers its three
lines; the covered positions of a document are merged into runs and cut out.

The first occurrence is the one with the smallest (id, text hash, position). Lines it holds
itself are never covered by a later occurrence of the same window that overlaps it in the
same document: of a line repeated five times, three stay.

Defined cases: null text stays null and has no lines; empty text has one empty line;
documents of fewer than three lines are left alone; windows of three empty lines are not
counted; rows that repeat id and text are treated alike (both keep what either keeps); a
null id counts as smaller than any other; an empty table gives an empty result; other
columns are carried through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notelake.session import materialise

WINDOW = 3


def _windows(h: Column) -> Column:
    """The windows of an array of line hashes, in order of position."""
    n = F.greatest(F.size(h) - (WINDOW - 1), F.lit(0))
    return F.arrays_zip(*[F.slice(h, F.lit(i), n).alias(f"l{i}") for i in range(1, WINDOW + 1)])


def _occurrences(packed: DataFrame) -> DataFrame:
    """One row per window: its two hashes, document and position."""
    lines = packed.filter(F.col("text").isNotNull()).select("id", "tie", F.split("text", "\n", -1).alias("lines")) \
        .filter(F.size("lines") >= WINDOW)
    hashed = lines.select("id", "tie", F.transform("lines", lambda x: F.struct(
        F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"), (x == "").alias("blank"))).alias("h"))
    w = hashed.select("id", "tie", F.posexplode(_windows(F.col("h"))).alias("pos", "w")) \
        .filter(~(F.col("w.l1.blank") & F.col("w.l2.blank") & F.col("w.l3.blank")))
    return w.select("id", "tie", "pos",
                    F.xxhash64("w.l1.a", "w.l2.a", "w.l3.a").alias("a"),
                    F.xxhash64("w.l1.b", "w.l2.b", "w.l3.b").alias("b"))


def _covered(packed: DataFrame) -> DataFrame:
    """Per document, the line positions that later occurrences of windows cover."""
    occ = _occurrences(packed)
    repeated = materialise(
        occ.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"),
                                  F.min(F.struct("id", "tie", "pos")).alias("first")).filter("n > 1").drop("n"),
        "line-windows")
    same_doc = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("tie") == F.col("first.tie"))
    later = occ.join(repeated.hint("merge"), ["a", "b"]).filter(~(same_doc & (F.col("pos") == F.col("first.pos"))))
    start = F.when(same_doc, F.greatest(F.col("pos"), F.col("first.pos") + WINDOW)).otherwise(F.col("pos"))
    return later.select("id", "tie", F.struct(start.alias("s"), (F.col("pos") + WINDOW - 1).alias("e")).alias("span")) \
        .groupBy(F.col("id").alias("c_id"), F.col("tie").alias("c_tie")) \
        .agg(F.array_sort(F.array_distinct(F.flatten(F.transform(
            F.collect_set("span"), lambda x: F.sequence(x["s"], x["e"]))))).alias("cov"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` (the input row as a struct), ``new_text``, ``n_lines``, ``n_removed``."""
    packed = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                         F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tie"))
    cov = _covered(packed.drop("row"))
    split = packed.join(cov.hint("merge"), F.col("id").eqNullSafe(F.col("c_id")) & (F.col("tie") == F.col("c_tie")), "left") \
        .select("row", "text", "cov", F.split("text", "\n", -1).alias("lines"))
    n = F.size("lines")
    # a run of covered positions starts where the one before is missing and ends likewise
    before = F.concat(F.array(F.lit(-2)), F.slice("cov", 1, F.size("cov") - 1))
    after = F.concat(F.slice("cov", 2, F.size("cov")), F.array(n + 1))
    runs = split.select(
        "row", "text", "cov", "lines", n.alias("n"),
        F.array_compact(F.zip_with("cov", before, lambda x, p: F.when(x > p + 1, x))).alias("starts"),
        F.array_compact(F.zip_with("cov", after, lambda x, q: F.when(q > x + 1, x + 1))).alias("ends"))
    kept = runs.withColumn("keep", F.zip_with(
        F.concat(F.array(F.lit(0)), F.col("ends")), F.concat(F.col("starts"), F.array(F.col("n"))),
        lambda s, e: F.struct(s.alias("s"), e.alias("e"))))
    return kept.select(
        "row",
        F.when(F.col("cov").isNull(), F.col("text")).otherwise(F.array_join(F.flatten(F.transform(
            "keep", lambda k: F.slice(F.col("lines"), k["s"] + 1, k["e"] - k["s"]))), "\n")).alias("new_text"),
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.col("n")).cast("long").alias("n_lines"),
        F.coalesce(F.size("cov"), F.lit(0)).cast("long").alias("n_removed"))

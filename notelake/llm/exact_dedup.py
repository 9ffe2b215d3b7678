"""Exact dedup by distributed MSD radix partitioning.

Each round takes the next run of UTF-8 bytes of every document that is still open (the
radix digit; runs grow by ``growth``) and splits each group by (digit, ended). A group is
settled when it has one document, or when its texts ended in this digit: all bytes were
then compared and are equal. No digest decides equality. A group that goes on is known by a
number of its row in the written table of the round's groups, so no two groups share one,
whatever their ids.

A round is one aggregation (``count``/``max``/``min``, combined map-side, so a group that
holds a third of the rows arrives as one row per task) and one join of the open rows with
the repeated digits only; both join sides are plain shuffles (a merge join at every size: the
number of repeated digits has no bound), so AQE splits a hot digit.
Only the rest of the open texts is carried on, as a table in the shared folder.

Defined cases: null text counts as empty; a null id is smaller than any id; an empty table
gives an empty result; rows that repeat both text and id carry the same marks (each has
``kept`` true if that id is the largest of its group); other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notelake.llm.common import full_text
from notelake.session import materialise


def mark_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          first_digit: int = 64, growth: int = 4) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``keep_id`` is the largest id among the equal texts. ``first_digit`` is the width in
    bytes of the first digit; later ones are ``growth`` times as wide as the one before.
    """
    state = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), full_text(text_col).alias("_t"),
    ).select("doc_id", F.sha2("_t", 256).alias("text_sha256"), F.lit(0).cast("bigint").alias("path"),
             F.col("_t").cast("binary").alias("rest"))
    width, settled = first_digit, []
    while True:
        state = state.withColumns({"ended": F.octet_length("rest") <= width,
                                   "digit": F.substring("rest", 1, width)})
        repeated = materialise(
            state.groupBy("path", "ended", "digit").agg(
                F.count(F.lit(1)).alias("size"), F.max("doc_id").alias("keep_id"),
            ).filter("size > 1").withColumn("next", F.monotonically_increasing_id()), "radix-groups")
        done = F.col("ended") | F.col("size").isNull()
        round_ = materialise(
            state.join(repeated.hint("merge"), ["path", "ended", "digit"], "left").select(
                "doc_id", "text_sha256", done.alias("done"),
                F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                F.coalesce("size", F.lit(1).cast("bigint")).alias("group_size"),
                F.when(~done, F.col("next")).alias("path"),
                F.when(~done, F.expr(f"substring(rest, {width + 1})")).alias("rest")), "radix-round")
        settled.append(round_.filter("done").select("doc_id", "keep_id", "group_size", "text_sha256"))
        state = round_.filter("NOT done").select("doc_id", "text_sha256", "path", "rest")
        if state.isEmpty():
            break
        width *= growth
    out = settled[0]
    for more in settled[1:]:
        out = out.unionAll(more)
    return out.select("doc_id", "keep_id", "group_size",
                      F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) without the rows whose equal text has a larger id elsewhere.
    The join is on the id, so ids must be unique; rows with a null id are dropped where a
    copy with an id exists or, of several such copies, not at all."""
    gone = mark_exact_duplicates(docs, id_col, text_col).filter("NOT kept").select(
        F.col("doc_id").alias("gone_id"), F.col("text_sha256").alias("gone_sha"))
    packed = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("bigint").alias("k"),
                         F.sha2(full_text(text_col), 256).alias("s"))
    return packed.join(gone, F.col("k").eqNullSafe(F.col("gone_id")) & (F.col("s") == F.col("gone_sha")),
                       "left_anti").select("row.*")

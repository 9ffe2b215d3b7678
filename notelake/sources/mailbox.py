"""The mailbox scan, split in parallel.

Mailbox files are cut at every line that starts with ``From `` by Spark's own text reader, so
one huge file is read by many tasks. A piece begins a message only if its first line is a real
separator; the running count of those (W6, over ranges of pieces) numbers the messages, and
the pieces of a message are put together again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notelake.operators.sequence import running_sum
from notelake.session import materialise

# The separator line of a message, after a trailing carriage return is dropped.
SEPARATOR = r"(?d)\AFrom \S+.*\d{4}\s*\z"


def read_mailbox(spark: SparkSession, path: str, max_bytes: int | None = None) -> DataFrame:
    """``file, seq, content BINARY, length`` of each message. What stands before the first
    separator is dropped, the separator line is no part of the content, messages without a
    line are not emitted. ``length`` counts each line and its end. With ``max_bytes`` longer
    messages come without content (null), so a caller can count them."""
    pieces = spark.read.option("lineSep", "\nFrom ").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.decode(F.col("value").cast("binary"), "ISO-8859-1").alias("piece"))
    pieces = materialise(pieces, "mailbox-pieces")     # one byte a character; numbered once
    start = pieces.groupBy("file").agg(F.min(F.struct("block", "at")).alias("first"), F.max(F.struct("block", "at")).alias("last"))
    p = pieces.join(start, "file")
    here = F.struct("block", "at")
    whole = F.when(here == F.col("first"), F.col("piece")).otherwise(F.concat(F.lit("From "), "piece"))
    whole = F.when(here == F.col("last"), F.regexp_replace(whole, r"\n\z", "")).otherwise(whole)
    lines = p.select("file", "block", "at", whole.alias("text"))
    head = F.regexp_replace(F.substring_index("text", "\n", 1), r"\r+\z", "")
    marked = lines.select("*", head.rlike(SEPARATOR).alias("starts"))
    numbered = running_sum(marked, ["file"], ["block", "at"], F.col("starts").cast("long"), "seq").filter("seq > 0")
    body = F.when(~F.col("starts"), F.col("text")).when(F.col("text").contains("\n"), F.substring(
        "text", F.instr("text", "\n") + 1, F.length("text")))
    part = numbered.select("file", "seq", "block", "at", body.alias("body")).filter("body IS NOT NULL")
    size = part.groupBy("file", "seq").agg((F.sum(F.length("body") + 1)).alias("length"))
    kept = part if max_bytes is None else part.join(size.filter(F.col("length") <= max_bytes), ["file", "seq"], "left_semi")
    joined = kept.groupBy("file", "seq").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("block", "at", "body"))), lambda x: x["body"]), "\n").alias("text"))
    return size.join(joined, ["file", "seq"], "left").select("file", "seq", F.encode("text", "ISO-8859-1").alias("content"), "length")

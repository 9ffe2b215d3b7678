"""The message scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The fields of a message document that the operators read.
MESSAGE_SCHEMA = ("account string, id string, threadId string, labelIds array<string>, internalDate string, "
                  "snippet string, payload variant")


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Message documents, one JSON object a line; lines that are not JSON or have no id are
    left out. Columns ``account, message_id, thread_id, labels, internal_ms, snippet, headers,
    payload`` (the payload stays a VARIANT tree, R3 flattens it)."""
    raw = spark.read.schema(MESSAGE_SCHEMA).option("mode", "DROPMALFORMED").json(path)
    headers = F.try_variant_get("payload", "$.headers", "array<struct<name:string,value:string>>")
    return raw.filter(F.col("id").isNotNull()).select(
        "account", F.col("id").alias("message_id"), F.col("threadId").alias("thread_id"),
        F.coalesce("labelIds", F.array().cast("array<string>")).alias("labels"),
        F.col("internalDate").try_cast("bigint").alias("internal_ms"), F.coalesce("snippet", F.lit("")).alias("snippet"),
        headers.alias("headers"), "payload")


def rejected_messages(spark: SparkSession, path: str) -> DataFrame:
    """The lines that ``read_messages`` leaves out: ``file, line, reason`` (``not_json``, also for
    a line that is no object, or ``no_id``). With the scanned ones they are all lines that are not blank,
    so they can feed the ``errors`` outcome."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    read = lines.select("*", F.from_json("line", MESSAGE_SCHEMA + ", _bad string", {"columnNameOfCorruptRecord": "_bad"}).alias("m"))
    broken = F.col("m").isNull() | F.col("m._bad").isNotNull() | F.ltrim("line").startswith("[")
    return read.filter(broken | F.col("m.id").isNull()).filter(F.trim("line") != "").select(
        "file", "line", F.when(broken, "not_json").otherwise("no_id").alias("reason"))

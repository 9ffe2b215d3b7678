"""R3, P7, A25, R2 on mailbox messages: nested parts split at their boundaries.

A message is one text of bytes. Level by level, a node whose type is ``multipart`` is split at the
lines of its boundary; each piece is a part with its own header block, and its path is the
list of child numbers from the top. Only the text between a node's own boundary lines is searched
for the boundaries of its children, so a boundary that stands in another branch splits nothing. What
stands before the first line and after the closing one is dropped; without a closing line the
last part goes on to the end. Everything is a column expression; a level is one map over the
nodes that have children.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notelake.functions import mime as MM
from notelake.functions.common import strip_ws
from notelake.operators.parts import join_texts
from notelake.session import materialise

# Extensions of attachments that a mailbox import saves.
SAVED_EXTENSIONS = [".pdf", ".csv", ".xlsx", ".xls", ".docx", ".doc", ".txt"]


def _boundary_lines(boundary: Column, closing: bool) -> Column:
    """The regular expression of a boundary line with the line end before it."""
    literal = F.replace(boundary, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    return F.concat(F.lit(r"(?:\A|\n)--\Q"), literal, F.lit(r"\E--[ \t]*(?=\n|\z)" if closing else r"\E[ \t]*(?=\n|\z)"))


def _children(mime: Column, boundary: Column, body: Column) -> Column:
    """The texts of the parts of a node; null if it has none."""
    inside = F.get(F.split(body, _boundary_lines(boundary, True), 2), F.lit(0))
    pieces = F.split(inside, _boundary_lines(boundary, False), -1)
    parts = F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), lambda p: F.regexp_replace(p, r"\A\n", ""))
    return F.when(F.startswith(mime, F.lit("multipart/")) & (boundary != ""), F.when(F.size(pieces) > 1, parts)) \
        .when(mime == "message/rfc822", F.array(body))


def split_entities(messages: DataFrame, keys: Sequence[str] = ("file", "seq"), content: str = "content") -> DataFrame:
    """One row per node of a message: ``keys, part_path, mime, charset, encoding, disposition,
    filename, has_parts, body`` (raw, null for nodes with children). As many rounds as the deepest
    message has levels; each reads only the parts of the level before."""
    level = messages.select(*keys, F.array(F.lit(0)).alias("part_path"), F.lit("text/plain").alias("usual"), MM.raw_text(content).alias("entity"))
    levels = []
    while True:
        cut = level.select(*keys, "part_path", "usual", MM.split_head("entity").alias("e")).select(
            *keys, "part_path", "usual", F.col("e.body").alias("body"),
            *[MM.header_value("e.head", n).alias(c) for n, c in (("Content-Type", "type"), ("Content-Transfer-Encoding", "encoding"),
                                                                 ("Content-Disposition", "disposition"))])
        stated = F.lower(strip_ws(F.substring_index("type", ";", 1)))
        read = cut.select("*", F.when(F.col("type").isNull(), F.col("usual")).when(stated.rlike("^[^/]*/[^/]*$"), stated)
                          .otherwise("text/plain").alias("mime"), F.regexp_replace(MM.parameter("type", "boundary"), r"\s+$", "").alias("boundary"))
        level = materialise(read.select(*keys, "part_path", "mime", "type", "encoding", "disposition", "body",
                                        _children(F.col("mime"), F.col("boundary"), F.col("body")).alias("children")), "mime-level")
        levels.append(level)
        usual = F.when(F.col("mime") == "multipart/digest", "message/rfc822").otherwise("text/plain")
        below = level.filter(F.size("children") > 0).select(*keys, "part_path", usual.alias("usual"), F.posexplode("children").alias("i", "entity")) \
            .select(*keys, F.concat("part_path", F.array("i")).alias("part_path"), "usual", "entity")
        if below.isEmpty():
            break
        level = below
    nodes = levels[0]
    for more in levels[1:]:
        nodes = nodes.unionAll(more)
    return nodes.select(*keys, "part_path", "mime", MM.parameter("type", "charset").alias("charset"), "encoding",
                        F.coalesce("disposition", F.lit("")).alias("disposition"), MM.decoded_words(MM.file_name("disposition", "type")).alias("filename"),
                        F.col("children").isNotNull().alias("has_parts"), F.when(F.col("children").isNull(), F.col("body")).alias("body"))


def marked_attachment() -> Column:
    """The disposition says so."""
    return F.col("disposition").contains("attachment")


def entity_bodies(entities: DataFrame, keys: Sequence[str] = ("file", "seq")) -> DataFrame:
    """Per message the decoded text parts that are no attachments, joined by newlines in part
    order: ``plain`` and ``html``. A message without parts is plain unless it is HTML. Empty parts
    and parts in an unknown charset are left out."""
    alone = (F.size("part_path") == 1) & ~F.col("has_parts")
    kind = F.when(alone & (F.col("mime") != "text/html"), "text/plain").otherwise(F.col("mime"))
    leaf = entities.filter(~F.col("has_parts") & (alone | ~marked_attachment())).withColumn("mime", kind) \
        .filter(F.col("mime").isin("text/plain", "text/html"))
    raw = leaf.select(*keys, "mime", "part_path", "charset", MM.transfer_decoded("body", "encoding").alias("raw")).filter("raw <> ''")
    text = materialise(raw.withColumn("text", MM.charset_text("raw", "charset")), "mime-texts")
    rest = text.filter("text IS NULL").withColumn("text", MM.other_charset_text(F.encode("raw", "ISO-8859-1"), "charset"))
    return join_texts(text.filter("text IS NOT NULL").unionByName(rest.filter("text IS NOT NULL")), keys)


def entity_attachments(entities: DataFrame, keys: Sequence[str] = ("file", "seq")) -> DataFrame:
    """R2: the attachments of messages with parts: ``keys, part_path, filename, raw`` (one
    character a byte; null for a node with children, which has no content of its own)."""
    found = entities.filter(marked_attachment() & (F.col("filename") != "") & ((F.size("part_path") > 1) | F.col("has_parts")))
    return found.select(*keys, "part_path", "filename", MM.transfer_decoded("body", "encoding").alias("raw"))

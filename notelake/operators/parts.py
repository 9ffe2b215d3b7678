"""Message parts: R3, A25, X7, P6, P7, R2, J14, K7.

A part is a row ``(message key..., part_path, mime, disposition, filename, attachment_id, data,
has_parts)``; ``part_path`` is the list of child numbers from the top, so its order is depth
first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notelake.functions.mail import decode_b64url, safe_name
from notelake.functions.text import choose_body
from notelake.operators.naming import assign_unique_names, split_ext
from notelake.session import materialise

# Extensions of attachments that are saved.
SAVED_EXTENSIONS = [".pdf", ".csv", ".doc", ".docx", ".xls", ".xlsx"]
_LAST = (1 << 31) - 1


def flatten_parts(msgs: DataFrame, keys: Sequence[str] = ("account", "message_id"), payload: str = "payload") -> DataFrame:
    """One row per node of the payload trees, level by level (as many rounds as the deepest
    tree has levels; each reads only nodes with children)."""
    level = msgs.select(*keys, F.array(F.lit(0)).alias("part_path"), F.col(payload).alias("node"))
    levels = []
    while True:
        level = materialise(level.withColumn("children", F.try_variant_get("node", "$.parts", "array<variant>")), "parts")
        levels.append(level)
        below = level.filter(F.size("children") > 0).select(*keys, "part_path", F.posexplode("children").alias("i", "node")) \
            .select(*keys, F.concat("part_path", F.array("i")).alias("part_path"), "node")
        if below.isEmpty():
            break
        level = below
    nodes = levels[0]
    for more in levels[1:]:
        nodes = nodes.unionAll(more)
    text = lambda p: F.try_variant_get("node", p, "string")
    return nodes.select(*keys, "part_path", F.coalesce(text("$.mimeType"), F.lit("")).alias("mime"),
                        F.lit(None).cast("string").alias("disposition"), F.coalesce(text("$.filename"), F.lit("")).alias("filename"),
                        text("$.body.attachmentId").alias("attachment_id"), text("$.body.data").alias("data"),
                        F.col("children").isNotNull().alias("has_parts"))


def join_parts(parts: DataFrame, keys: Sequence[str] = ("account", "message_id")) -> DataFrame:
    """Per message the decoded text parts joined by newlines in part order: ``plain`` and
    ``html`` (null without such a part). A node with children gives its children only; data
    that cannot be decoded gives no part; a text part with a file name counts if its data is there."""
    leaf = parts.filter(~F.col("has_parts") & F.col("mime").isin("text/plain", "text/html"))
    return join_texts(leaf.select(*keys, "mime", "part_path", decode_b64url("data").alias("text")).filter("text IS NOT NULL"), keys)


def join_texts(text: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``plain`` and ``html`` of each message from ``text(keys, mime, part_path, text)``."""
    of = lambda mime: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(
        F.col("mime") == mime, F.struct("part_path", "text")))), lambda x: x["text"]), "\n")
    n = lambda mime: F.count_if(F.col("mime") == mime)
    return text.groupBy(*keys).agg(F.when(n("text/plain") > 0, of("text/plain")).alias("plain"),
                                   F.when(n("text/html") > 0, of("text/html")).alias("html"))


def message_bodies(msgs: DataFrame, parts: DataFrame, keys: Sequence[str] = ("account", "message_id"),
                   max_chars: int | None = None) -> DataFrame:
    """X6 per message: ``body`` from the plain parts, else the HTML parts, else the placeholder."""
    j = msgs.select(*keys).join(join_parts(parts, keys), list(keys), "left")
    return j.select(*keys, choose_body("plain", "html", max_chars).alias("body"))


def first_plain(parts: DataFrame, keys: Sequence[str] = ("account", "message_id"), max_chars: int | None = None) -> DataFrame:
    """The first plain body that is not empty, children before their parent's own data; cut
    at ``max_chars`` characters only on request."""
    own = F.when(F.col("has_parts"), F.concat("part_path", F.array(F.lit(_LAST)))).otherwise(F.col("part_path"))
    p = parts.filter(F.col("mime") == "text/plain").select(*keys, own.alias("at"), decode_b64url("data").alias("text")) \
        .filter("text IS NOT NULL AND text <> ''")
    best = p.groupBy(*keys).agg(F.min_by("text", "at").alias("body"))
    return best if max_chars is None else best.withColumn("body", F.substring("body", 1, max_chars))


def is_attachment() -> Column:
    """A file name with an attachment id, or with a disposition that says so."""
    return (F.coalesce(F.col("filename"), F.lit("")) != "") & (
        F.col("attachment_id").isNotNull() | F.coalesce(F.col("disposition").contains("attachment"), F.lit(False)))


def extractable(parts: DataFrame, extensions: Sequence[str] = SAVED_EXTENSIONS) -> DataFrame:
    """Parts whose lower-case extension is one that is saved."""
    _, ext = split_ext(F.col("filename"))
    return parts.filter(F.lower(ext).isin(*extensions))


def explode_attachments(parts: DataFrame) -> DataFrame:
    """R2: one row per attachment, in part order (``part_path``)."""
    return parts.filter(is_attachment())


def attachment_names(attachments: DataFrame, date_prefix: str, style: str = "api", order: Sequence[str] = (),
                     existing: DataFrame | None = None) -> DataFrame:
    """The output name of each attachment: ``<date>_<safe file name>``. The API style only drops
    illegal characters (equal names are one file, J14); the mailbox style numbers equal names
    in ``order``, which must be unique (W1, before the extension)."""
    if style == "api":
        return attachments.withColumn("out_name", F.concat(F.col(date_prefix), F.lit("_"), F.regexp_replace(
            "filename", r'[<>:"/\\|?*\x00-\x1f]', "")))
    full = F.concat(F.col(date_prefix), F.lit("_"), safe_name("filename", 100))
    stem, ext = split_ext(full)
    named = attachments.withColumn("stem", stem).withColumn("ext", ext).withColumn("part_at", part_order())
    at = ["part_at" if c == "part_path" else c for c in order]
    return assign_unique_names(named, "stem", at, ext="ext", existing=existing, out="out_name").drop("stem", "ext", "part_at")


def part_order(path: str = "part_path") -> Column:
    """A part's path as text that sorts as the path does."""
    return F.array_join(F.transform(path, lambda i: F.lpad(i.cast("string"), 10, "0")), ".")


def drop_saved(attachments: DataFrame, saved: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """Attachments whose output name is not there yet (those are listed but not saved). With
    ``order`` (unique) also names that an earlier attachment of the same run saves count as there."""
    new = attachments.join(saved.select(F.col(saved.columns[0]).alias("out_name")).distinct(), "out_name", "left_anti")
    if order is None:
        return new
    at = F.struct(*[part_order() if c == "part_path" else F.col(c) for c in order])
    first = new.groupBy("out_name").agg(F.min(at).alias("_first"))
    return new.join(first, "out_name").filter(at == F.col("_first")).drop("_first")


def write_attachments(attachments: DataFrame, path: str, order: Sequence[str], content: Column | None = None) -> None:
    """K7: ``out_name, content BINARY``, one row per name (the first in ``order``, which is unique);
    the content is the URL-safe base64 of ``data`` unless another column is given."""
    raw = F.try_to_binary(F.translate("data", "-_", "+/"), F.lit("base64")) if content is None else content
    at = F.struct(*[part_order() if c == "part_path" else F.col(c) for c in order])
    one = attachments.withColumn("_content", raw).groupBy("out_name").agg(F.min_by("_content", at).alias("content"))
    one.write.mode("append").parquet(path)

"""Q5 attachment stubs: X34-X38, A6-A9 (DataFrame functions only).

A vault file is ``(path, content BINARY, length)`` with its path relative to the vault.
Byte tests run on an ISO-8859-1 view of the content (one character per byte), text tests on
the UTF-8 text with invalid bytes replaced. Every file gets a reason: ``read_error`` (null
content), one of four stub reasons, or ``kept``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notelake.functions.common import col_of, strip_ws
from notelake.operators.naming import assign_unique_names, split_ext
from notelake.session import materialise

# File-name patterns of attachments, magic bytes at the start of binary bodies (as
# ISO-8859-1 text), markers of binary data dumped as text (one strong or two weak ones), sizes.
ATTACHMENT_NAMES = [r"IMG_\d+", r"image\d*", "Outlook-", "Screenshot", "attachment[-_]", r"\.HEIC$", r"\.JPG$", r"\.PNG$",
                    r"\.jpeg$", r"\.gif$", r"\.mov$", r"\.MOV$", r"\.pdf$"]
MAGIC = ["\x89PNG", "%PDF", "\xff\xd8\xff", "GIF87a", "GIF89a", "RIFF", "PK\x03\x04"]
STRONG_MARKERS = ["IHDR", "IDATx", "/FlateDecode", "JFIF"]
WEAK_MARKERS = ["endobj", "endstream", "iCCProfile", "/ColorSpace", "/Subtype /Image"]
TINY, SHORT_BODY, SHORT_NOTE = 200, 20, 100
STUB_REASONS = ["tiny_file", "binary_content", "frontmatter_only", "attachment_filename_short_body"]


def attachment_like(name) -> Column:
    """The file name without extension and leading number matches an attachment pattern."""
    stem, _ = split_ext(col_of(name))
    return F.regexp_replace(stem, r"^\d+_", "").rlike("(?id)" + "|".join(ATTACHMENT_NAMES))


def _text(content: Column) -> Column:
    return F.make_valid_utf8(content.cast("string"))


def _any(text: Column, words: Sequence[str]) -> Column:
    return text.rlike("|".join(map(re.escape, words)))


def _count(text: Column, words: Sequence[str]) -> Column:
    return sum((text.contains(w).cast("int") for w in words), F.lit(0))


def with_bodies(df: DataFrame) -> DataFrame:
    """``df(path, content, ...)`` with the parts the tests read:

    ``_t_fm``/``_t_body``  whether the text has frontmatter, and what follows it;
    ``_t_rest``            that after leading blank, heading and rule lines, as text;
    ``_r_fm``/``_r_rest``  the same on raw bytes (ISO-8859-1 view).

    Frontmatter ends at the first ``---`` after the opening one, wherever it stands (Q14)."""
    raw = F.decode("content", "ISO-8859-1")
    t = df.select("*", _text(F.col("content")).alias("_text"), raw.alias("_raw"))
    ends = t.select("*", F.when(F.col("_text").startswith("---"), F.locate("---", "_text", 4)).otherwise(0).alias("_t_end"),
                    F.when(F.col("_raw").startswith("---"), F.locate("---", "_raw", 4)).otherwise(0).alias("_r_end"))
    after = lambda c, e: F.substring(c, F.col(e) + 3, F.length(c))
    cut = ends.select("*", F.when(F.col("_t_end") > 0, after("_text", "_t_end")).otherwise(F.col("_text")).alias("_t_body"),
                      F.when(F.col("_r_end") > 0, after("_raw", "_r_end")).alias("_r_body"))
    # leading lines that are blank, start with # or are a rule
    t_rest = F.regexp_replace(F.regexp_replace("_t_body", r"(?U)^\s+", ""), r"(?Ud)^(?:(?:[^\S\n]*(?:#[^\n]*|---)?[^\S\n]*)(?:\n|$))+", "")
    r_rest = F.regexp_replace("_r_body", r"^(?:[\r\n \t]*(?:#[^\n]*|---[ \t\r\x0b\x0c]*)(?:\n|$))*[\r\n \t]*", "")
    return cut.select(*df.columns, (F.col("_t_end") > 0).alias("_t_fm"), "_t_body",
                      F.when(F.col("_t_end") > 0, t_rest).alias("_t_rest"),
                      (F.col("_r_end") > 0).alias("_r_fm"), F.when(F.col("_r_end") > 0, r_rest).alias("_r_rest"))


def is_binary() -> Column:
    """X36 on ``with_bodies``: magic bytes in the first 100 raw bytes, ``Exif`` in the first 200,
    one strong or two weak markers in the first 5,000 bytes of text, or more than 8 % control
    bytes in the first 5,000 raw ones of a body over 200."""
    raw, text = F.col("_r_rest"), F.decode(F.substring(F.encode("_t_rest", "UTF-8"), 1, 5000), "ISO-8859-1")
    head = F.substring(raw, 1, 5000)
    control = F.length(F.regexp_replace(head, r"[^\x00-\x08\x0b\x0c\x0e-\x1f]", ""))
    long_text = F.coalesce(F.octet_length("_t_rest") >= 10, F.lit(False))
    return F.coalesce(F.col("_r_fm") & (F.length(raw) >= 10) & (
        _any(F.substring(raw, 1, 100), MAGIC) | F.substring(raw, 1, 200).contains("Exif")
        | (long_text & (_any(text, STRONG_MARKERS) | (_count(text, WEAK_MARKERS) >= 2)
                        | ((F.length(raw) > 200) & (control > F.length(head) * 0.08))))), F.lit(False))


def classify_stubs(files: DataFrame) -> DataFrame:
    """``files(path, content, length)`` -> ``path, length, reason``, the first that holds of
    ``read_error``, ``tiny_file`` (under 200 bytes), ``binary_content``, ``frontmatter_only``
    (under 20 bytes left), ``attachment_filename_short_body`` (under 100 characters without
    headings and rules), ``kept``."""
    parts = with_bodies(files.select("path", "content", "length"))
    left = F.octet_length(F.regexp_replace("_t_rest", r"^[\s\x0b]+|[\s\x0b]+$", ""))
    plain = strip_ws(F.regexp_replace(F.regexp_replace("_t_body", r"(?md)^#\s+.*$", ""), r"(?md)^---+\s*$", ""))
    reason = (F.when(F.col("content").isNull(), "read_error")
              .when(F.col("length") < TINY, "tiny_file")
              .when(is_binary(), "binary_content")
              .when(F.col("_t_fm") & (left < SHORT_BODY), "frontmatter_only")
              .when(attachment_like(F.substring_index("path", "/", -1)) & F.col("_t_fm") & (F.length(plain) < SHORT_NOTE),
                    "attachment_filename_short_body").otherwise("kept"))
    return materialise(parts.select("path", "length", reason.alias("reason")), "stubs")   # every report reads it


def is_stub(reason="reason") -> Column:
    return col_of(reason).isin(*STUB_REASONS)


def stubs_by_reason(classified: DataFrame) -> DataFrame:
    """Stubs per reason."""
    return classified.filter(is_stub()).groupBy("reason").agg(F.count(F.lit(1)).alias("stubs"))


def stubs_by_location(classified: DataFrame) -> DataFrame:
    """Stubs per first path component, ``(top-level)`` for files without one."""
    top = F.when(F.col("path").contains("/"), F.substring_index("path", "/", 1)).otherwise("(top-level)")
    return classified.filter(is_stub()).groupBy(top.alias("location")).agg(F.count(F.lit(1)).alias("stubs"))


def scan_summary(classified: DataFrame) -> DataFrame:
    """Scanned, stubs, kept, read errors and the share of stubs in percent."""
    r = F.col("reason")
    s = classified.agg(F.count(F.lit(1)).alias("scanned"), F.count_if(is_stub()).alias("stubs"),
                       F.count_if(r == "kept").alias("kept"), F.count_if(r == "read_error").alias("read_errors"))
    return s.withColumn("noise_pct", F.round(F.col("stubs") * 100.0 / F.greatest(F.col("scanned"), F.lit(1)), 4))


def extension_histogram(files: DataFrame) -> DataFrame:
    """Files per lower-case extension, with whether they are notes or binaries."""
    _, ext = split_ext(F.col("path"))
    return files.groupBy(F.lower(ext).alias("ext")).agg(F.count(F.lit(1)).alias("files")) \
        .withColumn("kind", F.when(F.col("ext") == ".md", "md").otherwise("binary"))


def folder_quality(classified: DataFrame, folder: str) -> DataFrame:
    """Total, meaningful, stubs per reason and the meaningful share of one folder (0 if it is
    empty). Unreadable notes count as meaningful, as they are no stubs."""
    f = classified.filter(F.col("path").startswith(folder.rstrip("/") + "/"))
    s = f.agg(F.count(F.lit(1)).alias("total"), F.count_if(~is_stub()).alias("meaningful"),
              *[F.count_if(F.col("reason") == r).alias(r) for r in STUB_REASONS])
    return s.withColumn("meaningful_pct", F.when(F.col("total") == 0, F.lit(0.0)).otherwise(
        F.round(F.col("meaningful") * 100.0 / F.col("total"), 4)))


def plan_archive(classified: DataFrame, prefix: str, existing: DataFrame | None = None) -> DataFrame:
    """``src, dst, reason`` of every stub: the same path under ``prefix``, numbered where a
    file is there already (W1)."""
    stubs = classified.filter(is_stub()).select(F.col("path").alias("src"), "reason", F.concat(F.lit(prefix + "/"), "path").alias("to"))
    return _free(stubs, existing, "_").select("src", "dst", "reason")


def plan_restore(archived: DataFrame, prefix: str, existing: DataFrame | None = None) -> DataFrame:
    """The way back of ``archived(path)``: the path without the prefix, ending in
    ``_restored_<n>`` where a file is there already."""
    back = archived.filter(F.col("path").startswith(prefix + "/")).select(
        F.col("path").alias("src"), F.substring("path", F.lit(len(prefix) + 2), F.length("path")).alias("to"))
    return _free(back, existing, "_restored_").select("src", "dst")


def _free(moves: DataFrame, existing: DataFrame | None, sep: str) -> DataFrame:
    stem, ext = split_ext(F.col("to"))
    named = moves.select("*", stem.alias("stem"), ext.alias("ext"))
    return assign_unique_names(named, "stem", ["src"], ext="ext", existing=existing, sep=sep, id_col="src", out="dst")


def top_k(df: DataFrame, k: int, count: str, *key: str) -> DataFrame:
    """L4: the ``k`` largest counts, ties by key (the cut is the feature)."""
    return df.orderBy(F.desc(count), *key).limit(k)

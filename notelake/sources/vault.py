"""Scans of note folders: S3, S4, S10 and the order L5."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notelake.operators.sequence import sorted_by
from notelake.session import read_folder


@dataclass(frozen=True)
class PathRules:
    """Which notes a scan takes. A file is skipped by its own name or by that of the folder it
    is in; folders below a skipped one are not skipped (Q15)."""
    skip_names: Sequence[str] = ("README.md",)
    # Numbered names that attachments get.
    skip_pattern: str = r"(?i)^0\d{3}_(IMG_|image\d|Outlook|Screenshot|Invoice)"
    skip_folders: Sequence[str] = ("attachments",)
    priority_folders: Sequence[str] = ()


def read_files(spark: SparkSession, root: str, glob: str = "*.md") -> DataFrame:
    """``path`` (relative to ``root``), ``content BINARY``, ``length`` of the files below it."""
    df = read_folder(spark, root, recursiveFileLookup=True, pathGlobFilter=glob)
    top = root.rstrip("/").split(":", 1)[-1].lstrip("/") + "/"
    rel = F.substring("path", F.instr("path", F.lit(top)) + F.lit(len(top)), F.length("path"))
    return df.select(rel.alias("path"), "content", "length")


def _folder() -> Column:
    parts = F.split("path", "/")
    return F.coalesce(F.try_element_at(parts, F.lit(-2)), F.lit(""))


def select_notes(files: DataFrame, rules: PathRules = PathRules()) -> DataFrame:
    """S3 on a listing ``files(path, ...)``: the notes of the rules, with ``priority``."""
    name = F.substring_index("path", "/", -1)
    keep = (name.endswith(".md") & ~name.startswith("_") & ~name.isin(*rules.skip_names)
            & ~name.rlike(rules.skip_pattern) & ~_folder().isin(*rules.skip_folders))
    return files.filter(keep).withColumn("priority", _folder().isin(*rules.priority_folders))


def read_notes(spark: SparkSession, root: str, rules: PathRules = PathRules()) -> DataFrame:
    """S3: ``path, priority, content`` (text) of the notes below ``root``."""
    return select_notes(read_files(spark, root), rules).withColumn("content", F.make_valid_utf8(F.col("content").cast("string")))


def exclude_prefixes(files: DataFrame, prefixes: Sequence[str] = ("attachments", "attachment-stubs")) -> DataFrame:
    """All ``.md`` files but those anywhere beneath one of the folders."""
    keep = F.col("path").endswith(".md")
    for p in prefixes:
        keep = keep & ~F.col("path").startswith(p.rstrip("/") + "/")
    return files.filter(keep)


def order_notes(notes: DataFrame, n: int | None = None, position: str | None = None) -> DataFrame:
    """Notes of priority folders first, then by path; the first ``n`` on request."""
    out = sorted_by(notes, [F.desc("priority"), "path"], position)
    return out if n is None else out.limit(n) if position is None else out.filter(F.col(position) < n)


def existing_names(notes: DataFrame) -> DataFrame:
    """Names (without ``.md``) of the notes that are there; only the path is read."""
    return notes.select(F.regexp_replace(F.substring_index("path", "/", -1), r"\.md$", "").alias("name")).distinct()

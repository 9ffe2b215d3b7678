"""File inventories and folder merges: S7, X39, J7, J8, J9, P14, A10, A11.

A file inventory is a DataFrame ``(folder, rel_path, ext, length, sha256)``; folder
merges are computed as plans (tables of outcomes and destinations), never as
moves on a disk.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notelake.operators.naming import assign_unique_names, split_ext
from notelake.session import materialise, read_folder


def content_hash(content) -> Column:
    """SHA-256 of the content as lowercase hex (null content -> null hash)."""
    c = F.col(content) if isinstance(content, str) else content
    return F.sha2(c, 256)


def file_inventory(spark: SparkSession, root: str, with_hash: bool = True) -> DataFrame:
    """Every file under ``root`` with its top folder, path relative to that
    folder, extension, size and (optionally) content hash. Without the hash the
    ``content`` column is pruned and never read."""
    df = read_folder(spark, root, recursiveFileLookup=True)
    top = root.rstrip("/").split(":", 1)[-1].lstrip("/") + "/"
    rel = F.substring_index(F.col("path"), top, -1) if top == "/" else F.substring(
        F.col("path"), F.instr(F.col("path"), F.lit(top)) + F.lit(len(top)), F.lit(1 << 30))
    cols = [F.split(rel, "/", 2)[0].alias("folder"),
            F.when(F.size(F.split(rel, "/", 2)) > 1, F.split(rel, "/", 2)[1]).alias("rel_path"),
            F.lower(F.regexp_extract(rel, r"(?<=[^./])(\.[^./]*)$", 1)).alias("ext"),
            F.col("length")]
    if with_hash:
        cols.append(content_hash("content").alias("sha256"))
    return df.select(*cols)


def full_path(root: str) -> Column:
    """The path of an inventoried file."""
    return F.concat(F.lit(root.rstrip("/") + "/"), F.concat_ws("/", "folder", "rel_path"))


def with_needed_hashes(spark: SparkSession, root: str, files: DataFrame, pairs: DataFrame, at_once: int = 10_000) -> DataFrame:
    """X39 read late: ``files`` (an inventory without hashes) with ``sha256`` of those files that a merge
    has to compare: another file claims the same path of the same target and has the same
    length. All others are never opened and have no hash, which compares as unequal, as their
    lengths differ. A file longer than the reader takes (``spark.sql.sources.binaryFile.maxLength``)
    has no hash either, so it is kept beside its namesake. Paths go through the driver in batches,
    as the listing of the files does."""
    here = files.withColumn("_file", full_path(root))
    goes = here.join(pairs.select(F.col("old").alias("folder"), F.col("new").alias("target")), "folder").select("_file", "target", "rel_path", "length")
    stays = here.join(pairs.select(F.col("new").alias("folder")).distinct(), "folder").select("_file", F.col("folder").alias("target"), "rel_path", "length")
    claims = materialise(goes.unionByName(stays), "merge-lengths")
    place = ["target", "rel_path", "length"]
    limit = int(spark.conf.get("spark.sql.sources.binaryFile.maxLength", str((1 << 31) - 1)))
    shared = claims.groupBy(*place).agg(F.count_distinct("_file").alias("n")).filter(f"n > 1 AND length <= {limit}")
    wanted = claims.join(shared, place, "left_semi").select("_file").distinct()
    paths, parts = [], []

    def read() -> None:
        escaped = [re.sub(r"([\\*?\[\]{}])", r"\\\1", p) for p in paths]
        some = read_folder(spark, escaped).select(F.col("path").alias("_at"), content_hash("content").alias("sha256"))
        parts.append(materialise(some, "merge-hashes"))
        paths.clear()

    for r in materialise(wanted, "merge-wanted").toLocalIterator():
        paths.append(r["_file"])
        if len(paths) >= at_once:
            read()
    if paths:
        read()
    if not parts:
        return files.withColumn("sha256", F.lit(None).cast("string"))
    hashes = parts[0]
    for more in parts[1:]:
        hashes = hashes.unionAll(more)
    bare = lambda c: F.regexp_replace(c, "^file:/+", "/")  # noqa: E731   the reader writes file: with one slash
    return here.join(hashes, bare(F.col("_file")) == bare(F.col("_at")), "left").select(*files.columns, "sha256")


def valid_pairs(pairs: DataFrame) -> DataFrame:
    """A pair spec ``old:new`` must split into exactly two parts."""
    p = F.split(F.col("spec"), ":")
    return pairs.filter(F.size(p) == 2).select(p[0].alias("old"), p[1].alias("new"))


def map_folders(files: DataFrame, pairs: DataFrame) -> DataFrame:
    """Files of old folders with their target folder (mapping joined on the first
    path component)."""
    m = pairs.select(F.col("old").alias("folder"), F.col("new").alias("target"))
    return files.join(m, "folder", "inner")


def plan_merge(files: DataFrame, pairs: DataFrame, dry_run: bool = False) -> DataFrame:
    """Each file of an old folder against what stands at the same relative path of the
    target when its turn comes: nothing -> moved there; the same hash -> duplicate_removed;
    another hash -> moved under ``<stem>_<n><ext>``, the first name free in the target (W1,
    seeded with the target's listing). Null hashes never compare equal (Q2). Old folders
    merge in name order, so of two that share a target the first one's file takes the path
    and the second one's is compared with it (only the base path is compared, Q3). In a dry
    run every file is ``would_move``.

    ``files`` is read twice (pass a written inventory): once for the path keys of the
    targets, once for the old folders."""
    src = map_folders(files, pairs).select(F.col("folder").alias("old"), "target", "rel_path", F.col("sha256").alias("src_sha"))
    if dry_run:
        return src.select("old", "target", "rel_path", F.concat_ws("/", "old", "rel_path").alias("src"),
                          F.lit("would_move").alias("outcome"), F.concat_ws("/", "target", "rel_path").alias("dst"))
    there = files.join(pairs.select(F.col("new").alias("folder")).distinct(), "folder", "left_semi") \
        .select(F.lit(None).cast("string").alias("old"), F.col("folder").alias("target"), "rel_path", F.col("sha256").alias("src_sha"))
    claims = materialise(src.unionByName(there), "merge-claims")
    # who holds the base path: the target's own file (null sorts first), else the first old folder
    held = claims.groupBy("target", "rel_path").agg(
        F.min(F.struct("old", "src_sha")).alias("base"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    j = claims.filter("old IS NOT NULL").join(held, ["target", "rel_path"], "left")
    outcome = (F.when(F.col("base").isNull() | (F.col("base.old") == F.col("old")), "moved")
               .when(F.col("src_sha") == F.col("base.src_sha"), "duplicate_removed").otherwise("moved_renamed"))
    plan = materialise(j.select("old", "target", "rel_path", F.concat_ws("/", "old", "rel_path").alias("src"),
                                outcome.alias("outcome"), F.concat_ws("/", "target", "rel_path").alias("dst")), "merge-plan")
    stem, ext = split_ext(F.col("dst"))
    ren = plan.filter("outcome = 'moved_renamed'").select("src", stem.alias("dst_stem"), ext.alias("dst_ext"))
    taken = claims.filter("old IS NULL").select(F.concat_ws("/", "target", "rel_path").alias("name")) \
        .unionByName(plan.filter("outcome = 'moved'").select(F.col("dst").alias("name")))
    named = assign_unique_names(ren, "dst_stem", ["src"], ext="dst_ext", existing=taken, id_col="src") \
        .select("src", F.col("unique_name").alias("renamed"))
    return plan.join(named, "src", "left").select(
        "old", "target", "rel_path", "src",
        F.when(F.col("outcome") == "moved_renamed", "moved").otherwise(F.col("outcome")).alias("outcome"),
        F.when(F.col("outcome") == "moved", F.col("dst")).otherwise(F.col("renamed")).alias("dst"))


def merge_stats(plan: DataFrame, pairs: DataFrame, folders: DataFrame | None = None) -> DataFrame:
    """Per pair, counts per outcome and the pair status. ``folders(folder)`` lists the
    folders that exist: an old one that is not there is old_not_found, one without files
    deleted_empty, any other merged. Without ``folders`` a folder exists if it has files. A
    plan has no move errors; a file whose content could not be read is compared as unequal."""
    agg = plan.groupBy("old", F.col("target").alias("new")).agg(
        F.count_if(F.col("outcome") == "moved").alias("moved"),
        F.count_if(F.col("outcome") == "duplicate_removed").alias("duplicate_removed"),
        F.count_if(F.col("outcome") == "would_move").alias("would_move"))
    j = pairs.select("old", "new").join(agg, ["old", "new"], "left")
    if folders is None:
        j = j.withColumn("_there", F.lit(None).cast("boolean"))
    else:
        j = j.join(folders.select(F.col("folder").alias("old"), F.lit(True).alias("_there")).distinct(), "old", "left")
    return j.select("old", "new",
                    *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("moved", "duplicate_removed", "would_move")],
                    F.when(F.col("moved").isNotNull(), "merged").when(F.col("_there"), "deleted_empty")
                    .otherwise("old_not_found").alias("status"))


def audit_folders(files: DataFrame, pairs: DataFrame) -> DataFrame:
    """A10 + J9: files per top folder (hidden folders skipped), tagged OLD, NEW (the
    first component of a target) or none."""
    counts = files.filter(~F.col("folder").startswith(".")).groupBy("folder") \
        .agg(F.count(F.lit(1)).alias("files"))
    olds = pairs.select(F.col("old").alias("folder"), F.lit("OLD").alias("_o")).distinct()
    news = pairs.select(F.split("new", "/")[0].alias("folder"), F.lit("NEW").alias("_n")).distinct()
    j = counts.join(olds, "folder", "left").join(news, "folder", "left")
    return j.select("folder", "files", F.coalesce("_o", "_n").alias("tag"))

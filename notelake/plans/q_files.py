"""Q6 ``merge_folders`` / ``audit_folders`` on document-derived vault folders."""

from __future__ import annotations

from pyspark.sql import functions as F

from notelake.operators import files as FL
from notelake.plans import bindings as B
from notelake.plans.registry import register
from notelake.session import materialise, read_table, shared_path

FILES_SQL = """
docf AS (
  SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'old-' ELSE 'new-' END || CAST((doc_id // 2) % 3 AS VARCHAR) AS folder,
         'n/' || left(md5(left(coalesce(text, ''), 30)), 10) AS base, coalesce(text, '') AS body
  FROM documents
),
files AS (
  SELECT doc_id, folder, base || CASE WHEN row_number() OVER (PARTITION BY folder, base ORDER BY doc_id) = 1 THEN ''
                                      ELSE '-' || doc_id END || '.md' AS rel_path, '.md' AS ext,
         CAST(octet_length(encode(body)) AS BIGINT) AS length, sha256(body) AS sha256 FROM docf
),
pairs AS (SELECT * FROM (VALUES ('old-0', 'new-0'), ('old-1', 'new-1'), ('old-2', 'new-0'),
                                ('old-missing', 'new-missing/sub'), ('old-empty', 'new-1')) t(old, new)),
claims AS (
  SELECT f.folder AS old, p.new AS target, f.rel_path, f.sha256, 1 AS late FROM files f JOIN pairs p ON f.folder = p.old
  UNION ALL SELECT '', folder, rel_path, sha256, 0 FROM files WHERE folder IN (SELECT new FROM pairs)
),
ranked AS (
  SELECT *, first_value(sha256) OVER w AS held, row_number() OVER w AS rn
  FROM claims WINDOW w AS (PARTITION BY target, rel_path ORDER BY late, old)
),
plan0 AS (
  SELECT old, target, rel_path, old || '/' || rel_path AS src,
         CASE WHEN rn = 1 THEN 'moved' WHEN sha256 = held THEN 'duplicate_removed' ELSE 'moved_renamed' END AS o
  FROM ranked WHERE late = 1
),
plan AS (
  SELECT old, target, rel_path, src, CASE WHEN o = 'moved_renamed' THEN 'moved' ELSE o END AS outcome,
         CASE WHEN o = 'moved' THEN target || '/' || rel_path
              WHEN o = 'moved_renamed' THEN target || '/' || regexp_replace(rel_path, '\\.md$', '') || '_'
                || row_number() OVER (PARTITION BY target, rel_path, o ORDER BY src) || '.md' END AS dst
  FROM plan0
)"""


def _inventory(spark, sf_dir):
    """The inventory, hashed once and written: a merge reads it more than once."""
    return materialise(B.doc_files(spark, sf_dir), "inventory")


@register("merge_plan", "WITH " + FILES_SQL + " SELECT * FROM plan")
def q_merge_plan(spark, sf_dir):
    """J7/J8 with W1 renames and X39 hashes; two old folders share a target."""
    return FL.plan_merge(_inventory(spark, sf_dir), B.merge_pairs(spark, sf_dir))


@register("merge_stats", "WITH " + FILES_SQL + """
SELECT p.old, p.new,
       count(*) FILTER (WHERE outcome = 'moved') AS moved,
       count(*) FILTER (WHERE outcome = 'duplicate_removed') AS duplicate_removed,
       CAST(0 AS BIGINT) AS would_move,
       CASE WHEN p.old = 'old-empty' THEN 'deleted_empty' WHEN count(pl.old) = 0 THEN 'old_not_found' ELSE 'merged' END AS status
FROM pairs p LEFT JOIN plan pl ON pl.old = p.old AND pl.target = p.new GROUP BY p.old, p.new""")
def q_merge_stats(spark, sf_dir):
    """Per-pair outcome counts and status."""
    files, pairs = _inventory(spark, sf_dir), B.merge_pairs(spark, sf_dir)
    return FL.merge_stats(FL.plan_merge(files, pairs), pairs, B.vault_folders(spark, files))


@register("merge_dry_run", "WITH " + FILES_SQL + """
SELECT s.folder AS old, count(*) AS would_move FROM files s JOIN pairs p ON s.folder = p.old GROUP BY s.folder""")
def q_merge_dry_run(spark, sf_dir):
    """K8: the same plan in dry-run mode: every file would move."""
    files, pairs = B.doc_files(spark, sf_dir), B.merge_pairs(spark, sf_dir)
    st = FL.merge_stats(FL.plan_merge(files, pairs, dry_run=True), pairs)
    return st.filter("status = 'merged'").select("old", "would_move")


@register("audit_folders", "WITH " + FILES_SQL + """
SELECT f.folder, count(*) AS files,
       CASE WHEN f.folder IN (SELECT old FROM pairs) THEN 'OLD'
            WHEN f.folder IN (SELECT split_part(new, '/', 1) FROM pairs) THEN 'NEW' END AS tag
FROM files f WHERE NOT starts_with(f.folder, '.') GROUP BY f.folder""")
def q_audit_folders(spark, sf_dir):
    """A10 + J9: files per top folder with its role."""
    return FL.audit_folders(B.doc_files(spark, sf_dir), B.merge_pairs(spark, sf_dir))


@register("file_hashes", "WITH " + FILES_SQL + " SELECT doc_id, folder, rel_path, length, sha256 FROM files")
def q_file_hashes(spark, sf_dir):
    """X39 content hashes and sizes of the whole inventory."""
    return B.doc_files(spark, sf_dir).select("doc_id", "folder", "rel_path", "length", "sha256")


@register("file_inventory", """
SELECT 'source=' || source AS folder, 'chunk=' || (doc_id // 200) AS sub, '.txt' AS ext, 1::BIGINT AS files,
       CAST(octet_length(encode(string_agg(coalesce(text, '') || chr(10), '' ORDER BY doc_id))) AS BIGINT) AS length,
       sha256(string_agg(coalesce(text, '') || chr(10), '' ORDER BY doc_id)) AS sha256
FROM documents GROUP BY source, doc_id // 200""")
def q_file_inventory(spark, sf_dir):
    """Documents written as text files of at most 200 rows under a root whose name holds
    pattern characters, scanned back with sizes and hashes."""
    root = shared_path(spark, "vault(1)+")
    d = read_table(spark, sf_dir, "documents").select(
        "doc_id", "source", F.floor(F.col("doc_id") / 200).cast("long").alias("chunk"), F.coalesce("text", F.lit("")).alias("value"))
    d.repartition("source", "chunk").sortWithinPartitions("source", "chunk", "doc_id").select("source", "chunk", "value") \
        .write.partitionBy("source", "chunk").text(root)
    found = FL.file_inventory(spark, root).filter(F.col("ext") == ".txt")
    return found.groupBy("folder", F.substring_index("rel_path", "/", 1).alias("sub"), "ext").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("length"), F.max("sha256").alias("sha256"))


@register("merge_late_hashes", """
WITH c AS (SELECT DISTINCT doc_id // 50 AS chunk FROM documents)
SELECT chunk, CASE WHEN chunk % 3 = 0 THEN 'duplicate_removed' ELSE 'moved' END AS outcome,
       chunk % 3 = 1 AS renamed, CASE WHEN chunk % 3 <> 2 THEN 2 ELSE 0 END AS hashed FROM c""")
def q_merge_late_hashes(spark, sf_dir):
    """Documents as files of an old and a new folder, by chunks: equal in both, of one
    length but not equal, or in the old one only. Only files with a namesake of their length are read."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", F.floor(F.col("doc_id") / 50).cast("long").alias("chunk"),
                                                      F.coalesce("text", F.lit("")).alias("value"))
    k = F.col("chunk") % 3
    head = F.when(F.col("doc_id") % 50 == 0, F.when(F.col("folder") == "old", "left ").when(k == 1, "right").otherwise("left "))
    both = d.withColumn("folder", F.explode(F.when(k < 2, F.array(F.lit("old"), F.lit("new"))).otherwise(F.array(F.lit("old"))))) \
        .withColumn("value", F.concat(F.coalesce(head, F.lit("")), "value"))
    root = shared_path(spark, "late")
    both.repartition("chunk").sortWithinPartitions("folder", "chunk", "doc_id").select("folder", "chunk", "value") \
        .write.partitionBy("folder", "chunk").text(root)
    files = FL.file_inventory(spark, root, with_hash=False).filter(F.col("ext") == ".txt")
    pairs = spark.createDataFrame([("folder=old", "folder=new")], "old string, new string")
    hashed = materialise(FL.with_needed_hashes(spark, root, files, pairs), "late-inventory")
    chunk = F.regexp_extract("rel_path", "chunk=([0-9]+)", 1).cast("long").alias("chunk")
    seen = hashed.groupBy(chunk).agg(F.count("sha256").cast("int").alias("hashed"))
    plan = FL.plan_merge(hashed, pairs).select(chunk, "outcome", F.coalesce(F.col("dst") != F.concat_ws("/", "target", "rel_path"), F.lit(False)).alias("renamed"))
    return plan.join(seen, "chunk").select("chunk", "outcome", "renamed", "hashed")

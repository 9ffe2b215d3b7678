"""Q4 ``retag_notes`` and J2/J3 on part-derived notes."""

from __future__ import annotations

from pyspark.sql import functions as F

from notelake.operators import brands as BR
from notelake.plans import bindings as B
from notelake.plans.registry import register

_KW = ", ".join(f"('{k}', '{b}', {r})" for k, b, r in B.SUB_BRAND_KEYWORDS)
G = B.GENERIC_BRAND

NOTES_SQL = f"""
notes AS (
  SELECT 'parts/' || CAST(p_partkey AS VARCHAR) || '.md' AS path,
         '---' || chr(10) || 'type: email' || chr(10) || 'related_brand: "' || b || '"' || chr(10) || '---' || chr(10)
         || chr(10) || '# ' || p_name || chr(10) || chr(10) || 'About [[' || b || ']] and the ' || p_name
         || ' (' || p_type || ', ' || p_brand || ').' || chr(10) AS content
  FROM (SELECT *, CASE WHEN p_size > 25 THEN '{G}' ELSE 'Other' END AS b FROM part)
),
kw AS (SELECT * FROM (VALUES {_KW}) t(keyword, brand, rank)),
linked AS (SELECT * FROM notes WHERE contains(content, '[[{G}]]') AND NOT contains(content, '(via [[{G}]])')),
dec AS (
  SELECT l.path, l.content,
         (SELECT arg_min(brand, rank) FROM kw WHERE contains(lower(l.content), lower(kw.keyword))) AS sub_brand
  FROM linked l
)"""


@register("retag_notes", "WITH " + NOTES_SQL + f"""
SELECT path, sub_brand,
       CASE WHEN sub_brand IS NOT NULL THEN
         regexp_replace(replace(content, '[[{G}]]', '[[' || sub_brand || ']] (via [[{G}]])'),
                        'related_brand:\\s*"{G}"', 'related_brand: "' || sub_brand || '"')
       END AS new_content
FROM dec""")
def q_retag_notes(spark, sf_dir):
    """P13, J3 (first keyword in list order), X18 rewrite."""
    d = BR.retag(B.part_notes(spark, sf_dir), G, B.keyword_table(spark))
    return d.select("path", "sub_brand", "new_content")


@register("retag_stats", "WITH " + NOTES_SQL + """
SELECT coalesce(sub_brand, '(still generic)') AS brand, count(*) AS notes FROM dec GROUP BY 1""")
def q_retag_stats(spark, sf_dir):
    """Counts per sub-brand and still generic."""
    return BR.retag_stats(BR.retag(B.part_notes(spark, sf_dir), G, B.keyword_table(spark)))


@register("subject_brand", f"""
WITH kw AS (SELECT * FROM (VALUES {_KW}) t(keyword, brand, rank))
SELECT p_partkey,
       coalesce((SELECT arg_min(brand, rank) FROM kw WHERE contains(lower(p_name), lower(kw.brand))),
                (SELECT arg_min(brand, rank) FROM kw WHERE contains(lower(p_name || ' ' || p_type), lower(kw.keyword))),
                '') AS brand
FROM part""")
def q_subject_brand(spark, sf_dir):
    """J2 shape: a brand named in the subject when the domain lookup missed (here
    the domain lookup is the brand-name test, the subject test the keyword test)."""
    p = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name", "p_type")
    kw = B.keyword_table(spark)
    byname = kw.select(F.col("brand").alias("keyword"), "brand", "rank")
    a = BR.first_contained(p, F.col("p_name"), byname, out="domain_brand")
    b = BR.first_contained(a, F.concat_ws(" ", "p_name", "p_type"), kw, out="subject_brand")
    return b.select("p_partkey", F.coalesce("domain_brand", "subject_brand", F.lit("")).alias("brand"))

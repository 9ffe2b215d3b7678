"""Brand linking: J1, J2, J3, P13, X18, A12 (jobs Q2 brand guess, Q4 retag).

Ranked dictionaries (``keyword, brand, rank``) of a few hundred terms are evaluated once to an array
in rank order, and "first in list order wins" is the first element of it that occurs in the
text: a projection, without a join or a shuffle of the texts. Larger ones go through an index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notelake.operators import joins
from notelake.operators.joins import first_term, ranked_terms


def lookup_brand(df: DataFrame, domains: DataFrame, domain_col: str = "domain") -> DataFrame:
    """Exact domain -> brand (left join; ``domains`` has ``domain, brand``)."""
    d = domains.select(F.col("domain").alias(domain_col), F.col("brand").alias("domain_brand"))
    return df.join(d, domain_col, "left")


def first_contained(df: DataFrame, text: Column, ranked: DataFrame,
                    term_col: str = "keyword", value_col: str = "brand", out: str = "match") -> DataFrame:
    """For each row the ``value_col`` of the first dictionary entry in rank order whose
    lowercase ``term_col`` occurs in the lowercase ``text``; null when none does. Dictionaries of
    more than ``ARRAY_TERMS`` terms are joined through an index of their grams."""
    if ranked.limit(joins.ARRAY_TERMS + 1).count() > joins.ARRAY_TERMS:
        return joins.first_indexed(df, F.lower(text), ranked, term_col, value_col, out)
    low = df.withColumns({"_low": F.lower(text), "_terms": ranked_terms(ranked, term_col, value_col)})
    # both are used twice, so they are computed once a row and not once a term
    known = F.col("_low").isNotNull() & F.col("_terms").isNotNull()
    return low.withColumn(out, F.when(known, first_term(F.col("_low"), F.col("_terms")))).drop("_low", "_terms")


def brand_from_subject(df: DataFrame, brands_ranked: DataFrame) -> DataFrame:
    """A brand whose lowercase name occurs in the subject, only where J1 missed;
    else ``""``."""
    names = brands_ranked.select(F.col("brand").alias("keyword"), "brand", "rank")
    g = first_contained(df, F.coalesce(F.col("subject"), F.lit("")), names, out="subject_brand")
    return g.withColumn("brand", F.coalesce(F.col("domain_brand"), F.col("subject_brand"), F.lit("")))


def linked_to(df: DataFrame, brand: str, content: str = "content") -> DataFrame:
    """Notes whose content holds the wikilink ``[[brand]]``."""
    return df.filter(F.col(content).contains(f"[[{brand}]]"))


def replace_link(content, old: str, new) -> Column:
    """``[[old]]`` -> ``[[new]] (via [[old]])`` and ``related_brand: "old"`` ->
    ``related_brand: "new"``."""
    c = F.col(content) if isinstance(content, str) else content
    n = F.col(new) if isinstance(new, str) else new
    c = F.replace(c, F.lit(f"[[{old}]]"), F.concat(F.lit("[["), n, F.lit(f"]] (via [[{old}]])")))
    return F.regexp_replace(c, F.lit(r'related_brand:\s*"' + old.replace("\\", "\\\\") + '"'),
                            F.concat(F.lit('related_brand: "'), n, F.lit('"')))


def retag(notes: DataFrame, generic: str, keywords: DataFrame) -> DataFrame:
    """Q4: notes linked to the generic brand get the first sub-brand whose keyword
    occurs in the lowercase note; the link and property are rewritten. Notes that
    already carry the ``via`` form are left alone (Q12 fix: reruns change nothing)."""
    linked = linked_to(notes, generic).filter(~F.col("content").contains(f"(via [[{generic}]])"))
    m = first_contained(linked, F.col("content"), keywords, out="sub_brand")
    return m.withColumn("new_content", F.when(F.col("sub_brand").isNotNull(),
                                              replace_link("content", generic, F.col("sub_brand"))))


def retag_stats(decisions: DataFrame) -> DataFrame:
    """Re-tagged notes per sub-brand, plus the still-generic count (brand null)."""
    return decisions.groupBy(F.coalesce("sub_brand", F.lit("(still generic)")).alias("brand")) \
        .agg(F.count(F.lit(1)).alias("notes"))

"""Dictionary lookups (J1, J8-J13 style probes, J2/J3 ranked terms).

Dictionaries are inputs (DataFrames). Equi-joins with them are left to the planner, which
broadcasts a side whose size in bytes is known to be small (statically, or at run time
by AQE) and shuffles it otherwise.

The first of many ranked terms that a text contains is found by an index: each term is known by
the rarest of its grams (runs of ``GRAM`` characters, or the whole of a shorter term), texts are
joined with the index on the grams they hold, and only the terms found so are searched in the
text. Nothing is collected, and a text meets the terms of its own grams only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notelake.session import materialise

GRAM = 4
#: Dictionaries of up to so many terms are one array, searched in rank order.
ARRAY_TERMS = 500


def ranked_terms(ranked: DataFrame, term: str, value: str) -> Column:
    """The dictionary as one array in rank order, evaluated once as a scalar subquery:
    ``array<struct<rank, term, value>>`` with lower-case terms."""
    one = F.struct(F.col("rank"), F.lower(F.col(term)).alias("term"), F.col(value).alias("value"))
    return ranked.agg(F.array_sort(F.collect_list(one)).alias("terms")).scalar()


def first_term(text: Column, terms: Column) -> Column:
    """The value of the first of ``terms`` that occurs in ``text``, which is lower-case (null: none)."""
    return F.try_element_at(F.filter(terms, lambda t: F.contains(text, t["term"])), F.lit(1))["value"]


def _grams(text: Column, size: int) -> Column:
    """The distinct runs of ``size`` characters of a text."""
    return F.array(F.lit("")) if size == 0 else F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), 1))


def _term_index(ranked: DataFrame, term: str, value: str) -> DataFrame:
    """``gram, entry`` of each distinct lower-case term: its first entry in rank order and its rarest gram."""
    low = F.lower(F.col(term))
    terms = ranked.filter(low.isNotNull()).groupBy(low.alias("term")).agg(
        F.min(F.struct(F.col("rank"), low.alias("term"), F.col(value).alias("value"))).alias("entry"))
    parts = materialise(terms.select("entry", F.explode(F.when(F.length("term") <= GRAM, F.array("term")).otherwise(_grams(F.col("term"), GRAM)))
                                     .alias("gram")), "terms-grams")
    count = parts.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rarest = parts.join(count, "gram").groupBy("entry").agg(F.min(F.struct("n", "gram")).alias("best"))
    return materialise(rarest.select("entry", F.col("best.gram").alias("gram")), "terms-index")


def first_indexed(df: DataFrame, text: Column, ranked: DataFrame, term: str, value: str, out: str) -> DataFrame:
    """``df`` with the value of the first term in rank order that occurs in ``text`` (lower-case; null: none)."""
    index = _term_index(ranked, term, value)
    rows = materialise(df.select("*", text.alias("_low"), F.monotonically_increasing_id().alias("_rid")), "terms-rows")
    sizes = sorted(r[0] for r in index.select(F.least(F.length("gram"), F.lit(GRAM))).distinct().collect())      # GRAM + 1 at most
    if not sizes:
        return rows.select(*df.columns, F.lit(None).cast(ranked.schema[value].dataType).alias(out))
    held = rows.select("_rid", F.explode(F.flatten(F.array(*[_grams(F.col("_low"), n) for n in sizes]))).alias("gram"))
    found = held.join(index, "gram").groupBy("_rid").agg(F.collect_set("entry").alias("entries"))
    first = rows.select("_rid", "_low").join(found.hint("merge"), "_rid").select(
        "_rid", F.array_min(F.filter("entries", lambda e: F.contains(F.col("_low"), e["term"])))["value"].alias(out))
    return rows.join(first.hint("merge"), "_rid", "left").select(*df.columns, out)

"""Mixing sources to target weights: hierarchical budgeting and seeded epochs.

The sources form a tree domain -> language -> source. A token budget is handed down by
weight; a node can use at most the capacity of its subtree (its tokens times the number of
epochs allowed), so what one child cannot use goes to its siblings, and only what the whole
family cannot use goes to the siblings of the parent. Filling siblings up to their
capacities has a closed form: in order of capacity per weight, a child is full while its
ratio is below the level at which the rest of the budget would fill the rest of the weight.

A leaf then reads its documents in seeded epochs (the order of an epoch is that of the md5
of seed, epoch and id): whole epochs first, then the prefix of the next one whose tokens
fit. The running token count of a leaf is taken over 4,096 slices of the (uniform) md5
space first and inside the one slice where the prefix ends after that, so no task sees a
whole leaf, even one that holds a third of all rows.

The tree has one row per leaf (aggregated map-side); budgets are computed with windows over
the siblings. Defined cases: null domain, language or source are leaves of their own
(``''``); null and empty texts have no tokens and are taken with whole epochs, and once more where
the prefix of the last epoch reaches them; equal ids tie by the md5 of the text, and rows of a
leaf that repeat both are taken or left together; keys without a weight get
``default_weight``; an empty table gives an empty result; other columns are carried
through, whatever their names.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notelake.session import materialise

SLICES = 4096  # three hex digits of the md5


def word_tokens(text: Column) -> Column:
    """Number of whitespace-separated tokens of the whole text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _weight(key: str, weights: Mapping[str, float], default: float) -> Column:
    table = F.from_json(F.lit(json.dumps({k: float(w) for k, w in weights.items()})), "map<string,double>")   # a constant
    return F.coalesce(F.try_element_at(table, F.col(key)), F.lit(float(default)))


def share_out(children: DataFrame, family: list[str]) -> DataFrame:
    """Fill siblings: ``children(family..., weight, cap, given)`` -> the same with ``budget``.

    ``given`` is the parent's budget, on every child; at most the sum of ``cap`` is used."""
    order = [F.col("cap") / F.col("weight"), F.col("cap"), *[F.col(c) for c in children.columns if c not in
                                                            ("weight", "cap", "given", *family)]]
    w = Window.partitionBy(*family).orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    left = w.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("given") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(left)
    ranked = children.withColumn("level", level).withColumn("full", F.col("cap") <= F.col("weight") * F.col("level"))
    # children are full up to some rank; the level rises up to the first that is not, where it
    # holds for the rest, and falls from there on
    rest = F.max(F.when(~F.col("full"), F.col("level"))).over(Window.partitionBy(*family))
    return ranked.withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * rest)) \
        .drop("level", "full", "given")


def leaf_budgets(leaves: DataFrame, budget: float, epochs: int, domain_weights: Mapping[str, float],
                 lang_weights: Mapping[str, float], source_weights: Mapping[str, float],
                 default_weight: float) -> DataFrame:
    """``leaves(domain, lang, source, tokens)`` -> the same with ``budget`` (tokens to take).

    ``budget`` is a multiple of all tokens there are."""
    src = leaves.withColumn("cap", F.col("tokens") * float(epochs)) \
        .withColumn("weight", _weight("source", source_weights, default_weight))
    lang = src.groupBy("domain", "lang").agg(F.sum("cap").alias("cap")) \
        .withColumn("weight", _weight("lang", lang_weights, default_weight))
    dom = lang.groupBy("domain").agg(F.sum("cap").alias("cap")) \
        .withColumn("weight", _weight("domain", domain_weights, default_weight))
    total = dom.agg((F.sum("cap") / epochs * budget).alias("given")).scalar()
    root = dom.withColumns({"given": total, "root": F.lit(1)})
    dom_b = share_out(root, ["root"]).select("domain", F.col("budget").alias("given"))
    lang_b = share_out(lang.join(dom_b, "domain"), ["domain"]).select("domain", "lang", F.col("budget").alias("given"))
    return share_out(src.join(lang_b, ["domain", "lang"]).drop("tokens"), ["domain", "lang"]) \
        .select("domain", "lang", "source", "budget")


def mix_sources(docs: DataFrame, domain: Column, budget: float = 1.0, epochs: int = 2, seed: int = 7,
                domain_weights: Mapping[str, float] | None = None,
                lang_weights: Mapping[str, float] | None = None,
                source_weights: Mapping[str, float] | None = None, default_weight: float = 1.0,
                id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                source_col: str = "source") -> DataFrame:
    """``row`` (the document as a struct), ``domain``, ``n_tokens``, ``copies``: how many
    times the mix takes the document (0: not at all). One row per document."""
    key = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    packed = docs.select(
        F.struct("*").alias("row"), key(domain).alias("domain"), key(F.col(lang_col)).alias("lang"),
        key(F.col(source_col)).alias("source"), word_tokens(F.col(text_col)).alias("n_tokens"),
        F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    leaf = ["domain", "lang", "source"]
    slim = packed.select(*leaf, "n_tokens", "id", F.md5(F.coalesce("text", F.lit(""))).alias("tie"))
    slim = materialise(slim, "mix-tokens")
    leaves = materialise(slim.groupBy(*leaf).agg(F.sum("n_tokens").alias("tokens")), "mix-leaves")
    budgets = materialise(
        leaf_budgets(leaves, budget, epochs, domain_weights or {}, lang_weights or {}, source_weights or {},
                     default_weight).join(leaves, leaf).select(
            *leaf, F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens") + 1e-9))
            .otherwise(epochs).cast("long").alias("whole"),
            F.when(F.col("tokens") > 0, F.col("budget")).otherwise(0.0).alias("budget"), "tokens"), "mix-budgets")
    budgets = budgets.withColumn("rest", F.greatest(F.col("budget") - F.col("whole") * F.col("tokens"), F.lit(0.0)))
    mark = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"),
                             F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("tie")))
    placed = slim.join(budgets, leaf).select(*leaf, "n_tokens", "id", "tie", "whole", "rest", mark.alias("mark")) \
        .withColumn("slice", F.substring("mark", 1, 3))
    sums = materialise(placed.groupBy(*leaf, "slice", "rest").agg(F.sum("n_tokens").alias("t")), "mix-slices")
    ahead = F.sum("t").over(Window.partitionBy(*leaf).orderBy("slice"))
    slices = sums.select(*leaf, "slice", (ahead - F.col("t")).alias("before"), ahead.alias("after"))
    at = placed.join(slices.hint("merge"), [*leaf, "slice"])
    inside = Window.partitionBy(*leaf, "slice").orderBy("mark").rangeBetween(Window.unboundedPreceding, 0)
    edge = at.filter("before < rest AND after > rest") \
        .withColumn("upto", F.col("before") + F.sum("n_tokens").over(inside)) \
        .select(*leaf, "id", "tie", "whole", (F.col("upto") <= F.col("rest")).alias("more"))
    # a slice whose end fits is taken, one that starts beyond the budget is not
    clear = at.filter("NOT (before < rest AND after > rest)") \
        .select(*leaf, "id", "tie", "whole", ((F.col("after") <= F.col("rest")) & (F.col("rest") > 0)).alias("more"))
    names = [f"t_{c}" for c in leaf]
    taken = edge.unionAll(clear).groupBy(*[F.col(c).alias(t) for c, t in zip(leaf, names)], F.col("id").alias("t_id"), F.col("tie").alias("t_tie")) \
        .agg(F.max(F.col("whole") + F.col("more").cast("long")).alias("copies"))
    same = F.col("id").eqNullSafe(F.col("t_id")) & (F.col("tie") == F.col("t_tie"))
    for c, t in zip(leaf, names):
        same = same & (F.col(c) == F.col(t))
    return packed.withColumn("tie", F.md5(F.coalesce("text", F.lit("")))) \
        .join(taken.hint("merge"), same).select("row", *leaf, "n_tokens", "copies")

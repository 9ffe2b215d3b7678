"""Collision-free names.

Rule: in arrival order each item takes ``stem + ext``; if that name is used it takes
``stem + sep + k + ext`` for the smallest k >= 1 not yet used. Used names are the
existing names plus the names given to earlier items.

*Blocks.* The plain stem is number 0. For one stem, the numbers that are used by others are its
blocks, and item i takes the i-th number that is no block: a distributed ordinal and a count of
blocks per stem. Only where the blocks of a stem have gaps are items and blocks ordered together:
put the j-th block k at place ``k - j`` and item i at place ``i``; in that order (blocks first) each
has its own number as its position.

*Stems that meet.* ``a_1`` may be number 1 of stem ``a`` and number 0 of stem ``a_1``, and no other name
belongs to two stems. The first item of the child ``a_1`` asks for it at its own time, which is known;
so number 1 is a block of ``a`` from that time on. Which item of ``a`` comes to number k follows from the
blocks below k; the blocks that count are found as a fixed point over all children at once (each
round settles at least one more child of a stem, and nearly always all of them). A parent whose
item came first leaves the child without its number 0. Children are decided after their parents,
in as many steps as names nest (``a``, ``a_1``, ``a_1_1`` all as stems).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notelake.operators.sequence import ordinal_within, running_sum
from notelake.session import materialise

_STEM = ["_ext", "_stem"]


def split_ext(name) -> tuple[Column, Column]:
    """``os.path.splitext`` on the last path component: ``(stem, ext)``."""
    c = F.col(name) if isinstance(name, str) else name
    ext = F.regexp_extract(c, r"(?<=[^./])(\.[^./]*)$", 1)
    stem = F.substring(c, F.lit(1), F.length(c) - F.length(ext))
    return stem, ext


def _parent(name: str, sep: str) -> tuple[Column, Column]:
    """``(stem, k)`` of a name that is number k >= 1 of another stem; k is null for other names."""
    shape = f"^(?s)(.*){re.escape(sep)}([1-9][0-9]{{0,17}})$"
    return F.regexp_extract(name, shape, 1), F.regexp_extract(name, shape, 2).try_cast("long")


def _existing_blocks(existing: DataFrame, stems: DataFrame, with_ext: bool, sep: str) -> DataFrame:
    """``_ext, _stem, _k`` of the existing names that are numbers of a stem."""
    name = F.col(existing.columns[0])
    stem, ext = split_ext(name) if with_ext else (name, F.lit(""))
    ex = existing.select(ext.alias("_ext"), stem.alias("_stem"))
    parent, k = _parent("_stem", sep)
    both = ex.withColumn("_k", F.lit(0).cast("long")).unionByName(ex.select("_ext", parent.alias("_stem"), k.alias("_k")).filter("_k IS NOT NULL"))
    return both.distinct().join(stems.select(*_STEM), _STEM, "left_semi")


def _settle(kids: DataFrame, blocks: DataFrame, items: DataFrame) -> DataFrame:
    """``kids(_ext, _stem, _k, _asked, _child)`` with ``_got``: whether the child has its name, given the
    other ``blocks`` of the parents."""
    fixed = blocks.join(kids.select(*_STEM).distinct(), _STEM, "left_semi").withColumn("_got", F.lit(True))
    state = materialise(kids.withColumn("_got", F.lit(True)), "names-children")
    while True:
        rows = fixed.unionByName(state, allowMissingColumns=True)
        below = running_sum(rows, _STEM, ["_k"], F.col("_got").cast("long"), "_upto").filter("_child IS NOT NULL")
        at = below.withColumn("_i", F.col("_k") - F.col("_upto") + F.col("_got").cast("long"))
        first = at.join(items.select(*_STEM, "_i", "_at"), [*_STEM, "_i"], "left")
        new = materialise(first.select(*_STEM, "_k", "_asked", "_child", F.col("_got").alias("_old"),
                                       (F.col("_at").isNull() | (F.col("_asked") < F.col("_at"))).alias("_got")), "names-children")
        state = new.drop("_old")
        if new.filter("_old <> _got").isEmpty():
            return state


def _blocks(items: DataFrame, existing: DataFrame | None, with_ext: bool, sep: str) -> DataFrame:
    """``_ext, _stem, _k``: the numbers of each stem that its items cannot take."""
    stems = materialise(items.groupBy(*_STEM).agg(F.min("_at").alias("_asked")), "names-stems")
    none = stems.limit(0).select(*_STEM, F.lit(0).cast("long").alias("_k"))
    blocks = none if existing is None else materialise(_existing_blocks(existing, stems, with_ext, sep), "names-existing")
    parent, k = _parent("_stem", sep)
    kids = stems.select("_ext", parent.alias("_stem"), k.alias("_k"), "_asked", F.col("_stem").alias("_child")).filter("_k IS NOT NULL") \
        .join(stems.select(*_STEM), _STEM, "left_semi").join(blocks, [*_STEM, "_k"], "left_anti")
    kids = materialise(kids, "names-children")
    if kids.isEmpty():
        return blocks
    some = materialise(items.join(kids.select(*_STEM).distinct(), _STEM, "left_semi"), "names-contested")
    while not kids.isEmpty():
        undecided = kids.select("_ext", F.col("_child").alias("_stem"))
        ready = materialise(kids.join(undecided, _STEM, "left_anti"), "names-ready")
        settled = _settle(ready, blocks, some)
        blocks = materialise(blocks.unionByName(settled.filter("_got").select(*_STEM, "_k")).unionByName(
            settled.filter("NOT _got").select("_ext", F.col("_child").alias("_stem"), F.lit(0).cast("long").alias("_k"))), "names-blocks")
        kids = materialise(kids.join(ready.select("_ext", "_child"), ["_ext", "_child"], "left_anti"), "names-children")
    return blocks


def assign_unique_names(df: DataFrame, stem: str, order: Sequence[str], ext: str | None = None,
                        existing: DataFrame | None = None, sep: str = "_",
                        id_col: str = "_row_id", out: str = "unique_name") -> DataFrame:
    """Add ``out`` to ``df`` following the W1 rule.

    ``stem``/``ext`` name columns of ``df`` (``ext`` optional, e.g. ``.pdf``); without
    ``ext`` the whole name is the stem, dots included. ``order`` gives arrival order and must
    be unique; ``id_col`` names a unique column (any type; without one, ``order`` is the key); a key
    that repeats is an error, as its rows could not be told apart. ``existing`` is a one-column
    DataFrame of names already in use (full names, extension included). Input column names must
    not start with an underscore.
    """
    ident = F.col(id_col) if id_col in df.columns else F.struct(*[F.col(o) for o in order])
    ocols = [F.col(o).alias(f"_o{i:02d}") for i, o in enumerate(order)]
    items = df.select(ident.alias("_id"), F.col(stem).alias("_stem"), (F.col(ext) if ext else F.lit("")).alias("_ext"), F.struct(*ocols).alias("_at"))
    items = materialise(ordinal_within(items, _STEM, ["_at", "_id"], out="_i"), "names-items")
    if not items.groupBy("_id").count().filter("count > 1").isEmpty():
        raise ValueError("the key of the items to name is not unique")
    blocks = _blocks(items, existing, ext is not None, sep)
    per = blocks.groupBy(*_STEM).agg(F.count(F.lit(1)).alias("_m"), F.max("_k").alias("_last"))
    counted = items.join(per, _STEM, "left")
    plain = counted.filter("_m IS NULL OR _last = _m - 1").select("_id", *_STEM, (F.col("_i") + F.coalesce("_m", F.lit(0))).alias("_n"))

    # stems whose blocks have gaps
    gaps = per.filter("_last <> _m - 1").select(*_STEM)
    nth = ordinal_within(blocks.join(gaps, _STEM, "left_semi"), _STEM, ["_k"], out="_j")
    places = counted.filter("_last <> _m - 1").select(*_STEM, "_id", F.col("_i").alias("_place"), F.lit(1).alias("_item")).unionByName(
        nth.select(*_STEM, (F.col("_k") - F.col("_j")).alias("_place"), F.lit(0).alias("_item"), "_k"), allowMissingColumns=True)
    merged = ordinal_within(places, _STEM, ["_place", "_item", "_k"], out="_n").filter("_item = 1").select("_id", *_STEM, "_n")
    named = plain.unionByName(merged).select("_id", F.when(F.col("_n") == 0, F.concat("_stem", "_ext")).otherwise(
        F.concat("_stem", F.lit(sep), F.col("_n").cast("string"), "_ext")).alias(out))
    return df.withColumn("_id", ident).join(named, "_id", "left").drop("_id")

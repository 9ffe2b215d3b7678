"""Document fingerprints by a homomorphic multiset hash (DataFrame functions only).

Each paragraph is hashed to a wide vector of 126 lanes, 0 or 1 each; the fingerprint of a
text is the lane-wise sum over its paragraphs, modulo 2**20, and the number of paragraphs.
So it depends on the multiset of paragraphs and not on their order; adding a paragraph adds
its vector, deleting one subtracts it (``insert``, ``delete``). Texts with different
multisets have equal fingerprints with a probability of about 2**-126 for one changed
paragraph.

Lanes centred by the number of paragraphs are a random projection of the multiset, so their
cosine estimates how much of it two texts share (``likeness``; standard error 0.09 for texts
that share nothing).

A paragraph here is a line, or a sentence where a line has several: the pieces between
``PARAGRAPH`` matches that are not empty.

Three lanes are kept in one long (20 bits and a guard bit each), 42 longs in all: lane
sums are then long additions, and the guard bits take the carries.

Defined cases: null text counts as empty; a text without paragraphs has the zero
fingerprint, likeness 1 with another such text and 0 with any other; an empty table gives
an empty result; documents of equal id follow each other in the order of their text's hash,
null ids come first; repeated rows are neighbours of each other; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notelake.llm.common import LEAST, full_text, range_of, split_points
from notelake.session import materialise

PARAGRAPH = r"\n+|(?<=[.!?])[ \t]+"
WORDS = 2                                                        # 64-bit hashes of a paragraph
PER_WORD = 21                                                    # longs that take the bits of one hash
ONES = 1 | 1 << 21 | 1 << 42                                     # lowest bit of each lane
LANE = (1 << 20) - 1
KEEP = LANE * ONES                                               # all lanes without guard bits
GUARD = (1 << 20) * ONES


def paragraphs(text: Column, pattern: str = PARAGRAPH) -> Column:
    return F.filter(F.split(text, pattern, -1), lambda p: p != "")


def with_fingerprint(df: DataFrame, text: Column, out: str, pattern: str = PARAGRAPH) -> DataFrame:
    """``df`` with ``out``: an array of 43 longs, the number of paragraphs and the lanes."""
    names = [f"{out}_hash{k}" for k in range(1, WORDS + 1)]
    # the hashes are a projection of their own: each is used many times, so Spark keeps it so
    hashed = df.select("*", paragraphs(text, pattern).alias(f"{out}_parts")).select(
        *df.columns, *[F.transform(f"{out}_parts", _salted(k)).alias(n) for k, n in enumerate(names, 1)])
    lanes = [F.aggregate(n, F.lit(0).cast("long"), _add_lanes(i)) for n in names for i in range(PER_WORD)]
    return hashed.select(*df.columns, F.array(F.size(names[0]).cast("long"), *lanes).alias(out))


def _salted(k: int):
    return lambda p: F.xxhash64(F.lit(k), p)


def _add_lanes(i: int):
    """Add the bits i, i + 21 and i + 42 of a hash to three lanes, each modulo 2**20."""
    return lambda a, x: (a + F.shiftrightunsigned(x, i).bitwiseAND(F.lit(ONES))).bitwiseAND(F.lit(KEEP))


def insert(fp: Column, other: Column) -> Column:
    """The fingerprint after the paragraphs of ``other`` are added."""
    return F.zip_with(fp, other, lambda a, b: (a + b).bitwiseAND(F.lit(KEEP)))


def delete(fp: Column, other: Column) -> Column:
    """The fingerprint after the paragraphs of ``other`` are taken out."""
    return F.zip_with(fp, other, lambda a, b: (a.bitwiseOR(F.lit(GUARD)) - b).bitwiseAND(F.lit(KEEP)))


def to_text(fp: Column) -> Column:
    return F.lower(F.array_join(F.transform(fp, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def centred(fp: Column) -> Column:
    """The 126 lanes as doubles, ``2 * lane - paragraphs``: their mean over texts is zero."""
    n = F.get(fp, F.lit(0))
    lane = lambda k: F.transform(F.slice(fp, 2, WORDS * PER_WORD), lambda x: (
        F.shiftright(x, 21 * k).bitwiseAND(F.lit(LANE)) * 2 - n).cast("double"))
    return F.concat(lane(0), lane(1), lane(2))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def likeness(equal: Column, a: Column, b: Column) -> Column:
    """0 to 1: cosine of centred lanes, 1 for equal fingerprints, 0 for a zero one."""
    norm = F.sqrt(_dot(a, a) * _dot(b, b))
    return F.when(equal, F.lit(1.0)).when(norm == 0, F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), _dot(a, b) / norm)))


def with_next(rows: DataFrame, value: str, made: Callable[[DataFrame], DataFrame] = lambda df: df, rows_per_bucket: int = 1024,
              max_buckets: int = 65_536) -> DataFrame:
    """``rows(id, tie, ...)`` with the columns that ``made`` adds, ``value`` among them, and ``next``: the
    value of the row that follows in the order (id, tie); after the last comes the first.

    Rows are put in ranges of (id, tie) that hold about as many rows each (split points from the
    ids alone, some ``max_buckets`` at most); ``lead`` runs inside a range, and the first row of the
    range that follows stands at its end as a guest. Only that is one row per range; guests are
    chosen before ``made`` works on them."""
    n = rows.select("id").count()
    points = split_points(rows, "id", min(max_buckets, -(-n // rows_per_bucket)))
    key = F.coalesce("id", F.lit(LEAST))
    put = rows.withColumn("bucket", range_of(F.col("id"), F.col("tie"), points))
    order = Window.orderBy("bucket")   # one row per range
    firsts = materialise(put.groupBy("bucket").agg(F.min(F.struct(key.alias("id"), "tie")).alias("first")), "range-firsts")
    last = F.max("bucket").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    guests = firsts.select(F.col("first.id").alias("f_id"), F.col("first.tie").alias("f_tie"),
                           F.coalesce(F.lag("bucket").over(order), last).alias("f_bucket"))
    guest_rows = made(rows.join(F.broadcast(guests), (key == F.col("f_id")) & (F.col("tie") == F.col("f_tie")))
                      .withColumn("bucket", F.col("f_bucket")).select(*rows.columns, "bucket", F.lit(1).alias("guest")))
    w = Window.partitionBy("bucket").orderBy("guest", key, "tie")
    return made(put.select(*rows.columns, "bucket", F.lit(0).alias("guest"))).unionByName(guest_rows) \
        .withColumn("next", F.lead(value).over(w)).filter("guest = 0").drop("guest", "bucket")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text (the last half replaced by as many
    first characters of the next document): ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``."""
    texts = docs.select(F.col(id_col).alias("id"), full_text(text_col).alias("text"))
    rows = texts.select("id", F.xxhash64("text").alias("tie"), "text")
    made = lambda df: with_fingerprint(df, F.col("text"), "fp").withColumn("doc", F.struct("text", "fp")).drop("text", "fp")
    n = F.length("doc.text")
    half = F.shiftright(n, 1)
    paired = with_next(rows, "doc", made).select(
        "id", n.alias("n"), "doc.fp", F.col("next.fp").alias("next_fp"),
        F.concat(F.substring("doc.text", F.lit(1), n - half), F.substring("next.text", F.lit(1), half)).alias("edited"))
    both = with_fingerprint(paired.withColumn("sha", F.sha2("edited", 256)), F.col("edited"), "edited_fp")
    vectors = both.drop("edited").select("*", *[centred(F.col(c)).alias(f"v_{c}") for c in ("fp", "next_fp", "edited_fp")])
    return vectors.select(
        F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_chars"), F.col("sha").alias("edited_sha256"),
        to_text(F.col("fp")).alias("fingerprint"), to_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp") == F.col("edited_fp"), F.col("v_fp"), F.col("v_edited_fp")).alias("near_edited"),
        likeness(F.col("fp") == F.col("next_fp"), F.col("v_fp"), F.col("v_next_fp")).alias("near_next"))

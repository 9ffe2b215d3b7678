"""Hard-negative mining by a secondary-sort shuffle.

Every anchor is scored against every row, in blocks: rows and anchors are dealt to blocks of a
bounded number of components, and a task scores one anchor block against one row block as a
product of whole-number matrices. Of the pairs of a block only those that can be among the
results leave it (a combine before the shuffle): for an anchor, its best ``positives`` rows of
the same label; then, once its positives and so its score windows are known, the best
``negatives`` rows of another label in each window. The rest is one secondary sort: pairs are
dealt by anchor and sorted within the partition by the packed key (anchor, descending score,
positives first, id), and an iterator reads the sorted rows once. A positive opens a window; a
negative is emitted for each open window that it falls into; a window that has its negatives,
or whose lower end has been passed, is closed. No anchor is held in memory: the state of the
iterator is the open windows of one anchor.

Scores are whole numbers, exact at any size of the components: a product that could leave the
53 bits of a double is computed with Python's integers, and a score beyond 64 bits counts as
the nearest 64-bit number.

Defined cases: a row with a null label, a null vector, or a null or non-finite component takes
no part; a null id is never an anchor, takes its label as it is, and comes after all other ids
of equal score; rows that repeat an id are rows of their own (each an anchor, and each other's
positives or negatives); vectors of different lengths have no inner product and are never
paired; empty vectors have the product 0; a window of a negative positive score is empty; an
anchor without positives has no rows; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notelake.session import materialise

BLOCK_VALUES = 1 << 20       # components of a block of rows or of anchors
LEAST_ROWS = 256             # a row block of fewer rows is not worth a task
_MAX = (1 << 63) - 1
PAIR = "arow long, score long, negative boolean, id long, row long"


def whole_vectors(vectors: DataFrame, scale: int, anchor_every: int, relabel_every: int, labels: int,
                  id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """``row`` (unique), ``id``, ``label``, ``vec`` (floor of the scaled components, as doubles) and
    ``anchor`` of the rows that take part."""
    id_, label, vec = F.col(id_col).cast("long"), F.col(label_col).cast("long"), F.col(vec_col).cast("array<double>")
    odd = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    new = F.when(F.coalesce(F.col("id") % relabel_every == 0, F.lit(False)), (F.col("label") + 1) % labels) \
        .otherwise(F.col("label"))
    return vectors.select(id_.alias("id"), label.alias("label"), vec.alias("vec")) \
        .filter(F.col("label").isNotNull() & F.col("vec").isNotNull()).filter(~odd) \
        .select(F.monotonically_increasing_id().alias("row"), "id", new.alias("label"),
                F.transform("vec", lambda x: _floor(x * float(scale))).alias("vec"),
                F.coalesce(F.col("id") % anchor_every == 0, F.lit(False)).alias("anchor"))


def _floor(x: Column) -> Column:
    """Floor as a double; doubles from 2**53 on are whole numbers, and ``floor`` would not hold them."""
    return F.when(F.abs(x) < float(1 << 53), F.floor(x).cast("double")).otherwise(x)


def _matrix(t: pa.Table, at: np.ndarray) -> np.ndarray:
    lists = t.column("vec").combine_chunks().take(pa.array(at))
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` with those of ``b`` as 64-bit integers."""
    if not a.shape[1]:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    if len(a) and len(b) and np.abs(a).max() * np.abs(b).max() * a.shape[1] >= float(1 << 53):
        x, y = ([[int(v) for v in r] for r in m] for m in (a, b))   # Python's integers: any size
        return np.array([[max(-_MAX, min(_MAX, sum(map(int.__mul__, p, q)))) for q in y] for p in x], dtype=np.int64)
    return (a @ b.T).astype(np.int64)


def _by_length(anchors: pa.Table, rows: pa.Table) -> Iterator[tuple]:
    """Of each vector length: (anchor positions, row positions, products); rows in order of id."""
    if not anchors.num_rows or not rows.num_rows:
        return
    na, nr = (t.column("vec").combine_chunks().value_lengths().to_numpy() for t in (anchors, rows))
    rid = rows.column("id").combine_chunks()
    no_id, num = rid.is_null().to_numpy(zero_copy_only=False), rid.fill_null(0).to_numpy()
    order = np.lexsort((rows.column("row").to_numpy(), num, no_id))
    for n in np.intersect1d(na, nr):
        i, j = np.flatnonzero(na == n), order[nr[order] == n]
        right = _matrix(rows, j)
        step = max(1, (1 << 22) // len(j))
        for at in range(0, len(i), step):
            yield i[at:at + step], j, scores(_matrix(anchors, i[at:at + step]), right)


def _pairs(found: list[tuple], rows: pa.Table, negative: bool) -> pa.Table:
    """``PAIR`` rows from (anchor row, row positions, scores)."""
    n = [len(at) for _, at, _ in found]
    at = np.concatenate([np.zeros(0, np.int64), *[x for _, x, _ in found]])
    return pa.table({
        "arow": pa.array(np.repeat(np.array([a for a, _, _ in found], dtype=np.int64), n)),
        "score": pa.array(np.concatenate([np.zeros(0, np.int64), *[s for _, _, s in found]])),
        "negative": pa.array(np.full(len(at), negative)),
        "id": rows.column("id").combine_chunks().take(pa.array(at)).cast(pa.int64()),
        "row": rows.column("row").combine_chunks().take(pa.array(at)).cast(pa.int64())})


def _best_positives(k: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        found = []
        al, rl = anchors.column("label").to_numpy(), rows.column("label").to_numpy()
        ar, rr = anchors.column("row").to_numpy(), rows.column("row").to_numpy()
        for i, j, s in _by_length(anchors, rows):
            for label in np.intersect1d(al[i], rl[j]):
                own = j[rl[j] == label]
                part = s[:, rl[j] == label]
                for x in np.flatnonzero(al[i] == label):
                    order = np.argsort(-part[x], kind="stable")[:k + 1]   # ties: by id, as the rows are
                    order = order[rr[own[order]] != ar[i[x]]][:k]
                    found.append((ar[i[x]], own[order], part[x][order]))
        return _pairs(found, rows, False)
    return run


def window_ends(p: int, low: int, high: int, per: int) -> tuple[int, int]:
    """The least and the greatest whole score s with low * p <= per * s <= high * p."""
    return -(-low * p // per), high * p // per


def _best_negatives(k: int, low: int, high: int, per: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        found = []
        al, rl = anchors.column("label").to_numpy(), rows.column("label").to_numpy()
        ar = anchors.column("row").to_numpy()
        windows = anchors.column("positive_scores").to_pylist()
        for i, j, s in _by_length(anchors, rows):
            for x, a in enumerate(i):
                other = np.flatnonzero(rl[j] != al[a])
                order = other[np.argsort(-s[x][other], kind="stable")]
                falling = -s[x][order]
                take = set()
                for p in windows[a]:
                    lo, hi = window_ends(p, low, high, per)
                    first, end = np.searchsorted(falling, -hi, "left"), np.searchsorted(falling, -lo, "right")
                    take.update(range(first, min(first + k, end)))
                at = order[sorted(take)]
                found.append((ar[a], j[at], s[x][at]))
        return _pairs(found, rows, True)
    return run


def _stream(k: int, low: int, high: int, per: int):
    """Reads pairs sorted by (anchor, descending score, positives first, id); yields the negatives."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, windows = None, []
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out)) or [()] * 6
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n == "rank" else pa.int64()) for c, n in zip(cols, names)],
                                              names=names)

        names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        for rb in batches:
            for arow, anchor_id, score, negative, id_ in zip(*[rb.column(c).to_pylist() for c in range(5)]):
                if arow != anchor:
                    anchor, windows = arow, []
                if not negative:
                    windows.append([*window_ends(score, low, high, per), id_, score, 0])
                    continue
                for w in windows:
                    if w[0] <= score <= w[1]:
                        w[4] += 1
                        out.append((anchor_id, w[2], w[4], id_, w[3], score))
                windows = [w for w in windows if w[4] < k and w[0] <= score]
                if len(out) >= 10_000:
                    yield flush()
        if out:
            yield flush()
    return run


def hard_negatives(vectors: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, per: int = 100,
                   scale: int = 256, anchor_every: int = 50, relabel_every: int = 7, labels: int = 10,
                   id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                   block_values: int = BLOCK_VALUES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for each anchor
    and each of its first ``positives`` rows of the same label, the first ``negatives`` rows of
    another label with ``low * positive_score <= per * negative_score <= high * positive_score``.
    A component becomes floor(scale * x); anchors are the ids divisible by ``anchor_every``; labels of
    ids divisible by ``relabel_every`` become (label + 1) % labels."""
    spark = vectors.sparkSession
    table = materialise(whole_vectors(vectors, scale, anchor_every, relabel_every, labels, id_col, vec_col, label_col),
                        "negatives-vectors")
    size = table.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("vec") + 1).alias("values"),
                     F.count_if("anchor").alias("anchors"), F.sum(F.when(F.col("anchor"), F.size("vec") + 1)).alias("held")).first()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rblocks = max(-(-(size["values"] or 0) // block_values), min(tasks, -(-size["rows"] // LEAST_ROWS)), 1)
    ablocks = max(-(-(size["held"] or 0) // block_values), 1)

    # blocks by a hash of the row number; rows meet each block of anchors, anchors each block of rows
    rows = table.select("row", "id", "label", "vec", F.pmod(F.xxhash64("row"), F.lit(rblocks)).alias("rb"),
                        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(ablocks - 1).cast("long"))).alias("ab"))
    anchors = materialise(table.filter("anchor").select("row", "id", "label", "vec"), "negatives-anchors")
    dealt = anchors.select("row", "label", "vec", F.pmod(F.xxhash64("row"), F.lit(ablocks)).alias("ab"))
    spread = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(rblocks - 1).cast("long"))).alias("rb")

    def in_blocks(left: DataFrame, fn) -> DataFrame:
        return left.select("*", spread).groupBy("ab", "rb").cogroup(rows.groupBy("ab", "rb")).applyInArrow(fn, PAIR)

    best = Window.partitionBy("arow").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "row")
    firsts = in_blocks(dealt, _best_positives(positives)).withColumn("r", F.row_number().over(best)) \
        .filter(F.col("r") <= positives).drop("r")
    firsts = materialise(firsts, "negatives-positives")
    opened = firsts.groupBy(F.col("arow").alias("row")).agg(F.collect_list("score").alias("positive_scores"))   # at most ``positives``
    seconds = in_blocks(dealt.join(opened, "row"), _best_negatives(negatives, low, high, per))
    pairs = firsts.unionByName(seconds).join(
        anchors.select(F.col("row").alias("arow"), F.col("id").alias("anchor_id")).hint("merge"), "arow")
    return pairs.repartition(F.col("arow")) \
        .sortWithinPartitions("arow", F.desc("score"), "negative", F.col("id").asc_nulls_last(), "row") \
        .select("arow", "anchor_id", "score", "negative", "id") \
        .mapInArrow(_stream(negatives, low, high, per),
                    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")

"""N-gram Jaccard join by grouped prefixes, and the classes of its links.

A document is the set of its distinct n-word shingles (64-bit hashes; the order of a set
is by corpus frequency, then hash). Documents of equal sets are one *class* from the start.
Two sets of Jaccard similarity t or more share a shingle within their prefixes (the first
``size - ceil(t * size) + 1`` shingles). Classes of identical prefix and size are collapsed
into one *group*, so the prefix join works on groups; group pairs are filtered by size and
then expanded to member classes, which are filtered by parity bitmaps and verified on the
whole sets.

*Order.* Any total order gives the same links; frequent shingles last make short posting
lists. All shingles of the corpus are counted (sorted, delta-packed runs by hash range, one
run per task and range, so the shuffle holds about three bytes per distinct shingle of a task).
A bitmap of those that repeat and the ``heavy`` most frequent ones, broadcasts of a fixed size,
place single ones first and frequent ones last. A shingle that the bitmap tells to be single
has no partner, so only the others of a prefix enter posting lists.

*Parity bitmap.* Bit b of a set's bitmap is the parity of the number of its shingles that
hash to b. The number of bits in which two bitmaps differ is at most the size of the
symmetric difference, so the filter drops no link.

*No all-pairs output.* Links only matter through the classes they join. First every
group of a posting list, and every member of a group, is compared with the first one of it
(a star: as many rows as the list has entries). Then the lists are joined with themselves
for pairs that are not yet connected, under the bitmap filter; within a component nothing
is left to compare, so a group of thousands of near copies yields no quadratic output, and
every pair that could connect two components is verified. Hot lists are plain shuffle joins
that AQE splits; bitmaps travel only with entries of lists that have a second entry.

*Components* are found by min-label propagation with pointer jumping over (class, class)
edges, as tables in the shared folder; nothing of it passes the driver but the number of
changes of a round.

Defined cases: null and empty text has no shingle, is linked with nothing, and is its own
component; a text of fewer words than a shingle has its whole word sequence as one shingle;
repeated rows are equal documents; a null id counts as larger than any other (a component
of null ids alone has a null id); an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notelake.session import materialise

BITMAP = 16                     # longs of the parity bitmap
HEAVY = 1 << 19                 # shingles placed last by their counts
KEY = 40                        # bits of a hash by which shingles are counted and ordered
SIEVE_BITS = 27                 # bitmap of repeated shingles
NO_ID = (1 << 63) - 1           # stands for a null id
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
KEY_BITS = 24                   # bitmap of the documents whose sets are read again


class _WordHashes(dict):
    """Word -> 64-bit hash, remembered by this worker (a memory, not a limit)."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 150_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_HASH_OF = _WordHashes().__getitem__


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _M2
    h = (h ^ (h >> np.uint64(29))) * _M1
    return h ^ (h >> np.uint64(32))


def shingle_set(text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of the whole text (UTF-8). On bytes,
    ``lower`` changes A-Z only and ``split`` parts at space and 0x09-0x0D only."""
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(_HASH_OF, words), dtype=np.uint64, count=len(words))
    n = max(1, len(h) - width + 1)
    out = np.full(n, np.uint64(min(len(h), width)), dtype=np.uint64)
    for k in range(min(width, len(h))):
        out = _mix(out * _M1 + h[k:k + n])
    out.sort()
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


def prefix_size(n: np.ndarray | int, num: int, den: int):
    """``n - ceil(n * num / den) + 1``: sets of that similarity share one of their prefixes."""
    return n - (n * num + den - 1) // den + 1


def parity_bitmap(s: np.ndarray) -> np.ndarray:
    bits = BITMAP * 64
    odd = np.bincount((s >> np.uint64(20)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def pack_sorted(x: np.ndarray) -> bytes:
    """Ascending unsigned 32-bit numbers as compressed differences (the low bits of a hash that
    remain are enough to tell frequent shingles apart)."""
    gaps = np.diff(x, prepend=np.uint32(0)).astype("<u4")
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 4).T).tobytes())


def unpack_sorted(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    gaps = np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4")
    return np.cumsum(gaps.ravel(), dtype=np.uint32)


def range_bits(documents: int) -> int:
    """The count is dealt to ``2 ** bits`` hash ranges, so that each holds the shingles of about
    2,000 documents."""
    return min(20, max(8, (documents // 2000).bit_length()))


def _runs(width: int, bits: int):
    """Map texts to (hash range, sorted distinct hashes of the task in that range, counts)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            u, c = np.unique(np.concatenate(held), return_counts=True)
            cuts = np.searchsorted(u, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
            low = ((u >> np.uint64(64 - KEY)) & np.uint64((1 << (KEY - bits)) - 1)).astype("<u4")
            return pa.RecordBatch.from_arrays([
                pa.array(np.arange(1 << bits), pa.int32()), pa.array([pack_sorted(x) for x in np.split(low, cuts)], pa.binary()),
                pa.array([np.minimum(x, 0xFFFF).astype("<u2").tobytes() if (x > 1).any() else b"" for x in np.split(c, cuts)],
                         pa.binary())], names=["part", "hashes", "counts"])

        for rb in batches:
            for t in rb.column(0).to_pylist():
                s = shingle_set(t, width)
                held.append(s)
                size += len(s)
                if size >= max(1 << 20, 64 << bits):
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()
    return run


def _merge_runs(per_part: int, range_bits: int):
    """Of one hash range: a bitmap of the shingles that occur more than once (compressed, as it
    passes the driver), and the most frequent ones with their counts."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        h = [unpack_sorted(x) for x in pdf["hashes"]]
        c = [np.frombuffer(x, dtype="<u2").astype(np.int64) if x else np.ones(len(y), dtype=np.int64) for x, y in zip(pdf["counts"], h)]
        u, at = np.unique(np.concatenate(h), return_inverse=True)
        n = np.bincount(at, weights=np.concatenate(c)).astype(np.int64)
        bits = np.zeros(1 << (SIEVE_BITS - range_bits), dtype=bool)
        bits[u[n > 1] & np.uint32(len(bits) - 1)] = True
        top = np.flatnonzero(n > 2)
        if len(top) > per_part:
            top = top[np.argpartition(-n[top], per_part - 1)[:per_part]]
        part = int(pdf["part"].iloc[0])
        full = (np.uint64(part) << np.uint64(KEY - range_bits)) | u[top].astype(np.uint64)
        packed = zstandard.ZstdCompressor(level=1).compress(np.packbits(bits, bitorder="little").tobytes())
        return pd.DataFrame({"part": [part], "repeated": [packed],
                             "hash": [full.astype("<u8").tobytes()], "n": [n[top].astype("<i8").tobytes()]})
    return run


def shingle_order(docs: DataFrame, width: int, heavy: int = HEAVY) -> Order:
    """The order of the corpus; every shingle is counted. What comes to the driver has the size of
    ``Order`` at any size of the corpus."""
    bits = range_bits(docs.select("hash").count())
    runs = docs.select(F.col("text").cast("binary")).mapInArrow(_runs(width, bits), "part int, hashes binary, counts binary")
    merged = runs.groupBy("part").applyInPandas(_merge_runs(max(1, heavy >> bits), bits), "part int, repeated binary, hash binary, n binary")
    sieve: dict[int, bytes] = {}
    h, n = [np.zeros(0, "<u8")], [np.zeros(0, "<i8")]
    for r in materialise(merged, "jaccard-order").toLocalIterator():   # a partition at a time
        sieve[r["part"]] = bytes(r["repeated"])
        h.append(np.frombuffer(r["hash"], "<u8"))
        n.append(np.frombuffer(r["n"], "<i8"))
    h, n = np.concatenate(h), np.concatenate(n)
    by_hash = np.argsort(h)
    return Order(sieve, bits, h[by_hash], n[by_hash])


class Order:
    """The order of the shingles of a set: those that the corpus has once, by hash; then others;
    then the most frequent ones by count and hash. A bitmap of 2**27 bits (16 MB) tells the
    first from the others; where it fills up, it tells fewer, and the order is worse but still
    one order for all sets. The frequent ones are at most ``HEAVY`` hashes with counts (8 MB).
    On the driver and on the way to the tasks the bitmap is compressed by hash range."""

    def __init__(self, sieve: dict[int, bytes], bits: int, heavy: np.ndarray, counts: np.ndarray):
        self.sieve, self.bits, self.heavy, self.counts = sieve, bits, heavy, counts

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        sieve = np.zeros((1 << self.bits, 1 << (SIEVE_BITS - 3 - self.bits)), dtype=np.uint8)
        for part, packed in self.sieve.items():
            sieve[part] = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
        self.sieve = sieve.ravel()

    def prefix(self, s: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the first ``size`` shingles of a sorted set those that the corpus has once, and the
        others, each in order of hash. Only the others can be shared with another set."""
        if not size:
            return s[:0], s[:0]
        key = s >> np.uint64(64 - KEY)
        low = SIEVE_BITS - self.bits
        at = ((key >> np.uint64(KEY - self.bits)) << np.uint64(low)) | (key & np.uint64((1 << low) - 1))
        again = (self.sieve[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        single = s[~again][:size]
        if len(single) == size:
            return single, s[:0]
        other = s[again]
        count = np.zeros(len(other), dtype=np.int64)
        if len(self.heavy):
            k = key[again]
            i = np.minimum(np.searchsorted(self.heavy, k), len(self.heavy) - 1)
            count = np.where(self.heavy[i] == k, self.counts[i], 0)
        return single, np.sort(other[np.lexsort((other, count))][:size - len(single)])


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *arrays])))


def _signatures(width: int, num: int, den: int, shared):
    """Map (id, text) to (id, size, set digest, prefix, prefix digest, bitmap)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shared.value
        for big in batches:
            for at in range(0, big.num_rows, 1000):
                rb = big.slice(at, 1000)
                size, digest, prefix, group, bits = [], [], [], [], []
                for t in rb.column(1).to_pylist():
                    s = shingle_set(t, width)
                    size.append(len(s))
                    digest.append(xxhash.xxh3_128_digest(s))
                    single, shared_ones = order.prefix(s, prefix_size(len(s), num, den) if len(s) else 0)
                    prefix.append(shared_ones.view(np.int64))
                    group.append(xxhash.xxh3_128_digest(np.concatenate([single, shared_ones])))
                    bits.append(parity_bitmap(s))
                yield pa.RecordBatch.from_arrays([
                    rb.column(0), pa.array(size, pa.int64()), pa.array(digest, pa.binary()), _lists(prefix),
                    pa.array(group, pa.binary()), _lists(bits)],
                    names=["id", "size", "digest", "prefix", "prefix_digest", "bits"])
    return run


def _overlap_ok(a: str, b: str, num: int, den: int) -> Column:
    """Sizes and bitmaps of two entries allow similarity num/den."""
    sa, sb = F.col(f"{a}.size"), F.col(f"{b}.size")
    differ = sum((F.bit_count(F.col(f"{a}.b{i}").bitwiseXOR(F.col(f"{b}.b{i}"))) for i in range(BITMAP)), F.lit(0))
    return (F.least(sa, sb) * den >= F.greatest(sa, sb) * num) & (differ * (num + den) <= (sa + sb) * (den - num))


def _verify(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose whole sets reach the similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 200):
                rb = big.slice(at, 200)
                keep = []
                for x, y in zip(rb.column(2), rb.column(3)):
                    p, q = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                    both = np.concatenate([p, q])
                    both.sort()
                    shared = int((both[1:] == both[:-1]).sum())
                    keep.append(den * shared >= num * (len(both) - shared))
                yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "x", "y")
    return both.mapInArrow(run, "a long, b long")


def _document_key() -> Column:
    return F.xxhash64("idk", "hash").bitwiseAND(F.lit((1 << KEY_BITS) - 1))


def _sets_of(wanted: DataFrame, members: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """``cls, shingles``: whole sets of the classes in ``wanted(cls)``, from one text each.

    Only texts whose key is in a bitmap of the wanted documents (a broadcast of 2 MB at any
    size) are made to sets and shuffled; the join decides."""
    some = materialise(members.join(wanted.distinct().hint("merge"), "cls").select("cls", "idk", "hash"), "jaccard-wanted")
    words = some.select(_document_key().alias("k")).groupBy(F.shiftright("k", 6).alias("w")) \
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(k & 63 AS INT))")).alias("bits")).toArrow()   # 2**18 rows at most, 16 bytes each
    table = np.zeros(1 << (KEY_BITS - 6), dtype=np.uint64)
    table[words["w"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            k = big.column(0).to_numpy().astype(np.uint64)
            hit = np.flatnonzero(shared.value[(k >> np.uint64(6)).astype(np.int64)] >> (k & np.uint64(63)) & np.uint64(1))
            for at in range(0, len(hit), 500):
                rb = big.take(pa.array(hit[at:at + 500]))
                yield pa.RecordBatch.from_arrays(
                    [rb.column(1), rb.column(2), pa.array([shingle_set(t, width).astype("<u8").tobytes() for t in rb.column(3).to_pylist()],
                                                          pa.binary())], names=["idk", "hash", "shingles"])

    sets = docs.select(_document_key().alias("k"), "idk", "hash", F.col("text").cast("binary").alias("text")) \
        .mapInArrow(run, "idk long, hash long, shingles binary")
    return sets.join(some.hint("merge"), ["idk", "hash"]).dropDuplicates(["cls"]).select("cls", "shingles")


def components(edges: DataFrame) -> DataFrame:
    """``node, label``: the smallest node of each component of ``edges(a, b)``; nodes without
    an edge are not listed. Min-label propagation with pointer jumping."""
    both = materialise(edges.filter("a <> b").select("a", "b").unionAll(
        edges.filter("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-edges")
    if both.isEmpty():
        return both.select(F.col("a").alias("node"), F.col("b").alias("label"))
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "cc-labels")
    while True:
        # the smallest label around a node is offered to the node and to its present label
        seen = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("m"))
        offers = labels.join(seen, labels["node"] == seen["a"]).select("node", "label", F.least("label", "m").alias("m"))
        best = offers.select("node", "m").unionAll(offers.select(F.col("label").alias("node"), "m")) \
            .groupBy("node").agg(F.min("m").alias("label"))
        up = best.select(F.col("node").alias("label"), F.col("label").alias("far"))
        jumped = best.join(up, "label").select("node", F.col("far").alias("label"))
        old = labels.select("node", F.col("label").alias("old"))
        new = materialise(jumped.join(old, "node"), "cc-labels")
        labels = new.select("node", "label")
        if new.filter("label <> old").isEmpty():
            return labels


def _classes(sig: DataFrame) -> DataFrame:
    """One row per distinct set: ``size, digest, prefix_digest, cls, least`` and the key of its first document.

    ``least`` is the smallest id of the documents of the set and also the number of the
    class; where ids repeat with different texts, all but one of those sets get a negative
    number from a hash."""
    # equal sets have equal prefixes
    per_set = materialise(sig.filter("size > 0").groupBy("size", "digest").agg(
        F.min(F.struct("idk", "hash")).alias("first"), F.min("prefix_digest").alias("prefix_digest"))
        .select("size", "digest", "prefix_digest", "first.idk", "first.hash"), "jaccard-sets")
    owner = per_set.groupBy("idk").agg(F.min("digest").alias("owner"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    own = F.col("owner").isNull() | (F.col("owner") == F.col("digest"))
    return materialise(per_set.join(owner, "idk", "left").select(
        "size", "digest", "prefix_digest", "idk", "hash", F.col("idk").alias("least"),
        F.when(own, F.col("idk")).otherwise(F.xxhash64("idk", "digest").bitwiseOR(F.lit(-(1 << 63)))).alias("cls")), "jaccard-classes")


def _keyed(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """``id, idk, hash, text`` of each document: ``(idk, hash)`` is equal for repeated rows only."""
    return docs.select(*more, F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("idk"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("hash"), F.col(text_col).alias("text"))


def jaccard_classes(docs: DataFrame, width: int = 3, num: int = 9, den: int = 10, id_col: str = "doc_id",
                    text_col: str = "text", heavy: int = HEAVY) -> DataFrame:
    """``doc_id, n_shingles, component_id``: documents linked (directly or not) by shingle sets
    of Jaccard similarity ``num / den`` or more; the component is named by its smallest id."""
    own = F.nullif(F.col("component"), F.lit(NO_ID))
    return _linked(_keyed(docs, id_col, text_col), width, num, den, heavy).select(
        F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"),
        F.when(F.col("size") == 0, F.col("id")).otherwise(own).alias("component_id"))


def keep_one_of_each(docs: DataFrame, width: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id",
                     text_col: str = "text", heavy: int = HEAVY) -> DataFrame:
    """``docs`` (all columns) with one document of each component: that of the smallest id (of
    equal ids, the smallest text hash). Documents without words all stay. Components are told
    apart by ``comp``: names are shared where ids are null or repeat."""
    packed = _keyed(docs, id_col, text_col, F.struct("*").alias("row"))
    found = materialise(_linked(packed.drop("row"), width, num, den, heavy), "jaccard-found")
    first = found.filter("size > 0").groupBy("comp").agg(F.min(F.struct("idk", "hash")).alias("k")).select("k.*")
    keys = first.withColumn("bare", F.lit(False)).unionAll(
        found.filter("size = 0").select("idk", "hash").distinct().withColumn("bare", F.lit(True)))
    kept = packed.select("row", "idk", "hash").join(keys.hint("merge"), ["idk", "hash"])
    return kept.filter("bare").select("row.*").unionAll(kept.filter("NOT bare").dropDuplicates(["idk", "hash"]).select("row.*"))


def _linked(rows: DataFrame, width: int, num: int, den: int, heavy: int) -> DataFrame:
    """``id, idk, hash, size, comp, component`` of each row (both null where size is 0): ``comp`` is
    unique to a component, ``component`` its smallest id, by which it is named."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(shingle_order(rows, width, heavy))
    key = "key struct<id:bigint,idk:bigint,hash:bigint>"
    sig = rows.select(F.struct("id", "idk", "hash").alias("key"), F.col("text").cast("binary")).mapInArrow(
        _signatures(width, num, den, shared),
        f"{key}, size long, digest binary, prefix array<bigint>, prefix_digest binary, bits array<bigint>")
    sig = materialise(sig.select("key.*", "size", "digest", "prefix", "prefix_digest", "bits"), "jaccard-signatures")

    classes = _classes(sig)
    members = classes.select("cls", "idk", "hash")
    bits = [f"b{i}" for i in range(BITMAP)]
    # groups: classes of identical prefix and size; a group is known by its smallest class
    groups = classes.groupBy("size", "prefix_digest").agg(F.min("cls").alias("grp"))
    grouped = classes.join(groups.hint("merge"), ["size", "prefix_digest"]).select("cls", "idk", "hash", "grp")
    reps = sig.select("idk", "hash", "size", "prefix", *[F.get("bits", F.lit(i)).alias(f"b{i}") for i in range(BITMAP)])
    reps = materialise(reps.join(grouped.hint("merge"), ["idk", "hash"]).dropDuplicates(["cls"]), "jaccard-groups")
    entry = reps.filter("cls = grp").select("grp", "size", F.explode("prefix").alias("token"))
    shared_tokens = entry.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.min("grp").alias("center")).filter("n > 1")
    shared_tokens = materialise(shared_tokens, "jaccard-tokens")
    lists = materialise(entry.join(shared_tokens.hint("merge"), "token").select("token", "grp", "center"), "jaccard-lists")

    # star: each group of a list with its first, each member of a group with its first
    stars = lists.filter("grp <> center").select("grp", "center").distinct()
    star_pairs = stars.join(reps.select("grp", "cls").hint("merge"), "grp").select(F.col("center").alias("a"), F.col("cls").alias("b")) \
        .unionAll(reps.filter("cls <> grp").select(F.col("grp").alias("a"), F.col("cls").alias("b")))
    sized = reps.select("cls", "size", *bits)
    near = star_pairs.join(sized.select(F.col("cls").alias("a"), F.struct("size", *bits).alias("x")).hint("merge"), "a") \
        .join(sized.select(F.col("cls").alias("b"), F.struct("size", *bits).alias("y")).hint("merge"), "b") \
        .filter(_overlap_ok("x", "y", num, den)).select("a", "b")
    near = materialise(near, "jaccard-star")
    sets = lambda p: materialise(_sets_of(p.select(F.col("a").alias("cls")).unionAll(p.select(F.col("b").alias("cls"))), members,
                                          rows.select("idk", "hash", "text"), width), "jaccard-sets")
    links = materialise(_verify(near, sets(near), num, den), "jaccard-links")
    found = components(links)

    # the rest: pairs of a list that are not yet connected
    labelled = reps.select("grp", "cls", "size", *bits).join(
        found.select(F.col("node").alias("cls"), "label").hint("merge"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    labelled = materialise(labelled, "jaccard-labels")
    spread = labelled.groupBy("grp").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    listed = lists.select("token", "grp").join(spread.hint("merge"), "grp")
    open_tokens = materialise(   # written, so that both sides of the join are plain shuffles that AQE splits
        listed.groupBy("token").agg(F.min("lo").alias("l"), F.max("hi").alias("h")).filter("l <> h").select("token"), "jaccard-open-tokens")
    still = materialise(listed.join(open_tokens.hint("merge"), "token").join(labelled.hint("merge"), "grp")
                        .select("token", "cls", "size", "label", *bits), "jaccard-open")
    x, y = still.alias("x"), still.hint("merge").alias("y")
    rest = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.cls") < F.col("y.cls"))
                  & (F.col("x.label") != F.col("y.label")) & _overlap_ok("x", "y", num, den)) \
        .select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b"))
    inner = labelled.join(spread.filter("lo <> hi").select("grp").hint("merge"), "grp")
    u, v = inner.alias("x"), inner.hint("merge").alias("y")
    within = u.join(v, (F.col("x.grp") == F.col("y.grp")) & (F.col("x.cls") < F.col("y.cls"))
                    & (F.col("x.label") != F.col("y.label")) & _overlap_ok("x", "y", num, den)) \
        .select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b"))
    rest = materialise(rest.unionAll(within).distinct(), "jaccard-rest")
    label_of = labelled.select("cls", "label")
    if rest.isEmpty():
        final = label_of.withColumnRenamed("label", "comp")
    else:
        more = materialise(_verify(rest, sets(rest), num, den), "jaccard-links")
        # components over components: links of the second step join labels of the first
        joined = more.join(label_of.select(F.col("cls").alias("a"), F.col("label").alias("la")).hint("merge"), "a") \
            .join(label_of.select(F.col("cls").alias("b"), F.col("label").alias("lb")).hint("merge"), "b") \
            .select(F.col("la").alias("a"), F.col("lb").alias("b"))
        top = components(joined).select(F.col("node").alias("label"), F.col("label").alias("top"))
        final = label_of.join(top.hint("merge"), "label", "left").select("cls", F.coalesce("top", "label").alias("comp"))
    final = materialise(final.join(classes.hint("merge"), "cls").select("comp", "size", "digest", "least"), "jaccard-final")
    least = final.groupBy("comp").agg(F.min("least").alias("component"))
    by_set = materialise(final.join(least.hint("merge"), "comp").select("size", "digest", "comp", "component"), "jaccard-components")
    return sig.select("id", "idk", "hash", "size", "digest").join(by_set.hint("merge"), ["size", "digest"], "left") \
        .select("id", "idk", "hash", "size", "comp", "component")

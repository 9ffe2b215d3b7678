"""SimHash near-duplicate classes by Golay-code fuzzy hashing.

A fingerprint has 64 bits: a bit is 1 if it is set in over half the 64-bit hashes of the
text's word shingles. Fingerprints that differ in 3 bits or fewer are linked.

*Golay keys.* The binary Golay code of length 23 is perfect: every 23-bit word lies within 3
bits of exactly one codeword, whose 12 message bits are the word's index. The index of a word
and those of all words one bit away are its nearby indices (one or six). If two segments
differ in one bit at most, the index of either is among the nearby indices of the other.

*Pigeonhole.* A fingerprint is cut into three segments (22, 21 and 21 bits, filled up with
zeros to 23). Three errors fall on the segments in one of two ways:

* some segment has none; then one of the other two has one at most. Key: the bits of the one
  and the index of the other (six ordered pairs of segments).
* each segment has exactly one. Key: the indices of the first two, and the parity of every
  segment, which is turned in all three.

A fingerprint stands in the list of each key once by its own index (``home``) and once for
each nearby index; a link is found where a nearby key of one is the home key of the other.

*Join without all pairs.* Equal fingerprints are one class from the start. Each entry of a
list is compared with the smallest fingerprint of its list, then, where a list still joins
several components, with one of the largest label (a star: as many rows as entries). Only the
pairs of a list that are not connected by then are joined, under the bit count of their
difference, by plain shuffles that AQE splits. The fingerprint is its own signature, so
verifying needs no further join, and every pair that could connect two components is verified.

Defined cases: null and empty text, and texts without words, have the fingerprint zero, which
is linked like any other; a text of fewer words than a shingle has its whole word sequence as
one shingle; repeated rows are equal documents; a null id counts as larger than any other (a
component of null ids alone has a null id); an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notelake.llm.ngram_join import components
from notelake.session import materialise

# The generator polynomial of the binary Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
LENGTH, CHECK = 23, 11
WIDTHS = (22, 21, 21)
SHINGLES_AT_ONCE = 1 << 16
_HASH = xxhash.xxh64_intdigest


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, CHECK - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECK)
    return word


class GolayCode:
    """Indices of 23-bit words by syndrome: the code is cyclic and systematic (12 message bits
    above 11 check bits), and each of the 2,048 syndromes belongs to one error of 3 bits or fewer."""

    def __init__(self) -> None:
        single = [_remainder(1 << b) for b in range(LENGTH)]
        self.check = np.zeros(1 << (LENGTH - CHECK), dtype=np.int32)     # syndrome of the message bits alone
        for b in range(LENGTH - CHECK):
            at = np.arange(len(self.check)) >> b & 1 == 1
            self.check[at] ^= single[b + CHECK]
        self.error = np.zeros(1 << CHECK, dtype=np.int32)
        for i in range(LENGTH):
            self.error[single[i]] = 1 << i
            for j in range(i):
                self.error[single[i] ^ single[j]] = 1 << i | 1 << j
                for k in range(j):
                    self.error[single[i] ^ single[j] ^ single[k]] = 1 << i | 1 << j | 1 << k

    def index(self, words: np.ndarray) -> np.ndarray:
        """The message bits of the codeword that is within 3 bits of each word."""
        syndrome = self.check[words >> CHECK] ^ (words & ((1 << CHECK) - 1))
        return (words ^ self.error[syndrome]) >> CHECK


def fingerprint(text: bytes | None, width: int) -> int:
    """The 64-bit fingerprint of a whole text (UTF-8)."""
    words = text.lower().split() if text else []     # bytes: A-Z only, parted at space and 0x09-0x0D only
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    n = max(1, len(words) - width + 1)
    start, end = start[:n], end[min(width, len(words)) - 1:]
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, SHINGLES_AT_ONCE):
        spans = zip(start[at:at + SHINGLES_AT_ONCE].tolist(), end[at:at + SHINGLES_AT_ONCE].tolist())
        h = np.array([_HASH(joined[i:j], 42) for i, j in spans], dtype="<u8")
        raw = h.view(np.uint8).reshape(-1, 8)
        ones += np.concatenate([np.bincount(raw[:, k], minlength=256) @ _BYTE_BITS for k in range(8)])
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def _fingerprints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 500):
                rb = big.slice(at, 500)
                fp = np.array([fingerprint(t, width) for t in rb.column(1).to_pylist()], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(fp.view(np.int64))], names=["id", "fp"])
    return run


class Keys:
    """Home and nearby keys of fingerprints as 64-bit numbers."""

    def __init__(self) -> None:
        self.code = GolayCode()
        self.shift = np.cumsum([0, *WIDTHS[:-1]]).astype(np.uint64)

    def segments(self, fp: np.ndarray) -> list[np.ndarray]:
        return [((fp >> s) & np.uint64((1 << w) - 1)).astype(np.int64) for s, w in zip(self.shift, WIDTHS)]

    def nearby(self, words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(word position, index) of the distinct indices of the words within one bit of each."""
        around = np.concatenate([[0], 1 << np.arange(width)])
        index = np.sort(self.code.index(words[:, None] ^ around[None, :]), axis=1)
        new = np.concatenate([np.ones((len(words), 1), dtype=bool), index[:, 1:] != index[:, :-1]], axis=1)
        return np.nonzero(new)[0], index[new]

    def of(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(fingerprint position, key, home) of all entries of unsigned fingerprints."""
        seg = self.segments(fp)
        home = [self.code.index(s) for s in seg]
        near = [self.nearby(s, w) for s, w in zip(seg, WIDTHS)]
        every = np.arange(len(fp))
        at, key, own = [], [], []

        def add(kind: int, where: np.ndarray, low: np.ndarray, is_home: bool) -> None:
            at.append(where)
            key.append((np.int64(kind) << np.int64(48)) | low)
            own.append(np.full(len(where), is_home))

        for kind, (i, j) in enumerate(permutations(range(3), 2)):
            add(kind, every, seg[i] << 12 | home[j], True)
            where, index = near[j]
            add(kind, where, seg[i][where] << 12 | index, False)
        turned = sum((np.bitwise_count(s) & 1).astype(np.int64) << k for k, s in enumerate(seg))
        add(6, every, (turned << 12 | home[0]) << 12 | home[1], True)
        (w0, i0), (w1, i1) = near[0], near[1]
        first1, n1 = np.searchsorted(w1, every), np.bincount(w1, minlength=len(fp))
        times = n1[w0]                                         # each index of the first with all of the second
        pick = np.repeat(first1[w0], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        where = np.repeat(w0, times)
        add(6, where, ((turned[where] ^ 7) << 12 | np.repeat(i0, times)) << 12 | i1[pick], False)
        return np.concatenate(at), np.concatenate(key), np.concatenate(own)


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys = Keys()
    for big in batches:
        for start in range(0, big.num_rows, 4096):
            fp = big.column(0).slice(start, 4096).to_numpy(zero_copy_only=False).view(np.uint64)
            at, key, own = keys.of(fp)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(own), pa.array(fp.view(np.int64)[at])], names=["key", "home", "fp"])


def _near(a: str, b: str, errors: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= errors


def _labels(fps: DataFrame, links: DataFrame) -> DataFrame:
    """``fp, label`` of every fingerprint; the label is the smallest fingerprint of the component."""
    found = components(links)
    return materialise(fps.select("fp").join(found.select(F.col("node").alias("fp"), "label").hint("merge"), "fp", "left")
                       .select("fp", F.coalesce("label", "fp").alias("label")), "simhash-labels")


def _relabel(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after more links between fingerprints."""
    a = labels.select(F.col("fp").alias("a"), F.col("label").alias("la")).hint("merge")
    b = labels.select(F.col("fp").alias("b"), F.col("label").alias("lb")).hint("merge")
    joined = links.join(a, "a").join(b, "b").select(F.col("la").alias("a"), F.col("lb").alias("b"))
    top = components(joined).select(F.col("node").alias("label"), F.col("label").alias("top"))
    return materialise(labels.join(top.hint("merge"), "label", "left").select("fp", F.coalesce("top", "label").alias("label")),
                       "simhash-labels")


def _open(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """Entries, with labels, of the lists that hold several components; ``far`` is an entry of the
    largest label of the list."""
    labelled = materialise(entries.join(labels.hint("merge"), "fp").select("key", "home", "fp", "label"), "simhash-open")
    spread = labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max(F.struct("label", "fp")).alias("hi"),
                                         F.bool_or("home").alias("h"), F.bool_and("home").alias("only")) \
        .filter("lo < hi.label AND h AND NOT only").select("key", F.col("hi.fp").alias("far"), F.col("hi.label").alias("far_label"))
    return materialise(labelled.join(spread.hint("merge"), "key"), "simhash-open")


def fingerprint_components(fps: DataFrame, errors: int = 3) -> DataFrame:
    """``fp, label`` for distinct fingerprints ``fps(fp)`` (64-bit): the label is the smallest
    (signed) fingerprint that is reachable by links of at most ``errors`` (3 or fewer) bits."""
    if not 0 <= errors <= 3:
        raise ValueError("the keys find differences of 3 bits or fewer")
    entries = fps.select("fp").mapInArrow(_entries, "key long, home boolean, fp long")
    # a list without a home entry or without a nearby one of another fingerprint has no pair
    lists = entries.groupBy("key").agg(F.min("fp").alias("center"), F.max("fp").alias("most"), F.bool_or("home").alias("h")) \
        .filter("center < most AND h").select("key", "center")
    listed = materialise(entries.join(lists.hint("merge"), "key"), "simhash-lists")
    star = listed.filter(F.col("fp") != F.col("center")).filter(_near("fp", "center", errors)) \
        .select(F.col("center").alias("a"), F.col("fp").alias("b")).distinct()
    labels = _labels(fps, materialise(star, "simhash-star"))
    still = _open(listed.select("key", "home", "fp"), labels)
    star = still.filter("label <> far_label").filter(_near("fp", "far", errors)) \
        .select(F.col("far").alias("a"), F.col("fp").alias("b")).distinct()
    labels = _relabel(labels, materialise(star, "simhash-star"))
    still = _open(still.select("key", "home", "fp"), labels)
    x, y = still.filter("NOT home").alias("x"), still.filter("home").hint("merge").alias("y")
    rest = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.label") != F.col("y.label")) & _near("x.fp", "y.fp", errors)) \
        .select(F.least("x.label", "y.label").alias("a"), F.greatest("x.label", "y.label").alias("b")).distinct()
    top = components(materialise(rest, "simhash-rest")).select(F.col("node").alias("label"), F.col("label").alias("top"))
    return labels.join(top.hint("merge"), "label", "left").select("fp", F.coalesce("top", "label").alias("label"))


def simhash_classes(docs: DataFrame, width: int = 3, errors: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id``: documents linked (directly or not) by fingerprints of
    ``width``-word shingles that differ in ``errors`` bits or fewer; the component is named by its
    smallest id, the fingerprint has 16 hex digits."""
    sig = materialise(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary"))
                      .mapInArrow(_fingerprints(width), "id long, fp long"), "simhash-fingerprints")
    fps = materialise(sig.groupBy("fp").agg(F.min("id").alias("least")), "simhash-classes")
    found = materialise(fingerprint_components(fps, errors).join(fps.hint("merge"), "fp"), "simhash-found")
    named = found.groupBy("label").agg(F.min("least").alias("component_id"))
    by_fp = found.select("fp", "label").join(named.hint("merge"), "label").select("fp", "component_id")
    return sig.join(by_fp.hint("merge"), "fp").select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

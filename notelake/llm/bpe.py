"""Byte-level BPE encoding and decoding by segment trees over adjacent pair ranks.

A pre-token is a row of byte symbols. Each leaf of a segment tree holds the rank of the pair
that starts at a position, combined with the position (``rank * width + position``), each
inner node the minimum of its children: the root is the leftmost pair of the lowest rank.
A merge changes three leaves (the pair itself, the one before, and the symbol that went), so
it costs a logarithmic number of node updates; it ends when no pair is left. Short
pre-tokens of equal tree width are merged together, one numpy step for all their trees;
long ones have a tree of their own.

Encoding is a map over the rows as they are read: no shuffle, no key that could be hot.
Distinct chunks of text are encoded once per worker and remembered up to ``max_chunks``
(forgotten ones are encoded again; results do not depend on it). Texts are cut before a
single space that is followed by something else: the pattern always cuts there.

Defined cases: null text counts as empty; empty text has no tokens; a special token's string
in a text is that token, as the tokenizer's own encode has it; unknown ids raise an error
when decoded; bytes that are not UTF-8 decode to U+FFFD; an empty table gives an empty
result; repeated rows are encoded alike; other columns are carried by ``keep``.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The pre-token pattern of byte-level BPE vocabularies of this family.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_INF = np.int64(1) << 62
LONG = 256           # bytes from which a pre-token has a tree of its own
BATCH = 1 << 19      # leaves merged together


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in vocabulary files: printable Latin-1 bytes stand
    for themselves, the others follow from U+0100 on in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    symbols = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [symbols[b] for b in range(256)]


class BytePairCodec:
    """A byte-level BPE vocabulary file with its encoder and decoder."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        symbols = byte_symbols()
        back = {s: b for b, s in enumerate(symbols)}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.byte_id = np.array([vocab[s] for s in symbols], dtype=np.int64)
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token_bytes: list[bytes | None] = [None] * size
        for token, i in vocab.items():
            if token not in self.special:
                self.token_bytes[i] = bytes(back[c] for c in token)
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.size = np.int64(size)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left, right = (np.array([vocab[p[k]] for p in pairs], dtype=np.int64) for k in (0, 1))
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        key = left * self.size + right
        order = np.argsort(key, kind="stable")
        self.pair_key, self.pair_rank = key[order], order.astype(np.int64)
        self.pattern = regex.compile(PATTERN)
        self.cut_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of symbols; -1 where they do not merge."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[at] == key, self.pair_rank[at], -1)

    def _leaf(self, left: np.ndarray, right: np.ndarray, pos: np.ndarray, width: int) -> np.ndarray:
        r = self._rank(left, right)
        return np.where(r >= 0, r * width + pos, _INF)

    def merge(self, words: Sequence[bytes]) -> list[np.ndarray]:
        """Token ids of each pre-token (as bytes)."""
        out: list[np.ndarray | None] = [None] * len(words)
        by_width: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if len(w) < 2:
                out[i] = self.byte_id[np.frombuffer(w, dtype=np.uint8)]
            else:
                by_width.setdefault(1 << (len(w) - 1).bit_length(), []).append(i)
        for width, all_of_width in by_width.items():
            step = max(1, BATCH // width)
            for at in range(0, len(all_of_width), step):
                rows = all_of_width[at:at + step]
                if width > LONG:
                    done: Iterable[np.ndarray] = (self._merge_one(words[i], width) for i in rows)
                else:
                    done = self._merge_batch([words[i] for i in rows], width)
                for i, ids in zip(rows, done):
                    out[i] = ids
        return out  # type: ignore[return-value]

    def _merge_batch(self, words: list[bytes], width: int) -> list[np.ndarray]:
        """Segment trees of ``width`` leaves, one for each word, advanced together."""
        n = len(words)
        size = np.fromiter(map(len, words), dtype=np.int64, count=n)
        ids = np.full((n, width + 1), -1, dtype=np.int64)      # the last column: no symbol
        ids[:, :width][np.arange(width) < size[:, None]] = self.byte_id[np.frombuffer(b"".join(words), dtype=np.uint8)]
        following = np.tile(np.arange(1, width + 2, dtype=np.int64), (n, 1))
        following[np.arange(n), size - 1] = width
        before = np.tile(np.arange(-1, width, dtype=np.int64), (n, 1))
        tree = np.full((n, 2 * width), _INF, dtype=np.int64)
        pos = np.arange(width - 1)
        both = ids[:, 1:width] >= 0
        leaves = np.full((n, width), _INF, dtype=np.int64)
        leaves[:, :width - 1] = np.where(both, self._leaf(ids[:, :width - 1], ids[:, 1:width], pos, width), _INF)
        tree[:, width:] = leaves
        level = width
        while level > 1:
            level //= 2
            tree[:, level:2 * level] = np.minimum(tree[:, 2 * level:4 * level:2], tree[:, 2 * level + 1:4 * level:2])

        def put(rows: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
            node = at + width
            tree[rows, node] = value
            while node[0] > 1:
                node = node >> 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

        rows = np.flatnonzero(tree[:, 1] < _INF)
        while len(rows):
            root = tree[rows, 1]
            at = root % width
            gone = following[rows, at]
            after = following[rows, gone]
            prev = before[rows, at]
            new = self.merged[root // width]
            ids[rows, at] = new
            ids[rows, gone] = -1
            following[rows, at] = after
            before[rows, after] = at                            # column ``width`` takes what has no use
            put(rows, gone, np.full(len(rows), _INF))
            right = ids[rows, after]
            put(rows, at, np.where(after < width, self._leaf(new, right, at, width), _INF))
            has = prev >= 0
            if has.any():
                r, p = rows[has], prev[has]
                put(r, p, self._leaf(ids[r, p], new[has], p, width))
            rows = rows[tree[rows, 1] < _INF]
        flat = ids[:, :width]
        keep = flat >= 0
        return np.split(flat[keep], np.cumsum(keep.sum(axis=1))[:-1])

    def _merge_one(self, word: bytes, width: int) -> np.ndarray:
        """The same with one tree, for a long pre-token."""
        ids = self.byte_id[np.frombuffer(word, dtype=np.uint8)].tolist()
        n, inf = len(ids), int(_INF)
        first = self._leaf(np.array(ids[:-1]), np.array(ids[1:]), np.arange(n - 1), width)
        full = np.full(2 * width, _INF, dtype=np.int64)
        full[width:width + n - 1] = first
        level = width
        while level > 1:
            level //= 2
            full[level:2 * level] = np.minimum(full[2 * level:4 * level:2], full[2 * level + 1:4 * level:2])
        tree = full.tolist()
        following, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        ranks = self._rank_table()
        merged, size = self.merged, int(self.size)

        def put(at: int, value: int) -> None:
            node = at + width
            tree[node] = value
            node >>= 1
            while node:
                low = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == low:
                    break
                tree[node] = low
                node >>= 1

        while tree[1] < inf:
            rank, at = divmod(tree[1], width)
            gone = following[at]
            after, prev = following[gone], before[at]
            ids[at] = new = int(merged[rank])
            ids[gone] = -1
            following[at] = after
            put(gone, inf)
            r = -1
            if after < n:
                before[after] = at
                r = ranks.get(new * size + ids[after], -1)
            put(at, r * width + at if r >= 0 else inf)
            if prev >= 0:
                r = ranks.get(ids[prev] * size + new, -1)
                put(prev, r * width + prev if r >= 0 else inf)
        return np.array([i for i in ids if i >= 0], dtype=np.int64)

    def _rank_table(self) -> dict[int, int]:
        if not hasattr(self, "_ranks"):
            self._ranks = dict(zip(self.pair_key.tolist(), self.pair_rank.tolist()))
        return self._ranks

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


def _chunks(text: str) -> list[str]:
    """Cut before each space that is followed by something else; the space is left out of
    all chunks but the first, which never had one to leave out."""
    return _CUT.split(text)


_CUT = re.compile(r" (?=\S)")


class ChunkEncoder:
    """Encodes texts; remembers the ids of distinct chunks."""

    def __init__(self, codec: BytePairCodec, max_chunks: int):
        self.codec, self.max_chunks = codec, max_chunks
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _learn(self, new: list[str]) -> None:
        find = self.codec.pattern.findall
        split = [find(c) for c in new]
        unseen = list(set().union(*split).difference(self.words))
        ids = self.codec.merge([w.encode("utf-8", "surrogatepass") for w in unseen])
        self.words.update((w, i.astype("<u4").tobytes()) for w, i in zip(unseen, ids))
        words = self.words
        self.chunks.update((c, b"".join([words[w] for w in s])) for c, s in zip(new, split))

    def encode_batch(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """Ids of each text as unsigned 32-bit numbers."""
        special, cut = self.codec.special, self.codec.cut_special
        parts: list[list[str]] = []     # chunks as they stand in the text, special tokens apart
        for t in texts:
            t = t or ""
            pieces = cut.split(t) if cut and any(s in t for s in special) else [t]
            row: list[str] = []
            for p in pieces:
                if p in special:
                    row.append(p)
                elif p:
                    head, *rest = _chunks(p)
                    if head:
                        row.append(head)
                    row += [" " + x for x in rest]
            parts.append(row)
        wanted = set().union(*parts).difference(special) if parts else set()
        if len(self.chunks) > self.max_chunks:   # before ``new`` is known: nothing this batch needs is forgotten
            self.chunks = {}
        if len(self.words) > self.max_chunks:
            self.words = {}
        new = [c for c in wanted if c not in self.chunks]
        if new:
            self._learn(new)
        known = self.chunks
        for s, i in special.items():
            known[s] = np.array([i], dtype="<u4").tobytes()
        return [np.frombuffer(b"".join([known[c] for c in row]), dtype="<u4") for row in parts]


_WORKER: dict[tuple[str, int], ChunkEncoder] = {}


def worker_encoder(path: str, max_chunks: int) -> ChunkEncoder:
    """The encoder of this Python worker (kept between tasks)."""
    if (path, max_chunks) not in _WORKER:
        _WORKER[path, max_chunks] = ChunkEncoder(BytePairCodec(path), max_chunks)
    return _WORKER[path, max_chunks]


def _struct(keep: Sequence[Column]) -> Column:
    return F.struct(*keep).alias("row")


def encode(docs: DataFrame, path: str, keep: Sequence[Column], text_col: str = "text",
           max_chunks: int = 250_000, rows_at_once: int = 256) -> DataFrame:
    """``row`` (the ``keep`` columns) and ``ids`` (array of ints) of each document."""
    packed = docs.select(F.col(text_col).alias("text"), _struct(keep))
    kind = packed.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = worker_encoder(path, max_chunks)
        for big in batches:
            for at in range(0, big.num_rows, rows_at_once):
                rb = big.slice(at, rows_at_once)
                ids = enc.encode_batch(rb.column(0).to_pylist())
                flat = np.concatenate([np.zeros(0, "<u4"), *ids]).astype(np.int32)
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [rb.column(1), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["row", "ids"])

    return packed.mapInArrow(run, f"row {kind}, ids array<int>")


def decode(tokens: DataFrame, path: str, keep: Sequence[Column], ids_col: str = "ids") -> DataFrame:
    """``row`` (the ``keep`` columns) and ``text``, decoded from an array of ids (null: empty)."""
    packed = tokens.select(F.col(ids_col).alias("ids"), _struct(keep))
    kind = packed.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_encoder(path, 0).codec
        for rb in batches:
            text = [codec.decode(x or ()) for x in rb.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([rb.column(1), pa.array(text, pa.string())], names=["row", "text"])

    return packed.mapInArrow(run, f"row {kind}, text string")


def round_trip_digests(docs: DataFrame, path: str, keep: Sequence[Column], text_col: str = "text",
                       max_chunks: int = 250_000, rows_at_once: int = 256) -> DataFrame:
    """``row`` (the ``keep`` columns), ``n_tokens``, ``ids_sha256`` (of the decimal ids joined
    by commas) and ``decoded_sha256`` (of the text decoded from the ids): encode and decode in
    one pass, without carrying the ids between two."""
    packed = docs.select(F.col(text_col).alias("text"), _struct(keep))
    kind = packed.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = worker_encoder(path, max_chunks)
        decimal = [str(i) for i in range(int(enc.codec.size))].__getitem__
        for big in batches:
            for at in range(0, big.num_rows, rows_at_once):
                rb = big.slice(at, rows_at_once)
                n, a, b = [], [], []
                for ids in enc.encode_batch(rb.column(0).to_pylist()):
                    each = ids.tolist()
                    n.append(len(each))
                    a.append(hashlib.sha256(",".join(map(decimal, each)).encode()).hexdigest())
                    b.append(hashlib.sha256(enc.codec.decode(each).encode("utf-8", "surrogatepass")).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [rb.column(1), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                    names=["row", "n_tokens", "ids_sha256", "decoded_sha256"])

    return packed.mapInArrow(run, f"row {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")

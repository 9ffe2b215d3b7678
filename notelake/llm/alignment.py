"""Alignment of the tokens of two tokenisers by whitespace-token anchors.

Tokeniser A is a byte-level BPE vocabulary, applied to a space and the text; tokeniser B a
sentencepiece model, which adds that space itself. Both tokenise the whole text first. Then
offsets at which a token of both begins and is marked by a space are anchors: shared ends
before space-marked tokens. They split a document into windows of token ids of A and B; the
alignment of a window depends on its ids alone and is remembered by them. The bytes of the
windows are put together again and compared with the text, which verifies the anchors and the
tokens at once.

*Tokenising.* Distinct chunks (white space and what follows up to the next white space) are
tokenised by the libraries once and remembered; the ids of a text are those of its chunks, as
A's pattern cuts before white space, and pieces of B have a space at their start only. Texts with
U+2581, or with other white space that some piece of B holds (the carriage return, found when the
vocabulary is loaded), are one chunk and are not remembered.
Both memories are bounded by their bytes; what is forgotten is computed again.

*Corpus counts.* A document's linked id pairs with their numbers are written packed, some two
bytes a pair. The corpus count of a pair is a sum over documents (combined in the task, then by
Spark). Where two tokens end together, the bytes of one end with those of the other, and a token
has no more endings than bytes: so there are at most as many pairs as both vocabularies have
bytes, at any size of the corpus. A table of that bound (some 10 MB) is broadcast for the second
pass, which reads the packed pairs only.

Defined cases: null and empty texts, and texts whose joined token bytes differ from a space and
the text, have no tokens: zeros and an empty digest; the strings of special tokens are plain
text; a null id and repeated rows are rows like others (each counts in the corpus counts); an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import sys
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notelake.llm.bpe import PATTERN, byte_symbols
from notelake.session import materialise

# The characters with the Unicode property White_Space.
SPACES = "\t-\r \x85\xa0  -     　"
_CHUNK = re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")
_SPACE = re.compile(f"[{SPACES}]")
_WHITE = frozenset(c for c in map(chr, range(0x3001)) if _SPACE.match(c))
#: One white space, then characters of whose classes (letter, number, other) all versions of Unicode say the same.
_LATIN = re.compile("[ \\n][!-~\u00a1-\u017f]+").fullmatch
_MARK = "▁"
_NEWLINE_PIECES = 2      # of a prefixed newline: the added space and the newline's byte
TOGETHER = 16            # new chunks that B tokenises in one call
MEMORY = 128 << 20       # bytes of a memory of this worker
FOUND = "id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs binary"


class Tokenisers:
    """Both vocabularies with the bytes of their tokens, and a memory of chunks."""

    def __init__(self, byte_bpe: str, pieces: str, memory: int = MEMORY):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(byte_bpe)
        self.a.encode_special_tokens = True
        self.a.no_padding()
        self.a.no_truncation()
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        back = {s: i for i, s in enumerate(byte_symbols())}
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_MARK, " ").encode() for i, p in enumerate(names)]
        if len(self.a_bytes) * len(self.b_bytes) > 1 << 32:
            raise ValueError("pairs of ids must fit 32 bits")
        ranks = {x: i for i, x in enumerate(self.a_bytes) if x and i not in self.a.get_added_tokens_decoder()}
        self.a_latin = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.a_len, self.b_len = (np.array([len(x) for x in t]) for t in (self.a_bytes, self.b_bytes))
        self.a_space, self.b_space = (np.array([x[:1] == b" " for x in t]) for t in (self.a_bytes, self.b_bytes))
        white = [p.replace(_MARK, " ") for i, p in enumerate(names) if not self.b.is_byte(i) and not self.b.is_control(i)]
        # white space that some piece holds after another character (here the carriage return)
        joined = set().union(*[_SPACE.findall(p.lstrip(" ")) for p in white if len(p) > 1])
        self.whole = re.compile(f"[{_MARK}{''.join(map(re.escape, sorted(joined)))}]")
        self.parted = "\n" not in joined and len(self.b.encode("\n")) == _NEWLINE_PIECES
        self.a_code = self.b_code = "H" if max(len(self.a_bytes), len(self.b_bytes)) < 1 << 16 else "I"
        if sys.byteorder != "little" or array("I").itemsize != 4:
            raise ValueError("ids are held on little-endian machines only")
        self.memory, self.held = memory, 0
        self.chunks: dict[str, tuple[bytes, bytes]] = {}

    def _learn(self, new: list[str]) -> None:
        """Ids of new chunks. Those that hold more than white space are tokenised end to end: they all
        begin with white space, where A cuts, and for B a newline is put before each. Chunks of ASCII and
        Latin letters go through the faster of two libraries for A; the merges are the same for both, as
        every token is what its own bytes are merged to and ids are in order of merges (tested)."""
        bare = [c for c in new if c[-1] in _WHITE]
        latin = [c for c in new if _LATIN(c)]
        other = [c for c in new if c[-1] not in _WHITE and not _LATIN(c)]
        full = latin + other
        size = np.array([len(c.encode("utf-8", "surrogatepass")) for c in full], dtype=np.int64)
        ids = self.a_latin.encode_ordinary("".join(latin)) + (self.a.encode("".join(other), add_special_tokens=False).ids if other else [])
        a = np.array(ids, dtype=self.a_code)
        lines = ["\n" + "\n".join(full[i:i + TOGETHER]) for i in range(0, len(full), TOGETHER)]
        b = np.array([i for ids in self.b.encode(lines, num_threads=1) for i in ids[1:]], dtype=self.b_code)
        cut_a = np.searchsorted(np.cumsum(self.a_len[a]), np.cumsum(size)) + 1
        cut_b = np.searchsorted(np.cumsum(self.b_len[b]), np.cumsum(size + 1)) + 1
        if len(full) and (cut_a[-1] != len(a) or cut_b[-1] != len(b)):
            raise ValueError("the tokens of chunks do not end with them")
        wa, wb = a.itemsize, b.itemsize
        at_a, at_b, raw_a, raw_b = [0, *(cut_a * wa).tolist()], [0, *(cut_b * wb).tolist()], a.tobytes(), b.tobytes()
        for c, i, j, k, m in zip(full, at_a, at_a[1:], at_b, at_b[1:]):
            self.chunks[c] = raw_a[i:j], raw_b[k + wb:m]
            self.held += 330 + 4 * len(c) + j - i + m - k
        for c in bare:
            ids, other = self.a.encode(c, add_special_tokens=False).ids, self.b.encode("\n" + c)[_NEWLINE_PIECES:]
            self.chunks[c] = np.array(ids, dtype=self.a_code).tobytes(), np.array(other, dtype=self.b_code).tobytes()
            self.held += 330 + 8 * len(c)

    def tokenise(self, texts: Sequence[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of A (of a space and the text) and of B of each text, in order."""
        if self.held > self.memory:      # before it is known what these texts need
            self.chunks, self.held = {}, 0
        rows = [_CHUNK.findall(" " + t) if self.parted and not self.whole.search(t) else None for t in texts]
        found = [list(map(self.chunks.get, r)) if r else None for r in rows]
        new = dict.fromkeys([c for r, got in zip(rows, found) if got and None in got for c, f in zip(r, got) if f is None])
        if new:
            self._learn(list(new))
        for text, row, got in zip(texts, rows, found):
            if row is None:
                a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
                yield np.array(a, dtype=self.a_code), np.array(b, dtype=self.b_code)
            else:
                known = [self.chunks[c] if f is None else f for c, f in zip(row, got)]
                yield np.frombuffer(b"".join([x for x, _ in known]), dtype=self.a_code), \
                    np.frombuffer(b"".join([y for _, y in known]), dtype=self.b_code)


class Aligner:
    """Alignments of windows, remembered by the ids of A and of B: the groups as text, each with a
    semicolon behind it, and the codes of the links as bytes; False where the bytes of the two differ."""

    def __init__(self, tokenisers: Tokenisers, memory: int = MEMORY):
        self.tok, self.memory, self.held = tokenisers, memory, 0
        self.known: dict[bytes, tuple[str, bytes] | bool] = {}
        n = len(tokenisers.a_bytes), len(tokenisers.b_bytes)
        self.signs = [f"{i}{after}" for size, last in zip(n, "|;") for i in range(size) for after in (",", last)]
        self.apart = np.iinfo(tokenisers.a_code).max      # no id; parts the ids of the two in a key

    def _learn(self, keys: list[bytes], a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> None:
        """Align new windows end to end: their common ends are shared ends, so no group crosses them.
        ``na`` and ``nb`` are the numbers of tokens of each."""
        tok = self.tok
        last_a, last_b = np.cumsum(na) - 1, np.cumsum(nb) - 1
        end_a, end_b = np.cumsum(tok.a_len[a]), np.cumsum(tok.b_len[b])
        same = b"".join([tok.a_bytes[i] for i in a.tolist()]) == b"".join([tok.b_bytes[i] for i in b.tolist()])
        if not same or not np.array_equal(end_a[last_a], end_b[last_b]):
            if len(keys) == 1:
                self.known[keys[0]] = False
                return
            h = len(keys) // 2           # some window's bytes differ: find it
            i, j = last_a[h - 1] + 1, last_b[h - 1] + 1
            self._learn(keys[:h], a[:i], b[:j], na[:h], nb[:h])
            self._learn(keys[h:], a[i:], b[j:], na[h:], nb[h:])
            return
        at = np.searchsorted(end_b, end_a)
        is_end = end_b[np.minimum(at, len(end_b) - 1)] == end_a
        ends = end_a[is_end]
        codes = a[is_end].astype(np.int64) * len(tok.b_bytes) + b[at[is_end]]
        b_end = np.zeros(len(b), dtype=bool)
        b_end[at[is_end]] = True
        order = np.argsort(np.concatenate([np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)]), kind="stable")
        sign = np.concatenate([2 * a.astype(np.int64) + is_end, 2 * (b.astype(np.int64) + len(tok.a_bytes)) + b_end])[order].tolist()
        texts = [self.signs[i] for i in sign]
        links = codes.astype("<u4").tobytes()
        cuts = [0, *(last_a + last_b + 2).tolist()], [0, *(4 * np.cumsum(is_end)[last_a]).tolist()]
        for key, i, j, c, d in zip(keys, cuts[0], cuts[0][1:], cuts[1], cuts[1][1:]):
            self.known[key] = "".join(texts[i:j]), links[c:d]
        self.held += 340 * len(keys) + 10 * len(texts) + len(links)

    def windows(self, a: np.ndarray, b: np.ndarray) -> list[tuple[str, bytes] | bool]:
        """The alignments of the windows of a document, in order."""
        tok = self.tok
        end_a, end_b = np.cumsum(tok.a_len[a]), np.cumsum(tok.b_len[b])
        ia, ib = np.flatnonzero(tok.a_space[a[1:]]), np.flatnonzero(tok.b_space[b[1:]])     # the tokens before marked ones
        ea, eb = end_a[ia], end_b[ib]
        at = np.minimum(np.searchsorted(eb, ea), max(len(eb) - 1, 0))
        shared = eb[at] == ea if len(eb) else np.zeros(len(ea), dtype=bool)
        to_a, to_b = np.append(ia[shared] + 1, len(a)), np.append(ib[at[shared]] + 1, len(b))     # ends of the windows
        na, nb = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
        number = np.arange(len(to_a))
        wa, wb = np.repeat(number, na), np.repeat(number, nb)
        line = np.full(len(a) + len(b) + len(number), self.apart, dtype=tok.a_code)             # per window: ids of A, a mark, ids of B
        line[np.arange(len(a)) + wa + (to_b - nb)[wa]] = a
        line[np.arange(len(b)) + wb + 1 + to_a[wb]] = b
        raw, cut = line.tobytes(), ((to_a + to_b + number + 1) * line.itemsize).tolist()
        keys = [raw[i:j] for i, j in zip([0, *cut], cut)]
        found = list(map(self.known.get, keys))
        if None in found:
            new = {k: w for w, (k, f) in enumerate(zip(keys, found)) if f is None}
            some = np.zeros(len(number), dtype=bool)
            some[list(new.values())] = True
            self._learn([keys[w] for w in np.flatnonzero(some).tolist()], a[some[wa]], b[some[wb]], na[some], nb[some])
            found = [self.known[k] if f is None else f for k, f in zip(keys, found)]
        return found

    def document(self, text: str, a: np.ndarray, b: np.ndarray) -> tuple | None:
        """(groups, digest of the groups, linked pairs, their numbers); None if the bytes differ from the text."""
        if self.held > self.memory:      # before it is known what this document needs
            self.known, self.held = {}, 0
        if b"".join(map(self.tok.a_bytes.__getitem__, a.tolist())) != (" " + text).encode("utf-8", "surrogatepass"):
            return None
        ws = self.windows(a, b)
        if False in ws:
            return None
        digest = hashlib.sha256("".join([w[0] for w in ws])[:-1].encode()).hexdigest()
        links = np.sort(np.frombuffer(b"".join([w[1] for w in ws]), dtype="<u4"))
        first = np.flatnonzero(np.concatenate([[True], links[1:] != links[:-1]]))
        return len(links), digest, links[first].astype(np.int64), np.diff(first, append=len(links))


_PACK, _UNPACK = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack_pairs(pair: np.ndarray, number: np.ndarray) -> bytes:
    """Ascending pair codes and their numbers."""
    gaps = np.diff(pair, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T
    return _PACK.compress(np.ascontiguousarray(gaps).tobytes() + number.astype("<u4").tobytes())


def unpack_pairs(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(_UNPACK.decompress(data), dtype=np.uint8)
    gaps, number = raw[:len(raw) // 2].reshape(4, -1), raw[len(raw) // 2:]
    return np.cumsum(np.ascontiguousarray(gaps.T).view("<u4").ravel(), dtype=np.int64), \
        np.frombuffer(number.tobytes(), dtype="<u4").astype(np.int64)


_WORKER: dict = {}


def worker_aligner(byte_bpe: str, pieces: str, memory: int) -> Aligner:
    """The aligner of this Python worker (kept between tasks)."""
    key = byte_bpe, pieces, memory
    if key not in _WORKER:
        _WORKER[key] = Aligner(Tokenisers(byte_bpe, pieces, memory), memory)
    return _WORKER[key]


def _align(byte_bpe: str, pieces: str, memory: int, chars_at_once: int = 1 << 20):
    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
        for big in batches:
            for at in range(0, big.num_rows, 256):
                rb = big.slice(at, 256)
                ids, texts, held = [], [], 0
                for i, t in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist()):
                    ids.append(i)
                    texts.append(t or "")
                    held += len(texts[-1])
                    if held > chars_at_once:
                        yield ids, texts
                        ids, texts, held = [], [], 0
                if ids:
                    yield ids, texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = worker_aligner(byte_bpe, pieces, memory)
        for ids, texts in slices(batches):
            out = []
            for t, (a, b) in zip(texts, aligner.tok.tokenise(texts)):
                got = aligner.document(t, a, b) if t else None
                out.append((len(a), len(b), got[0], got[1], pack_pairs(*got[2:])) if got else (0, 0, 0, "", None))
            kinds = pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *[pa.array(c, k) for c, k in zip(zip(*out), kinds)]],
                                             names=["id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs"])
    return run


def _sums(batches: Iterator[pa.RecordBatch], held: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The pairs of a task with their numbers."""
    pair, number = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    size = 0

    def merge() -> None:
        nonlocal pair, number, size
        u, at = np.unique(np.concatenate(pair), return_inverse=True)
        pair, number, size = [u], [np.bincount(at, weights=np.concatenate(number), minlength=len(u)).astype(np.int64)], 0

    for rb in batches:
        for data in rb.column(0).to_pylist():
            p, n = unpack_pairs(data)
            pair.append(p)
            number.append(n)
            size += len(p)
            if size > held:
                merge()
    merge()
    for at in range(0, len(pair[0]), 50_000):
        yield pa.RecordBatch.from_arrays([pa.array(pair[0][at:at + 50_000]), pa.array(number[0][at:at + 50_000])], names=["pair", "n"])


def pair_counts(found: DataFrame) -> DataFrame:
    """``pair, n``: how many links of all documents hold the pair (code: id of A times the size of B, plus id of B)."""
    return found.filter("pairs IS NOT NULL").select("pairs").mapInArrow(_sums, "pair long, n long") \
        .groupBy("pair").agg(F.sum("n").alias("n"))


def align_tokens(docs: DataFrame, byte_bpe: str, pieces: str, id_col: str = "doc_id", text_col: str = "text",
                 memory: int = MEMORY) -> DataFrame:
    """Per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    Groups are cut at the offsets where tokens of both end; the two tokens that end there are
    linked. ``count_sum`` sums the corpus counts of the id pairs of the links, ``n_best`` numbers the
    links whose pair has the highest count among the pairs of its id of B."""
    with open(byte_bpe, encoding="utf-8") as f:
        model = json.load(f)["model"]["vocab"]
    import sentencepiece
    model_b = sentencepiece.SentencePieceProcessor(model_file=pieces)
    names = [model_b.id_to_piece(i) for i in range(model_b.get_piece_size())]
    bound = sum(map(len, model)) + 4 * sum(map(len, names)) + 256 * len(names[0])

    found = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")) \
        .mapInArrow(_align(byte_bpe, pieces, memory), FOUND)
    found = materialise(found, "alignment-found")
    counts = materialise(pair_counts(found), "alignment-counts").toArrow()     # bounded by the vocabularies' bytes
    if counts.num_rows > bound:
        raise ValueError(f"{counts.num_rows} pairs, more than the {bound} that the vocabularies allow")
    pair, n = counts.column("pair").to_numpy(), counts.column("n").to_numpy()
    order = np.argsort(pair)
    pair, n = pair[order], n[order]
    most = np.zeros(len(names), dtype=np.int64)
    np.maximum.at(most, pair % len(names), n)
    shared = docs.sparkSession.sparkContext.broadcast((pair.astype("<u4"), n, n == most[pair % len(names)]))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = shared.value
        for rb in batches:
            out = []
            for data in rb.column("pairs").to_pylist():
                p, times = unpack_pairs(data) if data is not None else (np.zeros(0, np.int64),) * 2
                at = np.searchsorted(pair, p.astype("<u4"))
                out.append((int(times.sum()), int(times[best[at]].sum()), int((times * n[at]).sum())))
            cols = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(1), rb.column(2), rb.column(3), *[pa.array(c, pa.int64()) for c in cols],
                                              rb.column(4)], names=names_out)

    names_out = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return found.mapInArrow(judge, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
                                   "groups_sha256 string")

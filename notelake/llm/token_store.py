"""Token-ID output: one zstandard frame per document, with a shared dictionary.

Documents are put in ranges of (id, hash of the text) that hold about as many rows each (split
points from the quantiles of the ids, so the shard of a row is a pure function of the row; an id
that many rows share, or null, has several shards) and each range is one shard, written in
ascending id order. A shard is a list of blocks; a block holds the frames of successive documents end
to end (``payload``), their ids, token counts and byte offsets (the index), and the sha256 of
the dictionary they need. One document is read by its block's id range, its offset, and one
frame. Ids are little-endian unsigned 16-bit numbers if the vocabulary allows it, else
32-bit; the dictionary table says which.

``<path>/dictionary``  sha256, id_bytes, vocab_size, data                     (one row)
``<path>/blocks``      shard, block, first_id, last_id, n_tokens, doc_ids, counts, offsets,
                       dict_sha256, payload

Both are Parquet tables written by Spark, on whatever file system holds the path: a task
that fails or runs twice leaves nothing behind, and no file is local to a machine.

The dictionary is trained on the id arrays of a bounded sample: about ``sample_docs``
documents, chosen by the hash of their id and text, of those the ones of at most ``sample_chars``
characters. It only affects the size of the files. The start of a document is found from the block index: sums
per shard (one row per shard), then per block, then within the block.

Defined cases: null text counts as empty (the end id alone); null ids come first; documents
of equal id are ordered by the hash of their text; an empty table gives an empty store;
repeated rows are stored as often as they occur; other columns are not stored.
"""

from __future__ import annotations

import hashlib
import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from notelake.llm.common import LEAST, full_text, range_of, split_points

BLOCK_BYTES = 4 << 20
BLOCKS = ("shard int, block int, first_id long, last_id long, n_tokens long, doc_ids array<long>, "
          "counts array<long>, offsets array<long>, dict_sha256 string, payload binary")
_WORKER: dict = {}


#: A word of Latin letters with at most one mark after it: the vocabulary lower-cases letters
#: one by one and always parts them from the mark. (A letter whose lower case is more than one
#: code point, as U+0130, ends in a combining mark that is not parted: such words are left out.)
_SIMPLE = re.compile("([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u017F]+)([.,;:!?]?)")


#: Bytes that an entry takes in the table itself, about.
_ENTRY = 64


class WordEncoder(dict):
    """The tokenizers library with a memory of the chunks between spaces and line ends: maps a
    chunk to its serialised ids. The vocabulary drops white space and never joins across it, so
    a text's ids are those of its chunks; chunks are encoded by the library when they are first
    met and remembered up to ``max_bytes`` of Python objects, however long they are (what is
    forgotten is encoded again)."""

    def __init__(self, path: str, max_bytes: int = 192 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_padding()
        self.tok.no_truncation()
        self.width = 2 if self.tok.get_vocab_size() <= 1 << 16 else 4
        self.code = "H" if self.width == 2 else "I"
        if sys.byteorder != "little" or array("I").itemsize != 4:
            raise ValueError("ids are serialised on little-endian machines only")
        self.max_bytes, self.size = max_bytes, 0

    def __missing__(self, chunk: str) -> bytes:
        simple = _SIMPLE.fullmatch(chunk)
        low = simple[1].lower() if simple else ""
        if simple and len(low) == len(simple[1]) and (simple[2] or low != chunk):
            out = self[low] + (self[simple[2]] if simple[2] else b"")
        else:
            out = array(self.code, self.tok.encode(chunk, add_special_tokens=False).ids).tobytes()
        held = sys.getsizeof(chunk) + sys.getsizeof(out) + _ENTRY
        if held > self.max_bytes >> 8:      # a long run without a space
            return out
        if self.size + held > self.max_bytes:
            self.clear()
            self.size = 0
        self[chunk] = out
        self.size += held
        return out

    def encode(self, text: str, end_id: int) -> bytes:
        """Serialised ids of a text, with the end id."""
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" "))) + array(self.code, [end_id]).tobytes()


def _worker(path: str) -> WordEncoder:
    if path not in _WORKER:
        _WORKER[path] = WordEncoder(path)
    return _WORKER[path]


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int, sample_docs: int = 512,
                     sample_chars: int = 32_768, dict_bytes: int = 65_536) -> DataFrame:
    """One row: ``sha256, id_bytes, vocab_size, data``. ``docs(id, text)``."""
    n = docs.select("id").count()
    every = max(1, n // sample_docs)
    sample = docs.filter(F.pmod(F.xxhash64("id", "text"), F.lit(every)) == 0) \
        .filter(F.length("text").between(1, sample_chars)).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _worker(tokenizer)
        data = [enc.encode(t, end_id) for rb in batches for t in rb.column(0).to_pylist()]
        try:
            trained = zstandard.train_dictionary(dict_bytes, data).as_bytes() if data else b""
        except zstandard.ZstdError:   # too little to learn from
            trained = b""
        yield pa.RecordBatch.from_arrays(
            [pa.array([hashlib.sha256(trained).hexdigest()], pa.string()), pa.array([enc.width], pa.int32()),
             pa.array([enc.tok.get_vocab_size()], pa.int64()), pa.array([trained], pa.binary())],
            names=["sha256", "id_bytes", "vocab_size", "data"])

    return sample.repartition(1).mapInArrow(run, "sha256 string, id_bytes int, vocab_size long, data binary")


def write_token_store(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                      text_col: str = "text", level: int = 3) -> None:
    """Encode every text with the tokenizer file and write the store to ``path``."""
    slim = docs.select(F.col(id_col).cast("long").alias("id"), full_text(text_col).alias("text"))
    spark = docs.sparkSession
    train_dictionary(slim, tokenizer, end_id).write.parquet(f"{path}/dictionary")
    shared = spark.read.parquet(f"{path}/dictionary").first()   # one row of a bounded size
    sha, trained = (shared["sha256"], bytes(shared["data"])) if shared else (hashlib.sha256(b"").hexdigest(), b"")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _worker(tokenizer)
        pack = _compressor(trained, level)
        shard, block, ids, counts, frames, size = None, 0, [], [], [], 0

        def flush() -> pa.RecordBatch:
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])])
            known = [i for i in ids if i is not None]
            return pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int32()), pa.array([block], pa.int32()),
                pa.array([min(known, default=None)], pa.int64()), pa.array([max(known, default=None)], pa.int64()),
                pa.array([sum(counts)], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                pa.array([counts], pa.list_(pa.int64())), pa.array([offsets.tolist()], pa.list_(pa.int64())),
                pa.array([sha], pa.string()), pa.array([b"".join(frames)], pa.binary())],
                names=["shard", "block", "first_id", "last_id", "n_tokens", "doc_ids", "counts", "offsets",
                       "dict_sha256", "payload"])

        for big in batches:
            for at in range(0, big.num_rows, 256):
                rb = big.slice(at, 256)
                for s, i, text in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist(), rb.column(2).to_pylist()):
                    if ids and (s != shard or size >= BLOCK_BYTES):
                        yield flush()
                        block, ids, counts, frames, size = block + 1, [], [], [], 0
                    raw = enc.encode(text, end_id)
                    frame = pack.compress(raw)
                    shard = s
                    ids.append(i)
                    counts.append(len(raw) // enc.width)
                    frames.append(frame)
                    size += len(frame)
        if ids:
            yield flush()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    points, tie = split_points(slim, "id", n), F.xxhash64("text")
    slim.select(range_of(F.col("id"), tie, points).cast("int").alias("shard"), "id", "text").repartitionById(len(points) + 1, F.col("shard")) \
        .sortWithinPartitions("shard", F.coalesce("id", F.lit(LEAST)), tie) \
        .mapInArrow(run, BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")


def _compressor(trained: bytes, level: int) -> zstandard.ZstdCompressor:
    if not trained:
        return zstandard.ZstdCompressor(level=level)
    d = zstandard.ZstdCompressionDict(trained)
    d.precompute_compress(level=level)
    return zstandard.ZstdCompressor(dict_data=d)


def _dictionary(spark: SparkSession, path: str) -> tuple[str, bytes, int]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    if row is None:
        return hashlib.sha256(b"").hexdigest(), b"", 2
    return row["sha256"], bytes(row["data"]), row["id_bytes"]


def block_starts(blocks: DataFrame) -> DataFrame:
    """``shard, block, start``: tokens before each block, from the block index alone."""
    index = blocks.select("shard", "block", "n_tokens")
    shards = index.groupBy("shard").agg(F.sum("n_tokens").alias("t"))   # one row per written partition
    before = shards.select("shard", (F.sum("t").over(Window.orderBy("shard")) - F.col("t")).alias("shard_start"))
    here = Window.partitionBy("shard").orderBy("block")
    return index.withColumn("here", F.sum("n_tokens").over(here) - F.col("n_tokens")).join(before, "shard") \
        .select("shard", "block", (F.col("shard_start") + F.col("here")).alias("start"))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, read back from its frame: ``doc_id, start, n_tokens, ids_crc32``
    (crc32 of the ids as little-endian unsigned 32-bit numbers)."""
    blocks = spark.read.parquet(f"{path}/blocks")
    sha, trained, width = _dictionary(spark, path)
    slim = blocks.join(block_starts(blocks), ["shard", "block"]) \
        .select("start", "doc_ids", "counts", "offsets", "dict_sha256", "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for k in range(rb.num_rows):    # a block at a time
                row = rb.slice(k, 1).to_pylist()[0]
                ids, starts, counts, crc, at = [], [], [], [], row["start"]
                for doc, n, tokens in frames_of(row, sha, trained, width):
                    ids.append(doc)
                    starts.append(at)
                    counts.append(len(tokens))
                    crc.append(zlib.crc32(tokens.astype("<u4").tobytes()))
                    at += len(tokens)
                    if len(tokens) != n:
                        raise ValueError(f"document {doc}: {len(tokens)} ids in its frame, {n} in the index")
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (ids, starts, counts, crc)],
                                                 names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return slim.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def frames_of(row: dict, sha: str, trained: bytes, width: int, wanted: set | None = None) -> Iterator[tuple]:
    """(document id, indexed count, ids) of the documents of a block, or of the wanted ones."""
    if row["dict_sha256"] != sha:
        raise ValueError(f"block needs dictionary {row['dict_sha256']}, the store has {sha}")
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(trained) if trained else None)
    payload, offsets = memoryview(row["payload"]), row["offsets"]
    for k, doc in enumerate(row["doc_ids"]):
        if wanted is None or doc in wanted:
            yield doc, row["counts"][k], np.frombuffer(unpack.decompress(payload[offsets[k]:offsets[k + 1]]), dtype=f"<u{width}")


def read_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """``doc_id, ids`` of a few documents: only blocks whose id range fits are read, and only
    the frames of the documents are decompressed."""
    blocks = spark.read.parquet(f"{path}/blocks")
    sha, trained, width = _dictionary(spark, path)
    wanted = set(doc_ids)
    fits = F.lit(False)
    for i in sorted(wanted):
        fits = fits | ((F.col("first_id") <= i) & (F.col("last_id") >= i))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for row in rb.to_pylist():
                got = [(d, t.astype(np.int64)) for d, _, t in frames_of(row, sha, trained, width, wanted)]
                yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in got], pa.int64()),
                                                  pa.array([t for _, t in got], pa.list_(pa.int64()))], names=["doc_id", "ids"])

    return blocks.filter(fits).select("doc_ids", "counts", "offsets", "dict_sha256", "payload") \
        .mapInArrow(run, "doc_id long, ids array<long>")

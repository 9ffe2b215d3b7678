"""Language ID: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased and everything but letters becomes a space; 1- to 3-grams are hashed
into a fixed number of buckets. Training counts n-grams per language in each task (one
``bincount`` per batch) and sums the counts by (language, bucket) in Spark, over all
training rows. The log-probability matrix (languages x buckets) is broadcast; its size is
checked (``MAX_LANGS``) before. Scoring gathers the matrix rows of all n-grams of a batch
and sums them per document in numpy; long texts are read in pieces, so memory is bounded by
the text itself.

Defined cases: text that is null or has no letter is ``und`` with score 0; so is every text
if there is nothing to learn from; equal scores go to the language first in alphabetical
order; rows without a language or text teach nothing; empty tables give empty results;
other columns are kept (``predict`` adds the one it is told to).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET_BITS = 15
ORDERS = (1, 2, 3)
MAX_LANGS = 512      # more labels than this are not languages: the fit raises an error
PIECE = 1 << 18      # characters hashed at once
_MULT = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))
_LUT: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Code point -> its lower-case letter, or space for everything else."""
    if not _LUT:
        lut = np.full(0x110000, 32, dtype=np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                lut[i] = ord(low) if len(low) == 1 else i
        _LUT.append(lut)
    return _LUT[0]


def letters_of(text: str | None) -> np.ndarray:
    """The text as lower-case code points, non-letters as spaces."""
    return _letters()[np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype="<u4")]


def hash_ngrams(c: np.ndarray, starts: int, bits: int) -> list[np.ndarray]:
    """Buckets of the 1-, 2- and 3-grams at the first ``starts`` positions of ``c`` (which
    has two more); n-grams that begin with two spaces, or are one, fall in bucket 2**bits."""
    a, b, d = c[:starts], c[1:starts + 1], c[2:starts + 2]
    shift, dead = np.uint32(32 - bits), np.uint32(1 << bits)
    h1 = a * _MULT[0]
    h2 = (h1 ^ (b * _MULT[1])) * _MULT[2] + np.uint32(2)
    h3 = (h2 ^ (d * _MULT[0])) * _MULT[1] + np.uint32(3)
    space = a == 32
    blank = space & (b == 32)
    out = []
    for h, bad in ((h1 * _MULT[2] + np.uint32(1), space), (h2, blank), (h3, blank)):
        h = (h ^ (h >> np.uint32(15))) * _MULT[1] >> shift
        h[bad] = dead
        out.append(h)
    return out


def _pieces(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of code points of about ``PIECE``, and the document of each position
    (``-1`` where no n-gram starts). A document is framed by one space before and two after."""
    parts: list[np.ndarray] = []
    owner: list[np.ndarray] = []
    size = 0
    for i, t in enumerate(texts):
        c = np.concatenate([[np.uint32(32)], letters_of(t), [np.uint32(32)] * 2]).astype(np.uint32)
        n = len(c) - 2
        for at in range(0, n, PIECE):
            here = min(PIECE, n - at)
            parts.append(c[at:at + here + 2])
            o = np.full(here + 2, i, dtype=np.int64)
            o[here:] = -1
            owner.append(o)
            size += here
            if size >= PIECE:
                yield np.concatenate(parts), np.concatenate(owner)
                parts, owner, size = [], [], 0
    if parts:
        yield np.concatenate(parts), np.concatenate(owner)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    for big in batches:
        for at in range(0, big.num_rows, rows):
            yield big.slice(at, rows)


def _count_batches(bits: int):
    """Map over (text, lang) batches: sparse (lang, bucket, count) rows, summed per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = (1 << bits) + 1
        total: dict[str, np.ndarray] = {}
        for rb in _slices(batches):
            langs = rb.column(1).to_pylist()
            names = sorted(set(langs))
            code = np.array([names.index(x) for x in langs] or [0], dtype=np.int64)
            acc = np.zeros(len(names) * width, dtype=np.int64)
            for c, owner in _pieces(rb.column(0).to_pylist()):
                starts = len(c) - 2
                valid = owner[:starts] >= 0
                base = code[owner[:starts][valid]] * width
                for h in hash_ngrams(c, starts, bits):
                    acc += np.bincount(base + h[valid], minlength=len(acc))
            for k, name in enumerate(names):
                part = acc[k * width:(k + 1) * width]
                total[name] = total[name] + part if name in total else part
            if len(total) > MAX_LANGS:
                raise ValueError(f"more than {MAX_LANGS} languages in the training rows")
        for name, counts in total.items():
            at = np.flatnonzero(counts[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())],
                names=["lang", "bucket", "count"])
    return run


def _vector(bits: int):
    """The bucket counts of one language (as many rows as buckets at most) as one vector."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(1 << bits, dtype="<i8")
        out[pdf["bucket"].to_numpy()] = pdf["count"].to_numpy()
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "counts": [out.tobytes()]})
    return run


@dataclass
class LanguageModel:
    langs: list[str]
    logp: np.ndarray   # (buckets + 1, languages); the last row is zero
    prior: np.ndarray
    bits: int

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        scores = np.zeros((len(texts), len(self.langs)))
        letters = np.zeros(len(texts), dtype=np.int64)
        for c, owner in _pieces(texts) if self.langs else ():
            starts = len(c) - 2
            o = owner[:starts]
            valid = np.flatnonzero(o >= 0)
            docs, first = np.unique(o[valid], return_index=True)
            got = 0.0
            for h in hash_ngrams(c, starts, self.bits):
                got = got + np.add.reduceat(self.logp[h[valid]], first, axis=0)
            scores[docs] += got
            letters[docs] += np.add.reduceat(c[valid] != 32, first)
        pred, conf = ["und"] * len(texts), np.zeros(len(texts))
        known = np.flatnonzero(letters > 0)
        if len(known):
            s = scores[known] + self.prior
            best = s.argmax(axis=1)   # the first, hence in alphabetical order, of equals
            e = np.exp(s - s.max(axis=1, keepdims=True))
            conf[known] = e.max(axis=1) / e.sum(axis=1)
            for i, b in zip(known.tolist(), best.tolist()):
                pred[i] = self.langs[b]
        return pred, conf


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", smoothing: float = 0.5,
        bits: int = BUCKET_BITS) -> LanguageModel:
    """Fit on all rows of ``docs`` that have a language and a text with n-grams."""
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")) \
        .filter("lang IS NOT NULL AND text IS NOT NULL AND length(text) > 0")
    per_lang = rows.groupBy("lang").count().limit(MAX_LANGS + 1).collect()
    if len(per_lang) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages in the training rows")
    langs = sorted(r["lang"] for r in per_lang)
    counts = np.zeros(((1 << bits) + 1, len(langs)))
    sums = rows.mapInArrow(_count_batches(bits), "lang string, bucket long, count long") \
        .groupBy("lang", "bucket").agg(F.sum("count").alias("count"))
    for r in sums.groupBy("lang").applyInPandas(_vector(bits), "lang string, counts binary").collect():   # a vector a language
        counts[:-1, langs.index(r["lang"])] = np.frombuffer(r["counts"], "<i8")
    p = counts[:-1] + smoothing
    logp = np.vstack([np.log(p / p.sum(axis=0)), np.zeros((1, len(langs)))]) if langs else counts
    n = {r["lang"]: r["count"] for r in per_lang}
    prior = np.log(np.array([n[x] for x in langs], dtype=float) / max(1, sum(n.values())))
    return LanguageModel(langs, logp, prior, bits)


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with ``out``: a struct of ``lang_pred`` and ``score``. Only the texts go to Python."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for texts in batches:
            pred, conf = [], []
            for at in range(0, len(texts), 512):
                p, c = m.predict(texts.slice(at, 512).to_pylist())
                pred += p
                conf += c.tolist()
            yield pa.StructArray.from_arrays([pa.array(pred, pa.string()), pa.array(conf, pa.float64())], names=["lang_pred", "score"])

    return docs.withColumn(out, judge(F.col(text_col)))

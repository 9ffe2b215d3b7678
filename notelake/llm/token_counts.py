"""Token counts of a unigram tokenizer by trie-shared dynamic programming.

A pre-token is a word of the text with the word mark before it. Its best split into pieces
is the usual forward recurrence, and the forward score at a position depends on the prefix
alone; so the distinct pre-tokens are put in a trie and each shared prefix is scored once.
The trie is walked depth first: distinct pre-tokens in sorted order *are* its depth-first
order, so only the current branch is held, and the token count at each terminal is stored.

Piece scores come from the public vocabulary file, whose pieces are ordered by rank: the
log-probability of rank r is that of Zipf's law, ``-ln((r + 1) * H_N)``. A character that
no piece covers costs one piece per UTF-8 byte, each with the rank after the last.

The work is per document, so Spark maps over the rows as they are read: no shuffle, no key
that could be hot. Each worker keeps terminal counts between batches and forgets them
beyond ``max_words`` (they are recomputed when needed; results do not depend on it).

Defined cases: null and empty text have no pre-tokens and no tokens; equal scores take the
split with fewer pieces; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"


@dataclass
class UnigramVocabulary:
    """Pieces and their log-probabilities; ``byte_score`` is that of one fallback byte."""
    pieces: dict[str, float]
    byte_score: float
    longest: int

    @classmethod
    def ranked(cls, ranked: Iterable[str]) -> UnigramVocabulary:
        pieces = list(ranked)
        norm = math.log(sum(1.0 / r for r in range(1, len(pieces) + 2)))
        scores: dict[str, float] = {}
        for r, p in enumerate(pieces):
            scores.setdefault(p, -math.log(r + 1) - norm)
        return cls(scores, -math.log(len(pieces) + 1) - norm, max(map(len, pieces), default=1))

    @classmethod
    def load(cls, path: str) -> UnigramVocabulary:
        """The ordinary pieces of a sentencepiece model file, in order of rank."""
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return cls.ranked(sp.IdToPiece(i) for i in range(sp.GetPieceSize())
                          if not (sp.IsByte(i) or sp.IsControl(i) or sp.IsUnknown(i) or sp.IsUnused(i)))


def count_pieces(words: Iterable[str], vocab: UnigramVocabulary) -> Iterator[tuple[str, int]]:
    """(word, number of pieces of its best split) for distinct words in sorted order."""
    pieces, longest, byte = vocab.pieces.get, vocab.longest, vocab.byte_score
    best, used = [0.0], [0]   # along the current branch of the trie
    previous = ""
    for word in words:
        token = MARK + word
        shared = 0
        for a, b in zip(previous, token):
            if a != b:
                break
            shared += 1
        del best[shared + 1:], used[shared + 1:]
        for end in range(shared + 1, len(token) + 1):
            ch = token[end - 1]
            if pieces(ch) is None:
                n = len(ch.encode("utf-8", "surrogatepass"))
                top, cnt = best[end - 1] + n * byte, used[end - 1] + n
            else:
                top, cnt = -math.inf, 0
            for start in range(max(0, end - longest), end):
                score = pieces(token[start:end])
                if score is not None:
                    score += best[start]
                    if score > top or score == top and used[start] + 1 < cnt:
                        top, cnt = score, used[start] + 1
            best.append(top)
            used.append(cnt)
        previous = token
        yield word, used[len(token)]


def token_counts(docs: DataFrame, vocab: UnigramVocabulary, id_col: str = "doc_id", text_col: str = "text",
                 max_words: int = 400_000) -> DataFrame:
    """One row per document: ``doc_id, n_pretokens, n_tokens``."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, known = shared.value, {}
        for rb in batches:
            pre, tokens = [], []
            for at in range(0, rb.num_rows, 500):
                words = [(t or "").split() for t in rb.column(1).slice(at, 500).to_pylist()]
                if len(known) > max_words:
                    known = {}
                new = set().union(*words).difference(known)
                known.update(count_pieces(sorted(new), v))
                pre += map(len, words)
                tokens += [sum(map(known.__getitem__, w)) for w in words]
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(pre, pa.int64()), pa.array(tokens, pa.int64())],
                                             names=["doc_id", "n_pretokens", "n_tokens"])

    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, n_pretokens long, n_tokens long")

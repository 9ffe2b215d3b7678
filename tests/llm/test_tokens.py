import hashlib
import math
import random
import sys
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from notelake.llm import bpe, token_counts, token_store
from tests.llm.cases import empty, frame, rows

BPE, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def viterbi(token, vocab):
    """Fewest pieces among the best-scored splits, by the full recurrence for one pre-token."""
    best = [(0.0, 0)]
    for end in range(1, len(token) + 1):
        options = []
        if token[end - 1] not in vocab.pieces:
            n = len(token[end - 1].encode())
            options.append((best[end - 1][0] + n * vocab.byte_score, best[end - 1][1] + n))
        for start in range(end):
            if token[start:end] in vocab.pieces:
                options.append((vocab.pieces[token[start:end]] + best[start][0], best[start][1] + 1))
        top = max(o[0] for o in options)
        best.append((top, min(o[1] for o in options if o[0] == top)))
    return best[-1][1]


def test_token_counts_match_brute_force(spark):
    vocab = token_counts.UnigramVocabulary.load(public_tokenizers.path("piece_bpe_32k.model"))
    got = token_counts.token_counts(frame(spark), vocab, max_words=50).collect()
    memo = {}
    by = {}
    for i, t, *_ in rows():
        words = (t or "").split()
        for w in words:
            if w not in memo:
                memo[w] = viterbi("▁" + w, vocab)
        by.setdefault(i, []).append((len(words), sum(memo[w] for w in words)))
    have = {}
    for r in got:
        have.setdefault(r.doc_id, []).append((r.n_pretokens, r.n_tokens))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in by.items()}
    assert token_counts.token_counts(empty(spark), vocab).collect() == []


def test_shared_prefixes_and_unknown_characters():
    vocab = token_counts.UnigramVocabulary({"▁": -1.0, "a": -2.0, "ab": -2.5, "▁ab": -2.0, "b": -2.0, "abab": -9.0}, -20.0, 4)
    words = sorted({"", "a", "ab", "aba", "abab", "abz", "b", "é", "abé"})
    assert dict(token_counts.count_pieces(words, vocab)) == {w: viterbi("▁" + w, vocab) for w in words}
    assert math.isfinite(vocab.byte_score)


def test_bpe_matches_the_library_on_random_text():
    lib, enc = Tokenizer.from_file(BPE), bpe.ChunkEncoder(bpe.BytePairCodec(BPE), 40)
    rnd = random.Random(11)
    alphabet = [*" \n\t  ab'sllred'tÀéß漢字😀0123456789.,!-_<|>", "<|endoftext|>", "  ", " '", "'ll", " ", "​", "don't", "\x1c", "\x85", "　"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 50))) for _ in range(2000)]
    texts += ["a" * 3000, "ab" * 700, "é" * 400, " " * 500, "", "<|endoftext|>", "xyz" * 90]
    for text, got, want in zip(texts, enc.encode_batch(texts), lib.encode_batch(texts, add_special_tokens=False)):
        assert got.tolist() == want.ids, text
        assert enc.codec.decode(want.ids) == lib.decode(want.ids, skip_special_tokens=False) == text


def test_bpe_memory_smaller_than_a_batch():
    """Every batch has more unseen chunks than the memory holds, and some seen ones."""
    lib, enc = Tokenizer.from_file(BPE), bpe.ChunkEncoder(bpe.BytePairCodec(BPE), 1)
    for b in range(4):
        texts = ["shared words here", f"own{b} text {b}{b} of batch{b}", f"<|endoftext|> more{b}", "", None]
        want = lib.encode_batch([t or "" for t in texts], add_special_tokens=False)
        assert [g.tolist() for g in enc.encode_batch(texts)] == [w.ids for w in want]


def test_one_tree_and_many_trees_agree():
    codec = bpe.BytePairCodec(BPE)
    rnd = random.Random(2)
    words = [bytes(rnd.choice(b"abcdethein ") for _ in range(rnd.randint(2, 200))) for _ in range(150)]
    for w, ids in zip(words, codec.merge(words)):
        assert codec._merge_one(w, 1 << (len(w) - 1).bit_length()).tolist() == ids.tolist()


def test_bpe_invalid_bytes_decode_as_the_library_does():
    lib, codec = Tokenizer.from_file(BPE), bpe.BytePairCodec(BPE)
    rnd = random.Random(4)
    for _ in range(200):
        ids = [rnd.randrange(50257) for _ in range(rnd.randint(0, 12))]
        assert codec.decode(ids) == lib.decode(ids, skip_special_tokens=False)


def test_bpe_on_frames(spark):
    lib = Tokenizer.from_file(BPE)
    keep = [F.col("doc_id"), F.col("text").alias("t")]
    got = bpe.round_trip_digests(frame(spark), BPE, keep, rows_at_once=7).collect()
    assert len(got) == len(rows())
    for r in got:
        ids = lib.encode(r["row"].t or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((r["row"].t or "").encode()).hexdigest()
    coded = bpe.encode(frame(spark), BPE, keep)
    back = bpe.decode(coded, BPE, [F.col("row.t").alias("t")]).collect()
    assert len(back) == len(rows()) and all(r.text == (r["row"].t or "") for r in back)
    assert bpe.round_trip_digests(empty(spark), BPE, keep).collect() == []


def store(spark, tmp_path, df, name):
    path = f"file://{tmp_path}/{name}"
    token_store.write_token_store(df, path, WORDS, end_id=2)
    return path


def test_token_store_round_trip(spark, tmp_path, monkeypatch):
    lib = Tokenizer.from_file(WORDS)
    path = store(spark, tmp_path, frame(spark), "s")
    got = sorted(token_store.read_index(spark, path).collect(), key=lambda r: r.start)
    data = sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [r[0] for r in data]
    texts, at = {}, 0
    for i, t, *_ in data:
        texts.setdefault(i, []).append(t or "")
    for r in got:
        crcs = {(len(x), zlib.crc32(np.array(x, dtype="<u4").tobytes()))
                for x in (lib.encode(t, add_special_tokens=False).ids + [2] for t in texts[r.doc_id])}
        assert r.start == at and (r.n_tokens, r.ids_crc32) in crcs
        at += r.n_tokens
    one = token_store.read_documents(spark, path, [315, 4]).collect()
    assert {r.doc_id: r.ids for r in one} == {
        i: lib.encode(texts[i][0], add_special_tokens=False).ids + [2] for i in (315, 4)}
    blocks = spark.read.parquet(f"{path}/blocks")
    assert blocks.select("dict_sha256").distinct().count() == 1


def test_token_store_special_strings_and_case(spark, tmp_path):
    lib = Tokenizer.from_file(WORDS)
    texts = ["a<|endoftext|>b <|startoftext|>", "É é ́x İstanbul ΑΣ", "don't  'S\tx　y\r\nz", " ", "ﬁ ½ ² 12"]
    df = frame(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    got = {r.doc_id: r.ids_crc32 for r in token_store.read_index(spark, store(spark, tmp_path, df, "t")).collect()}
    for i, t in enumerate(texts):
        ids = lib.encode(t, add_special_tokens=False).ids + [2]
        assert got[i] == zlib.crc32(np.array(ids, dtype="<u4").tobytes()), t


def test_word_encoder_lower_case_before_marks():
    """Every letter of the short way, with every mark behind it, alone and in a word."""
    enc, lib = token_store.WordEncoder(WORDS), Tokenizer.from_file(WORDS)
    letters = [chr(c) for c in range(0x180) if token_store._SIMPLE.fullmatch(chr(c))]
    words = [f"{w}{m}" for c in letters for w in (c, f"GAZ{c}", f"{c}ab", f"x{c}Y") for m in ["", *".,;:!?"]]
    want = lib.encode_batch(words, add_special_tokens=False)
    assert "\u0130" in letters and len(words) > 5000
    for w, e in zip(words, want):
        assert np.frombuffer(enc.encode(w, 2), "<u2").tolist() == [*e.ids, 2], w


def test_word_encoder_is_bounded_by_bytes():
    """Long chunks count by their length: a bound by number let them take any memory."""
    enc, lib = token_store.WordEncoder(WORDS), Tokenizer.from_file(WORDS)
    enc.max_bytes = 1 << 18
    texts = [" ".join(f"{'xy' * k}{i}-z" for k in (1, 40, 300)) for i in range(500)] + ["run" * 2000]
    most = 0
    for t in texts:
        assert np.frombuffer(enc.encode(t, 2), "<u2").tolist() == [*lib.encode(t, add_special_tokens=False).ids, 2]
        most = max(most, sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in enc.items()))
    assert 1 << 15 < most <= 1 << 18


def test_token_store_empty(spark, tmp_path):
    path = store(spark, tmp_path, empty(spark), "e")
    assert token_store.read_index(spark, path).collect() == []

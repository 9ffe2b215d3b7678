import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from notelake.llm import alignment
from tests.llm.cases import empty, frame, rows

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tok():
    return alignment.Tokenisers(A, B)


def plain_groups(tok, text):
    """The groups of a text, from the offsets of whole tokens."""
    a, b = tok.a.encode(" " + text, add_special_tokens=False).ids, tok.b.encode(text)
    ends = [np.cumsum([len(tt[i]) for i in ids]).tolist() for tt, ids in ((tok.a_bytes, a), (tok.b_bytes, b))]
    shared, i, j = sorted(set(ends[0]) & set(ends[1])), 0, 0
    for e in shared:
        x, y = ends[0].index(e) + 1, ends[1].index(e) + 1
        yield f"{','.join(map(str, a[i:x]))}|{','.join(map(str, b[j:y]))}"
        i, j = x, y


def test_merges_of_both_libraries_are_the_same(tok):
    """Every token is what its own bytes are merged to, and ids are in order of merges: so merging by the rank
    of the merged token (one library) takes the pairs of the merge list (the other)."""
    from notelake.llm.bpe import BytePairCodec
    codec = BytePairCodec(A)
    known = [(i, x) for i, x in enumerate(codec.token_bytes) if x and i not in codec.special.values()]
    for (i, x), ids in zip(known, codec.merge([x for _, x in known])):
        assert ids.tolist() == [i], x
    by_rank = codec.merged[np.argsort(codec.pair_rank)] if len(codec.pair_rank) != len(codec.merged) else codec.merged
    assert (np.diff(by_rank) > 0).all() and max(codec.byte_id) < min(by_rank)
    assert all(tok.a_bytes[i] == x for i, x in known)


def test_latin_chunks_are_cut_alike(tok):
    """Every character of the short way beside every kind of character."""
    letters = [chr(c) for c in range(0x21, 0x180) if alignment._LATIN(" " + chr(c))]
    chunks = [f" {p}{c}{q}" for c in letters for p in ("", "a", "7", "'", "é") for q in ("", "b", "s", "9", "!", "ß")]
    assert len(chunks) > 8000
    for c, e in zip(chunks, tok.a.encode_batch(chunks, add_special_tokens=False)):
        assert tok.a_latin.encode_ordinary(c) == e.ids, c


def plain(tok, texts):
    """Whole texts by the libraries, every shared offset looked up; no chunks, anchors or windows."""
    docs, counts = [], Counter()
    for t in texts:
        a = tok.a.encode(" " + t, add_special_tokens=False).ids if t else []
        b = tok.b.encode(t) if t else []
        full = (" " + (t or "")).encode()
        if not t or b"".join(tok.a_bytes[i] for i in a) != full or b"".join(tok.b_bytes[i] for i in b) != full:
            docs.append(None)
            continue
        ends = [dict(zip(np.cumsum([len(tt[i]) for i in ids]).tolist(), range(len(ids)))) for tt, ids in ((tok.a_bytes, a), (tok.b_bytes, b))]
        shared = sorted(ends[0].keys() & ends[1].keys())
        links = [(a[ends[0][e]], b[ends[1][e]]) for e in shared]
        groups, i, j = [], 0, 0
        for e in shared:
            groups.append(f"{','.join(map(str, a[i:ends[0][e] + 1]))}|{','.join(map(str, b[j:ends[1][e] + 1]))}")
            i, j = ends[0][e] + 1, ends[1][e] + 1
        counts.update(links)
        docs.append((len(a), len(b), groups, links))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(n, best.get(b, 0))
    for d in docs:
        if d is None:
            yield 0, 0, 0, 0, 0, 0, ""
        else:
            a, b, groups, links = d
            yield (a, b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
                   hashlib.sha256(";".join(groups).encode()).hexdigest())


def aligned(spark, data, **kw):
    df = frame(spark, [(i, t, None, None, None) for i, t in data])
    return sorted(map(repr, map(tuple, alignment.align_tokens(df, A, B, **kw).collect())))


def want(tok, data):
    return sorted(repr((i, *p)) for (i, _), p in zip(data, plain(tok, [t for _, t in data])))


ODD = ["a", " ", "  ", " a", "a ", "a  b   c", "x\ny", "x\n\ny \n z", "\n", "\t\ttab", "été naïve 漢字 😀 ok", "▁", "a▁b", "<|endoftext|> x <s> </s> <unk> <0x0A>",
       "a b　c d\u0085e", "a\x1cb \x1d c\x00d", "don't we'll I'M x's", "1234 5678 12,3.4", "​ zero", "é é ﬁ ½", "a" * 3000, " " * 300 + "x",
       "ab\r\ncd\r\n", "word x   y", "…—“quoted” ‘x’", "x﻿y �"]


def test_tokenise_equals_the_libraries(tok):
    rnd = random.Random(3)
    chars = "aabcde  \n\t.,' é漢▁<1s　\x1c "
    texts = [t for t in ODD if t] + ["".join(rnd.choice(chars) for _ in range(rnd.randint(1, 60))) for _ in range(3000)]
    assert tok.parted
    for t, (a, b) in zip(texts, tok.tokenise(texts)):
        assert a.tolist() == tok.a.encode(" " + t, add_special_tokens=False).ids, repr(t)
        assert b.tolist() == tok.b.encode(t), repr(t)


def test_alignment_matches_plain_offsets(spark, tok):
    data = list(enumerate(ODD)) + [(100 + i, r[1]) for i, r in enumerate(rows())] + [(None, "null id"), (None, None), (5, ""), (5, "twice"), (5, "twice")]
    got = want(tok, data)
    assert aligned(spark, data) == got
    assert aligned(spark, data, memory=1) == got      # nothing is remembered between slices


def test_windows_split_at_verified_anchors(tok):
    al = alignment.Aligner(tok)
    text = "The cat sat on the mat. The cat sat."
    (a, b), = tok.tokenise([text])
    ws = al.windows(a, b)
    assert len(ws) == 9 and len(set(ws)) < len(ws) and len(al.known) == len(set(ws))
    assert "".join(w[0] for w in ws)[:-1] == ";".join(g for g in plain_groups(tok, text))


def test_pairs_round_trip():
    rng = np.random.default_rng(1)
    pair = np.unique(rng.integers(0, 1 << 31, 1000))
    number = rng.integers(1, 1 << 20, len(pair))
    p, n = alignment.unpack_pairs(alignment.pack_pairs(pair, number))
    assert (p == pair).all() and (n == number).all()


def test_alignment_empty(spark):
    assert alignment.align_tokens(empty(spark), A, B).count() == 0

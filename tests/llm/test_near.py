import hashlib
import pickle
import random
import re

import numpy as np
from pyspark.sql import functions as F

from notelake.llm import fingerprint, ngram_join
from tests.llm.cases import empty, frame, rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    w = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute_components(data, width, num, den):
    """Every pair of documents compared; (id, set size, smallest id reachable)."""
    sets = [shingles(t, width) for _, t in data]
    comp = list(range(len(data)))
    for a in range(len(data)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both) and comp[a] != comp[b]:
                old, new = comp[a], comp[b]
                comp = [new if c == old else c for c in comp]
    out = []
    for k, (i, _) in enumerate(data):
        ids = [data[j][0] for j in range(len(data)) if comp[j] == comp[k] and data[j][0] is not None]
        out.append((i, len(sets[k]), min(ids, default=None) if sets[k] else i))
    return out


def near_copies(seed, n=120):
    """A few originals and chains of edited copies, around and across the threshold."""
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    out = []
    for i in range(n):
        if out and rnd.random() < 0.7:
            words = rnd.choice(out).split()
            for _ in range(rnd.randint(0, 4)):
                words[rnd.randrange(len(words))] = rnd.choice(vocab)
            if rnd.random() < 0.2:
                words = words[:rnd.randint(1, len(words))]
        else:
            words = [rnd.choice(vocab) for _ in range(rnd.randint(1, 160))]
        out.append(" ".join(words))
    ids = rnd.sample(range(1000), n)
    return list(zip(ids, out))


def classes(spark, data, **kw):
    df = frame(spark, [(i, t, None, None, None) for i, t in data])
    return sorted(map(repr, map(tuple, ngram_join.jaccard_classes(df, **kw).collect())))


def test_join_matches_brute_force(spark):
    for seed, width, num, den, heavy in ((1, 3, 9, 10, 1 << 20), (2, 5, 4, 5, 1 << 12), (3, 2, 1, 2, 256)):
        data = near_copies(seed)
        want = sorted(map(repr, brute_components(data, width, num, den)))
        assert classes(spark, data, width=width, num=num, den=den, heavy=heavy) == want, seed


def test_join_on_odd_rows(spark):
    data = [(r[0], r[1]) for r in rows()]
    assert classes(spark, data) == sorted(map(repr, brute_components(data, 3, 9, 10)))
    assert ngram_join.jaccard_classes(empty(spark)).collect() == []


def test_join_of_one_group_of_near_copies(spark):
    """All documents share most of their text: one long posting list, many components."""
    rnd = random.Random(9)
    base = [f"b{i}" for i in range(100)]
    data = []
    for i in range(150):
        words = list(base)
        for _ in range(rnd.choice([1, 1, 2, 6])):
            words[rnd.randrange(100)] = f"e{rnd.randrange(10_000)}"
        data.append((i, " ".join(words)))
    assert classes(spark, data) == sorted(map(repr, brute_components(data, 3, 9, 10)))


def test_keep_one(spark):
    data = near_copies(7) + [(2000, ""), (2001, None), (2002, "")]
    data.append(data[0])
    df = frame(spark, [(i, t, None, None, None) for i, t in data])
    kept = sorted(r.doc_id for r in ngram_join.keep_one_of_each(df, 5, 4, 5).collect())
    comps = brute_components(data, 5, 4, 5)
    assert kept == sorted({c for _, n, c in comps if n} | {2000, 2001, 2002})


def test_keep_one_where_components_share_a_name(spark):
    """Unrelated texts under null ids or one repeated id: one document of each component stays."""
    text = lambda k: " ".join(f"t{k}w{i}" for i in range(40))
    near = lambda k: text(k) + " more"
    data = [(None, text(0)), (None, text(1)), (None, text(2)), (None, near(2)), (5, text(3)), (5, text(4)), (5, near(4)), (None, text(4)),
            (6, text(5)), (None, text(5)), (None, None), (None, "")]
    kept = [(r.doc_id, r.text) for r in ngram_join.keep_one_of_each(frame(spark, [(i, t, None, None, None) for i, t in data]), 5, 4, 5).collect()]
    assert set(kept) <= set(data)
    assert sorted(repr(((t or "").removesuffix(" more"), i)) for i, t in kept) == sorted(map(repr, [
        ("", None), ("", None), (text(0), None), (text(1), None), (text(2), None), (text(3), 5), (text(4), 5), (text(5), 6)]))


def test_bitmap_bounds_the_difference():
    rnd = np.random.default_rng(1)
    for _ in range(50):
        both = rnd.integers(0, 1 << 63, 200, dtype=np.uint64)
        a, b = rnd.integers(0, 1 << 63, 30, dtype=np.uint64), rnd.integers(0, 1 << 63, 20, dtype=np.uint64)
        x, y = (ngram_join.parity_bitmap(np.concatenate([both, s])) for s in (a, b))
        assert sum(int(v).bit_count() for v in (x ^ y).view(np.uint64)) <= 50


def test_components(spark):
    rnd = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(rnd.randrange(100, 160), rnd.randrange(100, 160)) for _ in range(40)] + [(7, 7)]
    label = {}
    for _ in range(200):
        for a, b in edges:
            m = min(label.get(a, a), label.get(b, b))
            label[a] = label[b] = m
    got = {r.node: r.label for r in ngram_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {k: label[k] for k in linked}


def test_order_is_small_on_the_driver(spark):
    """What the driver holds and broadcasts follows what repeats; it had 16 MB for any corpus."""
    texts = ["a b c d e", "b c d x", "b c d y", None, ""]
    docs = ngram_join._keyed(frame(spark, [(i, t, None, None, None) for i, t in enumerate(texts)]), "doc_id", "text")
    order = ngram_join.shingle_order(docs, 3)
    sent = pickle.dumps(order)
    assert len(sent) < 100_000
    back = pickle.loads(sent)
    assert len(back.sieve) == 1 << (ngram_join.SIEVE_BITS - 3)
    first, again = ngram_join.shingle_set(b"a b c d e", 3), ngram_join.shingle_set(b"b c d", 3)
    single, shared = back.prefix(first, len(first))
    assert shared.tolist() == again.tolist() and single.tolist() == [x for x in first.tolist() if x != again[0]]


def test_nothing_left_to_compare_writes_nothing_more(spark, monkeypatch):
    written = []
    write = ngram_join.materialise
    monkeypatch.setattr(ngram_join, "materialise", lambda df, name: written.append(name) or write(df, name))
    assert ngram_join.components(spark.createDataFrame([], "a long, b long")).collect() == []
    assert written == ["cc-edges"]
    written.clear()
    data = [(1, "p q r s t"), (2, "u v w x y"), (3, "p q r s t"), (4, "")]
    assert classes(spark, data) == sorted(map(repr, brute_components(data, 3, 9, 10)))
    assert written.count("cc-edges") == 1 and written.count("jaccard-links") == 1


def one(spark, texts, *cols):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    return [r.fp for r in fingerprint.with_fingerprint(df, F.col("text"), "fp").orderBy("id").collect()]


def test_fingerprint_is_a_multiset_hash(spark):
    a, b, c, ab, ba, aa, none = one(spark, ["first one", "second one", "third", "first one\nsecond one",
                                            "second one\n\nfirst one", "first one\nfirst one", ""])
    assert ab == ba and len({tuple(x) for x in (a, b, c, ab, aa, none)}) == 6 and set(none) == {0}
    pair = spark.createDataFrame([(a, b, ab)], "a array<long>, b array<long>, ab array<long>")
    got = pair.select(fingerprint.insert(F.col("a"), F.col("b")).alias("i"), fingerprint.delete(F.col("ab"), F.col("b")).alias("d")).first()
    assert got.i == ab and got.d == a


def test_lanes_wrap_modulo_a_power(spark):
    """Adding a vector 2**20 times gives the lanes back, without touching the neighbours."""
    full, = one(spark, ["text"])
    df = spark.createDataFrame([([0] + [fingerprint.KEEP] * 42, full)], "x array<long>, y array<long>")
    got = df.select(fingerprint.insert(F.col("x"), F.col("y")).alias("i"),
                    fingerprint.delete(fingerprint.insert(F.col("x"), F.col("y")), F.col("y")).alias("d")).first()
    lanes = lambda v: [(x >> 21 * k) & fingerprint.LANE for x in v for k in range(3)]
    assert lanes(got.i[1:]) == [(fingerprint.LANE + x) & fingerprint.LANE for x in lanes(full[1:])]
    assert got.d == [0] + [fingerprint.KEEP] * 42


def test_edited_fingerprints(spark):
    data = [r for r in rows() if r[0] is not None]
    got = fingerprint.edited_fingerprints(frame(spark, data)).collect()
    assert len(got) == len(data)
    texts = {}
    for i, t, *_ in data:
        texts.setdefault(i, set()).add(t or "")
    order = sorted(texts)
    for r in got:
        here, after = texts[r.doc_id], texts[order[(order.index(r.doc_id) + 1) % len(order)]] | texts[r.doc_id]
        edits = {hashlib.sha256((t[:len(t) - len(t) // 2] + n[:len(t) // 2]).encode()).hexdigest() for t in here for n in after}
        assert r.edited_sha256 in edits and r.n_chars in {len(t) for t in here}
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if r.fingerprint == r.edited_fingerprint:
            assert r.near_edited == 1
    by_text = {}
    for r in got:
        for t in texts[r.doc_id]:
            if len(texts[r.doc_id]) == 1:
                assert by_text.setdefault(t, r.fingerprint) == r.fingerprint


def test_next_document_over_many_ranges(spark):
    """Ids with gaps, an outlier and nulls: each row gets the value of the one after it."""
    rnd = random.Random(8)
    ids = sorted(rnd.sample(range(10_000), 300)) + [10 ** 15]
    df = spark.createDataFrame([(i, 0, f"t{i}") for i in ids] + [(None, 1, "tn")], "id long, tie long, v string").repartition(5)
    got = {r.id: r.next for r in fingerprint.with_next(df, "v", rows_per_bucket=7).collect()}
    line = [None, *ids]
    assert got == {a: f"t{b}" if b is not None else "tn" for a, b in zip(line, line[1:] + line[:1])}
    lone = spark.createDataFrame([(5, 0, "x")], "id long, tie long, v string")
    assert [r.next for r in fingerprint.with_next(lone, "v").collect()] == ["x"]
    assert fingerprint.edited_fingerprints(empty(spark)).collect() == []


def test_ranges_cut_ids_that_many_rows_share(spark):
    """A third of the rows without an id, a third with one id, the rest apart: no range holds much more than its share."""
    from collections import Counter

    from notelake.llm.common import range_of, split_points
    data = [(None, f"a{i}") for i in range(1000)] + [(7, f"b{i}") for i in range(1000)] + [(100 + i, f"c{i}") for i in range(1000)]
    df = spark.createDataFrame(data, "id long, text string").select("id", F.xxhash64("text").alias("tie"), "text")
    points = split_points(df, "id", 30)
    got = df.withColumn("b", range_of(F.col("id"), F.col("tie"), points)).collect()
    assert max(Counter(r.b for r in got).values()) <= 300 and len(points) < 45
    order = sorted(got, key=lambda r: (r.id is not None, r.id or 0, r.tie))
    assert [r.b for r in order] == sorted(r.b for r in got)
    following = {(r.id, r.tie): r.next for r in fingerprint.with_next(df, "text", rows_per_bucket=100).collect()}
    assert all(following[a.id, a.tie] == b.text for a, b in zip(order, order[1:] + order[:1]))
    for same in ([(None, "x")] * 50, [(i % 2, "x") for i in range(50)]):
        lone = spark.createDataFrame(same, "id long, text string").select("id", F.xxhash64("text").alias("tie"), "text")
        assert [r.next for r in fingerprint.with_next(lone, "text", rows_per_bucket=5).collect()] == ["x"] * 50

import random
import re

import numpy as np
import xxhash

from notelake.llm import simhash
from tests.llm.cases import empty, frame, rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text, width=3):
    w = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + width]), 42) for i in range(max(1, len(w) - width + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_labels(fps, errors=3):
    """Every pair compared."""
    fps = sorted(set(fps))
    comp = {f: f for f in fps}
    find = lambda f: f if comp[f] == f else find(comp[f])
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= errors:
                comp[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in fps}


def brute(data):
    fp = [plain_fingerprint(t) for _, t in data]
    label = brute_labels(fp)
    least = {}
    for (i, _), f in zip(data, fp):
        if i is not None:
            least[label[f]] = min(i, least.get(label[f], i))
    return sorted(repr((i, f"{f:016x}", least.get(label[f]))) for (i, _), f in zip(data, fp))


def found(spark, data, **kw):
    df = frame(spark, [(i, t, None, None, None) for i, t in data])
    return sorted(map(repr, map(tuple, simhash.simhash_classes(df, **kw).collect())))


def signed(f):
    return f - (1 << 64) if f >> 63 else f


def labelled(spark, fps):
    df = spark.createDataFrame([(signed(f),) for f in sorted(set(fps))], "fp long")
    return {(r["fp"], r["label"]) for r in simhash.fingerprint_components(df).collect()}


def as_signed(labels):
    """Components named by their smallest signed member."""
    least = {}
    for f, c in labels.items():
        least[c] = min(signed(f), least.get(c, signed(f)))
    return {(signed(f), least[c]) for f, c in labels.items()}


def test_golay_code_is_perfect():
    code = simhash.GolayCode()
    every = np.arange(1 << 23)
    index = code.index(every)
    assert (np.bincount(index) == 2048).all()                      # equal balls fill the space
    word = np.zeros(1 << 12, dtype=np.int64)
    syndrome = code.check[every >> 11] ^ (every & 2047)
    word[every[syndrome == 0] >> 11] = every[syndrome == 0]
    assert (np.bitwise_count(every ^ word[index]) <= 3).all()      # and have radius 3


def test_keys_of_all_patterns_of_errors():
    rnd, keys = random.Random(4), simhash.Keys()
    def entries(f):
        _, key, home = keys.of(np.array([f], dtype=np.uint64))
        assert len(key) == len(set(zip(key.tolist(), home.tolist())))
        return set(key[home].tolist()), set(key[~home].tolist())
    for _ in range(3000):
        f = rnd.getrandbits(64)
        g = f
        for b in rnd.sample(range(64), rnd.randint(0, 3)):
            g ^= 1 << b
        (hf, nf), (hg, ng) = entries(f), entries(g)
        assert hf & ng and hg & nf, (f, g)


def test_fingerprint_is_spark_hash_majority(spark):
    text = "One two THREE\tfour five  six ÉTÉ 漢字 x"
    assert simhash.fingerprint(text.encode(), 3) == plain_fingerprint(text)
    assert simhash.fingerprint(b"a b", 3) == xxhash.xxh64_intdigest("a b", 42)
    assert simhash.fingerprint(None, 3) == simhash.fingerprint(b" \n", 3) == 0
    long = " ".join(f"w{i * i % 991}" for i in range(200_000))
    step = simhash.SHINGLES_AT_ONCE
    assert simhash.fingerprint(long.encode(), 3) == plain_fingerprint(long) and step < 200_000


def test_components_of_dense_and_sparse_fingerprints(spark):
    rnd = random.Random(9)
    fps = [rnd.getrandbits(64) for _ in range(200)] + [0, (1 << 64) - 1, 1 << 63]
    for _ in range(6):                                             # chains and clouds around a few centres
        f = rnd.getrandbits(64)
        for _ in range(60):
            g = f
            for b in rnd.sample(range(64), rnd.randint(1, 4)):
                g ^= 1 << b
            fps.append(g)
            f = g if rnd.random() < 0.3 else f
    for a in range(64):                                            # one dense ball
        fps.append(fps[0] ^ 1 << a)
        fps += [fps[0] ^ 1 << a ^ 1 << b for b in range(a)]
    assert labelled(spark, fps) == as_signed(brute_labels(fps))


def test_classes_match_brute_force(spark):
    rnd = random.Random(2)
    vocab = [f"w{i}" for i in range(300)]
    data = []
    for i in range(250):
        if data and rnd.random() < 0.6:
            words = rnd.choice(data)[1].split()
            for _ in range(rnd.randint(0, 3)):
                words[rnd.randrange(len(words))] = rnd.choice(vocab)
        else:
            words = [rnd.choice(vocab) for _ in range(rnd.randint(1, 120))]
        data.append((1000 - i, " ".join(words)))
    want = brute(data)
    assert sum(1 for r in want if eval(r)[0] != eval(r)[2]) > 30
    assert found(spark, data) == want


def test_classes_odd_rows(spark):
    data = [(r[0], r[1]) for r in rows()] + [(None, "same text twice"), (None, "same text twice"), (7, "same  text\ttwice")]
    assert found(spark, data) == brute(data)
    assert simhash.simhash_classes(empty(spark)).count() == 0

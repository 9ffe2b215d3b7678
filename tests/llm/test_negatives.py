import math
import random

import numpy as np

from notelake.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(data, positives=5, negatives=3, low=50, high=95, per=100):
    """Every anchor against every row, in exact integers."""
    rows = []
    for i, v, label in data:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = math.fmod(label + 1, 10) if i is not None and i % 7 == 0 else label
        rows.append((i, int(label), [int(math.floor(256 * x)) for x in v]))
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for k, (a, label, v) in enumerate(rows):
        if a is None or a % 50:
            continue
        pairs = [(max(-hn._MAX, min(hn._MAX, sum(p * q for p, q in zip(v, w)))), i, own == label)
                 for m, (i, own, w) in enumerate(rows) if m != k and len(w) == len(v)]
        for p in sorted((x for x in pairs if x[2]), key=order)[:positives]:
            fits = [x for x in pairs if not x[2] and low * p[0] <= per * x[0] <= high * p[0]]
            for rank, n in enumerate(sorted(fits, key=order)[:negatives], 1):
                out.append((a, p[1], rank, n[1], p[0], n[0]))
    return sorted(map(repr, out))


def mined(spark, data, **kw):
    return sorted(map(repr, map(tuple, hn.hard_negatives(spark.createDataFrame(data, SCHEMA), **kw).collect())))


def vectors(seed, n, dims=6, copies=0.3):
    rnd = random.Random(seed)
    base = [[rnd.uniform(-1, 1) for _ in range(dims)] for _ in range(12)]
    out = []
    for i in range(n):
        v = rnd.choice(base) if rnd.random() < copies else [x + rnd.gauss(0, 0.2) for x in rnd.choice(base)]
        out.append((i * 5, v, rnd.randrange(4)))
    return out


def test_negatives_match_brute_force(spark):
    data = vectors(1, 400)
    want = brute(data)
    assert len(want) > 200 and mined(spark, data) == want


def test_negatives_do_not_depend_on_blocks(spark):
    data = vectors(2, 600, copies=0.6)
    want = mined(spark, data)
    assert want == brute(data) and mined(spark, data, block_values=300) == want


def test_negatives_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = vectors(3, 120) + [
        (600, None, 1), (650, [0.5] * 6, None), (700, [0.5, None, 1.0, 0.0, 0.0, 0.0], 1), (750, [nan] * 6, 1),
        (800, [inf, 0.0, 0.0, 0.0, 0.0, 0.0], 1), (None, [0.4] * 6, 2), (None, [0.4] * 6, 3), (0, [0.4] * 6, 3), (0, [0.4] * 6, 3),
        (850, [], 1), (855, [], 2), (860, [], 1), (900, [1.0, 2.0], 1), (905, [1.0, 2.0], 1), (910, [1.0, 1.1], 2),
        (-50, [0.3] * 6, 2), (-57, [0.3] * 6, 1), (950, [0.0] * 6, 2), (951, [0.0] * 6, 2), (952, [0.0] * 6, 1),
        (1000, [2.0, 1.0, 0.0], 1), (1005, [2.0, 1.0, 0.0], 1), (None, [1.4, 1.0, 0.0], 2), (1010, [1.4, 1.0, 0.0], 2)]
    want = brute(data)
    assert mined(spark, data) == want
    assert any(r.startswith("(850") for r in want) and any("None" in r for r in want)


def test_negatives_of_huge_components_are_exact(spark):
    data = [(0, [1e15, 3.0], 1), (1, [1e15, 5.0], 1), (2, [9e14, 1e-3], 2), (3, [9e14, 7.0], 2), (50, [3e38, 1.0], 1), (51, [2e38, -1.0], 1),
            (52, [1.0, 1.0], 1), (53, [1e6, 0.5], 2)]
    assert mined(spark, data) == brute(data)


def test_negatives_empty_and_alone(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(50, [1.0], 1)]) == []
    df = spark.createDataFrame([(i, [1.0, i / 9], i % 3, "x", "y") for i in range(60)], SCHEMA + ", row string, score string")
    assert hn.hard_negatives(df).count() == len(brute([(i, [1.0, i / 9], i % 3) for i in range(60)]))


def test_window_ends():
    for p in range(-300, 300):
        lo, hi = hn.window_ends(p, 50, 95, 100)
        assert [s for s in range(-300, 300) if 50 * p <= 100 * s <= 95 * p] == list(range(lo, hi + 1))


def test_exact_scores():
    rng = np.random.default_rng(3)
    a, b = rng.integers(-2**30, 2**30, (5, 3)).astype(float), rng.integers(-2**30, 2**30, (4, 3)).astype(float)
    want = [[max(-hn._MAX, min(hn._MAX, sum(int(p) * int(q) for p, q in zip(x, y)))) for y in b] for x in a]
    assert hn.scores(a, b).tolist() == want

import hashlib
from collections import defaultdict

from notelake.llm import exact_dedup, line_dedup
from tests.llm.cases import CLASHING, empty, frame, rows


def test_exact_marks(spark):
    got = exact_dedup.mark_exact_duplicates(frame(spark), first_digit=4, growth=3).collect()
    groups = defaultdict(list)
    for i, t, *_ in rows():
        groups[t or ""].append(i)
    import hashlib
    want = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_exact_no_digest_decides(spark):
    """Texts that agree up to a digit border, end there or go on."""
    texts = ["a" * n for n in (3, 4, 5, 16, 17, 16, 4)] + ["aaaa\x00", "aaaab", "", "aaaab"]
    data = [(i, t, None, None, None) for i, t in enumerate(texts)]
    got = {r.doc_id: (r.keep_id, r.group_size) for r in
           exact_dedup.mark_exact_duplicates(frame(spark, data), first_digit=4, growth=2).collect()}
    for i, t in enumerate(texts):
        same = [k for k, u in enumerate(texts) if u == t]
        assert got[i] == (max(same), len(same))


def test_exact_groups_of_one_smallest_id(spark):
    """Texts that differ in the first digit only, whose groups have one smallest id (null or repeated)."""
    tail = "t" * 2000
    a, b = "A" * 64 + tail, "B" * 64 + tail
    for ids in ((None, 1, None, 2), (7, 7, 7, 7), (None, None, None, None)):
        data = list(zip(ids, (a, a, b, b)))
        got = exact_dedup.mark_exact_duplicates(frame(spark, [(i, t, None, None, None) for i, t in data])).collect()
        sha = {t: hashlib.sha256(t.encode()).hexdigest() for t in (a, b)}
        keep = {sha[t]: max((i for i, u in data if u == t and i is not None), default=None) for t in (a, b)}
        assert sorted(repr((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256)) for r in got) == \
            sorted(repr((i, keep[sha[t]], 2, i == keep[sha[t]], sha[t])) for i, t in data)


def test_exact_empty_and_drop(spark):
    assert exact_dedup.mark_exact_duplicates(empty(spark)).collect() == []
    kept = exact_dedup.drop_exact_duplicates(frame(spark))
    assert set(CLASHING) < set(kept.columns)
    texts = [r.text or "" for r in kept.collect() if r.doc_id is not None]
    repeated = {rows()[7][1]}
    assert all(texts.count(t) == 1 or t in repeated for t in texts)


def brute_lines(data):
    """Later occurrences of three-line windows by plain loops, in order of id, then text hash."""
    docs = {}
    for i, t in data:
        if t is not None:
            docs[(i is not None, i or 0, t)] = t.split("\n")
    first, cover = {}, defaultdict(set)
    for key in sorted(docs, key=lambda k: k[:2]):
        ls = docs[key]
        for p in range(len(ls) - 2):
            w = tuple(ls[p:p + 3])
            if any(w):
                if w not in first:
                    first[w] = (key, p)
                else:
                    k, q = first[w]
                    cover[key] |= {x for x in range(p, p + 3) if k != key or x > q + 2}
    return {k[1:] if k[0] else (None, k[2]): ("\n".join(x for p, x in enumerate(ls) if p not in cover[k]), len(ls), len(cover[k]))
            for k, ls in docs.items()}


def test_lines_match_brute_force(spark):
    data = [r for r in rows() if r[0] != 2 or r[1].startswith("another") is False]   # one text per id: the order is by id
    got = line_dedup.dedup_lines(frame(spark, data)).select("row.doc_id", "row.text", "new_text", "n_lines", "n_removed").collect()
    want = brute_lines([(r[0], r[1]) for r in data])
    assert len(got) == len(data)
    removed = 0
    for r in got:
        if r.text is None:
            assert (r.new_text, r.n_lines, r.n_removed) == (None, 0, 0)
        else:
            assert (r.new_text, r.n_lines, r.n_removed) == want[(r.doc_id, r.text)], r.doc_id
            removed += r.n_removed
    assert removed > 30


def test_lines_small_cases(spark):
    data = [(1, "a\nb\nc\nd", None, None, None), (2, "x\na\nb\nc\ny", None, None, None), (3, "a\nb", None, None, None),
            (4, "r\nr\nr\nr\nr", None, None, None), (5, "\n\n\n", None, None, None), (6, "\n\n\n", None, None, None)]
    got = {r["row"].doc_id: r.new_text for r in line_dedup.dedup_lines(frame(spark, data)).collect()}
    assert got == {1: "a\nb\nc\nd", 2: "x\ny", 3: "a\nb", 4: "r\nr\nr", 5: "\n\n\n", 6: "\n\n\n"}
    assert line_dedup.dedup_lines(empty(spark)).collect() == []

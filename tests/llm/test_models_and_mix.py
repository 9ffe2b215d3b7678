import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from notelake.llm import lang_id, mixing, url_reputation
from notelake.llm.queries import held_out, source_domain
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm.cases import CLASHING, empty, frame, rows


def brute_ngrams(text):
    """Hashed n-grams of a text, one at a time."""
    c = [32] + [ord(ch.lower()) if ch.isalpha() and len(ch.lower()) == 1 else ord(ch) if ch.isalpha() else 32 for ch in text or ""] + [32, 32]
    out = Counter()
    for i in range(len(c) - 2):
        hs = lang_id.hash_ngrams(np.array(c[i:i + 3], dtype=np.uint32), 1, lang_id.BUCKET_BITS)
        out.update(int(h[0]) for h in hs if h[0] < 1 << lang_id.BUCKET_BITS)
    return out


def test_language_model_matches_brute_force(spark):
    data = [r for r in rows(n=40) if r[1] is None or len(r[1]) < 5000]
    model = lang_id.fit(frame(spark, data))
    counts, n = defaultdict(Counter), Counter()
    for _, t, lang, *_ in data:
        if lang is not None and t:
            counts[lang] += brute_ngrams(t)
            n[lang] += 1
    assert model.langs == sorted(counts)
    width = 1 << lang_id.BUCKET_BITS
    got = {r.doc_id: tuple(r.language) for r in lang_id.predict(frame(spark, data), model).collect()}
    for i, t, *_ in data:
        if [r[0] for r in data].count(i) > 1:
            continue
        grams = brute_ngrams(t)
        if not any(ch.isalpha() for ch in t or ""):
            assert got[i] == ("und", 0.0)
            continue
        s = {}
        for lang in model.langs:
            total = sum(counts[lang].values()) + 0.5 * width
            s[lang] = math.log(n[lang] / sum(n.values())) + sum(k * math.log((counts[lang][g] + 0.5) / total) for g, k in grams.items())
        best = max(s, key=lambda x: s[x])
        assert got[i][0] == best
        assert got[i][1] == pytest.approx(1 / sum(math.exp(v - s[best]) for v in s.values()), abs=1e-9)


def test_language_pieces_do_not_change_the_score(monkeypatch, spark):
    model = lang_id.fit(frame(spark))
    texts = [r[1] for r in rows()]
    whole = model.predict(texts)
    monkeypatch.setattr(lang_id, "PIECE", 37)
    parts = model.predict(texts)
    assert whole[0] == parts[0] and np.allclose(whole[1], parts[1])


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    model = lang_id.fit(docs.filter(~held_out()))
    got = lang_id.predict(docs.filter(held_out()), model).select((F.col("lang") == F.col("language.lang_pred")).alias("ok")).collect()
    assert len(got) > 300 and sum(r.ok for r in got) >= 0.99 * len(got)


def test_language_nothing_to_learn(spark):
    model = lang_id.fit(empty(spark))
    assert {r.language.lang_pred for r in lang_id.predict(frame(spark), model).collect()} == {"und"}
    assert lang_id.predict(empty(spark), model).collect() == []


def test_url_parts_and_rules(spark):
    urls = ["http://A.Example.NET/en/x?y", "https://example.com/de/1#t", "ftp://b.org/fr/?q", "http://net/", "http://x.net", "no scheme/a",
            None, "", "http://myexample.net/en/", "http://a.example.net/EN/", "http://h?x://y/z", "http://É.Org/fr/a\nb", "://", "http://c.org"]
    pages = spark.createDataFrame([(i, u, f"x{i}") for i, u in enumerate(urls)], "page_id long, url string, html string")
    pages = pages.select("*", *[F.lit(0).alias(c) for c in CLASHING])
    labels = spark.createDataFrame([], "page_id long, bad int")
    rules = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
    got = {r["row"].page_id: (r.host, r.path, r.rule, r.verdict) for r in url_reputation.judge_urls(pages, labels, rules).collect()}
    assert [got[i] for i in range(len(urls))] == [
        ("a.example.net", "/en/x", "example.net/en/", "allow"), ("example.com", "/de/1", "example.com/de/", "block"),
        ("b.org", "/fr/", "org/fr/", "allow"), ("net", "/", "net/", "block"), ("x.net", "", None, "allow"), ("", "", None, "allow"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("myexample.net", "/en/", "net/", "block"),
        ("a.example.net", "/EN/", "net/", "block"), ("h", "", None, "allow"), ("É.org", "/fr/a\nb", "org/fr/", "allow"),
        ("", "", None, "allow"), ("c.org", "", None, "allow")]
    assert url_reputation.judge_urls(pages.limit(0), labels, rules).collect() == []


def test_hosts_of_a_bad_domain_are_blocked(spark):
    """Labels that differ by domain: hosts are blocked on evidence, and not for lack of it."""
    hosts = {"a.bad.com": 1, "b.bad.com": 1, "a.good.com": 0, "b.good.com": 0, "x.new.org": None}
    data = [(f"http://{h}/{k}", b) for h, b in hosts.items() for k in range(40)]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(data)], "page_id long, url string")
    labels = spark.createDataFrame([(i, b) for i, (_, b) in enumerate(data)], "page_id long, bad int")
    got = {(r.host, r.verdict, r.bound > 0.5) for r in url_reputation.judge_urls(pages, labels).collect()}
    assert got == {(h, "block" if b else "allow", b == 1) for h, b in hosts.items()}


def test_reputation_shrinks_to_the_levels_above(spark):
    hosts = [("a.good.com", 40, 0), ("b.good.com", 0, 0), ("x.bad.com", 30, 30), ("y.bad.com", 25, 24), ("z.bad.com", 0, 0),
             ("one.new.co.uk", 1, 1), ("", 0, 0)]
    rep = {r.host: r for r in url_reputation.host_reputation(spark.createDataFrame(hosts, "host string, n long, bad long")).collect()}
    assert rep["x.bad.com"].bound > 0.5 > rep["a.good.com"].mean
    assert rep["z.bad.com"].mean > 0.5 > rep["b.good.com"].mean      # unseen hosts follow their domain
    assert rep["one.new.co.uk"].mean < 0.95 and rep["one.new.co.uk"].bound < rep["x.bad.com"].bound   # one page is weak evidence
    parts = spark.createDataFrame([("a.b.co.uk",), ("a.b.com",), ("com",), ("",)], "h string").select(
        url_reputation.registered_domain(F.col("h")).alias("d"), url_reputation.url_suffix(F.col("h")).alias("s")).collect()
    assert [tuple(r) for r in parts] == [("b.co.uk", "co.uk"), ("b.com", "com"), ("com", "com"), ("", "")]


def brute_fill(given, children):
    """Hand out by weight; what is over a cap goes round again."""
    budget, left = {k: 0.0 for k in children}, given
    open_ = set(children)
    while left > 1e-9 and open_:
        total = sum(children[k][0] for k in open_)
        full = {k for k in open_ if budget[k] + left * children[k][0] / total >= children[k][1]}
        if not full:
            for k in open_:
                budget[k] += left * children[k][0] / total
            break
        for k in full:
            left -= children[k][1] - budget[k]
            budget[k] = children[k][1]
        # the rest is handed out again from what the others have
        left += sum(budget[k] for k in open_ - full)
        for k in open_ - full:
            budget[k] = 0.0
        open_ -= full
    return budget


def test_share_out_matches_brute_force(spark):
    rnd = random.Random(6)
    for _ in range(6):
        fams = {f: {f"c{i}": (rnd.choice([0.5, 1.0, 2.0]), float(rnd.randint(0, 50))) for i in range(rnd.randint(1, 6))} for f in "pqr"}
        given = {f: rnd.uniform(0, sum(c for _, c in ch.values())) for f, ch in fams.items()}
        df = spark.createDataFrame([(f, c, w, cap, given[f]) for f, ch in fams.items() for c, (w, cap) in ch.items()],
                                   "fam string, child string, weight double, cap double, given double")
        got = {(r.fam, r.child): r.budget for r in mixing.share_out(df, ["fam"]).collect()}
        for f, ch in fams.items():
            for c, b in brute_fill(given[f], ch).items():
                assert got[f, c] == pytest.approx(b, abs=1e-6)


def test_mix_takes_prefixes_of_seeded_epochs(spark):
    import hashlib
    data = rows()
    args = dict(budget=0.7, epochs=2, seed=3, domain_weights={"d0": 0.2, "d1": 0.8}, lang_weights={"en": 2.0})
    got = mixing.mix_sources(frame(spark, data), source_domain(), **args).collect()
    assert len(got) == len(data)
    leaves = defaultdict(list)
    for r in got:
        t = r["row"].text or ""
        leaves[r.domain, r.lang, r.source].append((r["row"].doc_id, hashlib.md5(t.encode()).hexdigest(), r.n_tokens, r.copies))
        assert r.n_tokens == len([w for w in t.replace("\u3000", "x").split()]) and 0 <= r.copies <= 2
    cap = {k: 2.0 * sum(d[2] for d in v) for k, v in leaves.items()}
    total = sum(cap.values()) / 2 * 0.7
    by = lambda n: {k[:n]: sum(c for q, c in cap.items() if q[:n] == k[:n]) for k in cap}
    wd, wl = (lambda d: {"d0": 0.2, "d1": 0.8}.get(d, 1.0)), (lambda x: {"en": 2.0}.get(x, 1.0))
    dom = brute_fill(total, {k: (wd(k[0]), c) for k, c in by(1).items()})
    for d in dom:
        lang = brute_fill(dom[d], {k: (wl(k[1]), c) for k, c in by(2).items() if k[:1] == d})
        for x in lang:
            src = brute_fill(lang[x], {k: (1.0, c) for k, c in cap.items() if k[:2] == x})
            for k, budget in src.items():
                docs = leaves[k]
                tokens = sum(d[2] for d in docs)
                whole = int(budget / tokens + 1e-9) if tokens else 2
                order = sorted(docs, key=lambda d: hashlib.md5(f"3:{whole}:{'' if d[0] is None else d[0]}:{d[1]}".encode()).hexdigest())
                at, rest = 0, budget - whole * tokens
                marks = [f"{'' if d[0] is None else d[0]}:{d[1]}" for d in order]
                for j, d in enumerate(order):
                    at += d[2]
                    upto = at + sum(order[m][2] for m in range(j + 1, len(order)) if marks[m] == marks[j])
                    if abs(upto - rest) > 1e-6:
                        assert d[3] == whole + (rest > 0 and upto <= rest), (k, d)
    assert mixing.mix_sources(empty(spark), source_domain()).collect() == []


def test_mix_counts_rows_that_repeat_in_two_leaves_apart(spark):
    """Equal ids and texts in two sources: each source keeps to its own budget."""
    data = [(i, f"one two three {i}", "en", s, None) for i in range(200) for s in ("s1", "s2")]
    got = mixing.mix_sources(frame(spark, data), F.lit("d"), budget=0.5, epochs=2, source_weights={"s1": 1.0, "s2": 3.0}).collect()
    taken = {s: sum(r.copies * r.n_tokens for r in got if r.source == s) for s in ("s1", "s2")}
    assert len(got) == 400 and 190 <= taken["s1"] <= 200 and 590 <= taken["s2"] <= 600


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, seen, SF_SMALL)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
        seen = spark.createDataFrame(out.collect(), out.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, seen, SF_SMALL).collect()
    assert len(last) == seen.count() and all(r.round_trip for r in last)
    ran = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert sorted(map(repr, ran)) == sorted(map(repr, last))


def test_pipeline_stages_on_odd_rows(spark):
    for df in (frame(spark), empty(spark)):
        n = df.count()
        sizes = []
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, SF_SMALL)
            if name != "bpe_round_trip":
                assert out.columns == df.columns, name
            sizes.append(out.count())
        assert sizes[1] == n and sizes[4] == n and (n == 0) == (sizes[0] == 0)

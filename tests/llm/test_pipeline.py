"""The whole pipeline on the smallest tables, stage by stage against plain restatements."""

import hashlib
from collections import Counter

import duckdb
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as P
from notelake.llm import queries
from tests.conftest import SF_SMALL
from tests.llm.test_exact_and_lines import brute_lines
from tests.llm.test_near import brute_components


def test_pipeline_matches_plain_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    stages = dict(P.STAGES)
    rows = {r.doc_id: r for r in docs.collect()}

    seen = spark.createDataFrame(stages["language_id"](spark, docs, SF_SMALL).collect(), docs.schema)
    assert {r.doc_id for r in seen.collect()} == {i for i, r in rows.items() if any(c.isalpha() for c in r.text or "")}

    lines = stages["line_dedup"](spark, seen, SF_SMALL).collect()
    want = brute_lines([(r.doc_id, r.text) for r in seen.collect()])
    assert all(r.text == want[(r.doc_id, rows[r.doc_id].text)][0] and r.n_chars == len(r.text) for r in lines)
    seen = spark.createDataFrame(lines, docs.schema)

    kept = stages["ngram_jaccard"](spark, seen, SF_SMALL).collect()
    comps = brute_components([(r.doc_id, r.text) for r in lines], 5, 4, 5)
    assert sorted(r.doc_id for r in kept) == sorted({c for _, n, c in comps if n} | {i for i, n, _ in comps if not n})
    seen = spark.createDataFrame(kept, docs.schema)

    mixed = stages["mix_sources"](spark, seen, SF_SMALL).collect()
    con = duckdb.connect()
    con.register("documents", seen.toPandas())
    sql = queries._mix_oracle().replace("* 0.6::DOUBLE", "* 1.0::DOUBLE")
    copies = {i: c for i, c in con.sql(f"SELECT doc_id, copies FROM ({sql})").fetchall() if c}
    assert Counter(r.doc_id for r in mixed) == copies

    coded = stages["bpe_round_trip"](spark, spark.createDataFrame(mixed, docs.schema), SF_SMALL).collect()
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in mixed}
    assert len(coded) == len(mixed)
    for r in coded:
        ids = lib.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.round_trip and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert sorted(map(repr, P.run(spark, SF_SMALL).collect())) == sorted(map(repr, coded))

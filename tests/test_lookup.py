"""Large dictionaries, counters in the pass of a write, limits of a group, positions, rejected lines."""

import random

import pytest
from pyspark.sql import functions as F

from notelake.operators import brands as BR
from notelake.operators import joins as J
from notelake.operators import notify as NT
from notelake.operators import render as RD
from notelake.operators import routing as R
from notelake.sources.messages import read_messages, rejected_messages


def brute_first(texts, entries):
    out = {}
    for i, t in texts:
        hits = [(rank, term.lower(), value) for term, value, rank in entries if t is not None and term is not None and term.lower() in t.lower()]
        out[i] = min(hits)[2] if hits else None
    return out


def test_index_of_terms_equals_search_in_rank_order(spark):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdé😀İ ") for _ in range(rnd.randint(1, 9)))
    entries = [(word(), f"v{i}", rnd.randint(1, 500)) for i in range(900)] + [(None, "null", 0), ("ABCD", "upper", 1), ("abcd", "low", 1)]
    texts = [(i, " ".join(word() for _ in range(rnd.randint(0, 6)))) for i in range(150)] + [(900, None), (901, ""), (902, "x" * 50 + "AbCd"), (903, "abcd")]
    df = spark.createDataFrame(texts, "i int, t string")
    ranked = spark.createDataFrame(entries, "keyword string, brand string, rank int")
    assert len(entries) > J.ARRAY_TERMS
    got = {r.i: r.match for r in BR.first_contained(df, F.col("t"), ranked).collect()}
    low = [(i, None if t is None else t.replace("İ", "i̇")) for i, t in texts]
    assert got == brute_first(low, [(e[0] and e[0].replace("İ", "i̇"), *e[1:]) for e in entries])
    few = ranked.filter("rank <= 60").limit(J.ARRAY_TERMS)
    by_array = {r.i: r.match for r in BR.first_contained(df, F.col("t"), few).collect()}
    assert by_array == {r.i: r.m for r in J.first_indexed(df, F.lower("t"), few, "keyword", "brand", "m").collect()}


def test_index_with_an_empty_term_and_an_empty_dictionary(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None)], "i int, t string")
    one = spark.createDataFrame([("", "all", 5), ("b", "b", 1), ("zz", "z", 0)], "keyword string, brand string, rank int")
    assert {r.i: r.m for r in J.first_indexed(df, F.col("t"), one, "keyword", "brand", "m").collect()} == {1: "b", 2: None}
    assert [r.m for r in J.first_indexed(df, F.col("t"), one.limit(0), "keyword", "brand", "m").collect()] == [None, None]


def test_large_dictionary_is_no_array_and_no_cross_product(spark):
    ranked = spark.range(20_000).select(F.concat(F.lit("term "), F.col("id").cast("string"), F.lit("x")).alias("keyword"), F.col("id").cast("string").alias("brand"),
                                        F.col("id").alias("rank"))
    df = spark.range(2000).select("id", F.concat(F.lit("about term "), (F.col("id") * 7).cast("string"), F.lit("x and more")).alias("t"))
    out = BR.first_contained(df, F.col("t"), ranked)
    assert out.filter(F.col("match") == (F.col("id") * 7).cast("string")).count() == 2000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_counters_come_with_the_write(spark, tmp_path):
    df = spark.createDataFrame([(i, o) for i, o in enumerate(["created", "errors", "created", "skipped_old", "created"])], "i int, outcome string")
    counted, seen = R.observed(df, {o: F.col("outcome") == o for o in R.MBOX_OUTCOMES})
    counted.write.parquet(f"file://{tmp_path}/out")
    want = {r.outcome: r.n for r in R.import_stats(df).collect()}
    got = seen.get
    assert got.pop("rows") == 5 and {k: v for k, v in got.items() if v} == want


@pytest.mark.parametrize("n", [1, 3, 2000])
def test_latest_of_each_account(spark, n):
    rows = [(f"m{i:03d}", None if i % 10 == 0 else f"a{i % 3}", i // 4 if i % 9 else None) for i in range(120)]
    df = spark.createDataFrame(rows, "message_id string, account string, ts long")
    want = set()
    for a in {r[1] for r in rows}:
        mine = sorted((r for r in rows if r[1] == a), key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))
        want |= {r[0] for r in mine[:n]}
    out = R.cap_per_account(df, n)
    assert {r.message_id for r in out.collect()} == want
    assert ("WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()) == (n <= 1000)


def test_scanned_and_rejected_are_all_lines(spark, tmp_path):
    lines = ['{"id": "a", "labelIds": ["X"]}', "not json", '{"id": ', '{"account": "no id"}', "[]", '{"id": "b"}']
    spark.createDataFrame([(x,) for x in lines], "v string").coalesce(1).write.text(f"file://{tmp_path}/in")
    path = f"file://{tmp_path}/in"
    good = sorted(r.message_id for r in read_messages(spark, path).collect())
    bad = sorted((r.reason, r.line) for r in rejected_messages(spark, path).collect())
    assert good == ["a", "b"] and [r for r, _ in bad].count("not_json") >= 2 and len(good) + len(bad) == len(lines)
    assert ("not_json", "not json") in bad


def test_display_cuts_are_off_by_default(spark):
    long = "x" * 400
    df = spark.createDataFrame([("m", long, long, "e", "a", long, "d", "u")], "message_id string, subject string, sender string, sender_email string, "
                               "account string, snippet string, date string, url string")
    whole, cut = NT.notification_payload(df).first(), NT.notification_payload(df, **NT.SHOWN).first()
    assert long in whole.header and long in whole.from_field and long in whole.snippet_block
    assert cut.header.endswith("…") and cut.snippet_block.endswith("…_")
    row = spark.createDataFrame([("a", "f", long, "s", "n", "e", "b")], "account string, from_hdr string, to_hdr string, subject string, sender_name string, "
                                "sender_address string, body string").select(
        "*", F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"), F.array().cast("array<string>").alias("display_labels"),
        F.array().cast("array<string>").alias("attachment_names"), F.array().cast("array<struct<original:string,saved:string>>").alias("saved_names"))
    for size, chars in ((400, None), (200, RD.RECIPIENT_CHARS)):
        assert f'to: "{"x" * size}"\n' in row.select(RD.render_note("mbox", chars).alias("n")).first().n

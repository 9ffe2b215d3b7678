"""The registered queries of the operators: each applies its operator to a whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notelake.llm import alignment, bpe, exact_dedup, fingerprint, hard_negatives, lang_id, line_dedup, mixing, ngram_join
from notelake.llm import simhash, token_counts, token_store, url_reputation
from notelake.llm.common import table
from notelake.session import shared_path

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@_query("op6_exact_dedup", """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(text) AS text_sha256
FROM d WINDOW w AS (PARTITION BY text)""")
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_exact_duplicates(table(spark, sf_dir, "documents"))


@_query("op2_line_dedup", """
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
p AS (SELECT doc_id, unnest(lines) AS line, unnest(generate_series(0, len(lines) - 1)) AS pos FROM l),
w AS (SELECT doc_id, pos, line AS l1, lead(line, 1) OVER o AS l2, lead(line, 2) OVER o AS l3
      FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
f AS (SELECT *, min({'id': doc_id, 'pos': pos}) OVER (PARTITION BY l1, l2, l3) AS first
      FROM w WHERE l3 IS NOT NULL AND (l1 <> '' OR l2 <> '' OR l3 <> '')),
c AS (SELECT DISTINCT doc_id, pos + k AS pos FROM f, (SELECT unnest([0, 1, 2]) AS k)
      WHERE NOT (doc_id = first.id AND pos = first.pos)
        AND (doc_id <> first.id OR pos + k >= first.pos + 3)),
r AS (SELECT p.doc_id, coalesce(string_agg(p.line, chr(10) ORDER BY p.pos) FILTER (c.pos IS NULL), '') AS text,
             count(*) AS n_lines, count(c.pos) AS n_removed
      FROM p LEFT JOIN c ON p.doc_id = c.doc_id AND p.pos = c.pos GROUP BY p.doc_id)
SELECT d.doc_id, r.text, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
FROM documents d LEFT JOIN r ON d.doc_id = r.doc_id""")
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("row.doc_id", F.col("new_text").alias("text"), "n_lines", "n_removed")


#: Rules of the URL query: (host and path, verdict).
URL_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def _url_oracle() -> str:
    strength = lambda t: f"""SELECT CASE WHEN coalesce(sum(n), 0) = 0 THEN 1.0
        WHEN sum(bad * bad / n) / sum(n) - pow(sum(bad) / sum(n), 2)
             - sum(bad) / sum(n) * (1 - sum(bad) / sum(n)) * count(*) / sum(n) <= 0 THEN 1000.0
        ELSE least(1000.0, greatest(1.0, sum(bad) / sum(n) * (1 - sum(bad) / sum(n)) / (
             sum(bad * bad / n) / sum(n) - pow(sum(bad) / sum(n), 2)
             - sum(bad) / sum(n) * (1 - sum(bad) / sum(n)) * count(*) / sum(n)) - 1)) END AS k FROM {t} WHERE n > 0"""  # noqa: E731
    fits = lambda r: (lambda h, p: f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}'))")(*r.split("/", 1))
    rules = sorted(URL_RULES, key=lambda r: -len(r[0]))
    rule = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r}'" for r, _ in rules) + " END"
    verdict = "CASE " + " ".join(f"WHEN rule = '{r}' THEN '{v}'" for r, v in rules) + \
        " WHEN bound > 0.5 THEN 'block' ELSE 'allow' END"
    two = ", ".join(f"'{x}'" for x in url_reputation.TWO_LABEL_SUFFIXES)
    last = lambda k: f"array_to_string(list_slice(string_split(host, '.'), -{k}, -1), '.')"
    return f"""
WITH u AS (SELECT page_id,
    coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
known AS (SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 WHEN quality IS NOT NULL THEN 0 END) AS bad FROM labels GROUP BY doc_id),
h AS (SELECT host, count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS bad,
    CASE WHEN {last(2)} IN ({two}) THEN {last(3)} ELSE {last(2)} END AS domain,
    CASE WHEN {last(2)} IN ({two}) THEN {last(2)} ELSE {last(1)} END AS suffix
    FROM u LEFT JOIN known ON page_id = doc_id GROUP BY host),
d AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY ALL),
k0 AS ({strength('s')}), k1 AS ({strength('d')}), k2 AS ({strength('h')}),
ms AS (SELECT suffix, (bad + k * (SELECT (sum(bad) + 1) / (sum(n) + 2) FROM s)) / (n + k) AS m FROM s, k0),
md AS (SELECT d.suffix, domain, (bad + k * m) / (n + k) AS m FROM d JOIN ms USING (suffix), k1),
ab AS (SELECT host, n, bad, bad + k * m AS a, n - bad + k * (1 - m) AS b FROM h JOIN md USING (suffix, domain), k2),
rep AS (SELECT host, n, bad, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bound FROM ab),
j AS (SELECT *, {rule} AS rule FROM u)
SELECT page_id, host, path, rule, {verdict} AS verdict, n::BIGINT AS host_labelled, bad::BIGINT AS host_bad
FROM j JOIN rep USING (host)"""


@_query("op9_url_filters", _url_oracle())
def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled outcomes: ``labels`` by page id; bad is low quality or toxic."""
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNotNull(), 0)
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    out = url_reputation.judge_urls(table(spark, sf_dir, "pages"), labels, URL_RULES)
    return out.select("row.page_id", "host", "path", "rule", "verdict", "host_labelled", "host_bad")


#: Parameters of the mix: 0.6 of all tokens, at most two epochs of any source.
MIX = dict(budget=0.6, epochs=2, seed=7, domain_weights={"d0": 0.5, "d1": 0.3, "d2": 0.2},
           lang_weights={"en": 0.5, "fr": 0.2, "de": 0.2, "es": 0.1})


def source_domain(source: str = "source") -> Column:
    """The domain of a source: its trailing number modulo 3 (a stand-in for a source list)."""
    return F.concat(F.lit("d"), F.pmod(F.coalesce(F.expr(
        f"try_cast(regexp_extract({source}, '([0-9]{{1,9}})$', 1) AS int)"), F.lit(0)), F.lit(3)).cast("string"))


def _mix_oracle() -> str:
    weight = lambda key, w: "CASE " + " ".join(f"WHEN {key} = '{k}' THEN {v}" for k, v in w.items()) + " ELSE 1.0 END"
    fill = lambda t, fam, keys: f"""
      (SELECT {keys}, CASE WHEN cap <= weight * level THEN cap
         ELSE weight * max(CASE WHEN NOT cap <= weight * level THEN level END) OVER (PARTITION BY {fam}) END AS budget
       FROM (SELECT *, (given - coalesce(sum(cap) OVER (PARTITION BY {fam} ORDER BY cap / weight, cap, {keys}
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (PARTITION BY {fam}
               ORDER BY cap / weight, cap, {keys} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM {t}))"""  # noqa: E731
    return f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    'd' || (coalesce(try_cast(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS INT), 0) % 3) AS domain,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens, md5(coalesce(text, '')) AS tie FROM documents),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::DOUBLE AS tokens, sum(n_tokens) * 2.0::DOUBLE AS cap, 1.0::DOUBLE AS weight FROM d GROUP BY ALL),
lg AS (SELECT domain, lang, sum(cap) AS cap, ({weight('lang', MIX['lang_weights'])})::DOUBLE AS weight FROM leaf GROUP BY domain, lang),
dm AS (SELECT 1 AS root, domain, sum(cap) AS cap, ({weight('domain', MIX['domain_weights'])})::DOUBLE AS weight FROM lg GROUP BY domain),
dm2 AS (SELECT *, (SELECT sum(cap) / 2 * 0.6::DOUBLE FROM dm) AS given FROM dm),
dmb AS {fill('dm2', 'root', 'domain')},
lg2 AS (SELECT lg.*, budget AS given FROM lg JOIN dmb USING (domain)),
lgb AS {fill('lg2', 'domain', 'domain, lang')},
lf2 AS (SELECT leaf.*, budget AS given FROM leaf JOIN lgb USING (domain, lang)),
lfb AS {fill('lf2', 'domain, lang', 'domain, lang, source')},
b AS (SELECT domain, lang, source, CASE WHEN tokens > 0 THEN floor(budget / tokens + 1e-9) ELSE 2 END::BIGINT AS whole,
    CASE WHEN tokens > 0 THEN budget ELSE 0.0 END AS budget, tokens FROM lfb JOIN leaf USING (domain, lang, source)),
m AS (SELECT d.*, whole, greatest(budget - whole * tokens, 0.0) AS rest,
    md5('7:' || whole || ':' || coalesce(doc_id::VARCHAR, '') || ':' || tie) AS mark FROM d JOIN b USING (domain, lang, source)),
r AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY mark) AS upto,
    sum(n_tokens) OVER (PARTITION BY domain, lang, source, left(mark, 3)) AS in_slice FROM m)
SELECT doc_id, domain, lang, source, n_tokens, whole + (rest > 0 AND upto <= rest)::BIGINT AS copies FROM r"""


@_query("op10_mix_sources", _mix_oracle())
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix_sources(table(spark, sf_dir, "documents"), source_domain(), **MIX)
    return out.select("row.doc_id", "domain", "lang", "source", "n_tokens", "copies")


@_query("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = token_counts.UnigramVocabulary.load(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocab)


@_query("op3_token_store")
def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text with the end id 2, written to a store in the shared folder and read back."""
    path = shared_path(spark, "token-store")
    token_store.write_token_store(table(spark, sf_dir, "documents"), path,
                                  public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_store.read_index(spark, path)


@_query("op4_bpe_round_trip")
def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                 keep=[F.col("doc_id")])
    return out.select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def held_out() -> Column:
    """Documents that no model of these queries learns from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


@_query("op8_language_id")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = lang_id.fit(docs.filter(~held_out()))
    out = lang_id.predict(docs, model)
    return out.select("doc_id", held_out().alias("held_out"), "language.lang_pred", "language.score")


@_query("op5_fingerprints")
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_fingerprints(table(spark, sf_dir, "documents"))


@_query("op7_ngram_jaccard")
def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles, similarity 0.9."""
    return ngram_join.jaccard_classes(table(spark, sf_dir, "documents"), width=3, num=9, den=10)


@_query("op11_hard_negatives", """
WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, list_inner_product(a.vec, b.vec)::BIGINT AS score
    FROM v a JOIN v b ON a.id <> b.id WHERE a.id % 50 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT p.*, s.id AS negative_id, s.score AS negative_score,
        row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id)::INT AS rank
    FROM p JOIN s USING (anchor_id) WHERE NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3""")
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


@_query("op12_simhash")
def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles, at most three differing bits."""
    return simhash.simhash_classes(table(spark, sf_dir, "documents"), width=3, errors=3)


@_query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                  public_tokenizers.path("piece_bpe_32k.model"))

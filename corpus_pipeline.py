"""Corpus pipeline, registered as query ``pipeline``: language ID, line dedup, n-gram Jaccard
join, mixing of sources, BPE encoding and decoding.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet
and read again as the next stage's documents. All but the last return the columns they got.
The first, third and last stage need Python in the tasks, so there is no SQL for the whole;
the stages are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notelake.llm import bpe, lang_id, line_dedup, mixing, ngram_join
from notelake.llm.common import table
from notelake.session import materialise
from notelake.llm.queries import held_out, source_domain

#: A document whose best language has a lower posterior than this is rejected. The posterior of a whole
#: text is near 1 whatever its language, so in fact only documents without a letter go.
MIN_SCORE = 0.5
#: Near duplicates: word shingles of five words, similarity 4/5 or more.
NEAR = dict(width=5, num=4, den=5)
#: The mix takes as many tokens as there are, from at most two epochs of a source.
MIX = dict(budget=1.0, epochs=2, seed=7, domain_weights={"d0": 0.5, "d1": 0.3, "d2": 0.2},
           lang_weights={"en": 0.5, "fr": 0.2, "de": 0.2, "es": 0.1})


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter. A text in a language never learnt stays, as its posterior is near
    1 for one of the learnt ones."""
    model = lang_id.fit(docs.filter(~held_out()))
    judged = lang_id.predict(docs.select(F.struct("*").alias("row"), "text"), model, out="language")
    return judged.filter((F.col("language.lang_pred") != "und") & (F.col("language.score") >= MIN_SCORE)).select("row.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that later occurrences of repeated windows cover."""
    out = line_dedup.dedup_lines(docs)
    new = {"text": F.col("new_text"), "n_chars": F.length("new_text").cast("long")}
    return out.select(*[new[c].alias(c) if c in new else F.col("row").getField(c).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones."""
    return ngram_join.keep_one_of_each(docs, **NEAR)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    out = mixing.mix_sources(docs, source_domain(), **MIX)
    return out.filter("copies > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")) \
        .select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text decoded from them."""
    keep = [F.col("doc_id"), F.col("lang"), F.col("source"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha")]
    out = bpe.round_trip_digests(docs, public_tokenizers.path("byte_bpe_50k.json"), keep=keep)
    return out.select("row.doc_id", "row.lang", "row.source", "n_tokens", "ids_sha256", "decoded_sha256",
                      (F.col("decoded_sha256") == F.col("row.sha")).alias("round_trip"))


STAGES = [("language_id", language_id), ("line_dedup", dedup_lines), ("ngram_jaccard", near_duplicates),
          ("mix_sources", mix), ("bpe_round_trip", encode)]

#: None: SQL cannot express the first, third and last stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

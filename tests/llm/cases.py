"""Rows that every operator must handle: nulls in any column, empty and very long texts, ties
and repeated rows, an empty table, extra columns with clashing names."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977}" for i in range(60_000))


def rows(seed=5, n=60):
    rnd = random.Random(seed)
    vocab = ["the", "of", "and", "Tree", "house", "été", "naïve", "漢字", "zero", "one", "two,", "three.", "x", "😀"]
    line = lambda k: " ".join(rnd.choice(vocab) for _ in range(k))
    shared = [line(9) for _ in range(6)]
    out = []
    for i in range(n):
        body = [line(rnd.randint(1, 12)) for _ in range(rnd.randint(1, 8))]
        if i % 3 == 0:
            at = rnd.randint(0, len(body))
            body[at:at] = shared[:rnd.randint(3, 6)]
        out.append((i * 2, "\n".join(body), rnd.choice(["en", "fr", None]), rnd.choice(["src0", "src1", None]), None))
    copies = [(201, out[4][1], "en", "src0", 1), (203, out[4][1], None, None, None), out[7], out[7]]
    odd = [(301, None, "en", "src0", 0), (303, "", "fr", "src1", 0), (305, None, None, None, None),
           (None, "no id at all here", "en", "src0", 5), (None, None, None, None, None), (307, "1234 5678 !!", "en", "src0", 3),
           (309, LONG, "en", "src0", len(LONG)), (311, "\n\n\n\n\n", "en", "src0", 5), (313, "   ", "en", "src1", 3),
           (315, "one", "en", "src1", 3), (317, "one two", "en", "src1", 7), (319, "a\n" * 9 + "a", "fr", "src1", 19),
           (321, LONG + " and more", "en", "src1", 9), (2, "another text for id two", "fr", "src0", 4)]
    return out + copies + odd


#: Names that the operators use inside.
CLASHING = ("row", "id", "tie", "pos", "lines", "cov", "n", "bucket", "path", "rest", "digit", "size", "key", "hash", "idk",
            "cls", "grp", "token", "a", "b", "domain", "copies", "n_tokens", "host", "score", "lang_pred", "guest", "next",
            "new_text", "text_sha256", "keep_id", "doc", "fp", "slice", "mark", "budget", "ids", "start", "value", "first")


def frame(spark, data=None, clashing=True):
    df = spark.createDataFrame(rows() if data is None else data, SCHEMA)
    if clashing:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHING)])
    return df


def empty(spark):
    return frame(spark, [])

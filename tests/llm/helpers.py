from __future__ import annotations

import random

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # columns that clash with what operators compute
        T.StructField("score", T.StringType()),
        T.StructField("n_tokens", T.StringType()),
        T.StructField("t", T.StringType()),
        T.StructField("block", T.StringType()),
    ]
)

WORDS = {
    "en": "the of and stone river walking house that with from under bright winter morning people".split(),
    "de": "der die und stein fluss haus nicht durch unter winter morgen leute straße grün wald".split(),
}


def sentence(draw: random.Random, lang: str, n: int) -> str:
    return " ".join(draw.choice(WORDS[lang]) + draw.choice(["", "", str(draw.randint(0, 99))]) for _ in range(n))


def documents(spark, rows):
    """A documents table from (doc_id, text, lang) rows."""
    full = [(i, text, lang, "src0", None, "x", "y", "z", "b") for i, text, lang in rows]
    return spark.createDataFrame(full, DOCS)


def awkward(spark):
    """Nulls, empty and white-space texts, one very long text, repeated rows and ids."""
    draw = random.Random(3)
    rows = [
        (1, None, "en"), (2, "", "en"), (3, " \t\n ", None), (4, "a", "en"), (5, "1234 !!", "de"),
        (6, sentence(draw, "en", 40), "en"), (7, sentence(draw, "de", 40), "de"),
        (8, sentence(draw, "en", 40_000), "en"), (9, "x" * 200_000, None),
        (10, "Ωμέγα 你好 \x1c  é̂ 😀", None), (None, "no id here at all", "en"), (None, None, None),
    ]
    rows += [(11, "twice the same words in a row", "en")] * 2 + [(12, "twice the same words in a row", "en")]
    return documents(spark, rows)

"""Small documents with every odd case, and random text."""

from __future__ import annotations

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                       # names that operators use themselves
                       T.StructField("score", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("row", T.StringType()),
                       T.StructField("_hash", T.StringType()), T.StructField("topic", T.StringType())])


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 8))) for _ in range(n))


def frame(spark, rows):
    """Rows of (doc_id, text[, lang, source]) as a documents table with clashing extra columns."""
    full = [(r[0], r[1], *(r[2:4] if len(r) > 2 else ("en", "src0")), None if r[1] is None else len(r[1]), "x", 1, "y", None, "z") for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd_rows():
    rng = random.Random(3)
    long = words(rng, 3000)
    return [(1, None, "en", None), (2, "", None, "a"), (3, " \n\t ", "en", "a"), (4, "One word", "en", "a"), (4, "One word", "en", "a"),
            (5, "one word", None, "b"), (None, "a text without an id", "de", "b"), (None, "a text without an id", "de", "b"),
            (6, long, "en", "a"), (7, long + " more", "en", None), (8, "\U0001F600 é ß 日本 123", "fr", "a"), (9, "12345 !!", "en", "a")]

"""Rows that every operator over documents must stand."""

import os

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")
LONG = "the quick brown fox jumps over the lazy dog and runs " * 20_000
EDGE = [
    (1, "the quick brown fox jumps over the lazy dog", "en"), (1, "the quick brown fox jumps over the lazy dog", "en"), (1, "another text under the same id", "en"),
    (None, "the quick brown fox jumps over the lazy dog", None), (2, None, "en"), (3, "", "fr"), (4, " \t\n ", None), (5, "x", "en"), (6, LONG, "en"), (7, "\U0001f642 é́ ﬁ \x00 漢字", "fr"), (8, "a" * 100_000, "en"), (9, "Ünï cödé " * 500, "de"),
]
#: Names that operators use for their own columns.
CLASH = ("score", "n_tokens", "kept", "cls", "key", "n", "node", "root", "ids", "decoded", "content", "kinds", "starts", "__text", "features", "y", "item_id", "lang_pred")


def edge(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(EDGE, "doc_id long, text string, lang string")
    return rows.select("*", *[F.lit("other").alias(c) for c in CLASH])


def empty(spark):
    return edge(spark).where("doc_id < 0")

"""Rows with everything odd in them, and helpers of the tests."""

import random

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def prose(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def odd_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    rng = random.Random(5)
    a, long = prose(rng, 120), prose(rng, 30_000)
    rows = [(0, a, "en", "a", 1), (1, a, "en", "b", 1), (2, a + " tail", "en", None, 1), (2, a + " tail", "en", None, 1),
            (3, None, None, "a", None), (4, "", "en", "a", 0), (5, " \n\t ", "en", "b", 3), (None, a, "en", "a", 1),
            (None, None, None, None, None), (6, long, "en", "a", 1), (7, long + "\n" + a, "en", "b", 1), (8, "one two", "en", "b", 7),
            (9, "é#ñ | x" * 80, "fr", "c", 1), (10, "same words here " * 60, "en", "c", 1),
            (11, "line one has these eight words in it now\nline one has these nine words in it now\n"
                 "line one has these eight words in it now", "en", "a", 1)]
    return rows + [(20 + i, prose(rng, 80), "en", "abc"[i % 3], 1) for i in range(12)]


def same(a, b):
    """Equal multisets of rows, whatever the order."""
    return sorted(map(repr, map(tuple, a.collect()))) == sorted(map(repr, map(tuple, b.collect())))

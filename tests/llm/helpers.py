"""Small tables with the awkward cases, and brute-force helpers."""

import json

import numpy as np

LONG = " ".join(f"long{i % 977} tail{i % 13}" for i in range(6000))
BASE = "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree near the river bank " \
       "and nobody in the village ever asks why the miller keeps his lantern lit until the early morning hours of winter"


def rows():
    """(doc_id, text, lang, source): nulls, empty, very long, copies, near copies, ties."""
    near = BASE.replace("lantern", "candle")
    return [
        (0, BASE, "en", "a"), (1, BASE, "en", None), (2, BASE + " ", "en", "a"), (3, near, None, "b"),
        (4, None, "en", "a"), (5, "", None, None), (6, " \t\n", "de", "b"), (7, "one two", "en", "a"),
        (8, "one  two", "en", "a"), (9, LONG, "en", "a"), (10, LONG + " end", "en", "a"),
        (11, "der hund und die katze laufen durch den garten und sehen das alte haus", "de", "c"),
        (12, "Ünï cödé ☃ ▁x   spaces\x0b\x0cform", "de", "c"), (13, "x" * 5000, None, "c"),
        (14, "prefix words here " + BASE + " suffix words there", "en", "b"), (15, "123 456 !!", "en", "b"),
        (16, "a b a b a b a b a b a b a b a b a b a b a b a b a b a b a b a b a b a b a b", "en", "b"),
        (17, "漢字 かな", "ja", "d"), (18, BASE.upper(), "en", "d"),
        (16, "a b a b a b a b a b a b a b a b a b a b a b a b a b a b a b a b a b a b a b", "en", "b"),
    ]


SCHEMA = "doc_id long, text string, lang string, source string"


def docs(spark, data=None, extra=False):
    df = spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(3)
    if extra:  # columns whose names clash with the operators' own
        from pyspark.sql import functions as F
        for c in ("id", "key", "score", "rep", "size", "label", "kept", "host", "h", "n_tokens"):
            df = df.withColumn(c, F.lit("other"))
    return df


def as_dict(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def spaces(text):
    return [w for w in __import__("re").split("[\x20\x09-\x0d]+", text or "") if w]

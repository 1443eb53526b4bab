"""Corpus pipeline: raw documents in, clean encoded documents out.

Each stage takes (spark, docs, sf_dir), judges the documents its predecessor
kept and returns those that stay; the last returns their encoding.  Every
stage's result is written as Parquet in the shared folder and read again, so a
lost executor repeats at most its part of one stage.

Rows that share a doc_id and a text are one document (exact dedup keeps one of
them); rows that share an id only are documents of their own, and so are rows
without an id, which come after all others where the smallest id stays.  Empty
tables pass through every stage as empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import read_table, store
from docloom.llm.queries import held_out, model_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the model knows; without letters they go."""
    from docloom.llm.op02_language_id import fit, keep_known
    return keep_known(docs, fit(docs, ~held_out(), model_path()))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest, then the smallest id."""
    from docloom.llm.op06_exact_dedup import grace_dedup, normalised
    found = store(grace_dedup(docs), "dedup_decisions")
    # exactly one row of each text is kept, but rows may share its id and its text
    kept = found.filter("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    shared = found.groupBy("doc_id", "text_sha256").agg(F.max(F.col("kept").cast("int")).alias("k"),
                                                        F.count("*").alias("n")).filter("k = 1 and n > 1")
    sha = F.sha2(normalised("text"), 256)
    if shared.isEmpty():
        return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_id"]) & (sha == kept["_sha"]), "left_semi")
    rows = docs.withColumn("_key", sha)
    rows = rows.join(kept, rows["doc_id"].eqNullSafe(kept["_id"]) & (rows["_key"] == kept["_sha"]), "left_semi")
    text = F.coalesce("text", F.lit(""))
    best = rows.groupBy("_key").agg(F.max_by(F.struct(*docs.columns), F.struct(F.char_length(text), text)).alias("_row"))
    return best.select("_row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked sets of five-word shingles (Jaccard
    similarity 0.8 or more): the smallest id, then the smallest checksum."""
    from docloom.llm.op04_ngram_join import jaccard_components
    found = store(jaccard_components(docs, n=5, percent=80), "near_decisions")
    first = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    linked = (first.filter("component is not null").groupBy("component")
              .agg(F.first("component_id").alias("_id"), F.min("text_key").alias("_key")))
    stay = linked.select("_id", "_key").unionByName(first.filter("component is null").select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")))
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    return docs.join(stay, docs["doc_id"].eqNullSafe(stay["_id"]) & (key == stay["_key"]), "left_semi")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    from docloom.llm.op10_decontamination import without_leaks
    return without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and digests of the ids and of the decoded text."""
    from docloom.llm.op03_sentencepiece import encode_docs
    return encode_docs(docs, model_path(), keep_ids=True).drop("covered_bytes")


STAGES = [("language ID", language), ("exact dedup", exact_dedup), ("n-gram Jaccard join", near_dedup),
          ("benchmark decontamination", decontaminate), ("SentencePiece encoding", encode)]

#: language ID and the encoder have no SQL form; the tests check run() against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = store(stage(spark, docs, sf_dir), f"stage{k}")
    return docs

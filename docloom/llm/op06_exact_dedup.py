"""Exact dedup: Grace hash deduplication.

Records are combined where they are read (an open-addressing table per chunk
that compares complete content), written once, then partitioned by hash digits.
A partition that would not fit a table is split again by the next digits, level
after level, until every one fits; Spark's shuffle files are the spill files.
A partition that is too big although all its records share one hash (a hot
text met in very many chunks) is dealt out by record, combined, and only the
combined records meet.

Defined results: null text counts as empty; empty texts are one group; a row
that occurs twice is two records of one group, of which one is kept; a null id
comes after all others; of rows that share an id exactly one per group is kept;
an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import bucket_count, known_id, shown_id, store

#: content bytes one open-addressing table may hold
TABLE_BYTES = 32 << 20
#: what a record costs a table beside its content
ROW_BYTES = 64
MAX_LEVELS = 12
GAP = " \t\n\x0b\x0c\r"


def normalised(text: str | Column) -> Column:
    """The text without any character of [\\x20\\x09-\\x0D]; null is empty."""
    return F.coalesce(F.translate(text, GAP, ""), F.lit(""))


def table_groups(hashes: np.ndarray, contents) -> np.ndarray:
    """Open addressing with linear probing: for each record the index of the
    first record with the same complete content."""
    n = len(contents)
    size = 1 << max(3, (2 * n).bit_length())
    slots, mask = [-1] * size, size - 1
    out = np.empty(n, np.int64)
    for i, h in enumerate(hashes.tolist()):
        s = h & mask
        while (j := slots[s]) >= 0 and not (hashes[j] == h and contents[j] == contents[i]):
            s = (s + 1) & mask
        if j < 0:
            slots[s] = j = i
        out[i] = j
    return out


def _combine_chunks(limit: int):
    def run(batches):
        held, size = [], 0
        for pdf in batches:
            held.append(pdf)
            size += int(pdf["size"].sum())
            if size >= limit:
                yield _combined(pd.concat(held, ignore_index=True))
                held, size = [], 0
        if held:
            yield _combined(pd.concat(held, ignore_index=True))
    return run


def _combined(p: pd.DataFrame) -> pd.DataFrame:
    p["head"] = table_groups(p["h"].to_numpy(), p["content"].tolist())
    p = p.sort_values(["head", "n_points", "id"], ascending=[True, False, True], kind="stable")
    g = p.groupby("head", sort=True)
    best = g.first()
    return pd.DataFrame({
        "rec": g["rid"].min(), "h": best["h"], "content": best["content"],
        "best_points": best["n_points"], "best_id": best["id"], "n": g.size(),
        "members": g["id"].agg(list)}).reset_index(drop=True)


def _meet(p: pd.DataFrame) -> pd.DataFrame:
    """One table over combined records: the head record, kept id and size of each."""
    p = p.reset_index(drop=True)
    p["head"] = table_groups(p["h"].to_numpy(), p["content"].tolist())
    p = p.sort_values(["head", "best_points", "best_id", "best_rec"], ascending=[True, False, True, True])
    g = p.groupby("head")
    p["head_rec"] = g["rec"].transform("min")
    p["keep_id"] = g["best_id"].transform("first")
    p["keep_rec"] = g["best_rec"].transform("first")
    p["keep_points"] = g["best_points"].transform("first")
    p["group_size"] = g["n"].transform("sum")
    p["content"] = p["content"].where(p["rec"] == p["head_rec"]).where(p["salt"] >= 0)
    return p[["rec", "head_rec", "keep_id", "keep_rec", "keep_points", "group_size", "path", "h", "content"]]


def _partition(recs: DataFrame, table_bytes: int) -> DataFrame:
    """Recursive partitioning: ``path`` names a bucket that fits a table, or one
    hash whose records are dealt out by ``salt`` (-1: not dealt out)."""
    spark = recs.sparkSession
    total = int(recs.agg(F.coalesce(F.sum("size"), F.lit(0))).head()[0])
    first = bucket_count(spark, total, table_bytes)
    cur = recs.withColumn("path", F.pmod(F.xxhash64("h", F.lit(0)), F.lit(first)).cast("string"))
    cur = cur.withColumn("salt", F.lit(-1).cast("long"))
    for level in range(1, MAX_LEVELS):
        big = (cur.filter("salt = -1").groupBy("path")
               .agg(F.sum("size").alias("total"), F.min("h").alias("lo"), F.max("h").alias("hi"))
               .filter(F.col("total") > table_bytes)
               .select("path", F.ceil(F.col("total") / table_bytes * 2).cast("long").alias("fan"),
                       (F.col("lo") == F.col("hi")).alias("single")))
        big = store(big, "grace_big")
        if big.isEmpty():
            break
        digit = F.pmod(F.xxhash64("h", F.lit(level)), F.col("fan"))
        cur = cur.join(big, "path", "left").select(
            *[c for c in cur.columns if c not in ("path", "salt")],
            F.when(F.col("fan").isNotNull() & ~F.col("single"),
                   F.concat_ws("/", "path", digit.cast("string"))).otherwise(F.col("path")).alias("path"),
            F.when(F.coalesce("single", F.lit(False)), F.pmod(F.col("rec"), F.col("fan")))
            .otherwise(F.col("salt")).alias("salt"))
    return cur


def grace_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per input row: id, keep_id, group_size, text_sha256, kept.

    Texts are equal when identical without white space; the row with the most
    code points, then the smallest id, stays.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"), known_id(id_col).alias("id"),
        F.coalesce(F.char_length(text_col), F.lit(0)).cast("long").alias("n_points"),
        normalised(text_col).alias("content"))
    rows = rows.select("rid", "id", "n_points", "content", F.xxhash64("content").alias("h"),
                       (F.octet_length("content") + ROW_BYTES).alias("size"))
    recs = rows.mapInPandas(_combine_chunks(table_bytes // 4),
                            "rec long, h long, content string, best_points long, best_id long, "
                            "n long, members array<long>")
    recs = store(recs.withColumn("size", F.octet_length("content") + ROW_BYTES)
                 .withColumn("sha", F.sha2("content", 256)), "grace_recs")
    parts = _partition(recs.select("rec", "h", "content", "best_points", "best_id", F.col("rec").alias("best_rec"),
                                   "n", "size"), table_bytes)
    shape = ("rec long, head_rec long, keep_id long, keep_rec long, keep_points long, group_size long, "
             "path string, h long, content string")
    met = parts.drop("size").groupBy("path", "salt").applyInPandas(_meet, shape)
    met = store(met, "grace_met")
    facts = met.select("rec", "head_rec", "keep_id", "keep_rec", "group_size")
    dealt = met.filter("content is not null")
    if not dealt.isEmpty():
        heads = dealt.select(F.col("head_rec").alias("rec"), "h", "content", F.col("keep_points").alias("best_points"),
                             F.col("keep_id").alias("best_id"), F.col("keep_rec").alias("best_rec"),
                             F.col("group_size").alias("n"), "path",
                             F.lit(-1).cast("long").alias("salt"))
        top = heads.groupBy("path", "salt").applyInPandas(_meet, shape).select(
            F.col("rec").alias("head_rec"), F.col("keep_id").alias("top_id"), F.col("keep_rec").alias("top_rec"),
            F.col("group_size").alias("top_size"))
        facts = facts.join(top, "head_rec", "left").select(
            "rec", F.coalesce("top_id", "keep_id").alias("keep_id"), F.coalesce("top_rec", "keep_rec").alias("keep_rec"),
            F.coalesce("top_size", "group_size").alias("group_size"))
    out = recs.select("rec", "sha", "members").join(facts.select("rec", "keep_id", "keep_rec", "group_size"), "rec")
    # the first member of a record is its best row
    out = out.select(F.posexplode("members").alias("pos", "id"), "rec", "keep_id", "keep_rec", "group_size", "sha")
    return out.select(shown_id("id").alias(id_col), shown_id("keep_id").alias("keep_id"), "group_size",
                      F.col("sha").alias("text_sha256"),
                      ((F.col("rec") == F.col("keep_rec")) & (F.col("pos") == 0)).alias("kept"))

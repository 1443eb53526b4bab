"""URL filters: a cascade of Bloom filters, exact over the corpus's keys.

Level 1 holds the listed keys.  The keys of the corpus that pass it wrongly are
found by one pass over the distinct keys and go into level 2; the listed keys
that pass level 2 wrongly go into level 3, and so on until a level lets nobody
through wrongly.  A key is listed if the first level that rejects it has an even
number.  As every key the corpus can ask for was present when the levels were
built, answers are exact, and judging a url joins with nothing.

A key is (host suffix, path prefix).  The first level's error rate is chosen so
that about as many keys pass it wrongly as there are listed ones, which bounds
every level, and so the broadcast, by the size of the list.

Defined results: a null url or one without ``://`` has an empty host and path
and fits no rule; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import U64, mix, store

#: wrongly passed keys of a level that the driver gathers, at most
MAX_LEVEL_KEYS = 4_000_000


def host_path(url: str | Column) -> tuple[Column, Column]:
    url = F.col(url) if isinstance(url, str) else url
    rest = F.when(url.contains("://"), F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def url_keys(host: Column, path: Column, path_lengths: list[int]) -> Column:
    """All (host suffix + path prefix) strings a rule could name, longest first."""
    labels = F.split(host, r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)),
                        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    hosts = F.filter(hosts, lambda h: h != "")
    lengths = F.array(*[F.lit(n) for n in sorted(set(path_lengths), reverse=True)])
    keys = F.flatten(F.transform(hosts, lambda h: F.transform(
        F.filter(lengths, lambda n: F.char_length(path) >= n),
        lambda n: F.struct((F.char_length(h) + n).alias("size"), F.char_length(h).alias("host_size"),
                           F.concat(h, F.substr(path, F.lit(1), n)).alias("key")))))
    return F.array_distinct(F.transform(F.sort_array(keys, asc=False), lambda k: k["key"]))


class Bloom:
    """Bits, number of probes and seed of one level."""

    def __init__(self, hashes: np.ndarray, error: float, seed: int):
        n = max(1, len(hashes))
        self.size = max(64, int(math.ceil(-n * math.log(error) / math.log(2) ** 2)))
        self.probes = max(1, round(self.size / n * math.log(2)))
        self.seed = seed
        self.bits = np.zeros(self.size, bool)
        for at in self._places(hashes):
            self.bits[at] = True

    def _places(self, hashes: np.ndarray):
        a = mix(hashes.astype(np.uint64) + U64(self.seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        b = mix(a) | U64(1)
        for i in range(self.probes):
            yield (a + U64(i) * b) % U64(self.size)

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        ok = np.ones(len(hashes), bool)
        for at in self._places(hashes):
            ok &= self.bits[at]
        return ok


def listed_by(levels: list[Bloom], hashes: np.ndarray) -> np.ndarray:
    """Membership by the first level that rejects (counted from 1): even means listed."""
    out = np.zeros(len(hashes), bool)
    open_ = np.ones(len(hashes), bool)
    for k, level in enumerate(levels, 1):
        stop = open_ & ~level.passes(hashes)
        out[stop] = k % 2 == 0
        open_ &= ~stop
    out[open_] = len(levels) % 2 == 1
    return out


def build_cascade(listed: np.ndarray, universe: DataFrame, key_hash: str = "k") -> list[Bloom]:
    """Levels over the distinct corpus key hashes (``universe``) and the listed
    ones.  The passes over the corpus run as Spark jobs; the driver sees only
    keys that pass level 1 wrongly, about as many as are listed."""
    listed = np.unique(listed.astype(np.int64)).view(np.uint64)
    total = universe.count()
    error = min(0.5, max(len(listed), 1) / max(1, total))
    levels = [Bloom(listed, error, 1)]
    first, mine = levels[0], set(listed.tolist())

    def wrong(batches):
        for pdf in batches:
            h = pdf[key_hash].to_numpy(np.int64).view(np.uint64)
            h = h[first.passes(h)]
            yield pd.DataFrame({key_hash: [x for x in h.view(np.int64).tolist()
                                           if x & (1 << 64) - 1 not in mine]}, dtype="int64")

    passed = store(universe.mapInPandas(wrong, f"{key_hash} long"), "cascade")
    if passed.count() > MAX_LEVEL_KEYS:
        raise ValueError("the list is too long for a cascade that is broadcast")
    inside = passed.toPandas()[key_hash].to_numpy(np.int64).view(np.uint64)
    outside = listed
    while len(inside):
        levels.append(Bloom(inside, 0.5, len(levels) + 1))
        inside, outside = outside[levels[-1].passes(outside)], inside
    return levels


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], url_col: str = "url") -> DataFrame:
    """``pages`` plus host, path, rule and verdict.  ``rules``: (action, host,
    path); a rule fits its host, all subdomains and paths that start with its
    own; of the fitting rules the longest wins (then the longer host).  Without
    a fitting rule the cascade finds no listed key and the verdict is allow."""
    host, path = host_path(url_col)
    lengths = [len(p) for _, _, p in rules] or [0]
    judged = pages.withColumn("host", host).withColumn("path", path)
    keys = url_keys(F.col("host"), F.col("path"), lengths)
    judged = judged.withColumn("_keys", keys).withColumn(
        "_hashes", F.transform("_keys", lambda k: F.xxhash64(k)))
    universe = store(judged.select(F.explode("_hashes").alias("k")).distinct(), "url_keys")
    spark = pages.sparkSession
    rows = [(f"{h.lower()}{p}", a) for a, h, p in rules]
    hashed = spark.createDataFrame(rows or [("", "allow")], "rule string, action string").select(
        "rule", "action", F.xxhash64("rule").alias("k")).toPandas()
    if not rows:
        hashed = hashed.iloc[:0]
    cascades = {a: build_cascade(hashed.loc[hashed["action"] == a, "k"].to_numpy(), universe)
                for a in ("block", "allow")}

    @F.pandas_udf("struct<at: int, verdict: string>")
    def verdict(hashes: pd.Series) -> pd.DataFrame:
        sizes = np.array([len(x) if x is not None else 0 for x in hashes], np.int64)
        flat = np.concatenate([np.asarray(x, np.int64) for x in hashes if x is not None] or
                              [np.zeros(0, np.int64)]).view(np.uint64)
        block, allow = (listed_by(cascades[a], flat) for a in ("block", "allow"))
        at = np.zeros(len(sizes), np.int32)
        says = np.full(len(sizes), "allow", object)
        row = np.repeat(np.arange(len(sizes)), sizes)
        begin = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        hit = np.flatnonzero(block | allow)
        hit = hit[np.unique(row[hit], return_index=True)[1]]  # first, so longest, of each url
        at[row[hit]] = hit - begin[row[hit]] + 1
        says[row[hit]] = np.where(allow[hit], "allow", "block")
        return pd.DataFrame({"at": at, "verdict": says})

    out = judged.withColumn("_v", verdict("_hashes"))
    return out.select(*[c for c in pages.columns if c not in ("host", "path", "rule", "verdict")], "host", "path",
                      F.when(F.col("_v.at") > 0, F.try_element_at("_keys", F.col("_v.at"))).alias("rule"),
                      F.col("_v.verdict").alias("verdict"))

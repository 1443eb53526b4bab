"""Benchmark decontamination: size-partitioned MinHash containment search.

Items are partitioned by size (powers of two of their shingle count).  An
item's signature is the bottom of its MinHash order: with n shingles and a
threshold t, its n - ceil(t n) + 1 smallest shingle hashes.  A document that
contains the share t of an item's shingles must hold one of them, so looking a
long document's shingles up among the signatures finds every candidate, however
small the item is beside the document.  A partition whose smallest item needs
more shingles than a document has is skipped.  Candidates are verified by
exact shingle containment over the whole document.

Items are looked up in blocks of bounded size, so the broadcast is bounded
however long the benchmark is; documents are never shuffled.

Words are runs of ASCII letters and digits and non-ASCII characters, A-Z
lower-cased.  An item of fewer than five words is one shingle of its own length.

Defined results: null or wordless texts and items match nothing; a document row
that occurs twice is reported twice; empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import U64, buffers, chunks, lower_ascii, split_words, store, window_hashes, word_hashes

SHINGLE = 5
#: containment threshold as a fraction
NEED, OF = 4, 5
#: shingles of the items that one scan of the documents looks up
BLOCK_SHINGLES = 1_000_000
BITS = 22


class Shingler:
    """Word n-gram hashes of a chunk of texts."""

    def read(self, text: pa.Array) -> None:
        raw, offs = buffers(text)
        low = lower_ascii(raw)
        gap = ~(((low >= 48) & (low <= 57)) | ((low >= 97) & (low <= 122)) | (low >= 128))
        start, end, self.first = split_words(low, offs, gap)
        self.low, self.start, self.end = low, start, end
        self.words, = word_hashes(low, start, end)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, first gram of each document + total) of the n-grams."""
        counts = np.maximum(np.diff(self.first) - (n - 1), 0)
        cut = np.concatenate([[0], np.cumsum(counts)])
        at = np.arange(cut[-1]) - np.repeat(cut[:-1], counts) + np.repeat(self.first[:-1], counts)
        return window_hashes(self.words, n)[at], cut

    def texts(self, doc: int) -> list[bytes]:
        """The words of a document."""
        at = slice(self.first[doc], self.first[doc + 1])
        return [self.low[a:b].tobytes() for a, b in zip(self.start[at].tolist(), self.end[at].tolist())]


def word_shingles(words: list[bytes], n: int) -> set[bytes]:
    return {b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)}


def item_shingles(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, n words of a shingle, distinct shingle hashes) of every item with a word."""
    def run(batches):
        sh = Shingler()
        for batch, text in chunks(batches, "text"):
            sh.read(text)
            size = np.minimum(np.diff(sh.first), SHINGLE)
            out = [None] * len(size)
            for n in np.unique(size[size > 0]).tolist():
                h, cut = sh.grams(n)
                for i in np.flatnonzero(size == n).tolist():
                    out[i] = np.unique(h[cut[i]:cut[i + 1]]).view(np.int64)
            ids = batch.column(0).to_pylist()
            rows = [(ids[i], int(size[i]), out[i], b" ".join(sh.texts(i)).decode()) for i in range(len(size))
                    if out[i] is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([r[2] for r in rows], pa.list_(pa.int64())), pa.array([r[3] for r in rows], pa.string())],
                ["item", "words", "shingles", "text"])

    return items.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).alias("text")).mapInArrow(
        run, "item long, words int, shingles array<long>, text string")


class Partition:
    """Items of one shingle length and one size class."""

    def __init__(self, words: int, items: list[int], shingles: list[np.ndarray], texts: list[str]):
        self.texts = texts
        self.words, self.items, self.shingles = words, np.array(items, np.int64), shingles
        self.need = np.array([-(-len(s) * NEED // OF) for s in shingles], np.int64)
        sign = [s[:len(s) - need + 1] for s, need in zip(shingles, self.need)]  # ascending, so the bottom
        key = np.concatenate(sign)
        of = np.repeat(np.arange(len(sign)), [len(s) for s in sign])
        order = np.lexsort((of, key))
        self.of = of[order]
        self.keys, begin = np.unique(key[order], return_index=True)
        self.cut = np.append(begin, len(key))
        self.bits = np.zeros(1 << BITS, bool)
        self.bits[(self.keys >> U64(64 - BITS)).astype(np.int64)] = True

    def search(self, h: np.ndarray, cut: np.ndarray, texts):
        """(document, item, shingles of the item, in common) of all containments.  What the
        hashes find is counted again on the words themselves (``texts`` of a document)."""
        few = np.diff(cut) < self.need.min()
        hit = np.flatnonzero(self.bits[(h >> U64(64 - BITS)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, h[hit]), len(self.keys) - 1)
        same = self.keys[at] == h[hit]
        hit, at = hit[same], at[same]
        doc = np.searchsorted(cut, hit, "right") - 1
        pair = np.unique(np.stack([doc, at], 1), axis=0) if len(doc) else np.zeros((0, 2), np.int64)
        for d in np.unique(pair[:, 0]).tolist():
            if few[d]:
                continue
            cand = np.unique(np.concatenate([self.of[self.cut[k]:self.cut[k + 1]]
                                             for k in pair[pair[:, 0] == d, 1].tolist()]))
            mine, exact = np.unique(h[cut[d]:cut[d + 1]]), None
            for i in cand[self.need[cand] <= len(mine)].tolist():
                s = self.shingles[i]
                k = np.minimum(np.searchsorted(mine, s), len(mine) - 1)
                common = int((mine[k] == s).sum())
                if common >= self.need[i]:
                    exact = word_shingles(texts(d), self.words) if exact is None else exact
                    item = word_shingles(self.texts[i].encode().split(b" "), self.words)
                    common = len(item & exact)
                    if common * OF >= len(item) * NEED:
                        yield d, int(self.items[i]), len(item), common


def partitions(rows: pd.DataFrame) -> list[Partition]:
    size = rows["shingles"].str.len()
    out = []
    for (words, _), part in rows.groupby([rows["words"], np.floor(np.log2(size)).astype(int)]):
        out.append(Partition(int(words), part["item"].tolist(),
                             [np.sort(np.asarray(s, np.int64).view(np.uint64)) for s in part["shingles"]],
                             part["text"].tolist()))
    return out


def item_blocks(items: DataFrame, id_col: str, text_col: str):
    """The benchmark's partitions, a bounded block of items at a time."""
    table = store(item_shingles(items, id_col, text_col), "benchmark_items")
    total = table.agg(F.coalesce(F.sum(F.size("shingles")), F.lit(0))).head()[0]
    n = max(1, -(-int(total) // BLOCK_SHINGLES))
    for k in range(n):
        rows = table.filter(F.pmod(F.xxhash64("item"), F.lit(n)) == k).toPandas()
        if len(rows):
            yield partitions(rows.sort_values("item", kind="stable"))


def _scan(parts: list[Partition]):
    """Matches of a chunk's documents, in document order."""
    sh = Shingler()

    def matches(text: pa.Array) -> list[tuple]:
        sh.read(text)
        found = []
        for words in sorted({p.words for p in parts}):
            h, cut = sh.grams(words)
            for p in parts:
                if p.words == words:
                    found += p.search(h, cut, sh.texts)
        return sorted(found)

    return matches


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, item_id, n_shingles, n_common, containment) of every document that
    contains at least 4/5 of an item's shingles."""
    id_type = docs.schema[id_col].dataType.simpleString()
    shape = f"{id_col} {id_type}, item_id long, n_shingles long, n_common long, containment double"
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = None
    for parts in item_blocks(items, item_id, item_text):
        def run(batches, parts=parts):
            matches = _scan(parts)
            for batch, text in chunks(batches, "text"):
                got = matches(text)
                ids = batch.column(0).take(pa.array([g[0] for g in got], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array([g[k] for g in got], pa.int64()) for k in (1, 2, 3)),
                     pa.array([g[3] / g[2] for g in got], pa.float64())],
                    [id_col, "item_id", "n_shingles", "n_common", "containment"])

        found = rows.mapInArrow(run, shape)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], shape)


def without_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, that contain no item."""
    for parts in item_blocks(items, item_id, item_text):
        def run(batches, parts=parts):
            matches = _scan(parts)
            for batch, text in chunks(batches, text_col):
                bad = np.zeros(batch.num_rows, bool)
                bad[[g[0] for g in matches(text)]] = True
                yield batch.filter(pc.invert(pa.array(bad)))

        docs = docs.mapInArrow(run, docs.schema)
    return docs

"""Ranked lexical search: accumulator-limited, a term at a time.

Documents are searched in chunks.  A chunk's inverted lists (term -> documents
and frequencies) are built for the terms of the queries, and each query runs over
them term by term, the rarest first.  A document gets an accumulator when a term
first meets it.  Before each term the bounds of the terms still to come (weight
times the largest frequency part in the chunk) are added up: once that sum is below
the k-th best partial score, no document without an accumulator can reach the best
k any more, so none is created from there on.  The accumulators that exist go on
being updated to their exact scores.  The k best scores of the task's earlier
chunks count as partial scores too, so later chunks stop sooner.

Each task returns its k best documents per query; those meet in two steps (a hash
of the document, then the query), so no task ever sees more than a share of them.
Documents are never shuffled; queries are broadcast in blocks of bounded size.

Scores are integers: weight w = floor(1000 ln((2N+2)/(2df+1))), length norm
m = 50 + (50 n N) div L, part = (10^9 tf) div (1000 tf + 20 m), score = sum of
w * part over the query's distinct terms.  N counts the documents that hold a
term, n and L terms with repeats, df over all documents.

Terms are runs of ASCII letters and digits and non-ASCII characters, A-Z
lower-cased; they are compared as texts, not as hashes.  Rows of one item id are one query.

Defined results: null and wordless texts and queries match nothing; documents
that share an id are ranked each, in any order among equals; a null id comes after
the others of its score; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import buffers, chunks, lower_ascii, split_words, store, word_array

TOP = 50
#: bytes of text of one chunk and its lists
CHUNK = 1 << 23
#: distinct (query, term) pairs that one scan of the documents looks up
BLOCK_TERMS = 250_000
#: first step of the merge: shares of a query's candidates
SHARES = 64


def terms(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(terms of all texts, first term of each text + total)."""
    raw, offs = buffers(text)
    low = lower_ascii(raw)
    gap = ~(((low >= 48) & (low <= 57)) | ((low >= 97) & (low <= 122)) | (low >= 128))
    start, end, first = split_words(low, offs, gap)
    return word_array(low, gap, start, end), first


def query_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, term): the distinct terms of every query row."""
    kind = items.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch, text in chunks(batches, "text"):
            words, first = terms(text)
            row = np.repeat(np.arange(len(first) - 1), np.diff(first))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), words.cast(pa.string())],
                                             ["item", "term"])

    return items.select(F.col(id_col).alias("item"), F.col(text_col).alias("text")).mapInArrow(
        run, f"item {kind}, term string").distinct()


def blocks(table: DataFrame):
    """(items, terms, item row and term row of each pair), a bounded block at a time."""
    total = table.count()
    n = max(1, -(-total // BLOCK_TERMS))
    for k in range(n):
        got = table.filter(F.pmod(F.xxhash64("item"), F.lit(n)) == k).toArrow()
        if got.num_rows:
            item = got["item"].combine_chunks().dictionary_encode(null_encoding="encode")
            term = got["term"].combine_chunks().cast(pa.large_string()).dictionary_encode()
            yield (item.dictionary, term.dictionary, item.indices.to_numpy(zero_copy_only=False),
                   term.indices.to_numpy(zero_copy_only=False))


class Lists:
    """Inverted lists of a chunk for the terms of ``vocabulary``."""

    def __init__(self, text: pa.Array, vocabulary: pa.Array):
        words, first = terms(text)
        self.n = np.diff(first)
        code = pc.index_in(words, vocabulary)
        at = np.flatnonzero(code.is_valid().to_numpy(zero_copy_only=False))
        term = pc.fill_null(code, 0).to_numpy(zero_copy_only=False)[at].astype(np.int64)
        doc = np.searchsorted(first, at, "right") - 1
        key, self.tf = np.unique(term * len(self.n) + doc, return_counts=True)
        self.doc = key % max(len(self.n), 1)
        self.cut = np.searchsorted(key, np.arange(len(vocabulary) + 1) * len(self.n))


def statistics(docs: DataFrame, vocabulary: pa.Array) -> tuple[int, int, np.ndarray]:
    """(documents with a term, all terms with repeats, documents of each term)."""
    def run(batches):
        df = np.zeros(len(vocabulary), np.int64)
        n_docs = n_terms = 0
        for _, text in chunks(batches, "text", CHUNK):
            lists = Lists(text, vocabulary)
            n_docs += int((lists.n > 0).sum())
            n_terms += int(lists.n.sum())
            df += np.diff(lists.cut)
        hit = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-2, -1], hit])), pa.array(np.concatenate([[n_docs, n_terms], df[hit]]))],
            ["term", "n"])

    # one row per term of the block
    sums = docs.select(F.col("text")).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    got = {r["term"]: r["n"] for r in sums.collect()}
    return got.get(-2, 0), got.get(-1, 0), np.array([got.get(t, 0) for t in range(len(vocabulary))], np.int64)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Best:
    """The k best (score, id) of a query seen so far by a task."""

    def __init__(self, k: int):
        self.k, self.score, self.id = k, np.zeros(0, np.int64), None

    def floor(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else 0

    def add(self, score: np.ndarray, ids: pa.Array) -> None:
        both = np.concatenate([self.score, score])
        ids = ids if self.id is None else pa.concat_arrays([self.id, ids])
        order = pc.sort_indices(pa.table({"s": both, "i": ids}),
                                sort_keys=[("s", "descending"), ("i", "ascending")])[:self.k]
        self.score, self.id = both[order.to_numpy()], ids.take(order)


def search_chunk(lists: Lists, part: np.ndarray, query: list[tuple[int, int]], top: int, floor: int,
                 acc: np.ndarray, has: np.ndarray) -> np.ndarray:
    """Documents of the chunk that got an accumulator, among them all that can be
    among the best ``top``; their exact scores are in ``acc``, ``has`` marks them (the
    caller clears both).  ``query`` is its (term, weight) pairs, the rarest first; a
    document whose score is below ``floor`` is of no use."""
    cut = lists.cut
    most = np.array([w * int(part[cut[t]:cut[t + 1]].max(initial=0)) for t, w in query], np.int64)
    rest = np.concatenate([np.cumsum(most[::-1])[::-1], [0]])
    held = np.zeros(0, np.int64)
    creating = True
    for j, (t, w) in enumerate(query):
        a, b = cut[t], cut[t + 1]
        if a == b:
            continue
        doc = lists.doc[a:b]
        if creating:
            # the k-th best partial score; only worth looking up once it can matter
            kth = floor
            if len(held) >= top and rest[j] <= int(acc[held].max()):
                kth = max(kth, int(np.partition(acc[held], len(held) - top)[len(held) - top]))
            creating = rest[j] >= kth
        old = has[doc]
        if creating:
            new = doc[~old]
            has[new] = True
            held = np.concatenate([held, new])
            acc[doc] += w * part[a:b]
        else:
            acc[doc[old]] += w * part[a:b][old]
    return held


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
                   item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item id, rank, document id, score) of the ``top`` best documents of every
    query, equal scores by ascending id."""
    kind, item_kind = (d.schema[c].dataType.simpleString() for d, c in ((docs, id_col), (items, item_id)))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shape = f"item {item_kind}, id {kind}, score long"
    found = None
    for names, vocabulary, item, term in blocks(store(query_terms(items, item_id, item_text), "query_terms")):
        n_docs, n_terms, df = statistics(rows, vocabulary)
        weights = np.array([weight(n_docs, int(d)) if d else 0 for d in df], np.int64)
        # rarest first: by df, then by term for a fixed order
        order = np.lexsort((term, df[term], item))
        queries: list[list[tuple[int, int]]] = [[] for _ in range(len(names))]
        for i, t in zip(item[order].tolist(), term[order].tolist()):
            if weights[t] > 0:  # none of the terms that no document holds
                queries[i].append((t, int(weights[t])))

        def run(batches, names=names, vocabulary=vocabulary, queries=queries, n_docs=n_docs, n_terms=n_terms):
            best = [Best(top) for _ in queries]
            for batch, text in chunks(batches, "text", CHUNK):
                lists = Lists(text, vocabulary)
                if not len(lists.doc):
                    continue
                m = 50 + (50 * lists.n * n_docs) // max(n_terms, 1)
                part = (1_000_000_000 * lists.tf) // (1000 * lists.tf + 20 * m[lists.doc])
                acc, has = np.zeros(len(lists.n), np.int64), np.zeros(len(lists.n), bool)
                ids = batch.column(0)
                for q, mine in enumerate(queries):
                    floor = best[q].floor()
                    held = search_chunk(lists, part, mine, top, floor, acc, has)
                    score = acc[held]
                    acc[held], has[held] = 0, False
                    use = np.flatnonzero(score >= max(floor, 1))
                    if len(use) > top:  # ties with the k-th stay: their ids decide
                        kth = np.partition(score[use], len(use) - top)[len(use) - top]
                        use = use[score[use] >= kth]
                    if len(use):
                        best[q].add(score[use], ids.take(pa.array(held[use])))
            for q, b in enumerate(best):
                if len(b.score):
                    yield pa.RecordBatch.from_arrays(
                        [names.take(pa.array([q] * len(b.score))), b.id, pa.array(b.score)], ["item", "id", "score"])

        part_best = rows.mapInArrow(run, shape)
        found = part_best if found is None else found.unionByName(part_best)
    if found is None:
        found = docs.sparkSession.createDataFrame([], shape)
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    share = F.pmod(F.xxhash64("id", "score"), F.lit(SHARES))
    few = found.withColumn("share", share).withColumn(
        "n", F.row_number().over(Window.partitionBy("item", "share").orderBy(*order))).filter(F.col("n") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return ranked.filter(F.col("rank") <= top).select(
        F.col("item").alias(item_id), "rank", F.col("id").alias(id_col), "score")

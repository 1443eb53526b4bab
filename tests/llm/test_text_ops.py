"""Encoding, language ID, toxicity, decontamination, urls, WARC and the pipeline."""

import hashlib
import json
import math
import os
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from helpers import BASE, LONG, as_dict, docs, rows, spaces
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def model_path():
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


# ------------------------------------------------------------ sentencepiece
def library():
    import sentencepiece as spm
    return spm.SentencePieceProcessor(model_file=model_path())


def test_encoding_equals_the_library(spark):
    from docloom.llm.op03_sentencepiece import encode_docs
    sp = library()
    out = encode_docs(docs(spark, extra=True), model_path(), keep_ids=True)
    assert out.count() == len(rows())
    texts = {i: t or "" for i, t, *_ in rows()}
    for r in out.collect():
        ids = sp.encode(texts[r.doc_id]) + [sp.eos_id()]
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == sha(" ".join(map(str, ids)))
        assert r.decoded_sha256 == sha(sp.decode(ids))
        assert r.covered_bytes == len(texts[r.doc_id].encode())


def test_encoding_equals_the_library_on_documents(spark):
    from docloom.llm.queries import op3_sentencepiece
    sp = library()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in op3_sentencepiece(spark, SF).collect():
        ids = sp.encode(texts[r.doc_id]) + [sp.eos_id()]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), sha(" ".join(map(str, ids))), sha(sp.decode(ids)))


def test_encoder_takes_bounded_chunks_of_a_batch(spark, monkeypatch):
    """A worker holds the words of a bounded piece of a batch, never of all its rows."""
    from docloom.llm import op03_sentencepiece as op
    real, limit = op.Codec, 1 << 19

    class Bounded(real):
        def digest(self, texts, keep_ids=False):
            assert len(texts) == 1 or sum(len(t.encode()) for t in texts) <= limit
            return real.digest(self, texts, keep_ids)

    monkeypatch.setattr(op, "Codec", Bounded)
    texts = {i: f"word{i} " * 4000 for i in range(60)} | {60: None, 61: "long " * 200_000}
    data = [(i, t, None, None) for i, t in texts.items()]
    sp = library()
    got = op.encode_docs(docs(spark, data).coalesce(1), model_path(), keep_ids=True).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        assert r.ids == sp.encode(texts[r.doc_id] or "") + [sp.eos_id()]
        assert r.covered_bytes == len((texts[r.doc_id] or "").encode())


def test_spans_cover_the_text_and_equal_the_library_pieces():
    from docloom.llm.op03_sentencepiece import Codec, read_model
    codec, sp = Codec(read_model(model_path())), library()
    for text in [*(t or "" for _, t, *_ in rows()), "  lead", "trail  ", "a▁▁b ☃☃ é", "▁", " ", "\n\n", "🙂 ok 🙂"]:
        spans = codec.encode(text)
        assert [s[0] for s in spans] == sp.encode(text)
        data, at = text.encode(), 0
        for _, b, e in spans:
            assert b == at and e >= b
            at = e
        assert at == len(data)
        for (i, b, e) in spans:
            if not codec.is_byte[i]:
                piece = sp.id_to_piece(i).replace("▁", " ")
                assert data[b:e].decode().replace("▁", " ") in (piece, piece[1:])


def test_compiled_map_longest_prefix_and_alignment():
    """The walker over a compiled map equals the library's own normaliser."""
    import sentencepiece as spm
    from sentencepiece import sentencepiece_model_pb2 as pb
    from docloom.llm.op03_sentencepiece import CharsMap
    norm = spm.SentencePieceNormalizer(rule_name="nfkc", add_dummy_prefix=False, escape_whitespaces=False,
                                       remove_extra_whitespaces=False)
    spec = pb.ModelProto()
    spec.ParseFromString(norm.serialized_model_proto())
    m = CharsMap(spec.normalizer_spec.precompiled_charsmap)
    assert m.units
    for text in ["plain", "ﬁne ① ｶﾞ Å", "½ cup", "한글 e\u0301", "", "ｆｕｌｌ　width"]:
        out, at = m.apply(text)
        assert out.decode() == norm.normalize(text)
        assert len(at) == len(out) + 1 and at[-1] == len(text.encode())
        assert all(x <= y for x, y in zip(at, at[1:]))
    assert CharsMap(b"").apply("as is")[0] == b"as is"


def mapped_model(tmp_path, trim):
    """The public model with a compiled character map (and removal of extra spaces)."""
    import sentencepiece as spm
    from sentencepiece import sentencepiece_model_pb2 as pb
    norm = pb.ModelProto()
    norm.ParseFromString(spm.SentencePieceNormalizer(rule_name="nfkc").serialized_model_proto())
    model = pb.ModelProto()
    with open(model_path(), "rb") as f:
        model.ParseFromString(f.read())
    model.normalizer_spec.precompiled_charsmap = norm.normalizer_spec.precompiled_charsmap
    model.normalizer_spec.remove_extra_whitespaces = trim
    path = tmp_path / "mapped.model"
    path.write_bytes(model.SerializeToString())
    return str(path)


MAPPED = ["plain words", "ﬁne ①② ｶﾞ Å", "½ cup of  tea", "한글 e\u0301", "ｆｕｌｌ　width", "  two  lead", "trail \u3000 ",
          "\u3000", " ", "\u00a0a\u00a0b", "", None, "ﷺ ﷺ", "a▁b", "🙂 ok"]


@pytest.mark.parametrize("trim", [False, True])
def test_models_with_a_map_go_through_the_walker(spark, tmp_path, trim):
    """Whole query against the library, with a map that acts; the library's own
    whole-text encoding is never asked."""
    import sentencepiece as spm
    from docloom.llm.op03_sentencepiece import Codec, encode_docs, read_model
    path = mapped_model(tmp_path, trim)
    sp = spm.SentencePieceProcessor(model_file=path)
    codec = Codec(read_model(path))
    assert codec.plain and codec.map.units
    got = as_dict(encode_docs(docs(spark, [(i, t, None, None) for i, t in enumerate(MAPPED)]), path, keep_ids=True))
    for i, t in enumerate(MAPPED):
        ids = sp.encode(t or "") + [sp.eos_id()]
        assert got[i].ids == ids, t
        assert got[i].decoded_sha256 == sha(sp.decode(ids)), t
        spans = codec.encode(t or "")
        size = len((t or "").encode())
        assert [s[0] for s in spans] == ids[:-1]
        assert all(0 <= b <= e <= size for _, b, e in spans)
        assert all(x[2] <= y[1] for x, y in zip(spans, spans[1:]))
    # a ligature of the source is the span of the piece that its replacement is part of
    fine = codec.encode("ﬁne x")
    assert fine[0][1] == 0 and "ﬁne".encode().startswith("ﬁne x".encode()[:fine[0][2]])


@pytest.mark.parametrize("trim", [False, True])
def test_pieces_across_words_go_through_the_walker(tmp_path, monkeypatch, trim):
    """A model with a piece that crosses words: whole texts are mapped, segmented and aligned
    here; the library's own spans are never asked."""
    import sentencepiece as spm
    from sentencepiece import sentencepiece_model_pb2 as pb
    from docloom.llm.op03_sentencepiece import META, Codec
    model = pb.ModelProto()
    with open(mapped_model(tmp_path, trim), "rb") as f:
        model.ParseFromString(f.read())
    model.pieces.add(piece="s" + META, score=1.0)
    blob = model.SerializeToString()
    sp, codec = spm.SentencePieceProcessor(model_proto=blob), Codec(blob)
    assert not codec.plain and codec.map.units
    monkeypatch.setattr(Codec, "_encode_whole", None)
    crossing = 0
    for t in [t or "" for t in MAPPED] + ["cats dogs here", "cats  ﬁsh ", "s "]:
        spans, size = codec.encode(t), len(t.encode())
        assert [x[0] for x in spans] == sp.encode(t), t
        assert all(0 <= b <= e <= size for _, b, e in spans)
        assert all(x[2] <= y[1] for x, y in zip(spans, spans[1:]))
        crossing += sum(x[0] == len(model.pieces) - 1 for x in spans)
    assert crossing >= 2
    assert codec.encode("cats dogs")[-1][2] == len("cats dogs")


def test_decoded_text_comes_from_the_ids():
    from docloom.llm.op03_sentencepiece import Codec, read_model
    codec = Codec(read_model(model_path()))
    right = codec.digest(["seven wise owls"])["decoded_sha256"][0]
    codec.words.clear()

    class Wrong:
        def encode(self, words, **kw):
            ids = self.real.encode(words, **kw)
            return [[i[0] + 1, *i[1:]] if w == "wise" else i for w, i in zip(words, ids)]

        def decode(self, ids, **kw):
            return self.real.decode(ids, **kw)

    wrong = Wrong()
    wrong.real, codec.segmenter = codec.segmenter, wrong
    assert right == sha("seven wise owls") != codec.digest(["seven wise owls"])["decoded_sha256"][0]


# -------------------------------------------------------------- language ID
def test_forward_sums_all_segmentations():
    from docloom.llm.op02_language_id import Lattice, Trie
    pieces = ["▁", "a", "b", "ab", "▁a", "ba", "▁ab", "aba"]
    ids = {p: i for i, p in enumerate(pieces)}
    rng = np.random.default_rng(1)
    p = rng.random((len(pieces) + 1, 2))

    def brute(s, k):
        if not s:
            return 1.0
        total = sum(p[ids[s[:n]], k] * brute(s[n:], k) for n in range(1, min(4, len(s)) + 1) if s[:n] in ids)
        return total + (p[-1, k] * brute(s[1:], k) if s[0] not in ids else 0.0)

    words = ["a", "ab", "abab", "bxa", "aabba", "x"]
    lattice = Lattice(words, Trie(pieces))
    got = lattice.forward(np.log(p))[lattice.last]
    assert np.allclose(np.exp(got), [[brute("▁" + w, k) for k in (0, 1)] for w in words])
    # expected counts add up to the characters they cover
    e = lattice.expected(np.log(p), np.ones((len(words), 2)))
    sizes = np.array([len(x) for x in pieces] + [1])
    assert np.allclose((e * sizes[:, None]).sum(0), sum(len(w) + 1 for w in words))


def test_language_id_held_out_accuracy(spark):
    from docloom.llm.queries import op2_language_id
    sf = "/root/testdata/sf0.01"
    got = as_dict(op2_language_id(spark, sf))
    truth = as_dict(spark.read.parquet(f"{sf}/documents.parquet"))
    held = [i for i in got if got[i].held_out]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got)
    right = [got[i].lang_pred == truth[i].lang for i in held]
    assert len(got) == len(truth) and np.mean(right) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_id_odd_texts(spark):
    from docloom.llm.op02_language_id import fit, keep_known, predict
    df = docs(spark, extra=True)
    model = fit(df, F.lit(True), model_path())
    out = predict(df, model)
    assert out.count() == len(rows())
    got = as_dict(out)
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (4, 5, 6, 15))
    assert got[0].lang_pred == "en" and got[11].lang_pred == "de"
    kept = keep_known(df, model)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows()} - {4, 5, 6, 15}
    assert fit(docs(spark, []), F.lit(True), model_path()) is None
    assert {r.lang_pred for r in predict(df, None).collect()} == {"und"}


# ----------------------------------------------------------------- toxicity
def test_block_max_search_equals_all_cosines():
    from docloom.llm.op01_toxicity import Index
    rng = np.random.default_rng(2)
    n, terms = 300, 20
    vec = []
    for _ in range(n):
        ids = np.sort(rng.choice(terms, int(rng.integers(1, 5)), replace=False))
        w = rng.integers(1, 4, len(ids)).astype(float)
        vec.append((ids, w / np.sqrt((w * w).sum())))
    index = Index(vec, rng.integers(0, 2, n), np.arange(n), terms, block=16)
    dense = np.zeros((n, terms))
    for i, (t, w) in enumerate(vec):
        dense[i, t] = w
    for i in range(60):
        cos = np.round(dense @ dense[i], 9)
        want = [e for e in np.lexsort((np.arange(n), -cos)) if cos[e] > 0 and e != i][:12]
        e, c = index.nearest(*vec[i], 12, without=i)
        assert e.tolist() == want and np.allclose(c, cos[want])


def test_toxicity_held_out(spark):
    from docloom.llm.queries import op1_toxicity
    sf = "/root/testdata/sf0.1"
    got = as_dict(op1_toxicity(spark, sf).select("doc_id", "held_out", "score", "predicted"))
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [i for i in labels if got[i].held_out]
    tp = sum(got[i].predicted and labels[i] for i in held)
    fp = sum(got[i].predicted and not labels[i] for i in held)
    fn = sum(not got[i].predicted and labels[i] for i in held)
    assert 2 * tp / (2 * tp + fp + fn) > 0.8
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())


def test_toxicity_odd_texts_and_no_labels(spark):
    from docloom.llm.op01_toxicity import fit, score
    df = docs(spark, extra=True)
    assert fit(df, df.withColumn("label", F.lit(None).cast("int"))) is None
    assert {r.score for r in score(df, None).collect()} == {0.0}
    bad = [(100 + i, f"you {w} fool {i}", "en", "a") for i, w in enumerate(["awful", "awful", "nasty"] * 20)]
    good = [(300 + i, f"nice day {i} friend", "en", "a") for i in range(60)]
    train = docs(spark, bad + good).withColumn("label", (F.col("doc_id") < 300).cast("int"))
    model = fit(train, train)
    got = as_dict(score(df.unionByName(docs(spark, [(500, "such a fool", "en", "a"), (501, "a nice friend", "en", "a")],
                                            extra=True)), model))
    assert got[500].score > 0.5 > got[501].score
    assert got[500].neighbours and set(got[500].labels) == {1}
    assert got[4].score == got[5].score == got[13].score


def test_toxicity_weighs_every_term_of_whole_texts(spark):
    """Examples agree in every telling term; only the rest of a text tells which is its copy."""
    from docloom.llm.op01_toxicity import fit, score, words_of
    rng = np.random.default_rng(5)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    vocab = ["".join(rng.choice(letters, int(rng.integers(2, 9)))) for _ in range(900)]
    own = [" ".join(rng.choice(vocab, 30)) for _ in range(80)]
    data = [(i, f"{'awful fool' if i < 40 else 'nice friend'} {t}", "en", "a") for i, t in enumerate(own)]
    new = [(100 + i, t, "en", "a") for i, (_, t, _, _) in enumerate(data)] + [(300, own[3] + " unheard words", "en", "a")]
    train = docs(spark, data).withColumn("label", (F.col("doc_id") < 40).cast("int"))
    every = docs(spark, data + new)
    got = as_dict(score(every, fit(every, train)))
    n, n1, n0 = 161, 40, 40
    terms = [Counter(words_of(t)) for _, t, _, _ in data]
    df = Counter(t for _, x, _, _ in data + new for t in set(words_of(x)))
    a, b = Counter(t for x in terms[:40] for t in x), Counter(t for x in terms[40:] for t in x)

    def weigh(t):
        if not a[t] + b[t]:
            return math.log((1 + n) / 2) + 0.1
        chi = 80 * (a[t] * (n0 - b[t]) - b[t] * (n1 - a[t])) ** 2 / (n1 * n0) / (a[t] + b[t]) / max(1, 80 - a[t] - b[t])
        return (math.log((1 + n) / (1 + df[t])) + 0.1) * (1 + chi / 12)

    def vector(text):
        v = {t: (1 + math.log(c)) * weigh(t) for t, c in Counter(words_of(text)).items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / size for t, x in v.items()}

    made = [vector(t) for _, t, _, _ in data]
    for i, t, _, _ in new[::7] + new[-1:]:
        v = vector(t)
        cos = np.round([sum(x * e.get(t, 0) for t, x in v.items()) for e in made], 9)
        want = [e for e in np.lexsort((np.arange(80), -cos)) if cos[e] > 0][:25]
        assert got[i].neighbours == want and np.allclose(got[i].cosines, cos[want], atol=2e-9)
    for i, *_ in new[:-1]:
        assert got[i].neighbours[0] == i - 100 and got[i].cosines[0] == 1 > got[i].cosines[1]
    assert got[300].neighbours[0] == 3 and got[300].cosines[0] < 1


def test_lists_are_read_in_two_passes_at_most(monkeypatch):
    """Not once for each block; and blocks that cannot matter are still left out."""
    from docloom.llm.op01_toxicity import Index
    rng = np.random.default_rng(4)
    vec = []
    for i in range(320):  # half of them near copies of a few, far from the others
        ids = np.arange(4) + 4 * (i % 5) if i < 160 else np.sort(20 + rng.choice(180, 6, replace=False))
        w = rng.integers(1, 4, len(ids)).astype(float)
        vec.append((ids, w / np.sqrt((w * w).sum())))
    index, calls, listed = Index(vec, np.zeros(320), np.arange(320), 200, block=16, dense=0), [], Index._listed
    monkeypatch.setattr(Index, "_listed", lambda self, *a: calls.append(np.size(a[2])) or listed(self, *a))
    got = index.nearest_many(vec, 5, list(range(320)))
    assert len(calls) <= 2 * len(vec) and sum(calls) < 0.8 * index.n_blocks * len(vec)
    dense = np.zeros((320, 200))
    for i, (t, w) in enumerate(vec):
        dense[i, t] = w
    for i, (e, c) in enumerate(got):
        cos = np.round(dense @ dense[i], 9)
        want = [x for x in np.lexsort((np.arange(320), -cos)) if cos[x] > 0 and x != i][:5]
        assert e.tolist() == want and np.allclose(c, cos[want])


def test_words_equal_the_pattern():
    import re
    from docloom.llm.op01_toxicity import words_of
    for t in ("Straße ẞ İstanbul ΑΣ aΣ b_c 1a2 K Å x\x1cy\x85z é́ 漢字かな", "A\x0bB\x1fC_d-E'f 9G", "ǅ ŉ İ ٣a", "", " \n"):
        assert words_of(t) == re.findall(r"[^\W\d_]+", t.lower())


def test_matrix_and_lists_give_all_cosines():
    from docloom.llm.op01_toxicity import Index
    rng = np.random.default_rng(3)
    n, terms = 300, 400
    held = 1 / np.arange(1, terms + 1)
    vec = []
    for _ in range(n):
        ids = np.sort(rng.choice(terms, int(rng.integers(1, 40)), replace=False, p=held / held.sum()))
        w = rng.integers(1, 4, len(ids)).astype(float)
        vec.append((ids, w / np.sqrt((w * w).sum())))
    dense = np.zeros((n, terms))
    for i, (t, w) in enumerate(vec):
        dense[i, t] = w
    for n_dense in (0, 8, 1024):
        index = Index(vec, rng.integers(0, 2, n), np.arange(n), terms, block=32, dense=n_dense)
        for i, (e, c) in enumerate(index.nearest_many(vec[:90], 12, list(range(90)))):
            cos = np.round(dense @ dense[i], 9)
            want = [x for x in np.lexsort((np.arange(n), -cos)) if cos[x] > 0 and x != i][:12]
            assert e.tolist() == want and np.allclose(c, cos[want])


# ---------------------------------------------------------- decontamination
def brute_leaks(data, items):
    import re

    def words(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return re.findall("[0-9a-z\x80-\U0010ffff]+", low)

    out = []
    for item, t in items:
        ws = words(t)
        if not ws:
            continue
        k = min(5, len(ws))
        want = {tuple(ws[p:p + k]) for p in range(len(ws) - k + 1)}
        for i, d, *_ in data:
            dw = words(d)
            c = len(want & {tuple(dw[p:p + k]) for p in range(len(dw) - k + 1)})
            if c * 5 >= len(want) * 4:
                out.append((i, item, len(want), c))
    return sorted(out)


ITEMS = [(1, BASE), (2, BASE.replace("owls", "cats")), (3, "x" + BASE), (4, "one two"), (5, None), (6, ""), (7, "!!"),
         (8, " ".join(LONG.split()[4000:4040])), (9, "fox"), (10, "not there at all in any text"), (11, BASE)]


def test_leaks_match_brute_force(spark):
    from docloom.llm.op10_decontamination import find_leaks, without_leaks
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    df = docs(spark, extra=True)
    got = sorted((r.doc_id, r.item_id, r.n_shingles, r.n_common) for r in find_leaks(df, items).collect())
    want = brute_leaks(rows(), ITEMS)
    assert got == want
    left = without_leaks(df, items)
    assert left.columns == df.columns
    dirty = {w[0] for w in want}
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i, *_ in rows() if i not in dirty)
    assert find_leaks(df, items.limit(0)).collect() == []
    assert find_leaks(df.limit(0), items).collect() == []


def test_items_are_searched_in_blocks(spark, monkeypatch):
    from docloom.llm import op10_decontamination as op
    monkeypatch.setattr(op, "BLOCK_SHINGLES", 20)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.n_shingles, r.n_common) for r in op.find_leaks(docs(spark), items).collect())
    assert got == brute_leaks(rows(), ITEMS)


# --------------------------------------------------------------------- urls
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]
URLS = ["http://a.example.com/en/1", "https://www.example.com/en/1?x=/es/", "HTTP://WWW.Example.COM/en/", "http://x.net/es/1",
        "http://x.net/es", "http://net/fr/", "ftp://planet/es/", None, "", "no scheme/en/", "http://", "http://com",
        "http://com/", "http://x.com#f", "http://x.com?q://y.net/es/", "http://a.net/fr/#z", "http://example.com/EN/",
        "a://b://c.net/es/", "http://.net/es/", "http://x..net/fr/", "http://user@x.net:80/es/"]


def brute_rule(url):
    import re
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h) + len(p), len(h), h + p, a) for a, h, p in RULES
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def test_urls_match_brute_force(spark):
    from docloom.llm.op07_url_filters import judge_urls
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("rule", F.lit("x")) \
        .withColumn("extra", F.lit(1))
    got = as_dict(judge_urls(pages, RULES), "page_id")
    for i, u in enumerate(URLS):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == brute_rule(u), u
        assert got[i].extra == 1
    assert judge_urls(pages.limit(0), RULES).collect() == []
    assert {r.verdict for r in judge_urls(pages, []).collect()} == {"allow"}


def test_cascade_is_exact_over_its_universe(spark):
    from docloom.llm.op07_url_filters import build_cascade, listed_by
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(-2**62, 2**62, 20000))
    listed, absent = keys[::40], rng.integers(-2**62, 2**62, 50)
    universe = spark.createDataFrame([(int(k),) for k in keys[5:]], "k long")
    levels = build_cascade(np.concatenate([listed, absent]), universe)
    assert len(levels) > 1
    got = listed_by(levels, keys[5:].view(np.uint64))
    assert got.tolist() == np.isin(keys[5:], listed).tolist()
    assert sum(level.size for level in levels) < 64 * (len(listed) + 50)


# --------------------------------------------------------------------- WARC
def test_revisits(spark):
    from docloom.llm.op05_warc import resolve_revisits

    def rec(i, kind, url, moment, etag=None, digest=None, status=None, modified=None, **more):
        h = {k: v for k, v in {"etag": etag, "last-modified": modified, **more}.items() if v is not None}
        return (i, kind, url, moment, status or (200 if kind == "response" else 304), h, digest)

    data = [
        rec(1, "response", "http://www.A.com/x/", 10, etag="e1", digest="d1", **{"content-type": "text/html", "age": "1"}),
        rec(2, "revisit", "https://a.com/x?utm_source=q#f", 20, etag="e1", **{"age": "9", "content-type": "no"}),
        rec(3, "response", "http://a.com:80/x", 30, etag="e2", digest="d2"),
        rec(4, "revisit", "http://a.com/x", 40, etag="e1"),
        rec(5, "revisit", "http://a.com/x", 30, etag="e1"),       # same moment as 3: only 1 is earlier
        rec(6, "revisit", "http://b.com/", 50, etag="e"),
        rec(7, "revisit", None, 60, etag="e"),
        rec(8, "revisit", "http://a.com/x", 70, digest="d2"),     # falls back to the digest
        rec(9, "revisit", "http://a.com/x", 71),                  # shares no validator
        rec(10, "response", "http://a.com/x", 72, etag="e9", status=404),
        rec(11, "revisit", "http://a.com/x", 73, etag="e2"),
        rec(12, "response", "http://c.com/?b=2&a=1", 5, modified="m", digest="d"),
        rec(13, "revisit", "http://C.com?a=1&b=2", 6, modified="m", etag="new"),
        rec(14, "response", "http://a.com/x", 30, etag="e0", digest="d0"),  # tie with 3: the greater id counts
    ]
    records = spark.createDataFrame(data, "record_id long, type string, url string, moment long, status int, "
                                          "headers map<string,string>, digest string")
    want = {1: ("full", 1), 2: ("resolved", 1), 3: ("full", 3), 4: ("mismatch", None), 5: ("resolved", 1),
            6: ("no_earlier", None), 7: ("unresolvable", None), 8: ("mismatch", None), 9: ("mismatch", None),
            10: ("other", None), 11: ("mismatch", None), 12: ("full", 12), 13: ("resolved", 12), 14: ("full", 14)}
    for slice_rows in (1000, 3, 1):
        got = as_dict(resolve_revisits(records, slice_rows), "record_id")
        assert {i: (r.state, r.source_id) for i, r in got.items()} == want
    assert got[2].merged == {"etag": "e1", "content-type": "text/html", "age": "9"}
    assert got[13].merged == {"last-modified": "m", "etag": "new"}
    assert resolve_revisits(records.limit(0)).collect() == []


# ----------------------------------------------------------------- oracles
@pytest.mark.parametrize("name", ["op4_ngram_join", "op5_warc", "op6_exact_dedup", "op7_url_filters",
                                  "op8_substring_dedup", "op10_decontamination"])
def test_queries_equal_their_sql(spark, name):
    from docloom.llm.queries import QUERIES, SQL
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    res = con.execute(SQL[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=key) == sorted(res.fetchall(), key=key)


# ----------------------------------------------------------------- pipeline
def test_pipeline_stages(spark, tables):
    import corpus_pipeline as p
    from test_dedup_ops import brute_exact, brute_jaccard
    extra = [(200 + i, f"filler text number {i} about the {w} and the sea", "en", "a")
             for i, w in enumerate(["moon", "sun", "stars", "wind", "rain"] * 4)]
    data = rows() + extra
    sf = tables(documents=docs(spark, data), benchmark=spark.createDataFrame(ITEMS[7:8], "item_id long, text string"))
    df, cols = docs(spark, data), ["doc_id", "text", "lang", "source"]
    step = p.language(spark, df, sf)
    assert step.columns == cols
    known = [r for r in data if r[0] not in (4, 5, 6, 15)]
    assert sorted(r.doc_id for r in step.collect()) == sorted(r[0] for r in known)
    step = p.exact_dedup(spark, docs(spark, known), sf)
    exact = brute_exact(known)
    unique = {r[0]: r for r in known if exact[r[0]][0] == r[0]}
    assert step.columns == cols and sorted(r.doc_id for r in step.collect()) == sorted(unique)
    near = brute_jaccard(list(unique.values()), 5, 80)
    step = p.near_dedup(spark, docs(spark, list(unique.values())), sf)
    alone = [r for r in unique.values() if near[r[0]][1] == r[0]]
    assert step.columns == cols and sorted(r.doc_id for r in step.collect()) == sorted(r[0] for r in alone)
    leaks = {x[0] for x in brute_leaks(alone, ITEMS[7:8])}
    final = [r for r in alone if r[0] not in leaks]
    assert leaks
    sp = library()
    got = as_dict(p.run(spark, sf))
    assert sorted(got) == sorted(r[0] for r in final)
    assert all(got[r[0]].ids == sp.encode(r[1]) + [sp.eos_id()] for r in final)


def test_pipeline_keeps_rows_without_ids_and_of_shared_ids(spark, tables):
    import corpus_pipeline as p
    from test_dedup_ops import ODD
    texts = sorted({" ".join(spaces(t)) for _, t, *_ in ODD})
    step = p.exact_dedup(spark, docs(spark, ODD), "")
    got = sorted(((r.doc_id, r.text) for r in step.collect()), key=str)
    assert sorted(" ".join(spaces(t)) for _, t in got) == texts
    assert {i for i, t in got if t.strip()} == {5, None} and (2**62, " ") in got
    step = p.near_dedup(spark, step, "")
    assert sorted(" ".join(spaces(r.text)) for r in step.collect()) == texts
    base = " ".join(f"w{i}" for i in range(80))
    near = [(None, base, None, None), (None, base + " x", None, None), (3, base + " y", None, None),
            (3, "alone " * 9, None, None), (None, "nobody " * 9, None, None)]
    got = sorted(((r.doc_id, r.text) for r in p.near_dedup(spark, docs(spark, near), "").collect()), key=str)
    assert got == sorted([(3, base + " y"), (3, "alone " * 9), (None, "nobody " * 9)], key=str)
    two = [(4, "a b", "en", None), (4, "a  b", "de", None), (4, "a  b", "de", None)]
    assert [(r.text, r.lang) for r in p.exact_dedup(spark, docs(spark, two), "").collect()] == [("a  b", "de")]


def test_pipeline_on_empty_documents(spark, tables):
    import corpus_pipeline as p
    sf = tables(documents=docs(spark, []), benchmark=spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert p.run(spark, sf).collect() == []


def test_warc_without_moments_and_with_clashing_names(spark):
    from docloom.llm.op05_warc import resolve_revisits
    h = {"etag": '"x"'}
    data = [(1, "response", "http://a.com/", None, 200, h, "d"), (2, "revisit", "http://a.com/", None, 304, h, None),
            (3, "revisit", "http://a.com/", 9, 304, h, None), (4, "response", "http://b.com/", 1, 200, h, "d"),
            (5, "revisit", "http://b.com/", None, 304, h, None), (6, "revisit", "http://b.com/", 2, 304, h, None)]
    df = spark.createDataFrame(data, "record_id long, type string, url string, moment long, status int, "
                                     "headers map<string,string>, digest string")
    for c in ("state", "canonical", "merged", "source_id", "extra"):
        df = df.withColumn(c, F.lit("other"))
    out = resolve_revisits(df)
    assert len(set(out.columns)) == len(out.columns) and "extra" in out.columns
    got = {r.record_id: (r.state, r.source_id) for r in out.collect()}
    assert got == {1: ("full", 1), 2: ("no_earlier", None), 3: ("no_earlier", None), 4: ("full", 4),
                   5: ("no_earlier", None), 6: ("resolved", 4)}

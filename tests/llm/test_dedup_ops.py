"""Exact dedup, substring dedup, byte dedup and the Jaccard join against brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import as_dict, docs, rows, spaces


def sha(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


# ------------------------------------------------------------------ exact
def brute_exact(data):
    groups = defaultdict(list)
    for i, t, *_ in data:
        groups["".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")].append((-len(t or ""), i))
    return {i: (min(g)[1], len(g), sha(norm)) for norm, g in groups.items() for _, i in g}


@pytest.mark.parametrize("table_bytes", [32 << 20, 2000, 64])
def test_exact_dedup_matches_brute_force_at_every_table_size(spark, table_bytes):
    from docloom.llm.op06_exact_dedup import grace_dedup
    out = grace_dedup(docs(spark), table_bytes=table_bytes)
    got = [(r.doc_id, (r.keep_id, r.group_size, r.text_sha256)) for r in out.collect()]
    want = brute_exact(rows())
    assert sorted(i for i, _ in got) == sorted(i for i, *_ in rows())
    assert all(want[i] == v for i, v in got)
    # one row of each group stays, also where a row occurs twice
    kept = [r.keep_id for r in out.filter("kept and doc_id = keep_id").collect()]
    assert sorted(kept) == sorted({v[0] for v in want.values()}) and out.filter("kept").count() == len(kept)


def test_exact_dedup_hot_text_is_dealt_out(spark):
    from docloom.llm.op06_exact_dedup import grace_dedup
    data = [(i, "same text over and over " * 20, "en", "a") for i in range(400)] + \
           [(1000 + i, f"text {i}", "en", "a") for i in range(50)]
    df = docs(spark, data).repartition(20)
    got = as_dict(grace_dedup(df, table_bytes=600))
    assert all(got[i].keep_id == 0 and got[i].group_size == 400 for i in range(400))
    assert all(got[1000 + i].group_size == 1 for i in range(50))


def test_exact_dedup_compares_content_not_hashes():
    from docloom.llm.op06_exact_dedup import table_groups
    same = np.zeros(6, np.int64)  # every hash collides
    assert table_groups(same, ["a", "b", "a", "c", "b", "a"]).tolist() == [0, 1, 0, 3, 1, 0]


# -------------------------------------------------------------- substring
def brute_words(data, k):
    first, out = {}, {}
    uniq = {(i, t or ""): spaces(t) for i, t, *_ in data}
    for (i, t), ws in sorted(uniq.items()):
        for p in range(len(ws) - k + 1):
            w = tuple(ws[p:p + k])
            first.setdefault(w, (i, p))
            first[w] = min(first[w], (i, p))
    for (i, t), ws in uniq.items():
        gone = set()
        for p in range(len(ws) - k + 1):
            if first[tuple(ws[p:p + k])] < (i, p):
                gone |= set(range(p, p + k))
        kept = [w for n, w in enumerate(ws) if n not in gone]
        out[i] = (len(ws), len(gone), sha(" ".join(kept)))
    return out


@pytest.mark.parametrize("window,gram", [(20, 8), (4, 2), (5, 5)])
def test_substring_dedup_matches_brute_force(spark, window, gram):
    from docloom.llm.op08_substring_dedup import drop_repeats
    out = drop_repeats(docs(spark, extra=True), window=window, gram=gram)
    assert out.count() == len(rows())
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in out.collect()}
    assert got == brute_words(rows(), window)


def test_substring_spans_name_their_source(spark):
    from docloom.llm.op08_substring_dedup import keyed, repeated_spans
    spans = {r.id: r for r in repeated_spans(keyed(docs(spark), "doc_id", "text")).collect()}
    assert (spans[1].sources, spans[1].source_starts, spans[1].starts) == ([0], [0], [0])
    assert spans[14].sources == [0] and spans[14].starts == [3]


# ------------------------------------------------------------------ bytes
def brute_bytes(data, k):
    seen = Counter()
    for _, t, *_ in data:
        b = (t or "").encode()
        for p in range(len(b) - k + 1):
            seen[b[p:p + k]] += 1
    out = {}
    for i, t, *_ in data:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 2, np.int8)
        for p in range(len(b) - k + 1):
            if seen[b[p:p + k]] > 1:
                gone[p + 1:p + k + 1] = 1
        kept = bytes(c for c, g in zip(b, gone[1:]) if not g)
        out[i] = (len(b), int(gone.sum()), int((np.diff(gone) == 1).sum()), sha(kept))
    return out


@pytest.mark.parametrize("window,gram", [(200, 32), (20, 6), (8, 8)])
def test_byte_dedup_matches_brute_force(spark, window, gram):
    from docloom.llm.op09_suffix_dedup import drop_repeated_bytes
    out = drop_repeated_bytes(docs(spark, extra=True), window=window, gram=gram)
    assert out.count() == len(rows())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect()}
    assert got == brute_bytes(rows(), window)


def test_merged_transforms_equal_brute_force():
    from docloom.llm.op09_suffix_dedup import Shard, merge_shards, repeated_windows
    rng = np.random.default_rng(3)
    for trial in range(25):
        base = bytes(rng.choice(list(b"ab" if trial % 2 else b"abcdef"), 200).tolist())
        strings = [base[i:i + n] for i, n in zip(rng.integers(0, 150, 7).tolist(), rng.integers(1, 90, 7).tolist())]
        for window in (2, 6, 30):
            seen = Counter(s[p:p + window] for s in strings for p in range(len(s) - window + 1))
            got = repeated_windows(strings, window, shards=1 + trial % 4)
            for s, g in zip(strings, got):
                assert g.tolist() == [seen[s[p:p + window]] > 1 for p in range(max(0, len(s) - window + 1))]
    # the merged order is the order of all suffixes, and lcp says where they part
    shards = [Shard([b"banana", b"bandana"]), Shard([b"ananas"])]
    z, block, lcp = merge_shards(shards, 6)
    place = [iter(s.order) for s in shards]
    text = [s.text.tobytes() * 3 for s in shards]
    merged = [text[k][p:p + 6] for k in z.tolist() for p in [int(next(place[k]))]]
    assert merged == sorted(merged)
    for i in range(1, len(merged)):
        common = next((n for n in range(6) if merged[i][n] != merged[i - 1][n]), 6)
        assert lcp[i] == (common // 2 * 2 if common < 6 else -1)


# ---------------------------------------------------------------- jaccard
def brute_jaccard(data, n=4, percent=85):
    sets = defaultdict(set)
    for i, t, *_ in data:
        ws = spaces("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        grams = {tuple(ws[p:p + n]) for p in range(len(ws) - n + 1)} if len(ws) >= n else ({tuple(ws)} if ws else set())
        sets[i] |= grams
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                c = len(sets[a] & sets[b])
                if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
                    x, y = sorted((find(a), find(b)))
                    parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_jaccard_components_match_brute_force(spark):
    from docloom.llm.op04_ngram_join import jaccard_components
    out = jaccard_components(docs(spark, extra=True))
    assert out.count() == len(rows())
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out.collect()} == brute_jaccard(rows())


def test_jaccard_chains_outliers_and_common_passages(spark):
    """Near copies of many strengths, so that leaders, bounds and left-over pairs all decide."""
    from docloom.llm.op04_ngram_join import jaccard_components
    rng = np.random.default_rng(5)
    passage = [f"p{i}" for i in range(30)]
    data, i = [], 0
    for g in range(6):
        base = [f"g{g}w{k}" for k in range(int(rng.integers(20, 120)))]
        for _ in range(25):
            w = list(base)
            for k in rng.integers(0, len(w), int(rng.integers(0, 5))).tolist():
                w[k] = f"e{int(rng.integers(0, 6))}"
            if rng.random() < 0.3:
                w = w[int(rng.integers(0, 12)):]
            if rng.random() < 0.3:
                w = w + passage
            data.append((i, " ".join(w), "en", "a"))
            i += 1
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs(spark, data)).collect()}
    assert got == brute_jaccard(data)


# ------------------------------------------- null ids and ids of several rows
ODD = [(None, "seven wise owls watch the old oak tree by the river all night long", None, None),
       (None, "another text that nobody else has, not even in part, anywhere at all", None, None),
       (5, "seven wise owls watch the old oak tree by the river all night long", None, None),
       (5, "the keeper of the lighthouse writes letters to the moon every single evening", None, None),
       (5, "the keeper of the lighthouse writes letters to the moon every single evening", None, None),
       (6, "the keeper of the lighthouse writes letters to the moon every single evening", None, None),
       (None, "the keeper of the lighthouse writes letters to the moon every single evening", None, None),
       (None, None, None, None), (None, "", None, None), (2**62, " ", None, None)]


@pytest.mark.parametrize("table_bytes", [32 << 20, 64])
def test_exact_dedup_of_odd_ids(spark, table_bytes):
    from docloom.llm.op06_exact_dedup import grace_dedup
    got = grace_dedup(docs(spark, ODD), table_bytes=table_bytes).collect()
    assert len(got) == len(ODD)
    groups = defaultdict(list)
    for r in got:
        groups[r.text_sha256].append(r)
    size = {sha("".join(spaces(t))): n for t, n in Counter(" ".join(spaces(t)) for _, t, *_ in ODD).items()}
    assert {k: len(v) for k, v in groups.items()} == size
    for rs in groups.values():
        stay, = [r for r in rs if r.kept]
        assert stay.doc_id == stay.keep_id and all((r.keep_id, r.group_size) == (stay.doc_id, len(rs)) for r in rs)
    owls = sha("".join(spaces(ODD[0][1])))
    assert next(r.doc_id for r in groups[owls] if r.kept) == 5  # a known id comes before none
    assert next(r.doc_id for r in groups[sha("")] if r.kept) == 2**62  # a code point more


def test_jaccard_components_of_odd_ids(spark):
    from docloom.llm.op04_ngram_join import jaccard_components
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(docs(spark, ODD)).collect()), key=str)
    n = [max(0, len(spaces(t)) - 3) for _, t, *_ in ODD]
    least = [5, None, 5, 5, 5, 5, 5, None, None, 2**62]
    assert got == sorted(((i, k, c) for (i, *_), k, c in zip(ODD, n, least)), key=str)


def test_large_group_of_near_copies_is_not_compared_in_all_pairs(spark, monkeypatch):
    """Copies with up to six changed words of 300: few pairs link, all share most shingles."""
    from docloom.llm import op04_ngram_join as join
    rng = np.random.default_rng(5)
    data = []
    for i in range(120):
        words = [f"w{j}" for j in range(300)]
        for j in rng.choice(300, rng.integers(4, 7), replace=False):
            words[j] = f"x{i}y{j}"
        data.append((i, " ".join(words), "en", "a"))
    # changed alike at many places: they link by what both lack, far from the centre
    for i in range(120, 124):
        words = data[0][1].split()
        for j in range(0, 120, 12):
            words[j] = f"z{j}"
        words[200 + i % 4] = f"v{i}"
        data.append((i, " ".join(words), "en", "a"))
    compared, whole = [], join._overlaps

    def counted(pairs, classes):
        compared.append(pairs.count())
        return whole(pairs, classes)

    monkeypatch.setattr(join, "_overlaps", counted)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in join.jaccard_components(docs(spark, data)).collect()}
    assert got == brute_jaccard(data)
    assert len({c for _, c in got.values()}) > 10 and len({got[i][1] for i in range(120, 124)}) == 1
    assert sum(compared) < len(data) * len(data) / 8


def test_classes_that_share_an_id_lose_no_link(spark):
    """Two texts of one id, each with a near copy: both pairs are found."""
    from docloom.llm.op04_ngram_join import jaccard_components
    long = [" ".join(f"{w}{i}" for i in range(60)) for w in ("tick", "tock")]
    data = [(1, long[0], None, None), (1, long[1], None, None), (8, long[0] + " end", None, None), (9, long[1] + " end", None, None)]
    got = [(r.doc_id, r.component_id, r.component) for r in jaccard_components(docs(spark, data)).collect()]
    assert sorted(g[:2] for g in got) == [(1, 1), (1, 1), (8, 1), (9, 1)]
    assert len({g[2] for g in got}) == 2


def test_repeats_of_odd_ids(spark):
    from docloom.llm.op08_substring_dedup import drop_repeats
    from docloom.llm.op09_suffix_dedup import drop_repeated_bytes
    words = Counter((r.doc_id, r.n_words, r.n_removed) for r in drop_repeats(docs(spark, ODD), window=5, gram=2).collect())
    n = [len(spaces(t)) for _, t, *_ in ODD]
    gone = [n[0], 0, 0, 0, 0, n[3], n[3], 0, 0, 0]  # null ids come last; equal rows are one document
    assert words == Counter((i, k, g) for (i, *_), k, g in zip(ODD, n, gone))
    cut = drop_repeated_bytes(docs(spark, ODD), window=20, gram=8).collect()
    size = [len((t or "").encode()) for _, t, *_ in ODD]
    all_gone = [1, 0, 1, 1, 1, 1, 1, 0, 0, 0]
    assert Counter((r.doc_id, r.n_bytes, r.n_removed) for r in cut) == Counter(
        (i, k, k * g) for (i, *_), k, g in zip(ODD, size, all_gone))


# ------------------------------------------------------------------ empty
def test_empty_tables(spark):
    from docloom.llm.op04_ngram_join import jaccard_components
    from docloom.llm.op06_exact_dedup import grace_dedup
    from docloom.llm.op08_substring_dedup import drop_repeats
    from docloom.llm.op09_suffix_dedup import drop_repeated_bytes
    empty = docs(spark, [])
    for f in (jaccard_components, grace_dedup, drop_repeats, drop_repeated_bytes):
        assert f(empty).collect() == []


def test_bitmap_travels_compressed(spark):
    """The driver and the broadcast hold a small part of the bitmap that a task unpacks."""
    import pickle
    from docloom.llm.anchors import Bitmap, repeated_anchors
    from docloom.llm.common import mix

    def places(text):  # every row names ten hashes, and one that all rows name
        n = [int(t) for t in text.to_pylist()]
        return mix(np.array([x for k in n for x in [10 ** 6, *range(10 * k, 10 * k + 10)]], np.uint64))

    rows = [(i, str(i), None, None) for i in range(2000)] + [(9000 + i, str(i), None, None) for i in range(20)]
    found = repeated_anchors(docs(spark, rows), places, 60 << 20, per_anchor=6)
    bitmap = Bitmap.unpack(*found)
    assert len(bitmap.packed) == 1 << (found[2] - 3) >= 8 << 20
    assert len(pickle.dumps(found)) < len(bitmap.packed) // 100
    has = bitmap.has(mix(np.array([10 ** 6, *range(20_000)], np.uint64)))
    assert has[:201].all() and has[201:].sum() < 100


def test_hot_passage_meets_once_per_chunk(spark):
    """Of a passage that every document holds, one entry per chunk meets the others."""
    from helpers import BASE
    from docloom.llm.op08_substring_dedup import chunk_edges, drop_repeats, keyed
    data = [(i, f"own{i} {BASE} end{i} {BASE}", "en", "a") for i in range(300)]
    df = docs(spark, data)
    heads, tails = chunk_edges(keyed(df, "doc_id", "text"))
    h = np.concatenate([np.frombuffer(r.h, np.uint64) for r in heads.collect()])
    assert np.unique(h, return_counts=True)[1].max() <= df.rdd.getNumPartitions()
    assert sum(len(r.pos) // 4 for r in tails.collect()) > 300
    got = as_dict(drop_repeats(df))
    n = len(BASE.split())
    assert got[0].kept == f"own0 {BASE} end0" and got[0].n_removed == n
    assert all(got[i].kept == f"own{i} end{i}" and got[i].n_removed == 2 * n for i in range(1, 300))

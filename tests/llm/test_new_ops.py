"""Conversation repair, ranked search and packing against brute force and SQL."""

import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from helpers import LONG, docs, rows
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
sha = lambda x: hashlib.sha256(x.encode()).hexdigest()


def oracle(sql, **frames):
    con = duckdb.connect()
    for name, df in frames.items():
        con.register(name, df.toArrow())
    r = con.execute(sql)
    return [d[0] for d in r.description], r.fetchall()


def same_rows(df, sql, **frames):
    cols, want = oracle(sql, **frames)
    assert sorted(cols) == sorted(df.columns)
    got = [tuple(r[c] for c in cols) for r in df.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


# ------------------------------------------------------- conversation repair
def brute(codes):
    """(cost, audit) by trying all edits up to two inserts at each place."""
    from docloom.llm.op11_conversation_repair import BLANK, TRUNCATED, after
    best = {0: (0, "")}
    for k in range(len(codes) + 1):
        grown = {}
        for q, (cost, audit) in best.items():
            for n in range(3):
                s, c, a = q, cost, audit
                for _ in range(n):
                    s, c, a = (3 if s == 2 else 2), c + 3, a + "I"
                outs = [(s, c, a)]
                if k < len(codes):
                    initial, fault = codes[k]
                    outs = [(s, c + 4, a + "D")]
                    if fault < BLANK:
                        mend = 3 * (fault == TRUNCATED)
                        outs.append((3 if s == 2 else 2, c + 3 + mend, a + "R"))
                        if after(s, initial) is not None:
                            outs.append((after(s, initial), c + mend, a + "K"))
                for s2, c2, a2 in outs:
                    grown[s2] = min(grown.get(s2, (c2, a2)), (c2, a2))
        best = grown
    return min(best[q] for q in (0, 3) if q in best)


def test_search_equals_brute_force():
    from docloom.llm.op11_conversation_repair import START, cheapest, edit_lattice
    for n in range(4):
        for codes in itertools.product(itertools.product("suax", (0, 1, 2)), repeat=n):
            got = cheapest(edit_lattice([(r, f, 0) for r, f in codes]), START, (0, 3))
            assert got == brute(codes), codes
    rng = random.Random(5)
    for _ in range(300):
        codes = [(rng.choice("uuaasx"), rng.choice((0, 0, 0, 1, 2, 3))) for _ in range(rng.randint(4, 30))]
        assert cheapest(edit_lattice([(r, f, 0) for r, f in codes]), START, (0, 3)) == brute(codes)


def talks(spark, n=60, seed=3, long=0):
    """Conversations with nulls, repeated rows, ties, gaps, odd roles and blank texts."""
    rng = random.Random(seed)
    data = []
    for c in [*range(n), None]:
        size = long if c == 7 and long else rng.randint(1, 9)
        for t in range(size):
            turn = rng.choice([t, t, t, t + 1, None])
            role = rng.choice(["user", "assistant", "system", "user", "assistant", "tool", None, ""])
            text = rng.choice(["Yes.", "No", " \t\n", "", None, f"Say {rng.randint(0, 3)}!", "what? \x0b ", "ünï.", "x" * 50])
            data.append((c, turn, role, text))
    data += rng.sample(data, len(data) // 6)
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string").repartition(3)


def test_repair_equals_sql(spark):
    from docloom.llm.op11_conversation_repair import damage, repair_conversations
    from docloom.llm.queries import SQL
    for seed in (3, 4):
        t = talks(spark, seed=seed)
        same_rows(repair_conversations(damage(t)), SQL["op11_conversation_repair"], conversations=t)


def test_long_conversations_in_blocks_equal_whole_ones(spark):
    """Blocks, several levels of blocks, and counted copies give the same repair."""
    from docloom.llm.op11_conversation_repair import damage, repair_conversations
    t = damage(talks(spark, n=30, long=160)).cache()
    key = lambda d: sorted(d.collect(), key=repr)
    whole = key(repair_conversations(t))
    assert max(len(r.audit) for r in whole) > 100
    assert key(repair_conversations(t, long_rows=4, block_rows=3, fan=2)) == whole
    assert key(repair_conversations(t, long_rows=20, block_rows=7, fan=100)) == whole
    assert key(repair_conversations(t, long_bytes=10, block_rows=1, fan=3)) == whole


def test_repair_of_given_rows(spark):
    from docloom.llm.op11_conversation_repair import as_rows, repair_conversations
    data = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (2, 0, "assistant", "Hm."), (3, 0, "system", "Be kind."),
            (4, 0, "user", "cut off"), (4, 1, "assistant", "ok."), (5, 5, "user", ""), (5, 9, "user", "")]
    out = {r.conv_id: r for r in repair_conversations(as_rows(spark.createDataFrame(
        data, "conv_id long, turn long, role string, text string").withColumn("audit", F.lit(1)))).collect()}
    assert (out[1].cost, out[1].audit, out[1].repaired_sha256) == (0, "KK", sha("user:Hi.\nassistant:Yes."))
    assert (out[2].cost, out[2].audit) == (3, "IK") and out[2].repaired_sha256 == sha("user:\nassistant:Hm.")
    assert (out[3].cost, out[3].audit, out[3].repaired_sha256) == (4, "D", sha(""))
    assert (out[4].cost, out[4].audit, out[4].truncated) == (3, "KK", 1)
    assert (out[5].blank, out[5].gaps, out[5].illegal, out[5].audit) == (2, 3, 1, "DD")


def test_repair_of_nothing(spark):
    from docloom.llm.op11_conversation_repair import damage, repair_conversations
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair_conversations(damage(empty)).count() == 0
    # every row dropped: zeros, an empty audit and the hash of the empty text
    gone = [(c, t) for c in range(60) for t in range(1) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    assert gone
    t = spark.createDataFrame([(c, t, "user", "Hi.") for c, t in gone], "conv_id long, turn long, role string, text string")
    for kw in ({}, {"long_rows": 0}):
        for r in repair_conversations(damage(t), **kw).collect():
            assert tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "", sha(""))


# ------------------------------------------------------------ ranked search
ITEMS = [(1, "The quick brown fox"), (2, None), (3, ""), (4, "river bank river BANK 123"), (5, "--- !!"), (6, "漢字 long7 tail3 long9"),
         (7, "zzz-not-there"), (8, "one two a b the"), (None, "hund katze"), (1, "lantern")]


def test_search_equals_sql(spark):
    from docloom.llm.op12_ranked_search import rank_documents
    from docloom.llm.queries import SQL
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("rank", F.lit("other"))
    d = docs(spark, extra=True).withColumn("item", F.lit(1))
    d = d.unionByName(d.limit(1).withColumn("doc_id", F.lit(None).cast("long")))
    same_rows(rank_documents(d, items), SQL["op12_ranked_search"], documents=d, benchmark=items)
    small = SQL["op12_ranked_search"].replace("rank <= 50", "rank <= 3")
    same_rows(rank_documents(d, items, top=3), small, documents=d, benchmark=items)


def test_search_stops_creating_accumulators_and_loses_nothing():
    """Against scores of all documents, with skewed frequencies and copies."""
    import pyarrow as pa
    from docloom.llm import op12_ranked_search as s
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(300)]
    p = 1 / np.arange(1, 301) ** 1.2
    texts = [" ".join(rng.choice(words, rng.integers(1, 80), p=p / p.sum())) for _ in range(1500)] + ["w250 w1 w1"] * 400
    vocabulary = pa.array(words, pa.large_string())
    lists = s.Lists(pa.array(texts, pa.large_string()), vocabulary)
    n_docs, n_terms, df = len(texts), int(lists.n.sum()), np.diff(lists.cut)
    m = 50 + 50 * lists.n * n_docs // n_terms
    part = 1_000_000_000 * lists.tf // (1000 * lists.tf + 20 * m[lists.doc])
    acc, has, spared = np.zeros(len(texts), np.int64), np.zeros(len(texts), bool), 0
    for _ in range(40):
        q = sorted({int(t) for t in rng.choice(300, 12, p=p / p.sum())} | {int(rng.integers(150, 300))}, key=lambda t: (df[t], t))
        query = [(t, s.weight(n_docs, int(df[t]))) for t in q if df[t]]
        full = np.zeros(len(texts), np.int64)
        for t, w in query:
            a, b = lists.cut[t], lists.cut[t + 1]
            full[lists.doc[a:b]] += w * part[a:b]
        held = s.search_chunk(lists, part, query, 10, 0, acc, has)
        best = np.sort(full)[-10:]
        assert (np.sort(acc[held])[-10:] == best[-len(held):]).all()
        must = np.flatnonzero((full >= best[0]) & (full > 0))
        assert set(must) <= set(held.tolist()) and (acc[must] == full[must]).all()
        spared += int((full > 0).sum()) - len(held)
        acc[held], has[held] = 0, False
    assert spared > 1000  # accumulators that were never created


def test_search_in_blocks_chunks_and_partitions(spark, monkeypatch):
    from docloom.llm import op12_ranked_search as s
    from docloom.llm.queries import SQL
    d = spark.read.parquet(f"{SF}/documents.parquet").repartition(7)
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    monkeypatch.setattr(s, "CHUNK", 20_000)
    monkeypatch.setattr(s, "BLOCK_TERMS", 300)
    monkeypatch.setattr(s, "SHARES", 3)
    same_rows(s.rank_documents(d, items), SQL["op12_ranked_search"], documents=d, benchmark=items)


def test_search_of_nothing(spark):
    from docloom.llm.op12_ranked_search import rank_documents
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert rank_documents(docs(spark, []), items).count() == 0
    assert rank_documents(docs(spark), none).count() == 0
    assert rank_documents(docs(spark), spark.createDataFrame(ITEMS[1:3], items.schema)).count() == 0


# ------------------------------------------------------------------ packing
def tokenizer_path():
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def check_packing(out, capacity):
    """Gapless sequences within the capacity; all pieces of a document there."""
    bins = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end <= capacity
    return len(bins)


def test_pieces_equal_the_library(spark):
    import struct
    from tokenizers import Tokenizer
    from docloom.llm.op13_best_fit_packing import pack
    tok = Tokenizer.from_file(tokenizer_path())
    odd = [(30, "é ́a 　b <|endoftext|>x it's <|startoftext|> ΑΣ ΑΣ. <|endoftext|>", "en", "a"), (31, "́ x\x85y\x1c z  ", "en", "a"),
           (32, "İstanbul ﬁ 한글 é 12'll've", "en", "a"), (None, "no id", "en", "a"), (None, None, "en", "a")]
    data = rows() + odd
    for capacity in (2048, 64):
        out = pack(docs(spark, data, extra=True).withColumn("piece", F.lit("x")), tokenizer_path(), capacity, keep_ids=True).collect()
        got = {}
        for r in out:
            assert len(r.ids) == r.length and r.start == r.piece * capacity
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(r.ids)}I", *r.ids))
            got.setdefault(r.doc_id, []).append((r.piece, r.ids))
        for i in {d[0] for d in data}:
            want = [tok.encode(t or "", add_special_tokens=False).ids + [0] for j, t, *_ in data if j == i]
            want = [(k, w[k * capacity:(k + 1) * capacity]) for w in want for k in range(-(-len(w) // capacity))]
            assert sorted(got[i]) == sorted(want)
        check_packing(out, capacity)


def test_packing_of_documents(spark):
    from docloom.llm.queries import op13_best_fit_packing
    out = op13_best_fit_packing(spark, SF).collect()
    n = check_packing(out, 2048)
    assert n <= math.ceil(sum(r.length for r in out) / 2048) * 1.02 + 1


def item_by_item(lengths, capacity):
    """The same method piece by piece: greedy pairs above a third, then best fit."""
    large = sorted((n for n in lengths if 3 * n > capacity), reverse=True)
    gaps = []
    while large:
        n = large.pop(0)
        mate = next((k for k, m in enumerate(large) if n + m <= capacity), None)
        gaps.append(capacity - n - (large.pop(mate) if mate is not None else 0))
    for n in sorted((n for n in lengths if 3 * n <= capacity), reverse=True):
        fit = [g for g in gaps if g >= n]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - n)
        else:
            gaps.append(capacity - n)
    return sorted(gaps)


def test_counts_pack_like_single_pieces():
    from docloom.llm.op13_best_fit_packing import pack_lengths
    rng = random.Random(1)
    for _ in range(300):
        capacity = rng.choice([6, 10, 30, 100])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.3:
            lengths += [rng.randint(1, capacity)] * 40  # a hot length
        counts = {n: lengths.count(n) for n in set(lengths)}
        rules = pack_lengths(counts, capacity)
        held, bins = {}, {}
        for k, (length, first, each, at, offset) in enumerate(rules):
            last = rules[k + 1][1] if k + 1 < len(rules) and rules[k + 1][0] == length else counts[length]
            for i in range(last - first):
                bins.setdefault(at + i // each, []).append((offset + i % each * length, length))
            held[length] = held.get(length, 0) + last - first
        assert held == counts
        for parts in bins.values():
            end = 0
            for offset, length in sorted(parts):
                assert offset == end
                end += length
            assert end <= capacity and sum(3 * n > capacity for _, n in parts) <= 2
        assert sorted(capacity - sum(n for _, n in parts) for parts in bins.values()) == item_by_item(lengths, capacity)


def test_packing_of_nothing(spark):
    from docloom.llm.op13_best_fit_packing import pack
    assert pack(docs(spark, []), tokenizer_path()).count() == 0
    out = pack(docs(spark, [(1, None, None, None), (2, "", None, None), (3, LONG, None, None)]), tokenizer_path()).collect()
    assert {r.doc_id for r in out if r.length == 1} >= {1, 2}
    assert sum(r.length for r in out if r.doc_id == 3) == max(r.start + r.length for r in out if r.doc_id == 3)

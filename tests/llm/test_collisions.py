"""Words that collide under every polynomial hash modulo 2**64: different words all the same."""

from helpers import SCHEMA, as_dict

N = 1024
A = "".join("ab"[bin(i).count("1") % 2] for i in range(N))     # the Thue-Morse word
B = "".join("ba"[bin(i).count("1") % 2] for i in range(N))     # and its complement


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "a") for i, t in enumerate(texts)], SCHEMA)


def test_join_keeps_them_apart(spark):
    from docloom.llm.op04_ngram_join import jaccard_components
    got = as_dict(jaccard_components(frame(spark, [f"one two three {A}", f"one two three {B}", A, B, f"one two three {A}"])))
    assert [got[i].component_id for i in range(5)] == [0, 1, 2, 3, 0]


def test_substring_dedup_keeps_them_apart(spark):
    from docloom.llm.op08_substring_dedup import drop_repeats
    head = " ".join(f"w{i}" for i in range(19))
    got = as_dict(drop_repeats(frame(spark, [f"{head} {A}", f"{head} {B}", f"{head} {A}"])))
    assert [got[i].n_removed for i in range(3)] == [0, 0, 20]


def test_decontamination_keeps_them_apart(spark):
    from docloom.llm.op10_decontamination import find_leaks
    items = spark.createDataFrame([(7, B), (8, f"x {A}")], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in find_leaks(frame(spark, [f"see {A} here", f"see {B} here", f"x {A}"]), items).collect())
    assert got == [(1, 7), (2, 8)]


def test_windows_tell_arrangements_apart():
    """Also of two words in the order of the letters above."""
    import numpy as np
    from docloom.llm.common import window_hashes
    h = {"a": np.uint64(0x9E3779B97F4A7C15), "b": np.uint64(0xD1B54A32D192ED03)}
    for n in (2, 3, 4, 5, 8, 20, 64):
        x, y = (np.array([h[c] for c in w[:n]], np.uint64) for w in (A, B))
        assert window_hashes(x, n)[0] != window_hashes(y, n)[0]
        z = np.concatenate([x, y, x])
        all_ = window_hashes(z, n)
        assert len(all_) == len(z) - n + 1 and all_[0] == all_[2 * n] and len(window_hashes(z[:n - 1], n)) == 0
        for i in (0, 1, n):
            assert window_hashes(z[i:i + n], n)[0] == all_[i]

"""Suffix-array dedup: byte strings that occur twice, by merged Burrows-Wheeler
transforms.

A window can repeat only if all the short stretches in it can, that is, if the
anchor (see ``anchors``) of each occurs at two places; so a common line, shorter
than a window, makes no candidates.  A chunk cuts its texts into the runs of
candidate windows that share an anchor, ships each distinct run once, and runs
with one anchor meet in one task.  A run that
several places hold is repeated as a whole.  The distinct runs of a task are
dealt to shards; each shard's suffixes are sorted once, giving its transform.
The transforms are merged by iterative interleave refinement: starting from the
shards one after another, every pass reads the transforms in the current
interleave and deals the shard numbers out stably by symbol, which sorts the
merged suffixes by one more symbol (up to eight bytes) without looking at a
suffix again.  A rank at which neighbours first part has their common prefix; where
they still agree after a window's length lies an interval of repeated windows.

Defined results: null counts as empty; texts shorter than a window lose
nothing; rows that share an id and a text are two places, so they lose what
they share; rows that share an id only are told apart by a checksum of the
text; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from docloom.llm.anchors import Bitmap, anchor_places, bucket_bits, repeated_anchors, sliding, window_anchors
from docloom.llm.common import (BYTE_BASE, U64, Powers, buffers, byte_prefix, chunks, shown_id, span_hash, store,
                                text_bytes)
from docloom.llm.op08_substring_dedup import _frames, keyed

WINDOW, GRAM = 200, 32
SHARDS = 4
#: bytes of strings merged at a time, about (an anchor's strings stay together); at
#: most 65,536 symbols differ in so many, so symbols are eight bytes
MERGE_BYTES = 60_000
#: separates strings; no byte of UTF-8
END = 0xFF


# ---------------------------------------------------------------- transforms
class Shard:
    """Concatenated strings as one circular text: its first eight bytes at each
    position, and its rotations in order (by 256 bytes, by prefix doubling)."""

    def __init__(self, strings: list[bytes]):
        sep = bytes([END])
        self.text = np.frombuffer(sep.join([*strings, b""]), np.uint8)
        self.starts = np.concatenate([[0], np.cumsum([len(s) + 1 for s in strings])])[:-1]
        self.words = np.zeros(len(self.text), np.uint64)
        for k in range(8):
            self.words = (self.words << U64(8)) | np.roll(self.text, -k).astype(np.uint64)
        rank = np.unique(self.words, return_inverse=True)[1]
        for w in (8, 16, 32, 64, 128):
            top = int(rank.max())
            if top == len(rank) - 1:
                break
            rank = np.unique(rank.astype(np.int64) * (top + 1) + np.roll(rank, -w), return_inverse=True)[1]
        self.order = np.argsort(rank, kind="stable")


def _transforms(shards: list[Shard], depth: int) -> tuple[int, list[np.ndarray]]:
    """(bytes of a symbol, transform of each shard).  A symbol is the longest of
    8, 4, 2, 1 bytes that divides the depth and whose distinct values fit 16 bits."""
    words = np.concatenate([s.words for s in shards])
    cuts = np.cumsum([len(s.words) for s in shards])[:-1]
    for step in (8, 4, 2, 1):
        if depth % step:
            continue
        values, rank = np.unique(words >> U64(64 - 8 * step), return_inverse=True)
        if len(values) <= 1 << 16:
            break
    return step, [r[(s.order - step) % len(r)] for s, r in zip(shards, np.split(rank.astype(np.uint16), cuts))]


def merge_shards(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(interleave, block, lcp): the shard of each merged rank, the number of
    its block of suffixes that agree on ``depth`` bytes, and the number of bytes,
    in whole symbols, after which a rank parts from the one before it (-1: not
    within depth)."""
    step, bwt = _transforms(shards, depth)
    z = np.repeat(np.arange(len(shards), dtype=np.uint8), [len(t) for t in bwt])
    block, lcp = np.zeros(len(z), np.int32), np.full(len(z), -1, np.int16)
    symbols, count = np.empty(len(z), np.uint16), 1
    for done in range(0, depth, step):
        for k, t in enumerate(bwt):
            symbols[z == k] = t
        order = np.argsort(symbols, kind="stable")
        new, old = symbols[order], block[order]
        parts = np.ones(len(z), bool)
        parts[1:] = (new[1:] != new[:-1]) | (old[1:] != old[:-1])
        lcp[parts & (lcp < 0)] = done
        block, z = np.cumsum(parts, dtype=np.int32) - 1, z[order]
        if block[-1] + 1 == count:
            break  # no block parted, so none ever will
        count = int(block[-1]) + 1
    return z, block, lcp


def repeated_windows(strings: list[bytes], window: int = WINDOW, shards: int = SHARDS) -> list[np.ndarray]:
    """For each string, whether the window at each offset occurs a second time
    in the strings."""
    k = max(1, min(shards, len(strings)))
    dealt = [Shard(strings[i::k]) for i in range(k)]
    z, block, _ = merge_shards(dealt, window)
    twice = (np.bincount(block) > 1)[block]
    out: list[np.ndarray | None] = [None] * len(strings)
    for i, s in enumerate(dealt):
        flag = np.empty(len(s.text), bool)
        flag[s.order] = twice[z == i]
        for j, a in enumerate(s.starts.tolist()):
            n = len(strings[i + j * k])
            out[i + j * k] = flag[a:a + max(0, n - window + 1)]
    return out


# ---------------------------------------------------------------- the corpus
class Windows:
    """Byte windows of a chunk of texts with their anchors."""

    def __init__(self, window: int, gram: int):
        self.window, self.gram, self.span, self.powers = window, gram, window - gram + 1, Powers(BYTE_BASE)
        self.short = min(window, 2 * gram)  # bytes of a stretch

    def read(self, text: pa.Array) -> None:
        self.raw, self.offs = buffers(text)
        n = len(self.raw)
        s = byte_prefix(self.raw, self.powers)
        at = np.arange(max(0, n - self.gram + 1))
        self.grams = span_hash(s, at, at + self.gram, self.powers)
        self.end = np.repeat(self.offs[1:], np.diff(self.offs))
        self.stretches = self._anchors(self.short)

    def _anchors(self, window: int) -> np.ndarray:
        size = max(0, len(self.raw) - window + 1)
        return window_anchors(self.grams, np.arange(size) + window <= self.end[:size], window - self.gram + 1)

    def places(self) -> np.ndarray:
        return self.grams[anchor_places(self.grams, self.stretches, self.short - self.gram + 1)]

    def runs(self, bitmap: Bitmap):
        """(first window, last window, anchor, anchor met twice) of the runs of
        candidate windows with one anchor."""
        m = self._anchors(self.window)
        may = self.stretches != 0
        may[may] = bitmap.has(self.stretches[may])
        ok = m != 0
        if len(m):
            ok &= sliding(np.minimum, may.view(np.uint8), self.window - self.short + 1).astype(bool)
        edge = np.ones(len(m), bool)
        edge[1:] = m[1:] != m[:-1]
        begin = ok & edge
        begin[1:] |= ok[1:] & ~ok[:-1]
        last = ok.copy()
        last[:-1] &= edge[1:] | ~ok[1:]
        a, b = np.flatnonzero(begin), np.flatnonzero(last)
        v, place = m[a], np.flatnonzero(anchor_places(self.grams, m, self.span))
        lo, hi = np.searchsorted(place, a), np.searchsorted(place, b + self.span)
        run = np.repeat(np.arange(len(a)), hi - lo)
        at = np.arange(len(run)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)
        twice = np.bincount(run, self.grams[place[at]] == v[run], len(a)) > 1
        return a, b, v, twice


NAMES = ["bucket", "label", "ids", "keys", "anchors", "twice", "sizes", "content", "run", "doc", "start"]


def repeated_bytes(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``docs``: id, key, text.  Per (id, key): begins and ends of the maximal
    byte runs covered by windows that occur elsewhere."""
    spark = docs.sparkSession
    total = text_bytes(docs)

    def places(text):
        w = Windows(window, gram)
        w.read(text)
        return w.places()

    found = repeated_anchors(docs, places, total, per_anchor=gram // 2)
    flags = spark.sparkContext.broadcast(found)
    cut = bucket_bits(spark, total, 2 << 20)

    def emit(batches):
        w, bitmap = Windows(window, gram), Bitmap.unpack(*flags.value)
        for batch, text in chunks(batches, "text"):
            w.read(text)
            a, b, v, twice = w.runs(bitmap)
            if not len(a):
                continue
            ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            doc = np.searchsorted(w.offs, a, "right") - 1
            start, data = a - w.offs[doc], w.raw.tobytes()
            bucket = (v >> U64(64 - cut)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            out = []
            for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                known: dict[bytes, int] = {}
                heads, run = [], []
                for i, x, y in zip(part.tolist(), a[part].tolist(), b[part].tolist()):
                    c = data[x:y + window]
                    k = known.setdefault(c, len(known))
                    if k == len(heads):
                        heads.append(i)
                    run.append(k)
                near, d = np.unique(doc[part], return_inverse=True)
                out.append((int(bucket[part[0]]), int(ids.min()), ids[near].astype(np.int64).tobytes(),
                            keys[near].astype(np.int64).tobytes(), v[heads].tobytes(),
                            twice[heads].astype(np.uint8).tobytes(),
                            np.array([len(c) for c in known], np.uint32).tobytes(), b"".join(known),
                            np.array(run, np.uint32).tobytes(), d.astype(np.uint32).tobytes(),
                            start[part].astype(np.uint32).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.int64()),
                 *(pa.array([r[j] for r in out], pa.binary()) for j in range(2, 11))], NAMES)

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        known: dict[bytes, int] = {}
        anchor, twice, number, places_ = [], [], [], []
        for sizes, content, v, t, run in zip(_frames(pdf, "sizes", np.uint32), pdf["content"],
                                             _frames(pdf, "anchors", np.uint64), _frames(pdf, "twice", np.uint8),
                                             _frames(pdf, "run", np.uint32)):
            ends = np.cumsum(sizes.astype(np.int64)).tolist()
            mine = []
            for x, y, h, more in zip([0, *ends], ends, v.tolist(), t.tolist()):
                k = known.setdefault(content[x:y], len(known))
                if k == len(anchor):
                    anchor.append(h)
                    twice.append(more)
                mine.append(k)
            number.append(np.array(mine, np.int64)[run])
        held = np.bincount(np.concatenate(number), minlength=len(known))
        strings = list(known)
        _, group, size = np.unique(np.array(anchor, np.uint64), return_inverse=True, return_counts=True)
        rest = np.flatnonzero((size[group] > 1) | (np.array(twice) > 0))
        spans: list[tuple] = [()] * len(strings)
        # strings with different anchors share no window: merge some anchors' at a time
        rest = rest[np.argsort(group[rest], kind="stable")]
        bytes_ = np.cumsum([len(strings[i]) for i in rest.tolist()])
        whole = np.searchsorted(group[rest], group[rest], "left")  # where the anchor's strings begin
        part = (bytes_ // MERGE_BYTES)[whole] if len(rest) else np.zeros(0, np.int64)
        for some in np.split(rest, np.flatnonzero(np.diff(part)) + 1) if len(rest) else []:
            for i, flag in zip(some.tolist(), repeated_windows([strings[i] for i in some.tolist()], window)):
                f = np.flatnonzero(np.diff(np.concatenate([[0], flag.view(np.int8), [0]])))
                spans[i] = tuple(zip(f[::2].tolist(), (f[1::2] + window - 1).tolist()))
        for i in np.flatnonzero(held > 1).tolist():
            spans[i] = ((0, len(strings[i])),)
        n_spans = np.array([len(s) for s in spans], np.int64)
        first = np.concatenate([[0], np.cumsum(n_spans)])
        flat = np.array([x for s in spans for x in s], np.int64).reshape(-1, 2)
        out = []
        for k, (label, ids, keys, doc, start) in enumerate(zip(
                pdf["label"], _frames(pdf, "ids", np.int64), _frames(pdf, "keys", np.int64),
                _frames(pdf, "doc", np.uint32), _frames(pdf, "start", np.uint32))):
            r = number[k]
            m = np.repeat(np.arange(len(r)), n_spans[r])
            if not len(m):
                continue
            at = np.arange(len(m)) - np.repeat(np.cumsum(n_spans[r]) - n_spans[r], n_spans[r]) + first[r[m]]
            x = flat[at] + start.astype(np.int64)[m, None]
            out.append((label, ids[doc[m]].tobytes(), keys[doc[m]].tobytes(), x[:, 0].tobytes(), x[:, 1].tobytes()))
        return pd.DataFrame(out, columns=["label", "id", "key", "begin", "end"])

    def unite(pdf: pd.DataFrame) -> pd.DataFrame:
        t = pd.DataFrame({k: np.concatenate(_frames(pdf, k, np.int64)) for k in ("id", "key", "begin", "end")})
        t = t.sort_values(["id", "key", "begin"], kind="stable")
        a = {k: t[k].to_numpy() for k in t}
        other = np.ones(len(t), bool)
        other[1:] = (a["id"][1:] != a["id"][:-1]) | (a["key"][1:] != a["key"][:-1])
        far = np.cumsum(other) * (int(a["end"].max()) + 1)  # keeps documents apart on one line
        reach = np.maximum.accumulate(a["end"] + far)
        new = other.copy()
        new[1:] |= (a["begin"] + far)[1:] > reach[:-1]
        i = np.flatnonzero(new)
        j = np.append(i[1:], len(t)) - 1
        runs = pd.DataFrame({"id": a["id"][i], "key": a["key"][i], "begins": a["begin"][i], "ends": (reach - far)[j]})
        return runs.groupby(["id", "key"], sort=False).agg(list).reset_index()

    pieces = docs.select("id", "key", "text").mapInArrow(
        emit, "bucket int, label long, " + ", ".join(f"{k} binary" for k in NAMES[2:]))
    # so many tasks: their work is not in proportion to the bytes they read
    met = pieces.repartition(1 << cut, "bucket").groupBy("bucket").applyInPandas(
        meet, "label long, id binary, key binary, begin binary, end binary")
    return met.groupBy("label").applyInPandas(unite, "id long, key long, begins array<long>, ends array<long>")


def drop_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                        gram: int = GRAM) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256, kept (remaining bytes) for every row."""
    rows = keyed(docs, id_col, text_col)
    runs = store(repeated_bytes(rows, window, gram), "byte_runs").dropDuplicates(["id", "key"])
    joined = rows.join(runs, ["id", "key"], "left")

    def cut(batches):
        for batch, text in chunks(batches, "text"):
            ids, begins, ends = (batch.column(k).to_pylist() for k in (0, 3, 4))
            out = []
            for i, t, b, e in zip(ids, text.to_pylist(), begins, ends):
                data, b, e = t.encode(), b or [], e or []
                kept = b"".join([data[x:y] for x, y in zip([0, *e], [*b, len(data)])])
                out.append((i, len(data), len(data) - len(kept), len(b), hashlib.sha256(kept).hexdigest(), kept))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([o[k] for o in out], pa.int64()) for k in range(4)),
                 pa.array([o[4] for o in out], pa.string()), pa.array([o[5] for o in out], pa.binary())],
                [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return joined.select("id", "key", "text", "begins", "ends").mapInArrow(
        cut, f"{id_col} long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary").withColumn(
        id_col, shown_id(id_col))

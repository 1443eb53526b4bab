"""Substring dedup: De Bruijn compaction over words.

Every window of k words is an edge of a De Bruijn graph between its first and
last k - 1 words.  Edges met once cannot be part of a repeat; those whose
anchor (see ``anchors``) occurs once never leave their task.  The others meet by
edge hash: each occurrence learns the coordinates (document, word) of the edge's
first occurrence.  Repeated edges that follow one another both in a document and
at their source form a non-branching path and are compacted to one span with
source coordinates; a branch shows as a jump of the source.  Spans join back to
the documents and their words go.

An edge is known by a 64-bit hash and verified by 32 bits of another one, both of the
words' bytes with different seeds.  Only
an edge's first occurrence in a chunk meets those of other chunks; the later ones
wait at their chunk's label and take the source that their first one learnt.

Defined results: null and texts shorter than a window lose nothing; ids are
expected to be unique, rows that share an id and a text get the same result,
rows that share an id only are told apart by a checksum of the text; null ids come
after all others, told apart in the same way; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.anchors import (Bitmap, anchor_places, bucket_bits, bucket_cuts, repeated_anchors, window_anchors)
from docloom.llm.common import (buffers, chunks, is_space, known_id, shown_id, split_words, store, text_bytes,
                                window_hashes, word_hashes)

WINDOW, GRAM = 20, 8
CHECK_SEED = 1


class Edges:
    """Windows of a chunk of texts with their anchors and hashes."""

    def __init__(self, window: int, gram: int):
        self.window, self.gram, self.span = window, gram, window - gram + 1

    def read(self, text: pa.Array) -> None:
        raw, offs = buffers(text)
        start, end, self.first = split_words(raw, offs, is_space(raw))
        self.hashes = word_hashes(raw, start, end, (0, CHECK_SEED))
        n = len(start)
        self.grams = window_hashes(self.hashes[0], self.gram)
        size = max(0, n - self.window + 1)
        last = np.repeat(self.first[1:], np.diff(self.first))[:size]  # end of the document of each word
        self.anchors = window_anchors(self.grams, np.arange(size) + self.window <= last, self.span)

    def places(self) -> np.ndarray:
        return self.grams[anchor_places(self.grams, self.anchors, self.span)]

    def edges(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h, check = (window_hashes(x, self.window)[at] for x in self.hashes)
        return h, check.astype(np.uint32)


def _frames(pdf: pd.DataFrame, col: str, kind) -> list[np.ndarray]:
    return [np.frombuffer(b, kind) for b in pdf[col]]


def _joined(pdf: pd.DataFrame, col: str, kind) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *_frames(pdf, col, kind)])


def chunk_edges(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """``docs``: id, key, text.  Per chunk and bucket the first occurrences of
    edges, and per chunk the later ones of those that have such."""
    spark = docs.sparkSession
    total = text_bytes(docs)

    def places(text):
        e = Edges(window, gram)
        e.read(text)
        return e.places()

    found = repeated_anchors(docs, places, total, per_anchor=24)
    flags = spark.sparkContext.broadcast(found)
    cut = bucket_bits(spark, total, 8 << 20)

    def occurrences(batches):
        """Of each chunk its label, ids and keys, the edges' hashes, documents and
        positions in order, which are an edge's first, and the others that count."""
        e, bitmap = Edges(window, gram), Bitmap.unpack(*flags.value)
        for batch, text in chunks(batches, "text"):
            e.read(text)
            at = np.flatnonzero((e.anchors != 0) & bitmap.has(e.anchors))
            if not len(at):
                continue
            ids = batch.column(0).to_numpy()
            keys = batch.column(1).to_numpy()
            doc = np.searchsorted(e.first, at, "right") - 1
            pos = (at - e.first[doc]).astype(np.uint32)
            h, c = e.edges(at)
            order = np.lexsort((pos, keys[doc], ids[doc], c, h))
            h, c, doc, pos = h[order], c[order], doc[order], pos[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
            ref = np.cumsum(new) - 1
            heads = np.flatnonzero(new)
            k = heads[ref]
            twin = ~new & (ids[doc] == ids[doc[k]]) & (keys[doc] == keys[doc[k]]) & (pos == pos[k])
            more = np.flatnonzero(~new & ~twin)
            yield int(ids.min()), ids, keys, h, c, doc, pos, ref, heads, more

    def emit_heads(batches):
        for label, ids, keys, h, c, doc, pos, ref, heads, more in occurrences(batches):
            a = bucket_cuts(h[heads], cut)
            tailed = np.zeros(len(heads), np.uint8)
            tailed[ref[more]] = 1
            out = []
            for i in np.flatnonzero(np.diff(a)).tolist():
                x = heads[a[i]:a[i + 1]]
                near, d = np.unique(doc[x], return_inverse=True)
                out.append((i, label, ids[near].astype(np.int64).tobytes(), keys[near].astype(np.int64).tobytes(),
                            h[x].tobytes(), c[x].tobytes(), d.astype(np.uint32).tobytes(), pos[x].tobytes(),
                            tailed[a[i]:a[i + 1]].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.int64()),
                 *(pa.array([r[j] for r in out], pa.binary()) for j in range(2, 9))], ["bucket", "label", *head_cols])

    def emit_tails(batches):
        for label, ids, keys, h, c, doc, pos, ref, heads, more in occurrences(batches):
            if not len(more):
                continue
            some, at = np.unique(ref[more], return_inverse=True)
            x = heads[some]
            row = (h[x], c[x], ids[doc[x]].astype(np.int64), pos[x], ids[doc[more]].astype(np.int64),
                   keys[doc[more]].astype(np.int64), pos[more], at.astype(np.uint32))
            yield pa.RecordBatch.from_arrays(
                [pa.array([label], pa.int64()), *(pa.array([v.tobytes()], pa.binary()) for v in row)],
                ["label", *tail_cols])

    head_cols = ["ids", "keys", "h", "c", "doc", "pos", "tailed"]
    tail_cols = ["h", "c", "head_id", "head_pos", "id", "key", "pos", "ref"]
    rows = docs.select("id", "key", "text")
    return (rows.mapInArrow(emit_heads, "bucket int, label long, " + ", ".join(f"{k} binary" for k in head_cols)),
            rows.mapInArrow(emit_tails, "label long, " + ", ".join(f"{k} binary" for k in tail_cols)))


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``docs``: id, key, text.  Per (id, key) with later occurrences: starts
    and numbers of windows of the compacted spans, and their sources."""
    heads, tails = chunk_edges(docs, window, gram)

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, keys = _frames(pdf, "ids", np.int64), _frames(pdf, "keys", np.int64)
        base = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
        h, c, pos = (np.concatenate(_frames(pdf, k, t)) for k, t in (("h", np.uint64), ("c", np.uint32), ("pos", np.uint32)))
        doc = np.concatenate([d + np.int64(o) for d, o in zip(_frames(pdf, "doc", np.uint32), base)])
        ids, keys = np.concatenate(ids), np.concatenate(keys)
        order = np.lexsort((pos, keys[doc], ids[doc], c, h))
        new = np.ones(len(order), bool)
        hs, cs = h[order], c[order]
        new[1:] = (hs[1:] != hs[:-1]) | (cs[1:] != cs[:-1])
        first = np.empty(len(order), np.int64)  # of each entry, the entry of its edge's first occurrence
        first[order] = order[new][np.cumsum(new) - 1]
        tailed = _joined(pdf, "tailed", np.uint8) == 1
        later = np.flatnonzero(~((ids[doc] == ids[doc[first]]) & (keys[doc] == keys[doc[first]]) & (pos == pos[first])))
        row = np.searchsorted(base, doc[later], "right") - 1
        order = np.argsort(row, kind="stable")
        cuts = np.searchsorted(row[order], np.arange(len(pdf) + 1))
        out = []
        for i, label in enumerate(pdf["label"]):
            o = later[order[cuts[i]:cuts[i + 1]]]
            if len(o):
                f, t = first[o], tailed[o]
                out.append((label, ids[doc[o]].tobytes(), keys[doc[o]].tobytes(), pos[o].tobytes(),
                            ids[doc[f]].tobytes(), pos[f].tobytes(), h[o[t]].tobytes(), c[o[t]].tobytes(),
                            ids[doc[f[t]]].tobytes(), pos[f[t]].tobytes()))
        return pd.DataFrame(out, columns=["label", "id", "key", "pos", "src", "src_pos", "h", "c", "h_src", "h_pos"])

    def compact(pdf: pd.DataFrame, late: pd.DataFrame) -> pd.DataFrame:
        kinds = (("id", np.int64), ("key", np.int64), ("pos", np.uint32), ("src", np.int64), ("src_pos", np.uint32))
        met = {k: _joined(pdf, k, t) for k, t in kinds}
        # later occurrences in the chunk: the source their first one learnt, or itself
        edge = [("h", np.uint64), ("c", np.uint32)]
        known = pd.DataFrame({k: _joined(pdf, k, t) for k, t in edge})
        known["at"] = np.arange(len(known))
        mine = pd.DataFrame({k: _joined(late, k, t) for k, t in edge}).merge(
            known.drop_duplicates(["h", "c"]), "left", ["h", "c"])["at"].fillna(-1).to_numpy(np.int64)
        src, src_pos = _joined(late, "head_id", np.int64), _joined(late, "head_pos", np.uint32)
        src[mine >= 0] = _joined(pdf, "h_src", np.int64)[mine[mine >= 0]]
        src_pos[mine >= 0] = _joined(pdf, "h_pos", np.uint32)[mine[mine >= 0]]
        base = np.cumsum([0] + [len(x) for x in _frames(late, "c", np.uint32)])
        ref = np.concatenate([np.zeros(0, np.int64),
                              *(x + np.int64(o) for x, o in zip(_frames(late, "ref", np.uint32), base))])
        own = {k: _joined(late, k, t) for k, t in kinds[:3]} | {"src": src[ref], "src_pos": src_pos[ref]}
        t = pd.DataFrame({k: np.concatenate([met[k], own[k]]) for k in met})
        t = t.drop_duplicates(["id", "key", "pos"]).sort_values(["id", "key", "pos"], kind="stable")
        a = {k: t[k].to_numpy().astype(np.int64) for k in t}
        other = np.ones(len(t), bool)
        other[1:] = (a["id"][1:] != a["id"][:-1]) | (a["key"][1:] != a["key"][:-1])
        step = other.copy()
        step[1:] |= ((np.diff(a["pos"]) != 1) | (a["src"][1:] != a["src"][:-1]) | (np.diff(a["src_pos"]) != 1))
        begin = np.flatnonzero(step)
        spans = pd.DataFrame({"id": a["id"][begin], "key": a["key"][begin], "starts": a["pos"][begin],
                              "windows": np.diff(np.append(begin, len(t))), "sources": a["src"][begin],
                              "source_starts": a["src_pos"][begin]})
        return spans.groupby(["id", "key"], sort=False).agg(list).reset_index()

    met = heads.groupBy("bucket").applyInPandas(
        meet, "label long, id binary, key binary, pos binary, src binary, src_pos binary, h binary, c binary, "
              "h_src binary, h_pos binary")
    return met.groupBy("label").cogroup(tails.groupBy("label")).applyInPandas(
        compact, "id long, key long, starts array<long>, windows array<long>, sources array<long>, "
                 "source_starts array<long>")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id (null: after all others), key (checksum of the text) and text, null as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(known_id(id_col).alias("id"), F.crc32(text.cast("binary")).alias("key"),
                       text.alias("text"))


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                 gram: int = GRAM) -> DataFrame:
    """id, n_words, n_removed, kept_sha256, kept (the words that stay, joined by
    one space) for every row."""
    rows = keyed(docs, id_col, text_col)
    spans = store(repeated_spans(rows, window, gram), "spans").dropDuplicates(["id", "key"])
    joined = rows.join(spans.select("id", "key", "starts", "windows"), ["id", "key"], "left")

    def cut(batches):
        for batch, text in chunks(batches, "text"):
            ids, starts, windows = (batch.column(k).to_pylist() for k in (0, 3, 4))
            out = []
            for i, (t, s, w) in enumerate(zip(text.to_pylist(), starts, windows)):
                raw = np.frombuffer(t.encode(), np.uint8)
                a, b, _ = split_words(raw, np.array([0, len(raw)]), is_space(raw))
                keep = np.ones(len(a), bool)
                for x, n in zip(s or (), w or ()):
                    keep[x:x + n + window - 1] = False
                data = raw.tobytes()
                kept = b" ".join([data[x:y] for x, y in zip(a[keep].tolist(), b[keep].tolist())])
                out.append((ids[i], len(a), len(a) - int(keep.sum()), hashlib.sha256(kept).hexdigest(), kept.decode()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[k] for o in out], t) for k, t in enumerate(
                    (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()))],
                [id_col, "n_words", "n_removed", "kept_sha256", "kept"])

    return joined.select("id", "key", "text", "starts", "windows").mapInArrow(
        cut, f"{id_col} long, n_words long, n_removed long, kept_sha256 string, kept string").withColumn(
        id_col, shown_id(id_col))

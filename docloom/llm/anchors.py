"""Anchors of repeated strings, found without shipping every window.

A window of some length holds ``span`` consecutive short grams; its anchor is
the smallest gram hash.  Equal windows have equal anchors, so a window can
repeat only if its anchor occurs at two places.  One in about ``span / 2``
positions is an anchor.  Anchor hashes are counted in hash ranges; the repeated
ones are returned as one bitmap of bounded size.  The bitmap only ever lets too
much through, never too little: it thins what the next pass ships and decides
nothing.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from docloom.llm.common import U64, bucket_count, chunks

#: bound of the bitmap: 2**28 bits, 32 MB
MAX_BITS = 28
#: anchors a task gathers before it ships them
HOLD = 1 << 18


def sliding(op, x: np.ndarray, n: int) -> np.ndarray:
    """op over every n consecutive values."""
    out, w = x, 1
    while 2 * w <= n:
        out = op(out[:-w], out[w:])
        w *= 2
    return op(out[:len(out) - (n - w)], out[n - w:]) if w < n else out


def window_anchors(grams: np.ndarray, valid: np.ndarray, span: int) -> np.ndarray:
    """The anchor hash of every window of ``span`` grams; 0 where not valid."""
    if len(grams) < span:
        return np.zeros(0, np.uint64)
    return np.where(valid, sliding(np.minimum, grams, span), U64(0))


def anchor_places(grams: np.ndarray, anchors: np.ndarray, span: int) -> np.ndarray:
    """Whether a gram is the anchor of some valid window that holds it."""
    if not len(anchors):
        return np.zeros(len(grams), bool)
    pad = np.zeros(span - 1, np.uint64)
    return (sliding(np.maximum, np.concatenate([pad, anchors, pad]), span) == grams) & (grams != 0)


def bucket_cuts(values: np.ndarray, bits: int) -> np.ndarray:
    """Where each of 2**bits ranges begins in sorted values."""
    return np.searchsorted(values >> U64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))


def bucket_bits(spark, total_bytes: int, per_bucket: int) -> int:
    return max(1, (bucket_count(spark, total_bytes, per_bucket) - 1).bit_length())


class Bitmap:
    def __init__(self, packed: np.ndarray, bits: int):
        self.packed, self.bits = packed, bits

    @classmethod
    def unpack(cls, ranges: dict[int, bytes], cut: int, bits: int) -> Bitmap:
        """The bitmap of compressed ranges (2**cut of them, missing ones are empty)."""
        packed = np.zeros(1 << (bits - 3), np.uint8)
        size = len(packed) >> cut
        for k, x in ranges.items():
            packed[k * size:(k + 1) * size] = np.frombuffer(pa.decompress(x, size, "zstd"), np.uint8)
        return cls(packed, bits)

    def has(self, h: np.ndarray) -> np.ndarray:
        at = (h >> U64(64 - self.bits)).astype(np.int64)
        return (self.packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def repeated_anchors(docs: DataFrame, places, total_bytes: int, per_anchor: int) -> tuple[dict[int, bytes], int, int]:
    """What ``Bitmap.unpack`` takes: the driver and the broadcast hold the ranges
    compressed, only a task unpacks them.  ``docs`` has a ``text`` column; ``places(text array)`` gives the hashes
    of all anchors in a chunk, one for each place.  A hash that a chunk holds
    often is shipped once, marked as repeated.  Inside a bucket 32 more bits tell
    hashes apart; as buckets keep their size, about one in 10,000 hashes counts
    as repeated by mistake, at any size of the corpus."""
    spark = docs.sparkSession
    expected = max(1, total_bytes // per_anchor)
    cut = bucket_bits(spark, expected * 4, 4 << 20)
    bits = min(MAX_BITS, max(cut + 3, (8 * expected).bit_length()))

    def held(batches):
        """Anchors of several chunks at a time, so that less is shipped twice."""
        got, size = [], 0
        for _, text in chunks(batches, "text"):
            got.append(places(text))
            size += len(got[-1])
            if size >= HOLD:
                yield np.concatenate(got)
                got, size = [], 0
        if size:
            yield np.concatenate(got)

    def emit(batches):
        for found in held(batches):
            values, n = np.unique(found, return_counts=True)
            one, more = values[n == 1], values[n > 1]
            a, b = bucket_cuts(one, cut), bucket_cuts(more, cut)
            one, more = (((x << U64(cut)) >> U64(32)).astype(np.uint32) for x in (one, more))
            full = np.flatnonzero((np.diff(a) > 0) | (np.diff(b) > 0)).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int32()), pa.array([one[a[k]:a[k + 1]].tobytes() for k in full], pa.binary()),
                 pa.array([more[b[k]:b[k + 1]].tobytes() for k in full], pa.binary())], ["bucket", "one", "more"])

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        values, n = np.unique(np.frombuffer(b"".join(pdf["one"]), np.uint32), return_counts=True)
        more = np.concatenate([values[n > 1], np.frombuffer(b"".join(pdf["more"]), np.uint32)])
        flags = np.zeros(1 << (bits - cut), bool)
        flags[more >> np.uint32(32 - (bits - cut))] = True
        return pd.DataFrame({"bucket": [int(pdf["bucket"].iloc[0])], "flags": [pa.compress(np.packbits(flags), "zstd", asbytes=True)]})

    rows = docs.select("text").mapInArrow(emit, "bucket int, one binary, more binary").groupBy(
        "bucket").applyInPandas(count, "bucket int, flags binary").collect()
    return {r["bucket"]: bytes(r["flags"]) for r in rows}, cut, bits

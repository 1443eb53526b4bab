"""Helpers shared by the text operators: shared-folder tables, bounded chunks
of Arrow batches, vectorised word splitting and hashing, graph components."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: bytes of text a worker turns into arrays at a time (a longer text is one chunk)
CHUNK_BYTES = 1 << 19
U64 = np.uint64
#: odd multipliers of the polynomial hashes (arbitrary, fixed)
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD1B54A32D192ED03
MASK64 = (1 << 64) - 1
#: bytes of a word that is hashed by itself
LONG_WORD = 64
#: stands for a null id while a job runs, so null ids come after all others
NO_ID = (1 << 63) - 1


# ---------------------------------------------------------------- tables
def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; only a local
    session without one gets a folder of its own."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        d = tempfile.mkdtemp(prefix="docloom-shared-")
        spark.sparkContext.setCheckpointDir(d)
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there,
    a lost executor costs nothing that was written."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def known_id(col: str | Column) -> Column:
    """The id as a number; a null id sorts after all others."""
    return F.coalesce((F.col(col) if isinstance(col, str) else col).cast("long"), F.lit(NO_ID))


def shown_id(col: str | Column) -> Column:
    """``known_id`` undone."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c != NO_ID, c)


def text_bytes(df: DataFrame, col: str = "text") -> int:
    return int(df.agg(F.coalesce(F.sum(F.octet_length(col)), F.lit(0))).head()[0])


def bucket_count(spark: SparkSession, total_bytes: int, per_bucket: int) -> int:
    """Buckets in proportion to the data, at least the session's shuffle partitions."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-int(total_bytes) // per_bucket))


def per_worker(key, make):
    """An object that all tasks of a Python worker share (``make`` builds it once).
    Code of this package is new in every task, so it is kept beside the modules."""
    held = sys.modules.setdefault("_docloom_worker", types.ModuleType("_docloom_worker")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


# ---------------------------------------------------------------- chunks
def as_text(col: pa.Array) -> pa.Array:
    """A plain string array without nulls (null counts as empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    return pc.fill_null(col, "") if col.null_count else col


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text array; offsets start at 0."""
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1] \
        if len(col) else np.zeros(1, np.int64)
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def chunks(batches, text: str, limit: int = CHUNK_BYTES):
    """Cut record batches so that a chunk holds at most ``limit`` bytes of
    text (or one row); yields (batch, text array)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        col = as_text(batch.column(batch.schema.get_field_index(text)))
        _, offs = buffers(col)
        i, n = 0, batch.num_rows
        while i < n:
            j = int(np.searchsorted(offs, offs[i] + limit, "right")) - 1
            j = min(n, max(j, i + 1))
            yield batch.slice(i, j - i), col.slice(i, j - i)
            i = j


# ---------------------------------------------------------------- hashing
def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (splitmix64)."""
    x = x.copy()
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inv = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            m = n + (1 << 16)
            for name, b in (("up", self.base), ("down", self.inv)):
                a = np.full(m, b, np.uint64)
                a[0] = 1
                setattr(self, name, np.cumprod(a, dtype=np.uint64))
        return self.up, self.down


def prefix_hash(values: np.ndarray, powers: Powers) -> np.ndarray:
    """S with S[i] = sum of values[t] * base**t for t < i (mod 2**64)."""
    up, _ = powers.get(len(values) + 1)
    s = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=s[1:])
    return s


def span_hash(s: np.ndarray, start: np.ndarray, end: np.ndarray, powers: Powers) -> np.ndarray:
    """Position-independent hash of values[start:end] for arrays of spans."""
    _, down = powers.get(len(s))
    return mix((s[end] - s[start]) * down[start])


def is_space(raw: np.ndarray) -> np.ndarray:
    """Bytes of [\\x20\\x09-\\x0D]."""
    return (raw == 32) | ((raw >= 9) & (raw <= 13))


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    return np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw)


def split_words(raw: np.ndarray, offs: np.ndarray, gap: np.ndarray):
    """Words (maximal runs of bytes outside ``gap``) of adjacent documents:
    (start, end, first word of each document + total)."""
    n = len(raw)
    w = np.zeros(n + 2, bool)
    w[1:-1] = ~gap
    first = w[1:-1] & ~w[:-2]
    last = w[1:-1] & ~w[2:]
    edge = offs[1:-1]
    edge = edge[(edge > 0) & (edge < n)]
    first[edge] = w[1:-1][edge]
    last[edge - 1] = w[1:-1][edge - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, offs)


def word_array(raw: np.ndarray, gap: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The words of ``split_words`` as an Arrow text array."""
    cut = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=cut[1:])
    return pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(cut), pa.py_buffer(raw[~gap])])


def word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray, seeds: tuple[int, ...] = (0,)) -> list[np.ndarray]:
    """64-bit hashes of the words, one array per seed.  Eight bytes of all words at a
    time are mixed in one after the other (sums of powers collide on chosen words);
    words of up to eight bytes and one length never collide.  Long words go one by one."""
    size = end - start
    data = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(raw) + 1, "<u8", data.data, strides=(1,))
    out = [mix(size.astype(np.uint64) + U64(WORD_BASE * (seed + 1) & MASK64)) for seed in seeds]
    live, done = np.flatnonzero(size <= LONG_WORD), 0
    while len(live):
        block, left = eight[start[live] + done], size[live] - done
        part = left < 8
        block[part] &= (U64(1) << (U64(8) * left[part].astype(np.uint64))) - U64(1)
        for h, seed in zip(out, seeds):
            h[live] = mix((h[live] ^ block) * U64(BYTE_BASE + 2 * seed))
        live, done = live[left > 8], done + 8
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        word = data[start[i]:end[i]].tobytes()
        for h, seed in zip(out, seeds):
            h[i] = xxhash.xxh3_64_intdigest(word, seed)
    return out


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n consecutive word hashes, by their order (len(h) - n + 1)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out, done, part, size = None, 0, h, 1
    while True:
        if n & size:  # windows of n are put together from windows of powers of two
            out = part if out is None else mix(out[:len(h) - done - size + 1] * U64(WORD_BASE) + part[done:])
            done += size
        if done == n:
            return mix(out[:len(h) - n + 1] + U64(n))
        part = mix(part[:-size] * U64(WORD_BASE) + part[size:])
        size *= 2


def byte_prefix(raw: np.ndarray, powers: Powers) -> np.ndarray:
    """prefix_hash of bytes, in place where it can be."""
    v = np.empty(len(raw) + 1, np.uint64)
    v[0] = 0
    v[1:] = raw
    v[1:] += U64(1)
    v[1:] *= powers.get(len(raw) + 1)[0][:len(raw)]
    return np.cumsum(v, out=v)


def gram_starts(first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Start words of all n-grams inside documents, and their document."""
    counts = np.maximum(np.diff(first) - (n - 1), 0)
    doc = np.repeat(np.arange(len(counts)), counts)
    begin = np.concatenate([[0], np.cumsum(counts)])[:-1]
    return np.arange(len(doc)) - begin[doc] + first[:-1][doc], doc


# ---------------------------------------------------------------- components
def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable over ``edges`` (a, b).

    Alternating large-star / small-star steps; every step is one shuffle of
    the edges and a partial minimum per node, and each round is written to the
    shared folder.  A node of very high degree never meets in one task: its
    minimum is a partial aggregate and the edges join back to it (AQE splits
    the skewed side; merge joins, so nothing is broadcast through the driver).
    """
    e = store(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
              .filter("a < b").distinct(), "edges")
    last = None
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # large star: larger neighbours point at the minimum of the neighbourhood
        large = both.filter("b > a").join(low.hint("merge"), "a").select(F.col("b"), F.col("m").alias("a"))
        # small star: smaller neighbours and the node itself point at the minimum
        small_low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (large.join(small_low.hint("merge"), "b").select(F.col("a").alias("b"), F.col("m").alias("a"))
                 .unionByName(small_low.select("b", F.col("m").alias("a"))))
        e = store(small.filter("a < b").select("a", "b").distinct(), "edges")
        state = tuple(e.agg(F.count("*"), F.coalesce(F.sum(F.hash("a", "b").cast("long")), F.lit(0))).head())
        if state == last:
            return e.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))
        last = state
    raise RuntimeError("components did not settle")

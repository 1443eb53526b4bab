"""N-gram Jaccard join with set-relation skipping.

A document's set holds its distinct word shingles.  Two sets can reach the
threshold only if their prefixes, the first n - ceil(t n) + 1 shingles in one
common order, share a shingle.  The order puts shingles known to occur in one
document first (from a bounded bitmap, see ``anchors``), so the prefix of a
document without a near copy names nobody and the document leaves the join.

Index level: the lists of a shingle carry each set's size and the shingle's
position, cut into blocks by size class; a block of the wrong size is never
read, and a position so late that the rest of the sets cannot reach the
threshold skips the entry.

Answer level: equal sets are one class.  Classes that hang together by similar
leaders are a group; a large one is linked by what its sets differ by from its
centre (``link_group``), so its pairs are never listed.  Each class is first compared with one
highly similar class, the one that leads most of its lists.  What is then known
answers the rest: classes that already hang together need no comparison, and
for two classes with one leader the Jaccard distances to it bound theirs (it is
a metric), and so does what the two lost of it (shingles known to be nobody else's
are never shared), which settles the pair when the bounds do.  Pairs that remain are
first bounded by small histograms of their sets (the summed differences of the
counts never exceed the symmetric difference), then compared exactly.

Defined results: documents without words or text have an empty set and link
with nothing; rows that share an id are judged each by its own text; a null id
comes after all others (a component of null ids only has a null id); an empty
table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.anchors import Bitmap, repeated_anchors
from docloom.llm.common import (U64, buffers, chunks, components, gram_starts, is_space, known_id, lower_ascii, mix,
                                shown_id, split_words, store, text_bytes, window_hashes, word_hashes)

SHINGLE = 4
#: Jaccard threshold in hundredths
PERCENT = 85
#: classes that hang together by their leaders and are linked by their centre
GROUP = 16


class Sets:
    """Distinct shingle hashes of a chunk of texts, by document, ascending."""

    def __init__(self, n: int):
        self.n = n

    def read(self, text: pa.Array) -> None:
        raw, offs = buffers(text)
        low = lower_ascii(raw)
        start, end, first = split_words(low, offs, is_space(low))
        words, = word_hashes(low, start, end)
        at, doc = gram_starts(first, self.n)
        count = np.diff(first)
        found, docs = [window_hashes(words, self.n)[at]], [doc]
        for k in range(1, self.n):  # the whole sequence is the one shingle
            short = np.flatnonzero(count == k)
            if len(short):
                found.append(window_hashes(words, k)[first[short]])
                docs.append(short)
        h, doc = np.concatenate(found), np.concatenate(docs)
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        self.h, self.doc = h[new], doc[new]
        self.cut = np.searchsorted(self.doc, np.arange(len(text) + 1))


def need(n, percent: int = PERCENT):
    """Least size of a partner's overlap with a set of n shingles."""
    return -(-percent * n // 100)


def histogram(h: np.ndarray) -> bytes:
    """Counts of the hashes by their leading bits, about eight to a bin, as bytes."""
    bits = max(4, int(len(h)).bit_length() - 4)
    return np.minimum(np.bincount((h >> U64(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(
        np.uint8).tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound of the symmetric difference of two sets from their histograms."""
    x, y = np.frombuffer(a, np.uint8).astype(np.int64), np.frombuffer(b, np.uint8).astype(np.int64)
    while len(x) > len(y):
        x = x[::2] + x[1::2]
    while len(y) > len(x):
        y = y[::2] + y[1::2]
    return int(np.abs(x - y).sum())


def shingle_sets(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Per row: id, text_key, size, own (shingles that no other document has), active, a
    128-bit fingerprint of the set and, if active, the set, its histogram and the
    shared shingles of its prefix with their positions."""
    spark = docs.sparkSession

    def places(text):
        s = Sets(n)
        s.read(text)
        return s.h

    found = repeated_anchors(docs, places, text_bytes(docs), per_anchor=6)
    flags = spark.sparkContext.broadcast(found)

    def run(batches):
        s, bitmap = Sets(n), Bitmap.unpack(*flags.value)
        for batch, text in chunks(batches, "text"):
            s.read(text)
            alone = ~bitmap.has(s.h)
            size = np.diff(s.cut)
            prefix = np.where(size > 0, size - need(size, percent) + 1, 0)
            own = np.concatenate([[0], np.cumsum(alone)])
            own = own[s.cut[1:]] - own[s.cut[:-1]]
            active = prefix > own
            sums = [np.concatenate([[U64(0)], np.cumsum(mix(s.h ^ U64(k)), dtype=np.uint64)]) for k in (1, 2)]
            f1, f2 = ((x[s.cut[1:]] - x[s.cut[:-1]]).view(np.int64) for x in sums)
            sets, keys, pos, hists = [], [], [], []
            for i, ok in enumerate(active.tolist()):
                if not ok:
                    sets.append(None), keys.append(None), pos.append(None), hists.append(None)
                    continue
                h = s.h[s.cut[i]:s.cut[i + 1]]
                shared = h[~alone[s.cut[i]:s.cut[i + 1]]][:prefix[i] - own[i]]
                sets.append(h.tobytes()), keys.append(shared.tobytes())
                pos.append(np.arange(own[i], prefix[i], dtype=np.int32).tobytes())
                hists.append(histogram(h))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(size, pa.int64()), pa.array(own, pa.int64()), pa.array(active),
                 pa.array(f1), pa.array(f2),
                 *(pa.array(x, pa.binary()) for x in (sets, keys, pos, hists))],
                ["id", "text_key", "size", "own", "active", "f1", "f2", "shingles", "keys", "pos", "hist"])

    return docs.select("id", "text", "text_key").mapInArrow(
        run, "id long, text_key long, size long, own long, active boolean, f1 long, f2 long, "
             "shingles binary, keys binary, pos binary, hist binary")


def _entries(classes: DataFrame) -> DataFrame:
    """The index: one row per list entry (shingle, class, size, position)."""
    def run(batches):
        for pdf in batches:
            keys = [np.frombuffer(b, np.int64) for b in pdf["keys"]]
            n = [len(k) for k in keys]
            if sum(n):
                yield pd.DataFrame({"key": np.concatenate(keys), "rep": np.repeat(pdf["rep"], n),
                                    "size": np.repeat(pdf["size"], n),
                                    "pos": np.concatenate([np.frombuffer(b, np.int32) for b in pdf["pos"]])})

    return classes.select("rep", "size", "keys", "pos").mapInPandas(run, "key long, rep long, size long, pos int")


def _overlaps(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b, common, union) of pairs of classes, from the whole sets."""
    x = classes.select(F.col("rep").alias("a"), F.col("shingles").alias("x"))
    y = classes.select(F.col("rep").alias("b"), F.col("shingles").alias("y"))

    def run(batches):
        for batch in batches:
            common, union = [], []
            for s, t in zip(batch.column(2), batch.column(3)):
                s, t = np.frombuffer(s.as_buffer(), np.uint64), np.frombuffer(t.as_buffer(), np.uint64)
                k = np.minimum(np.searchsorted(t, s), len(t) - 1)
                c = int((t[k] == s).sum())
                common.append(c)
                union.append(len(s) + len(t) - c)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(common, pa.int64()),
                                              pa.array(union, pa.int64())], ["a", "b", "common", "union"])

    return pairs.select("a", "b").join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(
        run, "a long, b long, common long, union long")


def _bounded(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose histograms leave the threshold possible, with the
    least share of their shingles that differ."""
    x = classes.select(F.col("rep").alias("a"), F.col("size").alias("m"), F.col("hist").alias("x"))
    y = classes.select(F.col("rep").alias("b"), F.col("size").alias("n"), F.col("hist").alias("y"))

    def run(batches):
        for pdf in batches:
            far = np.array([least_difference(a, b) for a, b in zip(pdf["x"], pdf["y"])], np.int64)
            total = pdf["m"].to_numpy() + pdf["n"].to_numpy()
            ok = far <= total - 2 * -(-total * percent // (100 + percent))
            yield pd.DataFrame({"a": pdf["a"][ok], "b": pdf["b"][ok], "far": (far / total)[ok]})

    return pairs.select("a", "b").join(x, "a").join(y, "b").mapInPandas(run, "a long, b long, far double")


def _counts(sets: DataFrame, col: str) -> DataFrame:
    """(grp, key, n): how many sets of each group hold a shingle."""
    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            h = [np.frombuffer(s.as_buffer(), np.int64) for s in batch.column(1)]
            grp = np.repeat(batch.column(0).to_numpy(), [len(x) for x in h])
            h = np.concatenate(h)
            order = np.lexsort((h, grp))
            h, grp = h[order], grp[order]
            start = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (grp[1:] != grp[:-1])])[:len(h)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(grp[start]), pa.array(h[start]), pa.array(np.diff(np.append(start, len(h))))], ["grp", "key", "n"])

    return sets.select("grp", col).mapInArrow(run, "grp long, key long, n long").groupBy("grp", "key").agg(
        F.sum("n").alias("n"))


def _deltas(members: DataFrame, percent: int) -> DataFrame:
    """Per class of a large group: delta, what differs between its set and the
    group's centre (the shingles that more than half of the group holds), d, their
    number, and w = (100 + percent) d - (100 - percent) size."""
    total = members.groupBy("grp").agg(F.count("*").alias("total"))
    centre = (_counts(members, "shingles").join(total, "grp").filter("2 * n > total")
              .groupBy("grp").agg(F.collect_list("key").alias("centre")))

    def run(batches):
        for pdf in batches:
            found = [np.setxor1d(np.frombuffer(s, np.int64), np.array([] if c is None else c, np.int64))
                     for s, c in zip(pdf["shingles"], pdf["centre"])]
            d = np.array([len(x) for x in found], np.int64)
            yield pd.DataFrame({"rep": pdf["rep"], "grp": pdf["grp"], "d": d,
                                "w": (100 + percent) * d - (100 - percent) * pdf["size"].to_numpy(),
                                "delta": [x.tobytes() for x in found]})

    return members.join(centre, "grp", "left").select("rep", "grp", "size", "shingles", "centre").mapInPandas(
        run, "rep long, grp long, d long, w long, delta binary")


def _delta_entries(deltas: DataFrame) -> DataFrame:
    """One row per class and differing shingle."""
    def run(batches):
        for pdf in batches:
            keys = [np.frombuffer(b, np.int64) for b in pdf["delta"]]
            n = [len(k) for k in keys]
            if sum(n):
                yield pd.DataFrame({c: np.repeat(pdf[c].to_numpy(), n) for c in pdf.columns if c != "delta"}
                                   | {"key": np.concatenate(keys)})

    return deltas.select("rep", "grp", "component", "d", "w", "need", "outside", "delta").mapInPandas(
        run, "rep long, grp long, component long, d long, w long, need long, outside boolean, key long")


def link_group(members: DataFrame, first: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) that connect what is connected inside large groups, beyond ``first``.
    ``members``: rep, grp, size, shingles.

    Two sets differ by what each differs from the centre, less twice what both
    differ by: they link when w + w' <= 2 (100 + percent) c with c common differences.
    So a class links with the one of least w, or is outside; a pair with one outside
    has w + w' > 0 and needs common differences: it is found by the prefixes of the
    differences, the rarest of a group first, as many as leave that number possible."""
    each = 2 * (100 + percent)
    deltas = store(_deltas(members, percent), "deltas")
    best = deltas.groupBy("grp").agg(F.min(F.struct("w", "rep")).alias("best"))
    deltas = (deltas.join(best, "grp").withColumn("outside", F.col("w") + F.col("best.w") > 0)
              .select("rep", "grp", "d", "w", "delta", "outside", F.col("best.w").alias("least"), F.col("best.rep").alias("middle")))
    deltas = store(deltas, "deltas")
    inside = deltas.filter("not outside")
    star = inside.filter("rep != middle").select(F.col("middle").alias("a"), F.col("rep").alias("b"))
    # an outside class may meet any class of its group, the others only those outside
    away = deltas.filter("outside").groupBy("grp").agg(F.min("w").alias("away"))
    partner = F.when(F.col("outside"), F.col("least")).otherwise(F.col("away"))
    deltas = deltas.join(away, "grp").withColumn("need", F.greatest(F.lit(1), F.ceil((F.col("w") + partner) / each)))
    # outside, but its leader is not: it hangs together with those inside
    both = first.unionByName(first.select(F.col("b").alias("a"), F.col("a").alias("b")))
    held = both.join(inside.select(F.col("rep").alias("b"), "middle"), "b").groupBy(F.col("a").alias("rep")).agg(
        F.min("middle").alias("held"))
    deltas = store(deltas.filter("need <= d").join(held, "rep", "left").withColumn("component", F.when(
        F.col("outside"), F.coalesce("held", "rep")).otherwise(F.col("middle"))).drop("held", "least", "middle"), "deltas")
    shared = _counts(deltas, "delta").filter("n > 1")
    entries = _delta_entries(deltas).join(shared, ["grp", "key"])
    order = Window.partitionBy("rep").orderBy("n", "key")
    alone = F.col("d") - F.count("*").over(Window.partitionBy("rep"))
    entries = (entries.withColumn("pos", alone + F.row_number().over(order) - 1)
               .filter("pos <= d - need").select("rep", "grp", "key", "d", "w", "pos", "outside", "component"))
    entries = store(entries, "differences")
    x = entries.filter("outside").select([F.col(c).alias(f"x_{c}") if c not in ("key", "grp") else F.col(c) for c in entries.columns])
    y = entries.select([F.col(c).alias(f"y_{c}") if c not in ("key", "grp") else F.col(c) for c in entries.columns])
    common = F.ceil((F.col("x_w") + F.col("y_w")) / each)
    pairs = (x.join(y, ["grp", "key"]).filter(
        (F.col("x_component") != F.col("y_component")) & (~F.col("y_outside") | (F.col("x_rep") < F.col("y_rep")))
        & (F.least(F.col("x_d") - F.col("x_pos"), F.col("y_d") - F.col("y_pos")) >= common))
        .select(F.col("x_rep").alias("a"), F.col("y_rep").alias("b")).distinct())
    return star.unionByName(_overlaps(pairs, members).filter(F.col("common") * 100 >= F.col("union") * percent)
                            .select("a", "b"))


def link_classes(classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(rep, component) of classes that link with another one, directly or not.
    ``classes``: rep, size, own, shingles, keys, pos, hist, one row per distinct set."""
    lists = _entries(classes).groupBy("key").agg(F.min("rep").alias("a"), F.max("rep").alias("last")).filter("a < last")
    entries = store(_entries(classes).join(lists.select("key", "a"), "key"), "index")
    linked = F.col("common") * 100 >= F.col("union") * percent

    # one highly similar class each, among the leaders of its lists
    ask = entries.filter("a != rep").select(F.col("rep").alias("b"), "a").distinct()
    lead = (_bounded(ask, classes, percent).groupBy("b").agg(F.min(F.struct("far", "a")).alias("best"))
            .select("b", F.col("best.a").alias("a")))
    known = store(_overlaps(lead, classes), "known")
    first = known.filter(linked).select("a", "b")

    # classes that hang together by similar leaders are a group; large ones are linked by their centre
    near = components(known.filter("2 * common >= union").select("a", "b")).select(
        F.col("node").alias("rep"), F.col("component").alias("grp"))
    near = store(near.join(near.groupBy("grp").agg(F.count("*").alias("n")).filter(F.col("n") >= GROUP).select("grp"), "grp"),
                 "groups")
    if not near.isEmpty():
        members = classes.select("rep", "size", "shingles").join(near, "rep")
        first = store(first.unionByName(link_group(members, first, percent)), "links")
    comp = store(components(first), "components")

    # what hangs together already needs no comparison
    whole = classes.select(F.col("rep").alias("a"), F.col("size").alias("leader_size"))
    led = known.join(whole, "a").select(F.col("b").alias("rep"), F.col("a").alias("leader"), "leader_size", "common",
                                        (1 - F.col("common") / F.col("union")).alias("far"))
    tags = store(comp.withColumnRenamed("node", "rep").join(near, "rep", "full"), "tags")
    tagged = entries.join(tags, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    grp = F.coalesce("grp", F.lit(-1))
    mixed = tagged.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min(grp).alias("g"),
                                      F.max(grp).alias("h")).filter("lo < hi and (g < h or g = -1)")
    rows = tagged.drop("a").join(mixed.select("key"), "key").join(led, "rep", "left").join(classes.select("rep", "own"), "rep")
    rows = store(rows, "rows")

    # blocks by size class: partners of a size lie in its own and the next smaller class
    ratio = float(np.log(100 / percent)) * (1 + 1e-6)
    block = F.floor(F.log(F.col("size")) / ratio).cast("int")
    rows = rows.withColumn("block", block)
    x = rows.select([F.col(c).alias(f"x_{c}") if c not in ("key", "block") else F.col(c) for c in rows.columns])
    x = x.withColumn("block", F.explode(F.array(F.col("block"), F.col("block") - 1, F.col("block") + 1)))
    y = rows.select([F.col(c).alias(f"y_{c}") if c not in ("key", "block") else F.col(c) for c in rows.columns])
    overlap = F.ceil((F.col("x_size") + F.col("y_size")) * percent / (100.0 + percent) - 1e-9)
    rest = F.least(F.col("x_size") - F.col("x_pos"), F.col("y_size") - F.col("y_pos"))
    same_leader = F.coalesce(F.col("x_leader") == F.col("y_leader"), F.lit(False))
    limit = 1 - percent / 100
    # shingles of nobody else are never shared: they bound the overlap, and with a
    # common leader only what neither lost of it, plus shared additions, can be
    free = F.least(F.col("x_size") - F.col("x_own"), F.col("y_size") - F.col("y_own"))
    gains = F.least(*[F.col(f"{k}_size") - F.col(f"{k}_common") - F.least(f"{k}_own", F.col(f"{k}_size") - F.col(f"{k}_common"))
                      for k in "xy"])
    through = F.when(same_leader, F.least("x_common", "y_common") + gains).otherwise(free)
    pairs = (x.join(y, ["key", "block"]).filter(
        (F.col("x_rep") < F.col("y_rep")) & (F.col("x_component") != F.col("y_component"))
        & ~F.coalesce(F.col("x_grp") == F.col("y_grp"), F.lit(False))
        & (F.least("x_size", "y_size") * 100 >= F.greatest("x_size", "y_size") * percent) & (rest >= overlap)
        & (free >= overlap) & (through >= overlap)
        & ~F.coalesce((F.col("x_leader") == F.col("y_rep")) | (F.col("y_leader") == F.col("x_rep")), F.lit(False))
        & ~(same_leader & (F.abs(F.col("x_far") - F.col("y_far")) > limit + 1e-9)))
        .select(F.col("x_rep").alias("a"), F.col("y_rep").alias("b"),
                (same_leader & (F.col("x_far") + F.col("y_far") < limit - 1e-9)).alias("settled")).distinct())
    pairs = store(pairs, "pairs")
    more = pairs.filter("settled").select("a", "b").unionByName(
        _overlaps(_bounded(pairs.filter("not settled"), classes, percent), classes).filter(linked).select("a", "b"))
    more = store(more, "links")
    if more.isEmpty():
        return comp.select(F.col("node").alias("rep"), "component")
    return components(first.unionByName(more)).select(F.col("node").alias("rep"), "component")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE,
                       percent: int = PERCENT) -> DataFrame:
    """Per row: id, n_shingles, component_id (the smallest id reachable by links), a
    number of its component (null: the row links with nobody) and the text's checksum.
    Classes have numbers of their own, so ids need not be unique."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(known_id(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    sets = store(shingle_sets(rows, n, percent), "sets")
    live = sets.filter("active")
    same = ["f1", "f2", "size"]
    reps = live.groupBy(*same).agg(F.min("id").alias("id")).withColumn("rep", F.monotonically_increasing_id())
    reps = store(reps, "reps")
    classes = store(live.join(reps, [*same, "id"]).select("rep", "size", "own", "shingles", "keys", "pos", "hist")
                    .dropDuplicates(["rep"]), "classes")
    comp = reps.join(link_classes(classes, percent), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    least = comp.groupBy("component").agg(F.min("id").alias("component_id"))
    names = comp.select(*same, "component").join(least, "component")
    out = live.select("id", "text_key", *same).join(names, same).select("id", "size", "component_id", "component", "text_key")
    out = out.unionByName(sets.filter("not active").select(
        "id", "size", F.col("id").alias("component_id"), F.lit(None).cast("long").alias("component"), "text_key"))
    return out.select(shown_id("id").alias(id_col), F.col("size").alias("n_shingles"),
                      shown_id("component_id").alias("component_id"), "component", "text_key")

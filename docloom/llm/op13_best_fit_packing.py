"""Best-fit packing with large-item matching: token sequences of fixed capacity.

A document becomes its token ids and an end id; only documents longer than the
capacity are cut.  Pieces above a third of the capacity can share a sequence at
most in twos: they are matched greedily, the longest first, each with the longest
partner that fits.  The smaller ones, longest first, then go to the sequence with
the smallest gap that holds them; a new one opens only where none does.

Pieces of equal length are interchangeable, so the matching and the best fit are
worked out on the number of pieces per length.  That histogram has at most one
entry per possible length, whatever the corpus, and is all that the driver sees.
Its result is a list of rules "pieces number i.. of length l go, k to a sequence,
to sequences s.. at offset o".  A piece's number among those of its length comes
from its place in its task and the counts of the tasks before, so a length that a
third of all pieces share is numbered by all tasks, without one sort or window
over its pieces; the rules are then looked up row by row.

Encoding: each distinct word between ASCII white space is encoded once per worker by
the tokenizers library, a thousand at a time with a separator between them.  Its
normaliser and splitter never join text across white space, nor across the place
where an ASCII letter meets a stop, so words are cut there too; the ids of a text are
those of its words in order.

Defined results: a null or empty text is the end id alone; a null id is kept;
every row is packed, rows that share an id too; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import buffers, chunks, is_space, lower_ascii, per_worker, split_words, store, word_array

CAPACITY = 2048
END_ID = 0
#: bytes of text encoded at a time
BATCH_BYTES = 1 << 22
#: distinct words a worker remembers
CACHE_WORDS = 400_000
#: words encoded in one call, and the word that stands between them
JOINED = 1000
#: longest word given to the model itself
PLAIN = 200
SEPARATOR = "\x01"
STOPS = np.isin(np.arange(256), np.frombuffer(b".,;:!?)", np.uint8))
LETTERS = np.isin(np.arange(256), np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8))


# ------------------------------------------------------------------ encoding
class WordEncoder:
    """Token ids of whole texts, each distinct word encoded once.

    ``ids`` holds the ids of all known words one after the other, word ``w`` at
    ``cut[w]:cut[w + 1]``; word 0 is the end of a text."""

    def __init__(self, path: str, end_id: int = END_ID):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.end_id = end_id
        self.between = self.tokenizer.encode(SEPARATOR, add_special_tokens=False).ids
        self.letters = self.plain_letters()
        self.known_letters = dict.fromkeys(self.letters)
        self.forget()

    def plain_letters(self) -> dict[int, str]:
        """Letters of the Latin blocks that the normaliser leaves alone and the splitter
        keeps together, with what the splitter makes of each.  A word of such letters
        can go to the model itself.  Empty if this tokenizer treats any of them otherwise."""
        t = self.tokenizer
        keep = [c for c in map(chr, range(0x250)) if c.isalpha() and c.lower() == c
                and (t.normalizer is None or t.normalizer.normalize_str(c) == c)]
        split = lambda w: [x for x, _ in t.pre_tokenizer.pre_tokenize_str(w)] if t.pre_tokenizer else [w]
        table = {ord(c): split(c) for c in keep}
        word = "".join(keep)
        if any(len(v) != 1 for v in table.values()) or (
                t.normalizer is not None and t.normalizer.normalize_str(word) != word):
            return {}
        table = {k: v[0] for k, v in table.items()}
        return table if split(word) == [word.translate(table)] else {}

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.array([self.end_id], np.uint32)
        self.cut = np.array([0, 1], np.int64)

    def plain(self, word: str) -> bool:
        return len(word) <= PLAIN and word.isalpha() and word.translate(self.known_letters) == ""

    def model_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        model, table = self.tokenizer.model, self.letters
        got = [[x.id for x in model.tokenize(w.translate(table))] for w in words]
        return (np.fromiter((i for ids in got for i in ids), np.uint32),
                np.fromiter(map(len, got), np.int64, len(got)))

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each)."""
        ids = np.array(self.tokenizer.encode_batch_fast(
            [f" {SEPARATOR} ".join(words) + f" {SEPARATOR}"], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(ids == self.between[0])
        if len(self.between) == 1 and len(ends) == len(words):
            return np.delete(ids, ends), np.diff(ends, prepend=-1) - 1
        got = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return np.array([i for w in got for i in w], np.uint32), np.fromiter(map(len, got), np.int64, len(got))

    def learn(self, words: list[str]) -> np.ndarray:
        """Number of each of the (distinct) words; new ones are encoded."""
        if len(self.known) > CACHE_WORDS:
            self.forget()
        new = [w for w in words if w not in self.known]
        if new:
            kinds: tuple[list, list, list] = ([], [], [])
            for w in new:
                kinds[0 if self.plain(w) else 2 if SEPARATOR in w else 1].append(w)
            plain, mixed, odd = kinds  # odd ones in calls without a separator
            new = plain + mixed + odd
            got = [self.model_words(plain)] if plain else []
            got += [self.encode_words(mixed[k:k + JOINED]) for k in range(0, len(mixed), JOINED)]
            got += [self.encode_words([w]) for w in odd]
            sizes = np.concatenate([n for _, n in got])
            self.known.update(zip(new, range(len(self.cut) - 1, len(self.cut) - 1 + len(new))))
            self.ids = np.concatenate([self.ids, *(i for i, _ in got)])
            self.cut = np.concatenate([self.cut, self.cut[-1] + np.cumsum(sizes)])
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, start of each text's ids + total)."""
        raw, offs = buffers(text)
        gap = is_space(raw)
        if b"<|" not in raw.tobytes():  # no special token, whose letters must stay as they are
            raw = lower_ascii(raw)
            start, end, first = split_words(raw, offs, gap)
            cut = np.zeros(len(raw), bool)
            cut[1:] = LETTERS[raw[:-1]] & STOPS[raw[1:]]
            cut[start] = False
            cut = np.flatnonzero(cut)
            start, end = np.sort(np.concatenate([start, cut])), np.sort(np.concatenate([end, cut]))
            first = np.searchsorted(start, offs)
        else:
            start, end, first = split_words(raw, offs, gap)
        coded = word_array(raw, gap, start, end).dictionary_encode()
        number = self.learn(coded.dictionary.to_pylist())
        words = number[coded.indices.to_numpy(zero_copy_only=False)]
        words = np.insert(words, first[1:], 0)  # the ends of the texts
        first = first + np.arange(len(first))
        table = pa.LargeListArray.from_arrays(pa.array(self.cut), pa.array(self.ids))
        found = table.take(pa.array(words))
        return found.values.to_numpy(), found.offsets.to_numpy()[first]


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
               id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids: id, piece, start, length, ids_crc32
    (ids, if ``keep_ids``), the task that cut it and its number among the
    task's pieces of that length."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        coder = per_worker(("op13", tokenizer, end_id), lambda: WordEncoder(tokenizer, end_id))
        task = TaskContext.get().partitionId()
        held = np.zeros(capacity + 1, np.int64)
        for batch, text in chunks(batches, "text", BATCH_BYTES):
            ids, at = coder.encode(text)
            n = np.diff(at)
            pieces = -(-n // capacity)
            doc = np.repeat(np.arange(len(n)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(n[doc] - start, capacity)
            begin = at[doc] + start
            data = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
            crc = [zlib.crc32(data[4 * b:4 * e]) for b, e in zip(begin.tolist(), (begin + length).tolist())]
            order = np.argsort(length, kind="stable")
            by = length[order]
            rank = np.empty(len(by), np.int64)
            rank[order] = np.arange(len(by)) - np.searchsorted(by, by)
            number = held[length] + rank
            held += np.bincount(length, minlength=capacity + 1)
            out = [batch.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                   pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                   pa.array(np.full(len(doc), task), pa.int32()), pa.array(number, pa.int64())]
            names = [id_col, "piece", "start", "length", "ids_crc32", "task", "number"]
            if keep_ids:
                out.append(pa.ListArray.from_arrays(pa.array(np.append(begin, at[-1]), pa.int32()),
                                                    pa.array(ids.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names)

    shape = f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, task int, number long"
    return docs.select(F.col(id_col), F.col(text_col).alias("text")).mapInArrow(
        run, shape + (", ids array<int>" if keep_ids else ""))


# ------------------------------------------------------------------- packing
def pack_lengths(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Rules (length, first number, pieces to a sequence, first sequence, offset)
    that place ``counts[length]`` pieces of every length; a rule ends where the
    next one of its length begins."""
    left = {n: c for n, c in counts.items() if c}
    placed = dict.fromkeys(left, 0)
    rules: list[tuple[int, int, int, int, int]] = []
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # gap -> (first sequence, sequences)
    n_bins = 0

    def place(length: int, each: int, n: int, bins: int, offset: int) -> None:
        rules.append((length, placed[length], each, bins, offset))
        placed[length] += n
        left[length] -= n

    # above a third: one or two to a sequence
    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for n in large:
        while left[n]:
            mate = next((m for m in large if m <= min(n, capacity - n) and left[m] >= (2 if m == n else 1)), None)
            if mate is None:
                bins, gap = left[n], capacity - n
                place(n, 1, bins, n_bins, 0)
            elif mate == n:
                bins, gap = left[n] // 2, capacity - 2 * n
                place(n, 2, 2 * bins, n_bins, 0)
            else:
                bins, gap = min(left[n], left[mate]), capacity - n - mate
                place(n, 1, bins, n_bins, 0)
                place(mate, 1, bins, n_bins, n)
            gaps[gap].append((n_bins, bins))
            n_bins += bins

    # the others: the smallest gap that holds them, else a new sequence
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        gap = n
        while left[n]:
            while gap < capacity and not gaps[gap]:
                gap += 1
            if gap == capacity and not gaps[gap]:
                new = -(-left[n] // (capacity // n))
                gaps[capacity].append((n_bins, new))
                n_bins += new
            first, bins = gaps[gap].pop()
            each = gap // n
            full = min(bins, left[n] // each)
            if full:
                place(n, each, full * each, first, capacity - gap)
                gaps[gap - each * n].append((first, full))
                first, bins = first + full, bins - full
            if bins and left[n]:  # the last ones fill a part of one more sequence
                some = left[n]
                place(n, some, some, first, capacity - gap)
                gaps[gap - some * n].append((first, 1))
                first, bins = first + 1, bins - 1
            if bins:
                gaps[gap].append((first, bins))
    return sorted(rules)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id",
         text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their sequence and offset in it."""
    pieces = store(cut_pieces(docs, tokenizer, capacity, end_id, id_col, text_col, keep_ids), "pieces")
    counts = store(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "piece_counts")
    # at most one row per length from 1 to the capacity
    per_length = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rules = np.array(pack_lengths(per_length, capacity), np.int64).reshape(-1, 5)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    names = [id_col, "piece", "start", "length", "ids_crc32"] + (["ids"] if keep_ids else [])
    numbered = pieces.join(offsets, ["task", "length"]).select(
        *names, (F.col("before") + F.col("number")).alias("_number"))
    step = np.int64(1) << np.int64(48)
    keys = rules[:, 0] * step + rules[:, 1]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch.column(names.index("length")).to_numpy()
            number = batch.column(len(names)).to_numpy()
            rule = rules[np.searchsorted(keys, length * step + number, "right") - 1]
            k = number - rule[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(rule[:, 3] + k // rule[:, 2]),
                 pa.array(rule[:, 4] + k % rule[:, 2] * length)], [*names, "sequence_id", "offset"])

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema.fields[:-1])
    return numbered.mapInArrow(run, shape + ", sequence_id long, offset long")

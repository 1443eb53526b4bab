"""Conversation structure repair: bidirectional Dijkstra over the edit lattice.

A node of the lattice is (rows consumed, state); the state says what the repaired
conversation ends with: nothing, system, user or assistant.  Edges are the edits:
Keep 0, Rerole 3 and Delete 4 consume a row (an undeleted truncated row costs 3
more, blank and duplicate rows can only be deleted), Insert 3 consumes none.  The
cheapest path from the start to an end whose role initials read ``(s?(ua)+)?`` is the
repair; its edits' initials are the audit, and of equally cheap paths the one
with the ASCII-least audit counts.

Two heaps search from both ends.  They take nodes by (cost, rows): the only free
edge, Keep, consumes a row, so a node's least audit is known when it is taken.
Whenever an edge joins a node taken from the front with one taken from the back it
is a crossing; the search goes on until no path as cheap as the best is left, so
all crossings of that cost are seen, and the least concatenated audit wins.

A conversation of up to ``LONG_ROWS`` rows is repaired in one piece.  Of a longer
one, equal rows are first merged into one with a count, rows are numbered by a
distributed prefix sum and cut into blocks; each block gives the cheapest edits
from each state to each state.  Blocks are edges of the next lattice, searched the
same way a fixed number of blocks at a time until one is left; the choice is then
handed down.  So no task holds a long conversation.  Only its repaired text is
hashed in one pass (SHA-256 has no parts), as a stream in bounded memory.

Defined results: a null role or text is one space, as in the key of the damage;
rows of one turn are taken by role and then by the SHA-256 of their text; a null
turn comes first and is ignored by ``gaps``; a role without a first character has no
place in a repair; null conversation ids are one conversation; empty tables give
no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import store
from docloom.operators.positions import number_rows

KEEP, REROLE, DELETE, INSERT, MEND = 0, 3, 4, 3, 3
SPACES = " \t\n\x0b\x0c\r"
#: rows (and bytes of text) of a conversation repaired in one piece
LONG_ROWS, LONG_BYTES = 1000, 1 << 24
#: rows of a block, and blocks joined at a time
BLOCK_ROWS, FAN = 500, 500
START, SYSTEM, USER, ASSISTANT = range(4)
#: repairs a task remembers
CACHE = 1 << 16
NAMES = ("user", "assistant")

FINE, TRUNCATED, BLANK, DUPLICATE = range(4)


def after(state: int, initial: str) -> int | None:
    """The state after a row of this role, None where it may not come."""
    if initial == "u":
        return USER if state != USER else None
    if initial == "a":
        return ASSISTANT if state == USER else None
    return SYSTEM if initial == "s" and state == START else None


# ------------------------------------------------------------------- lattice
class Lattice:
    """Edges between nodes (position, state) for the search below."""

    def __init__(self, n: int, forward: list[dict[int, list[tuple[int, int, int, str]]]]):
        #: forward[i][state] = edges (position, state, cost, letter) leaving the node
        self.n, self.forward = n, forward
        self.backward: list[dict[int, list[tuple[int, int, int, str]]]] = [{} for _ in range(n + 1)]
        for i, states in enumerate(forward):
            for q, edges in states.items():
                for j, r, cost, letter in edges:
                    self.backward[j].setdefault(r, []).append((i, q, cost, letter))


def edit_lattice(rows: list[tuple[str, int, int]], open_end: bool = False) -> Lattice:
    """Lattice of rows (role initial, fault, further equal rows).  The further ones
    can only be deleted; their Ds stand as one letter.  ``open_end``: more rows
    follow, whose lattice holds the inserts of the last position."""
    n = len(rows)
    forward: list[dict] = []
    for i in range(n + 1):
        states: dict = {}
        for q in range(4):
            new = ASSISTANT if q == USER else USER
            edges = [(i, new, INSERT, "I")] if i < n or not open_end else []
            if i < n:
                initial, fault, more = rows[i]
                mark, rest = ("d", DELETE * more) if more else ("", 0)
                edges.append((i + 1, q, DELETE + rest, "D" + mark))
                if fault < BLANK:
                    mend = MEND if fault == TRUNCATED else 0
                    to = after(q, initial)
                    if to is not None:
                        edges.append((i + 1, to, KEEP + mend + rest, "K" + mark))
                    edges.append((i + 1, new, REROLE + mend + rest, "R" + mark))
            states[q] = edges
        forward.append(states)
    return Lattice(n, forward)


def cheapest(lat: Lattice, start: int, goals: tuple[int, ...]) -> tuple[int, str] | None:
    """(cost, least audit) from (0, start) to a goal state at the end."""
    ends = {(lat.n, g) for g in goals}
    sides = ({(0, start): (0, "")}, {e: (0, "") for e in ends})
    taken: tuple[dict, dict] = ({}, {})
    heaps: tuple[list, list] = ([(0, 0, start)], [(0, -i, q) for i, q in sorted(ends)])
    best: tuple[int, str] | None = None
    while heaps[0] and heaps[1] and (best is None or heaps[0][0][0] + heaps[1][0][0] <= best[0]):
        back = heaps[1][0][0] < heaps[0][0][0]
        cost, i, q = heappop(heaps[back])
        node = (abs(i), q)
        if node in taken[back]:
            continue
        audit = sides[back][node][1]
        taken[back][node] = (cost, audit)
        if not back and node in ends:
            best = min(best or (cost, audit), (cost, audit))
        other = taken[1 - back]
        for j, r, step, letter in (lat.backward if back else lat.forward)[node[0]].get(q, ()):
            to, total = (j, r), cost + step
            word = letter + audit if back else audit + letter
            if to in other:  # a crossing
                far, rest = other[to]
                found = (total + far, rest + word if back else word + rest)
                best = found if best is None else min(best, found)
            if to in taken[back]:
                continue
            known = sides[back].get(to)
            if known is None or (total, word) < known:
                if known is None or total < known[0]:
                    heappush(heaps[back], (total, -j if back else j, r))
                sides[back][to] = (total, word)
    return best


# -------------------------------------------------------------------- report
class Report:
    """What a conversation's rows, fed in order with their edits, add up to."""

    def __init__(self):
        self.rows = self.turns = 0
        self.low = self.high = self.last_turn = self.initial = None
        self.faults = [0, 0, 0, 0]
        self.illegal = 0
        self.hash, self.lines, self.audit = hashlib.sha256(), 0, []
        self.state = START

    def row(self, turn, role: str, fault: int, more: int) -> None:
        """``more`` further rows are equal, so duplicates (blanks, if this one is blank)."""
        if turn is not None:
            if turn != self.last_turn or not self.turns:
                self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = self.last_turn = turn
        self.faults[fault] += 1
        self.faults[BLANK if fault == BLANK else DUPLICATE] += more
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        if initial + initial not in ("su", "ua", "au"):
            self.illegal += more
        self.initial = initial
        self.rows += 1 + more

    def line(self, role: str, text: str) -> None:
        if self.lines:
            self.hash.update(b"\n")
        self.hash.update(f"{role}:{text}".encode())
        self.lines += 1

    def edit(self, letters: str, role: str, text: str, more: int) -> None:
        """The edits at a row, ``letters``: inserts around one K, R or D, and d for the
        Ds of the further equal rows."""
        for x in letters:
            if x == "K":
                self.line(role, text)
                self.state = after(self.state, role[:1])
            elif x in "RI":
                self.state = ASSISTANT if self.state == USER else USER
                self.line(NAMES[self.state == ASSISTANT], text if x == "R" else "")
            self.audit.append("D" * more if x == "d" else x)

    def result(self, cost: int) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[TRUNCATED], self.illegal, cost,
                "".join(self.audit), self.hash.hexdigest())


RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
RESULT_DDL = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, " \
             "repaired_sha256 string"


def per_row(audit: str, n: int) -> list[str]:
    """The letters of each of n rows: up to its K, R or D (and d); the last row
    takes what follows."""
    out, at = [], 0
    for k in range(n):
        end = at
        while audit[end] == "I":
            end += 1
        end += 1
        if audit[end:end + 1] == "d":
            end += 1
        if k == n - 1:
            end = len(audit)
        out.append(audit[at:end])
        at = end
    return out


def fault_of(text: str, seen: bool) -> int:
    kept = text.rstrip(SPACES)
    if not kept:
        return BLANK
    return DUPLICATE if seen else FINE if kept[-1] in ".!?" else TRUNCATED


def repair(rows: list[tuple], memory: dict) -> tuple:
    """Result of one conversation's rows (turn, role, text) in order."""
    seen: set = set()
    faults = []
    for _, role, text in rows:
        faults.append(fault_of(text, (role, text) in seen))
        seen.add((role, text))
    key = tuple((role[:1], f) for (_, role, _), f in zip(rows, faults))
    if key not in memory:
        if len(memory) > CACHE:
            memory.clear()
        cost, audit = cheapest(edit_lattice([(r, f, 0) for r, f in key]), START, (START, ASSISTANT))
        memory[key] = cost, audit, per_row(audit, len(key))
    cost, audit, letters = memory[key]
    report = Report()
    for (turn, role, text), fault, word in zip(rows, faults, letters):
        report.row(turn, role, fault, 0)
        report.edit(word, role, text, 0)
    return report.result(cost)


# --------------------------------------------------------------------- Spark
def damage(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """Rows (conv, turn, role, text, gone) with planted faults, chosen by
    crc32(``conv:turn``) mod 20: 0 is dropped (kept here with ``gone``, so that its
    conversation is not lost), 1 loses its text, 2 its ``.!?``, 3 comes twice, 4 gets
    the role user."""
    blank = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in (conv, turn)])
    kind = F.crc32(key.cast("binary")) % 20
    words = F.coalesce(F.col(text), blank)
    return conversations.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(F.coalesce(F.col(role), blank)).alias("role"),
        F.when(kind.isin(0, 1), F.lit("")).when(kind == 2, F.translate(words, ".!?", "")).otherwise(words).alias("text"),
        (kind == 0).alias("gone"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("_copy")).drop("_copy")


def as_rows(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """The rows of ``damage`` without any damage."""
    return conversations.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"),
                                *[F.coalesce(F.col(c), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))],
                                F.lit(False).alias("gone"))


def _order() -> list:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.sha2("text", 256)]


def _groups(batches, width: int):
    """(conversation, its rows) of batches sorted by conversation; the last ``width``
    columns make the rows."""
    conv, rows, begun = None, [], False
    for batch in batches:
        cols = [c.to_pylist() for c in batch.columns]
        for c, *row in zip(cols[0], *cols[-width:]):
            if begun and c != conv:
                yield conv, rows
                rows = []
            conv, begun = c, True
            rows.append(tuple(row))
    if begun:
        yield conv, rows


def _emit(results, conv_type: pa.DataType, size: int = 2000):
    held: list = []

    def batch():
        cols = list(zip(*held))
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], conv_type), *(pa.array(c, pa.int64()) for c in cols[1:7]),
             *(pa.array(c, pa.string()) for c in cols[7:])], ["conv", *RESULT])

    for conv, result in results:
        held.append((conv, *result))
        if len(held) == size:
            yield batch()
            held.clear()
    if held:
        yield batch()


def _short(rows: DataFrame) -> DataFrame:
    kind = rows.schema["conv"].dataType.simpleString()

    def run(batches):
        from itertools import chain
        batches = iter(batches)
        head = next(batches, None)
        if head is None:
            return
        memory: dict = {}

        def results():
            for conv, got in _groups(chain([head], batches), 4):
                yield conv, repair([r[:3] for r in got if not r[3]], memory)

        yield from _emit(results(), head.schema.field(0).type)

    ordered = rows.repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), *_order())
    return ordered.select("conv", "turn", "role", "text", "gone").mapInArrow(run, f"conv {kind}, {RESULT_DDL}")


def repair_conversations(rows: DataFrame, conv: str = "conv_id", long_rows: int = LONG_ROWS,
                         long_bytes: int = LONG_BYTES, block_rows: int = BLOCK_ROWS, fan: int = FAN) -> DataFrame:
    """Faults, cost, audit and hash of the repaired text of every conversation of
    ``rows`` (conv, turn, role, text, gone), as ``damage`` or ``as_rows`` give them."""
    size = rows.groupBy("conv").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b"))
    long = store(size.filter((F.col("n") > long_rows) | (F.col("b") > long_bytes)).select(F.col("conv").alias("_c")),
                 "long_conversations")
    if long.isEmpty():
        out = _short(rows)
    else:
        same = F.col("conv").eqNullSafe(F.col("_c"))
        out = _short(rows.join(long, same, "left_anti")).unionByName(
            _long(rows.join(long, same, "left_semi"), block_rows, fan))
    return out.withColumnRenamed("conv", conv)


# ------------------------------------------------------- long conversations
def _long(rows: DataFrame, block_rows: int, fan: int) -> DataFrame:
    kind = rows.schema["conv"].dataType.simpleString()
    # equal rows once, with a count, before anything is moved by conversation
    merged = (rows.withColumn("sha", F.sha2("text", 256)).groupBy("conv", "turn", "role", "sha", "gone")
              .agg((F.count("*") - 1).alias("more"), F.any_value("text").alias("text")))
    merged = store(merged, "long_rows")
    there = merged.filter(~F.col("gone"))
    place = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    first = there.groupBy(F.col("conv").alias("_c"), F.col("role").alias("_r"), F.col("sha").alias("_s")).agg(
        F.min(place).alias("first"))
    same = F.col("conv").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("sha") == F.col("_s"))
    tail = F.rtrim("text", F.lit(SPACES))
    items = there.join(first, same).select(
        "conv", "turn", "role", "sha", "more",
        F.when(tail == "", BLANK).when(~place.eqNullSafe(F.col("first")), DUPLICATE)
         .when(F.right(tail, F.lit(1)).isin(".", "!", "?"), FINE).otherwise(TRUNCATED).alias("fault"))
    items = store(number_rows(items, ["conv"], [F.col("turn").asc_nulls_first(), F.col("role"), F.col("sha")], "item")
                  .withColumn("block", F.expr(f"item div {block_rows}")), "long_items")
    ends = items.groupBy("conv").agg(F.max("block").alias("last"))
    items_in = items.join(ends.withColumnRenamed("conv", "_e"), F.col("conv").eqNullSafe(F.col("_e"))).select(
        "conv", "block", (F.col("block") == F.col("last")).alias("end"), "item",
        F.substring("role", 1, 1).alias("initial"), "fault", "more")

    def solve(table: pa.Table) -> pa.Table:
        d = table.sort_by("item").to_pydict()
        lat = edit_lattice(list(zip(d["initial"], d["fault"], d["more"])), not d["end"][0])
        return _edges(table, d["conv"][0], d["block"][0],
                      lambda q, r: cheapest(lat, q, (r,)), lambda word: word)

    shape = f"conv {kind}, block long, q int, r int, cost long, rank int, word string"
    level = store(items_in.groupBy("conv", "block").applyInArrow(solve, shape), "long_blocks")
    levels = [level]
    n_blocks = (items.agg(F.max("block")).head()[0] or 0) + 1

    def join_blocks(table: pa.Table) -> pa.Table:
        d = table.sort_by("block").to_pydict()
        at = {b: i for i, b in enumerate(sorted(set(d["block"])))}
        forward: list[dict] = [{} for _ in range(len(at) + 1)]
        for b, q, r, cost, rank in zip(d["block"], d["q"], d["r"], d["cost"], d["rank"]):
            # ranks order the audits that leave a state, so their letters order the paths
            forward[at[b]].setdefault(q, []).append((at[b] + 1, r, cost, chr(rank * 4 + r)))
        lat = Lattice(len(at), forward)
        return _edges(table, d["conv"][0], d["block"][0] // fan, lambda q, r: cheapest(lat, q, (r,)),
                      lambda word: "".join(str(ord(x) % 4) for x in word))

    while n_blocks > 1:
        level = store(level.withColumn("group", F.expr(f"block div {fan}")).groupBy("conv", "group")
                      .applyInArrow(join_blocks, shape), "long_level")
        levels.append(level)
        n_blocks = -(-n_blocks // fan)

    goal = levels[-1].filter((F.col("q") == START) & F.col("r").isin(START, ASSISTANT))
    chosen = goal.groupBy("conv").agg(F.min(F.struct("cost", "rank", "block", "q", "r", "word")).alias("x"))
    total = chosen.select("conv", F.col("x.cost").alias("cost"))
    chosen = chosen.select("conv", "x.block", "x.q", "x.r", "x.word")
    for lower in reversed(levels[:-1]):
        # word: the states after each block of the group, in order
        steps = chosen.select("conv", (F.col("block") * fan).alias("at"), "q", F.posexplode(F.split("word", "")).alias("i", "s"),
                              "word").filter("s <> ''")
        steps = steps.select(
            F.col("conv").alias("_c"), (F.col("at") + F.col("i")).alias("_b"), F.col("s").cast("int").alias("_r"),
            F.when(F.col("i") == 0, F.col("q")).otherwise(F.substring("word", F.col("i"), F.lit(1)).cast("int")).alias("_q"))
        chosen = lower.join(steps, F.col("conv").eqNullSafe(F.col("_c")) & (F.col("block") == F.col("_b"))
                            & (F.col("q") == F.col("_q")) & (F.col("r") == F.col("_r"))).select(
            "conv", "block", "q", "r", "word")

    def letters(batches):
        for batch in batches:
            d = batch.to_pydict()
            out: list = []
            for c, b, word in zip(d["conv"], d["block"], d["word"]):
                n = sum(x in "KRD" for x in word)
                out += [(c, b * block_rows + i, w) for i, w in enumerate(per_row(word, n))]
            cols = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], batch.schema.field(0).type), pa.array(cols[1], pa.int64()),
                                              pa.array(cols[2], pa.string())], ["_c", "_i", "letters"])

    edits = chosen.select("conv", "block", "word").mapInArrow(letters, f"_c {kind}, _i long, letters string")
    texts = there.select(F.col("conv").alias("_t"), F.col("turn").alias("_u"), F.col("role").alias("_r"),
                         F.col("sha").alias("_s"), "text")
    full = items.join(edits, F.col("conv").eqNullSafe(F.col("_c")) & (F.col("item") == F.col("_i"))).join(
        texts, F.col("conv").eqNullSafe(F.col("_t")) & F.col("turn").eqNullSafe(F.col("_u"))
        & (F.col("role") == F.col("_r")) & (F.col("sha") == F.col("_s")))
    full = full.join(total.withColumnRenamed("conv", "_v"), F.col("conv").eqNullSafe(F.col("_v"))).select(
        "conv", "item", "cost", "turn", "role", "text", "fault", "more", "letters")
    # conversations that lost all their rows
    none = merged.select("conv").distinct().join(ends.select(F.col("conv").alias("_e")),
                                                 F.col("conv").eqNullSafe(F.col("_e")), "left_anti")
    empty = none.select("conv", *[F.lit(0).cast("long").alias(c) for c in RESULT[:6]], F.lit("").alias("audit"),
                        F.sha2(F.lit(""), 256).alias("repaired_sha256"))

    def stream(batches):
        def results():
            report, conv, cost, begun = Report(), None, 0, False
            for batch in batches:
                for c, _, price, turn, role, text, fault, more, word in zip(*(x.to_pylist() for x in batch.columns)):
                    if begun and c != conv:
                        yield conv, report.result(cost)
                        report = Report()
                    conv, cost, begun = c, price, True
                    report.row(turn, role, fault, more)
                    report.edit(word, role, text, more)
            if begun:
                yield conv, report.result(cost)

        from itertools import chain
        batches = iter(batches)
        head = next(batches, None)
        if head is not None:
            batches = chain([head], batches)
            yield from _emit(results(), head.schema.field(0).type, 1)

    ordered = full.repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "item")
    return ordered.mapInArrow(stream, f"conv {kind}, {RESULT_DDL}").unionByName(empty)


def _edges(table: pa.Table, conv, block: int, solve, words) -> pa.Table:
    """Rows (conv, block, q, r, cost, rank, word) of every pair of states that a path
    joins; ranks order the words that leave the same state."""
    found = [(q, r, *got) for q in range(4) for r in range(4) if (got := solve(q, r))]
    order = {q: sorted({w for p, _, _, w in found if p == q}) for q in range(4)}
    rows = [(conv, block, q, r, cost, order[q].index(w), words(w)) for q, r, cost, w in found]
    cols = list(zip(*rows))
    return pa.Table.from_arrays(
        [pa.array(cols[0], table.schema.field("conv").type), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()),
         pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.int32()),
         pa.array(cols[6], pa.string())], ["conv", "block", "q", "r", "cost", "rank", "word"])

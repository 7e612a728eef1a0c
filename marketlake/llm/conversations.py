"""Repair of conversation structure: cheapest edits, found by bidirectional Dijkstra over the edit lattice.

A row's first fault counts: blank (no character but blanks, tabs and line ends),
duplicate (role and text stood earlier in its conversation) or truncated (the
last such character is none of ``.!?``). Edits are Keep (0), Rerole to user or
assistant (3), Delete (4; blanks and duplicates must go) and Insert of an empty
user or assistant row (3, anywhere); a truncated row that stays adds 3. The role
initials of the result must read ``(s?(ua)+)?``. Of the cheapest edits those are
taken whose initials, in order, are least.

Lattice. A node is a number of rows passed and the state of that pattern. One
heap grows from the start, one from the end; each settled node has its distance
and the least audit of that distance (a prefix or a suffix). They stop when their
tops together exceed the best crossing, so every crossing of equal cost is known;
the least concatenation of prefix, edge and suffix is the audit. An audit fixes
its path, so equal costs never leave a tie.

Long conversations. Rows are sorted by conversation and turn into ranges, so a
conversation may lie in several partitions. Those that lie inside one and have at
most ``BLOCK`` rows are repaired there. The others are cut into blocks: each gives
its cheapest costs between states, these are composed from the end, so each block
knows what follows it, each solves the lattice for every state it may be entered
in, and the blocks are walked in order, one at a time in memory. Only the hash of
the repaired text, which has to be taken in order, is one task's stream.

Rows are taken by turn (nulls first), then role, then text. Null roles and texts
are one blank; roles keep their spelling and unknown ones can only be reroled or
deleted. A null conversation is one of its own. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from .common import col, materialise, small_batches

#: Rows that one lattice holds.
BLOCK = 512
#: Bytes of text that a conversation may have to be repaired where its rows were sorted.
BLOCK_BYTES = 8 << 20
SPACE = " \t\n\x0b\x0c\r"
INF = float("inf")
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
#: States of the pattern: nothing yet, after s, after u, after a; a conversation may end in the first or last.
ENDS = (0, INF, INF, 0)

SUMMARY = T.StructType([
    *[T.StructField(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
    T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
MESSAGE = T.StructType([T.StructField(c, T.StringType()) for c in ("edit", "role", "text")])
_MESSAGES = pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))
_SUMMARY = pa.struct([*[(c, pa.int64()) for c in SUMMARY.names[:6]], ("audit", pa.string()), ("repaired_sha256", pa.string())])


def code(role: str, text: str, duplicate: bool) -> str:
    """What the lattice sees of a row: b(lank), d(uplicate), or its role initial (s, u, a, o for others), upper-case if truncated."""
    body = text.rstrip(SPACE)
    if not body:
        return "b"
    if duplicate:
        return "d"
    kind = role[0] if role[:1] in ("s", "u", "a") else "o"
    return kind if body[-1] in ".!?" else kind.upper()


def _expected(q: int) -> tuple[str, int]:
    return ("a", 3) if q == 2 else ("u", 2)


def steps(c: str, q: int) -> list[tuple[str, int, int]]:
    """Edits (initial, cost, next state) of a row with code ``c`` in state ``q``."""
    out = [("D", DELETE, q)]
    if c not in "bd":
        extra = CUT if c.isupper() else 0
        role, to = _expected(q)
        if c.lower() == role:
            out.append(("K", extra, to))
        elif c.lower() == "s" and q == 0:
            out.append(("K", extra, 1))
        out.append(("R", REROLE + extra, to))
    return out


class _Lattice:
    """Nodes (rows passed, state) of the codes, and a sink behind the last row, reached at the cost of the state left.

    Rows may be inserted behind the last one only in a last block: elsewhere the next block does it.
    """

    def __init__(self, codes: str, exits: tuple, last: bool):
        self.codes, self.n, self.exits, self.last = codes, len(codes), exits, last
        self.sink = (self.n + 1, 0)

    def out(self, node):
        i, q = node
        if node == self.sink:
            return
        if i < self.n or self.last:
            yield "I", INSERT, (i, _expected(q)[1])
        if i < self.n:
            for letter, cost, to in steps(self.codes[i], q):
                yield letter, cost, (i + 1, to)
        elif self.exits[q] < INF:
            yield "", self.exits[q], self.sink

    def into(self, node):
        i, q = node
        if node == self.sink:
            for p in range(4):
                if self.exits[p] < INF:
                    yield "", self.exits[p], (self.n, p)
            return
        if i < self.n or self.last:
            for p in range(4):
                if _expected(p)[1] == q:
                    yield "I", INSERT, (i, p)
        if i > 0:
            for p in range(4):
                for letter, cost, to in steps(self.codes[i - 1], p):
                    if to == q:
                        yield letter, cost, (i - 1, p)


class _Side:
    """One direction of the search: distances, settled nodes and their least audits."""

    def __init__(self, start: tuple[int, int], next_, back, sign: int):
        self.start, self.next, self.back, self.sign = start, next_, back, sign
        self.reached = {start: 0}
        self.audit: dict = {}
        self.heap: list = [(0, sign * start[0], start)]

    def top(self) -> float:
        while self.heap and (self.heap[0][2] in self.audit or self.heap[0][0] > self.reached[self.heap[0][2]]):
            heappop(self.heap)
        return self.heap[0][0] if self.heap else INF

    def settle(self):
        """The nearest open node (of equals the one with the fewest rows behind it), with its least audit.

        Edges without cost pass a row, so whatever reaches the node at its distance is settled before it.
        """
        cost, _, node = heappop(self.heap)
        audits = [""] if node == self.start else []
        for letter, c, other in self.back(node):
            if other in self.audit and self.reached[other] + c == cost:
                audits.append(self.audit[other] + letter if self.sign > 0 else letter + self.audit[other])
        self.audit[node] = min(audits)
        for _, c, other in self.next(node):
            if cost + c < self.reached.get(other, INF):
                self.reached[other] = cost + c
                heappush(self.heap, (cost + c, self.sign * other[0], other))
        return node


def solve(codes: str, entry: int, exits: tuple, last: bool) -> tuple[float, str, int]:
    """Least cost from state ``entry`` through all rows plus ``exits`` of the state reached; its least audit; that state."""
    lattice = _Lattice(codes, exits, last)
    there = _Side((0, entry), lattice.out, lattice.into, 1)
    back = _Side(lattice.sink, lattice.into, lattice.out, -1)
    best = INF
    while True:
        a, b = there.top(), back.top()
        if a == INF and b == INF or (a + b > best if INF not in (a, b) else min(a, b) > best):
            break
        if a <= b:
            v = there.settle()
            near = [(there.reached[v] + c + back.reached[w]) for _, c, w in lattice.out(v) if w in back.audit]
        else:
            v = back.settle()
            near = [(there.reached[w] + c + back.reached[v]) for _, c, w in lattice.into(v) if w in there.audit]
        if v in there.audit and v in back.audit:
            near.append(there.reached[v] + back.reached[v])
        best = min([best, *near])
    if best == INF:
        return INF, "", entry
    audits = [there.audit[v] + back.audit[v] for v in there.audit if v in back.audit and there.reached[v] + back.reached[v] == best]
    for v in there.audit:
        for letter, c, w in lattice.out(v):
            if w in back.audit and there.reached[v] + c + back.reached[w] == best:
                audits.append(there.audit[v] + letter + back.audit[w])
    audit = min(audits)
    return best, audit, walk(codes, entry, audit)[-1]


class Solver:
    """``solve`` with a memory: short conversations have few shapes."""

    def __init__(self, size: int = 1 << 14):
        self.known, self.size = {}, size

    def __call__(self, *key) -> tuple[float, str, int]:
        if key not in self.known:
            if len(self.known) >= self.size:
                self.known.clear()
            self.known[key] = solve(*key)
        return self.known[key]


def walk(codes: str, entry: int, audit: str) -> list[int]:
    """States after each edit of an audit (the entry state first)."""
    i, states = 0, [entry]
    for letter in audit:
        q = states[-1]
        if letter == "I":
            states.append(_expected(q)[1])
        else:
            states.append(next(to for x, _, to in steps(codes[i], q) if x == letter))
            i += 1
    return states


def distances(codes: str, entry: int, last: bool) -> list[float]:
    """Least cost from ``entry`` to each state behind the last row (one heap, to the end)."""
    lattice = _Lattice(codes, (INF,) * 4, last)
    reached, heap = {(0, entry): 0}, [(0, (0, entry))]
    while heap:
        cost, node = heappop(heap)
        if cost > reached[node]:
            continue
        for _, c, other in lattice.out(node):
            if cost + c < reached.get(other, INF):
                reached[other] = cost + c
                heappush(heap, (cost + c, other))
    return [reached.get((lattice.n, q), INF) for q in range(4)]


def edited(rows: list[tuple[str, str]], codes: str, entry: int, audit: str) -> list[tuple[str, str, str]]:
    """(edit, role, text) of the rows that an audit leaves."""
    out, i, states = [], 0, walk(codes, entry, audit)
    for letter, to in zip(audit, states[1:]):
        role = "assistant" if to == 3 else "user"
        if letter == "I":
            out.append(("I", role, ""))
            continue
        if letter == "K":
            out.append(("K", *rows[i]))
        elif letter == "R":
            out.append(("R", role, rows[i][1]))
        i += 1
    return out


class Tally:
    """Counts over a conversation's rows in order, and over its blocks in order."""

    def __init__(self):
        self.turns, self.low, self.high, self.first, self.turn = 0, None, None, None, None
        self.faults = {"b": 0, "d": 0, "t": 0}
        self.illegal, self.head, self.tail = 0, None, None

    def row(self, turn: int | None, role: str, c: str) -> None:
        if turn is not None:
            self.turns += turn != self.turn
            self.low = turn if self.low is None else self.low
            self.high = self.turn = turn
        kind = c if c in "bd" else "t" if c.isupper() else None
        if kind:
            self.faults[kind] += 1
        self.pair(role[:1], role[:1])

    def pair(self, head: str, tail: str) -> None:
        if self.tail is not None:
            self.illegal += self.tail + head not in ("su", "ua", "au")
        else:
            self.head = head
        self.tail = tail

    def numbers(self) -> tuple:
        return (self.turns, self.low, self.high, *self.faults.values(), self.illegal, self.head, self.tail)

    def add(self, turns, low, high, b, d, t, illegal, head, tail) -> None:
        """The next block's ``numbers``."""
        if low is not None:
            self.turns += turns - (low == self.turn)
            self.low = low if self.low is None else self.low
            self.high = self.turn = high
        for k, v in zip("bdt", (b, d, t)):
            self.faults[k] += v
        self.illegal += illegal
        if head is not None:
            self.pair(head, tail)

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


class _Hash:
    """SHA-256 of newline-joined ``role:text`` lines."""

    def __init__(self):
        self.h, self.any = hashlib.sha256(), False

    def add(self, messages) -> None:
        for _, role, text in messages:
            self.h.update(("\n" if self.any else "").encode() + f"{role}:{text}".encode())
            self.any = True


def _summary(tally: Tally, cost: int, audit: str, h: _Hash) -> dict:
    f = tally.faults
    return {"gaps": tally.gaps(), "blank": f["b"], "duplicate": f["d"], "truncated": f["t"], "illegal": tally.illegal,
            "cost": int(cost), "audit": audit, "repaired_sha256": h.h.hexdigest()}


def _messages(rows) -> list[dict]:
    return [{"edit": e, "role": r, "text": t} for e, r, t in rows]


def _sorted_rows(kind: pa.DataType, keep_messages: bool, block: int):
    """Sorted rows (conv, turn, role, text, present) -> whole conversations repaired, others row by row.

    The first and last conversation of a partition may go on in its neighbours; these and long ones pass
    through with their place (partition, number).
    """
    schema = pa.schema([("conv", kind), ("pid", pa.int32()), ("seq", pa.int64()), ("turn", pa.int64()), ("role", pa.string()),
                        ("text", pa.string()), ("present", pa.bool_()), ("messages", _MESSAGES), ("done", _SUMMARY)])

    solver = Solver()

    def repaired(conv, rows) -> tuple:
        tally, h, seen, codes = Tally(), _Hash(), set(), ""
        kept = [r for r in rows if r[4]]
        for _, turn, role, text, _ in kept:
            codes += code(role, text, (role, text) in seen)
            seen.add((role, text))
            tally.row(turn, role, codes[-1])
        cost, audit, _ = solver(codes, 0, ENDS, True)
        out = edited([(r[2], r[3]) for r in kept], codes, 0, audit)
        h.add(out)
        return (conv, None, None, None, None, None, None, _messages(out) if keep_messages else None, _summary(tally, cost, audit, h))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, seq = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        size, passing, begun = 0, True, False  # the partition's first conversation passes
        out: list[tuple] = []

        def opened(rows) -> None:
            nonlocal seq
            for r in rows:
                out.append((r[0], pid, seq, r[1], r[2], r[3], r[4], None, None))
                seq += 1

        def pack() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        last = None
        for batch in batches:
            for r in zip(*[c.to_pylist() for c in batch.columns]):
                if begun and r[0] != last:
                    if held:
                        out.append(repaired(last, held))
                    held, size, passing = [], 0, False
                begun, last = True, r[0]
                held.append(r)
                size += len(r[3])
                if passing or len(held) > block or size > BLOCK_BYTES:
                    opened(held)
                    held, size, passing = [], 0, True
            if out:
                yield pack()
                out = []
        opened(held)
        if out:
            yield pack()

    return run


def _blocks(kind: pa.DataType, block: int):
    """Flagged open rows in order of (conv, pid, seq) -> blocks with rows, codes, counts and costs between states."""
    schema = pa.schema([
        ("conv", kind), ("pid", pa.int32()), ("blk", pa.int64()), ("codes", pa.string()), ("roles", pa.list_(pa.string())),
        ("texts", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())), ("ends", pa.list_(pa.string())),
        ("costs", pa.list_(pa.float64())), ("final", pa.list_(pa.float64()))])

    def made(key, rows) -> pa.RecordBatch:
        tally, codes = Tally(), ""
        for _, _, _, turn, role, text, again in rows:
            codes += code(role, text, again)
            tally.row(turn, role, codes[-1])
        *counts, head, tail = tally.numbers()
        costs = [c for q in range(4) for c in distances(codes, q, False)]
        final = [solve(codes, q, ENDS, True)[0] for q in range(4)]
        row = (*key, codes, [r[4] for r in rows], [r[5] for r in rows], counts, [head, tail], costs, final)
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None
        for b in batches:
            for *r, present in zip(*[c.to_pylist() for c in b.columns]):
                key = (r[0], r[1], r[2] // block)
                if at is not None and key != at:
                    yield made(at, held)
                    held = []
                at = key
                if present:
                    held.append(tuple(r))
        if at is not None:
            yield made(at, held)

    return run


def _following(kind: pa.DataType):
    """Blocks in order of (conv, last first) -> what follows each: costs to the end by state, and whether it is the last."""
    schema = pa.schema([("conv", kind), ("pid", pa.int32()), ("blk", pa.int64()), ("exits", pa.list_(pa.float64())), ("last", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, after = None, None
        for b in batches:
            out = []
            for c, pid, blk, costs, final in zip(*[x.to_pylist() for x in b.columns]):
                if after is None or c != conv:
                    out.append((c, pid, blk, list(ENDS), True))
                    conv, after = c, final
                else:
                    out.append((c, pid, blk, after, False))
                    after = [min(costs[4 * q + p] + after[p] for p in range(4)) for q in range(4)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*out), schema)], schema=schema)

    return run


def _audits():
    """Blocks with what follows them -> audit and exit state for each state that a block may be entered in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = b.schema.names
            codes, exits, last = (b.column(names.index(c)).to_pylist() for c in ("codes", "exits", "last"))
            solved = [[solve(c, q, tuple(x), z) for q in range(4)] for c, x, z in zip(codes, exits, last)]
            audits = pa.array([[s[1] for s in row] for row in solved], pa.list_(pa.string()))
            states = pa.array([[s[2] for s in row] for row in solved], pa.list_(pa.int32()))
            keep = [b.column(names.index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*keep, audits, states], names=[*names, "audits", "states"])

    return run


def _walked(kind: pa.DataType, keep_messages: bool):
    """Solved blocks in order of (conv, pid, blk) -> pieces of the repaired conversation, the last with the summary."""
    schema = pa.schema([("conv", kind), ("piece", pa.int64()), ("messages", _MESSAGES), ("done", _SUMMARY)])

    def batch(rows) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for b in batches:
            for c, codes, roles, texts, counts, ends, last, audits, states in zip(*[x.to_pylist() for x in b.columns]):
                if state is None:
                    state = {"q": 0, "n": 0, "audit": [], "tally": Tally(), "h": _Hash(), "cost": 0}
                audit = audits[state["q"]]
                out = edited(list(zip(roles, texts)), codes, state["q"], audit)
                state["h"].add(out)
                state["tally"].add(*counts, *ends)
                state["audit"].append(audit)
                state["cost"] += _cost(codes, state["q"], audit)
                state["q"] = states[state["q"]]
                if last:
                    done = _summary(state["tally"], state["cost"], "".join(state["audit"]), state["h"])
                    yield batch([(c, state["n"], _messages(out) if keep_messages else None, done)])
                    state = None
                else:
                    if keep_messages:
                        yield batch([(c, state["n"], _messages(out), None)])
                    state["n"] += 1

    return run


def _cost(codes: str, entry: int, audit: str) -> int:
    total, i = 0, 0
    for letter, q in zip(audit, walk(codes, entry, audit)):
        if letter == "I":
            total += INSERT
        else:
            total += next(c for x, c, _ in steps(codes[i], q) if x == letter)
            i += 1
    return total


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           present_col: str | None = None, with_messages: bool = False, block: int = BLOCK) -> DataFrame:
    """``conv``, ``piece``, ``messages`` (edit, role, text; null unless asked for) and ``done``, the conversation's summary.

    Conversations of at most ``block`` rows have one piece; longer ones a piece for each block if messages are
    asked for, and the summary stands on the last. ``present_col``: rows where it is false only name their conversation.
    """
    spark = rows.sparkSession
    small_batches(spark)
    present = F.lit(True) if present_col is None else F.coalesce(col(present_col), F.lit(False))
    src = rows.select(
        col(conv_col).alias("conv"), col(turn_col).cast("long").alias("turn"), F.coalesce(col(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(col(text_col).cast("string"), F.lit(" ")).alias("text"), present.alias("present"))
    kind = T.StructField("conv", src.schema["conv"].dataType)
    arrow = _arrow_type(kind.dataType)
    # the row number spreads equal rows; their order doesn't matter
    dealt = (src.withColumn("n", F.monotonically_increasing_id())
             .repartitionByRange("conv", "turn", "role", F.substring("text", 1, 64), "n")
             .sortWithinPartitions("conv", "turn", "role", "text").drop("n"))
    messages = T.StructField("messages", T.ArrayType(MESSAGE))
    first = T.StructType([
        kind, T.StructField("pid", T.IntegerType()), T.StructField("seq", T.LongType()),
        *[T.StructField(f.name, f.dataType) for f in src.schema.fields[1:]], messages, T.StructField("done", SUMMARY)])
    done = materialise(dealt.mapInArrow(_sorted_rows(arrow, with_messages, block), first), "conversations-sorted")
    whole = done.where("done IS NOT NULL").select("conv", F.lit(0).cast("long").alias("piece"), "messages", "done")

    opened = done.where("done IS NULL").drop("messages", "done")
    told = F.md5(F.concat("role", F.lit("\0"), "text").cast("binary"))
    firsts = materialise(
        opened.where("present").select("conv", told.alias("k"), F.struct("pid", "seq").alias("at")).groupBy("conv", "k")
        .agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("m")).where("m > 1").drop("m"), "conversations-repeated")
    keyed = opened.withColumn("k", told)
    flagged = keyed.join(firsts, keyed.conv.eqNullSafe(firsts.conv) & (keyed.k == firsts.k), "left").select(
        keyed.conv, "pid", "seq", "turn", "role", "text",
        F.coalesce(F.struct("pid", "seq") != F.col("first"), F.lit(False)).alias("again"), "present")
    place = T.StructType([kind, T.StructField("pid", T.IntegerType()), T.StructField("blk", T.LongType())])

    def fields(ddl: str) -> T.StructType:
        return T.StructType([*place.fields, *T._parse_datatype_string(ddl).fields])

    blocks = materialise(
        flagged.repartition("conv", "pid", F.floor(F.col("seq") / block)).sortWithinPartitions("conv", "pid", "seq")
        .mapInArrow(_blocks(arrow, block), fields("codes string, roles array<string>, texts array<string>, counts array<long>, "
                                                  "ends array<string>, costs array<double>, final array<double>")), "conversations-blocks")
    after = materialise(
        blocks.select("conv", "pid", "blk", "costs", "final").repartition("conv").sortWithinPartitions("conv", F.desc("pid"), F.desc("blk"))
        .mapInArrow(_following(arrow), fields("exits array<double>, last boolean")), "conversations-exits")
    here = blocks.drop("costs", "final").withColumnRenamed("conv", "c0")
    joined = here.join(after, here.c0.eqNullSafe(after.conv) & (here.pid == after.pid) & (here.blk == after.blk)).select(
        after.conv, after.pid, after.blk, "codes", "roles", "texts", "counts", "ends", "exits", "last")
    solved = materialise(joined.mapInArrow(_audits(), T.StructType([
        *joined.schema.fields, T.StructField("audits", T.ArrayType(T.StringType())), T.StructField("states", T.ArrayType(T.IntegerType()))])),
        "conversations-solved")
    walked = (solved.repartition("conv").sortWithinPartitions("conv", "pid", "blk")
              .select("conv", "codes", "roles", "texts", "counts", "ends", "last", "audits", "states")
              .mapInArrow(_walked(arrow, with_messages), whole.schema))
    return whole.unionByName(walked)


def _arrow_type(t: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(t)


def damage(conversations: DataFrame) -> DataFrame:
    """The test damage: conv_id, turn, role, text, present; by crc32 of ``conv_id:turn`` (nulls: one blank) modulo 20.

    0 drops a row (it stays as not present), 1 empties its text, 2 removes its end marks, 3 repeats it, 4 makes it the user's.
    """
    def text(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    h = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    return conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), h.alias("h")).select(
        "conv_id", "turn", F.when(F.col("h") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("h") == 1, F.lit("")).when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("h") != 0).alias("present"),
        F.explode(F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def digest(repaired: DataFrame) -> DataFrame:
    return repaired.where("done IS NOT NULL").select(F.col("conv").alias("conv_id"), "done.*")

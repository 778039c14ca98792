"""Repair of the structure of conversations at least cost, by Hirschberg's divide-and-conquer.

A repaired conversation is empty, or an optional system turn and then user and assistant in turn, ending with the
assistant. Rows may be kept, given the role user or assistant, or deleted, and empty turns may be inserted. The initials
of the edits in order (K, R, D, I) are the audit; of the cheapest audits the least is taken.

1. The grammar has four states: before any turn, after system, after user, after assistant. An audit leads to one state only, and
   audits that end with the same row and differ are told apart before either ends. So it is enough
   to know, for each state after a row, the least cost and how the least audits of the four states compare: four costs and four ranks.
2. Forward vectors of this kind reach the middle row from the begin, backward vectors of costs from the end. Where their sum is least, and
   of those states where the rank is, the best audit crosses the middle; both halves are solved the same way.
   Vectors are all that is held, so the space is linear, and the time n log n.
3. Conversations of at most ``LONG_ROWS`` rows and ``LONG_BYTES`` of text are solved in the task that has them. Longer ones are cut into
   segments by a range shuffle; each segment gives its costs and ranks from every state to every state, and over these tables the
   crossings between segments are found in the same way; then every segment is solved by itself. No task holds more than a segment of text.
   Repeats in long conversations are found by an aggregation.

Defined results: rows of a conversation are ordered by turn (null first), role and text; a null role or text is one blank; rows
without an id are one conversation; a row with an empty role cannot be kept as it is; a row's first fault of blank, duplicate, truncated counts; rows that repeat a row entirely are duplicates;
an empty table gives no rows; other columns are ignored whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelpline.llm.tables import staged
from kelpline.operators.lookups import lookup_join
from kelpline.session import ship_package

LONG_ROWS = 1 << 14
LONG_BYTES = 16 * 1024 * 1024
#: Rows put out at once.
BATCH = 4096

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
ROLES = {USER: "user", ASSISTANT: "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Faults as they stand in a row's code: ``4 * fault + state of the role's initial``.
FAULTS = [None, "truncated", "blank", "duplicate"]
#: A state this much dearer than another is on no cheapest way: from any state the rest costs at most ten more than from any other.
FAR = 40

#: The role that comes next, and what is inserted at the end.
FOLLOWS = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
CLOSING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}

#: Per state its edges: the state after, the cost, and what the audit gets or, for segments, a rank.
Edges = list[list[tuple[int, int, str | int]]]
#: Per state the cost and the rank, none if it cannot be reached.
Vector = tuple[tuple[int, int] | None, ...]


def row_edges(code: int) -> Edges:
    """The edits of one row from each state. Nothing is inserted before a deletion: after it is less."""
    fault, role = FAULTS[code // 4], code % 4
    found: Edges = []
    for state in STATES:
        edges: list = [(state, DELETE, "D")]
        if fault in (None, "truncated"):
            extra = TRUNCATED if fault else 0
            for before, inserted in ((state, ""), (FOLLOWS[state], "I")):
                paid = extra + INSERT * len(inserted)
                if role == FOLLOWS[before] or (role, before) == (SYSTEM, START):
                    edges.append((role, paid + KEEP, inserted + "K"))
                edges.append((FOLLOWS[before], paid + REROLE, inserted + "R"))
        found.append(edges)
    return found


ROW_EDGES = [row_edges(code) for code in range(4 * len(FAULTS))]


def forward(vector: Vector, edges: Edges) -> Vector:
    best: dict[int, tuple] = {}
    for state, reached in enumerate(vector):
        if reached is not None:
            cost, rank = reached
            for after, paid, order in edges[state]:
                offer = (cost + paid, rank, order)
                if after not in best or offer < best[after]:
                    best[after] = offer
    least = min(offer[0] for offer in best.values())
    order = sorted((s for s in best if best[s][0] <= least + FAR), key=lambda s: best[s][1:])
    ranks = {s: i for i, s in enumerate(order)}
    return tuple((best[s][0], ranks[s]) if s in ranks else None for s in STATES)


def backward(costs: tuple, edges: Edges) -> tuple:
    """The least cost from each state to the end, given that after the row."""
    out = []
    for state in STATES:
        offers = [paid + costs[after] for after, paid, _ in edges[state] if costs[after] is not None]
        out.append(min(offers) if offers else None)
    return tuple(out)


class Rows:
    """The rows of a conversation or of a segment by their codes. Steps are looked up: few vectors occur, but for a constant."""

    _forward: dict = {}
    _backward: dict = {}

    def __init__(self, codes: bytes):
        self.codes = codes

    def __len__(self) -> int:
        return len(self.codes)

    def edges(self, i: int) -> Edges:
        return ROW_EDGES[self.codes[i]]

    def forward(self, vector: Vector, begin: int, end: int) -> Vector:
        known, paid = self._forward, 0
        for code in self.codes[begin:end]:
            step = known.get((vector, code))
            if step is None:
                after = forward(vector, ROW_EDGES[code])
                least = min(v[0] for v in after if v is not None)
                step = known[vector, code] = (tuple(v and (v[0] - least, v[1]) for v in after), least)
            vector, paid = step[0], paid + step[1]
        return tuple(v and (v[0] + paid, v[1]) for v in vector)

    def backward(self, costs: tuple, begin: int, end: int) -> tuple:
        known, paid = self._backward, 0
        for code in reversed(self.codes[begin:end]):
            step = known.get((costs, code))
            if step is None:
                before = backward(costs, ROW_EDGES[code])
                least = min(v for v in before if v is not None)
                step = known[costs, code] = (tuple(None if v is None else v - least for v in before), least)
            costs, paid = step[0], paid + step[1]
        return tuple(None if v is None else v + paid for v in costs)


class Segments:
    """Segments in their order, each by its edges from every state to every state."""

    def __init__(self, tables: list[Edges]):
        self.tables = tables

    def __len__(self) -> int:
        return len(self.tables)

    def edges(self, i: int) -> Edges:
        return self.tables[i]

    def forward(self, vector: Vector, begin: int, end: int) -> Vector:
        for i in range(begin, end):
            vector = forward(vector, self.tables[i])
        return vector

    def backward(self, costs: tuple, begin: int, end: int) -> tuple:
        for i in range(end - 1, begin - 1, -1):
            costs = backward(costs, self.tables[i])
        return costs


def only(state: int, value) -> tuple:
    return tuple(value if s == state else None for s in STATES)


def segment_edges(rows: Rows) -> Edges:
    """What a segment costs from every state to every state, and how its least audits from one state compare."""
    return [
        [(after, *reached) for after, reached in enumerate(rows.forward(only(state, (0, 0)), 0, len(rows))) if reached is not None] for state in STATES
    ]


def crossings(items: Rows | Segments, first: int, last: int) -> Iterator[tuple[int, int, str | int]]:
    """State before, state after and what the audit gets, item by item, on the least of the cheapest ways from ``first`` to ``last``."""
    open_parts = [(0, len(items), first, last)]
    while open_parts:
        begin, end, before, after = open_parts.pop()
        if end - begin == 1:
            _, order = min((paid, order) for s, paid, order in items.edges(begin)[before] if s == after)
            yield before, after, order
        elif end > begin:
            middle = (begin + end) // 2
            there = items.forward(only(before, (0, 0)), begin, middle)
            onward = items.backward(only(after, 0), middle, end)
            ways = [(there[s][0] + onward[s], there[s][1], s) for s in STATES if there[s] is not None and onward[s] is not None]
            crossing = min(ways)[2]
            open_parts.append((middle, end, crossing, after))
            open_parts.append((begin, middle, before, crossing))


def last_state(items: Rows | Segments) -> int:
    """Where the best audit of the whole ends, before what is inserted to close."""
    reached = items.forward(only(START, (0, 0)), 0, len(items))
    return min((v[0] + INSERT * len(CLOSING[s]), v[1], s) for s, v in enumerate(reached) if v is not None)[2]


def audit(codes: bytes) -> str:
    rows = Rows(codes)
    last = last_state(rows)
    return "".join(edit for _, _, edit in crossings(rows, START, last)) + CLOSING[last]


# -- rows ------------------------------------------------------------------------------------

#: Blank, tab, line feed, vertical tab, form feed, carriage return.
_TRIMMED = " \t\n\x0b\f\r"


def _prepared(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows with blanks for nulls, a key that is never null, and the faults that a row shows by itself."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    named = rows.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), blank(role).alias("role"), blank(text).alias("text"))
    last = F.right(F.rtrim("text", F.lit(_TRIMMED)), F.lit(1))
    fault = F.when(last == "", F.lit(2)).when(last.isin(".", "!", "?"), F.lit(0)).otherwise(F.lit(1))
    return named.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key"), "*", fault.alias("fault"))


def _sorted(columns: list[str]) -> list[Column]:
    return [F.asc_nulls_first(c) for c in columns]


EDITS = "key string, conv_id long, part int, seq int, place long, edit string, fault string, turn long, was string, role string, text string"
_EDITS = pa.schema(
    [
        ("key", pa.string()), ("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int32()), ("place", pa.int64()), ("edit", pa.string()),
        ("fault", pa.string()), ("turn", pa.int64()), ("was", pa.string()), ("role", pa.string()), ("text", pa.string()),
    ]
)


@dataclass
class _Part:
    """Rows of one conversation or segment, in order: (turn, role, text, fault)."""

    key: str
    conv_id: int | None
    part: int = 0
    seq: int = 0
    rows: list = None

    def codes(self) -> bytes:
        return bytes(4 * fault + INITIALS.get(role[:1], 0) for _, role, _, fault in self.rows)

    def edits(self, first: int, last: int, closing: str) -> Iterator[tuple]:
        place = 0

        def put(edit, fault=None, turn=None, was=None, role=None, text=None):
            nonlocal place
            place += 1
            return self.key, self.conv_id, self.part, self.seq, place - 1, edit, fault, turn, was, role, text

        for (turn, was, text, fault), (before, _, edits) in zip(self.rows, crossings(Rows(self.codes()), first, last)):
            if edits[0] == "I":
                before = FOLLOWS[before]
                yield put("I", role=ROLES[before], text="")
            role = {"K": was, "R": ROLES[FOLLOWS[before]], "D": None}[edits[-1]]
            yield put(edits[-1], FAULTS[fault], turn, was, role, text)
        for _ in closing:
            last = FOLLOWS[last]
            yield put("I", role=ROLES[last], text="")


def _batches(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    pending: list[tuple] = []
    for row in rows:
        pending.append(row)
        if len(pending) == BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*pending), _EDITS)], schema=_EDITS)
            pending = []
    if pending:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*pending), _EDITS)], schema=_EDITS)


def _columns(batches: Iterable[pa.RecordBatch | pa.Table], names: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch[c].to_pylist() for c in names))


def _short(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of whole conversations to edits; one conversation is held at a time."""

    def solved(part: _Part) -> Iterator[tuple]:
        last = last_state(Rows(part.codes()))
        return part.edits(START, last, CLOSING[last])

    def edits() -> Iterator[tuple]:
        part, seen = None, set()
        for key, conv_id, turn, role, text, fault in _columns(batches, ["key", "conv_id", "turn", "role", "text", "fault"]):
            if part is None or key != part.key:
                if part is not None:
                    yield from solved(part)
                part, seen = _Part(key, conv_id, rows=[]), set()
            if fault != 2:
                fault = 3 if (role, text) in seen else fault
                seen.add((role, text))
            part.rows.append((turn, role, text, fault))
        if part is not None:
            yield from solved(part)

    return _batches(edits())


# -- long conversations ----------------------------------------------------------------------


def _cutter(most_rows: int, most_bytes: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Numbers the segments of a range partition, and the rows in them."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, key, seq, at, size = TaskContext.get().partitionId(), None, 0, 0, 0
        for batch in batches:
            seqs, places = [], []
            for own, length in zip(batch["key"].to_pylist(), batch["size"].to_pylist()):
                if own != key:
                    key, seq, at, size = own, 0, 0, 0
                elif at >= most_rows or size + length > most_bytes:
                    seq, at, size = seq + 1, 0, 0
                seqs.append(seq)
                places.append(at)
                at, size = at + 1, size + length
            n = len(batch)
            numbers = [pa.array([part] * n, pa.int32()), pa.array(seqs, pa.int32()), pa.array(places, pa.int64())]
            yield pa.RecordBatch.from_arrays([*numbers, *batch.columns], names=["part", "seq", "at", *batch.schema.names])

    return cut


def _part(rows: pa.Table) -> _Part:
    rows = rows.sort_by("at")
    part = _Part(*(rows[c][0].as_py() for c in ("key", "conv_id", "part", "seq")))
    part.rows = list(_columns([rows], ["turn", "role", "text", "fault"]))
    return part


_TABLE = "key string, part int, seq int, state int, after int, paid long, rank int"


def _summed(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("at")
    codes = bytes(4 * fault + INITIALS.get(initial, 0) for initial, fault in _columns([rows], ["initial", "fault"]))
    own = [rows[c][0].as_py() for c in ("key", "part", "seq")]
    found = [(*own, state, *edge) for state, edges in enumerate(segment_edges(Rows(codes))) for edge in edges]
    return pa.Table.from_pydict(dict(zip(("key", "part", "seq", "state", "after", "paid", "rank"), map(list, zip(*found)))), schema=_TABLE_ARROW)


_TABLE_ARROW = pa.schema([("key", pa.string()), *((c, pa.int32()) for c in ("part", "seq", "state", "after")), ("paid", pa.int64()), ("rank", pa.int32())])
_CROSSED = "key string, part int, seq int, first int, last int, closing string"
_CROSSED_ARROW = pa.schema([("key", pa.string()), *((c, pa.int32()) for c in ("part", "seq", "first", "last")), ("closing", pa.string())])


def _crossed(rows: pa.Table) -> pa.Table:
    """The tables of one conversation's segments to the states between them: a few numbers per segment."""
    tables: dict[tuple[int, int], Edges] = {}
    for part, seq, state, after, paid, rank in sorted(_columns([rows], ["part", "seq", "state", "after", "paid", "rank"])):
        tables.setdefault((part, seq), [[] for _ in STATES])[state].append((after, paid, rank))
    segments = Segments(list(tables.values()))
    last = last_state(segments)
    key = rows["key"][0].as_py()
    found = [[key, *place, before, after, ""] for place, (before, after, _) in zip(tables, crossings(segments, START, last))]
    found[-1][-1] = CLOSING[last]
    return pa.Table.from_pydict(dict(zip(_CROSSED_ARROW.names, map(list, zip(*found)))), schema=_CROSSED_ARROW)


def _solved(rows: pa.Table, states: pa.Table) -> pa.Table:
    part = _part(rows)
    first, last, closing = (states[c][0].as_py() for c in ("first", "last", "closing"))
    return pa.Table.from_batches(_batches(part.edits(first, last, closing)), _EDITS)


def _long(rows: DataFrame, most_rows: int, most_bytes: int) -> DataFrame:
    """Edits of long conversations, segment by segment."""
    # rows alike are told apart by a number, which must not change when a task is run again
    rows = staged(rows.withColumn("id", F.monotonically_increasing_id()).withColumn("own", F.sha2("text", 256)))
    same = ["key", "role", "own"]
    groups = rows.where("fault <> 2").groupBy(*same).agg(F.min(F.struct("turn", "id")).alias("first"), F.count("*").alias("n"))
    repeated = staged(groups.where("n > 1").select(*same, F.col("first.id").alias("_first")))
    rows = lookup_join(rows, repeated, same)
    rows = rows.withColumn("fault", F.when(F.col("_first").isNotNull() & (F.col("fault") != 2) & (F.col("_first") != F.col("id")), F.lit(3)).otherwise(F.col("fault")))
    rows = staged(rows.select("key", "conv_id", "turn", "role", "text", "fault", "id", F.octet_length("text").cast("long").alias("size")))
    order = ["key", "turn", "role", "text", "id"]
    ranged = rows.repartitionByRange(*_sorted(order)).sortWithinPartitions(*_sorted(order)).drop("id")
    schema = "part int, seq int, at long, key string, conv_id long, turn long, role string, text string, fault int, size long"
    cut = staged(ranged.mapInArrow(_cutter(most_rows, most_bytes), schema))
    place = ["key", "part", "seq"]
    tables = cut.select(*place, "at", F.left("role", F.lit(1)).alias("initial"), "fault").groupBy(*place).applyInArrow(_summed, _TABLE)
    states = staged(tables.groupBy("key").applyInArrow(_crossed, _CROSSED))
    return cut.drop("size").groupBy(*place).cogroup(states.groupBy(*place)).applyInArrow(_solved, EDITS)


def repair(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES,
) -> DataFrame:
    """The edits of every conversation, a row per edit: what was there (``turn``, ``was``, ``fault``) and what is there now.

    ``part, seq, place`` order the edits of a ``key`` (the id as text, empty for none). Rows whose ``edit`` is not D are
    the repaired conversation, with ``role`` and ``text``; a deleted row has no ``role``, an inserted one no ``turn`` and ``was``.
    """
    ship_package(rows.sparkSession)
    rows = _prepared(rows, conv_id, turn, role, text)
    sizes = rows.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.octet_length("text").cast("long")).alias("bytes"))
    long_ones = staged(sizes.where((F.col("n") > long_rows) | (F.col("bytes") > long_bytes)).select("key"))
    some = not long_ones.isEmpty()
    short = lookup_join(rows, long_ones, ["key"], "left_anti") if some else rows
    placed = short.repartition("key").sortWithinPartitions(*_sorted(["key", "turn", "role", "text"]))
    found = placed.mapInArrow(_short, EDITS)
    return found.unionByName(_long(lookup_join(rows, long_ones, ["key"], "left_semi"), long_rows, long_bytes)) if some else found


# -- what a conversation looks like after ----------------------------------------------------

SUMMARY = (
    "key string, conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)
_SUMMARY = pa.schema(
    [("key", pa.string()), *((c, pa.int64()) for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string()), ("repaired_sha256", pa.string())]
)
_LEGAL = {"su", "ua", "au"}
_PRICES = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}


class _Summary:
    """Counts, audit and digest of one conversation, edit after edit; no text is held."""

    def __init__(self, key: str, conv_id: int | None):
        self.key, self.conv_id = key, conv_id
        self.counts = dict.fromkeys(FAULTS[1:], 0)
        self.illegal = self.cost = self.turns = 0
        self.first = self.latest = self.initial = None
        self.edits, self.digest, self.turn_written = [], hashlib.sha256(), False

    def add(self, edit: str, fault: str | None, turn: int | None, was: str | None, role: str | None, text: str) -> None:
        self.edits.append(edit)
        self.cost += _PRICES[edit] + (TRUNCATED if fault == "truncated" and edit != "D" else 0)
        if fault:
            self.counts[fault] += 1
        if edit != "I":
            self.illegal += self.initial is not None and self.initial + was[:1] not in _LEGAL
            self.initial = was[:1]
            if turn is not None and turn != self.latest:
                self.first = turn if self.first is None else self.first
                self.latest, self.turns = turn, self.turns + 1
        if edit != "D":
            self.digest.update((b"\n" if self.turn_written else b"") + f"{role}:{text}".encode())
            self.turn_written = True

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.latest - self.first + 1 - self.turns
        counts = (self.counts[f] for f in ("blank", "duplicate", "truncated"))
        # a difference of turns beyond a long cannot be told
        return self.key, self.conv_id, gaps if gaps < 2**63 else None, *counts, self.illegal, self.cost, "".join(self.edits), self.digest.hexdigest()


def _summarize(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def put(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SUMMARY)], schema=_SUMMARY)

    now, done, size = None, [], 0
    for key, conv_id, *edit in _columns(batches, ["key", "conv_id", "edit", "fault", "turn", "was", "role", "text"]):
        if now is None or key != now.key:
            if now is not None:
                done.append(now.row())
                size += len(done[-1][-2])
            now = _Summary(key, conv_id)
            if len(done) == BATCH or size > LONG_BYTES:
                yield put(done)
                done, size = [], 0
        now.add(*edit)
    if now is not None:
        yield put([*done, now.row()])


def summarize(edits: DataFrame) -> DataFrame:
    """Per conversation the faults, gaps, cost, audit and the digest of the repaired turns.

    A digest can only be taken in order, so the edits of a conversation pass through one task; it holds the audit
    and nothing else of them.
    """
    order = ["key", "part", "seq", "place"]
    return edits.repartition("key").sortWithinPartitions(*order).mapInArrow(_summarize, SUMMARY)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults put in by a hash of id and turn: rows dropped, emptied, cut short, repeated, given the role user."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = (F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20).alias("_fate")
    named = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), blank("role").alias("role"), blank("text").alias("text"), fate)
    text = F.when(F.col("_fate") == 1, F.lit("")).when(F.col("_fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_fate") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("_fate") == 3, F.lit(2)).otherwise(F.lit(1))))
    return named.where("_fate <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("_copy")).drop("_copy")

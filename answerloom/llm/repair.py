"""Conversation structure repair by weighted CYK parsing of intervals.

The rows of a conversation, in order, are a string over s, u and a (the first letters of their roles). Edits turn it into
one of ``(s?(ua)+)?``: Keep (0), Rerole to user or assistant (2), Delete (3) and Insert a user or assistant row (2); blank and
repeated rows must go, and a truncated one costs 1 unless it goes. The grammar is in Chomsky normal form: a non-terminal
is what a run of rows may become (nothing, or a part of the language by its first and last letter), and every rule joins
two of them. A cell holds the least (cost, audit) of each non-terminal over an interval of rows, the audit being
the edits' initials; single rows are closed under insertions on either side, longer spans follow bottom-up from all their
splits. Audits of one span, cost and non-terminal are never prefixes of one another, so least parts make a least whole.

Intervals of ``WIDEST`` rows are parsed by themselves, many at once in numpy; a longer conversation's intervals are joined by the
same rules, neighbours of like span first. The non-terminals name every part of the language, so any place may serve
as a split. That is why a conversation may be cut anywhere: rows are ranged by conversation and place, each task parses
the runs it holds, and the parts of a conversation meet as cells, a row per task. The repaired rows and their digest then come
from one sorted pass over each conversation, which holds a batch of rows and the audit. So no conversation is ever held
in one task, but its audit is one string and its cells as long as eight of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.llm.common import joined
from answerloom.storage import materialize

SPACES = " \t\n\x0b\f\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # costs
WIDEST = 8  # rows of an interval; its audits fit 64 bits

# What rows may become: nothing, a part of (ua)+ by its first and last letter, s, or s and such a part by its last letter.
NOTHING, UU, UA, AU, AA, S, SU, SA = range(8)
RULES = [(NOTHING, x, x) for x in range(8)] + [(x, NOTHING, x) for x in range(1, 8)]
RULES += [(UU, AU, UU), (UU, AA, UA), (UA, UU, UU), (UA, UA, UA), (AU, AU, AU), (AU, AA, AA), (AA, UU, AU), (AA, UA, AA)]
RULES += [(S, UU, SU), (S, UA, SA), (SU, AU, SU), (SU, AA, SA), (SA, UU, SU), (SA, UA, SA)]
WHOLE = (NOTHING, UA, SA)
NEVER = 10_000  # a cost beyond all
LETTERS = b"\0DIKR"  # in the order of ties
D, I, K, R = (np.uint64(x) << np.uint64(61) for x in (1, 2, 3, 4))
MOST_LETTERS = 21


@dataclass
class Cells:
    """Least (cost, audit) per non-terminal (last axis); audits from the high end, three bits a letter."""

    cost: np.ndarray
    audit: np.ndarray
    length: np.ndarray

    @classmethod
    def none(cls, *shape: int) -> Cells:
        return cls(np.full((*shape, 8), NEVER, np.int32), np.zeros((*shape, 8), np.uint64), np.zeros((*shape, 8), np.int64))

    def put(self, where, kind: int, cost, audit: np.uint64, length: int) -> None:
        self.cost[where, kind], self.audit[where, kind], self.length[where, kind] = cost, audit, length

    def take(self, kind: int, cost: np.ndarray, audit: np.ndarray, length: np.ndarray) -> None:
        mine = self.cost[..., kind]
        better = (cost < mine) | ((cost == mine) & (audit < self.audit[..., kind]))
        for held, new in ((self.cost, cost), (self.audit, audit), (self.length, length)):
            np.copyto(held[..., kind], new, where=better)

    def part(self, *at) -> Cells:
        return Cells(self.cost[at], self.audit[at], self.length[at])

    def plain(self) -> list[list[tuple[int, str] | None]]:
        """Per cell and non-terminal (cost, audit), or None."""
        shifts = np.arange(61, 0, -3, dtype=np.uint64)[:MOST_LETTERS]
        codes = (self.audit[..., None] >> shifts) & np.uint64(7)
        text = np.frombuffer(LETTERS, np.uint8)[codes.astype(np.int64)].view(f"S{MOST_LETTERS}")[..., 0]
        return [
            [(c, t.decode()) if c < NEVER else None for c, t in zip(cs, ts, strict=True)] for cs, ts in zip(self.cost.tolist(), text.tolist(), strict=True)
        ]


def joined_cells(a: Cells, b: Cells, into: Cells | None = None) -> Cells:
    """What neighbouring spans become together, or the less of that and ``into``."""
    shape = np.broadcast_shapes(a.cost.shape, b.cost.shape)
    out = Cells.none(*shape[:-1]) if into is None else into
    for left, right, whole in RULES:
        cost = np.minimum(a.cost[..., left] + b.cost[..., right], NEVER)
        length = a.length[..., left]
        audit = a.audit[..., left] | (b.audit[..., right] >> (3 * length).astype(np.uint64))
        out.take(whole, cost, audit, np.minimum(length + b.length[..., right], MOST_LETTERS))
    return out


def insertions() -> Cells:
    """What no rows may become: nothing, or up to two inserted rows."""
    out = Cells.none(1)
    out.put(0, NOTHING, 0, np.uint64(0), 0)
    for kind in (UU, AA):
        out.put(0, kind, INSERT, I, 1)
    for kind in (UA, AU):
        out.put(0, kind, 2 * INSERT, I | (I >> np.uint64(3)), 2)
    return out


def row_cells(initial: np.ndarray, gone: np.ndarray, truncated: np.ndarray) -> Cells:
    """One cell per row, closed under insertions on both sides; ``initial`` is 1 for s, 2 for u, 3 for a, else 0."""
    out = Cells.none(len(initial))
    out.put(slice(None), NOTHING, DELETE, D, 1)
    extra = truncated * TRUNCATED
    stays = ~gone
    for kind in (UU, AA):
        out.put(stays, kind, REROLE + extra[stays], R, 1)
    for code, kind in ((1, S), (2, UU), (3, AA)):
        own = stays & (initial == code)
        out.put(own, kind, KEEP + extra[own], K, 1)
    ends = insertions()
    return joined_cells(ends, joined_cells(out, ends))


def interval_cells(rows: Cells, begin: np.ndarray, size: np.ndarray) -> Cells:
    """The cell of each interval of up to ``WIDEST`` rows, bottom-up by span from all splits. Short ones are filled up."""
    at = begin[:, None] + np.arange(WIDEST)
    real = np.arange(WIDEST) < size[:, None]
    one = rows.part(np.where(real, at, 0))
    one.cost[~real], one.audit[~real], one.length[~real] = NEVER, 0, 0
    one.cost[~real, NOTHING] = 0
    chart = {1: one}
    for span in range(2, WIDEST + 1):
        n = WIDEST - span + 1
        out = None
        for k in range(1, span):
            out = joined_cells(chart[k].part(slice(None), slice(0, n)), chart[span - k].part(slice(None), slice(k, k + n)), out)
        chart[span] = out
    return chart[WIDEST].part(slice(None), 0)


Cell = list  # (cost, audit) or None per non-terminal


def joined_plain(a: Cell, b: Cell) -> Cell:
    out: Cell = [None] * 8
    for left, right, whole in RULES:
        x, y = a[left], b[right]
        if x is None or y is None:
            continue
        cost = x[0] + y[0]
        if out[whole] is None or cost <= out[whole][0]:
            candidate = (cost, x[1] + y[1])
            if out[whole] is None or candidate < out[whole]:
                out[whole] = candidate
    return out


class Spans:
    """Neighbouring spans of one conversation, joined when they are of like width."""

    def __init__(self):
        self.held: list[tuple[int, Cell]] = []

    def add(self, width: int, cell: Cell) -> None:
        while self.held and self.held[-1][0] <= width:
            before, left = self.held.pop()
            width, cell = width + before, joined_plain(left, cell)
        self.held.append((width, cell))

    def whole(self) -> Cell | None:
        if not self.held:
            return None
        cell = self.held[-1][1]
        for _, left in reversed(self.held[:-1]):
            cell = joined_plain(left, cell)
        return cell


def runs(column: pa.Array) -> Iterator[tuple[object, int, int]]:
    """(value, start, end) of each run of equal values."""
    if len(column):
        found = pc.run_end_encode(column, run_end_type=pa.int64())
        start = 0
        for value, end in zip(found.values.to_pylist(), found.run_ends.to_pylist(), strict=True):
            yield value, start, end
            start = end


def span_rows(conv_type: pa.DataType):
    """Per conversation in a task's sorted rows of (conv, initial, gone, truncated): one cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        current, spans = None, Spans()

        def batch_of(done: list) -> pa.RecordBatch:
            columns = [
                pa.array([d[0] for d in done], conv_type),
                pa.array([part] * len(done), pa.int32()),
                pa.array([[NEVER if x is None else x[0] for x in d[1]] for d in done], pa.list_(pa.int64())),
                pa.array([["" if x is None else x[1] for x in d[1]] for d in done], pa.list_(pa.string())),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["conv", "part", "costs", "audits"])

        for batch in batches:
            initial = batch.column("initial").to_numpy()
            flags = [batch.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("gone", "truncated")]
            cells = row_cells(initial, *flags)
            found = list(runs(batch.column("conv")))
            begin = [k for _, start, end in found for k in range(start, end, WIDEST)]
            size = [min(WIDEST, end - k) for _, start, end in found for k in range(start, end, WIDEST)]
            parsed = iter(interval_cells(cells, np.array(begin, np.int64), np.array(size, np.int64)).plain() if begin else [])
            done = []
            for conv, start, end in found:
                if spans.held and conv != current:
                    done.append((current, spans.whole()))
                    spans = Spans()
                current = conv
                for k in range(start, end, WIDEST):
                    spans.add(min(WIDEST, end - k), next(parsed))
            if done:
                yield batch_of(done)
        if spans.held:
            yield batch_of([(current, spans.whole())])

    return run


@dataclass
class Conversation:
    """One conversation on its sorted way past: first its cells, then its rows."""

    conv: object
    spans: Spans = field(default_factory=Spans)
    cost: int = 0
    audit: str = ""
    at: int = 0
    opened: bool = False
    letter: str = ""  # the last repaired row's
    place: int = 0
    seen: int = 0
    before: str | None = None
    illegal: int = 0
    faults: list[int] = field(default_factory=lambda: [0, 0, 0])
    turns: list[int] = field(default_factory=list)  # first, last, how many
    digest: object = field(default_factory=hashlib.sha256)

    def open(self) -> None:
        if not self.opened:
            self.opened = True
            cell = self.spans.whole()
            if cell is not None:
                self.cost, self.audit = min(cell[k] for k in WHOLE if cell[k] is not None)

    def emit(self, turn: int | None, role: str, text: bytes, edit: str) -> tuple:
        self.digest.update(b"\n" * (self.place > 0) + role.encode() + b":" + text)
        self.letter = role[:1]
        self.place += 1
        return self.conv, self.place - 1, turn, role, text, edit

    def following(self) -> str:
        return "assistant" if self.letter == "u" else "user"

    def inserted(self) -> Iterator[tuple]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self.emit(None, self.following(), b"", "I")

    def row(self, turn: int | None, role: str, text: bytes, fault: int) -> Iterator[tuple]:
        """The repaired rows up to this one."""
        self.open()
        if turn is not None:
            if not self.turns:
                self.turns = [turn, turn, 1]
            elif turn != self.turns[1]:
                self.turns[1:] = [turn, self.turns[2] + 1]
        if fault:
            self.faults[fault - 1] += 1
        if self.seen and self.before + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.seen, self.before = self.seen + 1, role[:1]
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            yield self.emit(turn, self.following() if edit == "R" else role, text, edit)

    def close(self) -> Iterator[tuple]:
        self.open()
        yield from self.inserted()

    def report(self) -> tuple:
        gaps = self.turns[1] - self.turns[0] + 1 - self.turns[2] if self.turns else 0
        return (self.conv, gaps, *self.faults, self.illegal, self.cost, self.audit, self.digest.hexdigest())


CELL, ROW, GONE = range(3)  # what a row of the sorted pass is, in this order
REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
ROWS_AT_ONCE = 10_000
BYTES_AT_ONCE = 16 << 20


def sorted_pass(conv_type: pa.DataType, rows: bool):
    """Reports, or the repaired rows, from sorted cells and rows of whole conversations."""
    longs = [pa.int64()] * 6
    types = [conv_type, pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string()] if rows else [conv_type, *longs, pa.string(), pa.string()]
    names = ["conv", "place", "turn", "role", "text", "edit"] if rows else ["conv", *REPORT]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        at: Conversation | None = None

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names=names)

        def keep(found: Iterator[tuple]) -> None:
            nonlocal size
            for row in found:
                if rows:
                    out.append(row)
                    size += len(row[4])

        def finish() -> None:
            nonlocal size
            if at is not None:
                keep(at.close())
                if not rows:
                    out.append(at.report())
                    size += len(at.audit)

        for batch in batches:
            costs, audits, text = (batch.column(c) for c in ("costs", "audits", "text"))
            kinds, turns, roles, faults = (batch.column(c).to_pylist() for c in ("kind", "turn", "role", "fault"))
            for conv, start, end in runs(batch.column("conv")):
                if at is None or conv != at.conv:
                    finish()
                    at = Conversation(conv)
                for k in range(start, end):
                    if kinds[k] == CELL:
                        cell = [None if c == NEVER else (c, t) for c, t in zip(costs[k].as_py(), audits[k].as_py(), strict=True)]
                        at.spans.add(1, cell)
                    elif kinds[k] == ROW:
                        keep(at.row(turns[k], roles[k], text[k].as_py(), faults[k]))
                    if len(out) >= ROWS_AT_ONCE or size >= BYTES_AT_ONCE:
                        yield batch_of()
                        out, size = [], 0
        finish()
        if out:
            yield batch_of()

    return run


def _passed(df: DataFrame, rows: bool, conv_col: str, turn_col: str, role_col: str, text_col: str, gone: str | None) -> DataFrame:
    given = df.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(role_col, F.lit(" ")).alias("role"), F.coalesce(text_col, F.lit(" ")).alias("text"),
        (F.coalesce(F.col(gone), F.lit(False)) if gone else F.lit(False)).alias("dropped"), F.monotonically_increasing_id().alias("seq"),
    )
    last = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    content = ["conv", "role", "text"]
    nulls = F.col("conv").isNull()
    given = given.select(
        "*", F.xxhash64(nulls, *content).alias("h1"), F.xxhash64(F.lit("second"), nulls, *content).alias("h2"), (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut")
    )
    given = materialize(given, "turns")
    here = given.filter(~F.col("dropped"))
    place = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn", "seq")
    several = here.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("of")).filter("of > 1").select("h1", "h2", "first")
    flagged = joined(here, several, ["h1", "h2"], "left", "repeated-turns")
    again = F.coalesce(place != F.col("first"), F.lit(False))
    fault = F.when(F.col("blank"), 1).when(again, 2).when(F.col("cut"), 3).otherwise(0)
    flagged = flagged.withColumn("fault", fault).withColumn("again", again)

    # Rows that agree in all of this are alike.
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("h1"), F.col("h2"), F.col("again")]
    initial = F.coalesce(F.try_element_at(F.create_map(F.lit("s"), F.lit(1), F.lit("u"), F.lit(2), F.lit("a"), F.lit(3)), F.left("role", F.lit(1))), F.lit(0))
    narrow = flagged.select("conv", "turn", "role", "h1", "h2", "again", "seq", initial.alias("initial"), F.col("fault").isin(1, 2).alias("gone"), (F.col("fault") == 3).alias("truncated"))
    ranged = narrow.repartitionByRange(F.col("conv").asc_nulls_first(), *order, "seq").sortWithinPartitions(F.col("conv").asc_nulls_first(), *order)
    conv = given.schema["conv"].dataType
    conv_arrow = df.select(conv_col).limit(0).toArrow().schema.field(0).type
    spans = ranged.select("conv", "initial", "gone", "truncated").mapInArrow(span_rows(conv_arrow), f"conv {conv.simpleString()}, part int, costs array<long>, audits array<string>")

    own = {"part": "int", "costs": "array<long>", "audits": "array<string>"}
    theirs = {"turn": "long", "role": "string", "text": "string", "fault": "int", "h1": "long", "h2": "long", "again": "boolean"}
    none = {name: F.lit(None).cast(kind).alias(name) for name, kind in (own | theirs).items()}
    cells = spans.select("conv", F.lit(CELL).alias("kind"), *own, *(none[c] for c in theirs))
    after = flagged.select("conv", F.lit(ROW).alias("kind"), *(none[c] for c in own), *theirs)
    dropped = given.filter("dropped").select("conv", F.lit(GONE).alias("kind")).distinct().select("*", *none.values())
    together = cells.unionByName(after).unionByName(dropped).repartition("conv").sortWithinPartitions("conv", "kind", "part", *order)
    together = together.select("conv", "kind", "costs", "audits", "turn", "role", F.encode("text", "UTF-8").alias("text"), "fault")
    if rows:
        schema = f"conv {conv.simpleString()}, place long, turn long, role string, text binary, edit string"
    else:
        schema = f"conv {conv.simpleString()}, " + ", ".join(f"{c} {'long' if k < 6 else 'string'}" for k, c in enumerate(REPORT))
    return together.mapInArrow(sorted_pass(conv_arrow, rows), schema)


def repair_report(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", gone: str | None = None) -> DataFrame:
    """(<conv_col>, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256): a row per conversation.

    Rows come in order of turn, nulls first, and of role and content where turns agree. A null role or text counts as one
    space; rows without a conversation are one conversation. Each row's first fault counts: blank, its role and text seen earlier,
    or its last character beyond white space none of ``.!?``. ``gaps`` are turn numbers missing between the first and the
    last, ``illegal`` neighbours whose roles' initials are none of su, ua, au. ``repaired_sha256`` is of the repaired
    ``role:text`` lines. Rows marked in the boolean column ``gone`` are not there, but their conversations are reported:
    one without rows has zeros, an empty audit and the digest of nothing. An empty table gives none.
    """
    return _passed(df, False, conv_col, turn_col, role_col, text_col, gone).withColumnRenamed("conv", conv_col)


def repaired_turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", gone: str | None = None) -> DataFrame:
    """(<conv_col>, place, <turn_col>, role, text, edit): the repaired rows, places from 0; inserted rows have no turn."""
    found = _passed(df, True, conv_col, turn_col, role_col, text_col, gone)
    return found.select(F.col("conv").alias(conv_col), "place", F.col("turn").alias(turn_col), F.col("role").alias(role_col), F.decode("text", "UTF-8").alias(text_col), "edit")

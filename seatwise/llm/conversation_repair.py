"""Repairing the structure of conversations by iterative-deepening A*.

A conversation is well formed if its roles spell ``(s?(ua)+)?`` by their initials. Each row
has at most one fault, the first that holds: blank (no black character), duplicate (role and
text stood in an earlier row), truncated (the last black character is not one of ``.!?``).
Edits run over the rows in order: Delete costs 3 and is required for blank and duplicate
rows; Insert, anywhere, an empty turn of user or assistant costs 2; Keep costs nothing;
Rerole to user or assistant costs 2; an undeleted truncated row adds 1.

``search`` finds the cheapest edits, of several the first in ASCII order (D, I, K, R): a
depth-first search in that order under a growing cost bound, with a table of the states that
failed and of what they need at least. The first accepting path is the answer.

The rows of a conversation are sorted by Spark within the partition that has it and read as
a stream, twice: first each row counts as two small numbers, from which the edits follow, then
the repaired text is digested row by row. So a task holds some small numbers per row of the
longest conversation, never its texts; earlier equal rows are found by a window over (conversation,
role, digest of the text), which a long conversation does not keep in one task.

Defined results: a null text or role is one blank. Rows sort by turn, nulls first, then
role, then text; repeated rows are duplicates. A role's initial is its first character; a row
with the empty role has none and fits nowhere. A null conv_id is a conversation. One without
rows has zeros, empty audit and the digest of nothing. An empty table gives an empty
result. Very long texts pass through as they are. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Faults of a row.
SOUND, TRUNCATED, DUPLICATE, BLANK = range(4)
#: Costs of the edits, and of a truncated row that stays.
DELETE, INSERT, REROLE, STAYS_TRUNCATED = 3, 2, 2, 1

#: States of the pattern: nothing yet, after the system turn, after a user's, after an
#: assistant's; by state the roles that may follow.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = ({"s": _SYSTEM, "u": _USER}, {"u": _USER}, {"a": _ASSISTANT}, {"u": _USER})
#: The turn that Insert and Rerole make, by state.
_MADE = ((_USER, "user"), (_USER, "user"), (_ASSISTANT, "assistant"), (_USER, "user"))
_DONE = (_START, _ASSISTANT)

_BLACK = r"[^\x20\x09-\x0D]"
_BROKEN_OFF = r"(?s)[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z"


def _row_edits(initial: str, fault: int, state: int) -> list[tuple[str, int, int]]:
    """Edits that consume a row in a state, in ASCII order: letter, cost, next state."""
    edits = [("D", DELETE, state)]
    if fault in (SOUND, TRUNCATED):
        extra = STAYS_TRUNCATED if fault == TRUNCATED else 0
        if initial in _NEXT[state]:
            edits.append(("K", extra, _NEXT[state][initial]))
        edits.append(("R", REROLE + extra, _MADE[state][0]))
    return edits


def lower_bounds(rows: list[tuple[str, int]], segment: int) -> list[list[int]]:
    """For each row and state the least cost of the rest, the state forgotten at the first
    row of every ``segment``: never more than the true cost, and short of it by a little
    per segment."""
    ends = [0 if state in _DONE else None for state in range(4)]

    def with_inserts(costs: list[int | None]) -> list[int]:
        known = [10 ** 9 if c is None else c for c in costs]
        for _ in range(3):
            known = [min(known[s], INSERT + known[_MADE[s][0]]) for s in range(4)]
        return known

    bounds = [with_inserts(ends)]
    for i in range(len(rows) - 1, -1, -1):
        after = bounds[-1]
        here = with_inserts([
            min(cost + after[state_after] for _, cost, state_after in _row_edits(*rows[i], state))
            for state in range(4)])
        bounds.append([min(here)] * 4 if i % segment == 0 and i else here)
    return bounds[::-1]


def search(rows: list[tuple[str, int]], segment: int | None = None) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of rows given as (role's initial, fault)."""
    n = len(rows)
    segment = segment or max(4, n // 32)
    needs = lower_bounds(rows, segment)
    bound = needs[0][_START]
    while True:
        # A frame: row, state, cost so far, edits still open, least need seen below.
        path: list[str] = []
        frames = [_frame(rows, 0, _START, 0)]
        while frames:
            row, state, cost, edits, least = frames[-1]
            if row == n and state in _DONE:
                return cost, "".join(path)
            for letter, price, row_after, state_after in edits:
                need = price + needs[row_after][state_after]
                if cost + need <= bound:
                    path.append(letter)
                    frames.append(_frame(rows, row_after, state_after, cost + price))
                    break
                frames[-1][4] = least = min(least, need)
            else:
                # Failed: from here at least this much more than the bound allows.
                needs[row][state] = max(needs[row][state], least)
                frames.pop()
                if frames:
                    letter = path.pop()
                    above = frames[-1]
                    price = cost - above[2]
                    above[4] = min(above[4], price + needs[row][state])
        bound = needs[0][_START]


def _frame(rows, row, state, cost):
    if row < len(rows):
        edits = [(letter, price, row + 1, after)
                 for letter, price, after in _row_edits(*rows[row], state)]
        edits.insert(1, ("I", INSERT, row, _MADE[state][0]))
    else:
        edits = [("I", INSERT, row, _MADE[state][0])]
    return [row, state, cost, iter(edits), 10 ** 9]


def _blank_for_null(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damage(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """conv_id, turn, role, text of all rows after the damage, and ``gone``, which marks the
    dropped ones. The damage of a row follows from the crc32 of its id and turn."""
    kind = F.crc32(F.concat(_blank_for_null(conv_id), F.lit(":"), _blank_for_null(turn))
                   .cast("binary")) % 20
    kept = rows.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        F.when(kind == 4, "user").otherwise(_blank_for_null(role)).alias("role"),
        F.when(kind == 1, "").when(
            kind == 2, F.regexp_replace(_blank_for_null(text), "[.!?]", ""))
        .otherwise(_blank_for_null(text)).alias("text"),
        (kind == 0).alias("gone"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
        .alias("_copy"),
    )
    return kept.drop("_copy")


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` of ``damage`` with their ``initial`` and ``fault``."""
    same = Window.partitionBy("conv_id", "role", F.sha2(F.col("text").cast("binary"), 256), "gone")
    again = F.row_number().over(same.orderBy(F.col("turn").asc_nulls_first())) > 1
    fault = (
        F.when(~F.col("text").rlike(_BLACK), BLANK).when(again, DUPLICATE)
        .when(F.col("text").rlike(_BROKEN_OFF), TRUNCATED).otherwise(SOUND))
    return rows.withColumns({"initial": F.substring("role", 1, 1), "fault": fault})


#: The order of a conversation's rows, nulls first. Of equal rows the duplicate comes later.
_ORDER = ("turn", "role", "text", "fault")


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *first, *_ORDER)


def _runs(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    """(conv_id, the columns' values, first row of its conversation) of every row."""
    before: object = _runs
    for batch in batches:
        ids = batch.column("conv_id").to_pylist()
        for conv, *values in zip(ids, *(batch.column(c).to_pylist() for c in columns), strict=True):
            yield conv, values, conv != before or before is _runs
            before = conv


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
        schema=schema)


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class _Tally:
    """What the first reading keeps of one conversation."""

    def __init__(self, conv):
        self.conv, self.rows, self.turns = conv, [], 0
        self.low = self.high = None

    def add(self, turn, initial, fault):
        if turn is not None:
            if turn != self.high:
                self.turns += 1
            if self.low is None:
                self.low = turn
            self.high = turn
        self.rows.append(_CODES.setdefault((initial, fault), (initial, fault)))

    def result(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        found = [sum(fault == kind for _, fault in self.rows)
                 for kind in (BLANK, DUPLICATE, TRUNCATED)]
        pairs = zip(self.rows, self.rows[1:], strict=False)
        illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in pairs)
        cost, audit = search(self.rows)
        return (self.conv, gaps, *found, illegal, cost, audit)


#: One tuple for all rows of the same initial and fault.
_CODES: dict[tuple[str, int], tuple[str, int]] = {}


def _plan(batches):
    def found():
        tally = None
        for conv, (turn, gone, initial, fault), new in _runs(
                batches, ["turn", "gone", "initial", "fault"]):
            if new:
                if tally is not None:
                    yield tally.result()
                tally = _Tally(conv)
            if not gone:
                tally.add(turn, initial, fault)
        if tally is not None:
            yield tally.result()

    fields = [("conv_id", pa.int64()), *((c, pa.int64()) for c in _COUNTS), ("audit", pa.string())]
    yield from _batches(found(), pa.schema(fields))


class _Digest:
    """The repaired text of one conversation, digested as its rows come by."""

    def __init__(self, plan):
        self.plan, self.audit, self.at, self.state = plan, plan["audit"], 0, _START
        self.hash, self.empty = hashlib.sha256(), True

    def _write(self, role, text):
        if not self.empty:
            self.hash.update(b"\n")
        self.hash.update(f"{role}:{text}".encode())
        self.empty = False

    def _inserts(self):
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.state, role = _MADE[self.state]
            self._write(role, "")
            self.at += 1

    def add(self, role, text):
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = _NEXT[self.state][role[0]]
            self._write(role, text)
        elif edit == "R":
            self.state, role = _MADE[self.state]
            self._write(role, text)

    def result(self) -> tuple:
        self._inserts()
        return (*(self.plan[c] for c in ("conv_id", *_COUNTS, "audit")), self.hash.hexdigest())


def _apply(batches):
    def found():
        digest = None
        for _, (plan, role, text), _ in _runs(batches, ["plan", "role", "text"]):
            if plan is not None:
                if digest is not None:
                    yield digest.result()
                digest = _Digest(plan)
            else:
                digest.add(role, text)
        if digest is not None:
            yield digest.result()

    fields = [("conv_id", pa.int64()), *((c, pa.int64()) for c in _COUNTS), ("audit", pa.string()),
              ("repaired_sha256", pa.string())]
    yield from _batches(found(), pa.schema(fields))


_PLANNED = "conv_id bigint, " + ", ".join(f"{c} bigint" for c in _COUNTS) + ", audit string"


def repair(rows: DataFrame, store: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """One row per conversation of ``rows`` (from ``damage``, or with its columns): counts of
    faults, the cheapest edits, and the digest of the repaired ``role:text`` lines."""
    rows = rows.withColumns({
        "conv_id": F.col("conv_id").cast("long"), "turn": F.col("turn").cast("long")})
    known = store(faults(rows), "faults")
    codes = _in_order(known).select("conv_id", "turn", "gone", "initial", "fault")
    plans = store(codes.mapInArrow(_plan, _PLANNED), "plans")
    lines = known.filter(~F.col("gone")).select(
        "conv_id", F.lit(1).alias("_kind"), "turn", "role", "text", "fault")
    heads = plans.select(
        "conv_id", F.lit(0).alias("_kind"), F.struct(*plans.columns).alias("plan"))
    both = heads.unionByName(lines, allowMissingColumns=True)
    return _in_order(both, "_kind").select("conv_id", "plan", "role", "text").mapInArrow(
        _apply, _PLANNED + ", repaired_sha256 string")

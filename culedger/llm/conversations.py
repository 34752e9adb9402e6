"""Conversation structure repair by secondary-sorted streaming (operator 11).

A conversation's role initials shall read ``(s?(ua)+)?``. The cheapest edits
that make them so are found by dynamic programming over (row, state of that
pattern): Keep 0, Rerole to user or assistant 2, Delete 3 (required for blank
and duplicate rows), Insert an empty user or assistant row 2; a truncated row
that is not deleted adds 1. Of equally cheap edits, those whose initials are
ASCII-least win.

1. Rows are dealt by conversation, once. Within a partition Spark's sort brings
   equal (role, text) together, which numbers repeats, and then the rows of a
   conversation into order of turn. Both sorts spill; nothing else grows.
2. ``mapInPandas`` streams the sorted rows. A conversation may run over any
   number of Arrow batches: its state is carried from one to the next.
3. What the program decides by is one byte a row (initial, fault). When a
   conversation ends, the bytes are walked backwards and each is joined by one
   byte, the number of the cost vector behind it: vectors less their minimum
   are few, so a step is a look-up, and the pair of bytes is the backpointer of
   all four states. A walk forwards then emits the edits next to the rows.
4. Rows and backpointers of a conversation over ``spool`` bytes go to a
   temporary file of the task that is gone when the conversation is. An
   executor that is lost takes only its running tasks along: Spark repeats
   them from the shuffle.

A conversation stays whole in one task, as the method says: its digest hashes
its rows one after the other. The task's memory does not grow with it.

Order within a conversation: turn (nulls first), then role, then text. Nulls:
a null role or text is one space (initial and text blank); rows whose conv_id
is null are one conversation. A role's initial is its first character. Empty
and blank texts are ``blank`` and deleted; repeated rows are ``duplicate``.
Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Costs, faults, and the blanks and ends of a text.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
FAULTS = ("", "blank", "duplicate", "truncated")
BLANKS, ENDS = " \t\n\x0b\x0c\r", ".!?"
#: Bytes of rows that a conversation keeps in memory, and rows of a block of
#: its backpointers.
SPOOL, BLOCK = 16 << 20, 1 << 18
#: Rows that are handed back to Spark at once.
BATCH = 4096

# States of the pattern: 0 nothing, 1 after s, 2 after u, 3 after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: The state after the only one of u and a that may come next, and its role.
NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
ROLE = ("user", "user", "assistant", "user")
FAR = 1 << 20


class _Costs:
    """Cost vectors (the cheapest rest from each state) by number, and the step
    over a row, each worked out once."""

    def __init__(self):
        self.vectors: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self.steps: dict[tuple[int, int], tuple] = {}
        self.end, _ = self._number(self._inserted([0, FAR, FAR, 0]))

    @staticmethod
    def _inserted(v: list[int]) -> list[int]:
        for _ in range(3):
            v = [min(v[q], INSERT + v[NEXT[q]]) for q in range(4)]
        return v

    def _number(self, v: list[int]) -> tuple[int, int]:
        low = min(v)
        key = tuple(x - low for x in v)
        if key not in self.numbers:
            self.numbers[key] = len(self.vectors)
            self.vectors.append(key)
        return self.numbers[key], low

    @staticmethod
    def _kept(initial: int, q: int) -> int | None:
        """The state after a row with this initial (0 other, 1 s, 2 u, 3 a)."""
        if initial == 1:
            return AFTER_S if q == START else None
        return NEXT[q] if initial and NEXT[q] == initial else None

    def step(self, after: int, row: int) -> tuple[int, int, tuple]:
        """(number of the vector before the row, what was taken off it, for each
        state: the edits' initials up to and with this row's, and the state
        that they lead to)."""
        known = self.steps.get((after, row))
        if known:
            return known
        initial, fault = row & 3, FAULTS[row >> 2]
        rest = self.vectors[after]
        extra = TRUNCATED if fault == "truncated" else 0
        own = []
        for q in range(4):
            can = [(DELETE + rest[q], "D", q)]
            if fault not in ("blank", "duplicate"):
                kept = self._kept(initial, q)
                if kept is not None:
                    can.append((KEEP + extra + rest[kept], "K", kept))
                can.append((REROLE + extra + rest[NEXT[q]], "R", NEXT[q]))
            own.append(can)
        best = self._inserted([min(c for c, _, _ in can) for can in own])
        ways = []
        for q in range(4):
            letters, at = "", q
            while True:
                here = {letter: to for cost, letter, to in own[at] if cost == best[at]}
                if best[at] == INSERT + best[NEXT[at]]:
                    here["I"] = NEXT[at]
                letter = min(here)
                letters, at = letters + letter, here[letter]
                if letter != "I":
                    break
            ways.append((letters, at))
        number, low = self._number(best)
        self.steps[after, row] = number, low, tuple(ways)
        return self.steps[after, row]

    def rest(self, q: int) -> tuple[str, int]:
        """Inserts after the last row, and the state that they lead to."""
        letters, v = "", self.vectors[self.end]
        while v[q]:
            letters, q = letters + "I", NEXT[q]
        return letters, q


class _Spool:
    """Rows in order; beyond ``limit`` bytes of text they are in a file."""

    def __init__(self, limit: int):
        self.limit, self.rows, self.size, self.file = limit, [], 0, None

    def add(self, row: tuple) -> None:
        self.rows.append(row)
        self.size += len(row[3]) + len(row[4]) + 64
        if self.size >= self.limit:
            self.file = self.file or tempfile.TemporaryFile()
            pickle.dump(self.rows, self.file)
            self.rows, self.size = [], 0

    def __iter__(self) -> Iterator[tuple]:
        if self.file:
            last = self.file.tell()
            self.file.seek(0)
            while self.file.tell() < last:
                yield from pickle.load(self.file)
        yield from self.rows

    def close(self) -> None:
        if self.file:
            self.file.close()


class _Backpointers:
    """One byte a row, in blocks; a block that is full goes to a file, and comes
    back with a second byte for each row."""

    def __init__(self, block: int):
        self.block, self.tail, self.full, self.file = block, bytearray(), 0, None

    def add(self, row: int) -> None:
        self.tail.append(row)
        if len(self.tail) == self.block:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.seek(2 * self.full * self.block)
            self.file.write(self.tail)
            self.tail, self.full = bytearray(), self.full + 1

    def backwards(self, costs: _Costs) -> tuple[int, int, bytearray]:
        """Walk back over all rows: (number of the first vector, total taken
        off, numbers for the rows in memory); those of full blocks are written
        behind their rows."""
        steps = costs.steps
        total, now, tail = 0, costs.end, bytearray(len(self.tail))
        for k in range(self.full, -1, -1):
            rows, numbers = self.tail, tail
            if k < self.full:
                self.file.seek(2 * k * self.block)
                rows, numbers = self.file.read(self.block), bytearray(self.block)
            for i in range(len(rows) - 1, -1, -1):
                numbers[i] = now
                s = steps.get((now, rows[i])) or costs.step(now, rows[i])
                now = s[0]
                total += s[1]
            if k < self.full:
                self.file.seek((2 * k + 1) * self.block)
                self.file.write(numbers)
        return now, total, tail

    def forwards(self, tail: bytearray) -> Iterator[tuple[int, int]]:
        for k in range(self.full):
            self.file.seek(2 * k * self.block)
            both = self.file.read(2 * self.block)
            yield from zip(both[: self.block], both[self.block :], strict=True)
        yield from zip(self.tail, tail, strict=True)

    def close(self) -> None:
        if self.file:
            self.file.close()


def _classed(role: str, text: str, copy: int) -> int:
    """A row's byte: its role's initial, and its first fault."""
    solid = text.rstrip(BLANKS)
    if not solid:
        fault = 1
    elif copy > 1:
        fault = 2
    else:
        fault = 0 if solid[-1] in ENDS else 3
    return "sua".find(role[:1] or "?") + 1 | fault << 2


def _repaired(rows: _Spool, back: _Backpointers, costs: _Costs) -> Iterator[tuple]:
    """The conversation's rows with their edits, inserted rows among them."""
    first, total, tail = back.backwards(costs)
    cost = total + costs.vectors[first][START]
    q = START
    for (conv, turn, dated, role, text, _), (row, after) in zip(rows, back.forwards(tail), strict=True):
        letters, to = costs.step(after, row)[2][q]
        for _ in letters[:-1]:
            yield conv, "I", None, "", None, ROLE[q], "", cost
            q = NEXT[q]
        edit = letters[-1]
        yield conv, edit, turn if dated else None, FAULTS[row >> 2], role, ROLE[q] if edit == "R" else role, text, cost
        q = to
    for _ in costs.rest(q)[0]:
        yield conv, "I", None, "", None, ROLE[q], "", cost
        q = NEXT[q]


def _keys(batch: pd.DataFrame) -> list[str | None]:
    """The rows' conversations; null, which pandas may hold as NaN, is None."""
    return [c if isinstance(c, str) else None for c in batch["conv"]]


def _streamed(spool: int, block: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        costs, out, now = _Costs(), [], None
        rows = back = None

        def ended():
            try:
                yield from _repaired(rows, back, costs)
            finally:
                rows.close()
                back.close()

        def frame():
            done = pd.DataFrame(out, columns=COLUMNS)
            done["turn"] = pd.array(done["turn"], "Int64")
            out.clear()
            return done

        for batch in batches:
            for row in zip(_keys(batch), *(batch[c] for c in INPUT[1:]), strict=True):
                if rows is None or row[0] != now:
                    if rows is not None:
                        for r in ended():
                            out.append(r)
                            if len(out) >= BATCH:
                                yield frame()
                    now, rows, back = row[0], _Spool(spool), _Backpointers(block)
                rows.add(row)
                back.add(_classed(row[3], row[4], row[5]))
        if rows is not None:
            for r in ended():
                out.append(r)
                if len(out) >= BATCH:
                    yield frame()
        if out:
            yield frame()

    return run


INPUT = ["conv", "turn", "dated", "role", "text", "copy"]
COLUMNS = ["conv", "edit", "turn", "fault", "was", "role", "text", "cost"]
SCHEMA = "conv string, edit string, turn long, fault string, was string, role string, text string, cost long"


def repair(conversations: DataFrame, spool: int = SPOOL, block: int = BLOCK) -> DataFrame:
    """The rows of ``conversations`` (conv_id, turn, role, text) with the edits
    that repair them, each conversation's together and in order: conv (the
    conv_id as text), edit (K, R, D, or I for a row that was not there), turn,
    fault, was (the role before), role, text (a deleted row keeps its own) and
    cost (of all the conversation's edits)."""
    held = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = conversations.select(F.col("conv_id").cast("string").alias("conv"), F.col("turn").isNotNull().alias("dated"), F.coalesce(F.col("turn").cast("long"), F.lit(0).cast("long")).alias("turn"), held("role"), held("text"))
    rows = rows.withColumn("same", F.xxhash64("role", "text")).repartition("conv")
    alike = Window.partitionBy("conv", "same", "role", "text").orderBy("dated", "turn")
    rows = rows.withColumn("copy", F.row_number().over(alike)).select(*INPUT)
    return rows.sortWithinPartitions("conv", "dated", "turn", "role", "text", "copy").mapInPandas(_streamed(spool, block), SCHEMA)


def _digested(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for each conversation, from its repaired rows in order."""
    done: list[tuple] = []
    now, seen = None, None

    def close():
        blank, duplicate, truncated = (seen["faults"].get(f, 0) for f in FAULTS[1:])
        gaps = seen["high"] - seen["low"] + 1 - seen["turns"] if seen["turns"] else 0
        done.append((now, gaps, blank, duplicate, truncated, seen["illegal"], seen["cost"], "".join(seen["audit"]), seen["hash"].hexdigest()))

    for batch in batches:
        batch["turn"] = batch["turn"].astype("Int64")
        for conv, edit, turn, fault, was, role, text, cost in zip(_keys(batch), *(batch[c].array for c in COLUMNS[1:]), strict=True):
            if seen is None or conv != now:
                if seen is not None:
                    close()
                    if len(done) >= BATCH:
                        yield pd.DataFrame(done, columns=DIGEST)
                        done.clear()
                now, seen = conv, {"low": None, "high": None, "turns": 0, "faults": {}, "illegal": 0, "cost": int(cost), "audit": [], "hash": hashlib.sha256(), "was": None, "any": False}
            seen["audit"].append(edit)
            if edit != "I":
                if turn is not pd.NA:
                    if seen["turns"] == 0:
                        seen["low"] = int(turn)
                    seen["turns"] += seen["high"] != turn
                    seen["high"] = int(turn)
                if fault:
                    seen["faults"][fault] = seen["faults"].get(fault, 0) + 1
                seen["illegal"] += seen["was"] is not None and seen["was"] + was[:1] not in ("su", "ua", "au")
                seen["was"] = was[:1]
            if edit != "D":
                if seen["any"]:
                    seen["hash"].update(b"\n")
                seen["hash"].update(f"{role}:{text}".encode())
                seen["any"] = True
    if seen is not None:
        close()
    if done:
        yield pd.DataFrame(done, columns=DIGEST)


DIGEST = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
DIGEST_SCHEMA = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def digest(repaired: DataFrame) -> DataFrame:
    """One row for each conversation of :func:`repair`'s rows, read in the order
    and the partitions that it left them in: counts of faults and gaps, the
    edits' initials, and the SHA-256 of the repaired rows."""
    return repaired.mapInPandas(_digested, DIGEST_SCHEMA)


def fault_code(conv_id: str = "conv_id", turn: str = "turn") -> Column:
    """crc32 of ``conv_id:turn`` modulo 20 (a null is one space)."""
    held = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return (F.crc32(F.concat(held(conv_id), F.lit(":"), held(turn)).cast("binary")) % 20).cast("int")


def damage(conversations: DataFrame) -> DataFrame:
    """``conversations`` with planted faults, by :func:`fault_code`: 0 drops the
    row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes its
    role user. Null roles and texts are one space."""
    held = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", held("role").alias("role"), held("text").alias("text"), fault_code().alias("code")).where("code != 0")
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    role = F.when(F.col("code") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("code") == 3, 2).otherwise(1))).alias("_")).drop("_")


def audit(conversations: DataFrame) -> DataFrame:
    """A row for each conv_id of ``conversations``: its rows after
    :func:`damage`, repaired and digested."""
    kind = conversations.schema["conv_id"].dataType
    rows = digest(repair(damage(conversations)))
    every = conversations.select("conv_id", F.col("conv_id").cast("string").alias("own")).distinct()
    joined = every.join(rows, F.col("own").eqNullSafe(F.col("conv")), "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in DIGEST[1:7]]
    return joined.select(F.col("conv_id").cast(kind), *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))

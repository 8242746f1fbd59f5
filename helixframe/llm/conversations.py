"""Conversation structure repair: the cheapest edits that make the turns alternate.

The roles of a repaired conversation are an optional system turn and then pairs of user and
assistant, or nothing. Turns are aligned to that string of each feasible length by
Wagner-Fischer: cell (i, r) is the least cost of the turns from i on against the last r roles, and as
the last r roles are the same in all lengths, one table serves them all. An incumbent, the cost of a repair
in one pass, bounds the table: only cells within Ukkonen's band, whose insertions
and deletions it can pay, are filled. The audits of all cheapest lengths are traced back and compared.

Keep costs 0, Rerole to user or assistant 2, Delete 3 (blank and duplicate turns must go), Insert
of an empty user or assistant turn 2; a truncated turn that stays costs 1 more. Of equally cheap audits the
least in ASCII counts. Turns are taken by turn number, nulls first, those of one
number by role and text. Null roles and texts are one space. A null conv_id is a conversation of
its own. Role initials count as they stand, in either case. A conversation is one value of the result, as its hash
is over all its text in order, so its turns are in one task; conversations are spread over tasks
and none waits for another. The table is held in blocks of rows, of which all but the first rows are made anew when traced.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
SPACE = " \t\n\x0b\x0c\r"
LEGAL = {"su", "ua", "au"}
ROLE = {"u": "user", "a": "assistant"}
_FAR = 1 << 30

#: Rows of the table that are held at once while tracing back.
BLOCK = 256


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, fate): rows with what befalls them, 0 to 4 of twenty; nulls are one space.

    0 drops the row, 1 empties its text, 2 removes its full stops, exclamation and question
    marks, 3 repeats it, 4 makes it the user's.
    """
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = (F.crc32(F.concat(cell("conv_id"), F.lit(":"), cell("turn"))) % 20).cast("int")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), cell("role").alias("role"), cell("text").alias("text"), fate.alias("fate"))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.withColumn("text", text).withColumn("role", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")))


def faults(turns: list[tuple[str, str]]) -> list[str | None]:
    """The first fault of each turn: blank, duplicate, truncated or none."""
    seen, out = set(), []
    for turn in turns:
        end = turn[1].rstrip(SPACE)
        out.append("blank" if not end else "duplicate" if turn in seen else "truncated" if end[-1] not in ".!?" else None)
        seen.add(turn)
    return out


class Alignment:
    """The table of one conversation: initials of its turns, which must go, and which cost more if they stay."""

    def __init__(self, initials: str, gone: list[bool], extra: list[int]):
        self.initials, self.gone, self.extra = initials, gone, extra
        n = self.n = len(initials)
        # Turns from i on that need not go.
        self.left = [0] * (n + 1)
        for i in reversed(range(n)):
            self.left[i] = self.left[i + 1] + (not gone[i])
        slack = self._incumbent() - DELETE * sum(gone) - sum(e for e, g in zip(extra, gone) if not g)
        self.under, self.over = slack // (DELETE - TRUNCATED) + 1, slack // INSERT + 1
        self.near: dict[int, np.ndarray] = {}
        self._fill()

    def _incumbent(self) -> int:
        """The cost of a repair in one pass: what fits stays, what does not is given the role that is due."""
        cost, due = 0, "u"
        start = next((i for i in range(self.n) if not self.gone[i]), None)
        for i, c in enumerate(self.initials):
            if self.gone[i]:
                cost += DELETE
            elif i == start and c == "s" and sum(not g for g in self.gone) > 1:
                cost += self.extra[i]
            else:
                cost += (REROLE if c != due else KEEP) + self.extra[i]
                due = "a" if due == "u" else "u"
        return cost + (INSERT if due == "a" else 0)

    def _lengths(self, i: int) -> tuple[int, int]:
        """The band of row i: from this number of roles to that."""
        return max(0, self.left[i] - self.under), self.left[i] + self.over

    def _row(self, i: int, after: np.ndarray) -> np.ndarray:
        """Row i of the table from row i + 1; cells outside the band are far."""
        low, high = self._lengths(i)
        base, below = self._lengths(i + 1)[0], len(after)
        r = np.arange(low, high + 1)

        def at(x: np.ndarray) -> np.ndarray:
            ok = (x >= base) & (x < base + below)
            return np.where(ok, after[np.clip(x - base, 0, below - 1)], _FAR)

        cost = at(r) + DELETE
        if not self.gone[i]:
            c = self.initials[i]
            fits = np.where(r % 2 == 0, c == "u", c == "a")
            cost = np.minimum(cost, np.where(r > 0, at(r - 1) + np.where(fits, KEEP, REROLE) + self.extra[i], _FAR))
        return np.minimum.accumulate(cost - INSERT * r) + INSERT * r

    def _last(self) -> np.ndarray:
        low, high = self._lengths(self.n)
        return INSERT * np.arange(low, high + 1)

    def _fill(self) -> None:
        row = self._last()
        rows = {self.n: row}
        system = [_FAR] * (self.n + 1)
        for i in reversed(range(self.n)):
            # With the system turn still to come, turns before it can only go.
            system[i] = min(system[i + 1] + DELETE, self._after_system(i + 1, row) + self.extra[i] if self.initials[i] == "s" and not self.gone[i] else _FAR)
            row = self._row(i, row)
            if i % BLOCK == 0 or i < BLOCK:
                rows[i] = row
        self.rows, self.system = rows, system

    def _after_system(self, i: int, row: np.ndarray) -> int:
        low = self._lengths(i)[0]
        even = row[max(2, low + low % 2) - low :: 2]
        return int(even.min()) if len(even) else _FAR

    def row(self, i: int) -> np.ndarray:
        """Row i; rows of a block that is not held are made from the first row after it."""
        if i in self.rows:
            return self.rows[i]
        if i not in self.near:
            end = min((i // BLOCK + 1) * BLOCK, self.n)
            row, self.near = self.rows[end], {}
            for j in reversed(range(i, end)):
                row = self.near[j] = self._row(j, row)
        return self.near[i]

    def cell(self, i: int, r: int) -> int:
        row, low = self.row(i), self._lengths(i)[0]
        return int(row[r - low]) if low <= r < low + len(row) else _FAR

    def audit(self, i: int, r: int) -> str:
        """The least of the cheapest audits of the turns from i on against the last r roles."""
        out = []
        while i < self.n or r:
            cost = self.cell(i, r)
            if i < self.n and DELETE + self.cell(i + 1, r) == cost:
                out.append("D")
                i += 1
            elif r and INSERT + self.cell(i, r - 1) == cost:
                out.append("I")
                r -= 1
            else:
                out.append("K" if self.initials[i] == "au"[r % 2 == 0] else "R")
                i, r = i + 1, r - 1
        return "".join(out)

    def best(self) -> tuple[int, str]:
        """The least cost and, of all lengths and both beginnings that reach it, the least audit."""
        row, low = self.row(0), self._lengths(0)[0]
        even = {low + k: int(c) for k, c in enumerate(row) if (low + k) % 2 == 0}
        cost = min([*even.values(), self.system[0]])
        audits = [self.audit(0, r) for r, c in even.items() if c == cost]
        if self.system[0] == cost:
            i = 0
            while DELETE + self.system[i + 1] == self.system[i]:
                i += 1
            rest, base = self.row(i + 1), self._lengths(i + 1)[0]
            least = self._after_system(i + 1, rest)
            audits += ["D" * i + "K" + self.audit(i + 1, base + k) for k, c in enumerate(rest) if (base + k) % 2 == 0 and base + k >= 2 and c == least]
        return cost, min(audits)


def repaired(turns: list[tuple[str, str]], audit: str) -> list[tuple[str, str]]:
    """The turns that an audit leaves, with their roles."""
    length = sum(x != "D" for x in audit)
    due = itertools.chain("s" if length % 2 else "", itertools.cycle("ua"))
    rows, out = iter(turns), []
    for x in audit:
        role, text = ("", "") if x == "I" else next(rows)
        if x != "D":
            to = next(due)
            out.append((role if x == "K" else ROLE[to], text))
    return out


def examine(turns: list[tuple[int | None, str, str]]) -> tuple:
    """gaps, blank, duplicate, truncated, illegal, cost, audit and the repaired turns of rows (turn, role, text) in order."""
    if not turns:
        return 0, 0, 0, 0, 0, 0, "", []
    said = [(role, text) for _, role, text in turns]
    numbers = {t for t, _, _ in turns if t is not None}
    found = faults(said)
    initials = [role[:1] for role, _ in said]
    illegal = sum(a + b not in LEGAL for a, b in itertools.pairwise(initials))
    # An empty role has an initial that fits nowhere.
    table = Alignment("".join(c or "\0" for c in initials), [f in ("blank", "duplicate") for f in found], [TRUNCATED * (f == "truncated") for f in found])
    cost, audit = table.best()
    count = lambda kind: sum(f == kind for f in found)
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    return gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, repaired(said, audit)


_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_SCHEMA = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()), ("turns", _TURNS)])


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, turns) of every conversation.

    ``conversations`` has conv_id, turn, role, text, and may have ``fate``, of which 0 drops a row and 3 repeats it.
    ``turns`` are the repaired turns, an array of (role, text). A conversation without rows has zeros and empty values.
    """
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    fate = F.col("fate").cast("int") if "fate" in conversations.columns else F.lit(None).cast("int")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), cell("role"), cell("text"), fate.alias("fate"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        every = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for conv, group in itertools.groupby(every, lambda row: row[0]):
            turns = [row[1:4] for row in group for _ in range({0: 0, 3: 2}.get(row[4], 1))]
            *numbers, said = examine(turns)
            out.append((conv, *numbers, [{"role": r, "text": t} for r, t in said]))
            if len(out) >= 256 or len(turns) >= 256:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _SCHEMA)], schema=_SCHEMA)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _SCHEMA)], schema=_SCHEMA)

    numbers = ", ".join(f"{c} long" for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))
    return map_arrow(rows, run, f"conv_id long, {numbers}, audit string, turns array<struct<role:string,text:string>>")


def repair_digests(conversations: DataFrame) -> DataFrame:
    """The result of :func:`repair_conversations` with repaired_sha256, the hash of ``role:text`` lines, in place of the turns."""
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit(":"), x["text"])), "\n")
    return repair_conversations(conversations).withColumn("repaired_sha256", F.sha2(said, 256)).drop("turns")

"""Repair of conversation structure by lightest derivations.

A repaired conversation is nothing, or a system turn at most and then pairs of
a user and an assistant turn: role initials ``(s?(ua)+)?``. Rows may be kept,
given another role, deleted, and empty rows inserted, each at a cost.

Items are ``[i, s]``: the first ``i`` rows are dealt with, and the output stands
in state ``s`` of the pattern. Deductions are hyperedges with two antecedents,
an item and an edit of its next row::

    [i, s], edit(row i, symbol x)  |-  [i + 1, s x]        (keep, rerole)
    [i, s], delete(row i)          |-  [i + 1, s]
    [i, s], insert(x)              |-  [i, s x]

Their weights are pairs (cost, audit), ordered by cost, then by the audit's
ASCII order; a deduction adds the edit's cost and appends its letter. That is
superior (no conclusion is lighter than its item: costs aren't negative, and a
longer audit follows its prefix) and monotone within an item (two audits for
the same rows where one is a proper prefix of the other differ by inserted rows, so by
cost). So Knuth's agenda is exact: items are popped lightest first, and a
popped item is final.

Rows come sorted by conversation and turn and stream through a task. The agenda
runs over ``BLOCK`` rows at a time until the items at the block's end are
final, which are the axioms of the next block; the prefix that their audits
share can't change any more, so its rows are written and forgotten. What is held is
the undecided end of one conversation and its audit, which is a value of the
result. A digest over a conversation's text in order is sequential by itself, so
one conversation is one task's stream, but never held in memory as a whole.

Nulls count as one space (a null turn stays null and comes first); rows of one
turn follow each other by role, then text. Equal rows are repetitions: all but
the first are duplicates. Empty tables give no rows. Other columns are ignored.
A null conversation id is a conversation of its own.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import WHITE, ship

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLOCK = 32
#: Output states: nothing, after s, after u, after a pair; the symbols that may follow.
AFTER = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
DONE = (0, 3)
ROLES = {"u": "user", "a": "assistant"}

COUNTS = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def edits(role: str, fault: str) -> list[tuple[str, int, str]]:
    """(symbol or nothing, cost, letter) of the edits that a row allows."""
    allowed = [("", DELETE, "D")]
    if fault not in ("blank", "duplicate"):
        more = TRUNCATED if fault == "truncated" else 0
        allowed += [(role[:1], KEEP + more, "K"), ("u", REROLE + more, "R"), ("a", REROLE + more, "R")]
    return allowed


def lightest(axioms: dict[int, tuple[int, str]], rows: list[list[tuple[str, int, str]]], goals: tuple[int, ...], enough: int) -> dict[int, tuple[int, str]]:
    """The lightest (cost, audit) of the items ``[len(rows), s]``, ``s`` in ``goals``.

    ``axioms`` are the items at row 0. Ends when ``enough`` goals are final or
    nothing is left on the agenda.
    """
    agenda = [(cost, audit, 0, s) for s, (cost, audit) in axioms.items()]
    heapq.heapify(agenda)
    final: set[tuple[int, int]] = set()
    found: dict[int, tuple[int, str]] = {}
    while agenda:
        cost, audit, i, s = heapq.heappop(agenda)
        if (i, s) in final:
            continue
        final.add((i, s))
        if i == len(rows) and s in goals:
            found[s] = cost, audit
            if len(found) == enough:
                break
        for symbol, to in AFTER[s].items():
            if symbol in ROLES and (i, to) not in final:
                heapq.heappush(agenda, (cost + INSERT, audit + "I", i, to))
        if i < len(rows):
            for symbol, weight, letter in rows[i]:
                to = AFTER[s].get(symbol) if symbol else (s if letter == "D" else None)
                if to is not None and (i + 1, to) not in final:
                    heapq.heappush(agenda, (cost + weight, audit + letter, i + 1, to))
    return found


class Repair:
    """One conversation, row by row."""

    def __init__(self):
        self.items = {0: (0, "")}
        self.pending: list[tuple[str, str]] = []  # rows whose edits are undecided
        self.block: list[list[tuple[str, int, str]]] = []
        self.state = 0  # of what is written
        self.audit: list[str] = []
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.last: str | None = None
        self.low = self.high = self.turn = None
        self.turns = 0

    def add(self, turn: int | None, role: str, text: str, again: bool) -> Iterator[tuple[str, str, str]]:
        bare = text.rstrip(WHITE)
        fault = "blank" if not bare else "duplicate" if again else "truncated" if bare[-1] not in ".!?" else ""
        if fault:
            self.counts[fault] += 1
        if self.last is not None and self.last + role[:1] not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.last = role[:1]
        if turn is not None and turn != self.turn:
            self.low, self.high, self.turns, self.turn = turn if self.low is None else self.low, turn, self.turns + 1, turn
        self.pending.append((role, text))
        self.block.append(edits(role, fault))
        if len(self.block) == BLOCK:
            self.items = lightest(self.items, self.block, (0, 1, 2, 3), 4)
            self.block = []
            yield from self.decided(os.path.commonprefix([audit for _, audit in self.items.values()]))

    def end(self) -> Iterator[tuple[str, str, str]]:
        """The rest; afterwards ``items`` holds the goal alone."""
        self.items = lightest(self.items, self.block, DONE, 1)
        yield from self.decided(next(iter(self.items.values()))[1])

    def decided(self, letters: str) -> Iterator[tuple[str, str, str]]:
        """Write the rows of a prefix that all items share: (letter, role, text)."""
        self.items = {s: (cost, audit[len(letters) :]) for s, (cost, audit) in self.items.items()}
        self.audit.append(letters)
        at = 0
        for letter in letters:
            role, text = ("", "") if letter == "I" else self.pending[at]
            at += letter != "I"
            if letter == "D":
                continue
            if letter in "RI":
                symbol = "a" if self.state == 2 else "u"
                role = ROLES[symbol]
            self.state = AFTER[self.state][role[:1]]
            yield letter, role, text
        del self.pending[:at]

    def summary(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        cost = next(iter(self.items.values()))[0]
        return gaps, self.counts["blank"], self.counts["duplicate"], self.counts["truncated"], self.counts["illegal"], cost, "".join(self.audit)


def _ordered(turns: DataFrame, gone: str | None) -> DataFrame:
    """(conv_id, turn, role, text, again, gone) by conversation and turn; one shuffle."""
    rows = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), (F.col(gone) if gone else F.lit(False)).alias("gone"))
    told = rows.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256)).repartition("conv_id")
    same = W.partitionBy("conv_id", "gone", "role", "digest").orderBy(F.col("turn").asc_nulls_first())
    flagged = told.withColumn("again", F.row_number().over(same) > 1)
    return flagged.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "again").select("conv_id", "turn", "role", "text", "again", "gone")


def _by_conversation(batches: Iterator[pa.RecordBatch], write) -> Iterator[tuple]:
    """Feed sorted rows to one ``Repair`` after the other; ``write`` takes (conv, repair, its new rows, whether it ends)."""
    conv, repair = None, None
    for batch in batches:
        for k, turn, role, text, again, gone in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if repair is None or k != conv:
                if repair is not None:
                    yield from write(conv, repair, repair.end(), True)
                conv, repair = k, Repair()
            if not gone:
                yield from write(conv, repair, repair.add(turn, role, text, again), False)
    if repair is not None:
        yield from write(conv, repair, repair.end(), True)


def _buffered(rows: Iterator[tuple], fields: list[tuple[str, pa.DataType]], most: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])

    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield batch()
            held = []
    if held:
        yield batch()


def _key_type(turns: DataFrame) -> tuple[str, pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    kind = turns.schema["conv_id"].dataType
    return kind.simpleString(), to_arrow_type(kind)


def repaired_rows(turns: DataFrame, gone: str | None = None) -> DataFrame:
    """The repaired conversations as rows: (conv_id, place, edit, role, text).

    ``turns`` has conv_id, turn, role and text. Rows whose column ``gone`` (if
    one is named) is true are no part of their conversation.
    """
    ship(turns)
    named, arrow = _key_type(turns)
    fields = [("conv_id", arrow), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]

    def run(batches):
        place = [0]

        def write(conv, repair, rows, ends):
            for letter, role, text in rows:
                yield conv, place[0], letter, role, text
                place[0] += 1
            if ends:
                place[0] = 0

        yield from _buffered(_by_conversation(batches, write), fields)

    return _ordered(turns, gone).mapInArrow(run, f"conv_id {named}, place bigint, edit string, role string, text string")


def repair(turns: DataFrame, gone: str | None = None) -> DataFrame:
    """One row per conversation: its faults, the cheapest repair's cost and audit, and a digest of the repaired text.

    The digest is over ``role:text`` of the repaired rows, joined by newlines.
    A conversation without rows (all ``gone``) has zeros and an empty audit.
    """
    ship(turns)
    named, arrow = _key_type(turns)
    fields = [("conv_id", arrow), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()), ("repaired_sha256", pa.string())]

    def run(batches):
        def fresh():
            return [hashlib.sha256(), False]

        digest = fresh()

        def write(conv, repair, rows, ends):
            for _, role, text in rows:
                digest[0].update(("\n" if digest[1] else "").encode() + f"{role}:{text}".encode())
                digest[1] = True
            if ends:
                yield conv, *repair.summary(), digest[0].hexdigest()
                digest[:] = fresh()

        yield from _buffered(_by_conversation(batches, write), fields)

    return _ordered(turns, gone).mapInArrow(run, f"conv_id {named}, {COUNTS}")


def damage(turns: DataFrame) -> DataFrame:
    """Rows damaged by their key's checksum modulo 20: 0 gone, 1 emptied, 2 without ``.!?``, 3 twice, 4 role user."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    h = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), h.alias("h"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (F.col("h") == 0).alias("gone"), F.explode(F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))

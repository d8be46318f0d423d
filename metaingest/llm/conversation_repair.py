"""Conversation structure repair by a dynamic program over sorted turns.

Turns are repartitioned by conversation and sorted by turn within partitions; one
task then streams them through ``mapInPandas``. The cheapest edits that give the
role initials ``(s?(ua)+)?`` are found by a dynamic program with four states
(nothing written, system, user or assistant turn written last), which is carried
from one Arrow batch to the next.

For each state the program knows its cost beyond the least one and the rank of
its edits among those of the other states in ASCII order. There are few such
quadruples, so a step is looked up by quadruple and kind of turn, and the number
of the step is all that is kept of a turn: two bytes, which go to a file of the
task once there are ``SPILL`` of them. What a state has written is hashed as the
turns pass, so texts are not kept either. A conversation is one sequence and is
read by one task; its length costs time and two bytes a turn.
"""

from __future__ import annotations

import hashlib
import tempfile
from array import array
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Steps kept in memory for one conversation; further ones are spilled.
SPILL = 1 << 20

_SPACE = " \t\n\x0b\x0c\r"
_NOTHING, _SYSTEM, _USER, _ASSISTANT = range(4)
_ROLES = {_USER: "user", _ASSISTANT: "assistant"}
#: The state after a user or an assistant turn that may follow in each state.
_FOLLOWING = {_NOTHING: _USER, _SYSTEM: _USER, _USER: _ASSISTANT, _ASSISTANT: _USER}
#: Turns to insert at the end, so that the roles are complete.
_MISSING = {_NOTHING: 0, _SYSTEM: 2, _USER: 1, _ASSISTANT: 0}
_KEPT = {("s", _NOTHING): _SYSTEM, ("u", _NOTHING): _USER, ("u", _SYSTEM): _USER, ("u", _ASSISTANT): _USER, ("a", _USER): _ASSISTANT}
_DELETE, _REROLE, _INSERT, _TRUNCATED = 3, 2, 2, 1
#: What follows a state can follow any other one for at most so much more (a deleted
#: system turn and an inserted one), so a state that is dearer by more is of no use.
_WORTH = _DELETE + _INSERT


class Kind(NamedTuple):
    """What matters of a turn for the edits."""

    initial: str
    deleted: bool
    truncated: bool


class Move(NamedTuple):
    """How a state was reached: from which one, by which edits, and what they
    write before (``lead``) and of the turn itself."""

    before: int
    edits: str
    lead: bytes
    writes: str


class Step(NamedTuple):
    number: int
    cost: int
    state: tuple
    moves: tuple


#: A state is (cost beyond the least, rank of its edits), or None if it can't be reached.
_START = ((0, 0), None, None, None)


class _Program:
    """Steps by state and kind of turn, made when first met."""

    def __init__(self):
        self._steps: dict[tuple, Step] = {}
        self.moves: list[tuple] = []

    def step(self, state: tuple, kind: Kind) -> Step:
        found = self._steps.get((state, kind))
        if found is None:
            cost, after, moves = _advance(state, kind)
            found = self._steps[state, kind] = Step(len(self.moves), cost, after, moves)
            self.moves.append(moves)
        return found


@lru_cache(1)
def _program() -> _Program:
    return _Program()


def _inserted(state: int, count: int) -> tuple[int, bytes]:
    """The state after so many inserted turns, and their lines."""
    lines = b""
    for _ in range(count):
        following = _FOLLOWING[state]
        lines += (b"" if state == _NOTHING else b"\n") + _ROLES[following].encode() + b":"
        state = following
    return state, lines


def _advance(state: tuple, kind: Kind) -> tuple[int, tuple, tuple]:
    """Least cost of a turn's step, the state after it, and the move into each state."""
    # Edits of two states that have passed the same turns differ before either
    # ends, since both end with a turn's own edit. So a rank decides whatever
    # follows, and no other cheapest edits of a state need be kept.
    best: dict[int, tuple] = {}
    for before, known in enumerate(state):
        if known is None:
            continue
        cost, rank = known
        for count in range(3):
            at, lines = _inserted(before, count)
            options = [("D", _DELETE, at, "")]
            if not kind.deleted:
                extra = _TRUNCATED if kind.truncated else 0
                if (kind.initial, at) in _KEPT:
                    options.append(("K", extra, _KEPT[kind.initial, at], "turn"))
                options.append(("R", _REROLE + extra, _FOLLOWING[at], "text"))
            for letter, price, after, writes in options:
                lead = lines
                if writes and at != _NOTHING:
                    lead += b"\n"
                if writes == "text":
                    lead += _ROLES[after].encode() + b":"
                order = (cost + count * _INSERT + price, rank, "I" * count + letter)
                if after not in best or order < best[after][0]:
                    best[after] = (order, Move(before, order[2], lead, writes))
    least = min(order[0] for order, _ in best.values())
    best = {q: found for q, found in best.items() if found[0][0] - least <= _WORTH}
    ranked = sorted(best, key=lambda after: best[after][0][1:])
    after = tuple((best[q][0][0] - least, ranked.index(q)) if q in best else None for q in range(4))
    return least, after, tuple(best[q][1] if q in best else None for q in range(4))


class _Steps:
    """Numbers of the steps of a conversation, read from the last to the first."""

    def __init__(self):
        self._held, self._file, self._blocks = array("H"), None, 0

    def append(self, number: int) -> None:
        self._held.append(number)
        if len(self._held) == SPILL:
            self._file = self._file or tempfile.TemporaryFile()
            self._held.tofile(self._file)
            self._held, self._blocks = array("H"), self._blocks + 1

    def backwards(self) -> Iterator[array]:
        yield self._held[::-1]
        for block in reversed(range(self._blocks)):
            self._file.seek(block * SPILL * 2)
            held = array("H")
            held.fromfile(self._file, SPILL)
            yield held[::-1]

    def close(self) -> None:
        if self._file is not None:
            self._file.close()


class _Conversation:
    def __init__(self, key: str | None):
        self.key = key
        self.state, self.cost = _START, 0
        self.hashes = [hashlib.sha256(), None, None, None]
        self.steps = _Steps()
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.last_initial: str | None = None
        self.first_turn = self.last_turn = None
        self.turns = 0

    def add(self, program: _Program, turn, role: str, text: str, fault: str) -> None:
        initial = role[:1]
        if self.last_initial is not None and self.last_initial + initial not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.last_initial = initial
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
            self.turns += 1
        if fault:
            self.counts[fault] += 1
        kind = Kind(initial if initial in ("s", "u", "a") else "", fault in ("blank", "duplicate"), fault == "truncated")
        step = program.step(self.state, kind)
        self.steps.append(step.number)
        self.state, self.cost = step.state, self.cost + step.cost
        body = text.encode("utf-8", "surrogatepass")
        hashes = []
        for move in step.moves:
            if move is None:
                hashes.append(None)
                continue
            known = self.hashes[move.before]
            if move.lead or move.writes:
                known = known.copy()
                known.update(move.lead)
                if move.writes == "turn":
                    known.update(role.encode("utf-8", "surrogatepass") + b":")
                if move.writes:
                    known.update(body)
            hashes.append(known)
        self.hashes = hashes

    def report(self, program: _Program) -> tuple:
        ends = [(known[0] + _INSERT * _MISSING[q], known[1], q) for q, known in enumerate(self.state) if known is not None]
        beyond, _, last = min(ends)
        written = self.hashes[last].copy()
        written.update(_inserted(last, _MISSING[last])[1])
        edits, at = bytearray(b"I" * _MISSING[last]), last
        for block in self.steps.backwards():
            for number in block:
                move = program.moves[number][at]
                edits += move.edits[::-1].encode()
                at = move.before
        self.steps.close()
        edits.reverse()
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        return (self.key, gaps, *self.counts.values(), self.cost + beyond, edits.decode(), written.hexdigest())


_REPORT = (
    "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


def _repair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    program, conversation, done = _program(), None, []

    def rows() -> pd.DataFrame:
        return pd.DataFrame(done, columns=[field.split()[0] for field in _REPORT.split(", ")])

    for batch in batches:
        for key, has_turn, turn, role, text, fault in zip(*(batch[c].tolist() for c in batch.columns)):
            if conversation is None or conversation.key != key:
                if conversation is not None:
                    done.append(conversation.report(program))
                conversation = _Conversation(key)
            conversation.add(program, turn if has_turn else None, role, text, fault)
        if done:
            yield rows()
            done = []
    if conversation is not None:
        done.append(conversation.report(program))
        yield rows()


def _fault(seen_before: Column) -> Column:
    """The first fault of a turn, or none."""
    body = F.rtrim(F.col("text"), F.lit(_SPACE))
    ends = F.right(body, F.lit(1)).isin(".", "!", "?")
    return F.when(body == "", "blank").when(seen_before, "duplicate").when(~ends, "truncated").otherwise("")


def _sorted_turns(turns: DataFrame) -> DataFrame:
    """Rows ``key``, ``has_turn``, ``turn``, ``role``, ``text`` and ``fault``, sorted within
    partitions, with each conversation in one. Nulls read as one space."""
    space = F.lit(" ")
    rows = turns.select(
        F.col("conv_id").cast("string").alias("key"),
        F.col("turn").isNotNull().alias("has_turn"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
    ).repartition("key")
    # 128 bits stand for a role and text. The windows below lie within a
    # conversation, so that all sorts share the one exchange.
    same = ["key", F.xxhash64("role", "text"), F.xxhash64("text", F.lit(1), "role")]
    place = F.row_number().over(Window.partitionBy(*same).orderBy("has_turn", "turn"))
    faulty = rows.withColumn("place", place).withColumn("fault", _fault(F.col("place") > 1)).drop("place")
    return faulty.sortWithinPartitions("key", "has_turn", "turn", "role", "text")


def report(turns: DataFrame) -> DataFrame:
    """One row for each ``conv_id`` of ``turns`` (``conv_id``, ``turn``, ``role``, ``text``).

    ``gaps`` counts turn numbers left out between the least and the greatest,
    ``blank``, ``duplicate`` and ``truncated`` the turns by their first fault,
    ``illegal`` adjacent turns whose role initials are none of su, ua, au.
    ``cost`` is that of the cheapest edits and ``audit`` their initials in order,
    the ASCII-least if several cost the same: Keep (0), Rerole to user or assistant
    (2), Delete (3; blank and duplicate turns must go), Insert an empty user or
    assistant turn (2). A truncated turn that stays adds 1. ``repaired_sha256`` is
    that of the repaired turns, as ``role:text`` joined by newlines.

    A null ``role`` or ``text`` reads as one space; a null ``turn`` sorts first and
    counts in no gap; rows of a null ``conv_id`` are one conversation. Turns of one
    number are in the order of role and text, so repeated rows are duplicates and
    ties give one result. Other columns are left out. No turns give no rows.
    """
    kind = turns.schema["conv_id"].dataType
    found = _sorted_turns(turns).mapInPandas(_repair, _REPORT)
    return found.select(F.col("key").cast(kind).alias("conv_id"), *[f.split()[0] for f in _REPORT.split(", ")[1:]])


def repaired(turns: DataFrame) -> DataFrame:
    """The repaired turns: ``conv_id``, ``position`` (gapless from 0), ``edit`` (K, R or
    I), the original ``turn`` (null for an inserted one), ``role`` and ``text``.

    Rows are as in ``report``; a conversation without any turn left has no rows.
    """
    kind = turns.schema["conv_id"].dataType
    edits = report(turns).select(F.col("conv_id").cast("string").alias("key"), F.posexplode(F.split("audit", "")).alias("step", "edit"))
    edits = edits.filter("edit <> ''")
    in_order = Window.partitionBy("key").orderBy("step")
    edits = edits.withColumn("place", F.count(F.when(F.col("edit") != "I", 1)).over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    by_turn = Window.partitionBy("key").orderBy("has_turn", "turn", "role", "text")
    own = _sorted_turns(turns).withColumn("own_place", F.row_number().over(by_turn)).withColumnRenamed("key", "own_key")
    match = F.col("key").eqNullSafe(F.col("own_key")) & (F.col("place") == F.col("own_place")) & (F.col("edit") != "I")
    rows = edits.join(own, match, "left").filter("edit <> 'D'")
    position = F.row_number().over(in_order) - 1
    # User and assistant turns alternate from the first one that is not a system turn.
    leads = F.max(F.when((F.col("edit") == "K") & F.startswith("role", F.lit("s")), 1).otherwise(0)).over(Window.partitionBy("key"))
    role = F.when(F.col("edit") == "K", F.col("role")).when((F.col("position") - F.col("leads")) % 2 == 0, "user").otherwise("assistant")
    rows = rows.withColumn("position", position).withColumn("leads", leads)
    return rows.select(
        F.col("key").cast(kind).alias("conv_id"),
        "position",
        "edit",
        F.when(F.col("has_turn"), F.col("turn")).alias("turn"),
        role.alias("role"),
        F.when(F.col("edit") == "I", "").otherwise(F.col("text")).alias("text"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role`` and ``text`` after the faults that a checksum of
    the row's ids chooses: dropped, emptied, without its sentence ends, repeated, or
    said by the user."""
    space = F.lit(" ")
    rows = turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.withColumn("fault", F.crc32(named.cast("binary")) % 20).filter("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")

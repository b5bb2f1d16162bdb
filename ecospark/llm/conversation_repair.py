"""Conversation structure repair by secondary-sorted streaming.

A repaired conversation has the role initials ``(s?(ua)+)?``.  Edits are Keep (0), Rerole to user or assistant (2),
Delete (3, required for blank and duplicate rows) and Insert of an empty user or assistant row (2); a truncated row
that stays adds 1.  The cheapest edits are found by dynamic programming over four states - nothing yet, after the
system row, after a user row, after an assistant row; of equal costs the edits whose initials are ASCII-least win.

What a row does to the four costs depends on their differences and order alone, and differences beyond what a detour
costs can be pruned, so the costs walk through a small automaton that is made once.  Rows are dealt by conversation
and sorted by turn, and ``mapInPandas`` carries the automaton's state across Arrow batches.  A row leaves a backpointer
of two bytes, its transition; full blocks of ``BLOCK`` backpointers are written out as rows of a table, so that a giant
conversation holds one block at a time.  A second stream reads the blocks from the last to the first and turns them
into edits; a third reads the edits together with the texts, in the order of the first stream, and applies them.  Texts
are shuffled once, in the third; the first moves a digest of role and text instead.

Edge cases: a null role or text counts as one space; a null conversation id is a conversation of its own.  Null turns
come first.  Rows of the same turn are ordered by role and a digest of the text, rows alike in all are neighbours and
all but the first of them duplicates.  Very long texts are one row each.  An empty table gives an empty result.  Extra
columns are left out.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ecospark.llm.common import materialize, partitions_for

#: Backpointers in a row of the table.
BLOCK = 4096
SPACES = "\t\n\x0b\x0c\r "
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = "sua"
#: State after an insert or a change of role, by the state before.
TURN = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: What it costs at most to go on from the first state as from the second one.
DETOUR = {(ASSISTANT, NOTHING): 3, (ASSISTANT, SYSTEM): 0, (ASSISTANT, USER): 2, (USER, ASSISTANT): 2, (USER, NOTHING): 5,
          (USER, SYSTEM): 2, (SYSTEM, USER): 2, (SYSTEM, ASSISTANT): 4, (SYSTEM, NOTHING): 4, (NOTHING, USER): 2,
          (NOTHING, ASSISTANT): 0, (NOTHING, SYSTEM): 0}
#: Kinds of rows: the initial (three known ones, or another) and fine, truncated, or to be deleted.
FINE, CUT, GONE = range(3)
KINDS = 12


def _inserted(state: int) -> Iterator[tuple[int, str]]:
    """States reached by inserts, and the inserts' initials."""
    for n in range(3):
        yield state, "I" * n
        state = TURN[state]


def _edits(state: int, kind: int) -> Iterator[tuple[int, int, str]]:
    """State, cost and initials of every way to treat a row."""
    initial, fault = divmod(kind, 3)
    for at, lead in _inserted(state):
        cost = INSERT * len(lead)
        yield at, cost + DELETE, lead + "D"
        if fault == GONE:
            continue
        cost += TRUNCATED * (fault == CUT)
        if at == NOTHING and initial == 0:
            yield SYSTEM, cost + KEEP, lead + "K"
        if initial == TURN[at] - 1 and initial > 0:
            yield TURN[at], cost + KEEP, lead + "K"
        yield TURN[at], cost + REROLE, lead + "R"


class Automaton:
    """Numbered states, each the costs (less the smallest) and the order of the edits of the four states; a transition
    is ``state * KINDS + kind``."""

    def __init__(self):
        start = ((0, 0), None, None, None)
        self.states, number = [start], {start: 0}
        self.next: list[int] = []
        self.cost: list[int] = []
        #: For each transition and state after it, the state before and the initials of the edits.
        self.back: list[list[tuple[int, str] | None]] = []
        for state in self.states:  # grows while it is read
            for kind in range(KINDS):
                after, cost, back = self._step(state, kind)
                if after not in number:
                    number[after] = len(self.states)
                    self.states.append(after)
                self.next.append(number[after])
                self.cost.append(cost)
                self.back.append(back)
        self.end = [min((cost + INSERT * len(tail), rank, s, tail) for s, known in enumerate(state) if known
                        for cost, rank in [known] for at, tail in _inserted(s) if at in (NOTHING, ASSISTANT))
                    for state in self.states]

    @staticmethod
    def _step(state, kind):
        best: list[tuple | None] = [None] * 4
        for s, known in enumerate(state):
            if known:
                for to, cost, initials in _edits(s, kind):
                    way = (known[0] + cost, known[1], initials, s)
                    if best[to] is None or way < best[to]:
                        best[to] = way
        kept = [w if w and not any(o and w[0] > o[0] + DETOUR[s, t] for s, o in enumerate(best) if s != t) else None
                for t, w in enumerate(best)]
        low = min(w[0] for w in kept if w)
        order = sorted((w[1:3], t) for t, w in enumerate(kept) if w)
        rank = {t: n for n, (_, t) in enumerate(order)}
        return (tuple((w[0] - low, rank[t]) if w else None for t, w in enumerate(kept)), low,
                [(w[3], w[2]) if w else None for w in kept])


@lru_cache(maxsize=1)
def automaton() -> Automaton:
    return Automaton()


KEY = ["conv", "has_conv", "has_turn", "turn", "role", "digest", "copy"]
KEY_SCHEMA = "conv long, has_conv int, has_turn int, turn long, role string, digest binary, copy int"
STATS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _rows(conversations: DataFrame, present: Column, copies: Column, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """The key of each row, present, text, and what is known of a row by itself."""
    conv, turn = (F.col(f"`{c}`").cast("long") for c in (conv_col, turn_col))
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (role_col, text_col))
    rows = conversations.select(
        F.coalesce(conv, F.lit(0)).alias("conv"), conv.isNotNull().cast("int").alias("has_conv"),
        turn.isNotNull().cast("int").alias("has_turn"), F.coalesce(turn, F.lit(0)).alias("turn"), role.alias("role"),
        text.alias("text"), present.alias("present"), F.explode(F.sequence(F.lit(1), copies)).alias("copy"))
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    last = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    return rows.select("conv", "has_conv", "has_turn", "turn", "role", digest.alias("digest"), "copy", "present", "text",
                       last.alias("last"))


def _compact(rows: DataFrame) -> DataFrame:
    """KEY, initial, fault (0 to 3 as in ``STATS``, duplicates of an earlier turn included), present."""
    who = ["conv", "has_conv", "digest"]
    small = rows.select(*KEY, "present", F.left("role", F.lit(1)).alias("initial"),
                        F.when(F.col("last") == "", 1).when(F.col("last").isin(".", "!", "?"), 0).otherwise(3).alias("fault"))
    at = F.struct("has_turn", "turn")
    again = small.where("present AND fault <> 1").groupBy(*who).agg(F.min(at).alias("first"), F.max(at).alias("last")) \
        .where("first < last").select(*who, "first")
    fault = F.when((F.col("fault") != 1) & F.coalesce(at > F.col("first"), F.lit(False)), 2).otherwise(F.col("fault"))
    initial = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    return small.join(again, who, "left").select(*KEY, initial.alias("initial"), fault.cast("int").alias("fault"), "present")


class _Conversation:
    """What the first stream carries for the conversation at hand."""

    def __init__(self, key):
        self.key, self.block, self.moves, self.state, self.cost = key, 0, [], 0, 0
        self.faults, self.illegal = [0, 0, 0, 0], 0
        self.initial = self.same = self.low = self.high = None
        self.turns = 0

    def row(self, key, initial: int, fault: int, machine: Automaton) -> None:
        if not self.moves:
            self.key = key
        if fault != 1 and key[2:6] == self.same:  # alike in turn, role and text
            fault = 2
        self.same = key[2:6]
        self.faults[fault] += 1
        if key[2] and key[3] != self.high:
            self.low = key[3] if self.low is None else self.low
            self.high = key[3]
            self.turns += 1
        if self.initial is not None and (self.initial, initial) not in ((0, 1), (1, 2), (2, 1)):
            self.illegal += 1
        self.initial = initial
        move = self.state * KINDS + initial * 3 + (GONE if fault in (1, 2) else CUT if fault == 3 else FINE)
        self.moves.append(move)
        self.state = machine.next[move]
        self.cost += machine.cost[move]

    def written(self, last: bool, machine: Automaton) -> tuple:
        """The block as a row; the last one has the state and the statistics."""
        stats = None
        if last:
            gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
            stats = [gaps, *self.faults[1:], self.illegal, self.cost + machine.end[self.state][0]]
        out = (*self.key, self.block, np.array(self.moves, "<u2").tobytes(), self.state if last else -1, stats)
        self.block, self.moves = self.block + 1, []
        return out


def _forward(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    machine, now, names = automaton(), None, [*KEY, "block", "moves", "state", "stats"]
    for frame in frames:
        out = []
        for *key, initial, fault, present in zip(*(frame[c].tolist() for c in [*KEY, "initial", "fault", "present"])):
            if now is None or now.key[:2] != key[:2]:
                if now is not None:
                    out.append(now.written(True, machine))
                now = _Conversation(key)
            if present:
                if len(now.moves) == BLOCK:
                    out.append(now.written(False, machine))
                now.row(key, initial, fault, machine)
        yield pd.DataFrame(out, columns=names)
    if now is not None:
        yield pd.DataFrame([now.written(True, machine)], columns=names)


def _backward(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks of a conversation, the last first, become the initials of their edits."""
    machine, at, stats, names = automaton(), None, None, [*KEY, "block", "edits", "stats"]
    for frame in frames:
        out = []
        for *key, block, moves, state, found in zip(*(frame[c].tolist() for c in [*KEY, "block", "moves", "state", "stats"])):
            edits = []
            if state >= 0:
                _, _, at, tail = machine.end[state]
                edits.append(tail)
                stats = found
            for move in reversed(np.frombuffer(moves, "<u2").tolist()):
                at, initials = machine.back[move][at]
                edits.append(initials)
            out.append((*key, block, "".join(reversed(edits)), stats))
        yield pd.DataFrame(out, columns=names)


def _edit_table(compact: DataFrame, parts: int) -> DataFrame:
    """KEY of the first row of each block, block, edits and the statistics of its conversation."""
    dealt = compact.repartition(parts, "conv", "has_conv").sortWithinPartitions(*KEY)
    blocks = materialize(dealt.mapInPandas(_forward, f"{KEY_SCHEMA}, block long, moves binary, state int, stats array<long>"), "repair-blocks")
    dealt = blocks.repartition(parts, "conv", "has_conv").sortWithinPartitions("conv", "has_conv", F.desc("block"))
    return materialize(dealt.mapInPandas(_backward, f"{KEY_SCHEMA}, block long, edits string, stats array<long>"), "repair-edits")


def _applied(frames: Iterator[pd.DataFrame]):
    """For each conversation in turn: (who, stats), then an edit after the other as (initial, turn, role, text) - turn,
    role and text of the row after the edit, None for a deleted row."""
    who, todo, last = None, deque(), ""

    def rest():
        nonlocal last
        while todo:  # inserts after the last row
            todo.popleft()
            last = "a" if last == "u" else "u"
            yield "I", None, "user" if last == "u" else "assistant", ""

    for frame in frames:
        for c, has, has_turn, turn, role, text, edits, stats in zip(
                *(frame[n].tolist() for n in ("conv", "has_conv", "has_turn", "turn", "role", "text", "edits", "stats"))):
            if (c, has) != who:
                yield from rest()
                who, last = (c, has), ""
                yield who, stats
            if edits is not None:
                todo.extend(edits)
                continue
            while True:
                edit = todo.popleft()
                if edit == "D":
                    yield "D", None, None, None
                    break
                if edit == "K":
                    last = role[0]
                    yield "K", turn if has_turn else None, role, text
                    break
                last = "a" if last == "u" else "u"
                changed = "user" if last == "u" else "assistant"
                if edit == "R":
                    yield "R", turn if has_turn else None, changed, text
                    break
                yield "I", None, changed, ""
    yield from rest()


def _merged(rows: DataFrame, edits: DataFrame, parts: int) -> DataFrame:
    """Rows with their texts in the order of the first stream, the edits of a block before its first row."""
    texts = rows.where("present").select(*KEY, F.lit(1).alias("place"), F.lit(0).cast("long").alias("block"), "text",
                                         F.lit(None).cast("string").alias("edits"), F.lit(None).cast("array<long>").alias("stats"))
    pieces = edits.select(*KEY, F.lit(0).alias("place"), "block", F.lit(None).cast("string").alias("text"), "edits", "stats")
    return texts.unionByName(pieces).repartition(parts, "conv", "has_conv").sortWithinPartitions(*KEY, "place", "block")


def _streams(conversations: DataFrame, present: Column | None, copies: Column | None, columns: dict) -> DataFrame:
    names = {"conv_col": "conv_id", "turn_col": "turn", "role_col": "role", "text_col": "text"} | columns
    rows = _rows(conversations, F.lit(True) if present is None else present, F.lit(1) if copies is None else copies, **names)
    parts = partitions_for(conversations, 2)
    return _merged(rows, _edit_table(_compact(rows), parts), parts)


def repair(conversations: DataFrame, present: Column | None = None, copies: Column | None = None, **columns: str) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), turn (null for inserted rows), role, text and edit.
    ``present`` leaves rows out and ``copies`` repeats them; columns are named by conv_col, turn_col and so on."""
    def run(frames):
        out, who, place = [], None, 0
        for event in _applied(frames):
            if len(event) == 2:
                who, place = event[0], 0
            elif event[0] != "D":
                out.append((who[0] if who[1] else None, place, event[1], event[2], event[3], event[0]))
                place += 1
                if len(out) == 1000 or len(event[3]) > 1_000_000:
                    yield _repaired(out)
                    out = []
        yield _repaired(out)

    return _streams(conversations, present, copies, columns).mapInPandas(
        run, "conv_id long, place long, turn long, role string, text string, edit string")


def _repaired(out: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(out, columns=["conv_id", "place", "turn", "role", "text", "edit"])
    return frame.astype({"conv_id": "Int64", "turn": "Int64"})


def audit(conversations: DataFrame, present: Column | None = None, copies: Column | None = None, **columns: str) -> DataFrame:
    """One row a conversation: conv_id, ``STATS``, audit (the initials of the edits in order) and repaired_sha256 of the
    repaired ``role:text``, joined by newlines.  A conversation without a row that is present has zeros, an empty audit
    and the digest of the empty text."""
    names = ["conv_id", *STATS, "audit", "repaired_sha256"]

    def run(frames):
        out, who, stats, edits, sha, lead = [], None, None, [], None, b""

        def row():
            return (who[0] if who[1] else None, *map(int, stats), "".join(edits), sha.hexdigest())

        for event in _applied(frames):
            if len(event) == 2:
                if who is not None:
                    out.append(row())
                (who, stats), edits, sha, lead = event, [], hashlib.sha256(), b""
                if len(out) == 1000:
                    yield pd.DataFrame(out, columns=names).astype({"conv_id": "Int64"})
                    out = []
                continue
            edits.append(event[0])
            if event[0] != "D":
                sha.update(lead + f"{event[2]}:{event[3]}".encode("utf-8", "surrogatepass"))
                lead = b"\n"
        if who is not None:
            out.append(row())
        yield pd.DataFrame(out, columns=names).astype({"conv_id": "Int64"})

    return _streams(conversations, present, copies, columns).mapInPandas(
        run, "conv_id long, " + ", ".join(f"{s} long" for s in STATS) + ", audit string, repaired_sha256 string")


def damage(conversations: DataFrame) -> tuple[DataFrame, Column, Column]:
    """Rows damaged by the remainder of crc32(``conv_id:turn``) by 20, with what says which rows stay and how often:
    0 drops the row, 1 empties the text, 2 removes its full stops, 3 repeats the row, 4 makes its role user."""
    part = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    code = F.pmod(F.crc32(F.encode(F.concat(part[0], F.lit(":"), part[1]), "utf-8")), F.lit(20))
    text = F.coalesce("text", F.lit(" "))
    rows = conversations.select("conv_id", "turn", F.when(code == 4, "user").otherwise(F.col("role")).alias("role"),
                                F.when(code == 1, "").when(code == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
                                code.alias("code"))
    return rows, F.col("code") != 0, F.when(F.col("code") == 3, 2).otherwise(1)

import hashlib
import itertools
import random
import sys
import zlib

import pytest
from ecospark.llm import conversation_repair as m
from fixtures import SF, needs_data

SPACE = "\t\n\x0b\x0c\r "
SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(rows):
    """(cost, audit) over all edits: rows are (initial, must go, truncated)."""
    known = {}

    def best(i, state, inserts):
        """The least (cost, audit) of the rows from i on, with the initials so far ending in ``state``."""
        if (i, state, inserts) in known:
            return known[i, state, inserts]
        after = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
        ways = [(0, "")] if i == len(rows) and state in ("", "a") else []

        def way(cost, letter, place, to, n=0):
            rest = best(place, to, n)
            if rest:
                ways.append((cost + rest[0], letter + rest[1]))
        if inserts < 3:
            way(2, "I", i, after, inserts + 1)
        if i < len(rows):
            initial, go, cut = rows[i]
            way(3, "D", i + 1, state)
            if not go:
                way(2 + cut, "R", i + 1, after)
                if initial == after or (initial == "s" and state == ""):
                    way(cut, "K", i + 1, initial)
        known[i, state, inserts] = min(ways, default=None)
        return known[i, state, inserts]
    return best(0, "", 0)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if code == 1 else text.translate({ord(c): None for c in ".!?"}) if code == 2 else text
        out += [(conv, turn, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return out


def brute(rows, every=None):
    """A row of the operator for each conversation; ``every`` are the rows before damage."""
    out = []
    for conv in {r[0] for r in every or rows}:
        mine = [(t, role, x) for c, t, role, x in rows if c == conv]
        digest = lambda r, x: hashlib.sha256(f"{len(r)}:{r}{x}".encode()).digest()
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), digest(r[1], r[2])))
        seen, faults, kinds = set(), [0, 0, 0], []
        for _, role, text in mine:
            body = text.rstrip(SPACE)
            fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                faults[fault] += 1
            kinds.append((role[:1], fault in (0, 1), fault == 2))
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:]))
        cost, audit = cheapest(kinds)
        lines, place, last = [], 0, ""
        for letter in audit:
            row = None if letter == "I" else mine[place]
            place += letter != "I"
            if letter == "D":
                continue
            last = row[1][0] if letter == "K" else "a" if last == "u" else "u"
            lines.append(f"{row[1] if letter == 'K' else {'u': 'user', 'a': 'assistant'}[last]}:{row[2] if row else ''}")
        out.append((str(conv), gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((str(r[0]), *r[1:]) for r in df.collect())


def test_automaton_finds_the_cheapest_and_least_edits():
    machine, rng = m.automaton(), random.Random(4)
    kinds = list(itertools.product("suax", (0, 1, 2)))
    cases = [p for n in range(4) for p in itertools.product(kinds, repeat=n)] + [rng.choices(kinds, k=rng.randint(4, 30)) for _ in range(400)]
    for case in cases:
        state, cost, moves = 0, 0, []
        for initial, fault in case:
            moves.append(state * m.KINDS + "suax".index(initial) * 3 + fault)
            state, cost = machine.next[moves[-1]], cost + machine.cost[moves[-1]]
        more, _, at, tail = machine.end[state]
        edits = [tail]
        for move in reversed(moves):
            at, letters = machine.back[move][at]
            edits.append(letters)
        assert (cost + more, "".join(reversed(edits))) == cheapest([(i, f == 2, int(f == 1)) for i, f in case])


ROLES = ["system", "user", "user", "assistant", "assistant", "tool", "", None]
TEXTS = ["One.", "Two!", "Three", "cut off", "", None, " \n", "One.", "é?  ", "a\x0bb."]


def some_rows(seed, conversations=60):
    rng = random.Random(seed)
    rows = [(rng.choice([c, c, c, None]) if c == 3 else c, rng.choice([None, *range(12)]), rng.choice(ROLES), rng.choice(TEXTS))
            for c in range(conversations) for _ in range(rng.randint(1, 12))]
    return rows


@pytest.mark.parametrize("block", [m.BLOCK, 3])
def test_damaged_rows(spark, monkeypatch, block):
    """Repeated rows, ties, nulls in every column, and blocks that end anywhere."""
    monkeypatch.setattr(m, "BLOCK", block)
    rows = some_rows(block)
    rows += rows[::7]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for extra in ("key", "conv", "digest", "block", "edits", "code", "copy", "present"):
        df = df.withColumn(extra, df.role)
    assert got(m.audit(*m.damage(df))) == brute(damaged(rows), rows)


def test_empty_table_and_a_giant_conversation(spark, monkeypatch):
    empty = spark.createDataFrame([], SCHEMA)
    assert m.audit(empty).count() == 0 and m.repair(empty).count() == 0
    monkeypatch.setattr(m, "BLOCK", 100)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 37)
    try:
        rng = random.Random(9)
        sys.setrecursionlimit(20_000)
        rows = [(1, t, rng.choice(ROLES[1:5]), f"{t}." if rng.random() < 0.8 else "x") for t in range(1500)] + [(2, 0, "user", "hi.")]
        assert got(m.audit(spark.createDataFrame(rows, SCHEMA).repartition(4))) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_repaired_rows(spark):
    rows = [(1, None, "system", "s."), (1, 1, "assistant", "u."), (1, 2, "assistant", "a."), (1, 3, "assistant", "b."), (2, 0, "user", " ")]
    out = m.repair(spark.createDataFrame(rows, SCHEMA)).orderBy("conv_id", "place").collect()
    assert [tuple(r) for r in out] == [(1, 0, None, "system", "s.", "K"), (1, 1, None, "user", "", "I"), (1, 2, 1, "assistant", "u.", "K"),
                                       (1, 3, 2, "user", "a.", "R"), (1, 4, 3, "assistant", "b.", "K")]


@needs_data
def test_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    assert got(m.audit(*m.damage(df))) == brute(damaged(rows), rows)

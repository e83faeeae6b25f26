import hashlib
import random
import zlib

import numpy as np
import pytest

from gleanery.llm import dialogue
from gleanery.llm.dialogue import AFTER_A, START, tables

SPACES = " \t\n\x0b\x0c\r"
LEGAL = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, lines) over all edits, by a search over every state and row."""
    best = {(0, ""): (0, "", ())}
    order = lambda x: (x[0], x[1])

    def add(table, state, entry):
        if state not in table or order(entry) < order(table[state]):
            table[state] = entry

    def insertions(table):
        for _ in range(4):
            for state, (cost, audit, lines) in list(table.items()):
                for letter, name in (("u", "user"), ("a", "assistant")):
                    if letter in LEGAL[state]:
                        add(table, letter, (cost + 5, audit + "I", (*lines, f"{name}:")))

    now = {"": (0, "", ())}
    del best
    for role, text, go, cut in rows:
        insertions(now)
        then = {}
        for state, (cost, audit, lines) in now.items():
            add(then, state, (cost + 2, audit + "D", lines))
            if not go:
                more = 5 if cut else 0
                if role[:1] in LEGAL[state] and role[:1]:
                    add(then, role[:1], (cost + more, audit + "K", (*lines, f"{role}:{text}")))
                for name in ("user", "assistant"):
                    if name[0] in LEGAL[state]:
                        add(then, name[0], (cost + 1 + more, audit + "R", (*lines, f"{name}:{text}")))
        now = then
    insertions(now)
    return min((now[s] for s in ("", "a") if s in now), key=order)


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        mine = damaged([r for r in rows if r[0] == conv])
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, counts, coded = set(), {"blank": 0, "duplicate": 0, "truncated": 0}, []
        for _, _, role, text in mine:
            bare = text.strip(SPACES)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else (
                "truncated" if bare[-1] not in ".!?" else None)
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            coded.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(coded, coded[1:]))
        cost, audit, lines = cheapest(coded)
        out[conv] = (gaps, *counts.values(), illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def result(rows):
    return {r.conv_id: tuple(r)[1:] for r in dialogue.report(rows).collect()}


def conversations(seed, n, longest):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(n)]:
        for turn in range(rng.randint(1, longest)):
            if rng.random() < 0.1:
                continue
            rows.append((conv, None if rng.random() < 0.05 else turn + rng.choice([0, 0, 0, 1]),
                         rng.choice(["user", "assistant"] * 4 + ["system", "tool", None, ""]),
                         rng.choice(["Yes.", "No!", "why", " \t", "", None, "ça va ?\n", f"t{turn}.", f"t{turn}"])))
    return rows


@pytest.mark.parametrize("longest", [9, 60])
def test_against_brute_force(spark, longest):
    rows = conversations(longest, 60 if longest < 10 else 8, longest)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    assert result(df) == brute(rows)


def test_conversations_in_many_pieces(spark):
    """One conversation holds nearly all rows, so that every range holds a piece of it."""
    rng = random.Random(7)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), f"text {t}" + rng.choice([".", ""])) for t in range(400)]
    rows += [(c, t, "user", "Hm.") for c in (0, 2) for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        marked = dialogue.faults(dialogue.damage(df))
        assert marked.where("conv_id = 1").select("part").distinct().count() > 1
        assert result(df) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_blocks_equal_single_steps():
    t, rng = tables(), np.random.default_rng(1)
    assert len(t.vectors) < 200
    for size in (0, 1, 2, 3, 7, 30):
        symbols = rng.integers(0, 9, size)
        vectors, paid, exits = t.summary(symbols)
        for behind in range(len(t.vectors)):
            vector, total = behind, 0
            for x in symbols[::-1]:
                total += t.paid[vector, x]
                vector = t.step[vector, x]
            assert (vectors[behind], paid[behind]) == (vector, total)
            for state in range(4):
                assert t.trace(symbols, behind, state)[1] == exits[behind][state]
        rows, state = t.trace(symbols, 0, START)
        assert len(rows) == size and state in range(4)
        assert t.closing(AFTER_A) == ("", "")


def test_a_conversation_that_loses_all_rows(spark):
    turn = next(t for t in range(100) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    got = dialogue.report(spark.createDataFrame([(5, turn, "user", "Hi.")], "conv_id long, turn long, role string, text string"))
    assert [tuple(r) for r in got.collect()] == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_extra_columns_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string, at string, fault long, part long, step string"
    rows = [(1, 0, "user", "Hi.", "x", 1, 2, "y"), (1, 1, "assistant", "a" * 100_000 + ".", "x", 1, 2, "y")]
    assert result(spark.createDataFrame(rows, schema)) == brute([r[:4] for r in rows])
    assert dialogue.report(spark.createDataFrame([], schema)).collect() == []

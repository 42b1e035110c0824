"""Conversation repair against a search over whole conversations."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from riskflow.llm import dialogue_repair as D

SCHEMA = "conv_id long, turn long, role string, text string"
ROLE = {"u": "user", "a": "assistant"}


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        case = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if case == 0:
            continue
        if case == 1:
            text = ""
        if case == 2:
            text = "".join(c for c in text if c not in ".!?")
        if case == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if case == 3 else 1)
    return out


def plain_repair(rows):
    """Cheapest edits of one conversation, by the states after each turn with whole audits."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
    counts = {name: 0 for name in D.COUNTS}
    turns = [r[0] for r in rows if r[0] is not None]
    counts["gaps"] = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, faults = set(), []
    for _, role, text in rows:
        rest = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not rest else "duplicate" if (role, text) in seen else "truncated" if rest[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)
        if fault:
            counts[fault] += 1
    initials = [r[1][:1] for r in rows]
    counts["illegal"] = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    # (state, cost, audit, lines): the state is the last initial written, "" at the start.
    follows = {"": "u", "s": "u", "u": "a", "a": "u"}
    found = {"": (0, "", ())}

    def inserted(found):
        out = dict(found)
        for _ in range(3):
            for state, (cost, audit, lines) in list(out.items()):
                new = follows[state]
                other = (cost + 5, audit + "I", lines + (f"{ROLE[new]}:",))
                if new not in out or other[:2] < out[new][:2]:
                    out[new] = other
        return out

    for (_, role, text), initial, fault in zip(rows, initials, faults):
        after = {}
        for state, (cost, audit, lines) in inserted(found).items():
            ways = [(state, (cost + 2, audit + "D", lines))]
            if fault not in ("blank", "duplicate"):
                extra, new = 5 * (fault == "truncated"), follows[state]
                ways.append((new, (cost + 1 + extra, audit + "R", lines + (f"{ROLE[new]}:{text}",))))
                if initial == new or (initial == "s" and state == ""):
                    ways.append((initial, (cost + extra, audit + "K", lines + (f"{role}:{text}",))))
            for new, way in ways:
                if new not in after or way[:2] < after[new][:2]:
                    after[new] = way
        found = after
    done = [way for state, way in inserted(found).items() if state in ("", "a")]
    cost, audit, lines = min(done, key=lambda w: w[:2])
    counts["cost"] = cost
    return (*[counts[n] for n in D.COUNTS], audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()), lines


def plain_report(rows):
    groups = {r[0]: [] for r in rows}
    for conv, *row in plain_damage(rows):
        groups[conv].append(tuple(row))
    return sorted(((conv, *plain_repair(own)[0]) for conv, own in groups.items()), key=str)


def report(frame):
    return sorted(((r.conv_id, *[r[n] for n in D.COUNTS], r.audit, r.repaired_sha256) for r in frame.collect()), key=str)


def made(rng, conversations, longest):
    roles, texts = ["user", "assistant", "system", "tool", "User", "", None, "uncle"], ["Fine.", "cut off", "", " \n", None, "Good!", "why?\t", "Ünï."]
    rows = []
    for conv in range(conversations):
        turn = rng.randrange(-2, 3)
        for k in range(rng.randrange(longest + 1)):
            role = ROLE["ua"[k % 2]] if rng.random() < 0.6 else rng.choice(roles)
            text = f"Turn {k} of {conv}." if rng.random() < 0.6 else rng.choice(texts)
            rows.append((conv if conv else None, turn if rng.random() < 0.95 else None, role, text))
            turn += rng.choice([1, 1, 1, 2, 0])
    return rows


def test_report_equals_plain(spark):
    rows = made(random.Random(6), 250, 14)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert report(D.repair_damaged(docs)) == plain_report(rows)


def test_one_conversation_over_many_ranges(spark):
    """All turns in one conversation, and one that repeats a single turn."""
    rng = random.Random(1)
    rows = [(1, *r[1:]) for r in made(rng, 60, 12)] + [(2, 5, "user", "Again.")] * 300
    rows = [(conv, i if conv == 1 else turn, role, text) for i, (conv, turn, role, text) in enumerate(rows)]
    docs, expected = spark.createDataFrame(rows, SCHEMA), plain_report(rows)
    assert report(D.repair_damaged(docs, parts=9)) == expected
    ranges = D._ordered(D._described(D.damage(docs)), 9).where("conv = '=1'").select("part").distinct().count()
    assert ranges > 3


def test_repaired_turns(spark):
    rows = made(random.Random(3), 40, 9)
    found = {}
    for r in D.repair(spark.createDataFrame(rows, SCHEMA)).turns.collect():
        found.setdefault(r.conv, {})[r.place] = f"{r.role}:{r.text}"
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault("-" if conv is None else f"={conv}", []).append((turn, " " if role is None else role, " " if text is None else text))
    for conv, own in groups.items():
        lines = found.get(conv, {})
        assert tuple(lines[k] for k in range(len(lines))) == plain_repair(own)[1]


def test_edges(spark):
    extra = SCHEMA + ", `a.b` string, symbol string, part int, at string, audit string"
    rows = [(7, None, None, None), (7, None, None, None), (8, 1, "user", "x. " * 40_000), (8, 2, "assistant", "ok."), (9, 0, "user", "Hi."), (9, 0, "user", "Hi.")]
    docs = spark.createDataFrame([(*r, "x", "s", 1, "2", "K") for r in rows], extra)
    assert report(D.repair_damaged(docs)) == plain_report(rows)
    assert D.repair_damaged(docs.limit(0)).count() == 0
    gone = next(n for n in range(1000) if zlib.crc32(f"{n}:1".encode()) % 20 == 0)
    lone = spark.createDataFrame([(gone, 1, "user", "Hi.")], SCHEMA)
    assert report(D.repair_damaged(lone)) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


@pytest.mark.parametrize("rules", [[], [(1, 2), (2, 1), (12, 12), (14, 13)], [(1, 1), (12, 1), (0, 1)]])
def test_grammar_changes_nothing(rules):
    """Matrices of compressed sequences equal those of the symbols one by one."""
    rng, plain, grammar = random.Random(2), D.Grammar([]), D.Grammar(rules)
    sequences = ["".join(rng.choice(D.SYMBOLS if rng.random() < 0.3 else "ua") for _ in range(rng.randrange(1, 40))) for _ in range(200)] + ["u" * 31, "ua" * 500]
    for one, two in zip(plain.evaluate(sequences), grammar.evaluate(sequences)):
        assert [e and (e[0], D._text(e[1])) for e in one] == [e and (e[0], D._text(e[1])) for e in two]


def test_rules_are_learned(spark):
    frame = spark.createDataFrame([("uaua" * 64,), ("suaua",)] * 3, "symbols string")
    rules = D.learn_rules(frame)
    flat = D.Grammar(rules).compress(D.numbers(["uaua" * 64]))
    assert rules[0] == (1, 2) and len(flat) < 8
    assert D._alternate(np.array([1, 2, 3, 7, 8, 10])).tolist() == [1, 3, 7, 10]


def test_rope_order():
    rng = random.Random(5)
    for _ in range(300):
        made = []
        for _ in range(2):
            rope = ""
            for _ in range(rng.randrange(1, 6)):
                rope = D._concat(rope, "K" * rng.randrange(60) + rng.choice("DIKR"))
            made.append(rope)
        assert D._less((made[0], "K"), (made[1], "K")) == (D._text(made[0]) + "K" < D._text(made[1]) + "K")

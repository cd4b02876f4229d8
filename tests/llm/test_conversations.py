from __future__ import annotations

import random
import re
import zlib
from hashlib import sha256

import pytest
from fixtures import FOLDER

from stakeline.llm import conversations
from stakeline.llm.common import read

DDL = "conv_id bigint, turn bigint, role string, text string, slice string, said string, cost string, _id string"


def cheapest(rows):
    """Cost, audit and repaired lines by Dijkstra's way over (rows used, roles written)."""
    nexts = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {(0, ""): (0, "", ())}
    for i in range(len(rows) + 1):
        for _ in range(4):
            for (n, state), (cost, audit, lines) in list(best.items()):
                if n == i:
                    for role, name in (("u", "user"), ("a", "assistant")):
                        if role in nexts[state]:
                            offer(best, (n, role), (cost + 5, audit + "I", (*lines, name + ":")))
        if i == len(rows):
            break
        role, text, fault = rows[i]
        late = 5 if fault == "truncated" else 0
        for (n, state), (cost, audit, lines) in list(best.items()):
            if n != i:
                continue
            offer(best, (i + 1, state), (cost + 2, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            if role[:1] and role[:1] in nexts[state]:
                kept = (*lines, f"{role}:{text}")
                offer(best, (i + 1, role[:1]), (cost + late, audit + "K", kept))
            for to, name in (("u", "user"), ("a", "assistant")):
                if to in nexts[state]:
                    changed = (*lines, f"{name}:{text}")
                    offer(best, (i + 1, to), (cost + 1 + late, audit + "R", changed))
    return min(best[n, s] for n, s in best if n == len(rows) and s in ("", "a"))


def offer(best, key, way):
    if key not in best or way[:2] < best[key][:2]:
        best[key] = way


def shown(value):
    return " " if value is None else str(value)


def brute(rows):
    by_id = {}
    for conv, turn, role, text in rows:
        own = by_id.setdefault(conv, [])
        role, text = shown(role), shown(text)
        kind = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        own += [(turn, role, text)] * (2 if kind == 3 else 1)
    return [report(conv, own) for conv, own in by_id.items()]


def report(conv, own):
    own = sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))
    seen, classed = set(), []
    for _, role, text in own:
        solid = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
        if not solid:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        else:
            fault = "none" if solid[-1] in ".!?" else "truncated"
        seen.add((role, text))
        classed.append((role, text, fault))
    turns = [t for t, _, _ in own if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    legal = ("su", "ua", "au")
    illegal = sum(
        a[0][:1] + b[0][:1] not in legal for a, b in zip(classed, classed[1:], strict=False)
    )
    counts = [sum(f == name for _, _, f in classed) for name in ("blank", "duplicate", "truncated")]
    cost, audit, lines = cheapest(classed)
    return (conv, gaps, *counts, illegal, cost, audit, sha256("\n".join(lines).encode()).hexdigest())


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def check(table, rows):
    found = conversations.repair_damaged(table)
    assert found.columns == COLUMNS
    assert [t for _, t in found.dtypes[1:7]] == ["bigint"] * 6
    got = [tuple(r) for r in found.collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)
    return got


def test_whole_table(spark):
    table = read(spark, FOLDER, "conversations")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = check(table, rows)
    assert all(any(r[k] for r in got) for k in range(1, 7))


def odd_rows(seed=1):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    says = ["Yes.", "No", "Yes. ", " ", "", None, "Why?", "Ünd\xa0", "long " * 3000 + "!", "a\nb."]
    rows = []
    for conv in [*range(40), None]:
        turns = rng.sample(range(30), rng.randrange(1, 12))
        for turn in turns:
            rows.append((conv, turn, rng.choice(roles), rng.choice(says)))
        if rng.random() < 0.3:
            rows.append((conv, None, rng.choice(roles), rng.choice(says)))
        if rng.random() < 0.3:
            rows += [rows[-1]] * rng.randrange(1, 5)
    # One conversation that spans all slices, and one of a repeated row.
    rows += [(77, t, rng.choice(roles), rng.choice(says) if t % 3 else f"say {t}.") for t in range(1500)]
    rows += [(78, 5, "user", "Again!")] * 300
    return rows


def wide(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], DDL)


def test_odd_rows(spark):
    rows = odd_rows()
    check(wide(spark, rows), rows)


def test_long_sequences_in_stretches(monkeypatch):
    monkeypatch.setattr(conversations, "STRETCH", 7)
    rng = random.Random(2)
    for rules in ([], ["EI"], ["EI", "IE", "Ā" + "Ā", "Ă" + "E"]):
        grammar = conversations.Grammar(rules)
        for _ in range(60):
            numbers = [rng.choice([4, 8, rng.randrange(16)]) for _ in range(rng.randrange(1, 50))]
            sequence = "".join(chr(conversations.FIRST + n) for n in numbers)
            compressed = grammar.compress(sequence)
            row = grammar.matrix(compressed)[0]
            cost, state, tail = conversations.closing(row)
            edits = "".join(grammar.read(compressed, 0, state)) + tail
            classed = [
                (conversations.ROLES[n // 4], "t", conversations.FAULTS[n % 4]) for n in numbers
            ]
            want = cheapest(classed)
            assert (cost, conversations.initials(edits)) == want[:2]


def test_grammar_is_learnt_and_changes_nothing(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"Line {t}.") for c in range(60) for t in range(8)]
    table = wide(spark, rows)
    kept = conversations._sequences(
        conversations._sliced(conversations._classed(conversations.damage(table)))
    )
    grammar = conversations.learn_grammar(kept)
    assert "EI" in grammar.rules and any(len(grammar.compress("EI" * 4)) <= k for k in (1, 2))
    plain = conversations.repair(conversations.damage(table), rules=0).report
    full = conversations.repair(conversations.damage(table)).report
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, full.select(plain.columns).collect()))


def test_repaired_rows(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "user", "Hi?"), (1, 2, "user", "Hi?")]
    mended = conversations.repair(wide(spark, rows))
    lines = mended.rows.orderBy("conv_id", "slice", "turn", "said", "part").collect()
    assert [(r.role, r.text) for r in lines] == [("user", "Hello."), ("assistant", "Hi?")]
    assert [(r.cost, r.audit) for r in mended.report.collect()] == [(4, "RRD")]


def test_empty_table(spark):
    assert conversations.repair_damaged(wide(spark, [])).collect() == []


@pytest.mark.parametrize("number", range(16))
def test_symbol_rows_have_different_strings(number):
    for row in conversations._symbol(number):
        known = [conversations.initials(v) for v in row.via if v is not None]
        assert len(set(known)) == len(known)

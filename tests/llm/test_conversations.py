"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from geotracks.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string, place long, _conv string, audit int"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def damaged(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, kinds):
    """The least (cost, audit) and its rows, forward over the states of the pattern."""
    best = {"": (0, "", ())}

    def offer(into, state, cost, audit, lines):
        if state not in into or (cost, audit) < into[state][:2]:
            into[state] = (cost, audit, lines)

    def inserted(table):
        for _ in range(3):
            for state, (cost, audit, lines) in list(table.items()):
                role = NEXT[state]
                offer(table, role, cost + 3, audit + "I", (*lines, (dict(u="user", a="assistant")[role], "")))

    inserted(best)
    for (_, _, role, text), kind in zip(rows, kinds):
        after = {}
        for state, (cost, audit, lines) in best.items():
            offer(after, state, cost + 4, audit + "D", lines)
            if kind in ("blank", "duplicate"):
                continue
            more = 3 if kind == "truncated" else 0
            if role[:1] == NEXT[state] or (role[:1] == "s" and state == ""):
                offer(after, role[:1], cost + more, audit + "K", (*lines, (role, text)))
            offer(after, NEXT[state], cost + more + 3, audit + "R", (*lines, (dict(u="user", a="assistant")[NEXT[state]], text)))
        inserted(after)
        best = after
    return min(best[s] for s in ("", "a") if s in best)


def expected(rows):
    out = []
    harmed = damaged(rows)
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in harmed if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, digest(r[2], r[3])))
        kinds = faults(own)
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, lines = cheapest(own, kinds)
        text = "\n".join(f"{role}:{body}" for role, body in lines)
        counts = [kinds.count(k) for k in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def some_rows():
    draw = random.Random(5)
    texts = ["Yes.", "No!", "why", "", "  \n", "a longer answer ends here?", "same. ", None, "été… fin.", "x" * 200_000 + "."]
    roles = ["user", "assistant", "system", "tool", "", None, "usher"]
    rows = []
    for conv in [*range(60), None]:
        for turn in range(draw.randrange(0, 9)):
            role = draw.choice(roles) if draw.random() < 0.3 else ["user", "assistant"][turn % 2] if turn else draw.choice(["system", "user"])
            rows.append((conv, draw.choice([turn, turn + 1, None]) if draw.random() < 0.2 else turn, role, draw.choice(texts[:-1]) if turn else texts[-1 if conv == 3 else 0]))
    # one conversation has a third of all rows, many of them equal
    rows += [(99, i // 3, roles[i % 3 if i % 17 else 4], texts[i % 7 if i % 5 else 0] or "") for i in range(len(rows) // 2)]
    rows += [(77, 4, "user", "the same.")] * 30
    return [(*r, 1, "x", 2) for r in rows]


@pytest.mark.parametrize("bits", [2, 12])
def test_repair_equals_the_plain_search(spark, monkeypatch, bits):
    monkeypatch.setattr(conversations, "PIECE_BITS", bits)
    rows = some_rows()
    table = spark.createDataFrame(rows, SCHEMA)
    got = conversations.report(conversations.damage(table), table)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)


def test_without_rows(spark):
    table = spark.createDataFrame([], SCHEMA)
    assert conversations.report(conversations.damage(table), table).count() == 0
    one = spark.createDataFrame([(1, 1, "user", "Hi.", 0, "", 0)], SCHEMA)
    row = conversations.report(table, one).first()
    assert tuple(row) == (1, 0, 0, 0, 0, 0, 0, "", conversations.EMPTY_SHA256)


def test_block_tables_equal_single_symbols():
    tables = conversations.Tables()
    letters = conversations.SYMBOLS
    for block in [(1, 2, 3, 4), (0, 9, 8, 8), (9, 9, 9, 9), (3, 3, 2, 0)]:
        number = sum(s * w for s, w in zip(block, tables.weights))
        for v in range(len(tables.vectors)):
            at = v
            for s in reversed(block):
                at = tables.before[at, s]
            assert tables.blocks[v, number] == at
    assert len(letters) == 10 and all(min(v) == 0 for v in tables.vectors[1:])


def test_every_short_sequence_of_symbols():
    """Costs and audits of all texts of up to three symbols, against the plain search."""
    import pyarrow as pa

    tables = conversations.Tables()
    texts = ["".join(t) for n in (1, 2, 3) for t in product(conversations.SYMBOLS[:-1], repeat=n)]
    zeros = pa.array([0] * len(texts), pa.int32())
    steps, offsets, ends = tables.trace(pa.array(texts), zeros, zeros)
    for text, a, b, end in zip(texts, offsets, offsets[1:], ends):
        rows = [(0, 0, c.lower(), "") for c in text]
        kinds = ["blank" if c == "x" else "truncated" if c.isupper() else "" for c in text]
        cost, audit, _ = cheapest(rows, kinds)
        assert "".join(tables.ops[steps[a:b]]) + tables.tail_ops[end] == audit
        assert tables.paid[steps[a:b]].sum() + 3 * len(tables.tail_ops[end]) == cost

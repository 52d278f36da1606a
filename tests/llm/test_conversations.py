"""Conversation repair against a programme over whole conversations."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from cohortry.llm import conversations

SOLID = re.compile(r"[^\x20\x09-\x0D]")
ORDER = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def brute(rows):
    """Contract of one conversation; ``rows`` are (conv_id, turn, role, text), nulls in them included."""
    after = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        after += [(turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return structure(after)


def structure(after):
    turns = [t for t, _, _ in after if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    faults, seen = [], set()
    for _, role, text in after:
        solid = SOLID.findall(text)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(after, after[1:]))
    language = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @lru_cache(None)
    def best(k, state, inserted):
        options = [(0, "", ())] if k == len(after) and state in ("", "a") else []
        steps = []
        if inserted < 3:
            steps += [(2, "I", k, language[state].get(x), inserted + 1, f"{n}:") for x, n in (("u", "user"), ("a", "assistant"))]
        if k < len(after):
            _, role, text = after[k]
            steps.append((3, "D", k + 1, state, 0, None))
            if faults[k] not in ("blank", "duplicate"):
                cut = faults[k] == "truncated"
                steps.append((cut, "K", k + 1, language[state].get(role[:1]), 0, f"{role}:{text}"))
                steps += [(2 + cut, "R", k + 1, language[state].get(x), 0, f"{n}:{text}") for x, n in (("u", "user"), ("a", "assistant"))]
        for cost, what, at, to, ins, out in steps:
            if to is not None and (at > k or ins):
                rest = best(at, to, ins)
                if rest is not None:
                    options.append((cost + rest[0], what + rest[1], (() if out is None else (out,)) + rest[2]))
        return min(options, key=lambda o: o[:2], default=None)

    cost, audit, out = best(0, "", 0)
    count = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def made(seed):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "cut off", "Why?", "", " \t", "Ends. \n", "é.", None, "x?"]
    roles = ["user", "assistant", "system", "tool", "", None, "u", "Assistant"]
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rng.randint(1, 14)):
            text = rng.choice(texts) if rng.random() < 0.6 else f"{rng.random()}{rng.choice(['.', ''])}"
            role = ("user", "assistant")[turn % 2] if rng.random() < 0.5 else rng.choice(roles)
            rows.append((conv, None if rng.random() < 0.1 else turn + (turn > 5) * rng.randint(0, 3), role, text))
    rows += [(100, t, "tool", f"{t}.") for t in range(41)]
    rows += [(101, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(1, 40)]
    rows += [(102, 7, "user", "again and again.")] * 50 + [(102, t, "user", "again and again.") for t in range(8, 30)]
    rows += [(103, t, "user", "") for t in range(9)]
    return rows + rows[:20]


@pytest.mark.parametrize(("seed", "chunk"), [(1, 3), (2, 1), (3, 64)])
def test_repair_against_whole_conversations(spark, seed, chunk):
    rows = made(seed)
    # columns of other uses, clashing names among them
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, n int, state string").repartition(5)
    got = {r["conv_id"]: tuple(r[n] for n in ORDER) for r in conversations.repair(conversations.damage(frame), chunk_rows=chunk).collect()}
    want = {c: brute([r for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert got == want


def test_chunks_that_do_not_converge_and_composed_blocks(spark, monkeypatch):
    """Rows that may all change sides keep the parity of a guess alive through every chunk; maps of states are composed over several levels."""
    monkeypatch.setattr(conversations, "COMPOSED", 3)
    rows = [(1, t, "tool", f"{t}.") for t in range(61)] + [(2, t, "system" if t == 20 else "user", f"{t}") for t in range(40)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, n int")
    got = {r["conv_id"]: tuple(r[n] for n in ORDER) for r in conversations.repair(frame, chunk_rows=2).collect()}
    assert got == {c: structure([r[1:] for r in rows if r[0] == c]) for c in (1, 2)}


def test_no_rows_and_rows_that_are_all_dropped(spark):
    schema = "conv_id long, turn long, role string, text string"
    none = spark.createDataFrame([], schema)
    assert conversations.repair(conversations.damage(none)).count() == 0
    dropped = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    (row,) = conversations.repair(conversations.damage(spark.createDataFrame([(dropped, 0, "user", "Hi.")], schema))).collect()
    assert tuple(row) == (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_runs_meet():
    """A run that is told another vector stops where both differ by a constant, with the same result as a whole run."""
    rng = random.Random(4)
    for _ in range(300):
        rows = "".join(rng.choice("suaxSUAXd") for _ in range(rng.randint(0, 12)))
        old, new = tuple(rng.randint(0, 4) for _ in range(4)), tuple(rng.randint(0, 4) for _ in range(4))
        assert conversations.again(rows, old, conversations.backward(rows, old), new) == conversations.backward(rows, new)

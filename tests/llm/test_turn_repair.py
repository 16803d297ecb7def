"""Conversation repair against a search of cheapest edits, within and across tasks."""

import hashlib
import heapq
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from loomwright.llm import turn_repair

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def damaged_brute(rows):
    out = defaultdict(list)
    for c, t, role, text in rows:
        out[c]
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out[c] += [] if k == 0 else [(t, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def cheapest(turns):
    """Best first: (cost, audit, next turn, role initials so far reduced to a state)."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    queue, done = [(0, "", 0, "", [])], set()
    while queue:
        cost, audit, i, last, kept = heapq.heappop(queue)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(turns) and last in ("", "a"):
            return cost, audit, kept
        name = {"u": "user", "a": "assistant"}
        for to in after[last]:
            if to != "s":
                heapq.heappush(queue, (cost + 5, audit + "I", i, to, [*kept, f"{name[to]}:"]))
        if i < len(turns):
            role, text, fault = turns[i]
            heapq.heappush(queue, (cost + 2, audit + "D", i + 1, last, kept))
            if fault in ("", "truncated"):
                more = 5 * (fault == "truncated")
                for to in after[last]:
                    if role[:1] == to:
                        heapq.heappush(queue, (cost + more, audit + "K", i + 1, to, [*kept, f"{role}:{text}"]))
                    if to != "s":
                        heapq.heappush(queue, (cost + 1 + more, audit + "R", i + 1, to, [*kept, f"{name[to]}:{text}"]))


def brute(conversations):
    out = {}
    for c, turns in conversations.items():
        turns = sorted(turns, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2][:64], hashlib.md5(x[2].encode()).hexdigest()))
        seen, marked, n = set(), [], defaultdict(int)
        for _, role, text in turns:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            n[fault] += 1
            marked.append((role, text, fault))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
        known = [t for t, *_ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        cost, audit, kept = cheapest(marked)
        sha = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out[c] = (c, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, sha)
    return out


def some_rows(seed, conversations, longest):
    rng = np.random.default_rng(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", "sys", None, "umpire"]
    texts = ["Yes.", "no", "", " \n", "Go on!", "what? ", "a.b", None, "ends.\x0b", "x" * 70 + "1.", "x" * 70 + "2.", " ", "no. "]
    rows = []
    for c in range(conversations):
        for t in range(rng.integers(0, longest)):
            role = ["user", "assistant"][t % 2] if rng.random() < 0.6 else roles[rng.integers(len(roles))]
            text = f"turn {t} of {c}." if rng.random() < 0.5 else texts[rng.integers(len(texts))]
            rows.append((c * 3, int(rng.integers(0, 2 * longest)) if rng.random() < 0.2 else t, role, text))
    return rows + [(None, None, "user", "hi."), (None, 1, "assistant", "ho."), (7, None, None, None), (7, None, "user", "again."), (7, None, "user", "again.")]


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


@pytest.mark.parametrize(("stretch", "fan", "parts"), [(4096, 16, 3), (4, 2, 5)])
def test_equals_brute_force(spark, monkeypatch, stretch, fan, parts):
    monkeypatch.setattr(turn_repair, "STRETCH", stretch)
    monkeypatch.setattr(turn_repair, "FAN", fan)
    rows = some_rows(stretch, 40, 14) + [(2, t, "user", "dropped") for t in range(400) if zlib.crc32(f"2:{t}".encode()) % 20 == 0]
    assert got(turn_repair.repair(turn_repair.damaged(spark.createDataFrame(rows, SCHEMA).repartition(parts)))) == sorted(
        brute(damaged_brute(rows)).values(), key=repr
    )


def test_one_very_long_conversation(spark, monkeypatch):
    """Nine tenths of all rows: its turns are many tasks' and the tree has four levels."""
    monkeypatch.setattr(turn_repair, "STRETCH", 64)
    monkeypatch.setattr(turn_repair, "FAN", 3)
    rng = np.random.default_rng(3)
    words = ["user", "assistant", "system", "tool"]
    rows = [(1, t, words[rng.choice(4, p=[0.45, 0.45, 0.05, 0.05])], f"t {t if t % 3 else 5}{'.' if t % 7 else ''}") for t in range(3000)]
    rows += [(c, t, words[t % 2], "short.") for c in range(2, 60) for t in range(4)]
    conversations = defaultdict(list)
    for c, t, role, text in rows:
        conversations[c].append((t, role, text))
    turns = turn_repair.turns_with(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert got(turn_repair.repair(turns)) == sorted(brute(conversations).values(), key=repr)
    lines = turn_repair.repaired_turns(turns).collect()
    for c in (1, 2, 59):
        own = sorted((r.place, r.edit, r.role, r.text) for r in lines if r.conv_id == c)
        assert [r[0] for r in own] == list(range(len(own)))
        whole = "\n".join(f"{r[2]}:{r[3]}" for r in own if r[1] != "delete")
        assert hashlib.sha256(whole.encode()).hexdigest() == brute({c: conversations[c]})[c][-1]
        assert "".join(r[1][0].upper() for r in own) == brute({c: conversations[c]})[c][-2]


def test_products_may_be_grouped_at_will():
    rng = np.random.default_rng(0)
    for _ in range(200):
        ms = [turn_repair.turn_matrix("sua-"[rng.integers(4)], rng.random() < 0.2, rng.random() < 0.3) for _ in range(3)]
        assert turn_repair.times(turn_repair.times(ms[0], ms[1]), ms[2]) == turn_repair.times(ms[0], turn_repair.times(ms[1], ms[2]))


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert turn_repair.repair(turn_repair.damaged(empty)).count() == 0
    gone = next(t for t in range(100) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(5, gone, "user", "x.", 1, "y")], SCHEMA + ", pos long, blank string")
    assert got(turn_repair.repair(turn_repair.damaged(df))) == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    long = spark.createDataFrame([(1, 0, "user", "w " * 2_000_000 + "."), (1, 1, "assistant", "ok.")], SCHEMA)
    assert got(turn_repair.repair(turn_repair.turns_with(long)))[0][6:8] == (0, "KK")

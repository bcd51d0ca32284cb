"""Conversation repair against a search over whole audits."""

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest
from llm_data import SMALL, longest

from termweave.llm import conversations, queries

NEXT = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}
KEEP = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("a", 2): 3, ("u", 3): 2}


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        t = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not t else "duplicate" if (role, text) in seen else "truncated" if t[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute(rows):
    """Dijkstra over (cost, audit): the first accepted node is the cheapest, least one."""
    f = faults(rows)
    illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    queue, done = [(0, "", 0, 0, ())], set()
    while True:
        cost, audit, i, q, out = heapq.heappop(queue)
        if (i, q) in done:
            continue
        done.add((i, q))
        if i == len(rows) and q in (0, 3):
            text = "\n".join(f"{r}:{t}" for r, t in out)
            return (*[f.count(k) for k in ("blank", "duplicate", "truncated")], illegal, cost, audit,
                    hashlib.sha256(text.encode()).hexdigest())
        to, role = NEXT[q]
        heapq.heappush(queue, (cost + 2, audit + "I", i, to, out + ((role, ""),)))
        if i < len(rows):
            heapq.heappush(queue, (cost + 3, audit + "D", i + 1, q, out))
            if f[i] in ("", "truncated"):
                stays = cost + (f[i] == "truncated")
                heapq.heappush(queue, (stays + 2, audit + "R", i + 1, to, out + ((role, rows[i][1]),)))
                if k := KEEP.get((rows[i][0][:1], q)):
                    heapq.heappush(queue, (stays, audit + "K", i + 1, k, out + (rows[i],)))


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))


def expected(rows):
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    out = {}
    for conv, v in by.items():
        d = damage(v)
        t = [x[0] for x in d if x[0] is not None]
        out[conv] = (max(t) - min(t) + 1 - len(set(t)) if t else 0, *brute([x[1:] for x in d]))
    return out


def result(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len({r[0] for r in rows})
    return {r[0]: r[1:] for r in rows}


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert result(queries.op12_conversation_repair(spark, SMALL)) == expected(rows)


SCHEMA = "conv_id long, turn long, role string, text string"


def odd_rows():
    r = random.Random(5)
    rows = [(500, 0, "user", longest() + "."), (500, 1, "assistant", longest())]
    for conv in [None, *range(120)]:
        for j in range(700 if conv == 7 else r.choice([1, 2, 3, 5, 8, 40])):
            rows.append((conv, r.choice([j, j, j, j // 2, None]),
                         r.choice(["system", "user", "assistant", "admin", "bot", "", None, "user", "assistant"]),
                         r.choice(["hi.", "ok", "what? ", " \n", None, "", f"w{j}.", f"x{j}", f"y{r.random()}!"])))
    return rows + rows[:40]


@pytest.mark.parametrize("block", [256, 7])
def test_odd_rows(spark, monkeypatch, block):
    """Nulls, ties, repeated rows, a conversation of many blocks (and, with small ones, of blocks of blocks)."""
    monkeypatch.setattr(conversations, "BLOCK", block)
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as key", "2 as pos", "3 as code", "4 as audit", "5 as block")
    assert result(conversations.repaired(df)) == expected(rows)


def test_lost_rows_and_empty_table(spark):
    lost = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = result(conversations.repaired(spark.createDataFrame([(lost, 0, "user", "hi.")], SCHEMA)))
    assert got == {lost: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert result(conversations.repaired(spark.createDataFrame([], SCHEMA))) == {}


def test_undamaged(spark):
    rows = [(1, 0, "user", "a."), (1, 1, "user", "b."), (1, 2, "assistant", "c.")]
    got = result(conversations.repaired(spark.createDataFrame(rows, SCHEMA), harmed=False))
    assert got[1] == (0, *brute([r[2:] for r in rows]))


def test_least_audits_of_a_block():
    """Every entry state's audit is the least of the cheapest ones, found by trying all."""
    r = random.Random(3)
    for _ in range(60):
        codes = [4 * r.randrange(4) + r.choice([0, 0, 1, 2, 3]) for _ in range(r.randint(1, 5))]
        got, ends, costs = conversations.least_audits(
            np.array([codes + [conversations.PAST] * 2], np.uint8), np.array([conversations.LAST]))
        for start in range(4):
            found = []

            def walk(i, q, cost, audit, inserts, start=start):
                if i == len(codes):
                    found.append((cost + conversations.LAST[q], audit, q))
                    return
                initial, fault = divmod(codes[i], 4)
                if inserts < 2:
                    walk(i, NEXT[q][0], cost + 2, audit + "I", inserts + 1)
                walk(i + 1, q, cost + 3, audit + "D", 0)
                if fault < 2:
                    walk(i + 1, NEXT[q][0], cost + 2 + fault, audit + "R", 0)
                    if k := KEEP.get(("?sua"[initial], q)):
                        walk(i + 1, k, cost + fault, audit + "K", 0)
            walk(0, start, 0, "", 0)
            assert (costs[0][start], got[0][start], ends[0][start]) == min(found)

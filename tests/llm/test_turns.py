"""Conversation repair against a search over all edits."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest

from metaloom.llm import turns

ROWS = "conv_id long, turn long, role string, text string, kind int, part int"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = lambda v: " " if v is None else v
        h = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(conv, turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        solid = re.sub("[\x20\x09-\x0d]", "", text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def best(rows, faults):
    """Least (cost, audit) by a search over (turn, state of the grammar), and the repaired turns."""
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    full = {"u": "user", "a": "assistant"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, said = heapq.heappop(heap)
        if i == len(rows) and state in ("", "a"):
            return cost, audit, list(said)
        if (i, state) in done:
            continue
        done.add((i, state))
        for role, after in step[state].items():
            if role in full:
                heapq.heappush(heap, (cost + 2, audit + "I", i, after, said + ((full[role], ""),)))
        if i < len(rows):
            role, text = rows[i][2:]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, said))
            if faults[i] in ("", "truncated"):
                more = faults[i] == "truncated"
                for to, after in step[state].items():
                    if role[:1] == to:
                        heapq.heappush(heap, (cost + more, audit + "K", i + 1, after, said + ((role, text),)))
                    if to in full:
                        heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, after, said + ((full[to], text),)))
    raise AssertionError


def brute(rows, damaged=True):
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == conv]
        after = damage(mine) if damaged else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in mine]
        after.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).digest()))
        faults = faults_of(after)
        known = {r[1] for r in after if r[1] is not None}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(after, after[1:]))
        cost, audit, said = best(after, faults)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()
        out[conv] = (gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def found(df):
    names = "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[n] for n in names) for r in rows}


def corpus(seed=13, conversations=250, longest=14):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "USER", "summary"]
    texts = ["Yes.", "No!", "what?", "cut", "", " \t", None, "é.", "Yes. \n", "many words here", "Why 🙂"]
    rows = []
    for conv in range(conversations):
        clean = rng.random() < 0.4
        for turn in range(rng.randrange(longest)):
            if clean:
                rows.append((conv, turn, ("user", "assistant")[turn % 2], f"text {turn}."))
            else:
                at = rng.choice([turn, turn, turn, turn + 3, max(0, turn - 1), None])
                rows.append((conv, at, rng.choice(roles), rng.choice(texts)))
    rows += [(None, 0, "user", "Hello."), (None, None, "user", "Hello."), (None, 1, "assistant", "Hi")]
    rows += [(7000, 5, "user", "same.")] * 90
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], ROWS).repartition(4)


@pytest.mark.parametrize("block", [1, 2, 3, 32])
def test_repair_against_search(spark, monkeypatch, block):
    monkeypatch.setattr(turns, "BLOCK", block)
    rows = corpus(seed=block)
    assert found(turns.repair_digests(turns.damaged(frame(spark, rows)))) == brute(rows)
    assert found(turns.repair_digests(turns.as_they_are(frame(spark, rows)))) == brute(rows, damaged=False)


def test_one_long_conversation_among_short_ones(spark):
    rng = random.Random(2)
    rows = [(1, i, rng.choice(["user", "assistant", "tool", "system"]), rng.choice([f"t{i}.", "again.", "", f"cut {i}"])) for i in range(3000)]
    rows += corpus(seed=9, conversations=60)
    assert found(turns.repair_digests(turns.damaged(frame(spark, rows)))) == brute(rows)


def test_repaired_turns(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "tool", "x."), (1, 2, "assistant", "Bye."), (2, 0, "user", "")]
    df = turns.as_they_are(frame(spark, rows))
    told = turns.audits(turns.blocks(turns.faults(df)))
    assert {r["conv_id"]: (r["cost"], r["audit"]) for r in told.collect()} == {1: (4, "IKRK"), 2: (3, "D")}
    said = sorted((r["conv_id"], r["place"], r["role"], r["text"]) for r in turns.repaired_turns(df, told).collect())
    assert said == [(1, 0, "user", ""), (1, 1, "assistant", "Hello."), (1, 2, "user", "x."), (1, 3, "assistant", "Bye.")]


def test_no_conversations(spark):
    assert found(turns.repair_digests(turns.damaged(spark.createDataFrame([], ROWS)))) == {}

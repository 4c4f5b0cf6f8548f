import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from rhapsode.llm import prefixtrie as P

SCHEMA = "conv_id long, turn long, role string, text string, n int, ids string, at_conv int"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        s = own.get(c - c % 5, [])[:h] + own[c][h:]
        ends[tuple(s)].append(c)
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    kids = defaultdict(list)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    out = {}
    for k in sorted(members, key=len, reverse=True):
        leaves, saved = (sum(out[x][i] for x in kids[k]) for i in (5, 6))
        if k:
            saved += (len(members[k]) - 1) * len(k[-1][1].encode())
        text = ",".join(map(str, sorted(ends[k]))) if k in ends else ""
        out[k] = (min(members[k]), len(k), min(members[k[:-1]]) if k else None, len(members[k]), len(kids[k]), leaves or 1, saved, hashlib.sha256(text.encode()).hexdigest())
    return sorted(map(str, out.values()))


def conversations(rng, n):
    rows, turns = [], [("user", "a"), ("user", "é" * 5), ("assistant", "a"), (None, "b"), ("user", None), ("", "")]
    for c in range(n):
        for t in range(rng.choice([0, 1, 2, 3, 5, 9, 14])):
            rows.append((c, t if rng.random() < 0.9 else rng.choice([None, 1]), *(turns[min(t, 2)] if rng.random() < 0.7 else rng.choice(turns))))
    rows += [(n + 5 * i, t, "user", "same") for i in range(40) for t in range(12)]  # copies
    rows += [(2000 + i, t, "user", "near" if t < 10 or i > t else f"own {i}") for i in range(20) for t in range(15)]  # a shared beginning, then ends of many kinds
    return rows + [(None, 1, "user", "x"), rows[3], rows[3], (7001, None, "user", "lone"), (9005, 2**40, None, None)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "i", 2) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("local", [1 << 14, 60, 2, 0])
def test_brute_force(spark, local):
    rows = conversations(random.Random(local), 80)
    got = P.prefix_trie(frame(spark, rows), local=local)
    assert [f"{f.name} {f.dataType.simpleString().replace('bigint', 'long')}" for f in got.schema] == P.NODE.split(", ")
    assert sorted(str(tuple(r)) for r in got.collect()) == brute(rows)


def test_large_class_is_hashed_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK", 7)
    rows = [(5 * i, 0, "user", "hello") for i in range(500)]
    assert sorted(str(tuple(r)) for r in P.prefix_trie(frame(spark, rows), local=3).collect()) == brute(rows)


def test_one_very_long_conversation_and_its_near_copy(spark):
    rows = [(0, t, "user", str(t % 7)) for t in range(3000)] + [(5000, t, "user", str(t % 7) if t < 2900 else "x") for t in range(3000)] + [(10, 0, "user", "0")]
    assert sorted(str(tuple(r)) for r in P.prefix_trie(frame(spark, rows), local=100).collect()) == brute(rows)


def test_empty(spark):
    assert P.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert P.prefix_trie(frame(spark, [(None, 1, "a", "b")])).collect() == []

"""The prefix trie beside a brute-force trie."""

import hashlib
import random
import zlib

import pytest

from eventweft.llm import prefixes


def ident(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]


def brute(rows, shared):
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, ident(role or "", text or ""), (role or "", text or "")))
    own = {c: [t[-1] for t in sorted(v)] for c, v in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if shared else 0
        made[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    nodes = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    child, out = {}, []
    for k in nodes:
        if k:
            child[k[:-1]] = child.get(k[:-1], 0) + 1
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for k, members in nodes.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in child
            saved[k[:d]] += (len(members) - 1) * (len(k[-1][1]) if k else 0)
    for k, members in nodes.items():
        end = ",".join(str(c) for c in sorted(members) if len(made[c]) == len(k))
        parent = min(nodes[k[:-1]]) if k else None
        out.append((min(members), len(k), parent, len(members), child.get(k, 0), leaves[k], saved[k], hashlib.sha256(end.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations():
    rng = random.Random(5)
    rows = []
    for conv in [*range(95, 130), *range(200, 206), 301, 302, 400, 450]:
        for turn in range(rng.choice([1, 2, 3, 7, 8, 9, 16, 17, 40])):
            rows.append((conv, turn, rng.choice(["user", "assistant"]), rng.choice(["a", "bb", "cé😀"]) * (turn < 3) or "same", 1, "x"))
    rows += [(500, 0, None, None, 1, "x"), (500, None, "user", "n", 1, "x"), (500, 3, "user", "t", 1, "x"), (500, 3, "bot", "t", 1, "x")]
    rows += [(501, 0, "user", "twice", 1, "x")] * 2 + [(None, 0, "user", "lost", 1, "x"), (600, 0, "", "a" * 50_000, 1, "x")]
    rows += [(7000 + i, t, "user", f"t{t}", 1, "x") for i in range(900) for t in range(2)]
    return rows


@pytest.mark.parametrize("shared", [True, False])
@pytest.mark.parametrize("chunk", [512, 2])
def test_trie_equals_brute_force(spark, monkeypatch, shared, chunk):
    monkeypatch.setattr(prefixes, "CHUNK", chunk)
    rows = conversations()
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth int, key string")
    got = prefixes.trie(frame, prefixes.rebuilt if shared else prefixes.plain).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, shared)


def test_trie_of_nothing(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefixes.trie(frame, prefixes.rebuilt).collect() == []

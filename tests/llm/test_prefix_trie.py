from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from loomstat.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, path int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _digest(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, _digest(role, text)[:32], role or "", text or ""))
    convs = {c: [t[3:] for t in sorted(turns)] for c, turns in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c > 0 else -1)
        built[c] = convs.get(base, [])[:h] + own[h:]
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for path, members in nodes.items():
        below = [(p, m) for p, m in nodes.items() if p[:len(path)] == path]
        ends = sorted(c for c in members if len(built[c]) == len(path))
        out.append((
            min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members),
            sum(len(p) == len(path) + 1 for p, _ in below),
            sum(not any(len(q) == len(p) + 1 and q[:len(p)] == p for q in nodes) for p, _ in below),
            sum((len(m) - 1) * len(p[-1][1].encode()) for p, m in below if p),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def found(spark, rows, shard=20_000, parts=3):
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(parts)
    result = prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.paths(turns)), shard=shard)
    assert result.columns == COLUMNS
    return sorted((tuple(r) for r in result.collect()), key=str)


def chats(seed, n, words=2):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        same = rnd.random() < 0.4
        for turn in range(6 if same else rnd.randint(0, 12)):
            text = "é same" if same else rnd.choice(["a", "bc", "ü\n"][:words])
            rows.append((c, turn, ["user", "assistant"][turn % 2], text))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard", [20_000, 7, 1])
def test_equals_plain_trie(spark, shard):
    rows = chats(shard, 90)
    assert found(spark, rows, shard) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (1, None, "user", "first"), (1, 0, None, "x"), (1, 1, "user", None), (None, 0, "user", "x"), (2, 5, "", ""), (2, 5, "", ""),
        (2, 5, "b", "tie"), (2, 5, "a", "tie"), (-7, 0, "user", "x"), (-5, 0, "u", "y"), (10, 0, "user", "z" * 300_000),
        (12, 0, "user", "x"), (14, 0, "user", "x"), (30, 2, "us", "er"), (31, 0, "u", "ser"),
    ]
    for shard in (20_000, 1):
        assert found(spark, rows, shard) == brute(rows)


def test_a_hot_path_is_split_and_its_ids_hashed_in_order(spark, monkeypatch):
    rows = [(c, t, "user", f"t{t}") for c in range(5, 405) for t in range(9)]  # all but one group end at equal paths
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    assert found(spark, rows, 10) == brute(rows)


def test_empty_and_turnless(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 0, "a", "b")]) == []
    # 7 takes its first turns from 5, which is absent, and has none of its own after them
    rows = [(7, 0, "user", "x")]
    assert found(spark, rows) == brute(rows) == [(7, 0, None, 1, 0, 1, 0, hashlib.sha256(b"7").hexdigest())]


def test_skeleton_names():
    wide = prefix_trie.WIDE
    symbol = lambda s: b"".join(bytes([c]) * wide for c in s.encode())
    skeleton = prefix_trie.Skeleton([(symbol("ab"), 3), (symbol("abc"), 1), (symbol("b"), 9)])
    assert [skeleton.shard(symbol(p), c) for p, c in [("a", 1), ("ab", 2), ("ab", 3), ("abc", 1), ("bb", 0)]] == [0, 0, 1, 2, 3]
    assert skeleton.reach(1, symbol("abb")) == 2 and skeleton.name(1, symbol("abb"), 2) == 0
    assert skeleton.reach(2, symbol("abcd")) == 3 and skeleton.name(2, symbol("abcd"), 3) == 1
    assert skeleton.reach(3, symbol("bz")) == 1 and skeleton.name(3, symbol("bz"), 0) == 0

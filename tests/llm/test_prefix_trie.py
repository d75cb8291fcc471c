import hashlib
import random
import zlib

import numpy as np
import pytest

from contrail.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth long, n long"


def brute_force(rows):
    own = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            digest = hashlib.md5(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest()
            own.setdefault(conv_id, []).append((turn is not None, turn or 0, digest, (role or "", text or "")))
    turns = {c: [t[3] for t in sorted(x, key=lambda y: y[:3])] for c, x in own.items()}
    full = {}
    for c, x in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        full[c] = tuple(turns.get(base, [])[:h] + x[h:])
    nodes = {}
    for c, x in full.items():
        for d in range(len(x) + 1):
            nodes.setdefault(x[:d], []).append(c)
    children, below = {}, {}
    for x in nodes:
        if x:
            children.setdefault(x[:-1], []).append(x)
    for x in sorted(nodes, key=len, reverse=True):
        own_bytes = (len(nodes[x]) - 1) * len(x[-1][1].encode()) if x else 0
        parts = [below[y] for y in children.get(x, [])]
        below[x] = (sum(p[0] for p in parts) or 1, own_bytes + sum(p[1] for p in parts))
    out = []
    for x, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in members if full[c] == x))
        out.append((min(members), len(x), min(nodes[x[:-1]]) if x else None, len(members), len(children.get(x, [])),
                    *below[x], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, "k", 1, 2) for r in rows], SCHEMA).repartition(parts)
    got = prefix_trie.prefix_trie(df)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                           "ends_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def conversations(seed, n):
    """Few different turns, so that prefixes, whole conversations and lists of ends repeat."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-20, 3 * n), n):
        for t in range(rng.choice([1, 2, 3, 6, 12])):
            rows.append((c, t, rng.choice(["user", "bot"]) if t else "user", "ä" * (0 if rng.random() < .6 else t)))
    return rows


@pytest.mark.parametrize("seed,block,piece", [(1, 4, 2), (2, 1, 1), (3, 25, 3), (4, 65_536, 4_096)])
def test_equals_a_trie_in_memory(spark, monkeypatch, seed, block, piece):
    monkeypatch.setattr(prefix_trie, "BLOCK_ROWS", block)
    monkeypatch.setattr(prefix_trie, "PIECE", piece)
    rows = conversations(seed, 120)
    assert run(spark, rows) == brute_force(rows)


def test_copies_and_one_first_turn_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK_ROWS", 6)
    rows = [(c, t, "user", "same") for c in range(0, 300, 5) for t in range(9)]
    rows += [(c, t, "user", "same" if t < 10 else str(c % 3)) for c in range(500, 700, 5) for t in range(12)]
    assert run(spark, rows) == brute_force(rows)


def test_turns_bound_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK_TURNS", 10)
    rows = conversations(8, 60) + [(1000, t, "user", str(t % 2)) for t in range(300)]
    assert run(spark, rows) == brute_force(rows)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "lost"), (5, None, None, None), (5, 1, "user", "a"), (5, 1, "user", "a"), (5, 1, "bot", "b"),
            (6, 1, "", ""), (7, 2, "a", "b"), (8, 2, "", "ab"), (9, 3, "user", "🙂 é" * 20_000), (12, 0, None, "x"), (-3, 1, "u", "v"),
            (0, 1, "user", "zero"), (4, 1, "user", "zero")]
    assert run(spark, rows) == brute_force(rows)
    assert run(spark, [(6, 1, "user", "only")]) == brute_force([(6, 1, "user", "only")])
    assert run(spark, []) == []


def test_interval_ends_equal_a_scan():
    rng = np.random.default_rng(4)
    values = rng.integers(0, 5, 37)
    table = prefix_trie._sparse(values)
    at, depth = np.repeat(np.arange(37), 6), np.tile(np.arange(6), 37)
    for i, d, low, high in zip(at, depth, prefix_trie._left_end(table, at, depth), prefix_trie._right_end(table, at, depth)):
        right, left = i, i
        while right + 1 < 37 and values[right + 1] >= d:
            right += 1
        while left >= 1 and values[left] >= d:
            left -= 1
        assert (low, high) == (left, right)

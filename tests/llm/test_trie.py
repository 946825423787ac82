"""Conversation prefix trie against plain Python, and its slot table."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
from gavel.llm import prefix_trie
from gavel.operators import segments
from hypothesis import given, settings
from hypothesis import strategies as st

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    paths = {}
    for c in own:
        rest = abs(c) % 5 * (1 if c >= 0 else -1)
        h = zlib.crc32(str(c).encode()) % 9
        turns = sorted(own.get(c - rest, []))[:h] + sorted(own[c])[h:]
        paths[c] = tuple(t[2:] for t in turns)
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    out = []
    for node, convs in members.items():
        below = [m for m in members if m[:len(node)] == node]
        children = [m for m in below if len(m) == len(node) + 1]
        inner = {m[:-1] for m in below if m}
        ends = ",".join(str(c) for c in sorted(convs) if paths[c] == node)
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children),
                    sum(m not in inner for m in below), sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in below if m),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return out


def conversations(seed=3, n=60):
    rng, rows = random.Random(seed), []
    for c in range(n):
        for t in range(rng.randrange(1, 14)):
            role = rng.choice(["user", "assistant", None])
            rows.append((c * rng.choice([1, 1, 1, 2]), t if rng.random() < 0.95 else None, role, rng.choice(["hi", "é" * 5, "", None, f"text {rng.randrange(4)}"])))
    rows += [(1000 + k, t, "user", f"same {t}") for k in range(40) for t in range(6)] + [(1000, 0, "user", "same 0")] * 3
    rows += [(None, 0, "user", "x"), (-7, 1, "user", "n"), (-5, 1, "user", "n"), (-5, 0, None, None)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "1 AS conv", "'x' AS depth", "2 AS d1", "3 AS place", "'y' AS size", "4 AS shard", "'z' AS digest")


def test_trie(spark, same):
    rows = conversations()
    same(prefix_trie.query(frame(spark, rows)), COLUMNS, brute(rows))


def test_many_shards_and_heavy_nodes(spark, same, monkeypatch):
    monkeypatch.setattr(segments, "SEGMENT_ROWS", 60)  # the long conversation is cut into segments
    rows = conversations(5, 30) + [(5000, t, "user", "long") for t in range(300)]
    same(prefix_trie.trie(frame(spark, rows), shard_rows=20), COLUMNS, brute(rows))


def test_no_conversations(spark, same):
    assert prefix_trie.query(frame(spark, [])).count() == 0
    assert prefix_trie.query(frame(spark, [(None, 1, "user", "x")])).count() == 0
    same(prefix_trie.query(frame(spark, [(5, 1, "user", "x")])), COLUMNS, brute([(5, 1, "user", "x")]))


@settings(max_examples=60, deadline=None)
@given(st.sets(st.tuples(st.integers(-2**63, 2**63 - 1), st.integers(-3, 3)), max_size=60))
def test_slots_are_a_minimal_perfect_hash(pairs):
    pairs = sorted(pairs)
    one, two = (np.array([p[k] for p in pairs], np.int64) for k in (0, 1))
    table = prefix_trie.SlotTable(one, two)
    assert sorted(table.slots) == list(range(len(pairs)))
    assert (table.find(one, two) == table.slots).all()
    other = np.array([7, 8], np.int64), np.array([99, 100], np.int64)
    assert (table.find(*other) == -1).all()

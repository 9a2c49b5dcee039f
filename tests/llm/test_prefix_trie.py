"""The prefix trie and its subtree totals against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from tidemark.llm import prefix_trie as P


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in own.items()}
    members = defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
        for d in range(len(rebuilt) + 1):
            members[rebuilt[:d]].append((c, d == len(rebuilt)))
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out = []
    for node, who in members.items():
        below = [n for n in members if n[:len(node)] == node]
        saved = sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in below if n)
        ends = ",".join(str(c) for c, end in sorted(who) if end)
        out.append((min(c for c, _ in who), len(node), min(c for c, _ in members[node[:-1]]) if node else None, len(who), len(children[node]),
                    sum(not children[n] for n in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows):
    frame = spark.createDataFrame([(*r, 0, "x") for r in rows], "conv_id long, turn long, role string, text string, node int, depth string")
    return sorted((tuple(r) for r in P.trie(frame).collect()), key=str)


def test_matches_brute_force(spark):
    rng = random.Random(1)
    rows = [(None, 0, "user", "of no conversation")]
    for c in [*range(0, 60), 100, 119, 1000, 5_000_000_000]:
        for turn in range(rng.choice([1, 2, 3, 5, 8])):
            rows.append((c, rng.choice([turn, turn, None]), rng.choice(["user", "assistant", None]), rng.choice(["hi there", "a\tb  c", "", None, "ünï çode", f"own {c}"])))
    rows += [rows[5], rows[5]]
    deep = [(i, "user", f"step {i} of {i % 3}") for i in range(70)]  # a long chain with a branch and a twin
    rows += [(80, *t) for t in deep] + [(81, *t) for t in deep] + [(82, *t) for t in deep[:40]] + [(83, *t) for t in deep[:40]] + [(83, 99, "user", "branch")]
    rng.shuffle(rows)
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("shape", ["path", "caterpillar", "random", "forest"])
def test_subtree_totals_of_shapes(spark, shape):
    rng = random.Random(7)
    n = 150
    parent = {0: None}
    for i in range(1, n):
        parent[i] = {"path": i - 1, "caterpillar": i - 1 if i % 2 else max(0, i - 2), "random": rng.randrange(i), "forest": None if i % 40 == 0 else rng.randrange(max(0, i - 3), i)}[shape]
    depth, value = {}, {i: rng.randrange(10) for i in range(n)}
    for i in range(n):
        depth[i] = 0 if parent[i] is None else depth[parent[i]] + 1
    want = dict(value)
    for i in range(n - 1, 0, -1):
        if parent[i] is not None:
            want[parent[i]] += want[i]
    tree = spark.createDataFrame([(i, parent[i], depth[i], value[i]) for i in range(n)], "node long, parent long, depth long, v long")
    assert {r.node: r.v for r in P.subtree_totals(tree, ["v"]).collect()} == want


def test_ids_of_many_slices_are_hashed_in_order(spark):
    ids = [-3, 0, 5, 9, 10, 100, 1023, 1024, 2047, 5000, 10**12]
    frame = spark.createDataFrame([(1, i) for i in reversed(ids)] + [(2, 7)], "k long, conv_id long").selectExpr("struct(k AS h1, k AS h2) AS node", "conv_id")
    got = {r.node.h1: r.ends_sha256 for r in P.ends_digest(frame).collect()}
    assert got == {1: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), 2: hashlib.sha256(b"7").hexdigest()}

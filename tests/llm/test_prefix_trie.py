import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from codegraph.llm import prefixtrie

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def conversations_of(rows):
    """Turns by conversation; equal turn numbers keep the order of the rows, so made rows have none with other contents."""
    out = {}
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        out.setdefault(conv, []).append((role or "", text or ""))
    return out


def rebuilt(rows):
    own = conversations_of(rows)
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def plain_nodes(paths):
    members, ends = {}, {}
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children, leaves, saved = {}, {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        leaves[p] = sum(leaves[q] for q in below) if below else 1
        saved[p] = sum(saved[q] for q in below) + (len(members[p]) - 1) * (len(WORD.findall(p[-1][1])) if p else 0)
        if p:
            children.setdefault(p[:-1], []).append(p)
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return [(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), leaves[p], saved[p], sha(ends.get(p, []))) for p, m in members.items()]


def as_rows(frame):
    return sorted(map(repr, map(tuple, frame.collect())))


def made(seed, n, most=12):
    rng = random.Random(seed)
    rows, before = [], []
    for c in rng.sample(range(4 * n), n):
        turns = []
        if before and rng.random() < 0.7:
            other = rng.choice(before)
            turns = other[: rng.randint(0, len(other))]
        while len(turns) < rng.randint(0, most):
            turns = [*turns, (rng.choice(["user", "assistant", None]), rng.choice(["", None, "a b", " c\tdd\ne ", "日本 x"]))]
        before.append(turns)
        rows += [(c, None if k == 0 and c % 3 == 0 else k * 2, *t) for k, t in enumerate(turns)]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def test_nodes_by_definition(spark):
    rows = made(1, 250) + [(None, 1, "user", "nobody")] + [(900_000 + k, j, "user", f"same {j}") for k in range(300) for j in range(5)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert as_rows(prefixtrie.shared_head_nodes(frame)) == sorted(map(repr, plain_nodes(rebuilt(rows))))
    assert as_rows(prefixtrie.conversation_nodes(frame, most_turns=40)) == sorted(map(repr, plain_nodes(conversations_of(rows))))


def test_conversations_in_many_segments(spark):
    rng = random.Random(2)
    base = [("user", f"t {k % 7}") for k in range(700)]
    rows = []
    for c in range(14):
        turns = base[: rng.randint(0, 700)] + [("x", str(rng.randint(0, 2))) for _ in range(rng.randint(0, 60))]
        rows += [(c, k, *t) for k, t in enumerate(turns)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(6)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "97")
    try:
        assert as_rows(prefixtrie.shared_head_nodes(frame, most_turns=500)) == sorted(map(repr, plain_nodes(rebuilt(rows))))
    finally:
        spark.conf.set(name, before)


def test_donors_that_are_short_or_absent(spark):
    rows = [(20, 0, "u", "donor")] + [(c, k, "u", f"{c} {k}") for c in range(21, 140) if c % 20 for k in range(3)]
    frame = spark.createDataFrame(rows, SCHEMA)
    expected = plain_nodes(rebuilt(rows))
    assert as_rows(prefixtrie.shared_head_nodes(frame)) == sorted(map(repr, expected))
    assert any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in expected)  # conversations without turns


def test_empty_and_odd_tables(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert prefixtrie.shared_head_nodes(frame).count() == 0
    odd = spark.createDataFrame([(1, 1, None, "x " * 100_000, "q", 1), (1, 1, None, "x " * 100_000, "q", 2), (2, 1, "", "x " * 100_000, None, None), (None, None, None, None, None, None)], SCHEMA + ", x string, depth long")
    rows = [tuple(r)[:4] for r in odd.collect()]
    assert as_rows(prefixtrie.conversation_nodes(odd)) == sorted(map(repr, plain_nodes(conversations_of(rows))))


def test_fat_binary_search():
    assert [prefixtrie.two_fattest(a, b) for a, b in ((0, 1), (0, 7), (4, 7), (5, 7), (6, 7), (8, 16), (3, 12))] == [1, 4, 6, 6, 7, 16, 8]
    rng = random.Random(3)
    segments = prefixtrie.Segments()
    trie = prefixtrie.ZFastTrie(segments)
    paths = []
    for _ in range(300):
        path = list(rng.choice(paths))[: rng.randint(0, 300)] if paths and rng.random() < 0.8 else []
        path += [rng.randint(1, 3) for _ in range(rng.randint(0, 200))]
        paths.append(path)
        hashes = np.array([hash(tuple(path[:k])) if k else 0 for k in range(len(path) + 1)])
        trie.insert(segments.add(0, hashes, hashes, np.ones(len(path), np.int64)))
    for k, path in enumerate(paths):
        node, depth = trie.exit_node(k)
        assert depth == len(path) == trie.bottom[node]
    assert len(trie.top) <= 2 * len(paths) + 1


@pytest.mark.parametrize("seed", range(3))
def test_two_tries_add_up_to_one(spark, seed):
    rows = made(10 + seed, 60, 6)
    frame = spark.createDataFrame(rows, SCHEMA)
    assert as_rows(prefixtrie.conversation_nodes(frame, most_turns=1)) == as_rows(prefixtrie.conversation_nodes(frame))

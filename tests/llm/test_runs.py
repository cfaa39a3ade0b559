import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from codegraph.llm import periodicruns

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, least=24, times=3):
    """By definition: for each period the stretches in which words that far apart are the same, if no smaller period holds."""
    n, found = len(words), []
    for q in range(1, n // times + 1):
        start = 0
        for i in range(n - q + 1):
            if i < n - q and words[i] == words[i + q]:
                continue
            length = i + q - start
            if length >= max(least, times * q) and not any(all(words[j] == words[j + p] for j in range(start, start + length - p)) for p in range(1, q)):
                found.append((start, length, q))
            start = i + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def digest(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def made_texts(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        words = []
        while len(words) < rng.randint(0, 160):
            root = [rng.choice("abcd"[: rng.randint(1, 4)]) for _ in range(rng.randint(1, 40))]
            words += (root * rng.randint(1, 6))[: rng.randint(1, 200)] if rng.random() < 0.7 else root
        yield words


def test_runs_by_definition():
    texts = list(made_texts(5, 300))
    numbered = {w: k for k, w in enumerate("abcd")}
    ids = np.array([numbered[w] for t in texts for w in t], np.int32)
    found = periodicruns.find_runs(ids, np.cumsum([len(t) for t in texts]))
    expected = [(d, *r) for d, t in enumerate(texts) for r in plain_runs(t)]
    assert [tuple(r) for r in found.tolist()] == expected
    assert len({r[3] for r in expected}) > 20


def test_names_with_equal_hashes(monkeypatch):
    monkeypatch.setattr(periodicruns, "mix64", lambda x: x.astype(np.uint64) % np.uint64(3))
    texts = list(made_texts(6, 60))
    ids = np.array([ord(w) for t in texts for w in t], np.int32)
    found = periodicruns.find_runs(ids, np.cumsum([len(t) for t in texts]))
    assert [tuple(r) for r in found.tolist()] == [(d, *r) for d, t in enumerate(texts) for r in plain_runs(t)]


def test_thresholds_that_the_first_level_cannot_see():
    with pytest.raises(ValueError):
        periodicruns.find_runs(np.zeros(4, np.int32), np.array([4]), least=10)


def test_run_digest(spark, odd):
    rows = [(k, " ".join(t)) for k, t in enumerate(made_texts(7, 120))] + [(k, "w" + " w".join(str(j % (k + 7)) for j in range(300))) for k in range(1000, 1040)]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    for r in periodicruns.run_digest(made).collect():
        assert tuple(r)[1:] == digest(r.doc_id, dict(rows)[r.doc_id]), r.doc_id
    long = {5}  # the brute force takes too long for it
    got = [r for r in periodicruns.run_digest(odd).collect() if r.doc_id not in long]
    expected = [(r.doc_id, *digest(r.doc_id, r.text)) for r in odd.collect() if r.doc_id not in long]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    assert periodicruns.run_digest(odd.limit(0)).count() == 0


def test_very_long_period_and_text(spark):
    words = [str(k) for k in range(20_000)] * 3
    made = spark.createDataFrame([(1, " ".join(["x", *words, "y"])), (2, "z " * 200_000)], "doc_id long, text string")
    got = {r.doc_id: r for r in periodicruns.periodic_runs(made).collect()}
    assert [tuple(r) for r in got[1].runs] == [(1, 60_000, 20_000)] and got[1].collapsed.split() == ["x", *words[:20_000], "y"]
    assert [tuple(r) for r in got[2].runs] == [(0, 200_000, 1)] and got[2].collapsed == "z"

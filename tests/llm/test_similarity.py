import hashlib
import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from codegraph.llm import common, jaccardjoin, linededup, lshforest
from codegraph.llm.queries import ORACLE_SQL


def shingles(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ")
    words = [w for w in words if w]
    if not words:
        return set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)}


def brute_components(rows):
    sets = {(i, t): shingles(t) for i, t in rows}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            root[find(a)] = find(b)
    groups = defaultdict(list)
    for k in sets:
        groups[find(k)].append(k[0])
    return {k: (len(sets[k]), min(groups[find(k)])) for k in sets}


def families(seed, n=60):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmnopqrst") + str(rng.randint(0, 30))
    passage = " ".join(word() for _ in range(40))
    rows = []
    for k in range(n):
        base = [word() for _ in range(rng.choice([3, 5, 20, 60, 200]))]
        for c in range(rng.randint(1, 6)):
            copy = [word() if rng.random() < rng.choice([0, 0.01, 0.03, 0.06]) else w for w in base]
            text = " ".join(copy)
            rows.append((k * 100 + c, text.upper() if c == 3 else text + (" " + passage if k % 4 == 0 else "")))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block, exact", [(1024, False), (8, False), (8, True)])
def test_components_are_those_of_all_pairs(spark, monkeypatch, block, exact):
    monkeypatch.setattr(jaccardjoin, "BLOCK", block)
    rows = families(block)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccardjoin.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), exact=exact).collect()}
    want = {i: v for (i, _), v in brute_components(rows).items()}
    assert found == want


def test_odd_documents(spark, odd):
    rows = jaccardjoin.jaccard_components(odd).collect()
    assert len(rows) == odd.count()
    assert {(r.doc_id, r.component_id) for r in rows} == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 6), (7, 7), (8, 1), (None, None)}
    assert {r.doc_id for r in jaccardjoin.keep_one(odd).collect()} == {1, 2, 3, 4, 5, 6, 7, None}
    assert jaccardjoin.jaccard_components(odd.limit(0)).count() == 0


def test_whole_prefixes_find_pairs_that_sketches_miss(spark, monkeypatch):
    """Texts made so that what differs comes first in the order of hashes."""
    rng = random.Random(3)
    words = [f"w{rng.randint(0, 10**9)}" for _ in range(1200)]
    hashed = lambda w: list(jaccardjoin.shingle_sets(pa.array([" ".join(w)])))[0]
    a = [words[k : k + 5] for k in range(0, 1200, 5)]
    low = sorted(range(240), key=lambda k: int(hashed(a[k])[0]))
    parts = [[w for k in range(240) if k not in drop for w in (*a[k], "|", "|", "|", "|")] for drop in (set(low[:8]), set(low[8:16]))]
    table = spark.createDataFrame([(1, " ".join(parts[0])), (2, " ".join(parts[1]))], "doc_id long, text string")
    sets = [shingles(" ".join(p)) for p in parts]
    assert 100 * len(sets[0] & sets[1]) >= 75 * len(sets[0] | sets[1])
    monkeypatch.setattr(jaccardjoin, "PREFIX", 2)
    assert {r.component_id for r in jaccardjoin.jaccard_components(table, exact=True).collect()} == {1}


def test_divide_skip():
    rng = random.Random(4)
    for _ in range(200):
        lists = [sorted(rng.sample(range(60), rng.randint(0, 30))) for _ in range(rng.randint(0, 12))]
        least = rng.randint(1, 8)
        counts = Counter(x for one in lists for x in one)
        assert sorted(jaccardjoin.divide_skip(lists, least)) == sorted((x, n) for x, n in counts.items() if n >= least)


def test_long_and_short_blocks_agree():
    rng = random.Random(1)
    for _ in range(60):
        first, base = rng.getrandbits(32), [rng.getrandbits(32) for _ in range(50)]
        sets = [np.array(sorted({x for x in base if rng.random() < 0.7} | {rng.getrandbits(32) for _ in range(rng.randint(0, 9))})[:31], "<u8") for _ in range(rng.randint(2, 60))]
        sets = [np.unique(np.append(x, np.uint64(first))) for x in sets]
        sizes = [len(x) + rng.randint(0, 8) for x in sets]
        comps = [rng.choice([1, 1, 2, 3, k + 10]) for k in range(len(sets))]
        masks = [rng.getrandbits(32) & ((1 << len(x)) - 1) | 1 << x.tolist().index(first) for x in sets]
        columns = [sizes, comps, masks, [rng.randint(0, 1) for _ in sets], [rng.random() < 0.5 for _ in sets]]
        often, times = Counter(comps).most_common(1)[0]
        found = [{frozenset((k, m)) for k, others in search(sets, columns, len(sets) % 2 == 0, first, often if times > 1 else None) for m in others} for search in (jaccardjoin._sparse_pairs, jaccardjoin._dense_pairs)]
        assert found[0] == found[1]


def brute_lines(rows):
    """Lines that go, by the definition."""
    at = [((i, k), tuple(line.split())) for i, t in rows for k, line in enumerate((t or "").split("\n")) if line.split()]
    first = {}
    for place, words in sorted(at):
        first.setdefault(words, place)
    near = set()
    for (a, x), (b, y) in combinations([(w, p) for w, p in first.items()], 2):
        if min(len(a), len(b)) >= linededup.NEAR_WORDS and abs(len(a) - len(b)) <= 1 and linededup.word_distance(" ".join(a), " ".join(b)) <= 1:
            near.add(max(x, y))
    return {place for place, words in at if first[words] in near or place != first[words]}


@pytest.mark.parametrize("block", [2048, 3])
def test_lines(spark, monkeypatch, block):
    monkeypatch.setattr(linededup, "BLOCK", block)
    rng = random.Random(6)
    pool = [" ".join(rng.choice("abcdef") + str(rng.randint(0, 20)) for _ in range(rng.choice([2, 7, 8, 9, 15, 16, 40]))) for _ in range(40)]

    def edited():
        words = rng.choice(pool).split()
        for _ in range(rng.choice([0, 1, 1, 2])):
            k = rng.randrange(len(words))
            words = rng.choice([words[:k] + words[k + 1 :], words[:k] + ["new" + str(rng.randint(0, 3))] + words[k:], words[:k] + ["sub" + str(rng.randint(0, 3))] + words[k + 1 :]])
        return " ".join(words)

    rows = [(d, "\n".join(edited() for _ in range(rng.randint(0, 9)))) for d in range(80)]
    gone = brute_lines(rows)
    found = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for r in found:
        lines = dict(rows)[r.doc_id].split("\n")
        assert r.text == "\n".join(x for k, x in enumerate(lines) if (r.doc_id, k) not in gone)
        assert r["__n_gone"] == sum((r.doc_id, k) in gone for k in range(len(lines)))


def test_line_bound_grows_with_the_line(spark, monkeypatch):
    monkeypatch.setattr(linededup, "BLOCK", 4)
    rng = random.Random(16)
    pool = [[rng.choice("abcdef") + str(rng.randint(0, 60)) for _ in range(n)] for n in (8, 12, 19, 20, 21, 27, 35, 60, 99)]

    def edited():
        words = list(rng.choice(pool))
        for _ in range(rng.choice([0, 1, len(words) // 10, len(words) // 10 + 1])):
            k = rng.randrange(len(words))
            words[k : k + rng.choice([0, 1, 1])] = rng.choice([[], ["new" + str(rng.randint(0, 9))]])
        return " ".join(words)

    rows = [(d, "\n".join(edited() for _ in range(rng.randint(0, 6)))) for d in range(60)]
    first = {}
    for place, words in sorted(((d, k), tuple(line.split())) for d, t in rows for k, line in enumerate(t.split("\n")) if line):
        first.setdefault(words, place)
    near = set()
    for (a, x), (b, y) in combinations(first.items(), 2):
        least = min(len(a), len(b))
        if least >= 8 and linededup.word_distance(" ".join(a), " ".join(b)) <= max(1, least // 10):
            near.add(max(x, y))
    found = linededup.line_dedup_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = {d: "\n".join(x for k, x in enumerate(t.split("\n")) if not x or (first[tuple(x.split())] not in near and first[tuple(x.split())] == (d, k))) for d, t in rows}
    assert {r.doc_id: r.text_sha256 for r in found} == {d: hashlib.sha256(t.encode()).hexdigest() for d, t in want.items()}
    one = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sum(r["__n_near"] for r in one) < sum(r.n_near for r in found)


def test_line_odd_documents(spark, odd):
    rows = linededup.dedup_lines(odd).collect()
    assert len(rows) == odd.count() and set(odd.columns) < set(rows[0].asDict())
    texts = {(r.doc_id, r.text) for r in rows}
    assert (2, None) in texts and (8, "") in texts and (None, "no id at all but words enough to make shingles of") in texts and (4, " \n\t \r\n ") in texts
    assert linededup.line_dedup_digest(odd.limit(0)).count() == 0


def test_lines_whose_keys_are_equal_by_one_hash_only_stay(spark):
    rows = [(5, 1, 2, 1), (5, 1, 2, 2), (5, 9, 2, 3), (6, 1, 0, 4), (6, 2, 1, 5)]
    variants = spark.createDataFrame([(*r, 0, 0, None, None, None) for r in rows], linededup.VARIANTS)
    assert [(r.doc_id, r.w_doc_id) for r in linededup.variant_pairs(variants).collect()] == [(2, 1)]


def test_lines_with_equal_keys_but_other_words_stay(spark, monkeypatch):
    pairs = [("a b c d e f g h", "a b c d e f g x", True), ("a b c d e f g h", "a b c d x f g y", False), ("a b c d e f g", "a b c d e f x", False)]
    batch = pa.RecordBatch.from_arrays([pa.array([k for k, _ in enumerate(pairs)]), pa.array([0] * 3), pa.array([0] * 3), *(pa.array([p[k] for p in pairs]) for k in (0, 1))], [*linededup.PLACE, "line", "w_line"])
    kept = [i for out in linededup._checked_rows([batch], 8, 0.1) for i in out.column("doc_id").to_pylist()]
    assert kept == [k for k, p in enumerate(pairs) if p[2]]


def test_lines_of_regular_patterns_are_no_copies(spark):
    morse = ["ab"[bin(k).count("1") % 2] for k in range(1024)]
    rows = [(1, " ".join(morse)), (2, " ".join("ba"[w == "b"] for w in morse)), (3, " ".join(["a", "b"] * 40)), (4, " ".join(["b", "a"] * 40))]
    found = {r.doc_id: r["__n_gone"] for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), share=0.1).collect()}
    assert found == {1: 0, 2: 0, 3: 0, 4: 1}


def test_ids_with_several_texts_keep_their_own_lines(spark):
    rows = [(1, "first line of one\nshared"), (1, "other\nshared"), (1, "other\nshared"), (2, "shared\nfirst line of one\nonly here")]
    found = Counter((r.doc_id, r.text) for r in linededup.dedup_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert found[1, "first line of one"] + found[1, "first line of one\nshared"] == 1 and found[2, "only here"] == 1
    assert sum(n * t.split("\n").count("shared") for (_, t), n in found.items()) in (1, 2)


def test_lines_post_no_more_pairs_than_edits_can_miss():
    rng = random.Random(21)
    words = [w * k for w in "abcdefghijklmnop" for k in (1, 2, 4, 9, 12)]
    texts, near = [], []
    for n in (20, 29, 40, 77, 120, 200):
        for few in (2, 7, len(words)):
            for _ in range(12):
                line = [rng.choice(words[-few:]) for _ in range(n)]
                other = list(line)
                for _ in range(rng.randint(1, n // 10)):
                    k = rng.randrange(len(other))
                    other[k : k + rng.choice([0, 1, 1])] = rng.choice([[], [rng.choice(words)], ["new"]])
                near.append(linededup.word_distance(" ".join(line), " ".join(other)) <= min(n, len(other)) // 10)
                texts += [" ".join(line), " ".join(other)]
    lines = linededup.Lines(pa.array(texts))
    limit = linededup.bounds(lines.n, 8, 0.1)
    posted = defaultdict(set)
    for line, key in zip(*linededup.posted_pairs(lines, limit), strict=True):
        posted[int(line)].add(int(key))
    both = [(2 * k, 2 * k + 1) for k in range(len(near)) if near[k] and limit[2 * k : 2 * k + 2].min() > 1]
    assert len(both) > 100 and all(posted[x] & posted[y] for x, y in both)
    assert all(len(posted[k]) <= 2 * limit[k] + 1 for k in posted)
    apart = linededup.Lines(pa.array([" ".join(f"{'long' * 5 if k % 4 == 0 else 'w'}{k}" for k in range(60))]))
    assert len(linededup.posted_pairs(apart, np.array([6]))[0]) == 7


def test_keys_of_many_lines_are_found(spark, monkeypatch):
    monkeypatch.setattr(linededup, "BLOCK", 10)
    rows = [([4, 4 * k + 400, 8 if k < 5 else 4 * k + 800],) for k in range(35)]
    table = spark.createDataFrame(rows, "keys array<long>").coalesce(1)
    assert [(r.key, r.slices) for r in linededup.hot_keys(table).collect()] == [(4, 4)]
    batches = [pa.RecordBatch.from_arrays([pa.array(x)], ["keys"]) for x in ([[1, 2], [2, 3]], [[3]], [], [[5, 5, 1], []])]
    batches[2] = batches[0].slice(0, 0)
    found = [(k, n) for b in linededup._repeated_keys(batches, 4) for k, n in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    assert found == [(2, 2), (5, 2)]


def test_sized_words_are_told_apart():
    words = ["", *("a" * k for k in range(1, 140)), *("a" * k + "b" for k in range(1, 140)), "a\0", "\0", "é", "ée", "12345678", "123456789", "123456780", "x" * 8 + "y" * 8, "y" * 8 + "x" * 8]
    hashed, counts, sizes = common.sized_words(pa.array([" ".join(words), None, "é  a\t12345678 "]), 8)
    assert counts.tolist() == [len(words) - 1, 0, 3] and sizes.tolist()[: len(words) - 1] == [len(w.encode()) for w in words[1:]]
    of = dict(zip(words[1:], hashed.tolist(), strict=False))
    assert len(set(of.values())) == len(words) - 1 and hashed[-3:].tolist() == [of["é"], of["a"], of["12345678"]]
    assert common.hashed_words(pa.array([" ".join(words), None]), 8)[1].tolist() == counts.tolist()[:2]


def test_word_distance():
    assert [linededup.word_distance(*x.split("|")) for x in ("a b c|a b c", "a b c|a c", "a b c|a x c", "a b|b a", "|a")] == [0, 1, 1, 2, 1]


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string, rank int")


def brute_nearest(rows, every, k=10):
    held = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    out = {}
    for q in (i for i in held if i % every == 0):
        far = sorted((float(np.sqrt(((held[i] - held[q]) ** 2).sum())), i) for i in held if i != q)
        out[q] = far[:k]
    return out


def test_forest(spark):
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((12, 24))
    rows = [(i, [float(x) for x in centres[i % 12] + 0.4 * rng.standard_normal(24)]) for i in range(3000)]
    table = vectors(spark, [(i, v, None, None) for i, v in rows]).repartition(3)
    found = defaultdict(list)
    for r in lshforest.nearest(table, lshforest.query_rows(table, 100)).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.score, r.vec_id))
    want = brute_nearest(rows, 100)
    assert set(found) == set(want) and all(len(v) == 10 for v in found.values())
    assert np.mean([len({i for _, i in found[q]} & {i for _, i in want[q]}) / 10 for q in want]) >= 0.9
    exact = dict(rows)
    for q, hits in found.items():
        assert hits == sorted(hits)
        for d, i in hits:
            assert abs(d - np.linalg.norm(np.array(exact[q], np.float32).astype(float) - np.array(exact[i], np.float32).astype(float))) < 1e-9


def test_forest_ties_and_unusable_vectors(spark, monkeypatch):
    monkeypatch.setattr(lshforest, "QUERY_BYTES", 200)
    same = [(i, [1.0, 2.0, 3.0], None, None) for i in range(0, 400)]
    bad = [(1000, None, None, None), (1001, [], None, None), (1002, [0.0, 0.0, 0.0], None, None), (1003, [1.0, None, 3.0], None, None), (1004, [float("nan"), 1.0, 1.0], None, None), (1100, [1.0, 2.0], None, None), (None, [1.0, 2.0, 3.0], None, None)]
    table = vectors(spark, same + bad + [same[0]]).repartition(4)
    rows = lshforest.nearest(table, lshforest.query_rows(table, 100)).collect()
    for q in (0, 100, 200, 300):
        assert [r.vec_id for r in sorted((r for r in rows if r.query_id == q), key=lambda r: r.rank)] == [i for i in range(11) if i != q][:10]
    few = vectors(spark, [(0, [1.0, 0.0], None, None), (100, [0.0, 1.0], None, None)])
    assert {(r.query_id, r["rank"], r.vec_id) for r in lshforest.nearest(few, lshforest.query_rows(few, 100)).collect()} == {(0, 1, 100), (100, 1, 0)}
    assert lshforest.nearest(few.limit(0), few.limit(0)).count() == 0


def test_oracle_is_for_a_query():
    assert set(ORACLE_SQL) == {"op6_jaccard_join"}

import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest
from pyspark.sql import functions as F

from codegraph.llm import bloomlm, mixing, toxicity


def words_of(text):
    return (text or "").encode().lower().split()


def corpus(spark, n=300):
    rng = random.Random(9)
    pool = [f"w{k}" for k in range(200)]
    phrase = " ".join(rng.choice(pool) for _ in range(30))
    rows = [(d, " ".join(rng.choice(pool) if rng.random() < 0.9 else f"Rare{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 60))) + (" " + phrase if d % 3 == 0 else "")) for d in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string"), rows


def test_lm_base_scores_and_both_ways(spark):
    table, rows = corpus(spark)
    one = {r.doc_id: r for r in bloomlm.score_documents(table, block_bytes=4000).collect()}
    two = {r.doc_id: r for r in bloomlm.score_documents(table, filter_bytes=0, block_bytes=4000).collect()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows}
    counts = Counter(w for d, t in rows if not held[d] for w in [*words_of(t), None])
    total, kinds = sum(counts.values()), len(counts)
    for d, t in rows:
        tokens = [*words_of(t), None]
        r = one[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], len(tokens), sum(counts[w] > 0 for w in tokens), total)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in tokens), rel_tol=1e-9)
        assert math.isclose(r.score, two[d].score, rel_tol=1e-12) and r.score <= 0
    gain = [(one[d].score, one[d].base_score) for d, _ in rows if held[d] and d % 3 == 0]
    assert sum(s for s, _ in gain) > sum(b for _, b in gain)


def test_lm_broadcasts_nothing_unless_allowed(spark, monkeypatch):
    table, rows = corpus(spark, 60)
    sent, send = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(value) or send(self, value))
    one = {r.doc_id: r for r in bloomlm.score_documents(table, block_bytes=2000).collect()}
    assert not sent
    two = {r.doc_id: r for r in bloomlm.score_documents(table, bloomlm.FILTER_BYTES, 2000).collect()}
    assert len(one) == len(rows) and any(isinstance(x, bloomlm.Filter) for x in sent)
    assert all(math.isclose(one[d].score, two[d].score, rel_tol=1e-12) for d, _ in rows)


def test_lm_steps_hold_little_beside_a_block():  # bytes a token, at the most
    rng = np.random.default_rng(4)
    words = np.array([f"word{k}" for k in range(40_000)])
    text = pa.array([" ".join(words[rng.zipf(1.3, 500) % len(words)]) for _ in range(2200)])
    block = pa.table({"doc_id": range(len(text)), "text": text, "held_out": [k % 7 == 2 for k in range(len(text))], "block": [0] * len(text)})

    def peak(run, *given):
        tracemalloc.start()
        out = run(*given)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return out, most / n_tokens

    n_tokens = len(bloomlm.tokens_of(text)[0])
    _, hashing = peak(bloomlm.tokens_of, text)
    packed, counting = peak(bloomlm._count_block(1, True), block)
    packed = pa.concat_tables([packed.set_column(1, "block", pa.array([k] * packed.num_rows, pa.int64())) for k in range(4)])
    answers, shard = peak(bloomlm._build_shard(True, bloomlm.BITS, bloomlm.HASHES), packed)
    found, scoring = peak(bloomlm._score_block(1, None, {"n": n_tokens, "v": 40_000, "b": 0.7, "k": 0.5}), block, answers.filter(pa.compute.equal(answers["block"], 2)))
    assert found.num_rows == len(text) and sum(found["n_tokens"].to_pylist()) == n_tokens
    assert hashing < 40 and counting < 75 and shard < 45 and scoring < 85, (hashing, counting, shard, scoring)


def test_lm_merged_keys_of_rows():
    rng = np.random.default_rng(6)
    rows = [np.unique(rng.integers(0, 300, n).astype(np.uint64)) for n in (0, 5, 200, 90)]
    counts = [rng.integers(0, 9, len(x)).astype(np.uint64) for x in rows]
    names, sums, place, ends = bloomlm._merged([bloomlm.pack(x, 6) for x in rows], [bloomlm.pack(c, 4) for c in counts], 6)
    want = Counter()
    for x, c in zip(rows, counts, strict=True):
        for key, n in zip(x.tolist(), c.tolist(), strict=True):
            want[key] += n
    assert names.tolist() == sorted(want) and sums.tolist() == [want[x] for x in sorted(want)]
    assert (names[place] == np.concatenate(rows)).all() and ends.tolist() == np.cumsum([len(x) for x in rows]).tolist()
    assert [len(x) for x in bloomlm._merged([], [], 6)] == [0, 0, 0, 0]


def test_lm_scores_are_those_of_the_formula(spark):
    table, rows = corpus(spark, 120)
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows}
    single, both = Counter(), Counter()
    for d, t in rows:
        tokens = [*words_of(t), None]
        if not held[d]:
            single.update(tokens)
            both.update(zip([None, *tokens[:-1]], tokens, strict=True))
    total, kinds = sum(single.values()), len(single)
    starts, follow = Counter(), Counter()
    for (v, _), n in both.items():
        starts[v] += n
        follow[v] += 1
    x, y = np.array([(math.log(n), math.log(follow[v])) for v, n in starts.items()]).T
    once = sum(n == 1 for n in both.values())
    slope, odds = float(x @ y / (x @ x)), max(0.05, once / max(1, sum(both.values()) - once))
    value = lambda n: float(bloomlm.VALUES[bloomlm.level(np.array([n]))[0]]) if n else 0.0

    def score(tokens):
        out = 0.0
        for v, w in zip([None, *tokens[:-1]], tokens, strict=True):
            chance, context = (value(single[w]) + 1) / (total + kinds + 1), value(single[v])
            mass = odds * context**slope
            out += min(0.0, math.log10((min(value(both[v, w]), context) + mass * chance) / (context + mass) if context else chance))
        return out

    for way in (bloomlm.FILTER_BYTES, 0):
        for r in bloomlm.score_documents(table, filter_bytes=way, bits_each=60, hashes=24).collect():  # no probe is a false positive then
            assert math.isclose(r.score, score([*words_of(dict(rows)[r.doc_id]), None]), rel_tol=1e-9)


def test_filter_never_understates():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 1 << 62, 4000).astype(np.uint64)
    counts = rng.zipf(1.5, 4000).clip(1, 10**6)
    levels = bloomlm.level(counts)
    f = bloomlm.Filter([bloomlm.Filter.build(keys, levels)])
    found = f.levels(keys, np.zeros(len(keys), np.int64))
    assert (found >= levels).all() and (found > levels).mean() < 0.05
    assert (f.levels(rng.integers(0, 1 << 62, 4000).astype(np.uint64), np.zeros(4000, np.int64)) > 0).mean() < 0.05
    assert [bloomlm.VALUES[q] for q in (0, 1, 2, 3)] == [0, 1, 2, 3] and (np.diff(bloomlm.VALUES[:40]) > 0).all()


def test_packing_of_keys():
    x = np.array([0, 1, 255, 256, (1 << 48) - 1], np.uint64)
    assert (bloomlm.unpack(bloomlm.pack(x, 6), 6) == x).all() and len(bloomlm.unpack(b"", 6)) == 0


def test_lm_odd_documents(spark, odd):
    rows = bloomlm.score_documents(odd).collect()
    assert len(rows) == odd.count() and {r.n_tokens for r in rows if r.doc_id in (2, 3, 4)} == {1}
    assert bloomlm.score_documents(odd.limit(0)).count() == 0
    held = odd.filter("doc_id is not null").withColumn("doc_id", F.lit(next(d for d in range(100) if zlib.crc32(str(d).encode()) % 7 == 2)))
    assert {(r.base_score, r.score, r.train_tokens) for r in bloomlm.score_documents(held).collect()} == {(0.0, 0.0, 0)}


def test_matching_is_that_of_every_term_at_every_word():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("ab") for _ in range(rng.randint(1, 5)))
    for _ in range(300):
        terms = {f" {word()} " if rng.random() < 0.5 else f" {word()}": rng.random() + 0.1 for _ in range(6)}
        fits = lambda term, w: w == term.strip() if term.endswith(" ") else w.startswith(term.strip())
        exceptions = {}
        for _ in range(3):
            x, y = word(), word()
            term = next((t for t in terms if fits(t, x) or fits(t, y)), None)
            if term:
                exceptions[f" {x} {y} "] = term
        words = [word() for _ in range(rng.randint(0, 30))]
        spared = set()
        for k in range(len(words) - 1):
            if term := exceptions.get(f" {words[k]} {words[k + 1]} "):
                spared.add(k if fits(term, words[k]) else k + 1)
        want = sum(max((w for t, w in terms.items() if fits(t, x)), default=0.0) for k, x in enumerate(words) if k not in spared)
        found, n = toxicity.Matcher(toxicity.Model(terms, exceptions)).weigh(f" {' '.join(words)} " if words else " ")
        assert math.isclose(found, want, abs_tol=1e-9) and n == len(words)


def test_training_text_is_bounded(spark, monkeypatch):
    rows = toxic_rows()
    documents, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(d, y) for d, _, y in rows], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 5000)
    assert 3000 < sum(len(t) for t, _ in toxicity.training_rows(documents, labels)) <= 5000


def test_folding():
    assert toxicity.fold("1D10T!! ѕсum, tr@$h 12 345 ａBc Ünïcode") == " idiot scum trash 12 345 abc unicode "
    assert toxicity.fold(None) == toxicity.fold(" .,! ") == " "


def toxic_rows():
    rng = random.Random(2)
    mild = lambda n: " ".join(rng.choice(["river", "stone", "cloud", "apple", "chair", "train"]) + str(rng.randint(0, 9)) for _ in range(n))
    rows = []
    for d in range(400):
        bad = d % 5 == 0
        word = rng.choice(["grubble", "snorfish", "zonk"]) + rng.choice(["", "s", "ing"]) if bad else "moss" if d % 7 else "holy grubble hill"
        rows.append((d, f"{mild(rng.randint(5, 60))} {word} {mild(8)}", int(bad)))
    return rows


def test_lexicon_learns_and_spares_exceptions(spark):
    rows = toxic_rows()
    documents, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(d, y, 0) for d, _, y in rows], "doc_id long, toxic int, text int")
    found = {r.doc_id: r for r in toxicity.toxicity(documents, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for d, r in found.items())
    held = [(found[d].predicted, y) for d, _, y in rows if found[d].held_out]
    assert np.mean([p == y for p, y in held]) > 0.97
    kept = {r.doc_id for r in toxicity.keep_clean(documents.withColumn("weight", F.lit("x")), labels).collect()}
    assert kept == {d for d, r in found.items() if not r.predicted}


def test_held_out_labels_are_not_read(spark):
    rows = toxic_rows()
    documents = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    make = lambda flip: spark.createDataFrame([(d, 1 - y if flip and zlib.crc32(str(d).encode()) % 4 == 2 else y) for d, _, y in rows], "doc_id long, toxic int")
    assert toxicity.training_rows(documents, make(False)) == toxicity.training_rows(documents, make(True))
    assert len(toxicity.training_rows(documents, make(False), sample=50)) == 50


def test_toxicity_odd_documents(spark, odd):
    none = spark.createDataFrame([(None, None), (1, None)], "doc_id long, toxic int")
    rows = toxicity.toxicity(odd, none).collect()
    assert len(rows) == odd.count() and {r.score for r in rows} == {0.0}
    assert toxicity.toxicity(odd.limit(0), none).count() == 0
    some = spark.createDataFrame([(1, 1), (3, 0), (7, 0), (None, 1)], "doc_id long, toxic int")
    assert toxicity.toxicity(odd, some).count() == odd.count()


@pytest.mark.parametrize("counts", [{"a": 5}, {"a": 100, "b": 7, None: 30}, {f"s{k}": 3 + k * k for k in range(12)}])
def test_pfair_windows_and_deviation(counts):
    weights = {s: 1.0 + k % 3 for k, s in enumerate(counts)}
    plan = mixing.Plan(dict(counts), weights, shares=64)
    slots = {}
    for s, n in counts.items():
        release, deadline, slot = plan.place(s, np.arange(n))
        assert (release <= slot).all() and (slot < deadline).all()
        slots.update({int(t): s for t in slot})
    assert sorted(slots) == list(range(sum(counts.values())))
    for p, end in zip(plan.phases, [*(q.start for q in plan.phases[1:]), sum(counts.values())]):
        seen = Counter()
        for t in range(p.start, end):
            seen[slots[t]] += 1
            for s, m in p.shares.items():
                assert abs(seen[s] - m / p.period * (t + 1 - p.start)) < 1


def test_schedule(spark, odd):
    rows = spark.createDataFrame([(d, f"s{d % 3}" if d % 2 else "hot", "x") for d in range(700)], "doc_id long, source string, slot string")
    found = mixing.schedule(rows).collect()
    assert len(found) == 700 and len({r.position for r in found}) == 700
    for s in {r.source for r in found}:
        ids = [r.doc_id for r in sorted(found, key=lambda r: r.position) if r.source == s]
        assert ids == sorted(ids)
    assert len(mixing.schedule(odd).collect()) == odd.count() and mixing.schedule(odd.limit(0)).count() == 0
    mixed = mixing.mix(rows, {"hot": 3.0})
    assert mixed.columns == rows.columns and mixed.count() == 700
    head = [r.source for r in mixed.limit(160).collect()]
    assert 0.3 < head.count("hot") / 160 < 0.7


def test_many_sources_share_an_entry(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_SOURCES", 3)
    rows = spark.createDataFrame([(d, f"s{d % 9}") for d in range(300)], "doc_id long, source string")
    assert len({r.position for r in mixing.schedule(rows).collect()}) == 300


def test_every_source_past_the_first_ones_keeps_its_share(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_SOURCES", 3)
    rows = spark.createDataFrame([(d, f"s{d % 40 if d % 3 else d % 5}") for d in range(6000)], "doc_id long, source string")
    found = mixing.schedule(rows).collect()
    assert sorted(r.slot for r in found if r.position % mixing.BLOCK == 0) == list(range(len({r.slot for r in found})))
    assert len({r.position for r in found}) == 6000 and all(r.release <= r.slot < r.deadline for r in found)
    counts = Counter(r.source for r in found)
    assert {(r.source, r.block) for r in found} == {(s, k) for s, n in counts.items() for k in range(-(-n // mixing.BLOCK))}
    for s in counts:
        mine = sorted((r for r in found if r.source == s), key=lambda r: r.position)
        assert [r.doc_id for r in mine] == sorted(r.doc_id for r in mine)
    named = mixing.schedule(rows, {"s39": 30.0, "s38": 10.0}).collect()
    head = Counter(r.source for r in named if r.slot < 200)
    plain = Counter(r.source for r in found if r.slot < 200)
    assert len(counts) == 40 and plain["s39"] == plain["s38"] and head["s39"] >= 2 * head["s38"]


@pytest.mark.parametrize("counts", [{"a": 5}, {"a": 9, "b": 9, None: 9}, {f"s{k}": 1 + k * k % 29 for k in range(60)}])
def test_fluid_windows_and_deviation(counts):
    weights = {s: 1.0 + k % 4 for k, s in enumerate(counts)}
    plan, slots = mixing.FluidPlan(dict(counts), weights), {}
    for s, n in counts.items():
        release, deadline, slot = plan.place(s, np.arange(n))
        assert (release <= slot).all() and (slot < deadline).all()
        slots.update({int(t): s for t in slot})
    total = sum(counts.values())
    assert sorted(slots) == list(range(total))
    got, seen = dict.fromkeys(counts, 0.0), Counter()
    for t in range(total):
        room = 1.0
        while room > 1e-9:
            live = [s for s in counts if got[s] < counts[s] - 1e-9]
            if not live:
                break
            weight = sum(weights[s] for s in live)
            step = min(room, *((counts[s] - got[s]) * weight / weights[s] for s in live))
            for s in live:
                got[s] += step * weights[s] / weight
            room -= step
        seen[slots[t]] += 1
        assert all(abs(seen[s] - got[s]) < 1 + 1e-5 for s in counts)

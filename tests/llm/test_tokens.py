import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from codegraph.llm import chunkstore, common, packing, tokencounts


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(common.tokenizer_path())
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_pieces_give_the_ids_of_whole_texts(plain):
    import pyarrow as pa

    rng = random.Random(3)
    texts = ["".join(rng.choice("ab.,!? \n\t'1é ś日_²\x1c　") for _ in range(rng.randint(0, 40))) for _ in range(1500)] + [None, "", " ", "a  b", "don't we'll's", "<|endoftext|> x"]
    made = common.encoder()
    assert [np.frombuffer(x, made.dtype).tolist() for x in made.ids(pa.array(texts))] == [plain(t) for t in texts]


def test_store_round_trip(spark, odd, plain):
    path = common.store_path(spark, "test-store")
    chunkstore.write_store(odd, path)
    want, at = [], 0
    for r in sorted(odd.collect(), key=lambda r: (r.doc_id is not None, r.doc_id)):
        ids = [*plain(r.text), 2]
        want.append((r.doc_id, at, ids))
        at += len(ids)
    key = lambda x: x[1]
    assert sorted(((r.doc_id, r.start, list(r.ids)) for r in chunkstore.reconstruct(spark, path).collect()), key=key) == want
    found = sorted(chunkstore.read_digests(spark, path).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found] == [(i, s, len(x), crc(x)) for i, s, x in want]
    chunks = spark.read.parquet(f"{path}/chunks")
    assert chunks.count() == chunks.select("hash").distinct().count() < sum(r.n_chunks for r in found)
    assert spark.read.parquet(f"{path}/manifest/level=store").count() == 1


def test_rows_of_one_id_have_a_fixed_order(spark):
    rows = [(1, "b b b"), (1, "a"), (1, None), (0, "z")]
    found = [{(r.start, r.n_tokens, r.ids_crc32) for r in chunkstore.store_documents(spark.createDataFrame(x, "doc_id long, text string").repartition(n)).collect()} for x, n in ((rows, 1), (rows[::-1], 3))]
    assert found[0] == found[1] and len(found[0]) == 4


def test_a_damaged_chunk_fails_the_read(spark, odd):
    path = common.store_path(spark, "test-damage")
    chunkstore.write_store(odd, path)
    other = common.store_path(spark, "test-damaged")
    for name in ("recipes", "manifest/level=segment"):
        spark.read.parquet(f"{path}/{name}").write.parquet(f"{other}/{name}")
    spark.read.parquet(f"{path}/chunks").withColumn("ids", F.expr("overlay(ids placing X'0101' from 1)")).write.parquet(f"{other}/chunks")
    with pytest.raises(Exception, match="damaged"):
        chunkstore.read_digests(spark, other).collect()


def test_chunks_follow_content():
    ids = np.random.default_rng(5).integers(0, 50_000, 20_000).astype(np.uint16)
    ends = chunkstore.cut_points(ids)
    assert ends[-1] == len(ids) and all(chunkstore.LEAST <= b - a <= chunkstore.MOST for a, b in zip([0, *ends], ends[:-1]))
    cut = lambda x: {x[a:b].tobytes() for a, b in zip([0, *chunkstore.cut_points(x)], chunkstore.cut_points(x))}
    shifted = np.concatenate([ids[:50], [7], ids[50:]]).astype(np.uint16)
    assert len(cut(ids) & cut(shifted)) > 0.9 * len(ends)


def test_empty_tables(spark, odd):
    none = odd.limit(0)
    assert chunkstore.store_documents(none).count() == packing.pack(none).count() == tokencounts.count_tokens(none).count() == 0


@pytest.mark.parametrize("split_tail", [True, False])
def test_packing(spark, odd, plain, split_tail):
    more = odd.unionByName(spark.range(100, 400).selectExpr("id AS doc_id", "repeat(concat('word', id, ' some '), cast(id % 97 AS int) * 9) AS text"), allowMissingColumns=True)
    rows = packing.pack(more.coalesce(3), split_tail=split_tail).collect()
    ids = Counter((r.doc_id, r.text) for r in more.collect())
    want = Counter({(i, crc([*plain(t), 1])): n for (i, t), n in ids.items()})
    whole = Counter()
    texts = {(i, len(plain(t)) + 1): [*plain(t), 1] for i, t in ids}
    for r in rows:
        part = texts[r.doc_id, r.doc_tokens]
        assert r.ids_crc32 == crc(part[r.start : r.start + r.length])
        whole[r.doc_id, r.doc_tokens] += r.length
    assert sum(whole.values()) == sum(n * len(texts[i, len(plain(t)) + 1]) for (i, t), n in ids.items()) and len(want)
    windows = {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    fills = [sum(x for _, x in p) for p in windows.values()]
    short = [f for f in fills if f < 2048]
    assert all(f & (f - 1) == 0 for f in short) if split_tail else len(short) <= 3


def test_levels_minimise_the_sum_of_squares():
    rng = np.random.default_rng(2)
    for _ in range(300):
        s = packing.SumOfSquares(16)
        s.counts[1:16] = rng.integers(0, 4, 15)
        size = int(rng.integers(1, 17))

        def cost(level, s=s, size=size):
            c = s.counts.copy()
            if level:
                c[level] -= 1
            if level + size < 16:
                c[level + size] += 1
            return int((c[1:16] ** 2).sum())

        options = [0] + [h for h in range(1, 16 - size + 1) if s.counts[h]]
        assert cost(s.level_for(size)) == min(map(cost, options))


def best_split(word, scores, longest):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        size = len(word[end - 1].encode())
        options = [(best[-1][0] + tokencounts.BYTE_SCORE * size, best[-1][1] - size)]
        options += [(best[b][0] + scores[word[b:end]], best[b][1] - 1) for b in range(max(0, end - longest), end) if word[b:end] in scores]
        best.append(max(options))
    return -best[-1][1]


def test_long_words_are_counted_without_nodes(monkeypatch):
    trie = tokencounts.Trie(tokencounts.load_scores())
    rng = random.Random(1)
    for _ in range(200):
        word = "▁" + "".join(rng.choice(["the", "ing", "a", "é", "日", "q"]) for _ in range(rng.randint(0, 30)))
        assert trie.streamed(word) == trie.insert(word)
    nodes = len(trie.score)
    monkeypatch.setattr(tokencounts, "LONG_WORD", 20)
    assert trie.insert("▁" + "ab" * 50_000) > 0 and len(trie.score) == nodes


def test_trie_counts(spark, odd):
    scores = tokencounts.load_scores()
    trie = tokencounts.Trie(scores)
    longest = max(map(len, scores))
    words = ["▁hello", "▁hell", "▁help", "▁日本語", "▁x", "▁" + "ab" * 30, "▁hello"]
    assert [trie.insert(w) for w in words] == [best_split(w, scores, longest) for w in words]
    assert len(trie.score) - 1 == len({w[:k] for w in words for k in range(1, len(w) + 1)})
    for r in tokencounts.count_tokens(odd).join(odd.select("doc_id", "text").distinct(), "doc_id").collect():
        assert r.n_tokens == sum(best_split("▁" + w, scores, longest) for w in (r.text or "").split())
    assert tokencounts.token_budget(odd).count() > 0

"""Operator 5, LM scoring: a log-frequency Bloom filter of quantised n-gram counts.

Training documents' words, word pairs and ends are counted exactly; a count c is kept as the level
q = 1 + floor(log_1.5 c) by putting (n-gram, 1) ... (n-gram, q) into a Bloom filter. To look a count up, a scorer probes
levels 1, 2, ... until one is missing. The probability of a word after another interpolates

    P(w | v) = (c(v w) + T(v) P(w)) / (c(v) + T(v)),   P(w) = (c(w) + 1) / (N + V + 1),   T(v) = K * c(v)^B

with all counts from probes; B is the Heaps exponent of words' followers, K the odds that a pair is new (pairs seen
once over pairs seen again), both from the training counts.

Documents are dealt into blocks of about BLOCK_BYTES. A block sends the sorted hashes of its distinct words and pairs,
with their counts, to shards of the key space, packed in one binary a shard; a shard adds up, builds its part of
the filter, and answers each block with the exact counts of its words, for the base score. So a frequent word is one
entry a block. Two ways give the same scores: the shards probe their own part for every block and send levels back, so
that no process holds the whole filter; or, where a caller allows a broadcast of so many bytes and the filter is no
larger, it is broadcast and the scorer probes it. Arrays beside a block's or shard's own are of STEP keys or ROUND bytes.

Defined results: a null or wordless text is its end alone; rows with a null doc_id train; repeated rows are counted and
scored each; with no training rows N and V are 0 and every log probability is 0; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold_hash, hashed_words, materialise, mix64, release, text_rounds, tidy

BLOCK_BYTES = 8 << 20
#: Blocks to a shard of the keys: a row for each block and shard, so rows grow slower, and no more of them than keys.
BLOCKS_A_SHARD = 4
#: For callers whose workers have room for a broadcast of this size.
FILTER_BYTES = 192 << 20
#: Bytes of text hashed and keys probed at a time.
ROUND, STEP = 1 << 20, 1 << 17
BITS, HASHES = 10, 6
BASE = 1.5
END = np.uint64(0x5BD1E9955BD1E995)
PAIR = np.uint64(0x9FB21C651E98DF25)
KEY_BYTES = {"u": 8, "b": 6}

PACKED = "shard long, block long, kind string, keys binary, counts binary"
SHARDS = "kind string, shard long, block long, data binary, n long, v long, once long, pairs long"


def by_step(f: Callable[..., np.ndarray], kind: type, *columns: np.ndarray) -> np.ndarray:
    """f of STEP values of each column at a time, so that what it needs for itself stays small."""
    out = np.empty(len(columns[0]), kind)
    for k in range(0, len(out), STEP):
        out[k : k + STEP] = f(*(c[k : k + STEP] for c in columns))
    return out


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens in a row (A-Z lower-cased words between ASCII white space, then the end), and each text's
    number of them."""
    parts = [hashed_words(pc.ascii_lower(part), 5) for _, part in text_rounds(column, ROUND)]
    hashed, sizes = (np.concatenate(x) for x in zip(*parts, strict=True))
    sizes = sizes + 1
    out = np.full(int(sizes.sum()), END, np.uint64)
    words = np.ones(len(out), bool)
    words[np.cumsum(sizes) - 1] = False
    out[words] = hashed
    return out, sizes


def pairs_of(tokens: np.ndarray) -> np.ndarray:
    """48-bit key of each token with the one before; an end comes before a text's first."""
    before = np.concatenate([[END], tokens[:-1]]).astype(np.uint64)
    with np.errstate(over="ignore"):
        return by_step(lambda v, w: mix64(mix64(v) * PAIR + w) >> np.uint64(16), np.uint64, before, tokens)


def pack(x: np.ndarray, width: int) -> bytes:
    """The low bytes of whole numbers, first all lowest ones: sorted keys and small counts then compress."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unpack(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, -1).T
    return out.view("<u8").reshape(-1)


def add_up(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    if counts is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[head], np.add.reduceat(counts.astype(np.int64), head) if len(keys) else counts.astype(np.int64)


def level(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / np.log(BASE) + 1e-9).astype(np.int64)


def level_values() -> np.ndarray:
    """Mean of the whole numbers at each level; 0 at level 0."""
    values = [0.0]
    for q in range(1, 64):
        low, high = int(np.ceil(BASE ** (q - 1) - 1e-6)), int(np.ceil(BASE**q - 1e-6)) - 1
        values.append((low + max(low, high)) / 2)
    return np.array(values)


VALUES = level_values()


class Filter:
    """Bit arrays of the shards, end to end."""

    def __init__(self, parts: list[bytes], hashes: int = HASHES):
        self.hashes = hashes
        sizes = np.array([len(p) for p in parts], np.uint64)
        self.bits = np.frombuffer(b"".join(parts), np.uint8)
        self.size = sizes * np.uint64(8)
        self.start = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.uint64) * np.uint64(8)

    @staticmethod
    def starts(keys: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
        """First place and step of an entry's probes."""
        with np.errstate(over="ignore"):
            one = mix64(keys + np.uint64(q) * np.uint64(0xA0761D6478BD642F))
            return one, mix64(one ^ np.uint64(0xE7037ED1A0B428DB)) | np.uint64(1)

    @classmethod
    def build(cls, keys: np.ndarray, levels: np.ndarray, bits_each: int = BITS, hashes: int = HASHES) -> bytes:
        entries = int(levels.sum())
        size = -(-max(1, entries) * bits_each // 8)
        bits = np.zeros(size * 8, bool)
        for k in range(0, len(keys), STEP):
            names, most = keys[k : k + STEP], levels[k : k + STEP]
            for q in range(1, int(most.max()) + 1):
                one, two = cls.starts(names[most >= q], q)
                for _ in range(hashes):
                    bits[one % np.uint64(size * 8)] = True
                    one = one + two
        return np.packbits(bits, bitorder="little").tobytes()

    def levels(self, keys: np.ndarray, shards: np.ndarray) -> np.ndarray:
        """Level of each key by membership probes; 0: not there."""
        return by_step(self._levels, np.uint8, keys, shards)

    def _levels(self, keys: np.ndarray, shards: np.ndarray) -> np.ndarray:
        found = np.zeros(len(keys), np.uint8)
        left = np.arange(len(keys))
        for q in range(1, len(VALUES)):
            names, size, start = keys[left], self.size[shards[left]], self.start[shards[left]]
            with np.errstate(over="ignore"):
                one, two = self.starts(names, q)
                for _ in range(self.hashes):  # a key that misses one bit needs no other
                    at = start + one % size
                    there = (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).view(bool)
                    left, size, start, two = left[there], size[there], start[there], two[there]
                    one = one[there] + two
            if not len(left):
                break
            found[left] = q
        return found


def _split(keys: np.ndarray, shards: int):
    """(shard, mask) of sorted keys."""
    shard = (keys % np.uint64(shards)).astype(np.uint16 if shards <= 1 << 16 else np.int64)  # short ones are sorted by radix
    order = np.argsort(shard, kind="stable")
    bounds = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in range(shards):
        if bounds[s] < bounds[s + 1]:
            yield s, order[bounds[s] : bounds[s + 1]]


def _count_block(shards: int, all_pairs: bool):
    def run(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        held = np.array(table.column("held_out").to_pylist(), bool)
        tokens, sizes = tokens_of(table.column("text").combine_chunks())
        trains = np.repeat(~held, sizes)
        rows = []
        pairs = pairs_of(tokens)
        for kind, keys in (("u", tokens), ("b", pairs)):
            if kind == "b" and not all_pairs:
                names, counts = add_up(keys[trains])
            else:
                names, counts = add_up(keys, trains)
            for s, at in _split(names, shards):
                rows.append((s, block, kind, pack(names[at], KEY_BYTES[kind]), pack(counts[at], 4)))
        del names, counts
        # Heaps exponent of followers: least squares of log followers on log count, over this block's words.
        before = np.concatenate([[END], tokens[:-1]]).astype(np.uint64)[trains]
        del tokens, keys
        words, counts = add_up(before)
        if len(words):
            _, once = np.unique(pairs[trains], return_index=True)
            followers = np.bincount(np.searchsorted(words, before[once]), minlength=len(words))
            x, y = np.log(counts), np.log(followers)
            rows.append((0, block, "s", np.array([x @ x, x @ y]).tobytes(), b""))
        del pairs, before
        tidy()
        return pa.table({n: pa.array([r[k] for r in rows], t) for k, (n, t) in enumerate((("shard", pa.int64()), ("block", pa.int64()), ("kind", pa.string()), ("keys", pa.binary()), ("counts", pa.binary())))})

    return run


def _merged(keys: list, counts: list, width: int) -> tuple[np.ndarray, ...]:
    """Of packed rows: the distinct keys in order, the sums of their counts, where each row's keys stand among them, and
    where the rows end. Only one copy of the keys is held beside what is made of them."""
    ends = np.cumsum([len(k) // width for k in keys], dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    names, each = np.empty(total, np.uint64), np.empty(total, np.uint32)
    for k, c, end in zip(keys, counts, ends.tolist(), strict=True):
        n = len(k) // width
        names[end - n : end], each[end - n : end] = unpack(k, width), unpack(c, 4)
    order = np.argsort(names, kind="stable")
    names = names[order]
    head = np.ones(total, bool)
    np.not_equal(names[1:], names[:-1], out=head[1:])
    names = names[head]
    each = each[order]
    sums = np.add.reduceat(each, np.flatnonzero(head), dtype=np.int64) if total else np.zeros(0, np.int64)
    del each
    place = np.empty(total, np.int32)
    place[order] = np.cumsum(head, dtype=np.int32) - np.int32(1)
    return names, sums, place, ends


def _build_shard(answer_levels: bool, bits_each: int, hashes: int):
    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        kinds, blocks = table.column("kind").to_pylist(), table.column("block").to_pylist()
        keys, counts = ([x.as_buffer() for x in table.column(c)] for c in ("keys", "counts"))
        rows, merged, filtered = [], {}, []
        stats = dict.fromkeys(("n", "v", "once", "pairs"), 0)
        for kind in "ub":
            at = [k for k, x in enumerate(kinds) if x == kind]
            names, sums, place, ends = _merged([keys[k] for k in at], [counts[k] for k in at], KEY_BYTES[kind])
            parts = [(blocks[k], slice(a, b)) for k, a, b in zip(at, [0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
            known = sums > 0
            if kind == "u":
                stats["n"], stats["v"] = int(sums.sum()), int(known.sum())
                rows += [("r", shard, block, sums[place[own]].tobytes()) for block, own in parts]
            else:
                stats["once"], stats["pairs"] = int((sums == 1).sum()), int(sums.sum())
            filtered.append((names[known], by_step(level, np.uint8, sums[known])))
            if answer_levels:
                merged[kind] = names, place, parts
            del names, sums, place, known
        names, levels = (np.concatenate(x) for x in zip(*filtered, strict=True))
        del filtered
        bits = Filter.build(names, levels, bits_each, hashes)
        del names, levels
        rows.append(("f", shard, None, b"" if answer_levels else bits))
        if answer_levels:
            own_filter = Filter([bits], hashes)
            for kind, (names, place, parts) in merged.items():
                found = own_filter.levels(names, np.zeros(len(names), np.uint8))
                rows += [(f"q{kind}", shard, block, found[place[own]].tobytes()) for block, own in parts]
            del names, place
        rows += [("s", shard, blocks[k], keys[k].to_pybytes()) for k, x in enumerate(kinds) if x == "s"]
        del merged
        tidy()
        columns = {n: pa.array([r[k] for r in rows], t) for k, (n, t) in enumerate((("kind", pa.string()), ("shard", pa.int64()), ("block", pa.int64()), ("data", pa.binary())))}
        for name, value in stats.items():
            columns[name] = pa.array([value if r[0] == "f" else None for r in rows], pa.int64())
        return pa.table(columns)

    return run


def _gather(rows: pa.Table, kind: str, names: np.ndarray, shards: int, dtype) -> np.ndarray:
    """Shards' answers in the order of a block's sorted keys."""
    out = np.zeros(len(names), dtype)
    answers = {s: d for k, s, d in zip(rows.column("kind").to_pylist(), rows.column("shard").to_pylist(), rows.column("data").to_pylist(), strict=True) if k == kind}
    for s, at in _split(names, shards):
        out[at] = np.frombuffer(answers[s], dtype)
    return out


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and where each key stands among them."""
    names, place = np.unique(keys, return_inverse=True)
    return names, place.astype(np.int32)


def _score_block(shards: int, shared, model: dict):
    def run(documents: pa.Table, answers: pa.Table) -> pa.Table:
        n = documents.num_rows
        tokens, sizes = tokens_of(documents.column("text").combine_chunks()) if n else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        words, at_word = _ranked(tokens)
        pairs, at_pair = _ranked(pairs_of(tokens)) if n else (words, at_word)
        del tokens
        exact = _gather(answers, "r", words, shards, np.int64)
        if shared is not None:
            where = lambda keys: (keys % np.uint64(shards)).astype(np.int64)
            word_level, pair_level = shared.value.levels(words, where(words)), shared.value.levels(pairs, where(pairs))
        else:
            word_level, pair_level = _gather(answers, "qu", words, shards, np.uint8), _gather(answers, "qb", pairs, shards, np.uint8)
        total, kinds = model["n"], model["v"]
        base = np.log10((exact + 1) / (total + kinds + 1))
        single = VALUES[word_level]
        chances = (single + 1) / (total + kinds + 1)
        before = np.concatenate([[np.searchsorted(words, END)], at_word[:-1]]).astype(np.int32) if n else at_word

        def log_chance(word: np.ndarray, last: np.ndarray, pair: np.ndarray) -> np.ndarray:
            p, context = chances[word], single[last]
            both = np.minimum(VALUES[pair_level[pair]], context)
            follow = model["k"] * context ** model["b"]
            seen = context > 0
            p[seen] = (both[seen] + follow[seen] * p[seen]) / (context[seen] + follow[seen])
            return np.minimum(0.0, np.log10(p))

        logs = by_step(log_chance, np.float64, at_word, before, at_pair)
        del words, pairs, at_pair, before
        first = np.cumsum(sizes) - sizes
        add = lambda x: np.add.reduceat(x, first) if n else x[:0]
        scores = pa.table({"doc_id": documents.column("doc_id"), "held_out": documents.column("held_out"), "n_tokens": pa.array(sizes), "n_known": pa.array(add((exact > 0)[at_word].astype(np.int64)), pa.int64()), "train_tokens": pa.array(np.full(n, total), pa.int64()), "base_score": pa.array(add(base[at_word]), pa.float64()), "score": pa.array(add(logs), pa.float64())})
        del at_word, logs
        tidy()
        return scores

    return run


def score_documents(documents: DataFrame, filter_bytes: int = 0, block_bytes: int = BLOCK_BYTES, bits_each: int = BITS, hashes: int = HASHES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row. `filter_bytes`: a
    filter of up to so many bytes is broadcast; 0: none is. `bits_each`: bits of the filter an entry; `hashes`: probes an
    entry."""
    spark = documents.sparkSession
    result = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    total = documents.agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))).cast("long") + 1).alias("n")).first().n
    if not total:
        return spark.createDataFrame([], result)
    blocks = max(1, -(-total // block_bytes))
    parts = -(-blocks // BLOCKS_A_SHARD)
    dealt = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", fold_hash(F.col("doc_id"), 7, 2).alias("held_out"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).alias("block"))

    def build(partitioned: bool) -> DataFrame:
        packed = dealt.groupBy("block").applyInArrow(_count_block(parts, partitioned), PACKED)
        return materialise(packed.groupBy("shard").applyInArrow(_build_shard(partitioned, bits_each, hashes), SHARDS), "lm-shards")

    partitioned = not filter_bytes
    shards = build(partitioned)
    if not partitioned:
        size = shards.filter("kind = 'f'").agg(F.sum(F.length("data")).alias("n")).first().n or 0
        if partitioned := size > filter_bytes:
            shards = build(True)
    release(spark)
    sums = shards.agg(*(F.sum(c).alias(c) for c in ("n", "v", "once", "pairs"))).first()
    heaps = np.zeros(2)
    for row in shards.filter("kind = 's'").select("data").toLocalIterator():
        heaps += np.frombuffer(bytes(row.data), np.float64)
    again = max(1, (sums.pairs or 0) - (sums.once or 0))
    model = {"n": sums.n or 0, "v": sums.v or 0, "b": float(heaps[1] / heaps[0]) if heaps[0] else 1.0, "k": max(0.05, (sums.once or 0) / again)}
    shared = None
    if not partitioned:
        bits = dict.fromkeys(range(parts), b"\0")
        for batch in shards.filter("kind = 'f'").select("shard", "data").toArrow().to_batches():
            bits.update(zip(batch.column("shard").to_pylist(), batch.column("data").to_pylist(), strict=True))
        shared = spark.sparkContext.broadcast(Filter([bits[s] for s in range(parts)], hashes))
        del bits
    answers = shards.filter("block is not null and kind <> 's'").select("block", "kind", "shard", "data")
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score_block(parts, shared, model), result)

"""Operator 8, line dedup: a deletion-neighbourhood join over the words of lines.

Lines that are equal but for white space are copies; lines of `near_words` words or more are near copies within a bound
of edits, that is words put in, left out or replaced: one, or `share` of the shorter line's words where that is more. The
earliest line, by (doc_id, line number), stays; a line goes when an earlier one equals it or is within the bound of its
text's earliest occurrence. No line goes as a near copy before its words have been held against the other's.

1. Each line gets a 128-bit hash; equal lines meet in one aggregation, for their earliest, which posts keys:
   - Where one edit is the bound, hashes of its halves: one edit leaves a half as it is.
   - Where k = 2 edits or more are, the first of its distinct pairs of neighbouring words, in one order for all, until k
     edits can't touch all of them: 2k + 1 at most, since an edit touches two pairs, and as few as k + 1 where no two are
     next to each other. Two lines within the bound share a posted one: else the line whose pairs end first in that order
     would have none of its own in the other, and more than k edits behind it. The order puts pairs that begin with a
     long word first, which are rare; any order gives the same result. All variants of a line within k edits would be
     n over k many, so the neighbourhood is that of single words in step 3 and pairs of words find the other lines.
2. Rows sorted by key are held against each other as they come: lines that share a half are asked for, and so are those
   with the same pair of words whose parities of words (64 bits, of which an edit turns two at most) are near. These come
   together again with 512 such bits of the longer ones; of the earlier lines that still fit each takes the nearest. A
   key posted by more than BLOCK lines is dealt into slices, each two of which are a block.
3. Lines that share a half emit all their variants: a hash of the line without word i, for each i in the half that may
   differ, with i (equal to another's: one word replaced at i) and without (equal to a whole line's hash: one word put
   in or left out). Equal variants join and give pairs of a line and an earlier one, as step 2 does.
4. The words of both lines of a pair decide. A line that its nearest ones don't take, and that has further ones with
   near parities, is held against all of these in its blocks, by their words.

Words are between ASCII white space. Defined results: a null text stays null, an empty one empty; blank lines stay; rows with a null doc_id stay as they are;
rows that repeat both doc_id and text count as one document and stay both; of rows that repeat a doc_id with other texts each has lines of its own;
a document may end up with no lines and an empty text; other columns are carried along, whatever their names.
"""

from __future__ import annotations

import itertools
from collections import Counter
from operator import ne

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import clear_names, materialise, mix64, release, signed, sized_words, text_rounds, widened

NEAR_WORDS = 8
#: Of a line's words, what may differ in op8 and in the pipeline; more than MOST_SHARE leaves no pair of words in common.
SHARE = 0.1
MOST_SHARE = 0.25
BLOCK = 2048
#: Lines that may differ in so many words have LONG_BITS further parities, since 64 are too few to tell them apart.
LONG_LIMIT, LONG_BITS = 8, 512
#: Keys with so many rows that they are dealt into slices are broadcast up to this number, 16 bytes each.
HOT_KEYS = 1_000_000
#: So many posted keys are counted at a time for hot ones.
COUNTED_KEYS = 4_000_000
SEEDS = (0x1E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
#: A pair's number has so many bits below its order by length.
PAIR_BITS = 41
#: Bytes of text whose words' arrays stay in a processor's cache.
LINE_ROUND = 500_000
#: What names a line: its document's id, its place there and a hash of the text, for ids that come with several texts.
PLACE = ["doc_id", "line_no", "t"]


def word_distance(a: str, b: str) -> int:
    """Levenshtein distance in words."""
    x, y = a.split(), b.split()
    row = list(range(len(y) + 1))
    for i, p in enumerate(x, 1):
        last, row[0] = row[0], i
        for j, q in enumerate(y, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (p != q))
    return row[-1]


def bounds(n, near_words: int, share: float):
    """Edits within which a line of n words is a near copy of one that isn't shorter."""
    return np.where(n >= near_words, np.maximum(1, np.floor(np.asarray(n) * share + 1e-9)), 0).astype(np.int64)


def within(x: list[str], y: list[str], limit: int) -> bool:
    """Whether word_distance is at most `limit`: the furthest place on each diagonal, edit by edit."""
    if len(x) == len(y) and sum(map(ne, x, y)) <= limit:
        return True
    n, m = len(x), len(y)
    last: dict[int, int] = {}
    for edits in range(limit + 1):
        far = {}
        for d in range(max(-min(edits, n), m - n - limit + edits), min(edits, m, m - n + limit - edits) + 1):
            i = max(last.get(d, -2) + 1, last.get(d - 1, -2), last.get(d + 1, -2) + 1, 0 if not edits else -2)
            if i < 0:
                continue
            i = min(i, n, m - d)
            while i < n and i + d < m and x[i] == y[i + d]:
                i += 1
            far[d] = i
        if far.get(m - n, -1) >= n:
            return True
        last = far
    return False


def placed(words: np.ndarray, at: np.ndarray, seed: int) -> np.ndarray:
    """A hash of each word at its place; the sum over a run of words is the run's hash."""
    with np.errstate(over="ignore"):
        return mix64(words ^ ((at + 1).astype(np.uint64) * np.uint64(SEEDS[1]) + np.uint64(seed)))


def tagged(hashes: np.ndarray, *tags) -> np.ndarray:
    """A hash that differs with the tags as well."""
    with np.errstate(over="ignore"):
        for t in tags:
            hashes = mix64(hashes + (np.asarray(t).astype(np.uint64) + np.uint64(1)) * np.uint64(SEEDS[1]))
    return hashes


def sums(values: np.ndarray) -> np.ndarray:
    """Sums modulo 2^64 of what is before each place."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=out[1:])
    return out


class Lines:
    """Words of lines and their hashes by place."""

    def __init__(self, lines: pa.Array):
        self.words, self.n, self.lengths = sized_words(lines, 8)
        some = self.n > 0
        self.some, self.n = some, self.n[some]
        self.begin = np.cumsum(self.n) - self.n
        self.at = np.arange(len(self.words)) - np.repeat(self.begin, self.n)
        self.front = [placed(self.words, self.at, seed) for seed in SEEDS[:2]]
        self.before = [sums(x) for x in self.front]

    def whole(self, k: int) -> np.ndarray:
        """Hash k of each line."""
        return tagged(self.before[k][self.begin + self.n] - self.before[k][self.begin], self.n)


def posted_pairs(lines: Lines, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(line, key): of each line with a limit of 2 or more its first distinct pairs of neighbouring words, up to the first
    that `limit` edits can't all touch."""
    many = np.flatnonzero(limit > 1)
    begin, size = lines.begin[many], lines.n[many] - 1
    line = np.repeat(np.arange(len(many)), size)
    heads = np.cumsum(size) - size
    at = np.arange(len(line)) - heads[line] + begin[line]
    with np.errstate(over="ignore"):
        pair = mix64(lines.words[at] * np.uint64(SEEDS[1]) + lines.words[at + 1]) >> np.uint64(64 - PAIR_BITS)
    pair |= (31 - np.minimum(lines.lengths[at], 31)).astype(np.uint64) << np.uint64(PAIR_BITS)
    width = np.uint64(PAIR_BITS + 5)
    # A round of text_rounds has fewer such lines than this, but for one text alone: then the order is found in two steps.
    order = np.argsort(line.astype(np.uint64) << width | pair) if len(many) < 1 << (64 - int(width)) else np.lexsort((pair, line))
    pair, line = pair[order], line[order]
    new = np.ones(len(pair), bool)
    new[1:] = (pair[1:] != pair[:-1]) | (line[1:] != line[:-1])
    pair, line, order = pair[new], line[new], order[new]
    counts = np.bincount(line, minlength=len(many))
    rank = np.arange(len(line)) - np.repeat(np.cumsum(counts) - counts, counts)
    early = rank <= 2 * limit[many][line]
    pair, line, order, rank = pair[early], line[early], order[early], rank[early]
    # An edit touches a pair, or two next to each other: so many edits touch all as there are pairs less such twos.
    there = np.full(len(at) + 2, len(at))
    there[order + 1] = rank
    start = np.zeros(len(at) + 1, bool)
    start[heads] = start[-1] = True
    more = 1 - (~start[order] & (there[order] < rank)).astype(np.int64) - (~start[order + 1] & (there[order + 2] < rank))
    edits, first = np.cumsum(more), np.flatnonzero(rank == 0)
    enough = edits - (edits[first] - more[first])[line] > limit[many][line]
    ends = np.minimum.reduceat(np.where(enough, rank, len(at)), first) if len(many) else rank
    kept = rank <= ends[line]
    return many[line[kept]], mix64(pair[kept]) & ~np.uint64(3)


def half_keys(lines: Lines, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(line, key): hashes of halves; the lowest bits of a key are 1 for a first and 2 for a second half."""
    which = np.flatnonzero(near)
    n, begin = lines.n[which], lines.begin[which]
    back = sums(placed(lines.words, np.repeat(lines.n, lines.n) - 1 - lines.at, SEEDS[2]))
    found = []
    for length, there in ((n // 2, n > 1), ((n + 1) // 2, n % 2 == 1)):
        for side, spans, start in ((1, lines.before[0], begin), (2, back, begin + n - length)):
            key = tagged(spans[start + length] - spans[start], length, np.full(len(n), side)) & ~np.uint64(3) | np.uint64(side)
            found.append((which[there], key[there]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def word_bits(lines: Lines, limit: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Of each line 64 bits, and of those with LONG_LIMIT or more LONG_BITS, each the parity of how many of its words fall on it."""
    where = mix64(lines.words)
    one = np.uint64(1) << (where & np.uint64(63))
    if not len(lines.n):
        return one, pa.nulls(0, pa.binary())
    many = limit >= LONG_LIMIT
    row, there = np.repeat(np.cumsum(many) - 1, lines.n), np.repeat(many, lines.n)
    cell = row[there] * (LONG_BITS // 64) + (where[there] >> np.uint64(6)).astype(np.int64) % (LONG_BITS // 64)
    order = np.argsort(cell, kind="stable")
    cell, ones = cell[order], one[there][order]
    long = np.zeros(int(many.sum()) * (LONG_BITS // 64), np.uint64)
    if len(cell):
        heads = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        long[cell[heads]] = np.bitwise_xor.reduceat(ones, heads)
    ends = np.concatenate([[0], np.cumsum(many)]) * (LONG_BITS // 8)
    packed = pa.BinaryArray.from_buffers(pa.binary(), len(many), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(long)])
    return np.bitwise_xor.reduceat(one, lines.begin), packed


def split_lines(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All lines, and of each the row of its text and its number there."""
    lists = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    counts = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(counts)), counts)
    return lists.flatten(), row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


LINES = "doc_id long, line_no int, t long, h1 long, h2 long, n int, bits long, long_bits binary, keys array<long>"


def _line_rows(batches, near_words, share):
    for batch in batches:
        for first, texts in text_rounds(batch.column("text"), LINE_ROUND):
            held, row, number = split_lines(texts)
            lines = Lines(held)
            if not len(lines.n):
                continue
            rows = pa.array(row[lines.some] + first)
            limit = bounds(lines.n, near_words, share)
            near = (limit == 1) | (bounds(lines.n - 1, near_words, share) == 1)
            found = half_keys(lines, near), posted_pairs(lines, limit)
            line, key = (np.concatenate(x) for x in zip(*found, strict=True))
            key = key[np.argsort(line, kind="stable")]
            ends = np.concatenate([[0], np.cumsum(np.bincount(line, minlength=len(lines.n)))])
            keys = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(signed(key)))
            bits, long_bits = word_bits(lines, limit)
            columns = [batch.column("doc_id").take(rows), pa.array(number[lines.some].astype(np.int32)), batch.column("t").take(rows)]
            columns += [pa.array(signed(lines.whole(k))) for k in (0, 1)]
            columns += [pa.array(lines.n.astype(np.int32)), pa.array(signed(bits)), long_bits, keys]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "line_no", "t", "h1", "h2", "n", "bits", "long_bits", "keys"])


def _asked_lines(batches):
    """The lines asked for, with their words."""
    for batch in batches:
        asked = batch.column("asked")
        for first, texts in text_rounds(batch.column("text")):
            lines, row, _ = split_lines(texts)
            wanted = asked.slice(first, len(texts))
            flat = wanted.flatten()
            of = np.repeat(np.arange(len(texts)), wanted.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
            sizes = np.bincount(row, minlength=len(texts))
            held = (np.cumsum(sizes) - sizes)[of] + flat.field("line_no").to_numpy(zero_copy_only=False)
            for k in range(0, len(held), 10_000):
                which, rows = flat.slice(k, 10_000), pa.array(of[k : k + 10_000] + first)
                columns = [batch.column("doc_id").take(rows), which.field("line_no"), batch.column("t").take(rows), which.field("sides"), lines.take(pa.array(held[k : k + 10_000]))]
                yield pa.RecordBatch.from_arrays(columns, [*PLACE, "sides", "line"])


VARIANTS = "key long, check long, kind int, doc_id long, line_no int, t long, w_doc_id long, w_line_no int, w_t long"


def _variant_rows(batches, near_words):
    """Whole (0), left-out (1) and replaced-word (2) keys of lines; of lines with one replaced-word key in a batch the
    earliest has it, and the others are its later partners (3)."""
    for batch in batches:
        for first, texts in text_rounds(batch.column("line")):
            lines = Lines(texts)
            keep = np.flatnonzero(lines.n >= near_words)
            if not len(keep):
                continue
            n, begin = lines.n[keep], lines.begin[keep]
            rows = np.flatnonzero(lines.some)[keep] + first
            place = [batch.column(c).take(pa.array(rows)) for c in PLACE]
            order = np.lexsort([p.to_numpy() for p in reversed(place)])
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            side = batch.column("sides").to_numpy(zero_copy_only=False)[rows]
            low, high = np.where(side & 2, 0, n // 2), np.where(side & 1, n, (n + 1) // 2)
            size = high - low
            line = np.repeat(np.arange(len(n)), size)
            at = np.arange(len(line)) - np.repeat(np.cumsum(size) - size, size) + low[line]
            word = begin[line] + at
            left, swapped = [], []
            for k in (0, 1):
                before, end = lines.before[k], begin + n
                one_less = sums(placed(lines.words, lines.at - 1, SEEDS[k]))
                left.append(tagged(before[word] - before[begin[line]] + one_less[end[line]] - one_less[word + 1], n[line] - 1))
                swapped.append(tagged(before[end[line]] - before[begin[line]] - lines.front[k][word], n[line], at, np.full(len(at), 7)))
            once = np.ones(len(line), bool)  # equal neighbours leave the same words
            once[1:] = (left[0][1:] != left[0][:-1]) | (left[1][1:] != left[1][:-1]) | (line[1:] != line[:-1])
            yield _variants([lines.whole(k)[keep] for k in (0, 1)], 0, place, np.arange(len(n)))
            yield _variants([x[once] for x in left], 1, place, line[once])
            order = np.lexsort((rank[line], swapped[1], swapped[0]))
            keys, line = [x[order] for x in swapped], line[order]
            head = np.ones(len(line), bool)
            head[1:] = (keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1])
            yield _variants([x[head] for x in keys], 2, place, line[head])
            yield _variants([x[~head] for x in keys], 3, place, line[~head], line[head][np.cumsum(head) - 1][~head])


def _variants(keys, kind, place, line, witness=None):
    mine = [p.take(pa.array(line)) for p in place]
    other = [pa.nulls(len(line), p.type) for p in place] if witness is None else [p.take(pa.array(witness)) for p in place]
    return pa.RecordBatch.from_arrays([*(pa.array(signed(x)) for x in keys), pa.array(np.full(len(line), kind, np.int32)), *mine, *other], [x.split()[0] for x in VARIANTS.split(", ")])


def variant_pairs(variants: DataFrame) -> DataFrame:
    """(place, w_place): lines with an earlier one that has an equal variant, as two hashes tell."""
    key, place = ["key", "check"], F.struct(*PLACE)
    rows = lambda kind, name: variants.filter(F.col("kind") == kind).select(*key, place.alias(name))
    heads = rows(2, "mine")
    swapped = heads.join(heads.groupBy(*key).agg(F.min("mine").alias("other")), key).filter("mine > other")
    moved = rows(1, "long").join(rows(0, "short"), key)
    longer = moved.filter("long > short").select(F.col("long").alias("mine"), F.col("short").alias("other"))
    shorter = moved.filter("long < short").groupBy(F.col("short").alias("mine")).agg(F.min("long").alias("other"))
    near = variants.filter("kind = 3").select(place.alias("mine"), F.struct(*(F.col(f"w_{c}").alias(c) for c in PLACE)).alias("other"))
    return near.union(swapped.select("mine", "other")).union(longer).union(shorter).select("mine.*", *(F.col(f"other.{c}").alias(f"w_{c}") for c in PLACE))


def _checked_rows(batches, near_words, share):
    """Of lines and their partners those whose words are within the bound."""
    for batch in batches:
        lines, others = words_of(batch.column("line")), words_of(batch.column("w_line"))
        limit = bounds(np.minimum([len(x) for x in lines], [len(y) for y in others]), near_words, share).tolist()
        kept = [k for k, (x, y) in enumerate(zip(lines, others, strict=True)) if few_other_words(Counter(x), Counter(y), limit[k]) and within(x, y, limit[k])]
        yield batch.select(PLACE).take(pa.array(kept, pa.int64()))


#: A posted key's row: place and size share one number, line_no above the lowest 31 bits and n in them.
POSTED = ["key", "doc_id", "t", "at", "bits"]
FOUND = "key long, doc_id long, t long, at long, bits long, sides int"
PAIRED = "key long, doc_id long, line_no int, t long, at long, bits long, w_doc_id long, w_line_no int, w_t long, more boolean, long_bits binary"


def whole_runs(batches, name: str):
    """Tables of whole runs of equal values of a column, a run or more each."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        x = batch.column(name).to_numpy()
        if held and held[-1].column(name)[-1].as_py() != x[0]:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        last = int(np.searchsorted(x, x[-1])) if (np.diff(x) >= 0).all() else int(np.flatnonzero(np.diff(x))[-1]) + 1 if (x != x[-1]).any() else 0
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)]).combine_chunks()
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def near_bits(table: pa.Table, near_words: int, share: float):
    """(later, earlier, distance) of rows of one key that may be within the bound by their numbers of words and bits:
    all rows next to each other first, then those two apart, and so on."""
    key, bits = table.column("key").to_numpy(), table.column("bits").to_numpy().view(np.uint64)
    n = table.column("at").to_numpy() & 0x7FFFFFFF
    limit = bounds(n, near_words, share)
    pairs = (key & 3) == 0
    long = None
    if "long_bits" in table.column_names:
        long = np.zeros((len(key), LONG_BITS // 64), np.uint64)
        wide = limit >= LONG_LIMIT
        if wide.any():
            long[wide] = np.frombuffer(b"".join(table.column("long_bits").filter(pa.array(wide)).to_pylist()), np.uint64).reshape(-1, LONG_BITS // 64)
    heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    place = np.arange(len(key)) - np.repeat(heads, np.diff(np.append(heads, len(key))))
    rows, apart = np.flatnonzero(pairs & (place > 0)), 1
    while len(rows):
        other = rows - apart
        least = np.minimum(limit[rows], limit[other])
        far = np.bitwise_count(bits[rows] ^ bits[other]).astype(np.int64)
        fits = (far <= 2 * least) & (np.abs(n[rows] - n[other]) <= least)
        later, earlier, far, least = rows[fits], other[fits], far[fits], least[fits]
        if long is not None and len(later):
            both = np.flatnonzero(wide[later] & wide[earlier])
            far[both] = np.bitwise_count(long[later[both]] ^ long[earlier[both]]).sum(axis=1, dtype=np.int64)
            fits = far <= 2 * least
            later, earlier, far = later[fits], earlier[fits], far[fits]
        yield later, earlier, far
        apart += 1
        rows = rows[place[rows] >= apart]


def _found_rows(batches, near_words, share):
    """Lines that share a half with others, and those with an earlier or a later one near in its block by 64 bits."""
    for table in whole_runs(batches, "key"):
        key = table.column("key").to_numpy()
        same = np.zeros(len(key) + 1, bool)
        same[1:-1] = key[1:] == key[:-1]
        shared = same[:-1] | same[1:]
        table, key = table.filter(pa.array(shared)), key[shared]
        wanted = key & 3 > 0
        for rows, other, _ in near_bits(table, near_words, share):
            wanted[rows] = wanted[other] = True
        kept = table.filter(pa.array(wanted))
        yield from kept.append_column("sides", pa.array((key[wanted] & 3).astype(np.int32))).to_batches()


def _paired_rows(batches, near_words, share):
    """Of each block the rows with a line near by all bits, each with the nearest earlier one, if there is any."""
    for table in whole_runs(batches, "key"):
        size = table.num_rows
        best, witness, times, wanted = np.full(size, 1 << 40), np.full(size, -1), np.zeros(size, np.int64), np.zeros(size, bool)
        for rows, other, far in near_bits(table, near_words, share):
            times[rows] += 1
            wanted[rows] = wanted[other] = True
            closer = far <= best[rows]  # of equals the earliest
            best[rows[closer]], witness[rows[closer]] = far[closer], other[closer]
        some = np.flatnonzero(wanted)
        if len(some):
            doc, t, at = (table.column(c).to_numpy() for c in ("doc_id", "t", "at"))
            line, of, none = (at >> 31).astype(np.int32), witness[some], witness[some] < 0
            theirs = [pa.array(x[of], mask=none) for x in (doc, line, t)]
            mine = table.take(pa.array(some)).combine_chunks()
            columns = {c: mine.column(c) for c in mine.column_names} | {"line_no": pa.array(line[some]), **dict(zip(WITNESS, theirs, strict=True)), "more": pa.array(times[some] > 1)}
            yield from pa.table({c.split()[0]: columns[c.split()[0]] for c in PAIRED.split(", ")}).to_batches()


def _left_rows(batches, near_words, share):
    """Of blocks with lines that are still open, these and the earlier lines whose bits are near theirs."""
    for table in whole_runs(batches, "key"):
        still = table.column("open").to_numpy(zero_copy_only=False)
        wanted = np.zeros(table.num_rows, bool)
        for rows, other, _ in near_bits(table, near_words, share):
            asks = still[rows]
            wanted[rows[asks]] = wanted[other[asks]] = True
        yield from table.filter(pa.array(wanted)).to_batches()


def _near_rows(batches, near_words, share):
    """Open lines within the bound of an earlier one of their block, from rows sorted by block and place."""
    for table in whole_runs(batches, "key"):
        words = words_of(table.column("line"))
        counts = [Counter(w) for w in words]
        limit = bounds(table.column("at").to_numpy() & 0x7FFFFFFF, near_words, share)
        still, gone = table.column("open").to_numpy(zero_copy_only=False), set()
        for rows, other, _ in near_bits(table, near_words, share):
            for k, m in zip(rows.tolist(), other.tolist(), strict=True):
                least = int(min(limit[k], limit[m]))
                if still[k] and k not in gone and few_other_words(counts[k], counts[m], least) and within(words[k], words[m], least):
                    gone.add(k)
        yield from table.select(PLACE).take(pa.array(sorted(gone), pa.int64())).to_batches()


def few_other_words(x: Counter, y: Counter, limit: int) -> bool:
    """Whether each line has at most `limit` words, counted as often as they occur, that the other hasn't: an edit
    changes one word of each."""
    common = sum(min(n, y[w]) for w, n in x.items() if w in y)
    return max(x.total(), y.total()) - common <= limit


def words_of(lines) -> list[list[bytes]]:
    """Words between ASCII white space of each line, as bytes."""
    return [x.split() for x in lines.cast(pa.binary()).to_pylist()]


PLACES = "doc_id long, line_no int, t long"
WITNESS = [f"w_{c}" for c in PLACE]


def _repeated_keys(batches, size):
    """(key, n): keys that are there more than once among `size` or more posted ones of a task, and how often."""
    held, count = [], 0
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            held.append(batch.column("keys").flatten().to_numpy())
            count += len(held[-1])
        if held and (batch is None or count >= size):
            keys = np.sort(np.concatenate(held))
            heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
            times = np.diff(np.append(heads, len(keys)))
            yield pa.RecordBatch.from_arrays([pa.array(keys[heads[times > 1]]), pa.array(times[times > 1].astype(np.int64))], ["key", "n"])
            held, count = [], 0


def hot_keys(distinct: DataFrame) -> DataFrame:
    """(key, slices) of the keys that more than BLOCK lines post. A key's only row among COUNTED_KEYS isn't counted, so one
    that isn't found has at most a row more for each so many; slices change no result."""
    counted = distinct.select("keys").mapInArrow(lambda batches: _repeated_keys(batches, COUNTED_KEYS), "key long, n long")
    return counted.groupBy("key").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("slices")).filter("slices > 1")


def posted_rows(distinct: DataFrame) -> DataFrame:
    """A row for each posted key and block, blocks side by side."""
    posted = distinct.select(F.explode("keys").alias("key"), "first.doc_id", "first.t", (F.shiftleft(F.col("first.line_no").cast("long"), 31) + F.col("n")).alias("at"), "bits")
    hot = materialise(hot_keys(distinct), "hot-keys", hashes=True)
    release(hot.sparkSession)
    sliced = posted.join(F.broadcast(hot) if hot.count() <= HOT_KEYS else hot, "key", "left")
    slice_ = F.when(F.col("slices").isNotNull(), F.pmod(F.xxhash64("doc_id", "at", "t"), F.col("slices"))).cast("int")
    # Pairs of words: all other slices, since each two lines must meet. Halves: the next one, so that no line is alone.
    others = F.when(F.col("slices").isNull(), F.array(F.lit(-1))).when(F.expr("key & 3 = 0"), F.sequence(F.lit(0), F.col("slices") - 1)).otherwise(F.array(F.col("slice"), (F.col("slice") + 1) % F.col("slices")))
    block = F.when(F.col("other") < 0, F.col("key")).otherwise(F.expr("xxhash64(key, least(slice, other), greatest(slice, other)) & -4L | key & 3L"))
    rows = sliced.withColumn("slice", slice_).withColumn("other", F.explode(others)).withColumn("key", block).select(*POSTED)
    return rows.repartition("key").sortWithinPartitions("key")


def near_lines(documents: DataFrame, distinct: DataFrame, near_words: int, share: float) -> DataFrame:
    """(doc_id, line_no, t) of the distinct lines that are within the bound of an earlier one."""
    spark = documents.sparkSession
    order = ["key", "doc_id", "at", "t"]
    found = materialise(posted_rows(distinct).mapInArrow(lambda batches: _found_rows(batches, near_words, share), FOUND), "found-lines", hashes=True)
    release(spark)
    line_no = F.expr("cast(shiftright(at, 31) as int)")
    wide = distinct.filter("long_bits is not null").select(*(F.col(f"first.{c}").alias(c) for c in PLACE), "long_bits")
    rows = found.filter("sides = 0").withColumn("line_no", line_no).join(wide, PLACE, "left").select(*order, "bits", "long_bits")
    paired = materialise(rows.repartition("key").sortWithinPartitions(*order).mapInArrow(lambda batches: _paired_rows(batches, near_words, share), PAIRED), "paired-lines", hashes=True)
    nearest = paired.filter("w_t is not null").select(*PLACE, *WITNESS).distinct()
    lines = found.filter("sides > 0").select("doc_id", line_no.alias("line_no"), "t", "sides").union(paired.select(*PLACE, F.lit(0)))
    texts = fetched(documents, lines)
    release(spark)
    variants = materialise(texts.filter("sides > 0").mapInArrow(lambda batches: _variant_rows(batches, near_words), VARIANTS), "variants", hashes=True)
    held = texts.select(*PLACE, "line")
    other = held.select(*(F.col(c).alias(f"w_{c}") for c in (*PLACE, "line")))
    pairs = variant_pairs(variants).union(nearest).join(held, PLACE).join(other, WITNESS).select(*PLACE, "line", "w_line")
    gone = materialise(pairs.mapInArrow(lambda batches: _checked_rows(batches, near_words, share), PLACES).distinct(), "near-lines", hashes=True)
    release(spark)
    left = materialise(paired.filter("more").select("key", *PLACE).join(gone, PLACE, "left_anti").withColumn("open", F.lit(True)), "open-lines", hashes=True)
    if not left.take(1):
        return gone
    blocks = paired.drop(*WITNESS, "more").join(left.select("key").distinct(), "key", "left_semi").join(left, ["key", *PLACE], "left").withColumn("open", F.coalesce("open", F.lit(False)))
    blocks = materialise(blocks.repartition("key").sortWithinPartitions(*order).mapInArrow(lambda batches: _left_rows(batches, near_words, share), blocks.schema), "open-blocks")
    release(spark)
    rows = blocks.join(held, PLACE).repartition("key").sortWithinPartitions(*order)
    more = materialise(gone.union(rows.mapInArrow(lambda batches: _near_rows(batches, near_words, share), PLACES)).distinct(), "more-near-lines")
    release(spark)
    return more


def fetched(documents: DataFrame, lines: DataFrame) -> DataFrame:
    """(doc_id, line_no, t, sides, line) of the lines (doc_id, line_no, t, sides), which may repeat. They grow with the
    documents, so they are never broadcast; texts needn't be sorted to meet them."""
    asked = lines.groupBy(*PLACE).agg(F.bit_or("sides").alias("sides")).groupBy("doc_id", "t").agg(F.collect_list(F.struct("line_no", "sides")).alias("asked"))
    texts = documents.join(asked.hint("shuffle_hash"), ["doc_id", "t"]).select("doc_id", "t", "text", "asked").mapInArrow(_asked_lines, f"{PLACES}, sides int, line string")
    return materialise(texts, "texts-of-lines").dropDuplicates(PLACE)  # a document may be there twice


def kept_lines(documents: DataFrame, near_words: int = NEAR_WORDS, share: float = 0.0) -> DataFrame:
    """(doc_id, t, lines): of each text that has any, its lines that are the earliest of their words: line_no, and
    whether an earlier line is near, so that it goes."""
    if near_words < 2 or not 0 <= share <= MOST_SHARE:
        raise ValueError(f"near_words must be 2 or more and share from 0 to {MOST_SHARE}")
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("t")).filter(F.col("doc_id").isNotNull())
    lines = documents.select("doc_id", "t", "text").mapInArrow(lambda batches: _line_rows(batches, near_words, share), LINES)
    distinct = lines.groupBy("h1", "h2").agg(F.min(F.struct(*PLACE)).alias("first"), *(F.first(c).alias(c) for c in ("n", "bits", "long_bits", "keys")))
    distinct = materialise(distinct, "distinct-lines", hashes=True)
    release(documents.sparkSession)
    gone = near_lines(documents, distinct, near_words, share).withColumn("near", F.lit(True))
    marked = distinct.select("first.*").join(gone, PLACE, "left").select(*PLACE, F.coalesce("near", F.lit(False)).alias("near"))
    lists = materialise(marked.repartition("doc_id", "t").groupBy("doc_id", "t").agg(F.collect_list(F.struct("line_no", "near")).alias("lines")), "kept-lines")
    release(documents.sparkSession)
    return lists


def _without_lines(plain: DataFrame, names: dict[str, str], near_words: int, share: float) -> DataFrame:
    """A table of clear names, its text without the lines that go, and n_lines, n_gone and n_near."""
    id_name, text_name = names["doc_id"], names["text"]
    lists = kept_lines(plain.select(F.col(id_name).alias("doc_id"), F.col(text_name).alias("text")), near_words, share).withColumnsRenamed({"doc_id": "kept_doc", "t": "kept_t", "lines": "kept_lines"})
    columns = plain.columns
    at = columns.index(text_name)
    joined = plain.join(lists.hint("shuffle_hash"), (F.col(id_name).cast("long") == F.col("kept_doc")) & (F.xxhash64(text_name) == F.col("kept_t")), "left").select(*columns, F.col(id_name).isNull().alias("kept_whole"), "kept_lines")

    def run(batches):
        for batch in batches:
            lines, row, _ = split_lines(batch.column(at))
            sizes = np.bincount(row, minlength=batch.num_rows)
            there = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(lines)), 0).to_numpy(zero_copy_only=False)
            kept = batch.column("kept_lines")
            counts = pc.fill_null(kept.value_lengths(), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = kept.flatten()
            of = np.repeat(np.arange(batch.num_rows), counts)
            near = flat.field("near").to_numpy(zero_copy_only=False).astype(bool)
            stay = np.zeros(len(row), bool)
            stay[((np.cumsum(sizes) - sizes)[of] + flat.field("line_no").to_numpy(zero_copy_only=False))[~near]] = True
            whole = batch.column("kept_whole").to_numpy(zero_copy_only=False)
            gone = there & ~stay & ~whole[row]
            goes = np.bincount(row[gone], minlength=batch.num_rows)
            ends = np.concatenate([[0], np.cumsum(np.bincount(row[~gone], minlength=batch.num_rows))])
            left = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), lines.filter(pa.array(~gone)))
            texts = pc.if_else(pa.array(goes > 0), pc.binary_join(left, "\n"), batch.column(at))
            counted = np.bincount(row[there], minlength=batch.num_rows), goes, np.bincount(of[near], minlength=batch.num_rows)
            arrays = [texts if k == at else batch.column(k) for k in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*arrays, *(pa.array(v.astype(np.int64)) for v in counted)], [*columns, "n_lines", "n_gone", "n_near"])

    return joined.mapInArrow(run, widened(plain.schema, T.LongType(), "n_lines", "n_gone", "n_near"))


def dedup_lines(documents: DataFrame, near_words: int = NEAR_WORDS, share: float = 0.0) -> DataFrame:
    """The documents, all columns, with `__n_lines`, `__n_gone` and `__n_near` after them, and text without the lines that go."""
    return _without_lines(*clear_names(documents), near_words, share).toDF(*documents.columns, "__n_lines", "__n_gone", "__n_near")


def dedup_texts(documents: DataFrame, near_words: int = NEAR_WORDS, share: float = SHARE) -> DataFrame:
    """The documents, all columns, text without the lines that go and n_chars, where there is one, of what stays."""
    plain, names = clear_names(documents)
    rows = _without_lines(plain, names, near_words, share)
    if count := names.get("n_chars"):
        rows = rows.withColumn(count, F.length(names["text"]).cast(plain.schema[count].dataType))
    return rows.select(*plain.columns).toDF(*documents.columns)


def line_dedup_digest(documents: DataFrame, near_words: int = NEAR_WORDS, share: float = SHARE) -> DataFrame:
    """doc_id, n_lines (not blank), n_gone, n_near (of these the earliest of their words), n_kept, text_sha256 of what stays."""
    rows = dedup_lines(documents.select("doc_id", "text"), near_words, share)
    return rows.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_gone").alias("n_gone"), F.col("__n_near").alias("n_near"), (F.col("__n_lines") - F.col("__n_gone")).alias("n_kept"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))

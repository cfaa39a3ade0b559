"""Operator 6, n-gram Jaccard join: T-occurrence search with DivideSkip over word shingles.

A document's set is that of its distinct five-word shingles, as 64-bit hashes. Two sets of sizes a and b link when their
intersection reaches T = ceil(J/(1+J) * (a+b)), so the search for one set is a T-occurrence problem over inverted lists.

1. Equal sets are one class, named by a 64-bit hash of the set; only classes go on.
2. Short lists: under an order of shingles that is random (their hashes), each class posts its first PREFIX shingles.
   Of the first 32 of a linked pair's union each is in both with chance J, so fewer than COMMON = 8 common ones have
   a chance below 3e-9 at J = 0.75, less above; up to 96 shingles it is none, and `exact` posts as many as make it none. A class leaves out its 7 most frequent posted shingles, the long lists,
   and with fewer than 8 that another class posts too it has no partner. Each class is held against one class of each
   of its lists, that with the most shared shingles, exactly, over both whole sets; the links make provisional components.
3. Lists that still hold classes of several components are searched in blocks: DivideSkip over the posted shingles finds,
   for each class, the classes of other components with enough posted shingles in common; these pairs meet again with
   their whole sets, block by block, for the links. A list is dealt by bands of set sizes that can link, and a band beyond BLOCK
   classes into slices, each pair of which is a block, so no list is gathered in one task.
4. Links give components by label propagation with pointer jumping; every document takes its class's component.

Candidate pairs are only looked at in the block of the smallest kept shingle that both have.

Defined results: a null or wordless text has no shingle, links with nothing and is its own component; a text of fewer
words is one shingle; rows with a null doc_id make no links and have their class's component, or null; repeated rows are
equal sets; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import clear_names, forget, hashed_words, materialise, mix64, release, signed, small_batches, text_rounds

WORDS = 5
SIMILARITY = (75, 100)
PREFIX = 32
COMMON = 8
BLOCK = 1024
PAIRS_A_BATCH = 100_000
DENSE = 48
FACTOR = 0xD1342543DE82EF95


def shingle_sets(column: pa.Array, words: int = WORDS):
    """Sorted distinct shingle hashes of each whole text; letters A-Z lower-cased, words between ASCII white space."""
    for _, texts in text_rounds(column):
        hashed, counts = hashed_words(pc.ascii_lower(texts), 6)
        with np.errstate(over="ignore"):
            rolled = np.zeros(max(0, len(hashed) - words + 1), np.uint64)
            for j in range(words):
                rolled *= np.uint64(FACTOR)
                rolled += hashed[j : len(rolled) + j]
                rolled ^= rolled >> np.uint64(32)
            rolled = mix64(rolled)
            at = 0
            for n in counts.tolist():
                if n >= words:
                    s = np.sort(rolled[at : at + n - words + 1])
                    yield s[np.concatenate([[True], s[1:] != s[:-1]])]
                elif n:
                    one = np.full(1, n, np.uint64)
                    for h in hashed[at : at + n]:
                        one = mix64(one * np.uint64(FACTOR) + h)
                    yield one
                else:
                    yield np.zeros(0, np.uint64)
                at += n


def required(a: int, b: int, similarity=SIMILARITY) -> int:
    """Least intersection of linked sets of these sizes."""
    up, down = similarity
    return -(-up * (a + b) // (up + down))


def divide_skip(lists: list[list[int]], least: int, mu: float = 0.02) -> list[tuple[int, int]]:
    """(entry, count) of the entries in at least `least` of the sorted lists.

    The longest lists are set aside; the short ones are merged by a heap that skips entries which can't be frequent
    enough, and what they give is probed for in the long ones by binary search.
    """
    lists = sorted((x for x in lists if x), key=len, reverse=True)
    if least < 1 or len(lists) < least:
        return []
    longest = len(lists[0])
    aside = min(least - 1, max(int(least / (mu * math.log2(longest + 1) + 1)), 0))
    long, short = lists[:aside], lists[aside:]
    need = least - aside
    out = []
    heap = [(x[0], k) for k, x in enumerate(short)]
    heapq.heapify(heap)
    place = [0] * len(short)
    while len(heap) >= need:
        entry = heap[0][0]
        hit = []
        while heap and heap[0][0] == entry:
            hit.append(heapq.heappop(heap)[1])
        if len(hit) >= need:
            count, left = len(hit), len(long)
            for x in long:
                if count + left < least:
                    break
                at = bisect_left(x, entry)
                count += at < len(x) and x[at] == entry
                left -= 1
            if count >= least:
                out.append((entry, count))
            to = entry + 1
        else:
            while heap and len(hit) < need - 1:
                hit.append(heapq.heappop(heap)[1])
            to = heap[0][0] if heap else None
            if to is None:
                break
        for k in hit:
            at = bisect_left(short[k], to, place[k])
            place[k] = at
            if at < len(short[k]):
                heapq.heappush(heap, (short[k][at], k))
    return out


SKETCHES = "doc_id long, n_shingles long, c1 long, sketch array<long>, short binary"


def posted_count(n: int, exact: bool, prefix: int = PREFIX) -> int:
    """How many of a set's first shingles are posted: `prefix`, or as many as make linked sets have COMMON of them in
    common whatever their order, since n less the least overlap can be missing."""
    up, down = SIMILARITY
    return n - -(-up * n // down) + COMMON if exact else prefix


def shingle_sketches(documents: DataFrame, words: int = WORDS, prefix: int = PREFIX, exact: bool = False) -> DataFrame:
    """Size, class hash and posted shingles of every whole text, and these as bytes."""

    def run(batches):
        for batch in batches:
            sizes, ones, posted, shorts = [], [], [], []
            for s in shingle_sets(batch.column("text"), words):
                sizes.append(len(s))
                ones.append(class_hash(s))
                s = s[: posted_count(len(s), exact, prefix)]
                posted.append(signed(s))
                shorts.append(s.astype("<u8").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(ones, pa.int64()), pa.array(posted, pa.list_(pa.int64())), pa.array(shorts, pa.binary())], ["doc_id", "n_shingles", "c1", "sketch", "short"])

    return documents.select("doc_id", "text").mapInArrow(run, SKETCHES)


def class_hash(shingles: np.ndarray) -> int:
    return int(np.frombuffer(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), np.int64)[0])


def whole_sets(documents: DataFrame, ids: DataFrame, words: int = WORDS) -> DataFrame:
    """(id, shingles binary) of the classes (id, doc_id) asked for, one row each, from the text of that document.

    The ids grow with the documents, so they are merged with them at every size and never broadcast.
    """
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids.select("id", "doc_id").distinct().hint("merge"), "doc_id")

    def run(batches):
        for batch in batches:
            sets = list(shingle_sets(batch.column("text"), words))
            same = pa.array([class_hash(s) == i for s, i in zip(sets, batch.column("id").to_pylist(), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("id").filter(same), pa.array([s.tobytes() for s in sets], pa.binary()).filter(same)], ["id", "shingles"])

    return texts.mapInArrow(run, "id long, shingles binary").groupBy("id").agg(F.first("shingles").alias("shingles"))


def as_set(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint64)


def linked(pairs: DataFrame) -> DataFrame:
    """Of (a, b, sa, sb) rows the (a, b) whose whole sets reach the required overlap."""

    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist(), strict=True):
                x, y = as_set(a), as_set(b)
                keep.append(overlap(x, y) >= required(len(x), len(y)))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def components(classes: DataFrame, links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable. Each round takes the smallest neighbour's label and then that label's own."""
    spark = links.sparkSession
    both = materialise(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = materialise(both.select(F.col("a").alias("id")).distinct().withColumn("component", F.col("id")), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        step = labels.join(near, "id").select("id", F.least("component", "near").alias("component"), (F.col("near") < F.col("component")).alias("changed"))
        step = materialise(step, "labels")
        jump = step.select(F.col("id").alias("component"), F.col("component").alias("top"))
        labels = materialise(step.join(jump, "component").select("id", F.col("top").alias("component")), "labels")
        if not step.filter("changed").take(1):
            break
        release(spark)
    return classes.select("id").join(labels, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def within_size(a: str, b: str):
    """Sizes that can reach the similarity."""
    up, down = SIMILARITY
    return (F.col(a) * down >= F.col(b) * up) & (F.col(b) * down >= F.col(a) * up)


def enough_common(a: str, b: str, na: str, nb: str):
    """Posted shingles in common: COMMON, or what short sets need."""
    up, down = SIMILARITY
    least = F.ceil((F.col(na) + F.col(nb)) * up / (up + down))
    return F.size(F.array_intersect(a, b)) >= F.least(F.lit(COMMON), least)


def size_class(n: Column) -> Column:
    """Linked sizes are in the same class or in neighbouring ones."""
    up, down = SIMILARITY
    return F.floor(F.log(n.cast("double")) / math.log(down / up) + 1e-9).cast("int")


def blocks(rows: DataFrame) -> DataFrame:
    """Rows of lists (key, n, id, ...) with their blocks: (key, band, i, j, side).

    A row is in the bands of its size class and the next, so linked sizes meet in the upper one's band; a band beyond
    BLOCK rows is dealt into slices and each pair of slices is a block.
    """
    c = size_class(F.col("n"))
    banded = rows.withColumn("low", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("band", c + F.col("low"))
    sizes = banded.groupBy("key", "band").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("slices"), F.min("low").alias("own"), F.min("component").alias("least"), F.max("component").alias("most"))
    # A band without its own class, or of one component, has nothing to find.
    sizes = sizes.filter("own = 0 and least < most").select("key", "band", "slices")
    dealt = banded.join(sizes, ["key", "band"]).withColumn("slice", F.pmod(F.xxhash64("id"), F.col("slices")).cast("int"))
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    return pairs.withColumn("i", F.least("slice", "other")).withColumn("j", F.greatest("slice", "other")).withColumn("side", F.col("slice") == F.col("i")).drop("other", "slices", "slice")


def runs(batches, keys: list[str]):
    """Slices of record batches that hold whole groups of rows sorted by some columns, and the groups' bounds.

    One slice holds many groups: most lists are short, and a call for each would cost more than the search.
    """
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        table = table.combine_chunks()
        heads = np.zeros(table.num_rows, bool)
        for k in keys:
            x = table.column(k).to_numpy()
            heads[1:] |= x[1:] != x[:-1]
        heads[:1] = True
        at = np.flatnonzero(heads)
        if len(at) > 1:
            yield table.slice(0, int(at[-1])), at
        held = table.slice(int(at[-1])) if len(at) else None
    if held is not None and held.num_rows:
        yield held.combine_chunks(), np.array([0, held.num_rows])


BLOCK_KEYS = ["key", "band", "i", "j"]
FLAGGED = "key long, band int, i int, j int, id long, component long, partners array<long>"


def _flag_blocks(batches):
    """Of each block the members with a partner of another component by the posted shingles, with these partners."""
    up, down = SIMILARITY
    forget()
    for table, at in runs(batches, BLOCK_KEYS):
        cols = {c: table.column(c).to_pylist() for c in ("key", "band", "i", "j", "id", "n", "component", "mask", "side", "low", "short")}
        cols["mask"] = [int(m[::-1], 2) for m in cols["mask"]]
        found: dict[int, set[int]] = {}
        pairs = 0

        def flush(cols=cols, found=found):
            some = sorted(found)
            return pa.RecordBatch.from_arrays([*(pa.array([cols[c][k] for k in some], t) for c, t in (("key", pa.int64()), ("band", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("id", pa.int64()), ("component", pa.int64()))), pa.array([sorted(found[k]) for k in some], pa.list_(pa.int64()))], [*BLOCK_KEYS, "id", "component", "partners"])

        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            comps = cols["component"][a:b]
            often, times = Counter(comps).most_common(1)[0]
            if times == b - a:
                continue
            sets = [np.frombuffer(x, "<u8") for x in cols["short"][a:b]]
            search = _dense_pairs if b - a > DENSE else _sparse_pairs
            for k, others in search(sets, [cols[c][a:b] for c in ("n", "component", "mask", "low", "side")], cols["i"][a] != cols["j"][a], cols["key"][a] % (1 << 64), None if times == 1 else often):
                found.setdefault(a + k, set()).update(cols["id"][a + m] for m in others)
                for m in others:
                    found.setdefault(a + m, set())
                pairs += len(others)
            if pairs > PAIRS_A_BATCH:
                yield flush()
                found.clear()
                pairs = 0
        yield flush()


def _sparse_pairs(sets, columns, across, first, often):
    """(k, partners) of a short block, list by list."""
    up, down = SIMILARITY
    sizes, comps, masks, low, side = columns
    sets = [s.tolist() for s in sets]
    # Of a component of several none looks for partners; they are looked for by the others.
    order = sorted(range(len(sets)), key=lambda k: (comps[k] != often, sizes[k]))
    index: dict[int, list[int]] = {}
    for rank, k in enumerate(order):
        if often is None or comps[k] != often:
            lists = [index[x] for x in sets[k] if x in index]
            others = []
            for hit, count in divide_skip(lists, min(COMMON, -(-up * sizes[k] // down))):
                m = order[hit]
                if (
                    comps[m] != comps[k] and not (low[k] and low[m]) and (not across or side[k] != side[m]) and sizes[k] * down >= sizes[m] * up and sizes[m] * down >= sizes[k] * up
                    and count >= min(COMMON, required(sizes[k], sizes[m])) and _first_kept(sets[k], masks[k], sets[m], masks[m]) == first
                ):
                    others.append(m)
            if others:
                yield k, others
        for x in sets[k]:
            index.setdefault(x, []).append(rank)


def _inverted(rows: np.ndarray, keys: np.ndarray):
    """Sorted lists of rows by key: keys, bounds, rows."""
    order = np.lexsort((rows, keys))
    names, at = np.unique(keys[order], return_index=True)
    return names, np.append(at, len(keys)), rows[order].astype(np.int32)


def _lists(inverted, keys: np.ndarray) -> list[np.ndarray]:
    names, bounds, rows = inverted
    at = np.searchsorted(names, keys)
    return [rows[bounds[k] : bounds[k + 1]] for k, x in zip(at.tolist(), keys.tolist(), strict=True) if k < len(names) and names[k] == x]


def _dense_pairs(sets, columns, across, first, often):
    """The same in a long block: short lists are merged by counting, long ones probed by binary search, all entries at once."""
    up, down = SIMILARITY
    sizes, comps, _, low, side = (np.array(c) for c in columns)
    lengths = np.array([len(s) for s in sets])
    keys, rows = np.concatenate(sets), np.repeat(np.arange(len(sets)), lengths)
    everything = _inverted(rows, keys)
    # Lists of kept shingles before the block's own: a pair that meets in one of them belongs to another block.
    kept = np.concatenate([np.frombuffer(f"{m:0{n}b}"[::-1].encode(), np.uint8)[:n] == 49 for m, n in zip(columns[2], lengths.tolist(), strict=True)])
    earlier = kept & (keys < np.uint64(first))
    before = _inverted(rows[earlier], keys[earlier])
    bounds = np.cumsum(lengths) - lengths
    for k in range(len(sets)):
        if often is not None and comps[k] == often:
            continue
        fits = (comps != comps[k]) & (sizes * down >= sizes[k] * up) & (sizes[k] * down >= sizes * up)
        if often is None:
            fits[k:] = False
        else:
            fits[k:] &= comps[k:] == often
        if low[k]:
            fits &= low == 0
        if across:
            fits &= side != side[k]
        if not fits.any():
            continue
        lists = sorted(_lists(everything, sets[k]), key=len)
        least = min(COMMON, -(-up * int(sizes[k]) // down))
        aside = lists[len(lists) - (least - 1) :] if least > 1 else []
        counts = np.bincount(np.concatenate(lists[: len(lists) - len(aside)]), minlength=len(sets)) if len(lists) > len(aside) else np.zeros(len(sets), np.int64)
        hits = np.flatnonzero((counts > 0) & fits)
        found = counts[hits]
        for x in aside:
            at = np.searchsorted(x, hits)
            at[at == len(x)] = 0
            found = found + (x[at] == hits)
        need = np.minimum(COMMON, -(-up * (sizes[hits] + sizes[k]) // (up + down)))
        hits = hits[found >= need]
        own = slice(bounds[k], bounds[k] + lengths[k])
        smaller = _lists(before, keys[own][earlier[own]])
        if smaller and len(hits):
            hits = hits[np.bincount(np.concatenate(smaller), minlength=len(sets))[hits] == 0]
        if len(hits):
            yield k, hits.tolist()


def _first_kept(a: list[int], a_mask: int, b: list[int], b_mask: int) -> int:
    """The smallest posted shingle that both kept."""
    there = {x for k, x in enumerate(b) if b_mask >> k & 1}
    return next((x for k, x in enumerate(a) if a_mask >> k & 1 and x in there), -1)


def _link_blocks(batches):
    """Links between components among a block's flagged pairs, by whole sets; a component found linked needs no more."""
    forget()
    for table, at in runs(batches, BLOCK_KEYS):
        ids, comps = (table.column(c).to_pylist() for c in ("id", "component"))
        raw, listed = table.column("shingles"), table.column("partners").combine_chunks()
        listed = listed.chunk(0) if isinstance(listed, pa.ChunkedArray) else listed
        bounds, partners = listed.offsets.to_numpy(), listed.values.to_numpy()
        links = []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            place = {ids[k]: k for k in range(a, b)}
            sets = {k: as_set(raw[k].as_py()) for k in range(a, b)}
            root = {c: c for c in comps[a:b]}

            def find(c, root=root):
                while root[c] != c:
                    root[c] = root[root[c]]
                    c = root[c]
                return c

            for k in range(a, b):
                for other in partners[bounds[k] : bounds[k + 1]].tolist():
                    m = place[other]
                    x, y = sets[k], sets[m]
                    if find(comps[k]) != find(comps[m]) and overlap(x, y) >= required(len(x), len(y)):
                        links.append((ids[k], other))
                        root[find(comps[k])] = find(comps[m])
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Common entries of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum()) if len(y) else 0


def in_blocks(rows: DataFrame) -> DataFrame:
    """Rows of a block side by side."""
    return rows.repartition(*BLOCK_KEYS).sortWithinPartitions(*BLOCK_KEYS, "id")


def posted_lists(classes: DataFrame) -> DataFrame:
    """(id, doc_id, n, sketch, short, shared, kept, mask) of the classes that may have a partner.

    Linked classes have T = min(COMMON, least overlap) posted shingles in common, so each leaves out its T - 1 most
    frequent ones, the long lists, and still meets every partner in a shorter one; with fewer than T shared ones it
    has no partner.
    """
    up, down = SIMILARITY
    posted = classes.select("id", "n", F.explode("sketch").alias("key"))
    counts = posted.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    least = F.least(F.lit(COMMON), F.ceil(F.col("n") * up / down)).cast("int")
    shared = posted.join(counts, "key").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("size", "key")), asc=False).alias("keys"))
    kept = shared.filter(F.size("keys") >= least).select("id", F.size("keys").alias("shared"), F.slice(F.col("keys.key"), least, F.size("keys")).alias("kept"))
    mask = F.expr("array_join(transform(sketch, x -> if(array_contains(kept, x), '1', '0')), '')")
    return classes.join(kept, "id").select("id", "doc_id", "n", "sketch", "short", "shared", "kept", mask.alias("mask"))


def class_components(documents: DataFrame, classes: DataFrame) -> DataFrame:
    """(id, component) of the classes (id, doc_id, n, sketch): component is the smallest class id reachable."""
    spark = documents.sparkSession
    classes = materialise(posted_lists(classes), "posted")
    release(spark)
    lists = classes.select("id", "n", "shared", F.explode("kept").alias("key"))
    # The class with the most shared shingles is likelier than others the text that the rest were made from.
    leaders = lists.groupBy("key").agg(F.max_by("id", F.struct(F.col("shared") / F.least("n", F.lit(PREFIX)), "n", "id")).alias("lead"), F.count("*").alias("size")).filter("size > 1").select("key", "lead")
    pairs = lists.join(leaders, "key").filter("id <> lead").select("id", "lead").distinct()
    pairs = pairs.join(classes.select("id", "doc_id", "n", "sketch"), "id").join(classes.select(F.col("id").alias("lead"), F.col("doc_id").alias("ldoc"), F.col("n").alias("ln"), F.col("sketch").alias("ls")), "lead")
    pairs = pairs.filter(within_size("n", "ln") & enough_common("sketch", "ls", "n", "ln")).select(F.col("id").alias("a"), F.col("lead").alias("b"), "doc_id", "ldoc")
    pairs = materialise(pairs, "candidates")
    release(spark)
    wanted = pairs.select(F.col("a").alias("id"), "doc_id").union(pairs.select("b", "ldoc"))
    sets = materialise(whole_sets(documents, wanted), "whole-sets")
    release(spark)
    first = linked(pairs.select("a", "b").join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b").join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a").select("a", "b", "sa", "sb"))
    first = materialise(first, "first-links")
    release(spark)
    now = materialise(components(classes, first), "first-components")
    release(spark)

    placed = lists.select("id", "key").join(now, "id")
    open_lists = placed.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most")).filter("least < most").select("key")
    members = materialise(placed.join(open_lists, "key").join(classes.select("id", "n", "short", "mask"), "id"), "members")
    release(spark)
    flagged = in_blocks(blocks(members)).mapInArrow(_flag_blocks, FLAGGED)
    with small_batches(spark):
        flagged = materialise(flagged, "flagged")
    release(spark)
    if not flagged.take(1):
        return now
    sets = materialise(whole_sets(documents, flagged.select("id").distinct().join(classes.select("id", "doc_id"), "id")), "whole-sets")
    release(spark)
    more = in_blocks(flagged.join(sets, "id")).mapInArrow(_link_blocks, "a long, b long").distinct()
    with small_batches(spark):
        more = materialise(more, "more-links")
    release(spark)
    return components(classes, first.union(more))


def jaccard_components(documents: DataFrame, exact: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id of every row. `exact`: whole prefixes are posted, a quarter of each set, so that
    no linked pair can be missed."""
    spark = documents.sparkSession
    rows = materialise(shingle_sketches(documents, exact=exact), "sketches")
    classes = rows.filter("doc_id is not null and n_shingles > 0").groupBy("c1").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"), F.first("short").alias("short")).withColumnRenamed("c1", "id")
    classes = materialise(classes, "classes")
    release(spark)
    found = materialise(class_components(documents.filter("doc_id is not null"), classes), "components")
    release(spark)
    joined = classes.select("id", "doc_id").join(found, "id")
    least = joined.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_class = materialise(joined.join(least, "component").select(F.col("id").alias("c1"), "component_id"), "class-components")
    alone = classes.select(F.col("id").alias("c1"), "doc_id").join(of_class, "c1", "left").select("c1", F.coalesce("component_id", "doc_id").alias("component_id"))
    return rows.select("doc_id", "n_shingles", "c1").join(alone, "c1", "left").select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.coalesce("component_id", "doc_id")).alias("component_id"))


def keep_one(documents: DataFrame) -> DataFrame:
    """The documents, all columns, that have the smallest id of their component, or no id."""
    plain, names = clear_names(documents)
    doc_id = F.col(names["doc_id"])
    kept = jaccard_components(plain.select(doc_id.alias("doc_id"), F.col(names["text"]).alias("text"))).filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("kept")).distinct()
    return plain.join(kept, doc_id.cast("long") == F.col("kept"), "left").filter(F.col("kept").isNotNull() | doc_id.isNull()).select(*plain.columns).toDF(*documents.columns)

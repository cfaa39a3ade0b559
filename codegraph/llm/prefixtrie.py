"""Prefix trie of conversations: z-fast tries filled in batches by tasks, their nodes expanded and added up by Spark.

A conversation is a string of turns. Its prefixes are known by 128-bit hashes: each turn's place and contents give two
64-bit words, and a prefix has the exclusive or of its turns'. A task keeps a trie of compacted nodes, each with the turns
from its parent's depth to its own, in a dictionary by the prefix hash at the node's handle, the depth of that stretch
that is divisible by the greatest power of two. A fat binary search over those depths finds the exit node of the next
conversation in a logarithm of its turns; there an edge is split, a leaf added or a node's end marked. When a trie holds
`MOST_TURNS` its edges are expanded to a row for each depth, and the task goes on with an empty one. So tries stay small,
and a prefix that a third of all conversations share is a row or two of each task, not a group.

Conversations longer than a batch, or met at the edge of a partition, are several segments, hung up at the hash of what
comes before; no step needs all turns of one conversation together. What subtrees sum up is added over members: the
smallest member of a node is so from some depth on, so a second pass that is given this depth counts each leaf and each
node's words once, by its smallest member.

Conversations without an id take no part; equal turns of one conversation are in the order of their contents' hashes, and
repeated rows are repeated turns. Null role or text is empty. Without conversations there is no root. Two different
prefixes are taken for one with a chance of 2 ** -128 a pair. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, materialise, mix64, signed

#: Turns (of all segments) that one trie takes before it is expanded.
MOST_TURNS = 400_000
WORD = r"[^\x20\x09-\x0D]+"
TURN = "struct<a:bigint,b:bigint,words:int>"
SEGMENT = f"conv_id bigint, part int, piece int, turns array<{TURN}>"
PLACED = f"conv_id bigint, start bigint, turns array<{TURN}>, own_x bigint, own_y bigint"
NODE = "x bigint, y bigint, depth bigint, px bigint, py bigint, conv_id bigint, n_convs bigint, longest bigint"
SUMS = "x bigint, y bigint, depth bigint, n_leaves bigint, saved_tokens bigint"


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that the greatest power of two divides."""
    return high & -1 << (low ^ high).bit_length() - 1


class Segments:
    """Stretches of conversations as arrays: prefix hashes from the place each hangs at to its end, and words of turns."""

    def __init__(self):
        self.start: list[int] = []
        self.hashes: list[list[tuple[int, int]]] = []
        self.words: list[np.ndarray] = []
        self.turns = 0

    def add(self, start: int, x: np.ndarray, y: np.ndarray, words: np.ndarray) -> int:
        self.start.append(start)
        self.hashes.append(list(zip(x.tolist(), y.tolist(), strict=True)))
        self.words.append(words)
        self.turns += len(words)
        return len(self.start) - 1


class ZFastTrie:
    """Compacted nodes of segments. A node's stretch is (top, bottom] of the segment `source`; a place where segments hang
    is a node of its own whose stretch is empty."""

    def __init__(self, segments: Segments):
        self.s = segments
        self.top: list[int] = []
        self.bottom: list[int] = []
        self.source: list[int] = []
        self.parent: list[int] = []
        self.root: list[int] = []
        self.below: list[dict[tuple[int, int], int]] = []
        self.handles: dict[tuple, int] = {}
        self.roots: dict[tuple, int] = {}

    def _hash(self, source: int, depth: int) -> tuple[int, int]:
        return self.s.hashes[source][depth - self.s.start[source]]

    def _node(self, top: int, bottom: int, source: int, parent: int, root: int) -> int:
        k = len(self.top)
        for column, value in ((self.top, top), (self.bottom, bottom), (self.source, source), (self.parent, parent), (self.root, k if root < 0 else root), (self.below, {})):
            column.append(value)
        if parent >= 0:
            self.below[parent][self._hash(source, top + 1)] = k
            self._register(k)
        return k

    def _register(self, k: int) -> None:
        self.handles[self.root[k], *self._hash(self.source[k], two_fattest(self.top[k], self.bottom[k]))] = k

    def exit_node(self, source: int) -> tuple[int, int]:
        """The node in whose stretch a segment's path through the trie ends, and the depth at which it does."""
        start = self.s.start[source]
        own = self.s.hashes[source]
        low, high = start, start + len(own) - 1
        place = (start, *own[0])
        node = self.roots.get(place, -1)
        if node < 0:
            node = self.roots[place] = self._node(start, start, source, -1, -1)
        root = node
        while low < high:
            middle = two_fattest(low, high)
            found = self.handles.get((root, *own[middle - start]), -1)
            if found < 0:
                high = middle - 1
            else:
                node, low = found, self.bottom[found]
        end = start + len(own) - 1
        common = self._common(node, source, end)
        if common == self.bottom[node] and common < end:
            further = self.below[node].get(own[common + 1 - start], -1)
            if further >= 0:
                return further, self._common(further, source, end)
        return node, common

    def _common(self, node: int, source: int, end: int) -> int:
        """Depth to which a segment follows a node's stretch, of whose top it is known that it does."""
        low, high = self.top[node], min(self.bottom[node], end)
        while low < high:
            middle = (low + high + 1) // 2
            if self._hash(self.source[node], middle) == self._hash(source, middle):
                low = middle
            else:
                high = middle - 1
        return low

    def insert(self, source: int) -> int:
        """Put a segment in; the node at which it ends."""
        end = self.s.start[source] + len(self.s.hashes[source]) - 1
        node, depth = self.exit_node(source)
        if depth < self.bottom[node]:
            upper = len(self.top)
            above = self.parent[node]
            self._node(self.top[node], depth, self.source[node], above, self.root[node])
            self.top[node], self.parent[node] = depth, upper
            self.below[upper][self._hash(self.source[node], depth + 1)] = node
            self._register(node)
            node = upper
        return node if depth == end else self._node(depth, end, source, node, self.root[node])

    def bottom_up(self) -> list[int]:
        return sorted(range(len(self.top)), key=lambda k: (-self.bottom[k], self.parent[k] < 0))

    def stretch(self, k: int) -> slice:
        """The depths of a node's stretch as places in its source's hashes; a root at depth 0 has its own."""
        start = self.s.start[self.source[k]]
        return slice(0, 1) if self.parent[k] < 0 and self.bottom[k] == 0 else slice(self.top[k] + 1 - start, self.bottom[k] + 1 - start)


def _expanded(trie: ZFastTrie, ends: list[int], rows: dict[str, list[int]], weighed: bool) -> pa.RecordBatch:
    """A row for each depth of each node. First pass: smallest member, members, longest member. With weights: leaves by
    their smallest member, and words that members have again."""
    n = len(trie.top)
    members, smallest, longest = [0] * n, [1 << 63] * n, [0] * n
    first, leaves, saved = [1 << 62] * n, [0] * n, [0] * n
    for k, node in enumerate(ends):
        members[node] += 1
        if weighed:
            first[node] = min(first[node], rows["first"][k])
            leaves[node] += rows["leaf"][k]
            saved[node] += rows["after"][k]
        else:
            smallest[node] = min(smallest[node], rows["conv_id"][k])
            longest[node] = max(longest[node], rows["whole"][k])
    parts: list[tuple] = []
    for k in trie.bottom_up():
        at = trie.stretch(k)
        depths = np.arange(at.start, at.stop) + trie.s.start[trie.source[k]]
        if len(depths):
            hashes = np.array(trie.s.hashes[trie.source[k]][max(0, at.start - 1) : at.stop], np.int64)
            own = hashes[-len(depths) :]
            same = lambda value, size=len(depths): np.full(size, value)
            if weighed:
                if at.start:
                    words = trie.s.words[trie.source[k]][at.start - 1 : at.stop - 1]
                    sums = saved[k] + np.cumsum((words * (members[k] - (first[k] <= depths)))[::-1])[::-1]
                else:
                    sums = same(saved[k])
                saved[k] = int(sums[0])
                parts.append((own[:, 0], own[:, 1], depths, same(leaves[k]), sums))
            else:
                above = hashes[:-1] if at.start else own
                parts.append((own[:, 0], own[:, 1], depths, above[:, 0], above[:, 1], same(smallest[k]), same(members[k]), same(longest[k])))
        if (up := trie.parent[k]) >= 0:
            members[up] += members[k]
            first[up], leaves[up], saved[up] = min(first[up], first[k]), leaves[up] + leaves[k], saved[up] + saved[k]
            smallest[up], longest[up] = min(smallest[up], smallest[k]), max(longest[up], longest[k])
    names = [f.split()[0] for f in (SUMS if weighed else NODE).split(", ")]
    columns = [np.concatenate(c).astype(np.int64) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def turn_words(turns: pa.Array, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Two 64-bit words of each turn by its place and contents, words in its text, and the places where lists end."""
    sizes = turns.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    flat = turns.flatten()
    a, b, words = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3))
    depth = np.arange(1, len(flat) + 1) - np.repeat(ends - sizes, sizes) + np.repeat(start, sizes)
    place = mix64(depth.astype(np.uint64))
    with np.errstate(over="ignore"):
        return mix64(a.view(np.uint64) * np.uint64(0xA0761D6478BD642F) + place), mix64(b.view(np.uint64) * np.uint64(0xE7037ED1A0B428DB) + place), words, ends


def _tries(weighed: bool, most_turns: int):
    def run(batches):
        forget()
        segments, trie, ends, rows = Segments(), None, [], {}
        for batch in batches:
            named = {n: batch.column(n) for n in batch.schema.names}
            numbers = {n: c.to_pylist() for n, c in named.items() if n != "turns"}
            one, two, words, stops = turn_words(named["turns"], named["start"].to_numpy())
            begin = 0
            for k, stop in enumerate(stops.tolist()):
                if trie is None:
                    segments, ends, rows = Segments(), [], {n: [] for n in numbers}
                    trie = ZFastTrie(segments)
                path = [np.bitwise_xor.accumulate(np.concatenate([np.array([numbers[n][k]], np.int64).view(np.uint64), w[begin:stop]])) for n, w in (("x", one), ("y", two))]
                ends.append(trie.insert(segments.add(numbers["start"][k], signed(path[0]), signed(path[1]), words[begin:stop])))
                for n, values in numbers.items():
                    rows[n].append(values[k])
                begin = stop
                if segments.turns + len(ends) >= most_turns:
                    yield _expanded(trie, ends, rows, weighed)
                    trie = None
        if trie is not None:
            yield _expanded(trie, ends, rows, weighed)

    return run


def _segments(batches):
    """Neighbouring rows of one conversation as one row."""
    forget()
    piece = 0
    for batch in batches:
        ids = batch.column("conv_id").to_numpy()
        if not len(ids):
            continue
        begins = np.concatenate([[0], np.flatnonzero(np.diff(ids)) + 1])
        turns = pa.StructArray.from_arrays([batch.column(n) for n in ("a", "b", "words")], ["a", "b", "words"])
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([begins, [len(ids)]]), pa.int32()), turns)
        pieces = np.arange(piece, piece + len(begins), dtype=np.int32)
        piece += len(begins)
        yield pa.RecordBatch.from_arrays([pa.array(ids[begins]), batch.column("part").take(pa.array(begins)), pa.array(pieces), lists], ["conv_id", "part", "piece", "turns"])


def _totals(batches):
    """Segments with the exclusive or of their own turns' words."""
    forget()
    for batch in batches:
        one, two, _, ends = turn_words(batch.column("turns"), batch.column("start").to_numpy())
        upto = [np.concatenate([np.zeros(1, np.uint64), np.bitwise_xor.accumulate(w)]) for w in (one, two)]
        totals = [pa.array(signed(u[ends] ^ u[np.concatenate([[0], ends[:-1]])])) for u in upto]
        yield pa.RecordBatch.from_arrays([*batch.columns, *totals], ["conv_id", "start", "turns", "own_x", "own_y"])


def segments_of(conversations: DataFrame) -> DataFrame:
    """Turns by conversation in order, as segments with the place where each starts. Sorted by ranges, so that a very long
    conversation is shared by tasks; texts aren't moved, only their hashes and numbers of words."""
    text = F.coalesce("text", F.lit(""))
    content = lambda k: F.xxhash64(F.lit(k), F.coalesce("role", F.lit("")), text)
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), "a", "b"]
    turns = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", content(1).alias("a"), content(2).alias("b"), F.regexp_count(text, F.lit(WORD)).cast("int").alias("words"))
    ranged = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", F.spark_partition_id().alias("part"), "a", "b", "words")
    found = materialise(ranged.mapInArrow(_segments, SEGMENT), "turns")
    before = Window.partitionBy("conv_id").orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)
    return found.select("conv_id", F.coalesce(F.sum(F.size("turns").cast("long")).over(before), F.lit(0).cast("long")).alias("start"), "turns")


def with_heads(segments: DataFrame, donor: Column, head: Column, most: int) -> DataFrame:
    """Segments of conversations whose first `head` turns are those of the `donor` conversation. `most`: bound of head."""
    first = segments.filter(F.col("start") < most).groupBy("conv_id").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("start", F.slice("turns", 1, most).alias("turns")))), lambda s: s["turns"])).alias("given"))
    rows = segments.withColumn("h", head).withColumn("donor", donor).join(first.select(F.col("conv_id").alias("donor"), "given"), "donor", "left")
    given = F.slice(F.coalesce("given", F.array().cast(f"array<{TURN}>")), F.lit(1), F.col("h"))
    left = F.greatest(F.col("h") - F.col("start"), F.lit(0)).cast("int")
    own = F.slice("turns", left + 1, F.greatest(F.size("turns") - left, F.lit(0)))
    leads = F.col("start") == 0
    return rows.select("conv_id", F.when(leads, 0).otherwise(F.size(given) + F.greatest(F.col("start") - F.col("h"), F.lit(0))).cast("long").alias("start"), F.when(leads, F.concat(given, own)).otherwise(own).alias("turns"))


def hung(segments: DataFrame) -> DataFrame:
    """Segments with the prefix hash of what comes before (x, y), of their own turns, and the turns of the whole
    conversation. What came before is added up by conversation, a row a segment. Empty ones go, but for one where the
    conversation has no turns."""
    sized = segments.mapInArrow(_totals, PLACED)
    by = Window.partitionBy("conv_id")
    before = by.orderBy("start", F.size("turns")).rowsBetween(Window.unboundedPreceding, -1)
    upto = lambda c: F.coalesce(F.bit_xor(f"own_{c}").over(before), F.lit(0)).alias(c)
    found = sized.select("*", upto("x"), upto("y"), F.max(F.col("start") + F.size("turns")).over(by).alias("whole"), F.row_number().over(by.orderBy("start", F.size("turns"))).alias("nth"))
    return found.filter((F.size("turns") > 0) | (F.col("whole") == 0) & (F.col("nth") == 1)).drop("nth")


def _id_lists(batches):
    """Neighbouring conversations that end at one node as one row: their ids, joined by commas."""
    for batch in batches:
        x, y, ids = (batch.column(k).to_numpy() for k in range(3))
        if len(x):
            begins = np.concatenate([[0], np.flatnonzero((np.diff(x) != 0) | (np.diff(y) != 0)) + 1])
            texts = [",".join(map(str, part.tolist())) for part in np.split(ids, begins[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(x[begins]), pa.array(y[begins]), batch.column(3).take(pa.array(begins)), pa.array(ids[begins]), pa.array(texts)], ["x", "y", "depth", "first", "ids"])


def _list_hashes(batches):
    """SHA-256 of each node's lists in order, one after the other."""
    node, digest, done = None, None, []

    def rows():
        columns = zip(*done, strict=True) if done else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k == 3 else pa.int64()) for k, c in enumerate(columns)], ["x", "y", "depth", "ends_sha256"])

    for batch in batches:
        for x, y, depth, ids in zip(*(batch.column(n).to_pylist() for n in ("x", "y", "depth", "ids")), strict=True):
            if node == (x, y, depth):
                digest.update(b",")
            else:
                if node:
                    done.append((*node, digest.hexdigest()))
                node, digest = (x, y, depth), hashlib.sha256()
            digest.update(ids.encode())
        yield rows()
        done.clear()
    if node:
        done.append((*node, digest.hexdigest()))
        yield rows()


def end_hashes(paths: DataFrame) -> DataFrame:
    """(x, y, depth, ends_sha256) of nodes at which conversations end. Ids are sorted by ranges and joined there, so that
    the ids of one node come together as few long texts, hashed as a stream."""
    end = lambda c: F.col(c).bitwiseXOR(F.col(f"own_{c}")).alias(c)
    ends = paths.filter(F.col("start") + F.size("turns") == F.col("whole")).select(end("x"), end("y"), "conv_id", F.col("whole").alias("depth"))
    lists = ends.repartitionByRange("x", "y", "conv_id").sortWithinPartitions("x", "y", "conv_id").mapInArrow(_id_lists, "x bigint, y bigint, depth bigint, first bigint, ids string")
    return lists.repartition("x", "y").sortWithinPartitions("x", "y", "first").mapInArrow(_list_hashes, "x bigint, y bigint, depth bigint, ends_sha256 string")


def prefix_nodes(paths: DataFrame, most_turns: int = MOST_TURNS) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of every node.
    `paths`: as of `hung`."""
    paths = materialise(paths, "paths")
    key = ["x", "y", "depth"]
    found = paths.select("conv_id", "start", "turns", "x", "y", "whole").mapInArrow(_tries(False, most_turns), NODE).groupBy(key).agg(F.min("px").alias("px"), F.min("py").alias("py"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.max("longest").alias("longest"))
    nodes = materialise(found, "nodes")
    smallest = nodes.groupBy("conv_id").agg(F.min("depth").alias("first"), F.max((F.col("longest") == F.col("depth")).cast("long")).alias("leaf"))
    led = paths.join(smallest, "conv_id", "left").withColumn("first", F.coalesce("first", F.col("whole") + 1)).withColumn("leaf", F.coalesce("leaf", F.lit(0)))
    here = F.aggregate(F.slice("turns", F.lit(1), F.greatest(F.lit(0).cast("long"), F.least(F.size("turns").cast("long"), F.col("first") - 1 - F.col("start"))).cast("int")), F.lit(0).cast("long"), lambda a, t: a + t["words"])
    later = Window.partitionBy("conv_id").orderBy(F.desc("start"), F.desc(F.size("turns"))).rowsBetween(Window.unboundedPreceding, -1)
    led = led.withColumn("after", F.coalesce(F.sum(here).over(later), F.lit(0)))
    sums = led.select("conv_id", "start", "turns", "x", "y", "first", "leaf", "after").mapInArrow(_tries(True, most_turns), SUMS)
    children = nodes.filter("depth > 0").select(F.col("px").alias("x"), F.col("py").alias("y"), (F.col("depth") - 1).alias("depth"), F.lit(1).cast("long").alias("n_children"))
    whole = nodes.drop("longest").unionByName(sums, allowMissingColumns=True).unionByName(children, allowMissingColumns=True).unionByName(end_hashes(paths), allowMissingColumns=True)
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    rows = whole.groupBy(key).agg(*(F.min(c).alias(c) for c in ("px", "py", "conv_id", "n_convs")), zero("n_children"), zero("n_leaves"), zero("saved_tokens"), F.coalesce(F.min("ends_sha256"), F.sha2(F.lit(""), 256)).alias("ends_sha256"))
    up = nodes.select(F.col("x").alias("px"), F.col("y").alias("py"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"))
    return rows.join(up, ["px", "py", "depth"], "left").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def conversation_nodes(conversations: DataFrame, most_turns: int = MOST_TURNS) -> DataFrame:
    """Nodes of the trie of whole conversations."""
    return prefix_nodes(hung(segments_of(conversations)), most_turns)


def shared_head_nodes(conversations: DataFrame, most_turns: int = MOST_TURNS) -> DataFrame:
    """Nodes of the trie of conversations that begin with up to three turns of the one whose id is the next lower multiple of 20."""
    conv = F.col("conv_id")
    head = (F.crc32(conv.cast("string").cast("binary")) % 4).cast("int")
    return prefix_nodes(hung(with_heads(segments_of(conversations), conv - conv % 20, head, 3)), most_turns)

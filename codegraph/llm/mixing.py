"""Operator 10, mixing sources to target weights by Pfair scheduling.

A source's documents, in doc_id order, form blocks. With m of M shares, its block i is released at slot
floor(i*M/m) and due by slot ceil((i+1)*M/m); each slot goes to the released block with the earliest deadline. Since
the shares sum to M, every deadline is met and at any slot each source is less than one block from its share. A schedule
repeats after M slots, so one period for each set of sources still supplied is all that is computed on the driver;
a document's slot follows from its place in its source by arithmetic, in parallel. When a source runs out, the others
go on with their shares scaled up: every document gets exactly one place.

Driver and broadcast: counts of sources and one period for each phase: SHARES + 16 * sources entries, times the number
of sources. That grows with the square of the sources, so past MOST_SOURCES of them FluidPlan has the windows of every
source in one phase, by exact fractions, and the slot of each block: 24 bytes a block and a count for each source and
partition.

Defined results: a null source is a source of its own; documents with a null doc_id come first in their source;
repeated rows each get a place; an empty table gives no rows; other columns are carried along by `mix` and not read by
`schedule`.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import clear_names, forget, materialise, widened

BLOCK = 16
SHARES = 2048
ALPHA = 0.7
MOST_SOURCES = 1000
WEIGHT_BITS = 31
ROWS_A_PART = 100_000
BYTES_A_PART = 32 << 20


def integer_shares(weights: dict, total: int) -> dict:
    """Largest remainders; each positive weight has 1 share at least."""
    names = sorted(weights, key=lambda s: (s is not None, s))
    scale = sum(weights.values())
    exact = {s: weights[s] / scale * (total - len(names)) for s in names}
    shares = {s: 1 + int(exact[s]) for s in names}
    for s in sorted(names, key=lambda s: (int(exact[s]) - exact[s], s is not None, s))[: total - sum(shares.values())]:
        shares[s] += 1
    return shares


def pfair_period(shares: dict) -> list:
    """The source of each slot of one period: earliest deadline first among released blocks."""
    names = list(shares)
    total = sum(shares.values())
    future = [(0, k, 0) for k in range(len(names))]
    ready: list[tuple[int, int, int]] = []
    slots = []
    for t in range(total):
        while future and future[0][0] <= t:
            _, k, i = heapq.heappop(future)
            heapq.heappush(ready, (-(-(i + 1) * total // shares[names[k]]), k, i))
        _, k, i = heapq.heappop(ready)
        slots.append(names[k])
        heapq.heappush(future, ((i + 1) * total // shares[names[k]], k, i + 1))
    return slots


@dataclass
class Phase:
    start: int
    shares: dict
    period: int
    slots: dict  # source: slots of its blocks within a period
    first: dict  # source: its blocks placed in earlier phases


class Plan:
    """The phases of a schedule of `blocks` blocks a source."""

    def __init__(self, blocks: dict, weights: dict, shares: int = SHARES):
        self.phases: list[Phase] = []
        left = {s: n for s, n in blocks.items() if n > 0}
        done = dict.fromkeys(left, 0)
        start = 0
        while left:
            m = integer_shares({s: weights[s] for s in left}, shares + 16 * len(left)) if len(left) > 1 else {next(iter(left)): 1}
            order = pfair_period(m)
            slots = {s: [] for s in m}
            for t, s in enumerate(order):
                slots[s].append(t)
            slots = {s: np.array(v, np.int64) for s, v in slots.items()}
            period = len(order)
            last = {s: (n - 1) // m[s] * period + int(slots[s][(n - 1) % m[s]]) for s, n in left.items()}
            length = min(last.values()) + 1
            self.phases.append(Phase(start, m, period, slots, dict(done)))
            for s in list(left):
                used = length // period * m[s] + int(np.searchsorted(slots[s], length % period))
                done[s] += used
                left[s] -= used
                if not left[s]:
                    del left[s]
            start += length
        self.sources: dict = {}
        for p in self.phases:
            for s in p.shares:
                self.sources.setdefault(s, []).append(p)

    def place(self, source, block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Release, deadline and slot of blocks of one source."""
        phases = self.sources[source]
        firsts = np.array([p.first[source] for p in phases])
        which = np.searchsorted(firsts, block, "right") - 1
        out = np.zeros((3, len(block)), np.int64)
        for k in np.unique(which):
            p, at = phases[k], which == k
            i, m = block[at] - firsts[k], p.shares[source]
            out[0, at] = p.start + i * p.period // m
            out[1, at] = p.start - (-(i + 1) * p.period // m)
            out[2, at] = p.start + i // m * p.period + p.slots[source][i % m]
        return out[0], out[1], out[2]


class FluidPlan:
    """A schedule of any number of sources: block i of a source with weight w has its window where the fluid mix gives
    the source its share from i to i + 1.

    In the fluid mix each source has w * v blocks at the virtual time v, until it runs out; the slot of v is what all
    have by then. Release (rounded down) and deadline (rounded up) of unit blocks that a fluid mix meets are met by
    earliest deadline first, so every source is less than one block from its share at any slot.
    """

    def __init__(self, blocks: dict, weights: dict):
        left = {s: n for s, n in blocks.items() if n > 0}
        scale = sum(weights[s] for s in left)
        whole = [max(1, int(weights[s] / scale * (1 << WEIGHT_BITS))) for s in left]
        counts = list(left.values())
        # Different fractions of such weights differ in this many bits.
        bits = 2 * WEIGHT_BITS + 1
        ends = sorted(((n << bits) // w, n, w) for n, w in zip(counts, whole, strict=True))
        keys, done, active = [k for k, _, _ in ends], [0], [sum(whole)]
        for _, n, w in ends:
            done.append(done[-1] + n)
            active.append(active[-1] - w)
        self.first = dict(zip(left, np.cumsum([0, *counts[:-1]]).tolist(), strict=True))
        self.windows = np.zeros((3, sum(counts)), np.int64)
        release, deadline, slots = self.windows
        at = 0
        for n, w in zip(counts, whole, strict=True):
            for i in range(n + 1):
                p = bisect_right(keys, (i << bits) // w)
                if i < n:
                    release[at + i] = done[p] + i * active[p] // w
                if i:
                    deadline[at + i - 1] = done[p] - (-i * active[p] // w)
            at += n
        order = np.argsort(release, kind="stable")
        coming = zip(release[order].tolist(), deadline[order].tolist(), order.tolist(), strict=True)
        ready: list[tuple[int, int]] = []
        following = next(coming, None)
        for t in range(at):
            while following and following[0] <= t:
                heapq.heappush(ready, following[1:])
                following = next(coming, None)
            slots[heapq.heappop(ready)[1]] = t

    def place(self, source, block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Release, deadline and slot of blocks of one source."""
        return tuple(self.windows[:, self.first[source] + block])


def parts_of(documents: DataFrame) -> int:
    """Partitions of at most about BYTES_A_PART of text and ROWS_A_PART rows."""
    size = F.sum(F.octet_length("text").cast("long")) if "text" in documents.columns else F.lit(0).cast("long")
    found = documents.agg(F.count("*").alias("n"), size.alias("size")).first()
    return max(found.n // ROWS_A_PART, (found.size or 0) // BYTES_A_PART) + 1


def number_within(documents: DataFrame, doc_id: str, partitions: int) -> tuple[DataFrame, dict]:
    """Rows with `__at`, their place among those of their source by doc_id, and the number of rows of each source.

    Range partitions split a hot source; only a count for each source and partition is gathered.
    """
    sorted_rows = documents.repartitionByRange(partitions, "__source", doc_id).sortWithinPartitions("__source", doc_id)
    names = [*documents.columns, "__part", "__local"]
    source_at = documents.columns.index("__source")

    def run(batches):
        forget()
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            local = []
            for s in batch.column(source_at).to_pylist():
                n = seen.get(s, 0)
                local.append(n)
                seen[s] = n + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(local), pa.int64()), pa.array(local, pa.int64())], names)

    rows = materialise(sorted_rows.mapInArrow(run, widened(sorted_rows.schema, T.LongType(), "__part", "__local")), "numbered")
    counts = [(r["__source"], r["__part"], r["n"]) for r in rows.groupBy("__source", "__part").agg(F.count("*").alias("n")).collect()]
    before, total = {}, {}
    for s, part, n in sorted(counts, key=lambda c: (c[0] is not None, c[0], c[1])):
        before[s, part] = total.get(s, 0)
        total[s] = total.get(s, 0) + n
    return rows, {"before": before, "total": total}


def scheduled(documents: DataFrame, weights: dict | None = None, alpha: float = ALPHA, block: int = BLOCK) -> DataFrame:
    """All columns of documents with __block, __release, __deadline, __slot and __position.

    `weights`: target weight of each source, above 0; those it doesn't name, or all without it, weigh their rows to the
    power `alpha`, scaled so that both kinds have the share of their rows. Names without rows have no part.
    """
    spark = documents.sparkSession
    plain, known = clear_names(documents)
    if any(not w > 0 for w in (weights or {}).values()):
        raise ValueError("target weights must be above 0")
    rows = plain.withColumn("__source", F.col(known["source"]).cast("string"))
    numbered, counts = number_within(rows, known["doc_id"], parts_of(documents))
    total = counts["total"]
    target = {s: float(n) ** alpha for s, n in total.items()}
    if weights:
        named = {s: w for s, w in weights.items() if s in total}
        rest = {s: w for s, w in target.items() if s not in named}
        share = sum(total[s] for s in named) / max(1, sum(total.values()))
        target = {s: w / sum(named.values()) * share for s, w in named.items()} | {s: w / sum(rest.values()) * (1 - share) for s, w in rest.items()}
    plan = (Plan if len(total) <= MOST_SOURCES else FluidPlan)({s: -(-n // block) for s, n in total.items()}, target)
    shared = spark.sparkContext.broadcast((plan, counts["before"]))
    names = numbered.columns
    extra = ["__block", "__release", "__deadline", "__slot", "__position"]

    def run(batches):
        plan, before = shared.value
        for batch in batches:
            local = batch.column(names.index("__local")).to_numpy(zero_copy_only=False)
            of = list(zip(*(batch.column(names.index(c)).to_pylist() for c in ("__source", "__part")), strict=True))
            heads = [k for k in range(len(of)) if not k or of[k] != of[k - 1]]
            out = np.zeros((5, len(local)), np.int64)
            for a, b in zip(heads, [*heads[1:], len(of)], strict=True):
                i = local[a:b] + before[of[a]]
                release, deadline, slot = plan.place(of[a][0], i // block)
                out[:, a:b] = (i // block, release, deadline, slot, slot * block + i % block)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(o, pa.int64()) for o in out)], [*names, *extra])

    return numbered.mapInArrow(run, widened(numbered.schema, T.LongType(), *extra)).select(*plain.columns, *extra).toDF(*documents.columns, *extra)


def schedule(documents: DataFrame, weights: dict | None = None) -> DataFrame:
    """doc_id, source, block, release, deadline, slot, position: every document's place in the mix."""
    rows = scheduled(documents.select("doc_id", "source"), weights)
    return rows.select("doc_id", "source", *(F.col(f"__{c}").alias(c) for c in ("block", "release", "deadline", "slot", "position")))


def mix(documents: DataFrame, weights: dict | None = None) -> DataFrame:
    """The documents, all columns, in the order of the mix: partitions are ranges of positions, rows in them sorted."""
    rows = scheduled(documents, weights)
    rows = rows.toDF(*(f"c{k}" for k in range(len(rows.columns))))
    position = rows.columns[-1]
    kept = rows.columns[: len(documents.columns)]
    return rows.repartitionByRange(parts_of(documents), position).sortWithinPartitions(position).select(*kept).toDF(*documents.columns)

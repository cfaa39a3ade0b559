"""Operator 4, packing: sum-of-squares online packing of token ids into windows.

Each task streams its documents. Whole windows are cut off a document first; the rest goes to the fill level where
it least raises the sum of squares of the counts of partly filled windows, as a level array has them. At the end of
a partition the windows still open are joined by cutting pieces, and the one that stays short is cut at powers of
two, so nothing is padded but by choice (`split_tail=False` leaves it in one padded window).

Memory of a task: one Arrow batch, and the ids of windows still open. No shuffle: a packer needs none of another's rows.

Defined results: a null text is the empty one and packs its end id; repeated rows and null ids are packed as they
come; an empty table has no pieces; other columns are not read. sequence_id is unique over all tasks:
the partition's number times 2^40 plus the window's number in it.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import encoder

CAPACITY = 2048
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
PIECES_A_BATCH = 20_000


class SumOfSquares:
    """Levels of partly filled windows. `items` of a window: any tuples whose first entry is a length."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, np.int64)
        self.open: dict[int, deque] = {}

    def level_for(self, size: int) -> int:
        """Fill level (0: a new window) that minimises the sum of squared counts after placing; ties to the fuller one."""
        fit = self.counts[: self.capacity - size + 1]
        cost = 2 * self.counts[size : self.capacity + 1] + 1
        cost[-1] = 0  # a full window is in no level
        cost = cost - 2 * fit + 1
        cost[0] = 2 * self.counts[size] + 1 if size < self.capacity else 0
        cost[1:][fit[1:] == 0] = np.iinfo(np.int64).max
        return len(cost) - 1 - int(np.argmin(cost[::-1]))

    def place(self, item: tuple) -> list[tuple] | None:
        """Put an item; the window's items, if this fills it."""
        size = item[0]
        level = self.level_for(size)
        if level:
            window = self.open[level].popleft()
            self.counts[level] -= 1
        else:
            window = []
        window.append(item)
        level += size
        if level == self.capacity:
            return window
        self.open.setdefault(level, deque()).append(window)
        self.counts[level] += 1
        return None

    def rest(self) -> list[list[tuple]]:
        """Windows still open, fullest first."""
        return [w for level in sorted(self.open, reverse=True) for w in self.open[level]]


def powers(n: int) -> list[int]:
    """The powers of two that make up n, largest first."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def pack(documents: DataFrame, capacity: int = CAPACITY, end_id: int = 1, tokenizer: str | None = None, split_tail: bool = True) -> DataFrame:
    """One row for each piece: document, place in it, length, crc32 of its ids, and sequence and offset."""

    def run(batches):
        made = encoder(tokenizer)
        width, end = made.dtype.itemsize, np.array([end_id], made.dtype).tobytes()
        base, numbers = TaskContext.get().partitionId() << 40, iter(range(1 << 40))
        levels, rows = SumOfSquares(capacity), []

        def emit(window):
            number, offset = base + next(numbers), 0
            for length, doc, start, total, raw in window:
                crc = zlib.crc32(np.frombuffer(raw, made.dtype).astype("<u4").tobytes())
                rows.append((doc, start, length, crc, total, number, offset))
                offset += length

        def flush():
            kinds = [pa.int64()] * 7
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            batch = pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(7)], names)
            rows.clear()
            return batch

        for batch in batches:
            for doc, raw in zip(batch.column("doc_id").to_pylist(), made.ids(batch.column("text")), strict=True):
                raw += end
                total = len(raw) // width
                cut = total - total % capacity
                for start in range(0, cut, capacity):
                    emit([(capacity, doc, start, total, raw[start * width : (start + capacity) * width])])
                if cut < total and (full := levels.place((total - cut, doc, cut, total, raw[cut * width :]))):
                    emit(full)
                if len(rows) >= PIECES_A_BATCH:
                    yield flush()
        whole, tail = divmod(sum(i[0] for w in levels.rest() for i in w), capacity)
        window: list[tuple] = []
        sizes = iter([capacity] * whole + (powers(tail) if split_tail else [tail] if tail else []))
        room = next(sizes, 0)
        for item in (i for w in levels.rest() for i in w):
            length, doc, start, total, raw = item
            while length:
                take = min(length, room)
                window.append((take, doc, start, total, raw[: take * width]))
                length, start, raw, room = length - take, start + take, raw[take * width :], room - take
                if not room:
                    emit(window)
                    window, room = [], next(sizes, 0)
            if len(rows) >= PIECES_A_BATCH:
                yield flush()
        if rows:
            yield flush()

    return documents.select("doc_id", "text").mapInArrow(run, SCHEMA)

"""A sink that writes rows, in an order, into one file, each task its own range of bytes.

Rows are sorted by ranges and kept; the bytes of each range are summed, which tells where each begins, and tasks then
write there, all into one staged file beside the target. Only one number a range comes to the driver. A repeated attempt
writes the same bytes to the same place; the commit sets the file's end and renames it, so the target is whole or as it
was. The folder must be one that driver and executors share.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ..operators import graph

BUFFER = 1 << 20


@dataclass
class Part:
    """Text before, a line for each row in an order (that of the rows' partitions without one), text between and after."""

    rows: DataFrame
    line: Column
    order: list[Column] = field(default_factory=list)
    before: str = ""
    between: str = "\n"
    after: str = ""


class RangeWriter(DataSourceWriter):
    def __init__(self, path: str, between: str):
        self.path, self.between = path, between.encode()

    def write(self, iterator):
        out, held = None, bytearray()
        try:
            for at, line in iterator:
                if out is None:
                    out = os.open(self.path, os.O_WRONLY)
                    os.lseek(out, at, os.SEEK_SET)
                held += line.encode("utf-8", "surrogatepass") + self.between
                if len(held) >= BUFFER:
                    self._flush(out, held)
            if out is not None:
                self._flush(out, held)
        finally:
            if out is not None:
                os.close(out)
        return WriterCommitMessage()

    @staticmethod
    def _flush(out: int, held: bytearray) -> None:
        while held:
            del held[: os.write(out, held)]

    def commit(self, messages):
        pass

    def abort(self, messages):
        pass


class LineFile(DataSource):
    @classmethod
    def name(cls):
        return "linefile"

    def writer(self, schema, overwrite):
        return RangeWriter(self.options["path"], self.options["between"])


def write(path: str, *parts: Part) -> None:
    """The parts one after the other as UTF-8, in place of what was at the path."""
    staged = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.{uuid.uuid4().hex}")
    try:
        at = 0
        with open(staged, "wb"):
            pass
        for part in parts:
            at = _append(staged, at, part)
        os.replace(staged, path)
    finally:
        if os.path.exists(staged):
            os.remove(staged)


def _append(staged: str, at: int, part: Part) -> int:
    """Write a part from a place in the staged file on; the place after it."""
    at = _put(staged, at, part.before)
    rows = part.rows
    rows.sparkSession.dataSource.register(LineFile)
    if part.order:
        rows = rows.repartitionByRange(*part.order).sortWithinPartitions(*part.order)
    between = len(part.between.encode())
    lines = graph.cut(rows.select(part.line.alias("line")).withColumn("range", F.spark_partition_id()))
    sizes = lines.groupBy("range").agg(F.sum(F.octet_length("line").cast("long") + between).alias("bytes")).orderBy("range").collect()
    if not sizes:
        return _put(staged, at, part.after)
    starts = []
    for r in sizes:
        starts.append((r["range"], at))
        at += r.bytes
    placed = lines.join(F.broadcast(rows.sparkSession.createDataFrame(starts, "range int, at bigint")), "range")
    placed.select("at", "line").write.format("linefile").mode("append").option("between", part.between).save(staged)
    return _put(staged, at - between, part.after)


def _put(path: str, at: int, text: str) -> int:
    with open(path, "r+b") as f:
        f.truncate(at)
        f.seek(at)
        f.write(text.encode())
        return f.tell()

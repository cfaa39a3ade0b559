"""Operator 2, token-id output: a content-addressed store of id streams.

Rolling hashes cut each document's ids into chunks, every distinct chunk is written once under its hash, a recipe
lists a document's chunks, and Merkle hashes over chunks, documents, segments and files verify what is read back.

Folders of a store (Parquet, so any file system Spark reads will do):
  chunks/    hash, n_ids, ids (little-endian, 2 bytes a value where the vocabulary allows)
  recipes/   doc_id, n_tokens, part, row, local_start, hashes, root; files and rows in ascending doc_id order
  manifest/  level, part, segment, root

Defined results: a null text is the empty one (its end id remains); a null doc_id is kept and comes first; repeated
rows are stored as so many documents that share chunks; an empty table makes an empty store; other columns are not
read. Rows with one doc_id are in the order of their chunks' hashes. A chunk whose bytes don't give its hash, or a document whose root differs, fails the read.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc32_join, encoder, materialise, remove, store_path

WINDOW, LEAST, MOST, MASK_BITS = 16, 96, 1024, 8
SEGMENT = 1024
DIGEST = 16
ROWS_A_PART = 100_000


def gear_table() -> np.ndarray:
    """32 random-looking bits for each residue of an id modulo 4096, from a rule."""
    x = np.arange(1, 4097, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53), (32, 0x9E3779B97F4A7C15)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x >> np.uint64(32)).astype(np.uint32)


GEAR = gear_table()


def cut_points(ids: np.ndarray, ends: np.ndarray | None = None) -> list[int]:
    """Ends of the chunks of documents that lie one after the other and end at `ends`: where the rolling hash of the last
    16 ids has 8 zero bits, 96 ids at least and 1024 at most. A document is cut as it is alone: a hash that reaches into
    the one before is within the first 96 ids."""
    hits = [len(ids)]
    if len(ids) > LEAST:
        rolling, width = GEAR[ids & 4095], 1
        with np.errstate(over="ignore"):
            while width < WINDOW:  # hashes of twice as many ids from two of those there are
                rolling = rolling[width:] + (rolling[:-width] << np.uint32(width))
                width *= 2
        hits = (np.flatnonzero((rolling >> np.uint32(WINDOW - MASK_BITS)) & np.uint32((1 << MASK_BITS) - 1) == 0) + WINDOW).tolist() + hits
    out, start, at = [], 0, 0
    for end in [len(ids)] if ends is None else ends.tolist():
        while end - start > LEAST:
            at = bisect_left(hits, start + LEAST, at)
            start = min(hits[at], start + MOST, end)
            out.append(start)
        if start < end:
            out.append(end)
            start = end
    return out


def chunk_hash(ids) -> bytes:
    return hashlib.blake2b(ids, digest_size=DIGEST, person=b"chunk").digest()


def merkle_root(leaves: list[bytes]) -> bytes:
    """Pairs are hashed level by level; an odd last one goes up as it is; no leaves have the hash of nothing."""
    level = leaves or [b""]
    if len(level) == 1:
        return hashlib.blake2b(level[0], digest_size=DIGEST, person=b"leaf").digest()
    while len(level) > 1:
        level = [hashlib.blake2b(b"".join(level[k : k + 2]), digest_size=DIGEST, person=b"node").digest() if k + 1 < len(level) else level[k] for k in range(0, len(level), 2)]
    return level[0]


def _chunk_rows(path: str | None, end_id: int):
    def run(batches):
        made = encoder(path)
        width = made.dtype.itemsize
        for batch in batches:
            at = 0
            for ids, ends in made.rounds(batch.column("text")):
                ids, ends = np.insert(ids, ends, end_id), ends + np.arange(1, len(ends) + 1)
                stops = np.array([0, *cut_points(ids, ends)])
                places = (stops * width).tolist()
                raw = memoryview(ids).cast("B")
                hashes = [chunk_hash(raw[i:j]) for i, j in zip(places, places[1:])]
                data = pa.BinaryArray.from_buffers(pa.binary(), len(hashes), [None, pa.py_buffer(np.array(places, np.int32)), pa.py_buffer(ids)])
                rows = pa.StructArray.from_arrays([pa.array(hashes, pa.binary()), pa.array(np.diff(stops).astype(np.int32)), data], ["hash", "n_ids", "ids"])
                chunks = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.searchsorted(stops, ends)]).astype(np.int32)), rows)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(ends)).cast(pa.int64()), pa.array(np.diff(ends, prepend=0)), chunks], ["doc_id", "n_tokens", "chunks"])
                at += len(ends)

    return run


def _lists(column: pa.Array, name: str | None = None) -> list[list]:
    """A list column as Python lists, by way of one flat array."""
    flat = column.flatten()
    flat = (flat.field(name) if name else flat).to_numpy(zero_copy_only=False).tolist()
    ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False)).tolist()
    return [flat[i:j] for i, j in zip([0, *ends], ends)]


def _number_rows(batches):
    """Rows of a sorted partition: its number, the row's, and the ids before it in there."""
    part, row, start = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        counts = batch.column("n_tokens").to_numpy()
        before = start + np.cumsum(counts) - counts
        hashes = batch.column("hashes")
        roots = [merkle_root(h) for h in _lists(hashes)]
        n = len(counts)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_tokens"), pa.array(np.full(n, part, np.int32)), pa.array(np.arange(row, row + n)), pa.array(before), hashes, pa.array(roots, pa.binary())], ["doc_id", "n_tokens", "part", "row", "local_start", "hashes", "root"])
        row, start = row + n, start + int(counts.sum())


RECIPE = "doc_id long, n_tokens long, part int, row long, local_start long, hashes array<binary>, root binary"


def write_store(documents: DataFrame, path: str, end_id: int = 2, tokenizer: str | None = None) -> None:
    """Tokenise once, then write chunks, recipes and manifest below `path`."""
    spark = documents.sparkSession
    staged_path = store_path(spark, "staged-chunks")
    staged = materialise(documents.select("doc_id", "text").mapInArrow(_chunk_rows(tokenizer, end_id), "doc_id long, n_tokens long, chunks array<struct<hash:binary,n_ids:int,ids:binary>>"), "staged-chunks", staged_path)
    unique = staged.select(F.inline("chunks")).groupBy("hash").agg(F.first("n_ids").alias("n_ids"), F.first("ids").alias("ids"))
    unique.write.option("compression", "zstd").parquet(f"{path}/chunks")
    rows = staged.count()
    recipes = staged.select("doc_id", "n_tokens", F.col("chunks.hash").alias("hashes")).repartitionByRange(max(1, rows // ROWS_A_PART + 1), "doc_id").sortWithinPartitions("doc_id", "hashes").mapInArrow(_number_rows, RECIPE)
    recipes.write.option("compression", "zstd").parquet(f"{path}/recipes")
    remove(spark, staged_path)
    read = spark.read.schema(RECIPE).parquet(f"{path}/recipes")
    join = lambda roots: F.unhex(F.sha2(F.aggregate(roots, F.lit(b""), lambda a, x: F.concat(a, x.root)), 256))
    segments = read.groupBy("part", F.floor(F.col("row") / SEGMENT).cast("long").alias("segment")).agg(F.sort_array(F.collect_list(F.struct("row", "root"))).alias("rows")).select(F.lit("segment").alias("level"), "part", "segment", join(F.col("rows")).alias("root"))
    segments = materialise(segments, "segments", f"{path}/manifest/level=segment")
    parts = segments.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("segment", "root"))).alias("rows")).select("part", join(F.col("rows")).alias("root"))
    top = parts.groupBy().agg(F.sort_array(F.collect_list(F.struct("part", "root"))).alias("rows")).select(F.lit(None).cast("int").alias("part"), join(F.col("rows")).alias("root"))
    parts.withColumn("segment", F.lit(None).cast("long")).write.parquet(f"{path}/manifest/level=part")
    top.withColumn("segment", F.lit(None).cast("long")).write.parquet(f"{path}/manifest/level=store")


def chunk_digests(spark: SparkSession, path: str) -> DataFrame:
    """(hash, n_ids, crc): every stored chunk's bytes are read, checked against their hash and summed up as 4-byte ids."""

    def run(batches):
        for batch in batches:
            names, raws = (batch.column(c).to_numpy(zero_copy_only=False).tolist() for c in ("hash", "ids"))
            counts = batch.column("n_ids").to_numpy()
            sizes = np.fromiter(map(len, raws), np.int64, len(raws))
            bad = [k for k, raw in enumerate(raws) if chunk_hash(raw) != names[k]] or np.flatnonzero(sizes % counts).tolist()
            if bad:
                raise ValueError(f"chunk {names[bad[0]].hex()} is damaged")
            crcs = np.zeros(len(raws), np.int64)
            for width in np.unique(sizes // counts).tolist():
                which = np.flatnonzero(sizes == counts * width)
                wide = memoryview(np.frombuffer(b"".join([raws[k] for k in which]), f"<u{width}").astype("<u4")).cast("B")
                ends = (np.cumsum(counts[which].astype(np.int64)) * 4).tolist()
                crcs[which] = [zlib.crc32(wide[i:j]) for i, j in zip([0, *ends], ends)]
            yield pa.RecordBatch.from_arrays([batch.column("hash"), batch.column("n_ids"), pa.array(crcs)], ["hash", "n_ids", "crc"])

    return spark.read.schema("hash binary, n_ids int, ids binary").parquet(f"{path}/chunks").mapInArrow(run, "hash binary, n_ids int, crc long")


def starts(spark: SparkSession, path: str) -> DataFrame:
    """Recipes with `start`, the ids of all documents before. Only a sum for each file goes through one task."""
    recipes = spark.read.schema(RECIPE).parquet(f"{path}/recipes")
    from pyspark.sql import Window

    sums = recipes.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn("before", F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    return recipes.join(sums.select("part", F.coalesce("before", F.lit(0)).alias("before")), "part").withColumn("start", F.col("before") + F.col("local_start"))


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """One row for each document, from the files: doc_id, start, n_tokens, ids_crc32, n_chunks, root."""
    recipes = starts(spark, path)
    entries = recipes.select("part", "row", F.posexplode("hashes").alias("at", "hash"))
    found = entries.join(chunk_digests(spark, path), "hash").groupBy("part", "row").agg(F.sort_array(F.collect_list(F.struct("at", "n_ids", "crc", "hash"))).alias("chunks"))

    def run(batches):
        for batch in batches:
            crcs, sizes = [], []
            roots = batch.column("root").to_pylist()
            parts = (_lists(batch.column("chunks"), c) for c in ("hash", "n_ids", "crc"))
            for hashes, lengths, sums, count, root in zip(*parts, batch.column("n_tokens").to_pylist(), roots, strict=True):
                if sum(lengths) != count or merkle_root(hashes) != root:
                    raise ValueError("a document's chunks don't give its root")
                crcs.append(crc32_join((c, 4 * n) for c, n in zip(sums, lengths, strict=True)))
                sizes.append(len(hashes))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(crcs, pa.int64()), pa.array(sizes, pa.int64()), pa.array([r.hex() for r in roots], pa.string())], ["doc_id", "start", "n_tokens", "ids_crc32", "n_chunks", "root"])

    return recipes.select("part", "row", "doc_id", "start", "n_tokens", "root").join(found, ["part", "row"]).select("doc_id", "start", "n_tokens", "root", "chunks").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, n_chunks long, root string")


def reconstruct(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids): whole id streams put together again from recipes and chunks."""
    recipes = starts(spark, path)
    chunks = spark.read.schema("hash binary, n_ids int, ids binary").parquet(f"{path}/chunks")
    parts = recipes.select("part", "row", F.posexplode("hashes").alias("at", "hash")).join(chunks, "hash").groupBy("part", "row").agg(F.sort_array(F.collect_list(F.struct("at", "n_ids", "ids"))).alias("chunks"))

    def run(batches):
        for batch in batches:
            ids = [[int(i) for c in chunks for i in np.frombuffer(c["ids"], f"<u{len(c['ids']) // c['n_ids']}")] for chunks in batch.column("chunks").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), pa.array(ids, pa.list_(pa.int64()))], ["doc_id", "start", "ids"])

    return recipes.select("part", "row", "doc_id", "start").join(parts, ["part", "row"]).select("doc_id", "start", "chunks").mapInArrow(run, "doc_id long, start long, ids array<long>")


def store_documents(documents: DataFrame) -> DataFrame:
    """Write a store of all documents in the shared folder and give the digests read back from it."""
    path = store_path(documents.sparkSession, "idstore")
    write_store(documents, path)
    return read_digests(documents.sparkSession, path)

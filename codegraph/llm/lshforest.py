"""Operator 9, approximate nearest neighbours: a hash-prefix forest.

Every vector has one hash string of 24 bits for each of 64 trees: the sides of random hyperplanes set at the sample's median
projection. A tree is the sorted array of its strings. A query descends each tree to its longest matching prefix, then
all trees ascend together, one bit at a time, until their prefixes hold enough candidates; those are ranked by exact
Euclidean distance in double precision.

The thresholds are fitted on a bounded sample (SAMPLE vectors with the smallest hash of vec_id); every row is indexed.
Each task builds the forest of its own rows, in blocks of BLOCK, and answers all queries from it; a query's best of
each block meet in one window ranking, cut to k before the shuffle. Queries go to the workers in batches of at most
QUERY_BYTES, so a broadcast never exceeds that. Equal vectors are one entry of a tree with their smallest k + 1 ids, so
copies neither crowd out other candidates nor lengthen a bucket.

Defined results: vectors that are null, empty, all zero, of another length than most, or hold a null or non-finite
component take no part, as row or query; so do null ids. Repeated (id, vector) rows count once. Fewer than k
candidates are all returned. Ties go to the smaller vec_id. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TREES, BITS = 64, 24
CANDIDATES = 0.4
LEAST_CANDIDATES = 1500
ROWS_A_ROUND = 4096
SAMPLE = 4096
BLOCK = 65_536
QUERY_BYTES = 16 << 20


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding array<double>) of the vectors that take part."""
    e = F.col("embedding")
    whole = ~F.exists(e, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))) & F.exists(e, lambda x: x != 0)
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.cast("array<double>").alias("embedding")).filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & whole)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dim).astype(np.float64)


class Hyperplanes:
    def __init__(self, sample: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = 9):
        dim = sample.shape[1]
        self.trees, self.bits = trees, bits
        self.planes = np.random.default_rng(seed).standard_normal((dim, trees * bits))
        self.at = np.median(sample @ self.planes, axis=0)

    def strings(self, x: np.ndarray) -> np.ndarray:
        """(trees, rows) hash strings, first bit most significant."""
        out = np.zeros((self.trees, len(x)), np.uint64)
        for k in range(0, len(x), ROWS_A_ROUND):
            sides = (x[k : k + ROWS_A_ROUND] @ self.planes > self.at).reshape(-1, self.trees, self.bits)
            for b in range(self.bits):
                out[:, k : k + ROWS_A_ROUND] = (out[:, k : k + ROWS_A_ROUND] << np.uint64(1)) | sides[:, :, b].T.astype(np.uint64)
        return out


class Forest:
    """Sorted arrays of the rows' hash strings."""

    def __init__(self, planes: Hyperplanes, vectors: np.ndarray):
        self.planes, self.vectors = planes, vectors
        strings = planes.strings(vectors)
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, axis=1)

    def ranges(self, strings: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of each tree whose first `level` bits are the query's."""
        low = (strings >> np.uint64(self.planes.bits - level)) << np.uint64(self.planes.bits - level)
        high = low + np.uint64((1 << (self.planes.bits - level)) - 1)
        begin = np.stack([np.searchsorted(s, q, "left") for s, q in zip(self.sorted, low, strict=True)])
        end = np.stack([np.searchsorted(s, q, "right") for s, q in zip(self.sorted, high, strict=True)])
        return begin, end

    def candidates(self, queries: np.ndarray, least: int):
        """Row numbers for each query: from the longest matching prefixes up, all trees a bit shorter at a time."""
        strings = self.planes.strings(queries)
        begin = np.zeros(strings.shape, np.int64)
        end = np.full(strings.shape, len(self.vectors), np.int64)
        waiting = np.arange(len(queries))
        for level in range(self.planes.bits, 0, -1):
            if not len(waiting):
                break
            b, e = self.ranges(strings[:, waiting], level)
            enough = (e - b).sum(axis=0) >= least
            begin[:, waiting[enough]], end[:, waiting[enough]] = b[:, enough], e[:, enough]
            waiting = waiting[~enough]
        for q in range(len(queries)):
            if begin[0, q] == 0 and end[0, q] == len(self.vectors):
                yield np.arange(len(self.vectors))
            else:
                yield np.unique(np.concatenate([self.order[t, begin[t, q] : end[t, q]] for t in range(self.planes.trees)]))


def search_block(planes: Hyperplanes, ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """(query_id, vec_id, distance) of each query's k best candidates in a block."""
    keys = np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).reshape(-1)
    _, first, group = np.unique(keys, return_index=True, return_inverse=True)
    order = np.lexsort((ids, group))
    once = np.ones(len(order), bool)
    once[1:] = (np.diff(group[order]) != 0) | (np.diff(ids[order]) != 0)
    members = ids[order[once]]
    bounds = np.searchsorted(group[order[once]], np.arange(len(first) + 1))
    forest = Forest(planes, vectors[first])
    least = max(LEAST_CANDIDATES, int(CANDIDATES * len(first)))
    for own, vector, found in zip(query_ids, queries, forest.candidates(queries, least), strict=True):
        far = np.sqrt(np.square(forest.vectors[found] - vector).sum(axis=1))
        if len(found) > k + 1:
            edge = np.partition(far, k)[k]
            found, far = found[far <= edge], far[far <= edge]
        rows = []
        for g, d in zip(found, far, strict=True):
            rows += [(float(d), int(i)) for i in members[bounds[g] : min(bounds[g + 1], bounds[g] + k + 1)] if i != own]
        for d, i in sorted(rows)[:k]:
            yield own, i, d


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: each query row's nearest found among all other rows."""
    spark = vectors.sparkSession
    result = "query_id long, rank int, vec_id long, score double"
    rows, asked = usable(vectors), usable(queries)
    sample = rows.withColumn("h", F.xxhash64("vec_id")).orderBy("h", "vec_id").limit(SAMPLE).select("embedding").toArrow()
    if not sample.num_rows:
        return spark.createDataFrame([], result)
    sizes = sample.column(0).combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
    dim = int(np.bincount(sizes).argmax())
    kept = sample.column(0).combine_chunks().filter(pa.array(sizes == dim))
    planes = spark.sparkContext.broadcast(Hyperplanes(matrix(kept, dim)))
    rows, asked = (x.filter(F.size("embedding") == dim) for x in (rows, asked))
    n = asked.count()
    batches = max(1, -(-n * (dim + 1) * 8 // QUERY_BYTES))
    found = None
    for b in range(batches):
        part = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(batches)) == b).toArrow()
        if not part.num_rows:
            continue
        shared = spark.sparkContext.broadcast((part.column("vec_id").to_numpy(), matrix(part.column("embedding").combine_chunks(), dim)))

        def run(arrow, shared=shared):
            query_ids, points = shared.value
            ids, held, size = [], [], 0

            def answer():
                out = list(search_block(planes.value, np.concatenate(ids), np.concatenate(held), query_ids, points, k))
                return pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], ["query_id", "vec_id", "score"])

            for batch in arrow:
                if batch.num_rows:
                    ids.append(batch.column("vec_id").to_numpy(zero_copy_only=False))
                    held.append(matrix(batch.column("embedding"), dim))
                    size += batch.num_rows
                if size >= BLOCK:
                    yield answer()
                    ids, held, size = [], [], 0
            if size:
                yield answer()

        one = rows.mapInArrow(run, "query_id long, vec_id long, score double")
        found = one if found is None else found.unionByName(one)
    if found is None:
        return spark.createDataFrame([], result)
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return ranked.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def query_rows(vectors: DataFrame, every: int) -> DataFrame:
    """The stated query set: rows whose id is divisible by `every`."""
    return vectors.filter(F.col("vec_id") % every == 0)

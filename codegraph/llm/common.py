"""Shared helpers of the training-data operators: tables, shared folder, Arrow plumbing, tokenisation."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import itertools
import os
import tempfile
import time
import uuid
import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKENIZER = "byte_bpe_50k.json"
PRETOKEN_CACHE = 2_000_000
SPACE_BYTE = "Ġ"  # the space, in the alphabet of byte-level vocabularies
CLOSING = ".,;:!?"
LINE_END_BYTE = "Ċ"
ROUND = 16_000_000
#: Fixed value: a space or line end before white space (Unicode's) or the end.
UNSAFE_SPACE = r"[ \n]([\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|\z)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; the path goes through Spark's own readers only."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset a session on one machine has
    a temporary one, and any other is refused."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = f"file://{tempfile.mkdtemp(prefix='codegraph-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def store_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, path: str | None = None, hashes: bool = False) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage with a copy that outlives executors. `hashes`: most
    columns are hashes, for which dictionaries and strong compression are work without use."""
    path = path or store_path(df.sparkSession, name)
    kind = {"compression": "snappy", "parquet.enable.dictionary": "false"} if hashes else {"compression": "zstd"}
    df.write.options(**kind).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table of the shared folder that nothing reads any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files of finished steps, which it does once the driver has collected its garbage."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 1000):
    """For steps whose rows are long: so many rows an Arrow batch, and the session's own number afterwards."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


_held: dict[str, object] = {}


def tidy() -> None:
    """Give memory that Arrow and the C library keep back to the system, which an executor's other processes need."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def worker_state(name: str, make):
    """What a worker process keeps between tasks: one operator's caches at a time, so that they don't add up."""
    if name not in _held:
        if _held:
            _held.clear()
            gc.collect()
            tidy()
        _held[name] = make()
    return _held[name]


def forget() -> None:
    """For operators that keep nothing: drop what an earlier one left in this worker."""
    worker_state("nothing", lambda: None)


def fold_hash(column, buckets: int, residue: int):
    """crc32 of an id as text, modulo `buckets`, equals `residue`; a null id is on the training side."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % buckets == residue, F.lit(False))


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def widened(schema: T.StructType, kind: T.DataType, *names: str) -> T.StructType:
    """A schema with further columns of one type."""
    return T.StructType([*schema.fields, *(T.StructField(n, kind) for n in names)])


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over a 64-bit word."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
    return x


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


ZEROS = memoryview(bytes(1 << 16))


def crc32_join(parts: Iterable[tuple[int, int]]) -> int:
    """crc32 of a concatenation from (crc32, bytes) of its parts."""
    total = 0
    for crc, n in parts:
        while n > 0:
            step = min(n, len(ZEROS))
            zeros = ZEROS[:step]
            total = zlib.crc32(zeros, total) ^ zlib.crc32(zeros)
            n -= step
        total ^= crc
    return total


def ids_crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def clear_names(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The table with columns called c0, c1, ... and what each name became: no name clashes or needs quoting then."""
    return df.toDF(*(f"c{k}" for k in range(len(df.columns)))), {name: f"c{k}" for k, name in enumerate(df.columns)}


WORD_BYTES = 64


@functools.cache
def byte_table(seed: int) -> np.ndarray:
    """64 random-looking bits for each place of a word and byte there."""
    with np.errstate(over="ignore"):
        return mix64(mix64(np.arange(WORD_BYTES << 8, dtype=np.uint64)) + np.uint64(seed + 1) * np.uint64(0x9FB21C651E98DF25))


def word_places(column: pa.Array) -> tuple[np.ndarray, ...]:
    """All words between ASCII white space as bytes side by side, where each starts and its size, and each text's number
    of words."""
    lists = pc.ascii_split_whitespace(pc.fill_null(column, ""))
    counts = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    wide = pa.types.is_large_string(flat.type)
    offsets = np.frombuffer(flat.buffers()[1], np.int64 if wide else np.int32, len(flat) + 1, flat.offset * (8 if wide else 4)) if len(flat) else np.zeros(1, np.int32)
    sizes = np.diff(offsets)
    kept = np.concatenate([[0], np.cumsum(sizes > 0)])
    ends = np.cumsum(counts)
    n_words = kept[ends] - kept[ends - counts]
    data = np.frombuffer(flat.buffers()[2], np.uint8, int(offsets[-1] - offsets[0]), int(offsets[0])) if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return data, (offsets[:-1] - offsets[0])[sizes > 0], sizes[sizes > 0], n_words


def rehash_long(hashed: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, seed: int) -> None:
    """Words of more than WORD_BYTES are hashed one by one."""
    for k in np.flatnonzero(sizes > WORD_BYTES).tolist():
        hashed[k] = xxhash.xxh3_64_intdigest(data[starts[k] : starts[k] + sizes[k]].tobytes(), seed)


def hashed_words(column: pa.Array, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words between ASCII white space, and each text's number of them. A word's hash is the mixed sum of
    its bytes' entries in a table by place, all words at once; longer words than the table has places for are hashed one
    by one."""
    forget()
    data, starts, sizes, n_words = word_places(column)
    if not len(sizes):
        return np.zeros(0, np.uint64), n_words
    place = np.arange(len(data), dtype=sizes.dtype) - np.repeat(starts, sizes)
    cell = (np.minimum(place, WORD_BYTES - 1).astype(np.uint16) << np.uint16(8)) | data
    with np.errstate(over="ignore"):
        hashed = mix64(np.add.reduceat(byte_table(seed)[cell], starts) + sizes.astype(np.uint64))
    rehash_long(hashed, data, starts, sizes, seed)
    return hashed, n_words


def sized_words(column: pa.Array, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Other hashes of all these words, by eight bytes at a time, which is quicker, each text's number of words, and the
    words' sizes in bytes."""
    forget()
    data, starts, sizes, n_words = word_places(column)
    eights = np.ndarray(len(data), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    masks = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    hashed = mix64((eights[starts] & masks[np.minimum(sizes, 8)]) + np.uint64(seed))
    at, rest = 8, np.flatnonzero((sizes > 8) & (sizes <= WORD_BYTES))
    with np.errstate(over="ignore"):
        while len(rest):
            hashed[rest] = mix64(hashed[rest] * np.uint64(0x9FB21C651E98DF25) ^ (eights[starts[rest] + at] & masks[np.minimum(sizes[rest] - at, 8)]))
            at += 8
            rest = rest[sizes[rest] > at]
        hashed = mix64(hashed + sizes.astype(np.uint64))
    rehash_long(hashed, data, starts, sizes, seed)
    return hashed, n_words, sizes.astype(np.int64)


def text_rounds(column: pa.Array, size: int = 8_000_000) -> Iterable[tuple[int, pa.Array]]:
    """(first row, slice) of so many texts that one round's arrays stay small."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(column):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
        yield at, column.slice(at, end - at)
        at = end
    tidy()


class Encoder:
    """Token ids of whole texts by the tokenizers library, each distinct piece encoded once.

    In a byte-level pre-tokeniser a space or line end directly before a visible character always starts a new
    pre-token, so a text is cut there and the ids of its pieces are joined. A text in which one of them is followed by
    white space or by nothing is encoded in one go instead. Pieces keep a line end and go without their space.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.begins = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.begins[[i for token, i in self.tokenizer.get_vocab().items() if token[0] in (SPACE_BYTE, LINE_END_BYTE)]] = True
        self.cache: dict[str, bytes] = {}

    def _fill(self, pieces: list[str]) -> None:
        new = [p for p in pieces if p not in self.cache]
        if len(self.cache) + len(new) > PRETOKEN_CACHE:
            self.cache.clear()
            new = pieces
        # Closing marks after a letter or digit are a pre-token of their own.
        bare = [p.rstrip(CLOSING) for p in new]
        cut = [b is not p and len(b) < len(p) and b[-1:].isalnum() for p, b in zip(new, bare, strict=True)]
        words = list({b if c else p for p, b, c in zip(new, bare, cut, strict=True)})
        made = dict(zip(words, self._words(words), strict=True))
        ends = {p[len(b) :] for p, b, c in zip(new, bare, cut, strict=True) if c}
        closing = {m: np.array(e.ids, self.dtype).tobytes() for m, e in zip(ends, self.tokenizer.encode_batch_fast([*ends], add_special_tokens=False), strict=True)}
        self.cache.update(made)
        self.cache.update((p, made[b] + closing[p[len(b) :]]) for p, b, c in zip(new, bare, cut, strict=True) if c)

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words with their space or line end: encoded side by side and cut before the tokens that begin with one."""
        out: list[bytes] = []
        width = self.dtype.itemsize
        for k in range(0, len(words), 20_000):
            part = [w if w[:1] == "\n" else f" {w}" for w in words[k : k + 20_000]]
            texts = ["".join(part[j : j + 200]) for j in range(0, len(part), 200)]
            made = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            ids = np.fromiter(itertools.chain.from_iterable(made), self.dtype, sum(map(len, made)))
            raw = ids.tobytes()
            begins = (np.flatnonzero(self.begins[ids]) * width).tolist()
            out += [raw[i:j] for i, j in zip(begins, [*begins[1:], len(raw)], strict=True)]
        return out

    def ids(self, column: pa.Array) -> list[bytes]:
        """Little-endian ids of each text in `dtype`; a null text has none."""
        return [ids for part in self.rounds(column) for ids in self._cut(*part)]

    def rounds(self, column: pa.Array) -> Iterable[tuple[np.ndarray, np.ndarray]]:
        """For so many texts as one round takes: all their ids one after the other, and the places where texts end."""
        for _, part in text_rounds(pc.fill_null(column, ""), ROUND):
            yield self._round(part)

    @staticmethod
    def _cut(ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        raw = ids.tobytes()
        bounds = (np.concatenate([[0], ends]) * ids.itemsize).tolist()
        return [raw[i:j] for i, j in zip(bounds[:-1], bounds[1:], strict=True)]

    def _round(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        unsafe = pc.match_substring_regex(texts, UNSAFE_SPACE)
        kept = pc.if_else(unsafe, "", texts)
        split = pc.split_pattern(pc.replace_substring(kept, "\n", " \n"), " ")
        after_last = split.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64).cumsum()
        heads = np.concatenate([[0], after_last[:-1]]).astype(np.int64)
        coded = split.flatten().dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        starts = [words[i] for i in index[heads]]
        self._fill(words)
        whole = unsafe.to_numpy(zero_copy_only=False)
        for k in np.flatnonzero(whole):
            starts[k] = texts[k].as_py()
        alone = [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(starts, add_special_tokens=False)]
        values = [*map(self.cache.__getitem__, words), *alone]
        index[heads] = np.arange(len(words), len(values))
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // self.dtype.itemsize
        begins = np.cumsum(sizes) - sizes
        each = sizes[index]
        after = np.cumsum(each)
        take = np.repeat((begins[index] - (after - each)).astype(np.int32), each)
        take += np.arange(len(take), dtype=np.int32)
        return np.frombuffer(b"".join(values), self.dtype)[take], after[after_last - 1]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str | None = None) -> Encoder:
    """One encoder for each worker process."""
    path = path or tokenizer_path()
    return worker_state(f"encoder {path}", lambda: Encoder(path))

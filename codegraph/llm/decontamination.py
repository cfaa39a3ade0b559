"""Benchmark decontamination: a prefix-filtered join of the shingles of item windows with documents, in DataFrame functions.

A window is a stretch of `WINDOW` words of an item (a shorter item is one window); its shingles are its stretches of
`SHINGLE` words. A document that holds a window holds all of its shingles, so the prefix that must be joined is one
shingle, and the rarest is taken: shingles are ordered by how often documents have them. A window with a shingle that no
document has is in none and posts nothing. A place of the posted shingle in a document gives the window's one possible
start there, bounds on start and end leave impossible ones out, and the words from there on must be the window's.

Postings and shingles are broadcast in blocks of bounded size, and every block meets all documents; only places that hold
a whole window leave the scan. Work is one pass over documents for counts and one for places, times the blocks of a
benchmark too large for one.

Words: A-Z lower-cased, then stretches of digits, a-z and anything outside ASCII. Null and empty texts have no words, no
hits and are not contaminated. Equal rows of documents give equal rows. An item without id counts under an empty id, one
without words takes no part, and windows of several items count for each of them. Other columns are not read.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

WINDOW, SHINGLE = 10, 3
#: Bytes of windows, and shingles, in one broadcast block.
BLOCK_BYTES, BLOCK_KEYS = 32 << 20, 1 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A word before A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Characters outside ASCII that have a lower case, or may have.
OTHER_CAPITALS = r"[\p{Lu}\p{Lt}\p{Nl}\p{So}&&[^\x00-\x7F]]"
OCCURRENCE = "doc_id bigint, text_key string, start int, length int, window string"


def words_of(text: Column) -> Column:
    """The words of a text; `lower` does for A-Z alone where it can't change another letter, and is the faster way."""
    low = F.when(text.rlike(OTHER_CAPITALS), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))
    return F.array_remove(F.split(F.coalesce(low, F.lit("")), SEPARATORS), "")


def shingle_at(words: Column, place: Column, size: int) -> Column:
    return F.xxhash64(*(F.get(words, place + k) for k in range(size)))


def windows_of(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, window, length): the windows of each item once, words joined by a space."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of(F.col("text")).alias("words"))
    items = items.withColumn("length", F.least(F.size("words"), F.lit(window))).filter("length > 0")
    placed = items.select("item", "words", "length", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)).alias("at"))
    return placed.select("item", F.array_join(F.slice("words", F.col("at"), F.col("length")), " ").alias("window"), "length").distinct()


def shingles_of(windows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(window, length, size, place, key): the shingles of each distinct window; `size` is less in windows of fewer words."""
    distinct = windows.select("window", "length").distinct().withColumn("words", F.split("window", " "))
    parts = []
    for size in range(1, shingle + 1):
        fit = F.col("length") >= shingle if size == shingle else F.col("length") == size
        placed = distinct.filter(fit).select("window", "length", "words", F.explode(F.sequence(F.lit(0), F.col("length") - size)).alias("place"))
        parts.append(placed.select("window", "length", F.lit(size).alias("size"), "place", shingle_at(F.col("words"), F.col("place"), size).alias("key")))
    return functools.reduce(DataFrame.unionByName, parts)


def _places(documents: DataFrame, size: int) -> DataFrame:
    """Every place of a shingle in documents, with the words around still at hand: nothing is copied until rows leave the stage."""
    placed = documents.filter(F.size("words") >= size).select("doc_id", "text_key", "words", F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("at"))
    return placed.withColumn("key", shingle_at(F.col("words"), F.col("at"), size))


def _union(spark, parts: list[DataFrame], schema: str) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def occurrences(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, block_bytes: int = BLOCK_BYTES, block_keys: int = BLOCK_KEYS) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_key, start, length, window) of every window in documents, and (item, window, length) of the items.
    `text_key` tells texts of one id apart. Both are tables in the shared folder."""
    spark = documents.sparkSession
    items = materialise(windows_of(benchmark, window), "windows")
    shingles = materialise(shingles_of(items, shingle), "shingles")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(F.coalesce("text", F.lit(""))).alias("text_key"), words_of(F.col("text")).alias("words"))
    counted = []
    for size, n in sorted(shingles.groupBy("size").agg(F.count_distinct("key")).collect()):
        blocks = -(-n // block_keys)
        keys = shingles.filter(F.col("size") == size).select("key").distinct()
        for b in range(blocks):
            block = keys.filter(F.pmod("key", F.lit(blocks)) == b)
            counted.append(_places(docs, size).join(F.broadcast(block), "key").groupBy("key").agg(F.count("*").alias("n")))
    counts = _union(spark, counted, "key bigint, n bigint")
    ranked = shingles.join(counts, "key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = ranked.groupBy("window", "length", "size").agg(F.min_by(F.struct("key", "place"), F.struct("n", "key", "place")).alias("first"), F.min("n").alias("n"))
    postings = materialise(rarest.filter("n > 0").select("window", "length", "size", "first.key", "first.place"), "postings")
    found = []
    for size, n in sorted(postings.groupBy("size").agg(F.sum(F.octet_length("window") + 64)).collect()):
        blocks = -(-n // block_bytes)
        for b in range(blocks):
            block = postings.filter((F.col("size") == size) & (F.pmod(F.xxhash64("window"), F.lit(blocks)) == b)).drop("size")
            start = F.col("at") - F.col("place")
            fits = (start >= 0) & (start + F.col("length") <= F.size("words"))
            same = F.array_join(F.slice("words", start + 1, F.col("length")), " ") == F.col("window")
            found.append(_places(docs, size).join(F.broadcast(block), "key").filter(F.when(fits, same).otherwise(False)).select("doc_id", "text_key", start.alias("start"), "length", "window"))
    return materialise(_union(spark, found, OCCURRENCE).distinct(), "occurrences"), items


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, **ways) -> DataFrame:
    """doc_id, n_words, n_hit (words in any occurrence), spans (start and length of occurrences) and items (ids of those
    with an occurrence, sorted), a row for each row of documents."""
    found, windows = occurrences(documents, benchmark, window, **ways)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(F.coalesce("text", F.lit(""))).alias("text_key"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_words"))
    by = ["doc_id", "text_key"]
    spans = found.groupBy(by).agg(F.sort_array(F.collect_set(F.struct("start", "length"))).alias("spans"))
    named = found.select(*by, "window").distinct().join(windows.select("window", "item"), "window").select(*by, "item").distinct()
    items = named.groupBy(by).agg(F.sort_array(F.collect_set("item")).alias("items"))
    parts = (rows.groupBy(*by, "n_words").agg(F.count("*").alias("copies")), spans, items)
    whole = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    one = whole.groupBy(by).agg(*(F.max(c).alias(c) for c in ("n_words", "copies")), *(F.any_value(c, F.lit(True)).alias(c) for c in ("spans", "items")))
    zero = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("end"))
    after = lambda x: (x["start"] + x["length"]).cast("long")
    reach = F.aggregate("spans", zero, lambda a, x: F.struct((a["hit"] + F.greatest(F.lit(0).cast("long"), after(x) - F.greatest(a["end"], x["start"].cast("long")))).alias("hit"), F.greatest(a["end"], after(x)).alias("end")))
    none = F.array().cast("array<string>")
    return one.select("doc_id", "n_words", F.coalesce(reach["hit"], F.lit(0)).cast("long").alias("n_hit"), "spans", F.coalesce("items", none).alias("items"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).drop("copy")


def contamination_digest(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = contamination(documents, benchmark)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, **ways) -> DataFrame:
    """The rows of documents, with all their columns, whose texts hold no window."""
    found, _ = occurrences(documents, benchmark, window, **ways)
    held = found.select(F.col("text_key").alias("__held_text")).distinct()
    return documents.join(held, F.md5(F.coalesce(documents["text"], F.lit(""))) == F.col("__held_text"), "left_anti")

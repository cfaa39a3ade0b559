"""Repository files as a DataFrame: folders are listed by tasks, conditions apply to the listing, contents are read last.

Spark's own file readers leave names out that begin with a dot or underscore. Roots must be mounted where executors run,
as source checkouts on a shared file system are. Nothing is listed on the driver: a task walks the folders it is given
until it has seen `FOLDERS_A_TURN`, and hands the rest back to be dealt out in the next round.
"""

from __future__ import annotations

import datetime
import hashlib
import os
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs, parse
from ..operators import graph

LISTED = "root string, path string, rel_path string, kind string, size_bytes bigint, last_write_utc timestamp, folder boolean"
CONTENTS = "path string, rel_path string, kind string, size_bytes bigint, last_write_utc timestamp, sha256 string, text string"
FOLDERS_A_TURN = 512
FILES_A_PART = 256
ROWS_A_BATCH = 64
BATCH_BYTES = 16 << 20
HASH_BUFFER = 1 << 20


def dot_suffix(name: str) -> str:
    """From the last dot, which may be the first character."""
    at = name.rfind(".")
    return name[at:].lower() if at >= 0 else ""


def walk(root: str, start: str, suffixes: frozenset[str], skip: frozenset[str], most: int) -> Iterator[dict]:
    """Files with one of the suffixes below `start`, and the folders that are left after `most`. Skipped names of folders
    are compared without case; folders that can't be read are left out, links to folders are not followed."""
    left, seen = [start], 0
    while left:
        folder = left.pop()
        if seen >= most:
            yield {"root": root, "path": folder, "folder": True}
            continue
        seen += 1
        try:
            entries = sorted(os.scandir(folder), key=lambda e: e.name)
        except OSError:
            continue
        for e in entries:
            try:
                if e.is_dir():
                    if not e.is_symlink() and e.name.lower() not in skip:
                        left.append(e.path)
                elif (suffix := dot_suffix(e.name)) in suffixes:
                    stat = e.stat()
                    when = datetime.datetime.fromtimestamp(stat.st_mtime, datetime.UTC)
                    yield {"root": root, "path": e.path, "rel_path": os.path.relpath(e.path, root).replace(os.sep, "/"), "kind": suffix[1:].upper(), "size_bytes": stat.st_size, "last_write_utc": when, "folder": False}
            except OSError:
                continue


def listing(spark: SparkSession, roots: Sequence[str] | str, extensions: Sequence[str] = exprs.EXTENSIONS, skip: Sequence[str] = (), folders_a_turn: int = FOLDERS_A_TURN) -> DataFrame:
    """root, path, rel_path, kind, size_bytes, last_write_utc of the files below roots; a missing root is made and has none."""
    roots = [roots] if isinstance(roots, str) else list(roots)
    for root in roots:
        os.makedirs(root, exist_ok=True)
    suffixes, without, schema = frozenset(extensions), frozenset(skip), parse.arrow(LISTED)

    def turn(batches):
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            yield from parse.record_batches((x for root, folder in rows for x in walk(root, folder, suffixes, without, folders_a_turn)), schema)

    left = spark.createDataFrame([(r, r) for r in roots], "root string, path string")
    found = None
    while found is None or not left.isEmpty():
        listed = graph.cut(left.repartition("path").mapInArrow(turn, LISTED))
        files = listed.filter("not folder").drop("folder")
        found = files if found is None else found.unionByName(files)
        left = listed.filter("folder").select("root", "path")
    return found


def contents(found: DataFrame, text: bool = True, hashes: bool = False) -> DataFrame:
    """Listed files with their text (null if not asked for) and the SHA-256 of their bytes, read by tasks of a few files
    each. What is filtered from the listing is never opened; files that are gone meanwhile are left out."""
    schema = parse.arrow(CONTENTS)

    def read(batches):
        rows, held = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                try:
                    if text:
                        with open(row["path"], encoding="utf-8-sig", errors="replace", newline="") as f:
                            row["text"] = f.read()
                    if hashes:
                        row["sha256"] = file_sha256(row["path"])
                except OSError:
                    continue
                rows.append(row)
                held += row["size_bytes"]
                if len(rows) >= ROWS_A_BATCH or held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    parts = max(1, -(-found.count() // FILES_A_PART))
    asked = found.select("path", "rel_path", "kind", "size_bytes", "last_write_utc")
    return asked.repartition(parts, "path").mapInArrow(read, CONTENTS)


def file_sha256(path: str) -> str:
    """Streamed, in lowercase hex."""
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(HASH_BUFFER):
            digest.update(block)
    return digest.hexdigest()


def files(spark: SparkSession, roots: Sequence[str] | str, extensions: Sequence[str] = exprs.EXTENSIONS, skip: Sequence[str] = (), content: bool = True, hashes: bool = False, where: Column | None = None) -> DataFrame:
    """path, rel_path, kind, size_bytes, last_write_utc, sha256, text of the files below roots that meet a condition on
    the first five; a missing root is made and has none."""
    found = listing(spark, roots, extensions, skip)
    return contents(found if where is None else found.filter(where), content, hashes)


def sql_files(spark: SparkSession, root: str) -> DataFrame:
    return files(spark, root, (".sql",), exprs.SQL_SKIP)


def model_files(spark: SparkSession, roots: Sequence[str]) -> DataFrame:
    return files(spark, roots, (".cs",))


def inline_files(spark: SparkSession, roots: Sequence[str]) -> DataFrame:
    return files(spark, roots, (".cs",), exprs.CS_SKIP)


def with_text_hash(rows: DataFrame, column: str = "text") -> DataFrame:
    """sha256 of a text column, in the JVM."""
    return rows.withColumn("sha256", F.sha2(F.coalesce(column, F.lit("")), 256))


#: Fixed value: a class whose first base is a context.
CONTEXT_CLASS = r"class\s+\w+\s*:\s*(\w+\.)*(Identity)?DbContext\b"


def code_roots(listing: DataFrame, n: int = 300) -> DataFrame:
    """Project folders whose first n C# files, by path, hold a context class or a DbSet property.

    `listing`: path, text of project and C# files. Folders of tests, samples and build output don't count.
    """
    folder = F.regexp_replace("path", r"/[^/]*$", "")
    excluded = F.exists(F.split(F.lower("path"), "/"), lambda s: s.isin(*exprs.TEST_SEGMENTS))
    projects = listing.filter(F.lower("path").endswith(".csproj") & ~excluded).select(folder.alias("root")).distinct()
    code = listing.filter(F.lower("path").endswith(".cs")).select("path", "text")
    under = code.withColumn("root", F.explode(exprs.folders_of(F.col("path")))).join(projects, "root")
    from ..operators.graph import first_per_group

    first = first_per_group(under, ["root"], ["path"], n)
    hit = F.col("text").rlike(CONTEXT_CLASS) | F.col("text").contains(" DbSet<") | F.col("text").contains("\tDbSet<")
    return first.groupBy("root").agg(F.bool_or(hit).alias("hit")).filter("hit").select("root")


def discover_roots(spark: SparkSession, sql_root: str) -> list[str]:
    """Code roots near a SQL root: three folders up, or Server/DataAccess there."""
    top = os.path.abspath(sql_root)
    for _ in range(3):
        top = os.path.dirname(top)
    inner = os.path.join(top, "Server", "DataAccess")
    top = inner if os.path.isdir(inner) else top
    return sorted(r.root for r in code_roots(files(spark, top, (".cs", ".csproj"))).collect())

"""Writers of a bundle: graph tables, JSON, body files, manifest, archive; and readers of what was written.

The relations themselves belong in Parquet (`write_tables`). The single-file forms are written by tasks, each its own
range of bytes; the archive alone is packed on one machine, from files.
"""

from __future__ import annotations

import csv
import datetime
import functools
import json
import os
import re
import shutil
import zipfile
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs
from ..operators import graph
from . import bodies, linefile

NODE_HEADER = ["key", "kind", "name", "schema", "file", "batch", "domain", "body_path"]
EDGE_HEADER = ["from", "to", "relation", "to_kind", "file", "batch"]


def write_tables(path: str, **tables: DataFrame) -> None:
    for name, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{path}/{name}")


def csv_lines(rows: DataFrame, header: list[str]) -> DataFrame:
    """One quoted CSV line a row, in the JVM."""
    ready = rows.withColumn("file", exprs.slashes(F.col("file")))
    return ready.select(F.concat_ws(",", *(exprs.csv_quote(F.col(f"`{c}`")) for c in header)).alias("line"))


def write_csv(rows: DataFrame, header: list[str], path: str, order: Sequence[str] = ()) -> None:
    """A header and a line a row, in alphabetical order of some columns."""
    columns = [F.col(f"`{c}`") for c in header]
    ready = rows.withColumn("file", exprs.slashes(F.col("file"))) if "file" in header else rows
    linefile.write(path, linefile.Part(ready, F.concat_ws(",", *map(exprs.csv_quote, columns)), graph.alphabetical(*order), ",".join(header) + "\n", "\n", "\n"))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A written CSV again, all texts."""
    return spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True).na.fill("")


def json_lines(rows: DataFrame) -> DataFrame:
    return rows.select(json_line(rows).alias("value"))


def json_line(rows: DataFrame) -> Column:
    return F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})


def write_bodies_jsonl(parts: Iterable[DataFrame], path: str) -> None:
    """Shapes one after the other: scripts, entities, migrations, embedded SQL."""
    linefile.write(path, *(linefile.Part(rows, F.concat(json_line(rows), F.lit("\n")), between="") for rows in parts))


def write_body_files(parts: Iterable[DataFrame], folder: str) -> None:
    """A file for each row with a path (`body_path` or `bodyPath`) and its body, committed together."""
    named = [p.select(F.col("body_path" if "body_path" in p.columns else "bodyPath").alias("path"), F.coalesce("body", F.lit("")).alias("content")) for p in parts]
    bodies.write(functools.reduce(DataFrame.unionByName, named), folder)


def write_graph_json(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """{"nodes": [...], "edges": [...]} with all values as texts, in the files' orders."""
    texts = lambda rows, header: rows.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in header))
    n, e = texts(nodes, NODE_HEADER), texts(edges, EDGE_HEADER)
    linefile.write(path, linefile.Part(n, json_line(n), graph.alphabetical(*graph.NODE_ORDER), '{"nodes":[', ",", "],"), linefile.Part(e, json_line(e), graph.alphabetical(*graph.EDGE_ORDER), '"edges":[', ",", "]}"))


def manifest(nodes: DataFrame, edges: DataFrame, bodies: DataFrame, sql_root: str, code_roots: list[str]) -> dict:
    """Counts before enrichment; docs are bodies of scripts only."""
    return {"schema": 1, "builtAt": datetime.datetime.now(datetime.UTC).isoformat(), "sqlRoot": sql_root, "codeRoots": code_roots, "counts": {"nodes": nodes.count(), "edges": edges.count(), "docs": bodies.count()}}


def write_json(value, path: str) -> None:
    with open(path, "w", encoding="utf-8") as f:
        json.dump(value, f, indent=2, ensure_ascii=False)


def write_code(chunks: DataFrame, adjacency: DataFrame, meta: dict, folder: str) -> None:
    """chunks.json, dependencies.json, repo_meta.json and README_WSL.txt."""
    os.makedirs(folder, exist_ok=True)
    public = chunks.drop("member_ord", "params", "path")
    linefile.write(os.path.join(folder, "chunks.json"), linefile.Part(public, json_line(public), [F.col("id")], "[\n  ", ",\n  ", "\n]\n"))
    entry = F.concat(F.lit('"'), "src", F.lit('": '), F.to_json("callees"))
    linefile.write(os.path.join(folder, "dependencies.json"), linefile.Part(adjacency, entry, [F.col("src")], "{\n  ", ",\n  ", "\n}\n"))
    write_json(meta, os.path.join(folder, "repo_meta.json"))
    with open(os.path.join(folder, "README_WSL.txt"), "w", encoding="utf-8") as f:
        f.write("Unpack this archive where the retrieval service reads its bundles.\n")


def branch_file_name(branch: str | None) -> str:
    """A branch as a file name; artifacts where nothing is left."""
    name = re.sub(r'[/\\<>:"|?*\x00-\x1f]', "_", branch or "").strip().rstrip(".")
    return name if (branch or "").strip() and name else "artifacts"


def archive(folder: str, branch: str | None = None, out_dir: str | None = None, keep: bool = False) -> str:
    """Zip a folder's content at the archive's root, remove the folder, move the archive; an existing name gets a time stamp."""
    target_dir = out_dir or os.path.dirname(os.path.abspath(folder))
    os.makedirs(target_dir, exist_ok=True)
    stem = os.path.join(target_dir, branch_file_name(branch))
    path, n = f"{stem}.zip", 0
    stamp = datetime.datetime.now(datetime.UTC).strftime("%Y%m%d_%H%M%S")
    while os.path.exists(path):
        path = f"{stem}_{stamp}{f'_{n}' if n else ''}.zip"
        n += 1
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for top, _, names in os.walk(folder):
            for name in sorted(names):
                whole = os.path.join(top, name)
                z.write(whole, os.path.relpath(whole, folder))
    if not keep:
        shutil.rmtree(folder)
    return path


def split_csv(line: str) -> list[str]:
    return next(csv.reader([line]), [])

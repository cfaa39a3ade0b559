"""Solution files, projects of documents, and the state of a git checkout."""

from __future__ import annotations

import os
import re
import subprocess

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PROJECT_SUFFIX = r"(?i)\.(csproj|vbproj|fsproj|sqlproj)$"


def normal_path(folder: Column, path: Column) -> Column:
    """A path below a folder with forward slashes, . and .. taken out."""
    whole = F.when(F.startswith(path, F.lit("/")) | path.rlike("^[A-Za-z]:"), path).otherwise(F.concat(folder, F.lit("/"), path))
    parts = F.filter(F.split(F.replace(whole, F.lit("\\"), F.lit("/")), "/"), lambda p: (p != ".") & (p != ""))
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda a, p: F.when((p == "..") & (F.size(a) > 0), F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))).when(p == "..", a).otherwise(F.array_append(a, p)))
    return F.concat(F.when(F.startswith(whole, F.lit("/")), "/").otherwise(""), F.array_join(kept, "/"))


def distinct_projects(found: DataFrame) -> DataFrame:
    """(solution, project_path, n) of supported projects from (solution, folder, n, project): distinct without case, the first spelling kept."""
    rows = found.filter(F.col("project").rlike(PROJECT_SUFFIX)).withColumn("project_path", normal_path(F.col("folder"), F.replace("project", F.lit("\\"), F.lit("/"))))
    return rows.groupBy("solution", F.lower("project_path").alias("k")).agg(F.min_by("project_path", "n").alias("project_path"), F.min("n").alias("n")).select("solution", "project_path", "n")


def sln_projects(texts: DataFrame) -> DataFrame:
    """Of (solution, folder, value): Project("...") lines, the text between the first and second comma without quotes."""
    lines = texts.select("solution", "folder", F.posexplode(F.split("value", "\r?\n")).alias("n", "line"))
    found = lines.filter(F.startswith(F.ltrim("line"), F.lit('Project("')) & (F.size(F.split("line", ",")) > 2))
    return distinct_projects(found.select("solution", "folder", "n", F.trim(F.replace(F.get(F.split("line", ","), F.lit(1)), F.lit('"'), F.lit(""))).alias("project")))


def slnx_projects(texts: DataFrame) -> DataFrame:
    """Of (solution, folder, value): Path attributes anywhere in the XML."""
    bare = texts.withColumn("value", F.regexp_replace("value", r"(?s)<!--.*?-->", ""))
    return distinct_projects(bare.select("solution", "folder", F.posexplode(F.regexp_extract_all("value", F.lit(r"""\bPath\s*=\s*["']([^"']+)["']"""), 1)).alias("n", "project")))


READERS = {".sln": sln_projects, ".slnx": slnx_projects}


def read_solution(spark: SparkSession, path: str) -> DataFrame:
    """solution, project_path, n; the reader is the one for the file's suffix."""
    reader = READERS.get(os.path.splitext(path)[1].lower())
    if reader is None:
        raise NotImplementedError(f"no reader for {path}")
    text = spark.read.text(path, wholetext=True)
    place = os.path.abspath(path)
    return reader(text.select(F.lit(place).alias("solution"), F.lit(os.path.dirname(place)).alias("folder"), "value"))


def git_state(path: str) -> dict[str, str]:
    """branch, head_sha and root of the checkout around a path: git's own answer, else what its files say; never an error."""
    folder = path if os.path.isdir(path) else os.path.dirname(os.path.abspath(path))

    def ask(*args: str) -> str:
        try:
            done = subprocess.run(["git", "-C", folder, *args], capture_output=True, text=True, timeout=3)
            return done.stdout.strip() if done.returncode == 0 else ""
        except (OSError, subprocess.SubprocessError):
            return ""

    root, sha, branch = ask("rev-parse", "--show-toplevel"), ask("rev-parse", "HEAD"), ask("rev-parse", "--abbrev-ref", "HEAD")
    if root and sha:
        return {"branch": "(detached)" if branch == "HEAD" else branch, "head_sha": sha, "root": root}
    return git_files(folder)


def git_files(folder: str) -> dict[str, str]:
    none = {"branch": "", "head_sha": "", "root": ""}
    try:
        while not os.path.isdir(os.path.join(folder, ".git")):
            above = os.path.dirname(folder)
            if above == folder:
                return none
            folder = above
        git = os.path.join(folder, ".git")
        with open(os.path.join(git, "HEAD"), encoding="utf-8") as f:
            head = f.read().strip()
        if not head.startswith("ref:"):
            return {"branch": "(detached)", "head_sha": head, "root": folder}
        ref = head[4:].strip()
        sha, loose, packed = "", os.path.join(git, ref), os.path.join(git, "packed-refs")
        if os.path.isfile(loose):
            with open(loose, encoding="utf-8") as f:
                sha = f.read().strip()
        elif os.path.isfile(packed):
            with open(packed, encoding="utf-8") as f:
                m = re.search(rf"^([0-9a-f]+) {re.escape(ref)}$", f.read(), re.M)
                sha = m[1] if m else ""
        return {"branch": ref.removeprefix("refs/heads/"), "head_sha": sha, "root": folder}
    except OSError:
        return none

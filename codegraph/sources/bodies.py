"""A sink that writes each row as a file of its own, all of them or none.

Tasks write below a staging folder inside the target: first under the attempt's own folder, then renamed into the staged
tree, so a repeated or speculative attempt replaces whole files by equal ones. The commit drops what attempts left behind
and renames the staged folders to their places, one rename for each folder that the target hasn't yet. A job that ends
before its commit leaves nothing in the target but the staging folder, and an aborted one not even that.
"""

from __future__ import annotations

import os
import shutil
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

STAGING = ".staging-"
ATTEMPT = ".attempt-"


@dataclass
class Written(WriterCommitMessage):
    files: int


def _place(root: str, relative: str) -> str:
    """A path below the root; one that leads out of it is refused."""
    whole = os.path.normpath(os.path.join(root, relative))
    if os.path.isabs(relative) or not whole.startswith(os.path.normpath(root) + os.sep):
        raise ValueError(f"not a path below the folder: {relative!r}")
    return whole


def _move(source: str, target: str) -> None:
    """A file or folder to its place; folders that exist are filled, files replaced."""
    if os.path.isdir(source) and os.path.isdir(target):
        for name in sorted(os.listdir(source)):
            _move(os.path.join(source, name), os.path.join(target, name))
    else:
        os.replace(source, target)


class BodyWriter(DataSourceWriter):
    def __init__(self, path: str):
        self.path = path
        self.staging = os.path.join(path, f"{STAGING}{uuid.uuid4().hex}")

    def write(self, iterator):
        own = os.path.join(self.staging, f"{ATTEMPT}{uuid.uuid4().hex}")
        os.makedirs(own, exist_ok=True)
        part, n = os.path.join(own, "part"), 0
        for relative, content in iterator:
            target = _place(self.staging, relative)
            with open(part, "wb") as f:
                f.write(content.encode("utf-8", "surrogatepass") if isinstance(content, str) else bytes(content or b""))
            os.makedirs(os.path.dirname(target), exist_ok=True)
            os.replace(part, target)
            n += 1
        return Written(n)

    def commit(self, messages):
        os.makedirs(self.staging, exist_ok=True)
        for name in sorted(os.listdir(self.staging)):
            whole = os.path.join(self.staging, name)
            if name.startswith(ATTEMPT):
                shutil.rmtree(whole)
            else:
                _move(whole, os.path.join(self.path, name))
        shutil.rmtree(self.staging)

    def abort(self, messages):
        shutil.rmtree(self.staging, ignore_errors=True)


class BodyFiles(DataSource):
    @classmethod
    def name(cls):
        return "bodyfiles"

    def writer(self, schema, overwrite):
        return BodyWriter(self.options["path"])


def write(rows: DataFrame, folder: str, path_column: str = "path", content_column: str = "content") -> None:
    """A file a row, of text (UTF-8) or bytes, at a path below the folder, which driver and executors must both see. Rows
    without a path are left out, null contents make empty files."""
    rows.sparkSession.dataSource.register(BodyFiles)
    named = rows.select(path_column, content_column).filter(rows[path_column].isNotNull())
    named.write.format("bodyfiles").mode("append").save(folder)

"""Incremental indexing: new or changed files of a landing folder, each content once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parse

SCHEMA = "path string, rel_path string, text string, seen timestamp"


def changed_files(spark: SparkSession, landing: str, late: str = "1 day") -> DataFrame:
    """A stream of (path, rel_path, text, sha256): rows that repeat a file's content within the time allowed for late ones are left out."""
    rows = spark.readStream.schema(SCHEMA).parquet(landing).withColumn("sha256", F.sha2(F.coalesce("text", F.lit("")), 256))
    return rows.withWatermark("seen", late).dropDuplicatesWithinWatermark(["rel_path", "sha256"])


def index_scripts(spark: SparkSession, landing: str, out: str, checkpoint: str):
    """Parse changed scripts as they come and append their batches to a table."""
    parsed = parse.parse_tsql(changed_files(spark, landing))
    return parsed.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

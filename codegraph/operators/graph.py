"""Graph algebra: first-wins, kind resolution, edge de-duplication, closure. Keys compare without case, edges with it.

Nodes: key, kind, name, schema, file, batch, domain, body_path and `seq`, a struct that orders rows (stage, path, batch, ord, nth).
Edges: from, to, relation, to_kind, file, batch, seq.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import exprs
from . import skew

NODE = ["key", "kind", "name", "schema", "file", "batch", "domain", "body_path"]
EDGE = ["from", "to", "relation", "to_kind", "file", "batch"]
#: Lines in a bucket of the interval index, and in a block of a sweep, as powers of two.
BUCKET_BITS, BLOCK_BITS = 6, 12


def seq(stage: int, path: Column, batch: Column | None = None, ord_: Column | None = None, nth: Column | None = None) -> Column:
    whole = lambda c: F.lit(0) if c is None else F.coalesce(c, F.lit(0)).cast("int")
    return F.struct(F.lit(stage).alias("stage"), path.alias("path"), whole(batch).alias("batch"), whole(ord_).alias("ord"), whole(nth).alias("nth"))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, of spark.checkpoint.dir; a session on one machine may have a temporary one."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="codegraph-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def cut(rows: DataFrame) -> DataFrame:
    """The rows from a copy in the shared folder."""
    context = rows.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(rows.sparkSession))
    return rows.checkpoint()


def stored(rows: DataFrame) -> DataFrame:
    """The rows from a table in the shared folder, for wide rows of which later steps read some columns each. Unlike `cut`
    it keeps neither partitions nor their order. It goes when Python ends, if its folder is one of this machine."""
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/rows-{uuid.uuid4().hex}"
    atexit.register(shutil.rmtree, path.removeprefix("file://"), ignore_errors=True)
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def shuffled(rows: DataFrame) -> DataFrame:
    """A side of a join that grows with the corpus. Sizes of rows that come out of a parser are estimated from the tables
    that texts were read from, far too low, so such a side must not be broadcast on an estimate."""
    return rows.hint("merge")


def case_free(key: Column | str) -> Column:
    """A key that is equal for texts that the collation UTF8_LCASE takes as equal, character by character without case; for
    grouping and joining, not for output. A plain text, as keys with a collation are sorted and hashed by slower ways."""
    text = F.col(key) if isinstance(key, str) else key
    single = F.array_join(F.transform(F.split(text, ""), F.lower), "")  # whole texts have a sigma of their own at a word's end
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(single, "\u03c2", "\u03c3"))


def alphabetical(*columns: str) -> list[Column]:
    """The order of a language's readers: letters by alphabet, then accents, then case; equals in binary order."""
    return [*(F.collate(c, "UNICODE") for c in columns), *map(F.col, columns)]


def first_by(rows: DataFrame, keys: list[Column], order: str = "seq") -> DataFrame:
    """One row a key, the first by an order. An aggregation, so hot keys are cut down before the shuffle."""
    names = rows.columns
    held = F.min_by(F.struct(*names), F.col(order)).alias("__row")
    grouped = rows.groupBy(*(k.alias(f"__k{i}") for i, k in enumerate(keys))).agg(held)
    return grouped.select(*(F.col(f"__row.`{n}`").alias(n) for n in names))


def upsert_nodes(*parts: DataFrame) -> DataFrame:
    """All parts' nodes, the first of each key."""
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return first_by(whole, [case_free("key")])


def dedupe_edges(edges: DataFrame) -> DataFrame:
    """The first edge of each (from, to, relation). Who asks for these alone has them without the first edges being looked for."""
    keys = ["from", "to", "relation"]
    held = F.min_by(F.struct(*(c for c in edges.columns if c not in keys)), F.col("seq")).alias("__row")
    return edges.groupBy(*keys).agg(held).select(*(F.col(f"`{c}`") if c in keys else F.col(f"__row.`{c}`").alias(c) for c in edges.columns))


def defined_kinds(defines: DataFrame) -> DataFrame:
    """(base, kind): the first kind of each name; `defines` has key and seq."""
    base = defines.select(target_base(F.col("key")).alias("base"), exprs.key_kind(F.col("key")).alias("kind"), "seq")
    return base.groupBy("base").agg(F.min_by("kind", "seq").alias("kind"))


def target_base(to: Column) -> Column:
    return case_free(exprs.key_name(to))


def resolve_kinds(edges: DataFrame, kinds: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Targets whose name is defined take the defined kind. Targets that many edges name are dealt out by their sources.
    `counts`: (base, n) edges of each `target_base`, if they are known without making the edges."""
    e = edges.withColumn("__base", target_base(F.col("to")))
    counts = counts and counts.withColumnRenamed("base", "__base")
    k = kinds.select(F.col("base").alias("__base"), F.col("kind").alias("__kind"))
    to = F.when(F.col("__kind").isNotNull(), F.concat(exprs.key_name(F.col("to")), F.lit("|"), F.col("__kind"))).otherwise(F.col("to"))
    spread = F.struct(*(F.col(f"`{c}`") for c in ("from", "relation", "file") if c in edges.columns))
    return skew.salted_join(e, k, "__base", spread, counts=counts).withColumn("to", to).withColumn("to_kind", F.coalesce("__kind", "to_kind")).select(*edges.columns)


def missing_nodes(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(external) nodes for targets that none describes."""
    targets = edges.groupBy(case_free("to").alias("__key")).agg(F.min_by(F.struct("to", "to_kind"), F.struct("from", "relation", "to")).alias("t"), F.min("seq").alias("seq"))
    absent = targets.join(shuffled(nodes.select(case_free("key").alias("__key"))), "__key", "left_anti")
    schema, name = exprs.schema_and_name(exprs.key_name(F.col("t.to")))
    kind = F.coalesce("t.to_kind", exprs.key_kind(F.col("t.to")))
    return absent.select(F.col("t.to").alias("key"), kind.alias("kind"), name.alias("name"), schema.alias("schema"), F.lit("").alias("file"), F.lit(None).cast("int").alias("batch"), F.lit("(external)").alias("domain"), F.lit(None).cast("string").alias("body_path"), "seq")


def missing_tables(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Nodes of domain db for TABLE targets without one, with the file of the first such edge in (from, to) order."""
    tables = edges.filter(F.upper("to_kind") == "TABLE")
    first = tables.groupBy(case_free("to").alias("__key")).agg(F.min_by(F.struct("to", "file"), F.struct("from", "to", "relation", "file")).alias("t"), F.min("seq").alias("seq"))
    absent = first.join(shuffled(nodes.select(case_free("key").alias("__key"))), "__key", "left_anti")
    schema, name = exprs.table_key_parts(F.col("t.to"))
    return absent.select(F.col("t.to").alias("key"), F.lit("TABLE").alias("kind"), name.alias("name"), schema.alias("schema"), F.col("t.file").alias("file"), F.lit(None).cast("int").alias("batch"), F.lit("db").alias("domain"), F.lit(None).cast("string").alias("body_path"), "seq")


def _line_bucket(line: Column) -> Column:
    return F.shiftright(line, BUCKET_BITS)


def held_lines(lines: DataFrame, spans: DataFrame) -> DataFrame:
    """(path, line, m): the first span that holds each distinct line of a path, if any does.

    Spans are cut at buckets of lines and joined by path and bucket. Of equal pieces in a bucket only the first is kept,
    so a bucket has a bounded number of them however many methods a file or a line has.
    """
    covered = spans.select("path", "start_line", "end_line", F.struct("ord", "ns", "type", "method").alias("m"), F.explode(F.sequence(_line_bucket(F.col("start_line")), _line_bucket(F.col("end_line")))).alias("bucket"))
    low, high = F.shiftleft("bucket", BUCKET_BITS), F.shiftleft(F.col("bucket") + 1, BUCKET_BITS) - 1
    pieces = covered.groupBy("path", "bucket", F.greatest("start_line", low).alias("low"), F.least("end_line", high).alias("high")).agg(F.min("m").alias("m"))
    asked = lines.select("path", "line").filter("line is not null").distinct().withColumn("bucket", _line_bucket(F.col("line")))
    return asked.join(shuffled(pieces), ["path", "bucket"]).filter(F.col("line").between(F.col("low"), F.col("high"))).groupBy("path", "line").agg(F.min("m").alias("m"))


def near_lines(lines: DataFrame, spans: DataFrame) -> DataFrame:
    """(path, line, m): for each distinct line that no span holds, the span with the least distance, the first of equals.

    That is the last to end before the line or the first to begin after it: both by a sweep over ends, begins and lines in
    order. Sweeps run in blocks of lines, and what the blocks before and after bring is carried from block to block.
    """
    m = F.struct("ord", "ns", "type", "method")
    block = lambda at: F.shiftright(at, BLOCK_BITS).alias("block")
    at = lambda c: spans.groupBy("path", F.col(c).alias("at")).agg(F.min(m).alias("m"))
    asked = lines.select("path", F.col("line").alias("at")).filter("at is not null").distinct().withColumn("asked", F.lit(True))
    events = asked.unionByName(at("end_line").select("path", "at", F.struct("at", "m").alias("left")), allowMissingColumns=True).unionByName(at("start_line").select("path", "at", F.struct("at", "m").alias("right")), allowMissingColumns=True).withColumn("block", block(F.col("at")))
    blocks = events.groupBy("path", "block").agg(F.max_by("left", F.when(F.col("left").isNotNull(), F.col("at"))).alias("l"), F.min_by("right", F.when(F.col("right").isNotNull(), F.col("at"))).alias("r"))
    # Downwards too the frame ends at the row itself: one that runs on to the end is gone through anew for each row.
    sweep = lambda keys, order, end: Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, end)
    latest = lambda c, keys, order, end: F.last(c, True).over(sweep(keys, order, end)).alias(c)
    carried = blocks.select("path", "block", latest("l", ["path"], F.asc("block"), -1), latest("r", ["path"], F.desc("block"), -1))
    inside = ["path", "block"]
    swept = events.select("path", "block", "at", "asked", latest("left", inside, F.asc("at"), 0), latest("right", inside, F.desc("at"), 0)).filter("asked")
    ends = swept.join(shuffled(carried), ["path", "block"]).select("path", "at", F.coalesce("left", "l").alias("left"), F.coalesce("right", "r").alias("right"))
    far = lambda c, d: F.when(F.col(c).isNotNull(), F.struct(d.alias("d"), F.col(f"{c}.m").alias("m")))
    return ends.select("path", F.col("at").alias("line"), F.least(far("left", F.col("at") - F.col("left.at")), far("right", F.col("right.at") - F.col("at")))["m"].alias("m"))


def _with_method(rows: DataFrame, m: Column, keep: list[str]) -> DataFrame:
    return rows.select(*(F.col(f"`{c}`") for c in keep), *(m[c].alias(c) for c in ("ns", "type", "method")))


def method_at_line(lines: DataFrame, spans: DataFrame) -> DataFrame:
    """Rows of (path, line, ...) with the first method span of the path that holds the line, null if none does."""
    return _with_method(lines.join(shuffled(held_lines(lines, spans)), ["path", "line"], "left"), F.col("m"), lines.columns)


def nearest_method(lines: DataFrame, spans: DataFrame) -> DataFrame:
    """Rows with the method of the path with the least distance to the line, the first of equals; without a line, the first."""
    held = held_lines(lines, spans).withColumnRenamed("m", "held")
    first = spans.groupBy("path").agg(F.min(F.struct("ord", "ns", "type", "method")).alias("first"))
    rows = lines.join(shuffled(held), ["path", "line"], "left").join(shuffled(near_lines(lines, spans)), ["path", "line"], "left").join(shuffled(first), "path", "left")
    return _with_method(rows, F.when(F.col("line").isNull(), F.col("first")).otherwise(F.coalesce("held", "m")), lines.columns)


def first_per_group(rows: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """The first n rows of each group."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= n).drop("__n")


#: Nodes and edges of files are in this order.
NODE_ORDER, EDGE_ORDER = ("key",), ("from", "to", "relation", "file")


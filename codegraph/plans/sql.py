"""SQL knowledge from scripts: definitions, references, pseudo-definitions, edges, closure and bodies."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs
from ..operators import graph


DEFINES_A_BLOCK = 512


class Knowledge:
    """Nodes, edges and bodies of scripts. Each is worked out from the parsed batches where it is asked for, in the columns
    that are asked for; `kept_edges` are the edges from a table, for who starts from them several times."""

    def __init__(self, batches: DataFrame):
        self.batches = batches

    @functools.cached_property
    def found(self) -> DataFrame:
        return defines(self.batches)

    @functools.cached_property
    def kinds(self) -> DataFrame:
        return graph.defined_kinds(script_nodes(self.found))

    @functools.cached_property
    def edges(self) -> DataFrame:
        targets = references(self.batches).groupBy(graph.target_base(F.col("to")).alias("base")).agg(F.sum("n_defs").alias("n"))  # an edge for each definition
        return graph.dedupe_edges(graph.resolve_kinds(batch_edges(self.batches), self.kinds, targets))

    @functools.cached_property
    def kept_edges(self) -> DataFrame:
        return graph.stored(self.edges)

    @functools.cached_property
    def nodes(self) -> DataFrame:
        return graph.stored(self.nodes_with(*graph.NODE[1:]))

    def nodes_with(self, *columns: str) -> DataFrame:
        """key, some columns and seq of the defined nodes and of external ones for targets that none of them is."""
        every, names = script_nodes(self.found), ["key", *columns, "seq"]
        edges = self.__dict__.get("kept_edges", self.edges)
        return graph.upsert_nodes(every.select(*names)).unionByName(graph.missing_nodes(edges, every).select(*names))

    @functools.cached_property
    def bodies(self) -> DataFrame:
        return script_bodies(self.found)


def _definition() -> dict[str, Column]:
    """Columns of a definition from `defines`, gone into with its empty arrays; a batch without any is a BATCH or, in a pre-
    or post-deployment script, a DEPLOY."""
    real = F.col("d_ord").isNotNull()
    low = F.when(F.col("is_prepost"), "__deploy__").otherwise("__batch__")
    name = F.when(real, F.col("d_name")).otherwise(F.concat(low, F.lit(":"), exprs.slashes(F.col("rel_path")), F.lit(":"), F.col("batch")))
    kind = F.when(real, F.col("d_kind")).when(F.col("is_prepost"), "DEPLOY").otherwise("BATCH")
    schema = F.coalesce("d_schema", F.lit("dbo"))
    key = F.when(real, exprs.object_key(F.col("d_schema"), F.col("d_name"), F.col("d_kind"), F.col("d_db"))).otherwise(F.concat(schema, F.lit("."), name, F.lit("|"), kind))
    return {"ord": F.coalesce("d_ord", F.lit(0)), "key": key, "kind": kind, "name": name, "schema": schema}


DEFINED = ("d_ord", "d_db", "d_schema", "d_name", "d_kind", "d_text")


def defines(batches: DataFrame) -> DataFrame:
    """One row a definition."""
    named = batches.select("path", "rel_path", "domain", "batch", "is_prepost", F.col("text").alias("whole"), F.inline_outer("defines").alias(*DEFINED))
    body = F.when(F.col("d_ord").isNotNull(), F.col("d_text")).otherwise(F.col("whole"))
    return named.select("path", "rel_path", "domain", "batch", *(c.alias(n) for n, c in _definition().items()), body.alias("body"))


def references(batches: DataFrame) -> DataFrame:
    number = F.greatest(F.size("defines"), F.lit(1)).alias("n_defs")  # a batch without any has a pseudo-definition
    return _targets(batches.select("path", "rel_path", "batch", number, F.inline("refs").alias(*NAMED)))


NAMED = ("ref_ord", "r_db", "r_schema", "r_name", "r_kind", "r_relation")


def _targets(refs: DataFrame) -> DataFrame:
    """The other columns, and ref_ord, to, to_kind and relation of references whose columns are named so."""
    kind = F.coalesce("r_kind", F.lit("UNKNOWN"))
    key = exprs.object_key(F.col("r_schema"), F.col("r_name"), kind, F.col("r_db"))
    others = [c for c in refs.columns if c not in NAMED]
    return refs.filter(~F.col("r_name").rlike("^[#@]")).select(*others, "ref_ord", key.alias("to"), kind.alias("to_kind"), F.coalesce("r_relation", F.lit("Uses")).alias("relation"))


def define_ref_edges(found: DataFrame, refs: DataFrame) -> DataFrame:
    """Every definition of a batch linked to every reference of it. The definitions of a large batch come in blocks, each
    joined to a copy of the references, so that no task makes a whole product of thousands by thousands.

    `found` numbers the definitions of a batch from 0 (`ord`); `refs` tells their number (`n_defs`), or has it counted."""
    if "n_defs" not in refs.columns:
        refs = refs.join(found.groupBy("path", "batch").agg((F.max("ord") + 1).alias("n_defs")), ["path", "batch"])
    block = lambda ord_: F.floor(ord_ / DEFINES_A_BLOCK).cast("int")
    d = found.select("path", "batch", block(F.col("ord")).alias("block"), F.col("key").alias("from"), F.col("ord").alias("def_ord"))
    r = refs.withColumn("block", F.explode(F.sequence(F.lit(0), F.greatest(block(F.col("n_defs") - 1), F.lit(0)))))
    return _edges(d.join(r, ["path", "batch", "block"]))


def define_ref_totals(found: DataFrame, refs: DataFrame) -> DataFrame:
    """One row a definition of a batch with references: how many edges `define_ref_edges` gives it (`n`) and the place that
    they share. References are counted a batch first, so a batch of thousands by thousands makes no product."""
    counted = refs.groupBy("path", "batch").agg(F.count("*").alias("n"))
    order = graph.seq(0, F.col("path"), F.col("batch"), F.col("ord"))
    return found.join(graph.shuffled(counted), ["path", "batch"]).select(F.col("key").alias("from"), "n", order.alias("seq"))


def batch_edges(batches: DataFrame) -> DataFrame:
    """`define_ref_edges` of parsed batches. A batch's definitions and references lie side by side in its row and are paired
    there; batches of so many definitions that they come in blocks are taken apart and joined."""
    large = F.size("defines") > DEFINES_A_BLOCK
    paired = batches.filter(~large).select("path", "rel_path", "batch", "is_prepost", "refs", F.inline_outer("defines").alias(*DEFINED))
    d = _definition()
    paired = paired.select("path", "rel_path", "batch", "refs", d["key"].alias("from"), d["ord"].alias("def_ord"))
    paired = _targets(paired.select("path", "rel_path", "batch", "from", "def_ord", F.inline("refs").alias(*NAMED)))
    joined = batches.filter(large)
    return _edges(paired).unionByName(define_ref_edges(defines(joined), graph.shuffled(references(joined))))


def _edges(pairs: DataFrame) -> DataFrame:
    order = graph.seq(0, F.col("path"), F.col("batch"), F.col("def_ord"), F.col("ref_ord"))
    return pairs.select("from", "to", "relation", "to_kind", exprs.slashes(F.col("rel_path")).alias("file"), "batch", order.alias("seq"))


def script_nodes(found: DataFrame, *more: str) -> DataFrame:
    has_body = F.col("kind").isin(*exprs.BODY_KINDS)
    name = F.concat_ws(".", "schema", F.coalesce("name", F.lit("(anon)")), "kind")
    path = F.concat(F.lit("docs/bodies/"), F.regexp_replace(name, r"[/\\\x00]", "_"), F.lit(".sql"))
    return found.select("key", "kind", "name", "schema", exprs.slashes(F.col("rel_path")).alias("file"), "batch", F.col("domain"), F.when(has_body, path).alias("body_path"), graph.seq(0, F.col("path"), F.col("batch"), F.col("ord")).alias("seq"), *more)


def script_bodies(found: DataFrame) -> DataFrame:
    """Of the first definitions of each key the first of each body path: key, kind, schema, name, domain, file, body, body_path."""
    made = script_nodes(found.select("*", F.struct("name", "body").alias("own")), "own")
    first = graph.first_by(graph.upsert_nodes(made.drop("name", "batch")).filter(F.col("body_path").isNotNull()), [F.lower("body_path")])
    return first.select("key", "kind", "schema", "own.name", "domain", "file", "own.body", "body_path")


def knowledge(batches: DataFrame) -> Knowledge:
    return Knowledge(batches)


def definition_artifacts(batches: DataFrame) -> DataFrame:
    """source_path, kind, identifier of CREATE and of ALTER VIEW, PROC and FUNC; synonyms are left out."""
    made = batches.select("path", F.inline("defines").alias("ord", "db", "schema", "name", "kind", "text")).filter("kind <> 'SYNONYM'").select("path", "schema", "name", "kind")
    altered = batches.select("path", F.inline("alters").alias("db", "schema", "name", "kind")).select("path", "schema", "name", "kind")
    whole = made.unionByName(altered)
    return whole.select(F.col("path").alias("source_path"), F.col("kind").alias("artifact_kind"), exprs.object_key(F.col("schema"), F.col("name"), F.col("kind")).alias("identifier"))

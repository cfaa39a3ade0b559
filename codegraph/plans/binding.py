"""Type names bound to qualified declarations, the hierarchy of types, and the interfaces and base type of each.

A type's key is its namespace, name and number of type parameters, as in `Shop.Core.IStore`1`; the parts of a partial type
share one. A name is looked up in the enclosing namespaces from the inside out, then in the file's usings; aliases are
replaced first. What is declared nowhere keeps its written name and counts as an interface if it is named like one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import graph

CONTEXT = ["ns", "usings", "written"]


@dataclass
class Types:
    declared: DataFrame  # key, kind
    parts: DataFrame  # path, class_ord, key, kind, ns, usings
    bases: DataFrame  # key, nth, base (null if not declared), shown, is_interface
    lineage: DataFrame  # key, ancestor, depth; itself at depth 0


def without_lists(text: Column) -> Column:
    """A type or parameter list without what stands in inner brackets and quotes, so that commas separate its parts."""
    bare = F.regexp_replace(text, r'"(?:[^"\\]|\\.)*"', "s")
    for _ in range(4):
        bare = F.regexp_replace(bare, r"<[^<>]*>|\([^()]*\)|\[[^\[\]]*\]", "")
    return bare


def arguments_of(written: Column) -> Column:
    """Number of type arguments of a written type."""
    inner = F.regexp_extract(written, r"<(.*)>[^>]*$", 1)
    return F.when(F.trim(inner) == "", 0).otherwise(F.size(F.split(without_lists(inner), ",")))


def shown(written: Column) -> Column:
    """A type without namespaces, one space after commas."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(written), r"\s+", ""), r"(?:\w+(?:\.|::))+(?=\w)", "")
    return F.regexp_replace(bare, ",", ", ")


def key_of(name: Column, parameters: Column) -> Column:
    return F.concat(name, F.when(parameters > 0, F.concat(F.lit("`"), parameters.cast("string"))).otherwise(""))


def parts_of(syntax: DataFrame) -> DataFrame:
    """Each declared part of a type: path, class_ord, key, kind, ns, usings, name, bases."""
    c = syntax.select("path", "usings", F.inline("classes"))
    head = F.regexp_extract(F.substring_index("text", "{", 1), r"\b(?:class|struct|interface|record)\s+\w+\s*<([^<>]*)>", 1)
    parameters = F.when(head == "", 0).otherwise(F.size(F.split(head, ",")))
    return c.select("path", F.col("ord").alias("class_ord"), key_of(F.concat_ws(".", F.nullif("ns", F.lit("")), "name"), parameters).alias("key"), "kind", "ns", "usings", "name", "bases")


def candidates(ns: Column, usings: Column, written: Column) -> Column:
    """Keys that a written name may mean, the first declared one first."""
    said = F.regexp_replace(F.regexp_extract(written, r"^\s*(?:global\s*::\s*)?([\w.\s]+)", 1), r"\s+", "")
    first = F.regexp_extract(said, r"^\w+", 0)
    alias = F.get(F.filter(usings, lambda u: F.regexp_extract(u, r"^(\w+)\s*=", 1) == first), F.lit(0))
    said = F.when(alias.isNull(), said).otherwise(F.concat(F.regexp_replace(F.substring_index(alias, "=", -1), r"\s+", ""), F.substring(said, F.length(first) + 1, F.length(said))))
    steps = F.split(ns, r"\.")
    around = F.when(ns == "", F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.size(steps), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(steps, F.lit(1), n), ".")))
    imported = F.filter(usings, lambda u: ~u.contains("="))
    names = F.concat(F.transform(around, lambda n: F.concat(n, F.lit("."), said)), F.array(said), F.transform(imported, lambda n: F.concat(n, F.lit("."), said)))
    return F.transform(names, lambda n: key_of(n, arguments_of(written)))


def bind(contexts: DataFrame, declared: DataFrame) -> DataFrame:
    """(ns, usings, written, key, kind) of distinct written names of which one is declared."""
    distinct = contexts.select(*CONTEXT).filter("written <> ''").distinct()
    tried = distinct.select(*CONTEXT, F.posexplode(candidates(F.col("ns"), F.col("usings"), F.col("written"))).alias("nth", "key"))
    found = tried.join(declared, "key").groupBy(*CONTEXT).agg(F.min(F.struct("nth", "key", "kind")).alias("to"))
    return found.select(*CONTEXT, "to.key", "to.kind")


def closure(edges: DataFrame) -> DataFrame:
    """(key, ancestor, depth) over edges (key, base): the pairs a round finds first are the only ones the next extends.
    Depth has no bound, and cycles end because pairs found before are left out."""
    edges = graph.cut(edges.select("key", "base").distinct().filter("key <> base"))
    found = fresh = edges.select("key", F.col("base").alias("ancestor"), F.lit(1).alias("depth"))
    up = edges.select(F.col("key").alias("ancestor"), F.col("base").alias("next"))
    depth = 1
    while not fresh.isEmpty():
        depth += 1
        reached = fresh.join(up, "ancestor").select("key", F.col("next").alias("ancestor")).filter("key <> ancestor").distinct()
        fresh = graph.cut(reached.join(found, ["key", "ancestor"], "left_anti").withColumn("depth", F.lit(depth)))
        found = found.unionByName(fresh)
    return found


def types_of(syntax: DataFrame) -> Types:
    parts = graph.cut(parts_of(syntax))
    declared = parts.groupBy("key").agg(F.min_by("kind", F.struct("path", "class_ord")).alias("kind"))
    written = parts.select("key", "path", "class_ord", "ns", "usings", F.posexplode("bases").alias("at", "written"))
    named = bound(written, declared)
    label = shown(F.col("written"))
    is_interface = F.coalesce(F.col("base_kind") == "interface", label.rlike("^I[A-Z]"))
    bases = graph.cut(named.select("key", F.struct("path", "class_ord", "at").alias("nth"), "base", label.alias("shown"), is_interface.alias("is_interface")))
    itself = declared.select("key", F.col("key").alias("ancestor"), F.lit(0).alias("depth"))
    lineage = graph.cut(itself.unionByName(closure(bases.filter("base is not null"))))
    return Types(declared, parts, bases, lineage)


def bound(written: DataFrame, declared: DataFrame) -> DataFrame:
    """Rows with base and base_kind, null where nothing declared is meant."""
    found = bind(written, declared).withColumnsRenamed({"key": "base", "kind": "base_kind"})
    return written.join(found, CONTEXT, "left")


def interfaces(types: Types) -> DataFrame:
    """(class, implemented_interfaces): of a type, its ancestors and what they name, as written where they are named."""
    named = types.lineage.join(types.bases.filter("is_interface").select(F.col("key").alias("ancestor"), "shown"), "ancestor")
    return named.groupBy(F.col("key").alias("class")).agg(F.sort_array(F.collect_set("shown")).alias("implemented_interfaces"))


def base_types(types: Types) -> DataFrame:
    """(class, base_type): the first base that is no interface, in whichever part of the type it stands."""
    return types.bases.filter("not is_interface").groupBy(F.col("key").alias("class")).agg(F.min_by("shown", "nth").alias("base_type"))

"""Code chunks of members, their call dependencies, and counts of the code."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs
from ..operators import graph, numbering
from . import binding, calls

#: What kinds of members are called in a chunk.
CHUNK_KINDS = {"method": "Method", "ctor": "Constructor", "property": "Property", "operator": "Operator"}


def with_projects(syntax: DataFrame, projects: DataFrame) -> DataFrame:
    """Rows with project_name: that of the project whose folder is the longest prefix of the path; none drops the row."""
    p = projects.select(F.regexp_replace("project_path", r"/[^/]*$", "").alias("folder"), F.regexp_extract("project_path", r"([^/]*)\.[^./]*$", 1).alias("project"))
    above = syntax.select("path", F.explode(exprs.folders_of(F.col("path"))).alias("folder"))
    near = above.join(p, "folder").groupBy("path").agg(F.max_by("project", F.struct(F.length("folder"), F.col("project"))).alias("project_name"))
    return syntax.join(near, "path")


def members_of(syntax: DataFrame, types: binding.Types, branch: str = "", head_sha: str = "", project: str = "") -> DataFrame:
    """One row a method, constructor, property or operator, but for its id: all columns of a chunk, and path and member_ord."""
    source = syntax if "project_name" in syntax.columns else syntax.withColumn("project_name", F.lit(project))
    members = source.filter(~exprs.is_generated(F.col("path"))).select("path", "rel_path", "project_name", F.inline("members")).filter(F.col("kind").isin(*CHUNK_KINDS))
    owners = types.parts.select("path", "class_ord", F.col("key").alias("owner"))
    about = binding.base_types(types).join(binding.interfaces(types), "class", "full").withColumnRenamed("class", "owner")
    rows = members.join(owners, ["path", "class_ord"], "left").join(about, "owner", "left")
    owner = F.when((F.col("class_kind") == "class") & (F.col("class") != ""), F.col("class")).otherwise("NoClass")
    space = F.when(F.col("ns_block") != "", F.col("ns_block")).otherwise("NoNamespace")
    kind = F.element_at(F.create_map(*[F.lit(x) for pair in CHUNK_KINDS.items() for x in pair]), F.col("kind"))
    # Names as a compiler shows them: type, owner and name, and parameters but for properties.
    returned = F.when(F.col("kind") == "ctor", "").otherwise(F.concat(F.regexp_replace(F.regexp_replace("type_text", r"^((public|private|protected|internal|static|virtual|override|abstract|sealed|async|new|partial|extern|unsafe|readonly|required)\s+)+", ""), r"\s+", " "), F.lit(" ")))
    shown = F.concat(returned, "class", F.lit("."), "name", F.when(F.col("kind") == "property", "").otherwise(F.concat(F.lit("("), F.regexp_replace("param_text", r"\s+", " "), F.lit(")"))))
    text = F.concat(F.lit("// Namespace: "), space, F.lit(" // Class: "), owner, F.lit(" // Type: "), kind, F.lit(" "), F.col("doc"), F.lit(" "), F.col("full_text"))
    in_class = owner != "NoClass"
    none = F.array().cast("array<string>")
    return rows.select(exprs.base_name(F.col("path")).alias("file"), owner.alias("class"), F.col("name").alias("member"), kind.alias("type"), F.concat_ws(".", space, owner, shown).alias("signature"), text.alias("text"), "project_name", F.when(in_class, F.coalesce("base_type", F.lit("object"))).otherwise("").alias("base_type"), F.when(in_class, F.coalesce("implemented_interfaces", none)).otherwise(none).alias("implemented_interfaces"), F.lit(branch).alias("branch"), F.lit(head_sha).alias("head_sha"), F.col("rel_path").alias("repo_relative_path"), F.col("ord").alias("member_ord"), "params", "path")


@dataclass
class CodeGraph:
    chunks: DataFrame
    links: DataFrame  # src, dst, first
    symbols: DataFrame  # path, member_ord, id: also of methods that are called and have no chunk


def code_graph(syntax: DataFrame, branch: str = "", head_sha: str = "", project: str = "") -> CodeGraph:
    """Chunks with ids, and the calls between them. Ids go from 1 by first sight: members in the order of folder, path and
    place, each before the methods that it calls. A called method without a chunk, as in a generated file, has an id too."""
    types = binding.types_of(syntax)
    members = members_of(syntax, types, branch, head_sha, project)
    called = graph.cut(calls.resolve(syntax.filter(~exprs.is_generated(F.col("path"))), types, syntax))
    folder = F.regexp_extract(exprs.slashes(F.col("repo_relative_path")), "^(.*)/", 1)
    seen = graph.cut(members.select(folder.alias("folder"), "repo_relative_path", "path", "member_ord"))
    order = ["folder", "repo_relative_path", "path", "member_ord", "call"]
    declared = seen.select(*order[:4], F.lit(-1).alias("call"), F.col("path").alias("to_path"), F.col("member_ord").alias("to_ord"))
    named = called.join(seen, ["path", "member_ord"]).select(*order, "to_path", "to_ord")
    sights = declared.unionByName(named).groupBy("to_path", "to_ord").agg(F.min(F.struct(*order)).alias("at")).select("to_path", "to_ord", "at.*")
    ids = graph.cut(numbering.dense_ids(sights, order).select(F.col("to_path").alias("path"), F.col("to_ord").alias("member_ord"), F.col("id").cast("int").alias("id")))
    found = members.join(ids, ["path", "member_ord"]).select("id", *members.columns)
    src = ids.withColumnRenamed("id", "src")
    dst = ids.select(F.col("path").alias("to_path"), F.col("member_ord").alias("to_ord"), F.col("id").alias("dst"))
    links = called.join(src, ["path", "member_ord"]).join(dst, ["to_path", "to_ord"]).groupBy("src", "dst").agg(F.min("call").alias("first"))
    return CodeGraph(found, links, ids)


def adjacency(links: DataFrame) -> DataFrame:
    """(src, callees): distinct callees of each caller in the order of their first call."""
    return links.groupBy("src").agg(F.transform(F.sort_array(F.collect_list(F.struct("first", "dst"))), lambda x: x["dst"]).alias("callees"))


def statistics(syntax: DataFrame) -> DataFrame:
    """One row: projects, documents, classes, methods, documents of each project."""
    rows = syntax.select("project_name", "path", F.size(F.filter("classes", lambda c: c["kind"] == "class")).alias("c"), F.size(F.filter("members", lambda m: m["kind"] == "method")).alias("m"))
    per = rows.groupBy("project_name").agg(F.count("*").alias("docs"), F.sum("c").alias("c"), F.sum("m").alias("m"))
    return per.agg(F.count("*").cast("int").alias("project_count"), F.sum("docs").cast("int").alias("document_count"), F.sum("c").cast("int").alias("class_count"), F.sum("m").cast("int").alias("method_count"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("project_name", F.col("docs").cast("int"))))).alias("per_project_documents"))

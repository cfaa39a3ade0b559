"""SQL embedded in C#: hot calls and literals that look like SQL, their references, METHOD nodes and edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs, parse
from ..operators import graph


def spans(syntax: DataFrame) -> DataFrame:
    """Line spans of methods: path, ord, start_line, end_line, ns, type, method."""
    m = syntax.select("path", F.inline("members"))
    return m.filter("kind = 'method'").select("path", "ord", "start_line", "end_line", "ns", F.concat_ws(".", F.nullif("ns", F.lit("")), "class").alias("type"), F.concat_ws(".", F.nullif("ns", F.lit("")), "class", "name").alias("method"))


def hot_calls(syntax: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """path, rel_path, line, body, origin of calls with a hot name whose first argument is, or names, a literal."""
    calls = syntax.select("path", "rel_path", F.inline("invocations")).withColumn("origin", exprs.hot_origin(F.col("call_text"), extra)).filter(F.col("origin").isNotNull() & (F.size("args") > 0))
    calls = calls.select("path", "rel_path", F.col("ord").alias("call"), "member_ord", "origin", F.get("args", F.lit(0)).alias("a"))
    named = syntax.select("path", F.inline("literals")).filter("decl_name is not null").groupBy("path", F.col("member_ord").alias("m"), "decl_name").agg(F.min_by("value", "ord").alias("value"), F.min("ord").alias("first"))
    anywhere = named.groupBy("path", "decl_name").agg(F.min_by("value", "first").alias("any_value"))
    joined = calls.join(graph.shuffled(named.select(F.col("path").alias("p"), "m", "decl_name", "value")), (F.col("path") == F.col("p")) & (F.col("member_ord") == F.col("m")) & (F.col("a.ident") == F.col("decl_name")), "left").drop("p", "m", "decl_name")
    joined = joined.join(graph.shuffled(anywhere.select(F.col("path").alias("p"), "decl_name", "any_value")), (F.col("path") == F.col("p")) & (F.col("member_ord") < 0) & (F.col("a.ident") == F.col("decl_name")), "left")
    body = F.coalesce("a.literal", "value", "any_value")
    return joined.select("path", "rel_path", F.col("a.line").alias("line"), body.alias("body"), "origin", F.col("call").alias("ord")).filter(F.trim("body") != "")


def sql_literals(syntax: DataFrame, hot: DataFrame) -> DataFrame:
    """Literals that look like SQL, on lines that no hot call took."""
    texts = syntax.select("path", "rel_path", F.inline("literals")).filter(exprs.looks_like_sql(F.col("value")))
    rows = texts.select("path", "rel_path", "line", F.col("value").alias("body"), F.lit("HeuristicRoslyn").alias("origin"), F.col("ord"))
    return rows.join(graph.shuffled(hot.select("path", "line").distinct()), ["path", "line"], "left_anti").select(*hot.columns)


def snippet_targets(found: DataFrame) -> DataFrame:
    """One row a reference: executed procedures, else tables with foreign keys, else what a clause word names; none gives one generic row."""
    parsed = parse.snippet_refs(found, "body")
    pack = lambda c, kind: F.transform(c, lambda x: F.struct(F.coalesce(x["schema"], F.lit("dbo")).alias("schema"), x["name"].alias("name"), F.lit(kind).alias("kind")))
    refs = F.when(F.size("execs") > 0, pack(F.col("execs"), "PROC")).when(F.size("children") > 0, pack(F.col("children"), "TABLE")).otherwise(pack(exprs.table_refs(F.col("body")), "TABLE_OR_VIEW"))
    rows = parsed.withColumn("refs", refs).select(*found.columns, F.posexplode_outer("refs").alias("n", "ref"))
    place = F.concat(exprs.slashes(F.col("rel_path")), F.lit(":L"), F.col("line"))
    named = F.concat(F.col("ref.schema"), F.lit("."), F.col("ref.name"), F.lit("|"), F.col("ref.kind"), F.lit("|inline@"), place)
    return rows.select(*found.columns, F.coalesce("n", F.lit(0)).alias("n"), F.coalesce(named, F.concat(F.lit("inline:"), place)).alias("identifier"))


def artifacts(syntax: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """SQL facts with their namespace, type and method; where no method holds the line, the nearest one's."""
    hot = graph.cut(hot_calls(syntax, extra))
    snippets = graph.cut(hot.unionByName(sql_literals(syntax, hot)))
    places = graph.nearest_method(snippets.select("path", "line").distinct(), spans(syntax))  # a method that holds the line is at no distance from it
    held = snippet_targets(snippets).join(graph.shuffled(places), ["path", "line"], "left")
    return held.select(F.col("path").alias("source_path"), F.lit("InlineSQL").alias("artifact_kind"), "identifier", "ns", F.col("type").alias("type_full_name"), F.col("method").alias("method_full_name"), F.col("line").alias("line_number"), F.col("rel_path").alias("relative_path"), "body", F.col("origin").alias("body_origin"), "ord", "n")


def method_nodes(facts: DataFrame) -> DataFrame:
    order = graph.seq(3, F.col("source_path"), F.col("line_number"), F.col("ord"))
    rows = facts.filter("method_full_name is not null").select(F.concat(F.lit("csharp:"), "method_full_name", F.lit("|METHOD")).alias("key"), F.lit("METHOD").alias("kind"), F.col("method_full_name").alias("name"), F.lit("csharp").alias("schema"), exprs.slashes(F.col("relative_path")).alias("file"), F.lit(None).cast("int").alias("batch"), F.lit("code-inline-sql").alias("domain"), F.lit(None).cast("string").alias("body_path"), order.alias("seq"))
    return graph.upsert_nodes(rows)


def method_edges(facts: DataFrame) -> DataFrame:
    """METHOD to target, always ReadsFrom, with the file of the method's first fact."""
    rows = facts.filter("method_full_name is not null").withColumn("seq", graph.seq(3, F.col("source_path"), F.col("line_number"), F.col("ord")))
    files = rows.groupBy("method_full_name").agg(F.min_by("relative_path", "seq").alias("first_file"))
    schema, name, kind = exprs.inline_identifier(F.col("identifier"))
    rows = rows.withColumn("s", schema).withColumn("t", name).withColumn("k", kind).filter(F.col("t").isNotNull()).join(graph.shuffled(files), "method_full_name")
    return rows.select(F.concat(F.lit("csharp:"), "method_full_name", F.lit("|METHOD")).alias("from"), F.concat("s", F.lit("."), "t", F.lit("|"), "k").alias("to"), F.lit("ReadsFrom").alias("relation"), F.col("k").alias("to_kind"), exprs.slashes(F.col("first_file")).alias("file"), F.lit(None).cast("int").alias("batch"), "seq")


def foreign_key_edges(facts: DataFrame) -> DataFrame:
    """The fact's own table to every table its text names after FOREIGN KEY ... REFERENCES."""
    schema, name, _ = exprs.inline_identifier(F.col("identifier"))
    rows = facts.filter("method_full_name is not null").withColumn("s", schema).withColumn("t", name).filter(F.col("t").isNotNull())
    rows = rows.withColumn("parent", F.explode(exprs.fk_targets(F.col("body"), F.col("s"))))
    return rows.select(F.concat("s", F.lit("."), "t", F.lit("|TABLE")).alias("from"), F.concat("parent", F.lit("|TABLE")).alias("to"), F.lit("ForeignKey").alias("relation"), F.lit("TABLE").alias("to_kind"), exprs.slashes(F.col("relative_path")).alias("file"), F.lit(None).cast("int").alias("batch"), graph.seq(3, F.col("source_path"), F.col("line_number"), F.col("ord")).alias("seq"))


def bodies(facts: DataFrame) -> DataFrame:
    """One row a fact with a method: its key is the method's name, its file the whole path; an empty body has no file."""
    name = exprs.safe_name(F.col("method_full_name"))
    path = F.concat(F.lit("docs/bodies/InlineSql."), name, F.lit(".L"), F.coalesce("line_number", F.lit(0)), F.lit(".sql"))
    rows = facts.filter(F.trim("method_full_name") != "").withColumn("body", F.coalesce("body", F.lit("")))
    return rows.select(F.col("method_full_name").alias("key"), F.lit("InlineSQL").alias("kind"), F.col("method_full_name").alias("methodFullName"), F.col("body_origin").alias("bodyOrigin"), F.col("ns").alias("namespace"), F.col("type_full_name").alias("typeFullName"), F.col("relative_path").alias("relativePath"), F.col("source_path").alias("file"), F.col("line_number").alias("lineNumber"), F.when(F.col("body") != "", path).alias("bodyPath"), "body")

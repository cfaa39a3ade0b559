"""Database migrations in C#: classes, operations, graph and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs
from ..operators import graph
from .ef import classes, null_int, null_text

#: Calls recognised by their last name, with the kind of what they do.
BUILDER_CALLS = {"CreateTable": "CreateTable", "DropTable": "DropTable", "AddColumn": "TouchTable", "DropColumn": "TouchTable", "RenameColumn": "TouchTable", "AddForeignKey": "TouchTable", "DropForeignKey": "TouchTable"}
DATA_CALLS = ("InsertEntity", "InsertEntities", "UpdateEntity", "UpdateEntities", "DeleteEntity", "DeleteEntities")
GRAPH_KINDS = ("CreateTable", "DropTable", "CreateIndex", "DropIndex", "TouchTable")
OP = ["kind", "operation", "table", "schema", "index", "column", "new_column", "foreign_key", "raw"]


def migration_classes(syntax: DataFrame) -> DataFrame:
    """Classes with a base that ends in Migration or an attribute whose name has Migration in it."""
    base = F.exists("bases", lambda b: F.regexp_replace(b, r"\s+", "").rlike(r"Migration$"))
    attr = F.exists("attrs", lambda a: F.lower(a["name"]).contains("migration"))
    rows = classes(syntax).filter(base | attr)
    full = F.concat_ws(".", F.nullif("ns", F.lit("")), "name")
    return rows.select("path", "rel_path", F.col("ord").alias("class_ord"), F.col("name").alias("class_name"), F.col("ns").alias("namespace"), full.alias("type_full_name"), F.transform("attrs", lambda a: F.struct(a["name"].alias("name"), F.transform(a["args"], exprs.simple_name).alias("values"))).alias("attributes"))


def _named(name: str) -> Column:
    return exprs.simple_name(F.get(F.filter("args", lambda a: F.lower(a["name"]) == name.lower()), F.lit(0))["text"])


def _first() -> Column:
    return exprs.simple_name(F.get("args", F.lit(0))["text"])


def entity_of(text: Column) -> Column:
    """Type of new T{...}, of new T[]{...} and new[]{new T...}, or a name."""
    made = F.regexp_extract(text, r"^\s*new\s+([\w.]+)", 1)
    listed = F.regexp_extract(text, r"(?s)^\s*new\s*\[\s*\]\s*\{\s*new\s+([\w.]+)", 1)
    ident = F.regexp_extract(text, r"^\s*(\w+)\s*$", 1)
    return F.nullif(exprs.short_name(F.when(made != "", made).when(listed != "", listed).otherwise(ident)), F.lit(""))


def recognised(calls: DataFrame) -> DataFrame:
    """Calls that are migration operations, with the operation's fields. The member chain decides."""
    first, second, last = F.get("chain", F.lit(0)), F.get("chain", F.lit(1)), F.element_at("chain", -1)
    two = lambda a, b: (first == a) & (second == b)
    builder, data = last.isin(*BUILDER_CALLS), last.isin(*DATA_CALLS)
    operation = (
        F.when(two("Create", "Table"), "CreateTable").when(two("Create", "Index"), "CreateIndex").when(two("Delete", "Table"), "DropTable").when(two("Delete", "Index"), "DropIndex").when(two("Schema", "Table"), "TouchTable")
        .when(builder, last).when(data, last).when(last == "Sql", "RawSql")
    )
    fluent = (two("Create", "Table") | two("Delete", "Table") | two("Schema", "Table"))
    indexes = two("Create", "Index") | two("Delete", "Index")
    kinds = F.create_map(*[F.lit(x) for kv in BUILDER_CALLS.items() for x in kv])
    kind = F.when(fluent | indexes, F.when(two("Schema", "Table"), "TouchTable").otherwise(operation)).when(builder, F.try_element_at(kinds, last)).when(data, "DataChange").otherwise("RawSql")
    whole = builder & ~fluent & ~indexes
    table = F.when(fluent, _first()).when(whole & last.isin("CreateTable", "DropTable"), F.coalesce(_named("name"), _first())).when(whole, _named("table")).when(data & ~fluent & ~indexes, entity_of(F.get("args", F.lit(0))["text"]))
    keyed = whole & last.isin("AddForeignKey", "DropForeignKey")
    # A data call without a recognisable entity is none.
    rows = calls.withColumn("operation", operation).withColumn("table", table).filter(F.col("operation").isNotNull() & ~(data & ~fluent & ~indexes & (F.trim(F.coalesce("table", F.lit(""))) == "")))
    raw = F.when((F.col("operation") == "RawSql") & (F.size("args") > 0), F.coalesce(F.get("args", F.lit(0))["literal"], F.get("args", F.lit(0))["text"])).otherwise(F.col("raw"))
    return rows.select(
        *[c for c in calls.columns if c not in ("args", "chain", "raw")], kind.alias("kind"), "operation", "table", F.when(whole, _named("schema")).alias("schema"), F.when(indexes, _first()).alias("index"),
        F.when(whole & last.isin("AddColumn", "DropColumn", "RenameColumn"), _named("name")).alias("column"), F.when(whole & (last == "RenameColumn"), F.coalesce(_named("newName"), _named("newColumnName"))).alias("new_column"), F.when(keyed, _named("name")).alias("foreign_key"), raw.alias("raw"),
    )


def analysed(syntax: DataFrame) -> DataFrame:
    """One row a migration: names, attributes, text of the first Up, and operations of Up and Down in order."""
    found = migration_classes(syntax)
    members = syntax.select("path", F.inline("members")).filter("kind = 'method' and name in ('Up', 'Down')").select("path", "class_ord", F.col("ord").alias("member_ord"), F.col("name").alias("method"), "text")
    methods = members.join(found.select("path", "class_ord"), ["path", "class_ord"])
    calls = syntax.select("path", F.inline("invocations")).select("path", "member_ord", F.col("ord").alias("call"), "chain", "args", "raw")
    ops = recognised(calls).join(methods.select("path", "class_ord", "member_ord", "method"), ["path", "member_ord"])
    one = F.struct("call", *OP)
    listed = ops.groupBy("path", "class_ord").agg(F.sort_array(F.collect_list(F.when(F.col("method") == "Up", one))).alias("up_operations"), F.sort_array(F.collect_list(F.when(F.col("method") == "Down", one))).alias("down_operations"))
    up = methods.filter("method = 'Up'").groupBy("path", "class_ord").agg(F.min_by("text", "member_ord").alias("up_body"))
    return found.join(up, ["path", "class_ord"], "left").join(listed, ["path", "class_ord"], "left")


def operations(migrations: DataFrame) -> DataFrame:
    """One row an operation of Up."""
    return migrations.select("path", "rel_path", "class_ord", "class_name", "type_full_name", F.inline("up_operations"))


def _key(name: Column) -> Column:
    return F.concat(F.lit("csharp:"), name, F.lit("|MIGRATION"))


def migration_graph(migrations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """MIGRATION nodes; SchemaChange edges to dbo.<table>, whatever schema is named; keys of AddForeignKey, dependent to principal."""
    name = F.coalesce(F.nullif("type_full_name", F.lit("")), "class_name")
    file = exprs.slashes(F.col("rel_path")).alias("file")
    body = F.concat(F.lit("docs/bodies/Migration."), exprs.safe_name(name), F.lit(".MIGRATION.cs"))
    nodes = migrations.select(_key(name).alias("key"), F.lit("MIGRATION").alias("kind"), F.col("class_name").alias("name"), F.lit("csharp").alias("schema"), file, null_int().alias("batch"), F.lit("code").alias("domain"), body.alias("body_path"), graph.seq(2, F.col("path"), F.lit(0), F.col("class_ord")).alias("seq"))
    ops = operations(migrations).filter(F.col("kind").isin(*GRAPH_KINDS) & (F.trim("table") != ""))
    table = F.concat(F.lit("dbo."), "table", F.lit("|TABLE"))
    order = graph.seq(2, F.col("path"), F.col("class_ord"), F.col("call")).alias("seq")
    changes = ops.select(_key(name).alias("from"), table.alias("to"), F.lit("SchemaChange").alias("relation"), F.lit("TABLE").alias("to_kind"), file, null_int().alias("batch"), order)
    keys = ops.filter("operation = 'AddForeignKey'").withColumn("principal", exprs.principal_table(F.col("raw"))).filter("principal is not null")
    links = keys.select(table.alias("from"), F.concat(F.lit("dbo."), "principal", F.lit("|TABLE")).alias("to"), F.lit("ForeignKey").alias("relation"), F.lit("TABLE").alias("to_kind"), file, null_int().alias("batch"), order)
    return nodes, changes.unionByName(links)


def fallback(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """By patterns alone (fixed values), for when no migration was recognised anywhere: each class named ...Migration of a file with each table of the file."""
    rows = files.select("path", "rel_path", F.regexp_extract_all("text", F.lit(r"class\s+(\w*Migration)\b"), 1).alias("names"), F.array_union(F.regexp_extract_all("text", F.lit(r"Schema\.Table\(\s*nameof\(\s*(\w+)\s*\)\s*\)"), 1), F.regexp_extract_all("text", F.lit(r'Schema\.Table\(\s*"([^"]+)"\s*\)'), 1)).alias("tables"))
    file = exprs.slashes(F.col("rel_path")).alias("file")
    named = rows.select("path", file, "tables", F.posexplode("names").alias("n", "class_name"))
    order = graph.seq(2, F.col("path"), F.lit(0), F.col("n")).alias("seq")
    nodes = named.select(_key(F.col("class_name")).alias("key"), F.lit("MIGRATION").alias("kind"), F.col("class_name").alias("name"), F.lit("csharp").alias("schema"), "file", null_int().alias("batch"), F.lit("code").alias("domain"), null_text().alias("body_path"), order)
    pairs = named.select("path", "file", "n", "class_name", F.explode("tables").alias("table")).groupBy("path", "file", "n", "class_name", F.lower("table").alias("__t")).agg(F.min("table").alias("table"))
    edges = pairs.select(_key(F.col("class_name")).alias("from"), F.concat(F.lit("dbo."), "table", F.lit("|TABLE")).alias("to"), F.lit("SchemaChange").alias("relation"), F.lit("TABLE").alias("to_kind"), "file", null_int().alias("batch"), order)
    return nodes, edges


def summaries(migrations: DataFrame) -> DataFrame:
    """One body row a migration with seven arrays of what its Up does; tables carry their schema here."""
    ops = F.coalesce("up_operations", F.array().cast(migrations.schema["up_operations"].dataType))
    table = lambda o: exprs.canonical_table(o["schema"], o["table"])
    filled = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))

    def has(o, name, *need):
        test = (o["operation"] == name) & filled(o["table"])
        for n in need:
            test = test & filled(o[n])
        return test

    pick = lambda name, make, *need: F.transform(F.filter(ops, lambda o: has(o, name, *need)), make)
    column = lambda o: F.struct(table(o).alias("table"), o["column"].alias("column"))
    key = lambda o: F.struct(table(o).alias("table"), o["foreign_key"].alias("foreignKey"))
    name = F.coalesce(F.nullif("type_full_name", F.lit("")), "class_name")
    return migrations.select(
        _key(name).alias("key"), F.lit("MIGRATION").alias("kind"), F.col("class_name").alias("name"), "namespace", F.col("type_full_name").alias("typeFullName"), F.col("path").alias("file"), F.concat(F.lit("docs/bodies/Migration."), exprs.safe_name(name), F.lit(".MIGRATION.cs")).alias("bodyPath"),
        pick("CreateTable", table).alias("createsTables"), pick("DropTable", table).alias("dropsTables"), pick("AddColumn", column, "column").alias("addsColumns"), pick("DropColumn", column, "column").alias("dropsColumns"),
        pick("RenameColumn", lambda o: F.struct(table(o).alias("table"), o["column"].alias("from"), o["new_column"].alias("to")), "column", "new_column").alias("renamesColumns"), pick("AddForeignKey", key, "foreign_key").alias("addsForeignKeys"), pick("DropForeignKey", key, "foreign_key").alias("dropsForeignKeys"), F.col("up_body").alias("body"),
    )

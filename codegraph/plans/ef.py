"""Entity models: entity to table map, DBSET and ENTITY nodes, fluent foreign keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs
from ..operators import graph


def null_int() -> Column:
    return F.lit(None).cast("int")


def null_text() -> Column:
    return F.lit(None).cast("string")


def classes(syntax: DataFrame) -> DataFrame:
    return syntax.select("path", "rel_path", F.inline("classes").alias("ord", "class_kind", "name", "ns", "ns_block", "bases", "attrs", "start", "end", "text")).filter("class_kind = 'class'")


def _quoted(text: Column) -> Column:
    return F.regexp_extract(text, r'(?s)^\s*@?"(.*)"\s*$', 1)


def table_attribute(attrs: Column) -> tuple[Column, Column, Column]:
    """(present, schema, name) of a [Table("Name", Schema = "S")] attribute."""
    is_table = lambda a: a["name"].rlike(r"(^|\.)Table(Attribute)?$")
    args = F.get(F.filter(attrs, is_table), F.lit(0))["args"]
    name = F.get(F.filter(F.transform(args, _quoted), lambda x: x != ""), F.lit(0))
    schema = F.get(F.filter(F.transform(args, lambda a: F.regexp_extract(a, r'(?s)^\s*Schema\s*=\s*@?"(.*)"\s*$', 1)), lambda x: x != ""), F.lit(0))
    return F.exists(attrs, is_table), F.coalesce(schema, F.lit("dbo")), name


def entity_map(syntax: DataFrame) -> DataFrame:
    """(entity, schema, table), the last mapping of each entity without case: [Table] attributes, and Entity(typeof(T) or "T").ToTable(...)."""
    present, schema, name = table_attribute(F.col("attrs"))
    by_attr = classes(syntax).filter(present).select(F.concat_ws(".", F.nullif("ns_block", F.lit("")), "name").alias("entity"), schema.alias("schema"), name.alias("table"), F.struct(F.lit(0).alias("kind"), "path", F.col("ord").alias("n")).alias("at")).filter("table is not null")
    calls = syntax.select("path", F.inline("invocations"))
    target = F.get("args", F.lit(0))
    entities = calls.filter((F.col("name") == "Entity") & (F.size("args") == 1)).select("path", "first_at", "at", F.coalesce(F.nullif(F.regexp_extract(target["text"], r"^\s*typeof\s*\(\s*([\w.]+)\s*\)\s*$", 1), F.lit("")), target["literal"]).alias("entity")).filter("entity is not null")
    tables = calls.filter("name = 'ToTable'").select(F.col("path").alias("p"), F.col("first_at").alias("f"), F.col("at").alias("t"), target["literal"].alias("table"), F.coalesce(F.get("args", F.lit(1))["literal"], F.lit("dbo")).alias("schema")).filter("table is not null")
    by_call = entities.join(tables, (F.col("path") == F.col("p")) & (F.col("first_at") == F.col("f")) & (F.col("at") < F.col("t"))).groupBy("path", "t", "table", "schema").agg(F.max_by("entity", "at").alias("entity")).select("entity", "schema", "table", F.struct(F.lit(1).alias("kind"), "path", F.col("t").alias("n")).alias("at"))
    return by_attr.unionByName(by_call).groupBy(F.lower("entity").alias("__e")).agg(F.max_by(F.struct("entity", "schema", "table"), "at").alias("m"), F.min("at").alias("at")).select("m.entity", "m.schema", "m.table", "at")


def _best(rows: DataFrame, mapping: DataFrame, entity: str, rules) -> DataFrame:
    """Rows with __m, the mapping that the first of some rules gives: (priority, left key, right key) equalities."""
    m = mapping.select(F.struct("schema", "table").alias("m"), "at", F.lower("entity").alias("e"))
    sides = [m.select(rule(F.col("e")).alias("k"), F.lit(p).alias("p"), "m", "at") for p, _, rule in rules]
    right = sides[0]
    for s in sides[1:]:
        right = right.unionByName(s)
    asked = rows.select(entity).distinct()
    left = None
    for p, key, _ in rules:
        one = asked.select(F.col(entity), key(F.lower(entity)).alias("k"), F.lit(p).alias("p"))
        left = one if left is None else left.unionByName(one)
    best = left.join(right, ["k", "p"]).groupBy(F.col(entity).alias("__entity")).agg(F.min_by("m", F.struct("p", "at")).alias("__m"))
    return rows.join(best, F.col(entity) == F.col("__entity"), "left").drop("__entity")


def _last(c: Column) -> Column:
    return F.substring_index(c, ".", -1)


def dbsets(syntax: DataFrame) -> DataFrame:
    """Properties whose type has DbSet<: class, property, entity."""
    p = syntax.select("path", "rel_path", F.inline("members")).filter("kind = 'property'").filter(F.col("type_text").contains("DbSet<"))
    return p.select("path", "rel_path", "ord", "class", F.col("name").alias("property"), F.trim(F.get(F.split("type_text", "[<>]"), F.lit(1))).alias("entity"))


def dbset_graph(syntax: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """DBSET nodes and their MapsTo edges; the table node isn't made here."""
    rows = _best(dbsets(syntax), mapping, "entity", [(1, lambda e: e, lambda e: e), (2, _last, lambda e: e), (3, _last, _last)])
    key = F.concat(F.lit("csharp:"), "class", F.lit("."), "property", F.lit("|DBSET"))
    order = graph.seq(1, F.col("path"), F.lit(0), F.col("ord")).alias("seq")
    file = exprs.slashes(F.col("rel_path")).alias("file")
    nodes = rows.select(key.alias("key"), F.lit("DBSET").alias("kind"), F.col("property").alias("name"), F.lit("csharp").alias("schema"), file, null_int().alias("batch"), F.lit("code").alias("domain"), null_text().alias("body_path"), order)
    table = F.concat(F.coalesce("__m.schema", F.lit("dbo")), F.lit("."), F.coalesce("__m.table", _last(F.col("entity"))), F.lit("|TABLE"))
    edges = rows.select(key.alias("from"), table.alias("to"), F.lit("MapsTo").alias("relation"), F.lit("TABLE").alias("to_kind"), file, null_int().alias("batch"), order)
    return nodes, edges


def entity_classes(syntax: DataFrame, base_types: Sequence[str] = ()) -> DataFrame:
    """Classes that a DbSet names or whose first base is a configured entity base; from_dbset tells which."""
    names = dbsets(syntax).select(F.lower(_last(F.col("entity"))).alias("n")).distinct()
    rows = classes(syntax).join(names, F.lower("name") == F.col("n"), "left").withColumn("from_dbset", F.col("n").isNotNull()).drop("n")
    base = F.regexp_replace(F.get("bases", F.lit(0)), r"\s+", "")
    wanted = [b.strip() for b in base_types if b and b.strip()]
    listed = F.array(*map(F.lit, wanted)).cast("array<string>")
    derived = F.exists(listed, lambda b: (base == b) | (base == _last(b)) | (_last(base) == _last(b)))
    return rows.filter(F.col("from_dbset") | F.coalesce(derived, F.lit(False)))


def entity_graph(syntax: DataFrame, mapping: DataFrame, tables: DataFrame, base_types: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """ENTITY nodes with the tables they map to, MapsTo edges, and entity bodies, whose file is the whole path.

    `tables`: TABLE nodes of the scripts (name, schema, seq). A class maps to its own mapping, one of a like name, its
    [Table] attribute, a table of its name give or take an s, or, from a DbSet, dbo and its own name.
    """
    rows = entity_classes(syntax, base_types)
    rows = _best(rows, mapping, "name", [(1, lambda e: e, lambda e: e), (2, lambda e: e, _last), (3, lambda e: F.concat(e, F.lit("s")), lambda e: e), (4, lambda e: e, lambda e: F.concat(e, F.lit("s")))])
    by_name = tables.select(F.col("name").alias("entity"), "schema", F.col("name").alias("table"), F.col("seq").alias("at"))
    rows = _best(rows.withColumnRenamed("__m", "__map"), by_name, "name", [(1, lambda e: e, lambda e: e), (2, lambda e: F.concat(e, F.lit("s")), lambda e: e), (3, lambda e: e, lambda e: F.concat(e, F.lit("s")))])
    present, schema, name = table_attribute(F.col("attrs"))
    own = F.struct(schema.alias("schema"), F.coalesce(name, F.col("name")).alias("table"))
    convention = F.struct(F.lit("dbo").alias("schema"), F.col("name").alias("table"))
    rows = rows.withColumn("to", F.when(F.col("__map").isNotNull(), F.col("__map")).when(present, own).when(F.col("__m").isNotNull(), F.col("__m")).when(F.col("from_dbset"), convention))
    key = F.concat(F.lit("csharp:"), "name", F.lit("|ENTITY"))
    body_path = F.concat(F.lit("docs/bodies/Poco."), exprs.safe_name(F.concat_ws(".", F.nullif("ns", F.lit("")), "name")), F.lit(".ENTITY.cs"))
    order, file = graph.seq(1, F.col("path"), F.lit(1), F.col("ord")).alias("seq"), exprs.slashes(F.col("rel_path")).alias("file")
    nodes = rows.select(key.alias("key"), F.lit("ENTITY").alias("kind"), "name", F.lit("csharp").alias("schema"), file, null_int().alias("batch"), F.lit("code").alias("domain"), body_path.alias("body_path"), order)
    mapped = rows.filter("to is not null")
    target = F.concat("to.schema", F.lit("."), "to.table", F.lit("|TABLE"))
    made = mapped.select(target.alias("key"), F.lit("TABLE").alias("kind"), F.col("to.table").alias("name"), F.col("to.schema").alias("schema"), file, null_int().alias("batch"), F.lit("ef").alias("domain"), null_text().alias("body_path"), order)
    edges = mapped.select(key.alias("from"), target.alias("to"), F.lit("MapsTo").alias("relation"), F.lit("TABLE").alias("to_kind"), file, null_int().alias("batch"), order)
    first = graph.first_by(rows.select(key.alias("key"), "name", "ns", "text", body_path.alias("bodyPath"), F.col("path").alias("file"), order), [F.lower("key")])
    body_rows = first.select("key", F.lit("ENTITY").alias("kind"), "name", F.col("ns").alias("namespace"), F.concat_ws(".", F.nullif("ns", F.lit("")), "name").alias("typeFullName"), "file", "bodyPath", F.col("text").alias("body"))
    return nodes.unionByName(made), edges, body_rows


def fluent_keys(syntax: DataFrame) -> DataFrame:
    """(path, related, entity, has_one, at) of ...Entity<T>()...HasOne or HasMany(...)...HasForeignKey(...)."""
    calls = syntax.select("path", "rel_path", F.inline("invocations"))
    c = calls.select("path", "rel_path", "first_at", "at", "name", F.trim("targ").alias("targ"), F.get("args", F.lit(0))["text"].alias("arg"))
    keys = c.filter("name = 'HasForeignKey'").select("path", "rel_path", "first_at", F.col("at").alias("key_at"))
    navs = c.filter("name in ('HasOne', 'HasMany')").select("path", "first_at", F.col("at").alias("nav_at"), "name", "targ", "arg")
    roots = c.filter("name = 'Entity' and targ is not null and targ not like '%,%'").select("path", "first_at", F.col("at").alias("root_at"), F.col("targ").alias("entity"))
    nav = keys.join(navs, ["path", "first_at"]).filter("nav_at < key_at").groupBy("path", "rel_path", "first_at", "key_at").agg(F.max_by(F.struct("nav_at", "name", "targ", "arg"), "nav_at").alias("n"))
    whole = nav.join(roots, ["path", "first_at"]).filter("root_at < n.nav_at").groupBy("path", "rel_path", "key_at", "n").agg(F.max_by("entity", "root_at").alias("entity"))
    member = F.regexp_extract("n.arg", r"^\s*\w+\s*=>\s*(?:[\w.]+\.)?(\w+)!?\s*$", 1)
    related = F.coalesce(F.nullif("n.targ", F.lit("")), F.nullif(member, F.lit("")))
    return whole.select("path", "rel_path", F.col("key_at").alias("at"), "entity", related.alias("related"), (F.col("n.name") == "HasOne").alias("has_one")).filter("related is not null")


def fluent_graph(syntax: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """TABLE nodes and ForeignKey edges, child to parent."""
    rules = [(1, lambda e: e, lambda e: e), (2, _last, lambda e: e)]
    rows = _best(fluent_keys(syntax), mapping, "entity", rules).withColumnRenamed("__m", "e")
    rows = _best(rows, mapping, "related", rules).withColumnRenamed("__m", "r")
    table = lambda m, n: F.struct(F.coalesce(f"{m}.schema", F.lit("dbo")).alias("schema"), F.coalesce(f"{m}.table", _last(F.col(n))).alias("name"))
    rows = rows.withColumn("et", table("e", "entity")).withColumn("rt", table("r", "related"))
    child, parent = F.when(F.col("has_one"), F.col("et")).otherwise(F.col("rt")), F.when(F.col("has_one"), F.col("rt")).otherwise(F.col("et"))
    rows = rows.withColumn("c", child).withColumn("p", parent)
    key = lambda t: F.concat(f"{t}.schema", F.lit("."), f"{t}.name", F.lit("|TABLE"))
    order, file = graph.seq(1, F.col("path"), F.lit(2), F.col("at")).alias("seq"), exprs.slashes(F.col("rel_path")).alias("file")
    edges = rows.select(key("c").alias("from"), key("p").alias("to"), F.lit("ForeignKey").alias("relation"), F.lit("TABLE").alias("to_kind"), file, null_int().alias("batch"), order)
    node = lambda t: rows.select(key(t).alias("key"), F.lit("TABLE").alias("kind"), F.col(f"{t}.name").alias("name"), F.col(f"{t}.schema").alias("schema"), file, null_int().alias("batch"), F.lit("ef").alias("domain"), null_text().alias("body_path"), order)
    return node("c").unionByName(node("p")), edges

"""Column expressions: keys, names, paths, predicates and pattern matches. All run inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names of calls that take SQL, words of the SQL test, extensions a scan keeps, kinds with a body,
#: folders that scans leave out.
HOT_METHODS = ("SqlQuery", "ExecuteSql", "FromSql")
SQL_VERBS = ("SELECT", "INSERT", "UPDATE", "DELETE", "MERGE", "EXEC")
SQL_CONTEXT = ("FROM ", " INTO ", " WHERE ", " JOIN ", " TABLE ")
EXTENSIONS = (".cs", ".csx", ".xaml", ".axaml", ".json", ".md", ".sql", ".tt", ".editorconfig", ".props", ".targets")
BODY_KINDS = ("PROC", "FUNC", "VIEW", "TRIGGER", "TABLE", "SEQUENCE", "TYPE")
SQL_SKIP = ("change scripts", "changescripts", "initial data", "initialdata", "snapshots", "tools", ".git", ".vs", "bin", "obj")
CS_SKIP = (".git", ".svn", ".hg", "bin", "obj", "packages")
TEST_SEGMENTS = ("test", "tests", "example", "examples", "sample", "samples", "dev", "client", "tools", "bin", "obj")
SQLCMD = r"(?im)^[^\S\n]*:(r|setvar|connect|on[^\S\n]+error[^\S\n]+exit)\b[^\n]*\n?"
#: Fixed patterns: a table after a clause word; the table after FOREIGN KEY ... REFERENCES.
TABLE_REF = r"(?i)\b(?:FROM|JOIN|INTO|UPDATE|MERGE|DELETE\s+FROM)\s+(?:(\[[^\]]+\]|\w+)\.)?(\[[^\]]+\]|\w+)"
FK_TARGET = r"(?is)\bFOREIGN\s+KEY\b[^;]*?\bREFERENCES\b\s+((?:\[[^\]]+\]|[A-Za-z_][A-Za-z0-9_]*)(?:\s*\.\s*(?:\[[^\]]+\]|[A-Za-z_][A-Za-z0-9_]*))?)"


def _any(tests: Sequence[Column]) -> Column:
    out = F.lit(False)
    for t in tests:
        out = out | t
    return out


def looks_like_sql(text: Column) -> Column:
    """A literal that is SQL: a verb with a context word, or table DDL with a foreign key; 12 characters at least."""
    flat = F.upper(F.regexp_replace(text, r"\s+", " "))
    verb, context = _any([flat.contains(w) for w in SQL_VERBS]), _any([flat.contains(w) for w in SQL_CONTEXT])
    ddl = (flat.contains("CREATE TABLE") | flat.contains("ALTER TABLE")) & flat.contains("FOREIGN KEY") & flat.contains(" REFERENCES ")
    return F.coalesce((F.trim(text) != "") & (F.length(flat) >= 12) & ((verb & context) | ddl), F.lit(False))


def hot_origin(call_text: Column, extra: Sequence[str] = ()) -> Column:
    """ExtraHotMethod or HotMethod where the call's text holds such a name, else null."""
    extras = [e for e in extra if e and e.strip()]
    return F.when(_any([call_text.contains(e) for e in extras]), "ExtraHotMethod").when(_any([call_text.contains(h) for h in HOT_METHODS]), "HotMethod")


def unwrap(part: Column) -> Column:
    """A name without brackets or quotes."""
    return F.regexp_replace(F.trim(part), r'^[\[\"`]+|[\]\"`]+$', "")


def table_refs(body: Column) -> Column:
    """array<struct<schema,name>> of what follows FROM, JOIN, INTO, UPDATE, MERGE and DELETE FROM."""
    found = F.arrays_zip(F.regexp_extract_all(body, F.lit(TABLE_REF), 1).alias("s"), F.regexp_extract_all(body, F.lit(TABLE_REF), 2).alias("n"))
    return F.transform(found, lambda x: F.struct(F.when(x["s"] == "", "dbo").otherwise(unwrap(x["s"])).alias("schema"), unwrap(x["n"]).alias("name")))


def fk_targets(body: Column, schema: Column | None = None) -> Column:
    """array<string> schema.table of each FOREIGN KEY ... REFERENCES, behind a cheap guard; `schema` where none is named."""
    default = F.coalesce(F.nullif(F.trim(schema), F.lit("")), F.lit("dbo")) if schema is not None else F.lit("dbo")
    whole = F.transform(F.regexp_extract_all(body, F.lit(FK_TARGET), 1), lambda x: F.transform(F.split(x, r"\s*\.\s*"), unwrap))
    named = F.transform(whole, lambda p: F.when(F.size(p) > 1, F.concat_ws(".", p[0], p[1])).otherwise(F.concat(default, F.lit("."), p[0])))
    guard = F.upper(body).contains("FOREIGN KEY") & F.upper(body).contains("REFERENCES")
    return F.when(guard, named).otherwise(F.array().cast("array<string>"))


def sqlcmd_preprocess(text: Column) -> Column:
    """Without sqlcmd directive lines; $(Variable) as 0."""
    return F.regexp_replace(F.regexp_replace(text, SQLCMD, ""), r"\$\([^)]+\)", "0")


def object_key(schema: Column, name: Column, kind: Column, db: Column | None = None) -> Column:
    base = F.concat_ws(".", *([db] if db is not None else []), F.coalesce(F.nullif(schema, F.lit("")), F.lit("dbo")), F.coalesce(F.nullif(name, F.lit("")), F.lit("(anon)")))
    return F.concat(base, F.lit("|"), F.coalesce(kind, F.lit("UNKNOWN")))


def key_name(key: Column) -> Column:
    """Part before the last bar."""
    return F.when(F.instr(key, "|") > 0, F.regexp_extract(key, r"(?s)^(.*)\|", 1)).otherwise(key)


def key_kind(key: Column) -> Column:
    return F.when(F.instr(key, "|") > 0, F.substring_index(key, "|", -1)).otherwise(F.lit("UNKNOWN"))


def schema_and_name(base: Column) -> tuple[Column, Column]:
    """Of a dotted name: the middle and last of three parts, both of two, else dbo and the last."""
    p = F.split(base, r"\.")
    n = F.size(p)
    schema = F.when(n == 3, F.get(p, F.lit(1))).when(n == 2, F.get(p, F.lit(0))).otherwise(F.lit("dbo"))
    return schema, F.when(n == 3, F.get(p, F.lit(2))).when(n == 2, F.get(p, F.lit(1))).otherwise(F.element_at(p, -1))


def table_key_parts(key: Column) -> tuple[Column, Column]:
    """Schema before the first dot, name the rest."""
    base = key_name(key)
    dotted = F.instr(base, ".") > 0
    return F.when(dotted, F.substring_index(base, ".", 1)).otherwise(F.lit("dbo")), F.when(dotted, F.regexp_extract(base, r"(?s)^[^.]*\.(.*)$", 1)).otherwise(base)


def inline_identifier(identifier: Column) -> tuple[Column, Column, Column]:
    """(schema, name, kind) of schema.name|KIND|inline@...; null where it isn't one."""
    p = F.split(identifier, r"\|")
    base = F.get(p, F.lit(0))
    dot = F.instr(base, ".")
    good = (F.size(p) >= 3) & (dot > 1) & (dot < F.length(base))
    kind = F.get(p, F.lit(1))
    return F.when(good, F.substring_index(base, ".", 1)), F.when(good, F.regexp_extract(base, r"^[^.]*\.(.*)$", 1)), F.when(good, F.when(F.trim(kind) == "", "TABLE_OR_VIEW").otherwise(kind))


def canonical_table(schema: Column, table: Column) -> Column:
    return F.when(table.contains("."), table).otherwise(F.concat(F.coalesce(F.nullif(F.trim(schema), F.lit("")), F.lit("dbo")), F.lit("."), table))


def safe_name(name: Column) -> Column:
    """Letters, digits, dots and underscores; others as underscores."""
    return F.regexp_replace(name, r"[^\p{L}\p{Nd}._]", "_")


def csv_quote(value: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(F.coalesce(value.cast("string"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))


def slashes(path: Column) -> Column:
    return F.replace(path, F.lit("\\"), F.lit("/"))


def relative_to(path: Column, root: str) -> Column:
    root = root.rstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(root)), F.substring(path, len(root) + 1, 1 << 30)).otherwise(path)


def domain_of(rel_path: Column) -> Column:
    """First folder below the root, else empty."""
    p = F.split(slashes(rel_path), "/")
    return F.when(F.size(p) > 1, F.get(p, F.lit(0))).otherwise(F.lit(""))


def folders_of(path: Column) -> Column:
    """All folders above a path, without their last slash; to join paths with folders by equality."""
    p = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(p) - 1, F.lit(1))), lambda n: F.array_join(F.slice(p, 1, n), "/"))


def base_name(path: Column) -> Column:
    return F.substring_index(slashes(path), "/", -1)


def extension(path: Column) -> Column:
    """From the last dot of the file name, which may be its first character."""
    return F.lower(F.regexp_extract(base_name(path), r"(\.[^.]*)$", 1))


def in_folder(rel_path: Column, names: Sequence[str]) -> Column:
    """Whether a folder of the path, ignoring case, is among names; the file's own name doesn't count."""
    p = F.split(F.lower(slashes(rel_path)), "/")
    return F.arrays_overlap(F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0))), F.array(*map(F.lit, names)))


def is_generated(path: Column) -> Column:
    """Build output (the folder name between backslashes only) and generated files."""
    low = F.lower(path)
    return F.contains(low, F.lit("\\obj\\")) | F.endswith(low, F.lit(".g.cs")) | F.endswith(low, F.lit(".designer.cs"))


def is_prepost(path: Column) -> Column:
    return F.lower(base_name(path)).isin("predeployment.sql", "postdeployment.sql")


def short_name(type_name: Column) -> Column:
    return F.substring_index(type_name, ".", -1)


def principal_table(raw: Column) -> Column:
    """First quoted text after principalTable, else null."""
    return F.nullif(F.regexp_extract(raw, r'(?s)principalTable[^"]*"([^"]+)"', 1), F.lit(""))


def branch_file_name(branch: Column) -> Column:
    clean = F.regexp_replace(F.trim(F.regexp_replace(branch, r'[/\\<>:"|?*\x00-\x1f]', "_")), r"\.+$", "")
    return F.when(clean == "", "artifacts").otherwise(clean)


def simple_name(text: Column) -> Column:
    """What a name argument says: its literal, the last part of nameof(...), else the expression's text."""
    inner = F.regexp_extract(text, r"^\s*nameof\s*\(\s*(.*?)\s*\)\s*$", 1)
    quoted = F.regexp_extract(text, r'(?s)^\s*@?"(.*)"\s*$', 1)
    return F.when(F.rlike(text, F.lit(r'(?s)^\s*@?".*"\s*$')), quoted).when(inner != "", F.substring_index(inner, ".", -1)).otherwise(F.nullif(F.trim(text), F.lit("")))

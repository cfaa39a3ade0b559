"""Arrow-batched parsing: one row a file in, one row of nested rows out, and the same as SQL-callable table functions."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from . import exprs, lex_csharp, lex_tsql

CLASS = "struct<ord:int,kind:string,name:string,ns:string,ns_block:string,bases:array<string>,attrs:array<struct<name:string,args:array<string>>>,start:int,end:int,text:string>"
MEMBER = "struct<ord:int,kind:string,name:string,class_ord:int,class:string,class_kind:string,ns:string,ns_block:string,type_text:string,params:int,param_text:string,start_line:int,end_line:int,doc:string,text:string,full_text:string,accessors:boolean>"
ARG = "struct<name:string,text:string,literal:string,ident:string,line:int>"
INVOCATION = f"struct<ord:int,call_text:string,name:string,targ:string,chain:array<string>,raw:string,line:int,member_ord:int,class_ord:int,at:int,first_at:int,end_at:int,args:array<{ARG}>>"
LITERAL = "struct<ord:int,value:string,line:int,decl_name:string,member_ord:int>"
SYNTAX = f"path string, rel_path string, classes array<{CLASS}>, members array<{MEMBER}>, invocations array<{INVOCATION}>, literals array<{LITERAL}>, error string, usings array<string>"
DEFINE = "struct<ord:int,db:string,schema:string,name:string,kind:string,text:string>"
REF = "struct<ord:int,db:string,schema:string,name:string,kind:string,relation:string>"
NAME = "struct<db:string,schema:string,name:string,kind:string>"
SQL_BATCHES = f"path string, rel_path string, domain string, is_prepost boolean, batch int, text string, defines array<{DEFINE}>, alters array<{NAME}>, refs array<{REF}>, fk_children array<{NAME}>, error string"
FILES_A_CHUNK = 64
#: Namespaces and aliases that a file imports.
USING = r"(?m)(?:^|(?<=[;{]))[ \t]*(?:global[ \t]+)?using[ \t]+(?!static\b)((?:\w+[ \t]*=[ \t]*)?[\w.]+)[ \t]*;"


def arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def record_batches(rows, schema: pa.Schema):
    """Record batches of a few rows, so that a worker never holds many parsed files."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= FILES_A_CHUNK:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def csharp_row(text: str | None) -> dict:
    """What one C# text declares, calls and quotes; an error is told, not raised, and leaves the texts between quotes, line by line."""
    try:
        f = lex_csharp.recognise(text or "")
        return {"classes": f.classes, "members": f.members, "invocations": f.invocations, "literals": f.literals, "error": None}
    except Exception as e:  # a file that can't be read must not end the job
        quoted = [(n, v) for n, line in enumerate((text or "").split("\n"), 1) for v in re.findall(r'"([^"]*)"', line)]
        literals = [{"ord": k, "value": v, "line": n, "decl_name": None, "member_ord": -1} for k, (n, v) in enumerate(quoted)]
        return {"classes": [], "members": [], "invocations": [], "literals": literals, "error": f"{type(e).__name__}: {e}"[:300]}


def tsql_rows(text: str | None) -> list[dict]:
    try:
        batches = lex_tsql.recognise(text or "")
    except Exception as e:  # as above
        return [{"batch": 0, "text": text, "defines": [], "alters": [], "refs": [], "fk_children": [], "error": f"{type(e).__name__}: {e}"[:300]}]
    number = lambda rows: [{"ord": k} | r for k, r in enumerate(rows)]
    return [{"batch": b.index, "text": b.text, "defines": number(b.defines), "alters": b.alters, "refs": number(b.refs), "fk_children": [{"kind": "TABLE"} | c for c in b.fk_children], "error": None} for b in batches]


def parse_csharp(files: DataFrame) -> DataFrame:
    """(path, rel_path, text) to one syntax row a file; every later stage reads these rows, none parses again."""

    schema = arrow(SYNTAX)  # on the driver; workers have no session to read types with

    def run(batches):
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("path", "rel_path", "text", "usings")]
            yield from record_batches(({"path": p, "rel_path": r, "usings": u} | csharp_row(t) for p, r, t, u in zip(*cols, strict=True)), schema)

    usings = F.coalesce(F.regexp_extract_all("text", F.lit(USING), 1), F.array().cast("array<string>"))
    return files.select("path", "rel_path", "text", usings.alias("usings")).mapInArrow(run, SYNTAX)


def parse_tsql(files: DataFrame) -> DataFrame:
    """(path, rel_path, text) to one row a batch, after sqlcmd directives are taken out."""
    ready = files.select("path", "rel_path", exprs.domain_of(F.col("rel_path")).alias("domain"), exprs.is_prepost(F.col("path")).alias("is_prepost"), exprs.sqlcmd_preprocess(F.col("text")).alias("text"))

    schema = arrow(SQL_BATCHES)

    def run(batches):
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("path", "rel_path", "domain", "is_prepost", "text")]
            yield from record_batches(({"path": p, "rel_path": r, "domain": d, "is_prepost": x} | b for p, r, d, x, t in zip(*cols, strict=True) for b in tsql_rows(t)), schema)

    return ready.mapInArrow(run, SQL_BATCHES)


SNIPPET = f"execs array<{NAME}>, children array<{NAME}>"


def snippet_refs(rows: DataFrame, body: str) -> DataFrame:
    """All columns, and the procedures executed and the tables with foreign keys in a SQL text.

    Only texts with EXEC or TABLE in them go to Python.
    """
    needs = F.upper(F.col(body)).rlike(r"\bEXEC(UTE)?\b|\b(CREATE|ALTER)\s+TABLE\b")
    schema = StructType([*rows.schema.fields, *StructType.fromDDL(SNIPPET).fields])
    names, kinds = rows.columns, arrow(SNIPPET)

    def run(batches):
        for batch in batches:
            found = []
            for text in batch.column(names.index(body)).to_pylist():
                parsed = tsql_rows(text)
                found.append({"execs": [{k: r[k] for k in ("db", "schema", "name", "kind")} for b in parsed for r in b["refs"] if r["relation"] == "Executes"], "children": [c for b in parsed for c in b["fk_children"]]})
            extra = pa.RecordBatch.from_pylist(found, schema=kinds)
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra.columns], [*names, "execs", "children"])

    none = F.array().cast(f"array<{NAME}>")
    plain = rows.filter(~F.coalesce(needs, F.lit(False))).withColumn("execs", none).withColumn("children", none)
    return rows.filter(needs).mapInArrow(run, schema).unionByName(plain)


class TSqlBatches:
    """tsql_batches(text): batch, defines and refs of a script."""

    def eval(self, text: str):
        for b in tsql_rows(text):
            join = lambda rows: [f"{r['schema'] or 'dbo'}.{r['name']}|{r['kind']}" for r in rows]
            yield b["batch"], join(b["defines"]), join(b["refs"])


class CSharpMembers:
    """csharp_members(text): kind, namespace, type, name and lines of each member."""

    def eval(self, text: str):
        for m in csharp_row(text)["members"]:
            yield m["kind"], m["ns"], m["class"], m["name"], m["start_line"], m["end_line"]


def register(spark: SparkSession) -> None:
    """Make both parsers callable from SQL, as in `SELECT ... FROM files, LATERAL tsql_batches(text)`."""
    spark.udtf.register("tsql_batches", F.udtf(TSqlBatches, returnType="batch int, defines array<string>, refs array<string>"))
    spark.udtf.register("csharp_members", F.udtf(CSharpMembers, returnType="kind string, ns string, class string, name string, start_line int, end_line int"))

"""Scenarios from text to graph."""

import pytest

from codegraph import corpus
from codegraph.functions import exprs, parse
from codegraph.operators import graph, numbering, skew
from codegraph.plans import binding, chunks, ef, index, inline, migrations, sql
from pyspark.sql import functions as F

FILES = "path string, rel_path string, text string"


def files(spark, **texts):
    return spark.createDataFrame([(n, n, t) for n, t in texts.items()] if texts else [], FILES)


def scripts(spark, **texts):
    return sql.knowledge(parse.parse_tsql(files(spark, **texts)))


def code(spark, *texts):
    return parse.parse_csharp(files(spark, **{f"f{k}.cs": t for k, t in enumerate(texts)}))


def edges_of(rows):
    return {(r["from"], r["to"], r["relation"]) for r in rows.collect()}


def test_a_batch_links_every_definition_to_every_reference(spark):
    k = scripts(spark, a="CREATE TABLE dbo.Parent (Id INT); CREATE TABLE dbo.Child (Id INT, CONSTRAINT f FOREIGN KEY (Id) REFERENCES Parent (Id))")
    assert edges_of(k.edges) == {("dbo.Child|TABLE", "dbo.Parent|TABLE", "ForeignKey"), ("dbo.Parent|TABLE", "dbo.Parent|TABLE", "ForeignKey")}


def test_views_and_procedures_resolve_kinds_and_close(spark):
    k = scripts(spark, a="CREATE TABLE dbo.[Order] (Id INT)", b="CREATE VIEW dbo.V AS SELECT * FROM dbo.[order] o JOIN dbo.Gone g ON 1 = 1", c="CREATE PROC dbo.P AS SELECT * FROM V", d="PRINT 1")
    assert edges_of(k.edges) == {("dbo.V|VIEW", "dbo.order|TABLE", "ReadsFrom"), ("dbo.V|VIEW", "dbo.Gone|TABLE_OR_VIEW", "ReadsFrom"), ("dbo.P|PROC", "dbo.V|VIEW", "ReadsFrom")}
    nodes = {r.key: r for r in k.nodes.collect()}
    assert set(nodes) == {"dbo.Order|TABLE", "dbo.V|VIEW", "dbo.P|PROC", "dbo.__batch__:d:0|BATCH", "dbo.Gone|TABLE_OR_VIEW"}
    assert nodes["dbo.Gone|TABLE_OR_VIEW"].domain == "(external)" and nodes["dbo.V|VIEW"].body_path == "docs/bodies/dbo.V.VIEW.sql"
    assert {r.key for r in k.bodies.collect()} == {"dbo.Order|TABLE", "dbo.V|VIEW", "dbo.P|PROC"}


def test_a_batch_of_30000_definitions(spark):
    d = spark.range(30_000).select(F.lit("a").alias("path"), F.lit(0).alias("batch"), F.concat(F.lit("d"), "id").alias("key"), F.col("id").cast("int").alias("ord"))
    r = spark.range(20).select(F.lit("a").alias("path"), F.lit("a").alias("rel_path"), F.lit(0).alias("batch"), (F.col("id") * 10_000).cast("int").alias("ref_ord"), F.concat(F.lit("t"), "id").alias("to"), F.lit("TABLE").alias("to_kind"), F.lit("ReadsFrom").alias("relation"))
    edges = sql.define_ref_edges(d, r)
    last = edges.orderBy(F.desc("seq")).first()
    assert edges.count() == 600_000 and (last["from"], last.to, last.seq.ord, last.seq.nth) == ("d29999", "t19", 29_999, 190_000)


def test_totals_of_a_batch_make_no_product(spark):
    d = spark.range(200_000).select((F.col("id") % 2).cast("string").alias("path"), F.lit(0).alias("batch"), F.concat(F.lit("d"), "id").alias("key"), F.col("id").cast("int").alias("ord"))
    r = spark.range(200_000).select(F.lit("0").alias("path"), F.lit("a").alias("rel_path"), F.lit(0).alias("batch"), F.col("id").cast("int").alias("ref_ord"), F.concat(F.lit("t"), "id").alias("to"), F.lit("TABLE").alias("to_kind"), F.lit("ReadsFrom").alias("relation"))
    totals = sql.define_ref_totals(d, r)  # of 2e10 edges
    assert totals.groupBy("n", "seq.path").count().collect() == [(200_000, "0", 100_000)]
    few = lambda rows: rows.filter("cast(substring(key, 2) as int) < 9" if "key" in rows.columns else "ref_ord < 7")
    expected = sql.define_ref_edges(few(d), few(r)).groupBy("from", F.col("seq.ord").alias("ord")).agg(F.count("*").alias("n"))
    assert sorted(expected.select("from", "n", "ord").collect()) == sorted(sql.define_ref_totals(few(d), few(r)).select("from", "n", "seq.ord").collect())


def test_sides_that_grow_with_the_code_are_never_broadcast(spark):
    syntax = graph.stored(code(spark, 'class A { void M() { var q = "SELECT a FROM dbo.T WHERE b = 1"; db.ExecuteSqlRaw(q); } }'))
    hot, lines = inline.hot_calls(syntax), syntax.select("path", F.lit(1).alias("line"))
    for rows in (hot, inline.sql_literals(syntax, hot), graph.nearest_method(lines, inline.spans(syntax)), inline.method_edges(inline.artifacts(syntax))):
        plan = rows._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_keys_of_a_small_file_are_parsed_by_many_tasks(spark, tmp_path):
    spark.range(5_000).select(F.col("id").alias("c_custkey"), F.lit("A b").alias("c_mktsegment")).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    rows = corpus.repository_files(spark, str(tmp_path))
    assert rows.count() == 5_000 and rows.select(F.spark_partition_id()).distinct().count() == 3


def test_case_free_keys_are_those_of_the_collation(spark):
    points = spark.createDataFrame([(chr(k),) for k in range(1, 0x20000) if not 0xD800 <= k < 0xE000], "c string")
    pairs = points.select("c", F.explode(F.array(F.lower("c"), F.upper("c"), F.initcap("c"), F.lit("i"), F.lit("s"), F.lit("\u03c3"), F.lit("\u03c2"))).alias("d"))
    whole = pairs.select(F.explode(F.array(F.struct("c", "d"), F.struct(F.concat(F.lit("Db.A"), "c").alias("c"), F.concat(F.lit("dB.a"), "d").alias("d")))).alias("p")).select("p.*")
    same = F.collate("c", "UTF8_LCASE") == F.collate("d", "UTF8_LCASE")
    odd = whole.filter(~(same.eqNullSafe(graph.case_free("c") == graph.case_free("d"))))
    assert whole.filter(same).count() > 250_000 and odd.limit(5).collect() == []
    assert spark.sql("select cast(null as string) as k").select(graph.case_free("k").alias("k")).first().k is None


def test_edges_of_parsed_batches_are_those_of_the_join(spark):
    views = "\nCREATE SYNONYM dbo.N{k} FOR dbo.T{k};"
    texts = {"a.sql": "CREATE VIEW v AS SELECT a FROM t JOIN #w ON 1 = 1\nGO\nINSERT INTO u (a) VALUES (1)\nGO\nSELECT 1", "PostDeployment.sql": "EXEC p", "many.sql": "".join(views.format(k=k) for k in range(600))}
    b = graph.stored(parse.parse_tsql(files(spark, **texts)))
    edges, expected = sql.batch_edges(b), sql.define_ref_edges(sql.defines(b), sql.references(b))
    assert edges.columns == expected.columns and edges.count() == 600 * 600 + 4 and edges.exceptAll(expected).count() == 0
    assert {r["from"] for r in edges.filter("relation <> 'SynonymFor'").collect()} == {"dbo.v|VIEW", "dbo.__batch__:a.sql:1|BATCH", "dbo.__deploy__:PostDeployment.sql:0|DEPLOY"}


def test_what_is_not_asked_for_is_not_worked_out(spark):
    k = sql.knowledge(graph.stored(parse.parse_tsql(files(spark, a="CREATE VIEW v AS SELECT a FROM t"))))
    counted = index.counts(graph.dedupe_edges(sql.batch_edges(k.batches)), "relation")
    assert "min_by" not in counted._jdf.queryExecution().optimizedPlan().toString() and [tuple(r) for r in counted.collect()] == [("ReadsFrom", 1)]
    assert [r.key for r in k.bodies.collect()] == ["dbo.v|VIEW"] and not {"edges", "kept_edges", "nodes"} & k.__dict__.keys()
    assert {(r.key, r.kind) for r in k.nodes_with("kind").collect()} == {("dbo.v|VIEW", "VIEW"), ("dbo.t|TABLE_OR_VIEW", "TABLE_OR_VIEW")}


def test_nodes_of_code_are_counted_without_tables_of_edges(spark):
    syntax = graph.stored(code(spark, 'class A { void M() { var q = "SELECT a FROM dbo.T WHERE b = 1"; } }'))
    built = index.build(graph.stored(parse.parse_tsql(files(spark, a="CREATE VIEW v AS SELECT a FROM t"))), syntax, syntax, syntax)
    counted = index.counts(built.closing().filter("domain in ('code', 'code-inline-sql')"), "kind")
    assert "Join" not in counted._jdf.queryExecution().optimizedPlan().toString() and [tuple(r) for r in counted.collect()] == [("METHOD", 1)]
    assert built.closed.exceptAll(built.closing()).count() == 0 and built.closed.count() == built.closing().count() == 3


def test_hot_keys_are_dealt_out(spark):
    rows = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("key"), F.col("id").alias("v")).unionByName(spark.createDataFrame([(None, -1)], "key string, v long"))
    lookup = spark.createDataFrame([("hot", "H"), ("k1", "One"), ("unused", "U")], "key string, found string")
    found = skew.salted_join(rows, lookup, "key", F.col("v"))
    expected = rows.join(lookup, "key", "left")
    assert found.columns == ["key", "v", "found"] and found.count() == 40_001 and found.exceptAll(expected).count() == 0
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        sizes = sorted(r["count"] for r in skew.salted_join(rows, lookup, "key", F.col("v")).groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sizes[-1] < 3 * sizes[len(sizes) // 2] and sum(sizes) == 40_001


def test_deployment_scripts_without_definitions(spark):
    k = scripts(spark, **{"x/PostDeployment.sql": "INSERT INTO dbo.T (a) VALUES ($(V))\n:r other.sql"})
    assert {r.kind for r in k.nodes.collect()} == {"DEPLOY", "TABLE_OR_VIEW", "TABLE"}


CONTEXT = """class BaseEntity {} class Customer : BaseEntity {} class B {} class C : X.TrackedEntity {} class D {}
class Ctx : DbContext { public DbSet<Customer> Customers { get; set; } public IDbSet<B> Bs { get; set; } }"""


def test_entities_come_from_sets_and_bases(spark):
    s = code(spark, CONTEXT)
    none = spark.createDataFrame([], "name string, schema string, seq struct<stage:int,path:string,batch:int,ord:int,nth:int>")
    nodes, edges, bodies = ef.entity_graph(s, ef.entity_map(s), none, ["Other.TrackedEntity"])
    assert {r.key for r in nodes.filter("kind = 'ENTITY'").collect()} == {"csharp:Customer|ENTITY", "csharp:B|ENTITY", "csharp:C|ENTITY"}
    assert edges_of(edges) == {("csharp:Customer|ENTITY", "dbo.Customer|TABLE", "MapsTo"), ("csharp:B|ENTITY", "dbo.B|TABLE", "MapsTo")}
    assert bodies.count() == 3


@pytest.mark.parametrize(
    "chain, edge",
    [
        ("b.Entity<Child>().HasOne(c => c.Parent).WithMany(p => p.Children).HasForeignKey(c => c.ParentId);", ("dbo.Child|TABLE", "dbo.Parent|TABLE")),
        ("b.Entity<Child>().HasOne<Parent>().WithMany().HasForeignKey(c => c.ParentId);", ("dbo.Child|TABLE", "dbo.Parent|TABLE")),
        ("b.Entity<Parent>().HasMany(p => p.Children).WithOne(c => c.Parent).HasForeignKey(c => c.ParentId);", ("dbo.Children|TABLE", "dbo.Parent|TABLE")),
    ],
)
def test_fluent_keys(spark, chain, edge):
    s = code(spark, f"class X {{ void M(ModelBuilder b) {{ {chain} }} }}")
    assert edges_of(ef.fluent_graph(s, ef.entity_map(s))[1]) == {(*edge, "ForeignKey")}


def test_generic_to_table_is_no_mapping(spark):
    s = code(spark, 'class X { void M(ModelBuilder b) { b.Entity<A>().ToTable("T"); b.Entity("B").ToTable("U", "s"); } }')
    assert [(r.entity, r.schema, r.table) for r in ef.entity_map(s).collect()] == [("B", "s", "U")]


def test_migrations(spark):
    s = code(spark, """namespace N { [Migration(7)] class AddTouch { public void Up() { if (!Schema.Table(nameof(Customer)).Exists()) return; x.AddForeignKey(name: "FK", table: "Customer", principalTable: "Dependency"); Alter.Table("Blogs").AddColumn("Slug"); Data.InsertEntities(new[] { new Post { } }); } }
    class Initial : Migration { protected override void Up(MigrationBuilder b) { b.CreateTable("Blogs", t => new { }); } protected override void Down(MigrationBuilder b) { b.DropTable(name: "Blogs"); } } class Snap : ModelSnapshot { } }""")  # fmt: skip
    found = migrations.analysed(s)
    nodes, edges = migrations.migration_graph(found)
    assert {r.key for r in nodes.collect()} == {"csharp:N.AddTouch|MIGRATION", "csharp:N.Initial|MIGRATION"}
    assert edges_of(edges) == {("csharp:N.AddTouch|MIGRATION", "dbo.Customer|TABLE", "SchemaChange"), ("dbo.Customer|TABLE", "dbo.Dependency|TABLE", "ForeignKey"), ("csharp:N.Initial|MIGRATION", "dbo.Blogs|TABLE", "SchemaChange")}
    ops = {(r.operation, r.table) for r in migrations.operations(found).collect()}
    assert ("AddColumn", None) in ops and ("InsertEntities", "Post") in ops


def literal_class(*values):
    return "class T { void M() {\n" + "\n".join(f"var v{k} = {v!s};" for k, v in enumerate(values)) + "\n} }"


def test_classifier_stress(spark):
    n = range(10)
    good = [t for i in n for t in (f"SELECT * FROM dbo.T{i} WHERE Id = {i}", f"SELECT Name FROM dbo.T{i} WHERE Name LIKE 'a%'", f"INSERT INTO dbo.T{i} (a) VALUES (1)", f"UPDATE dbo.T{i} SET a = 1 WHERE b = 2", f"DELETE FROM dbo.T{i} WHERE a = {i}", f"SELECT * FROM dbo.A{i} a JOIN dbo.B{i} b ON a.Id = b.Id", f"SELECT [a] FROM [dbo].[T{i}]", f"SELECT COUNT(*) FROM dbo.T{i}", f"SELECT TOP 5 a FROM dbo.T{i}", f"EXEC dbo.P{i} 1 -- FROM x")] + ["SELECT 1 FROM dbo.Last"]
    bad = [t for i in n for t in (f"hello {i}", f"selected items {i}", f"from here to {i}", "update", f"please insert coin {i}", "x", f"delete key {i}", f"join us {i}", f"table for {i}", f"where are you {i}")]
    s = code(spark, literal_class(*(f'"{t}"' for t in good + bad)))
    facts = inline.artifacts(s)
    assert facts.select("line_number").distinct().count() == 101 and facts.count() == 111


def test_hot_methods_take_prose_and_extras_only_when_named(spark):
    text = 'namespace A.B { class R { void One() { db.SqlQuery<int>("refresh it"); }\n void Two() { RunAdHoc("do the thing"); }\n void Three() { log.Info("plain words"); } } }'
    s = code(spark, text)
    assert {(r.method_full_name, r.body_origin) for r in inline.artifacts(s).collect()} == {("A.B.R.One", "HotMethod")}
    assert {(r.method_full_name, r.body_origin) for r in inline.artifacts(s, ["RunAdHoc"]).collect()} == {("A.B.R.One", "HotMethod"), ("A.B.R.Two", "ExtraHotMethod")}


def test_a_named_literal_is_told_at_the_call_and_at_its_declaration(spark):
    s = code(spark, 'class R { void M() {\nvar q = "SELECT a FROM dbo.T WHERE b = 1";\ndb.FromSqlRaw(q);\n} }')
    assert {(r.line_number, r.body_origin) for r in inline.artifacts(s).collect()} == {(2, "HeuristicRoslyn"), (3, "HotMethod")}


def test_inline_foreign_keys(spark):
    s = code(spark, 'class R { string _d = "CREATE TABLE dbo.Child (Id INT, FOREIGN KEY (Id) REFERENCES [crm].[Parent](Id))"; void M() { } }')
    facts = inline.artifacts(s)
    assert edges_of(inline.foreign_key_edges(facts)) == {("dbo.Child|TABLE", "crm.Parent|TABLE", "ForeignKey")}
    assert edges_of(inline.method_edges(facts)) == {("csharp:R.M|METHOD", "dbo.Child|TABLE", "ReadsFrom")}


def test_table_pattern_quirks(spark):
    rows = spark.createDataFrame([("MERGE INTO dbo.T",), ("SELECT 1 FROM Db.dbo.T",), ("UPDATE u SET a = 1",), ("DELETE dbo.X",)], "b string")
    found = [[(x.schema, x.name) for x in r.r] for r in rows.select(exprs.table_refs(F.col("b")).alias("r")).collect()]
    assert found == [[("dbo", "INTO")], [("Db", "dbo")], [("dbo", "u")], []]


def test_whole_build_closes_tables(spark):
    empty = parse.parse_tsql(files(spark))
    s = code(spark, CONTEXT, 'class R { void M() { db.SqlQuery("SELECT * FROM dbo.View1"); } }')
    g = index.build(empty, s, s, s, ["BaseEntity"])
    keys = {r.key: r.domain for r in g.closed.collect()}
    assert keys["dbo.B|TABLE"] == "ef" and "dbo.View1|TABLE_OR_VIEW" not in keys and keys["csharp:R.M|METHOD"] == "code-inline-sql"
    assert keys["csharp:Ctx.Customers|DBSET"] == "code"


def test_interfaces_of_any_depth_and_cycles(spark):
    chain = " ".join(f"class C{k} : C{k + 1} {{ public int P{k} {{ get; set; }} }}" for k in range(12))
    s = code(spark, f"{chain} class C12 : IDeep, Odd {{ }} interface Odd : ILast {{ }} class X : Y {{ }} class Y : X, IKnot {{ }} class IClass {{ }} class Z : IClass {{ }}")
    found = {r["class"]: r.implemented_interfaces for r in binding.interfaces(binding.types_of(s)).collect()}
    assert found["C0"] == found["C12"] == ["IDeep", "ILast", "Odd"] and found["X"] == ["IKnot"] and "Z" not in found


def test_interfaces_and_base_types_are_bound_by_namespace(spark):
    s = code(spark, "class A : IHandler<My.Ns.Command>, System.IDisposable { int F() { } } namespace X { class P : IOne { int F() { } } } namespace Y { class P { int F() { } } class P<T> : ITwo<T, Ns.U[]> { } }",
             "using Al = X; using Y;\nnamespace Z.Q { class B : P { } class C : Al.P, IThree { } partial class D : IFour { } partial class D : B { } class E : P<int> { } class F : Unknown.Thing { } }", "namespace Z { class P { } }")
    types = binding.types_of(s)
    found = {r["class"]: r.implemented_interfaces for r in binding.interfaces(types).collect()}
    assert found == {"A": ["IDisposable", "IHandler<Command>"], "X.P": ["IOne"], "Y.P`1": ["ITwo<T, U[]>"], "Z.Q.C": ["IOne", "IThree"], "Z.Q.D": ["IFour"], "Z.Q.E": ["ITwo<T, U[]>"]}
    assert {r["class"]: r.base_type for r in binding.base_types(types).collect()} == {"Z.Q.B": "P", "Z.Q.C": "P", "Z.Q.D": "B", "Z.Q.E": "P<int>", "Z.Q.F": "Thing"}
    # The enclosing namespace comes before the file's usings.
    assert {(r.key, r.base) for r in types.bases.filter("base is not null").collect()} == {("Z.Q.B", "Z.P"), ("Z.Q.C", "X.P"), ("Z.Q.D", "Z.Q.B"), ("Z.Q.E", "Y.P`1")}
    assert {r.member: (r.base_type, r.implemented_interfaces) for r in chunks.members_of(s, types).filter("class = 'A'").collect()} == {"F": ("object", ["IDisposable", "IHandler<Command>"])}


def links_of(s):
    linked = chunks.code_graph(s)
    names = {r.id: f"{r['class']}.{r.member}/{r.params}" for r in linked.chunks.collect()}
    return {(names[r.src], names.get(r.dst, "?")) for r in linked.links.collect()}


def test_calls_are_resolved_by_class_receiver_and_sole_owner(spark):
    s = code(spark, """class Top { protected virtual void Do(int a) { } public void Up() { } }
class Mid : Top { protected override void Do(int a) { base.Do(a); } void Go(string s) { } void Go(int n) { } void Go(string s, params int[] more) { } void Go(object a, int b, int c) { } }
class Low : Mid { Mid other; public Top Prop { get; set; }
  void Run(Elsewhere x, System.Collections.Generic.Dictionary<string, Top> d, Low low = null) { Do(1); this.Up(); other.Do(2); Prop.Up(); this.Prop.Up(); x.Up(); Go("a"); Go(3); Go("a", 1, 2, 3); Go("a", 1, 2); low.Run(null, d); Elsewhere.Up(); Nobody(); One(1); "s".Ext(4); Elsewhere.Twice("s", 4); Make().Up(); Low.One(2); } }
class Elsewhere { public static void Up() { } static void One(int a) { } static void Ext(this string s, int b) { } static void Twice(this string s, int b) { } }""")  # fmt: skip
    assert links_of(s) == {("Mid.Do/1", "Top.Do/1"), ("Low.Run/3", "Mid.Do/1"), ("Low.Run/3", "Top.Up/0"), ("Low.Run/3", "Elsewhere.Up/0"), ("Low.Run/3", "Mid.Go/1"), ("Low.Run/3", "Mid.Go/2"), ("Low.Run/3", "Mid.Go/3"), ("Low.Run/3", "Low.Run/3"), ("Low.Run/3", "Elsewhere.One/1"), ("Low.Run/3", "Elsewhere.Ext/2"), ("Low.Run/3", "Elsewhere.Twice/2")}
    assert {r.dst for r in chunks.code_graph(code(spark, "class A { void M() { N(); } }", "class A { void M() { N(); } }")).links.collect()} == set()


def test_no_join_on_names_alone(spark):
    s = code(spark, "class A { void M() { N(); } void N() { } }")
    plan = chunks.code_graph(s).links._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_ids_follow_first_sight(spark):
    s = parse.parse_csharp(files(spark, **{"b/x.cs": "class X { void A() { Late(); Gen(); Early(); } void Early() { } void Late() { } }", "a/y.cs": "class Y { int P => 1; }", "b/z.g.cs": "class G { static void Gen() { } void Unused() { } }"}))
    linked = chunks.code_graph(s)
    assert {r.member: r.id for r in linked.chunks.collect()} == {"P": 1, "A": 2, "Late": 3, "Early": 5}
    assert {(r.src, tuple(r.callees)) for r in chunks.adjacency(linked.links).collect()} == {(2, (3, 4, 5))}


def test_dense_numbers_over_ranges(spark):
    rows = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("a"), F.lit("x").alias("b"))
    found = numbering.dense_ids(rows.repartition(9), ["a"]).collect()
    assert all(r.id == r.a + 1 for r in found) and len(found) == 5000
    assert numbering.dense_ids(rows.filter("a < 0"), ["a"]).count() == 0


def test_files_belong_to_the_deepest_project(spark):
    s = parse.parse_csharp(files(spark, **{"/r/a/b/x.cs": "class X { }", "/r/a/y.cs": "class Y { }", "/r/z.cs": "class Z { }"}))
    projects = spark.createDataFrame([("/r/a/A.csproj",), ("/r/a/b/B.csproj",)], "project_path string")
    assert {(r.path, r.project_name) for r in chunks.with_projects(s, projects).collect()} == {("/r/a/b/x.cs", "B"), ("/r/a/y.cs", "A")}


def test_chunk_text_has_what_stands_before_and_after(spark):
    s = code(spark, "class A {\n  int f;\n\n  /// <summary>x</summary>\n  public static int M(int a,\n    int b) => a; // end\n  A() { } }")
    found = {r.member: r for r in chunks.code_graph(s).chunks.collect()}
    assert found["M"].signature == "NoNamespace.A.int A.M(int a, int b)" and found["A"].signature == "NoNamespace.A.A.A()"
    assert found["M"].text == "// Namespace: NoNamespace // Class: A // Type: Method /// <summary>x</summary> \n  /// <summary>x</summary>\n  public static int M(int a,\n    int b) => a; // end\n"


def test_errors_are_told(spark):
    parsed = spark.createDataFrame([("b", "y"), ("a", "x"), ("c", "z"), ("d", None)], "path string, error string")
    assert [(r.path, r.error) for r in index.parse_errors(parsed).collect()] == [("a", "x"), ("b", "y")]


def test_raw_statements_and_data_calls(spark):
    s = code(spark, 'class V : Migration { void Up(B b) { b.Sql("UPDATE t SET a = 1"); b.Sql(Text()); Data.InsertEntity(Make()); Data.DeleteEntity(old); } }')
    ops = {(r.operation, r.table, r.raw if r.operation == "RawSql" else None) for r in migrations.operations(migrations.analysed(s)).collect()}
    assert ops == {("RawSql", None, "UPDATE t SET a = 1"), ("RawSql", None, "Text()"), ("DeleteEntity", "old", None)}


def test_inline_rows_without_a_body_have_no_file(spark):
    facts = spark.createDataFrame([("/r/a.cs", "a.cs", "N.R.M", ""), ("/r/a.cs", "a.cs", "N.R.M", "SELECT 1"), ("/r/a.cs", "a.cs", None, "SELECT 2")], "source_path string, relative_path string, method_full_name string, body string")
    facts = facts.selectExpr("*", "3 AS line_number", "'HotMethod' AS body_origin", "'N' AS ns", "'N.R' AS type_full_name")
    assert {(r.key, r.file, r.bodyPath) for r in inline.bodies(facts).collect()} == {("N.R.M", "/r/a.cs", None), ("N.R.M", "/r/a.cs", "docs/bodies/InlineSql.N.R.M.L3.sql")}


def test_sqlcmd_lines(spark):
    rows = spark.createDataFrame([("a\n\n  :r x.sql\nb $(V) $()\n:setvar q\n:other\n",)], "t string")
    assert rows.select(exprs.sqlcmd_preprocess(F.col("t"))).first()[0] == "a\n\nb 0 $()\n:other\n"


def test_first_wins_without_case_and_edges_with_case(spark):
    rows = spark.createDataFrame([("DBO.T|TABLE", 2), ("dbo.t|TABLE", 1)], "key string, n int").withColumn("seq", graph.seq(0, F.lit("p"), F.col("n")))
    assert [r.key for r in graph.first_by(rows, [F.lower("key")]).collect()] == ["dbo.t|TABLE"]
    edges = spark.createDataFrame([("a", "B", "R"), ("a", "b", "R"), ("a", "B", "R")], "from string, to string, relation string").withColumn("seq", graph.seq(0, F.lit("p")))
    assert graph.dedupe_edges(edges).count() == 2


def test_parsers_are_callable_from_sql(spark):
    parse.register(spark)
    rows = spark.sql("SELECT t.* FROM VALUES ('CREATE VIEW v AS SELECT * FROM a') f(text), LATERAL tsql_batches(f.text) t").collect()
    assert rows[0].defines == ["dbo.v|VIEW"] and rows[0].refs == ["dbo.a|TABLE_OR_VIEW"]

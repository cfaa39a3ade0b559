"""What the two recognisers find in small texts."""

import pytest

from codegraph.functions import lex_csharp, lex_tsql


def sql(text):
    batches = lex_tsql.recognise(text)
    return [[(d["kind"], d["schema"], d["name"]) for d in b.defines] for b in batches], [[(r["relation"], r["schema"], r["name"]) for r in b.refs] for b in batches]


def test_batches_are_split_by_lines_of_go_only():
    defines, _ = sql("CREATE TABLE Blogs (Id INT)\nGO\nCREATE VIEW vBlogs AS SELECT 'GO\nGO\n' x FROM Blogs\n go 5 \n")
    assert defines[0] == [("TABLE", None, "Blogs")]
    assert len(lex_tsql.split_batches("a\nGO\nb /* \nGO\n */ c")) == 2


@pytest.mark.parametrize(
    "text, refs",
    [
        ("SELECT * FROM a x, [s].[b c] AS y WITH (NOLOCK) JOIN c ON 1 = 1", [("ReadsFrom", None, "a"), ("ReadsFrom", "s", "b c"), ("ReadsFrom", None, "c")]),
        ("SELECT * FROM dbo.fn(1) f, #t, @v CROSS APPLY dbo.g(2)", []),
        ("FETCH NEXT FROM cur INTO @a; SELECT TRIM('x' FROM y), a IS DISTINCT FROM b", []),
        ("INSERT INTO dbo.T (a) SELECT a FROM (SELECT * FROM dbo.U) q", [("ReadsFrom", "dbo", "T"), ("WritesTo", "dbo", "T"), ("ReadsFrom", "dbo", "U")]),
        ("UPDATE STATISTICS dbo.T; UPDATE TOP (3) x.T SET a = 1", [("ReadsFrom", "x", "T"), ("WritesTo", "x", "T")]),
        ("DELETE TOP (5) FROM z", [("ReadsFrom", None, "z"), ("WritesTo", None, "z")]),
        ("MERGE INTO dbo.T AS t USING src s ON 1 = 1 WHEN MATCHED THEN UPDATE SET a = 1;", [("ReadsFrom", "dbo", "T"), ("WritesTo", "dbo", "T"), ("ReadsFrom", None, "src")]),
        ("EXEC @rc = srv.dbo.P 1; EXECUTE ('text'); EXEC #p", [("Executes", "dbo", "P")]),
        ("CREATE SYNONYM s FOR other.T", [("SynonymFor", "other", "T")]),
        ("CREATE TRIGGER t ON dbo.X AFTER INSERT, UPDATE AS INSERT INTO l SELECT * FROM inserted", [("On", "dbo", "X"), ("ReadsFrom", None, "l"), ("WritesTo", None, "l"), ("ReadsFrom", None, "inserted")]),
        ("CREATE TABLE c (p INT REFERENCES q(i), CONSTRAINT f FOREIGN KEY (p, [Year]) REFERENCES dbo.Parent (a, b) ON DELETE CASCADE)", [("ForeignKey", "dbo", "Parent")]),
        ("ALTER TABLE dbo.c WITH CHECK ADD CONSTRAINT f FOREIGN KEY (p) REFERENCES Parent (a)", [("ForeignKey", None, "Parent")]),
        ("-- FROM a\n/* FROM b /* FROM c */ FROM d */ SELECT 'FROM e' ", []),
    ],
)
def test_references(text, refs):
    assert sql(text)[1][0] == refs


def test_either_create_or_alter_defines_nothing():
    defines, refs = sql("CREATE OR ALTER PROCEDURE dbo.P AS IF EXISTS (SELECT 1 FROM dbo.Blogs) UPDATE dbo.Blogs SET a = 1 ELSE INSERT INTO dbo.Blogs (a) VALUES (1)")
    assert defines == [[]] and ("WritesTo", "dbo", "Blogs") in refs[0] and ("ReadsFrom", "dbo", "Blogs") in refs[0]


def test_broken_scripts_do_not_raise():
    for text in ("", "CREATE", "CREATE TABLE", "SELECT * FROM", "INSERT INTO (", "'never ends", "[never ends", "/* never ends", "EXEC", "CREATE TABLE a (((", "MERGE"):
        lex_tsql.recognise(text)


CODE = '''using System;
namespace Outer.Inner
{
    /// <summary>a thing</summary>
    [Table("Product", Schema = "dbo"), Serializable]
    public partial class Product<T> : Base<int>, IThing where T : class
    {
        private readonly string _q = "SELECT 1";
        public DbSet<Customer> Customers { get; set; } = null!;
        public int Short => Count(1);
        public int this[int i] { get { return 1; } }
        public Product(int x) : base(x) { Init(); }
        ~Product() { }
        public static Product operator +(Product a, Product b) { return Join(a, b); }
        public static implicit operator int(Product p) => 1;
        public event Action Changed;
        public (int, string) Tup(int a, Dictionary<string, int> b) => (1, "x");
        public async Task<List<int>> Load<K>(string sql)
        {
            var local = @"select ""a"" from dbo.T";
            var raw = """
                FROM raw
                """;
            var s = $"hello {Fmt("inner", 1):x} {{no}} z";
            db.Database.ExecuteSqlRaw(local, 1);
            var made = new Thing(1).Run();
            if (x < 3) { a.B(nameof(C.D)); }
            void Local(int q) { Deep(); }
            return await Go(x);
        }
    }
    public record Rec(int A) { public void M() { } }
    interface IThing { void N(); }
}
#if NEVER
class Hidden { }
#else
class Shown { }
#endif
'''


def test_types_and_members():
    f = lex_csharp.recognise("﻿" + CODE)
    assert [(c["kind"], c["name"], c["ns"]) for c in f.classes] == [("class", "Product", "Outer.Inner"), ("record", "Rec", "Outer.Inner"), ("interface", "IThing", "Outer.Inner"), ("class", "Shown", "")]
    product = f.classes[0]
    assert product["bases"] == ["Base<int>", "IThing"] and [a["name"] for a in product["attrs"]] == ["Table", "Serializable"] and product["attrs"][0]["args"] == ['"Product"', 'Schema = "dbo"']
    kinds = [(m["kind"], m["name"]) for m in f.members if m["class"] == "Product"]
    assert kinds == [("field", "_q"), ("property", "Customers"), ("property", "Short"), ("indexer", ""), ("ctor", "Product"), ("destructor", "Product"), ("operator", "+"), ("conversion", ""), ("event", ""), ("method", "Tup"), ("method", "Load")]
    load = next(m for m in f.members if m["name"] == "Load")
    assert (load["start_line"], load["params"], load["type_text"]) == (18, 1, "Task<List<int>>")


def test_calls_and_literals():
    f = lex_csharp.recognise(CODE)
    calls = {c["name"]: c for c in f.invocations}
    assert set(calls) == {"Count", "Init", "Join", "Fmt", "ExecuteSqlRaw", "B", "nameof", "Deep", "Go", "Run"}
    assert calls["ExecuteSqlRaw"]["chain"] == ["db", "Database", "ExecuteSqlRaw"] and calls["ExecuteSqlRaw"]["args"][0]["ident"] == "local"
    values = [x["value"] for x in f.literals]
    assert 'select "a" from dbo.T' in values and "FROM raw" in values and "inner" in values and not any("hello" in v for v in values)
    assert next(x for x in f.literals if x["value"] == "SELECT 1")["decl_name"] == "_q"


def test_file_scoped_namespaces_have_no_block_form():
    c = lex_csharp.recognise("namespace A.B;\nclass C { }").classes[0]
    assert (c["ns"], c["ns_block"]) == ("A.B", "")


def test_broken_code_does_not_raise():
    for text in ("", "class", "class X {", "class X { void M(", '"never', '$"{', "/*", "#if", "class X { int P { get; ", "namespace", "[A(", "}}}}", "class X : ", '"""'):
        lex_csharp.recognise(text)


def test_a_file_that_cannot_be_parsed_keeps_its_quoted_texts(monkeypatch):
    from codegraph.functions import parse

    monkeypatch.setattr(lex_csharp, "recognise", lambda text: 1 / 0)
    row = parse.csharp_row('a = "SELECT 1 FROM t";\nb')
    assert row["error"].startswith("ZeroDivisionError") and [(x["value"], x["line"]) for x in row["literals"]] == [("SELECT 1 FROM t", 1)]

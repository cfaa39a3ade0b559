"""Code rendered from the driver's tables by string expressions, so that expected results follow from the source columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Files that a task parses.
SCRIPTS_A_TASK, CLASSES_A_TASK = 20_000, 2_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(template: str, **values: Column) -> Column:
    """A template with {{name}} places."""
    parts, rest = [], template
    while "{{" in rest:
        before, _, rest = rest.partition("{{")
        name, _, rest = rest.partition("}}")
        parts += [F.lit(before), values[name].cast("string")]
    return F.concat(*parts, F.lit(rest))


def _dealt(rows: DataFrame, per_task: int) -> DataFrame:
    """Keys dealt out over tasks: a few bytes of a table's file become many texts, each some work to parse."""
    parts = -(-rows.count() // per_task)
    return rows.repartition(parts) if parts > 1 else rows


def _files(rows: DataFrame, path: Column, text: Column) -> DataFrame:
    return rows.select(F.concat(F.lit("/w/"), path).alias("path"), path.alias("rel_path"), text.alias("text"))


TABLE_SQL = """CREATE TABLE [dbo].[Part_{{k}}] (
  Id INT NOT NULL PRIMARY KEY, -- the key
  SupplierId INT REFERENCES dbo.Ignored(Id),
  Name NVARCHAR(100),
  CONSTRAINT FK_{{k}} FOREIGN KEY (SupplierId) REFERENCES sales.Supplier_{{s}}(Id) ON DELETE CASCADE
);
GO
"""
VIEW_SQL = """CREATE VIEW dbo.vCustomer_{{k}}
AS /* joins */ SELECT c.Id, n.Name FROM dbo.Customer_{{k}} AS c JOIN Nation_{{n}} n ON c.NationId = n.Id WHERE c.Name <> 'FROM nowhere'
GO
"""
PROC_SQL = """SET NOCOUNT ON
GO
CREATE PROCEDURE dbo.pOrder_{{k}} @id INT AS
BEGIN
  SELECT * FROM dbo.vCustomer_{{c}} WHERE Id = @id;
  INSERT INTO dbo.Audit_{{s}} (Id) SELECT Id FROM #work;
  EXEC dbo.Log{{p}} @id = 1;
END
"""


def sql_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table script for each part, a view for each customer, a procedure for each order.

    Every 7th part script has sqlcmd lines, every 11th defines nothing.
    """
    part = _dealt(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k")), SCRIPTS_A_TASK)
    supplier = (F.col("k") % 97) + 1
    made = text_of(TABLE_SQL, k=F.col("k"), s=supplier)
    text = F.when(F.col("k") % 11 == 0, text_of("INSERT INTO dbo.PartLog (Id) SELECT Id FROM dbo.Part_{{k}}\nGO\n", k=F.col("k"))).when(F.col("k") % 7 == 0, F.concat(F.lit(':setvar Size "10"\n:r other.sql\n'), F.replace(made, F.lit("NVARCHAR(100)"), F.lit("NVARCHAR($(Size))")))).otherwise(made)
    parts = _files(part, F.concat(F.lit("Tables/Part_"), "k", F.lit(".sql")), text)
    customer = _dealt(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("n")), SCRIPTS_A_TASK)
    views = _files(customer, F.concat(F.lit("Views/vCustomer_"), "k", F.lit(".sql")), text_of(VIEW_SQL, k=F.col("k"), n=F.col("n")))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.col("o_orderstatus").alias("s"), F.substring("o_orderpriority", 1, 1).alias("p"))
    orders = _dealt(orders, SCRIPTS_A_TASK)
    procs = _files(orders, F.concat(F.lit("Procs/pOrder_"), "k", F.lit(".sql")), text_of(PROC_SQL, k=F.col("k"), c=F.col("c"), s=F.col("s"), p=F.col("p")))
    return parts.unionByName(views).unionByName(procs)


KINDS_SQL = (
    "CREATE PROC dbo.U_{{k}} AS UPDATE sales.T_{{k}} SET a = 1 WHERE b = 2;",
    "CREATE PROC dbo.D_{{k}} AS DELETE FROM sales.T_{{k}} WHERE a = 1;",
    "CREATE PROC dbo.M_{{k}} AS MERGE INTO sales.T_{{k}} AS t USING stage.S_{{k}} AS s ON t.Id = s.Id WHEN MATCHED THEN UPDATE SET a = s.a WHEN NOT MATCHED THEN INSERT (a) VALUES (s.a);",
    "CREATE FUNCTION dbo.F_{{k}} (@x INT) RETURNS TABLE AS RETURN SELECT Id FROM sales.T_{{k}} WHERE Id = @x;",
    "CREATE TYPE dbo.Y_{{k}} AS TABLE (Id INT NOT NULL);",
    "CREATE TYPE dbo.Z_{{k}} FROM NVARCHAR(10) NOT NULL;",
    "CREATE SEQUENCE dbo.Q_{{k}} START WITH 1 INCREMENT BY 1;",
    "CREATE TRIGGER dbo.G_{{k}} ON sales.T_{{k}} AFTER UPDATE AS INSERT INTO dbo.Log_{{k}} (a) VALUES (1);",
    "CREATE SYNONYM dbo.N_{{k}} FOR sales.T_{{k}};",
    "ALTER TABLE sales.T_{{k}} ADD CONSTRAINT FK_{{k}} FOREIGN KEY (a) REFERENCES ref.P_{{k}} (Id);",
    "ALTER VIEW dbo.W_{{k}} AS SELECT Id FROM sales.T_{{k}};",
    "INSERT INTO dbo.Seed_{{k}} (a) VALUES (1);",
)


def kinds_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A script for each supplier, of one of twelve kinds of statements; the last are deployment scripts."""
    k = F.col("k")
    text = text_of(KINDS_SQL[0], k=k)
    for n, template in enumerate(KINDS_SQL[1:], 1):
        text = F.when(k % 12 == n, text_of(template, k=k)).otherwise(text)
    path = F.when(k % 12 == 11, F.concat(F.lit("Kinds/"), k, F.lit("/PostDeployment.sql"))).otherwise(F.concat(F.lit("Kinds/K_"), k, F.lit(".sql")))
    return _files(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k")), path, text)


MODEL_CS = """using System;
namespace Shop.Model
{
    public class BaseEntity { public int Id { get; set; } }
    public class Ctx_{{k}} : DbContext
    {
        public DbSet<Cust_{{k}}> Custs { get; set; } = null!;
        public IDbSet<Model.Ord_{{k}}> Ords { get; set; }
        protected override void OnModelCreating(ModelBuilder b)
        {
            b.Entity<Ord_{{k}}>().HasOne(o => o.Cust_{{k}}).WithMany(c => c.Orders).HasForeignKey(o => o.CustId);
            b.Entity(typeof(Ord_{{k}})).ToTable("Orders_{{k}}", "sales");
            if (b != null) { Prepare(b); }
        }
        private void Prepare(ModelBuilder b) { Check("ready"); }
        private void Check(string what) => Console.WriteLine(what);
    }
    {{attribute}}
    public class Cust_{{k}} : BaseEntity { public string Name { get; set; } }
    public class Ord_{{k}} { public int CustId { get; set; } }
    public class Extra_{{k}} : Shop.Model.BaseEntity, IThing { }
    public class Plain_{{k}} { public const string Note = "nothing to see"; }
}
"""


def model_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A context with two sets and four classes for each nation; even ones name their customer table."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"))
    attribute = F.when(F.col("k") % 2 == 0, text_of('[Table("CustTable_{{k}}", Schema = "crm")]', k=F.col("k"))).otherwise("")
    return _files(nation, F.concat(F.lit("Model/Ctx_"), "k", F.lit(".cs")), text_of(MODEL_CS, k=F.col("k"), attribute=attribute))


REPO_CS = """namespace Shop.Data
{
    public class Repo_{{k}}
    {
        private readonly string _last = "SELECT Name FROM seg.Last_{{k}} WHERE Id = 2";
        public void Load()
        {
            var q = "SELECT * FROM dbo.Customer_{{k}} WHERE Id = 1";
        }
        public void Save() { Run(@"INSERT INTO seg.Seg_{{s}}
            VALUES (1)"); }
        public void Hot() { var text = "refresh everything"; _db.Database.ExecuteSqlRaw(text, 1); }
        public void Prose() { Log("select nothing at all"); var n = $"SELECT {1} FROM dbo.Never"; }
        {{more}}
    }
}
"""
EXEC_CS = 'public void Exec() { _db.SqlQuery<int>("EXEC dbo.Refresh_{{k}} 1"); }'
DDL_CS = 'public void Ddl() { var d = "CREATE TABLE dbo.Child_{{k}} (Id INT, P INT, CONSTRAINT fk FOREIGN KEY (P) REFERENCES crm.Parent_{{k}}(Id))"; }'


def repository_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A class with embedded SQL for each customer; every 5th executes a procedure, every 7th of the others has DDL."""
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.lower("c_mktsegment").alias("s"))
    customer = _dealt(customer, CLASSES_A_TASK)
    k = F.col("k")
    more = F.when(k % 5 == 0, text_of(EXEC_CS, k=k)).when(k % 7 == 0, text_of(DDL_CS, k=k)).otherwise("")
    return _files(customer, F.concat(F.lit("Data/Repo_"), "k", F.lit(".cs")), text_of(REPO_CS, k=k, s=F.regexp_replace("s", r"\W", "_"), more=more))


SHARED_CS = """using System;
namespace Shop.Contracts
{
    public interface IRoot { }
    public abstract class Root : IRoot { }
    public class Item { }
}
namespace Shop.Contracts.Rows { public interface IRow { } }
namespace Shop { public static class Tool { public static int Twice(int n) => n + n; } }
"""
CORE_CS = """using System;
using Rows = Shop.Contracts.Rows;
namespace Shop.Core.S{{k}}
{
    public interface IStore<T> : IDisposable
    {
        void Put(T item, int n);
    }
    public abstract partial class Base : Shop.Contracts.Root, IStore<Shop.Contracts.Item>, Rows.IRow
    {
        /// <summary>Saves {{k}}.</summary>
        public void Save(string text) { Log("saved", 1); }
        public void Save(int number, bool twice = false) { Log("number", 2); }
        protected void Log(string what, int level) { Generated(level); }
        public void Put(Shop.Contracts.Item item, int n) { }
        public void Dispose() { }
    }
    public class P : IOne { public int A { get; set; } }
    public static class Other { public static void Only{{k}}() { } }
}
"""
IMPL_CS = """using Shop.Core.S{{k}};
using Shop.Contracts;
namespace Shop.Impl.S{{k}}
{
    public class Impl : Base, IHandler<Shop.Contracts.Item>, System.IEquatable<Impl>
    {
        private readonly Helper _helper;
        public Impl(Helper helper) { _helper = helper; Log("made", 0); }
        public void Run(IStore<Item> store)
        {
            Save("text");
            Save(7);
            base.Dispose();
            _helper.Make(1, 2, 3);
            store.Put(null, 1);
            Tool.Twice(2);
            Only{{k}}();
            Console.WriteLine("done");
        }
        public int Size { get { return _helper.Count(); } }
        public int Fast => _helper.Count();
    }
    public class P { public int A { get; set; } }
    public class Helper
    {
        public void Make(params int[] all) { }
        public int Count() { return 1; }
    }
}
"""
GENERATED_CS = """namespace Shop.Core.S{{k}}
{
    public partial class Base : System.IFormattable { void Generated(int level) { } }
}
"""


def hierarchy_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file that all share, and for each supplier a base class with overloads and interfaces, a class derived from it in
    another namespace, classes of one name in both, and a generated part. Member names are the same everywhere."""
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"))
    folder = F.concat(F.lit("Lib/"), F.lpad("k", 8, "0"))
    made = [_files(supplier, F.concat(folder, F.lit(f"/{name}")), text_of(text, k=F.col("k"))) for name, text in (("A.cs", CORE_CS), ("B.cs", IMPL_CS), ("C.g.cs", GENERATED_CS))]
    shared = _files(supplier.agg(F.min("k").alias("k")), F.lit("Lib/0.cs"), F.lit(SHARED_CS))
    return shared.unionByName(made[0]).unionByName(made[1]).unionByName(made[2])


MIGRATION_CS = """namespace Shop.Migrations
{
    [DbContext(typeof(Ctx))]
    [Migration("{{k}}_step")]
    public partial class V{{k}} : Migration
    {
        protected override void Up(MigrationBuilder migrationBuilder)
        {
            {{up}}
        }
        protected override void Down(MigrationBuilder migrationBuilder)
        {
            migrationBuilder.DropTable(name: "Undo_{{k}}");
        }
    }
}
"""
UPS = (
    'migrationBuilder.CreateTable(name: "T_{{k}}", columns: t => new { Id = t.Column<int>(nullable: false) }, schema: "sales");',
    'migrationBuilder.DropTable("T_{{k}}");',
    'migrationBuilder.AddColumn<int>(name: "C_{{k}}", table: "T_{{k}}", schema: "sales");',
    'migrationBuilder.DropColumn(name: "C_{{k}}", table: "T_{{k}}");',
    'migrationBuilder.RenameColumn(name: "C_{{k}}", table: "T_{{k}}", newName: "D_{{k}}");',
    'migrationBuilder.AddForeignKey(name: "FK_{{k}}", table: "T_{{k}}", column: "P", principalTable: "P_{{k}}");',
    'migrationBuilder.DropForeignKey(name: "FK_{{k}}", table: "T_{{k}}"); migrationBuilder.Sql("UPDATE dbo.X SET a = 1");',
    'if (!Schema.Table(nameof(T_{{k}})).Exists()) { Create.Table("N_{{k}}"); Create.Index("IX_{{k}}"); Data.InsertEntity(new Post_{{k}} { A = 1 }); }',
)


def migration_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A migration for each supplier, one of eight kinds."""
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"))
    k = F.col("k")
    up = text_of(UPS[0], k=k)
    for n, template in enumerate(UPS[1:], 1):
        up = F.when(k % 8 == n, text_of(template, k=k)).otherwise(up)
    return _files(supplier, F.concat(F.lit("Migrations/V"), "k", F.lit(".cs")), text_of(MIGRATION_CS, k=k, up=up))


def literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path, line, method, value: a literal for each order, SQL of three kinds and prose."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.col("o_orderstatus").alias("s"))
    k = F.col("k")
    value = F.when(k % 4 == 0, text_of("SELECT *\n FROM dbo.Customer_{{c}} x JOIN [sales].[Order_{{s}}] y ON x.Id = y.Id", c=F.col("c"), s=F.col("s"))).when(k % 4 == 1, text_of("insert into Audit_{{s}} values ({{k}})", s=F.col("s"), k=k)).when(k % 4 == 2, text_of("UPDATE crm.Customer_{{c}} SET a = 1 WHERE Id = {{k}}", c=F.col("c"), k=k)).otherwise(text_of("please select order {{k}} at once", k=k))
    return o.select(F.concat(F.lit("Data/F"), k % 1000, F.lit(".cs")).alias("path"), (k % 311).cast("int").alias("line"), F.concat(F.lit("Shop.Data.F.M"), k).alias("method"), value.alias("value"), k.alias("k"))


def tree_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, content) of a folder tree: a file for each supplier, in folders that scans skip and others, of kinds that they
    take and others, with dots and spaces in names, every fourth not UTF-8, every ninth empty."""
    k = F.col("s_suppkey")
    folder = F.element_at(F.array(*map(F.lit, ("src/A", "src/bin", "db/Change Scripts", "db/Snapshots/x", ".git", "src/.hidden/deep", "packages/p", "db"))), (k % 8 + 1).cast("int"))
    name = F.element_at(F.array(*map(F.lit, ("F #.cs", "t#.SQL", "#.editorconfig", "_n#.md", "i#.png"))), (k % 5 + 1).cast("int"))
    path = F.concat_ws("/", folder, F.when(k % 3 == 0, F.concat(F.lit("n"), k % 10)), F.replace(name, F.lit("#"), k.cast("string")))
    content = F.when(k % 9 == 0, F.lit("").cast("binary")).when(k % 4 == 0, F.concat(F.unhex(F.lit("FFFE80C3")), k.cast("string").cast("binary"))).otherwise(F.concat(F.lit("// é "), k).cast("binary"))
    return table(spark, sf_dir, "supplier").select(path.alias("path"), content.alias("content"))


def colliding_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A script for each supplier, in pairs that define one view in different case; each third also alters a procedure and
    a function."""
    k = F.col("k")
    pair = F.floor(k / 2)
    view = F.when(k % 2 == 0, text_of("CREATE VIEW dbo.Same_{{p}} AS SELECT {{k}} AS n FROM sales.T_{{k}}", p=pair, k=k)).otherwise(text_of("CREATE VIEW DBO.SAME_{{p}} AS SELECT {{k}} AS n FROM sales.T_{{k}}", p=pair, k=k))
    more = F.when(k % 3 == 0, text_of("\nGO\nALTER PROC dbo.A_{{k}} AS SELECT 1 AS one\nGO\nALTER FUNCTION dbo.B_{{k}} (@x INT) RETURNS INT AS BEGIN RETURN 1 END\n", k=k)).otherwise("")
    return _files(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k")), F.concat(F.lit("Same/"), F.lpad("k", 8, "0"), F.lit(".sql")), F.concat(view, more))


def mapped_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files for each nation that map one entity by attributes, in different case; for even ones a third by a call."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"))
    one = _files(nation, F.concat(F.lit("Map/a_"), "k", F.lit(".cs")), text_of('namespace M { [Table("First_{{k}}")] public class E_{{k}} { } }', k=F.col("k")))
    two = _files(nation, F.concat(F.lit("Map/b_"), "k", F.lit(".cs")), text_of('namespace M { [Table("Second_{{k}}", Schema = "s")] public class e_{{k}} { } }', k=F.col("k")))
    call = _files(nation.filter("k % 2 = 0"), F.concat(F.lit("Map/a0_"), "k", F.lit(".cs")), text_of('class C { void M(B b) { b.Entity("M.E_{{k}}").ToTable("Third_{{k}}", "t"); } }', k=F.col("k")))
    return one.unionByName(two).unionByName(call)


HOT_CS = """namespace Hot.N
{
    class R_{{k}}
    {
        void One() { RunAdHoc("do {{k}} things"); RunOther("do other things"); }
        void Two() { db.Database.ExecuteSqlRaw("refresh {{k}}"); var s = "SELECT a FROM dbo.Hidden_{{k}} WHERE b = 1"; }
        void Three() { var s = "SELECT a FROM dbo.Seen_{{k}} WHERE b = 1"; }
        void Four() { db.Database.ExecuteSqlRaw("   "); RunAdHoc(""); }
    }
}
"""


def hot_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A class for each supplier with a hot name that only a setting knows, a literal on the line of a hot call, and blank ones."""
    return _files(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k")), F.concat(F.lit("Hot/R_"), "k", F.lit(".cs")), text_of(HOT_CS, k=F.col("k")))


FLUENT_CS = (
    "b.Entity<Child_{{k}}>().HasOne(c => c.Parent_{{k}}).WithMany(p => p.Children).HasForeignKey(c => c.ParentId);",
    "b.Entity<Child_{{k}}>().HasOne<Parent_{{k}}>().WithMany().HasForeignKey(c => c.ParentId);",
    "b.Entity<Parent_{{k}}>().HasMany(p => p.Children_{{k}}).WithOne(c => c.Parent).HasForeignKey(c => c.ParentId);",
)


def fluent_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A context for each supplier with a foreign key in one of three forms."""
    k = F.col("k")
    chain = F.when(k % 3 == 0, text_of(FLUENT_CS[0], k=k)).when(k % 3 == 1, text_of(FLUENT_CS[1], k=k)).otherwise(text_of(FLUENT_CS[2], k=k))
    return _files(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k")), F.concat(F.lit("Fluent/X_"), k, F.lit(".cs")), F.concat(F.lit("class X_"), k, F.lit(" { void M(ModelBuilder b) { "), chain, F.lit(" } }")))

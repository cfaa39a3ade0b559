"""Repository scans, configuration, solutions, bundles, streaming."""

import json
import os
import re
import time
import zipfile

import pytest

from codegraph import __main__ as command
from codegraph import config, progress
from codegraph.plans import index
from codegraph.sources import bodies, bundle, linefile, repo, solution
from codegraph.streaming import incremental
from pyspark.sql import functions as F


def put(root, **texts):
    for name, text in texts.items():
        path = os.path.join(str(root), name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", encoding="utf-8") as f:
            f.write(text)


def test_scan_keeps_dot_files_and_drops_others(spark, tmp_path):
    put(tmp_path, **{"a.MD": "x", "b.cs": "y", "Q/c.SQL": "", ".editorconfig": "", "_d.tt": "", "e.json": "{}", "f.png": "", "g.log": ""})
    rows = {r.rel_path: r for r in repo.files(spark, str(tmp_path), hashes=True).collect()}
    assert {r.kind for r in rows.values()} == {"MD", "CS", "SQL", "EDITORCONFIG", "TT", "JSON"} and len(rows) == 6
    assert rows["Q/c.SQL"].sha256 == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert {r.rel_path for r in repo.files(spark, str(tmp_path)).filter("kind = 'CS'").collect()} == {"b.cs"}


def test_a_missing_root_is_made(spark, tmp_path):
    assert repo.files(spark, str(tmp_path / "new")).count() == 0 and (tmp_path / "new").is_dir()


def test_folders_are_listed_in_turns(spark, tmp_path):
    names = {f"a{i}/b{j}/c{k}.cs" for i in range(4) for j in range(5) for k in range(2)}
    put(tmp_path, **dict.fromkeys(names, "x"), **{"a1/Bin/z.cs": "x", "a2/q.txt": ""})
    os.symlink(str(tmp_path / "a0"), str(tmp_path / "loop"))
    for most in (1, 3, 512):
        assert {r.rel_path for r in repo.listing(spark, str(tmp_path), skip=("bin",), folders_a_turn=most).collect()} == names
    (tmp_path / "a0" / "b0" / "c0.cs").unlink()
    assert repo.files(spark, str(tmp_path), where=F.col("rel_path").startswith("a0/b0/")).count() == 1


def test_files_that_are_gone_are_left_out(spark, tmp_path):
    put(tmp_path, **{"a.cs": "x", "b.cs": "y"})
    found = repo.listing(spark, str(tmp_path))
    (tmp_path / "a.cs").unlink()
    assert [r.rel_path for r in repo.contents(found).collect()] == ["b.cs"]


def tree_of(folder):
    return {os.path.relpath(os.path.join(top, n), folder): open(os.path.join(top, n), "rb").read() for top, _, names in os.walk(folder) for n in names}


def test_body_files_are_written_whole_or_not_at_all(spark, tmp_path):
    rows = spark.createDataFrame([(f"docs/{k % 3}/{k}.sql", f"é {k}") for k in range(40)] + [(None, "x"), ("empty", None)], "path string, content string")
    bodies.write(rows.repartition(5), str(tmp_path))
    whole = {f"docs/{k % 3}/{k}.sql": f"é {k}".encode() for k in range(40)} | {"empty": b""}
    assert tree_of(tmp_path) == whole
    bodies.write(spark.createDataFrame([("docs/0/0.sql", b"\xff"), ("docs/new/n", b"")], "path string, content binary"), str(tmp_path))
    assert tree_of(tmp_path) == whole | {"docs/0/0.sql": b"\xff", "docs/new/n": b""}
    with pytest.raises(Exception, match="not a path below"):
        bodies.write(rows.unionByName(spark.createDataFrame([("../out", "x")], "path string, content string")).repartition(4), str(tmp_path / "new"))
    assert not (tmp_path / "out").exists() and tree_of(tmp_path / "new") == {} and not list((tmp_path / "new").glob(".*"))


def test_a_killed_task_leaves_no_partial_file(tmp_path):
    writer = bodies.BodyWriter(str(tmp_path))

    def killed():
        yield "a/1.sql", "one"
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        writer.write(killed())
    own = next(tmp_path.glob(".staging-*/.attempt-*"))
    (own / "part").write_text("half of a fi")  # what a task that is killed in the middle leaves
    assert [p for p in tmp_path.iterdir() if not p.name.startswith(".staging-")] == []
    done = [writer.write(iter([("a/1.sql", "one"), ("a/2.sql", "two")])), writer.write(iter([("a/1.sql", "one")]))]
    writer.commit(done)
    assert tree_of(tmp_path) == {"a/1.sql": b"one", "a/2.sql": b"two"}


def test_one_file_written_by_ranges(spark, tmp_path):
    path = str(tmp_path / "x.txt")
    put(tmp_path, **{"x.txt": "as it was"})
    rows = spark.range(3000).select(F.col("id"), F.concat(F.lit("é"), F.col("id") * 7919 % 3000).alias("line")).repartition(7)
    made = [linefile.Part(rows, F.col("line"), [F.desc("id")], "head\n", ", ", " end\n"), linefile.Part(rows.filter("id < 0"), F.col("line"), [], "<", "|", ">"), linefile.Part(rows.filter("id = 5"), F.col("line"), [], "<", "|", ">")]
    linefile.write(path, *made)
    with open(path, encoding="utf-8") as f:
        assert f.read() == "head\n" + ", ".join(f"é{k * 7919 % 3000}" for k in reversed(range(3000))) + " end\n<><é" + str(5 * 7919 % 3000) + ">"
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        linefile.write(path, made[0], linefile.Part(rows, (F.lit(1) / (F.col("id") - 7)).cast("string")))
    assert os.listdir(tmp_path) == ["x.txt"] and os.path.getsize(path) > 15_000


def test_heartbeat():
    lines = []
    with progress.Heartbeat(lines.append, " ", 0.01) as beat:
        assert beat.period == 0.25 and progress.Heartbeat(print, "x", 99).period == 10
        assert re.fullmatch(r"\[HB \d\d:\d\d:\d\d\] Starting \(   -\), elapsed 00:00:0\d", beat.line())
        beat.report("graph", 1, 4)
        assert beat.line().endswith("graph [1/4] ( 25%), elapsed 00:00:00")
        beat.since -= 3700
        beat.report("", 4, 4)
        assert beat.line().endswith("graph [4/4] (100%), elapsed 01:01:40")
        time.sleep(0.4)
    n = len(lines)
    assert n >= 2
    time.sleep(0.4)
    assert len(lines) == n


def test_hash_of_streams(tmp_path):
    put(tmp_path, abc="abc", big="x" * 3_500_000)
    assert repo.file_sha256(str(tmp_path / "abc")) == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"
    assert len(repo.file_sha256(str(tmp_path / "big"))) == 64


def test_sql_scan_leaves_folders_out(spark, tmp_path):
    put(tmp_path, **{"a.sql": "", "Change Scripts/b.sql": "", "x/BIN/c.sql": "", "Initial Data/d.sql": "", "y/e.sql": ""})
    assert {r.rel_path for r in repo.sql_files(spark, str(tmp_path)).collect()} == {"a.sql", "y/e.sql"}


@pytest.mark.parametrize("name, text", [("s.sln", 'Project("{F}") = "A", "A\\A.csproj", "{G}"\nEndProject'), ("s.slnx", '<Solution><Project Path="A/A.csproj" /></Solution>')])
def test_solutions(spark, tmp_path, name, text):
    put(tmp_path, **{name: text})
    assert [r.project_path for r in solution.read_solution(spark, str(tmp_path / name)).collect()] == [str(tmp_path / "A" / "A.csproj")]
    with pytest.raises(NotImplementedError):
        solution.read_solution(spark, "x.txt")


def test_git_files(tmp_path):
    put(tmp_path, **{".git/HEAD": "ref: refs/heads/feature/x\n", ".git/packed-refs": "# pack\nabc123 refs/heads/feature/x\n"})
    assert solution.git_files(str(tmp_path)) == {"branch": "feature/x", "head_sha": "abc123", "root": str(tmp_path)}
    put(tmp_path, **{".git/HEAD": "def456\n"})
    assert solution.git_files(str(tmp_path))["branch"] == "(detached)"


def test_config(tmp_path):
    c = config.load_jsonc('{ // note\n "paths": { "sqlRoot": "db", "modelRoot": 7, }, /* x */ "ef": "http://no,}t", "dbGraph": { "entityBaseTypes": ["A.B", " ", 3] }, }')
    made = config.IndexerConfig.load({"migrationsroot": "/m"}, c, "/base", {"INDEXER_NOHASH": "1", "INDEXER_OUTROOT": "/o"})
    assert (made.sql_root, made.migrations_root, made.out_root, made.entity_base_types, made.skip_hashes) == ("/base/db", "/m", "/o", ("A.B",), True)
    assert made.mode == "sql+ef" and config.IndexerConfig(migrations_root="/m").ef_root == "/m" and config.IndexerConfig().mode == "skip"
    assert config.parse_args(["--a", "1", "-b", "c=d", "--flag"]) == {"a": "1", "b": "c=d", "flag": "true"}
    for bad in (None, {}, {"dbGraph": None}, {"dbGraph": {"entityBaseTypes": "x"}}, {"dbGraph": []}):
        assert config.entity_base_types(bad) == []
    assert config.split_roots(" a ;b|| c") == ["a", "b", "c"]


def test_command_line(tmp_path, capsys):
    put(tmp_path, **{"c/index.json": '{ "paths": { "solution": "S.sln", "inlineSqlRoot": "a;b" } }'})
    made = command.settings(["--config", str(tmp_path / "c" / "index.json"), "--temp-root", '"/t"', "sql=/db"])
    assert (made.solution, made.temp_root, made.sql_root, made.inline_sql_root) == (str(tmp_path / "c" / "S.sln"), "/t", "/db", f"{tmp_path}/c/a;{tmp_path}/c/b")
    assert command.main(["--solution", "x"]) == 2 and "--temp-root" in capsys.readouterr().err


def test_archive(tmp_path):
    put(tmp_path / "in", **{"a.txt": "1", "d/b.txt": "2"})
    path = bundle.archive(str(tmp_path / "in"), "feature/x", str(tmp_path / "out"))
    assert os.path.basename(path) == "feature_x.zip" and not (tmp_path / "in").exists() and sorted(zipfile.ZipFile(path).namelist()) == ["a.txt", "d/b.txt"]
    put(tmp_path / "in", **{"a.txt": "1"})
    assert bundle.archive(str(tmp_path / "in"), "feature/x", str(tmp_path / "out")) != path
    assert bundle.branch_file_name(" ") == "artifacts" and bundle.branch_file_name("a..") == "a"


def test_a_whole_run(spark, tmp_path):
    put(tmp_path, **{"db/T.sql": 'CREATE TABLE dbo.Customer (Id INT, Name NVARCHAR(10) DEFAULT \'a"b\')', "db/V.sql": "CREATE VIEW dbo.V AS SELECT * FROM Customer", "src/M.cs": "class Customer {} class Ctx : DbContext { public DbSet<Customer> Customers { get; set; } void Go() { Run(); } void Run() { } }",
                     "src/Mig.cs": 'class V1 : Migration { void Up(B b) { b.CreateTable("Blogs"); } }', "src/R.cs": 'class R { void M() { db.SqlQuery("SELECT * FROM dbo.Customer"); } }'})
    made = config.IndexerConfig(temp_root=str(tmp_path / "tmp"), out_root=str(tmp_path / "out"), sql_root=str(tmp_path / "db"), model_root=str(tmp_path / "src"), migrations_root=str(tmp_path / "src"), inline_sql_root=str(tmp_path / "src"))
    assert index.core_counts(spark, made) == {"files": 5, "hashes": 5, "classes": 4, "methods": 4, "definitions": 2}
    path = index.run(spark, made)
    with zipfile.ZipFile(path) as z:
        names = set(z.namelist())
        nodes = z.read("sql_code_bundle/graph/nodes.csv").decode()
        bodies = [json.loads(x) for x in z.read("sql_code_bundle/docs/sql_bodies.jsonl").decode().splitlines()]
        graph = json.loads(z.read("sql_code_bundle/graph/graph.json"))
        manifest = json.loads(z.read("sql_code_bundle/manifest.json"))
        chunks = json.loads(z.read("code_bundle/chunks.json"))
        depends = json.loads(z.read("code_bundle/dependencies.json"))
    assert nodes.splitlines()[0] == "key,kind,name,schema,file,batch,domain,body_path" and '"dbo.Customer|TABLE","TABLE"' in nodes
    assert [b["kind"] for b in bodies] == ["TABLE", "VIEW", "ENTITY", "MIGRATION", "InlineSQL"] or {b["kind"] for b in bodies} == {"TABLE", "VIEW", "ENTITY", "MIGRATION", "InlineSQL"}
    assert {"sql_code_bundle/docs/bodies/dbo.V.VIEW.sql", "code_bundle/README_WSL.txt", "repo_meta.json", "sql_code_bundle/docs/bodies/Migration.V1.MIGRATION.cs"} <= names
    assert manifest["counts"]["docs"] == 2 and len(graph["nodes"]) == len(nodes.splitlines()) - 1 == manifest["counts"]["nodes"] + 1
    ids = {c["member"]: c["id"] for c in chunks}
    assert depends[str(ids["Go"])] == [ids["Run"]]


def test_incremental_scripts(spark, tmp_path):
    rows = spark.sql("SELECT 'a' path, 'a.sql' rel_path, 'CREATE TABLE t (i INT)' text, timestamp'2024-01-01' seen")
    landing = str(tmp_path / "in")
    rows.write.parquet(landing)
    rows.write.mode("append").parquet(landing)
    for _ in range(2):
        incremental.index_scripts(spark, landing, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1

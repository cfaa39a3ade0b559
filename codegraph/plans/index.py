"""The whole run: scripts, models, migrations and embedded SQL into one closed graph, and the bundle on disk."""

from __future__ import annotations

import functools
import logging
import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import IndexerConfig, split_roots
from ..functions import parse
from ..operators import graph
from ..sources import bundle, repo, solution
from . import chunks as code
from . import ef, inline, migrations, sql

log = logging.getLogger(__name__)


@dataclass
class Graph:
    nodes: DataFrame
    every_edge: DataFrame
    script_bodies: DataFrame
    entity_bodies: DataFrame
    migration_bodies: DataFrame
    inline_bodies: DataFrame

    @functools.cached_property
    def edges(self) -> DataFrame:
        return graph.stored(self.every_edge)

    @functools.cached_property
    def closed(self) -> DataFrame:
        """Nodes with the tables that edges name, kept for who starts from them several times."""
        return graph.stored(self.closing(self.edges))

    def closing(self, edges: DataFrame | None = None) -> DataFrame:
        """The same as a relation, worked out as far as it is asked for."""
        return self.nodes.unionByName(graph.missing_tables(self.every_edge if edges is None else edges, self.nodes))


def build(batches: DataFrame, models: DataFrame, migration_syntax: DataFrame, inline_syntax: DataFrame, base_types: Sequence[str] = (), extra_hot: Sequence[str] = (), migration_files: DataFrame | None = None) -> Graph:
    """From parsed relations to the graph. Stages add in the order scripts, models, migrations, embedded SQL; the first
    node of a key wins. Only the scripts' edges are resolved and de-duplicated.

    `migration_files`: texts for the pattern fallback, used if no migration is recognised.
    """
    known = sql.knowledge(batches)
    edges = known.kept_edges
    mapping = graph.cut(ef.entity_map(models))
    sets, set_edges = ef.dbset_graph(models, mapping)
    tables = known.nodes.filter("kind = 'TABLE'").select("name", "schema", "seq")
    entities, entity_edges, entity_bodies = ef.entity_graph(models, mapping, tables, base_types)
    fluent, fluent_edges = ef.fluent_graph(models, mapping)
    found = graph.cut(migrations.analysed(migration_syntax))
    moves, move_edges = migrations.migration_graph(found)
    if migration_files is not None and not migrations.migration_classes(migration_syntax).take(1):
        moves, move_edges = migrations.fallback(migration_files)
    facts = graph.cut(inline.artifacts(inline_syntax, extra_hot))
    nodes = graph.stored(graph.upsert_nodes(known.nodes, sets, entities, fluent, moves, inline.method_nodes(facts)))
    for part in (set_edges, entity_edges, fluent_edges, move_edges, inline.method_edges(facts), inline.foreign_key_edges(facts)):
        edges = edges.unionByName(part)
    return Graph(nodes, edges, known.bodies, entity_bodies, migrations.summaries(found), inline.bodies(facts))


def run(spark: SparkSession, config: IndexerConfig, progress=None) -> str | None:
    """Read the configured roots, write a bundle and give its archive's path; None where no root is set."""
    say = progress or (lambda phase, n, total: spark.sparkContext.setJobDescription(f"{phase} {n}/{total}"))
    if config.mode == "skip":
        return None
    sql_root = config.sql_root or config.ef_root
    roots = split_roots(config.ef_root)
    say("parse", 1, 4)
    batches = parse.parse_tsql(repo.sql_files(spark, sql_root)).persist()
    model_roots = roots or (repo.discover_roots(spark, sql_root) if config.sql_root else [])
    models = parse.parse_csharp(repo.model_files(spark, model_roots)).persist()
    extra = split_roots(config.migrations_root)
    other = [r for r in extra if r.lower() not in {m.lower() for m in model_roots}]
    moved = (models.unionByName(parse.parse_csharp(repo.model_files(spark, other))) if other else models).persist()
    inlined = parse.parse_csharp(repo.inline_files(spark, split_roots(config.inline_sql_root))).persist()
    for rows in (batches, models, inlined):
        for r in parse_errors(rows).collect():
            log.warning("%s: %s", r.path, r.error)
    say("graph", 2, 4)
    built = build(batches, models, moved, inlined, config.entity_base_types, config.extra_hot_methods, repo.model_files(spark, [*model_roots, *other]))
    out = os.path.join(config.temp_root or config.out_root, "bundle")
    data = os.path.join(out, "sql_code_bundle")
    for folder in ("graph", "docs"):
        os.makedirs(os.path.join(data, folder), exist_ok=True)
    say("write", 3, 4)
    bundle.write_csv(built.closed, bundle.NODE_HEADER, os.path.join(data, "graph", "nodes.csv"), graph.NODE_ORDER)
    bundle.write_csv(built.edges, bundle.EDGE_HEADER, os.path.join(data, "graph", "edges.csv"), graph.EDGE_ORDER)
    bundle.write_graph_json(built.closed, built.edges, os.path.join(data, "graph", "graph.json"))
    bundle.write_bodies_jsonl([built.script_bodies.drop("body_path"), built.entity_bodies, built.migration_bodies, built.inline_bodies], os.path.join(data, "docs", "sql_bodies.jsonl"))
    bundle.write_body_files([built.script_bodies, built.entity_bodies, built.migration_bodies, built.inline_bodies], data)
    os.makedirs(os.path.join(data, "docs/bodies"), exist_ok=True)
    bundle.write_json(bundle.manifest(built.nodes, built.edges, built.script_bodies, sql_root, model_roots), os.path.join(data, "manifest.json"))
    state = solution.git_state(config.solution or model_roots[0] if model_roots else sql_root)
    syntax = models
    if config.solution:
        projects = solution.read_solution(spark, config.solution)
        folders = [os.path.dirname(r.project_path) for r in projects.collect()]
        syntax = code.with_projects(parse.parse_csharp(repo.model_files(spark, folders)), projects)
    syntax = syntax.persist()
    linked = code.code_graph(syntax, state["branch"], state["head_sha"])
    bundle.write_code(linked.chunks, code.adjacency(linked.links), state, os.path.join(out, "code_bundle"))
    bundle.write_json(state, os.path.join(out, "repo_meta.json"))
    say("archive", 4, 4)
    path = bundle.archive(out, state["branch"], config.out_root or None)
    for held in (batches, models, moved, inlined, syntax):
        held.unpersist()
    return path


def parse_errors(parsed: DataFrame, n: int = 2) -> DataFrame:
    """(path, error) of the first n files, by path, that couldn't be read whole."""
    return parsed.filter("error is not null").groupBy("path").agg(F.min("error").alias("error")).orderBy("path").limit(n)


def core_counts(spark: SparkSession, config: IndexerConfig) -> dict[str, int]:
    """Files, hashes, classes, methods and SQL definitions below the configured roots; hashing can be switched off."""
    roots = [*split_roots(config.ef_root), *split_roots(config.sql_root)]
    listed = repo.files(spark, roots, content=False, hashes=not config.skip_hashes)
    items = listed.agg(F.count("*").alias("files"), F.count("sha256").alias("hashes")).first()
    stats = code.statistics(parse.parse_csharp(repo.model_files(spark, split_roots(config.ef_root))).withColumn("project_name", F.lit(""))).first()
    found = sql.definition_artifacts(parse.parse_tsql(repo.sql_files(spark, config.sql_root or config.ef_root))).count()
    return {"files": items.files, "hashes": items.hashes, "classes": stats.class_count or 0, "methods": stats.method_count or 0, "definitions": found}


def counts(nodes: DataFrame, column: str) -> DataFrame:
    return nodes.groupBy(column).agg(F.count("*").alias("n"))

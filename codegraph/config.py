"""Configuration of an indexing run: JSON with comments, precedence of settings, roots and modes."""

from __future__ import annotations

import json
import os
import re
from dataclasses import dataclass, field

PATH_KEYS = ("solution", "tempRoot", "outRoot", "sqlRoot", "modelRoot", "migrationsRoot", "inlineSqlRoot")
#: Older names of the same settings.
ALIASES = {"sqlRoot": "sql", "modelRoot": "ef", "migrationsRoot": "migrations", "inlineSqlRoot": "inlineSql", "outRoot": "out"}
#: Further names on the command line, and names in the environment.
OPTIONS = {"tempRoot": ("temp-root",), "modelRoot": ("model",), "inlineSqlRoot": ("inline-sql",)}
VARIABLES = {"solution": "INDEXER_SOLUTION", "tempRoot": "INDEXER_TEMP_ROOT", "modelRoot": "EF_PATH", "migrationsRoot": "MIGRATIONS_PATH"}


def parse_args(argv: list[str]) -> dict[str, str]:
    """--k v, -k v, --flag (true) and k=v; keys without case, values without quotes around them."""
    out, i = {}, 0
    while i < len(argv):
        word = argv[i]
        if word.startswith("-"):
            name = word.lstrip("-")
            if "=" in name:
                name, value = name.split("=", 1)
            elif i + 1 < len(argv) and not argv[i + 1].startswith("-"):
                i += 1
                value = argv[i]
            else:
                value = "true"
            out[name.lower()] = value.strip('"')
        elif "=" in word:
            name, value = word.split("=", 1)
            out[name.lower()] = value.strip('"')
        i += 1
    return out


def load_jsonc(text: str) -> dict:
    """A JSON object with comments and trailing commas; {} for nothing."""
    bare = re.sub(r'("(?:\\.|[^"\\])*")|//[^\n]*|/\*.*?\*/', lambda m: m[1] or " ", text.lstrip("﻿"), flags=re.S)
    bare = re.sub(r'("(?:\\.|[^"\\])*")|,(?=\s*[}\]])', lambda m: m[1] or "", bare, flags=re.S)
    value = json.loads(bare) if bare.strip() else {}
    if not isinstance(value, dict):
        raise ValueError("the configuration is no JSON object")
    return value


def first_non_empty(*values: str | None) -> str:
    return next((v.strip() for v in values if v and v.strip()), "")


def split_roots(text: str | None) -> list[str]:
    """Several folders in one setting, between ; | or the platform's path separator."""
    return [p.strip() for p in re.split(rf"[;|{re.escape(os.pathsep)}]", text or "") if p.strip()]


def entity_base_types(config: dict | None) -> list[str]:
    """dbGraph.entityBaseTypes; anything malformed is none."""
    graph = (config or {}).get("dbGraph")
    listed = graph.get("entityBaseTypes") if isinstance(graph, dict) else None
    return [x.strip() for x in listed if isinstance(x, str) and x.strip()] if isinstance(listed, list) else []


def extra_hot_methods(config: dict | None) -> list[str]:
    inline = (config or {}).get("inlineSql")
    listed = inline.get("extraHotMethods") if isinstance(inline, dict) else None
    return [x.strip() for x in listed if isinstance(x, str) and x.strip()] if isinstance(listed, list) else []


@dataclass(frozen=True)
class IndexerConfig:
    solution: str = ""
    temp_root: str = ""
    out_root: str = ""
    sql_root: str = ""
    model_root: str = ""
    migrations_root: str = ""
    inline_sql_root: str = ""
    entity_base_types: tuple[str, ...] = field(default_factory=tuple)
    extra_hot_methods: tuple[str, ...] = field(default_factory=tuple)
    skip_hashes: bool = False

    @property
    def ef_root(self) -> str:
        """The model root, else the migrations', else the inline SQL's."""
        return first_non_empty(self.model_root, self.migrations_root, self.inline_sql_root)

    @property
    def mode(self) -> str:
        """sql+ef, sql, ef (whose root stands for both) or skip."""
        if self.sql_root:
            return "sql+ef" if self.ef_root else "sql"
        return "ef" if self.ef_root else "skip"

    @classmethod
    def load(cls, args: dict[str, str] | None = None, config: dict | None = None, base: str = "", env: dict[str, str] | None = None) -> IndexerConfig:
        """Command line before paths.* before root keys before environment; paths in a configuration are relative to its folder."""
        args, config, env = args or {}, config or {}, os.environ if env is None else env
        paths = config.get("paths") if isinstance(config.get("paths"), dict) else {}
        place = lambda v: v if not v or os.path.isabs(v) or not base else os.path.normpath(os.path.join(base, v))
        text = lambda d, k: d.get(k) if isinstance(d.get(k), str) else None
        found = {}
        for key in PATH_KEYS:
            alias = ALIASES.get(key, key)
            listed = first_non_empty(text(paths, key), text(paths, alias), text(config, key), text(config, alias))
            given = first_non_empty(*(args.get(name.lower()) for name in (key, alias, *OPTIONS.get(key, ()))))
            joined = ";".join(map(place, split_roots(listed))) if key == "inlineSqlRoot" else place(listed)
            found[key] = first_non_empty(given, joined, env.get(VARIABLES.get(key, f"INDEXER_{key.upper()}")))
        return cls(found["solution"], found["tempRoot"], found["outRoot"], found["sqlRoot"], found["modelRoot"], found["migrationsRoot"], found["inlineSqlRoot"], tuple(entity_base_types(config)), tuple(extra_hot_methods(config)), env.get("INDEXER_NOHASH") == "1")

"""Command line: python -m codegraph --config index.json [--solution S --temp-root T --sql R --model M --migrations G --inline-sql I --out O]."""

from __future__ import annotations

import os
import sys

from .config import IndexerConfig, load_jsonc, parse_args
from .progress import Heartbeat


def settings(argv: list[str]) -> IndexerConfig:
    """From the command line, and from the configuration file that --config names."""
    args = parse_args(argv)
    path = args.get("config", "")
    if not path:
        return IndexerConfig.load(args)
    with open(path, encoding="utf-8-sig") as f:
        return IndexerConfig.load(args, load_jsonc(f.read()), os.path.dirname(os.path.abspath(path)))


def main(argv: list[str]) -> int:
    config = settings(argv)
    missing = [name for name, value in (("--solution", config.solution), ("--temp-root", config.temp_root)) if not value]
    if missing:
        print(f"missing: {', '.join(missing)}", file=sys.stderr)
        return 2
    from pyspark.sql import SparkSession

    from .plans import index

    spark = SparkSession.builder.appName("codegraph").config("spark.cleaner.referenceTracking.cleanCheckpoints", "true").getOrCreate()
    for name, value in index.core_counts(spark, config).items():
        print(f"{name}: {value}")
    with Heartbeat(lambda line: print(line, flush=True)) as beat:
        path = index.run(spark, config, beat.report)
    print(path or "no root of scripts or code is set")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

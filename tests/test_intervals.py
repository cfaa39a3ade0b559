"""Lines and method spans: the interval index against brute force, and on one very large file."""

import random
import time

import pytest
from codegraph.operators import graph
from pyspark.sql import functions as F

SPAN = "path string, ord int, start_line int, end_line int, ns string, type string, method string"


def plain(line, spans, nearest):
    if line is None:
        return min(spans)[3] if nearest and spans else None
    far = [(0 if a <= line <= b else min(abs(line - a), abs(line - b)), o, m) for o, a, b, m in spans if nearest or a <= line <= b]
    return min(far)[2] if far else None


@pytest.mark.parametrize("seed", range(2))
def test_spans_by_brute_force(spark, seed):
    rng = random.Random(seed)
    spans = {f"p{p}": [(o, a := rng.randint(0, 9000 if p else 30), a + rng.choice([0, 0, 1, 5, 90, 400, 5000]), f"m{p}_{o}") for o in range(rng.randint(0, 40))] for p in range(12)}
    lines = [(f"p{p}", rng.choice([None, *(rng.randint(-3, 14_000 if p else 60) for _ in range(60))]), k) for k, p in enumerate(rng.randint(0, 12) for _ in range(1500))]
    s = spark.createDataFrame([(p, o, a, b, "N", "N.T", m) for p, rows in spans.items() for o, a, b, m in rows], SPAN)
    facts = spark.createDataFrame([*lines, *lines[:50]], "path string, line int, k int").withColumn("x.y", F.lit(1))
    for nearest, operator in ((False, graph.method_at_line), (True, graph.nearest_method)):
        found = operator(facts, s)
        assert found.columns == ["path", "line", "k", "x.y", "ns", "type", "method"]
        expected = [(k, plain(line, spans.get(p, []), nearest)) for p, line, k in [*lines, *lines[:50]]]
        assert sorted((r.k, r.method or "") for r in found.collect()) == sorted((k, m or "") for k, m in expected)


def test_one_file_with_many_lines_and_methods(spark):
    """100,000 facts and 100,000 methods in a file, and as many on a single line of another: no product of both."""
    n = 100_000
    k = F.col("id").cast("int")
    spans = spark.range(n).select(F.lit("big").alias("path"), k.alias("ord"), (k * 4).alias("start_line"), (k * 4 + 1).alias("end_line"), F.lit("N").alias("ns"), F.lit("T").alias("type"), F.concat(F.lit("m"), k).alias("method"))
    spans = spans.unionByName(spans.withColumn("path", F.lit("one")).withColumn("start_line", F.lit(1)).withColumn("end_line", F.lit(1)))
    lines = spark.range(n).select(F.lit("big").alias("path"), (k * 4 + 2 + k % 2).alias("line"), k.alias("k")).unionByName(spark.range(n).select(F.lit("one").alias("path"), F.lit(1).alias("line"), k.alias("k")))
    began = time.time()
    found = graph.nearest_method(lines, spans)
    wrong = found.filter(F.col("method") != F.when(F.col("path") == "one", "m0").otherwise(F.concat(F.lit("m"), F.least(F.col("k") + F.col("k") % 2, F.lit(n - 1)))))
    assert wrong.count() == 0 and found.filter("method is null").count() == 0
    assert graph.method_at_line(lines, spans).filter("method is not null").count() == n
    assert time.time() - began < 120

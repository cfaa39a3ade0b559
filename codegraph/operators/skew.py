"""Joins whose left side may have a third or more of its rows on one key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with more than one in so many rows is dealt out. There can't be more such keys than this, which bounds what is broadcast.
SHARE = 1000


def salted_join(rows: DataFrame, lookup: DataFrame, key: str, spread: Column, how: str = "left", share: int = SHARE, counts: DataFrame | None = None) -> DataFrame:
    """Rows joined to a lookup with one row a key. Rows of hot keys are dealt out by `spread`, one part for each `share`-th
    of all rows, and their lookup rows are repeated for each part, so that no task has more than its share of a key.

    Keys are counted first, by partial aggregation; at most `share` of them are hot, whatever the input. `counts`: rows of
    each key (key, n) where something smaller than the rows tells them."""
    if counts is None:
        counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    counts = counts.select(F.col(key).alias("__hot"), F.col("n").alias("__n"))
    total = counts.agg(F.sum("__n").alias("__all"))
    hot = counts.filter("__hot is not null").join(F.broadcast(total), F.col("__n") * share > F.col("__all")).select("__hot", F.ceil(F.col("__n") * share / F.col("__all")).cast("int").alias("__parts"))
    parts = F.broadcast(hot)
    dealt = rows.join(parts, F.col(key) == F.col("__hot"), "left").withColumn("__part", F.when(F.col("__parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(spread), F.col("__parts"))).cast("int")).drop("__hot", "__parts")
    copies = lookup.join(parts, F.col(key) == F.col("__hot"), "left").withColumn("__part", F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))).drop("__hot", "__parts")
    return dealt.join(copies.hint("merge"), [key, "__part"], how).drop("__part")

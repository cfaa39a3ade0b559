"""Dense numbers in an order over range partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import cut

ROW_BITS = 33  # of monotonically_increasing_id, below the partition's number


def dense_ids(rows: DataFrame, order: list, name: str = "id", first: int = 1) -> DataFrame:
    """The rows with numbers from `first` without gaps, in an order. Rows are sorted by ranges; only the size of each
    range goes through one task, and comes back as the number of rows in the ranges before."""
    ranged = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()))
    placed = ranged.withColumn("__range", F.shiftright("__at", ROW_BITS)).withColumn("__row", F.col("__at").bitwiseAND(F.lit((1 << ROW_BITS) - 1)))
    sizes = placed.groupBy("__range").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("__range", before.alias("__before"))
    return placed.join(F.broadcast(starts), "__range").withColumn(name, F.col("__before") + F.col("__row") + first).drop("__at", "__range", "__row", "__before")

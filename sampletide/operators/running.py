"""Running sums over a table in order: ordinals, counts and totals up to a row, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sampletide.session import materialise

# Rows that one task sorts.
PART_ROWS = 500_000


def running(rows: DataFrame, order: list[str], sums: dict[str, Column], part_rows: int = PART_ROWS) -> DataFrame:
    """`rows` and, per name of `sums`, the sum of the column over all rows up to this one, itself included. `order` names
    columns that no two rows share.

    Rows are cut into ranges of the order and written; a range's rows are summed in its task, and the totals of the ranges
    before it, one row a range, are added.
    """
    held = materialise(rows, "unordered")
    parts = max(1, -(-held.count() // part_rows))
    # The number of the range is written with its rows, as a second run might cut them elsewhere.
    cut = materialise(held.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "ordered")
    totals = cut.groupBy("_part").agg(*[F.sum(c).alias(f"_{name}") for name, c in sums.items()])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("_part", *[F.sum(f"_{name}").over(earlier).alias(f"_{name}") for name in sums])
    upto = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    named = {name: F.coalesce(F.col(f"_{name}"), F.lit(0)) + F.sum(c).over(upto) for name, c in sums.items()}
    return cut.join(F.broadcast(before), "_part").withColumns(named).select(*rows.columns, *sums)

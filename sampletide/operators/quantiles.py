"""Exact order statistics of groups of any size.

A buffer of all values of a group does not fit a task when the group is most of the table. Instead the interval in which the
wanted rank lies is narrowed: values are counted per bucket of the interval, the bucket that holds the rank is kept with
the least and greatest value found in it, and so on. Counts are partial aggregates, so what is shuffled and held is one
row per bucket, whatever the group. Intervals that hold few values are ranked value by value at the end.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sampletide.session import materialise

BUCKETS = 1024
# Values of an interval that are ranked one by one.
FEW = 50_000
# Greater than any binary exponent of a double, least included.
_SPAN = 1100


def _magnitude(value: Column) -> Column:
    """Sign and binary exponent as one number that never falls as the value rises; infinities and NaN beyond all others."""
    power = F.floor(F.log2(F.abs(value))) + _SPAN
    beyond = F.when(F.isnan(value), 3 * _SPAN).when(value == float("inf"), 2.5 * _SPAN).when(value == float("-inf"), -2.5 * _SPAN)
    return F.coalesce(beyond, F.when(value > 0, power).when(value < 0, -power).otherwise(0)).cast("int")


def _bucket(value: Column, lo: Column, hi: Column) -> Column:
    """Bucket of a value in [lo, hi]: by magnitude while the ends differ in it, else by equal widths. The ends lie in different
    buckets unless they are equal."""
    width = F.floor((value - lo) / (hi - lo) * BUCKETS).cast("int")
    return F.when(_magnitude(lo) != _magnitude(hi), _magnitude(value)).when(value == hi, BUCKETS).otherwise(F.least(width, F.lit(BUCKETS - 1)))


def _picked(counted: DataFrame, by: list[str]) -> DataFrame:
    """Of counted parts (rank, n, part), the one in which the rank lies, with the rank inside it."""
    upto = F.sum("n").over(Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, 0))
    return counted.withColumn("upto", upto).where((F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("n") <= F.col("rank"))).withColumn(
        "rank", F.col("rank") - F.col("upto") + F.col("n")).drop("upto")


def order_statistics(rows: DataFrame, group: list[str], value: str, ranks, few: int = FEW) -> DataFrame:
    """(group columns, which, value): for every group the value at each rank of `ranks(n)`, a list of columns over the number n
    of its values, counted from 0. NULLs are no values, NaN is the greatest. Null group columns are a group."""
    # One key at least: the whole table is a group too.
    named = [*group, None] if not group else group
    keys = [f"_g{i}" for i in range(len(named))]
    own = rows.select(*[(F.col(c) if c else F.lit(0)).alias(k) for c, k in zip(named, keys, strict=True)], F.col(value).cast("double").alias("v")).where("v is not null")
    wanted = ranks(F.col("n"))
    sized = own.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    asked = F.array(*[F.struct(F.lit(i).alias("which"), r.cast("long").alias("rank")) for i, r in enumerate(wanted)])
    state = materialise(sized.select("*", F.inline(asked)), "ranks")
    on = lambda a, b: reduce(Column.__and__, [a[k].eqNullSafe(b[k]) for k in keys])
    done = []

    def inside(held: DataFrame) -> DataFrame:
        found = own.join(held, on(own, held)).where((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
        return found.select(*[held[k] for k in keys], "which", "rank", "lo", "hi", "v")
    while True:
        done.append(state.where((F.col("n") <= few) | (F.col("lo") == F.col("hi"))))
        state = state.where((F.col("n") > few) & (F.col("lo") != F.col("hi")))
        if state.isEmpty():
            break
        counted = inside(state).groupBy(*keys, "which", "rank", _bucket(F.col("v"), F.col("lo"), F.col("hi")).alias("part")).agg(
            F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        state = materialise(_picked(counted, [*keys, "which"]).select(*keys, "n", "lo", "hi", "which", "rank"), "ranks")
    done = reduce(DataFrame.unionByName, done)
    out = [*[F.col(k).alias(c) for c, k in zip(named, keys, strict=True) if c], "which"]
    single = done.where("lo = hi").select(*out, F.col("lo").alias("value"))
    several = inside(done.where("lo <> hi")).groupBy(*keys, "which", "rank", F.col("v").alias("part")).agg(F.count(F.lit(1)).alias("n"))
    return single.unionByName(_picked(several, [*keys, "which"]).select(*out, F.col("part").alias("value")))


def median(rows: DataFrame, group: list[str], value: str, few: int = FEW) -> DataFrame:
    """(group columns, median): the middle value, or the mean of the two in the middle. Groups without values are left out."""
    middle = lambda n: [F.floor((n - 1) / 2), F.floor(n / 2)]
    found = order_statistics(rows, group, value, middle, few)
    low, high = (F.max(F.when(F.col("which") == i, F.col("value"))) for i in (0, 1))
    return found.groupBy(*group).agg(low.alias("_low"), high.alias("_high")).select(
        *group, F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(F.col("_low") / 2 + F.col("_high") / 2).alias("median"))

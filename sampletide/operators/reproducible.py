"""Sums of doubles that come out the same, bit for bit, under any partitioning.

Addition of doubles depends on its order. Here every value is split into an integer and a power of two, and integers are
added per bin of 32 powers as decimals, which is exact whatever the order and combines before the shuffle. A group has at
most 66 bins. They are carried into digits of 32 bits and put together from the highest down, so the result is within
one unit in the last place of the exact sum, however large the values and however much of them cancels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 32
_WHOLE = "decimal(38,0)"


def _scaled(value: Column, power: Column) -> Column:
    """value * 2 ** power in two steps, as one may leave the range of a double."""
    half = F.floor(power / 2)
    return value * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half)


def _digits(value: Column) -> tuple[Column, Column]:
    """Bin and integer of a finite value other than 0: value = integer * 2 ** (BITS * bin)."""
    # One bit more than the 52 of a double, so that a logarithm off by one still leaves a whole number.
    power = F.lit(53) - F.floor(F.log2(F.abs(value)))
    whole = _scaled(value, power).cast("bigint")
    bin_ = F.floor(-power / BITS).cast("int")
    shift = (-power - bin_ * BITS).cast("int")
    return bin_, whole.cast("decimal(19,0)") * F.call_function("shiftleft", F.lit(1).cast("bigint"), shift).cast("decimal(11,0)")


def _carried(low: Column, sums: Column) -> Column:
    """Digits, lowest first, of the sums of neighbouring bins: each from 0 to 2 ** BITS - 1, but for the last, which has the sign."""
    base = F.lit(1 << BITS).cast(_WHOLE)
    start = F.struct(F.lit(0).cast(_WHOLE).alias("over"), F.array().cast(f"array<{_WHOLE}>").alias("out"))

    def step(state, own):
        total = (state["over"] + own).cast(_WHOLE)
        digit = F.pmod(total, base).cast(_WHOLE)
        return F.struct(((total - digit) / base).cast(_WHOLE).alias("over"), F.concat(state["out"], F.array(digit)).alias("out"))
    return F.aggregate(sums, start, step, lambda s: F.concat(s["out"], F.array(s["over"])))


def sums(rows: DataFrame, group: list[str], values: dict[str, Column]) -> DataFrame:
    """The group columns and, per name of `values`, its sum and `<name>_n`, the number of its values.

    NULLs are no values; a sum of none is null. NaN, or infinities of both signs, give NaN; infinities of one sign give it.
    """
    keys = [f"_g{i}" for i in range(len(group))]
    pairs = F.array(*[F.struct(F.lit(name).alias("name"), v.cast("double").alias("v")) for name, v in values.items()])
    own = rows.select(*[F.col(c).alias(k) for c, k in zip(group, keys, strict=True)], F.inline(pairs))
    v = F.col("v")
    finite = ~F.isnan(v) & (F.abs(v) != float("inf"))
    bin_, whole = _digits(F.when(finite & (v != 0), v))
    binned = own.groupBy(*keys, "name", F.coalesce(bin_, F.lit(0)).alias("bin")).agg(
        F.sum(whole).cast(_WHOLE).alias("whole"), F.count("v").alias("n"), F.count_if(F.isnan(v)).alias("nans"),
        F.count_if(v == float("inf")).alias("tops"), F.count_if(v == float("-inf")).alias("bottoms"))
    # At most 66 bins a group and name.
    held = binned.groupBy(*keys, "name").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", F.coalesce("whole", F.lit(0).cast(_WHOLE))))).alias("bins"), F.min("bin").alias("low"),
        F.max("bin").alias("high"), *[F.sum(c).alias(c) for c in ("n", "nans", "tops", "bottoms")])
    every = F.transform(F.sequence("low", "high"), lambda b: F.coalesce(F.element_at("bins", b), F.lit(0).cast(_WHOLE)))
    digits = _carried(F.col("low"), every)
    place = F.struct(digits.alias("digits"), F.col("low").alias("low"))
    held = held.withColumn("_p", place)
    last = F.size("_p.digits")
    # From the highest digit down; a digit lost to rounding is below the last place of what is there.
    added = F.aggregate(F.sequence(last - 1, F.lit(0), F.lit(-1)), F.lit(0.0), lambda total, i: total + _scaled(
        F.get("_p.digits", i).cast("double"), (F.col("_p.low") + i) * BITS))
    total = (F.when(F.col("n") == 0, None).when((F.col("nans") > 0) | ((F.col("tops") > 0) & (F.col("bottoms") > 0)), float("nan"))
             .when(F.col("tops") > 0, float("inf")).when(F.col("bottoms") > 0, float("-inf")).otherwise(added))
    done = held.select(*keys, "name", total.alias("total"), "n")
    named = [F.max(F.when(F.col("name") == name, F.col(c))).alias(name + end) for name in values for c, end in (("total", ""), ("n", "_n"))]
    return done.groupBy(*keys).agg(*named).select(*[F.col(k).alias(c) for c, k in zip(group, keys, strict=True)], *[x for name in values for x in (name, f"{name}_n")])


def moments(rows: DataFrame, group: list[str], value: str) -> DataFrame:
    """The group columns, n, mean, rms and stddev (of the population) of a column, all reproducible."""
    x = F.col(value).cast("double")
    found = sums(rows, group, {"_sum": x, "_squares": x * x})
    n, mean, square = F.col("_sum_n"), F.col("_sum") / F.col("_sum_n"), F.col("_squares") / F.col("_sum_n")
    return found.select(*group, n.alias("n"), mean.alias("mean"), F.sqrt(square).alias("rms"), F.sqrt(F.greatest(square - mean * mean, F.lit(0.0))).alias("stddev"))

"""Join of ids with ranges of ids, of any width.

A range of the 128-bit id is cut into pieces at the digits where its ends part: at every prefix length a piece is what lies
in one prefix cell beyond the lower end, below the upper end, or between both. Ids carry their prefix of each length that
occurs, so the join is one of equal cells, and every pair of id and range is found by exactly one piece. A wide range is a
few pieces with short prefixes; cells that hold many ids are dealt over slots, to which their pieces are sent.

What is only counted or added up needs no pairs: `totals` takes the sums over all ids up to each end of a range from each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampletide.operators.running import PART_ROWS, running
from sampletide.session import materialise

# Prefix lengths of the id's text, four digits apart (with the dashes); the whole id last.
LENGTHS = (0, 4, 8, 13, 18, 23, 28, 32, 36)
# Greater than any character of an id: a prefix with it is greater than all ids of the prefix.
BEYOND = "g"
# Ids of a cell that one task should meet.
SLOT = 200_000


def pieces(ranges: DataFrame, lo: str = "lid_lo", hi: str = "lid_hi") -> DataFrame:
    """The columns of `ranges` with level, cell, above, below: ids of the cell, greater than `above` and less than `below`
    where these are given, lie in the range. Ranges with a null end or ends in wrong order have no pieces."""
    low, high = ([F.substring(c, 1, n) for n in LENGTHS] for c in (lo, hi))
    none = F.lit(None).cast("string")

    def piece(when: Column, level: int, cell: Column, above: Column, below: Column) -> Column:
        return F.when(when, F.struct(F.lit(level).alias("level"), cell.alias("cell"), above.alias("above"), below.alias("below")))
    made, last = [], len(LENGTHS) - 1
    for i in range(last):
        parted, deeper = low[i] != high[i], low[i + 1] != high[i + 1]
        made += [piece(~parted & deeper, i, low[i], F.concat(low[i + 1], F.lit(BEYOND)), high[i + 1]),
                 piece(parted, i, low[i], F.concat(low[i + 1], F.lit(BEYOND)), none), piece(parted, i, high[i], none, high[i + 1])]
    made += [piece(F.lit(True), last, F.col(lo), none, none), piece(F.col(lo) != F.col(hi), last, F.col(hi), none, none)]
    return ranges.where(F.col(lo) <= F.col(hi)).select("*", F.inline(F.filter(F.array(*made), lambda p: p.isNotNull())))


def within(records: DataFrame, ranges: DataFrame, lo: str = "lid_lo", hi: str = "lid_hi", most: int = SLOT) -> DataFrame:
    """`records` (lid and others) joined with every range that holds their id, ends included."""
    cut = materialise(pieces(ranges, lo, hi), "range-pieces").withColumnsRenamed({c: f"_{c}" for c in ("level", "cell", "above", "below")})
    # At most one row per prefix length.
    levels = sorted(r[0] for r in cut.select("_level").distinct().collect())
    cells = F.array(*[F.struct(F.lit(i).alias("level"), F.substring("lid", 1, LENGTHS[i]).alias("cell")) for i in levels])
    if not levels:
        return records.join(cut.drop("_level", "_cell", "_above", "_below"), F.lit(False))
    placed = records.withColumn("_in", F.explode(cells))
    counted = placed.groupBy(F.col("_in.level").alias("_level"), F.col("_in.cell").alias("_cell"))
    hot = materialise(counted.agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("_slots")).where("_slots > 1"), "hot-cells")
    if hot.isEmpty():
        placed, cut = placed.withColumn("_at", F.lit(0)), cut.withColumn("_slot", F.lit(0))
    else:
        last = F.coalesce(F.col("_slots") - 1, F.lit(0))
        cut = cut.join(hot, ["_level", "_cell"], "left").withColumn("_slot", F.explode(F.sequence(F.lit(0), last))).drop("_slots")
        own = hot.withColumnsRenamed({"_level": "_l", "_cell": "_c"})
        slot = F.coalesce(F.pmod(F.xxhash64(*records.columns), F.col("_slots")), F.lit(0)).cast("int")
        placed = placed.join(own, (F.col("_in.level") == F.col("_l")) & (F.col("_in.cell") == F.col("_c")), "left").withColumn("_at", slot).drop("_l", "_c", "_slots")
    held = ((F.col("_in.level") == F.col("_level")) & (F.col("_in.cell") == F.col("_cell")) & (F.col("_at") == F.col("_slot"))
            & (F.col("_above").isNull() | (F.col("lid") > F.col("_above"))) & (F.col("_below").isNull() | (F.col("lid") < F.col("_below"))))
    return placed.join(cut, held).drop("_in", "_at", "_slot", "_level", "_cell", "_above", "_below")


def totals(records: DataFrame, ranges: DataFrame, sums: dict[str, str], lo: str = "lid_lo", hi: str = "lid_hi", part_rows: int = PART_ROWS) -> DataFrame:
    """`ranges` that hold an id of `records` (lid and others), with `n_records` and per name of `sums` the sum of that whole-number
    column over the ids in the range: `within`, counted, without a row per pair of id and range.

    The work is one sort of ids and ends, whatever the ranges' widths and however they overlap.
    """
    exact = "decimal(38,0)"
    names = {"n_records": F.count(F.lit(1)), **{name: F.sum(F.col(c).cast(exact)) for name, c in sums.items()}}
    named = ranges.where(F.col(lo) <= F.col(hi))
    # A row per different id and end; an end that is no id adds nothing.
    held = records.where("lid is not null").groupBy("lid").agg(*[total.cast(exact).alias(n) for n, total in names.items()])
    none = [F.lit(None).cast(exact).alias(n) for n in names]
    ends = named.select(F.explode(F.array(lo, hi)).alias("lid")).distinct().select("lid", *none)
    own = held.unionByName(ends).groupBy("lid").agg(*[F.sum(n).alias(n) for n in names])
    own = own.select("lid", *[F.coalesce(n, F.lit(0).cast(exact)).alias(n) for n in names], *[F.col(n).isNotNull().cast("int").alias(f"has_{n}") for n in names])
    counted = {f"upto_{n}": F.col(n) for n in names} | {f"known_{n}": F.col(f"has_{n}") for n in names}
    upto = materialise(running(own, ["lid"], counted, part_rows), "upto")
    last = upto.select(F.col("lid").alias(hi), *[F.col(c).alias(f"_to_{c}") for c in counted])
    first = upto.select(F.col("lid").alias(lo), *[(F.col(f"upto_{n}") - F.col(n)).alias(f"_from_upto_{n}") for n in names],
                        *[(F.col(f"known_{n}") - F.col(f"has_{n}")).alias(f"_from_known_{n}") for n in names])
    # A sum of no values is null, as it is over the rows themselves.
    found = {n: F.when(F.col(f"_to_known_{n}") > F.col(f"_from_known_{n}"), F.col(f"_to_upto_{n}") - F.col(f"_from_upto_{n}")).cast("bigint") for n in names}
    return named.join(last, hi).join(first, lo).select(*[F.col(c) for c in ranges.columns], *[v.alias(n) for n, v in found.items()]).where("n_records > 0")

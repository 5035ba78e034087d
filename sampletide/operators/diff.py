"""Difference of two versions of a table, at a cost that follows the difference.

Rows are hashed into a tree of buckets by their key. The digests of LEAVES // WIDTH buckets are compared first, then those of the
leaves below the buckets that differ; only rows of leaves that differ are joined by key. What is shuffled is thus two small
tables of digests, and the rows that share a leaf with a difference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampletide.session import materialise

LEAVES, WIDTH = 1 << 24, 1 << 12


def _digests(rows: DataFrame, by: str) -> DataFrame:
    """Digest of the rows of each bucket: how many, and two sums of their hashes that do not depend on order."""
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("hash").cast("decimal(20,0)")).alias("total"), F.bit_xor("hash").alias("mix"))


def _differing(old: DataFrame, new: DataFrame, by: str) -> DataFrame:
    names = {c: f"_{c}" for c in ("n", "total", "mix")}
    both = _digests(old, by).join(_digests(new, by).withColumnsRenamed(names), by, "full")
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]
    return both.where(~(same[0] & same[1] & same[2])).select(by)


def changes(old: DataFrame, new: DataFrame, keys: list[str], leaves: int = LEAVES) -> DataFrame:
    """The key columns and change: 'inserted', 'deleted' or 'changed'. Columns are matched by name, those of one side alone are not
    compared. Null keys are keys. Rows that share a key are compared together: one change if their rows differ in any way."""
    shared = [c for c in old.columns if c in new.columns and c not in keys]

    def placed(rows: DataFrame) -> DataFrame:
        # A null is told from its column's place: hashing passes over nulls.
        told = [x for c in shared for x in (F.col(c).isNull(), F.col(c))]
        leaf = F.pmod(F.xxhash64(*[x for k in keys for x in (F.col(k).isNull(), F.col(k))]), F.lit(leaves))
        return rows.select(*keys, F.xxhash64(F.lit(17), *keys, *told).alias("hash"), leaf.alias("leaf"), F.floor(leaf / WIDTH).alias("bucket"))
    sides = [placed(old), placed(new)]
    buckets = materialise(_differing(*sides, "bucket"), "differing-buckets")
    # At most LEAVES // WIDTH rows.
    sides = [s.join(F.broadcast(buckets), "bucket", "left_semi") for s in sides]
    found = materialise(_differing(*sides, "leaf"), "differing-leaves")
    rows = [s.join(found, "leaf", "left_semi").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("hash").cast("decimal(20,0)")).alias("total"), F.bit_xor("hash").alias("mix")) for s in sides]
    named = rows[1].withColumnsRenamed({c: f"_{c}" for c in (*keys, "n", "total", "mix")})
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    both = rows[0].join(named, on, "full")
    change = (F.when(F.col("n").isNull(), "inserted").when(F.col("_n").isNull(), "deleted")
              .when((F.col("n") != F.col("_n")) | (F.col("total") != F.col("_total")) | (F.col("mix") != F.col("_mix")), "changed"))
    picked = [F.when(F.col("n").isNull(), F.col(f"_{k}")).otherwise(F.col(k)).alias(k) for k in keys]
    return both.select(*picked, change.alias("change")).where("change is not null")

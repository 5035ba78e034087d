"""Digests kept between runs: only files that are new or changed are hashed again.

The index is a table of (path, length, modified, sha256), appended to as files are hashed. A file whose path, length and time are in
the index keeps its digest. A share of the known files, another one in every run, is hashed all the same, which finds content
that changed without its time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampletide.session import exists, materialise
from sampletide.sources.files import hashed, listing

SCHEMA = "path string, length long, modified timestamp, sha256 string"


def digests(spark: SparkSession, path, index: str, glob: str = "*.parquet", again: float = 0.01) -> DataFrame:
    """(path, length, sha256, state) of every file below `path`. `state` is 'new' (not in the index as it is now), 'known', 'same'
    (hashed again and equal) or 'altered' (hashed again, and not what the index says)."""
    listed = listing(spark, path, glob)
    known = spark.read.schema(SCHEMA).parquet(index) if exists(spark, index) else spark.createDataFrame([], SCHEMA)
    # Two runs may have hashed one file: they found the same, or the later entry is as good.
    told = known.groupBy("path", "length", "modified").agg(F.max("sha256").alias("told"))
    joined = listed.join(told, ["path", "length", "modified"], "left")
    draw = F.pmod(F.xxhash64("path", F.lit(uuid.uuid4().hex)), F.lit(1_000_000)) < int(again * 1_000_000)
    marked = materialise(joined.withColumn("due", F.col("told").isNull() | draw), "digests-due")
    fresh = materialise(hashed(marked.where("due").select("path", "length")), "digests-fresh").select("path", F.col("sha256").alias("found"))
    state = (F.when(F.col("told").isNull(), "new").when(F.col("found").isNull(), "known").when(F.col("found") == F.col("told"), "same").otherwise("altered"))
    done = materialise(marked.join(fresh, "path", "left").withColumn("state", state).withColumn("sha256", F.coalesce("found", "told")), "digests-done")
    done.where("state = 'new'").select("path", "length", "modified", "sha256").write.mode("append").parquet(index)
    return done.select("path", "length", "sha256", "state")

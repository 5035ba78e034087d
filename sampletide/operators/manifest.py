"""Dataset manifest: rows, id bounds, digest and source digests of every dataset."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampletide.functions import lid
from sampletide.sources.registry import DATASETS

# The layer number of each layer name, as the id carries it.
LAYERS = {"bronze": 1, "silver": 2, "gold": 3}


def describe(name: str, rows: DataFrame, dim: DataFrame) -> DataFrame:
    """One row. A dataset with ids lists the digests of the files they came from, one without lists all.

    Rows are first reduced to one per source file (the id's file field), so the digest list is built from at
    most 65,535 values.
    """
    files = dim.select("ingest_ord", "sha256")
    if "lid" in rows.columns:
        per_file = rows.groupBy(lid.file("lid").alias("ingest_ord")).agg(
            F.count(F.lit(1)).alias("n"), F.min("lid").alias("lo"), F.max("lid").alias("hi"))
        joined = per_file.join(files, "ingest_ord", "left")
    else:
        counted = rows.agg(F.count(F.lit(1)).alias("n")).select(
            "n", F.lit(None).cast("string").alias("lo"), F.lit(None).cast("string").alias("hi"),
            F.lit(None).cast("string").alias("sha256"))
        listed = files.select(F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("string").alias("lo"),
                              F.lit(None).cast("string").alias("hi"), "sha256")
        joined = counted.unionByName(listed)
    return joined.agg(
        F.min("lo").alias("lid_lo"), F.max("hi").alias("lid_hi"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_records"),
        F.array_sort(F.collect_set("sha256")).alias("file_digests")).select(
            F.lit(name).alias("dataset"), F.lit(LAYERS[DATASETS[name].layer]).cast("tinyint").alias("layer"),
            "lid_lo", "lid_hi", "n_records", "file_digests")


def dataset_manifest(lake: dict[str, DataFrame], dim: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [describe(name, rows, dim) for name, rows in lake.items()])


def complete(manifest: DataFrame, versions: DataFrame, produced_at, commit: str) -> DataFrame:
    """With digest, time and commit, in contract order."""
    return (manifest.join(versions, "dataset")
            .withColumn("produced_at", F.lit(produced_at).cast("timestamp_ntz")).withColumn("git_commit", F.lit(commit))
            .select(*DATASETS["gold/dataset_manifest"].fields))

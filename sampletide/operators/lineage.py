"""Jobs over lineage ids: dimension, trace, ranges, audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampletide.functions import lid, values
from sampletide.operators import closure
from sampletide.operators.ingest import with_ingest_ord
from sampletide.sources.bounds import literal
from sampletide.sources.registry import EXPERIMENT_CODES


def experiment_codes(spark: SparkSession, codes: dict[str, int] = EXPERIMENT_CODES) -> DataFrame:
    return literal(spark, [(c, e) for e, c in codes.items()], "code int, experiment string")


def edges(spark: SparkSession) -> DataFrame:
    """Multi-parent edges of a new lake: none, with the schema that readers rely on. `origins` follows them."""
    return spark.createDataFrame([], "child_lid string, parent_lid string")


def file_dim(audit: DataFrame) -> DataFrame:
    """One row per ingested file: ordinal, source path, digest, time. Needs the audit alone."""
    return with_ingest_ord(audit).select(
        "ingest_ord", "ingest_id", values.source_path(F.col("data_root"), F.col("source_path_rel")).alias("source_path"),
        "source_url", "sha256", lid.epoch_ms("ingested_at").alias("ts_ms"))


def lineage_dim(audit: DataFrame, recording: DataFrame) -> DataFrame:
    """The file dimension with each file's experiment, which the Bronze partition of its ingest carries."""
    held = recording.select("experiment", "ingest_id").distinct()
    return file_dim(audit).join(held, "ingest_id", "left").select(
        "ingest_ord", "ingest_id", "source_path", "source_url", "sha256", "ts_ms", "experiment")


def trace(ids: DataFrame, dim: DataFrame, codes: DataFrame) -> DataFrame:
    """Source file of every id, with the fields the id carries. An id whose time is not its file's is no trace of it."""
    decoded = ids.select("lid", lid.decode("lid").alias("f"))
    files = dim.select("ingest_ord", "source_path", "source_url", "sha256", F.col("ts_ms").alias("_ts"))
    return (decoded.join(files, (F.col("f.file") == F.col("ingest_ord")) & (F.col("f.ts_ms") == F.col("_ts")))
            .join(codes, F.col("f.experiment") == F.col("code"))
            .select("lid", "source_path", "source_url", "sha256", F.col("f.ts_ms").alias("ts_ms"),
                    F.col("f.layer").alias("layer"), "experiment", F.col("f.run").alias("run"),
                    F.col("f.channel").alias("channel"), F.col("f.segment").alias("segment")))


def origins(ids: DataFrame, parents: DataFrame, dim: DataFrame, codes: DataFrame) -> DataFrame:
    """(lid, source_path, sha256): every source file an id was made from, over edges (child_lid, parent_lid) of any depth to ids
    without a parent, and through these to their files. An id without a parent has the file of its own fields."""
    own = ids.select("lid").distinct()
    alone = own.join(parents.select(F.col("child_lid").alias("lid")).distinct(), "lid", "left_anti").select("lid", F.col("lid").alias("root_lid"))
    found = closure.roots(parents, own).select("lid", "root_lid").unionByName(alone)
    traced = trace(found.select(F.col("root_lid").alias("lid")).distinct(), dim, codes).select(F.col("lid").alias("root_lid"), "source_path", "sha256")
    return found.join(traced, "root_lid").select("lid", "source_path", "sha256").distinct()


def prefix_bounds(dim: DataFrame, codes: DataFrame, layer: int = 2) -> DataFrame:
    """Lowest and highest id any record of a file can carry in `layer`."""
    coded = dim.join(codes, "experiment")
    first = lid.mint_text("ts_ms", layer, "code", "ingest_ord", 0, 0, 0, 0)
    last = lid.mint_text("ts_ms", layer, "code", "ingest_ord", 15, 1023, 1023, 1, reserved=lid.RESERVED_LOW)
    return coded.select("ingest_ord", "ingest_id", first.alias("lid_lo"), last.alias("lid_hi"))


def children(records: DataFrame, bounds: DataFrame) -> DataFrame:
    """Records of many files at once: equality on the file field narrows the range test."""
    files = bounds
    inside = (lid.file("lid") == F.col("ingest_ord")) & F.col("lid").between(F.col("lid_lo"), F.col("lid_hi"))
    return records.join(files, inside).drop("lid_lo", "lid_hi")


def children_of(records: DataFrame, lid_lo: str, lid_hi: str) -> DataFrame:
    """Records of one file: a literal range Parquet can prune row groups by."""
    return records.where(F.col("lid").between(lid_lo, lid_hi))


def layer_audit(rows: DataFrame, expected: int) -> DataFrame:
    wrong = lid.layer("lid") != expected
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(wrong).alias("wrong_layer"))


def file_consistency(rows: DataFrame, dim: DataFrame) -> DataFrame:
    """Per file field found in the ids: rows, and whether the dimension knows it with the same time."""
    found = rows.groupBy(lid.file("lid").alias("file"), lid.ts_ms("lid").alias("id_ts_ms")).agg(
        F.count(F.lit(1)).alias("n_rows"))
    return (found.join(dim.select("ingest_ord", "ts_ms"),
                       F.col("file") == F.col("ingest_ord"), "left")
            .select("file", "n_rows", F.when(F.col("ts_ms") == F.col("id_ts_ms"), 1).otherwise(0).alias("agrees")))


def canary_by_subject(rows: DataFrame, subject: str) -> DataFrame:
    bit = F.when(lid.is_canary("lid"), 1).otherwise(0)
    return rows.groupBy(subject).agg(F.min(bit).alias("min_bit"), F.max(bit).alias("max_bit"))


def canaries(records: DataFrame) -> DataFrame:
    return records.where(lid.is_canary("lid"))


def without_parent(rows: DataFrame, above: DataFrame) -> DataFrame:
    """Ids of `rows` whose parent id does not occur one layer up."""
    ids = rows.select("lid").distinct().withColumn("parent_lid", lid.parent("lid"))
    return ids.join(above.select(F.col("lid").alias("parent_lid")).distinct(), "parent_lid", "left_anti")


def without_samples(records: DataFrame, samples: DataFrame) -> DataFrame:
    return records.join(samples.select("lid").distinct(), "lid", "left_anti")

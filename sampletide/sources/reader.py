"""Reading datasets of a lake."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from sampletide.sources.registry import DATASETS, Dataset


def committed(rows: DataFrame, audit: DataFrame) -> DataFrame:
    """Rows of ingests the audit names. An ingest that failed before its audit row stays invisible."""
    return rows.join(audit.select("ingest_id"), "ingest_id", "left_semi")


def read_files(spark: SparkSession, dataset: Dataset, path: str) -> DataFrame:
    """Files of one dataset with the declared schema, partition values as text; empty when there is none."""
    reader = spark.read.schema(dataset.schema)
    if dataset.evolves:
        reader = reader.option("mergeSchema", "true")
    try:
        return reader.parquet(path).select(*dataset.fields)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], dataset.schema)


def dataset(spark: SparkSession, root: str, name: str) -> DataFrame:
    """`layer/name` of the lake at `root`, in contract column order, committed ingests only."""
    described = DATASETS[name]
    rows = read_files(spark, described, f"{root}/{name}")
    if described.committed:
        rows = committed(rows, dataset(spark, root, "bronze/ingest_audit")).select(*described.fields)
    return rows


def read_plain(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Files of a dataset without reordering columns, so that `_metadata` stays reachable."""
    return spark.read.schema(DATASETS[name].schema).parquet(f"{root}/{name}")


def register_views(spark: SparkSession, root: str) -> None:
    """A temp view per dataset: `silver/recording` is `silver_recording`."""
    for name, described in DATASETS.items():
        dataset(spark, root, name).createOrReplaceTempView(described.view)

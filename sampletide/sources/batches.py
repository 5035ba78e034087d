"""Appends that can be repeated: a batch counts once, however often it is written.

Data of an attempt lie in a folder of their own, `data/attempt=<id>`; the batch is committed by a marker in `commits`
that names the attempt and is moved into place whole, which fails if the batch has one already. Readers take attempts
with a marker only. A crash before the marker leaves an attempt nobody reads, a repeated call finds the marker and writes
nothing, and of two writers at once the first marker counts. This is what `foreachBatch` asks of a sink.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sampletide.session import exists
from sampletide.sources.writer import clustered

ATTEMPT = "attempt"


def _marker(path: str, batch: str) -> str:
    return f"{path.rstrip('/')}/commits/{quote(batch, safe='')}"


def write_attempt(rows: DataFrame, path: str, *partitions: str) -> str:
    """The data of one attempt, not committed yet; returns its name."""
    attempt = uuid.uuid4().hex
    clustered(rows, *partitions).write.partitionBy(*partitions).parquet(f"{path.rstrip('/')}/data/{ATTEMPT}={attempt}")
    return attempt


def commit(spark: SparkSession, path: str, batch: str, attempt: str) -> bool:
    """Make an attempt the one of its batch; False if the batch has one."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    marker = jvm.org.apache.hadoop.fs.Path(_marker(path, batch))
    trial = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/commits/.{uuid.uuid4().hex}")
    files = marker.getFileSystem(conf)
    out = files.create(trial, False)
    out.write(bytearray(attempt.encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        # Unlike a file system's plain rename, this one never replaces a file.
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(marker.toUri(), conf).rename(trial, marker, options)
        return True
    except Py4JJavaError:
        if not exists(spark, _marker(path, batch)):
            raise
        files.delete(trial, False)
        return False


def append(rows: DataFrame, path: str, batch: str, *partitions: str) -> bool:
    """Append `rows` as `batch`, once; False if the batch was committed before, now or by another writer."""
    spark = rows.sparkSession
    if exists(spark, _marker(path, batch)):
        return False
    return commit(spark, path, batch, write_attempt(rows, path, *partitions))


def _attempts(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema("value string").text(f"{path.rstrip('/')}/commits").select(F.col("value").alias(ATTEMPT))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{ATTEMPT} string")


def _data(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    with_attempt = T.StructType([*schema.fields, T.StructField(ATTEMPT, T.StringType())])
    try:
        return spark.read.schema(with_attempt).parquet(f"{path.rstrip('/')}/data")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], with_attempt)


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of committed batches. The attempt is a partition of the folder, so the join prunes what is not committed."""
    return _data(spark, path, schema).join(_attempts(spark, path), ATTEMPT, "left_semi").select(*schema.names)


def abandoned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(attempt, n_rows) of attempts without a commit: crashed, lost a race, or still being written."""
    rest = _data(spark, path, schema).join(_attempts(spark, path), ATTEMPT, "left_anti")
    return rest.groupBy(ATTEMPT).agg(F.count(F.lit(1)).alias("n_rows"))

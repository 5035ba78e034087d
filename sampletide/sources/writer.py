"""Writing datasets: append, overwrite, and the sorted layout of the sample table."""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampletide.session import materialise, scratch
from sampletide.sources.files import listing
from sampletide.sources.registry import DATASETS

# Most rows per row group the layout check accepts, rows written per group, rows per file.
MAX_ROWS_PER_GROUP = 200_000
ROWS_PER_GROUP = 198_656
ROWS_PER_FILE = 20_000_000
DELTA_COLUMNS = ("sample_idx", "ts_ms")
# Bytes at rest and rows that one task sorts and writes. Sorted ids and numbers that rise take a few bytes a row at rest and some 200
# in a sort, so bytes alone do not bound a task's memory.
RANGE_BYTES = 128 * 1024**2
RANGE_ROWS = 1_000_000


def clustered(rows: DataFrame, *partitions: str) -> DataFrame:
    """Rows gathered by partition value, so that a task writes few partitions instead of a file in each. Other
    columns take part in the ranges, which cuts a hot partition into several tasks."""
    spread = [c for c in ("lid", "sample_idx", "ts_ms", "check_id") if c in rows.columns and c not in partitions]
    return rows.repartitionByRange(*partitions, *spread) if partitions else rows


def append(rows: DataFrame, path: str, *partitions: str) -> None:
    clustered(rows, *partitions).write.mode("append").partitionBy(*partitions).parquet(path)


def overwrite(rows: DataFrame, path: str, *partitions: str, only_touched: bool = False) -> None:
    """Replace a dataset, or only the partitions present in `rows`."""
    mode = "dynamic" if only_touched else "static"
    (clustered(rows, *partitions).write.mode("overwrite").option("partitionOverwriteMode", mode)
     .partitionBy(*partitions).parquet(path))


def write_dataset(rows: DataFrame, root: str, name: str, mode: str = "append") -> None:
    described = DATASETS[name]
    writer = append if mode == "append" else overwrite
    writer(rows.select(*described.fields), f"{root}/{name}", *described.partitions)


def written_aside(rows: DataFrame, name: str) -> tuple[DataFrame, int]:
    """The rows as a table in scratch, and its bytes."""
    path = scratch(rows.sparkSession, name)
    rows.write.parquet(path)
    held = listing(rows.sparkSession, path, "*.parquet").agg({"length": "sum"}).first()[0] or 0
    return rows.sparkSession.read.schema(rows.schema).parquet(path), held


@contextmanager
def _kept_sort_order(spark: SparkSession):
    """The planned partitioned write may re-sort by partition alone and lose the order inside files."""
    key = "spark.sql.optimizer.plannedWrite.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _by_group_size(rows: DataFrame, partitions, groups: int, most: int) -> list[tuple[DataFrame, int, int]]:
    """(rows, their number, rows per group): partitions of like size together, so that a file of each has `groups` row groups
    at least and, up to `most` rows a group, some four times as many at most. Sizes are powers of four: a dozen parts."""
    size = F.pow(F.lit(4.0), F.floor(F.log(4.0, F.col("n") / groups))).cast("bigint")
    counted = rows.groupBy(*partitions).agg(F.count(F.lit(1)).alias("n"))
    sized = materialise(counted.withColumn("size", F.greatest(F.lit(1), F.least(F.lit(most), size))), "group-sizes")
    parts = []
    for r in sized.groupBy("size").agg(F.sum("n").alias("n")).orderBy("size").collect():
        mine = sized.where(F.col("size") == r["size"])
        same = reduce(lambda x, y: x & y, [rows[c].eqNullSafe(mine[c]) for c in partitions])
        parts.append((rows.join(mine, same, "left_semi"), r["n"], r["size"]))
    return parts or [(rows, 0, most)]


def layout_write(rows: DataFrame, path: str, partitions=("experiment", "subject_pid"), order=("lid", "sample_idx"),
                 ranges: int | None = None, split_by=None, codec: str = "snappy", version: str = "v2",
                 rows_per_group: int = ROWS_PER_GROUP, rows_per_file: int = ROWS_PER_FILE, groups_per_file: int | None = None) -> None:
    """Partitioned files, each sorted by `order`, row groups bounded by rows.

    Range partitioning on partition and sort columns together cuts a hot partition into many tasks and files
    with disjoint key ranges, so no task holds a whole subject and id ranges still prune files. Range bounds need a
    sample of the rows, so derived rows are written to scratch first rather than derived twice; the number of ranges
    follows the bytes and rows of that table unless it is given. `split_by` names other range columns, for small tables.
    With `groups_per_file` a partition is one file of so many row groups at least, their size following its rows up to
    `rows_per_group`.
    """
    keys = [*partitions, *order]
    rows, held = written_aside(rows, "layout")
    total = rows.count()
    parts = _by_group_size(rows, partitions, groups_per_file, rows_per_group) if groups_per_file else [(rows, total, rows_per_group)]
    if groups_per_file:
        split_by = partitions
    for i, (part, n, group) in enumerate(parts):
        cut = ranges or max(1, -(-held * n // max(1, total * RANGE_BYTES)), -(-n // RANGE_ROWS))
        split = part.repartitionByRange(cut, *(split_by or keys))
        writer = (split.sortWithinPartitions(*keys).write.mode("append" if i else "overwrite")
                  .option("compression", codec)
                  .option("parquet.block.row.count.limit", group)
                  .option("maxRecordsPerFile", rows_per_file)
                  .option("parquet.writer.version", version))
        if version == "v2":
            # Without a dictionary the v2 writer stores steadily rising integers as deltas.
            for column in DELTA_COLUMNS:
                writer = writer.option(f"parquet.enable.dictionary#{column}", "false")
        with _kept_sort_order(rows.sparkSession):
            writer.partitionBy(*partitions).parquet(path)

"""Layout analysis: footer reports, exact sums, point lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sampletide.functions import lid
from sampletide.session import materialise
from sampletide.sources import files, writer

# Prefix lengths of an id's text, four hex digits apart, and ids that may be sorted in one task.
PREFIXES = (4, 8, 13, 18, 23, 28, 32, 36)
FEW = 100_000


def encoding_cells(footers: DataFrame, columns=("ts_ms", "sample_idx", "value_uv")) -> DataFrame:
    """Row groups, and packed bytes and encodings of the named columns, one row."""
    named = lambda c, x: F.when(F.col("column_name") == c, F.col(x))
    groups = F.count_if(F.col("column_name") == columns[0]).alias("row_groups")
    cells = [cell for c in columns for cell in (
        F.sum(named(c, "packed_bytes")).alias(f"{c}_bytes"),
        F.array_join(F.array_sort(F.collect_set(named(c, "encodings"))), ", ").alias(f"{c}_encodings"))]
    return footers.agg(groups, *cells)


def exact_sum(rows: DataFrame, value: str = "value_uv") -> DataFrame:
    """Row count and a sum that does not depend on the order of addition. Through DOUBLE: a FLOAT cast straight
    to DECIMAL is rounded in single precision by some engines."""
    exact = F.col(value).cast("double").cast("decimal(38,6)")
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(exact).cast("decimal(38,6)").alias("total"))


def layout_variants(spark: SparkSession, rows: DataFrame, path: str, variants) -> DataFrame:
    """Write `rows` once per (version, codec, rows per group) and report cells and content of each."""
    reports = None
    for version, codec, group in variants:
        target = f"{path}/{version}-{codec}-{group}"
        writer.layout_write(rows, target, version=version, codec=codec, rows_per_group=group)
        cells = encoding_cells(files.footers(spark, target))
        content = exact_sum(spark.read.schema(rows.schema).parquet(target))
        report = cells.select(F.lit(version).alias("version"), F.lit(codec).alias("codec"),
                              F.lit(group).alias("rows_per_group"), "*",
                              content.select("n_rows").scalar().alias("n_rows"),
                              content.select("total").scalar().alias("total"))
        reports = report if reports is None else reports.unionByName(report)
    return reports


def channel_aggregate(samples: DataFrame) -> DataFrame:
    return samples.groupBy("channel_idx").agg(F.avg("value_uv").alias("mean_uv"), F.count(F.lit(1)).alias("n_samples"))


def middle_id(ids: DataFrame, few: int = FEW) -> str | None:
    """The id in the middle of all different ids of `ids` (lid) in order; None without any.

    Found from counts per prefix, four hex digits longer at each step, so a step has at most 65,536 groups; what is left is
    ranked once it is few. No task sees all ids, and only a few numbers reach the driver.
    """
    held = materialise(ids.select("lid").where("lid is not null").distinct(), "ids")
    n, first, last = held.agg(F.count(F.lit(1)), F.min("lid"), F.max("lid")).first()
    place = n // 2
    for length in PREFIXES:
        if n <= few:
            break
        if first[:length] == last[:length]:
            continue
        counted = held.groupBy(F.substring("lid", 1, length).alias("prefix")).agg(
            F.count(F.lit(1)).alias("n"), F.min("lid").alias("first"), F.max("lid").alias("last"))
        upto = counted.withColumn("upto", F.sum("n").over(Window.orderBy("prefix")))
        prefix, n, first, last, before = upto.where(F.col("upto") > place).orderBy("prefix").select(
            "prefix", "n", "first", "last", F.col("upto") - F.col("n")).first()
        place -= before
        held = held.where(F.col("lid").between(first, last))
    found = held.orderBy("lid").offset(place).limit(1).first()
    return found["lid"] if found else None


def record_read(samples: DataFrame, wanted: str) -> DataFrame:
    """Rows and mean of one record: a literal equality, so that file statistics leave out all row groups without the id."""
    return samples.where(F.col("lid") == wanted).groupBy("lid").agg(F.count(F.lit(1)).alias("n_samples"), F.avg("value_uv").alias("mean_uv"))


def middle_record(samples: DataFrame) -> DataFrame:
    """Rows and mean of the record in the middle of all ids in order: its id from the ids alone, its rows by a pruned read."""
    return record_read(samples, middle_id(samples) or "")


def smallest_partition(samples: DataFrame, records: DataFrame) -> DataFrame:
    """The experiment and subject with the fewest samples among those without canaries."""
    kept = records.where(~lid.is_canary("lid")).select("experiment", "subject_pid").distinct()
    counted = samples.groupBy("experiment", "subject_pid").agg(F.count(F.lit(1)).alias("n_samples"))
    return (counted.join(kept, ["experiment", "subject_pid"], "left_semi")
            .orderBy("n_samples", "experiment", "subject_pid").limit(1))


def channel_in_list(records: DataFrame, channels) -> DataFrame:
    """Rows whose channel is in the list: one set membership, however long the list."""
    return records.where(F.col("channel_idx").isin([int(c) for c in channels])).agg(F.count(F.lit(1)).alias("n"))

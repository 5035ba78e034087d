"""Bronze to Silver: typed, scaled, pseudonymised.

Key map and audit have a row per source file at most and are joined plainly, so the planner broadcasts them while they are small;
the sample table is then not shuffled to be typed. The Silver id is the Bronze id one layer down, so no join against the record
table is needed to find it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampletide.functions import lid, values
from sampletide.operators.pseudonym import replace_code
from sampletide.sources.bounds import literal
from sampletide.sources.registry import DATASETS, UNIT_SCALE


def unit_scale(spark: SparkSession, scale: dict = UNIT_SCALE) -> DataFrame:
    rows = [(e, float(u), basis) for e, (u, basis) in scale.items()]
    return literal(spark, rows, "experiment string, uv_per_unit float, scale_basis string")


def _fields(rows: DataFrame, name: str) -> DataFrame:
    return rows.select(*DATASETS[name].fields)


def _down(rows: DataFrame) -> DataFrame:
    return rows.withColumn("lid", lid.relayer("lid", 1))


def subject(recording: DataFrame, key_map: DataFrame) -> DataFrame:
    held = recording.select("subject_src").distinct()
    return key_map.join(held, "subject_src", "left_semi").select(
        "subject_pid", F.col("created_at").alias("first_seen_at"))


def record(recording: DataFrame, key_map: DataFrame, scale: DataFrame) -> DataFrame:
    """One row per record; its count includes missing samples. Names are joined after the aggregate."""
    keys = ["lid", "experiment", "subject_src", "run", "channel_idx"]
    counted = recording.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_samples_src"))
    named = replace_code(counted, key_map).join(scale.drop("uv_per_unit"), "experiment")
    return _fields(_down(named), "silver/record")


def recording(bronze: DataFrame, key_map: DataFrame, audit: DataFrame, scale: DataFrame) -> DataFrame:
    """Present samples in microvolts and milliseconds, by three joins with tables of a row per file or experiment."""
    rates = audit.select("ingest_id", "sample_rate_hz")
    present = bronze.where(F.col("value_raw").isNotNull() & ~F.isnan("value_raw"))
    joined = replace_code(present.join(rates, "ingest_id"), key_map).join(scale, "experiment")
    typed = joined.select(
        "experiment", "subject_pid", "run", "channel_idx",
        values.sample_time_ms(F.col("sample_idx"), F.col("sample_rate_hz")).alias("ts_ms"),
        values.to_microvolt(F.col("value_raw"), F.col("uv_per_unit")).alias("value_uv"), "lid", "sample_idx")
    return _fields(_down(typed), "silver/recording")


def electrode(bronze: DataFrame, key_map: DataFrame) -> DataFrame:
    return _fields(_down(replace_code(bronze, key_map)), "silver/electrode")


def event(bronze: DataFrame, key_map: DataFrame, audit: DataFrame) -> DataFrame:
    rates = audit.select("ingest_id", "sample_rate_hz")
    timed = bronze.join(rates, "ingest_id").withColumn(
        "ts_ms", values.sample_time_ms(F.col("sample_idx"), F.col("sample_rate_hz")))
    return _fields(_down(replace_code(timed, key_map)), "silver/event")

"""From source tables to Bronze."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sampletide.functions import lid, values


def wide_to_long(wide: DataFrame, samples: str, *keep: str) -> DataFrame:
    """One row per channel of every sample array: the position is the channel. No shuffle."""
    return wide.select(*keep, F.posexplode(samples).alias("position", "value_raw")).select(
        *keep, F.col("position").cast("smallint").alias("channel_idx"), F.col("value_raw").cast("float"))


def onsets(codes: DataFrame, run: list[str], index: str = "sample_idx", code: str = "event_code",
           block: int = 1 << 20) -> DataFrame:
    """Rows whose code is set and differs from the sample before; the first sample of a run follows 0.

    `index` is the position in the run's cue array; absent positions are passed over. A run may be any share of the
    table: it is cut into blocks of the index, so no task holds a run. Each block's last row, one per block, is carried
    to the next block that has rows, and stands before its first.
    """
    home = F.floor(F.col(index).cast("bigint") / F.lit(block)).cast("bigint")
    cut = codes.withColumn("_block", home)
    ends = cut.groupBy(*run, "_block").agg(F.max(F.struct(index, code)).alias("_end"))
    carried = ends.select(*run, "_block", F.lag("_end").over(Window.partitionBy(*run).orderBy("_block")).alias("_carried"))
    inside = F.lag(F.struct(code)).over(Window.partitionBy(*run, "_block").orderBy(index))
    before = (F.when(F.col("_inside").isNotNull(), F.col("_inside")[code])
              .when(F.col("_carried").isNotNull(), F.col("_carried")[code]).otherwise(0))
    return (cut.withColumn("_inside", inside).join(carried, [*run, "_block"]).withColumn("_before", before)
            .where((F.col(code) != 0) & (F.col(code) != F.col("_before")))
            .drop("_block", "_inside", "_carried", "_before").select(*codes.columns))


def with_labels(events: DataFrame, labels: DataFrame) -> DataFrame:
    """Label of each code; a code without one keeps its row and a NULL label. A code is a 16-bit number."""
    return events.join(labels, "event_code", "left")


def sentinel_to_zero(code: Column, sentinel: int) -> Column:
    return F.when(code == sentinel, F.lit(0)).otherwise(code).cast("smallint")


def lookup(code: Column, table: dict[int, str]) -> Column:
    """Text of a code from a small fixed table, NULL outside it."""
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), code.cast("int"))


def range_label(code: Column, ranges: list[tuple[int, int, str]]) -> Column:
    """Text of the inclusive code range, NULL outside every range."""
    chosen = F.lit(None).cast("string")
    for low, high, label in reversed(ranges):
        chosen = F.when(code.between(low, high), F.lit(label)).otherwise(chosen)
    return chosen


def new_sources(offered: DataFrame, audit: DataFrame) -> DataFrame:
    """Sources whose digest the audit does not hold, each digest once. Makes a rerun a no-op."""
    fresh = offered.join(audit.select("sha256"), "sha256", "left_anti")
    return (fresh.groupBy("sha256").agg(F.min_by(F.struct(*[c for c in fresh.columns if c != "sha256"]), "source_path_rel")
                                        .alias("s")).select("sha256", "s.*"))


def with_ingest_ord(audit: DataFrame) -> DataFrame:
    """Position of each file in the append-only audit: the one its row stores, which later batches never change.

    A first batch that has none yet is numbered in order of time and digest.

    The id has 16 bits for it, so the numbered table has at most 65,535 rows and one task numbers them; one
    more fails the job.
    """
    if "ingest_ord" in audit.columns:
        return audit
    number = F.row_number().over(Window.orderBy("ingested_at", "sha256"))
    message = F.lit(f"the lineage id has room for {lid.MAX_FILES} files")
    return audit.withColumn("ingest_ord", F.when(number <= lid.MAX_FILES, number)
                            .otherwise(F.raise_error(message).cast("int")))


def batch_ord(batch: DataFrame, audit: DataFrame) -> DataFrame:
    """Ordinals of a new batch: they continue after the highest the audit stores, whatever the batch's times are."""
    last = with_ingest_ord(audit).agg(F.coalesce(F.max("ingest_ord"), F.lit(0))).scalar()
    fresh = batch.drop("ingest_ord")
    number = last + F.row_number().over(Window.orderBy("ingested_at", "sha256"))
    message = F.lit(f"the lineage id has room for {lid.MAX_FILES} files")
    return fresh.withColumn("ingest_ord", F.when(number <= lid.MAX_FILES, number).otherwise(F.raise_error(message).cast("int")).cast("int"))


def split_routable(offered: DataFrame, codes: DataFrame) -> DataFrame:
    """Every offered source with its experiment code, or the reason it is skipped."""
    known = offered.join(codes, "experiment", "left")
    reason = F.concat(F.lit("experiment '"), F.col("experiment"), F.lit("' has no lineage code"))
    return known.withColumn("skipped", F.when(F.col("code").isNull(), reason))


def _with_prefix(rows: DataFrame, ingests: DataFrame) -> DataFrame:
    """Rows with the ingest id, id prefix and canary bit of their file, one row per file broadcast."""
    keys = ["experiment", "subject_src"]
    prefix = lid.file_prefix("ts_ms", 1, "code", "ingest_ord")
    batch = ingests.select(*keys, "ingest_id", "radioactive", prefix.alias("prefix"))
    return rows.join(batch, keys)


def _bronze_lid(run, channel) -> Column:
    return lid.with_prefix("prefix", run, channel, "radioactive")


def bronze_recording(samples: DataFrame, ingests: DataFrame) -> DataFrame:
    """Long samples with ingest id and Bronze id; a NaN becomes NULL and its row stays.

    The part of the id that a file's records share is computed once per file, the rest is one number per row.
    """
    return _with_prefix(samples, ingests).select(
        "experiment", "subject_src", F.col("run").cast("smallint"), F.col("channel_idx").cast("smallint"),
        F.col("sample_idx").cast("bigint"), values.nan_to_null(F.col("value_raw").cast("float")).alias("value_raw"),
        "ingest_id", _bronze_lid("run", "channel_idx").alias("lid"))


def bronze_event(events: DataFrame, ingests: DataFrame) -> DataFrame:
    """Cue onsets. They belong to the run, so their id carries channel 0."""
    return _with_prefix(events, ingests).select(
        "experiment", "subject_src", F.col("run").cast("smallint"), F.col("sample_idx").cast("bigint"),
        F.col("event_code").cast("smallint"), "event_label", "ingest_id", _bronze_lid("run", 0).alias("lid"))


def bronze_electrode(channels: DataFrame, locations: DataFrame, ingests: DataFrame, run: int = 1) -> DataFrame:
    """One row per channel of a file; position and area are NULL where the file has none."""
    keys = ["experiment", "subject_src"]
    placed = channels.join(locations, [*keys, "channel_idx"], "left")
    return _with_prefix(placed, ingests).select(
        *keys, F.col("channel_idx").cast("smallint"),
        *[F.col(c).cast("float") for c in ("x_mm", "y_mm", "z_mm")], F.col("brain_area"), "ingest_id",
        _bronze_lid(run, "channel_idx").alias("lid"))


def audit_rows(recording: DataFrame, sources: DataFrame) -> DataFrame:
    """Audit row of every source with rows written. Written last: it commits the ingest."""
    written = recording.groupBy("ingest_id").agg(F.count(F.lit(1)).alias("rows_written"))
    return sources.join(written, "ingest_id")


def orphans(rows: DataFrame, audit: DataFrame) -> DataFrame:
    """Ingests that wrote rows but never their audit row."""
    held = rows.groupBy("experiment", "subject_src", "ingest_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return held.join(audit.select("ingest_id"), "ingest_id", "left_anti")

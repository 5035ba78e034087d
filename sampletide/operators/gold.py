"""Silver to Gold marts.

Sample passes group by the narrow id alone, with map-side partial aggregates, and never join the sample table.
Names are added to the aggregated rows.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampletide.functions import lid
from sampletide.session import materialise
from sampletide.sources.registry import DATASETS

# Task functions travel to executors by value: the package is needed on the driver only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Records whose extremes are sent to every task: some 60 bytes each.
KNOWN_RECORDS = 500_000


def _kept(rows: DataFrame) -> DataFrame:
    """Without canaries: they never enter a mart."""
    return rows.where(~lid.is_canary("lid"))


def record_extremes(records: DataFrame, samples: DataFrame) -> DataFrame:
    """Lowest and highest value of every kept record."""
    found = _kept(samples).groupBy("lid").agg(F.min("value_uv").alias("lo"), F.max("value_uv").alias("hi"))
    return found.join(records.select("lid"), "lid", "left_semi")


def run_rails(records: DataFrame, extremes: DataFrame) -> DataFrame:
    """Extremes of each run, from its records' extremes, on every record of the run."""
    run = ["experiment", "subject_pid", "run"]
    named = extremes.join(records.select("lid", *run), "lid")
    rails = named.groupBy(*run).agg(F.min("lo").alias("rail_lo"), F.max("hi").alias("rail_hi"))
    return _kept(records).select("lid", *run).join(rails, run).select("lid", "rail_lo", "rail_hi")


PART_SCHEMA = "lid string, n long, squares double, lo float, n_lo long, hi float, n_hi long"


def _record_parts(batches):
    """Per batch and record: rows, sum of squares, both extremes and how often each occurs. Samples lie sorted by
    record, so a record is a few runs of rows; where they do not, a batch is sorted first."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, value = batch.column(0), batch.column(1)
        starts = _run_starts(ids)
        if len(starts) > len(ids) // 8:
            order = pc.sort_indices(ids)
            ids, value = ids.take(order), value.take(order)
            starts = _run_starts(ids)
        held = value.is_valid().to_numpy(zero_copy_only=False)
        v = value.fill_null(0).to_numpy(zero_copy_only=False)
        length = np.diff(np.append(starts, len(v)))
        lo = np.minimum.reduceat(np.where(held, v, np.float32(np.inf)), starts)
        hi = np.maximum.reduceat(np.where(held, v, np.float32(-np.inf)), starts)
        at = [np.add.reduceat(held & (v == np.repeat(e, length)), starts, dtype=np.int64) for e in (lo, hi)]
        empty = ~np.logical_or.reduceat(held, starts)
        yield pa.RecordBatch.from_arrays([
            ids.take(pa.array(starts)), pa.array(length.astype(np.int64)), pa.array(np.add.reduceat((v * v).astype(np.float64), starts)),
            pa.array(lo, mask=empty), pa.array(at[0]), pa.array(hi, mask=empty), pa.array(at[1])],
            names=["lid", "n", "squares", "lo", "n_lo", "hi", "n_hi"])


def _run_starts(ids) -> np.ndarray:
    return np.append(0, np.flatnonzero(pc.not_equal(ids[1:], ids[:-1]).to_numpy(zero_copy_only=False)) + 1)


def record_stats(samples: DataFrame, most: int = KNOWN_RECORDS) -> DataFrame:
    """Everything channel quality needs of a record, whatever the values of its samples: lid, n_samples, sum_squares, lo, hi, and
    how often each extreme occurs.

    Two scans of built-in aggregates: the extremes first, then how many samples lie at them. The second joins the extremes, one
    row a record, which are sent to every task while they are at most `most` records; beyond that one Arrow pass does both.
    Neither way shuffles samples. NULL values count as samples and nothing else. Canaries fall out later, when the records
    they belong to do.
    """
    return _stats_and_extremes(samples, most)[0]


def _stats_and_extremes(samples: DataFrame, most: int = KNOWN_RECORDS) -> tuple[DataFrame, DataFrame]:
    """The statistics, to be read once, and a written table that has their lid, lo and hi."""
    own = samples.select("lid", F.col("value_uv").cast("float").alias("v"))
    ends = materialise(own.groupBy("lid").agg(
        F.count(F.lit(1)).alias("n_samples"), F.sum(F.col("v") * F.col("v")).alias("sum_squares"), F.min("v").alias("lo"), F.max("v").alias("hi")), "record-extremes")
    if ends.count() > most:
        return _record_stats_in_one_pass(samples), ends
    at = own.join(F.broadcast(ends.select("lid", "lo", "hi")), "lid").where((F.col("v") <= F.col("lo")) | (F.col("v") >= F.col("hi")))
    counted = at.groupBy("lid").agg(F.count_if(F.col("v") == F.col("lo")).alias("n_lo"), F.count_if(F.col("v") == F.col("hi")).alias("n_hi"))
    return ends.join(counted, "lid", "left").select("lid", "n_samples", "sum_squares", "lo", "hi", "n_lo", "n_hi"), ends


def _record_stats_in_one_pass(samples: DataFrame) -> DataFrame:
    """The same by Arrow batches: a task reduces each batch to one row per record with its extremes and their counts; those rows
    are what is shuffled. The count at a record's extreme is the sum over the parts that reach it."""
    parts = samples.select("lid", F.col("value_uv").cast("float").alias("value_uv")).mapInArrow(_record_parts, PART_SCHEMA)
    low = F.struct(F.col("lo").alias("value"), F.col("n_lo").alias("at"), "n", "squares")
    high = F.struct(F.col("hi").alias("value"), F.col("n_hi").alias("at"), F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("squares"))
    ends = parts.select("lid", F.inline(F.when(F.col("lo") < F.col("hi"), F.array(low, high)).otherwise(F.array(low))))
    levels = ends.groupBy("lid", "value").agg(F.sum("at").alias("at"), F.sum("n").alias("n"), F.sum("squares").alias("squares"))
    return levels.groupBy("lid").agg(
        F.sum("n").alias("n_samples"), F.when(F.count("value") > 0, F.sum("squares")).alias("sum_squares"),
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.min_by("at", "value").alias("n_lo"), F.max_by("at", "value").alias("n_hi"))


def clipping(records: DataFrame, stats: DataFrame, extremes: DataFrame | None = None) -> DataFrame:
    """Share of a record's samples at the run's rails and at its own extremes, percent.

    A sample sits on a rail of its run only if the record's own extreme is that rail, so the counts at the own
    extremes answer both. When low and high coincide the samples are counted once. `extremes`, where given, saves reading
    `stats` twice.
    """
    run = ["experiment", "subject_pid", "run"]
    named = stats.join(records, "lid")
    ends = named if extremes is None else extremes.select("lid", "lo", "hi").join(records.select("lid", *run), "lid")
    rails = ends.groupBy(*run).agg(F.min("lo").alias("rail_lo"), F.max("hi").alias("rail_hi"))
    joined = named.join(rails, run)
    at = lambda hit, n: F.when(hit, F.col(n)).otherwise(0)
    on_rails = at(F.col("lo") == F.col("rail_lo"), "n_lo") + at(
        (F.col("hi") == F.col("rail_hi")) & (F.col("rail_lo") != F.col("rail_hi")), "n_hi")
    own = F.col("n_lo") + at(F.col("lo") != F.col("hi"), "n_hi")
    share = lambda n: (F.lit(100.0) * n / F.col("n_samples")).cast("float")
    return joined.withColumn("clipped_pct", share(on_rails)).withColumn("clipped_own_pct", share(own))


def channel_quality(records: DataFrame, samples: DataFrame, noise: DataFrame | None = None) -> DataFrame:
    """One row per kept record with samples."""
    measured = clipping(_kept(records), *_stats_and_extremes(samples))
    if noise is None:
        measured = measured.withColumn("line_noise_ratio", F.lit(None).cast("float"))
    else:
        measured = measured.join(noise.select("lid", "line_noise_ratio"), "lid", "left")
    return measured.select(
        "experiment", "subject_pid", "run", "channel_idx", "n_samples",
        (F.col("n_samples_src") - F.col("n_samples")).alias("missing_samples"),
        F.sqrt(F.col("sum_squares") / F.col("n_samples")).cast("float").alias("rms_uv"),
        "clipped_pct", "clipped_own_pct", F.col("line_noise_ratio").cast("float"), "scale_basis",
        lid.relayer("lid", 2).alias("lid"))


def file_names(records: DataFrame) -> DataFrame:
    """Names that a record id's file field stands for: one row per source file, so it can be broadcast."""
    names = records.select(lid.file_key("lid").alias("file"), "experiment", "subject_pid").distinct()
    return names


def feature_window(records: DataFrame, samples: DataFrame, width_ms: int = 1000) -> DataFrame:
    """One row per kept record and tumbling window.

    Run and channel are read from the id and the names come from its file, so the windows, which grow with the
    samples, are never shuffled to be named. Silver writes samples only for ids of the record table.
    """
    start = F.expr(f"ts_ms div {int(width_ms)} * {int(width_ms)}")
    windows = (_kept(samples).select("lid", start.alias("window_start_ms"), "value_uv", "sample_idx")
               .groupBy("lid", "window_start_ms").agg(
                   F.avg("value_uv").cast("float").alias("mean_uv"),
                   F.stddev_pop("value_uv").cast("float").alias("std_uv"),
                   (F.max("value_uv") - F.min("value_uv")).cast("float").alias("p2p_uv"),
                   F.min("sample_idx").alias("sample_lo"), F.max("sample_idx").alias("sample_hi")))
    named = windows.join(file_names(_kept(records)), lid.file_key("lid") == F.col("file"))
    return (named.withColumn("run", lid.run("lid")).withColumn("channel_idx", lid.channel("lid"))
            .withColumn("lid", lid.relayer("lid", 2)).select(*DATASETS["gold/feature_window"].fields))


def experiment_summary(records: DataFrame, samples: DataFrame, events: DataFrame) -> DataFrame:
    """One row per experiment and subject: runs, channels, duration, events. Canary subjects are left out."""
    subject = ["experiment", "subject_pid"]
    channels = samples.groupBy(*subject, "run", "channel_idx").agg(F.max("ts_ms").alias("last_ms"))
    runs = channels.groupBy(*subject, "run").agg(
        F.count("channel_idx").alias("n_channels"), (F.max("last_ms") + 1).alias("duration_ms"))
    planted = records.where(lid.is_canary("lid")).select("subject_pid").distinct()
    totals = runs.join(planted, "subject_pid", "left_anti").groupBy(*subject).agg(
        F.count(F.lit(1)).cast("smallint").alias("n_runs"), F.max("n_channels").cast("smallint").alias("n_channels"),
        (F.sum("duration_ms") / F.lit(1000.0)).cast("float").alias("duration_s"))
    cued = events.groupBy(*subject).agg(F.count(F.lit(1)).alias("n_events"))
    return totals.join(cued, subject, "left").select(
        *subject, "n_runs", "n_channels", "duration_s", F.coalesce("n_events", F.lit(0)).cast("int").alias("n_events"))

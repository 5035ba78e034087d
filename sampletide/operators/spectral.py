"""Mains-noise share of a record's first ten seconds, as sums.

Only 42 frequency bins are needed, so each is a pair of sums of x cos and x sin, and the total power follows
from the variance. Sums combine on the map side: no record's excerpt is gathered anywhere and no Python runs.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampletide.functions import lid
from sampletide.operators.ingest import with_ingest_ord

# Seconds of excerpt, and the inclusive bands in Hz.
EXCERPT_S = 10
BANDS_HZ = ((49, 51), (59, 61))


def _bins() -> list[int]:
    """With ten seconds a bin is a tenth of a hertz, so bin numbers do not depend on the sample rate."""
    return [k for low, high in BANDS_HZ for k in range(low * EXCERPT_S, high * EXCERPT_S + 1)]


def with_rate(samples: DataFrame, audit: DataFrame) -> DataFrame:
    """Samples of the first seconds with the sample rate of their file, found through the id's file field.

    The highest rate bounds the excerpt of every file, which lets the Parquet scan skip the row groups beyond.
    """
    rates = with_ingest_ord(audit).select(lid.file_key_of("ingest_ord").alias("file"), "sample_rate_hz")
    longest = audit.agg(F.max("sample_rate_hz") * EXCERPT_S).scalar()
    early = samples.where(F.col("sample_idx") < longest)
    return early.join(rates,
                      lid.file_key("lid") == F.col("file")).drop("file")


def line_noise(samples: DataFrame, key: str = "lid") -> DataFrame:
    """(key, line_noise_ratio); NULL unless every sample of the first ten seconds is present and varies.

    `samples` carries sample_rate_hz, sample_idx and value_uv.
    """
    length = f"(sample_rate_hz * {EXCERPT_S})"
    excerpt = samples.where(f"sample_idx >= 0 and sample_idx < {length}").select(
        key, "sample_rate_hz", F.col("sample_idx").alias("i"), F.col("value_uv").cast("double").alias("x"))
    # Reducing k*i modulo the length first keeps the angle, and with it the precision, small.
    sums = [F.expr(f"sum(x * {wave}((i * {k} % {length}) * {2 * math.pi!r}D / {length})) AS {wave}{k}")
            for k in _bins() for wave in ("cos", "sin")]
    parts = excerpt.groupBy(key, "sample_rate_hz").agg(
        F.expr("count(x) AS n"), F.expr("var_pop(x) AS variance"), F.expr("sum(if(i % 2 = 0, x, -x)) AS nyquist"), *sums)
    band = " + ".join(f"if({2 * k} <= {length}, cos{k} * cos{k} + sin{k} * sin{k}, 0D)" for k in _bins())
    total = "(cast(n as double) * n * variance + nyquist * nyquist) / 2"
    return parts.select(key, F.expr(f"if(n = {length} and variance > 0, ({band}) / ({total}), null) AS line_noise_ratio"))

"""Scalar rules of the data model that differ between engines if written carelessly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(value: Column) -> Column:
    return F.when(F.isnan(value), F.lit(None)).otherwise(value)


def sample_time_ms(sample_idx: Column, rate_hz: Column) -> Column:
    """Milliseconds from the start of the run, halves to even; a plain integer cast would truncate."""
    return F.rint(sample_idx.cast("bigint") * 1000 / rate_hz).cast("bigint")


def to_microvolt(value_raw: Column, uv_per_unit: Column) -> Column:
    """FLOAT times FLOAT: a decimal or double scale would widen the product."""
    return (value_raw.cast("float") * uv_per_unit.cast("float")).cast("float")


def source_path(data_root: Column, path: Column) -> Column:
    return F.when(path.startswith("/"), path).otherwise(F.concat_ws("/", data_root, path))

"""Small fixed tables as local relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _constant(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else repr(value)


def literal(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small fixed table as a local relation, whose size the planner knows."""
    fields = T.StructType.fromDDL(schema)
    if not rows:
        return spark.createDataFrame([], fields)
    values = ", ".join("(" + ", ".join(_constant(v) for v in row) + ")" for row in rows)
    columns = ", ".join(f"cast({f.name} as {f.dataType.simpleString()}) AS {f.name}" for f in fields)
    return spark.sql(f"SELECT {columns} FROM VALUES {values} AS t({', '.join(fields.names)})")

"""Shared by the operators: words, tables below a data folder, Arrow task functions, written intermediates."""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampletide.session import materialise


def travels(name: str) -> None:
    """Task functions of module `name` go to executors by value: the package is needed on the driver only."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


travels(__name__)

# White space of the contracts: space and tab to carriage return. bytes.split() without argument splits on just these.
SPACE = " \t\n\x0b\x0c\r"
WORD_REGEX = r"[^\x20\x09-\x0D]+"
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def written(rows: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared scratch folder: computed once, lineage cut, size known to the planner."""
    return materialise(rows, f"llm-{name}")


def mapped(rows: DataFrame, task, schema: str) -> DataFrame:
    """Run `task(columns) -> columns` on every Arrow batch. Both are dicts of lists or arrays by column name."""
    fields = rows.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema
    out = to_arrow_schema(fields)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                made = task({n: batch.column(i) for i, n in enumerate(batch.schema.names)})
                yield record_batch(made, out)
    return rows.mapInArrow(run, fields)


def record_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c := columns[f.name], pa.Array) and c.type == f.type else pa.array(c, f.type) for f in schema],
        schema=schema)


def crc32_fold(column, folds: int):
    """crc32 of the id as text, modulo `folds`."""
    return F.crc32(F.encode(column.cast("string"), "UTF-8")) % folds

"""Sample passes over a long generated table, for values of few levels and continuous ones.

    python bench_long.py [rows]          default 20,000,000; prints one JSON line

The table has the layout of the Silver samples (sorted by record, 1,000 records, a third of the rows on one of them).
executors wrote, over the bytes of the samples.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from sampletide.operators import gold
from sampletide.session import scratch, session

RECORDS = 1000


def main(rows: int) -> None:
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = session(f"local[{cpus}]", **{"spark.sql.shuffle.partitions": str(cpus), "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    written = lambda: sum(e.totalShuffleWrite() for e in _executors(spark))
    out = {"rows": rows, "cpus": cpus}
    for kind, value in (("levels", F.floor(F.rand(1) * 4097)), ("continuous", F.randn(1) * 50)):
        path = scratch(spark, f"long-{kind}")
        record = F.when(F.col("id") < rows // 3, 0).otherwise(1 + F.floor((F.col("id") - rows // 3) / (rows * 2 / 3 / (RECORDS - 1) + 1)))
        ids = F.concat(F.lit("01900000-0000-2010-0001-1"), F.lpad(F.lower(F.hex(record)), 11, "0"))
        spark.range(0, rows, 1, 4 * cpus).select(ids.alias("lid"), value.cast("float").alias("value_uv"), F.col("id").alias("sample_idx"),
                                                 F.col("id").alias("ts_ms")).write.parquet(path)
        samples = spark.read.parquet(path)
        before = written()
        began = time.perf_counter()
        stats = gold.record_stats(samples).agg(F.sum("n_samples"), F.count("*")).first()
        took = time.perf_counter() - began
        assert stats[0] == rows
        out[f"record_stats_{kind}"] = {"sec": round(took, 2), "rows_per_sec_core": round(rows / took / cpus), "shuffle_mb": round((written() - before) / 1e6, 2)}
        began = time.perf_counter()
        gold.feature_window(samples.select("lid").distinct().withColumns({"experiment": F.lit("e"), "subject_pid": F.lit("p")}), samples).agg(F.count("*")).first()
        took = time.perf_counter() - began
        out[f"feature_window_{kind}"] = {"sec": round(took, 2), "rows_per_sec_core": round(rows / took / cpus)}
    print(json.dumps(out))


def _executors(spark):
    found = spark.sparkContext._jsc.sc().statusStore().executorList(True)
    return [found.apply(i) for i in range(found.size())]


if __name__ == "__main__":
    main(int(sys.argv[1]) if len(sys.argv) > 1 else 20_000_000)

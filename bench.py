"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is built and run once to warm up and then timed: best of two runs, planning included, results
discarded by a noop sink, except that queries which write files time those writes too.
"""

from __future__ import annotations

import json
import os
import time

from sampletide.plans.catalogue import queries
from sampletide.session import session

HEADLINE = ("bronze_recording", "silver_record", "silver_recording", "record_extremes", "run_rails", "channel_quality",
            "line_noise", "feature_window", "experiment_summary", "event_onsets", "wide_to_long", "lid_decode", "lid_trace",
            "lid_children", "lineage_integrity", "pseudonymise", "check_not_null", "check_unique", "check_verdicts",
            "flag_event_rate", "ranked_checks", "build_inventory", "layout_write", "dataset_manifest", "dataset_version",
            "exact_sum", "middle_record")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    every, seconds = queries(), {}
    for name in HEADLINE:
        def run():
            began = time.perf_counter()
            every[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - began
        run()
        seconds[name] = round(min(run(), run()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()

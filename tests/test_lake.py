import pathlib
import shutil

import pytest
from pyspark.sql import functions as F

from sampletide.operators import gold, lineage, manifest, spectral
from sampletide.plans import lake as plan
from sampletide.session import scratch
from sampletide.sources import files, reader, rules


def rows(df):
    return sorted(map(str, df.collect()))


def test_written_layers_equal_the_lazy_ones(spark, lake, lake_inputs):
    f = lake_inputs
    for name, want in (("bronze/recording", f.bronze_recording), ("silver/record", f.record), ("silver/recording", f.recording),
                       ("silver/electrode", f.electrode), ("silver/event", f.event), ("silver/subject", f.subject),
                       ("gold/feature_window", f.windows), ("gold/experiment_summary", f.summary)):
        assert rows(reader.dataset(spark, lake, name)) == rows(want), name


def test_evidence_grows_by_runs_and_digests_are_stable(spark, lake):
    first = plan.evidence(spark, lake, "R1")
    n = first.count()
    odd = first.where("result <> 'pass'").select("check_id", "severity", "observed").collect()
    assert not [r for r in odd if r["severity"] == "block"], odd
    second = plan.evidence(spark, lake, "R2")
    assert reader.dataset(spark, lake, "gold/evidence").where("run_id = 'R1'").count() == n
    drift = {r["dataset"]: (r["a"], r["b"]) for r in first.select("dataset", F.col("dataset_version").alias("a")).distinct().join(
        second.select("dataset", F.col("dataset_version").alias("b")).distinct(), "dataset").collect()}
    assert all(a == b for d, (a, b) in drift.items() if d != "gold/evidence")
    agreed = reader.dataset(spark, lake, "gold/dataset_manifest").join(
        second.select("dataset", F.col("dataset_version").alias("checked")).distinct(), "dataset")
    assert agreed.where("dataset not in ('gold/evidence') and dataset_version <> checked").count() == 0 and agreed.count() > 5


def test_no_rule_vanishes_with_its_data(spark, lake_inputs):
    """Without a dataset, a capture or the folder of captures, every rule still has its row, failing or in error."""
    root = plan.build(lake_inputs, scratch(spark, "test-lost"))
    every = {r["check_id"]: r for r in plan.evidence(spark, root, "R1").collect()}
    shutil.rmtree(f"{root}/silver/recording")
    captures = sorted(p for p in pathlib.Path(f"{root}/raw").rglob("*.mat"))
    captures[0].unlink()
    captures[1].write_text("tampered")
    lost = {r["check_id"]: r for r in plan.evidence(spark, root, "R2").collect()}
    assert set(lost) == set(every)
    mine = {i: r["result"] for i, r in lost.items() if r["dataset"] == "silver/recording"}
    assert mine["SAMPLES-THERE/row_count_min/silver/recording/1"] == "fail"
    assert [r for i, r in mine.items() if "partition_layout" in i] == ["error"]
    intact = next(i for i in lost if i.startswith("CAPTURE-INTACT"))
    assert (every[intact]["result"], every[intact]["observed"]) == ("pass", "0")
    assert (lost[intact]["result"], lost[intact]["observed"]) == ("fail", "2")
    shutil.rmtree(f"{root}/raw")
    assert {r["check_id"]: r["result"] for r in plan.evidence(spark, root, "R3").collect()}[intact] == "error"


def test_failing_checks_become_error_rows(spark, lake):
    broken = rules.Rule("x/sql", "x", "contract", "silver/record", "sql", "block", "c", {"sql": "SELECT nothing FROM nowhere"})
    missing = rules.Rule("x/null", "x", "contract", "silver/record", "not_null", "block", "c", {"column": "absent"})
    fine = rules.Rule("x/rows", "x", "contract", "silver/record", "row_count_min", "block", "c", {"min": 1})
    seen = {i: (o, e) for i, o, e in plan.observations(spark, lake, [broken, missing, fine])}
    assert seen["x/sql"][0] is None and seen["x/sql"][1]
    assert seen["x/null"][0] is None and seen["x/rows"][1] is None


def test_sql_users_reach_views_and_lineage(spark, lake):
    plan.views(spark, lake)
    one = spark.sql("SELECT lid FROM silver_record ORDER BY lid LIMIT 1").first()["lid"]
    traced = spark.sql(f"SELECT * FROM lid_trace('{one}')").collect()
    assert len(traced) == 1 and traced[0]["layer"] == 2
    n = spark.sql("SELECT count(*) AS n FROM lid_children(3)").first()["n"]
    assert n == spark.sql("SELECT count(*) AS n FROM silver_record WHERE lid_file(lid) = 3").first()["n"] > 0


def test_id_ranges_are_pushed_to_the_scan(spark, lake):
    plan_text = lineage.children_of(reader.dataset(spark, lake, "silver/record"), "0", "f")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(lid" in plan_text and "LessThanOrEqual(lid" in plan_text


def test_publication_is_refused_with_a_canary_in_gold(spark, lake_inputs):
    root = plan.build(lake_inputs, scratch(spark, "test-leak"))
    plan.evidence(spark, root)
    out = scratch(spark, "test-out")
    listed = plan.publish_gold(spark, root, out)
    sources = files.digests(spark, f"{root}/gold").select("sha256")
    assert rows(listed.select("sha256")) == rows(sources)
    assert listed.where("path like 'gold/build_summary/%'").count() > 0
    # Rewritten and published again: the new version alone, with the same rows.
    quality = spark.read.parquet(f"{root}/gold/channel_quality")
    kept = rows(quality)
    quality.repartition(3).write.parquet(f"{root}/aside")
    spark.read.parquet(f"{root}/aside").write.mode("overwrite").parquet(f"{root}/gold/channel_quality")
    again = plan.publish_gold(spark, root, out)
    place = plan.published_root(spark, out)
    assert place.endswith(again.first()["version"])
    assert rows(spark.read.parquet(f"{place}/gold/channel_quality").select(*quality.columns)) == kept
    assert rows(again.select("sha256")) == rows(files.digests(spark, f"{root}/gold").select("sha256"))
    results = {r["check_id"]: r["result"] for r in plan.recheck_published(spark, out).collect()}
    assert set(results.values()) <= {"pass", "fail"}
    broken = next(pathlib.Path(f"{place}/gold/feature_window").rglob("*.parquet"))
    broken.unlink()
    after = {r["check_id"]: r["result"] for r in plan.recheck_published(spark, out).collect()}
    assert {i for i, r in after.items() if r == "not run"} == {i for i in results if "/gold/feature_window" in i}
    lost = spark.createDataFrame([("f" * 40,)], "git_commit string")
    with pytest.raises(ValueError, match="commits"):
        plan.publish_gold(spark, root, scratch(spark, "test-out"), lost)
    leaked = lake_inputs.record.where("false").unionByName(lineage.canaries(lake_inputs.record))
    leaked.select("experiment", "subject_pid", "run", "channel_idx", F.lit(0).cast("bigint").alias("window_start_ms"),
                  *[F.lit(0).cast("float").alias(c) for c in ("mean_uv", "std_uv", "p2p_uv")], "lid",
                  F.lit(0).cast("bigint").alias("sample_lo"), F.lit(0).cast("bigint").alias("sample_hi")
                  ).write.mode("append").parquet(f"{root}/gold/feature_window")
    with pytest.raises(ValueError, match="canary"):
        plan.publish_gold(spark, root, scratch(spark, "test-out"))


def test_manifest_of_a_dataset_without_ids_lists_every_source(lake_inputs):
    row = manifest.describe("bronze/ingest_audit", lake_inputs.audit, lake_inputs.file_dim).first()
    assert (row["lid_lo"], row["n_records"], len(row["file_digests"])) == (None, lake_inputs.audit.count(), lake_inputs.audit.count())


def test_noise_runs_on_the_written_lake(spark, lake):
    samples = reader.dataset(spark, lake, "silver/recording")
    early = spectral.with_rate(samples, reader.dataset(spark, lake, "bronze/ingest_audit"))
    assert early.where("sample_rate_hz is null").count() == 0
    assert spectral.line_noise(early).where("line_noise_ratio is not null").count() == 0


def test_stats_survive_a_second_layer(spark, lake):
    assert gold.record_extremes(reader.dataset(spark, lake, "silver/record"), reader.dataset(spark, lake, "silver/recording")).count() > 0

import hashlib
import hmac
import random

import pytest
from pyspark.sql import functions as F

from sampletide.functions import values
from sampletide.operators import ingest, lineage, pseudonym, silver
from sampletide.sources import bounds, reader


def brute_onsets(codes):
    before, found = 0, []
    for i, c in enumerate(codes):
        if c != 0 and c != before:
            found.append(i)
        before = c
    return found


@pytest.mark.parametrize("block", [1, 2, 3, 5, 1000])
def test_onsets_across_blocks(spark, block):
    """Blocks cut a run anywhere; the result is the one of a single pass."""
    codes = {"a": [1, 1, 0, 2, 2, 3, 0, 0, 4, 4, 4, 1], "b": [0, 0, 5, 5, 0, 5, 6]}
    rows = spark.createDataFrame([(r, i, c) for r, cs in codes.items() for i, c in enumerate(cs)],
                                 "run string, sample_idx long, event_code int")
    found = ingest.onsets(rows, ["run"], block=block).collect()
    assert sorted((r["run"], r["sample_idx"]) for r in found) == [(r, i) for r, cs in sorted(codes.items()) for i in brute_onsets(cs)]


def test_hot_run_is_split(spark):
    rows = spark.range(1000).select(F.lit(1).alias("run"), F.col("id").alias("sample_idx"), F.expr("id div 7 % 3 AS event_code"))
    codes = [i // 7 % 3 for i in range(1000)]
    assert ingest.onsets(rows, ["run"], block=64).count() == len(brute_onsets(codes))


def test_labels_remap_and_ranges(spark):
    rows = spark.createDataFrame([(1,), (7,), (9,), (0,)], "event_code smallint")
    labels = spark.createDataFrame([(1, "one")], "event_code smallint, event_label string")
    assert {r["event_code"]: r["event_label"] for r in ingest.with_labels(rows, labels).collect()} == {1: "one", 7: None, 9: None, 0: None}
    made = rows.select("event_code", ingest.sentinel_to_zero(F.col("event_code"), 9).alias("z"),
                       ingest.range_label(F.col("event_code"), [(1, 4, "a"), (5, 8, "b")]).alias("g"),
                       ingest.lookup(F.col("event_code"), {1: "x"}).alias("t")).collect()
    assert {r["event_code"]: (r["z"], r["g"], r["t"]) for r in made} == {
        1: (1, "a", "x"), 7: (7, "b", None), 9: (0, None, None), 0: (0, None, None)}


def test_wide_to_long(spark):
    wide = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0])], "sample_idx long, data array<float>")
    rows = {(r["channel_idx"], r["sample_idx"]): r["value_raw"] for r in ingest.wide_to_long(wide, "data", "sample_idx").collect()}
    assert rows == {(0, 0): 1.0, (1, 0): 2.0, (0, 1): 3.0, (1, 1): 4.0}


def test_rounding_is_half_even(spark):
    rows = spark.createDataFrame([(1, 2000), (3, 2000), (5, 2000), (7, 512)], "i long, rate int")
    assert [r[0] for r in rows.select(values.sample_time_ms(F.col("i"), F.col("rate"))).collect()] == [0, 2, 2, 14]


def test_scale_stays_single_precision(spark):
    import numpy as np
    rows = spark.createDataFrame([(1234.5,)], "v float").select(values.to_microvolt(F.col("v"), F.lit(0.0298)).alias("uv"))
    assert rows.schema["uv"].dataType.simpleString() == "float"
    assert rows.first()["uv"] == pytest.approx(float(np.float32(1234.5) * np.float32(0.0298)), abs=0)


def test_nan_becomes_null_and_stays(spark):
    rows = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "v float").select(values.nan_to_null(F.col("v")).alias("v"))
    assert sorted([r["v"] for r in rows.collect()], key=str) == [1.0, None, None]


def test_rerun_offers_nothing_new(lake_inputs):
    sources = lake_inputs.sources.select("sha256", "source_path_rel")
    assert ingest.new_sources(sources, lake_inputs.audit).count() == 0
    twice = sources.unionByName(sources)
    assert ingest.new_sources(twice, lake_inputs.audit.where("false")).count() == sources.count()


def test_ordinals_continue(lake_inputs):
    audit = lake_inputs.audit.drop("ingest_ord")
    first, batch = audit.where("ingest_id < 'm'"), audit.where("ingest_id >= 'm'")
    n = first.count()
    later = [r["ingest_ord"] for r in ingest.batch_ord(batch, first).collect()]
    assert sorted(later) == list(range(n + 1, n + 1 + batch.count()))


def test_uncommitted_rows_are_invisible(lake_inputs):
    rows = reader.committed(lake_inputs.bronze_recording, lake_inputs.partial_audit)
    lost = ingest.orphans(lake_inputs.bronze_recording, lake_inputs.partial_audit).collect()
    assert rows.where("ingest_id = 'view-u7'").count() == 0
    assert [r["ingest_id"] for r in lost] == ["view-u7"]
    assert rows.count() + lost[0]["n_rows"] == lake_inputs.samples.count()


def test_pseudonym_is_the_standard_hmac(spark):
    codes = ["u0", "", "é", "x" * 200, None, "u0"]
    for secret in (bytes(range(32)), b"k" * 200):
        made = pseudonym.pseudonymise(spark.createDataFrame([(c,) for c in codes], "subject_src string"), secret)
        for r in made.collect():
            code = r["subject_src"]
            assert r["subject_pid"] == (None if code is None else hmac.new(secret, code.encode(), hashlib.sha256).hexdigest()[:16])
        plan = made._jdf.queryExecution().toString()
        assert secret.hex() not in plan and bytes(b ^ 0x36 for b in secret[:64].ljust(64, b"\0")).hex() not in plan.lower()


def test_reidentification_is_logged_first(spark, lake_inputs, tmp_path):
    pid = lake_inputs.key_map.where("subject_src = 'u3'").first()["subject_pid"]
    requests = spark.createDataFrame([(pid, "a", "p"), ("f" * 16, "a", "p")], "subject_pid string, actor string, purpose string").withColumn(
        "accessed_at", F.current_timestamp())
    answers = {r["subject_pid"]: r["subject_src"] for r in pseudonym.reidentify(requests, lake_inputs.key_map, str(tmp_path / "log")).collect()}
    assert answers == {pid: "u3", "f" * 16: None}
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2


@pytest.mark.parametrize("threshold", ["-1", "1b", "10485760"])
def test_results_do_not_depend_on_a_size_setting(spark, lake_inputs, threshold):
    """More labels than ids have files: joins have no bound of their own, whatever the planner may broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        many = spark.range(70_000).select(F.col("id").cast("int").alias("event_code"), F.lit("x").alias("event_label"))
        assert ingest.with_labels(spark.range(70_000).select(F.col("id").cast("int").alias("event_code")), many).where("event_label = 'x'").count() == 70_000
        rows = silver.recording(lake_inputs.bronze_recording, lake_inputs.key_map, lake_inputs.audit, lake_inputs.scale)
        assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, lake_inputs.recording.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("block", [1, 2, 8, 64, 1 << 20])
def test_onsets_pass_over_gaps(spark, block):
    rng = random.Random(block)
    rows, want = [], []
    for run in range(4):
        before = 0
        for i in sorted(rng.sample(range(400), 150)):
            code = rng.choice([0, 3, 3, 3, 5])
            rows.append((run, i, code))
            if code not in (0, before):
                want.append((run, i, code))
            before = code
    made = ingest.onsets(spark.createDataFrame(rows, "run int, sample_idx long, event_code short").repartition(5), ["run"], block=block)
    assert sorted(map(tuple, made.collect())) == want


def test_a_late_batch_of_earlier_times_moves_no_ordinal(spark, lake_inputs):
    """Stored ordinals stay; ids of the first batch still name their files."""
    audit = lake_inputs.audit
    early = audit.withColumn("ingested_at", F.col("ingested_at") - F.expr("INTERVAL 900 DAYS")).withColumn("sha256", F.sha2("sha256", 256)).withColumn(
        "ingest_id", F.concat(F.lit("late-"), "ingest_id"))
    both = audit.unionByName(ingest.batch_ord(early, audit).select(*audit.columns))
    dim = lineage.file_dim(both)
    assert dim.select("ingest_ord").distinct().count() == 2 * audit.count()
    one = lineage.trace(lake_inputs.record, lake_inputs.file_dim, lake_inputs.codes)
    two = lineage.trace(lake_inputs.record, dim, lake_inputs.codes)
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    moved = dim.withColumn("ts_ms", F.col("ts_ms") + 1)
    assert lineage.trace(lake_inputs.record, moved, lake_inputs.codes).count() == 0


def test_children_by_literal_range(lake_inputs):
    bound = lineage.prefix_bounds(lake_inputs.dim, lake_inputs.codes).where("ingest_ord = 7").first()
    one = lineage.children_of(lake_inputs.record, bound["lid_lo"], bound["lid_hi"]).select("lid").collect()
    every = lineage.children(lake_inputs.record, lineage.prefix_bounds(lake_inputs.dim, lake_inputs.codes)).where("ingest_ord = 7")
    assert sorted(r["lid"] for r in one) == sorted(r["lid"] for r in every.collect()) != []


def test_literal_tables_keep_any_text(spark):
    rows = [("it's", 1, 1.5), ('a "b" \\ \\n {c}', None, None), ("é\n", 3, -0.25)]
    made = bounds.literal(spark, rows, "t string, n int, x float")
    assert sorted(map(tuple, made.collect())) == sorted(rows)

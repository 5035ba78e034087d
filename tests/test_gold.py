import numpy as np
import pytest
from pyspark.sql import functions as F

from sampletide.functions import lid
from sampletide.operators import gold, spectral
from sampletide.plans.fixtures import Fixture
from sampletide.sources.registry import DATASETS


def tone(spark, hz, seconds, rate=1000, offset=5.0):
    n = int(seconds * rate)
    x = (np.sin(2 * np.pi * hz * np.arange(n) / rate) * 10 + offset).astype(np.float32)
    rows = spark.createDataFrame(list(zip(range(n), x.tolist())), "sample_idx long, value_uv float")
    return x, rows.withColumn("lid", F.lit("r")).withColumn("sample_rate_hz", F.lit(rate))


def share(rows):
    return spectral.line_noise(rows).first()["line_noise_ratio"]


def fft_share(x, rate):
    n = 10 * rate
    power = np.abs(np.fft.rfft(x[:n].astype(np.float64) - x[:n].astype(np.float64).mean())) ** 2
    freq = np.fft.rfftfreq(n, 1 / rate)
    band = ((freq >= 49) & (freq <= 51)) | ((freq >= 59) & (freq <= 61))
    return power[band].sum() / power.sum()


def test_mains_tone_and_other_tone(spark):
    assert share(tone(spark, 50, 10)[1]) > 0.99
    assert share(tone(spark, 10, 10)[1]) < 0.01


@pytest.mark.parametrize("rate", [1000, 200, 110])
def test_equals_the_transform(spark, rate):
    """Also at a rate so low that part of the bands lies above half of it."""
    rng = np.random.default_rng(1)
    x = (rng.normal(3, 20, 12 * rate) + 8 * np.sin(2 * np.pi * 50 * np.arange(12 * rate) / rate)).astype(np.float32)
    rows = spark.createDataFrame(list(zip(range(len(x)), x.tolist())), "sample_idx long, value_uv float").withColumn(
        "lid", F.lit("r")).withColumn("sample_rate_hz", F.lit(rate))
    assert share(rows) == pytest.approx(fft_share(x, rate), rel=1e-9)


def test_short_gapped_or_flat_records_have_no_share(spark):
    rows = tone(spark, 50, 10)[1]
    assert share(tone(spark, 50, 9.999)[1]) is None
    assert share(rows.where("sample_idx <> 4321")) is None
    assert share(rows.withColumn("value_uv", F.lit(2.5).cast("float"))) is None


def brute_quality(records, samples):
    """Two passes over plain lists."""
    runs = {r["lid"]: (r["experiment"], r["subject_pid"], r["run"]) for r in records}
    by = {}
    for s in samples:
        by.setdefault(s["lid"], []).append(np.float32(s["value_uv"]))
    rails = {}
    for k, v in by.items():
        lo, hi = rails.get(runs[k], (np.inf, -np.inf))
        rails[runs[k]] = min(lo, min(v)), max(hi, max(v))
    out = {}
    for k, v in by.items():
        lo, hi = rails[runs[k]]
        out[k] = (len(v), 100.0 * sum(x in (lo, hi) for x in v) / len(v), 100.0 * sum(x in (min(v), max(v)) for x in v) / len(v),
                  float(np.sqrt(np.mean([float(x * x) for x in v]))))
    return out


def test_clipping_against_brute_force(spark):
    """Records sharing a rail, a constant record, a constant run."""
    values = {0: [1, 5, 5, 9, 1], 1: [9, 9, 9, 2], 2: [3, 3, 3], 3: [1, 9, 4, -0.0], 4: [7, 7]}
    run_of = {0: 1, 1: 1, 2: 1, 3: 2, 4: 3}
    ids = {r["c"]: r["lid"] for r in spark.range(5).select(F.col("id").alias("c"), lid.mint_text(1, 2, 1, 1, 1, "id", 0, 0).alias("lid")).collect()}
    records = spark.createDataFrame([(ids[c], "e", "p", run_of[c], c, 10, "documented") for c in values],
                                    "lid string, experiment string, subject_pid string, run short, channel_idx short, n_samples_src long, scale_basis string")
    samples = spark.createDataFrame([(ids[c], float(v)) for c, vs in values.items() for v in vs], "lid string, value_uv float")
    want = brute_quality(records.collect(), samples.collect())
    rows = gold.channel_quality(records, samples).collect()
    assert len(rows) == 5
    for r in rows:
        silver = r["lid"][:14] + "2" + r["lid"][15:]
        n, clipped, own, rms = want[silver]
        assert (r["n_samples"], r["missing_samples"]) == (n, 10 - n)
        assert r["clipped_pct"] == pytest.approx(clipped, rel=1e-6) and r["clipped_own_pct"] == pytest.approx(own, rel=1e-6)
        assert r["rms_uv"] == pytest.approx(rms, rel=1e-6)


def test_marts_of_the_lake(spark, lake_inputs):
    f = lake_inputs
    quality, windows, summary = f.quality.collect(), f.windows.collect(), f.summary.collect()
    source = {r["lid"]: r["n_samples_src"] for r in f.record.collect()}
    for r in quality:
        assert r["n_samples"] + r["missing_samples"] == source[r["lid"][:14] + "2" + r["lid"][15:]]
    for w in windows:
        assert w["sample_lo"] <= w["sample_hi"] and w["window_start_ms"] % 1000 == 0 and w["std_uv"] >= 0
    for rows in (f.quality, f.windows):
        assert rows.where(lid.is_canary()).count() == 0
        assert rows.where(lid.layer() != 3).count() == 0
    planted = {r["subject_pid"] for r in f.key_map.where("subject_src = 'u9'").collect()}
    assert not planted & {r["subject_pid"] for r in summary}
    present = f.recording.where(~lid.is_canary()).count()
    assert sum(r["n_samples"] for r in quality) == present


def test_windows_of_any_width(spark, lake_inputs):
    whole = gold.feature_window(lake_inputs.record, lake_inputs.recording, 10**9)
    assert whole.count() == lake_inputs.quality.count()


def test_schemas_are_the_contracts(lake_inputs):
    f = lake_inputs
    built = {"bronze/recording": f.bronze_recording, "bronze/electrode": f.bronze_electrode, "bronze/event": f.bronze_event,
             "bronze/ingest_audit": f.audit.select(*DATASETS["bronze/ingest_audit"].fields),
             "silver/subject": f.subject, "silver/record": f.record, "silver/recording": f.recording, "silver/electrode": f.electrode,
             "silver/event": f.event, "gold/channel_quality": f.quality, "gold/experiment_summary": f.summary, "gold/feature_window": f.windows}
    for name, rows in built.items():
        have = [(x.name, x.dataType) for x in rows.schema]
        want = [(x.name, x.dataType) for x in DATASETS[name].schema]
        if name == "bronze/ingest_audit":
            have = [(n, t) for n, t in have if n not in ("bytes", "rows_written", "sample_rate_hz")]
            want = [(n, t) for n, t in want if n not in ("bytes", "rows_written", "sample_rate_hz")]
        assert have == want, name


@pytest.mark.parametrize("levels", [7, None])
@pytest.mark.parametrize("sorted_", [True, False])
@pytest.mark.parametrize("most", [gold.KNOWN_RECORDS, 5])
def test_record_stats_of_few_levels_and_of_continuous_values(spark, levels, sorted_, most):
    """With more records than `most`, one Arrow pass gives the same."""
    value = (F.floor(F.rand(3) * levels) if levels else F.randn(3)).cast("float")
    samples = spark.range(60_000).select(F.concat(F.lit("r"), F.pmod(F.xxhash64("id"), F.lit(23))).alias("lid"),
                                         F.when(F.col("id") % 97 > 0, value).alias("value_uv"))
    samples = samples.sort("lid").cache() if sorted_ else samples.cache()
    got = gold.record_stats(samples, most)
    v = F.col("value_uv")
    ends = samples.groupBy("lid").agg(F.min(v).alias("l"), F.max(v).alias("h"))
    want = samples.join(ends, "lid").groupBy("lid").agg(
        F.count("*").alias("n_samples"), F.sum((v * v).cast("double")).alias("sum_squares"), F.min("l").alias("lo"), F.max("h").alias("hi"),
        F.count_if(v == F.col("l")).alias("n_lo"), F.count_if(v == F.col("h")).alias("n_hi"))
    shape = lambda t: sorted(map(tuple, t.withColumn("sum_squares", F.round("sum_squares", 4)).collect()))
    assert shape(got) == shape(want)


def test_hot_record_of_a_third(spark):
    """A record with a third of all samples, in one window more than in the others: counts stay whole."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50 + 1).alias("c"), F.col("id").alias("sample_idx"),
        (F.col("id") % 97).cast("float").alias("value_uv"))
    samples = rows.withColumn("lid", lid.mint_text(1, 2, 1, 1, 1, "c", 0, 0))
    stats = gold.record_stats(samples).agg(F.sum("n_samples"), F.max("n_samples")).first()
    assert tuple(stats) == (30_000, 10_000)


def test_fixture_scales_agree(spark):
    small, large = Fixture(spark, "/root/testdata/sf0.001"), Fixture(spark, "/root/testdata/sf0.01")
    assert small.bronze_recording.schema == large.bronze_recording.schema

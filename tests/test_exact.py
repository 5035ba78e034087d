import math
import random
import statistics
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sampletide.functions import lid
from sampletide.operators import layout, quantiles, reproducible
from sampletide.session import scratch


def table(spark, rows, schema="g string, x double"):
    return spark.createDataFrame(rows, schema)


def total(values):
    exact = sum(map(Fraction, values))
    return float(exact) if exact else 0.0


CASES = {
    "wide": [1e30, 1e-9, -1e30, 3.5, 1e-300, 5e-324, -7.25e12],
    "cancels": [1e308, -1e308, 1e-10, 2e-10],
    "negative": [-1.0, -1e-20, -3e15, 1e15],
    "tiny": [5e-324] * 3 + [-5e-324],
    "largest": [1.7976931348623157e308, -1.7976931348623157e308, 2.0 ** -1022, 0.1],
    "zero": [0.0, -0.0], "powers": [2.0 ** e for e in range(-1074, 1024, 7)],
}


def test_sums_are_exact_and_do_not_depend_on_partitions(spark):
    rng = random.Random(2)
    cases = CASES | {f"random {i}": [rng.choice([-1, 1]) * math.ldexp(rng.random(), rng.randint(-400, 400)) for _ in range(60)] for i in range(6)}
    rows = [(g, x) for g, own in cases.items() for x in own] + [("zero", None), ("nothing", None)]
    found = []
    for parts in (1, 3, 8):
        rng.shuffle(rows)
        got = reproducible.sums(table(spark, rows).repartition(parts), ["g"], {"s": F.col("x")})
        found.append({r.g: (r.s, r.s_n) for r in got.collect()})
    assert found[0] == found[1] == found[2]
    for g, own in cases.items():
        s, n = found[0][g]
        assert n == len(own) and abs(Fraction(s) - sum(map(Fraction, own))) <= Fraction(math.ulp(total(own))), g
    assert found[0]["nothing"] == (None, 0)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=64).filter(lambda x: abs(x) < 1e300), min_size=1, max_size=30))
def test_any_doubles(spark, values):
    got = reproducible.sums(table(spark, [("a", x) for x in values]), [], {"s": F.col("x")}).first()
    assert abs(Fraction(got.s) - sum(map(Fraction, values))) <= Fraction(math.ulp(total(values)))


def test_sums_of_special_values(spark):
    inf = float("inf")
    rows = [("nan", float("nan")), ("nan", 1.0), ("up", inf), ("up", 1.0), ("down", -inf), ("both", inf), ("both", -inf), (None, 2.5), (None, 0.5)]
    got = {r.g: r.s for r in reproducible.sums(table(spark, rows), ["g"], {"s": F.col("x")}).collect()}
    assert math.isnan(got["nan"]) and math.isnan(got["both"]) and (got["up"], got["down"], got[None]) == (inf, -inf, 3.0)
    assert reproducible.sums(table(spark, []), ["g"], {"s": F.col("x")}).collect() == []


def test_moments(spark):
    values = [1.5, -2.0, 4.25, 1e-3]
    got = reproducible.moments(table(spark, [("a", x) for x in values]), ["g"], "x").first()
    assert got.n == 4 and got.mean == pytest.approx(statistics.fmean(values)) and got.stddev == pytest.approx(statistics.pstdev(values))


@pytest.fixture(scope="module")
def groups():
    """Skewed groups: one with most rows, values over many magnitudes, long ties, special values."""
    rng = random.Random(6)
    inf = float("inf")
    out = {"hot": [rng.choice([-1, 1]) * math.ldexp(rng.random(), rng.randint(-300, 300)) for _ in range(4001)],
           "even": [rng.gauss(0, 1) for _ in range(1000)], "ties": [3.25] * 700 + [1.0] * 10 + [9.0] * 10, "one": [42.0], "two": [1.0, 2.0],
           "ends": [inf] * 40 + [-inf] * 40 + [0.5, -0.5, 0.0], "close": [1.0 + i * 2.0 ** -52 for i in range(300)], None: [7.0, 5.0, 6.0], "huge": [1.7e308, -1.7e308, 1e308]}
    return out


@pytest.mark.parametrize("few", [1, 50, 50_000])
def test_medians(spark, groups, few):
    rows = [(g, x) for g, own in groups.items() for x in own] + [("even", None), ("nothing", None)]
    random.Random(1).shuffle(rows)
    got = {r.g: r.median for r in quantiles.median(table(spark, rows).repartition(5), ["g"], "x", few).collect()}
    assert got.keys() == groups.keys()
    for g, own in groups.items():
        ordered = sorted(own)
        low, high = ordered[(len(own) - 1) // 2], ordered[len(own) // 2]
        assert got[g] == (low if low == high else low / 2 + high / 2), g


def test_order_statistics_of_a_whole_table(spark):
    values = [float(x) for x in range(500)] + [float("nan")] * 3
    ranks = lambda n: [F.lit(0), n - 4, n - 1]
    got = {r.which: r.value for r in quantiles.order_statistics(table(spark, [("a", x) for x in values]), [], "x", ranks, 20).collect()}
    assert got[0] == 0.0 and got[1] == 499.0 and math.isnan(got[2])
    assert quantiles.median(table(spark, []), ["g"], "x").collect() == []


def test_no_buffer_of_a_group(spark, groups):
    """Plans hold neither a percentile nor a collected list."""
    plan = quantiles.median(table(spark, [(g, x) for g, own in groups.items() for x in own]), ["g"], "x", 50)._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "collect" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("few", [1, 3, 100_000])
@pytest.mark.parametrize("n", [0, 1, 2, 7, 300])
def test_middle_id(spark, few, n):
    rng = random.Random(n)
    ids = sorted({f"{rng.choice(['018c', '018d', '7f00'])}{rng.randint(0, 3):04x}-{rng.randint(0, 1):04x}-2010-{rng.randint(0, 9):04x}-1{rng.randint(0, 99):011x}" for _ in range(n)})
    frame = table(spark, [(i,) for i in ids for _ in range(rng.randint(1, 3))] + [(None,)], "lid string")
    assert layout.middle_id(frame, few) == (ids[len(ids) // 2] if ids else None)


def test_point_read_leaves_out_row_groups(spark):
    """The read is a pushed equality; the scan returns the row groups that may hold the id and no others."""
    path = scratch(spark, "point")
    made = spark.range(200_000).select(lid.mint_text(1_704_067_200_000, 2, 1, 1, "id div 16000", "(id div 100) % 160", 0, 0).alias("lid"), F.col("id").cast("float").alias("value_uv"))
    made.sortWithinPartitions("lid").write.option("parquet.block.row.count.limit", 5_000).parquet(path)
    samples = spark.read.parquet(path)
    wanted = layout.middle_id(samples)
    found = layout.record_read(samples, wanted)
    row = found.collect()[0]
    plan = found._jdf.queryExecution().executedPlan()
    assert f"PushedFilters: [IsNotNull(lid), EqualTo(lid,{wanted})]" in plan.toString()
    scans = [plan for plan in _nodes(plan) if plan.nodeName().startswith("Scan parquet")]
    read = sum(s.metrics().apply("numOutputRows").value() for s in scans)
    assert row.n_samples == 100 and row.n_samples <= read <= 40_000
    assert layout.middle_record(samples).first() == row


def _nodes(plan):
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    if "QueryStageExec" in plan.getClass().getSimpleName():
        plan = plan.plan()
    yield plan
    for i in range(plan.children().size()):
        yield from _nodes(plan.children().apply(i))

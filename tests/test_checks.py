import pytest
from pyspark.sql import functions as F

from sampletide.operators import checks
from sampletide.sources import files, rules, writer
from sampletide.sources.registry import DATASETS


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame([("a", 1), ("b", 2), ("b", 2), (None, 3), (None, 3)], "pid string, n int")


def value(rows):
    return rows.first()["observed"]


def test_not_null_and_unique(people):
    assert {r["column_name"]: r["observed"] for r in checks.null_counts(people, ["pid", "n"]).collect()} == {"pid": 2, "n": 0}
    # Two groups repeat: 'b', and NULL counts as one group.
    assert value(checks.duplicate_groups(people, ["pid"])) == 2
    assert value(checks.duplicate_groups(people.distinct(), ["pid", "n"])) == 0


def test_row_count_identifier_and_values(people):
    assert value(checks.row_count(people)) == 5
    assert value(checks.forbidden_columns(people, ["pid", "other"])) == 1
    assert value(checks.outside_values(people, "pid", ["a"])) == 2


@pytest.mark.parametrize("kind, observed, expected, result", [
    ("not_null", "0", "0", "pass"), ("not_null", "1", "0", "fail"), ("row_count_min", "5", "1", "pass"),
    ("row_count_min", "0", "1", "fail"), ("retention", "3.5", "30", "pass"), ("retention", "31", "30", "fail"),
    ("sql", "no records", "no records", "pass"), ("sql", "1 of 2: x", "no records", "fail"), ("unique", "0.0", "0", "pass"),
])
def test_verdicts(spark, kind, observed, expected, result):
    row = spark.createDataFrame([(kind, observed, expected)], "k string, o string, e string")
    assert row.select(checks.verdict(F.col("k"), F.col("o"), F.col("e"))).first()[0] == result


@pytest.mark.parametrize("n, text", [
    (0, "no records"), (3, "3 of 10: x3, x2, x1"), (5, "5 of 10: x5, x4, x3, x2, x1"), (6, "6 of 10: x6, x5, x4, x3, x2 and more")])
def test_offenders_are_named_in_order(spark, n, text):
    rows = spark.range(1, 11)
    found = rows.where(F.col("id") <= n).select(F.concat(F.lit("x"), "id").alias("offender"), "id")
    assert value(checks.offender_text(found, [F.desc("id")], rows)) == text


def test_event_rates_use_the_median_of_their_experiment(spark):
    summary = spark.createDataFrame([("e", "a", 60.0, 10), ("e", "b", 60.0, 10), ("e", "c", 60.0, 21), ("e", "d", 60.0, 4), ("e", "z", 0.0, 9),
                                     ("f", "a", 60.0, 99)], "experiment string, subject_pid string, duration_s float, n_events int")
    assert sorted(r["offender"] for r in checks.odd_event_rates(summary).collect()) == ["e c", "e d"]


def test_rules_expand_by_pattern(spark):
    rows = spark.createDataFrame([("r1", "gold/*", {"min": "1"}, "at least {{min}}"), ("r2", "published/copy", {}, "c"),
                                  ("r3", "silver/record", {"columns": '["a","b"]'}, "c")],
                                 "requirement_id string, dataset string, params map<string,string>, control string").withColumn("check_kind", F.lit("k"))
    made = {r["check_id"]: (r["dataset"], r["control"]) for r in checks.expand_rules(rows).collect()}
    gold = [n for n in DATASETS if n.startswith("gold/")]
    assert {f"r1/k/{n}/1" for n in gold} < set(made)
    assert made["r2/k/published/copy"] == ("published/copy", "c")
    assert "r3/k/silver/record/['a', 'b']" in made
    assert made["r1/k/gold/evidence/1"] == ("gold/evidence", "at least 1")


def test_contract_rules_cover_every_required_and_unique_column():
    owned = rules.contract_rules()
    for name, d in DATASETS.items():
        mine = [r for r in owned if r.dataset == name]
        assert [r.params["column"] for r in mine if r.kind == "not_null"] == d.required
        assert len([r for r in mine if r.kind == "unique"]) == len(d.unique)
    assert len({r.check_id for r in owned}) == len(owned)


def test_hash_match_sees_changed_and_missing_files(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for name in "abc":
        (raw / f"{name}.mat").write_bytes(name.encode() * 10)
    audit = files.digests(spark, str(raw), "*.mat").select(
        F.regexp_replace("path", r"^.*/raw/", "raw/").alias("source_path_rel"), "sha256").persist()
    audit.count()
    look = lambda: value(checks.digest_mismatches(audit, files.digests(spark, str(raw), "*.mat"), str(tmp_path)))
    assert look() == 0
    (raw / "a.mat").write_bytes(b"x")
    assert look() == 1
    (raw / "b.mat").unlink()
    assert look() == 2


def test_layout_rule(spark, lake_inputs, tmp_path):
    writer.layout_write(lake_inputs.recording, str(tmp_path / "s"), ranges=1, rows_per_group=5)
    found = files.footers(spark, str(tmp_path / "s"))
    assert value(checks.layout_violations(found, 5, 1)) == 0
    assert value(checks.layout_violations(found, 4, 1)) > 0
    assert value(checks.layout_violations(found, 5, 10**6)) == found.select("file").distinct().count()


def test_age_of_files(spark, tmp_path):
    import os
    import time
    (tmp_path / "old.parquet").write_bytes(b"x")
    then = time.time() - 10 * 86400
    os.utime(tmp_path / "old.parquet", (then, then))
    (tmp_path / "new.parquet").write_bytes(b"x")
    assert value(checks.oldest_age_days(files.listing(spark, str(tmp_path), "*.parquet"))) == pytest.approx(10, abs=0.01)

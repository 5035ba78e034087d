"""Things done twice: appends, digests, versions, uniqueness rules."""

import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sampletide.operators import checks, diff
from sampletide.session import scratch
from sampletide.sources import batches, digest_index, files

SCHEMA = "k long, part string, x double"


@pytest.fixture
def rows(spark):
    return spark.range(100).select(F.col("id").alias("k"), F.concat(F.lit("p"), F.col("id") % 3).alias("part"), (F.col("id") / 7).alias("x"))


def ids(frame):
    return sorted(r.k for r in frame.collect())


def test_a_batch_counts_once(spark, rows):
    path, schema = scratch(spark, "batches"), rows.schema
    assert ids(batches.read(spark, path, schema)) == []
    assert batches.append(rows.where("k < 40"), path, "run/1", "part")
    assert not batches.append(rows.where("k < 40"), path, "run/1", "part")
    batches.write_attempt(rows.where("k >= 40"), path, "part")
    assert ids(batches.read(spark, path, schema)) == list(range(40))
    assert [r.n_rows for r in batches.abandoned(spark, path, schema).collect()] == [60]
    assert batches.append(rows.where("k >= 40"), path, "run/2", "part")
    assert ids(batches.read(spark, path, schema)) == list(range(100))


def test_of_two_writers_one_commits(spark, rows):
    path = scratch(spark, "race")
    first, second = (batches.write_attempt(rows, path) for _ in range(2))
    assert [batches.commit(spark, path, "b", a) for a in (second, first)] == [True, False]
    assert ids(batches.read(spark, path, rows.schema)) == list(range(100))
    assert [r.attempt for r in batches.abandoned(spark, path, rows.schema).collect()] == [first]
    assert sorted(f for f in os.listdir(f"{path}/commits") if not f.startswith(".")) == ["b"]


def test_uncommitted_attempts_are_not_scanned(spark, rows):
    """The attempt is a partition: the plan prunes it by the commits."""
    path = scratch(spark, "pruned")
    batches.append(rows, path, "a")
    batches.write_attempt(rows, path)
    plan = batches.read(spark, path, rows.schema)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(attempt" in plan and "NestedLoop" not in plan


def test_stream_replayed_from_the_start(spark, rows):
    """A stream that lost its checkpoint sends its batches again; the table stays as it was."""
    source, path = scratch(spark, "source"), scratch(spark, "sink")
    for i in range(3):
        rows.where(F.col("k") % 3 == i).coalesce(1).write.mode("append").parquet(source)
    for _ in range(2):
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
        run = stream.writeStream.foreachBatch(lambda batch, n: batches.append(batch, path, f"stream-{n}")).option(
            "checkpointLocation", scratch(spark, "checkpoint")).trigger(availableNow=True).start()
        run.awaitTermination()
        assert ids(batches.read(spark, path, rows.schema)) == list(range(100))


def test_only_changed_files_are_hashed(spark):
    root, index = scratch(spark, "files"), scratch(spark, "index")
    lines = spark.createDataFrame([(f"f{i}.parquet", f"line {i}") for i in range(6)], "path string, line string")
    files.write_lines(lines, root)

    def run(again=0.0):
        return {r.path.rsplit("/", 1)[1]: (r.state, r.sha256) for r in digest_index.digests(spark, root, index, again=again).collect()}
    first = run()
    assert {s for s, _ in first.values()} == {"new"}
    assert {k: v[1] for k, v in run().items()} == {k: v[1] for k, v in first.items()} and {s for s, _ in run().values()} == {"known"}
    files.write_lines(lines.where("path = 'f1.parquet'").withColumn("line", F.lit("other")), root)
    changed = run()
    assert {k for k, (s, _) in changed.items() if s == "new"} == {"f1.parquet"} and changed["f1.parquet"][1] != first["f1.parquet"][1]
    # Content that changed under the same length and time is found when the file is hashed again.
    place = f"{root}/f2.parquet"
    was = os.stat(place)
    with open(place, "w") as out:
        out.write("line X")
    os.utime(place, ns=(was.st_atime_ns, was.st_mtime_ns))
    assert run()["f2.parquet"][0] == "known"
    sampled = run(again=1.0)
    assert sampled["f2.parquet"][0] == "altered" and {s for k, (s, _) in sampled.items() if k != "f2.parquet"} == {"same"}


def test_lines_of_a_long_file_are_streamed(spark):
    root = scratch(spark, "long")
    lines = spark.range(3000).select(F.lit("a/b.txt").alias("path"), F.format_string("%05d%s", "id", F.repeat(F.lit("."), 3000)).alias("line"))
    files.write_lines(lines.unionByName(spark.createDataFrame([("a/empty.txt", None)], "path string, line string")).repartition(7), root)
    with open(f"{root}/a/b.txt") as source:
        found = source.read().split("\n")
    assert [x[:5] for x in found] == [f"{i:05d}" for i in range(3000)] and os.path.getsize(f"{root}/a/empty.txt") == 0


@pytest.mark.parametrize("leaves", [1 << 24, 8192])
def test_changes(spark, leaves):
    rng = random.Random(5)
    old = [(k, rng.choice("ab"), rng.random()) for k in range(400)] + [(None, "n", 1.0), (9, "twice", 0.0), (500, None, None), (501, "x", None)]
    new = [r for r in old if r[0] is None or r[0] % 50] + [(600 + i, "new", 0.5) for i in range(5)]
    new = [(k, p, x + 1 if x is not None and k is not None and k % 37 == 1 else x) for k, p, x in new]
    new = [(k, "n2", x) if k is None else (k, x if k == 501 else p, None) if k == 500 else (k, p, x) for k, p, x in new]
    new = [(500, "x", None) if r[0] == 500 else r for r in new] + [(11, "again", 2.0)]
    a, b = spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA).withColumn("extra", F.lit(1))
    got = {r.k: r.change for r in diff.changes(a, b, ["k"], leaves).collect()}
    want = {}
    for k in {r[0] for r in old + new}:
        x, y = (sorted([r[1:] for r in t if r[0] == k], key=str) for t in (old, new))
        if x != y:
            want[k] = "inserted" if not x else "deleted" if not y else "changed"
    assert got == want and {"inserted", "deleted", "changed"} == set(got.values())


def test_equal_versions_join_nothing(spark, rows):
    assert diff.changes(rows, rows.repartition(3), ["k"]).collect() == []
    assert diff.changes(rows.limit(0), rows.limit(0), ["k"]).collect() == []
    assert {r.change for r in diff.changes(rows.limit(0), rows, ["k"]).collect()} == {"inserted"}


def test_unique_rules_in_one_scan(spark):
    rng = random.Random(7)
    data = [(rng.choice([None, 1, 2, 3]), rng.choice([None, 1, 2, 3]), rng.choice(["a", "b", None]), rng.choice([0.0, -0.0, float("nan"), 1.5, None]), i) for i in range(60)]
    frame = spark.createDataFrame(data, "a int, b int, c string, d double, e int")
    rules = {"ab": ["a", "b"], "ba": ["b", "a"], "c": ["c"], "d": ["d"], "cd": ["c", "d"], "e": ["e"], "ae": ["a", "e"]}
    got = {r.check_id: r.observed for r in checks.duplicate_groups_of(frame, rules).collect()}
    assert got == {name: checks.duplicate_groups(frame, columns).first().observed for name, columns in rules.items()}
    assert {r.observed for r in checks.duplicate_groups_of(frame.limit(0), rules).collect()} == {0}


def test_swapped_nulls_are_no_duplicates(spark):
    """Hashing passes over nulls, so the two rows share a hash; compared in full they differ."""
    frame = spark.createDataFrame([(None, 5), (5, None)], "a int, b int")
    assert checks.duplicate_groups_of(frame, {"ab": ["a", "b"]}).first().observed == 0


def test_unique_rules_read_and_deal_a_key_once(spark, monkeypatch):
    """Keys that repeat are no text and no second join: one scan, one exchange of values, and many tasks for many keys."""
    monkeypatch.setattr(checks, "ENTRIES_PER_TASK", 100)
    frame = spark.range(3000).selectExpr("id div 2 as a", "id % 700 as b", "if(id % 3 = 0, null, id) as c")
    rules = {"a": ["a"], "ab": ["a", "b"], "ba": ["b", "a"], "c": ["c"]}
    found = checks.duplicate_groups_of(frame, rules)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("Range") == 1 and "to_json" not in plan and "Repartition 90" in plan
    assert {r.check_id: r.observed for r in found.collect()} == {"a": 1500, "ab": 0, "ba": 0, "c": 1}


def test_a_task_returns_a_row_per_file_and_not_per_line(tmp_path):
    """Lines of a path that batches cut, empty lines and a path without any."""
    given = [("a", "x"), ("a", None), ("a", ""), ("b/c", None), ("d", ""), ("d", "é")]
    for size in (1, 2, 6):
        root = tmp_path / str(size)
        root.mkdir()
        batches = [pa.RecordBatch.from_pylist([{"path": p, "line": v} for p, v in given[i:i + size]], pa.schema([("path", pa.string()), ("line", pa.string())]))
                   for i in range(0, len(given), size)]
        assert [p for b in files._line_files(f"file://{root}")([*batches, batches[0].slice(0, 0)]) for p in b.column(0).to_pylist()] == ["a", "b/c", "d"]
        assert {n: (root / n).read_text() for n in ("a", "b/c", "d")} == {"a": "x\n", "b/c": "", "d": "\né"}
        assert sorted(p.name for p in root.rglob("*") if p.is_file()) == ["a", "c", "d"]

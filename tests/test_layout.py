import hashlib

import pytest
from pyspark.sql import functions as F

from sampletide.operators import layout
from sampletide.session import scratch
from sampletide.sources import files, reader, writer
from sampletide.sources.registry import DATASETS


@pytest.fixture(scope="module")
def samples(spark, lake_inputs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("layout") / "recording")
    writer.layout_write(lake_inputs.recording, path, ranges=6, rows_per_group=7)
    return path


def read(spark, path):
    return spark.read.schema(DATASETS["silver/recording"].schema).parquet(path)


def test_files_are_sorted_and_bounded(spark, lake_inputs, samples):
    rows = read(spark, samples)
    order = files.out_of_order(rows).collect()
    assert sum(r["rows"] for r in order) == lake_inputs.recording.count()
    assert sum(r["out_of_order"] for r in order) == 0
    assert files.footers(spark, samples).agg(F.max("group_rows")).first()[0] <= 7


def test_one_partition_keeps_its_order(spark, lake_inputs, tmp_path):
    """A constant leading partition is the case in which the planned write would lose the order."""
    path = str(tmp_path / "one")
    one = lake_inputs.recording.where("experiment = 'click'").withColumn("experiment", F.lit("click"))
    writer.layout_write(one, path, ranges=1)
    assert files.out_of_order(read(spark, path)).agg(F.sum("out_of_order")).first()[0] == 0


def test_hot_partition_is_cut_into_ranges(spark, tmp_path):
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("e"), F.col("id") % 40)).alias("experiment"), F.lit("p").alias("subject_pid"),
        F.lit("x").alias("lid"), F.col("id").alias("sample_idx"))
    path = str(tmp_path / "hot")
    writer.layout_write(rows, path, ranges=9)
    hot = files.listing(spark, path, "*.parquet").where(F.col("path").contains("experiment=hot")).count()
    assert hot >= 3
    assert spark.read.parquet(path).count() == 9000


def test_ranges_follow_the_rows(spark, tmp_path, monkeypatch):
    """Rows that take few bytes at rest are cut into ranges all the same, each written by its task."""
    monkeypatch.setattr(writer, "RANGE_ROWS", 500)
    path = str(tmp_path / "many")
    rows = spark.range(5000).select(F.lit("a").alias("experiment"), F.lit("p").alias("subject_pid"), F.lit("0").alias("lid"), F.col("id").alias("sample_idx"))
    writer.layout_write(rows, path)
    held = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert len(held) == 10 and max(held) < 1000 and sum(held) == 5000


def test_row_groups_follow_the_rows_of_a_partition(spark, tmp_path):
    """Each file has two groups and more, and a large one not thousands: every reader of a part of it reads about them all."""
    path = str(tmp_path / "groups")
    sizes = {"a": 2, "b": 37, "c": 5000, "d": 40_000, None: 90}
    named = F.explode(F.array(*[F.struct(F.lit(k).cast("string").alias("experiment"), F.lit(n).alias("n")) for k, n in sizes.items()]))
    rows = spark.range(40_000).select("id", named.alias("s")).where("id < s.n").select(
        "s.experiment", F.lit("p").alias("subject_pid"), F.lit("0").alias("lid"), F.col("id").alias("sample_idx"))
    writer.layout_write(rows, path, groups_per_file=2)
    kept = spark.read.parquet(path)
    assert {r["experiment"]: r["count"] for r in kept.groupBy("experiment").count().collect()} == sizes
    groups = files.footers(spark, path).groupBy("file").agg(F.count_distinct("row_group").alias("n")).collect()
    assert len(groups) == len(sizes) and all(2 <= r["n"] <= 9 for r in groups)
    assert files.out_of_order(kept).agg(F.sum("out_of_order")).first()[0] == 0


@pytest.mark.parametrize("batch", [1, 2, 3, 10000])
def test_disorder_is_found_across_batches(spark, tmp_path, batch):
    path = str(tmp_path / "u")
    keys = [1, 2, 3, 2, 5, 4, 4, 9, 8]
    spark.createDataFrame([("x", k) for k in keys], "lid string, sample_idx long").coalesce(1).write.parquet(path)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    found = files.out_of_order(spark.read.parquet(path)).first()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10000)
    assert (found["rows"], found["out_of_order"]) == (9, sum(b < a for a, b in zip(keys, keys[1:])))


def test_disorder_between_scan_tasks_is_found(spark, tmp_path):
    """Small row groups read by different tasks: the only disorder lies between two of them."""
    path = str(tmp_path / "split")
    keys = [*range(500, 1000), *range(500)]
    (spark.createDataFrame([("x" * 200, k) for k in keys], "lid string, sample_idx long").coalesce(1)
     .write.option("parquet.block.row.count.limit", 100).option("parquet.enable.dictionary", "false").parquet(path))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = spark.read.parquet(path)
        assert rows.rdd.getNumPartitions() > 1
        found = files.out_of_order(rows).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [(r["rows"], r["out_of_order"]) for r in found] == [(1000, 1)]


def test_rising_integers_are_stored_as_deltas(spark, samples):
    chunks = files.footers(spark, samples).where(F.col("column_name").isin("sample_idx", "ts_ms")).select("encodings").distinct().collect()
    assert all("DELTA_BINARY_PACKED" in r["encodings"] for r in chunks)


def test_encodings_do_not_change_content(spark, lake_inputs, tmp_path):
    report = layout.layout_variants(spark, lake_inputs.recording, str(tmp_path), [
        (v, c, 1000) for v in ("v1", "v2") for c in ("snappy", "zstd")]).collect()
    assert len(report) == 4 and len({(r["n_rows"], r["total"]) for r in report}) == 1
    assert len({r["sample_idx_encodings"] for r in report}) == 2


def test_middle_record_is_the_middle(lake_inputs):
    ids = sorted(r["lid"] for r in lake_inputs.recording.select("lid").distinct().collect())
    assert layout.middle_record(lake_inputs.recording).first()["lid"] == ids[len(ids) // 2]


def test_empty_files_are_reported(spark, tmp_path):
    (tmp_path / "a.parquet").write_bytes(b"")
    (tmp_path / "b.parquet").write_bytes(b"x")
    (tmp_path / "d" / "e").mkdir(parents=True)
    (tmp_path / "d" / "e" / "c.parquet").write_bytes(b"")
    assert [r["path"].rsplit("/")[-1] for r in files.aborted(spark, str(tmp_path), scratch(spark, "test-listing")).orderBy("path").collect()] == ["a.parquet", "c.parquet"]


def test_dataset_version_is_the_digest_of_sorted_digests(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"{i}.parquet").write_bytes(bytes([i]) * 100)
    rows = files.digests(spark, str(tmp_path)).withColumn("dataset", F.lit("d"))
    other = rows.where("length < 0").unionByName(rows.withColumn("dataset", F.lit("e")).limit(1))
    got = {r["dataset"]: r["dataset_version"] for r in files.dataset_versions(rows.unionByName(other)).collect()}
    each = sorted(hashlib.sha256(bytes([i]) * 100).hexdigest() for i in range(5))
    assert got["d"] == hashlib.sha256("\n".join(each).encode()).hexdigest()
    assert len(got) == 2


def test_partition_values_stay_text(spark, tmp_path):
    schema = DATASETS["silver/event"].schema
    rows = spark.createDataFrame([("0123", "0009", 1, 5, 1, None, "x")], "experiment string, subject_pid string, run short, ts_ms long, "
                                 "event_code short, event_label string, lid string")
    writer.write_dataset(rows, str(tmp_path), "silver/event")
    back = reader.dataset(spark, str(tmp_path), "silver/event")
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in schema]
    assert (back.first()["experiment"], back.first()["subject_pid"]) == ("0123", "0009")


def test_dataset_without_files_is_empty_and_typed(spark, tmp_path):
    for name, described in DATASETS.items():
        rows = reader.dataset(spark, str(tmp_path), name)
        assert rows.columns == described.fields and rows.count() == 0


def test_layers_are_summed_per_experiment(spark, lake):
    sizes = {(r["layer"], r["experiment"]): r["bytes"] for r in files.sizes(spark, lake).collect()}
    assert len(sizes) == 10 and all(b > 0 for b in sizes.values())

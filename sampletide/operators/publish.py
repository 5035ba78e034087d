"""Publication gates, manifests and the reports read from evidence."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampletide.functions import lid
from sampletide.operators.checks import latest_run
from sampletide.sources import files

# Limits of a published copy in bytes.
FILE_LIMIT = 95 * 1024**2
TOTAL_LIMIT = 500 * 1024**2


def leaks(rows: DataFrame) -> DataFrame:
    """Canary rows per file of a scanned table, every file listed."""
    return rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.count_if(lid.is_canary("lid")).alias("canary_rows"))


def size_gate(files: DataFrame, file_limit: int = FILE_LIMIT, total_limit: int = TOTAL_LIMIT) -> DataFrame:
    """One row: files over the limit, all bytes, and whether publication may go on."""
    totals = files.agg(F.count(F.lit(1)).alias("files"), F.count_if(F.col("length") > file_limit).alias("files_over"),
                       F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
    fits = (F.col("files_over") == 0) & (F.col("bytes") <= total_limit)
    return totals.withColumn("allowed", F.when(fits, 1).otherwise(0))


def published_files(digests: DataFrame, root: str) -> DataFrame:
    """path below the root, bytes, sha256."""
    below = F.regexp_replace("path", "^file:/+", "/")
    return digests.select(F.substr(below, F.lit(len(root.rstrip("/")) + 2)).alias("path"),
                          F.col("length").alias("bytes"), "sha256")


def publish_files(spark: SparkSession, source: str, out: str, below: str, gate=None) -> DataFrame:
    """Copy the files of `source` into a new version of `out`, list them, and point to the version last.

    Returns path (below the version), bytes, sha256, version. The list is that of the source joined to the digests of
    the copies, so nothing that lies in the target by accident is in it, and a copy that is lost fails the job. Older
    versions stay as they are; `current` names the one to read. `gate(place)` may refuse the finished version.
    """
    version = uuid.uuid4().hex
    place = f"{out.rstrip('/')}/{version}"
    copied = files.copy(spark, source, f"{place}/{below}")
    copied.write.format("noop").mode("overwrite").save()
    start = len(source.split("://", 1)[-1].rstrip("/")) + 2
    listed = files.listing(spark, source, "*.parquet").select(
        F.concat(F.lit(f"{below}/"), F.expr(f"substr(regexp_replace(path, '^file:/+', '/'), {start})")).alias("path"), F.col("length").alias("bytes"))
    arrived = published_files(files.digests(spark, f"{place}/{below}"), place).select("path", "sha256")
    checked = listed.join(arrived, "path", "left").withColumn("sha256", F.coalesce("sha256", F.raise_error(F.concat(F.lit("not copied: "), F.col("path")))))
    checked.withColumn("version", F.lit(version)).write.json(f"{place}/manifest")
    if gate:
        gate(place)
    spark.createDataFrame([(version,)], "value string").coalesce(1).write.mode("overwrite").text(f"{out.rstrip('/')}/current")
    return spark.read.schema("path string, bytes long, sha256 string, version string").json(f"{place}/manifest")


def verify(received: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files of the manifest that were received, how many of them differ from it, and how many never arrived."""
    joined = manifest.select("path", F.col("sha256").alias("published")).join(received.select("path", "sha256"), "path", "left")
    there = F.col("sha256").isNotNull()
    return joined.agg(F.count_if(there).alias("files"), F.count_if(there & (F.col("sha256") != F.col("published"))).alias("mismatches"),
                      F.count_if(~there).alias("missing"))


def withheld_checks(checks: DataFrame, files: DataFrame) -> DataFrame:
    """Checks that read a dataset of which a file did not verify, by name or in their SQL text.

    The names a check mentions are pulled out of its text, which turns the text search into an equality join.
    """
    bad = files.where(F.col("received").isNull() | (F.col("received") != F.col("sha256"))).select(
        F.split_part("path", F.lit("/"), F.lit(2)).alias("mart")).distinct()
    named = F.regexp_extract_all("sql", F.lit(r"\bgold_(\w+)"), F.lit(1))
    own = F.when(F.col("dataset").startswith("gold/"), F.array(F.expr("substr(dataset, 6)"))).otherwise(F.array())
    touched = checks.select("check_id", F.explode(F.array_distinct(F.concat(named, own))).alias("mart"))
    ids = touched.join(bad, "mart", "left_semi").select("check_id").distinct()
    return checks.join(ids, "check_id", "left_semi")


def build_summary(evidence: DataFrame, manifest: DataFrame) -> DataFrame:
    """The numbers of the latest run and build, one row."""
    latest = latest_run(evidence)
    bronze = manifest.where("layer = 1").agg(F.sum("n_records").cast("bigint"))
    samples = manifest.where("dataset = 'silver/recording'").agg(F.max("n_records"))
    failed = F.col("result") != "pass"
    return latest.agg(
        F.count_distinct(F.when(F.col("dataset").startswith("gold/"), F.col("dataset"))).alias("gold_datasets"),
        F.count(F.lit(1)).alias("checks"), F.count_if(F.col("result") == "pass").alias("n_pass"),
        F.count_if(failed & (F.col("severity") == "block")).alias("n_fail"),
        F.count_if(failed & (F.col("severity") == "flag")).alias("n_flag"),
        F.date_format(F.min("ran_at"), "yyyy-MM-dd HH:mm:ss").alias("ran_at"),
        F.left(F.max("git_commit"), F.lit(7)).alias("git_commit"),
    ).select("gold_datasets", bronze.scalar().alias("bronze_rows"), samples.scalar().alias("samples"),
             "checks", "n_pass", "n_fail", "n_flag", "ran_at", "git_commit")


def as_pairs(row: DataFrame) -> DataFrame:
    """A one-row table as (name, value) text rows."""
    pairs = [F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in row.columns]
    return row.select(F.inline(F.array(*pairs)))


def summary_diff(published: DataFrame, live: DataFrame) -> DataFrame:
    """Values that are not the same in the published and the recomputed summary."""
    p = as_pairs(published).withColumnRenamed("value", "published")
    v = as_pairs(live).withColumnRenamed("value", "recomputed")
    return p.join(v, "name", "full").where(~F.col("published").eqNullSafe(F.col("recomputed")))


def unknown_commits(evidence: DataFrame, manifest: DataFrame, history: DataFrame) -> DataFrame:
    """Recorded commits that are no hash or not in the history."""
    recorded = evidence.select("git_commit").union(manifest.select("git_commit")).distinct()
    marked = recorded.withColumn("is_hash", F.when(F.col("git_commit").rlike("^[0-9a-f]{7,40}$"), 1).otherwise(0))
    known = history.select("git_commit", F.lit(1).alias("is_hash")).distinct()
    return marked.join(known, ["git_commit", "is_hash"], "left_anti").select("git_commit", "is_hash")


def noisiest_channels(quality: DataFrame, limit: int = 100) -> DataFrame:
    """The report's top hundred by noise share; records without one come last."""
    top = quality.orderBy(F.col("line_noise_ratio").desc_nulls_last(), "lid").limit(limit)
    return top.withColumn("lid", lid.crockford())


def _outcome():
    return [F.count(F.lit(1)).alias("checks"), F.count_if(F.col("result") == "pass").alias("n_pass"),
            F.count_if(F.col("result") != "pass").alias("n_not_pass")]


def framework_coverage(evidence: DataFrame) -> DataFrame:
    elsewhere = F.count_if(~F.col("dataset").startswith("gold/")).alias("n_elsewhere")
    return latest_run(evidence).groupBy("framework").agg(*_outcome(), elsewhere)


def run_history(evidence: DataFrame) -> DataFrame:
    return evidence.groupBy("run_id").agg(
        *_outcome(), F.min("ran_at").alias("ran_at"), F.max("git_commit").alias("git_commit")).orderBy(F.desc("run_id"))


def evidence_matrix(evidence: DataFrame) -> DataFrame:
    return evidence.groupBy("framework", "severity", "result").agg(F.count(F.lit(1)).alias("n"))


def ranked_checks(evidence: DataFrame) -> DataFrame:
    """Reading order of the latest run: not passed, privacy, lineage, flags, others, contract rules.

    Passed contract rules are one line per dataset, counted before the sort.
    """
    contract = F.col("framework") == "contract"
    rank = (F.when(F.col("result") != "pass", 0).when(F.col("framework") == "GDPR-Art9", 1)
            .when(~contract & F.col("check_id").contains("lid"), 2).when(F.col("severity") == "flag", 3)
            .when(contract, 5).otherwise(4))
    grouped = contract & (F.col("result") == "pass")
    listed = latest_run(evidence).select(
        rank.alias("place"), F.when(grouped, F.lit("contract rules")).otherwise(F.col("check_id")).alias("check_id"),
        "dataset", "result")
    return (listed.groupBy("place", "check_id", "dataset", "result").agg(F.count(F.lit(1)).alias("n"))
            .orderBy("place", "check_id", "dataset", "result"))


def build_inventory(recording: DataFrame, file_sizes: DataFrame | None = None) -> DataFrame:
    """Subjects, runs, channels and samples per experiment, canary subjects left out; bytes when given."""
    kept = recording.where(~lid.is_canary("lid"))
    records = kept.groupBy("experiment", "subject_src", "run", "channel_idx").agg(F.count(F.lit(1)).alias("samples"))
    table = records.groupBy("experiment").agg(
        F.count_distinct("subject_src").alias("subjects"), F.count_distinct(F.struct("subject_src", "run")).alias("runs"),
        F.count(F.lit(1)).alias("channels"), F.sum("samples").alias("samples"))
    if file_sizes is None:
        return table
    for layer in ("bronze", "silver"):
        held = file_sizes.where(F.col("layer") == layer).select("experiment", F.col("bytes").alias(f"{layer}_bytes"))
        table = table.join(held, "experiment", "left")
    return table


def build_span(evidence: DataFrame, audit: DataFrame) -> DataFrame:
    """Files, first ingestion, end of the first check run, and the milliseconds between."""
    first = evidence.where(F.col("run_id") == evidence.agg(F.min("run_id")).scalar())
    began = audit.agg(F.min("ingested_at")).scalar()
    return first.agg(F.max("ran_at").alias("ended_at")).select(
        audit.agg(F.count(F.lit(1))).scalar().alias("files"), began.alias("began_at"), "ended_at").withColumn(
            "span_ms", F.timestamp_diff("MILLISECOND", F.col("began_at"), F.col("ended_at")))

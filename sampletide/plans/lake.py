"""A whole lake: Bronze, Silver, Gold, checks and publication as one chain of Spark jobs."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampletide.functions import sql as sql_functions
from sampletide.operators import checks, gold, lineage, manifest, publish, silver, spectral
from sampletide.session import exists, scratch
from sampletide.sources import files, reader, rules, writer
from sampletide.sources.bounds import literal
from sampletide.sources.registry import DATASETS, UNIT_SCALE

# Datasets whose checks run at the same time: jobs of one session, which shares its tasks between them.
SIDE_BY_SIDE = 6
SIMPLE_KINDS = ("not_null", "row_count_min", "accepted_values", "no_direct_identifier")


def write_bronze(root: str, recording: DataFrame, electrode: DataFrame, event: DataFrame, audit: DataFrame) -> None:
    """Append one batch of ingests. The audit rows come last: they commit it."""
    for name, rows in (("recording", recording), ("electrode", electrode), ("event", event), ("ingest_audit", audit)):
        writer.write_dataset(rows, root, f"bronze/{name}")


def write_silver(spark: SparkSession, root: str, key_map: DataFrame, scale: dict = UNIT_SCALE, **layout) -> None:
    """`layout` goes to the sorted write of the samples."""
    bronze = {n: reader.dataset(spark, root, f"bronze/{n}") for n in ("recording", "electrode", "event", "ingest_audit")}
    units = silver.unit_scale(spark, scale)
    built = {
        "silver/subject": silver.subject(bronze["recording"], key_map),
        "silver/record": silver.record(bronze["recording"], key_map, units),
        "silver/electrode": silver.electrode(bronze["electrode"], key_map),
        "silver/event": silver.event(bronze["event"], key_map, bronze["ingest_audit"]),
    }
    for name, rows in built.items():
        writer.write_dataset(rows, root, name, "overwrite")
    samples = silver.recording(bronze["recording"], key_map, bronze["ingest_audit"], units)
    writer.layout_write(samples, f"{root}/silver/recording", **layout)


def write_gold(spark: SparkSession, root: str, commit: str, codes: DataFrame | None = None) -> None:
    records, samples, events = (reader.dataset(spark, root, f"silver/{n}") for n in ("record", "recording", "event"))
    audit = reader.dataset(spark, root, "bronze/ingest_audit")
    noise = spectral.line_noise(spectral.with_rate(samples, audit))
    built = {
        "gold/channel_quality": gold.channel_quality(records, samples, noise),
        "gold/experiment_summary": gold.experiment_summary(records, samples, events),
        "gold/feature_window": gold.feature_window(records, samples),
    }
    for name, rows in built.items():
        writer.write_dataset(rows, root, name, "overwrite")
    write_manifest(spark, root, commit)


def dim(spark: SparkSession, root: str) -> DataFrame:
    return lineage.lineage_dim(reader.dataset(spark, root, "bronze/ingest_audit"), reader.dataset(spark, root, "bronze/recording"))


def versions(spark: SparkSession, root: str, names) -> DataFrame:
    """Digest of every dataset, each file read once."""
    found = [files.digests(spark, f"{root}/{n}").select(F.lit(n).alias("dataset"), "sha256") for n in names]
    return files.dataset_versions(reduce(DataFrame.unionByName, found))


def _present(spark: SparkSession, root: str, skip=()) -> list[str]:
    """Datasets that have files: a driver-side listing of folder names, not of files."""
    return [n for n in DATASETS if n not in skip and exists(spark, f"{root}/{n}")]


def write_manifest(spark: SparkSession, root: str, commit: str) -> None:
    names = _present(spark, root, skip=("gold/dataset_manifest",))
    lake = {n: reader.dataset(spark, root, n) for n in names}
    rows = manifest.complete(manifest.dataset_manifest(lake, lineage.file_dim(reader.dataset(spark, root, "bronze/ingest_audit"))), versions(spark, root, names),
                             datetime.now(UTC).replace(tzinfo=None), commit)
    writer.write_dataset(rows, root, "gold/dataset_manifest", "overwrite")


def views(spark: SparkSession, root: str) -> None:
    """Dataset views, lineage views and the lineage functions, for SQL."""
    sql_functions.register(spark)
    reader.register_views(spark, root)
    codes = lineage.experiment_codes(spark)
    files_dim = dim(spark, root)
    codes.createOrReplaceTempView("lineage_experiment")
    lineage.edges(spark).createOrReplaceTempView("lineage_edge")
    files_dim.createOrReplaceTempView("lineage_dim")
    lineage.prefix_bounds(files_dim, codes).createOrReplaceTempView("lineage_bounds")
    sql_functions.register_tables(spark)


# --- checks -----------------------------------------------------------------------------------------------

def _simple(rule: rules.Rule, columns: list[str]):
    """The aggregate a one-pass rule needs."""
    p = rule.params
    if rule.kind == "not_null":
        return F.count_if(F.col(p["column"]).isNull())
    if rule.kind == "row_count_min":
        return F.count(F.lit(1))
    if rule.kind == "accepted_values":
        return F.count_if(~F.col(p["column"]).isin(p["values"]))
    return F.lit(len(set(p["forbidden_columns"]) & set(columns))).cast("bigint")


def observe_simple(rows: DataFrame, owned: list[rules.Rule]) -> DataFrame:
    """(check_id, observed) of every one-pass rule of a dataset, from a single scan."""
    counts = rows.agg(*[_simple(r, rows.columns).alias(f"c{i}") for i, r in enumerate(owned)])
    pairs = [F.struct(F.lit(r.check_id).alias("check_id"), F.col(f"c{i}").cast("string").alias("observed"))
             for i, r in enumerate(owned)]
    return counts.select(F.inline(F.array(*pairs)))


def observe_contracts(spark: SparkSession, held: dict[str, DataFrame]) -> DataFrame:
    """Contract rules of the given tables with what they observe and their verdicts."""
    parts = []
    for name, rows in held.items():
        owned = rules.contract_rules([name])
        parts.append(observe_simple(rows, [r for r in owned if r.kind in SIMPLE_KINDS]))
        parts += [checks.duplicate_groups(rows, r.params["columns"]).select(
            F.lit(r.check_id).alias("check_id"), F.col("observed").cast("string")) for r in owned if r.kind == "unique"]
    every = rules.contract_rules(list(held))
    facts = literal(spark, [(r.check_id, r.dataset, r.kind, r.expected) for r in every],
                    "check_id string, dataset string, check_kind string, expected string")
    seen = reduce(DataFrame.unionByName, parts)
    return seen.join(facts, "check_id").withColumn(
        "result", checks.verdict(F.col("check_kind"), F.col("observed"), F.col("expected")))


def _bound_query(spark: SparkSession, params: dict) -> DataFrame:
    """The rule's own query; `{{name}}` is bound as a parameter, never pasted into the text."""
    text = re.sub(r"\{\{(\w+)\}\}", r":\1", params["sql"])
    return spark.sql(text, args={k: v for k, v in params.items() if k != "sql"})


def _observe_other(spark: SparkSession, root: str, rule: rules.Rule) -> DataFrame:
    p, path = rule.params, f"{root}/{rule.dataset}"
    if rule.kind == "unique":
        return checks.duplicate_groups(reader.dataset(spark, root, rule.dataset), p["columns"])
    if rule.kind == "hash_match":
        return checks.digest_mismatches(reader.dataset(spark, root, rule.dataset), files.digests(spark, f"{root}/raw", "*"), root)
    if rule.kind == "partition_layout":
        return checks.layout_violations(files.footers(spark, path), p["max_rows_per_row_group"], p["min_row_groups"])
    if rule.kind == "retention":
        return checks.oldest_age_days(files.listing(spark, path, "*.parquet"))
    if rule.kind == "sql" and rule.severity == "flag":
        # The query is already ordered: number its first five rows in that order.
        found = _bound_query(spark, p)
        top = found.limit(checks.OFFENDERS_NAMED).withColumn("place", F.monotonically_increasing_id())
        return checks.offender_text_of(found, top, reader.dataset(spark, root, rule.dataset))
    if rule.kind == "sql":
        return checks.violations(_bound_query(spark, p))
    raise ValueError(f"unknown check kind '{rule.kind}'")


def observations(spark: SparkSession, root: str, owned: list[rules.Rule]) -> list[tuple]:
    """(check_id, observed, error) of every rule. A check that fails becomes an error row and stops nothing.

    One-pass rules of a dataset share a scan; only if that scan fails are they run one by one. Datasets are checked
    side by side, each by jobs of its own.
    """
    def attempt(plan, ids):
        try:
            rows = plan().collect()
            return [(r["check_id"], str(r["observed"]), None) for r in rows]
        except PySparkException as e:
            return [(i, None, str(e).splitlines()[0]) for i in ids]

    def of_dataset(name):
        seen, mine = [], [r for r in owned if r.dataset == name]
        simple = [r for r in mine if r.kind in SIMPLE_KINDS]
        if simple:
            rows = reader.dataset(spark, root, name)
            seen = attempt(lambda: observe_simple(rows, simple), [r.check_id for r in simple])
            if any(e for _, _, e in seen):
                seen = [o for r in simple for o in attempt(lambda: observe_simple(rows, [r]), [r.check_id])]
        named = lambda rule: _observe_other(spark, root, rule).select(
            F.lit(rule.check_id).alias("check_id"), F.col("observed").cast("string"))
        unique = [r for r in mine if r.kind == "unique"]
        if unique:
            found = attempt(lambda: checks.duplicate_groups_of(reader.dataset(spark, root, name), {r.check_id: r.params["columns"] for r in unique}),
                            [r.check_id for r in unique])
            if any(e for _, _, e in found):
                found = [o for r in unique for o in attempt(lambda: named(r), [r.check_id])]
            seen = seen + found
        for rule in (r for r in mine if r.kind not in (*SIMPLE_KINDS, "unique")):
            seen = seen + attempt(lambda: named(rule), [rule.check_id])
        return seen

    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        return [o for part in pool.map(of_dataset, dict.fromkeys(r.dataset for r in owned)) for o in part]


def evidence(spark: SparkSession, root: str, run_id: str = "R1", commit: str = "0000000",
             extra: list[rules.Rule] = ()) -> DataFrame:
    """Run governance and contract rules, append the run's evidence, return its rows.

    Every rule of every registered dataset runs, whether the dataset has files or not: a lost dataset is an empty table
    that fails its row counts, and a check of files that are not there is an error row.
    """
    views(spark, root)
    present = _present(spark, root)
    governed = rules.requirement_rules(checks.expand_rules(rules.governance_text(spark), tuple(DATASETS)))
    owned = [*governed, *rules.contract_rules(), *extra]
    observed = literal(spark, observations(spark, root, owned), "check_id string, observed string, error string")
    facts = literal(
        spark, [(r.check_id, r.requirement_id, r.framework, r.dataset, r.kind, r.severity, r.clause, r.control, r.expected) for r in owned],
        "check_id string, requirement_id string, framework string, dataset string, check_kind string, severity string, "
        "clause string, control string, expected string")
    failed = F.col("error").isNotNull()
    result = F.when(failed, "error").otherwise(checks.verdict(F.col("check_kind"), F.col("observed"), F.col("expected")))
    rows = (facts.join(observed, "check_id").join(versions(spark, root, present), "dataset", "left")
            .withColumn("result", result).withColumn("expected", F.when(~failed, F.col("expected")))
            .withColumns({"run_id": F.lit(run_id), "ran_at": F.lit(datetime.now(UTC).replace(tzinfo=None)).cast("timestamp_ntz"),
                          "engine_version": F.lit(spark.version), "git_commit": F.lit(commit),
                          "lid": F.lit(None).cast("string")}))
    writer.write_dataset(rows, root, "gold/evidence")
    return reader.dataset(spark, root, "gold/evidence").where(F.col("run_id") == run_id)


def refused(rows: DataFrame, what: str, folder: str) -> None:
    """Raise if there are rows: all of them are written below `folder`, the message has their number and the place."""
    place = f"{folder}/refused-{what.replace(' ', '-')}"
    rows.write.mode("overwrite").json(place)
    n = rows.sparkSession.read.schema(rows.schema).json(place).count()
    if n:
        raise ValueError(f"refused: {n} {what}, listed in {place}")


def publish_gold(spark: SparkSession, root: str, out: str, history: DataFrame | None = None, file_limit: int = publish.FILE_LIMIT,
                 total_limit: int = publish.TOTAL_LIMIT) -> DataFrame:
    """Gates first, then a new version of the copy with its manifest. Returns the manifest rows.

    The summary is written with the marts, so it is copied, digested and listed like them. Rules over the published
    copy run on the new version before anything points to it.
    """
    present = [n for n in _present(spark, root) if n.startswith("gold/")]
    with_ids = [n for n in present if "lid" in DATASETS[n].fields]
    reports = scratch(spark, "publish")
    gates = [publish.leaks(reader.read_plain(spark, root, n)) for n in with_ids]
    refused(reduce(DataFrame.unionByName, gates).where("canary_rows > 0"), "files with canary records", reports)
    records = reader.dataset(spark, root, "gold/evidence"), reader.dataset(spark, root, "gold/dataset_manifest")
    if history is not None:
        refused(publish.unknown_commits(*records, history), "commits outside the history", reports)
    publish.build_summary(*records).write.mode("overwrite").parquet(f"{root}/gold/build_summary")
    gate = publish.size_gate(files.listing(spark, [f"{root}/{n}" for n in [*present, "gold/build_summary"]], "*.parquet"), file_limit, total_limit).first()
    if not gate["allowed"]:
        raise ValueError(f"refused: {gate['files_over']} files over the limit, {gate['bytes']} bytes in all")
    return publish.publish_files(spark, f"{root}/gold", out, "gold", lambda place: refused(
        reduce(DataFrame.unionByName, [publish.leaks(reader.read_plain(spark, place, n)) for n in with_ids]).where("canary_rows > 0"),
        "published files with canary records", reports))


def published_root(spark: SparkSession, out: str) -> str:
    """The version of a published copy that `current` points to."""
    return f"{out.rstrip('/')}/{spark.read.text(f'{out.rstrip(chr(47))}/current').first()['value']}"


def recheck_published(spark: SparkSession, out: str, extra: list[rules.Rule] = ()) -> DataFrame:
    """check_id, dataset, result of the rules over the marts of a published copy, run on what was received.

    The copy is verified first: a check that reads a mart of which a file is missing or differs is 'not run'.
    """
    place = published_root(spark, out)
    views(spark, place)
    listed = spark.read.schema("path string, bytes long, sha256 string").json(f"{place}/manifest")
    received = publish.published_files(files.digests(spark, f"{place}/gold"), place).select("path", F.col("sha256").alias("received"))
    marts = [n for n in DATASETS if n.startswith("gold/")]
    governed = rules.requirement_rules(checks.expand_rules(rules.governance_text(spark), tuple(DATASETS)))
    owned = [r for r in [*governed, *rules.contract_rules(marts), *extra] if r.dataset in marts and r.kind != "retention"]
    facts = literal(spark, [(r.check_id, r.dataset, r.kind, r.expected, r.params.get("sql", "")) for r in owned],
                    "check_id string, dataset string, check_kind string, expected string, sql string")
    withheld = publish.withheld_checks(facts, listed.join(received, "path", "left")).select("check_id", F.lit(1).alias("withheld"))
    observed = literal(spark, observations(spark, place, owned), "check_id string, observed string, error string")
    result = (F.when(F.col("withheld") == 1, "not run").when(F.col("error").isNotNull(), "error")
              .otherwise(checks.verdict(F.col("check_kind"), F.col("observed"), F.col("expected"))))
    return facts.join(observed, "check_id").join(withheld, "check_id", "left").select("check_id", "dataset", result.alias("result"))


def build(fixture, root: str) -> str:
    """The lake of the fixture tables, Bronze to Gold, below `root`."""
    files.write_blobs(fixture.raw_files, root)
    write_bronze(root, fixture.bronze_recording, fixture.bronze_electrode, fixture.bronze_event, fixture.audit)
    # Files of any size are of several row groups each, as the layout rule asks.
    write_silver(fixture.spark, root, fixture.key_map, groups_per_file=2)
    write_gold(fixture.spark, root, "0000000")
    return root

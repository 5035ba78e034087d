"""Rules as data, their observations and verdicts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sampletide.functions import lid
from sampletide.operators import quantiles
from sampletide.sources.registry import DATASETS

# A number in plain decimal form: neither NaN, nor infinity, nor a suffix of the type.
NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
NO_OFFENDER = "no records"
OFFENDERS_NAMED = 5
# Keys of uniqueness rules that a task counts, some hundred bytes each.
ENTRIES_PER_TASK = 4_000_000


# --- observations ---------------------------------------------------------------------------------

def null_counts(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, observed) of many columns in one pass."""
    counts = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("observed")) for c in columns])
    return counts.select(F.inline(pairs))


def duplicate_groups(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Groups of the columns that occur more than once; NULLs are one group, unlike in count(distinct)."""
    repeated = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_occurrences")).where("_occurrences > 1")
    return repeated.agg(F.count(F.lit(1)).alias("observed"))


def duplicate_groups_of(rows: DataFrame, rules: dict[str, Sequence[str]]) -> DataFrame:
    """(check_id, observed): `duplicate_groups` of many rules in one scan.

    The rules' columns are grouping sets, so values are grouped as they are and combined before the shuffle; rules that name the
    same columns in another order are one set. Keys that hardly repeat fill a task's memory, so a large table is first dealt
    to tasks of few enough rows.
    """
    sets = [list(c) for c in dict.fromkeys(tuple(sorted(set(c))) for c in rules.values())]
    columns = sorted({c for s in sets for c in s})
    # As the function numbers a set: a bit per column that is not in it, the first column's the highest.
    number = lambda held: sum(1 << i for i, c in enumerate(reversed(columns)) if c not in held)
    narrow = rows.select(*columns)
    tasks = -(-narrow.count() * len(sets) // ENTRIES_PER_TASK)
    if tasks > rows.sparkSession.sparkContext.defaultParallelism:
        narrow = narrow.repartition(tasks)
    found = narrow.groupingSets(sets, *columns).agg(F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_n"))
    groups = found.where("_n > 1").groupBy("_set").agg(F.count(F.lit(1)).alias("_k"))
    names = rows.sparkSession.createDataFrame([(n, number(c)) for n, c in rules.items()], "check_id string, _set bigint")
    return names.join(groups, "_set", "left").select("check_id", F.coalesce("_k", F.lit(0)).cast("bigint").alias("observed"))


def row_count(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("observed"))


def forbidden_columns(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Forbidden columns the schema carries, next to the rows that would carry them."""
    held = [c for c in rows.columns if c in set(names)]
    return rows.agg(F.lit(len(held)).cast("bigint").alias("observed"), F.count(F.lit(1)).alias("n_rows"))


def outside_values(rows: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    """Rows whose value is not in the list. NULL is not outside: not_null covers it."""
    return rows.agg(F.count_if(~F.col(column).isin(list(allowed))).alias("observed"))


def violations(query: DataFrame) -> DataFrame:
    return row_count(query)


def digest_mismatches(audit: DataFrame, digests: DataFrame, root: str) -> DataFrame:
    """Audit rows whose file below the lake root is missing or differs. Matching on the path below the root
    keeps a moved lake from reading as tampered with; a capture recorded by an absolute path is not in the lake."""
    prefix = F.lit(root.rstrip("/") + "/")
    plain = F.regexp_replace("path", "^file:/+", "/")
    found = digests.select(plain.alias("path"), F.col("sha256").alias("digest"))
    joined = audit.where(~F.col("source_path_rel").startswith("/")).join(found, F.concat(prefix, F.col("source_path_rel")) == F.col("path"), "left")
    return joined.agg(F.count_if(F.col("digest").isNull() | (F.col("digest") != F.col("sha256"))).alias("observed"))


def layout_violations(footers: DataFrame, max_rows: int, min_groups: int) -> DataFrame:
    """Files with too large or too few row groups."""
    groups = footers.groupBy("file", "row_group").agg(F.max("group_rows").alias("group_rows"))
    files = groups.groupBy("file").agg(F.count(F.lit(1)).alias("row_groups"), F.max("group_rows").alias("most_rows"))
    return files.agg(F.count_if((F.col("row_groups") < min_groups) | (F.col("most_rows") > max_rows)).alias("observed"))


def oldest_age_days(files: DataFrame) -> DataFrame:
    """Age of the oldest file, 0 without files. `files` has a `modified` timestamp."""
    age = (F.unix_micros(F.current_timestamp()) - F.unix_micros(F.min("modified"))) / F.lit(86_400_000_000.0)
    return files.agg(F.coalesce(F.round(age, 3), F.lit(0.0)).alias("observed"))


def offender_text(found: DataFrame, order: Sequence[Column], rows: DataFrame) -> DataFrame:
    """'k of n: first five[ and more]', or 'no records'. `found` has one column `offender` and its sort keys."""
    top = found.orderBy(*order).limit(OFFENDERS_NAMED)
    placed = top.withColumn("place", F.row_number().over(Window.orderBy(*order)))
    return offender_text_of(found, placed, rows)


def offender_text_of(found: DataFrame, top: DataFrame, rows: DataFrame) -> DataFrame:
    """The text from the rows found and the first five, numbered by `place`. Only those and two counts leave
    the executors."""
    named = top.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "offender"))),
                                             lambda s: s["offender"]), ", "))
    k = F.col("k")
    text = F.concat(k.cast("string"), F.lit(" of "), row_count(rows).scalar().cast("string"), F.lit(": "),
                    named.scalar(), F.when(k > OFFENDERS_NAMED, F.lit(" and more")).otherwise(F.lit("")))
    return found.agg(F.count(F.lit(1)).alias("k")).select(
        F.when(k == 0, F.lit(NO_OFFENDER)).otherwise(text).alias("observed"))


# --- rules that find offenders ---------------------------------------------------------------------

def implausible_rms(quality: DataFrame, low: float = 1, high: float = 1000) -> DataFrame:
    found = quality.where((F.col("rms_uv") < low) | (F.col("rms_uv") > high))
    return found.select(lid.crockford().alias("offender"), "rms_uv", "lid")


def noisy_channels(quality: DataFrame, limit: float = 0.5) -> DataFrame:
    found = quality.where(F.col("line_noise_ratio") >= limit)
    return found.select(lid.crockford().alias("offender"), "line_noise_ratio", "lid")


def odd_event_rates(summary: DataFrame, low: float = 0.5, high: float = 2.0) -> DataFrame:
    """Subjects whose event rate lies outside multiples of their experiment's median rate."""
    per_minute = F.try_divide(F.lit(60.0) * F.col("n_events"), F.col("duration_s").cast("double"))
    rates = summary.select("experiment", "subject_pid", per_minute.alias("per_minute"))
    middle = quantiles.median(rates, ["experiment"], "per_minute").withColumnRenamed("median", "middle")
    joined = rates.join(middle, "experiment")
    outside = (F.col("per_minute") < low * F.col("middle")) | (F.col("per_minute") > high * F.col("middle"))
    return joined.where(outside).select(
        F.concat_ws(" ", "experiment", "subject_pid").alias("offender"), "per_minute")


# --- rule rows --------------------------------------------------------------------------------------

def expand_rules(rules: DataFrame, names: Sequence[str] = tuple(DATASETS)) -> DataFrame:
    """One row per dataset the rule's pattern matches, the pattern itself when it matches none.

    The dataset names are a fixed list, so matching is an array filter inside each row and needs no join. The
    parameters (a map) fill `{{name}}` in the control text and end the check id.
    """
    every = F.array(*[F.lit(n) for n in names])
    # A glob as a regular expression: literal text quoted, * and ? opened.
    quoted = F.concat(F.lit("^\\Q"), F.col("dataset"), F.lit("\\E$"))
    pattern = F.replace(F.replace(quoted, F.lit("*"), F.lit("\\E.*\\Q")), F.lit("?"), F.lit("\\E.\\Q"))
    matched = F.filter(every, lambda n: F.rlike(n, F.col("_pattern")))
    control = F.aggregate(F.map_entries("params"), F.col("control"), lambda text, p: F.replace(
        text, F.concat(F.lit("{{"), p["key"], F.lit("}}")), p["value"]))
    detail = F.transform(F.map_values("params"), _list_text)
    return (rules.withColumn("_pattern", pattern)
            .withColumn("name", F.explode(F.when(F.size(matched) > 0, matched).otherwise(F.array("dataset"))))
            .withColumn("dataset", F.col("name"))
            .withColumn("control", control)
            .withColumn("check_id", F.array_join(F.concat(
                F.array("requirement_id", "check_kind", "dataset"), detail), "/"))
            .drop("name", "_pattern"))


def _list_text(value: Column) -> Column:
    """A JSON list of names in the form check ids have always shown it: ['a', 'b']."""
    quoted = F.replace(F.replace(value, F.lit('"'), F.lit("'")), F.lit("','"), F.lit("', '"))
    return F.when(value.startswith("["), quoted).otherwise(value)


def verdict(kind: Column, observed: Column, expected: Column) -> Column:
    """pass or fail: as numbers where both sides are numbers, else as text."""
    o, e = (F.when(x.rlike(NUMBER), x.try_cast("double")) for x in (observed, expected))
    relation = F.when(kind == "row_count_min", o >= e).when(kind == "retention", o <= e).otherwise(o == e)
    held = F.when(o.isNull() | e.isNull(), observed == expected).otherwise(relation)
    return F.when(held, "pass").otherwise("fail")


# --- evidence ---------------------------------------------------------------------------------------

def blocking_summary(evidence: DataFrame) -> DataFrame:
    """Per run: counts by result, and what stops the build."""
    is_ = lambda r: F.count_if(F.col("result") == r)
    return evidence.groupBy("run_id").agg(
        is_("pass").alias("n_pass"), is_("fail").alias("n_fail"), is_("error").alias("n_error"),
        F.count_if((F.col("result") != "pass") & (F.col("severity") == "block")).alias("n_blocking"))


def version_drift(evidence: DataFrame) -> DataFrame:
    """Datasets seen with more than one digest across runs."""
    seen = evidence.select("dataset", "dataset_version").distinct()
    return seen.groupBy("dataset").agg(F.count(F.lit(1)).alias("n_versions")).where("n_versions > 1")


def latest_run(evidence: DataFrame) -> DataFrame:
    """Rows of the newest run: run ids are time-ordered text."""
    return evidence.where(F.col("run_id") == evidence.agg(F.max("run_id")).scalar())


def version_agreement(evidence: DataFrame, manifest: DataFrame) -> DataFrame:
    """Manifest datasets the latest run also checked, and whether both name one digest."""
    checked = latest_run(evidence).select("dataset", F.col("dataset_version").alias("checked_version")).distinct()
    return manifest.select("dataset", "dataset_version").join(checked, "dataset").select(
        "dataset", F.when(F.col("dataset_version") == F.col("checked_version"), 1).otherwise(0).alias("agrees"))

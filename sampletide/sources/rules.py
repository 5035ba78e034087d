"""Rules as rows: governance requirements, contract rules, published manifests."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampletide.sources.bounds import literal
from sampletide.sources.registry import DATASETS

REQUIREMENTS = Path(__file__).resolve().parent.parent / "governance" / "requirements.csv"
REQUIREMENT_SCHEMA = ("framework string, requirement_id string, clause string, control string, check_kind string, "
                      "dataset string, params string, severity string")


@dataclass(frozen=True)
class Rule:
    check_id: str
    requirement_id: str
    framework: str
    dataset: str
    kind: str
    severity: str
    control: str
    params: dict = field(hash=False)
    clause: str | None = None

    @property
    def expected(self) -> str:
        named = {"row_count_min": "min", "retention": "max_age_days"}.get(self.kind)
        if named:
            return str(self.params[named])
        return "no records" if self.kind == "sql" and self.severity == "flag" else "0"


def read_requirements(spark: SparkSession, path: str) -> DataFrame:
    """Requirement rows; `params` as a map, list values keeping their JSON text."""
    read = spark.read.schema(REQUIREMENT_SCHEMA).option("header", True).option("escape", '"').csv(path)
    return read.withColumn("params_json", F.col("params")).withColumn("params", F.from_json("params", "map<string,string>"))


def governance_text(spark: SparkSession) -> DataFrame:
    """The packaged requirement file, as rows: read on the driver, since executors need not have the package."""
    lines = REQUIREMENTS.read_text(encoding="utf-8").splitlines()
    text = literal(spark, [(line,) for line in lines[1:]], "value string")
    options = {"escape": '"'}
    parsed = text.select(F.from_csv("value", REQUIREMENT_SCHEMA, options).alias("r")).select("r.*")
    return parsed.withColumn("params_json", F.col("params")).withColumn("params", F.from_json("params", "map<string,string>"))


def requirement_rules(expanded: DataFrame) -> list[Rule]:
    """Expanded requirement rows as rule objects: one per check, a few dozen."""
    severities = expanded.where(~F.col("severity").isin("block", "flag")).count()
    if severities:
        raise ValueError("severity is 'block' or 'flag'")
    return [Rule(r["check_id"], r["requirement_id"], r["framework"], r["dataset"], r["check_kind"], r["severity"],
                 r["control"], json.loads(r["params_json"]), r["clause"])
            for r in expanded.collect()]


def contract_rules(names=None) -> list[Rule]:
    """required → not_null, unique → unique, and each dataset's own quality rules."""
    rules = []
    for name in names or DATASETS:
        d = DATASETS[name]
        owned = [("not_null", {"column": c}, f"Every row has a value for {c}.") for c in d.required]
        owned += [("unique", {"columns": list(u)}, f"No two rows share {' and '.join(u)}.") for u in d.unique]
        owned += [("accepted_values", {"column": c, "values": list(v)}, f"{c} is one of {', '.join(v)}.") for c, v in d.accepted]
        if d.forbidden:
            owned.append(("no_direct_identifier", {"forbidden_columns": list(d.forbidden)},
                          f"No column is named {' or '.join(d.forbidden)}."))
        if d.minimum_rows is not None:
            owned.append(("row_count_min", {"min": d.minimum_rows}, f"At least {d.minimum_rows} rows are present."))
        owner = name.replace("/", "-").replace("_", "-")
        for kind, params, control in owned:
            check_id = "/".join([owner, kind, name, *map(str, params.values())])
            rules.append(Rule(check_id, owner, "contract", name, kind, "block", control, params))
    return rules


def manifest_files(spark: SparkSession, path: str) -> DataFrame:
    """File entries of JSON manifests, one row each."""
    schema = "mart string, files array<struct<path: string, sha256: string>>"
    return spark.read.schema(schema).option("multiLine", "false").json(path).select("mart", F.inline("files"))

"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def session(master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators are written for. Size shuffle partitions to the data."""
    builder = SparkSession.builder.appName("sampletide")
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
        "spark.ui.enabled": "false",
        # Stack traces for every column expression cost more than small queries do.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch(spark: SparkSession, name: str = "work") -> str:
    """A new folder below the shared folder that spark.checkpoint.dir names. In local mode, where it may be unset, a
    folder of this application takes its place and goes when the application ends."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = _local_base()
    return f"{base.rstrip('/')}/sampletide-{name}-{uuid.uuid4().hex}"


@cache
def _local_base() -> str:
    base = tempfile.mkdtemp(prefix="sampletide-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    return base


def exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


_WRITTEN: dict = {}


def written_once(spark: SparkSession, inputs: str, name: str, write) -> str:
    """Path of a table written once per application and state of its inputs: `write(path)` runs on first use.

    The state is the number, bytes and latest change of the files below `inputs`, so changed inputs are read anew.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(inputs)
             .agg({"length": "sum", "modificationTime": "max", "path": "count"}).first())
    key = (spark.sparkContext.applicationId, inputs, name, *files)
    if key not in _WRITTEN or not exists(spark, _WRITTEN[key]):
        path = scratch(spark, name)
        write(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def materialise(table, name: str, **options):
    """Write an intermediate to the shared scratch folder and read it back.

    For a small result of a large scan that several branches of one plan use: the scan runs once, the lineage
    is cut in storage that outlives executors, and the planner sees the real size.
    """
    spark = table.sparkSession
    path = scratch(spark, name)
    table.write.options(**options).parquet(path)
    return spark.read.schema(table.schema).parquet(path)

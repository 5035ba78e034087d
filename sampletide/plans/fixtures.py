"""The lake's inputs as views over the given tables (FIXTURES.md part B).

Every view is a lazy DataFrame over whole tables. Where a fixture needs a running number it uses a dense key
the table already has, so none of them ranks a table in one task.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampletide.functions import lid
from sampletide.operators import gold, ingest, lineage, manifest, pseudonym, silver, spectral
from sampletide.session import written_once
from sampletide.sources import files, writer
from sampletide.sources.bounds import literal
from sampletide.sources.registry import EXPERIMENT_CODES

# Fixed values of the fixture lake.
TEST_SECRET = bytes(range(32))
CANARY = "u9"
UNCOMMITTED = "view-u7"
AREAS = {1: "frontal", 2: "parietal", 3: "temporal", 4: "occipital", 5: "insula"}
CUE_LABELS = [(c, "house") for c in range(1, 5)] + [(c, "face") for c in range(5, 9)]
CUE_RANGES = [(1, 4, "house"), (5, 8, "face")]
SENTINEL = 9
SPECTRAL_RATE = 200
SPECTRAL_CHANNELS = 7
ORDERS_PER_FILE = 256
LONG_LINE = 6000


class Fixture:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _table(self, name: str, make, partitions=()) -> DataFrame:
        """A layer as a table: written once per application below the shared folder, then read like any other.

        Later layers and checks scan the columns they need of the table before them, as in a lake, instead of
        deriving every layer again from the source tables.
        """
        made = make()

        def write(path):
            if partitions:
                writer.layout_write(made, path, partitions)
            else:
                made.write.parquet(path)
        path = written_once(self.spark, self.sf_dir, name, write)
        return self.spark.read.schema(made.schema).parquet(path).select(*made.columns)

    # --- samples and audit from events ---

    @cached_property
    def samples(self) -> DataFrame:
        value = F.when(F.col("event_id") % 97 == 0, F.lit(None)).otherwise(F.col("value").cast("float"))
        return self.table("events").select(
            F.col("event_type").alias("experiment"), F.concat(F.lit("u"), F.col("user_id") % 10).alias("subject_src"),
            F.when(F.dayofmonth("ts") < 16, 1).otherwise(2).cast("smallint").alias("run"),
            (F.col("event_id") % 4).cast("smallint").alias("channel_idx"), F.col("event_id").alias("sample_idx"),
            value.alias("value_raw"), "ts")

    @cached_property
    def sources(self) -> DataFrame:
        """One row per source file: what the audit is made of. Written once, as the audit is a table of the
        lake, so that the many small joins against it do not scan the samples again."""
        return self._table("audit", self._sources)

    def _sources(self) -> DataFrame:
        name = F.concat_ws("/", "experiment", "subject_src")
        below = F.concat(F.lit("raw/"), name, F.lit(".mat"))
        first = lid.to_millisecond("min(ts)")
        found = self.samples.groupBy("experiment", "subject_src").agg(
            F.count(F.lit(1)).alias("rows_written"), first.alias("ingested_at"))
        return ingest.with_ingest_ord(found.select(
            F.concat_ws("-", "experiment", "subject_src").alias("ingest_id"), F.lit("/lake").alias("data_root"),
            F.when(name == "click/u0", F.concat(F.lit("/mnt/"), below)).otherwise(below).alias("source_path_rel"),
            F.concat(F.lit("https://example.org/"), F.col("experiment"), F.lit(".zip")).alias("source_url"),
            F.sha2(name, 256).alias("sha256"), (F.col("rows_written") * 4).alias("bytes"),
            F.when(F.col("experiment") == "click", 512).otherwise(1000).alias("sample_rate_hz"), "rows_written",
            F.lit("ingest").alias("tool"), F.lit("1").alias("tool_version"), F.lit("4.1").alias("engine_version"),
            F.lit("host").alias("ingest_host"), "ingested_at", "experiment", "subject_src"))

    @cached_property
    def audit(self) -> DataFrame:
        return self.sources.drop("experiment", "subject_src")

    @cached_property
    def raw_files(self) -> DataFrame:
        """The captures the audit names, where they lie in the lake: path, content."""
        below = F.col("source_path_rel")
        return self.sources.where(~below.startswith("/")).select(below.alias("path"), F.concat_ws("/", "experiment", "subject_src").alias("content"))

    @cached_property
    def partial_audit(self) -> DataFrame:
        return self.audit.where(F.col("ingest_id") != UNCOMMITTED)

    @cached_property
    def codes(self) -> DataFrame:
        return lineage.experiment_codes(self.spark)

    @cached_property
    def ingests(self) -> DataFrame:
        numbered = ingest.with_ingest_ord(self.sources)
        return numbered.join(self.codes, "experiment").select(
            "experiment", "subject_src", "ingest_id", "ingest_ord", lid.epoch_ms("ingested_at").alias("ts_ms"),
            "code", F.when(F.col("subject_src") == CANARY, 1).otherwise(0).alias("radioactive"))

    def make_bronze_recording(self) -> DataFrame:
        return ingest.bronze_recording(self.samples, self.ingests)

    @cached_property
    def bronze_recording(self) -> DataFrame:
        return self._table("bronze-recording", self.make_bronze_recording, ("experiment", "subject_src"))

    # --- electrodes ---

    @cached_property
    def channels(self) -> DataFrame:
        return self.samples.select("experiment", "subject_src", "channel_idx").distinct()

    @cached_property
    def locations(self) -> DataFrame:
        """Grid positions; channel 3 has none and some area codes lie outside the table."""
        digit = F.expr("cast(substr(subject_src, 2) as int)")
        return self.channels.where("channel_idx <> 3").select(
            "experiment", "subject_src", "channel_idx", (F.col("channel_idx") * 10).cast("float").alias("x_mm"),
            (digit * 10).cast("float").alias("y_mm"), F.lit(0).cast("float").alias("z_mm"),
            ingest.lookup((F.col("channel_idx") + digit) % 8, AREAS).alias("brain_area"))

    @cached_property
    def bronze_electrode(self) -> DataFrame:
        return ingest.bronze_electrode(self.channels, self.locations, self.ingests)

    # --- wide samples and cues from embeddings ---

    @cached_property
    def wide(self) -> DataFrame:
        return self.table("embeddings").select(
            F.col("vec_id").alias("sample_idx"), F.col("embedding").alias("data"),
            F.col("label").cast("smallint").alias("event_code"))

    @cached_property
    def onsets(self) -> DataFrame:
        return ingest.onsets(self.wide.select(F.lit(1).alias("run"), "sample_idx", "event_code"), ["run"])

    @cached_property
    def labels(self) -> DataFrame:
        return literal(self.spark, CUE_LABELS, "event_code smallint, event_label string")

    @cached_property
    def cues(self) -> DataFrame:
        """Onsets dealt to the fifty files by position."""
        slot = F.col("sample_idx") % 50
        names = F.array(*[F.lit(e) for e in sorted(EXPERIMENT_CODES)])
        return ingest.with_labels(self.onsets, self.labels).select(
            F.element_at(names, (F.floor(slot / 10) + 1).cast("int")).alias("experiment"),
            F.concat(F.lit("u"), slot % 10).alias("subject_src"), F.lit(1).alias("run"), "sample_idx", "event_code",
            "event_label")

    @cached_property
    def bronze_event(self) -> DataFrame:
        return ingest.bronze_event(self.cues, self.ingests)

    # --- key map, Silver ---

    @cached_property
    def key_map(self) -> DataFrame:
        first = self.sources.groupBy("subject_src").agg(F.min("ingested_at").alias("created_at"))
        return pseudonym.pseudonymise(first, TEST_SECRET).select("subject_src", "subject_pid", "created_at")

    @cached_property
    def scale(self) -> DataFrame:
        return silver.unit_scale(self.spark)

    @cached_property
    def subject(self) -> DataFrame:
        return silver.subject(self.bronze_recording, self.key_map)

    def make_record(self) -> DataFrame:
        return silver.record(self.bronze_recording, self.key_map, self.scale)

    @cached_property
    def record(self) -> DataFrame:
        return self._table("silver-record", self.make_record)

    def make_recording(self) -> DataFrame:
        return silver.recording(self.bronze_recording, self.key_map, self.audit, self.scale)

    @cached_property
    def recording(self) -> DataFrame:
        return self._table("silver-recording", self.make_recording, ("experiment", "subject_pid"))

    @cached_property
    def recording_path(self) -> str:
        return written_once(self.spark, self.sf_dir, "silver-recording",
                            lambda path: writer.layout_write(self.make_recording(), path))

    @cached_property
    def electrode(self) -> DataFrame:
        return silver.electrode(self.bronze_electrode, self.key_map)

    @cached_property
    def event(self) -> DataFrame:
        return silver.event(self.bronze_event, self.key_map, self.audit)

    # --- Gold ---

    @cached_property
    def dim(self) -> DataFrame:
        return lineage.lineage_dim(self.audit, self.bronze_recording)

    @cached_property
    def file_dim(self) -> DataFrame:
        return lineage.file_dim(self.audit)

    @cached_property
    def quality_table(self) -> DataFrame:
        return self._table("channel-quality", lambda: self.quality)

    @cached_property
    def summary_table(self) -> DataFrame:
        return self._table("experiment-summary", lambda: self.summary)

    @cached_property
    def window_table(self) -> DataFrame:
        return self._table("feature-window", lambda: self.windows)

    @cached_property
    def tone_table(self) -> DataFrame:
        return self._table("tone-quality", lambda: self.tone_quality)

    @cached_property
    def quality(self) -> DataFrame:
        return gold.channel_quality(self.record, self.recording)

    @cached_property
    def windows(self) -> DataFrame:
        return gold.feature_window(self.record, self.recording)

    @cached_property
    def summary(self) -> DataFrame:
        return gold.experiment_summary(self.record, self.recording, self.event)

    # --- contiguous records from orders, for the spectrum ---

    @cached_property
    def tones(self) -> DataFrame:
        """Seven channels by order key, every third with a 50 Hz tone (period four samples at 200 Hz)."""
        channel, i = F.col("o_orderkey") % SPECTRAL_CHANNELS, F.floor(F.col("o_orderkey") / SPECTRAL_CHANNELS)
        tone = F.when(channel % 3 != 0, 0).when(i % 4 == 1, 100).when(i % 4 == 3, -100).otherwise(0)
        ids = lid.mint_text(1_704_067_200_000, 2, 1, 1, 1, f"o_orderkey % {SPECTRAL_CHANNELS}", 0, 0)
        return self.table("orders").select(
            F.lit("click").alias("experiment"), F.concat(F.lit("p"), channel % 2).alias("subject_pid"),
            (channel % 2 + 1).cast("smallint").alias("run"),
            channel.cast("smallint").alias("channel_idx"), (i * 5).cast("bigint").alias("ts_ms"),
            (F.col("o_totalprice") / 10000 + tone).cast("float").alias("value_uv"), ids.alias("lid"),
            i.cast("bigint").alias("sample_idx"))

    @cached_property
    def tone_record(self) -> DataFrame:
        return self.tones.groupBy("lid", "experiment", "subject_pid", "run", "channel_idx").agg(
            F.count(F.lit(1)).alias("n_samples_src")).withColumn("scale_basis", F.lit("documented"))

    @cached_property
    def tone_noise(self) -> DataFrame:
        return spectral.line_noise(self.tones.withColumn("sample_rate_hz", F.lit(SPECTRAL_RATE)))

    @cached_property
    def tone_quality(self) -> DataFrame:
        return gold.channel_quality(self.tone_record, self.tones, self.tone_noise)

    # --- ids with every field in use, from events ---

    @cached_property
    def id_fields(self) -> DataFrame:
        n, u = F.col("event_id"), F.col("user_id")
        return self.table("events").select(
            "event_id", lid.epoch_ms("ts").alias("ts_ms"), (n % 14 + 1).alias("layer"),
            (u % 256).alias("experiment"), (n % 65536).alias("file"), (n % 16).alias("run"),
            (n % 1024).alias("channel"), (u * 7 % 1024).alias("segment"), (n % 2).alias("radioactive"))

    @cached_property
    def ids(self) -> DataFrame:
        return self._table("ids", self.make_ids)

    def make_ids(self) -> DataFrame:
        fields = ("ts_ms", "layer", "experiment", "file", "run", "channel", "segment", "radioactive")
        return self.id_fields.withColumn("lid", lid.mint_text(*fields))

    # --- derived records: orders made from parts, parts from suppliers, suppliers from one another ---

    def node(self, key: str, layer: int):
        """Id of a derived record: its number lies in the file and channel fields."""
        return lid.mint_text(1_704_067_200_000, layer, 1, f"{key} % 65536", 0, f"({key} div 65536) % 1024", 0, 0)

    @property
    def node_order(self) -> list[str]:
        """Keys that count past the file field carry on in the channel: by layer, channel and file, ids lie in order of their keys."""
        return ["substr(lid, 1, 18)", "substr(lid, 25, 12)", "substr(lid, 20, 4)"]

    @cached_property
    def edges(self) -> DataFrame:
        """A supplier's parent is the one of half its number; the first one's parent is the third, which closes a cycle."""
        lines, suppliers = self.table("lineitem"), self.table("supplier")
        above = "if(s_suppkey = 1, 3L, s_suppkey div 2)"
        named = [lines.select(self.node("l_orderkey", 3).alias("child_lid"), self.node("l_partkey", 2).alias("parent_lid")),
                 lines.select(self.node("l_partkey", 2).alias("child_lid"), self.node("l_suppkey", 1).alias("parent_lid")),
                 suppliers.select(self.node("s_suppkey", 1).alias("child_lid"), self.node(above, 1).alias("parent_lid"))]
        return named[0].unionByName(named[1]).unionByName(named[2])

    @cached_property
    def summary_edges(self) -> DataFrame:
        """One derived record per experiment and channel, made from the records of all subjects and runs."""
        made = lid.mint_text(1_704_067_200_000, 3, "code", 0, 0, "channel_idx", 0, 0)
        return self.record.join(self.codes, "experiment").select(made.alias("child_lid"), F.col("lid").alias("parent_lid"))

    # --- ranges of ids: of a user's day, of a kind's day, of a kind ---

    @cached_property
    def id_ranges(self) -> DataFrame:
        day, user = F.to_date("ts").cast("string"), F.col("user_id").cast("string")
        own = self.table("events").select("event_id", "event_type", day.alias("day"), user.alias("user")).join(self.ids, "event_id")
        kinds = F.array(F.concat_ws("/", "user", "day"), F.concat_ws("/", "event_type", "day"), F.col("event_type"))
        return own.select(F.explode(kinds).alias("name"), "lid").groupBy("name").agg(F.min("lid").alias("lid_lo"), F.max("lid").alias("lid_hi"))

    # --- evidence from orders ---

    @cached_property
    def evidence(self) -> DataFrame:
        n, customer = F.col("o_orderkey"), F.col("o_custkey")
        frameworks = {"1-URGENT": "Part11", "2-HIGH": "GDPR-Art9", "3-MEDIUM": "ALCOA+", "4-NOT SPECIFIED": "ISO13485"}
        framework = F.lit("contract")
        for priority, name in frameworks.items():
            framework = F.when(F.col("o_orderpriority") == priority, name).otherwise(framework)
        dataset = (F.when(F.col("o_orderstatus") == "F", "gold/channel_quality")
                   .when(F.col("o_orderstatus") == "O", "silver/recording").otherwise("gold/feature_window"))
        run = F.concat(F.lit("R"), n % 3)
        version = F.sha2(F.when(dataset == "silver/recording", F.concat(dataset, run)).otherwise(dataset), 256)
        return self.table("orders").select(
            run.alias("run_id"), F.concat(F.when(n % 8 == 0, "lid/").otherwise(""), F.lit("C"), n).alias("check_id"),
            F.concat(F.lit("Q"), customer % 20).alias("requirement_id"), framework.alias("framework"),
            dataset.alias("dataset"), version.alias("dataset_version"),
            F.when(n % 8 == 0, "not_null").when(n % 8 == 1, "row_count_min").when(n % 8 == 2, "retention")
            .otherwise("sql").alias("check_kind"), F.when(customer % 5 == 0, "flag").otherwise("block").alias("severity"),
            F.lit(None).cast("string").alias("clause"), F.concat(F.lit("control "), customer % 20).alias("control"),
            F.when(n % 11 == 0, "fail").when(n % 11 == 1, "error").otherwise("pass").alias("result"),
            (customer % 7).cast("string").alias("observed"),
            F.when(n % 13 == 0, "no records").otherwise((n % 7).cast("string")).alias("expected"),
            F.col("o_orderdate").cast("timestamp_ntz").alias("ran_at"), F.lit("4.1").alias("engine_version"),
            F.substring(F.sha2(F.concat(F.lit("commit"), n % 5), 256), 1, 40).alias("git_commit"),
            F.lit(None).cast("string").alias("lid"))

    @cached_property
    def manifest(self) -> DataFrame:
        """Counts of three datasets; the digest of one differs from what its checks saw."""
        counted = manifest.dataset_manifest(
            {"bronze/recording": self.bronze_recording, "silver/recording": self.recording,
             "gold/feature_window": self.window_table}, self.file_dim)
        seen = F.when(F.col("dataset") == "gold/feature_window", F.concat("dataset", F.lit("R2"))).otherwise(
            F.when(F.col("dataset") == "silver/recording", F.concat("dataset", F.lit("R2"))).otherwise(F.col("dataset")))
        return counted.withColumn("dataset_version", F.sha2(seen, 256)).withColumn(
            "git_commit", F.substring(F.sha2(F.concat(F.lit("build"), "n_records"), 256), 1, 40))

    @cached_property
    def blob_lines(self) -> DataFrame:
        """Files of known content, one per block of order keys with its order lines: path, line, priority, status. The lines of the
        first block are long, which makes one file greater than the chunks that digests and copies read."""
        block = F.expr(f"l_orderkey div {ORDERS_PER_FILE}")
        line = F.concat_ws(",", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("bigint"), "l_returnflag")
        priority = (block % 5 + 1).cast("string")
        below = F.concat(F.lit("raw/experiment="), priority, F.lit("/block-"), block, F.lit(".parquet"))
        return self.table("lineitem").select(
            below.alias("path"), F.when(block == 0, F.rpad(line, LONG_LINE, ".")).otherwise(line).alias("line"),
            priority.alias("priority"), F.element_at(F.array(*map(F.lit, "FOP")), (block % 3 + 1).cast("int")).alias("status"))

    @cached_property
    def blobs(self) -> DataFrame:
        """One row per file: path, content, priority, status. A block has a bounded number of lines."""
        return self.blob_lines.groupBy("path", "priority", "status").agg(F.array_join(F.array_sort(F.collect_list("line")), "\n").alias("content"))

    def blob_files(self, root: str, empty_status: str = "", without: str = "") -> str:
        """The files below `root`; those of one status empty, those of another not written."""
        line = F.when(F.col("status") != empty_status, F.col("line"))
        files.write_lines(self.blob_lines.where(F.col("status") != without).select("path", line.alias("line")), root)
        return root

    @cached_property
    def published(self) -> DataFrame:
        """Published files with the digest received: one file of the windows did not arrive intact."""
        part = F.col("o_orderkey") % 50
        name = F.when(F.col("o_orderstatus") == "F", "channel_quality").when(F.col("o_orderstatus") == "P", "feature_window").otherwise("experiment_summary")
        path = F.concat(F.lit("gold/"), name, F.lit("/part-"), part, F.lit(".parquet"))
        broken = (name == "feature_window") & (part == 7)
        return self.table("orders").select(path.alias("path"), broken.alias("broken")).distinct().select(
            "path", F.sha2("path", 256).alias("sha256"),
            F.sha2(F.when(F.col("broken"), F.concat("path", F.lit("x"))).otherwise(F.col("path")), 256).alias("received"))

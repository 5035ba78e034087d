"""Datasets of the lake: declared columns, keys, partitions and rules.

Index and time columns of samples are BIGINT, not 32-bit: the values are the same and a long recording
does not overflow. The id is its 36-character text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(), "byte": T.ByteType(), "short": T.ShortType(), "int": T.IntegerType(),
    "long": T.LongType(), "float": T.FloatType(), "timestamp": T.TimestampNTZType(),
    "strings": T.ArrayType(T.StringType()),
}


@dataclass(frozen=True)
class Dataset:
    name: str
    columns: tuple[tuple[str, str, bool], ...]  # name, type, required
    partitions: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    accepted: tuple[tuple[str, tuple[str, ...]], ...] = ()
    forbidden: tuple[str, ...] = ()
    minimum_rows: int | None = None
    evolves: bool = False
    committed: bool = False

    @property
    def layer(self) -> str:
        return self.name.split("/")[0]

    @property
    def view(self) -> str:
        return self.name.replace("/", "_")

    @property
    def fields(self) -> list[str]:
        return [c[0] for c in self.columns]

    @property
    def required(self) -> list[str]:
        return [c[0] for c in self.columns if c[2]]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, _TYPES[t], True) for n, t, _ in self.columns])


def _columns(text: str):
    """`name:type` per column, `?` after the type of an optional one."""
    parsed = []
    for item in text.split():
        name, kind = item.split(":")
        parsed.append((name, kind.rstrip("?"), not kind.endswith("?")))
    return tuple(parsed)


_PID = ("subject_src",)

DATASETS = {d.name: d for d in (
    Dataset("bronze/recording", _columns(
        "experiment:string subject_src:string run:short channel_idx:short sample_idx:long value_raw:float? "
        "ingest_id:string lid:string"),
        partitions=("experiment", "subject_src", "ingest_id"), committed=True),
    Dataset("bronze/electrode", _columns(
        "experiment:string subject_src:string channel_idx:short x_mm:float? y_mm:float? z_mm:float? "
        "brain_area:string? ingest_id:string lid:string"),
        partitions=("experiment", "subject_src"), committed=True),
    Dataset("bronze/event", _columns(
        "experiment:string subject_src:string run:short sample_idx:long event_code:short event_label:string? "
        "ingest_id:string lid:string"),
        partitions=("experiment", "subject_src"), committed=True),
    Dataset("bronze/ingest_audit", _columns(
        "ingest_id:string data_root:string source_path_rel:string source_url:string sha256:string bytes:long "
        "sample_rate_hz:int rows_written:long tool:string tool_version:string engine_version:string "
        "ingest_host:string ingested_at:timestamp ingest_ord:int")),
    Dataset("silver/subject", _columns("subject_pid:string first_seen_at:timestamp"),
            unique=(("subject_pid",),), forbidden=_PID),
    Dataset("silver/record", _columns(
        "lid:string experiment:string subject_pid:string run:short channel_idx:short n_samples_src:long "
        "scale_basis:string"),
        unique=(("lid",),), accepted=(("scale_basis", ("documented", "assumed")),), forbidden=_PID),
    Dataset("silver/recording", _columns(
        "experiment:string subject_pid:string run:short channel_idx:short ts_ms:long value_uv:float lid:string "
        "sample_idx:long"),
        partitions=("experiment", "subject_pid"), forbidden=_PID, minimum_rows=1),
    Dataset("silver/electrode", _columns(
        "experiment:string subject_pid:string channel_idx:short x_mm:float? y_mm:float? z_mm:float? "
        "brain_area:string? lid:string"),
        partitions=("experiment", "subject_pid"), forbidden=_PID),
    Dataset("silver/event", _columns(
        "experiment:string subject_pid:string run:short ts_ms:long event_code:short event_label:string? lid:string"),
        partitions=("experiment", "subject_pid"), forbidden=_PID),
    Dataset("gold/channel_quality", _columns(
        "experiment:string subject_pid:string run:short channel_idx:short n_samples:long missing_samples:long "
        "rms_uv:float clipped_pct:float clipped_own_pct:float line_noise_ratio:float? scale_basis:string lid:string"),
        unique=(("lid",),), accepted=(("scale_basis", ("documented", "assumed")),), forbidden=_PID),
    Dataset("gold/experiment_summary", _columns(
        "experiment:string subject_pid:string n_runs:short n_channels:short duration_s:float n_events:int"),
        unique=(("experiment", "subject_pid"),), forbidden=_PID),
    Dataset("gold/feature_window", _columns(
        "experiment:string subject_pid:string run:short channel_idx:short window_start_ms:long mean_uv:float "
        "std_uv:float p2p_uv:float lid:string sample_lo:long sample_hi:long"),
        unique=(("lid", "window_start_ms"),), forbidden=_PID),
    Dataset("gold/evidence", _columns(
        "run_id:string check_id:string requirement_id:string framework:string dataset:string dataset_version:string "
        "check_kind:string severity:string? clause:string? control:string? result:string observed:string? "
        "expected:string? ran_at:timestamp engine_version:string git_commit:string lid:string?"),
        partitions=("run_id",), unique=(("run_id", "check_id"),), evolves=True),
    Dataset("gold/dataset_manifest", _columns(
        "dataset_version:string dataset:string layer:byte lid_lo:string? lid_hi:string? n_records:long "
        "file_digests:strings produced_at:timestamp git_commit:string"),
        unique=(("dataset_version",), ("dataset",)), forbidden=_PID),
)}

# Experiment codes of the fixture lake, microvolts per raw unit and where the scale comes from.
EXPERIMENT_CODES = {"click": 1, "error": 2, "purchase": 3, "signup": 4, "view": 5}
UNIT_SCALE = {
    "click": (0.0298, "documented"), "error": (0.0298, "documented"), "purchase": (0.0298, "documented"),
    "signup": (0.0298, "documented"), "view": (0.0298, "assumed"),
}

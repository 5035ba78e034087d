"""The lineage functions under SQL names, for rules and users that write SQL.

They take and return the text form; `lid_from_uuid` and `lid_to_uuid` are therefore identities, kept so that
queries written with them run unchanged.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from sampletide.functions.lid import HIGH_FIELDS, LOW_FIELDS, text

_FIELDS = HIGH_FIELDS + LOW_FIELDS


def _scalars():
    """name, arguments, result type, body."""
    yield "lid_from_uuid", "lid STRING", "STRING", "lid"
    yield "lid_to_uuid", "lid STRING", "STRING", "lid"
    yield "lid_hi", "lid STRING", "BIGINT", text.hi("lid")
    yield "lid_lo", "lid STRING", "BIGINT", text.lo("lid")
    for word, layout in (("lid_hi(lid)", HIGH_FIELDS), ("lid_lo(lid)", LOW_FIELDS)):
        for name, width, shift in layout:
            yield f"lid_{name}", "lid STRING", "BIGINT", f"shiftrightunsigned({word}, {shift}) & {(1 << width) - 1}L"
    yield ("lid_decode", "lid STRING", f"STRUCT<{', '.join(n + ': BIGINT' for n, _, _ in _FIELDS)}>",
           text.decode("lid_hi(lid)", "lid_lo(lid)"))
    named = {n: n for n, _, _ in _FIELDS}
    yield ("lid_encode", ", ".join(f"{n} BIGINT" for n in named), "STRING",
           text.words_text(text.pack(HIGH_FIELDS, named), text.pack(LOW_FIELDS, named)))
    yield "lid_time", "lid STRING", "TIMESTAMP_NTZ", text.from_epoch_ms("lid_ts_ms(lid)")
    yield "lid_validate", "lid STRING, expected INT", "BOOLEAN", "lid_layer(lid) = expected"
    yield ("lid_relayer", "lid STRING, expected INT", "STRING",
           "if(lid_layer(lid) = expected and expected < 15, concat(substr(lid, 1, 14), lower(hex(expected + 1)), "
           "substr(lid, 16)), raise_error(concat('lineage id: cannot go one layer down from ', lid_layer(lid))))")
    yield "lid_parent", "lid STRING", "STRING", text.parent("lid")
    yield "lid_text", "lid STRING", "STRING", text.crockford("lid")
    yield "lid_parse", "txt STRING", "STRING", text.from_crockford("txt")


def register(spark: SparkSession) -> None:
    """Temporary functions of this session."""
    for name, arguments, returns, body in _scalars():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {returns} RETURN {body}")


def register_tables(spark: SparkSession) -> None:
    """Table functions over the views lineage_dim, lineage_experiment, lineage_bounds and silver_record."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION lid_trace(lid STRING) RETURNS TABLE(source_path STRING, "
              "source_url STRING, sha256 STRING, ts_ms BIGINT, layer BIGINT, experiment STRING, run BIGINT, "
              "channel BIGINT, segment BIGINT) RETURN SELECT d.source_path, d.source_url, d.sha256, lid_ts_ms(lid_trace.lid), "
              "lid_layer(lid_trace.lid), e.experiment, lid_run(lid_trace.lid), lid_channel(lid_trace.lid), "
              "lid_segment(lid_trace.lid) FROM lineage_dim d, lineage_experiment e "
              "WHERE d.ingest_ord = lid_file(lid_trace.lid) AND e.code = lid_experiment(lid_trace.lid)")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION lid_children(ing INT) RETURNS TABLE(lid STRING, experiment STRING, "
              "subject_pid STRING, run SMALLINT, channel_idx SMALLINT, n_samples_src BIGINT, scale_basis STRING) "
              "RETURN SELECT r.lid, r.experiment, r.subject_pid, r.run, r.channel_idx, r.n_samples_src, r.scale_basis "
              "FROM silver_record r JOIN lineage_bounds b ON r.lid BETWEEN b.lid_lo AND b.lid_hi "
              "WHERE b.ingest_ord = lid_children.ing")

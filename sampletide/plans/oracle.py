"""Equivalent SQL per registered query, for the checking engine, over the given tables only.

The shared views are WITH clauses, written independently of the Spark operators: ids are assembled digit by
digit from text, quality is computed from the samples directly, the spectrum bin by bin.
"""

from __future__ import annotations

import csv
import fnmatch
import json
import re

from sampletide.plans.fixtures import AREAS, TEST_SECRET
from sampletide.sources import rules
from sampletide.sources.registry import DATASETS

_IPAD = bytes(b ^ 0x36 for b in TEST_SECRET.ljust(64, b"\0")).hex()
_OPAD = bytes(b ^ 0x5C for b in TEST_SECRET.ljust(64, b"\0")).hex()


def _lid(ts, layer, code, ord_, run, channel, segment="0", radioactive="0"):
    tail = f"(({channel})::BIGINT * 17179869184 + ({segment})::BIGINT * 16777216 + ({radioactive})::BIGINT * 8388608)"
    stamp = f"printf('%012x', ({ts})::BIGINT)"
    return (f"(substr({stamp}, 1, 8) || '-' || substr({stamp}, 9, 4) || '-' || printf('%x%02x0', ({layer})::BIGINT, ({code})::BIGINT)"
            f" || '-' || printf('%04x', ({ord_})::BIGINT) || '-' || printf('%x%011x', ({run})::BIGINT, {tail}))")


def _pid(code):
    return f"substr(sha256(unhex('{_OPAD}') || unhex(sha256(unhex('{_IPAD}') || encode({code})))), 1, 16)"


def _layer(lid, digit):
    return f"(substr({lid}, 1, 14) || '{digit}' || substr({lid}, 16))"


def _canary(lid):
    return f"(substr({lid}, 31, 1) >= '8')"


def _text(lid):
    """26 characters: the 128 bits written out, two zeros in front, read five at a time."""
    bits = (f"('00' || list_aggregate(list_transform(string_split(replace({lid}, '-', ''), ''), "
            "lambda c: format('{:04b}', ('0x' || c)::INTEGER)), 'string_agg', ''))")
    digit = " + ".join(f"{2 ** (4 - j)} * substr(g, {j + 1}, 1)::INTEGER" for j in range(5))
    groups = f"list_transform(range(26), lambda i: substr({bits}, (5 * i + 1)::INTEGER, 5))"
    return (f"list_aggregate(list_transform({groups}, lambda g: substr('0123456789ABCDEFGHJKMNPQRSTVWXYZ', {digit} + 1, 1)), "
            "'string_agg', '')")


_AREA_CASE = "CASE {0} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in AREAS.items()) + " END"
_MS = "epoch_ms(date_trunc('millisecond', {0}))"

VIEWS = {
    "codes": "SELECT * FROM (VALUES (1, 'click'), (2, 'error'), (3, 'purchase'), (4, 'signup'), (5, 'view')) v(code, experiment)",
    "samples": """SELECT event_type AS experiment, 'u' || (user_id % 10) AS subject_src,
        (CASE WHEN day(ts) < 16 THEN 1 ELSE 2 END)::SMALLINT AS run, (event_id % 4)::SMALLINT AS channel_idx,
        event_id AS sample_idx, CASE WHEN event_id % 97 = 0 THEN NULL ELSE value::FLOAT END AS value_raw, ts FROM events""",
    "sources": """SELECT experiment || '-' || subject_src AS ingest_id, '/lake' AS data_root,
        CASE WHEN experiment = 'click' AND subject_src = 'u0' THEN '/mnt/' ELSE '' END || 'raw/' || experiment || '/' || subject_src || '.mat'
            AS source_path_rel,
        'https://example.org/' || experiment || '.zip' AS source_url, sha256(experiment || '/' || subject_src) AS sha256,
        count(*) * 4 AS bytes, CASE WHEN experiment = 'click' THEN 512 ELSE 1000 END AS sample_rate_hz, count(*) AS rows_written,
        'ingest' AS tool, '1' AS tool_version, '4.1' AS engine_version, 'host' AS ingest_host,
        date_trunc('millisecond', min(ts)) AS ingested_at, experiment, subject_src
        FROM samples GROUP BY experiment, subject_src""",
    "ingests": """SELECT s.*, row_number() OVER (ORDER BY ingested_at, sha256) AS ingest_ord, epoch_ms(ingested_at) AS ts_ms, code,
        CASE WHEN subject_src = 'u9' THEN 1 ELSE 0 END AS radioactive FROM sources s JOIN codes USING (experiment)""",
    "bronze": f"""SELECT s.experiment, s.subject_src, s.run, s.channel_idx, s.sample_idx, s.value_raw, i.ingest_id,
        {_lid('i.ts_ms', '1', 'i.code', 'i.ingest_ord', 's.run', 's.channel_idx', '0', 'i.radioactive')} AS lid,
        i.sample_rate_hz, i.ingest_ord
        FROM samples s JOIN ingests i ON s.experiment = i.experiment AND s.subject_src = i.subject_src""",
    "keys": f"""SELECT subject_src, {_pid('subject_src')} AS subject_pid, date_trunc('millisecond', min(ts)) AS created_at
        FROM samples GROUP BY subject_src""",
    "record": f"""SELECT {_layer('b.lid', 2)} AS lid, b.experiment, k.subject_pid, b.run, b.channel_idx, count(*) AS n_samples_src,
        CASE WHEN b.experiment = 'view' THEN 'assumed' ELSE 'documented' END AS scale_basis
        FROM bronze b JOIN keys k USING (subject_src) GROUP BY ALL""",
    "recording": f"""SELECT b.experiment, k.subject_pid, b.run, b.channel_idx,
        round_even(b.sample_idx * 1000 / b.sample_rate_hz, 0)::BIGINT AS ts_ms,
        (b.value_raw * 0.0298::FLOAT)::FLOAT AS value_uv, {_layer('b.lid', 2)} AS lid, b.sample_idx, b.ingest_ord
        FROM bronze b JOIN keys k USING (subject_src) WHERE b.value_raw IS NOT NULL""",
    "channels": "SELECT DISTINCT experiment, subject_src, channel_idx FROM samples",
    "bronze_electrodes": f"""SELECT c.experiment, c.subject_src, c.channel_idx,
        CASE WHEN c.channel_idx <> 3 THEN c.channel_idx * 10.0::DOUBLE END AS x_mm,
        CASE WHEN c.channel_idx <> 3 THEN substr(c.subject_src, 2)::INTEGER * 10.0::DOUBLE END AS y_mm,
        CASE WHEN c.channel_idx <> 3 THEN 0.0::DOUBLE END AS z_mm,
        CASE WHEN c.channel_idx <> 3 THEN {_AREA_CASE.format('(c.channel_idx + substr(c.subject_src, 2)::INTEGER) % 8')} END AS brain_area,
        i.ingest_id, {_lid('i.ts_ms', '1', 'i.code', 'i.ingest_ord', '1', 'c.channel_idx', '0', 'i.radioactive')} AS lid
        FROM channels c JOIN ingests i USING (experiment, subject_src)""",
    "electrode": f"""SELECT experiment, subject_pid, channel_idx, x_mm, y_mm, z_mm, brain_area, {_layer('lid', 2)} AS lid
        FROM bronze_electrodes JOIN keys USING (subject_src)""",
    "cue_rows": """SELECT vec_id AS sample_idx, label::SMALLINT AS event_code,
        coalesce(lag(label) OVER (ORDER BY vec_id), 0) AS before FROM embeddings""",
    "cue_onsets": "SELECT sample_idx, event_code FROM cue_rows WHERE event_code <> 0 AND event_code <> before",
    "cues": """SELECT CASE (sample_idx % 50) // 10 WHEN 0 THEN 'click' WHEN 1 THEN 'error' WHEN 2 THEN 'purchase' WHEN 3 THEN 'signup'
            ELSE 'view' END AS experiment, 'u' || (sample_idx % 10) AS subject_src, sample_idx, event_code,
        CASE WHEN event_code BETWEEN 1 AND 4 THEN 'house' WHEN event_code BETWEEN 5 AND 8 THEN 'face' END AS event_label FROM cue_onsets""",
    "bronze_events": f"""SELECT c.experiment, c.subject_src, 1::SMALLINT AS run, c.sample_idx, c.event_code, c.event_label, i.ingest_id,
        {_lid('i.ts_ms', '1', 'i.code', 'i.ingest_ord', '1', '0', '0', 'i.radioactive')} AS lid, i.sample_rate_hz
        FROM cues c JOIN ingests i USING (experiment, subject_src)""",
    "event": f"""SELECT experiment, subject_pid, run, round_even(sample_idx * 1000 / sample_rate_hz, 0)::BIGINT AS ts_ms, event_code, event_label,
        {_layer('lid', 2)} AS lid FROM bronze_events JOIN keys USING (subject_src)""",
    "extremes": f"""SELECT lid, min(value_uv) AS lo, max(value_uv) AS hi FROM recording WHERE NOT {_canary('lid')} GROUP BY lid""",
    "rails": """SELECT lid, min(lo) OVER w AS rail_lo, max(hi) OVER w AS rail_hi
        FROM extremes JOIN record USING (lid) WINDOW w AS (PARTITION BY experiment, subject_pid, run)""",
    "quality": f"""SELECT r.experiment, r.subject_pid, r.run, r.channel_idx, m.n_samples, r.n_samples_src - m.n_samples AS missing_samples,
        m.rms_uv, m.clipped_pct, m.clipped_own_pct, NULL::DOUBLE AS line_noise_ratio, r.scale_basis, {_layer('r.lid', 3)} AS lid
        FROM record r JOIN (
            SELECT s.lid, count(*) AS n_samples, sqrt(avg(s.value_uv * s.value_uv))::FLOAT AS rms_uv,
                (100.0::DOUBLE * sum(CASE WHEN s.value_uv IN (a.rail_lo, a.rail_hi) THEN 1 ELSE 0 END) / count(*))::FLOAT AS clipped_pct,
                (100.0::DOUBLE * sum(CASE WHEN s.value_uv IN (e.lo, e.hi) THEN 1 ELSE 0 END) / count(*))::FLOAT AS clipped_own_pct
            FROM recording s JOIN rails a USING (lid) JOIN extremes e USING (lid) GROUP BY s.lid) m ON m.lid = r.lid""",
    "windows": f"""SELECT experiment, subject_pid, run, channel_idx, ts_ms // 1000 * 1000 AS window_start_ms,
        avg(value_uv)::FLOAT AS mean_uv, stddev_pop(value_uv)::FLOAT AS std_uv, (max(value_uv) - min(value_uv))::FLOAT AS p2p_uv,
        {_layer('lid', 3)} AS lid, min(sample_idx) AS sample_lo, max(sample_idx) AS sample_hi
        FROM recording WHERE NOT {_canary('lid')} GROUP BY ALL""",
    "summary": f"""SELECT r.experiment, r.subject_pid, count(*)::SMALLINT AS n_runs, max(r.n_channels)::SMALLINT AS n_channels,
        (sum(r.duration_ms) / 1000.0::DOUBLE)::FLOAT AS duration_s,
        (SELECT count(*) FROM event e WHERE e.experiment = r.experiment AND e.subject_pid = r.subject_pid)::INTEGER AS n_events
        FROM (SELECT experiment, subject_pid, run, count(DISTINCT channel_idx) AS n_channels, max(ts_ms) + 1 AS duration_ms
              FROM recording GROUP BY ALL) r
        WHERE r.subject_pid NOT IN (SELECT subject_pid FROM record WHERE {_canary('lid')}) GROUP BY r.experiment, r.subject_pid""",
    "dim": """SELECT ingest_ord::INTEGER AS ingest_ord, ingest_id,
        CASE WHEN source_path_rel LIKE '/%' THEN source_path_rel ELSE data_root || '/' || source_path_rel END AS source_path,
        source_url, sha256, ts_ms, experiment, code FROM ingests""",
    "bounds": f"""SELECT ingest_ord, ingest_id, {_lid('ts_ms', '2', 'code', 'ingest_ord', '0', '0')} AS lid_lo,
        substr({_lid('ts_ms', '2', 'code', 'ingest_ord', '15', '1023', '1023', '1')}, 1, 30) || 'ffffff' AS lid_hi FROM dim""",
    "tones": f"""SELECT o_orderkey % 7 AS channel_idx, o_orderkey // 7 AS sample_idx,
        (o_totalprice / 10000 + CASE WHEN (o_orderkey % 7) % 3 <> 0 THEN 0 WHEN (o_orderkey // 7) % 4 = 1 THEN 100
            WHEN (o_orderkey // 7) % 4 = 3 THEN -100 ELSE 0 END)::FLOAT AS value_uv,
        {_lid('1704067200000', '3', '1', '1', '1', 'o_orderkey % 7')} AS lid FROM orders""",
    "tone_bins": """SELECT channel_idx, k, sum(value_uv::DOUBLE * cos(2 * pi() * ((k * sample_idx) % 2000) / 2000)) AS re,
        sum(value_uv::DOUBLE * sin(2 * pi() * ((k * sample_idx) % 2000) / 2000)) AS im
        FROM tones, (SELECT unnest(range(490, 511)) AS k UNION ALL SELECT unnest(range(590, 611)))
        WHERE sample_idx < 2000 GROUP BY ALL""",
    "tone_noise": """SELECT t.channel_idx, CASE WHEN t.n = 2000 AND t.v > 0 THEN b.power / ((2000.0::DOUBLE * 2000 * t.v + t.alt * t.alt) / 2) END AS line_noise_ratio
        FROM (SELECT channel_idx, count(*) AS n, var_pop(value_uv::DOUBLE) AS v,
                  sum(CASE WHEN sample_idx % 2 = 0 THEN value_uv::DOUBLE ELSE -value_uv::DOUBLE END) AS alt
              FROM tones WHERE sample_idx < 2000 GROUP BY channel_idx) t
        JOIN (SELECT channel_idx, sum(re * re + im * im) AS power FROM tone_bins GROUP BY channel_idx) b USING (channel_idx)""",
    "tone_quality": """SELECT 'click' AS experiment, 'p' || (channel_idx % 2) AS subject_pid, (channel_idx % 2 + 1)::SMALLINT AS run,
        channel_idx::SMALLINT AS channel_idx, count(*) AS n_samples, 0::BIGINT AS missing_samples, sqrt(avg(value_uv * value_uv))::FLOAT AS rms_uv,
        (100.0::DOUBLE * count(*) FILTER (value_uv IN (rail_lo, rail_hi)) / count(*))::FLOAT AS clipped_pct,
        (100.0::DOUBLE * count(*) FILTER (value_uv IN (lo, hi)) / count(*))::FLOAT AS clipped_own_pct,
        any_value(line_noise_ratio)::FLOAT AS line_noise_ratio, 'documented' AS scale_basis, lid
        FROM (SELECT *, min(value_uv) OVER r AS rail_lo, max(value_uv) OVER r AS rail_hi, min(value_uv) OVER c AS lo, max(value_uv) OVER c AS hi
              FROM tones WINDOW r AS (PARTITION BY channel_idx % 2), c AS (PARTITION BY channel_idx)) t
        JOIN tone_noise USING (channel_idx) GROUP BY channel_idx, lid""",
    "ids": f"""SELECT *, {_lid('ts_ms', 'layer', 'experiment', 'file', 'run', 'channel', 'segment', 'radioactive')} AS lid FROM (
        SELECT event_id, {_MS.format('ts')} AS ts_ms, event_id % 14 + 1 AS layer, user_id % 256 AS experiment, event_id % 65536 AS file,
            event_id % 16 AS run, event_id % 1024 AS channel, user_id * 7 % 1024 AS segment, event_id % 2 AS radioactive FROM events)""",
    "evidence": """SELECT 'R' || (o_orderkey % 3) AS run_id, CASE WHEN o_orderkey % 8 = 0 THEN 'lid/' ELSE '' END || 'C' || o_orderkey AS check_id,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'Part11' WHEN '2-HIGH' THEN 'GDPR-Art9' WHEN '3-MEDIUM' THEN 'ALCOA+'
            WHEN '4-NOT SPECIFIED' THEN 'ISO13485' ELSE 'contract' END AS framework,
        CASE o_orderstatus WHEN 'F' THEN 'gold/channel_quality' WHEN 'O' THEN 'silver/recording' ELSE 'gold/feature_window' END AS dataset,
        CASE o_orderstatus WHEN 'F' THEN sha256('gold/channel_quality') WHEN 'O' THEN sha256('silver/recordingR' || (o_orderkey % 3))
            ELSE sha256('gold/feature_window') END AS dataset_version,
        CASE o_orderkey % 8 WHEN 0 THEN 'not_null' WHEN 1 THEN 'row_count_min' WHEN 2 THEN 'retention' ELSE 'sql' END AS check_kind,
        CASE WHEN o_custkey % 5 = 0 THEN 'flag' ELSE 'block' END AS severity, 'control ' || (o_custkey % 20) AS control,
        CASE o_orderkey % 11 WHEN 0 THEN 'fail' WHEN 1 THEN 'error' ELSE 'pass' END AS result, (o_custkey % 7)::VARCHAR AS observed,
        CASE WHEN o_orderkey % 13 = 0 THEN 'no records' ELSE (o_orderkey % 7)::VARCHAR END AS expected, o_orderdate AS ran_at,
        substr(sha256('commit' || (o_orderkey % 5)), 1, 40) AS git_commit FROM orders""",
    "latest": "SELECT * FROM evidence WHERE run_id = (SELECT max(run_id) FROM evidence)",
    "manifest": """SELECT 'bronze/recording' AS dataset, 1 AS layer, count(*) AS n_records, sha256('bronze/recording') AS dataset_version FROM bronze
        UNION ALL SELECT 'silver/recording', 2, count(*), sha256('silver/recordingR2') FROM recording
        UNION ALL SELECT 'gold/feature_window', 3, count(*), sha256('gold/feature_windowR2') FROM windows""",
    "published": """SELECT DISTINCT path, sha256(path) AS sha256, sha256(path || CASE WHEN bad THEN 'x' ELSE '' END) AS received FROM (
        SELECT 'gold/' || CASE o_orderstatus WHEN 'F' THEN 'channel_quality' WHEN 'P' THEN 'feature_window' ELSE 'experiment_summary' END
            || '/part-' || (o_orderkey % 50) || '.parquet' AS path, o_orderstatus = 'P' AND o_orderkey % 50 = 7 AS bad FROM orders)""",
    "blobs": """SELECT 'raw/experiment=' || (block % 5 + 1) || '/block-' || block || '.parquet' AS path, content, (block % 5 + 1)::VARCHAR AS priority,
        ['F', 'O', 'P'][block % 3 + 1] AS status FROM (SELECT block, string_agg(CASE block WHEN 0 THEN rpad(line, 6000, '.') ELSE line END, chr(10)
            ORDER BY CASE block WHEN 0 THEN rpad(line, 6000, '.') ELSE line END) AS content FROM (SELECT l_orderkey // 256 AS block, concat_ws(',', l_orderkey,
            l_linenumber, l_partkey, l_suppkey, l_quantity::BIGINT, l_returnflag) AS line FROM lineitem) GROUP BY block)""",
    "history_summary": """SELECT r AS upto, count(DISTINCT CASE WHEN dataset LIKE 'gold/%' THEN dataset END) AS gold_datasets, count(*) AS checks,
        count(*) FILTER (result = 'pass') AS n_pass, count(*) FILTER (result <> 'pass' AND severity = 'block') AS n_fail,
        count(*) FILTER (result <> 'pass' AND severity = 'flag') AS n_flag, strftime(min(ran_at), '%Y-%m-%d %H:%M:%S') AS ran_at,
        max(git_commit)[1:7] AS git_commit FROM evidence JOIN (VALUES ('R1'), ('R2')) v(r) ON run_id = r GROUP BY r""",
}


def _node(key, layer):
    return _lid("1704067200000", str(layer), "1", f"{key} % 65536", "0", f"({key} // 65536) % 1024")


VIEWS["edges"] = f"""SELECT DISTINCT * FROM (SELECT {_node('l_orderkey', 3)} AS child_lid, {_node('l_partkey', 2)} AS parent_lid FROM lineitem
    UNION ALL SELECT {_node('l_partkey', 2)}, {_node('l_suppkey', 1)} FROM lineitem
    UNION ALL SELECT {_node('s_suppkey', 1)}, {_node('(CASE s_suppkey WHEN 1 THEN 3 ELSE s_suppkey // 2 END)', 1)} FROM supplier)"""
VIEWS["id_ranges"] = """SELECT name, min(lid) AS lid_lo, max(lid) AS lid_hi FROM (SELECT lid, unnest([user_id || '/' || strftime(ts, '%Y-%m-%d'),
    event_type || '/' || strftime(ts, '%Y-%m-%d'), event_type]) AS name FROM events JOIN ids USING (event_id)) GROUP BY name"""


def _needs(sql: str) -> list[str]:
    words = set(re.findall(r"\b\w+\b", sql))
    return [name for name in VIEWS if name in words]


def _with(body: str) -> str:
    """Prefix the views a statement mentions, and theirs, in the order they are declared."""
    wanted, todo = set(), _needs(body)
    while todo:
        name = todo.pop()
        if name not in wanted:
            wanted.add(name)
            todo += [n for n in _needs(VIEWS[name]) if n != name]
    if not wanted:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in VIEWS if n in wanted) + "\n" + body


def _r(column, digits=4, name=None):
    return f"round({column}::DOUBLE, {digits}) AS {name or column}"


def _rows(**parts):
    return " UNION ALL ".join(f"SELECT '{n.replace('__', '/').replace('_s_', ' ')}' AS name, ({q})::VARCHAR AS observed" for n, q in parts.items())


def _nulls(view, columns):
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS observed FROM {view}" for c in columns)


def _flag(found, order, total):
    """'k of n: first five[ and more]' from a statement with an `offender` column."""
    return (f"SELECT CASE WHEN (SELECT count(*) FROM ({found})) = 0 THEN 'no records' ELSE (SELECT count(*) FROM ({found})) || ' of ' || "
            f"(SELECT count(*) FROM {total}) || ': ' || (SELECT string_agg(offender, ', ' ORDER BY n) FROM "
            f"(SELECT offender, row_number() OVER (ORDER BY {order}) AS n FROM ({found})) WHERE n <= 5) || "
            f"CASE WHEN (SELECT count(*) FROM ({found})) > 5 THEN ' and more' ELSE '' END END AS observed")


_BRONZE_COLUMNS = "experiment, subject_src, run, channel_idx, sample_idx"
_IS_OFFENDER_RMS = f"SELECT {_text('lid')} AS offender, round(rms_uv::DOUBLE, 4) AS rms_uv, lid FROM quality WHERE round(rms_uv::DOUBLE, 4) < 1.2 OR round(rms_uv::DOUBLE, 4) > 1000"
_TONES_NOISY = (f"SELECT DISTINCT {_text('lid')} AS offender, round(line_noise_ratio, 4) AS line_noise_ratio, lid FROM tones JOIN tone_noise USING (channel_idx) "
                "WHERE line_noise_ratio >= 0.5")
_RATES = ("SELECT s.experiment || ' ' || s.subject_pid AS offender, round(s.rate, 4) AS per_minute FROM "
          "(SELECT *, 60.0::DOUBLE * n_events / nullif(duration_s::DOUBLE, 0) AS rate FROM summary) s JOIN "
          "(SELECT experiment, median(60.0::DOUBLE * n_events / nullif(duration_s::DOUBLE, 0)) AS middle FROM summary GROUP BY experiment) m "
          "USING (experiment) WHERE s.rate < 0.5 * m.middle OR s.rate > 2 * m.middle")
_RULES = """SELECT 'Q' || o_orderkey AS requirement_id, CASE o_orderstatus WHEN 'F' THEN 'gold/*' WHEN 'O' THEN 'silver/record' ELSE 'published/copy' END AS dataset,
    (o_orderkey % 9)::VARCHAR AS minimum, CASE WHEN o_orderkey % 4 = 0 THEN 'flag' ELSE 'block' END AS severity FROM orders"""
_GOLD = ("channel_quality", "experiment_summary", "feature_window", "evidence", "dataset_manifest")
_CONTRACTS = {
    "silver/record": ("record", "lid experiment subject_pid run channel_idx n_samples_src scale_basis", [["lid"]]),
    "silver/recording": ("recording", "experiment subject_pid run channel_idx ts_ms value_uv lid sample_idx", []),
    "silver/event": ("event", "experiment subject_pid run ts_ms event_code lid", []),
    "gold/experiment_summary": ("summary", "experiment subject_pid n_runs n_channels duration_s n_events", [["experiment", "subject_pid"]]),
    "gold/feature_window": ("windows", "experiment subject_pid run channel_idx window_start_ms mean_uv std_uv p2p_uv lid sample_lo sample_hi",
                            [["lid", "window_start_ms"]]),
}


def _contract_sql():
    parts = []

    def add(dataset, kind, detail, observed, expected="0", ok="observed = expected"):
        owner = dataset.replace("/", "-").replace("_", "-")
        check = f"{owner}/{kind}/{dataset}/{detail}".replace("'", "''")
        parts.append(f"SELECT '{check}' AS check_id, '{dataset}' AS dataset, '{kind}' AS check_kind, ({observed})::VARCHAR AS observed, "
                     f"'{expected}' AS expected, '{ok}' AS how")
    for dataset, (view, columns, unique) in _CONTRACTS.items():
        for c in columns.split():
            add(dataset, "not_null", c, f"SELECT count(*) FROM {view} WHERE {c} IS NULL")
        for u in unique:
            add(dataset, "unique", str(u), f"SELECT count(*) FROM (SELECT 1 FROM {view} GROUP BY {', '.join(u)} HAVING count(*) > 1)")
        if dataset == "silver/record":
            add(dataset, "accepted_values", "scale_basis/['documented', 'assumed']",
                f"SELECT count(*) FROM {view} WHERE scale_basis NOT IN ('documented', 'assumed')")
        add(dataset, "no_direct_identifier", "['subject_src']", "SELECT 0")
        if dataset == "silver/recording":
            add(dataset, "row_count_min", "1", f"SELECT count(*) FROM {view}", "1", "ge")
    return ("SELECT check_id, dataset, check_kind, observed, expected, CASE WHEN how = 'ge' AND observed::DOUBLE >= expected::DOUBLE THEN 'pass' "
            "WHEN observed::DOUBLE = expected::DOUBLE THEN 'pass' ELSE 'fail' END AS result FROM (" + " UNION ALL ".join(parts) + ")")


_LAKE_VIEWS = {
    "bronze/recording": "bronze", "bronze/electrode": "bronze_electrodes", "bronze/event": "bronze_events",
    "bronze/ingest_audit": "(SELECT *, ingest_ord AS stored FROM ingests)", "silver/subject": "(SELECT subject_pid, created_at AS first_seen_at FROM keys)",
    "silver/record": "record", "silver/recording": "recording", "silver/electrode": "electrode", "silver/event": "event",
    "gold/channel_quality": "quality", "gold/experiment_summary": "summary", "gold/feature_window": "windows"}
_PACES = ("SELECT s.experiment || ' ' || s.subject_pid AS offender, s.pace FROM (SELECT *, 60.0::DOUBLE * n_events / nullif(duration_s::DOUBLE, 0) AS pace FROM summary) s "
          "JOIN (SELECT experiment, median(60.0::DOUBLE * n_events / nullif(duration_s::DOUBLE, 0)) AS typical FROM summary GROUP BY experiment) m USING (experiment) "
          "WHERE NOT s.pace BETWEEN 0.5 * m.typical AND 2 * m.typical")


def _evidence_sql():
    """Every rule of the packaged file and of the contracts with what it observes in the fixture's lake.

    Tables that the build fills itself (evidence, manifest, subjects' keys) have no NULL; files and captures are intact.
    """
    owned = [(r.check_id, r.dataset, r.kind, r.severity, r.expected, r.params) for r in rules.contract_rules()]
    with rules.REQUIREMENTS.open(encoding="utf-8", newline="") as lines:
        for row in csv.DictReader(lines):
            params = json.loads(row["params"])
            for name in [n for n in DATASETS if fnmatch.fnmatchcase(n, row["dataset"])] or [row["dataset"]]:
                check = "/".join([row["requirement_id"], row["check_kind"], name, *map(str, params.values())])
                fixed = {"row_count_min": "min", "retention": "max_age_days"}.get(row["check_kind"])
                expected = str(params[fixed]) if fixed else "no records" if row["check_kind"] == "sql" and row["severity"] == "flag" else "0"
                owned.append((check, name, row["check_kind"], row["severity"], expected, params))
    parts = []
    for check, name, kind, severity, expected, params in owned:
        view, observed = _LAKE_VIEWS.get(name), "0"
        if kind == "row_count_min":
            observed = f"(SELECT count(*) FROM {view})" if view else "0"
        elif kind == "not_null" and view:
            observed = f"(SELECT count(*) - count({params['column']}) FROM {view})"
        elif kind == "unique" and view:
            observed = f"(SELECT count(*) FROM (SELECT 1 FROM {view} GROUP BY {', '.join(params['columns'])} HAVING count(*) > 1))"
        elif kind == "accepted_values" and view:
            listed = ", ".join(f"'{v}'" for v in params["values"])
            observed = f"(SELECT count(*) FROM {view} WHERE {params['column']} NOT IN ({listed}))"
        elif kind == "sql" and severity == "block":
            observed = f"(SELECT count(*) FROM {view} WHERE {_canary('lid')})"
        elif kind == "sql" and "low" in params:
            observed = "(" + _flag(f"SELECT {_text('lid')} AS offender, rms_uv, lid FROM quality WHERE NOT rms_uv BETWEEN 1 AND 1000", "rms_uv DESC, lid", "quality") + ")"
        elif kind == "sql" and "share" in params:
            observed = "(" + _flag(f"SELECT {_text('lid')} AS offender, line_noise_ratio, lid FROM quality WHERE NOT line_noise_ratio < 0.5", "line_noise_ratio DESC, lid", "quality") + ")"
        elif kind == "sql":
            observed = "(" + _flag(_PACES, "pace DESC, offender", "summary") + ")"
        quoted = check.replace("'", "''")
        parts.append(f"SELECT '{quoted}' AS check_id, '{name}' AS dataset, '{kind}' AS check_kind, '{severity}' AS severity, ({observed})::VARCHAR AS observed, '{expected}' AS expected")
    relation = ("CASE check_kind WHEN 'row_count_min' THEN observed::DOUBLE >= expected::DOUBLE WHEN 'retention' THEN observed::DOUBLE <= expected::DOUBLE "
                "ELSE observed = expected END")
    return f"SELECT *, CASE WHEN {relation} THEN 'pass' ELSE 'fail' END AS result FROM (" + " UNION ALL ".join(parts) + ")"


_MANIFEST_SOURCES = {
    "bronze/recording": ("1", "bronze", "ingest_ord"), "silver/record": ("2", "record", None), "silver/recording": ("2", "recording", "ingest_ord"),
    "silver/event": ("2", "event", None), "gold/feature_window": ("3", "windows", None)}


def _manifest_sql():
    parts = [f"""SELECT '{d}' AS dataset, {layer}::TINYINT AS layer, min(lid) AS lid_lo, max(lid) AS lid_hi, count(*) AS n_records,
        (SELECT string_agg(sha256, ',' ORDER BY sha256) FROM dim WHERE printf('%04x', ingest_ord::BIGINT) IN (SELECT substr(lid, 20, 4) FROM {view})) AS file_digests
        FROM {view}""" for d, (layer, view, _) in _MANIFEST_SOURCES.items()]
    parts.append("SELECT 'bronze/ingest_audit', 1::TINYINT, NULL, NULL, count(*), string_agg(sha256, ',' ORDER BY sha256) FROM dim")
    return " UNION ALL ".join(parts)


def _outcome():
    return ("count(*) AS checks, count(*) FILTER (result = 'pass') AS n_pass, count(*) FILTER (result <> 'pass') AS n_not_pass")


_PRICES = "SELECT unnest(['all', 'flag ' || l_returnflag]) AS name, l_extendedprice AS price FROM lineitem"
# Longer than any shortest path here: suppliers are as many levels deep as their number has bits.
_FARTHEST = 24


def _closure(start, at, to):
    return f"""SELECT lid, steps, count(*) AS n, min(node) AS first, max(node) AS last FROM (SELECT lid, node, min(steps)::INTEGER AS steps FROM (WITH RECURSIVE walk AS (
        SELECT s.lid, {to} AS node, 1 AS steps FROM ({start}) s JOIN edges ON {at} = s.lid
        UNION SELECT w.lid, {to}, steps + 1 FROM walk w JOIN edges ON {at} = w.node WHERE steps < {_FARTHEST}) SELECT * FROM walk) GROUP BY lid, node) GROUP BY lid, steps"""


_BLOB_FILES = "SELECT path, length(content)::BIGINT AS bytes, sha256(content) AS sha256 FROM blobs"

STATEMENTS = {
    "evidence_run": _evidence_sql(),
    # scans, sinks, layout
    "scan_dataset": "SELECT experiment, subject_src, count(*) AS n_rows, max(lid) AS last_lid FROM bronze_events GROUP BY ALL",
    "union_by_name_scan": """SELECT run_id, count(*) AS n_rows, CASE WHEN run_id = 'R0' THEN 0 ELSE count(*) END AS with_control,
        CASE WHEN run_id = 'R0' THEN 0 ELSE count(*) END AS with_severity FROM evidence GROUP BY run_id""",
    "committed_read": "SELECT ingest_id, count(*) AS n_rows FROM bronze WHERE ingest_id <> 'view-u7' GROUP BY ingest_id",
    "orphan_ingests": "SELECT ingest_id, experiment, subject_src, count(*) AS n_rows FROM bronze WHERE ingest_id = 'view-u7' GROUP BY ALL",
    "bronze_append": """SELECT experiment, subject_src, ingest_id, count(*) AS n_rows, count(value_raw) AS n_values,
        round(sum(value_raw::DOUBLE), 4) AS total FROM bronze GROUP BY ALL""",
    "silver_overwrite": """SELECT experiment, subject_pid, count(*) AS n_rows, max(event_code) AS top_code FROM (
        SELECT e.*, experiment = 'click' AND EXISTS (SELECT 1 FROM event x WHERE x.experiment = e.experiment AND x.subject_pid = e.subject_pid
            AND x.event_code < 5) AS replaced FROM event e) WHERE NOT replaced OR event_code < 5 GROUP BY ALL""",
    "layout_write": """SELECT experiment, subject_pid, count(*) AS n_rows, 0::BIGINT AS out_of_order, 0::BIGINT AS oversized_groups
        FROM recording GROUP BY experiment, subject_pid""",
    "evidence_append": "SELECT run_id, result, count(*) AS n_rows, strftime(max(ran_at), '%Y-%m-%d %H:%M:%S') AS last_ran_at FROM evidence GROUP BY ALL",
    "dataset_version": "SELECT priority AS dataset, sha256(string_agg(sha256(content), chr(10) ORDER BY sha256(content))) AS dataset_version FROM blobs GROUP BY priority",
    "aborted_files": "SELECT count(*) FILTER (status = 'P') AS n_aborted, count(*) AS n_files FROM blobs",
    "multi_file_count": "SELECT 'orders' AS table_name, count(*) AS n_rows FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem",
    "file_sortedness": "SELECT count(*) AS n_rows, 0::BIGINT AS out_of_order FROM recording",
    "file_digests": _BLOB_FILES,
    "layer_bytes": "SELECT 'bronze' AS layer, priority AS experiment, count(*) AS files, sum(length(content))::BIGINT AS bytes FROM blobs GROUP BY ALL",
    "manifest_unnest": "SELECT string_split(path, '/')[2] AS mart, path, sha256 FROM published",
    "requirements_rules": f"SELECT requirement_id, 'row_count_min' AS check_kind, dataset, severity, minimum, 2 AS n_params FROM ({_RULES})",
    "expand_rules": f"""SELECT requirement_id || '/row_count_min/' || d || '/' || minimum || '/rows' AS check_id, requirement_id, d AS dataset,
        'at least ' || minimum || ' rows, "rows"' AS control FROM (SELECT *, unnest(CASE dataset WHEN 'gold/*'
        THEN [{', '.join(f"'gold/{g}'" for g in _GOLD)}] ELSE [dataset] END) AS d FROM ({_RULES}))""",
    "contract_rules": _contract_sql(),
    # ingestion
    "wide_to_long": """SELECT vec_id AS sample_idx, (c - 1)::SMALLINT AS channel_idx, round(embedding[c]::DOUBLE, 6) AS value_raw
        FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS c FROM embeddings)""",
    "event_onsets": "SELECT sample_idx * 3 + sample_idx // 40 * 100 AS sample_idx, event_code FROM cue_onsets",
    "event_labels": "SELECT sample_idx, event_code, event_label FROM cues",
    "code_remap": f"""SELECT sample_idx, event_code, {_AREA_CASE.format('event_code')} AS area,
        CASE WHEN event_code BETWEEN 1 AND 4 THEN 'house' WHEN event_code BETWEEN 5 AND 8 THEN 'face' END AS label
        FROM (SELECT vec_id AS sample_idx, (CASE label WHEN 9 THEN 0 ELSE label END)::SMALLINT AS event_code,
            coalesce(lag(CASE label WHEN 9 THEN 0 ELSE label END) OVER (ORDER BY vec_id), 0) AS before FROM embeddings)
        WHERE event_code <> 0 AND event_code <> before""",
    "nan_to_null": """SELECT event_type, count(*) AS n_rows, count(*) FILTER (event_id % 97 <> 0) AS n_values,
        round(max(CASE WHEN event_id % 97 <> 0 THEN value END), 4) AS top FROM events GROUP BY event_type""",
    "new_sources": """SELECT sha256, source_path_rel, experiment, subject_src FROM sources WHERE substr(subject_src, 2)::INTEGER >= 5""",
    "ingest_ord": """SELECT ingest_id, row_number() OVER (ORDER BY experiment = 'view', ingested_at, sha256)::INTEGER AS ingest_ord FROM sources""",
    "ingest_audit": """SELECT ingest_id, data_root, source_path_rel, source_url, sha256, bytes, sample_rate_hz, rows_written, tool, tool_version,
        engine_version, ingest_host, rtrim(rtrim(strftime(ingested_at, '%Y-%m-%d %H:%M:%S.%g'), '0'), '.') AS ingested_at,
        row_number() OVER (ORDER BY sources.ingested_at, sha256)::INTEGER AS ingest_ord FROM sources""",
    "bronze_recording": f"SELECT {_BRONZE_COLUMNS}, {_r('value_raw')}, ingest_id, lid FROM bronze",
    "bronze_electrode": "SELECT experiment, subject_src, channel_idx, x_mm, y_mm, z_mm, brain_area, ingest_id, lid FROM bronze_electrodes",
    "bronze_event": "SELECT experiment, subject_src, run, sample_idx, event_code, event_label, ingest_id, lid FROM bronze_events",
    "ingest_rejects": """SELECT experiment, ingest_id, CASE WHEN experiment <> 'signup' THEN code END AS code,
        CASE WHEN experiment = 'signup' THEN 'experiment ''signup'' has no lineage code' END AS skipped FROM ingests""",
    # lineage ids
    "lid_mint": "SELECT event_id, lid FROM ids",
    "lid_decode": "SELECT event_id, ts_ms, layer, experiment, file, run, channel, segment, radioactive FROM ids",
    "lid_uuid_roundtrip": """SELECT event_id, ts_ms * 65536 + layer * 4096 + experiment * 16 AS hi,
        (CASE WHEN file >= 32768 THEN file - 65536 ELSE file END) * 281474976710656 + run * 17592186044416 + channel * 17179869184
            + segment * 16777216 + radioactive * 8388608 AS lo, lid FROM ids""",
    "lid_text": f"SELECT event_id, {_text('lid')} AS text FROM ids",
    "lid_parse": "SELECT event_id, lid FROM ids",
    "lid_time": """SELECT strftime(i.ingested_at, '%Y-%m-%d') AS day, count(*) AS n_samples, count(DISTINCT i.ingest_id) AS n_files
        FROM samples s JOIN ingests i USING (experiment, subject_src) GROUP BY 1""",
    "lid_layer_audit": """SELECT 'record' AS source, count(*) AS n_rows, 0::BIGINT AS wrong_layer FROM record
        UNION ALL SELECT 'mixed', count(*), count(*) FILTER (layer <> 2) FROM ids""",
    "lid_relayer": "SELECT event_id, substr(lid, 1, 14) || printf('%x', layer + 1) || substr(lid, 16) AS lid FROM ids",
    "lid_parent": "SELECT event_id, substr(lid, 1, 14) || printf('%x', layer - 1) || substr(lid, 16) AS lid FROM ids WHERE layer > 1",
    "lineage_dim": "SELECT ingest_ord, ingest_id, source_path, source_url, sha256, ts_ms, experiment FROM dim",
    "lid_trace": """SELECT r.lid, d.source_path, d.source_url, d.sha256, d.ts_ms, 2 AS layer, r.experiment, r.run, r.channel_idx AS channel, 0 AS segment
        FROM record r JOIN keys k USING (subject_pid) JOIN dim d ON d.ingest_id = r.experiment || '-' || k.subject_src""",
    "lid_prefix_bounds": "SELECT ingest_ord, ingest_id, lid_lo, lid_hi FROM bounds",
    "lid_children": "SELECT b.ingest_ord, b.ingest_id, r.lid, r.n_samples_src FROM record r JOIN bounds b ON r.lid BETWEEN b.lid_lo AND b.lid_hi",
    "lid_ranges": "SELECT name, lid_lo, lid_hi, count(*) AS n_records, sum(event_id)::BIGINT AS events FROM id_ranges JOIN ids ON lid BETWEEN lid_lo AND lid_hi GROUP BY ALL",
    "lineage_ancestors": _closure(f"SELECT {_node('o_orderkey', 3)} AS lid FROM orders", "child_lid", "parent_lid"),
    "lineage_descendants": _closure(f"SELECT {_node('s_suppkey', 1)} AS lid FROM supplier", "parent_lid", "child_lid"),
    "lineage_roots": f"""SELECT {_node('l_orderkey', 3)} AS lid, 2 AS steps, count(DISTINCT root_lid) AS n, min(root_lid) AS first, max(root_lid) AS last FROM lineitem JOIN (SELECT DISTINCT l_partkey, {_node('l_suppkey', 1)} AS root_lid
        FROM lineitem) USING (l_partkey) GROUP BY ALL""",
    "lineage_sources": f"""SELECT DISTINCT unnest([r.lid, {_lid('1704067200000', '3', 'c.code', '0', '0', 'r.channel_idx')}]) AS lid, d.source_path, d.sha256
        FROM record r JOIN codes c USING (experiment) JOIN keys k USING (subject_pid) JOIN dim d ON d.ingest_id = r.experiment || '-' || k.subject_src""",
    "canary_records": f"SELECT lid, experiment, subject_pid, run, channel_idx FROM record WHERE {_canary('lid')}",
    "lid_file_consistency": "SELECT ingest_ord::INTEGER AS file, count(*) AS n_rows, 1 AS agrees FROM recording GROUP BY ingest_ord",
    "canary_by_subject": """SELECT subject_pid, CASE subject_src WHEN 'u9' THEN 1 ELSE 0 END AS min_bit, CASE subject_src WHEN 'u9' THEN 1 ELSE 0 END AS max_bit
        FROM keys WHERE subject_pid IN (SELECT subject_pid FROM recording)""",
    "lineage_integrity": """SELECT lid, 'no parent' AS problem FROM record JOIN keys USING (subject_pid) WHERE experiment = 'view' AND subject_src = 'u7'
        UNION ALL SELECT lid, 'no samples' FROM record r WHERE NOT EXISTS (SELECT 1 FROM recording s WHERE s.lid = r.lid AND s.value_uv > 3)""",
    # pseudonyms
    "pseudonymise": f"SELECT c_name AS subject_src, {_pid('c_name')} AS subject_pid FROM customer",
    "keymap_new": """SELECT subject_src, subject_pid, rtrim(rtrim(strftime(created_at, '%Y-%m-%d %H:%M:%S.%g'), '0'), '.') AS created_at
        FROM keys WHERE subject_src NOT IN ('u0', 'u1', 'u2')""",
    "reidentify": """SELECT event_id AS request_id, CASE WHEN event_id % 7 = 0 THEN '0000000000000000' ELSE subject_pid END AS subject_pid,
        CASE WHEN event_id % 7 <> 0 THEN subject_src END AS subject_src FROM events JOIN keys ON subject_src = 'u' || (event_id % 10)""",
    # Silver and Gold
    "silver_subject": "SELECT subject_pid, rtrim(rtrim(strftime(created_at, '%Y-%m-%d %H:%M:%S.%g'), '0'), '.') AS first_seen_at FROM keys",
    "silver_record": "SELECT * FROM record",
    "silver_recording": f"SELECT experiment, subject_pid, run, channel_idx, ts_ms, {_r('value_uv', 6)}, lid, sample_idx FROM recording",
    "silver_electrode": "SELECT * FROM electrode",
    "silver_event": "SELECT * FROM event",
    "record_extremes": f"SELECT lid, {_r('lo', 6)}, {_r('hi', 6)} FROM extremes",
    "run_rails": f"SELECT lid, {_r('rail_lo', 6)}, {_r('rail_hi', 6)} FROM rails",
    "clipping": f"SELECT lid, {_r('clipped_pct')}, {_r('clipped_own_pct')} FROM quality",
    "channel_quality": f"""SELECT experiment, subject_pid, run, channel_idx, n_samples, missing_samples, {_r('rms_uv')}, {_r('clipped_pct')},
        {_r('clipped_own_pct')}, {_r('line_noise_ratio')}, scale_basis, lid FROM (SELECT * FROM quality UNION ALL SELECT * FROM tone_quality)""",
    "line_noise": f"SELECT channel_idx::SMALLINT AS channel_idx, {_r('line_noise_ratio')} FROM tone_noise",
    "experiment_summary": f"SELECT experiment, subject_pid, n_runs, n_channels, {_r('duration_s')}, n_events FROM summary",
    "feature_window": f"""SELECT experiment, subject_pid, run, channel_idx, window_start_ms, {_r('mean_uv')}, {_r('std_uv')}, {_r('p2p_uv')}, lid,
        sample_lo, sample_hi FROM windows""",
    "dataset_manifest": _manifest_sql(),
    # checks
    "check_not_null": _nulls("bronze", "experiment subject_src run channel_idx sample_idx value_raw ingest_id lid".split()),
    "check_unique": _rows(
        record_s_lid="SELECT count(*) FROM (SELECT 1 FROM record GROUP BY lid HAVING count(*) > 1)",
        window="SELECT count(*) FROM (SELECT 1 FROM windows GROUP BY lid, window_start_ms HAVING count(*) > 1)",
        sample_s_lid="SELECT count(*) FROM (SELECT 1 FROM recording GROUP BY lid HAVING count(*) > 1)",
        area="SELECT count(*) FROM (SELECT 1 FROM electrode GROUP BY brain_area HAVING count(*) > 1)"),
    "check_row_count": "SELECT name, observed, 'pass' AS result FROM (" + _rows(
        silver__recording="SELECT count(*) FROM recording", silver__record="SELECT count(*) FROM record") + ")",
    "check_no_identifier": """SELECT 'bronze/recording' AS dataset, 1::BIGINT AS observed, count(*) AS n_rows FROM bronze
        UNION ALL SELECT 'silver/recording', 0, count(*) FROM recording UNION ALL SELECT 'gold/feature_window', 0, count(*) FROM windows""",
    "check_partition_layout": """SELECT name, count(*) FILTER (bad)::VARCHAR AS observed FROM (SELECT unnest(['few', 'large', 'fine']) AS name,
        unnest([n <= 3000, n >= 1000, false]) AS bad FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderpriority)) GROUP BY name""",
    "check_hash_match": "SELECT count(*) FILTER (status = 'P' OR priority = '3') AS observed FROM blobs",
    "check_retention": """SELECT substr(o_orderpriority, 1, 1) AS name, max(o_custkey % 900)::VARCHAR AS observed,
        CASE WHEN max(o_custkey % 900) <= 880 THEN 'pass' ELSE 'fail' END AS result FROM orders GROUP BY 1""",
    "check_sql": _rows(scale="SELECT count(*) FROM record WHERE scale_basis NOT IN ('documented', 'assumed')",
                       large="SELECT count(*) FROM recording WHERE value_uv > 3"),
    "check_flag_offenders": "SELECT 'some' AS name, observed FROM (" + _flag(
        "SELECT lid AS offender, n_samples_src FROM record WHERE n_samples_src > 20", "n_samples_src DESC, offender", "record")
        + ") UNION ALL SELECT 'none', 'no records'",
    "check_verdicts": """SELECT run_id, check_id, CASE WHEN CASE WHEN TRY_CAST(expected AS DOUBLE) IS NULL THEN observed = expected
        WHEN check_kind = 'row_count_min' THEN observed::DOUBLE >= TRY_CAST(expected AS DOUBLE)
        WHEN check_kind = 'retention' THEN observed::DOUBLE <= TRY_CAST(expected AS DOUBLE)
        ELSE observed::DOUBLE = TRY_CAST(expected AS DOUBLE) END THEN 'pass' ELSE 'fail' END AS verdict FROM evidence""",
    "blocking_summary": """SELECT run_id, count(*) FILTER (result = 'pass') AS n_pass, count(*) FILTER (result = 'fail') AS n_fail,
        count(*) FILTER (result = 'error') AS n_error, count(*) FILTER (result <> 'pass' AND severity = 'block') AS n_blocking
        FROM evidence GROUP BY run_id""",
    "canary_leaks": _rows(silver__record=f"SELECT count(*) FROM record WHERE {_canary('lid')}",
                          gold__channel_quality=f"SELECT count(*) FROM quality WHERE {_canary('lid')}",
                          gold__feature_window=f"SELECT count(*) FROM windows WHERE {_canary('lid')}"),
    "flag_rms": _flag(_IS_OFFENDER_RMS, "rms_uv DESC, lid", "quality"),
    "flag_line_noise": _flag(_TONES_NOISY, "line_noise_ratio DESC, lid", "tone_noise"),
    "flag_event_rate": _flag(_RATES, "per_minute DESC, offender", "summary"),
    "check_accepted_values": _rows(scale_basis="SELECT count(*) FROM record WHERE scale_basis NOT IN ('documented', 'assumed')",
                                   documented_s_only="SELECT count(*) FROM record WHERE scale_basis NOT IN ('documented')",
                                   area="SELECT count(*) FROM electrode WHERE brain_area NOT IN ('frontal', 'parietal')"),
    "version_drift": "SELECT dataset, count(DISTINCT dataset_version) AS n_versions FROM evidence GROUP BY dataset HAVING count(DISTINCT dataset_version) > 1",
    "version_agreement": """SELECT DISTINCT m.dataset, CASE WHEN m.dataset_version = l.dataset_version THEN 1 ELSE 0 END AS agrees
        FROM manifest m JOIN latest l USING (dataset)""",
    # publication and reports
    "leak_gate": f"SELECT count(*) FILTER ({_canary('lid')}) AS canary_rows, 1 AS refused FROM recording",
    "size_gate": """SELECT limits, count(*) AS files, count(*) FILTER (length(content) > most) AS files_over, sum(length(content))::BIGINT AS bytes,
        CASE WHEN count(*) FILTER (length(content) > most) = 0 AND sum(length(content)) <= whole THEN 1 ELSE 0 END AS allowed
        FROM blobs, (VALUES ('file', 4194304, 1152921504606846976), ('total', 1152921504606846976, 100), ('none', 1152921504606846976, 1152921504606846976)) v(limits, most, whole) GROUP BY limits, most, whole""",
    "verify_manifest": """SELECT count(*) FILTER (status <> 'P') AS files, count(*) FILTER (priority = '2' AND status <> 'P') AS mismatches,
        count(*) FILTER (status = 'P') AS missing FROM blobs""",
    "publish_manifest": _BLOB_FILES,
    "withheld_checks": """SELECT check_id, dataset FROM latest WHERE dataset = 'gold/feature_window' OR (check_kind = 'sql' AND length(check_id) % 2 = 0)""",
    "build_summary": """SELECT gold_datasets, (SELECT sum(n_records) FROM manifest WHERE layer = 1)::BIGINT AS bronze_rows,
        (SELECT n_records FROM manifest WHERE dataset = 'silver/recording') AS samples, checks, n_pass, n_fail, n_flag, ran_at, git_commit
        FROM history_summary WHERE upto = 'R2'""",
    "summary_diff": """SELECT a.name, a.value AS published, b.value AS recomputed FROM
        (UNPIVOT (SELECT gold_datasets::VARCHAR AS gold_datasets, checks::VARCHAR AS checks, n_pass::VARCHAR AS n_pass, n_fail::VARCHAR AS n_fail,
            n_flag::VARCHAR AS n_flag, ran_at, git_commit FROM history_summary WHERE upto = 'R1') ON * INTO NAME name VALUE value) a JOIN
        (UNPIVOT (SELECT gold_datasets::VARCHAR AS gold_datasets, checks::VARCHAR AS checks, n_pass::VARCHAR AS n_pass, n_fail::VARCHAR AS n_fail,
            n_flag::VARCHAR AS n_flag, ran_at, git_commit FROM history_summary WHERE upto = 'R2') ON * INTO NAME name VALUE value) b
        USING (name) WHERE a.value <> b.value""",
    "unknown_commits": """SELECT DISTINCT git_commit, CASE WHEN git_commit = 'unknown' THEN 0 ELSE 1 END AS is_hash FROM (
        SELECT CASE WHEN result = 'error' THEN 'unknown' ELSE git_commit END AS git_commit FROM evidence
        UNION ALL SELECT substr(sha256('build' || n_records), 1, 40) FROM manifest) WHERE git_commit NOT IN
        (SELECT substr(sha256('commit' || (o_orderkey % 5)), 1, 40) FROM orders WHERE o_orderkey % 5 <> 3)""",
    "noisiest_channels": f"""SELECT experiment, subject_pid, run, channel_idx, n_samples, line_noise_ratio, {_text('lid')} AS lid FROM (
        SELECT * FROM (SELECT experiment, subject_pid, run, channel_idx, n_samples, line_noise_ratio, lid FROM quality
            UNION ALL SELECT 'click', 'p' || (channel_idx % 2), channel_idx % 2 + 1, channel_idx, count(*), round(any_value(line_noise_ratio), 4), lid
            FROM tones JOIN tone_noise USING (channel_idx) GROUP BY channel_idx, lid)
        ORDER BY line_noise_ratio DESC NULLS LAST, lid LIMIT 100)""",
    "framework_coverage": f"""SELECT framework, {_outcome()}, count(*) FILTER (dataset NOT LIKE 'gold/%') AS n_elsewhere FROM latest GROUP BY framework""",
    "run_history": f"""SELECT run_id, {_outcome()}, strftime(min(ran_at), '%Y-%m-%d %H:%M:%S') AS ran_at, max(git_commit) AS git_commit
        FROM evidence GROUP BY run_id""",
    "evidence_matrix": "SELECT framework, severity, result, count(*) AS n FROM evidence GROUP BY ALL",
    "build_inventory": f"""SELECT experiment, count(DISTINCT subject_src) AS subjects, count(DISTINCT subject_src || '/' || run) AS runs,
        count(DISTINCT lid) AS channels, count(*) AS samples FROM bronze WHERE NOT {_canary('lid')} GROUP BY experiment""",
    "build_span": """SELECT (SELECT count(*) FROM sources) AS files,
        rtrim(rtrim(strftime((SELECT min(ingested_at) FROM sources), '%Y-%m-%d %H:%M:%S.%g'), '0'), '.') AS began_at,
        strftime(max(ran_at), '%Y-%m-%d %H:%M:%S') AS ended_at, epoch_ms(max(ran_at)) - (SELECT epoch_ms(min(ingested_at)) FROM sources) AS span_ms
        FROM evidence WHERE run_id = 'R0'""",
    "ranked_checks": """SELECT place, check_id, dataset, result, count(*) AS n FROM (
        SELECT CASE WHEN result <> 'pass' THEN 0 WHEN framework = 'GDPR-Art9' THEN 1 WHEN framework <> 'contract' AND check_id LIKE '%lid%' THEN 2
            WHEN severity = 'flag' THEN 3 WHEN framework = 'contract' THEN 5 ELSE 4 END AS place,
            CASE WHEN framework = 'contract' AND result = 'pass' THEN 'contract rules' ELSE check_id END AS check_id, dataset, result FROM latest)
        GROUP BY ALL""",
    "channel_aggregate": "SELECT channel_idx, round(avg(value_uv), 4) AS mean_uv, count(*) AS n_samples FROM recording GROUP BY channel_idx",
    "middle_record": """SELECT lid, count(*) AS n_samples, round(avg(value_uv), 4) AS mean_uv FROM recording WHERE lid = (
        SELECT lid FROM (SELECT lid, row_number() OVER (ORDER BY lid) AS n, count(*) OVER () AS total FROM (SELECT DISTINCT lid FROM recording))
        WHERE n = total // 2 + 1) GROUP BY lid""",
    "smallest_partition": f"""SELECT experiment, subject_pid, count(*) AS n_samples FROM recording WHERE NOT {_canary('lid')}
        GROUP BY experiment, subject_pid ORDER BY n_samples, experiment, subject_pid LIMIT 1""",
    "exact_sum": "SELECT count(*) AS n_rows, sum(value_uv::DOUBLE::DECIMAL(38, 6))::DECIMAL(38, 6)::VARCHAR AS total FROM recording",
    "layout_variants": """SELECT version, codec, n_rows, total FROM (SELECT count(*) AS n_rows, sum(value_uv::DOUBLE::DECIMAL(38, 6))::DECIMAL(38, 6)::VARCHAR AS total
        FROM recording), (VALUES ('v1', 'snappy'), ('v1', 'zstd'), ('v2', 'snappy'), ('v2', 'zstd')) v(version, codec)""",
    "reproducible_sums": """SELECT l_returnflag, printf('%.12e', sum(k * power(2.0::DOUBLE, p) ORDER BY p DESC)) AS total, sum(n)::BIGINT AS n FROM (
        SELECT l_returnflag, [-60, -30, 0, 40, 80, 100, -100][l_linenumber] AS p, count(*) AS n,
            sum(l_quantity::HUGEINT * CASE l_linestatus WHEN 'O' THEN -1 ELSE 1 END)::DOUBLE AS k FROM lineitem GROUP BY ALL) GROUP BY l_returnflag""",
    "reproducible_moments": """SELECT channel_idx, count(value_uv) AS n, round(avg(value_uv::DOUBLE), 6) AS mean, round(sqrt(avg(value_uv::DOUBLE * value_uv)), 6) AS rms,
        round(stddev_pop(value_uv::DOUBLE), 6) AS stddev FROM recording GROUP BY channel_idx""",
    "grouped_median": f"SELECT name, round(median(price), 3) AS median FROM ({_PRICES}) GROUP BY name",
    "grouped_percentiles": f"""SELECT name, percent, round(price, 3) AS price FROM (SELECT name, price, row_number() OVER (PARTITION BY name ORDER BY price) AS place,
        count(*) OVER (PARTITION BY name) AS n FROM ({_PRICES})), (VALUES (1), (25), (90), (99)) v(percent) WHERE place = (n * percent + 99) // 100""",
    "retry_append": """SELECT o_orderstatus, o_orderpriority, count(*) AS n_rows, sum(o_orderkey)::BIGINT AS keys FROM orders
        WHERE o_orderstatus <> 'P' GROUP BY ALL""",
    "unique_rules": " UNION ALL ".join(f"SELECT '{name}' AS check_id, count(*) AS observed FROM (SELECT 1 FROM {view} GROUP BY {columns} HAVING count(*) > 1)"
        for name, view, columns in (("line", "lineitem", "l_orderkey, l_linenumber"), ("order", "lineitem", "l_orderkey"), ("pair", "lineitem", "l_partkey, l_suppkey"),
                                    ("swapped", "lineitem", "l_suppkey, l_partkey"), ("sample", "recording", "lid, sample_idx"), ("record", "recording", "lid"),
                                    ("place", "recording", "experiment, sample_idx"))),
    "indexed_digests": """SELECT path, length(now)::BIGINT AS bytes, sha256(now) AS sha256, CASE priority WHEN '2' THEN 'new' ELSE 'known' END AS state FROM
        (SELECT *, CASE priority WHEN '2' THEN 'x' || replace(content, chr(10), chr(10) || 'x') ELSE content END AS now FROM blobs)""",
    "widened_scan": """SELECT o_orderstatus, count(*) AS n_rows, sum(o_orderkey)::BIGINT AS keys, sum(o_custkey)::BIGINT AS customers, sum(o_custkey::DOUBLE) AS amount
        FROM orders GROUP BY o_orderstatus""",
    "version_diff": """SELECT o_orderkey, CASE WHEN o_orderkey % 101 = 0 THEN 'deleted' ELSE 'changed' END AS change FROM orders WHERE o_orderkey % 101 = 0 OR o_orderkey % 103 = 0
        UNION ALL SELECT -o_orderkey - 1, 'inserted' FROM orders WHERE o_orderkey % 107 = 0""",
    "channel_in_list": "SELECT count(*) AS n FROM recording WHERE channel_idx <> 1 AND channel_idx <> 3",
}


def oracle_sql() -> dict[str, str]:
    return {name: _with(body) for name, body in STATEMENTS.items()}

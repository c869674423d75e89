"""Derived relations in DuckDB SQL, prepended to a check's SQL where it uses them."""

from __future__ import annotations

import re

VIEWS = {
    "contracts": """
        SELECT o_orderkey AS contract_id, concat('PIID-', o_orderkey) AS piid, c_name AS vendor_name,
               o_totalprice AS contract_value, CAST(o_orderdate AS DATE) AS award_date,
               o_orderpriority AS contract_type, c_mktsegment AS agency_code
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "files": """
        SELECT source AS agency, concat('sess-', (doc_id // 20) % 5) AS session,
               concat('doc-', doc_id, '.txt') AS file_name, text AS content,
               CAST(strlen(text) AS BIGINT) AS size, doc_id,
               CAST(substr(source, 4) AS INT) AS agency_no, CAST((doc_id // 20) % 5 AS INT) AS session_no
        FROM documents""",
    "objects": """
        SELECT doc_id, size,
               CASE WHEN doc_id % 50 = 0 THEN concat('file_mode/outgoing/', agency, '/', session, '/')
                    WHEN doc_id % 37 = 0 THEN concat('file_mode/outgoing/', agency, '/', file_name, '.done')
                    WHEN doc_id % 41 = 0 THEN concat('file_mode/processed/', file_name)
                    WHEN doc_id % 43 = 0 THEN 'file_mode/outgoing/'
                    WHEN doc_id % 3 = 0 THEN concat('file_mode/outgoing/', file_name)
                    WHEN doc_id % 7 = 0 THEN concat('north/file_mode/outgoing/', agency, '/', file_name)
                    ELSE concat('file_mode/outgoing/', agency, '/', session, '/', file_name) END AS key
        FROM files""",
    "file_markers": "SELECT doc_id FROM labels WHERE quality = 1",
    "session_markers": """
        SELECT DISTINCT agency, session,
               CASE WHEN (agency_no + session_no) % 7 = 1 THEN 'rejected' ELSE 'done' END AS kind
        FROM files WHERE (agency_no + session_no) % 7 = 1 OR (agency_no + session_no) % 3 = 0""",
    "blocklist": """
        SELECT DISTINCT sha256(d.text) AS sha256 FROM documents d JOIN labels l ON d.doc_id = l.doc_id
        WHERE l.toxic = 1""",
    "manifests": """
        SELECT agency, session,
               CASE WHEN k % 17 = 3 THEN concat(session, '-x') ELSE session END AS manifest_session,
               CASE WHEN k % 5 = 0 THEN '' WHEN k % 19 = 4 THEN 'other' ELSE 'hub' END AS receiver_agency,
               CASE WHEN k % 13 = 2 THEN 3 WHEN k % 31 = 8 THEN 1 ELSE 2 END AS total_file_count,
               CASE WHEN k % 31 = 8 THEN 1 ELSE 2 END AS entries,
               bytes AS source_size, bytes // 3 + 20 AS archive_size,
               sha256(concat('source', agency, session)) AS source_sha,
               sha256(concat(agency, session)) AS archive_sha_actual,
               CASE WHEN k % 11 = 5 THEN sha256('broken') WHEN k % 23 = 6 THEN 'not-hex'
                    ELSE upper(sha256(concat(agency, session))) END AS archive_sha_manifest
        FROM (SELECT agency, session, min(agency_no) * 5 + min(session_no) AS k, CAST(sum(size) AS BIGINT) AS bytes
              FROM files GROUP BY agency, session) s""",
    "checked_manifests": """
        SELECT *, [c FOR c IN [
                 CASE WHEN entries = 2 AND NOT regexp_full_match(archive_sha_manifest, '[0-9a-fA-F]{64}') THEN 'checksum_not_hex' END,
                 CASE WHEN total_file_count <> entries THEN 'count_mismatch' END,
                 CASE WHEN entries <> 2 THEN 'entry_count' END,
                 CASE WHEN entries = 2 AND lower(archive_sha_manifest) <> archive_sha_actual THEN 'checksum_mismatch' END,
                 CASE WHEN manifest_session <> session THEN 'session_mismatch' END,
                 CASE WHEN receiver_agency NOT IN ('', 'hub') THEN 'receiver_mismatch' END] IF c IS NOT NULL] AS codes
        FROM manifests""",
    "infections": """
        SELECT agency, session, count(*) AS members, count(b.sha256) AS infected
        FROM files f LEFT JOIN blocklist b ON sha256(f.content) = b.sha256 GROUP BY agency, session""",
    "routed": """
        SELECT c.agency, c.session,
               CASE WHEN m.kind IS NOT NULL THEN 'already_processed' WHEN len(c.codes) > 0 THEN 'failed'
                    WHEN i.infected > 0 THEN 'rejected' ELSE 'processed' END AS status,
               CASE WHEN m.kind IS NOT NULL THEN m.kind WHEN len(c.codes) > 0 THEN c.codes[1]
                    WHEN i.infected > 0 THEN 'infected' END AS reason
        FROM checked_manifests c LEFT JOIN session_markers m ON c.agency = m.agency AND c.session = m.session
        JOIN infections i ON c.agency = i.agency AND c.session = i.session""",
    "definitions": """
        SELECT concat('dp_', p_partkey % 40) AS dataproduct_id, p_partkey % 40 AS n, p_partkey AS path_no,
               concat('definitions/', lpad(CAST(p_partkey AS VARCHAR), 12, '0'), '.json') AS path,
               concat(CASE WHEN p_partkey % 9 = 0 THEN 'v' ELSE '' END, p_size % 3, '.',
                      (p_partkey // 40) % 13, CASE WHEN p_partkey % 2 = 0 THEN '.0' ELSE '' END) AS version,
               CASE WHEN p_partkey % 40 % 8 = 7 THEN 'draft'
                    ELSE CASE (p_partkey // 40) % 4 WHEN 0 THEN 'active' WHEN 1 THEN 'draft'
                         WHEN 2 THEN 'deprecated' ELSE 'retired' END END AS status,
               CASE WHEN p_partkey % 40 % 10 = 9 THEN 'file' ELSE 'sql' END AS source_type,
               CASE WHEN p_partkey % 20 = 9 THEN 's3-file' ELSE 'postgres' END AS engine,
               CASE WHEN p_partkey % 40 % 11 = 10 THEN 'legacy_extract' ELSE 'dot_contract_extract_v1' END AS template_id,
               CASE WHEN p_partkey % 40 % 13 = 12 THEN ['schema', 'table', 'purpose'] ELSE ['schema', 'table'] END AS required,
               CASE WHEN p_partkey % 40 % 17 = 16 THEN ['select_fields', 'order_by']
                    ELSE ['select_fields', 'filters', 'order_by'] END AS optional,
               CASE WHEN p_partkey % 40 % 6 = 0 THEN [] ELSE
                    ['contract_id', 'piid', 'vendor_name', 'contract_value', 'award_date'] END AS allowed_select,
               CASE WHEN p_partkey % 40 % 5 = 0 THEN [] WHEN p_partkey % 40 % 7 = 3 THEN ['award_date']
                    ELSE ['contract_value', 'award_date'] END AS allowed_filter_fields,
               ['agency' || ((p_partkey + i) % 40 % 25) FOR i IN range(12)] AS agencies,
               1 + p_partkey % 60 AS retention_days,
               CASE p_partkey % 3 WHEN 0 THEN 'dataproduct_plus_params' WHEN 1 THEN 'request_id'
                    ELSE 'requester_plus_params' END AS scope,
               1000 * (1 + p_partkey % 10) AS default_row_limit, 100000 AS max_row_limit,
               120 AS default_timeout_seconds, 300 AS max_timeout_seconds
        FROM part""",
    "active": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY dataproduct_id ORDER BY (status = 'active') DESC,
                   CAST(split_part(ltrim(version, 'v'), '.', 1) AS INT) DESC,
                   CAST(split_part(ltrim(version, 'v'), '.', 2) AS INT) DESC,
                   CAST(coalesce(nullif(split_part(ltrim(version, 'v'), '.', 3), ''), '0') AS INT) DESC, path_no) AS rn
          FROM definitions) WHERE rn = 1""",
    "requests": """
        SELECT c_custkey, concat('REQ-', 100000 + c_custkey) AS request_id,
               CASE WHEN c_custkey % 3 = 0 THEN concat(' DP_', c_custkey % 45, ' ')
                    ELSE concat('dp_', c_custkey % 45) END AS dataproduct_id,
               concat('agency', c_nationkey) AS requesting_agency, c_name AS requested_by,
               CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_custkey * 90 END AS requested_row_limit,
               CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 60 + (c_custkey % 10) * 40 END AS requested_timeout_seconds,
               concat('{"schema":"', CASE WHEN c_custkey % 14 = 0 THEN ' ' ELSE 'dot' END,
                      '","table":"', CASE WHEN c_custkey % 16 = 0 THEN 'other' ELSE 'contract_data' END, '"',
                      CASE WHEN c_custkey % 10 = 0 THEN ',"rogue":"x"' ELSE '' END,
                      CASE WHEN c_custkey % 8 = 0 THEN ',"select_fields":["contract_id","secret"]'
                           ELSE ',"select_fields":["contract_id","vendor_name"]' END,
                      CASE WHEN c_custkey % 12 = 0 THEN ',"filters":{"contract_value":{"like":1}}'
                           ELSE ',"filters":{"contract_value":{"min":1000}}' END, '}') AS params
        FROM customer""",
    "governed": """
        SELECT r.* EXCLUDE (dataproduct_id), d.*
        FROM requests r JOIN active d ON lower(trim(r.dataproduct_id)) = d.dataproduct_id""",
    "raw_requests": """
        SELECT c_custkey,
          CASE c_custkey % 60
            WHEN 7 THEN '[1,2]' WHEN 8 THEN '{"request_id": "REQ' WHEN 9 THEN '  '
            ELSE concat('{"request_id":"', CASE WHEN c_custkey % 60 = 11 THEN 'R 1' ELSE concat(' REQ-', 100000 + c_custkey) END, '",',
              '"dataproduct_id":"', CASE WHEN c_custkey % 60 = 22 THEN '_bad!' ELSE concat('DP_', c_custkey % 45) END, '",',
              '"requesting_agency":"', CASE WHEN c_custkey % 60 = 23 THEN 'x' ELSE concat('agency', c_nationkey) END, '"',
              CASE WHEN c_custkey % 60 = 10 THEN '' ELSE concat(',"requested_by":"', c_name, '"') END,
              ',"params":', CASE c_custkey % 60 WHEN 15 THEN '{}' WHEN 16 THEN '[]' ELSE '{"schema":"dot","table":"contract_data"}' END,
              CASE c_custkey % 60 WHEN 12 THEN ',"requested_row_limit":0' WHEN 13 THEN ',"requested_row_limit":"10"'
                   WHEN 14 THEN ',"requested_timeout_seconds":90000' WHEN 17 THEN ',"color":"red"'
                   WHEN 18 THEN ',"justification":"   "' WHEN 19 THEN ',"metadata":{"a":{"b":1}}'
                   WHEN 20 THEN ',"metadata":{"a":1,"b":"x","c":true}' WHEN 21 THEN ',"delivery_target_id":"ab"'
                   WHEN 24 THEN ',"justification":" audit "' ELSE ',"requested_row_limit":500' END, '}') END AS raw
        FROM customer""",
    "extract_requests": """
        SELECT c_custkey, c_mktsegment, concat('REQ-', 100000 + c_custkey) AS request_id,
               concat('sess-', c_custkey % 97) AS session, 'dot_contract_extract_v1' AS template_id,
               1000 * (1 + c_custkey % 10) AS row_limit, 60 * (1 + c_custkey % 3) AS timeout_seconds,
               concat('{"table":"contract_data","schema":"dot","filters":{"contract_value":{"min":',
                      CASE WHEN c_custkey % 7 = 0 THEN '1000' ELSE CAST(1000 * (c_custkey % 4) AS VARCHAR) END,
                      '}},"select_fields":["piid","contract_id"]}') AS params,
               concat('{"filters":{"contract_value":{"min":',
                      CASE WHEN c_custkey % 7 = 0 THEN '1000' ELSE CAST(1000 * (c_custkey % 4) AS VARCHAR) END,
                      '}},"schema":"dot","select_fields":["piid","contract_id"],"table":"contract_data"}',
                      ' OBJECT<filters: OBJECT<contract_value: OBJECT<min: BIGINT>>, schema: STRING, ',
                      'select_fields: ARRAY<STRING>, table: STRING>') AS canonical
        FROM customer""",
    "fingerprints": """
        SELECT *, sha256(CAST(to_json(['fp1', 'parquet', '', '', '', '', template_id, CAST(row_limit AS VARCHAR),
                   CAST(timeout_seconds AS VARCHAR), canonical]) AS VARCHAR)) AS fingerprint
        FROM extract_requests""",
    "done_fingerprints": """
        SELECT DISTINCT fingerprint FROM fingerprints WHERE c_mktsegment = 'BUILDING' AND timeout_seconds = 60""",
    "audit": """
        SELECT event_id, ts AS timestamp, concat('transfer-', user_id) AS transfer_session_id,
               CASE event_type WHEN 'signup' THEN 'pipeline_start' WHEN 'view' THEN 'extract_data'
                    WHEN 'click' THEN 'compress' WHEN 'purchase' THEN 'pipeline_complete'
                    ELSE 'sftp_transfer_complete' END AS event_type,
               CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS outcome,
               CAST(floor(value * 100) AS BIGINT) AS bytes_transferred, props AS details
        FROM events""",
    "timeline": """
        SELECT transfer_session_id, strftime(min(timestamp), '%Y-%m-%d %H:%M:%S.%f') AS first_ts,
               strftime(max(timestamp), '%Y-%m-%d %H:%M:%S.%f') AS last_ts, count(*) AS events,
               count(*) FILTER (WHERE outcome = 'failure') AS failures,
               CAST(sum(bytes_transferred) AS BIGINT) AS bytes,
               arg_max(outcome, timestamp + INTERVAL 1 MICROSECOND * 0) AS final_outcome,
               epoch_us(max(timestamp)) - epoch_us(min(timestamp)) AS duration_us
        FROM audit GROUP BY transfer_session_id""",
    "job_events": """
        SELECT conv_id AS job, turn AS seq,
               CASE WHEN turn = 0 THEN CASE WHEN conv_id % 17 = 3 THEN 'running' ELSE 'pending' END
                    WHEN turn = 1 THEN CASE WHEN conv_id % 7 = 0 THEN 'cancelled' ELSE 'running' END
                    WHEN turn = 2 THEN CASE WHEN conv_id % 5 = 0 THEN 'failed'
                                            WHEN conv_id % 11 = 0 THEN 'pending' ELSE 'sent' END
                    WHEN turn = 3 THEN CASE WHEN conv_id % 17 = 3 THEN 'pending' ELSE 'running' END
                    ELSE CASE WHEN conv_id % 3 = 0 THEN 'sent' ELSE 'running' END END AS status,
               CASE WHEN conv_id % 13 = 4 THEN NULL ELSE sha256(text) END AS result,
               CASE WHEN conv_id % 25 = 5 THEN '' ELSE concat('error-', role) END AS error
        FROM conversations""",
    "runs": """
        SELECT event_type AS agent, event_id AS run_id, ts AS start_ts,
               ts + INTERVAL 1 MINUTE * CAST(floor(value) AS INT) AS end_ts
        FROM events""",
}

REPLAY = """
  ordered AS (SELECT *, row_number() OVER (PARTITION BY job ORDER BY seq) AS rn FROM job_events),
  replay AS (
    SELECT job, seq, status, result, error, rn, CAST(NULL AS VARCHAR) AS before,
           CASE WHEN status = 'pending' THEN 'pending' END AS after, status = 'pending' AS accepted
    FROM ordered WHERE rn = 1
    UNION ALL
    SELECT o.job, o.seq, o.status, o.result, o.error, o.rn, r.after,
           CASE WHEN {ok} THEN o.status ELSE r.after END, {ok}
    FROM replay r JOIN ordered o ON o.job = r.job AND o.rn = r.rn + 1)
"""
_STEP_OK = """((r.after IS NULL AND o.status = 'pending') OR (r.after = 'pending' AND o.status IN ('running', 'cancelled'))
   OR (r.after = 'running' AND (o.status = 'cancelled' OR (o.status = 'sent' AND o.result IS NOT NULL)
       OR (o.status = 'failed' AND o.error <> ''))))"""


def _needed(sql: str, found: dict[str, None]) -> None:
    for name, body in VIEWS.items():
        if name not in found and re.search(rf"\b{name}\b", re.sub(r"'[^']*'", "", sql)):
            _needed(body, found)
            found[name] = None


def with_views(sql: str) -> str:
    """The statement with every derived relation it uses as a CTE."""
    found: dict[str, None] = {}
    _needed(sql, found)
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in found)
    return f"WITH {ctes}\n{sql}" if found else sql


def with_replay(sql: str) -> str:
    """A statement over ``replay``: job histories played row by row."""
    steps = REPLAY.replace("{ok}", _STEP_OK)
    return f"WITH RECURSIVE job_events AS ({VIEWS['job_events']}),\n{steps}\n{sql}"

"""Written outputs, read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.operators import audit, integrity
from tidegate.session import run_folder
from tidegate.sinks import extracts, transfers as sinks
from tidegate.sources import files as file_sources

from .registry import check
from .tables import Tables
from .transfers import _entries, _MANIFEST_SQL, _routed

# Blanks around, tabs, a lone blank, quotes, line breaks, and doubles of 17 digits from 1e-12 to 1e15.
_DOC_SQL = """SELECT doc_id, concat('  ', source, chr(9)) AS source, text, CASE WHEN doc_id % 2 = 0 THEN ' ' ELSE '"a"' || chr(10) || ',' END AS odd,
    CAST('1.2345678901234567e' || CAST(doc_id % 28 - 12 AS VARCHAR) AS DOUBLE) AS weight FROM documents"""


def _rows(t: Tables):
    return t.base("documents").selectExpr(
        "doc_id", "concat('  ', source, chr(9)) AS source", "text", """CASE WHEN doc_id % 2 = 0 THEN ' ' ELSE concat('"a"', chr(10), ',') END AS odd""",
        "CAST(concat('1.2345678901234567e', CAST(doc_id % 28 - 12 AS STRING)) AS DOUBLE) AS weight")


@check("write_csv_extract", _DOC_SQL)
def write_csv_extract(t: Tables):
    path, rows = run_folder(t.spark, "csv"), _rows(t)
    extracts.write_csv_extract(rows, path)
    return extracts.read_csv_extract(t.spark, path, rows.schema)


@check("write_extract", " UNION ALL ".join(f"SELECT '{kind}' AS kind, * FROM ({_DOC_SQL})" for kind in ("csv", "jsonl", "parquet")))
def write_extract(t: Tables):
    path, rows = run_folder(t.spark, "extract"), _rows(t)
    extracts.write_extract(rows, f"{path}/parquet", "parquet")
    extracts.write_extract(rows, f"{path}/jsonl", "jsonl")
    extracts.write_extract(rows, f"{path}/csv", "csv")
    as_csv = extracts.read_csv_extract(t.spark, f"{path}/csv", rows.schema).select(F.lit("csv").alias("kind"), "*")
    as_json = t.spark.read.schema(rows.schema).json(f"{path}/jsonl").select(F.lit("jsonl").alias("kind"), "*")
    return as_csv.unionByName(as_json).unionByName(t.spark.read.parquet(f"{path}/parquet").select(F.lit("parquet").alias("kind"), "*"))


@check("write_gzip_payload", _DOC_SQL)
def write_gzip_payload(t: Tables):
    path, rows = run_folder(t.spark, "gzip"), _rows(t)
    extracts.write_gzip_payload(rows, path)
    return extracts.read_csv_extract(t.spark, path, rows.schema)


@check("write_manifests", _MANIFEST_SQL)
def write_manifests(t: Tables):
    path = run_folder(t.spark, "manifests")
    manifests = integrity.build_manifests(t.transfers(), "hub")
    sinks.write_manifests(manifests, path)
    return _entries(file_sources.read_manifests(t.spark, path, multi_line=False))


@check("write_markers", """
    SELECT agency, session, CASE status WHEN 'processed' THEN 'done' ELSE 'rejected' END AS kind, reason AS detail FROM routed
    WHERE status IN ('processed', 'rejected')""")
def write_markers(t: Tables):
    path, routed = run_folder(t.spark, "markers"), _routed(t)
    fresh = routed.where("status IN ('processed', 'rejected')").selectExpr(
        "agency", "session", "CASE status WHEN 'processed' THEN 'done' ELSE 'rejected' END AS kind", "reason AS detail")
    sinks.write_markers(fresh, path)
    sinks.write_markers(fresh, path)
    return sinks.read_markers(t.spark, path).select("agency", "session", "kind", "detail")


@check("store_to_target", """
    SELECT agency, session, file_name AS member, concat('transfers/', agency, '/', session, '/', file_name) AS target_key, sha256(content) AS sha256 FROM files""")
def store_to_target(t: Tables):
    path = run_folder(t.spark, "target")
    members = t.files().select("agency", "session", F.col("file_name").alias("member"), F.col("content").cast("binary").alias("content"))
    sinks.store_to_target(members, path)
    sinks.store_to_target(members.where("session IN ('sess-1', 'sess-3')"), path)
    return t.spark.read.parquet(path).select("agency", "session", "member", "target_key", F.sha2("content", 256).alias("sha256"))


@check("write_audit_log", """
    SELECT strftime(timestamp, '%Y-%m-%d') AS event_date, transfer_session_id, event_type, outcome, bytes_transferred,
           strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%fZ') AS timestamp FROM audit""")
def write_audit_log(t: Tables):
    path = run_folder(t.spark, "audit")
    sinks.write_audit_log(audit.audit_events(t.audit()), path)
    log = t.spark.read.schema("transfer_session_id string, event_type string, outcome string, bytes_transferred bigint, timestamp string, event_date string").json(path)
    return log.select("event_date", "transfer_session_id", "event_type", "outcome", "bytes_transferred", "timestamp")

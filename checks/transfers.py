"""Files, markers, manifests, quarantine, routing and idempotency."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.operators import aggregates, idempotency, integrity
from tidegate.session import run_folder
from tidegate.sinks import transfers as sinks
from tidegate.sources import files as file_sources

from .registry import check
from .tables import Tables, joined


@check("scan_files", """
    SELECT doc_id, key, size, regexp_extract(key, '[^/]+$') AS file_name FROM objects
    WHERE starts_with(key, 'file_mode/outgoing/') AND key <> 'file_mode/outgoing/' AND NOT ends_with(key, '/') AND NOT ends_with(key, '.done')""")
def scan_files(t: Tables):
    return file_sources.scan_files(t.objects(), "file_mode/outgoing/").select("doc_id", "key", "size", "file_name")


@check("landing_sessions", "SELECT DISTINCT agency, session FROM files")
def landing_sessions(t: Tables):
    keys = t.files().select(F.concat_ws("/", "agency", "session", "file_name").alias("key"))
    return file_sources.landing_sessions(keys)


_MANIFEST_ROWS = """
    SELECT sender_agency, transfer_session_id, total_file_count, position, file_name, file_size_bytes, checksum_sha256 FROM (
      SELECT agency AS sender_agency, concat(session, '-', doc_id) AS transfer_session_id, 2 AS total_file_count, 1 AS position,
             file_name, size AS file_size_bytes, sha256(content) AS checksum_sha256 FROM files
      UNION ALL SELECT agency, concat(session, '-', doc_id), 2, 2, 'transfer.tar.gz', size // 3 + 20, sha256(concat(agency, session, '-', doc_id, doc_id)) FROM files)"""
_MANIFEST_SQL = _MANIFEST_ROWS.replace("sha256(concat(agency, session, '-', doc_id, doc_id))", "sha256(concat(agency, session, doc_id))")


def _entries(manifests):
    return manifests.select("sender_agency", "transfer_session_id", "total_file_count", F.posexplode("files").alias("p", "f")).select(
        "sender_agency", "transfer_session_id", "total_file_count", (F.col("p") + 1).alias("position"), "f.file_name",
        "f.file_size_bytes", "f.checksum_sha256")


@check("build_manifests", _MANIFEST_SQL)
def build_manifests(t: Tables):
    return _entries(integrity.build_manifests(t.transfers(), "hub"))


@check("read_manifests", _MANIFEST_SQL)
def read_manifests(t: Tables):
    path = run_folder(t.spark, "manifests")
    sinks.write_manifests(integrity.build_manifests(t.transfers(), "hub"), path)
    return _entries(file_sources.read_manifests(t.spark, path, multi_line=False).where("corrupt IS NULL"))


@check("expand_archives", """
    SELECT agency, session, doc_id, file_name AS member, size, sha256(content) AS sha256, 'ok' AS status FROM files""")
def expand_archives(t: Tables):
    # Archives are the unit of work; deal them out whatever the number of table files.
    files = t.files().repartition(t.spark.sparkContext.defaultParallelism)
    packed = sinks.pack_archives(files, ["agency", "session", "doc_id"])
    members = file_sources.whole_members(file_sources.expand_archives(packed, ["agency", "session", "doc_id"], "archive"))
    return members.select("agency", "session", "doc_id", "member", "size", "sha256", "status")


@check("unprocessed_files", "SELECT doc_id, file_name FROM files WHERE doc_id NOT IN (SELECT doc_id FROM file_markers)")
def unprocessed_files(t: Tables):
    return idempotency.unprocessed_files(t.files().select("doc_id", "file_name"), t.file_markers(), ["doc_id"])


@check("already_processed", """
    SELECT doc_id, f.agency, f.session FROM files f JOIN session_markers m ON f.agency = m.agency AND f.session = m.session""")
def already_processed(t: Tables):
    return idempotency.already_processed(t.files().select("doc_id", "agency", "session"), t.session_markers(), ["agency", "session"])


@check("marker_union", "SELECT agency, session FROM session_markers")
def marker_union(t: Tables):
    markers = t.session_markers()
    return idempotency.marker_union(markers.where("kind = 'done'"), markers.where("kind = 'rejected'"), ["agency", "session"])


@check("insert_if_absent", """
    SELECT o_custkey, o_orderkey, o_totalprice FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders)
    WHERE rn = 1 AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def insert_if_absent(t: Tables):
    """All orders as the batch; the target already has the customers of one segment."""
    orders = t.base("orders").select("o_custkey", "o_orderkey", "o_totalprice")
    target = t.base("customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return idempotency.insert_if_absent(orders, target, ["o_custkey"], ["o_orderkey"])


@check("bytes_per_session", """
    SELECT agency, session, count(*) AS file_count, CAST(sum(size) AS BIGINT) AS total_bytes FROM files GROUP BY agency, session""")
def bytes_per_session(t: Tables):
    return aggregates.bytes_per_session(t.files())


@check("compression_stats", """
    SELECT agency, count(*) AS transfers, CAST(sum(source_size) AS BIGINT) AS source_bytes, CAST(sum(CASE WHEN entries = 2 THEN archive_size END) AS BIGINT) AS archive_bytes,
           round(CAST(sum(CASE WHEN entries = 2 THEN archive_size END) AS DOUBLE) / CAST(sum(source_size) AS DOUBLE), 6) AS ratio FROM manifests GROUP BY agency""")
def compression_stats(t: Tables):
    return aggregates.compression_stats(t.manifests())


@check("file_checksums", "SELECT doc_id, file_name, size, sha256(content) AS sha256 FROM files")
def file_checksums(t: Tables):
    return integrity.file_checksums(t.files().select("doc_id", "file_name", "content"))


@check("validate_manifests", """
    SELECT agency, session, len(codes) = 0 AS valid, codes[1] AS first_violation, array_to_string(codes, ',') AS violations FROM checked_manifests""")
def validate_manifests(t: Tables):
    return integrity.validate_manifests(t.manifests(), t.archives(), "hub").select(
        "agency", "session", "valid", "first_violation", joined("violations"))


_CLAIMED_SIZE = "size + CASE WHEN doc_id % 23 = 0 THEN 1 ELSE 0 END"


@check("validate_manifest_members", f"""
    SELECT agency, session, file_name, claimed_size, actual_size, array_to_string(codes, ',') AS violations FROM (
      SELECT coalesce(c.agency, a.agency) AS agency, coalesce(c.session, a.session) AS session, coalesce(c.file_name, a.file_name) AS file_name,
             claimed_size, a.size AS actual_size, [x FOR x IN [CASE WHEN a.sha IS NULL THEN 'missing_member' END, CASE WHEN c.sha IS NULL THEN 'extra_member' END,
               CASE WHEN claimed_size <> a.size THEN 'size_mismatch' END, CASE WHEN c.sha <> a.sha THEN 'checksum_mismatch' END] IF x IS NOT NULL] AS codes
      FROM (SELECT agency, session, CASE WHEN doc_id % 37 = 0 THEN concat('ghost-', file_name) ELSE file_name END AS file_name, {_CLAIMED_SIZE} AS claimed_size,
                   CASE WHEN doc_id % 29 = 0 THEN sha256('other') ELSE sha256(content) END AS sha FROM files) c
      FULL OUTER JOIN (SELECT agency, session, file_name, size, sha256(content) AS sha FROM files) a
        ON c.agency = a.agency AND c.session = a.session AND c.file_name = a.file_name) WHERE len(codes) > 0""")
def validate_manifest_members(t: Tables):
    claimed = t.files().selectExpr(
        "agency", "session", "CASE WHEN doc_id % 37 = 0 THEN concat('ghost-', file_name) ELSE file_name END AS file_name",
        f"{_CLAIMED_SIZE} AS size", "CASE WHEN doc_id % 29 = 0 THEN sha2('other', 256) ELSE upper(sha2(content, 256)) END AS sha256")
    actual = integrity.file_checksums(t.files())
    return integrity.validate_manifest_members(claimed, actual).select(
        "agency", "session", "file_name", "claimed_size", "actual_size", joined("violations"))


@check("quarantine_content", """
    SELECT f.agency, f.session, count(*) AS members, count(b.sha256) AS infected, count(*) FILTER (WHERE doc_id % 61 = 5) AS errors,
           CASE WHEN count(b.sha256) > 0 THEN 'infected' WHEN count(*) FILTER (WHERE doc_id % 61 = 5) > 0 THEN 'error' ELSE 'clean' END AS verdict
    FROM files f LEFT JOIN blocklist b ON CASE WHEN doc_id % 61 <> 5 THEN sha256(f.content) END = b.sha256 GROUP BY f.agency, f.session""")
def quarantine_content(t: Tables):
    members = integrity.file_checksums(t.files()).withColumn("sha256", F.expr("CASE WHEN doc_id % 61 <> 5 THEN sha256 END"))
    return integrity.quarantine_content(members.select("agency", "session", "sha256"), t.blocklist())


def _routed(t: Tables):
    checked = integrity.validate_manifests(t.manifests(), t.archives(), "hub")
    verdicts = integrity.quarantine_content(t.members(), t.blocklist())
    narrow = t.measured()
    return integrity.route_transfers(narrow.select("agency", "session").distinct(), t.session_markers(narrow), checked, verdicts)


@check("route_transfers", "SELECT agency, session, status, reason FROM routed")
def route_transfers(t: Tables):
    return _routed(t)


@check("status_counts", """
    SELECT count(*) FILTER (WHERE status = 'processed') AS processed, count(*) FILTER (WHERE status = 'already_processed') AS already_processed,
           count(*) FILTER (WHERE status IN ('failed', 'rejected')) AS failed,
           CASE WHEN count(*) FILTER (WHERE status IN ('failed', 'rejected')) = 0 THEN 'success' ELSE 'failure' END AS outcome FROM routed""")
def status_counts(t: Tables):
    return aggregates.status_counts(_routed(t))


@check("recent_processed", """
    SELECT agency, session FROM session_markers ORDER BY session DESC, agency LIMIT 3""")
def recent_processed(t: Tables):
    marked = t.files().select("agency", "session").distinct().join(
        t.session_markers().withColumn("status", F.lit("already_processed")), ["agency", "session"], "left")
    return aggregates.recent_processed(marked)


@check("exact_duplicates", """
    SELECT sha256(text) AS sha256, count(*) AS copies, min(doc_id) AS first_key FROM documents GROUP BY 1 HAVING count(*) > 1""")
def exact_duplicates(t: Tables):
    return integrity.exact_duplicates(integrity.file_checksums(t.files()), "doc_id")


@check("first_of_duplicates", """
    SELECT fingerprint, min(c_custkey) AS c_custkey, arg_min(request_id, c_custkey) AS request_id, count(*) AS copies FROM fingerprints GROUP BY fingerprint""")
def first_of_duplicates(t: Tables):
    return idempotency.first_of_duplicates(
        t.fingerprints().select("fingerprint", "c_custkey", "request_id"), "fingerprint", ["c_custkey"])


@check("first_pending_file", """
    SELECT agency, session, min(file_name) AS file_name, arg_min(doc_id, file_name) AS doc_id FROM files
    WHERE doc_id NOT IN (SELECT doc_id FROM file_markers) GROUP BY agency, session""")
def first_pending_file(t: Tables):
    files = t.files().select("agency", "session", "file_name", "doc_id")
    pending = idempotency.unprocessed_files(files, t.file_markers(), ["doc_id"])
    return idempotency.first_pending_file(pending, ["agency", "session"], "file_name")


@check("plan_extracts", """
    SELECT request_id, fingerprint, action, concat('query_mode/processed/', template_id, '/', fingerprint, '.done') AS marker_key,
           CASE WHEN action = 'run' THEN concat('query_mode/outgoing/', session, '/', template_id, '_', substr(fingerprint, 1, 12), '_results.csv') END AS output_key
    FROM (SELECT f.*, CASE WHEN fingerprint IN (SELECT fingerprint FROM done_fingerprints) THEN 'skip_done'
                           WHEN c_custkey = min(c_custkey) OVER (PARTITION BY fingerprint) THEN 'run' ELSE 'skip_duplicate' END AS action FROM fingerprints f)""")
def plan_extracts(t: Tables):
    return idempotency.plan_extracts(t.fingerprints(), t.done_fingerprints(), ["c_custkey"]).select(
        "request_id", "fingerprint", "action", "marker_key", "output_key")


@check("plan_transfers", """
    SELECT DISTINCT agency, session FROM files WHERE (agency, session) NOT IN (SELECT (agency, session) FROM session_markers)""")
def plan_transfers(t: Tables):
    return idempotency.plan_transfers(t.files().select("agency", "session").distinct(), t.session_markers())

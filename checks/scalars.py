"""Column expressions: names, paths, checksums, synthetic values."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.functions import hashing, naming, synth, text
from tidegate.sources import documents as docs
from tidegate.sources import files as file_sources
from tidegate.sources import generate

from .registry import check
from .tables import Tables


@check("classification_tags", """
    SELECT c_custkey, concat(CASE WHEN c_custkey % 3 = 0 THEN concat('Data_Classification=', c_mktsegment, ';') ELSE '' END,
                             CASE WHEN c_custkey % 2 = 0 THEN concat('classification=', c_nationkey, ';') ELSE '' END) AS tags
    FROM customer""")
def classification_tags(t: Tables):
    metadata = F.create_map(
        F.when(F.col("c_custkey") % 3 == 0, F.lit("Data_Classification")).otherwise(F.lit("segment")), F.col("c_mktsegment"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("classification")).otherwise(F.lit("nation")),
        F.col("c_nationkey").cast("string"))
    tags = F.array_sort(F.map_entries(text.classification_tags(metadata)))
    shown = F.array_join(F.transform(tags, lambda e: F.concat(e["key"], F.lit("="), e["value"], F.lit(";"))), "")
    return t.base("customer").select("c_custkey", shown.alias("tags"))


@check("normalize_request", r"""
    SELECT request_id, lower(trim(dataproduct_id)) AS dataproduct_id, lower(trim(requesting_agency)) AS requesting_agency,
           nullif(trim(delivery_target_id), '') AS delivery_target_id, trim(requested_by) AS requested_by
    FROM (SELECT *, CASE c_custkey % 3 WHEN 0 THEN '   ' WHEN 1 THEN concat(' target-', c_custkey) END AS delivery_target_id FROM requests)""")
def normalize_request(t: Tables):
    noisy = t.requests().withColumn("delivery_target_id", F.expr(
        "CASE c_custkey % 3 WHEN 0 THEN ' \t ' WHEN 1 THEN concat('\t target-', c_custkey, '\n') END"))
    noisy = noisy.withColumn("requesting_agency", F.upper("requesting_agency"))
    return text.normalize_request(noisy).select(
        "request_id", "dataproduct_id", "requesting_agency", "delivery_target_id", "requested_by")


@check("normalize_input_mode", """
    SELECT event_id, CASE WHEN event_id % 5 IN (0, 1) THEN CASE event_id % 5 WHEN 0 THEN 'query' ELSE 'file' END ELSE 'file' END AS mode,
           CASE event_id % 5 WHEN 0 THEN 'explicit' WHEN 1 THEN 'explicit' WHEN 2 THEN 'default_missing'
                WHEN 3 THEN 'default_blank' ELSE concat('default_invalid:', event_type) END AS reason FROM events""")
def normalize_input_mode(t: Tables):
    raw = F.expr("CASE event_id % 5 WHEN 0 THEN ' Query ' WHEN 1 THEN 'FILE' WHEN 2 THEN NULL WHEN 3 THEN '  ' ELSE event_type END")
    return t.base("events").select("event_id", text.normalize_input_mode(raw).alias("m")).select("event_id", "m.mode", "m.reason")


_URI_SQL = """CASE WHEN doc_id % 9 = 0 THEN concat('http://bucket/', key) WHEN doc_id % 9 = 1 THEN 's3://bucket'
    WHEN doc_id % 9 = 2 THEN 's3:///nokey' WHEN doc_id % 9 = 3 THEN concat('S3://bucket/', key)
    WHEN doc_id % 9 = 4 THEN 's3://bucket/' WHEN doc_id % 9 = 5 THEN concat('s3://bucket/file-', doc_id)
    ELSE concat('s3://store-', doc_id % 4, '/', key) END"""


@check("parse_object_uri", f"""
    SELECT doc_id, CASE WHEN ok THEN regexp_extract(uri, '^s3://([^/]+)/(.+)$', 1) END AS bucket,
           CASE WHEN ok THEN regexp_extract(uri, '^s3://([^/]+)/(.+)$', 2) END AS object_key,
           CASE WHEN ok THEN 'ok' WHEN starts_with(uri, 's3://') THEN 'invalid' ELSE 'other_scheme' END AS status
    FROM (SELECT *, regexp_matches(uri, '^s3://([^/]+)/(.+)$') AS ok FROM (
            SELECT doc_id, {_URI_SQL} AS uri FROM objects UNION ALL SELECT -1 - page_id, url FROM pages))""")
def parse_object_uri(t: Tables):
    uris = t.objects().select("doc_id", F.expr(_URI_SQL).alias("uri")).unionAll(
        t.base("pages").select((-1 - F.col("page_id")).alias("doc_id"), "url"))
    return uris.select("doc_id", naming.parse_object_uri(F.col("uri")).alias("p")).select(
        "doc_id", "p.bucket", F.col("p.key").alias("object_key"), "p.status")


@check("resolve_file_request", f"""
    SELECT doc_id, status, CASE WHEN status = 'ok' THEN regexp_extract(uri, '^s3://([^/]+)/(.+)$', 1) END AS bucket,
           CASE WHEN status = 'ok' THEN k END AS object_key,
           CASE WHEN status = 'ok' THEN CASE WHEN doc_id % 4 = 0 THEN concat('renamed-', doc_id)
                ELSE regexp_extract(rtrim(k, '/'), '[^/]+$') END END AS file_name,
           CASE WHEN status = 'ok' THEN concat('s3://', regexp_extract(uri, '^s3://([^/]+)/(.+)$', 1), '/', regexp_extract(k, '^(.*/)?', 0)) END AS marker_directory
    FROM (SELECT doc_id, uri, regexp_extract(uri, '^s3://([^/]+)/(.+)$', 2) AS k,
                 CASE WHEN uri IS NULL OR trim(uri) = '' THEN 'missing_path'
                      WHEN regexp_matches(uri, '^s3://([^/]+)/(.+)$') THEN 'ok'
                      WHEN starts_with(uri, 's3://') THEN 'invalid' ELSE 'other_scheme' END AS status
          FROM (SELECT doc_id, CASE WHEN doc_id % 10 = 7 THEN ' ' ELSE {_URI_SQL} END AS uri FROM objects))""")
def resolve_file_request(t: Tables):
    requests = t.objects().select(
        "doc_id", F.expr(f"CASE WHEN doc_id % 10 = 7 THEN ' ' ELSE {_URI_SQL} END").alias("uri"),
        F.expr("CASE doc_id % 4 WHEN 0 THEN concat(' renamed-', doc_id) WHEN 1 THEN '  ' END").alias("wanted"))
    return file_sources.resolve_file_request(requests, "uri", "wanted").drop("uri", "wanted")


_WANTED_SQL = """CASE doc_id % 5 WHEN 0 THEN concat('s3://store-', doc_id % 4, '/', regexp_replace(key, '[^/]*$', ''))
    WHEN 1 THEN concat('s3://store-', doc_id % 4, '/', key, '.gone') WHEN 2 THEN concat('s3://store-', doc_id % 3, '/', key)
    WHEN 3 THEN regexp_replace(concat('s3://store-', doc_id % 4, '/', key), '/[^/]*$', '') ELSE concat('s3://store-', doc_id % 4, '/', key) END"""


@check("locate_objects", f"""
    SELECT * FROM (WITH l AS (SELECT concat('store-', doc_id % 4) AS bucket, key, min(size) AS size FROM objects
               WHERE NOT ends_with(key, '/') AND NOT ends_with(key, '.done') GROUP BY ALL),
         w AS (SELECT doc_id, split_part(uri, '/', 3) AS bucket, regexp_replace(uri, '^s3://[^/]+/?', '') AS k
               FROM (SELECT doc_id, {_WANTED_SQL} AS uri FROM objects)),
         folders AS (SELECT bucket, k, count(l.key) AS n, min(l.key) AS only FROM (SELECT DISTINCT bucket, k FROM w) d
                     JOIN l USING (bucket) WHERE starts_with(l.key, concat(rtrim(k, '/'), '/')) GROUP BY bucket, k)
    SELECT doc_id, CASE WHEN w.k = '' THEN 'invalid' WHEN e.key IS NOT NULL OR f.n = 1 THEN 'ok' WHEN f.n > 1 THEN 'several_objects' ELSE 'object_absent' END AS status,
           CASE WHEN w.k = '' THEN NULL WHEN e.key IS NOT NULL THEN e.key WHEN f.n = 1 THEN f.only END AS source_key,
           CASE WHEN w.k = '' THEN NULL WHEN e.key IS NOT NULL THEN e.size WHEN f.n = 1 THEN o.size END AS source_size
    FROM w LEFT JOIN l e ON e.bucket = w.bucket AND e.key = w.k LEFT JOIN folders f ON f.bucket = w.bucket AND f.k = w.k
    LEFT JOIN l o ON o.bucket = f.bucket AND o.key = f.only)""")
def locate_objects(t: Tables):
    objects = t.objects()
    requests = objects.select("doc_id", F.expr(_WANTED_SQL).alias("uri"), F.lit(None).cast("string").alias("wanted"))
    listing = objects.select(F.expr("concat('store-', doc_id % 4)").alias("bucket"), "key", "size")
    located = file_sources.locate_objects(file_sources.resolve_file_request(requests, "uri", "wanted"), listing)
    return located.select("doc_id", "status", "source_key", "source_size")


@check("storage_paths", """
    SELECT doc_id, concat('file_mode/transfers/', session, '/', file_name) AS file_path,
           concat('query_mode/transfers/', session, '/', file_name) AS query_path,
           CASE WHEN doc_id % 8 <> 0 THEN concat(CASE WHEN doc_id % 6 = 0 THEN 'landing' ELSE agency END, '/', session, '/', file_name) END AS landing_path,
           concat('extracted/', session, '/', file_name) AS extracted_path, doc_id % 8 = 0 AS blank FROM files""")
def storage_paths(t: Tables):
    session, name = F.concat(F.lit(" "), "session", F.lit(" ")), F.concat("file_name", F.lit("\t"))
    agency = F.expr("CASE WHEN doc_id % 8 = 0 THEN '  ' WHEN doc_id % 6 = 0 THEN NULL ELSE concat(agency, ' ') END")
    return t.files().select(
        "doc_id", naming.transfer_path(F.lit("file"), session, name).alias("file_path"),
        naming.transfer_path(F.lit("query"), session, name).alias("query_path"),
        naming.landing_path(session, name, agency).alias("landing_path"),
        naming.extracted_path(session, name).alias("extracted_path"),
        naming.blank_part(F.coalesce(agency, F.lit("landing"))).alias("blank"))


@check("bucket_names", """
    SELECT doc_id, concat('exchange-', CASE WHEN doc_id % 2 = 0 THEN 'dev' ELSE 'prod' END, '-', agency, '-data-', CASE doc_id % 4 WHEN 0 THEN 'staging'
              WHEN 1 THEN 'landing' WHEN 2 THEN 'target' END) AS sender_bucket,
           CASE WHEN doc_id % 4 IN (1, 2) THEN concat('exchange-', CASE WHEN doc_id % 2 = 0 THEN 'dev' ELSE 'prod' END, '-', agency, '-data-',
              CASE doc_id % 4 WHEN 1 THEN 'landing' ELSE 'target' END) END AS receiver_bucket
    FROM files WHERE doc_id % 4 <> 3 UNION ALL SELECT doc_id, NULL, NULL FROM files WHERE doc_id % 4 = 3""")
def bucket_names(t: Tables):
    env = F.expr("CASE WHEN doc_id % 2 = 0 THEN ' Dev' ELSE 'PROD' END")
    purpose = F.expr("CASE doc_id % 4 WHEN 0 THEN 'staging' WHEN 1 THEN 'LANDING' WHEN 2 THEN 'target' ELSE 'other' END")
    return t.files().select(
        "doc_id", naming.bucket_name(env, F.upper("agency"), purpose).alias("sender_bucket"),
        naming.bucket_name(env, F.upper("agency"), purpose, allowed_purposes=naming.RECEIVER_PURPOSES).alias("receiver_bucket"))


@check("marker_keys", """
    SELECT doc_id, concat(CASE WHEN starts_with(key, 'file_mode/outgoing/') OR contains(key, '/file_mode/outgoing/')
                               THEN regexp_replace(key, '(^|/)file_mode/outgoing/', '\\1file_mode/processed/')
                               ELSE concat('file_mode/processed/', regexp_extract(rtrim(key, '/'), '[^/]+$')) END, '.done') AS file_marker,
           concat('query_mode/processed/extract_v1/', sha256(key), '.done') AS query_marker,
           concat('processed/', doc_id % 5, '/', size, CASE WHEN doc_id % 2 = 0 THEN '.done' ELSE '.rejected' END) AS session_marker
    FROM objects""")
def marker_keys(t: Tables):
    kind = F.expr("CASE WHEN doc_id % 2 = 0 THEN 'done' ELSE 'rejected' END")
    return t.objects().select(
        "doc_id", naming.file_marker_key(F.col("key")).alias("file_marker"),
        naming.query_marker_key("extract_v1", F.sha2("key", 256)).alias("query_marker"),
        naming.session_marker_key((F.col("doc_id") % 5).cast("string"), F.col("size").cast("string"), kind).alias("session_marker"))


@check("file_names", "SELECT doc_id, regexp_extract(rtrim(key, '/'), '[^/]*$') AS file_name FROM objects")
def file_names(t: Tables):
    return t.objects().select("doc_id", naming.base_name(F.col("key")).alias("file_name"))


_MEMBER_SQL = """CASE doc_id % 9 WHEN 0 THEN concat('../', file_name) WHEN 1 THEN concat('/', file_name) WHEN 2 THEN concat('a/../', file_name)
    WHEN 3 THEN '.' WHEN 4 THEN '' WHEN 5 THEN concat('a/..b/', file_name) WHEN 6 THEN '..' ELSE concat(session, '/', file_name) END"""


@check("safe_member_names", f"""
    SELECT doc_id, CASE WHEN name = '' THEN 'empty' WHEN name IN ('.', '..') THEN 'dot_name' WHEN starts_with(name, '/') THEN 'absolute'
                        WHEN list_contains(string_split(name, '/'), '..') THEN 'traversal' END AS violation
    FROM (SELECT doc_id, {_MEMBER_SQL} AS name FROM files)""")
def safe_member_names(t: Tables):
    return t.files().select("doc_id", naming.member_name_violation(F.expr(_MEMBER_SQL)).alias("violation"))


@check("sha256_hex", "SELECT doc_id, sha256(text) AS sha256 FROM documents")
def sha256_hex(t: Tables):
    return t.base("documents").select("doc_id", hashing.sha256_hex(F.col("text")).alias("sha256"))


@check("short_fingerprint", "SELECT doc_id, substr(sha256(text), 1, 12) AS short FROM documents")
def short_fingerprint(t: Tables):
    return t.base("documents").select("doc_id", hashing.short_fingerprint(F.sha2("text", 256)).alias("short"))


@check("hex_checksum_valid", """
    SELECT doc_id, CASE WHEN doc_id % 3 < 2 THEN sha256(source || doc_id) END AS checksum FROM documents""")
def hex_checksum_valid(t: Tables):
    digest = F.sha2(F.concat("source", "doc_id"), 256)
    noisy = F.when(F.col("doc_id") % 3 == 0, F.upper(digest)).when(F.col("doc_id") % 3 == 1, digest).otherwise(
        F.concat(F.lit("g"), F.substring(digest, 2, 63)))
    return t.base("documents").select("doc_id", hashing.hex_checksum(noisy).alias("checksum"))


@check("archive_field_names", """
    SELECT agency, concat(session, '-', doc_id) AS session, u.position, CASE u.position WHEN 1 THEN file_name ELSE 'transfer.tar.gz' END AS file_name,
           CASE u.position WHEN 1 THEN size ELSE size // 3 + 20 END AS file_size_bytes
    FROM files, (VALUES (1), (2)) u(position)""")
def archive_field_names(t: Tables):
    entry = "named_struct('file_name', {0}, 'file_size_bytes', {1}, 'checksum_sha256', {2})"
    files = F.expr(f"array({entry.format('source_name', 'source_size', 'source_sha256')}, "
                   f"{entry.format('archive_name', 'archive_size', 'archive_sha256')})")
    sent = file_sources.archive_field_names_out(files)
    received = file_sources.archive_field_names(sent)
    return t.transfers().select("agency", "session", F.posexplode(received).alias("p", "f")).select(
        "agency", "session", (F.col("p") + 1).alias("position"), "f.file_name", "f.file_size_bytes")


@check("session_ids", """
    SELECT event_id, concat(strftime(ts, '%Y%m%d-%H%M%S'), '-', substr(sha256(CAST(event_id AS VARCHAR)), 1, 8)) AS session_id FROM events""")
def session_ids(t: Tables):
    return t.base("events").select("event_id", naming.session_id(F.col("ts"), F.col("event_id")).alias("session_id"))


@check("read_requests", """
    SELECT c_custkey, CASE c_custkey % 60 WHEN 7 THEN 'not_object' WHEN 8 THEN 'invalid_json' WHEN 9 THEN 'blank' ELSE 'ok' END AS status,
           trim(json_extract_string(object, '$.request_id')) AS request_id,
           lower(json_extract_string(object, '$.dataproduct_id')) AS dataproduct_id,
           CAST(json_extract_string(object, '$.requested_row_limit') AS BIGINT) AS requested_row_limit,
           nullif(trim(json_extract_string(object, '$.justification')), '') AS justification
    FROM (SELECT c_custkey, CASE WHEN json_valid(raw) THEN raw END AS object FROM raw_requests)""")
def read_requests(t: Tables):
    return docs.read_requests(t.raw_requests()).select(
        "c_custkey", "status", "request_id", "dataproduct_id", "requested_row_limit", "justification")


def _draw_sql(column: str, salt: str, row: str = "c_custkey") -> str:
    return f"CAST(('0x' || substr(md5('0|{column}|{salt}|' || {row}), 1, 15)) AS BIGINT)"


def _sql_list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{value}'" for value in values) + "]"


def _pick_sql(column: str, salt: str, values: list[str]) -> str:
    return f"{_sql_list(values)}[{_draw_sql(column, salt)} % {len(values)} + 1]"


_PIID_SQL = f"""concat({_pick_sql('piid', 'prefix', synth.ID_PREFIXES)}, {_draw_sql('piid', 'year')} % 6 + 21, {_pick_sql('piid', 'letter', ['C', 'D'])}, '-',
    {_draw_sql('piid', 'year')} % 6 + 21, '-', {_pick_sql('piid', 'letter', ['C', 'D'])}, '-', lpad(CAST({_draw_sql('piid', 'number')} % 9999 + 1 AS VARCHAR), 4, '0'))"""
_VENDOR_SQL = f"""concat({_pick_sql('vendor_name', 'first', synth.VENDOR_WORDS)}, ' ',
    CASE WHEN {_draw_sql('vendor_name', 'words')} % 2 = 1 THEN {_sql_list(synth.VENDOR_WORDS)}[
      ({_draw_sql('vendor_name', 'first')} % {len(synth.VENDOR_WORDS)} + 1 + {_draw_sql('vendor_name', 'second')} % {len(synth.VENDOR_WORDS) - 1}) % {len(synth.VENDOR_WORDS)} + 1] || ' ' ELSE '' END,
    {_pick_sql('vendor_name', 'suffix', synth.VENDOR_SUFFIXES)})"""
_DUNS_SQL = f"CAST({_draw_sql('vendor_duns', 'duns')} % 900000000 + 100000000 AS VARCHAR)"


@check("synth_piid", f"SELECT c_custkey, {_PIID_SQL} AS piid FROM customer")
def synth_piid(t: Tables):
    return t.base("customer").select("c_custkey", synth.synth_piid(synth.Draw(F.col("c_custkey"), "piid")).alias("piid"))


@check("synth_vendor", f"SELECT c_custkey, {_VENDOR_SQL} AS vendor_name FROM customer")
def synth_vendor(t: Tables):
    return t.base("customer").select("c_custkey", synth.synth_vendor(synth.Draw(F.col("c_custkey"), "vendor_name")).alias("vendor_name"))


@check("synth_duns", f"SELECT c_custkey, {_DUNS_SQL} AS vendor_duns FROM customer")
def synth_duns(t: Tables):
    return t.base("customer").select("c_custkey", synth.synth_duns(synth.Draw(F.col("c_custkey"), "vendor_duns")).alias("vendor_duns"))



@check("synth_values", f"""
    SELECT c_custkey, {_draw_sql('n', 'int')} % 1000000 + 1 AS n, CAST(({_draw_sql('amount', 'num')} % 99999901 + 100) / 100.0 AS DOUBLE) AS amount,
           {_draw_sql('flag', 'bool')} % 2 = 1 AS flag, strftime(DATE '2021-01-01' + CAST({_draw_sql('award_date', 'date')} % 2191 AS INT), '%Y-%m-%d') AS award_date,
           {_pick_sql('contract_type', 'type', synth.CONTRACT_TYPES)} AS contract_type, concat('user', c_custkey, '@example.com') AS email,
           concat('note_', c_custkey) AS note, concat(substr(u, 1, 8), '-', substr(u, 9, 4), '-', substr(u, 13, 4), '-', substr(u, 17, 4), '-', substr(u, 21, 12)) AS id
    FROM (SELECT *, md5('0|id|uuid|' || c_custkey) AS u FROM customer)""")
def synth_values(t: Tables):
    row = F.col("c_custkey")
    value = lambda name, kind: synth.synth_value(name, kind, row).alias(name)
    return t.base("customer").select(
        "c_custkey", value("n", "integer"), value("amount", "numeric(15,2)").cast("double").alias("amount"), value("flag", "boolean"),
        F.date_format(value("award_date", "date"), "yyyy-MM-dd").alias("award_date"), value("contract_type", "text"),
        value("email", "text"), value("note", "text"), value("id", "uuid"))


@check("synth_rows", f"""
    SELECT {_PIID_SQL} AS piid, {_VENDOR_SQL} AS vendor_name, {_DUNS_SQL} AS vendor_duns,
           {_sql_list(['active', 'closed'])}[{_draw_sql('state', 'label')} % 2 + 1] AS state FROM customer""")
def synth_rows(t: Tables):
    columns = [
        {"name": "id", "type": "bigint", "identity": True}, {"name": "piid", "type": "text"},
        {"name": "vendor_name", "type": "text"}, {"name": "vendor_duns", "type": "text"},
        {"name": "state", "type": "user-defined", "labels": ["active", "closed"]},
    ]
    return generate.synth_rows(t.base("customer"), columns, row="c_custkey")

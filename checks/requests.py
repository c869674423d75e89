"""Registry and request governance."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.functions import hashing
from tidegate.operators import governance, registry
from tidegate.plans.requests import run_requests as run_all
from tidegate.session import run_folder
from tidegate.sources import documents as docs

from .registry import check
from .tables import Tables, joined


def _codes(*rules: tuple[str, str]) -> str:
    """SQL list of the codes whose condition holds, as comma-joined text."""
    cases = ", ".join(f"CASE WHEN {condition} THEN '{code}' END" for code, condition in rules)
    return f"array_to_string([c FOR c IN [{cases}] IF c IS NOT NULL], ',')"


@check("active_definition", "SELECT dataproduct_id, version, status, path FROM active")
def active_definition(t: Tables):
    return t.active().select("dataproduct_id", "version", "status", "path")


@check("duplicate_definitions", """
    SELECT dataproduct_id, version, count(*) AS n, min(path) AS first_path, max(path) AS last_path
    FROM definitions GROUP BY dataproduct_id, version HAVING count(*) > 1""")
def duplicate_definitions(t: Tables):
    return registry.duplicate_definitions(t.definitions())


@check("read_definitions", """
    SELECT dataproduct_id, version, status, source_type, engine, template_id, array_to_string(required, ',') AS required,
           array_to_string(allowed_select, ',') AS allowed_select, default_row_limit, retention_days AS retention_policy_days FROM definitions""")
def read_definitions(t: Tables):
    path = run_folder(t.spark, "definitions")
    t.definition_docs().select(docs_struct()).select("d.*").write.option("ignoreNullFields", "false").json(path)
    return _flat(docs.read_definitions(t.spark, path, multi_line=False))


def docs_struct():
    names = ["dataproduct_id", "name", "version", "status", "owner_agency", "data_owner", "access", "extraction", "delivery", "operations"]
    return F.struct(*names).alias("d")


def _flat(definitions):
    flat = registry.flatten_definitions(definitions)
    return flat.select(
        "dataproduct_id", "version", "status", "source_type", "engine", "template_id",
        F.array_join(F.transform("required_params", lambda p: p["name"]), ",").alias("required"),
        joined("allowed_select_fields", "allowed_select"), "default_row_limit", "retention_policy_days")


@check("definition_schema_check", f"""
    SELECT path, {_codes(
        ('document:unexpected_key', 'b = 15'), ('name:length', "b = 10"), ('version:pattern', 'b = 12'), ('status:enum', 'b = 13'),
        ('owner_agency:length', 'b = 2'), ('data_owner.contact_email:format', 'b = 3'),
        ('access.classification_tags:not_unique', 'b = 4'), ('access.retention_policy_days:range', 'b = 9'),
        ('extraction.engine:not_for_file', "source_type = 'file' AND engine <> 's3-file'"),
        ('extraction.required_params:too_few', 'b = 11'), ('extraction.default_row_limit:range', 'b = 5'),
        ('extraction.allowed_filters:item_operators', 'b = 6'), ('delivery.output_format:enum', 'b = 8'),
        ('operations.schedule_constraints:window', 'b = 7'), ('operations.notifications:missing', 'b = 14'))} AS violations
    FROM (SELECT *, path_no % 30 AS b FROM definitions)""")
def definition_schema_check(t: Tables):
    checked = registry.definition_schema_check(t.definition_texts(broken=True), raw="raw")
    return checked.select("path", joined("violations"))


@check("registry_lookup", """
    SELECT r.request_id, lower(trim(r.dataproduct_id)) AS dataproduct_id, d.version AS definition_version,
           d.dataproduct_id IS NOT NULL AS known_product
    FROM requests r LEFT JOIN active d ON lower(trim(r.dataproduct_id)) = d.dataproduct_id""")
def registry_lookup(t: Tables):
    return registry.registry_lookup(t.requests(), t.active()).select(
        "request_id", "dataproduct_id", "definition_version", "known_product")


_RAW = "json_extract_string(raw, '$.{0}')".format
_OBJ = "CASE WHEN json_valid(raw) THEN json_type(raw) = 'OBJECT' ELSE false END"


@check("request_schema_check", f"""
    SELECT c_custkey, {_codes(
        ('document:blank', "trim(raw) = ''"), ('document:invalid_json', "trim(raw) <> '' AND NOT json_valid(raw)"),
        ('document:not_object', f"json_valid(raw) AND NOT ({_OBJ})"),
        ('document:unexpected_key', f"({_OBJ}) AND list_contains(json_keys(raw), 'color')"),
        ('requested_by:missing', f"({_OBJ}) AND NOT list_contains(json_keys(raw), 'requested_by')"),
        ('dataproduct_id:pattern', f"NOT regexp_matches(lower({_RAW('dataproduct_id')}), '^[a-z0-9][a-z0-9_-]{{2,63}}$')"),
        ('delivery_target_id:length', f"length({_RAW('delivery_target_id')}) < 3"),
        ('justification:type', f"trim({_RAW('justification')}) = ''"),
        ('metadata:not_scalar', "json_type(raw, '$.metadata.a') = 'OBJECT'"),
        ('params:type', "json_type(raw, '$.params') = 'ARRAY'"), ('params:empty', f"{_RAW('params')} = '{{}}'"),
        ('request_id:length', f"length(trim({_RAW('request_id')})) < 6"),
        ('request_id:pattern', f"NOT regexp_matches(trim({_RAW('request_id')}), '^[A-Za-z0-9._-]+$')"),
        ('requested_row_limit:type', "json_type(raw, '$.requested_row_limit') = 'VARCHAR'"),
        ('requested_row_limit:range', "json_type(raw, '$.requested_row_limit') <> 'VARCHAR' AND CAST(" + _RAW('requested_row_limit') + " AS BIGINT) < 1"),
        ('requested_timeout_seconds:range', f"CAST({_RAW('requested_timeout_seconds')} AS BIGINT) > 86400"),
        ('requesting_agency:length', f"length({_RAW('requesting_agency')}) < 2"))} AS violations
    FROM (SELECT c_custkey, CASE WHEN json_valid(r.raw) THEN r.raw ELSE NULL END AS parsed, r.raw FROM raw_requests r) q""".replace(
        "json_extract_string(raw,", "json_extract_string(parsed,").replace("json_type(raw, '$.", "json_type(parsed, '$."))
def request_schema_check(t: Tables):
    checked = governance.request_schema_check(docs.read_requests(t.raw_requests()))
    return checked.select("c_custkey", joined("schema_violations", "violations"))


@check("source_type_check", """
    SELECT request_id, CASE WHEN source_type <> 'sql' THEN 'source_type_mismatch' END AS query_path,
           CASE WHEN source_type <> 'file' THEN 'source_type_mismatch' WHEN engine <> 's3-file' THEN 'engine_mismatch' END AS file_path
    FROM governed""")
def source_type_check(t: Tables):
    query = governance.source_type_check(t.governed(), "sql").withColumnRenamed("source_type_violation", "query_path")
    both = governance.source_type_check(query, "file").withColumnRenamed("source_type_violation", "file_path")
    return both.select("request_id", "query_path", "file_path")


_UNKNOWN = "list_sort([k FOR k IN json_keys(params) IF NOT list_contains(list_concat(required, optional), k)])"
_MISSING = "list_sort([k FOR k IN required IF trim(coalesce(json_extract_string(params, '$.' || k), '')) = ''])"
_VALUES = """[c FOR c IN [CASE WHEN json_extract_string(params, '$.schema') <> 'dot' THEN 'schema' END,
    CASE WHEN json_extract_string(params, '$.table') <> 'contract_data' THEN 'table' END] IF c IS NOT NULL]"""
_SELECT = """CASE WHEN len(allowed_select) = 0 THEN [] ELSE
    list_sort([f FOR f IN CAST(json_extract(params, '$.select_fields') AS VARCHAR[]) IF NOT list_contains(allowed_select, f)]) END"""
_FILTER = """CASE WHEN len(allowed_filter_fields) = 0 THEN []
    WHEN NOT list_contains(allowed_filter_fields, 'contract_value') THEN ['contract_value']
    WHEN json_exists(params, '$.filters.contract_value.like') THEN ['contract_value.like'] ELSE [] END"""
_TEMPLATE = """CASE WHEN template_id <> 'dot_contract_extract_v1' THEN 'template_not_allowed'
    WHEN trim(json_extract_string(params, '$.schema')) = '' THEN 'template_params_missing' END"""


@check("unknown_params", f"SELECT request_id, array_to_string({_UNKNOWN}, ',') AS unknown_params FROM governed")
def unknown_params(t: Tables):
    return governance.unknown_params(t.governed()).select("request_id", joined("unknown_params"))


@check("missing_params", f"SELECT request_id, array_to_string({_MISSING}, ',') AS missing_params FROM governed")
def missing_params(t: Tables):
    return governance.missing_params(t.governed()).select("request_id", joined("missing_params"))


@check("param_values", f"SELECT request_id, array_to_string({_VALUES}, ',') AS bad_values FROM governed")
def param_values(t: Tables):
    return governance.param_values(t.governed()).select("request_id", joined("bad_values"))


@check("select_allow_list", f"SELECT request_id, array_to_string({_SELECT}, ',') AS select_violations FROM governed")
def select_allow_list(t: Tables):
    return governance.select_allow_list(t.governed()).select("request_id", joined("select_violations"))


@check("filter_allow_list", f"SELECT request_id, array_to_string({_FILTER}, ',') AS filter_violations FROM governed")
def filter_allow_list(t: Tables):
    return governance.filter_allow_list(t.governed()).select("request_id", joined("filter_violations"))


@check("template_allow_list", f"SELECT request_id, {_TEMPLATE} AS template_violation FROM governed")
def template_allow_list(t: Tables):
    return governance.template_allow_list(t.governed()).select("request_id", "template_violation")


@check("param_set_difference", """
    SELECT request_id, array_to_string(list_sort([k FOR k IN json_keys(params) IF k NOT IN ('schema', 'table', 'filters')]), ',') AS extra FROM requests""")
def param_set_difference(t: Tables):
    names = lambda *values: F.array(*[F.lit(v) for v in values])
    extra = governance.param_set_difference(F.json_object_keys("params"), names("schema", "table"), names("filters", "table"))
    return t.requests().select("request_id", F.array_join(extra, ",").alias("extra"))


_ROWS = "coalesce(requested_row_limit, default_row_limit)"
_TIME = "coalesce(requested_timeout_seconds, default_timeout_seconds)"
_LIMITS = _codes(("row_limit_exceeds_cap", f"{_ROWS} > 50000"), ("timeout_exceeds_cap", f"{_TIME} > 300"))


@check("limit_resolution", f"""
    SELECT request_id, CAST({_ROWS} AS BIGINT) AS row_limit, CAST({_TIME} AS BIGINT) AS timeout_seconds,
           50000 AS row_limit_cap, 300 AS timeout_cap, {_LIMITS} AS limit_violations FROM governed""")
def limit_resolution(t: Tables):
    return governance.limit_resolution(t.governed(), row_cap=50_000).select(
        "request_id", "row_limit", "timeout_seconds", "row_limit_cap", "timeout_cap", joined("limit_violations"))


@check("contract_version_check", """
    SELECT c_custkey, c_custkey % 4 = 0 AS supported FROM customer""")
def contract_version_check(t: Tables):
    version = F.expr("CASE c_custkey % 4 WHEN 0 THEN 'v3.1.0' WHEN 1 THEN '3.1.0' WHEN 2 THEN 'v3.0.0' END")
    return t.base("customer").select("c_custkey", governance.contract_version_check(version).alias("supported"))


@check("policy_decision", """
    SELECT agency, session, CASE WHEN agency_no % 6 = 0 OR n < 1 THEN 'error' ELSE 'allow' END AS decision,
           CASE WHEN agency_no % 6 = 0 THEN 'agency_blank' WHEN n < 1 THEN 'file_count_invalid' ELSE 'policy_approved' END AS reason
    FROM (SELECT agency, session, min(agency_no) AS agency_no, CASE WHEN min(session_no) = 3 THEN 0 ELSE count(*) END AS n FROM files GROUP BY agency, session)""")
def policy_decision(t: Tables):
    sessions = t.files().groupBy("agency", "session").agg(
        F.min("agency_no").alias("agency_no"), F.when(F.min("session_no") == 3, 0).otherwise(F.count("*")).alias("n"))
    agency = F.when(F.col("agency_no") % 6 == 0, F.lit("  ")).otherwise(F.col("agency"))
    return sessions.select("agency", "session", governance.policy_decision(agency, F.col("n")).alias("p")).select(
        "agency", "session", "p.decision", "p.reason")


def _coded_sql(code: str, names: str) -> str:
    return f"['{code}:' || k FOR k IN {names}]"


_ALL_CODES = f"""CASE WHEN d.dataproduct_id IS NULL THEN ['unknown_dataproduct'] ELSE [c FOR c IN list_concat(
    [CASE WHEN source_type <> 'sql' THEN 'source_type_mismatch' END], {_coded_sql('unknown_param', _UNKNOWN)},
    {_coded_sql('missing_param', _MISSING)}, {_coded_sql('param_value', _VALUES)}, {_coded_sql('select_field', f'({_SELECT})')},
    {_coded_sql('filter', f'({_FILTER})')}, [{_TEMPLATE}],
    [CASE WHEN {_ROWS} > 100000 THEN 'row_limit_exceeds_cap' END, CASE WHEN {_TIME} > 300 THEN 'timeout_exceeds_cap' END])
    IF c IS NOT NULL] END"""


@check("request_decision", f"""
    SELECT request_id, CASE WHEN len(codes) = 0 THEN 'accepted' ELSE 'rejected' END AS decision, codes[1] AS first_violation,
           array_to_string(codes, ',') AS violations, CASE WHEN len(codes) = 0 THEN CAST(row_limit AS BIGINT) END AS effective_row_limit,
           CASE WHEN len(codes) = 0 THEN template_id END AS effective_template_id
    FROM (SELECT r.request_id, d.template_id, {_ROWS} AS row_limit, {_ALL_CODES} AS codes
          FROM requests r LEFT JOIN active d ON lower(trim(r.dataproduct_id)) = d.dataproduct_id)""")
def request_decision(t: Tables):
    return governance.request_decision(t.requests(), t.active()).select(
        "request_id", "decision", "first_violation", joined("violations"), "effective_row_limit", "effective_template_id")


_PATH_PARAMS = """CASE c_custkey % 6 WHEN 0 THEN '{"s3_path":"s3://drop/in/f.csv"}' WHEN 1 THEN '{"s3_path":"s3://drop/in/f.csv","file_name":" new.csv "}'
    WHEN 2 THEN '{}' WHEN 3 THEN '{"s3_path":5}' WHEN 4 THEN '{"s3_path":"s3://drop","extra":1}' ELSE '[1]' END"""
_FILE_CODES = """CASE WHEN d.dataproduct_id IS NULL THEN list_concat(CASE WHEN k = 5 THEN ['params_not_object'] ELSE [] END, ['unknown_dataproduct'])
    WHEN k = 5 THEN ['params_not_object'] ELSE [c FOR c IN [CASE WHEN d.source_type <> 'file' THEN 'source_type_mismatch' WHEN d.engine <> 's3-file' THEN 'engine_mismatch' END,
        CASE WHEN k = 4 THEN 'unknown_param:extra' END, CASE WHEN k = 2 THEN 'missing_param:s3_path' END,
        CASE WHEN k IN (2, 3) THEN 's3_path:missing_path' WHEN k = 4 THEN 's3_path:invalid' END] IF c IS NOT NULL] END"""


@check("file_request_decision", f"""
    SELECT request_id, CASE WHEN len(codes) = 0 THEN 'accepted' ELSE 'rejected' END AS decision, array_to_string(codes, ',') AS violations,
           CASE WHEN len(codes) = 0 THEN 'in/f.csv' END AS object_key,
           CASE WHEN len(codes) = 0 THEN CASE WHEN k = 1 THEN 'new.csv' ELSE 'f.csv' END END AS file_name
    FROM (SELECT r.request_id, r.c_custkey % 6 AS k, {_FILE_CODES} AS codes
          FROM requests r LEFT JOIN active d ON lower(trim(r.dataproduct_id)) = d.dataproduct_id)""")
def file_request_decision(t: Tables):
    p = "named_struct('name', '{0}', 'type', 'string', 'description', '', 'allowed_values', '[]', 'min', CAST(NULL AS DOUBLE), 'max', CAST(NULL AS DOUBLE))"
    products = t.active().withColumns({
        "required_params": F.expr(f"array({p.format('s3_path')})"), "optional_params": F.expr(f"array({p.format('file_name')})")})
    decided = governance.file_request_decision(t.requests().withColumn("params", F.expr(_PATH_PARAMS)), products)
    return decided.select("request_id", "decision", joined("violations"), "object_key", "file_name")


_RUN_SQL = f"""(SELECT r.c_custkey, r.request_id, r.params, {_ROWS} AS row_limit, {_TIME} AS timeout_seconds, {_ALL_CODES} AS codes
    FROM requests r LEFT JOIN active d ON lower(trim(r.dataproduct_id)) = d.dataproduct_id)"""


@check("run_requests", f"""
    SELECT d.request_id, CASE WHEN len(codes) = 0 THEN 'accepted' ELSE 'rejected' END AS decision, codes[1] AS first_violation,
           CASE WHEN len(codes) = 0 THEN CASE WHEN f.first_id = d.request_id THEN 'run' ELSE 'skip_duplicate' END END AS action,
           CASE WHEN len(codes) = 0 THEN CASE WHEN c_custkey % 8 = 0 OR c_custkey % 12 = 0 THEN 'failed' ELSE 'done' END END AS status,
           CASE WHEN len(codes) = 0 THEN CASE WHEN c_custkey % 8 = 0 OR c_custkey % 12 = 0 THEN 0
                ELSE least(d.row_limit, (SELECT count(*) FROM contracts WHERE contract_value >= 1000)) END END AS row_count,
           CASE WHEN len(codes) = 0 THEN CASE WHEN f.first_id = d.request_id THEN 'extract_data,pipeline_start,policy_check' ELSE 'pipeline_start,policy_check' END
                ELSE 'pipeline_start' END AS events
    FROM {_RUN_SQL} d LEFT JOIN (SELECT params, row_limit, timeout_seconds, min(request_id) AS first_id FROM {_RUN_SQL} WHERE len(codes) = 0
                                 GROUP BY params, row_limit, timeout_seconds) f
      ON d.params = f.params AND d.row_limit = f.row_limit AND d.timeout_seconds = f.timeout_seconds""")
def run_requests(t: Tables):
    root = run_folder(t.spark, "request-extracts")
    outcome = run_all(t.spark, t.requests(), t.active(), lambda schema, table: t.contracts(), root, "run-1", "dot", "hub", audit_path=f"{root}/audit")
    log = t.spark.read.schema("transfer_session_id string, event_type string, outcome string").json(f"{root}/audit")
    events = log.groupBy(F.col("transfer_session_id").alias("request_id")).agg(joined(F.array_sort(F.collect_set("event_type")), "events"))
    return outcome.join(events, "request_id").select(
        "request_id", "decision", "first_violation", "action", "status", "row_count", "events")


@check("access_check", """
    SELECT request_id, CASE WHEN NOT list_contains(agencies, requesting_agency) THEN 'agency_not_allowed'
                            WHEN c_custkey % 5 = 0 THEN 'role_not_allowed' ELSE 'allowed' END AS access FROM governed""")
def access_check(t: Tables):
    rows = t.governed().withColumn("role", F.expr("CASE WHEN c_custkey % 5 = 0 THEN 'visitor' ELSE 'analyst' END"))
    return governance.access_check(rows, role="role").select("request_id", "access")


@check("schedule_window_check", """
    SELECT event_id, CASE event_id % 3 WHEN 0 THEN true WHEN 1 THEN (m >= 60 AND m < 300) OR (m >= 1080 AND m < 1380)
                          ELSE m >= 1320 OR m < 120 END AS in_window
    FROM (SELECT event_id, hour(ts) * 60 + minute(ts) AS m FROM events)""")
def schedule_window_check(t: Tables):
    windows = F.expr("""CASE event_id % 3 WHEN 0 THEN CAST(array() AS array<string>) WHEN 1 THEN array('01:00-05:00', '18:00-23:00')
        ELSE array('22:00-02:00') END""")
    rows = t.base("events").withColumn("schedule_constraints", F.struct(
        F.lit(True).alias("enabled"), windows.alias("allowed_utc_windows")))
    return governance.schedule_window_check(rows, "ts").select("event_id", "in_window")


@check("param_type_check", """
    SELECT request_id, array_to_string(list_sort([c FOR c IN [
        CASE WHEN c_custkey % 5 = 0 THEN 'filters:type' END, CASE WHEN c_custkey % 7 = 0 THEN 'amount:type' WHEN c_custkey % 50 < 5 THEN 'amount:min'
             WHEN c_custkey % 50 > 40 THEN 'amount:max' END, CASE WHEN c_custkey % 6 = 0 THEN 'day:type' END] IF c IS NOT NULL]), ',') AS type_violations
    FROM requests""")
def param_type_check(t: Tables):
    params = F.expr("""concat('{"schema":"dot","amount":', CASE WHEN c_custkey % 7 = 0 THEN '"x"' ELSE CAST(c_custkey % 50 AS STRING) END,
        ',"day":', CASE WHEN c_custkey % 6 = 0 THEN '"soon"' ELSE '"2026-01-31"' END,
        ',"filters":', CASE WHEN c_custkey % 5 = 0 THEN '[1]' ELSE '{"a":1}' END, '}')""")
    p = "named_struct('name', '{0}', 'type', '{1}', 'description', '', 'allowed_values', '[]', 'min', {2}, 'max', {3})"
    none = "CAST(NULL AS DOUBLE)"
    rows = t.requests().withColumn("params", params).withColumns({
        "required_params": F.expr(f"array({p.format('schema', 'string', none, none)})"),
        "optional_params": F.expr(f"""array({p.format('amount', 'integer', '5.0D', '40.0D')}, {p.format('day', 'date', none, none)},
            {p.format('filters', 'object', none, none)}, {p.format('absent', 'boolean', none, none)})""")})
    return governance.param_type_check(rows).select("request_id", joined("type_violations"))


@check("scoped_fingerprint", """
    SELECT request_id, sha256(CAST(to_json(CASE scope WHEN 'request_id' THEN [scope, request_id]
        WHEN 'dataproduct_plus_params' THEN [scope, dataproduct_id, canon] ELSE [scope, requesting_agency, canon] END) AS VARCHAR)) AS scoped_fingerprint
    FROM (SELECT *, concat('{"schema":"', schema_name, '","table":"contract_data"} OBJECT<schema: STRING, table: STRING>') AS canon
          FROM (SELECT *, concat('s', c_custkey % 3) AS schema_name FROM governed))""")
def scoped_fingerprint(t: Tables):
    params = F.expr("""concat('{ "table":"contract_data", "schema":"s', c_custkey % 3, '"}')""")
    return governance.scoped_fingerprint(t.governed().withColumn("params", params)).select("request_id", "scoped_fingerprint")


@check("manifest_required_fields", """
    SELECT request_id, CASE WHEN n % 2 = 1 THEN CASE WHEN c_custkey % 3 = 0 THEN 'checksum,record_count' ELSE 'record_count' END
                            WHEN c_custkey % 3 = 0 THEN 'checksum' ELSE '' END AS missing_manifest_fields FROM governed""")
def manifest_required_fields(t: Tables):
    present = F.expr("CASE WHEN c_custkey % 3 = 0 THEN array('transfer_session_id') ELSE array('transfer_session_id', 'checksum') END")
    rows = t.governed().withColumn("present", present)
    return governance.manifest_required_fields(rows, "present").select("request_id", joined("missing_manifest_fields"))


@check("retention_expired", """
    SELECT contract_id, award_date + CAST(1 + contract_id % 400 AS INT) < DATE '1998-01-01' AS expired FROM contracts""")
def retention_expired(t: Tables):
    rows = t.contracts().withColumn("retention_policy_days", 1 + F.col("contract_id") % 400)
    return governance.retention_expired(rows, "award_date", F.lit("1998-01-01").cast("date")).select("contract_id", "expired")


@check("fingerprint", "SELECT request_id, fingerprint FROM fingerprints")
def fingerprint(t: Tables):
    source = hashing.SourceIdentity(engine=" Parquet ")
    return t.extract_requests().select("request_id", hashing.fingerprint(
        F.col("params"), F.col("template_id"), F.col("row_limit"), F.col("timeout_seconds"), source).alias("fingerprint"))

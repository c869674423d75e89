"""Derived relations as DataFrames over the test tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.hashing import fingerprint
from tidegate.operators.integrity import file_checksums
from tidegate.operators.registry import active_definition, flatten_definitions, registry_lookup
from tidegate.session import path_exists, run_folder
from tidegate.sources.documents import DEFINITION_SCHEMA
from tidegate.sources.tables import scan_parquet

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def text_time(name: str, alias: str | None = None):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(alias or name)


def joined(name: str, alias: str | None = None):
    return F.array_join(name, ",").alias(alias or name)


class Tables:
    """The test tables below one folder and the relations derived from them."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._base: dict[str, DataFrame] = {}
        self._measured: DataFrame | None = None

    def base(self, name: str) -> DataFrame:
        """A test table; its schema is read from the files once per query."""
        if name not in self._base:
            self._base[name] = scan_parquet(self.spark, self.root, name)
        return self._base[name]

    def base_tables(self) -> dict[str, DataFrame]:
        return {name: self.base(name) for name in BASE_TABLES if path_exists(self.spark, f"{self.root}/{name}.parquet")}

    def contracts(self) -> DataFrame:
        joined = self.base("orders").join(self.base("customer"), F.col("o_custkey") == F.col("c_custkey"))
        return joined.selectExpr(
            "o_orderkey AS contract_id", "concat('PIID-', o_orderkey) AS piid", "c_name AS vendor_name",
            "o_totalprice AS contract_value", "CAST(o_orderdate AS DATE) AS award_date",
            "o_orderpriority AS contract_type", "c_mktsegment AS agency_code")

    def files(self) -> DataFrame:
        return self.base("documents").selectExpr(
            "source AS agency", "concat('sess-', (doc_id div 20) % 5) AS session",
            "concat('doc-', doc_id, '.txt') AS file_name", "text AS content",
            "CAST(octet_length(text) AS BIGINT) AS size", "doc_id",
            "CAST(substr(source, 4) AS INT) AS agency_no", "CAST((doc_id div 20) % 5 AS INT) AS session_no")

    def objects(self) -> DataFrame:
        return self.files().selectExpr("doc_id", "size", """
            CASE WHEN doc_id % 50 = 0 THEN concat('file_mode/outgoing/', agency, '/', session, '/')
                 WHEN doc_id % 37 = 0 THEN concat('file_mode/outgoing/', agency, '/', file_name, '.done')
                 WHEN doc_id % 41 = 0 THEN concat('file_mode/processed/', file_name)
                 WHEN doc_id % 43 = 0 THEN 'file_mode/outgoing/'
                 WHEN doc_id % 3 = 0 THEN concat('file_mode/outgoing/', file_name)
                 WHEN doc_id % 7 = 0 THEN concat('north/file_mode/outgoing/', agency, '/', file_name)
                 ELSE concat('file_mode/outgoing/', agency, '/', session, '/', file_name) END AS key""")

    def file_markers(self) -> DataFrame:
        return self.base("labels").where("quality = 1").select("doc_id")

    def measured(self) -> DataFrame:
        """Every file with size and checksum and without its text, written once per query."""
        if self._measured is None:
            folder = run_folder(self.spark, "measured")
            file_checksums(self.files()).write.parquet(folder)
            self._measured = self.spark.read.parquet(folder)
        return self._measured

    def session_markers(self, files: DataFrame | None = None) -> DataFrame:
        return (self.files() if files is None else files).where(
            "(agency_no + session_no) % 7 = 1 OR (agency_no + session_no) % 3 = 0"
        ).selectExpr(
            "agency", "session", "CASE WHEN (agency_no + session_no) % 7 = 1 THEN 'rejected' ELSE 'done' END AS kind"
        ).distinct()

    def blocklist(self) -> DataFrame:
        toxic = self.base("labels").where("toxic = 1").select("doc_id")
        return self.measured().join(toxic, "doc_id").select("sha256").distinct()

    def members(self) -> DataFrame:
        """Each file's checksum, without its text."""
        return self.measured().select("agency", "session", F.col("file_name").alias("member"), "sha256")

    def manifests(self) -> DataFrame:
        """One manifest per session, some broken on purpose, with its two entries."""
        k = self.measured().groupBy("agency", "session").agg(
            (F.min("agency_no") * 5 + F.min("session_no")).alias("k"), F.sum("size").alias("bytes"))
        return k.selectExpr(
            "agency", "session", "'1.0' AS manifest_version", "'sha256' AS checksum_algorithm", "'gzip' AS compression_type",
            "agency AS sender_agency",
            "CASE WHEN k % 17 = 3 THEN concat(session, '-x') ELSE session END AS transfer_session_id",
            "CASE WHEN k % 5 = 0 THEN '' WHEN k % 19 = 4 THEN 'other' ELSE 'hub' END AS receiver_agency",
            "CASE WHEN k % 13 = 2 THEN 3 WHEN k % 31 = 8 THEN 1 ELSE 2 END AS total_file_count",
            """slice(array(
                 named_struct('file_name', 'data.csv', 'file_size_bytes', bytes,
                              'checksum_sha256', sha2(concat('source', agency, session), 256)),
                 named_struct('file_name', 'transfer.tar.gz', 'file_size_bytes', bytes div 3 + 20, 'checksum_sha256',
                   CASE WHEN k % 11 = 5 THEN sha2('broken', 256) WHEN k % 23 = 6 THEN 'not-hex'
                        ELSE upper(sha2(concat(agency, session), 256)) END)),
               1, CASE WHEN k % 31 = 8 THEN 1 ELSE 2 END) AS files""")

    def archives(self) -> DataFrame:
        """Checksum of the archive that arrived for each session."""
        return self.files().select("agency", "session").distinct().withColumn(
            "sha256", F.sha2(F.concat("agency", "session"), 256))

    def transfers(self) -> DataFrame:
        """One source file and its archive per document."""
        return self.files().selectExpr(
            "agency", "concat(session, '-', doc_id) AS session", "file_name AS source_name", "size AS source_size",
            "sha2(content, 256) AS source_sha256", "'transfer.tar.gz' AS archive_name",
            "size div 3 + 20 AS archive_size", "sha2(concat(agency, session, doc_id), 256) AS archive_sha256")

    def definition_docs(self, broken: bool = False) -> DataFrame:
        """Product definitions as nested documents; ``broken`` adds one fault to half of them."""
        # A definition is many times the size of its part: deal the parts out whatever the number of table files.
        parts = self.base("part").select("p_partkey", "p_name", "p_size").repartition(
            self.spark.sparkContext.defaultParallelism, "p_partkey")
        parts = parts.selectExpr("*", "p_partkey % 40 AS n", f"{'p_partkey % 30' if broken else '-1'} AS b")
        param = "named_struct('name', '{0}', 'type', '{1}', 'description', '', 'allowed_values', {2}, 'min', {3}, 'max', {4})"

        def p(name: str, kind: str, allowed: str = "'[]'", low: str = "CAST(NULL AS DOUBLE)",
              high: str = "CAST(NULL AS DOUBLE)") -> str:
            return param.format(name, kind, allowed, low, high)

        schema, table = p("schema", "string", "'[\"dot\"]'"), p("table", "string", "'[\"contract_data\"]'")
        optional = f"{p('select_fields', 'array')}, {p('order_by', 'string')}"
        value_filter = "named_struct('field', 'contract_value', 'operators', array('min', 'max'))"
        date_filter = "named_struct('field', 'award_date', 'operators', array('min', 'max'))"
        none = "CAST(array() AS array<struct<field:string,operators:array<string>>>)"
        documents = parts.selectExpr(
            "concat('dp_', n) AS dataproduct_id", "CASE WHEN b = 10 THEN 'ab' ELSE p_name END AS name",
            """CASE WHEN b = 12 THEN '1' ELSE concat(CASE WHEN p_partkey % 9 = 0 THEN 'v' ELSE '' END, p_size % 3, '.',
                 (p_partkey div 40) % 13, CASE WHEN p_partkey % 2 = 0 THEN '.0' ELSE '' END) END AS version""",
            """CASE WHEN b = 13 THEN 'gone' WHEN n % 8 = 7 THEN 'draft' ELSE element_at(
                 array('active', 'draft', 'deprecated', 'retired'), CAST((p_partkey div 40) % 4 + 1 AS INT)) END AS status""",
            "CASE WHEN b = 2 THEN 'd' ELSE 'dot' END AS owner_agency",
            """named_struct('name', 'Data Owner', 'team', 'Systems', 'contact_email',
                 CASE WHEN b = 3 THEN 'nobody' ELSE 'owner@example.com' END) AS data_owner""",
            """named_struct('allowed_requesting_agencies',
                   transform(sequence(0, 11), i -> concat('agency', (p_partkey + i) % 40 % 25)),
                 'allowed_requesting_roles', array('analyst'), 'approval_policy', 'auto', 'classification_tags',
                 CASE WHEN b = 4 THEN array('CUI', 'CUI') ELSE array('CUI') END,
                 'retention_policy_days', CASE WHEN b = 9 THEN 0 ELSE 1 + p_partkey % 60 END) AS access""",
            f"""named_struct('source_type', CASE WHEN n % 10 = 9 THEN 'file' ELSE 'sql' END,
                 'engine', CASE WHEN p_partkey % 20 = 9 THEN 's3-file' ELSE 'postgres' END,
                 'template_id', CASE WHEN n % 11 = 10 THEN 'legacy_extract' ELSE 'dot_contract_extract_v1' END,
                 'required_params', CASE WHEN b = 11 THEN slice(array({schema}), 1, 0)
                     WHEN n % 13 = 12 THEN array({schema}, {table}, {p('purpose', 'string')})
                     ELSE array({schema}, {table}) END,
                 'optional_params', CASE WHEN n % 17 = 16 THEN array({optional})
                     ELSE array({optional}, {p('filters', 'object')}) END,
                 'default_row_limit', CASE WHEN b = 5 THEN 0 ELSE 1000 * (1 + p_partkey % 10) END, 'max_row_limit', 100000,
                 'default_timeout_seconds', 120, 'max_timeout_seconds', 300,
                 'allowed_select_fields', CASE WHEN n % 6 = 0 THEN CAST(array() AS array<string>) ELSE
                     array('contract_id', 'piid', 'vendor_name', 'contract_value', 'award_date') END,
                 'allowed_filters', CASE WHEN b = 6 THEN array(named_struct('field', 'x', 'operators', array('like')))
                     WHEN n % 5 = 0 THEN {none} WHEN n % 7 = 3 THEN array({date_filter})
                     ELSE array({value_filter}, {date_filter}) END) AS extraction""",
            """named_struct('output_format', CASE WHEN b = 8 THEN 'xml' ELSE 'csv' END, 'naming_convention', 'extract.csv',
                 'delivery_targets', array(named_struct('target_id', 'default', 'type', 's3', 'description', '')),
                 'manifest_requirements', CASE WHEN n % 2 = 0 THEN array('transfer_session_id', 'checksum')
                   ELSE array('transfer_session_id', 'checksum', 'record_count') END) AS delivery""",
            """named_struct('schedule_constraints', named_struct('enabled', n % 4 <> 3, 'allowed_utc_windows',
                   CASE WHEN b = 7 THEN array('25-30') ELSE CASE n % 4 WHEN 0 THEN CAST(array() AS array<string>)
                     WHEN 1 THEN array('01:00-05:00', '18:00-23:00') WHEN 2 THEN array('22:00-02:00')
                     ELSE array('00:00-00:01') END END),
                 'idempotency_scope', element_at(array('dataproduct_plus_params', 'request_id', 'requester_plus_params'),
                   CAST(p_partkey % 3 + 1 AS INT)), 'audit_level', 'standard',
                 'notifications', CASE WHEN b = 14 THEN NULL ELSE named_struct('on_request', CAST(array() AS array<string>),
                   'on_success', CAST(array() AS array<string>), 'on_failure', array('ops@example.com')) END) AS operations""",
            "concat('definitions/', lpad(CAST(p_partkey AS STRING), 12, '0'), '.json') AS path", "b")
        return documents if broken else documents.drop("b")

    def definition_texts(self, broken: bool = False) -> DataFrame:
        """The documents as JSON text and as read back from it."""
        documents = self.definition_docs(broken)
        if not broken:
            documents = documents.withColumn("b", F.lit(-1))
        fields = [name for name in documents.columns if name not in ("path", "b")]
        text = F.to_json(F.struct(*fields))
        for allowed in ('["dot"]', '["contract_data"]', "[]"):  # lists, not their text
            text = F.replace(text, F.lit(f'"allowed_values":{json.dumps(allowed)}'), F.lit(f'"allowed_values":{allowed}'))
        raw = F.when(F.col("b") == 15, F.concat(F.lit('{"color":1,'), F.substring(text, 2, 1 << 30))).otherwise(text)
        return documents.select("path", raw.alias("raw")).withColumn("doc", F.from_json("raw", DEFINITION_SCHEMA)).select(
            "path", "raw", "doc.*")

    def definitions(self) -> DataFrame:
        return flatten_definitions(self.definition_docs())

    def active(self) -> DataFrame:
        return active_definition(self.definitions())

    def requests(self) -> DataFrame:
        return self.base("customer").selectExpr(
            "c_custkey", "concat('REQ-', 100000 + c_custkey) AS request_id",
            "CASE WHEN c_custkey % 3 = 0 THEN concat(' DP_', c_custkey % 45, ' ') ELSE concat('dp_', c_custkey % 45) END AS dataproduct_id",
            "concat('agency', c_nationkey) AS requesting_agency", "c_name AS requested_by",
            "CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_custkey * 90 END AS requested_row_limit",
            "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 60 + (c_custkey % 10) * 40 END AS requested_timeout_seconds",
            """concat('{"schema":"', CASE WHEN c_custkey % 14 = 0 THEN ' ' ELSE 'dot' END,
                 '","table":"', CASE WHEN c_custkey % 16 = 0 THEN 'other' ELSE 'contract_data' END, '"',
                 CASE WHEN c_custkey % 10 = 0 THEN ',"rogue":"x"' ELSE '' END,
                 CASE WHEN c_custkey % 8 = 0 THEN ',"select_fields":["contract_id","secret"]'
                      ELSE ',"select_fields":["contract_id","vendor_name"]' END,
                 CASE WHEN c_custkey % 12 = 0 THEN ',"filters":{"contract_value":{"like":1}}'
                      ELSE ',"filters":{"contract_value":{"min":1000}}' END, '}') AS params""")

    def governed(self) -> DataFrame:
        """Requests of known products with their product's columns."""
        return registry_lookup(self.requests(), self.active()).where("known_product")

    def raw_requests(self) -> DataFrame:
        return self.base("customer").selectExpr("c_custkey", """
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
                     WHEN 24 THEN ',"justification":" audit "' ELSE ',"requested_row_limit":500' END, '}') END AS raw""")

    def extract_requests(self) -> DataFrame:
        return self.base("customer").selectExpr(
            "c_custkey", "c_mktsegment", "concat('REQ-', 100000 + c_custkey) AS request_id", "concat('sess-', c_custkey % 97) AS session",
            "'dot_contract_extract_v1' AS template_id", "1000 * (1 + c_custkey % 10) AS row_limit",
            "60 * (1 + c_custkey % 3) AS timeout_seconds",
            """concat('{"table":"contract_data","schema":"dot","filters":{"contract_value":{"min":',
                 CASE WHEN c_custkey % 7 = 0 THEN '1000' ELSE CAST(1000 * (c_custkey % 4) AS STRING) END,
                 '}},"select_fields":["piid","contract_id"]}') AS params""")

    def fingerprints(self) -> DataFrame:
        return self.extract_requests().withColumn("fingerprint", fingerprint(
            F.col("params"), F.col("template_id"), F.col("row_limit"), F.col("timeout_seconds")))

    def done_fingerprints(self) -> DataFrame:
        return self.fingerprints().where("c_mktsegment = 'BUILDING' AND timeout_seconds = 60").select("fingerprint").distinct()

    def audit(self, events: DataFrame | None = None) -> DataFrame:
        events = self.base("events") if events is None else events
        return events.selectExpr(
            "event_id", "CAST(ts AS TIMESTAMP) AS timestamp", "concat('transfer-', user_id) AS transfer_session_id",
            """CASE event_type WHEN 'signup' THEN 'pipeline_start' WHEN 'view' THEN 'extract_data'
                 WHEN 'click' THEN 'compress' WHEN 'purchase' THEN 'pipeline_complete'
                 ELSE 'sftp_transfer_complete' END AS event_type""",
            "CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS outcome",
            "CAST(floor(value * 100) AS BIGINT) AS bytes_transferred", "props AS details")

    def job_events(self, conversations: DataFrame | None = None) -> DataFrame:
        conversations = self.base("conversations") if conversations is None else conversations
        return conversations.selectExpr(
            "conv_id AS job", "turn AS seq",
            """CASE WHEN turn = 0 THEN CASE WHEN conv_id % 17 = 3 THEN 'running' ELSE 'pending' END
                    WHEN turn = 1 THEN CASE WHEN conv_id % 7 = 0 THEN 'cancelled' ELSE 'running' END
                    WHEN turn = 2 THEN CASE WHEN conv_id % 5 = 0 THEN 'failed'
                                            WHEN conv_id % 11 = 0 THEN 'pending' ELSE 'sent' END
                    WHEN turn = 3 THEN CASE WHEN conv_id % 17 = 3 THEN 'pending' ELSE 'running' END
                    ELSE CASE WHEN conv_id % 3 = 0 THEN 'sent' ELSE 'running' END END AS status""",
            "CASE WHEN conv_id % 13 = 4 THEN NULL ELSE sha2(text, 256) END AS result",
            "CASE WHEN conv_id % 25 = 5 THEN '' ELSE concat('error-', role) END AS error")

    def runs(self) -> DataFrame:
        return self.base("events").selectExpr(
            "event_type AS agent", "event_id AS run_id", "ts AS start_ts",
            "ts + make_dt_interval(0, 0, CAST(floor(value) AS INT)) AS end_ts")

"""Scans, filters, projection, order, caps and run summaries."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tidegate.contracts import ExtractSpec, parse_filters
from tidegate.operators import aggregates, extract
from tidegate.plans.shared import extract_all
from tidegate.session import run_folder
from tidegate.sources import tables as sources

from .registry import check
from .tables import BASE_TABLES, Tables

CONTRACT_SQL = """contract_id, piid, vendor_name, contract_value, strftime(award_date, '%Y-%m-%d') AS award_date,
       contract_type, agency_code"""


def shown(df):
    """Dates as text, the form both engines print alike."""
    return df.withColumn("award_date", F.date_format("award_date", "yyyy-MM-dd")) if "award_date" in df.columns else df


@check("scan_table", "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM lineitem")
def scan_table(t: Tables):
    name = sources.attach_folder(t.spark, t.root, ["lineitem"])
    line = sources.scan_table(t.spark, name, "lineitem")
    return line.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"))


@check("table_inventory", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in sorted(BASE_TABLES)))
def table_inventory(t: Tables):
    return sources.table_inventory(t.base_tables())


@check("table_preview", """SELECT o_orderkey, o_custkey, o_totalprice, (SELECT count(*) FROM orders) AS total_rows
    FROM orders ORDER BY o_orderkey LIMIT 20""")
def table_preview(t: Tables):
    return sources.table_preview(t.base("orders").select("o_orderkey", "o_custkey", "o_totalprice"), ["o_orderkey"], 20)


_ORDER_COLUMNS = [
    ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
    ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"),
]


@check("column_profile", " UNION ALL ".join(
    f"""SELECT '{name}' AS column_name, {i} AS ordinal, '{kind}' AS data_type, true AS nullable,
        count(*) - count({name}) AS null_count, count(DISTINCT {name}) AS distinct_count FROM orders"""
    for i, (name, kind) in enumerate(_ORDER_COLUMNS, start=1)))
def column_profile(t: Tables):
    orders = t.base("orders")
    return sources.column_profile(orders, exact=orders.columns)


@check("column_profile_merged", " UNION ALL ".join(
    f"""SELECT '{name}' AS column_name, {i} AS ordinal, count(*) - count({name}) AS null_count, true AS within_bound FROM orders"""
    for i, (name, _) in enumerate(_ORDER_COLUMNS, start=1)))
def column_profile_merged(t: Tables):
    """Sketches of two parts of a table, stored and merged, within 3 % (about four standard deviations) of the exact counts."""
    orders, folder = t.base("orders"), run_folder(t.spark, "sketches")
    for part in ("o_orderkey % 3 = 0", "o_orderkey % 3 <> 0 OR o_orderkey IS NULL"):
        sources.profile_sketches(orders.where(part)).write.mode("append").parquet(folder)
    merged = sources.merge_profiles(t.spark.read.parquet(folder))
    exact = sources.column_profile(orders, exact=orders.columns).select("column_name", F.col("distinct_count").alias("exact"))
    return merged.join(exact, "column_name").select(
        "column_name", "ordinal", "null_count", (F.abs(F.col("distinct_count") - F.col("exact")) <= 0.03 * F.col("exact")).alias("within_bound"))


_CUT_COLUMNS = ["o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_custkey"]


@check("scan_jdbc_parts", " UNION ALL ".join(
    f"SELECT '{name}' AS column_name, count(*) AS total, 1 AS least, 1 AS most FROM orders" for name in _CUT_COLUMNS))
def scan_jdbc_parts(t: Tables):
    """Equal-depth predicates applied to the table: each row meets exactly one."""
    orders = t.base("orders").withColumn("o_custkey", F.expr("CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE o_custkey END"))
    met = {name: sources.partition_predicates(orders, name, 16, "`", "") for name in _CUT_COLUMNS}
    hits = {name: sum((F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in found), F.lit(0)) for name, found in met.items()}
    rows = orders.select(F.inline(F.array(*[F.struct(F.lit(name).alias("column_name"), n.alias("hits")) for name, n in hits.items()])))
    return rows.groupBy("column_name").agg(F.count("*").alias("total"), F.min("hits").alias("least"), F.max("hits").alias("most"))


@check("enum_domain", "SELECT DISTINCT event_type AS label FROM events WHERE event_type IS NOT NULL")
def enum_domain(t: Tables):
    return sources.enum_domain(t.base("events"), "event_type")


@check("filter_min", f"SELECT {CONTRACT_SQL} FROM contracts WHERE contract_value >= 200000")
def filter_min(t: Tables):
    return shown(extract.filter_min(t.contracts(), "contract_value", 200000))


@check("filter_max", f"SELECT {CONTRACT_SQL} FROM contracts WHERE award_date <= DATE '1996-06-30'")
def filter_max(t: Tables):
    return shown(extract.filter_max(t.contracts(), "award_date", "1996-06-30"))


@check("filter_ranges", f"""SELECT {CONTRACT_SQL} FROM contracts WHERE contract_value >= 100000 AND contract_value <= 300000.5
    AND award_date >= DATE '1996-01-01' AND award_date <= DATE '1997-12-31' AND contract_id <= 9000""")
def filter_ranges(t: Tables):
    return shown(extract.filter_ranges(t.contracts(), parse_filters({
        "contract_value": {"min": 100000, "max": 300000.5},
        "award_date": {"min": "1996-01-01", "max": "1997-12-31"}, "contract_id": {"max": 9000.7}})))


@check("filter_equal", f"SELECT {CONTRACT_SQL} FROM contracts WHERE contract_type = '1-URGENT'")
def filter_equal(t: Tables):
    return shown(extract.filter_equal(t.contracts(), "contract_type", "1-URGENT"))


@check("filter_in", f"SELECT {CONTRACT_SQL} FROM contracts WHERE agency_code IN ('BUILDING', 'MACHINERY')")
def filter_in(t: Tables):
    return shown(extract.filter_in(t.contracts(), "agency_code", ["BUILDING", "MACHINERY"]))


@check("project_fields", "SELECT vendor_name, contract_id, contract_value FROM contracts")
def project_fields(t: Tables):
    return extract.project_fields(t.contracts(), ["vendor_name", "contract_id", "contract_value"])


FLAGSHIP = {
    "template_id": "dot_contract_extract_v1", "row_limit": 100, "timeout_seconds": 120,
    "params": {
        "schema": "dot", "table": "contract_data",
        "filters": {"contract_value": {"min": 200000}, "award_date": {"min": "1996-01-01"}},
        "select_fields": ["contract_id", "piid", "vendor_name", "contract_value", "award_date"],
        "order_by": "award_date DESC",
    },
}


@check("governed_extract", """SELECT contract_id, piid, vendor_name, contract_value, strftime(award_date, '%Y-%m-%d') AS award_date
    FROM contracts WHERE contract_value >= 200000 AND award_date >= DATE '1996-01-01'
    ORDER BY contracts.award_date DESC, contract_id LIMIT 100""")
def governed_extract(t: Tables):
    spec = ExtractSpec.from_json(json.dumps(FLAGSHIP)).check_template()
    return shown(extract.governed_extract(t.contracts(), spec, key=("contract_id",)))


@check("order_by_field", "SELECT contract_id, contract_value, agency_code FROM contracts")
def order_by_field(t: Tables):
    """The whole table in order; the unit tests look at the order itself, which a row comparison does not see."""
    return extract.order_by_field(t.contracts(), "agency_code", False, ("contract_id",)).select(
        "contract_id", "contract_value", "agency_code")


@check("limit_rows", """SELECT least(count(*), 30000) AS row_count, least(count(*), 30000) AS known_rows FROM lineitem""")
def limit_rows(t: Tables):
    """Which rows an unordered cap keeps is open, so the check counts them and how many of them the table has."""
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    line = t.base("lineitem").select(*key)
    kept = extract.limit_rows(line, 30_000)
    known = kept.join(line.distinct(), key, "left_semi").agg(F.count("*").alias("known_rows"))
    return kept.agg(F.count("*").alias("row_count")).withColumn("known_rows", known.scalar())


@check("topk_extract", """SELECT l_orderkey, l_linenumber, l_extendedprice, l_partkey FROM lineitem
    ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 30000""")
def topk_extract(t: Tables):
    line = t.base("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey")
    return extract.topk_extract(line, "l_extendedprice", 30_000, True, ("l_orderkey", "l_linenumber", "l_partkey"))


@check("join_inner_equi", """SELECT o_orderkey, c_name, n_name, r_name FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def join_inner_equi(t: Tables):
    orders = aggregates.join_inner_equi(t.base("orders"), t.base("customer"), [("o_custkey", "c_custkey")])
    nations = aggregates.join_inner_equi(t.base("nation"), t.base("region"), [("n_regionkey", "r_regionkey")])
    return aggregates.join_inner_equi(orders, nations, [("c_nationkey", "n_nationkey")]).select(
        "o_orderkey", "c_name", "n_name", "r_name")


@check("count_rows", "SELECT count(*) AS row_count FROM lineitem")
def count_rows(t: Tables):
    return aggregates.count_rows(t.base("lineitem"))


@check("key_uniqueness", """SELECT l_orderkey, l_linenumber, count(*) AS n, 'duplicate_key' AS violation
    FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def key_uniqueness(t: Tables):
    return aggregates.key_uniqueness(t.base("lineitem"), ["l_orderkey", "l_linenumber"])


def _segment_contracts(t: Tables):
    """One contract per agency in use, and one of them twice."""
    labels = sources.enum_domain(t.base("customer"), "c_mktsegment")
    labels = labels.withColumn("contract_id", F.col("label")).unionByName(
        labels.agg(F.min("label").alias("label")).withColumn("contract_id", F.concat("label", F.lit(" again"))))
    return labels.selectExpr(
        "contract_id", "'dot_contract_extract_v1' AS template_id", "CAST(100000 AS BIGINT) AS row_limit", "CAST(300 AS BIGINT) AS timeout_seconds",
        """concat('{"schema":"dot","table":"contract_data","order_by":"contract_value desc","filters":{"contract_value":{"min":200000},',
            '"agency_code":{"equal":"', label, '"}},"select_fields":["contract_id","vendor_name","contract_value"]}') AS params""")


_SEGMENT_CANON = """concat('{"filters":{"agency_code":{"equal":"', agency_code, '"},"contract_value":{"min":200000}},',
    '"order_by":"contract_value desc","schema":"dot","select_fields":["contract_id","vendor_name","contract_value"],',
    '"table":"contract_data"} OBJECT<filters: OBJECT<agency_code: OBJECT<equal: STRING>, ',
    'contract_value: OBJECT<min: BIGINT>>, order_by: STRING, schema: STRING, select_fields: ARRAY<STRING>, table: STRING>')"""


@check("extract_summary", f"""
    SELECT fingerprint, concat('query_mode/processed/dot_contract_extract_v1/', fingerprint, '.done') AS marker_key,
           CASE WHEN skipped THEN '' ELSE concat('query_mode/outgoing/run-1/dot_contract_extract_v1_', substr(fingerprint, 1, 12), '_results.csv') END AS output_key,
           CASE WHEN skipped THEN 0 ELSE n END AS row_count, NOT skipped AS has_bytes, skipped,
           CASE WHEN skipped THEN 'skipped' ELSE 'done' END AS status
    FROM (SELECT agency_code, count(*) AS n, sha256(CAST(to_json(['fp1', 'parquet', '', '', '', '',
            'dot_contract_extract_v1', '100000', '300', {_SEGMENT_CANON}]) AS VARCHAR)) AS fingerprint
          FROM contracts WHERE contract_value >= 200000 GROUP BY agency_code) s
    JOIN (VALUES (false), (true)) v(skipped) ON NOT skipped OR agency_code = (SELECT min(c_mktsegment) FROM customer)""")
def extract_summary(t: Tables):
    summary = extract_all(
        t.spark, _segment_contracts(t), lambda schema, table: t.contracts(), run_folder(t.spark, "extracts"), "run-1",
        lambda schema, table: ("contract_id",))
    return summary.select(
        "fingerprint", "marker_key", "output_key", "row_count", (F.col("file_size_bytes") > 0).alias("has_bytes"),
        "skipped", "status")

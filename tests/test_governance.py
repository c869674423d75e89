"""Registry choice and request checks on hand-made rows."""

import json

import pytest
from pyspark.sql import functions as F

from checks.tables import Tables
from tidegate.operators import governance, registry
from tidegate.sources import documents


def definition(dataproduct_id="dp_one", version="1.0.0", status="active", **extraction):
    param = lambda name, allowed=(): {"name": name, "type": "string", "allowed_values": list(allowed)}
    return {
        "dataproduct_id": dataproduct_id, "name": "One", "version": version, "status": status, "owner_agency": "dot",
        "data_owner": {"name": "Owner", "team": "Team", "contact_email": "a@example.com"},
        "access": {"allowed_requesting_agencies": ["north"], "approval_policy": "auto", "classification_tags": ["CUI"],
                   "retention_policy_days": 30},
        "extraction": {
            "source_type": "sql", "engine": "postgres", "template_id": "dot_contract_extract_v1",
            "required_params": [param("schema", ["dot"]), param("table")],
            "optional_params": [{"name": n, "type": t} for n, t in (
                ("select_fields", "array"), ("filters", "object"), ("order_by", "string"))],
            "default_row_limit": 500, "max_row_limit": 1000, "default_timeout_seconds": 60, "max_timeout_seconds": 120,
            "allowed_select_fields": ["a", "b"], "allowed_filters": [{"field": "a", "operators": ["min"]}], **extraction},
        "delivery": {"output_format": "csv", "naming_convention": "x.csv", "manifest_requirements": ["checksum"],
                     "delivery_targets": [{"target_id": "one", "type": "s3"}]},
        "operations": {"idempotency_scope": "request_id", "audit_level": "standard",
                       "notifications": {"on_request": [], "on_success": [], "on_failure": []}},
    }


@pytest.fixture
def load(spark, tmp_path):
    def write(*docs):
        for i, doc in enumerate(docs):
            (tmp_path / f"{i:03}.json").write_text(json.dumps(doc, indent=2))
        return documents.read_definitions(spark, str(tmp_path))
    return write


def test_empty_folder_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        documents.read_definitions(spark, str(tmp_path))


def test_active_definition(load):
    docs = load(
        definition("dp_one", "1.9"), definition("dp_one", "v1.10.0"), definition("dp_one", "2.0", "draft"),
        definition("dp_two", "0.1", "retired"), definition("dp_two", "0.2", "draft"),
        definition("dp_tie", "1.2"), definition("dp_tie", "1.2.0"))
    chosen = registry.active_definition(registry.flatten_definitions(docs)).collect()
    assert {r["dataproduct_id"]: r["version"] for r in chosen} == {"dp_one": "v1.10.0", "dp_two": "0.2", "dp_tie": "1.2"}


def test_definitions_are_closed_and_typed_at_every_level(spark):
    def change(path, value):
        doc = definition()
        *parents, last = path
        place = doc
        for key in parents:
            place = place[key]
        place[last] = value
        return doc

    broken = {
        "document:unexpected_key": change(["more"], 1), "data_owner:unexpected_key": change(["data_owner", "x"], 1),
        "operations.notifications:unexpected_key": change(["operations", "notifications", "on_skip"], []),
        "operations.schedule_constraints:unexpected_key": change(["operations", "schedule_constraints"], {"enabled": True, "allowed_utc_windows": [], "x": 1}),
        "extraction.required_params:item_unexpected_key": change(["extraction", "required_params", 0, "x"], 1),
        "extraction.optional_params:item_unexpected_key": change(["extraction", "optional_params", 1, "x"], None),
        "extraction.allowed_filters:item_unexpected_key": change(["extraction", "allowed_filters", 0, "x"], 1),
        "delivery.delivery_targets:item_unexpected_key": change(["delivery", "delivery_targets", 0, "x"], 1),
        "extraction.max_row_limit:type": change(["extraction", "max_row_limit"], "1000"),
        "access.retention_policy_days:type": change(["access", "retention_policy_days"], 1.5),
        "access.classification_tags:type": change(["access", "classification_tags"], ["CUI", 5]),
        "name:type": change(["name"], 12345), "delivery:type": change(["delivery"], "csv"),
        "operations.schedule_constraints.enabled:type": change(["operations", "schedule_constraints"], {"enabled": "yes", "allowed_utc_windows": []}),
        "extraction.required_params:item_kind": change(["extraction", "required_params", 0, "name"], 5),
    }
    rows = [("ok", json.dumps(definition())), ("mixed", json.dumps(change(["extraction", "required_params", 0, "allowed_values"], ["a", 1, True, 2.5])))]
    df = spark.createDataFrame(rows + [(code, json.dumps(doc)) for code, doc in broken.items()], "code string, raw string")
    typed = df.select("code", "raw", F.from_json("raw", documents.DEFINITION_SCHEMA).alias("d")).select("code", "raw", "d.*")
    found = {r["code"]: r["violations"] for r in registry.definition_schema_check(typed, "raw").collect()}
    assert found["ok"] == [] == found["mixed"]
    for code in broken:
        assert code in found[code], (code, found[code])
        assert not code.endswith(":type") or code.replace(":type", ":missing") not in found[code]


@pytest.mark.parametrize("allowed, value, fine", [
    ('["5"]', "5", False), ('["5"]', '"5"', True), ("[5]", "5", True), ("[5]", "5.0", True), ("[5]", '"5"', False), ("[0.5, 1]", "0.50", True),
    ("[true]", "true", True), ("[true]", '"true"', False), ("[false]", "0", True), ("[]", '"any"', True), ('["a"]', "null", False),
    ('["a"]', '["a"]', False), ('["a", 1, true]', '"a"', True), ("[12345678901234567890]", "12345678901234567890", True),
])
def test_allowed_values_keep_their_types(spark, load, allowed, value, fine):
    doc = definition(required_params=[{"name": "schema", "type": "string", "allowed_values": json.loads(allowed)}])
    active = registry.flatten_definitions(load(doc))
    rows = spark.createDataFrame([("dp_one", '{"schema": %s}' % value)], "dataproduct_id string, params string")
    checked = governance.param_values(registry.registry_lookup(rows, active)).first()
    assert checked["bad_values"] == ([] if fine else ["schema"])


def test_types_of_fields_come_from_one_walk(spark):
    """Paths into the whole document, one per rule, walk it again and again."""
    df = spark.createDataFrame([(json.dumps(definition()),)], "raw string").select("raw", F.from_json("raw", documents.DEFINITION_SCHEMA).alias("d"))
    checked = registry.definition_schema_check(df.select("raw", "d.*"), "raw")
    plan = checked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_variant_get") < 40
    assert checked.columns == ["raw", *df.select("d.*").columns, "violations"] and checked.first()["violations"] == []


def test_definitions_are_dealt_out(spark, tmp_path):
    """One small file of parts must not be one task of definitions."""
    rows = spark.range(0, 400, 1, 1).selectExpr("id AS p_partkey", "concat('part ', id) AS p_name", "CAST(id % 7 AS INT) AS p_size")
    rows.write.parquet(f"{tmp_path}/part.parquet")
    texts = Tables(spark, str(tmp_path)).definition_texts(broken=True)
    assert texts.select(F.spark_partition_id().alias("task")).distinct().count() > 1


def test_active_definition_sorts_no_whole_definitions(spark, load):
    """Keys and order are aggregated first; of the definitions only those in force are sorted."""
    docs = [definition(version=f"1.{n}", dataproduct_id=f"dp_{n % 3}") for n in range(30)] + [definition(version="9.0", status="draft")]
    flat = registry.flatten_definitions(load(*docs))
    found = registry.active_definition(flat.unionByName(flat).unionByName(flat.withColumn("dataproduct_id", F.lit(None).cast("string"))))
    assert {(r["dataproduct_id"], r["version"]) for r in found.collect()} == {("dp_0", "1.27"), ("dp_1", "1.28"), ("dp_2", "1.29"), ("dp_one", "9.0"), (None, "1.29")}
    assert found.count() == 5 and found.columns == flat.columns
    assert "Aggregate" not in found._jdf.queryExecution().executedPlan().toString()


def test_valid_definition_has_no_violations(load):
    checked = registry.definition_schema_check(load(definition()))
    assert checked.first()["violations"] == []


def test_wrong_types_and_missing_sections(load):
    doc = definition()
    del doc["operations"], doc["delivery"]
    doc["version"], doc["extraction"]["max_row_limit"] = "one", 0
    codes = registry.definition_schema_check(load(doc)).first()["violations"]
    assert "version:pattern" in codes and "extraction.max_row_limit:range" in codes
    assert "operations.idempotency_scope:missing" in codes and "delivery.output_format:missing" in codes


REQUEST_COLUMNS = (
    "request_id string, dataproduct_id string, requesting_agency string, params string, "
    "requested_row_limit bigint, requested_timeout_seconds bigint")


def decide(spark, load, params, definition_doc=None, **columns):
    active = registry.active_definition(registry.flatten_definitions(load(definition_doc or definition())))
    request = {"request_id": "REQ-1", "dataproduct_id": " DP_ONE ", "requesting_agency": "north", "params": params,
               "requested_row_limit": None, "requested_timeout_seconds": None, **columns}
    df = spark.createDataFrame([tuple(request.values())], REQUEST_COLUMNS)
    return governance.request_decision(df, active).first()


GOOD = {"schema": "dot", "table": "t"}


PARAM_CASES = [
    (GOOD, []),
    ({**GOOD, "select_fields": ["a"], "filters": {"a": {"min": 1}}}, []),
    ({**GOOD, "filters": {}}, []),
    ({"schema": "dot"}, ["missing_param:table", "template_params_missing"]),
    ({"schema": "dot", "table": None}, ["missing_param:table", "template_params_missing"]),
    ({"schema": "dot", "table": "  "}, ["missing_param:table", "template_params_missing"]),
    ({"schema": "dot", "table": 0}, []),
    ({"schema": "dot", "table": []}, []),
    ({"schema": "x", "table": "t"}, ["param_value:schema"]),
    ({**GOOD, "z": 1, "y": 2}, ["unknown_param:y", "unknown_param:z"]),
    ({**GOOD, "select_fields": "a"}, ["select_field:not_array"]),
    ({**GOOD, "select_fields": None}, ["select_field:not_array"]),
    ({**GOOD, "select_fields": ["c", "a", "b2"]}, ["select_field:b2", "select_field:c"]),
    ({**GOOD, "filters": [1]}, ["filter:not_object"]),
    ({**GOOD, "filters": {"b": {"min": 1}}}, ["filter:b"]),
    ({**GOOD, "filters": {"a": 5}}, ["filter:a:not_object"]),
    ({**GOOD, "filters": {"a": {"max": 5, "in": [1]}}}, ["filter:a.in", "filter:a.max"]),
]


def test_param_rules(spark, load):
    active = registry.active_definition(registry.flatten_definitions(load(definition())))
    rows = [(str(i), "dp_one", "north", json.dumps(params), None, None) for i, (params, _) in enumerate(PARAM_CASES)]
    decided = governance.request_decision(spark.createDataFrame(rows, REQUEST_COLUMNS), active).collect()
    got = {int(r["request_id"]): (r["violations"], r["decision"]) for r in decided}
    for i, (params, expected) in enumerate(PARAM_CASES):
        assert got[i] == (expected, "rejected" if expected else "accepted"), params


def test_empty_allow_lists_are_no_restriction(spark, load):
    doc = definition(allowed_select_fields=[], allowed_filters=[])
    row = decide(spark, load, json.dumps({**GOOD, "select_fields": ["zz"], "filters": {"q": {"like": 1}}}), doc)
    assert row["violations"] == []


@pytest.mark.parametrize("params", ["[1]", "{", "5", None])
def test_unreadable_params(spark, load, params):
    assert decide(spark, load, params)["first_violation"] == "params_not_object"


def test_limits(spark, load):
    row = decide(spark, load, json.dumps(GOOD))
    assert (row["effective_row_limit"], row["effective_timeout_seconds"]) == (500, 60)
    row = decide(spark, load, json.dumps(GOOD), requested_row_limit=1001, requested_timeout_seconds=121)
    assert row["violations"] == ["row_limit_exceeds_cap", "timeout_exceeds_cap"] and row["effective_row_limit"] is None


def test_unknown_product_and_file_product(spark, load):
    assert decide(spark, load, json.dumps(GOOD), dataproduct_id="nope")["violations"] == ["unknown_dataproduct"]
    row = decide(spark, load, json.dumps(GOOD), definition(source_type="file", engine="s3-file"))
    assert row["first_violation"] == "source_type_mismatch"


def request(**changes):
    base = {"request_id": "REQ-0001", "dataproduct_id": "dp_one", "requesting_agency": "north", "requested_by": "someone",
            "params": {"schema": "dot"}}
    return {k: v for k, v in {**base, **changes}.items() if v is not ...}


SCHEMA_CASES = [
    ({}, []),
    ({"justification": "  "}, ["justification:type"]),
    ({"justification": None}, ["justification:type"]),
    ({"delivery_target_id": ""}, ["delivery_target_id:type"]),
    ({"requested_by": ...}, ["requested_by:missing"]),
    ({"requested_by": 7}, ["requested_by:type"]),
    ({"params": {}}, ["params:empty"]),
    ({"params": None}, ["params:type"]),
    ({"metadata": {"a": None}}, ["metadata:not_scalar"]),
    ({"metadata": {"a": [1]}}, ["metadata:not_scalar"]),
    ({"metadata": {"a": 1.5, "b": True, "c": "x"}}, []),
    ({"requested_row_limit": 5.0}, []),
    ({"requested_row_limit": 5.5}, ["requested_row_limit:type"]),
    ({"requested_row_limit": 10**9}, ["requested_row_limit:range"]),
    ({"requested_row_limit": 10**25}, ["requested_row_limit:range"]),
    ({"requested_timeout_seconds": True}, ["requested_timeout_seconds:type"]),
    ({"request_id": "  R-1 "}, ["request_id:length"]),
    ({"request_id": "REQ 0001"}, ["request_id:pattern"]),
    ({"color": 1}, ["document:unexpected_key"]),
]


def test_request_schema(spark):
    rows = [(i, json.dumps(request(**changes))) for i, (changes, _) in enumerate(SCHEMA_CASES)]
    raw = spark.createDataFrame(rows, "i int, raw string")
    got = {r["i"]: r["schema_violations"] for r in governance.request_schema_check(documents.read_requests(raw)).collect()}
    for i, (changes, expected) in enumerate(SCHEMA_CASES):
        assert got[i] == expected, changes


def test_request_normalization(spark):
    raw = spark.createDataFrame([(json.dumps(request(dataproduct_id=" DP_One\n", delivery_target_id=" x ")),)], "raw string")
    row = documents.read_requests(raw).first()
    assert row["dataproduct_id"] == "dp_one" and row["delivery_target_id"] == "x" and json.loads(row["params"]) == {"schema": "dot"}


@pytest.mark.parametrize("time, inside", [
    ("21:59", False), ("22:00", True), ("23:59", True), ("00:00", True), ("01:59", True), ("02:00", False)])
def test_window_wraps_midnight(spark, time, inside):
    moment = F.lit(f"2024-05-05 {time}:00").cast("timestamp")
    column = governance.in_schedule_window(moment, F.array(F.lit("22:00-02:00")), F.lit(True))
    assert spark.range(1).select(column.alias("x")).first()["x"] is inside


FILE_CASES = [
    ({"s3_path": " s3://b/in/x.csv "}, [], ("b", "in/x.csv", "x.csv", "s3://b/in/")),
    ({"s3_path": "s3://b/x.csv", "file_name": " y.csv "}, [], ("b", "x.csv", "y.csv", "s3://b/")),
    ({"s3_path": "s3://b/x.csv", "file_name": 7}, [], ("b", "x.csv", "x.csv", "s3://b/")),
    ({"s3_path": "s3://b"}, ["s3_path:invalid"], None),
    ({"s3_path": "/tmp/x"}, ["s3_path:other_scheme"], None),
    ({"s3_path": 5}, ["s3_path:missing_path"], None),
    ({}, ["missing_param:s3_path", "s3_path:missing_path"], None),
    ({"s3_path": "s3://b/x", "rogue": 1}, ["unknown_param:rogue"], None),
]


def test_file_requests(spark, load):
    doc = definition(
        source_type="file", engine="s3-file", required_params=[{"name": "s3_path", "type": "string"}],
        optional_params=[{"name": "file_name", "type": "string"}])
    active = registry.active_definition(registry.flatten_definitions(load(doc, definition("dp_sql"))))
    rows = [(str(i), "dp_one", "north", json.dumps(p), None, None) for i, (p, _, _) in enumerate(FILE_CASES)]
    rows += [("sql", "dp_sql", "north", json.dumps(GOOD), None, None), ("no", "dp_no", "north", "{}", None, None)]
    decided = governance.file_request_decision(spark.createDataFrame(rows, REQUEST_COLUMNS), active).collect()
    got = {r["request_id"]: r for r in decided}
    for i, (params, violations, resolved) in enumerate(FILE_CASES):
        row = got[str(i)]
        assert row["violations"] == violations, params
        where = (row["bucket"], row["object_key"], row["file_name"], row["marker_directory"])
        assert where == (resolved or (None,) * 4)
    assert got["sql"]["first_violation"] == "source_type_mismatch" and got["no"]["violations"] == ["unknown_dataproduct"]

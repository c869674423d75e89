"""Written files and catalog sources."""

import csv
import glob
import json
import time
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.contracts import ContractError, ExtractSpec
from tidegate.operators import audit
from tidegate.plans.extracts import run_extracts
from tidegate.session import ActionTimeout, run_folder, time_limit
from tidegate.sinks import extracts, transfers
from tidegate.sources import generate, tables


def test_csv_text(spark, tmp_path):
    rows = [(1, 'say "hi", ok', 1e7, None), (2, "line\nbreak", 12345678.25, ""), (3, "naïve ü", 1e-5, "x")]
    df = spark.createDataFrame(rows, "id int, note string, value double, maybe string").coalesce(1)
    extracts.write_csv_extract(df, str(tmp_path / "out"))
    part = glob.glob(str(tmp_path / "out" / "part-*.csv"))[0]
    with open(part, newline="", encoding="utf-8") as f:
        read = list(csv.reader(f))
    assert read[0] == ["id", "note", "value", "maybe"]
    assert read[1] == ["1", 'say "hi", ok', "10000000.0", ""] and read[2][1:] == ["line\nbreak", "12345678.25", ""]
    assert float(read[3][2]) == 1e-5 and "E" not in read[3][2]


def test_csv_keeps_every_value(spark, tmp_path):
    texts = ["  lead", "trail  ", "\ttab\t", " ", "\t", 'q"q', '"', "a,b", "l1\nl2", "l1\r\nl2", "\r", "#x", "\\", "'", "ü €", "''"]
    numbers = [float(f"{sign}{digits}e{power}") for digits in ("1.2345678901234567", "9.999999999999999", "1", "3.5", "1.25")
               for power in range(-12, 16) for sign in ("", "-")] + [0.0, -0.0, 1e300, 5e-324, 1e16, 123456789.0]
    rows = [(i, texts[i % len(texts)], value) for i, value in enumerate(numbers)]
    df = spark.createDataFrame(rows, "id int, note string, value double")
    extracts.write_csv_extract(df, str(tmp_path / "out"))
    back = extracts.read_csv_extract(spark, str(tmp_path / "out"), df.schema).collect()
    assert sorted((r["id"], r["note"], repr(r["value"])) for r in back) == sorted((i, t, repr(v)) for i, t, v in rows)
    shown = spark.createDataFrame([(v,) for _, _, v in rows if v == 0 or 1e-12 <= abs(v) < 1e16], "value double").select(
        extracts.plain_number(F.col("value")).alias("text"), "value").collect()
    assert all("E" not in r["text"] and float(r["text"]) == r["value"] for r in shown)


def test_empty_csv_has_only_a_header(spark, tmp_path):
    extracts.write_csv_extract(spark.createDataFrame([], "a int, b string"), str(tmp_path / "out"))
    text = "".join(open(p).read() for p in glob.glob(str(tmp_path / "out" / "part-*.csv")))
    assert text.strip() in ("a,b", "")


def test_unknown_format(spark, tmp_path):
    with pytest.raises(ValueError):
        extracts.write_extract(spark.range(1), str(tmp_path / "x"), "xml")


def test_audit_log_is_sorted_json(spark, tmp_path):
    events = spark.createDataFrame(
        [("compress", "s1", "2024-01-02 03:04:05.000006", "success", {"b": "2", "a": "1"})],
        "event_type string, transfer_session_id string, ts string, outcome string, details map<string,string>")
    typed = audit.audit_events(events.withColumn("timestamp", F.col("ts").cast("timestamp")), F.col("details"))
    transfers.write_audit_log(typed, str(tmp_path / "log"))
    line = open(glob.glob(str(tmp_path / "log" / "event_date=2024-01-02" / "part-*"))[0]).read().strip()
    document = json.loads(line)
    assert list(document) == sorted(document) and list(document["details"]) == ["a", "b"]
    assert document["timestamp"] == "2024-01-02T03:04:05.000006Z" and document["stage"] == "sender"
    assert document["destination_host"] is None and len(document) == 10


def specs(limit=100, schema="dot"):
    return [ExtractSpec.from_dict({"template_id": "dot_contract_extract_v1", "row_limit": limit, "params": {
        "schema": schema, "table": "t", "filters": {"id": {"min": low}}, "order_by": "id"}}) for low in (0, 5, 0)]


def test_run_extracts_is_idempotent(spark):
    root = run_folder(spark, "test-extracts")
    table = lambda schema, name: spark.range(10).withColumn("x", F.lit("v"))
    first = run_extracts(spark, specs(), table, root, "s1").collect()
    assert [(r["status"], r["row_count"], r["skipped"]) for r in first] == [("done", 10, False), ("done", 5, False), ("skipped", 0, True)]
    assert all(r["file_size_bytes"] > 0 for r in first[:2])
    again = run_extracts(spark, specs(), table, root, "s2").collect()
    assert [r["status"] for r in again] == ["skipped"] * 3
    other = run_extracts(spark, specs(limit=7), table, root, "s3").collect()
    assert [r["row_count"] for r in other] == [7, 5, 0]


def test_failed_extract_leaves_no_marker(spark):
    root, calls = run_folder(spark, "test-extracts"), []

    def table(schema, name):
        calls.append(1)
        if len(calls) <= 2:
            raise ContractError("table_not_found", "gone")
        return spark.range(10)

    assert [r["status"] for r in run_extracts(spark, specs(), table, root, "s").collect()] == ["failed", "failed", "skipped"]
    assert [r["status"] for r in run_extracts(spark, specs(), table, root, "s").collect()] == ["done", "done", "skipped"]


def test_time_limit_cancels_the_job(spark):
    slow = F.udf(lambda x: (time.sleep(60), x)[1], "bigint")
    started = time.time()
    with pytest.raises(ActionTimeout), time_limit(spark, 2):
        spark.range(1).select(slow("id")).collect()
    assert time.time() - started < 30
    assert spark.range(3).count() == 3


def test_narrowing_inside_the_time_limit(spark):
    """A contract whose order alone takes too long is stopped, whole error and no marker."""
    slow = F.udf(lambda x: (time.sleep(60), x)[1], "bigint")
    contract = ExtractSpec.from_dict({"template_id": "dot_contract_extract_v1", "row_limit": 5, "timeout_seconds": 2, "params": {
        "schema": "s", "table": "t", "order_by": "id"}})
    root, started = run_folder(spark, "test-extracts"), time.time()
    done = run_extracts(spark, [contract], lambda schema, name: spark.range(3).select(slow("id").alias("id")), root, "s").collect()
    assert time.time() - started < 40 and [r["status"] for r in done] == ["failed"] and "ActionTimeout" in done[0]["error"]


def test_run_folders_go_when_they_are_no_longer_needed(spark, tmp_path, monkeypatch):
    from tidegate import session

    monkeypatch.setattr(session, "_run_folders", [])
    first, second = session.run_folder(spark, "a"), session.run_folder(spark, "b")
    spark.range(3).write.parquet(first)
    assert session.remove_run_folders(spark) == 1 and not session.path_exists(spark, first)
    assert second != first and session.remove_run_folders(spark) == 0


def test_jdbc_options():
    source = tables.JdbcSource("db", "core", "reader", partition_column="id", lower_bound=0, upper_bound=10**9, num_partitions=200)
    options = source.options("dot", "contract_data", 120)
    assert options["url"] == "jdbc:postgresql://db:5432/core" and options["dbtable"] == '"dot"."contract_data"'
    assert (options["partitionColumn"], options["numPartitions"], options["queryTimeout"]) == ("id", "200", "120")
    with pytest.raises(ContractError):
        tables.JdbcSource("db", "core", "u", engine="oracle").options("s", "t", 1)
    with pytest.raises(ContractError):
        tables.JdbcSource("db", "core", "u", partition_column="id").options("s", "t", 1)


def test_jdbc_predicates_cut_by_equal_depth(spark):
    rows = spark.range(40_000).selectExpr(
        "CAST(pow(id / 1000.0, 4) AS BIGINT) AS skewed", "CASE WHEN id % 5 = 0 THEN NULL ELSE pow(id, 3) END AS gaps",
        "concat('it''s ', substr(sha2(CAST(id AS STRING), 256), 1, 9)) AS text", "CAST(if(id % 2 = 0, id, 0) AS DECIMAL(20,3)) AS hot",
        "timestamp_micros(id * id * 1000) AS at", "date_add(DATE '2020-01-01', CAST(sqrt(id) AS INT)) AS day", "CAST(NULL AS STRING) AS nothing",
        "if(id % 100 = 0, CAST('NaN' AS DOUBLE), CAST(id AS DOUBLE)) AS nan")
    for name in rows.columns:
        predicates = tables.partition_predicates(rows, name, 10, "`", "")
        counts = rows.agg(*[F.count_if(F.expr(p)).alias(f"p{i}") for i, p in enumerate(predicates)]).first()
        assert sum(counts) == 40_000, name
        if name in ("text", "at", "gaps", "nan", "day"):
            held = counts[:-1]
            assert len(held) == 10 and max(held) <= 1.5 * sum(held) / 10, (name, counts)
    assert tables.partition_predicates(rows, "nothing", 10) == ['"nothing" IS NOT NULL', '"nothing" IS NULL']
    assert tables.partition_predicates(rows.limit(0), "gaps", 4) == ['"gaps" IS NOT NULL', '"gaps" IS NULL']
    outside = spark.createDataFrame([(-1.0,), (1e300,), (None,)], "gaps double")
    found = tables.partition_predicates(rows, "gaps", 10, "`", "")
    assert [sum(outside.where(p).count() for p in found), outside.where(found[-1]).count()] == [3, 1]
    assert ' COLLATE "C" ' in tables.partition_predicates(rows, "text", 3)[0]
    with pytest.raises(ContractError):
        tables.JdbcSource("db", "core", "u", partition_column="id", lower_bound=0, upper_bound=9, predicates=("a",)).options("s", "t", 1)


def test_table_names(spark):
    assert tables.split_table_name(" a.b ") == ("a", "b") and tables.split_table_name("b", "a") == ("a", "b")
    for bad in ("b", ".b", "a."):
        with pytest.raises(ContractError):
            tables.split_table_name(bad)
    with pytest.raises(ContractError) as caught:
        tables.scan_table(spark, "nowhere", "nothing")
    assert caught.value.code == "table_not_found"


def test_profile_sketch_agrees_on_small_data(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (None, "b")], "n int, s string")
    shown = lambda exact: {r["column_name"]: (r["null_count"], r["distinct_count"]) for r in tables.column_profile(df, exact).collect()}
    assert shown(("n", "s")) == shown(()) == shown(("s",)) == {"n": (1, 2), "s": (0, 2)}


def test_profiles_of_parts_merge(spark):
    schema = "a bigint, `b.c` string, n double, m map<string,int>"
    parts = [[(i % 700, f"x{i}", None, {"k": i % 3}) for i in range(k * 500, k * 500 + 600)] for k in range(4)]
    sketches = [tables.profile_sketches(spark.createDataFrame(rows, schema)) for rows in [*parts, []]]
    merged = tables.merge_profiles(reduce(DataFrame.unionByName, sketches))
    shown = {r["column_name"]: (r["ordinal"], r["null_count"], r["distinct_count"]) for r in merged.collect()}
    assert shown["n"] == (3, 2_400, 0) and shown["m"] == (4, 0, 3)
    for name, count in (("a", 700), ("b.c", 2_100)):
        assert abs(shown[name][2] - count) <= 0.03 * count
    whole = spark.createDataFrame([r for rows in parts for r in rows], schema)
    exact = tables.column_profile(whole, whole.columns)
    assert {r["column_name"]: r["distinct_count"] for r in exact.collect()} == {"a": 700, "b.c": 2_100, "n": 0, "m": 3}
    assert {r["distinct_count"] for r in tables.column_profile(whole.limit(0), whole.columns).collect()} == {0}


def test_synthetic_rows_do_not_depend_on_partitioning(spark):
    columns = [{"name": n, "type": t} for n, t in (
        ("contract_id", "uuid"), ("piid", "varchar"), ("vendor_name", "text"), ("vendor_duns", "text"), ("contract_value", "numeric"),
        ("award_date", "date"), ("active", "boolean"), ("n", "integer"))]
    one = generate.synth_table(spark, columns, 500, 1).collect()
    assert sorted(map(str, one)) == sorted(map(str, generate.synth_table(spark, columns, 500, 7).collect()))
    df = generate.synth_table(spark, columns, 500, 3)
    good = F.col("piid").rlike("^[A-Z0-9]{2,5}2[1-6][CD]-2[1-6]-[CD]-[0-9]{4}$") & F.col("vendor_duns").rlike("^[1-9][0-9]{8}$") & F.col(
        "contract_id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$") & F.col("contract_value").between(1, 1_000_000) & F.col(
        "award_date").between("2021-01-01", "2026-12-31") & F.col("n").between(1, 1_000_000)
    assert df.where(good).count() == 500 and df.select("contract_id").distinct().count() == 500
    with pytest.raises(ValueError):
        generate.synth_rows(spark.range(1), [{"name": "id", "type": "bigint", "identity": True}])

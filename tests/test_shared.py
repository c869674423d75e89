"""Extracts of many contracts by one scan, against the extract of each contract alone."""

import datetime
import decimal
import json

import pytest
from pyspark.sql import functions as F

from tidegate.contracts import ContractError, ExtractSpec
from tidegate.operators.extract import governed_extract
from tidegate.plans import shared
from tidegate.plans.extracts import read_extract_markers
from tidegate.session import run_folder
from tidegate.sinks.extracts import read_csv_extract

ROWS = "contract_id string, params string, template_id string, row_limit bigint, timeout_seconds bigint"


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(0, 900, 1, 5).selectExpr(
        "id", "CAST(id % 40 AS INT) AS small", "CASE WHEN id % 11 = 0 THEN NULL ELSE concat('k', id % 7) END AS kind", "id / 8.0D AS real",
        "CAST(id / 4 AS DECIMAL(9,2)) AS money", "date_add(DATE '2024-01-01', CAST(id % 90 AS INT)) AS day",
        "TIMESTAMP '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, CAST(id AS INT)) AS at", "id % 3 = 0 AS flag",
        "concat('a,\"', id) AS odd")
    return df.withColumn("kind", F.when(F.col("id") % 3 == 1, "hot").otherwise(F.col("kind")))


def contracts(spark, kinds):
    rows = [(f"c{i:03}", json.dumps({"schema": "s", "table": "t", **params}), "dot_contract_extract_v1", limit, 300)
            for i, (params, limit) in enumerate(kinds)]
    return spark.createDataFrame(rows, ROWS).repartition(3)


KINDS = [
    ({}, 50), ({}, 2000), ({"order_by": "id desc", "select_fields": ["id", "odd"]}, 33),
    *(({"filters": {"kind": {"equal": k}}, "order_by": "real desc", "select_fields": ["id", "real"]}, n) for k in ("k1", "k2", "hot", "none") for n in (3, 500)),
    ({"filters": {"kind": {"in": ["k1", "k5", "k1", "x"]}, "small": {"in": [1, 2, 3, "4", 5.0, 6.5, 1e12]}}, "order_by": "id"}, 100),
    ({"filters": {"kind": {"equal": "k1"}, "small": {"in": []}}, "order_by": "id"}, 100),
    *(({"filters": {"real": {"min": low, "max": low + 20}}, "order_by": "id", "select_fields": ["id"]}, 1000) for low in (0, 3.3, 50, 80.125, 500)),
    ({"filters": {"money": {"min": 10.001, "max": "99.999"}, "day": {"min": "2024-02-01", "max": "2024-03-03"}}, "order_by": "money desc"}, 1000),
    ({"filters": {"money": {"min": -1e30}, "day": {"max": "2024-02-01"}}, "order_by": "money desc"}, 1000),
    *(({"filters": {"small": {"min": low, "max": high}, "kind": {"min": "k2"}, "at": {"min": "2024-01-02T00:00:00"}}, "order_by": "id"}, 1000)
      for low, high in ((3.5, 7.2), (-1e15, 1e15), (1e15, 1e16))),
    ({"filters": {"flag": {"equal": True}, "money": {"equal": 2.25}, "id": {"max": 100}}, "order_by": "id"}, 1000),
    ({"filters": {"flag": {"equal": False}, "money": {"in": [2.505, 3, "4.50"]}, "id": {"max": 100}}, "order_by": "id"}, 1000),
]


def test_every_contract_gets_what_it_gets_alone(spark, table):
    root = run_folder(spark, "test-shared")
    done = shared.extract_all(spark, contracts(spark, KINDS), lambda *_: table, root, "s", lambda *_: ("id",), "parquet").collect()
    assert {r["status"] for r in done} == {"done"} and len(done) == len(KINDS)
    keyed = {r["fingerprint"]: r for r in done}
    named = contracts(spark, KINDS).select("contract_id", shared.fingerprint(
        F.col("params"), F.col("template_id"), F.col("row_limit"), F.col("timeout_seconds")).alias("fp"))
    for r in named.collect():
        params, limit = KINDS[int(r["contract_id"][1:])]
        spec = ExtractSpec.from_dict({"params": {"schema": "s", "table": "t", **params}, "row_limit": limit, "template_id": "dot_contract_extract_v1"})
        want = [tuple(x) for x in governed_extract(table, spec, ("id",)).collect()]
        assert keyed[r["fp"]]["row_count"] == len(want), params
        if not want:
            continue
        path = shared.output_path(root, keyed[r["fp"]]["output_key"])
        parts = spark.read.parquet(path).withColumn("file", F.input_file_name()).withColumn("nth", F.monotonically_increasing_id())
        got = [tuple(x)[:-2] for x in parts.orderBy("file", "nth").collect()]
        if spec.order_field:
            assert got == want, params
        else:
            every = {tuple(x) for x in table.collect()}
            assert len(set(got)) == limit if limit < 900 else set(got) == every
            assert set(got) <= every


def test_csv_has_header_and_order_and_a_second_run_skips(spark, table):
    root, kinds = run_folder(spark, "test-shared"), [KINDS[2], KINDS[3], KINDS[9], KINDS[3]]
    first = shared.extract_all(spark, contracts(spark, kinds), lambda *_: table, root, "s", lambda *_: ("id",)).collect()
    assert sorted((r["status"], r["row_count"]) for r in first) == [("done", 0), ("done", 3), ("done", 33), ("skipped", 0)]
    for r in first:
        if r["status"] == "done":
            path = shared.output_path(root, r["output_key"])
            header = spark.read.text(path).first()[0]
            assert header in ("id,odd", "id,real") and r["file_size_bytes"] > 0
            if r["row_count"] == 33:
                schema = table.select("id", "odd").schema
                assert sorted(x["odd"] for x in read_csv_extract(spark, path, schema).collect()) == sorted(f'a,"{i}' for i in range(867, 900))
    again = shared.extract_all(spark, contracts(spark, kinds), lambda *_: table, root, "t", lambda *_: ("id",)).collect()
    assert [r["status"] for r in again] == ["skipped"] * 4 and read_extract_markers(spark, root).count() == 3


def test_broken_contracts_fail_alone(spark, table):
    root = run_folder(spark, "test-shared")
    kinds = [({"filters": {"gone": {"min": 1}}}, 5), ({"select_fields": ["gone"]}, 5), ({"order_by": "id", "select_fields": ["odd"]}, 5),
             ({"filters": {"small": {"min": "many"}}}, 5), ({"filters": {"small": {"like": 1}}}, 5), ({"table": "missing"}, 5), ({"schema": " "}, 5), ({}, 5)]

    def source(schema, name):
        if name == "missing":
            raise ContractError("table_not_found", "gone")
        return table
    done = shared.extract_all(spark, contracts(spark, kinds), source, root, "s").collect()
    assert sorted(r["status"] for r in done) == ["done"] + ["failed"] * 7
    assert all(r["error"].startswith("ContractError") and r["output_key"] == "" for r in done if r["status"] == "failed")
    assert read_extract_markers(spark, root).count() == 1
    assert shared.extract_all(spark, contracts(spark, []), source, root, "s").collect() == []


def test_jobs_do_not_grow_with_the_contracts(spark, table):
    def jobs(n):
        kinds = [({"filters": {"kind": {"equal": f"k{i % 7}"}, "real": {"min": i}}, "order_by": "id", "select_fields": ["id"]}, 10 + i) for i in range(n)]
        spark.sparkContext.setJobGroup(f"jobs-{n}", "")
        done = shared.extract_all(spark, contracts(spark, kinds), lambda *_: table, run_folder(spark, "test-shared"), "s", lambda *_: ("id",)).collect()
        found = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"jobs-{n}"))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert [r["status"] for r in done] == ["done"] * n
        return found
    assert jobs(90) <= jobs(3) + 3


def test_typed_bounds():
    from pyspark.sql import types as T
    d = decimal.Decimal
    assert shared._bound(d("3.5"), T.IntegerType(), True) == ("4", True) and shared._bound(d("3.5"), T.IntegerType(), False) == ("3", True)
    assert shared._bound(d("1e12"), T.IntegerType(), True) == (None, False) and shared._bound(d("1e12"), T.IntegerType(), False) == (None, True)
    assert shared._bound(d("1.005"), T.DecimalType(5, 2), True) == ("1.01", True) and shared._bound(d("1.005"), T.DecimalType(5, 2), False) == ("1.00", True)
    assert shared._bound(datetime.date(2024, 1, 2), T.DateType(), True) == ("2024-01-02", True)

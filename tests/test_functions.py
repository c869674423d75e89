"""Names, paths, versions, fingerprints."""

import json

import pytest
from pyspark.sql import functions as F

from tidegate.functions import hashing, naming, text, versions
from tidegate.sinks.extracts import plain_number


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return row.select(column.alias("x")).first()["x"]


def test_versions_order(spark):
    given = ["1.2", "1.2.0", "v1.10.0", "1.9", "0.9.9", "v1.2"]
    df = spark.createDataFrame([(v,) for v in given], "v string").select("v", versions.version_key(F.col("v")).alias("k"))
    keys = {r["v"]: r["k"] for r in df.collect()}
    assert keys["1.2"] == keys["1.2.0"] == keys["v1.2"] == [1, 2, 0]
    assert keys["v1.10.0"] > keys["1.9"] > keys["1.2"] > keys["0.9.9"]
    assert one(spark, versions.version_key(F.lit("1"))) is None


@pytest.mark.parametrize("key, marker", [
    ("file_mode/outgoing/a.json", "file_mode/processed/a.json.done"),
    ("file_mode/outgoing/sub/a.json", "file_mode/processed/sub/a.json.done"),
    ("north/file_mode/outgoing/sub/a.json", "north/file_mode/processed/sub/a.json.done"),
    ("elsewhere/a.json", "file_mode/processed/a.json.done"),
    ("file_mode/outgoing/file_mode/outgoing/x", "file_mode/processed/file_mode/outgoing/x.done"),
])
def test_file_marker_key(spark, key, marker):
    assert one(spark, naming.file_marker_key(F.lit(key))) == marker


@pytest.mark.parametrize("uri, expected", [
    ("s3://b/k/x", ("b", "k/x", "ok")), ("S3://b/k", (None, None, "other_scheme")), ("s3://b", (None, None, "invalid")),
    ("s3://b/", (None, None, "invalid")), ("s3:///k", (None, None, "invalid")), ("/tmp/x", (None, None, "other_scheme")),
    ("s3://b//k", ("b", "/k", "ok")),
])
def test_parse_object_uri(spark, uri, expected):
    assert tuple(one(spark, naming.parse_object_uri(F.lit(uri)))) == expected


def test_marker_directory(spark):
    assert one(spark, naming.marker_directory(F.lit("b"), F.lit("p/q/r.txt"))) == "s3://b/p/q/"
    assert one(spark, naming.marker_directory(F.lit("b"), F.lit("r.txt"))) == "s3://b/"


def test_paths_refuse_blank_parts(spark):
    assert one(spark, naming.transfer_path(F.lit("query"), F.lit(" s "), F.lit("f"))) == "query_mode/transfers/s/f"
    assert one(spark, naming.transfer_path(F.lit("query"), F.lit("  "), F.lit("f"))) is None
    assert one(spark, naming.landing_path(F.lit("s"), F.lit("f"))) == "landing/s/f"
    assert one(spark, naming.bucket_name(F.lit("Dev"), F.lit(" DOT "), F.lit("landing"))) == "exchange-dev-dot-data-landing"
    assert one(spark, naming.bucket_name(F.lit("Dev"), F.lit("x"), F.lit("attic"))) is None


@pytest.mark.parametrize("raw, mode, reason", [
    (None, "file", "default_missing"), (" \t", "file", "default_blank"), (" QUERY ", "query", "explicit"),
    ("stream", "file", "default_invalid:stream"),
])
def test_input_mode(spark, raw, mode, reason):
    assert tuple(one(spark, text.normalize_input_mode(F.lit(raw).cast("string")))) == (mode, reason)


def fp(spark, params, **kw):
    source = hashing.SourceIdentity(**kw)
    return one(spark, hashing.fingerprint(F.lit(params), "t", F.lit(10), F.lit(60), source))


def test_fingerprint_equality_classes(spark):
    base = fp(spark, json.dumps({"schema": "s", "filters": {"b": {"min": 1, "max": 2}}, "list": [1, 2]}))
    assert base == fp(spark, '{ "list":[1,2], "filters":{"b":{"max":2,"min":1}}, "schema":"s"}')
    assert base != fp(spark, '{"list":[2,1],"filters":{"b":{"max":2,"min":1}},"schema":"s"}')
    assert base != fp(spark, '{"list":[1,2],"filters":{"b":{"max":2,"min":1.0}},"schema":"s"}')
    assert base != fp(spark, '{"list":[1,2],"filters":{"b":{"max":2,"min":"1"}},"schema":"s"}')
    assert base != fp(spark, '{"list":[1,2],"filters":{"b":{"max":2,"min":1}},"schema":"s"}', host="other")


def test_hex_checksum(spark):
    assert one(spark, hashing.hex_checksum(F.lit("A" * 64))) == "a" * 64
    assert one(spark, hashing.hex_checksum(F.lit("a" * 63))) is None
    assert one(spark, hashing.hex_checksum(F.lit("g" * 64))) is None


@pytest.mark.parametrize("value", [0.0, 1.5, -2.25, 1e7, 12345678.5, 123456789012.25, 1e-5, 0.001, -1e9, 3.0e15])
def test_plain_number_has_no_exponent(spark, value):
    shown = one(spark, plain_number(F.lit(value)))
    assert "E" not in shown and float(shown) == value


@pytest.mark.parametrize("value", [1e300, 1e-300])
def test_extreme_numbers_survive(spark, value):
    assert float(one(spark, plain_number(F.lit(value)))) == value

"""Filters, projection, order and cap on rows the test tables do not have."""

import datetime as dt
import random
from decimal import Decimal

import pytest

from tidegate.contracts import ContractError, ExtractSpec
from tidegate.operators import extract

D = dt.date


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [
            (1, "a", 10.5, Decimal("1.10"), D(2024, 1, 1), True), (2, "b", None, Decimal("2.20"), D(2024, 2, 1), False),
            (3, None, 30.0, None, None, None), (4, "a", 40.0, Decimal("4.40"), D(2024, 4, 1), True),
            (None, "ü", 50.0, Decimal("5.50"), D(2024, 5, 1), False),
        ], "id int, name string, value double, amount decimal(15,2), day date, flag boolean")


def ids(df):
    return sorted((r["id"] for r in df.collect()), key=lambda x: (x is None, x))


def test_bounds_drop_nulls(rows):
    assert ids(extract.filter_min(rows, "value", 30)) == [3, 4, None]
    assert ids(extract.filter_max(rows, "value", "30.0")) == [1, 3]
    assert ids(extract.filter_min(rows, "day", "2024-02-01")) == [2, 4, None]
    assert ids(extract.filter_max(rows, "amount", 2.2)) == [1, 2]


def test_fractional_and_huge_bounds_on_integers(rows):
    assert ids(extract.filter_min(rows, "id", 1.5)) == [2, 3, 4]
    assert ids(extract.filter_max(rows, "id", 3.9)) == [1, 2, 3]
    assert ids(extract.filter_max(rows, "id", 10**12)) == [1, 2, 3, 4]
    assert ids(extract.filter_min(rows, "id", 10**12)) == []
    assert ids(extract.filter_min(rows, "id", -(10**12))) == [1, 2, 3, 4]


def test_equal_and_in(rows):
    assert ids(extract.filter_equal(rows, "name", "a")) == [1, 4]
    assert ids(extract.filter_equal(rows, "id", 2.5)) == []
    assert ids(extract.filter_in(rows, "id", [1, 3, 3, 99])) == [1, 3]
    assert ids(extract.filter_in(rows, "id", [])) == []
    assert ids(extract.filter_equal(rows, "flag", True)) == [1, 4]


def test_long_lists_agree_with_short_ones(rows):
    assert ids(extract.filter_in(rows, "id", list(range(2, 4_000)))) == [2, 3, 4]
    # A value with more digits than the column holds matches nothing, however long the list.
    for more in (0, 1_500):
        wanted = ["1.105", "2.20", 1e30, "1" * 20] + [f"{i}.005" for i in range(more)]
        assert ids(extract.filter_in(rows, "amount", wanted)) == [2]


@pytest.mark.parametrize("name, value", [
    ("day", "soon"), ("value", "x"), ("value", True), ("flag", 1), ("name", 5), ("id", None), ("value", float("nan")),
])
def test_bad_literals_are_refused_before_any_job(rows, name, value):
    with pytest.raises(ContractError) as caught:
        extract.filter_min(rows, name, value)
    assert caught.value.code == "filter_value_invalid"


def test_field_names_are_exact(rows):
    with pytest.raises(ContractError):
        extract.filter_min(rows, "VALUE", 1)
    with pytest.raises(ContractError) as caught:
        extract.project_fields(rows, ["ID"])
    assert caught.value.code == "unknown_select_field"


def spec(**kwargs):
    return ExtractSpec("s", "t", **kwargs)


def test_projection_order_and_empty_list(rows):
    assert extract.project_fields(rows, ["value", "id"]).columns == ["value", "id"]
    assert extract.project_fields(rows, []).columns == rows.columns


def test_order_field_must_be_projected(rows):
    with pytest.raises(ContractError) as caught:
        extract.governed_extract(rows, spec(select_fields=("id",), order_field="value"))
    assert caught.value.code == "unknown_order_field"


def test_filter_may_use_an_unprojected_column(rows):
    from tidegate.contracts import parse_filters
    result = extract.governed_extract(rows, spec(select_fields=("id",), filters=parse_filters({"value": {"min": 40}})))
    assert ids(result) == [4, None]


def test_nulls_last_both_ways(rows):
    up = [r["value"] for r in extract.order_by_field(rows, "value").collect()]
    down = [r["value"] for r in extract.order_by_field(rows, "value", True).collect()]
    assert up == [10.5, 30.0, 40.0, 50.0, None] and down == [50.0, 40.0, 30.0, 10.5, None]


def test_empty_result(rows):
    result = extract.governed_extract(rows, spec(filters=(), row_limit=5, order_field="value"))
    assert result.where("false").count() == 0


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("distinct", [3, 1000, 10**9])
def test_topk_equals_sorting(spark, descending, distinct):
    """The top-k is what a full sort would give, also with heavy ties and nulls."""
    rng = random.Random(distinct)
    data = [(i, rng.randrange(distinct) if rng.random() > 0.1 else None) for i in range(5_000)]
    df = spark.createDataFrame(data, "id int, v bigint").repartition(7)
    for limit in (1, 101, 2_000, 4_900, 6_000):
        result = extract.topk_extract(df, "v", limit, descending, ("id",)).collect()
        expected = sorted(data, key=lambda r: (r[1] is None, -(r[1] or 0) if descending else (r[1] or 0), r[0]))[:limit]
        assert [tuple(r) for r in result] == expected


@pytest.mark.parametrize("limit", [101, 3_000, 5_000, 9_000])
def test_unordered_limit(spark, limit):
    df = spark.range(0, 5_000, 1, 9).withColumn("same", (extract.F.col("id") % 2))
    rows = extract.limit_rows(df, limit)
    assert rows.count() == min(limit, 5_000) == rows.distinct().count()
    assert extract.limit_rows(df.select("same"), limit).count() == min(limit, 5_000)


def test_filters_reach_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    spec = ExtractSpec.from_dict({"row_limit": 10, "params": {
        "schema": "s", "table": "orders", "filters": {"o_totalprice": {"min": 1000}, "o_custkey": {"max": 50.5}},
        "select_fields": ["o_orderkey", "o_totalprice"], "order_by": "o_totalprice desc"}})
    chosen = extract.project_fields(extract.filter_ranges(orders, spec.filters), spec.select_fields)
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_totalprice,1000.0)" in plan and "LessThanOrEqual(o_custkey,50)" in plan
    assert "o_orderpriority" not in plan
    got = [tuple(r) for r in extract.governed_extract(orders, spec, ("o_orderkey",)).collect()]
    assert got == [tuple(r) for r in chosen.orderBy(extract.F.desc("o_totalprice"), "o_orderkey").limit(10).collect()]


@pytest.mark.parametrize("limit", [100, 30_000])
def test_caps_take_nested_maps_and_hot_values(spark, limit):
    df = spark.range(0, 60_000, 1, 6).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 3 END AS hot", "struct(map('a', id) AS m) AS nested", "array(map(id, 'x')) AS listed")
    assert extract.limit_rows(df, limit).count() == limit
    got = extract.topk_extract(df, "hot", limit, tie_break=("id",)).collect()
    expected = sorted(((7 if i % 3 == 0 else i % 3), i) for i in range(60_000))[:limit]
    assert [(r["hot"], r["id"]) for r in got] == expected and got[0]["nested"]["m"] == {"a": got[0]["id"]}
    assert extract.topk_extract(df.select("hot"), "hot", limit).where("hot = 1").count() == min(limit, 20_000)


def test_an_unprojected_key_breaks_ties(spark):
    df = spark.range(0, 900, 1, 5).selectExpr("899 - id AS key", "0 AS level", "id AS shown")
    rows = extract.governed_extract(df, spec(select_fields=("level", "shown"), order_field="level", row_limit=10), ("key",))
    assert [tuple(r) for r in rows.collect()] == [(0, 899 - i) for i in range(10)]

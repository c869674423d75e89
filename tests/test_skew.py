"""A key with a third of all rows must not end up in one task."""

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tidegate.operators import idempotency
from tidegate.plans import skew
from tidegate.plans.skew import first_of_wide_rows, first_per_key, join_back


@pytest.fixture
def skewed(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 5000).cast("string")))
    yield spark.range(0, 600_000, 1, 16).select(
        key.alias("fingerprint"), "id", F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_join_back_splits_the_hot_key(skewed, how):
    per_key = skewed.groupBy("fingerprint").agg(F.min("id").alias("first"))
    joined = join_back(skewed, per_key, ["fingerprint"], how)
    assert "skew=true" in executed(joined)
    assert joined.count() == (0 if how == "left_anti" else 600_000)


def test_plan_extracts_under_skew(spark, skewed):
    requests = skewed.select("fingerprint", "id", F.lit("t").alias("template_id"), F.lit("s").alias("session"), "payload")
    markers = spark.createDataFrame([("k1",), ("k2",)], "fingerprint string")
    planned = idempotency.plan_extracts(requests, markers, ["id"])
    counts = {r["action"]: r["count"] for r in planned.groupBy("action").count().collect()}
    keys = requests.select("fingerprint").distinct().count()
    done = requests.where("fingerprint IN ('k1', 'k2')").count()
    assert counts == {"run": keys - 2, "skip_done": done, "skip_duplicate": 600_000 - done - (keys - 2)}


def test_first_per_key_combines_before_the_shuffle(skewed):
    firsts = first_per_key(skewed, ["fingerprint"], [F.col("id")])
    plan = executed(firsts)
    assert "partial_min_by" in plan and "Window" not in plan
    assert firsts.where("fingerprint = 'hot'").first()["id"] == 0


def _children(node):
    return [node.children().apply(i) for i in range(node.children().size())]


def _nodes(node):
    yield node
    for child in _children(node):
        yield from _nodes(child)


@pytest.mark.parametrize("sent", [skew._SENT_BYTES, 0])
def test_wide_rows_are_not_sorted_with_a_key_each(spark, monkeypatch, sent):
    """With as many keys as rows the first ones are all rows: they must not be sorted or aggregated either."""
    written, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(skew, "_SENT_BYTES", sent)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **kw: (written.append(self._df), write(self, *a, **kw))[1])
    rows = spark.range(0, 900, 1, 4).selectExpr(
        "IF(id < 600, id, IF(id < 890, id - 600, NULL)) AS key", "IF(id < 600, 1, 0) AS n", "IF(id % 5 = 0, NULL, repeat('x', 500)) AS wide")
    for df, keys in ((rows.where("n = 1"), 600), (rows, 601), (rows.unionByName(rows), 601)):
        found = first_of_wide_rows(df, ["key"], [F.col("n").alias("o")])
        assert found.columns == ["key", "n", "wide"] and found.count() == found.select("key").distinct().count() == keys
        firsts = df.groupBy("key").agg(F.min("n").alias("n"))
        assert found.join(firsts, found["key"].eqNullSafe(firsts["key"]) & (found["n"] == firsts["n"])).count() == keys
        assert found.exceptAll(df).count() == 0
    for df in written:
        for node in _nodes(df._jdf.queryExecution().sparkPlan()):
            if "Aggregate" in node.nodeName() or node.nodeName() in ("SortMergeJoin", "Sort", "Window"):
                assert all("wide#" not in child.output().mkString(",") for child in _children(node))


def test_equal_hashes_leave_one_row_a_key(spark, monkeypatch):
    """Rows picked by an equal hash only are dropped by their order and number."""
    monkeypatch.setattr(F, "xxhash64", lambda *columns: F.lit(1).cast("bigint"))
    rows = spark.range(0, 60, 1, 3).selectExpr("id % 7 AS key", "id AS n", "repeat('x', 9) AS wide")
    found = first_of_wide_rows(rows.unionByName(rows), ["key"], [F.col("n").alias("o")])
    assert sorted((r["key"], r["n"]) for r in found.collect()) == [(k, k) for k in range(7)]

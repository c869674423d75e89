"""Marker and target tables that stay usable with many sessions."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from tidegate.operators.idempotency import already_processed, plan_transfers
from tidegate.session import run_folder
from tidegate.sinks import transfers


def sessions(spark, low, high):
    return spark.range(low, high).selectExpr("concat('agency', id % 9) AS agency", "concat('sess-', id) AS session")


def marked(df, kind="done"):
    return df.withColumns({"kind": F.lit(kind), "detail": F.lit(None).cast("string")})


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def marker_side(plan):
    """The part of a plan below the join that reads the marker table."""
    at = plan.index("tidegate_markers")
    lines = plan[:at].splitlines()
    depth = lambda line: len(re.match(r"[ :+\-*()0-9]*", line)[0])
    out, level = [], depth(lines[-1])
    for line in reversed(lines):
        if depth(line) <= level:
            out.append(line)
            level = depth(line)
            if "Join" in line:
                break
    return "\n".join(out)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_marker_joins_do_not_move_the_markers(spark, no_broadcast):
    path = run_folder(spark, "test-markers")
    transfers.write_markers(marked(sessions(spark, 0, 3000)), path)
    transfers.write_markers(marked(sessions(spark, 2000, 4000), "rejected"), path)
    markers = transfers.read_markers(spark, path)
    assert markers.count() == 4000 and markers.where("kind = 'rejected'").count() == 1000
    work = sessions(spark, 3500, 4500)
    left = plan_transfers(work, markers)
    done = already_processed(work.crossJoin(spark.range(3)), markers, ["agency", "session"])
    for df in (left, done):
        side = marker_side(plan_of(df))
        assert "Join" in side and "Exchange" not in side, side
    assert left.count() == 500 and done.count() == 1500
    files = glob.glob(f"{path}/part-*")
    assert len(files) <= 2 * transfers.MARKER_BUCKETS


def test_a_second_session_reads_the_buckets(spark, no_broadcast):
    path = run_folder(spark, "test-markers")
    transfers.write_markers(marked(sessions(spark, 0, 500)), path)
    spark.sql(f"DROP TABLE {transfers._marker_table(spark, path)}")
    other = spark.newSession()
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    markers = transfers.read_markers(other, path)
    left = plan_transfers(sessions(other, 400, 600), markers)
    assert left.count() == 100 and "Exchange" not in marker_side(plan_of(left))
    target = run_folder(spark, "test-markers")
    transfers.compact_markers(spark, path, target)
    assert transfers.read_markers(spark, target).count() == 500
    assert len(glob.glob(f"{target}/part-*")) <= transfers.MARKER_BUCKETS


def test_markers_before_the_first_write_and_repeated_keys(spark):
    path = run_folder(spark, "test-markers")
    assert transfers.read_markers(spark, path).count() == 0
    rows = [("a", "s", "rejected", "late"), ("a", "s", "done", None), ("a", None, "done", None)]
    transfers.write_markers(spark.createDataFrame(rows, transfers.MARKER_SCHEMA), path)
    transfers.write_markers(spark.createDataFrame(rows[:1], transfers.MARKER_SCHEMA), path)
    assert {tuple(r) for r in transfers.read_markers(spark, path).collect()} == {("a", "s", "done", None), ("a", None, "done", None)}
    assert transfers.read_markers(spark, path).where("session = 's'").count() == 1


def members(df, body="x"):
    return df.withColumns({"member": F.lit("m.txt"), "part": F.lit(0), "size": F.lit(1).cast("bigint"), "sha256": F.lit(body),
                           "content": F.lit(body).cast("binary")})


def test_a_hundred_thousand_sessions_fill_the_buckets_only(spark):
    path = run_folder(spark, "test-target")
    transfers.store_to_target(members(sessions(spark, 0, 100_000)), path)
    assert 0 < len(glob.glob(f"{path}/bucket=*")) <= transfers.TARGET_BUCKETS
    one = transfers.read_target(spark, path, "agency4", "sess-4")
    assert [r["target_key"] for r in one.collect()] == ["transfers/agency4/sess-4/m.txt"]
    assert "PartitionFilters: [isnotnull(bucket" in plan_of(one) and "EqualTo(session,sess-4)" in plan_of(one)
    assert transfers.read_target(spark, path).count() == 100_000


def test_a_replay_replaces_its_sessions_and_nothing_else(spark):
    path = run_folder(spark, "test-target")
    transfers.store_to_target(members(sessions(spark, 0, 300)), path, 16)
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/bucket=*/part-*")}
    transfers.store_to_target(members(sessions(spark, 300, 400)), path, 16)
    assert all(os.path.exists(f) and os.path.getmtime(f) == t for f, t in before.items())
    rows = lambda: sorted(tuple(r) for r in transfers.read_target(spark, path).select("agency", "session", "target_key", "sha256").collect())
    whole = rows()
    transfers.store_to_target(members(sessions(spark, 300, 400)), path, 16)
    assert rows() == whole and len(whole) == 400
    # One session again with other content, and a new one.
    kept = {f for f in glob.glob(f"{path}/bucket=*/part-*")}
    transfers.store_to_target(members(sessions(spark, 7, 8).union(sessions(spark, 400, 401)), "new"), path, 16)
    assert [r[3] for r in rows()].count("new") == 2 and len(rows()) == 401
    gone = {os.path.dirname(f) for f in kept if not os.path.exists(f)}
    assert len(gone) == 1

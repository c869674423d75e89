"""Streams that stop and go on."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tidegate.operators import audit
from tidegate.streaming import batches, jobs
from tidegate.streaming.levels import GRACE, Levels


def drain(writer, checkpoint):
    batches.start(writer, checkpoint).awaitTermination()


def test_new_files_are_handled_once(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    (folder / "sub").mkdir(parents=True)
    (folder / "sub" / "a.txt").write_bytes(b"a")
    stream = lambda: batches.new_file_stream(spark, str(folder)).select("path", F.sha2("content", 256).alias("sha256"))
    store = batches.store_batches(lambda df: df, out)
    drain(stream().writeStream.foreachBatch(store), str(tmp_path / "cp"))
    (folder / "b.txt").write_bytes(b"b")
    for _ in range(2):
        drain(stream().writeStream.foreachBatch(store), str(tmp_path / "cp"))
    stored = batches.read_batches(spark, out, "path string, sha256 string").collect()
    assert sorted(r["path"].rsplit("/", 1)[1] for r in stored) == ["a.txt", "b.txt"]


def arrivals(spark, tmp_path, schema, parts, writer):
    """Drain a stream after each part arrives; the writer takes the streaming rows."""
    folder = str(tmp_path / "arrived")
    for rows in parts:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(folder)
        drain(writer(batches.folder_stream(spark, folder, spark.createDataFrame([], schema).schema)), str(tmp_path / "cp"))


def test_first_arrivals_are_remembered(spark, tmp_path):
    jobs.use_state_store(spark)
    out, schema = str(tmp_path / "out"), "fingerprint string, at bigint"
    parts = [[("a", 2), ("a", 1), ("b", 3), (None, 1)], [("b", 1), ("c", 5), ("c", 6), (None, 0)], [("a", 0)]]
    arrivals(spark, tmp_path, schema, parts, lambda s: batches.first_arrivals(s, "fingerprint", ["at"], out))
    stored = {(r["fingerprint"], r["at"]) for r in batches.read_commits(spark, out, schema).collect()}
    assert stored == {("a", 1), ("b", 3), ("c", 5), (None, 1)}


def test_memory_of_arrivals_is_bounded(spark, tmp_path):
    """Keys leave the state after the delay, and copies of them are refused still."""
    jobs.use_state_store(spark)
    folder, out, schema = str(tmp_path / "arrived"), str(tmp_path / "out"), "fingerprint string, at bigint"
    held, parts = [], [[(f"k{b}-{i}", b) for i in range(200)] + [(f"k{max(0, b - 2)}-{i}", b) for i in range(100)] for b in range(6)]
    for rows in parts:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(folder)
        stream = batches.folder_stream(spark, folder, spark.createDataFrame([], schema).schema)
        query = batches.start(batches.first_arrivals(stream, "fingerprint", ["at"], out, "1 millisecond"), str(tmp_path / "cp"))
        query.awaitTermination()
        held.append(max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]))
    # 300 rows a batch: never more than the batch in hand and the one before it, of 1,800 in all.
    assert max(held) <= 600
    whole = spark.createDataFrame([r for part in parts for r in part], schema)
    stored = batches.read_commits(spark, out, schema)
    assert sorted(stored.collect()) == sorted(whole.groupBy("fingerprint").agg(F.min("at").alias("at")).collect())
    # A lost checkpoint takes all arrivals again and stores none of them.
    drain(batches.first_arrivals(batches.folder_stream(spark, folder, whole.schema), "fingerprint", ["at"], out), str(tmp_path / "new"))
    assert batches.read_commits(spark, out, schema).count() == 1_200


def test_late_events_count(spark, tmp_path):
    out, schema = str(tmp_path / "out"), "transfer_session_id string, timestamp timestamp, event_id bigint, outcome string, bytes_transferred bigint"
    day = lambda d: dt.datetime(2024, 1, d)
    parts = [[("s", day(30 - i), i, "success" if i else "failure", 1), ("t", day(1), 100 + i, "success", None)] for i in range(5)]
    arrivals(spark, tmp_path, schema, parts, lambda s: s.writeStream.foreachBatch(batches.timeline_batches(out)))
    rows = [r for part in parts for r in part]
    whole = spark.createDataFrame(rows, schema)
    merged = batches.read_timelines(whole, out)
    assert sorted(merged.collect()) == sorted(audit.session_timeline(whole).collect())
    assert merged.agg(F.sum("events")).first()[0] == 10


def test_job_state_over_batches_with_a_hot_job(spark, tmp_path):
    out, schema = str(tmp_path / "out"), "job bigint, seq bigint, status string"
    hot = [(7, 1_000 + i, "running") for i in range(5_000)]
    parts = [
        [(1, 0, "pending"), (2, 0, "running"), (3, 0, "pending"), (3, 1, "cancelled"), (7, 0, "pending"), *hot],
        [(1, 1, "running"), (2, 1, "pending"), (3, 2, "running"), (7, 9_000, "failed"), *hot],
        [(1, 2, "pending"), (2, 2, "sent"), (1, 3, "sent"), (7, 9_001, "sent")], [(2, 3, "running"), (2, 4, "other"), (2, 5, "sent")]]
    advance = jobs.job_state_batches(out)
    arrivals(spark, tmp_path, schema, parts, lambda s: s.writeStream.foreachBatch(advance))
    state = lambda: {r["job"]: (r["status"], r["seq"]) for r in jobs.read_job_states(spark, out).collect()}
    expected = {1: ("sent", 3), 2: ("sent", 5), 3: ("cancelled", 1), 7: ("failed", 9_000)}
    assert state() == expected
    advance(spark.createDataFrame(parts[1], schema), 1)  # a replayed batch decides as it did
    assert state() == expected


def test_dedup_within_watermark(spark, tmp_path):
    path, start = str(tmp_path / "in"), dt.datetime(2024, 1, 1)
    rows = [(f"f{i % 4}", start + dt.timedelta(seconds=i)) for i in range(40)]
    df = spark.createDataFrame(rows, "fingerprint string, at timestamp")
    df.write.parquet(path)
    kept = batches.dedup_within_watermark(batches.folder_stream(spark, path, df.schema), "fingerprint", "at", "1 hour")
    out = str(tmp_path / "out")
    drain(kept.writeStream.foreachBatch(batches.store_batches(lambda d: d, out)), str(tmp_path / "cp"))
    assert batches.read_batches(spark, out, "fingerprint string, at timestamp").count() == 4


def test_replayed_batches_do_not_add_rows(spark, tmp_path):
    out = str(tmp_path / "out")
    store = batches.store_batches(lambda df: df, out)
    for batch_id in (0, 1, 1, 0):
        store(spark.range(batch_id * 10, batch_id * 10 + 5), batch_id)
    assert batches.read_batches(spark, out, "id bigint").count() == 10


def test_compaction_keeps_the_newest_state(spark, tmp_path):
    out, small, schema = str(tmp_path / "out"), str(tmp_path / "small"), "k string, v bigint"
    store = batches.store_batches(lambda df: df, out)
    store(spark.createDataFrame([("a", 1), ("b", 1)], schema), 0)
    store(spark.createDataFrame([("a", 2)], schema), 1)
    batches.compact_batches(spark, out, schema, ["k"], small)
    rows = batches.read_batches(spark, small, schema).collect()
    assert {(r["k"], r["v"], r["batch_id"]) for r in rows} == {("a", 2, 1), ("b", 1, 1)}


def live_spans(table, spark):
    return [last - first + 1 for first, last in table.parts(spark)]


def test_parts_double_and_old_ones_go(spark, tmp_path):
    table = Levels(str(tmp_path / "t"), "k bigint, v bigint", ("k",), lambda rows: batches.latest_per_key(rows, ["k"]), 4)
    for i in range(13):
        table.store(spark.range(3).selectExpr("id AS k", f"{i} * 10 + id AS v"), i)
        assert sum(live_spans(table, spark)) == i + 1 and len(live_spans(table, spark)) == bin(i + 1).count("1")
    assert live_spans(table, spark) == [8, 4, 1]
    assert len(os.listdir(table.path)) <= 4 + 2 * GRACE
    assert sorted(map(tuple, table.merged(spark).select("k", "v").collect())) == [(0, 120), (1, 121), (2, 122)]


def test_replayed_and_half_written_parts(spark, tmp_path):
    table = Levels(str(tmp_path / "t"), "k bigint, n bigint", ("k",), lambda rows: rows.groupBy("k").agg(F.sum("n").alias("n")), 4)
    rows = spark.range(5).selectExpr("id AS k", "1 AS n")
    for i in (0, 1, 1, 2, 3):
        table.store(rows, i)
    os.remove(f"{table.path}/{0:012d}-{3:012d}/_SUCCESS")  # the writer of batch 3 was lost
    assert live_spans(table, spark) == [2, 1]
    for i in (3, 3, 1, 0):  # taken again; batches that others have followed are not
        table.store(rows, i)
    assert sorted(map(tuple, table.merged(spark).collect())) == [(k, 4) for k in range(5)]


def test_only_touched_folders_are_read(spark, tmp_path):
    table = Levels(str(tmp_path / "t"), "k bigint, n bigint", ("k",), lambda rows: rows.groupBy("k").agg(F.max("n").alias("n")))
    assert table.read(spark).count() == 0 and table.next_id(spark) == 0
    table.store(spark.range(1_000).selectExpr("CAST(id AS INT) AS k", "id AS n"), 0)
    one = table.read(spark, touched=spark.createDataFrame([(7,)], "k int"))
    assert 0 < one.count() < 100 and one.where("k = 7").count() == 1
    assert table.read(spark, touched=spark.createDataFrame([], "k int")).count() == 0


def test_rows_read_do_not_grow_with_the_age_of_the_stream(spark, tmp_path):
    out, schema = str(tmp_path / "out"), "job bigint, seq bigint, status string"
    advance, table, read, parts = jobs.job_state_batches(out), jobs.job_levels(out), {}, {}
    jobs_in_hand = spark.createDataFrame([(job,) for job in range(8)], "job bigint")
    for i in [0, 1, 2, 3, 20, 21, 22, 23, 200, 201, 202, 203]:
        status = {0: "pending", 2: "running", 21: "sent"}.get(i, "running")
        for _ in range(2 if i == 21 else 1):  # the second time it is a replay
            advance(spark.createDataFrame([(job, i, status) for job in range(8)], schema), i)
        read[i], parts[i] = table.read(spark, i + 1, jobs_in_hand).count(), len(table.parts(spark))
    assert {(r["status"], r["seq"]) for r in jobs.read_job_states(spark, out).collect()} == {("sent", 21)}
    assert max(read[i] for i in read if i >= 200) <= max(read[i] for i in read if 20 <= i < 30) <= 3 * 8
    assert max(parts.values()) <= 8


def test_timelines_have_a_row_a_level(spark, tmp_path):
    out, schema = str(tmp_path / "out"), "transfer_session_id string, timestamp timestamp, event_id bigint, outcome string, bytes_transferred bigint"
    rows = [[("s", dt.datetime(2024, 1, 1, minute=(7 * i) % 60), i, "success" if i % 3 else "failure", i if i % 2 else None)] for i in range(7)]
    store = batches.timeline_batches(out)
    for i, part in enumerate(rows):
        store(spark.createDataFrame(part, schema), i)
    store(spark.createDataFrame(rows[6], schema), 6)
    whole = spark.createDataFrame([r for part in rows for r in part], schema)
    assert batches.read_timelines(whole, out).collect() == audit.session_timeline(whole).collect()
    assert batches.timeline_levels(out, whole).read(spark).count() == 3  # 4 + 2 + 1


def test_contents_are_stored_once_without_the_checkpoint(spark, tmp_path):
    folder, out, schema = str(tmp_path / "arrived"), str(tmp_path / "out"), "k string, size bigint"
    store, stored = batches.commit_batches(out), lambda: sorted(map(str, batches.read_commits(spark, out, schema).collect()))

    def run(checkpoint, files_per_batch):
        source = batches.folder_stream(spark, folder, spark.createDataFrame([], schema).schema, files_per_batch)
        drain(source.writeStream.foreachBatch(store), str(tmp_path / checkpoint))
    assert stored() == []
    parts = [[("a", 1), ("b", None), ("a", 1)], [("c", 3), (None, None)], [("b", None), ("d", 4)], [("e", 5)]]
    for rows in parts[:3]:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        run("first", 1)
    before, commits = stored(), len(os.listdir(f"{out}/data"))
    run("second", 2)  # all again, in other batches
    assert stored() == before and len(os.listdir(f"{out}/data")) <= commits + 1
    spark.createDataFrame(parts[3], schema).write.mode("append").parquet(folder)
    run("third", 100)
    assert stored() == sorted(map(str, spark.createDataFrame([r for part in parts for r in part], schema).distinct().collect()))


def test_data_without_a_commit_is_written_over(spark, tmp_path):
    out, schema = str(tmp_path / "out"), "k string, size bigint"
    store, rows = batches.commit_batches(out, ["k"]), spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], schema)
    store(rows, 0)
    uncommitted = spark.read.parquet(f"{out}/data/commit=0")
    uncommitted.write.parquet(f"{out}/data/commit=1")  # a writer that was lost before its commit
    assert batches.read_commits(spark, out, schema).count() == 2
    store(spark.createDataFrame([("c", 1), ("b", 9)], schema), 1)
    assert sorted(map(tuple, batches.read_commits(spark, out, schema).collect())) == [("a", 1), ("b", 1), ("c", 1)]

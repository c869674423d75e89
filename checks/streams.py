"""Streams over the test tables, drained and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.session import run_folder
from tidegate.streaming import batches, jobs as job_stream

from .audits import _STATE_SQL
from .registry import check
from .tables import Tables, text_time
from .views import with_replay


def _drain(query) -> None:
    query.awaitTermination()


def _arrive(rows, part: str, path: str, run, parts: int = 4) -> None:
    """Let the rows arrive in parts: write one, drain the stream, write the next."""
    for i in range(parts):
        rows.where(F.expr(f"{part} = {i}")).write.mode("append").parquet(path)
        _drain(run())


@check("stream_new_files", "SELECT doc_id, sha256(text) AS sha256 FROM documents")
def stream_new_files(t: Tables):
    out = run_folder(t.spark, "new-files")
    source = batches.table_stream(t.spark, t.root, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))
    for _ in range(2):
        store = batches.store_batches(lambda df: df, f"{out}/table")
        _drain(batches.start(source.writeStream.foreachBatch(store), f"{out}/checkpoint"))
    return batches.read_batches(t.spark, f"{out}/table", batches.ddl(source)).select("doc_id", "sha256")


@check("stream_dedup_requests", """
    SELECT fingerprint, min(c_custkey % 4 * 1000000000 + c_custkey) % 1000000000 AS c_custkey FROM fingerprints GROUP BY fingerprint""")
def stream_dedup_requests(t: Tables):
    job_stream.use_state_store(t.spark)
    rows, out = t.fingerprints().select("fingerprint", "c_custkey"), run_folder(t.spark, "dedup")

    def run():
        source = batches.folder_stream(t.spark, f"{out}/arrived", rows.schema)
        return batches.start(batches.first_arrivals(source, "fingerprint", ["c_custkey"], f"{out}/table"), f"{out}/checkpoint")

    _arrive(rows, "c_custkey % 4", f"{out}/arrived", run)
    return batches.read_commits(t.spark, f"{out}/table", batches.ddl(rows)).select("fingerprint", "c_custkey")


@check("stream_session_timeline", "SELECT * FROM timeline")
def stream_session_timeline(t: Tables):
    """Newest events first, so most of them come late."""
    events, out = t.audit(), run_folder(t.spark, "timeline")
    store = batches.timeline_batches(f"{out}/table")

    def run():
        source = batches.folder_stream(t.spark, f"{out}/arrived", events.schema)
        return batches.start(source.writeStream.foreachBatch(store), f"{out}/checkpoint")

    _arrive(events, "CAST(3 - least(3, day(timestamp) div 8) AS INT)", f"{out}/arrived", run)
    return batches.read_timelines(events, f"{out}/table").withColumns({"first_ts": text_time("first_ts"), "last_ts": text_time("last_ts")})


@check("stream_store_idempotent", "SELECT agency, session, count(*) AS members, CAST(sum(size) AS BIGINT) AS bytes FROM files GROUP BY agency, session")
def stream_store_idempotent(t: Tables):
    """The checkpoint is lost after the third part; the new one takes all parts again, in one batch."""
    files, out = t.files().select("doc_id", "agency", "session", "size"), run_folder(t.spark, "store")
    store = batches.commit_batches(f"{out}/table")

    def run(checkpoint: str):
        source = batches.folder_stream(t.spark, f"{out}/arrived", files.schema)
        _drain(batches.start(source.writeStream.foreachBatch(store), f"{out}/{checkpoint}"))

    for i in range(4):
        files.where(f"doc_id % 4 = {i}").write.mode("append").parquet(f"{out}/arrived")
        if i % 2 == 0:
            run("checkpoint")
    run("checkpoint-after-loss")
    stored = batches.read_commits(t.spark, f"{out}/table", batches.ddl(files))
    return stored.groupBy("agency", "session").agg(F.count("*").alias("members"), F.sum("size").alias("bytes"))


@check("stream_job_state", f"SELECT job, status, seq FROM ({_STATE_SQL})", with_replay)
def stream_job_state(t: Tables):
    events, out = t.job_events(), run_folder(t.spark, "job-state")
    advance = job_stream.job_state_batches(f"{out}/table", "result", "error")

    def run():
        source = batches.folder_stream(t.spark, f"{out}/arrived", events.schema)
        return batches.start(source.writeStream.foreachBatch(advance), f"{out}/checkpoint")

    _arrive(events, "CAST(least(seq, 3) AS INT)", f"{out}/arrived", run)
    return job_stream.read_job_states(t.spark, f"{out}/table")

"""Audit events and job histories."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.operators import audit, jobs

from .registry import check
from .tables import Tables, joined, text_time
from .views import with_replay

_STAGE_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in audit.EVENT_STAGES.items()) + " END"


@check("audit_events", f"""
    SELECT event_type, transfer_session_id, strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%fZ') AS timestamp, 'north' AS sender_agency, '' AS receiver_agency,
           {_STAGE_SQL} AS stage, outcome, NULL AS destination_host, bytes_transferred,
           CASE WHEN event_id % 4 = 0 THEN '' ELSE concat('k=', json_extract_string(details, '$.k')) END AS details FROM audit""")
def audit_events(t: Tables):
    details = F.when(F.col("event_id") % 4 != 0, F.from_json("details", "map<string,string>"))
    events = audit.audit_events(t.audit().withColumn("sender_agency", F.lit("north")), details)
    shown = F.array_join(F.transform(F.map_entries("details"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return events.withColumn("details", shown)


@check("audit_event_check", """
    SELECT event_id, array_to_string([c FOR c IN [CASE WHEN event_id % 10 = 1 THEN 'event_type_unknown' END, CASE WHEN event_id % 10 = 2 THEN 'session_blank' END,
        CASE WHEN event_id % 10 = 3 THEN 'outcome_unknown' END, CASE WHEN event_id % 10 = 4 AND bytes_transferred > 0 THEN 'bytes_negative' END] IF c IS NOT NULL], ',') AS violations
    FROM audit""")
def audit_event_check(t: Tables):
    noisy = t.audit().withColumns({
        "event_type": F.expr("CASE WHEN event_id % 10 = 1 THEN 'upload' ELSE event_type END"),
        "transfer_session_id": F.expr("CASE WHEN event_id % 10 = 2 THEN ' ' ELSE transfer_session_id END"),
        "outcome": F.expr("CASE WHEN event_id % 10 = 3 THEN NULL ELSE outcome END"),
        "bytes_transferred": F.expr("CASE WHEN event_id % 10 = 4 THEN -bytes_transferred ELSE bytes_transferred END")})
    return audit.audit_event_check(noisy).select("event_id", joined("violations"))


@check("stage_of_event", f"SELECT event_id, {_STAGE_SQL} AS stage FROM audit")
def stage_of_event(t: Tables):
    return t.audit().select("event_id", audit.stage_of_event(F.col("event_type")).alias("stage"))


@check("session_timeline", "SELECT * FROM timeline")
def session_timeline(t: Tables):
    timeline = audit.session_timeline(t.audit())
    return timeline.withColumns({"first_ts": text_time("first_ts"), "last_ts": text_time("last_ts")})


@check("session_completeness", f"""
    SELECT transfer_session_id, array_to_string([e FOR e IN ['{"', '".join(audit.EVENT_STAGES)}'] IF NOT list_contains(seen, e)], ',') AS missing,
           list_contains(seen, 'pipeline_complete') AS completed
    FROM (SELECT transfer_session_id, list(DISTINCT event_type) AS seen FROM audit GROUP BY transfer_session_id)""")
def session_completeness(t: Tables):
    return audit.session_completeness(t.audit()).select("transfer_session_id", joined("missing"), "completed")


@check("job_transitions", """
    SELECT job, seq, status, before AS state_before, coalesce(accepted, false) AS accepted,
           CASE WHEN accepted THEN NULL WHEN (status = 'sent' AND result IS NULL) OR (status = 'failed' AND error = '') THEN 'incomplete_step'
                WHEN before IS NULL THEN 'job_not_found' WHEN status = 'pending' THEN 'duplicate_job' ELSE 'invalid_transition' END AS reason
    FROM replay""", with_replay)
def job_transitions(t: Tables):
    return jobs.job_transitions(t.job_events(), "result", "error").select("job", "seq", "status", "state_before", "accepted", "reason")


_STATE_SQL = """SELECT job, status, seq, CASE WHEN status = 'sent' THEN result END AS result, CASE WHEN status = 'failed' THEN error END AS error
    FROM (SELECT *, row_number() OVER (PARTITION BY job ORDER BY seq DESC) AS back FROM replay WHERE accepted) WHERE back = 1"""


@check("job_state", _STATE_SQL, with_replay)
def job_state(t: Tables):
    return jobs.job_state(t.job_events(), "result", "error")


@check("busy_state", f"""SELECT coalesce(bool_or(status IN ('pending', 'running')), false) AS busy,
    count(*) FILTER (WHERE status IN ('pending', 'running')) AS open_jobs FROM ({_STATE_SQL})""", with_replay)
def busy_state(t: Tables):
    return jobs.busy_state(jobs.job_state(t.job_events(), "result", "error"))


@check("concurrent_jobs", """
    SELECT agent, run_id, strftime(start_ts, '%Y-%m-%d %H:%M:%S.%f') AS start_ts, strftime(end_ts, '%Y-%m-%d %H:%M:%S.%f') AS end_ts
    FROM (SELECT *, max(end_ts) OVER (PARTITION BY agent ORDER BY start_ts, run_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest FROM runs)
    WHERE latest > start_ts""")
def concurrent_jobs(t: Tables):
    return jobs.concurrent_jobs(t.runs()).select("agent", "run_id", text_time("start_ts"), text_time("end_ts"))


@check("duplicate_jobs", """
    SELECT job, count(*) FILTER (WHERE status = 'pending') AS submissions FROM job_events GROUP BY job HAVING count(*) FILTER (WHERE status = 'pending') > 1""")
def duplicate_jobs(t: Tables):
    return jobs.duplicate_jobs(t.job_events())

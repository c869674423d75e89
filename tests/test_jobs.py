"""Job replay and overlap against row-by-row brute force."""

import datetime as dt
import random

import pytest

from tidegate.operators import jobs
from tidegate.streaming.batches import latest_per_key, read_batches
from tidegate.streaming.jobs import STATE_SCHEMA, job_state_batches

MOVES = {None: {"pending"}, "pending": {"running", "cancelled"}, "running": {"sent", "failed", "cancelled"}}


def replay(steps):
    """Accepted flag and state before each step."""
    state, out = None, []
    for seq, status, result, error in steps:
        usable = status in jobs.STATUSES and not (status == "sent" and result is None) and not (status == "failed" and not error)
        ok = usable and status in MOVES.get(state, ())
        out.append((seq, state, ok))
        state = status if ok else state
    return state, out


def histories(seed, n_jobs=60, hot=2_000):
    rng = random.Random(seed)
    statuses = [*jobs.STATUSES, "lost"]
    for job in range(n_jobs):
        length = hot if job == 0 else rng.randrange(1, 12)
        yield job, [
            (seq, rng.choice(statuses if job else ["running", "sent", "lost"]) if seq != 700 or job else "pending",
             rng.choice([None, "r"]), rng.choice([None, "", "e"]))
            for seq in range(length)
        ]


@pytest.mark.parametrize("seed", [1, 2])
def test_replay_equals_a_fold(spark, seed):
    data = list(histories(seed))
    rows = [(job, *step) for job, steps in data for step in steps]
    df = spark.createDataFrame(rows, "job bigint, seq bigint, status string, result string, error string").repartition(5)
    got = {(r["job"], r["seq"]): (r["state_before"], r["accepted"]) for r in jobs.job_transitions(df, "result", "error").collect()}
    states = {r["job"]: r["status"] for r in jobs.job_state(df, "result", "error").collect()}
    for job, steps in data:
        final, expected = replay(steps)
        assert states.get(job) == final
        for seq, before, ok in expected:
            assert got[job, seq] == (before, ok)


def test_state_shows_result_or_error_of_its_step(spark):
    rows = [(1, 0, "pending", None, None), (1, 1, "running", None, None), (1, 2, "sent", "sum", "x"),
            (2, 0, "pending", None, None), (2, 1, "running", None, None), (2, 2, "failed", "sum", "boom")]
    df = spark.createDataFrame(rows, "job bigint, seq bigint, status string, result string, error string")
    got = {r["job"]: (r["status"], r["result"], r["error"]) for r in jobs.job_state(df, "result", "error").collect()}
    assert got == {1: ("sent", "sum", None), 2: ("failed", None, "boom")}


def test_state_over_split_batches(spark, tmp_path):
    """Random histories cut at two random places reach the state of the whole history."""
    rng, expected, parts = random.Random(3), {}, ([], [], [])
    for job in range(150):
        steps = [(seq, rng.choice(jobs.STATUSES), "r", "e") for seq in range(rng.randrange(1, 15))]
        expected[job] = replay(steps)[0]
        cuts = sorted(rng.randrange(0, len(steps) + 1) for _ in range(2))
        for part, chosen in zip(parts, (steps[:cuts[0]], steps[cuts[0]:cuts[1]], steps[cuts[1]:])):
            part += [(job, seq, status) for seq, status, _, _ in rng.sample(chosen, len(chosen))]
    out = str(tmp_path / "out")
    advance = job_state_batches(out)
    for batch_id, part in enumerate(parts):
        advance(spark.createDataFrame(part, "job bigint, seq bigint, status string"), batch_id)
    got = {r["job"]: r["status"] for r in latest_per_key(read_batches(spark, out, STATE_SCHEMA), ["job"]).collect()}
    assert got == {job: state for job, state in expected.items() if state}


def overlap(runs):
    """Runs that start before the latest end of the agent's earlier runs."""
    found, latest = set(), {}
    for agent, run, start, end in sorted(runs, key=lambda r: (r[0], r[2], r[1])):
        if agent in latest and latest[agent] > start:
            found.add(run)
        latest[agent] = max(latest.get(agent, end), end)
    return found


@pytest.mark.parametrize("spread", [3, 90_000, 400_000])
def test_concurrent_runs(spark, spread):
    """Ties on the start time, empty runs, runs over midnight, one agent with most runs."""
    rng, zero = random.Random(spread), dt.datetime(2024, 2, 27, 12)
    runs = []
    for run in range(1_500):
        start = zero + dt.timedelta(seconds=rng.randrange(spread), microseconds=rng.choice([0, 0, 5]))
        runs.append(("hot" if rng.random() < 0.7 else f"a{rng.randrange(5)}", run, start,
                     start + dt.timedelta(seconds=rng.choice([0, 0, 1, 30, spread // 50]))))
    df = spark.createDataFrame(runs, "agent string, run_id bigint, start_ts timestamp_ntz, end_ts timestamp_ntz").repartition(6)
    assert {r["run_id"] for r in jobs.concurrent_jobs(df).collect()} == overlap(runs)


def scans(df, table):
    """How often a finished plan reads a table; reused exchanges read nothing."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return sum("FileScan" in line and table in line for line in plan.splitlines())


def test_two_scans_are_enough(spark, tmp_path):
    events = spark.range(200).selectExpr("id % 20 AS job", "id AS seq", "element_at(array('pending', 'running', 'sent'), CAST(id % 3 + 1 AS INT)) AS status")
    events.write.parquet(str(tmp_path / "jobevents"))
    stored = spark.read.parquet(str(tmp_path / "jobevents"))
    assert scans(jobs.job_state(stored), "jobevents") == 0 and scans(jobs.job_transitions(stored), "jobevents") == 1  # and one to write the steps
    runs = spark.range(300).selectExpr(
        "id % 3 AS agent", "id AS run_id", "timestamp_seconds(id * 40) AS start_ts", "timestamp_seconds(id * 40 + id % 100) AS end_ts")
    runs.write.parquet(str(tmp_path / "agentruns"))
    assert scans(jobs.concurrent_jobs(spark.read.parquet(str(tmp_path / "agentruns"))), "agentruns") == 1

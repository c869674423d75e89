"""Job histories: replay of a small state machine, admission and overlap.

A job is created ``pending``; from there it may go to ``running`` or
``cancelled``, and from ``running`` to ``sent``, ``failed`` or ``cancelled``.
A step that is not allowed leaves the state as it was, so the state is a fold
over the history. The machine has no cycles: a job takes at most three steps,
and each is the *first* allowed event after the one before. Three ``min``
aggregations therefore replay any history exactly, however long, and no job's
events are gathered or sorted in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..plans.skew import join_back
from ..session import run_folder

# Job states.
STATUSES = ("pending", "running", "sent", "failed", "cancelled")
TERMINAL = ("sent", "failed", "cancelled")


def _usable(result: str | None, error: str | None) -> Column:
    """A ``sent`` step needs a result and a ``failed`` step an error text."""
    ok = F.col("status").isin(*STATUSES)
    if result:
        ok = ok & ~((F.col("status") == "sent") & F.col(result).isNull())
    if error:
        ok = ok & ~((F.col("status") == "failed") & (F.coalesce(F.col(error), F.lit("")) == ""))
    return ok


def usable_steps(events: DataFrame, result: str | None = None, error: str | None = None) -> DataFrame:
    """Steps that could move a job: a known status with what it requires."""
    return events.where(_usable(result, error)).select("job", "seq", "status")


def _first_step(events: DataFrame, statuses: tuple[str, ...], after: DataFrame | None, name: str) -> DataFrame:
    """Per job, the first event with one of the statuses later than the step before."""
    wanted = events.where(F.col("status").isin(*statuses))
    if after is not None:
        wanted = join_back(wanted, after, ["job"], "inner").where(F.col("seq") > F.col("after"))
    return wanted.groupBy("job").agg(F.min(F.struct("seq", "status")).alias(name))


def accepted_steps(events: DataFrame, result: str | None = None, error: str | None = None) -> DataFrame:
    """Per job the steps its history takes: ``created``, ``started`` and ``ended``, each ``(seq, status)``.

    The usable steps are read three times, so they are written once, without the
    rest of the events, to the shared folder.
    """
    folder = run_folder(events.sparkSession, "steps")
    usable_steps(events, result, error).write.parquet(folder)
    usable = events.sparkSession.read.parquet(folder)
    created = _first_step(usable, ("pending",), None, "created")
    started = _first_step(
        usable, ("running", "cancelled"), created.select("job", F.col("created.seq").alias("after")), "started")
    running = started.where(F.col("started.status") == "running")
    ended = _first_step(usable, TERMINAL, running.select("job", F.col("started.seq").alias("after")), "ended")
    return created.join(started, "job", "left").join(ended, "job", "left")


def job_transitions(events: DataFrame, result: str | None = None, error: str | None = None) -> DataFrame:
    """Every step with the state before it, whether it was accepted, and why not."""
    rows = join_back(events, accepted_steps(events, result, error), ["job"])
    seq = F.col("seq")
    state = (
        F.when(F.col("created").isNull() | (seq <= F.col("created.seq")), F.lit(None).cast("string"))
        .when(F.col("started").isNull() | (seq <= F.col("started.seq")), F.lit("pending"))
        .when(F.col("ended").isNull() | (seq <= F.col("ended.seq")), F.col("started.status"))
        .otherwise(F.col("ended.status"))
    )
    accepted = F.lit(False)
    for step in ("created", "started", "ended"):
        hit = (seq == F.col(f"{step}.seq")) & (F.col("status") == F.col(f"{step}.status"))
        accepted = accepted | F.coalesce(hit, F.lit(False))
    reason = (
        F.when(F.col("accepted"), F.lit(None).cast("string"))
        .when(~_usable(result, error), F.lit("incomplete_step"))
        .when(F.col("state_before").isNull(), F.lit("job_not_found"))
        .when(F.col("status") == "pending", F.lit("duplicate_job"))
        .otherwise(F.lit("invalid_transition"))
    )
    return (
        rows.withColumn("state_before", state)
        .withColumn("accepted", accepted)
        .withColumn("reason", reason)
        .drop("created", "started", "ended")
    )


def job_state(events: DataFrame, result: str | None = None, error: str | None = None) -> DataFrame:
    """Latest valid state per job, with the result or error of the step that led there."""
    steps = accepted_steps(events, result, error)
    latest = F.coalesce("ended", "started", "created")
    state = steps.select("job", latest["status"].alias("status"), latest["seq"].alias("seq"))
    extras = [name for name in (result, error) if name]
    if not extras:
        return state
    step_rows = events.select("job", "seq", "status", *extras)
    carried = join_back(step_rows, state.withColumnsRenamed({"seq": "at", "status": "final"}), ["job"], "inner")
    at_step = carried.where((F.col("seq") == F.col("at")) & (F.col("status") == F.col("final")))
    picked = at_step.groupBy("job").agg(*[F.min(name).alias(name) for name in extras])
    shown = {}
    if result:
        shown[result] = F.when(F.col("status") == "sent", F.col(result))
    if error:
        shown[error] = F.when(F.col("status") == "failed", F.col(error))
    return state.join(picked, "job", "left").withColumns(shown)


def busy_state(states: DataFrame) -> DataFrame:
    """One row: is any job pending or running."""
    open_job = F.col("status").isin("pending", "running")
    return states.agg(F.coalesce(F.bool_or(open_job), F.lit(False)).alias("busy"), F.count_if(open_job).alias("open_jobs"))


def duplicate_jobs(events: DataFrame) -> DataFrame:
    """Job ids that were submitted more than once."""
    return events.groupBy("job").agg(F.count_if(F.col("status") == "pending").alias("submissions")).where("submissions > 1")


def _carry(df: DataFrame, value: str, partition: list[str], order: str, name: str) -> DataFrame:
    """Largest value among the earlier rows of a partition."""
    window = W.partitionBy(*partition).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn(name, F.max(value).over(window))


def concurrent_jobs(runs: DataFrame) -> DataFrame:
    """Runs that start while an earlier run of the same agent is still going.

    A running maximum of end times per agent needs the agent's runs in order,
    and one agent may own a third of them. The maximum is therefore built over
    time units: per start time (combined on the map side), per second and per
    day. Each window holds at most the microseconds of a second, the seconds of
    a day or the days of the data, whatever the number of runs. Runs that start
    at the same instant are ordered by id, and the smallest id among those that
    last any time decides for its group.
    """
    spark, folder = runs.sparkSession, run_folder(runs.sparkSession, "starts")
    timed = runs.withColumn("second", F.date_trunc("second", "start_ts")).withColumn("day", F.date_trunc("day", "start_ts"))
    timed = timed.select("agent", "run_id", "start_ts", "end_ts", "second", "day")
    lasting = F.when(F.col("end_ts") > F.col("start_ts"), F.col("run_id"))
    starts = timed.groupBy("agent", "day", "second", "start_ts").agg(
        F.max("end_ts").alias("group_end"), F.min(lasting).alias("first_lasting")
    )
    # One line per start, read three times: written once, so that the runs are scanned twice in all.
    starts.write.parquet(folder)
    starts = spark.read.parquet(folder)
    seconds = starts.groupBy("agent", "day", "second").agg(F.max("group_end").alias("second_end"))
    days = seconds.groupBy("agent", "day").agg(F.max("second_end").alias("day_end"))
    before_day = _carry(days, "day_end", ["agent"], "day", "day_carry").select("agent", "day", "day_carry")
    before_second = _carry(seconds, "second_end", ["agent", "day"], "second", "second_carry").join(
        before_day, ["agent", "day"]
    ).select("agent", "day", "second", F.greatest("second_carry", "day_carry").alias("outer_carry"))
    before_start = _carry(starts, "group_end", ["agent", "day", "second"], "start_ts", "start_carry").join(
        before_second, ["agent", "day", "second"]
    ).select("agent", "start_ts", "first_lasting", F.greatest("start_carry", "outer_carry").alias("latest_end"))
    rows = join_back(runs, before_start, ["agent", "start_ts"])
    overlaps = (F.col("latest_end") > F.col("start_ts")) | (F.col("run_id") > F.col("first_lasting"))
    return rows.where(overlaps).drop("latest_end", "first_lasting")

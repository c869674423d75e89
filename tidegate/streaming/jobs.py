"""The job state machine over a stream of job events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.jobs import accepted_steps, usable_steps
from ..session import run_folder
from .batches import latest_per_key
from .levels import Levels

STATE_SCHEMA = "job bigint, status string, seq bigint"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PAST = -(1 << 62)


def use_state_store(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def _steps_so_far(states: DataFrame) -> DataFrame:
    """A history, before all events, that leads to each job's state."""
    steps = F.when(F.col("status") == "pending", F.array(F.lit("pending"))).when(
        F.col("status") == "running", F.array(F.lit("pending"), F.lit("running"))).otherwise(
        F.array(F.lit("pending"), F.lit("running"), F.col("status")))
    return states.select("job", F.posexplode(steps)).select("job", (F.lit(_PAST) + F.col("pos")).alias("seq"), F.col("col").alias("status"))


def job_levels(path: str) -> Levels:
    return Levels(path, STATE_SCHEMA, ("job",), lambda rows: latest_per_key(rows, ["job"]))


def job_state_batches(path: str, result: str | None = None, error: str | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that stores the jobs whose state moved in each micro-batch.

    The events of a micro-batch are taken in ``seq`` order after all earlier
    batches. They are replayed by the same aggregations as whole histories, behind
    a short history that stands for the job's state, so a job that owns most events
    is combined on the map side. The states are kept in ``levels``: a batch reads
    the folders its jobs fall into, in a logarithmic number of parts, however many
    batches came before. Only earlier batches are consulted, so a replay changes nothing.
    """
    def advance(batch: DataFrame, batch_id: int) -> None:
        spark, table = batch.sparkSession, job_levels(path)
        if table.passed(spark, batch_id):
            return
        folder = run_folder(spark, "events")
        usable_steps(batch, result, error).write.parquet(folder)
        usable = spark.read.parquet(folder)
        jobs = usable.select("job").distinct()
        known = latest_per_key(table.read(spark, batch_id, jobs).join(jobs, "job", "left_semi"), ["job"])
        steps = accepted_steps(_steps_so_far(known).unionByName(usable.select("job", "seq", "status")))
        latest = F.coalesce("ended", "started", "created")
        moved = steps.select("job", latest["status"].alias("status"), latest["seq"].alias("seq")).where(F.col("seq") > _PAST + 2)
        table.store(moved, batch_id)
    return advance


def read_job_states(spark: SparkSession, path: str) -> DataFrame:
    """The state of every job."""
    return job_levels(path).merged(spark)

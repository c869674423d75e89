"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
    # Call sites are captured per column expression otherwise, which dominates the building of wide plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "tidegate", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session with the settings every operator assumes."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**_SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach, named by ``spark.checkpoint.dir``.

    A temporary folder is used only where nothing is named and the session is
    local, as in unit tests; on a cluster an unnamed folder is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = os.path.join(tempfile.gettempdir(), "tidegate-checkpoints")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_run_folders: list[str] = []


def run_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; the writer creates it."""
    _run_folders.append(f"{shared_root(spark)}/tidegate/{label}-{uuid.uuid4().hex}")
    return _run_folders[-1]


def remove_run_folders(spark: SparkSession) -> int:
    """Delete what ``run_folder`` named in this process, once its results are read or stored elsewhere.

    DataFrames that read from such folders must not be used afterwards. Returns
    how many folders were there.
    """
    removed = 0
    while _run_folders:
        target = spark._jvm.org.apache.hadoop.fs.Path(_run_folders.pop())
        removed += target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return removed


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


class ActionTimeout(RuntimeError):
    """A Spark action ran longer than its contract allows."""


@contextmanager
def time_limit(spark: SparkSession, seconds: float):
    """Cancel the Spark jobs started inside the block after ``seconds``.

    The jobs carry a tag, so only they are interrupted and other work of the
    session goes on.
    """
    context, tag = spark.sparkContext, f"limit-{uuid.uuid4().hex}"
    fired = threading.Event()

    def cancel() -> None:
        fired.set()
        context.cancelJobsWithTag(tag)

    timer = threading.Timer(seconds, cancel)
    context.addJobTag(tag)
    timer.start()
    try:
        yield
    except Exception as exc:
        if fired.is_set():
            raise ActionTimeout(f"action exceeded {seconds}s") from exc
        raise
    finally:
        timer.cancel()
        context.removeJobTag(tag)

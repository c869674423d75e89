"""Running governed extracts: one Spark job per contract, data before marker."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..contracts import ExtractSpec
from ..functions.hashing import SourceIdentity, fingerprint
from ..functions.naming import extract_key, query_marker_key
from ..operators.extract import governed_extract
from ..session import path_exists, time_limit
from ..sinks.extracts import write_extract, written_bytes

MARKER_SCHEMA = "fingerprint string, template_id string, output_key string, row_limit bigint, timeout_seconds bigint"
SUMMARY_SCHEMA = (
    "fingerprint string, marker_key string, output_key string, row_count bigint, file_size_bytes bigint, "
    "duration_seconds double, skipped boolean, status string, error string"
)


@dataclass(frozen=True)
class ExtractSummary:
    """What one extract did. A failed one has no marker and may be run again."""

    fingerprint: str
    marker_key: str
    output_key: str = ""
    row_count: int = 0
    file_size_bytes: int = 0
    duration_seconds: float = 0.0
    skipped: bool = False
    status: str = "done"
    error: str = ""


def identify(
    spark: SparkSession, specs: list[ExtractSpec], session: str, source: SourceIdentity = SourceIdentity()
) -> list[tuple[str, str, str]]:
    """Fingerprint, marker key and output key of each contract, from the same expressions bulk plans use."""
    rows = [(i, json.dumps(s.params), s.template_id, s.row_limit, s.timeout_seconds) for i, s in enumerate(specs)]
    table = spark.createDataFrame(rows, "i int, params string, template_id string, row_limit bigint, timeout bigint")
    keyed = table.withColumn("fp", fingerprint(
        F.col("params"), F.col("template_id"), F.col("row_limit"), F.col("timeout"), source))
    named = keyed.select(
        "i", "fp", query_marker_key(F.col("template_id"), F.col("fp")).alias("marker"),
        extract_key(F.lit(session), F.col("template_id"), F.col("fp")).alias("output"),
    )
    return [(r["fp"], r["marker"], r["output"]) for r in named.orderBy("i").collect()]


@dataclass(frozen=True)
class Contract:
    """A contract with its names; without a spec it cannot be run, and ``error`` says why."""

    fingerprint: str
    marker_key: str
    output_key: str
    spec: ExtractSpec | None
    error: str = ""


def read_extract_markers(spark: SparkSession, root: str) -> DataFrame:
    """Markers of finished extracts, empty before the first."""
    if not path_exists(spark, f"{root}/markers"):
        return spark.createDataFrame([], MARKER_SCHEMA)
    return spark.read.schema(MARKER_SCHEMA).parquet(f"{root}/markers")


def finished(spark: SparkSession, root: str, fingerprints: list[str]) -> set[str]:
    """Which of these fingerprints already have a marker."""
    wanted = spark.createDataFrame([(f,) for f in set(fingerprints)], "fingerprint string")
    return {r["fingerprint"] for r in wanted.join(read_extract_markers(spark, root), "fingerprint", "left_semi").collect()}


def _run_one(
    spark: SparkSession, contract: Contract, table: Callable[[str, str], DataFrame], root: str,
    table_key: Callable[[str, str], tuple[str, ...]], output_format: str,
) -> ExtractSummary:
    spec, started, path = contract.spec, time.time(), f"{root}/{contract.output_key}"
    names = (contract.fingerprint, contract.marker_key)
    if spec is None:
        return ExtractSummary(*names, status="failed", error=contract.error)
    try:
        seen = Observation()
        with time_limit(spark, spec.timeout_seconds):
            rows = governed_extract(table(spec.schema, spec.table), spec, table_key(spec.schema, spec.table))
            write_extract(rows.observe(seen, F.count(F.lit(1)).alias("n")), path, output_format)
        return ExtractSummary(
            *names, contract.output_key, seen.get["n"], written_bytes(spark, path), time.time() - started)
    except Exception as exc:  # one failed contract must not stop the others
        return ExtractSummary(
            *names, status="failed", error=f"{type(exc).__name__}: {exc}", duration_seconds=time.time() - started)


def run_contracts(
    spark: SparkSession, contracts: list[Contract], table: Callable[[str, str], DataFrame], root: str,
    table_key: Callable[[str, str], tuple[str, ...]], output_format: str, parallel: int,
) -> DataFrame:
    """Run contracts side by side and return a summary row for each, in order.

    Markers of those that succeeded are written in one commit after all data; if
    that is never reached, the same files are written again.
    """
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        run = inheritable_thread_target(spark)(_run_one)
        futures = [pool.submit(run, spark, c, table, root, table_key, output_format) for c in contracts]
        summaries = [future.result() for future in futures]
    markers = [(c.fingerprint, c.spec.template_id, c.output_key, c.spec.row_limit, c.spec.timeout_seconds)
               for c, s in zip(contracts, summaries) if s.status == "done"]
    if markers:
        spark.createDataFrame(markers, MARKER_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/markers")
    return spark.createDataFrame([tuple(asdict(s).values()) for s in summaries], SUMMARY_SCHEMA)


def run_extracts(
    spark: SparkSession,
    specs: list[ExtractSpec],
    table: Callable[[str, str], DataFrame],
    root: str,
    session: str,
    table_key: Callable[[str, str], tuple[str, ...]] = lambda schema, name: (),
    output_format: str = "csv",
    parallel: int = 4,
) -> DataFrame:
    """Run contracts that have no marker yet and return one summary row per contract.

    Rows are counted while they are written. A contract listed twice, or run in
    an earlier call, is skipped. For contracts that come from a table of
    requests, however many, see ``plans.requests``.
    """
    keys = identify(spark, specs, session)
    done = finished(spark, root, [k[0] for k in keys])
    todo: dict[str, Contract] = {}
    rows: list = []
    for spec, (fp, marker, output) in zip(specs, keys):
        if fp in done or fp in todo:
            rows.append(tuple(asdict(ExtractSummary(fp, marker, skipped=True, status="skipped")).values()))
        else:
            todo[fp] = Contract(fp, marker, output, spec)
            rows.append(fp)
    ran = run_contracts(spark, list(todo.values()), table, root, table_key, output_format, parallel)
    by_key = {r["fingerprint"]: tuple(r) for r in ran.collect()}
    return spark.createDataFrame([by_key.get(row, row) for row in rows], SUMMARY_SCHEMA)

"""From a table of requests to extracts, in one run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import SourceIdentity, fingerprint
from ..operators.audit import audit_events
from ..operators.governance import policy_decision, request_decision
from ..operators.idempotency import plan_extracts
from ..session import run_folder
from ..sinks.transfers import write_audit_log
from .extracts import read_extract_markers
from .shared import run_shared

def request_events(outcome: DataFrame, agency: str, receiver: str) -> DataFrame:
    """The audit events a sender leaves for each request: start, policy, and the extract where one was run."""
    def step(name: str, ok) -> F.Column:
        return F.struct(F.lit(name).alias("event_type"), F.when(ok, "success").otherwise("failure").alias("outcome"))

    accepted, allowed, ran = F.col("decision") != "rejected", F.col("decision") == "accepted", F.col("action") == "run"
    steps = F.array_compact(F.array(
        step("pipeline_start", accepted), F.when(accepted, step("policy_check", allowed)),
        F.when(allowed & ran, step("extract_data", F.col("status") == "done"))))
    rows = outcome.select("*", F.inline(steps)).withColumns({
        "transfer_session_id": F.col("request_id"), "sender_agency": F.lit(agency), "receiver_agency": F.lit(receiver),
        "timestamp": F.current_timestamp()})
    details = F.create_map(*[x for name in ("decision", "first_violation", "action", "fingerprint", "output_key", "error")
                             for x in (F.lit(name), F.col(name).cast("string"))])
    return audit_events(rows, F.map_filter(details, lambda _, value: value.isNotNull()))


def run_requests(
    spark: SparkSession, requests: DataFrame, active: DataFrame, table: Callable[[str, str], DataFrame], root: str, session: str,
    agency: str, receiver: str = "", table_key: Callable[[str, str], tuple[str, ...]] = lambda schema, name: (),
    output_format: str = "csv", audit_path: str | None = None,
) -> DataFrame:
    """Decide all requests, run each accepted contract once, and return one row per request.

    ``decision`` is ``accepted``, ``rejected`` (``first_violation`` says why) or ``denied`` by policy.
    Requests with the same contract share one extract; ``action`` says which of them ran it.
    Contracts with a marker from an earlier run are not run again. Requests and contracts stay
    tables; contracts of one layout share a scan, whatever their number (``plans.shared``).
    """
    decided = request_decision(requests, active)
    policy = policy_decision(F.col("requesting_agency"), F.lit(1))
    decided = decided.withColumn("reason", F.when(policy["decision"] != "allow", policy["reason"])).withColumn(
        "decision", F.when((F.col("decision") == "accepted") & F.col("reason").isNotNull(), "denied").otherwise(F.col("decision")))
    shown = ["request_id", "decision", "first_violation"]
    contract = ["params", "effective_template_id", "effective_row_limit", "effective_timeout_seconds"]
    folder = run_folder(spark, "requests")
    decided.select(*shown[:2], F.coalesce("first_violation", "reason").alias("first_violation"), *contract).write.parquet(f"{folder}/decided")
    decided = spark.read.parquet(f"{folder}/decided")
    accepted = decided.where("decision = 'accepted'").withColumns({
        "fingerprint": fingerprint(F.col("params"), F.col("effective_template_id"), F.col("effective_row_limit"),
                                   F.col("effective_timeout_seconds"), SourceIdentity()),
        "template_id": F.col("effective_template_id"), "session": F.lit(session)})
    plan_extracts(accepted, read_extract_markers(spark, root), ["request_id"]).write.parquet(f"{folder}/planned")
    planned = spark.read.parquet(f"{folder}/planned")
    contracts = planned.where("action = 'run'").select(
        "fingerprint", "marker_key", "output_key", "template_id", "params", F.col("effective_row_limit").alias("row_limit"),
        F.col("effective_timeout_seconds").alias("timeout_seconds"))
    outcomes = run_shared(spark, contracts, table, root, table_key, output_format)
    known = planned.select("request_id", "fingerprint", "action").join(outcomes.select(
        "fingerprint", "output_key", "row_count", "status", "error"), "fingerprint", "left")
    finished = F.when(F.col("action") == "skip_done", F.lit("skipped")).otherwise(F.col("status"))
    outcome = decided.select(*shown).join(known.withColumn("status", finished), "request_id", "left")
    if audit_path:
        write_audit_log(request_events(outcome, agency, receiver), audit_path)
    return outcome

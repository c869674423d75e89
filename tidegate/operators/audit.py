"""The audit trail: typed events, their checks and per-session views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import violations
from ..functions.text import is_blank

# Event types in lifecycle order with the stage each one belongs to.
EVENT_STAGES = {
    "pipeline_start": "sender",
    "extract_data": "sender",
    "policy_check": "sender",
    "compress": "sender",
    "manifest_created": "sender",
    "sftp_transfer_start": "transfer",
    "sftp_transfer_complete": "transfer",
    "validate_manifest": "receiver",
    "decompress": "receiver",
    "virus_scan": "receiver",
    "store_data": "receiver",
    "pipeline_complete": "receiver",
}
OUTCOMES = ("success", "partial", "failure")
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def stage_of_event(event_type: Column) -> Column:
    """Fixed stage of an event type, null for an unknown one."""
    pairs = [F.lit(text) for item in EVENT_STAGES.items() for text in item]
    return F.create_map(*pairs)[event_type]


def _or_null(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def audit_events(df: DataFrame, details: Column | None = None) -> DataFrame:
    """Rows in the ten-column event schema; absent details become an empty map."""
    details = F.lit(None).cast("map<string,string>") if details is None else details
    empty = F.create_map().cast("map<string,string>")
    stage = _or_null(df, "stage", "string")
    return df.select(
        F.col("event_type"),
        F.col("transfer_session_id"),
        F.date_format("timestamp", TIMESTAMP_FORMAT).alias("timestamp"),
        F.coalesce(_or_null(df, "sender_agency", "string"), F.lit("")).alias("sender_agency"),
        F.coalesce(_or_null(df, "receiver_agency", "string"), F.lit("")).alias("receiver_agency"),
        F.coalesce(stage, stage_of_event(F.col("event_type"))).alias("stage"),
        F.col("outcome"),
        _or_null(df, "destination_host", "string").alias("destination_host"),
        _or_null(df, "bytes_transferred", "bigint").alias("bytes_transferred"),
        F.coalesce(details, empty).alias("details"),
    )


def audit_event_check(events: DataFrame) -> DataFrame:
    """Adds ``violations``: unknown type or outcome, blank session or stage, negative bytes."""
    c = F.col
    rules = [
        ("event_type_unknown", ~F.coalesce(c("event_type").isin(*EVENT_STAGES), F.lit(False))),
        ("session_blank", is_blank(c("transfer_session_id"))),
        ("outcome_unknown", ~F.coalesce(c("outcome").isin(*OUTCOMES), F.lit(False))),
        ("bytes_negative", c("bytes_transferred") < 0),
    ]
    if "stage" in events.columns:
        rules.append(("stage_missing", c("stage").isNull()))
    return events.withColumn("violations", violations(*rules))


def routing_events(routed: DataFrame, receiver: str) -> DataFrame:
    """The audit events a receiver run leaves for each session, from its outcome.

    The steps that were passed succeed, the one that ended the session fails.
    """
    def step(name: str, ok: bool = True):
        return F.struct(F.lit(name).alias("event_type"), F.lit("success" if ok else "failure").alias("outcome"))

    passed = [step("extract_data"), step("validate_manifest"), step("decompress"), step("virus_scan"), step("store_data")]
    status, reason = F.col("status"), F.col("reason")
    steps = (
        F.when(status == "already_processed", F.array(step("store_data")))
        .when(status == "processed", F.array(*passed))
        .when(status == "rejected", F.array(*passed[:3], step("virus_scan", False), step("store_data", False)))
        .when(reason == "scan_error", F.array(*passed[:2], step("decompress", False)))
        .otherwise(F.array(passed[0], step("validate_manifest", False)))
    )
    rows = routed.select("agency", "session", "status", "reason", F.inline(steps)).withColumns({
        "transfer_session_id": F.col("session"), "sender_agency": F.col("agency"), "receiver_agency": F.lit(receiver),
        "timestamp": F.current_timestamp(),
    })
    return audit_events(rows, F.map_filter(
        F.create_map(F.lit("status"), F.col("status"), F.lit("reason"), F.col("reason")), lambda _, v: v.isNotNull()))


def timeline_columns(order: list[str]) -> list[Column]:
    """Aggregates of one session. They can be merged, so a part of a session has the same columns."""
    position = F.struct(*order)
    return [
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"),
        F.count("*").alias("events"),
        F.count_if(F.col("outcome") == "failure").alias("failures"),
        F.sum("bytes_transferred").alias("bytes"),
        F.max(position).alias("last_position"),
        F.max_by("outcome", position).alias("final_outcome"),
    ]


def _with_duration(timeline: DataFrame) -> DataFrame:
    micros = lambda name: F.unix_micros(F.col(name).cast("timestamp"))
    return timeline.drop("last_position").withColumn("duration_us", micros("last_ts") - micros("first_ts"))


def session_timeline(events: DataFrame, order: tuple[str, ...] = ("timestamp", "event_id")) -> DataFrame:
    """First and last time, duration, counts, bytes and final outcome of each session."""
    return _with_duration(events.groupBy("transfer_session_id").agg(*timeline_columns(list(order))))


def merge_parts(parts: DataFrame) -> DataFrame:
    """Parts of sessions put together into larger parts with the same columns."""
    return parts.groupBy("transfer_session_id").agg(
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.sum("events").alias("events"),
        F.sum("failures").alias("failures"), F.sum("bytes").alias("bytes"), F.max("last_position").alias("last_position"),
        F.max_by("final_outcome", "last_position").alias("final_outcome"),
    )


def merge_timelines(parts: DataFrame) -> DataFrame:
    """Timelines of sessions from the timelines of their parts."""
    return _with_duration(merge_parts(parts))


def session_completeness(events: DataFrame, expected: tuple[str, ...] = tuple(EVENT_STAGES)) -> DataFrame:
    """Steps each session lacks and whether it was completed.

    One flag per expected type is aggregated, a fixed-size buffer however many
    events a session has; an event type logged twice counts once.
    """
    flags = [F.coalesce(F.bool_or(F.col("event_type") == name), F.lit(False)).alias(f"saw_{name}") for name in expected]
    seen = events.groupBy("transfer_session_id").agg(*flags)
    missing = F.array_compact(F.array(*[F.when(~F.col(f"saw_{name}"), F.lit(name)) for name in expected]))
    return seen.select(
        "transfer_session_id", missing.alias("missing"), F.col("saw_pipeline_complete").alias("completed"),
    )

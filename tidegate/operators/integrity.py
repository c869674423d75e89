"""Checksums, manifests, quarantine and routing of received transfers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import HEX_SHA256, sha256_hex
from ..functions.rules import first_violation, violations
from ..functions.text import is_blank
from ..plans.skew import join_back

SESSION_KEY = ["agency", "session"]


def file_checksums(files: DataFrame, content: str = "content") -> DataFrame:
    """Size in bytes and SHA-256 of each file; the bytes themselves go no further."""
    return files.withColumns(
        {"size": F.octet_length(content).cast("bigint"), "sha256": sha256_hex(F.col(content))}
    ).drop(content)


def _optional(df: DataFrame, name: str):
    return (F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")).alias(name)


def build_manifests(transfers: DataFrame, receiver: str = "", version: str = "1.0") -> DataFrame:
    """A manifest per transfer: source entry, then archive entry.

    A transfer carries one source and its archive, so the entry list is built
    from the row itself and nothing is grouped. ``created_at`` is a UTC time, the
    transfer's own where it has a column of that name; ``transfer_date`` and
    ``business_date`` are taken over where there are.
    """
    created = F.col("created_at") if "created_at" in transfers.columns else F.current_timestamp()
    utc = F.to_utc_timestamp(created.cast("timestamp"), F.current_timezone())

    def entry(prefix: str):
        return F.struct(
            F.col(f"{prefix}_name").alias("file_name"),
            F.col(f"{prefix}_size").alias("file_size_bytes"),
            F.lower(f"{prefix}_sha256").alias("checksum_sha256"),
        )
    files = F.array(entry("source"), entry("archive"))
    return transfers.select(
        F.lit(version).alias("manifest_version"),
        F.col("session").alias("transfer_session_id"),
        F.col("agency").alias("sender_agency"),
        F.lit(receiver).alias("receiver_agency"),
        F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).alias("created_at"),
        F.lit("sha256").alias("checksum_algorithm"),
        F.size(files).alias("total_file_count"),
        F.lit("gzip").alias("compression_type"),
        _optional(transfers, "transfer_date"),
        _optional(transfers, "business_date"),
        files.alias("files"),
    )


def manifest_model_rules() -> list:
    """Rules a manifest must meet on its own."""
    files, c = F.col("files"), F.col
    return [
        ("session_blank", is_blank(c("transfer_session_id"))),
        ("sender_blank", is_blank(c("sender_agency"))),
        ("version_blank", c("manifest_version").isNotNull() & is_blank(c("manifest_version"))),
        ("algorithm_unknown", c("checksum_algorithm") != "sha256"),
        ("compression_unknown", c("compression_type") != "gzip"),
        ("files_empty", F.coalesce(F.size(files), F.lit(0)) < 1),
        ("file_name_blank", F.exists(files, lambda f: is_blank(f["file_name"]))),
        ("file_size_invalid", F.exists(
            files, lambda f: f["file_size_bytes"].isNull() | (f["file_size_bytes"] < 0))),
        ("checksum_not_hex", F.exists(
            files, lambda f: ~F.coalesce(f["checksum_sha256"].rlike(HEX_SHA256), F.lit(False)))),
        ("count_mismatch", F.coalesce(c("total_file_count"), F.lit(0)) != F.size(files)),
    ]


def validate_manifests(manifests: DataFrame, archives: DataFrame, receiver: str) -> DataFrame:
    """Manifests with ``violations`` and ``valid``, checked against the archives that arrived.

    ``manifests`` are keyed by the folder they lie in (agency, session);
    ``archives`` has the checksum of each session's archive. A manifest must
    name its own session, name this receiver if it names one, and carry exactly
    a source and an archive entry whose checksum is that of the archive.
    """
    actual = archives.select(*SESSION_KEY, F.lower("sha256").alias("archive_sha256"))
    joined = manifests.join(actual, SESSION_KEY, "left")
    claimed = F.lower(F.try_element_at("files", F.lit(2))["checksum_sha256"])
    rules = manifest_model_rules() + [
        ("entry_count", F.size("files") != 2),
        ("archive_missing", F.col("archive_sha256").isNull()),
        ("checksum_mismatch", (F.size("files") == 2) & (claimed != F.col("archive_sha256"))),
        ("session_mismatch", F.col("transfer_session_id") != F.col("session")),
        ("receiver_mismatch", (F.col("receiver_agency") != "") & (F.col("receiver_agency") != receiver)),
    ]
    checked = joined.withColumn("violations", violations(*rules))
    return checked.withColumns(
        {"first_violation": first_violation(F.col("violations")), "valid": F.size("violations") == 0}
    )


def validate_manifest_members(claimed: DataFrame, actual: DataFrame) -> DataFrame:
    """Differences between listed and received members, one row each.

    Both sides have (agency, session, file_name, size, sha256); the join key
    includes the file name, so no session gathers in one task.
    """
    key = [*SESSION_KEY, "file_name"]
    left = claimed.select(*key, F.col("size").alias("claimed_size"), F.lower("sha256").alias("claimed_sha256"))
    right = actual.select(*key, F.col("size").alias("actual_size"), F.lower("sha256").alias("actual_sha256"))
    joined = left.join(right, key, "full_outer")
    codes = violations(
        ("missing_member", F.col("actual_sha256").isNull()),
        ("extra_member", F.col("claimed_sha256").isNull()),
        ("size_mismatch", F.col("claimed_size") != F.col("actual_size")),
        ("checksum_mismatch", F.col("claimed_sha256") != F.col("actual_sha256")),
    )
    return joined.withColumn("violations", codes).where(F.size("violations") > 0)


def quarantine_members(members: DataFrame, blocklist: DataFrame) -> DataFrame:
    """Members with a verdict: ``infected``, ``error`` where there is no readable content, else ``clean``."""
    listed = blocklist.select("sha256").distinct().withColumn("__listed", F.lit(True))
    joined = join_back(members, listed, ["sha256"])
    verdict = (
        F.when(F.col("sha256").isNull(), F.lit("error"))
        .when(F.col("__listed"), F.lit("infected"))
        .otherwise(F.lit("clean"))
    )
    return joined.withColumn("verdict", verdict).drop("__listed")


def quarantine_content(members: DataFrame, blocklist: DataFrame) -> DataFrame:
    """Verdict per session, fail closed: one infected member rejects the whole transfer.

    An unreadable member stops the session too, but as an error that is tried again.
    """
    checked = quarantine_members(members, blocklist)
    totals = checked.groupBy(*SESSION_KEY).agg(
        F.count("*").alias("members"),
        F.count_if(F.col("verdict") == "infected").alias("infected"),
        F.count_if(F.col("verdict") == "error").alias("errors"),
    )
    verdict = (
        F.when(F.col("infected") > 0, F.lit("infected")).when(F.col("errors") > 0, F.lit("error")).otherwise("clean")
    )
    return totals.withColumn("verdict", verdict)


def route_transfers(
    sessions: DataFrame, markers: DataFrame, manifests: DataFrame, quarantine: DataFrame
) -> DataFrame:
    """Outcome and reason of every session, in order of priority.

    A marked session is already processed; an invalid or absent manifest or a
    scan error fails it, to be tried again; infection rejects it for good; the
    rest is processed. All inputs have one row per session.
    """
    marked = markers.groupBy(*SESSION_KEY).agg(F.max("kind").alias("marker"))
    checked = manifests.select(*SESSION_KEY, "valid", "first_violation")
    scanned = quarantine.select(*SESSION_KEY, F.col("verdict").alias("scan"))
    joined = sessions.select(*SESSION_KEY).join(marked, SESSION_KEY, "left").join(
        checked, SESSION_KEY, "left").join(scanned, SESSION_KEY, "left")
    status = (
        F.when(F.col("marker").isNotNull(), F.lit("already_processed"))
        .when(~F.coalesce("valid", F.lit(False)), F.lit("failed"))
        .when(F.col("scan") == "infected", F.lit("rejected"))
        .when(F.coalesce("scan", F.lit("error")) == "error", F.lit("failed"))
        .otherwise(F.lit("processed"))
    )
    reason = (
        F.when(F.col("status") == "already_processed", F.col("marker"))
        .when(F.col("valid").isNull(), F.lit("manifest_missing"))
        .when(~F.col("valid"), F.col("first_violation"))
        .when(F.col("status") == "rejected", F.lit("infected"))
        .when(F.col("status") == "failed", F.lit("scan_error"))
    )
    return joined.withColumn("status", status).withColumn("reason", F.when(
        F.col("status") != "processed", reason)).select(*SESSION_KEY, "status", "reason")


def exact_duplicates(files: DataFrame, key: str) -> DataFrame:
    """Contents sent more than once: checksum, copies and the first file that had it."""
    return files.groupBy("sha256").agg(F.count("*").alias("copies"), F.min(key).alias("first_key")).where("copies > 1")

"""The two ends of a file exchange, each as one run over everything that is pending.

Both ends decide from listings, which are small, and read file contents only
for pending work. The work goes in waves of a bounded number of transfers: a
wave's paths are handed to the reader, so files that are done are never read
again, and what a wave has finished stays finished if the run is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.naming import file_marker_key, outgoing_prefix, session_id
from ..operators.audit import routing_events
from ..operators.integrity import build_manifests, quarantine_content, route_transfers, validate_manifests
from ..operators.idempotency import already_processed, plan_transfers, unprocessed_files
from ..session import run_folder
from ..sinks.objects import write_objects
from ..sinks.transfers import manifest_json, read_markers, store_to_target, write_audit_log, write_markers
from ..sources.files import list_files, read_manifests, scan_files, whole_members
from ..sources.large_files import hash_files, pack_files, qualified, unpack_archives

KEY = ["agency", "session"]
WAVE_TRANSFERS = 5_000
ARCHIVE_NAME = "transfer.tar.gz"
MANIFEST_NAME = "manifest.json"


def _folder(path: Column, depth: int) -> Column:
    """Path component counted from the file name, which is depth 1."""
    return F.try_element_at(F.split(path, "/"), F.lit(-depth))


def _keyed(files: DataFrame, path: str) -> DataFrame:
    return files.withColumns({"agency": _folder(F.col(path), 3), "session": _folder(F.col(path), 2)})


def _waves(work: DataFrame, keys: list[str], folder: str, size: int) -> Iterator[tuple[int, DataFrame]]:
    """Fix the work of a run in a table and yield it in parts of about ``size`` keys."""
    work.write.parquet(folder)
    fixed = work.sparkSession.read.parquet(folder)
    waves = max(1, math.ceil(fixed.select(*keys).distinct().count() / size))
    for wave in range(waves):
        yield wave, fixed.where(F.pmod(F.xxhash64(*keys), F.lit(waves)) == wave)


def _paths(files: DataFrame, suffix: str = "") -> list[str]:
    """Paths of one wave's files; a wave is bounded, so the list is."""
    return [row["key"] for row in files.where(F.col("key").endswith(suffix)).select("key").collect()]


def send_files(
    spark: SparkSession, source: str, staging: str, markers_path: str, agency: str, receiver: str,
    wave_transfers: int = WAVE_TRANSFERS,
) -> DataFrame:
    """Sender run: pack every outgoing file that has no marker.

    Each file becomes one transfer: an archive and a manifest below
    ``staging/agency/session``. The session id comes from the file itself, so
    a retry writes the same objects again. Returns the manifests of the run.
    """
    staging = qualified(spark, staging)
    listing = list_files(spark, f"{source}/{outgoing_prefix('file')}")
    relative = F.substring_index(F.col("key"), f"/{outgoing_prefix('file')}", -1)
    outgoing = listing.withColumn("object", F.concat(F.lit(outgoing_prefix("file")), relative))
    named = scan_files(outgoing, outgoing_prefix("file"), "object").withColumns({
        "agency": F.lit(agency), "session": session_id(F.col("modificationTime"), F.col("object")),
        "marker": file_marker_key(F.col("object")),
    })
    done = read_markers(spark, markers_path).where("kind = 'sent'").select(F.col("detail").alias("marker"))
    pending = unprocessed_files(named, done, ["marker"]).select("key", "file_name", "marker", *KEY)
    folder = run_folder(spark, "send")
    for wave, files in _waves(pending, ["key"], f"{folder}/pending", wave_transfers):
        paths = _paths(files)
        if not paths:
            continue
        place = F.concat_ws("/", F.lit(agency), "session")
        sources = list_files(spark, paths).select("key", "size").join(files, "key").withColumn(
            "target", F.concat_ws("/", F.lit(staging), place, F.lit(ARCHIVE_NAME)))
        pack_files(sources, [*KEY, "marker", "file_name"], "file_name", "target").write.parquet(f"{folder}/measured/wave={wave}")
        measured = spark.read.parquet(f"{folder}/measured/wave={wave}")
        manifests = build_manifests(measured.select(
            *KEY, F.col("file_name").alias("source_name"), "source_sha256", "source_size",
            F.lit(ARCHIVE_NAME).alias("archive_name"), "archive_size", "archive_sha256"), receiver)
        manifests.write.parquet(f"{folder}/manifests/wave={wave}")
        manifests = spark.read.parquet(f"{folder}/manifests/wave={wave}")
        documents = manifest_json(manifests.withColumn("session", F.col("transfer_session_id")), keep=["session"])
        write_objects(documents.select(
            F.concat_ws("/", place, F.lit(MANIFEST_NAME)).alias("key"),
            F.col("value").cast("binary").alias("content")), staging)
        write_markers(measured.select(*KEY, F.lit("sent").alias("kind"), F.col("marker").alias("detail")), markers_path)
    if not spark.read.parquet(f"{folder}/pending").head(1):
        return build_manifests(spark.createDataFrame([], (
            "agency string, session string, source_name string, source_size bigint, source_sha256 string, "
            "archive_name string, archive_size bigint, archive_sha256 string")), receiver)
    return spark.read.parquet(f"{folder}/manifests").drop("wave")


def _receive_wave(
    spark: SparkSession, files: DataFrame, folder: str, target: str, markers_path: str, blocklist: DataFrame,
    receiver: str,
) -> None:
    sessions = files.select(*KEY).distinct()
    archives = files.where(F.col("key").endswith(f"/{ARCHIVE_NAME}")).select("key", *KEY)
    manifests = _keyed(read_manifests(spark, _paths(files, f"/{MANIFEST_NAME}")), "path")
    validate_manifests(manifests, hash_files(archives, KEY), receiver).write.parquet(f"{folder}/checked")
    checked = spark.read.parquet(f"{folder}/checked")
    valid = checked.where("valid").select("agency", "session")
    unpack_archives(archives.join(valid, KEY, "left_semi"), KEY).write.parquet(f"{folder}/parts")
    parts = spark.read.parquet(f"{folder}/parts")
    members = whole_members(parts)
    markers = read_markers(spark, markers_path)
    route_transfers(sessions, markers, checked, quarantine_content(members, blocklist)).write.parquet(f"{folder}/routed")
    routed = spark.read.parquet(f"{folder}/routed")
    accepted = parts.join(routed.where("status = 'processed'").select(*KEY), KEY, "left_semi")
    store_to_target(accepted.select(*KEY, "member", "part", "size", "sha256", "content"), target)
    kind = F.when(F.col("status") == "processed", "done").when(F.col("status") == "rejected", "rejected")
    fresh = routed.select(*KEY, kind.alias("kind"), F.col("reason").alias("detail")).where("kind IS NOT NULL")
    write_markers(fresh, markers_path)


def receive_transfers(
    spark: SparkSession, landing: str, target: str, markers_path: str, blocklist: DataFrame, receiver: str,
    wave_transfers: int = WAVE_TRANSFERS, audit_path: str | None = None,
) -> DataFrame:
    """Receiver run over all pending sessions of a landing area; returns every session's outcome.

    Errors are rows with a status and a reason. Expanded members are written to
    the shared folder before they are checked, so that losing an executor later
    does not unpack an archive again and what is stored is what was scanned.
    Markers follow the data; a failed session gets none and is tried again. A
    member is stored as one row per part of bounded size, whatever its own size.
    """
    listing = _keyed(list_files(spark, landing), "key").select("key", *KEY)
    markers = read_markers(spark, markers_path).where("kind IN ('done', 'rejected')").select(*KEY, "kind")
    folder = run_folder(spark, "receive")
    sessions = listing.select(*KEY).distinct()
    route = already_processed(sessions, markers, KEY).join(markers, KEY).groupBy(*KEY).agg(F.max("kind").alias("reason"))
    route.select(*KEY, F.lit("already_processed").alias("status"), "reason").write.parquet(f"{folder}/outcome/wave=-1")
    pending = listing.join(plan_transfers(sessions, markers), KEY, "left_semi")
    for wave, files in _waves(pending, KEY, f"{folder}/pending", wave_transfers):
        if files.head(1):
            _receive_wave(spark, files, f"{folder}/wave-{wave}", target, markers_path, blocklist, receiver)
            spark.read.parquet(f"{folder}/wave-{wave}/routed").write.parquet(f"{folder}/outcome/wave={wave}")
    outcome = spark.read.parquet(f"{folder}/outcome").drop("wave")
    if audit_path:
        write_audit_log(routing_events(outcome, receiver), audit_path)
    return outcome

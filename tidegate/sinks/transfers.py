"""Manifests, markers, target storage and the audit log."""

from __future__ import annotations

from collections.abc import Iterator
import gzip
import hashlib
import io
import tarfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.naming import target_path
from ..session import path_exists, run_folder
from ..sources.files import archive_field_names_out, arrow_batches

MARKER_SCHEMA = "agency string, session string, kind string, detail string"
#: Buckets of the marker table and of the target table; a table keeps the number it was made with.
MARKER_BUCKETS, TARGET_BUCKETS = 64, 256


def pack_archives(files: DataFrame, keys: list[str], name: str = "file_name", content: str = "content") -> DataFrame:
    """A tar.gz per file, byte-equal on every run because it carries no time. A worker holds one batch as it came and few archives."""
    def pack(body: bytes, member: str) -> bytes:
        buffer = io.BytesIO()
        with gzip.GzipFile(fileobj=buffer, mode="wb", compresslevel=6, mtime=0) as packed, tarfile.open(fileobj=packed, mode="w") as tar:
            info = tarfile.TarInfo(member)
            info.size = len(body)
            tar.addfile(info, io.BytesIO(body))
        return buffer.getvalue()

    def pack_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = list(range(batch.num_columns - 1))
            rows = ((*(batch.column(c)[i].as_py() for c in kept), pack(batch.column(len(kept))[i].as_py(), batch.column(len(kept) - 1)[i].as_py()))
                    for i in range(batch.num_rows))
            yield from arrow_batches(rows, pa.schema([*list(batch.schema)[:-1], pa.field("archive", pa.binary())]), "archive")

    fields = files.select(*keys, name).schema.fields
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", archive binary"
    narrow = files.select(*keys, name, F.col(content).cast("binary").alias(content))
    return narrow.mapInArrow(pack_batches, schema)


def manifest_json(manifests: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Manifest documents as text, the archive entry under its ``zip_`` names."""
    keep = keep or []
    fields = [F.col(name) for name in manifests.columns if name != "files" and name not in keep]
    files = archive_field_names_out(F.col("files")).alias("files")
    return manifests.select(*keep, "sender_agency", F.to_json(F.struct(*fields, files)).alias("value"))


def write_manifests(manifests: DataFrame, path: str) -> None:
    """One JSON document per line, in one folder per sender."""
    documents = manifest_json(manifests).withColumn("agency", F.col("sender_agency")).drop("sender_agency")
    documents.hint("rebalance", "agency").write.mode("overwrite").partitionBy("agency").text(path)


def _marker_table(spark: SparkSession, path: str) -> str:
    """Name of the marker table at ``path`` in this session's catalog.

    The table is bucketed and sorted by agency and session, so a join on them reads it as it lies, without a
    shuffle. Its files carry their bucket in their names; a session that did not write them only has to say so.
    """
    store = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = store.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(store).toString()
    name = f"tidegate_markers_{hashlib.sha256(full.encode()).hexdigest()[:24]}"
    quoted = full.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({MARKER_SCHEMA}) USING parquet "
              f"CLUSTERED BY (agency, session) SORTED BY (agency, session) INTO {MARKER_BUCKETS} BUCKETS LOCATION '{quoted}'")
    return name


def read_markers(spark: SparkSession, path: str) -> DataFrame:
    """The marker table, empty before its first write."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], MARKER_SCHEMA)
    name = _marker_table(spark, path)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def write_markers(markers: DataFrame, path: str) -> None:
    """Append markers that are not there yet; call it only after the data is committed.

    A failed transfer gets no marker and is tried again. The first marker of a
    session stands; of several in one batch, the first by kind and detail.
    Only the fresh markers move: they are dealt out like the table's buckets and each adds one sorted file to its bucket.
    """
    spark, key = markers.sparkSession, ["agency", "session"]
    fresh = markers.groupBy(*key).agg(F.min(F.struct("kind", F.col("detail").cast("string").alias("detail"))).alias("m"))
    fresh = fresh.select(*key, "m.kind", "m.detail")
    name = _marker_table(spark, path)
    spark.catalog.refreshTable(name)
    folder = run_folder(spark, "markers")
    fresh.join(spark.table(name).select(*key), key, "left_anti").write.parquet(folder)
    spark.read.parquet(folder).repartition(MARKER_BUCKETS, *key).select("agency", "session", "kind", "detail").write.insertInto(name)


def compact_markers(spark: SparkSession, path: str, target: str) -> None:
    """Write the markers to a new table of one file a bucket, for when many appends have made many files."""
    read_markers(spark, path).repartition(MARKER_BUCKETS, "agency", "session").write.insertInto(_marker_table(spark, target))


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("agency", "session"), F.lit(buckets)).cast("int")


def read_target(spark: SparkSession, path: str, agency: str | None = None, session: str | None = None, buckets: int = TARGET_BUCKETS) -> DataFrame:
    """The target table, or one session of it, for which one bucket and the sorted row groups that may hold it are read."""
    table = spark.read.parquet(path)
    if agency is None or session is None:
        return table.drop("bucket")
    place = spark.range(1).select(F.lit(agency).alias("agency"), F.lit(session).alias("session")).select(_bucket(buckets)).first()[0]
    return table.where((F.col("bucket") == place) & (F.col("agency") == agency) & (F.col("session") == session)).drop("bucket")


def store_to_target(members: DataFrame, path: str, buckets: int = TARGET_BUCKETS) -> None:
    """Write received members to the target table, replacing exactly the sessions in hand.

    The table has ``buckets`` folders by a hash of agency and session, which stay columns; rows are sorted by them in every
    file. New sessions are appended to their buckets. Where a session in hand is there already, as after
    a run that was lost before its markers, its bucket is written anew without the old rows, so a replay changes
    nothing and other buckets are not touched. The new content of a bucket is whole in the shared folder before the old goes.
    """
    spark, key, folder = members.sparkSession, ["agency", "session"], run_folder(members.sparkSession, "target")
    stored = members.withColumn("target_key", target_path(F.col("agency"), F.col("session"), F.col("member"))).withColumn("bucket", _bucket(buckets))
    order = ["bucket", *key, "member", *(c for c in ("part",) if c in members.columns)]

    def write(rows: DataFrame, mode: str) -> None:
        rows.hint("rebalance", "bucket").sortWithinPartitions(*order).write.mode(mode).option(
            "partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    stale: list[int] = []
    if path_exists(spark, path):
        stored.select(*key, "bucket").distinct().write.parquet(f"{folder}/sessions")
        sessions = spark.read.parquet(f"{folder}/sessions")
        touched = [r["bucket"] for r in sessions.select("bucket").distinct().collect()]  # at most one line a bucket
        # A table that has got no row yet has no file to tell its columns.
        old = spark.read.schema(stored.schema).parquet(path).where(F.col("bucket").isin(touched))
        there = old.select(*key, "bucket").join(sessions.select(*key), key, "left_semi")
        stale = [r["bucket"] for r in there.select("bucket").distinct().collect()]
        if stale:
            kept = old.where(F.col("bucket").isin(stale)).join(sessions.select(*key), key, "left_anti")
            kept.select(*stored.columns).unionByName(stored.where(F.col("bucket").isin(stale))).write.parquet(f"{folder}/replaced")
            write(spark.read.parquet(f"{folder}/replaced"), "overwrite")
    write(stored.where(~F.col("bucket").isin(stale)) if stale else stored, "append")


def write_audit_log(events: DataFrame, path: str) -> None:
    """Events as JSON lines with sorted keys, in one folder per event date."""
    keys = sorted(events.columns)
    body = [
        F.map_from_entries(F.array_sort(F.map_entries(name))).alias(name) if name == "details" else F.col(name)
        for name in keys
    ]
    dated = events.select(F.substring("timestamp", 1, 10).alias("event_date"), F.to_json(
        F.struct(*body), {"ignoreNullFields": "false"}).alias("value"))
    dated.hint("rebalance", "event_date").write.mode("append").partitionBy("event_date").text(path)

"""File listings, landing folders, manifests and archives."""

from __future__ import annotations

import hashlib
import io
import posixpath
import tarfile
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.naming import MARKER_SUFFIX, base_name, marker_directory, parse_object_uri
from ..functions.text import clean, is_blank
from ..plans.skew import join_back

MANIFEST_SCHEMA = (
    "manifest_version string, transfer_session_id string, sender_agency string, receiver_agency string, "
    "created_at string, checksum_algorithm string, total_file_count int, compression_type string, "
    "transfer_date string, business_date string, "
    "files array<struct<file_name:string, file_size_bytes:bigint, checksum_sha256:string, "
    "zip_file_name:string, zip_file_size_bytes:bigint>>, corrupt string"
)

# A member is a run of rows of at most this many bytes each.
PART_BYTES = 32 << 20
_BATCH_BYTES = 64 << 20
#: Content of one batch of members of archives held in a column, and of one batch of archives.
ARROW_BYTES = 4 << 20
MEMBER_COLUMNS = ["member", "part", "size", "sha256", "content", "status"]
MEMBER_SCHEMA = "member string, part bigint, size bigint, sha256 string, content binary, status string"
MEMBER_FIELDS = [pa.field(name, kind) for name, kind in zip(
    MEMBER_COLUMNS, (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string()))]


FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def _binary_files(spark: SparkSession, path: str | list[str], glob: str | None) -> DataFrame:
    if not path:
        return spark.createDataFrame([], FILE_SCHEMA)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def list_files(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Every object below a path with its size; the bytes are not read."""
    return _binary_files(spark, path, glob).select(
        F.col("path").alias("key"), F.col("length").alias("size"), "modificationTime")


def scan_files(listing: DataFrame, prefix: str, key: str = "key") -> DataFrame:
    """The files of a listing that lie below a prefix: no folder keys, no markers, not the prefix itself."""
    path = F.col(key)
    wanted = path.startswith(prefix) & (path != prefix) & ~path.endswith("/") & ~path.endswith(MARKER_SUFFIX)
    return listing.where(wanted).withColumn("file_name", base_name(path))


def landing_sessions(listing: DataFrame, key: str = "key") -> DataFrame:
    """Sender and session folders of a landing area, from keys ``agency/session/file``."""
    parts = F.split(F.col(key), "/")
    return (
        listing.where(F.size(parts) >= 3)
        .select(F.get(parts, F.lit(0)).alias("agency"), F.get(parts, F.lit(1)).alias("session"))
        .distinct()
    )


def resolve_file_request(requests: DataFrame, uri: str, override: str, status: str = "status") -> DataFrame:
    """Bucket, key, file name and marker folder of requested objects, with a status per row."""
    parsed = parse_object_uri(clean(F.col(uri)))
    named = F.when(is_blank(F.col(override)), base_name(F.col("__p.key"))).otherwise(clean(F.col(override)))
    outcome = (
        F.when(is_blank(F.col(uri)), F.lit("missing_path"))
        .when((F.col("__p.status") == "ok") & (F.col("__name") == ""), F.lit("invalid"))
        .otherwise(F.col("__p.status"))
    )
    ok = F.col(status) == "ok"
    return (
        requests.withColumn("__p", parsed)
        .withColumn("__name", named)
        .withColumn(status, outcome)
        .withColumns({
            "bucket": F.when(ok, F.col("__p.bucket")),
            "object_key": F.when(ok, F.col("__p.key")),
            "file_name": F.when(ok, F.col("__name")),
            "marker_directory": F.when(ok, marker_directory(F.col("__p.bucket"), F.col("__p.key"))),
        })
        .drop("__p", "__name")
    )


def locate_objects(located: DataFrame, listing: DataFrame, status: str = "status", bucket: str = "bucket", key: str = "key") -> DataFrame:
    """Which object of a listing each resolved request means; adds ``source_key`` and ``source_size``.

    A request that names an object has it. One that names a folder, with or without
    its slash, has the object below it if there is one only; ``several_objects``
    if there are more, and ``object_absent`` if there is none. An object comes before
    a folder of the same name. Folder keys and markers are no objects, and a key
    listed twice is one object, of the lesser size. Requests that were not
    resolved keep their status.
    """
    path, parts = F.col(key), F.split(F.col(key), "/")
    folders = F.when(F.size(parts) > 1, F.transform(
        F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, 1, n), "/"))).otherwise(F.array())
    objects = listing.where(~path.endswith("/") & ~path.endswith(MARKER_SUFFIX)).select(
        F.col(bucket).alias("bucket"), F.struct(path.alias("key"), F.col("size").alias("size")).alias("__object"),
        F.explode(F.concat(F.array(path), folders)).alias("__name"))
    same = F.col("__object.key") == F.col("__name")
    below = F.when(~same, F.col("__object"))
    # A line per object and folder, whatever the number of objects below it.
    named = objects.groupBy("bucket", "__name").agg(
        F.min(F.when(same, F.col("__object"))).alias("__exact"), F.min(below).alias("__least"), F.max(below).alias("__most"))
    rows = join_back(located.withColumn("__name", F.regexp_replace("object_key", "/$", "")), named, ["bucket", "__name"])
    one = F.when(F.col("__least.key") == F.col("__most.key"), F.col("__least"))
    found = F.when(F.col("object_key").endswith("/"), one).otherwise(F.coalesce("__exact", one))
    outcome = F.when(F.col(status) != "ok", F.col(status)).when(F.col("__found").isNotNull(), F.lit("ok")).when(
        F.col("__least").isNotNull(), F.lit("several_objects")).otherwise(F.lit("object_absent"))
    return rows.withColumn("__found", found).withColumns({
        status: outcome, "source_key": F.col("__found.key"), "source_size": F.col("__found.size"),
    }).drop("__name", "__exact", "__least", "__most", "__found")


def archive_field_names(files):
    """Manifest entries under their standard names, whichever names the archive entry uses."""
    return F.transform(files, lambda f: F.struct(
        F.coalesce(f["file_name"], f["zip_file_name"]).alias("file_name"),
        F.coalesce(f["file_size_bytes"], f["zip_file_size_bytes"]).alias("file_size_bytes"),
        f["checksum_sha256"].alias("checksum_sha256"),
    ))


def archive_field_names_out(files):
    """The sender's form: the archive, which is entry two, carries ``zip_`` names."""
    def renamed(entry, position):
        archive = position == 1
        return F.struct(
            F.when(~archive, entry["file_name"]).alias("file_name"),
            F.when(~archive, entry["file_size_bytes"]).alias("file_size_bytes"),
            entry["checksum_sha256"].alias("checksum_sha256"),
            F.when(archive, entry["file_name"]).alias("zip_file_name"),
            F.when(archive, entry["file_size_bytes"]).alias("zip_file_size_bytes"),
        )
    return F.transform(files, renamed)


def read_manifests(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """Manifests below a path under standard entry names; unreadable ones keep their text in ``corrupt``."""
    if not path:
        return spark.createDataFrame([], MANIFEST_SCHEMA).withColumns(
            {"files": archive_field_names(F.col("files")), "path": F.lit(None).cast("string")})
    raw = (
        spark.read.schema(MANIFEST_SCHEMA)
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", "true")
        .option("columnNameOfCorruptRecord", "corrupt")
        .json(path)
    )
    return raw.withColumns({"files": archive_field_names(F.col("files")), "path": F.url_decode(F.replace(
        F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))})  # a listing has paths as they are, this one is percent-encoded


def escapes_root(name: str) -> bool:
    """True when extracting a member of this name would leave the target folder."""
    flat = posixpath.normpath(name)
    return posixpath.isabs(name) or flat == ".." or flat.startswith("../")


def member_rows(stream) -> Iterator[tuple]:
    """The members of a tar.gz read front to back, as rows of ``MEMBER_COLUMNS``.

    A member is one row per ``PART_BYTES``, numbered from 0; its last row carries
    size and checksum. A bad archive ends in a row without a member whose status
    says why.
    """
    try:
        with tarfile.open(fileobj=stream, mode="r|gz") as tar:
            for member in tar:
                if not member.isfile():
                    continue
                if escapes_root(member.name):
                    yield None, None, None, None, None, "path_traversal"
                    return
                body, digest, size, part = tar.extractfile(member), hashlib.sha256(), 0, 0
                data = body.read(PART_BYTES)
                while True:
                    digest.update(data)
                    size += len(data)
                    more = body.read(PART_BYTES) if data else b""
                    if not more:
                        yield member.name, part, size, digest.hexdigest(), data, "ok"
                        break
                    yield member.name, part, None, None, data, "ok"
                    data, part = more, part + 1
    except (tarfile.TarError, OSError, EOFError, zlib.error):
        yield None, None, None, None, None, "unreadable"


def batched_rows(rows: Iterator[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    """Batches cut by bytes, which bounds a worker's memory however many members an archive has."""
    kept, held, content = [], 0, columns.index("content")
    for row in rows:
        kept.append(row)
        held += len(row[content]) if row[content] is not None else 100
        if held >= _BATCH_BYTES:
            yield pd.DataFrame(kept, columns=columns)
            kept, held = [], 0
    if kept:
        yield pd.DataFrame(kept, columns=columns)


def member_schema(archives: DataFrame, keys: list[str]) -> str:
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in archives.select(*keys).schema.fields)
    return f"{kept}, {MEMBER_SCHEMA}"


def arrow_batches(rows: Iterator[tuple], schema: pa.Schema, content: str) -> Iterator[pa.RecordBatch]:
    """Batches cut by the bytes of their content, made of rows one at a time."""
    kept, held, at = [], 0, schema.get_field_index(content)

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(values, field.type) for values, field in zip(zip(*kept), schema)], schema=schema)
    for row in rows:
        kept.append(row)
        held += 200 + len(row[at] or b"")
        if held >= ARROW_BYTES:
            yield batch()
            kept, held = [], 0
    if kept:
        yield batch()


def expand_archives(archives: DataFrame, keys: list[str], content: str = "content") -> DataFrame:
    """Regular files of each tar.gz held in a column, as rows of ``member_rows``.

    An archive is not splittable, so the work is parallel across archives. A worker holds
    an incoming batch as it came, the archive in hand and about ``ARROW_BYTES`` of members.
    """
    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        for i in range(batch.num_rows):
            *key, data = (column[i].as_py() for column in batch.columns)
            found = member_rows(io.BytesIO(data)) if data is not None else [(None, None, None, None, None, "no_content")]
            for row in found:
                yield *key, *row

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from arrow_batches(rows(batch), pa.schema([*list(batch.schema)[:-1], *MEMBER_FIELDS]), "content")
    return archives.select(*keys, content).mapInArrow(expand, member_schema(archives, keys))


def whole_members(rows: DataFrame) -> DataFrame:
    """One row per member, or per bad archive: the last part's size, checksum and status."""
    return rows.where("sha256 IS NOT NULL OR status <> 'ok'").drop("part", "content")

"""Streams whose sink is a table.

In a table with one folder per micro-batch a batch writes ``batch_id=N`` by overwriting it, so a batch that is replayed
after a failure leaves the table as it was. Tables that are read again by every
batch are kept in ``levels``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..operators.audit import merge_parts, merge_timelines, timeline_columns
from ..session import path_exists, run_folder
from ..sources.files import FILE_SCHEMA
from .levels import Levels, has_parts


def table_stream(spark: SparkSession, root: str, table: str, files_per_batch: int = 1_000) -> DataFrame:
    """The files of ``root/table.parquet`` as a stream; each file is handled once."""
    path = f"{root.rstrip('/')}/{table}.parquet"
    # A one-letter pattern matches the table whether it is a folder or a single file.
    return folder_stream(spark, path.removesuffix("t") + "[t]", spark.read.parquet(path).schema, files_per_batch)


def folder_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 1_000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def new_file_stream(spark: SparkSession, path: str, glob: str = "*", files_per_batch: int = 1_000) -> DataFrame:
    """Files of a folder as they arrive; the checkpoint remembers which were handled."""
    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
    )


def start(writer: DataStreamWriter, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Start with a checkpoint; without an interval, drain what is there and stop."""
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def _replace_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_batches(spark: SparkSession, path: str, schema) -> DataFrame:
    """All batches with their id, or the live parts of a table of doubling parts; an empty table before the first batch."""
    full = f"{schema}, batch_id bigint"
    if not path_exists(spark, path):
        return spark.createDataFrame([], full)
    if has_parts(spark, path):
        return Levels(path, schema, (), lambda rows: rows).read(spark)
    return spark.read.schema(full).option("basePath", path).parquet(path)


def ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def store_batches(transform: Callable[[DataFrame], DataFrame], path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that stores each batch under its id."""
    def store(batch: DataFrame, batch_id: int) -> None:
        _replace_batch(transform(batch), path, batch_id)
    return store


def drop_recent_copies(requests: DataFrame, keys: list[str], delay: str) -> DataFrame:
    """Drop rows whose keys arrived within the delay, so that few copies reach the table of all keys.

    The state holds keys and no rows, and keys leave it once the delay has passed. Time is that of arrival: no request
    is late, however old its own times are. A copy after the delay passes and is for ``commit_batches`` to refuse.
    """
    stamped = requests.withColumn("__arrived", F.current_timestamp()).withWatermark("__arrived", delay)
    return stamped.dropDuplicatesWithinWatermark(keys).drop("__arrived")


def first_arrivals(requests: DataFrame, key: str, order: list[str], path: str, delay: str = "1 hour") -> DataStreamWriter:
    """Store the first request of each key, for all time, as it arrives; of one micro-batch the first in ``order``.

    Two tiers remember: the state store what came within the delay, by key and order, and the table of commits below
    ``path`` every key. A micro-batch reads only the folders its keys fall into, so neither memory nor the
    work of a batch grows with the stream's age. ``read_commits`` reads the result.
    """
    recent = drop_recent_copies(requests, [key, *(name for name in order if name != key)], delay)
    return recent.writeStream.outputMode("append").foreachBatch(commit_batches(path, [key], order))


def dedup_within_watermark(requests: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """Drop repeats that arrive within the delay; state is bounded by it."""
    return requests.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def timeline_levels(path: str, events: DataFrame, order: tuple[str, ...] = ("timestamp", "event_id")) -> Levels:
    """The stored timelines of events with the columns of ``events``, which may be a stream."""
    parts = events.groupBy("transfer_session_id").agg(*timeline_columns(list(order)))
    return Levels(path, ddl(parts), ("transfer_session_id",), merge_parts)


def timeline_batches(path: str, order: tuple[str, ...] = ("timestamp", "event_id")) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that stores each micro-batch's part of every session's timeline.

    Parts are merged as they are written, so a session has at most one row a level.
    There is no watermark: an event counts however late it comes.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        parts = batch.groupBy("transfer_session_id").agg(*timeline_columns(list(order)))
        timeline_levels(path, batch, order).store(parts, batch_id)
    return store


def read_timelines(events: DataFrame, path: str, order: tuple[str, ...] = ("timestamp", "event_id")) -> DataFrame:
    """The stored timelines, one row a session."""
    return merge_timelines(timeline_levels(path, events, order).read(events.sparkSession))


def _commit_levels(path: str) -> Levels:
    return Levels(f"{path}/commits", "content_key string", ("content_key",), lambda rows: rows.select("content_key").distinct())


def commit_batches(path: str, keys: list[str] | None = None, order: list[str] | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that stores every content once, whatever becomes of the checkpoint.

    A row's content key is a checksum of its ``keys``, or of all its columns. Rows
    whose key is committed are left out; the others are written, and then
    their keys are committed. Commits are numbered by the table and not by the
    stream, so neither a lost checkpoint nor other cuts between batches
    store anything twice. Data without a commit is not read and is written over by the next attempt.
    Rows of one batch with the same key are one, the first in ``order`` and then by their JSON text.
    One stream at a time may write to a table.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        spark, commits, folder = batch.sparkSession, _commit_levels(path), run_folder(batch.sparkSession, "commit")
        content = F.to_json(F.struct(*(keys or batch.columns)))
        row = F.struct(*batch.columns)
        keyed = batch.groupBy(F.sha2(content, 256).alias("content_key")).agg(F.min_by(row, F.struct(*(order or []), F.to_json(row))).alias("row"))
        keyed.write.parquet(folder)
        keyed = spark.read.schema(keyed.schema).parquet(folder)
        known = commits.read(spark, touched=keyed).select("content_key")
        fresh = keyed.join(known, "content_key", "left_anti")
        number = commits.next_id(spark)
        place = f"{path}/data/commit={number}"
        fresh.write.mode("overwrite").parquet(place)
        written = spark.read.schema(keyed.schema).parquet(place)
        if not written.isEmpty():
            commits.store(written.select("content_key"), number)
    return store


def read_commits(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The committed rows; an empty table before the first commit."""
    if not path_exists(spark, f"{path}/data"):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(f"content_key string, row struct<{schema}>, commit bigint").parquet(f"{path}/data")
    return rows.where(F.col("commit") < _commit_levels(path).next_id(spark)).select("row.*")


def latest_per_key(changes: DataFrame, keys: list[str]) -> DataFrame:
    """The newest state of each key in a table of per-batch changes."""
    rest = [name for name in changes.columns if name not in (*keys, "batch_id")]
    newest = changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("__row"))
    return newest.select(*keys, *[F.col(f"__row.`{name}`").alias(name) for name in rest])


def compact_batches(spark: SparkSession, path: str, schema: str, keys: list[str], target: str) -> None:
    """Write the newest state of each key as one batch of a new folder.

    The batch keeps the id of the last one read, so the stream can go on in the
    new folder where it stopped in the old one.
    """
    changes = read_batches(spark, path, schema)
    last = changes.agg(F.max("batch_id")).first()[0]
    if last is not None:
        _replace_batch(latest_per_key(changes, keys), target, last)

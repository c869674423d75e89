"""Counts, totals and key checks. All combine on the map side before any shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def bytes_per_session(files: DataFrame, size: str = "size") -> DataFrame:
    """File count and total bytes of each transfer."""
    return files.groupBy("agency", "session").agg(
        F.count("*").alias("file_count"), F.sum(size).alias("total_bytes")
    )


def compression_stats(manifests: DataFrame) -> DataFrame:
    """Source and archive bytes per sender with the overall ratio; entry one is the source, entry two the archive."""
    entry = lambda position: F.try_element_at("files", F.lit(position))["file_size_bytes"]
    totals = manifests.groupBy("agency").agg(
        F.count("*").alias("transfers"),
        F.sum(entry(1)).alias("source_bytes"),
        F.sum(entry(2)).alias("archive_bytes"),
    )
    ratio = F.when(F.col("source_bytes") > 0, F.col("archive_bytes") / F.col("source_bytes"))
    return totals.withColumn("ratio", F.round(ratio, 6))


def status_counts(transfers: DataFrame, status: str = "status") -> DataFrame:
    """One row: transfers per status and the run's outcome.

    A rejected transfer counts as failed in the run that rejects it, and any
    failure makes the run a failure.
    """
    value = F.col(status)
    counted = transfers.agg(
        F.count_if(value == "processed").alias("processed"),
        F.count_if(value == "already_processed").alias("already_processed"),
        F.count_if(value.isin("failed", "rejected")).alias("failed"),
    )
    return counted.withColumn("outcome", F.when(F.col("failed") == 0, "success").otherwise("failure"))


def recent_processed(transfers: DataFrame, n: int = 3) -> DataFrame:
    """The last already-processed sessions, by session id descending."""
    done = transfers.where(F.col("status") == "already_processed").select("agency", "session")
    return done.orderBy(F.col("session").desc(), F.col("agency")).limit(n)


def key_uniqueness(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that break uniqueness or hold a null, with their row count and the rule broken."""
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()
    counted = df.groupBy(*keys).agg(F.count("*").alias("n"))
    broken = F.when(has_null, F.lit("null_key")).when(F.col("n") > 1, F.lit("duplicate_key"))
    return counted.withColumn("violation", broken).where("violation IS NOT NULL")


def join_inner_equi(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Inner join on one or more column pairs; Spark picks the strategy from measured sizes."""
    condition = None
    for mine, theirs in pairs:
        equal = left[mine] == right[theirs]
        condition = equal if condition is None else condition & equal
    return left.join(right, condition, "inner")

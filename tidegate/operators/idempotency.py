"""Work that is safe to repeat: markers, first of duplicates and run plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.naming import extract_key, query_marker_key
from ..plans.skew import first_per_key, join_back


def unprocessed_files(files: DataFrame, markers: DataFrame, key: list[str]) -> DataFrame:
    """Files without a processed marker."""
    return files.join(markers.select(*key), key, "left_anti")


def already_processed(work: DataFrame, markers: DataFrame, key: list[str]) -> DataFrame:
    """Work whose key has a marker of any kind.

    The keys of the work are combined and move to the markers; a marker table bucketed by the key is read as it lies.
    """
    done = work.select(*key).distinct().join(markers.select(*key), key, "left_semi")
    return join_back(work, done, key, "left_semi")


def marker_union(done: DataFrame, rejected: DataFrame, key: list[str]) -> DataFrame:
    return done.select(*key).unionByName(rejected.select(*key)).distinct()


def insert_if_absent(batch: DataFrame, target: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The rows of a batch to append: first of each key, none whose key the target has.

    Duplicates are merged before the join, so a key repeated in the batch costs
    one row per map task.
    """
    return first_per_key(batch, key, [F.col(c) for c in order]).join(target.select(*key), key, "left_anti")


def first_of_duplicates(requests: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first request of every fingerprint with the number of requests it stands for."""
    rest = [name for name in requests.columns if name != key]
    picked = requests.groupBy(key).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("__row"), F.count("*").alias("copies")
    )
    return picked.select(key, *[F.col(f"__row.`{name}`").alias(name) for name in rest], "copies")


def first_pending_file(files: DataFrame, directory: list[str], key: str = "key") -> DataFrame:
    """The file each directory would send next: its first key."""
    return first_per_key(files, directory, [F.col(key)])


def plan_extracts(requests: DataFrame, markers: DataFrame, order: list[str], session: str = "session") -> DataFrame:
    """What to do with every request: ``run``, ``skip_duplicate`` or ``skip_done``.

    ``markers`` holds fingerprints of finished extracts. The first request of a
    new fingerprint runs; later ones are covered by it. The decision is made on
    one row per fingerprint and joined back.
    """
    per_key = requests.groupBy("fingerprint").agg(F.min(F.struct(*order)).alias("__first"))
    done = markers.select("fingerprint").distinct().withColumn("__done", F.lit(True))
    decided = per_key.join(done, "fingerprint", "left")
    rows = join_back(requests, decided, ["fingerprint"])
    action = (
        F.when(F.coalesce("__done", F.lit(False)), F.lit("skip_done"))
        .when(F.struct(*order).eqNullSafe(F.col("__first")), F.lit("run"))
        .otherwise(F.lit("skip_duplicate"))
    )
    marker = query_marker_key(F.col("template_id"), F.col("fingerprint"))
    output = F.when(F.col("action") == "run", extract_key(F.col(session), F.col("template_id"), F.col("fingerprint")))
    return (
        rows.withColumn("action", action)
        .withColumn("marker_key", marker)
        .withColumn("output_key", output)
        .drop("__first", "__done")
    )


def plan_transfers(sessions: DataFrame, markers: DataFrame) -> DataFrame:
    """Landing sessions still to process: those neither done nor rejected. A bucketed marker table does not move."""
    return sessions.join(markers.select("agency", "session"), ["agency", "session"], "left_anti")

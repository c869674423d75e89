"""Joining per-key results back to their rows when a key may be hot."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import run_folder

_KEY_HASH = "__key_hash"
_ROW = "__row"
#: Marks of this many bytes in all are sent to every executor; more are joined by shuffle.
_SENT_BYTES = 32 << 20


def join_back(rows: DataFrame, per_key: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join rows to a table with one row per key so that a hot key is split.

    A per-key table comes out of an aggregation already partitioned by the key,
    and a join would reuse that partitioning; adaptive execution splits a
    skewed partition only when both sides read a plain shuffle. Adding a hash
    of the key to the join condition gives the small side its own shuffle, so
    a key with a third of all rows is spread over many tasks, each with a copy
    of that one small row. A small per-key table is still broadcast, by its
    measured size.
    """
    hashed = F.xxhash64(*[F.col(key) for key in keys])
    joined = rows.withColumn(_KEY_HASH, hashed).join(
        per_key.withColumn(_KEY_HASH, hashed), [*keys, _KEY_HASH], how
    )
    return joined.drop(_KEY_HASH)


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of every key, by aggregation instead of a window.

    ``min_by`` combines on the map side, so one key's rows never have to meet
    in one task; a ranking window would sort all of them there.
    """
    rest = [name for name in df.columns if name not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return picked.select(*keys, *[F.col(f"__row.`{name}`").alias(name) for name in rest]).select(*df.columns)


def first_of_wide_rows(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """``first_per_key`` of rows much wider than their keys and order, written to the shared folder.

    An aggregation whose buffer holds a whole row sorts whole rows in every task.
    Here keys and order alone are aggregated; a hash of each key's first order,
    written and counted, then picks the rows, which are written as they come.
    Only where more rows than keys were picked (equal orders, equal hashes) are they
    numbered and picked once more by the number. Whole rows are never sorted or
    aggregated, whatever the number of keys. What is left has a known size, so a
    join on it broadcasts it, if it is small, and not its other side.
    """
    def written(rows: DataFrame) -> DataFrame:
        folder = run_folder(df.sparkSession, "firsts")
        rows.write.parquet(folder)
        return df.sparkSession.read.schema(rows.schema).parquet(folder)

    def picked(rows: DataFrame, order: list, mark: Callable[[Column], Column]) -> tuple[DataFrame, int]:
        firsts = rows.select(*keys, F.struct(*order).alias("__order")).groupBy(*keys).agg(F.min("__order").alias("__order"))
        marks = written(firsts.select(mark(F.col("__order")).alias("__mark")))
        n = marks.count()
        # Beyond that size the marks become hash tables, one a partition, so the rows need no order to meet them.
        marks = F.broadcast(marks) if 8 * n <= _SENT_BYTES else marks.hint("shuffle_hash")
        return rows.join(marks, mark(F.struct(*order)) == F.col("__mark"), "left_semi"), n

    rows, n = picked(df, order, lambda order: F.xxhash64(*keys, order))
    rows = written(rows.withColumn(_ROW, F.monotonically_increasing_id()))
    if rows.count() > n:
        rows = written(picked(rows, [*order, F.col(_ROW)], lambda order: order[_ROW])[0])
    return rows.select(*df.columns)

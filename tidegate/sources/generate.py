"""Synthetic tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.synth import synth_value


def columns_of(df: DataFrame) -> list[dict]:
    """Column metadata of an existing table, to generate more of the same."""
    return [{"name": f.name, "type": f.dataType.simpleString()} for f in df.schema.fields]


def synth_rows(
    index: DataFrame, columns: list[dict], row: str = "id", seed: int = 0, now: Column | None = None
) -> DataFrame:
    """One generated row per index row.

    A column is ``{"name", "type"}`` with optional ``labels`` (an enumerated
    column) and ``identity`` (left out, the store fills it in).
    """
    wanted = [column for column in columns if not column.get("identity")]
    if not wanted:
        raise ValueError("no insertable columns")
    return index.select(*[
        synth_value(c["name"], c["type"], F.col(row), seed, c.get("labels"), now).alias(c["name"]) for c in wanted
    ])


def synth_table(spark: SparkSession, columns: list[dict], n: int, partitions: int | None = None, seed: int = 0) -> DataFrame:
    """``n`` generated rows, spread over the cluster from the start."""
    index = spark.range(n, numPartitions=partitions) if partitions else spark.range(n)
    return synth_rows(index, columns, seed=seed)

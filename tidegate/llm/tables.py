"""Small helpers around DataFrames that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import run_folder
from .words import slices


def crc_rest(column: str, modulus: int):
    """crc32 of the id as text, modulo; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def map_slices(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema, column: str = "text") -> DataFrame:
    """Apply ``work`` to Arrow slices of bounded text size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column):
                yield work(part)
    return df.mapInArrow(run, schema)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one where ``df`` has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Rows of ids of this many bytes in all are sent to every executor; more are joined by shuffle.
BROADCAST_BYTES = 32 << 20


def sent_if_small(ids: DataFrame, row_bytes: int = 8) -> DataFrame:
    """``ids``, a written table, marked for broadcast where its counted rows are few."""
    return F.broadcast(ids) if row_bytes * ids.count() <= BROADCAST_BYTES else ids


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends here and survives lost executors."""
    folder = run_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))

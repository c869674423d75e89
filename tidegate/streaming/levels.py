"""Tables that a stream writes and whose cost does not grow with the stream's age.

Every micro-batch adds a part. A part takes up the parts before it that span no
more batches than it does, so their spans double: after n batches at most
log2(n) + 1 parts are live, and a row is rewritten log2(n) times in all. Rows
lie in folders by a hash of their keys, and a reader that knows its keys reads
the folders they fall into and no others.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 32
#: Batches for which a part stays on disk after it was taken up, for readers that are under way.
GRACE = 4

Part = tuple[int, int]


def has_parts(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds parts of such a table, and not a folder a batch."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)
    return any(re.fullmatch("[0-9]{12,}-[0-9]{12,}", status.getPath().getName()) for status in found)


@dataclass(frozen=True)
class Levels:
    """A table below ``path`` with at most one row a key in each of its parts.

    ``merge`` takes rows of several parts, with the last batch of each row's part
    as ``batch_id``, and returns one row a key. A part is live once its writer
    has left ``_SUCCESS``. What it took up goes ``GRACE`` batches later, so a part
    that was lost half written is written again from the same rows. One
    writer at a time; its batch ids rise, and a batch that later ones have followed is not taken again.
    """

    path: str
    schema: str
    keys: tuple[str, ...]
    merge: Callable[[DataFrame], DataFrame]
    buckets: int = BUCKETS

    def _folder(self, part: Part) -> str:
        return f"{self.path}/{part[0]:012d}-{part[1]:012d}"

    def _stored(self, spark: SparkSession) -> list[Part]:
        root = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        store = root.getFileSystem(spark._jsc.hadoopConfiguration())
        if not store.exists(root):
            return []
        done = lambda place: store.exists(spark._jvm.org.apache.hadoop.fs.Path(place, "_SUCCESS"))
        names = [status.getPath().getName() for status in store.listStatus(root) if done(status.getPath())]
        return [(int(first), int(last)) for first, last in (name.split("-") for name in names)]

    def parts(self, spark: SparkSession, before: int | None = None) -> list[Part]:
        """First and last batch of the live parts, oldest first."""
        live: list[Part] = []
        for part in sorted(self._stored(spark), key=lambda p: p[1], reverse=True):
            if (before is None or part[1] < before) and (not live or part[1] < live[-1][0]):
                live.append(part)
        return live[::-1]

    def next_id(self, spark: SparkSession) -> int:
        return max((last for _, last in self._stored(spark)), default=-1) + 1

    def passed(self, spark: SparkSession, batch_id: int) -> bool:
        """Whether a later batch is stored already."""
        return self.next_id(spark) > batch_id + 1

    def _fields(self) -> list[T.StructField]:
        return T.StructType.fromDDL(self.schema).fields

    def _bucket(self) -> Column:
        kinds = {f.name: f.dataType for f in self._fields()}
        return F.pmod(F.xxhash64(*[F.col(key).cast(kinds[key]) for key in self.keys]), F.lit(self.buckets)).cast("int")

    def _read(self, spark: SparkSession, parts: list[Part]) -> DataFrame:
        reader = spark.read.schema(f"{self.schema}, bucket int")
        tables = [reader.parquet(self._folder(part)).withColumn("batch_id", F.lit(part[1]).cast("bigint")) for part in parts]
        if not tables:
            return spark.createDataFrame([], f"{self.schema}, bucket int, batch_id bigint")
        return reduce(DataFrame.unionByName, tables)

    def read(self, spark: SparkSession, before: int | None = None, touched: DataFrame | None = None) -> DataFrame:
        """The rows of the live parts with their ``batch_id``; with ``touched``, of the folders its keys fall into."""
        rows = self._read(spark, self.parts(spark, before))
        if touched is not None:
            places = [r["place"] for r in touched.select(self._bucket().alias("place")).distinct().collect()]  # at most one line a folder
            rows = rows.where(F.col("bucket").isin(places))
        return rows.drop("bucket")

    def merged(self, spark: SparkSession) -> DataFrame:
        """One row a key."""
        return self.merge(self.read(spark))

    def store(self, rows: DataFrame, batch_id: int) -> None:
        """Add a batch, one row a key, and take up the parts it has caught up with."""
        spark = rows.sparkSession
        if self.passed(spark, batch_id):
            return
        self._retire(spark, batch_id)
        live, first = self.parts(spark, batch_id), batch_id
        taken: list[Part] = []
        while live and live[-1][1] - live[-1][0] <= batch_id - first:
            taken.append(live.pop())
            first = taken[-1][0]
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self._fields()]
        if taken:
            batch = rows.select(*columns, F.lit(batch_id).cast("bigint").alias("batch_id"))
            rows = self.merge(self._read(spark, taken).drop("bucket").unionByName(batch))
        placed = rows.select(*columns).withColumn("bucket", self._bucket())
        placed.hint("rebalance", "bucket").sortWithinPartitions("bucket", *self.keys).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").partitionBy("bucket").parquet(self._folder((first, batch_id)))

    def _retire(self, spark: SparkSession, batch_id: int) -> None:
        """Delete the parts that a live one took up more than ``GRACE`` batches ago."""
        live = self.parts(spark, batch_id)
        for part in self._stored(spark):
            if any(first <= part[0] and part[1] < last < batch_id - GRACE for first, last in live):
                place = spark._jvm.org.apache.hadoop.fs.Path(self._folder(part))
                place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)

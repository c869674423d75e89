"""Table scans, JDBC options and catalog inspection."""

from __future__ import annotations

import datetime as dt
import hashlib
import math
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import ContractError
from ..session import shared_root

# Fixed value: the database engines a JDBC source may use.
JDBC_ENGINES = {"postgres": "postgresql"}


def split_table_name(name: str, default_schema: str | None = None) -> tuple[str, str]:
    """``schema.table`` (or a bare table with a default schema) as a pair of non-empty names."""
    schema, dot, table = name.strip().partition(".")
    if not dot:
        schema, table = default_schema or "", schema
    if not schema.strip() or not table.strip():
        raise ContractError("missing_params", f"'{name}' must name a schema and a table")
    return schema.strip(), table.strip()


def scan_table(spark: SparkSession, schema: str, table: str) -> DataFrame:
    """A catalog table by schema and name; a missing one is a contract error."""
    if not schema or not table:
        raise ContractError("missing_params", "both schema and table are needed")
    if not spark.catalog.tableExists(f"`{schema}`.`{table}`"):
        raise ContractError("table_not_found", f"table '{table}' not found in schema '{schema}'")
    return spark.table(f"`{schema}`.`{table}`")


def attach_folder(spark: SparkSession, root: str, tables: list[str], schema: str | None = None) -> str:
    """Make ``root/name.parquet`` tables available in the catalog under one schema and return its name.

    The tables stay where they are; only their location is recorded.
    """
    schema = schema or f"folder_{hashlib.sha256(root.encode()).hexdigest()}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}` LOCATION '{shared_root(spark)}/schemas/{schema}'")
    for table in tables:
        place = f"{root.rstrip('/')}/{table}.parquet"
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{schema}`.`{table}` USING parquet LOCATION '{place}'")
        described = spark.sql(f"DESCRIBE TABLE EXTENDED `{schema}`.`{table}`").where("col_name = 'Location'").first()["data_type"]
        if described.split(":", 1)[-1].replace("///", "/") != place.split(":", 1)[-1].replace("///", "/"):
            raise ContractError("table_elsewhere", f"table '{schema}.{table}' is at '{described}', not at '{place}'")
    return schema


def scan_parquet(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table stored as ``root/table.parquet``."""
    return spark.read.parquet(f"{root.rstrip('/')}/{table}.parquet")


@dataclass(frozen=True)
class JdbcSource:
    """Connection and partitioning of a database table.

    A big table needs ``predicates``, from ``partition_predicates``, or a
    ``partition_column`` with its bounds: without them Spark would read
    everything through one connection in one task.
    """

    host: str
    database: str
    user: str
    port: int = 5432
    engine: str = "postgres"
    password: str = ""
    partition_column: str | None = None
    lower_bound: str | int | None = None
    upper_bound: str | int | None = None
    num_partitions: int = 64
    fetch_size: int = 10_000
    predicates: tuple[str, ...] = ()

    def options(self, schema: str, table: str, timeout_seconds: int) -> dict[str, str]:
        engine = self.engine.strip().lower()
        if engine not in JDBC_ENGINES:
            raise ContractError("engine_not_supported", f"engine '{self.engine}' is not supported")
        split_table_name(f"{schema}.{table}")
        options = {
            "url": f"jdbc:{JDBC_ENGINES[engine]}://{self.host}:{self.port}/{self.database}",
            "dbtable": f'"{schema}"."{table}"',
            "user": self.user,
            "password": self.password,
            "queryTimeout": str(timeout_seconds),
            "fetchsize": str(self.fetch_size),
            "pushDownPredicate": "true",
            "pushDownLimit": "true",
        }
        if self.partition_column is not None and self.predicates:
            raise ContractError("jdbc_bounds_conflict", "predicates and partition_column exclude each other")
        if self.partition_column is not None:
            if self.lower_bound is None or self.upper_bound is None:
                raise ContractError("jdbc_bounds_missing", "partition_column needs lower_bound and upper_bound")
            options |= {
                "partitionColumn": self.partition_column,
                "lowerBound": str(self.lower_bound),
                "upperBound": str(self.upper_bound),
                "numPartitions": str(self.num_partitions),
            }
        return options


def scan_jdbc(spark: SparkSession, source: JdbcSource, schema: str, table: str, timeout_seconds: int = 60) -> DataFrame:
    options = source.options(schema, table, timeout_seconds)
    if not source.predicates:
        return spark.read.format("jdbc").options(**options).load()
    url, name = options.pop("url"), options.pop("dbtable")
    return spark.read.jdbc(url, name, predicates=list(source.predicates), properties=options)


#: Rows that the bounds of partitions are chosen from, about; the sample is all that reaches the driver.
BOUND_SAMPLE = 20_000


def _literal(value) -> str | None:
    """SQL form of a bound that means the same to every engine, or None."""
    if isinstance(value, bool) or value is None or value != value:
        return None
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ', timespec='microseconds')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, float):
        return repr(value) if math.isfinite(value) else None
    if isinstance(value, (int, Decimal)):
        return format(value, "f") if isinstance(value, Decimal) else str(value)
    if isinstance(value, str) and value.isprintable() and "\\" not in value:
        return "'" + value.replace("'", "''") + "'"
    return None


def partition_predicates(rows: DataFrame, column: str, parts: int, quote: str = '"', collation: str = ' COLLATE "C"') -> list[str]:
    """Predicates for ``JdbcSource`` that cut a table by equal depth, so that a skewed column gives even tasks.

    ``rows`` holds the column, of any orderable type, as an earlier extract or a
    sample that the database drew. The bounds are quantiles of about
    ``BOUND_SAMPLE`` of them. Every row meets exactly one predicate: the ends are
    open, and nulls have one of their own. A value that many rows share is
    not split, as no predicate on the column can do that. Text is compared by code point, whatever the table's collation.
    """
    values = rows.select(F.col(f"`{column}`").alias("v")).where(F.col("v").isNotNull())
    kind = rows.schema[column].dataType
    total = values.count()
    drawn = values.sample(fraction=min(1.0, BOUND_SAMPLE / max(total, 1)), seed=7) if total > BOUND_SAMPLE else values
    sample = sorted(v for v in (r["v"] for r in drawn.collect()) if v == v)
    name = f"{quote}{column.replace(quote, quote * 2)}{quote}"
    term = name + collation if isinstance(kind, T.StringType) else name
    bounds: list[str] = []
    for i in range(1, parts):
        value = sample[i * len(sample) // parts] if sample else None
        literal = _literal(value)
        # The least value opens no part of its own, and a value opens one part only.
        if literal is not None and value != sample[0] and literal not in bounds[-1:]:
            bounds.append(literal)
    if not bounds:
        return [f"{name} IS NOT NULL", f"{name} IS NULL"]
    inner = [f"{term} >= {low} AND {term} < {high}" for low, high in zip(bounds, bounds[1:])]
    return [f"{term} < {bounds[0]}", *inner, f"{term} >= {bounds[-1]}", f"{name} IS NULL"]


def table_inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """Exact row count per table."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in sorted(tables.items())
    ]
    return reduce(DataFrame.unionByName, counts)


def catalog_inventory(spark: SparkSession, schema: str) -> DataFrame:
    """Inventory of a catalog schema's tables."""
    names = [t.name for t in spark.catalog.listTables(schema) if not t.isTemporary]
    return table_inventory({name: scan_table(spark, schema, name) for name in names})


def table_preview(df: DataFrame, key: list[str], n: int) -> DataFrame:
    """The first ``n`` rows by key with the table's total row count."""
    total = df.select(F.count("*")).scalar()
    return df.orderBy(*key).limit(n).withColumn("total_rows", total)


#: Size of a distinct-count sketch: 2^14 cells, a relative error of 0.8 % (one standard deviation).
SKETCH_BITS = 14
SKETCH_SCHEMA = "column_name string, ordinal int, data_type string, nullable boolean, null_count bigint, sketch binary"


def profile_sketches(df: DataFrame) -> DataFrame:
    """A line per column with its null count and a sketch of its distinct values, from one scan.

    The lines of parts of a table can be stored; ``merge_profiles`` makes the
    table's profile of them, so a grown table is profiled from its new parts.
    """
    fields = df.schema.fields
    if not fields:
        return df.sparkSession.createDataFrame([], SKETCH_SCHEMA)
    wide = df.agg(*[
        F.struct(
            F.count_if(F.col(f"`{f.name}`").isNull()).alias("null_count"),
            F.hll_sketch_agg(_comparable(f), F.lit(SKETCH_BITS)).alias("sketch"),
        ).alias(f"s{position}")
        for position, f in enumerate(fields, start=1)
    ])
    rows = F.array(*[
        F.struct(
            F.lit(f.name).alias("column_name"), F.lit(position).alias("ordinal"), F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit(f.nullable).alias("nullable"), F.col(f"s{position}.null_count"), F.col(f"s{position}.sketch"))
        for position, f in enumerate(fields, start=1)
    ])
    return wide.select(F.inline(rows))


def merge_profiles(sketches: DataFrame) -> DataFrame:
    """The profile of all parts whose sketches are given; a column is nullable if it is so in any part."""
    return sketches.groupBy("column_name", "ordinal", "data_type").agg(
        F.bool_or("nullable").alias("nullable"), F.sum("null_count").alias("null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_count"))


def column_profile(df: DataFrame, exact: Sequence[str] = ()) -> DataFrame:
    """Position, type, nullability, null count and distinct count of every column.

    One pass of sketches counts all columns. The columns named in ``exact`` are
    counted exactly, together in one more scan, whose repeated values are
    combined on the map side.
    """
    facts = ["column_name", "ordinal", "data_type", "nullable"]
    named = [(position, f) for position, f in enumerate(df.schema.fields, start=1) if f.name in exact]
    rest = [f"`{f.name}`" for f in df.schema.fields if f.name not in exact]
    parts = []
    if rest:
        places = F.create_map(*[F.lit(x) for position, f in enumerate(df.schema.fields, start=1) for x in (f.name, position)])
        parts.append(merge_profiles(profile_sketches(df.select(*rest))).withColumn("ordinal", places[F.col("column_name")]))
    if named:
        values = df.select(F.inline(F.array(*[
            F.struct(F.lit(position).alias("ordinal"), _comparable(f).alias("value")) for position, f in named])))
        counted = values.groupBy("ordinal", "value").agg(F.count("*").alias("n")).groupBy("ordinal").agg(
            F.sum(F.when(F.col("value").isNull(), F.col("n"))).alias("nulls"), F.count("value").alias("distinct_count"))
        lines = df.sparkSession.createDataFrame(
            [(f.name, position, f.dataType.simpleString(), f.nullable) for position, f in named], "column_name string, ordinal int, data_type string, nullable boolean")
        zero = F.lit(0).cast("bigint")
        parts.append(lines.join(counted, "ordinal", "left").select(
            *facts, F.coalesce("nulls", zero).alias("null_count"), F.coalesce("distinct_count", zero).alias("distinct_count")))
    return reduce(DataFrame.unionByName, parts).select(*facts, "null_count", "distinct_count")


def _comparable(field: T.StructField):
    """Text form of a value; long binary and text values are compared by checksum."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.sha2(column, 256)
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(column)
    return column.cast("string")


def enum_domain(df: DataFrame, column: str) -> DataFrame:
    """Labels in use, in order."""
    return df.select(F.col(column).alias("label")).where(F.col(column).isNotNull()).distinct().orderBy("label")

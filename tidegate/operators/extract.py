"""Governed extraction: filters, projection, order and row cap over one table."""

from __future__ import annotations

import math
from decimal import Decimal
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import ContractError, ExtractSpec, FieldFilter, typed_value
from ..session import run_folder

_ROW_BITS = 33


def _column_type(df: DataFrame, name: str, code: str = "unknown_field") -> T.DataType:
    """Type of a column by its exact name; Spark alone would accept any case."""
    if name not in df.columns:
        raise ContractError(code, f"field '{name}' does not exist in the table")
    return df.schema[name].dataType


def _literal(value: Any, dtype: T.DataType, rounding=None) -> Column:
    """Literal of the column's own type, so the column is never cast and the filter reaches the scan."""
    if isinstance(dtype, T.IntegralType):
        return F.lit(int(rounding(value) if rounding else value)).cast(dtype)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.lit(float(value)).cast(dtype)
    if isinstance(value, Decimal):
        return F.lit(value).cast(dtype) if _fits(value, dtype) else F.lit(value)
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(value.replace(tzinfo=None).isoformat()).cast(dtype)
    return F.lit(value)


_INTEGRAL_RANGE = {T.ByteType: 7, T.ShortType: 15, T.IntegerType: 31, T.LongType: 63}


def _bound(df: DataFrame, name: str, value: Any, lower: bool) -> Column:
    dtype = _column_type(df, name)
    literal = typed_value(value, dtype, name)
    column = F.col(f"`{name}`")
    if isinstance(dtype, T.IntegralType):
        # A fractional bound is tightened to the next integer inside the range.
        literal = math.ceil(literal) if lower else math.floor(literal)
        limit = 1 << _INTEGRAL_RANGE[type(dtype)]
        if not -limit <= literal < limit:
            keeps_all = literal < 0 if lower else literal > 0
            return column.isNotNull() if keeps_all else F.lit(False)
    return column >= _literal(literal, dtype) if lower else column <= _literal(literal, dtype)


def min_predicate(df: DataFrame, name: str, value: Any) -> Column:
    return _bound(df, name, value, lower=True)


def max_predicate(df: DataFrame, name: str, value: Any) -> Column:
    return _bound(df, name, value, lower=False)


def _fits(value: Any, dtype: T.DataType) -> bool:
    """Whether a column can hold the number: whole and in range, or within the decimal's digits."""
    if isinstance(dtype, T.IntegralType):
        limit = 1 << _INTEGRAL_RANGE[type(dtype)]
        return value == value.to_integral_value() and -limit <= value < limit
    if isinstance(dtype, T.DecimalType):
        return value.is_finite() and value.adjusted() < dtype.precision - dtype.scale and value == round(value, dtype.scale)
    return True


def _member_values(df: DataFrame, name: str, values: list[Any]) -> tuple[T.DataType, list[Any]]:
    dtype = _column_type(df, name)
    typed = [typed_value(value, dtype, name) for value in values]
    return dtype, list(dict.fromkeys(value for value in typed if _fits(value, dtype)))


def in_predicate(df: DataFrame, name: str, values: list[Any]) -> Column:
    dtype, typed = _member_values(df, name, values)
    return F.col(f"`{name}`").isin([_literal(value, dtype) for value in typed]) if typed else F.lit(False)


def equal_predicate(df: DataFrame, name: str, value: Any) -> Column:
    return in_predicate(df, name, [value])


def filter_min(df: DataFrame, name: str, value: Any) -> DataFrame:
    """Rows with ``name >= value``; nulls drop."""
    return df.filter(min_predicate(df, name, value))


def filter_max(df: DataFrame, name: str, value: Any) -> DataFrame:
    return df.filter(max_predicate(df, name, value))


def filter_equal(df: DataFrame, name: str, value: Any) -> DataFrame:
    return df.filter(equal_predicate(df, name, value))


def filter_in(df: DataFrame, name: str, values: list[Any]) -> DataFrame:
    """Rows whose value is in the list; values the column cannot hold match nothing."""
    return df.filter(in_predicate(df, name, values))


_PREDICATES = {"min": min_predicate, "max": max_predicate, "equal": equal_predicate, "in": in_predicate}


def filter_ranges(df: DataFrame, filters: tuple[FieldFilter, ...]) -> DataFrame:
    """All filters of a contract as one conjunction."""
    predicates = [_PREDICATES[f.operator](df, f.field, f.value) for f in filters]
    return df.filter(reduce(lambda left, right: left & right, predicates)) if predicates else df


def project_fields(df: DataFrame, fields: tuple[str, ...] | list[str]) -> DataFrame:
    """The listed columns in the listed order; an empty list keeps all."""
    if not fields:
        return df
    for name in fields:
        _column_type(df, name, "unknown_select_field")
    return df.select(*[F.col(f"`{name}`") for name in fields])


def _sort_columns(field: str, descending: bool, tie_break: tuple[str, ...]) -> list[Column]:
    column = F.col(f"`{field}`")
    lead = column.desc_nulls_last() if descending else column.asc_nulls_last()
    return [lead] + [F.col(f"`{name}`").asc_nulls_last() for name in tie_break if name != field]


def order_by_field(
    df: DataFrame, field: str, descending: bool = False, tie_break: tuple[str, ...] = ()
) -> DataFrame:
    """Sort by one field, nulls last both ways, then by the table's key where one is declared."""
    _column_type(df, field, "unknown_order_field")
    return df.orderBy(*_sort_columns(field, descending, tie_break))


def limit_rows(df: DataFrame, row_limit: int) -> DataFrame:
    """Any ``row_limit`` rows; each task stops at the cap, and so does the task that joins them."""
    return df.limit(row_limit)


def _place(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` sorted inside its partitions, with the place of each row in its partition."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return df.sortWithinPartitions(*order).withColumn(name, place)


def topk_extract(
    df: DataFrame, field: str, row_limit: int, descending: bool = False, tie_break: tuple[str, ...] = ()
) -> DataFrame:
    """The first ``row_limit`` rows of an order, in that order.

    Every task keeps its first k rows; what is left is dealt out by range of the order and each
    range gives as many rows as the ranges before it leave of the cap, so no task merges the k rows of
    all the others. Rows that tie in the whole order keep the order of the scan, which also
    lets the ranges split a value that many rows share.
    """
    _column_type(df, field, "unknown_order_field")
    for name in tie_break:
        _column_type(df, name, "unknown_order_field")
    rows = df.select(F.struct(*[F.col(f"`{name}`") for name in df.columns]).alias("kept"), *[
        F.col(f"`{name}`").alias(f"by_{i}") for i, name in enumerate((field, *[n for n in tie_break if n != field]))])
    names = [name for name in rows.columns if name != "kept"]
    lead = F.col("by_0").desc_nulls_last() if descending else F.col("by_0").asc_nulls_last()
    order = [lead, *[F.col(name).asc_nulls_last() for name in names[1:]], F.col("scanned").asc()]
    first = _place(rows.withColumn("scanned", F.monotonically_increasing_id()), order, "place").where(F.col("place") < row_limit)
    # Dealing out reads its input twice, so what the tasks keep of the table is written first.
    folder = run_folder(df.sparkSession, "kept")
    first.drop("place").write.parquet(folder)
    first = df.sparkSession.read.parquet(folder)
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = _place(first.repartitionByRange(ranges, *order), order, "place").withColumn("part", F.spark_partition_id())
    # Range bounds come from a sample and would differ in a second run of the plan, so the ranges are written once.
    folder = run_folder(df.sparkSession, "ranges")
    dealt.write.parquet(folder)
    dealt = df.sparkSession.read.parquet(folder)
    sizes = dealt.groupBy("part").count().withColumn("all", F.lit(1))
    before = F.sum("count").over(Window.partitionBy("all").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # One line a range.
    quota = sizes.select(F.col("part").alias("of_part"), (F.lit(row_limit) - F.coalesce(before, F.lit(0))).alias("quota"))
    cut = dealt.join(F.broadcast(quota), F.col("part") == F.col("of_part")).where(F.col("place") < F.col("quota"))
    return cut.orderBy(*order).select("kept.*")


def governed_extract(df: DataFrame, spec: ExtractSpec, key: tuple[str, ...] = ()) -> DataFrame:
    """Filters, then projection, then order, then cap.

    A filter may use a column that is not projected; the order field must be
    projected. ``key`` names the table's unique key: it breaks ties at the cap,
    whether it is projected or not.
    """
    rows = filter_ranges(df, spec.filters)
    shown = project_fields(rows, spec.select_fields)
    if spec.order_field is None:
        return limit_rows(shown, spec.row_limit)
    _column_type(shown, spec.order_field, "unknown_order_field")
    tie_break = tuple(name for name in key if name in rows.columns)
    carried = project_fields(rows, list(dict.fromkeys([*shown.columns, *tie_break])))
    return project_fields(topk_extract(carried, spec.order_field, spec.row_limit, spec.descending, tie_break), spec.select_fields)

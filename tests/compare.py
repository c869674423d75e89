"""Compare a Spark result with a DuckDB result, ignoring row order."""

from __future__ import annotations

import glob
import math
import os
from decimal import Decimal

import duckdb


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{root}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, bool) or value is None:
        return value
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(row[i]) for i in order) for row in rows), key=repr)


def differences(spark_df, con, sql: str) -> str | None:
    """None when equal, ``empty result`` when both have no rows, else a short description."""
    result = con.execute(sql)
    sql_columns = [c[0] for c in result.description]
    expected = rows_of(sql_columns, result.fetchall())
    actual = rows_of(spark_df.columns, spark_df.collect())
    if sorted(sql_columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(sql_columns)}"
    if actual == expected:
        return None if expected else "empty result"
    only_spark = [r for r in actual if r not in set(expected)][:3]
    only_sql = [r for r in expected if r not in set(actual)][:3]
    return f"{len(actual)} rows vs {len(expected)}; only spark {str(only_spark)[:600]}; only sql {str(only_sql)[:600]}"

"""Validation as data: every broken rule of a row becomes a code in an array."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def violations(*rules: tuple[str, Column]) -> Column:
    """Codes of the rules a row breaks, in the order given. A null condition is not broken."""
    return F.array_compact(F.array(*[F.when(broken, F.lit(code)) for code, broken in rules]))


def first_violation(codes: Column) -> Column:
    return F.get(codes, F.lit(0))

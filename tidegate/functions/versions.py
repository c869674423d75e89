"""Ordering of product versions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VERSION_PATTERN = "^v?[0-9]+\\.[0-9]+(\\.[0-9]+)?$"


def version_key(version: Column) -> Column:
    """Comparable ``[major, minor, patch]``: ``v1.2`` equals ``1.2.0`` and ``1.10`` is above ``1.9``."""
    numbers = F.transform(
        F.split(F.regexp_replace(version, "^v", ""), "\\."), lambda part: part.try_cast("bigint")
    )
    padded = F.concat(numbers, F.array_repeat(F.lit(0).cast("bigint"), 3 - F.size(numbers)))
    return F.when(version.rlike(VERSION_PATTERN), padded)

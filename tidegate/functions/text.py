"""Trimming and blank handling shared by all validators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark's trim() removes spaces only; request text may carry tabs and newlines.
WHITESPACE = " \t\n\r\x0b\x0c"


def clean(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def clean_lower(col: Column) -> Column:
    return F.lower(clean(col))


def clean_or_null(col: Column) -> Column:
    """Trimmed text; blank becomes null."""
    return F.nullif(clean(col), F.lit(""))


def is_blank(col: Column) -> Column:
    """True for null, empty and whitespace-only text."""
    return F.coalesce(clean(col), F.lit("")) == ""


def normalize_request(df):
    """Trim identifiers, lower-case the two codes, turn blank optional text into null.

    Only the columns that are present are touched, so the function also serves
    narrow tables.
    """
    rules = {
        "request_id": clean,
        "requested_by": clean,
        "dataproduct_id": clean_lower,
        "requesting_agency": clean_lower,
        "delivery_target_id": clean_or_null,
        "justification": clean_or_null,
    }
    return df.withColumns({name: rule(F.col(name)) for name, rule in rules.items() if name in df.columns})


def normalize_input_mode(raw: Column) -> Column:
    """``struct(mode, reason)``: only ``file`` and ``query`` are modes, all else means ``file``."""
    mode = clean_lower(raw)
    reason = (
        F.when(raw.isNull(), F.lit("default_missing"))
        .when(mode == "", F.lit("default_blank"))
        .when(mode.isin("file", "query"), F.lit("explicit"))
        .otherwise(F.concat(F.lit("default_invalid:"), raw))
    )
    chosen = F.when(mode.isin("file", "query"), mode).otherwise(F.lit("file"))
    return F.struct(chosen.alias("mode"), reason.alias("reason"))


def classification_tags(metadata: Column) -> Column:
    """Metadata entries whose key mentions a classification, in any case."""
    return F.map_filter(metadata, lambda key, _: F.lower(key).contains("classification"))

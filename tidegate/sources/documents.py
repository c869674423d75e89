"""Product definitions and requests: JSON documents as typed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import is_blank, normalize_request

# Allowed values stay JSON text, which keeps the type of each.
PARAM_TYPE = "struct<name:string,type:string,description:string,allowed_values:string,min:double,max:double>"
DEFINITION_SCHEMA = f"""
    dataproduct_id string, name string, version string, status string, owner_agency string,
    data_owner struct<name:string,team:string,contact_email:string>,
    access struct<allowed_requesting_agencies:array<string>,allowed_requesting_roles:array<string>,
                  approval_policy:string,classification_tags:array<string>,retention_policy_days:bigint>,
    extraction struct<source_type:string,engine:string,template_id:string,
                      required_params:array<{PARAM_TYPE}>,optional_params:array<{PARAM_TYPE}>,
                      default_row_limit:bigint,max_row_limit:bigint,
                      default_timeout_seconds:bigint,max_timeout_seconds:bigint,
                      allowed_select_fields:array<string>,
                      allowed_filters:array<struct<field:string,operators:array<string>>>>,
    delivery struct<output_format:string,naming_convention:string,
                    delivery_targets:array<struct<target_id:string,type:string,description:string>>,
                    manifest_requirements:array<string>>,
    operations struct<schedule_constraints:struct<enabled:boolean,allowed_utc_windows:array<string>>,
                      idempotency_scope:string,audit_level:string,
                      notifications:struct<on_request:array<string>,on_success:array<string>,on_failure:array<string>>>,
    corrupt string
"""

# The fields of a request envelope.
REQUEST_REQUIRED = ("request_id", "dataproduct_id", "requesting_agency", "requested_by", "params")
REQUEST_OPTIONAL = (
    "requested_row_limit", "requested_timeout_seconds", "delivery_target_id", "justification", "metadata",
)


def read_definitions(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Every ``*.json`` definition below a path with its file path as the order key.

    The files are listed by name at plan time; an empty folder is an error.
    """
    reader = (
        spark.read.schema(DEFINITION_SCHEMA)
        .option("multiLine", multi_line)
        .option("pathGlobFilter", "*.json")
        .option("columnNameOfCorruptRecord", "corrupt")
    )
    definitions = reader.json(path)
    if not definitions.inputFiles():
        raise FileNotFoundError(f"no definition files found in '{path}'")
    return definitions.withColumn("path", F.col("_metadata.file_path"))


def _typed(value: Column, name: str, target: str) -> Column:
    return F.try_variant_get(value, f"$.{name}", target)


def read_requests(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Request documents as columns, with ``status`` and the JSON type of every top-level field.

    A document that is blank, not JSON or not an object becomes a row with that
    status. ``field_types`` maps each field that is present to its JSON type, so
    that later checks can tell ``"5"`` from ``5`` and null from absent.
    """
    text = F.col(raw)
    value = F.col("__value")
    kind = F.schema_of_variant(value)
    status = (
        F.when(is_blank(text), F.lit("blank"))
        .when(value.isNull(), F.lit("invalid_json"))
        .when(~kind.startswith("OBJECT"), F.lit("not_object"))
        .otherwise(F.lit("ok"))
    )
    fields = F.try_variant_get(value, "$", "map<string,variant>")
    metadata = F.try_variant_get(value, "$.metadata", "map<string,variant>")
    texts = {name: _typed(value, name, "string") for name in (
        "request_id", "dataproduct_id", "requesting_agency", "requested_by", "delivery_target_id", "justification",
    )}
    numbers = {name: _typed(value, name, "bigint") for name in ("requested_row_limit", "requested_timeout_seconds")}
    parsed = (
        df.withColumn("__value", F.try_parse_json(text))
        .withColumns({
            "status": status,
            "field_types": F.transform_values(fields, lambda _, v: F.schema_of_variant(v)),
            **texts,
            **numbers,
            "params": F.to_json(_typed(value, "params", "variant")),
            "metadata": F.try_variant_get(value, "$.metadata", "map<string,string>"),
            "metadata_types": F.transform_values(metadata, lambda _, v: F.schema_of_variant(v)),
        })
        .drop("__value")
    )
    return normalize_request(parsed)

"""The product registry: definitions, versions and the lookup of a request's product."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import violations
from ..functions.text import clean_lower
from ..functions.versions import VERSION_PATTERN, version_key
from ..plans.skew import first_of_wide_rows, join_back

# Patterns and enumerations of a product definition.
ID_PATTERN = "^[a-z0-9][a-z0-9_-]{2,63}$"
EMAIL_PATTERN = "^[^@\\s]+@[^@\\s]+$"
WINDOW_PATTERN = "^[0-2][0-9]:[0-5][0-9]-[0-2][0-9]:[0-5][0-9]$"
STATUSES = ("draft", "active", "deprecated", "retired")
SOURCE_ENGINES = {"sql": "postgres", "file": "s3-file"}
PARAM_TYPES = ("string", "integer", "number", "boolean", "date", "datetime", "array", "object")
FILTER_OPERATORS = ("min", "max", "equal", "in")
SECTION_FIELDS = {
    "$": ("dataproduct_id", "name", "version", "status", "owner_agency", "data_owner", "access", "extraction",
          "delivery", "operations"),
    "$.data_owner": ("name", "team", "contact_email"),
    "$.access": ("allowed_requesting_agencies", "allowed_requesting_roles", "approval_policy",
                 "classification_tags", "retention_policy_days"),
    "$.extraction": ("source_type", "engine", "template_id", "required_params", "optional_params",
                     "default_row_limit", "max_row_limit", "default_timeout_seconds", "max_timeout_seconds",
                     "allowed_select_fields", "allowed_filters"),
    "$.delivery": ("output_format", "naming_convention", "delivery_targets", "manifest_requirements"),
    "$.operations": ("schedule_constraints", "idempotency_scope", "audit_level", "notifications"),
}

# Fields of the objects nested in sections, and the JSON type of every field.
_TEXT, _WHOLE, _NUMBER, _FLAG = "^STRING$", "^(BIGINT|DECIMAL\\([0-9]+,0\\))$", "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$", "^BOOLEAN$"
_TEXTS, _OBJECTS, _OBJECT = "^ARRAY<(STRING|VOID)>$", "^ARRAY<(OBJECT.*|VOID)>$", "^OBJECT"
_SCALARS = "^ARRAY<(STRING|BIGINT|DOUBLE|FLOAT|DECIMAL.*|BOOLEAN|VOID|VARIANT)>$"
_PARAM_KINDS = {"name": _TEXT, "type": _TEXT, "description": _TEXT, "allowed_values": _SCALARS, "min": _NUMBER, "max": _NUMBER}
LIST_KINDS = {
    "extraction.required_params": _PARAM_KINDS,
    "extraction.optional_params": _PARAM_KINDS,
    "extraction.allowed_filters": {"field": _TEXT, "operators": _TEXTS},
    "delivery.delivery_targets": {"target_id": _TEXT, "type": _TEXT, "description": _TEXT},
}
OBJECT_KINDS = {
    "operations.schedule_constraints": {"enabled": _FLAG, "allowed_utc_windows": _TEXTS},
    "operations.notifications": {"on_request": _TEXTS, "on_success": _TEXTS, "on_failure": _TEXTS},
}
FIELD_KINDS = {
    **{name: _TEXT for name in (
        "dataproduct_id", "name", "version", "status", "owner_agency", "data_owner.name", "data_owner.team", "data_owner.contact_email",
        "access.approval_policy", "extraction.source_type", "extraction.engine", "extraction.template_id", "delivery.output_format",
        "delivery.naming_convention", "operations.idempotency_scope", "operations.audit_level")},
    **{name: _OBJECT for name in (
        "data_owner", "access", "extraction", "delivery", "operations", "operations.schedule_constraints", "operations.notifications")},
    **{name: _TEXTS for name in (
        "access.allowed_requesting_agencies", "access.allowed_requesting_roles", "access.classification_tags",
        "extraction.allowed_select_fields", "delivery.manifest_requirements")},
    **{name: _OBJECTS for name in LIST_KINDS},
    **{name: _WHOLE for name in (
        "access.retention_policy_days", "extraction.default_row_limit", "extraction.max_row_limit",
        "extraction.default_timeout_seconds", "extraction.max_timeout_seconds")},
    **{f"{path}.{name}": kind for path, fields in OBJECT_KINDS.items() for name, kind in fields.items()},
}


def flatten_definitions(definitions: DataFrame) -> DataFrame:
    """The parts of a definition that governance reads, one column each."""
    extraction = [
        "source_type", "engine", "template_id", "required_params", "optional_params", "default_row_limit",
        "max_row_limit", "default_timeout_seconds", "max_timeout_seconds", "allowed_select_fields", "allowed_filters",
    ]
    return definitions.select(
        "dataproduct_id", "version", "status", "path",
        *[F.col(f"extraction.{name}").alias(name) for name in extraction],
        F.col("access.allowed_requesting_agencies").alias("allowed_requesting_agencies"),
        F.col("access.allowed_requesting_roles").alias("allowed_requesting_roles"),
        F.col("access.retention_policy_days").alias("retention_policy_days"),
        F.col("delivery.manifest_requirements").alias("manifest_requirements"),
        F.col("operations.schedule_constraints").alias("schedule_constraints"),
        F.col("operations.idempotency_scope").alias("idempotency_scope"),
    )


def active_definition(definitions: DataFrame) -> DataFrame:
    """The definition in force per product.

    The highest version among active ones wins; with none active, the highest
    of all. Equal versions keep the first in path order.
    """
    descending = F.transform(version_key(F.col("version")), lambda part: -part)
    unreadable = F.array(*[F.lit(1).cast("bigint")] * 3)
    order = [F.col("status") != "active", F.coalesce(descending, unreadable), F.col("path")]
    return first_of_wide_rows(definitions, ["dataproduct_id"], [c.alias(f"o{i}") for i, c in enumerate(order)])


def duplicate_definitions(definitions: DataFrame) -> DataFrame:
    """Products that carry one version more than once, with the first and last file."""
    return (
        definitions.groupBy("dataproduct_id", "version")
        .agg(F.count("*").alias("n"), F.min("path").alias("first_path"), F.max("path").alias("last_path"))
        .where("n > 1")
    )


def registry_lookup(requests: DataFrame, active: DataFrame) -> DataFrame:
    """Requests with the columns of their product; ``known_product`` is false where there is none.

    One product may be asked for by a third of all requests, so the rows are
    attached by the skew-safe join. A registry small enough is broadcast by its
    measured size and the requests do not move.
    """
    renamed = active.withColumnsRenamed(
        {"status": "definition_status", "version": "definition_version", "path": "definition_path"}
    ).withColumn("known_product", F.lit(True))
    normalized = requests.withColumn("dataproduct_id", clean_lower(F.col("dataproduct_id")))
    return join_back(normalized, renamed, ["dataproduct_id"]).withColumn(
        "known_product", F.coalesce("known_product", F.lit(False))
    )


def _length(name: str, col: Column, low: int, high: int | None = None) -> list[tuple[str, Column]]:
    size = F.length(col)
    broken = size < low if high is None else ~size.between(low, high)
    return [(f"{name}:missing", col.isNull()), (f"{name}:length", broken)]


def _enum(name: str, col: Column, allowed: tuple[str, ...]) -> list[tuple[str, Column]]:
    return [(f"{name}:missing", col.isNull()), (f"{name}:enum", ~col.isin(*allowed))]


def _range(name: str, col: Column, high: int) -> list[tuple[str, Column]]:
    return [(f"{name}:missing", col.isNull()), (f"{name}:range", ~col.between(1, high))]


def _names(name: str, col: Column, low: int, high: int, at_least: int = 1, required: bool = True):
    """Rules for a list of distinct texts."""
    rules = [(f"{name}:missing", col.isNull())] if required else []
    return rules + [
        (f"{name}:too_few", F.size(col) < at_least),
        (f"{name}:not_unique", F.size(F.array_distinct(col)) < F.size(col)),
        (f"{name}:item_length", F.exists(col, lambda item: ~F.length(item).between(low, high))),
    ]


def _params(name: str, col: Column, at_least: int) -> list[tuple[str, Column]]:
    return [
        (f"{name}:missing", col.isNull()),
        (f"{name}:too_few", F.size(col) < at_least),
        (f"{name}:not_unique", F.size(F.array_distinct(col)) < F.size(col)),
        (f"{name}:item_name", F.exists(
            col, lambda p: p["name"].isNull() | ~F.length(p["name"]).between(1, 120))),
        (f"{name}:item_type", F.exists(col, lambda p: p["type"].isNull() | ~p["type"].isin(*PARAM_TYPES))),
        (f"{name}:item_description", F.exists(col, lambda p: F.length(p["description"]) > 500)),
    ]


def _kinds(value: Column) -> Column:
    """JSON type of every field of an object; null where ``value`` is none."""
    return F.transform_values(F.try_variant_get(value, "$", "map<string,variant>"), lambda _, field: F.schema_of_variant(field))


def _with_kinds(definitions: DataFrame, raw: str) -> DataFrame:
    """``definitions`` with the types of all checked fields, from one walk over each document.

    Columns are named ``__kinds:`` and the path of a section, nested object or list of objects.
    """
    sections = [path for path in SECTION_FIELDS if path != "$"]
    added = definitions.withColumn("__doc", F.try_parse_json(F.col(raw))).withColumn(
        "__at:$", F.try_variant_get("__doc", "$", "map<string,variant>"))
    added = added.withColumns({f"__at:{path}": F.try_variant_get(
        F.col("__at:$")[path[2:]], "$", "map<string,variant>") for path in sections})

    def at(path: str) -> Column:
        section, _, name = path.partition(".")
        return F.col(f"`__at:$.{section}`")[name]
    types = lambda path: F.transform_values(F.col(f"`__at:{path}`"), lambda _, field: F.schema_of_variant(field))
    # The type of a section names all below it, of which its own columns hold the types.
    tops = F.transform_values(F.col("`__at:$`"), lambda _, field: F.when(
        F.try_variant_get(field, "$", "map<string,variant>").isNotNull(), F.lit("OBJECT")).otherwise(F.schema_of_variant(field)))
    return added.withColumns({
        "__kinds:$": tops, **{f"__kinds:{path}": types(path) for path in sections},
        **{f"__kinds:$.{path}": _kinds(at(path)) for path in OBJECT_KINDS},
        **{f"__kinds:$.{path}": F.transform(F.try_variant_get(at(path), "$", "array<variant>"), _kinds) for path in LIST_KINDS},
    }).drop("__doc", "__at:$", *[f"__at:{path}" for path in sections])


def _kinds_at(path: str) -> Column:
    return F.col(f"`__kinds:{path}`")


def _kind(path: str) -> Column:
    """JSON type of a field; null where it is absent."""
    parent, _, name = f"$.{path}".rpartition(".")
    return _kinds_at(parent)[name]


def _extra_keys(kinds: Column, allowed) -> Column:
    extra = F.array_except(F.map_keys(kinds), F.array(*[F.lit(name) for name in allowed]))
    return F.coalesce(F.size(extra) > 0, F.lit(False))


def _document_rules() -> list[tuple[str, Column]]:
    """Unexpected keys and wrong types of every section, nested object and list item of a document."""
    rules = [(f"{'document' if path == '$' else path[2:]}:unexpected_key", _extra_keys(_kinds_at(path), allowed))
             for path, allowed in SECTION_FIELDS.items()]
    rules += [(f"{path}:unexpected_key", _extra_keys(_kinds_at(f"$.{path}"), fields)) for path, fields in OBJECT_KINDS.items()]
    for path, fields in LIST_KINDS.items():
        items = _kinds_at(f"$.{path}")
        rules.append((f"{path}:item_unexpected_key", F.exists(items, lambda item: _extra_keys(item, fields))))
        rules.append((f"{path}:item_kind", F.exists(items, lambda item: reduce(or_, [
            ~F.coalesce(item[name].rlike(kind), F.lit(True)) for name, kind in fields.items()]))))
    return rules + [(f"{path}:type", ~_kind(path).rlike(f"{kind}|^VOID$")) for path, kind in FIELD_KINDS.items()]


def definition_schema_check(definitions: DataFrame, raw: str | None = None) -> DataFrame:
    """Definitions with ``violations``: every schema rule a document breaks.

    ``raw`` names a column with the document text; with it unexpected keys and
    wrong JSON types are found at every level, which a typed reader would drop
    or convert. A field of the wrong type is not reported as missing.
    """
    c = F.col
    rules: list[tuple[str, Column]] = []
    if raw is not None:
        definitions = _with_kinds(definitions, raw)
        rules += _document_rules()
    rules += _length("dataproduct_id", c("dataproduct_id"), 3)
    rules += [("dataproduct_id:pattern", ~c("dataproduct_id").rlike(ID_PATTERN))]
    rules += _length("name", c("name"), 3, 200)
    rules += [("version:missing", c("version").isNull()), ("version:pattern", ~c("version").rlike(VERSION_PATTERN))]
    rules += _enum("status", c("status"), STATUSES)
    rules += _length("owner_agency", c("owner_agency"), 2, 50)
    rules += _length("data_owner.name", c("data_owner.name"), 2, 120)
    rules += _length("data_owner.team", c("data_owner.team"), 2, 120)
    email = c("data_owner.contact_email")
    rules += [("data_owner.contact_email:missing", email.isNull()),
              ("data_owner.contact_email:format", ~email.rlike(EMAIL_PATTERN))]
    rules += _names("access.allowed_requesting_agencies", c("access.allowed_requesting_agencies"), 2, 50)
    rules += _names("access.allowed_requesting_roles", c("access.allowed_requesting_roles"), 2, 120, 0, False)
    rules += _enum("access.approval_policy", c("access.approval_policy"), ("auto", "owner_approval", "dual_approval"))
    rules += _names("access.classification_tags", c("access.classification_tags"), 2, 64)
    rules += _range("access.retention_policy_days", c("access.retention_policy_days"), 36_500)
    source, engine = c("extraction.source_type"), c("extraction.engine")
    rules += _enum("extraction.source_type", source, tuple(SOURCE_ENGINES))
    rules += _enum("extraction.engine", engine, tuple(SOURCE_ENGINES.values()))
    for kind, fitting in SOURCE_ENGINES.items():
        rules.append((f"extraction.engine:not_for_{kind}", (source == kind) & (engine != fitting)))
    rules += _length("extraction.template_id", c("extraction.template_id"), 3, 120)
    rules += _params("extraction.required_params", c("extraction.required_params"), 1)
    rules += _params("extraction.optional_params", c("extraction.optional_params"), 0)
    for name, high in (("row_limit", 100_000_000), ("timeout_seconds", 86_400)):
        for prefix in ("default", "max"):
            rules += _range(f"extraction.{prefix}_{name}", c(f"extraction.{prefix}_{name}"), high)
    rules += _names(
        "extraction.allowed_select_fields", c("extraction.allowed_select_fields"), 1, 128, 0, False)
    filters = c("extraction.allowed_filters")
    rules += [
        ("extraction.allowed_filters:item_field", F.exists(
            filters, lambda f: f["field"].isNull() | ~F.length(f["field"]).between(1, 128))),
        ("extraction.allowed_filters:item_operators", F.exists(filters, lambda f: (
            f["operators"].isNull() | (F.size(f["operators"]) < 1)
            | (F.size(F.array_distinct(f["operators"])) < F.size(f["operators"]))
            | F.exists(f["operators"], lambda o: ~o.isin(*FILTER_OPERATORS))))),
    ]
    rules += _enum("delivery.output_format", c("delivery.output_format"), ("csv", "parquet", "jsonl"))
    rules += _length("delivery.naming_convention", c("delivery.naming_convention"), 3, 200)
    targets = c("delivery.delivery_targets")
    rules += [
        ("delivery.delivery_targets:missing", targets.isNull()),
        ("delivery.delivery_targets:too_few", F.size(targets) < 1),
        ("delivery.delivery_targets:not_unique", F.size(F.array_distinct(targets)) < F.size(targets)),
        ("delivery.delivery_targets:item", F.exists(targets, lambda t: (
            t["target_id"].isNull() | ~F.length(t["target_id"]).between(3, 120)
            | t["type"].isNull() | ~t["type"].isin("s3", "sftp") | (F.length(t["description"]) > 300)))),
    ]
    rules += _names("delivery.manifest_requirements", c("delivery.manifest_requirements"), 2, 120)
    schedule = c("operations.schedule_constraints")
    rules += [
        ("operations.schedule_constraints:incomplete", schedule.isNotNull() & (
            schedule["enabled"].isNull() | schedule["allowed_utc_windows"].isNull())),
        ("operations.schedule_constraints:window", F.exists(
            schedule["allowed_utc_windows"], lambda w: ~w.rlike(WINDOW_PATTERN))),
    ]
    rules += _enum("operations.idempotency_scope", c("operations.idempotency_scope"),
                   ("dataproduct_plus_params", "request_id", "requester_plus_params"))
    rules += _enum("operations.audit_level", c("operations.audit_level"), ("standard", "verbose"))
    notices = c("operations.notifications")
    rules += [("operations.notifications:missing", notices.isNull())]
    for name in ("on_request", "on_success", "on_failure"):
        rules += [
            (f"operations.notifications.{name}:missing", notices.isNotNull() & notices[name].isNull()),
            (f"operations.notifications.{name}:format", F.exists(
                notices[name], lambda address: ~address.rlike(EMAIL_PATTERN))),
        ]
    if raw is not None:
        rules = [(code, broken & F.coalesce(_kind(code[:-8]) == "VOID", F.lit(True)))
                 if code.endswith(":missing") and code[:-8] in FIELD_KINDS else (code, broken) for code, broken in rules]
    return definitions.withColumn("violations", violations(*rules)).drop(*[n for n in definitions.columns if n.startswith("__kinds:")])

"""Request validation over whole tables of requests.

Each operator adds one column that says what is wrong with a row; a bad
request is a row with violations, never a failed job. ``request_decision``
puts the checks in their fixed order, so the first violation is the one a
request-at-a-time service would have stopped at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import GLOBAL_ROW_CAP, GLOBAL_TIMEOUT_CAP, TEMPLATES
from ..functions.hashing import scoped_fingerprint as scoped_fingerprint_column
from ..functions.rules import first_violation, violations
from ..functions.text import clean, is_blank
from ..sources.documents import REQUEST_OPTIONAL, REQUEST_REQUIRED
from ..sources.files import resolve_file_request
from .registry import ID_PATTERN, registry_lookup

REQUEST_ID_PATTERN = "^[A-Za-z0-9._-]+$"
INTEGER_JSON = "^(BIGINT|DECIMAL\\([0-9]+,0\\))$"
NUMBER_JSON = "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"
SCALAR_JSON = "^(STRING|BOOLEAN|BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"
CONTRACT_API_VERSION = "v3.1.0"

# Columns the checks share: parsed values, their JSON types and texts, and a product's param names.
_PARAMS, _KINDS, _TEXTS, _REQUIRED, _ALLOWED, _VALUES = "__params", "__kinds", "__texts", "__required", "__allowed", "__values"


def _string_list(values) -> Column:
    return F.array(*[F.lit(value) for value in values]).cast("array<string>")


def request_schema_check(requests: DataFrame) -> DataFrame:
    """Requests from ``read_requests`` with ``schema_violations`` in document order.

    Envelope rules come first, then the fields by name. A field that is blank
    after trimming counts as null, which an optional text field may not be.
    """
    kinds, c = F.col("field_types"), F.col
    kind = {name: kinds[name] for name in REQUEST_REQUIRED + REQUEST_OPTIONAL}
    extra = F.array_except(F.map_keys(kinds), _string_list(REQUEST_REQUIRED + REQUEST_OPTIONAL))
    readable = c("status") == "ok"
    rules: list[tuple[str, Column]] = [
        ("document:blank", c("status") == "blank"),
        ("document:invalid_json", c("status") == "invalid_json"),
        ("document:not_object", c("status") == "not_object"),
        ("document:unexpected_key", F.size(extra) > 0),
    ]
    rules += [(f"{name}:missing", readable & kind[name].isNull()) for name in sorted(REQUEST_REQUIRED)]

    def text(name: str, low: int, high: int, pattern: str | None = None) -> None:
        is_text = kind[name] == "STRING"
        rules.append((f"{name}:type", ~is_text if name in REQUEST_REQUIRED else ~is_text | (is_text & c(name).isNull())))
        rules.append((f"{name}:length", is_text & ~F.length(name).between(low, high)))
        if pattern:
            rules.append((f"{name}:pattern", is_text & ~c(name).rlike(pattern)))

    def integer(name: str, high: int) -> None:
        whole = kind[name].rlike(INTEGER_JSON)
        in_range = F.coalesce(c(name).between(1, high), F.lit(False))
        rules.append((f"{name}:type", ~whole))
        rules.append((f"{name}:range", whole & ~in_range))

    text("dataproduct_id", 3, 64, ID_PATTERN)
    text("delivery_target_id", 3, 120)
    text("justification", 0, 2000)
    rules.append(("metadata:type", ~kind["metadata"].startswith("OBJECT")))
    rules.append(("metadata:not_scalar", F.exists(
        F.map_values("metadata_types"), lambda value: ~value.rlike(SCALAR_JSON))))
    rules.append(("params:type", ~kind["params"].startswith("OBJECT")))
    rules.append(("params:empty", kind["params"].startswith("OBJECT") & (F.size(F.json_object_keys("params")) == 0)))
    text("request_id", 6, 120, REQUEST_ID_PATTERN)
    text("requested_by", 2, 200)
    integer("requested_row_limit", 100_000_000)
    integer("requested_timeout_seconds", 86_400)
    text("requesting_agency", 2, 50)
    return requests.withColumn("schema_violations", violations(*rules))


def with_param_map(df: DataFrame, params: str = "params") -> DataFrame:
    """Parse the params text once into values, JSON types and texts by name, which all checks read."""
    if _PARAMS in df.columns:
        return df
    parsed = F.try_variant_get(F.try_parse_json(F.col(params)), "$", "map<string,variant>")
    names = {}
    if "required_params" in df.columns and _REQUIRED not in df.columns:
        names = param_names()
    return df.withColumns({_PARAMS: parsed, **names}).withColumns({
        _KINDS: F.transform_values(_PARAMS, lambda _, value: F.schema_of_variant(value)),
        _TEXTS: F.transform_values(_PARAMS, lambda _, value: F.try_variant_get(value, "$", "string")),
    })


def param_names() -> dict[str, Column]:
    """Names of a product's required params and of all its params."""
    return {
        _REQUIRED: _param_names(F.col("required_params")),
        _ALLOWED: F.array_union(_param_names(F.col("required_params")), _param_names(F.col("optional_params"))),
        _VALUES: _value_rules(),
    }


def _comparable(value: Column) -> Column:
    """A JSON value as text under which equal values are equal: types differ, ``1``, ``1.0`` and ``true`` do not."""
    kind, text = F.schema_of_variant(value), F.try_variant_get(value, "$", "string")
    digits = F.regexp_replace(F.try_variant_get(value, "$", "decimal(38,18)").cast("string"), "\\.?0+$", "")
    return (
        F.when(kind == "STRING", F.concat(F.lit("text "), text))
        .when(kind == "BOOLEAN", F.when(text == "true", "number 1").otherwise("number 0"))
        .when(kind.rlike(NUMBER_JSON), F.concat(F.lit("number "), F.coalesce(digits, text)))
        .otherwise(F.concat(F.lit("json "), F.coalesce(text, F.lit("null"))))
    )


def _value_rules() -> Column:
    """Params with a non-empty list of allowed values, as ``(name, allowed)``."""
    definitions = F.concat(F.coalesce("required_params", F.array()), F.coalesce("optional_params", F.array()))
    listed = F.transform(definitions, lambda p: F.struct(p["name"].alias("name"), F.transform(
        F.try_variant_get(F.try_parse_json(p["allowed_values"]), "$", "array<variant>"), _comparable).alias("allowed")))
    return F.filter(listed, lambda p: F.size(p["allowed"]) > 0)


def drop_param_map(df: DataFrame) -> DataFrame:
    return df.drop(_PARAMS, _KINDS, _TEXTS, _REQUIRED, _ALLOWED, _VALUES)


def _has(name: str) -> Column:
    return F.map_contains_key(F.col(_PARAMS), name)


def _kind(name: Column | str) -> Column:
    return F.col(_KINDS)[name]


def _param_names(definitions: Column) -> Column:
    return F.transform(F.coalesce(definitions, F.array()), lambda p: p["name"])


def unknown_param_names() -> Column:
    return F.sort_array(F.array_except(F.map_keys(_PARAMS), F.col(_ALLOWED)))


def _absent(name: Column) -> Column:
    """Null, JSON null or blank text; an empty list, zero and false are present."""
    kind = F.coalesce(_kind(name), F.lit("VOID"))
    return (kind == "VOID") | ((kind == "STRING") & is_blank(F.col(_TEXTS)[name]))


def missing_param_names(required: Column) -> Column:
    return F.sort_array(F.filter(required, _absent))


def bad_param_values() -> Column:
    """Names of params whose value, type included, is outside their non-empty list of allowed values."""
    broken = F.filter(_VALUES, lambda p: F.map_contains_key(F.col(_PARAMS), p["name"]) & ~F.coalesce(
        F.array_contains(p["allowed"], _comparable(F.col(_PARAMS)[p["name"]])), F.lit(False)))
    return F.sort_array(F.transform(broken, lambda p: p["name"]))


def select_violations() -> Column:
    """Disallowed select fields, or ``not_array``; an empty allow-list is no restriction."""
    value = F.col(_PARAMS)["select_fields"]
    fields = F.try_variant_get(value, "$", "array<string>")
    restricted = (F.size("allowed_select_fields") > 0) & _has("select_fields")
    none = F.array().cast("array<string>")
    return (
        F.when(~F.coalesce(restricted, F.lit(False)), none)
        .when(~F.coalesce(_kind("select_fields").startswith("ARRAY"), F.lit(False)), _string_list(["not_array"]))
        .otherwise(F.sort_array(F.array_except(fields, "allowed_select_fields")))
    )


def filter_violations() -> Column:
    """Unknown fields as ``field`` and forbidden operators as ``field.operator``."""
    value = F.col(_PARAMS)["filters"]
    requested = F.map_entries(F.try_variant_get(value, "$", "map<string,variant>"))
    restricted = (F.size("allowed_filters") > 0) & _has("filters")

    def of_field(entry: Column) -> Column:
        rules = F.filter("allowed_filters", lambda f: f["field"] == entry["key"])
        operators = F.map_keys(F.try_variant_get(entry["value"], "$", "map<string,variant>"))
        # A field listed twice in a definition is governed by its last entry.
        allowed = F.element_at(rules, -1)["operators"]
        return (
            F.when(F.size(rules) == 0, F.array(entry["key"]))
            .when(operators.isNull(), F.array(F.concat(entry["key"], F.lit(":not_object"))))
            .otherwise(F.transform(F.array_except(operators, allowed), lambda o: F.concat(entry["key"], F.lit("."), o)))
        )

    none = F.array().cast("array<string>")
    return (
        F.when(~F.coalesce(restricted, F.lit(False)), none)
        .when(~F.coalesce(_kind("filters").startswith("OBJECT"), F.lit(False)), _string_list(["not_object"]))
        .otherwise(F.sort_array(F.flatten(F.transform(requested, of_field))))
    )


def source_type_violation(path: Column | str = "sql") -> Column:
    """A query needs an SQL product; a file transfer needs a file product on the object store."""
    route = F.lit(path) if isinstance(path, str) else path
    source, engine = F.col("source_type"), F.col("engine")
    return (
        F.when(source.isNull(), F.lit("extraction_missing"))
        .when(source != route, F.lit("source_type_mismatch"))
        .when((route == "file") & (F.coalesce(engine, F.lit("")) != "s3-file"), F.lit("engine_mismatch"))
    )


def _template_map(field: str, templates: dict) -> Column:
    pairs = []
    for name, rules in sorted(templates.items()):
        value = rules[field]
        pairs += [F.lit(name), _string_list(value) if isinstance(value, (tuple, list)) else F.lit(value)]
    return F.create_map(*pairs)


def template_violation(templates: dict = TEMPLATES) -> Column:
    template = F.col("template_id")
    required = _template_map("required_params", templates)[template]
    return (
        F.when(is_blank(template), F.lit("template_missing"))
        .when(required.isNull(), F.lit("template_not_allowed"))
        .when(F.size(missing_param_names(required)) > 0, F.lit("template_params_missing"))
    )


def source_type_check(df: DataFrame, path: Column | str = "sql") -> DataFrame:
    return df.withColumn("source_type_violation", source_type_violation(path))


def unknown_params(df: DataFrame) -> DataFrame:
    """Param names outside required and optional ones, sorted."""
    return drop_param_map(with_param_map(df).withColumn("unknown_params", unknown_param_names()))


def missing_params(df: DataFrame) -> DataFrame:
    names = missing_param_names(F.col(_REQUIRED))
    return drop_param_map(with_param_map(df).withColumn("missing_params", names))


def param_values(df: DataFrame) -> DataFrame:
    return drop_param_map(with_param_map(df).withColumn("bad_values", bad_param_values()))


def select_allow_list(df: DataFrame) -> DataFrame:
    return drop_param_map(with_param_map(df).withColumn("select_violations", select_violations()))


def filter_allow_list(df: DataFrame) -> DataFrame:
    return drop_param_map(with_param_map(df).withColumn("filter_violations", filter_violations()))


def template_allow_list(df: DataFrame, templates: dict = TEMPLATES) -> DataFrame:
    return drop_param_map(with_param_map(df).withColumn("template_violation", template_violation(templates)))


def param_set_difference(given: Column, required: Column, optional: Column) -> Column:
    """Names given but neither required nor optional, sorted."""
    return F.sort_array(F.array_except(given, F.array_union(required, optional)))


def limit_resolution(
    df: DataFrame,
    row_cap: int = GLOBAL_ROW_CAP,
    timeout_cap: int = GLOBAL_TIMEOUT_CAP,
    templates: dict = TEMPLATES,
) -> DataFrame:
    """Effective limits and caps; a request above its cap is refused, not clamped.

    The limit is the requested one, else the product's default. The cap is the
    least of the global, the product's and the template's.
    """
    def cap(limit: int, product: str, field: str) -> Column:
        template = _template_map(field, templates)[F.col("template_id")]
        return F.least(F.lit(limit), F.coalesce(product, F.lit(limit)), F.coalesce(template, F.lit(limit))).cast("bigint")

    return df.withColumns({
        "row_limit": F.coalesce("requested_row_limit", "default_row_limit", F.lit(row_cap)).cast("bigint"),
        "timeout_seconds": F.coalesce(
            "requested_timeout_seconds", "default_timeout_seconds", F.lit(timeout_cap)).cast("bigint"),
        "row_limit_cap": cap(row_cap, "max_row_limit", "max_row_limit"),
        "timeout_cap": cap(timeout_cap, "max_timeout_seconds", "max_timeout_seconds"),
    }).withColumn("limit_violations", violations(
        ("row_limit_exceeds_cap", F.col("row_limit") > F.col("row_limit_cap")),
        ("timeout_exceeds_cap", F.col("timeout_seconds") > F.col("timeout_cap")),
    ))


def contract_version_check(version: Column, supported: str = CONTRACT_API_VERSION) -> Column:
    """True when a data contract states the supported API version."""
    return F.coalesce(version == supported, F.lit(False))


def policy_decision(agency: Column, file_count: Column) -> Column:
    """``struct(decision, reason)``; a transfer is allowed once its agency and file count make sense."""
    reason = (
        F.when(is_blank(agency), F.lit("agency_blank"))
        .when(file_count.isNull() | (file_count < 1), F.lit("file_count_invalid"))
        .otherwise(F.lit("policy_approved"))
    )
    decision = F.when(reason == "policy_approved", F.lit("allow")).otherwise(F.lit("error"))
    return F.struct(decision.alias("decision"), reason.alias("reason"))


def _coded(code: str, names: Column) -> Column:
    return F.transform(names, lambda name: F.concat(F.lit(f"{code}:"), name))


def request_decision(
    requests: DataFrame,
    active: DataFrame,
    row_cap: int = GLOBAL_ROW_CAP,
    timeout_cap: int = GLOBAL_TIMEOUT_CAP,
    templates: dict = TEMPLATES,
) -> DataFrame:
    """Accept or reject every request for an SQL product.

    ``violations`` holds all codes in checking order and ``first_violation`` the
    first of them. One plan: requests are read once, joined once to the
    registry, and all checks are expressions over the joined row. Requests that
    carry ``schema_violations`` keep them in front.
    """
    joined = with_param_map(registry_lookup(requests, active.withColumns(param_names())))
    resolved = limit_resolution(joined, row_cap, timeout_cap, templates)
    known = F.col("known_product")
    none = F.array().cast("array<string>")
    single = lambda code: F.array_compact(F.array(code))
    product_checks = F.concat(
        single(source_type_violation()),
        _coded("unknown_param", unknown_param_names()),
        _coded("missing_param", missing_param_names(F.col(_REQUIRED))),
        _coded("param_value", bad_param_values()),
        _coded("select_field", select_violations()),
        _coded("filter", filter_violations()),
        single(template_violation(templates)),
        F.col("limit_violations"),
    )
    params_unreadable = F.when(F.col(_PARAMS).isNull(), F.array(F.lit("params_not_object"))).otherwise(none)
    codes = F.concat(
        params_unreadable,
        F.when(known, F.coalesce(product_checks, none)).otherwise(F.array(F.lit("unknown_dataproduct"))),
    )
    if "schema_violations" in requests.columns:
        codes = F.concat(F.coalesce("schema_violations", none), codes)
    decided = resolved.withColumn("violations", codes).withColumn("first_violation", first_violation(F.col("violations")))
    accepted = F.size("violations") == 0
    return drop_param_map(decided).withColumns({
        "decision": F.when(accepted, F.lit("accepted")).otherwise(F.lit("rejected")),
        "effective_row_limit": F.when(accepted, F.col("row_limit")),
        "effective_timeout_seconds": F.when(accepted, F.col("timeout_seconds")),
        "effective_template_id": F.when(accepted, F.col("template_id")),
    })


def file_request_decision(requests: DataFrame, active: DataFrame) -> DataFrame:
    """Accept or reject every request for a file product, and resolve the object it names.

    Params are held to the same rules; ``s3_path`` must be a non-blank text that
    names a bucket and a key, and ``file_name`` may rename the file.
    """
    joined = with_param_map(registry_lookup(requests, active.withColumns(param_names())))
    is_text = lambda name: F.when(_kind(name) == "STRING", F.col(_TEXTS)[name])
    named = joined.withColumns({"__uri": is_text("s3_path"), "__override": is_text("file_name")})
    located = resolve_file_request(named, "__uri", "__override", "path_status")
    none = F.array().cast("array<string>")
    path_code = F.when(F.col("path_status") != "ok", F.concat(F.lit("s3_path:"), F.col("path_status")))
    checks = F.concat(
        F.array_compact(F.array(source_type_violation("file"))),
        _coded("unknown_param", unknown_param_names()),
        _coded("missing_param", missing_param_names(F.col(_REQUIRED))),
        _coded("param_value", bad_param_values()),
        F.array_compact(F.array(path_code)),
    )
    unreadable = F.when(F.col(_PARAMS).isNull(), F.array(F.lit("params_not_object"))).otherwise(none)
    codes = F.concat(
        unreadable, F.when(F.col("known_product"), F.coalesce(checks, none)).otherwise(F.array(F.lit("unknown_dataproduct"))))
    if "schema_violations" in requests.columns:
        codes = F.concat(F.coalesce("schema_violations", none), codes)
    decided = located.withColumn("violations", codes)
    accepted = F.size("violations") == 0
    return drop_param_map(decided).drop("__uri", "__override", "path_status").withColumns({
        "first_violation": first_violation(F.col("violations")),
        "decision": F.when(accepted, F.lit("accepted")).otherwise(F.lit("rejected")),
        **{name: F.when(accepted, F.col(name)) for name in ("bucket", "object_key", "file_name", "marker_directory")},
    })


# Checks that product definitions declare. They extend the executed ones above.


def access_check(df: DataFrame, role: str | None = None) -> DataFrame:
    """Adds ``access``: the requesting agency, and the role where roles are listed, must be allowed."""
    agencies, roles = F.col("allowed_requesting_agencies"), F.col("allowed_requesting_roles")
    agency_ok = F.coalesce(F.array_contains(agencies, F.col("requesting_agency")), F.lit(False))
    code = F.when(~agency_ok, F.lit("agency_not_allowed"))
    if role is not None:
        listed = F.coalesce(F.size(roles), F.lit(0)) > 0
        role_ok = F.coalesce(F.array_contains(roles, F.col(role)), F.lit(False))
        code = code.when(listed & ~role_ok, F.lit("role_not_allowed"))
    return df.withColumn("access", code.otherwise(F.lit("allowed")))


def in_schedule_window(moment: Column, windows: Column, enabled: Column) -> Column:
    """True when a UTC time lies in one of the ``HH:MM-HH:MM`` windows.

    The end is exclusive and a window whose start is after its end wraps
    midnight. Disabled or empty windows are no restriction.
    """
    minute = F.hour(moment) * 60 + F.minute(moment)

    def at(text: Column, start: int) -> Column:
        return F.substring(text, start, 2).try_cast("int") * 60 + F.substring(text, start + 3, 2).try_cast("int")

    def inside(window: Column) -> Column:
        low, high = at(window, 1), at(window, 7)
        return F.when(low <= high, (minute >= low) & (minute < high)).otherwise((minute >= low) | (minute < high))

    restricted = F.coalesce(enabled, F.lit(False)) & (F.coalesce(F.size(windows), F.lit(0)) > 0)
    return ~restricted | F.coalesce(F.exists(windows, inside), F.lit(False))


def schedule_window_check(df: DataFrame, moment: str) -> DataFrame:
    schedule = F.col("schedule_constraints")
    return df.withColumn(
        "in_window", in_schedule_window(F.col(moment), schedule["allowed_utc_windows"], schedule["enabled"]))


def param_type_check(df: DataFrame) -> DataFrame:
    """Adds ``type_violations``: params whose JSON type, minimum or maximum breaks their definition."""
    definitions = F.concat(F.coalesce("required_params", F.array()), F.coalesce("optional_params", F.array()))

    def codes(p: Column) -> Column:
        kind, text = _kind(p["name"]), F.col(_TEXTS)[p["name"]]
        is_text = kind == "STRING"
        fits = (
            F.when(p["type"] == "string", is_text)
            .when(p["type"] == "integer", kind.rlike(INTEGER_JSON))
            .when(p["type"] == "number", kind.rlike(NUMBER_JSON))
            .when(p["type"] == "boolean", kind == "BOOLEAN")
            .when(p["type"] == "date", is_text & text.try_cast("date").isNotNull())
            .when(p["type"] == "datetime", is_text & text.try_cast("timestamp").isNotNull())
            .when(p["type"] == "array", kind.startswith("ARRAY"))
            .when(p["type"] == "object", kind.startswith("OBJECT"))
        )
        number = F.when(kind.rlike(NUMBER_JSON), text.try_cast("double"))
        return violations_of(p["name"], (":type", ~fits), (":min", number < p["min"]), (":max", number > p["max"]))

    def violations_of(name: Column, *rules: tuple[str, Column]) -> Column:
        return F.array_compact(F.array(*[F.when(broken, F.concat(name, F.lit(code))) for code, broken in rules]))

    present = F.filter(definitions, lambda p: F.map_contains_key(F.col(_PARAMS), p["name"]))
    found = F.sort_array(F.flatten(F.transform(present, codes)))
    return drop_param_map(with_param_map(df).withColumn("type_violations", found))


def scoped_fingerprint(df: DataFrame) -> DataFrame:
    """Adds the request's identity under its product's idempotency scope."""
    return df.withColumn("scoped_fingerprint", scoped_fingerprint_column(
        F.col("idempotency_scope"), F.col("dataproduct_id"), F.col("request_id"),
        clean(F.col("requesting_agency")), F.col("params"),
    ))


def manifest_required_fields(df: DataFrame, present: str, required: str = "manifest_requirements") -> DataFrame:
    """Adds ``missing_manifest_fields``: names a product requires and a manifest lacks."""
    return df.withColumn("missing_manifest_fields", F.sort_array(F.array_except(required, present)))


def retention_expired(df: DataFrame, stored_at: str, as_of: Column, days: str = "retention_policy_days") -> DataFrame:
    """Adds ``expired``: the retention period ended before ``as_of``."""
    return df.withColumn("expired", F.date_add(F.col(stored_at).cast("date"), F.col(days).cast("int")) < as_of)

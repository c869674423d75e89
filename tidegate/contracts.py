"""Extract contracts: the small request envelope that is parsed on the driver.

A contract says what one extract reads and keeps. All rows stay in Spark; only
this specification and the literals inside it are handled in Python.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from datetime import date, datetime
from decimal import Decimal, InvalidOperation
from typing import Any

from pyspark.sql import types as T

# Contract defaults and the global caps.
DEFAULT_ROW_LIMIT = 10_000
DEFAULT_TIMEOUT_SECONDS = 60
GLOBAL_ROW_CAP = 1_000_000
GLOBAL_TIMEOUT_CAP = 600

# Templates an extract may name, with what each requires and allows.
TEMPLATES = {
    "dot_contract_extract_v1": {
        "required_params": ("schema", "table"),
        "max_row_limit": 100_000,
        "max_timeout_seconds": 300,
    },
}

OPERATORS = ("min", "max", "equal", "in")


class ContractError(ValueError):
    """A contract that cannot be executed; ``code`` names the broken rule."""

    def __init__(self, code: str, message: str):
        super().__init__(message)
        self.code = code


@dataclass(frozen=True)
class FieldFilter:
    """One operator applied to one field."""

    field: str
    operator: str
    value: Any


@dataclass(frozen=True)
class ExtractSpec:
    """A parsed contract: scan, filters, projection, order and cap, applied in that order."""

    schema: str
    table: str
    filters: tuple[FieldFilter, ...] = ()
    select_fields: tuple[str, ...] = ()
    order_field: str | None = None
    descending: bool = False
    row_limit: int = DEFAULT_ROW_LIMIT
    timeout_seconds: int = DEFAULT_TIMEOUT_SECONDS
    template_id: str = "dot_contract_extract_v1"
    params: dict[str, Any] = field(default_factory=dict, compare=False)

    @classmethod
    def from_json(cls, text: str) -> ExtractSpec:
        if not text or not text.strip():
            raise ContractError("blank", "contract is blank")
        try:
            payload = json.loads(text)
        except json.JSONDecodeError as exc:
            raise ContractError("invalid_json", f"contract is not valid JSON: {exc}") from exc
        return cls.from_dict(payload)

    @classmethod
    def from_dict(cls, payload: Any) -> ExtractSpec:
        if not isinstance(payload, dict) or not isinstance(payload.get("params"), dict):
            raise ContractError("not_object", "contract and its params must be objects")
        params = payload["params"]
        schema, table = params.get("schema"), params.get("table")
        if not _present(schema) or not _present(table):
            raise ContractError("missing_params", "params must name 'schema' and 'table'")
        order_field, descending = parse_order(params.get("order_by"))
        return cls(
            schema=schema,
            table=table,
            filters=parse_filters(params.get("filters")),
            select_fields=_field_list(params.get("select_fields")),
            order_field=order_field,
            descending=descending,
            row_limit=_positive(payload, "row_limit", DEFAULT_ROW_LIMIT),
            timeout_seconds=_positive(payload, "timeout_seconds", DEFAULT_TIMEOUT_SECONDS),
            template_id=payload.get("template_id") or "",
            params=params,
        )

    def check_template(
        self, row_cap: int = GLOBAL_ROW_CAP, timeout_cap: int = GLOBAL_TIMEOUT_CAP, templates: dict = TEMPLATES
    ) -> ExtractSpec:
        """Reject an unlisted template, a missing template param or a limit above its cap."""
        rules = templates.get(self.template_id)
        if rules is None:
            raise ContractError("template_not_allowed", f"template '{self.template_id}' is not allow-listed")
        missing = sorted(name for name in rules["required_params"] if not _present(self.params.get(name)))
        if missing:
            raise ContractError("template_params_missing", f"missing template params: {missing}")
        if self.row_limit > min(row_cap, rules["max_row_limit"]):
            raise ContractError("row_limit_exceeds_cap", f"row_limit {self.row_limit} is above the cap")
        if self.timeout_seconds > min(timeout_cap, rules["max_timeout_seconds"]):
            raise ContractError("timeout_exceeds_cap", f"timeout_seconds {self.timeout_seconds} is above the cap")
        return self


def _present(value: Any) -> bool:
    return value is not None and not (isinstance(value, str) and not value.strip())


def _positive(payload: dict, name: str, default: int) -> int:
    value = payload.get(name, default)
    if isinstance(value, bool) or not isinstance(value, int) or value < 1:
        raise ContractError(f"{name}_invalid", f"{name} must be an integer of at least 1")
    return value


def _field_list(value: Any) -> tuple[str, ...]:
    if not value:
        return ()
    if not isinstance(value, list) or not all(isinstance(item, str) for item in value):
        raise ContractError("select_fields_not_array", "select_fields must be an array of names")
    return tuple(value)


def parse_order(order_by: Any) -> tuple[str | None, bool]:
    """``field [ASC|DESC]``, one key only; anything else is refused rather than half understood."""
    if not order_by:
        return None, False
    tokens = str(order_by).split()
    if len(tokens) > 2 or (len(tokens) == 2 and tokens[1].lower() not in ("asc", "desc")):
        raise ContractError("order_by_invalid", f"order_by must be 'field [ASC|DESC]', got '{order_by}'")
    if not tokens or "," in tokens[0]:
        raise ContractError("order_by_invalid", f"order_by takes one field, got '{order_by}'")
    return tokens[0], len(tokens) == 2 and tokens[1].lower() == "desc"


def parse_filters(filters: Any) -> tuple[FieldFilter, ...]:
    if not filters:
        return ()
    if not isinstance(filters, dict):
        raise ContractError("filters_not_object", "filters must be an object")
    parsed = []
    for name, operators in filters.items():
        if not isinstance(operators, dict):
            raise ContractError("filter_not_object", f"filter for '{name}' must be an object")
        for operator, value in operators.items():
            if operator not in OPERATORS:
                raise ContractError("filter_operator_unknown", f"operator '{operator}' on '{name}' is not supported")
            if operator == "in" and not isinstance(value, list):
                raise ContractError("filter_value_invalid", f"'in' on '{name}' needs an array")
            parsed.append(FieldFilter(name, operator, value))
    return tuple(parsed)


def typed_value(value: Any, dtype: T.DataType, name: str) -> Any:
    """The literal as a Python value of the column's type, checked before any job starts."""
    try:
        if isinstance(dtype, T.BooleanType):
            if isinstance(value, bool):
                return value
        elif isinstance(dtype, T.NumericType):
            if not isinstance(value, bool) and isinstance(value, (int, float, Decimal, str)):
                number = Decimal(str(value))
                if number.is_finite():
                    return number
        elif isinstance(dtype, T.DateType):
            return date.fromisoformat(value)
        elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            return datetime.fromisoformat(value)
        elif isinstance(dtype, T.StringType):
            if isinstance(value, str):
                return value
    except (TypeError, ValueError, InvalidOperation):
        pass
    raise ContractError("filter_value_invalid", f"value {value!r} does not fit '{name}' of type {dtype.simpleString()}")

"""Contract parsing: what is refused, and with which code."""

import json

import pytest

from tidegate.contracts import ContractError, ExtractSpec, parse_filters, parse_order


def contract(**params):
    return {"template_id": "dot_contract_extract_v1", "params": {"schema": "dot", "table": "t", **params}}


def code(callable_, *args):
    with pytest.raises(ContractError) as caught:
        callable_(*args)
    return caught.value.code


@pytest.mark.parametrize("text, expected", [
    ("", "blank"), ("  ", "blank"), ("{", "invalid_json"), ("[]", "not_object"), ('{"params": []}', "not_object"),
    ('{"params": {"schema": "", "table": "t"}}', "missing_params"), ('{"params": {"schema": "s"}}', "missing_params"),
])
def test_bad_documents(text, expected):
    assert code(ExtractSpec.from_json, text) == expected


def test_defaults():
    spec = ExtractSpec.from_json(json.dumps(contract()))
    assert (spec.row_limit, spec.timeout_seconds, spec.order_field, spec.filters) == (10_000, 60, None, ())


@pytest.mark.parametrize("order_by, expected", [
    ("award_date", ("award_date", False)), ("award_date DESC", ("award_date", True)), (" a asc ", ("a", False)),
    ("a desc", ("a", True)), (None, (None, False)), ("", (None, False)),
])
def test_order(order_by, expected):
    assert parse_order(order_by) == expected


@pytest.mark.parametrize("order_by", ["a DESC, b", "a sideways", "a,b", "a desc b"])
def test_order_refused(order_by):
    assert code(parse_order, order_by) == "order_by_invalid"


@pytest.mark.parametrize("filters, expected", [
    ([1], "filters_not_object"), ({"a": 5}, "filter_not_object"), ({"a": {"like": 1}}, "filter_operator_unknown"),
    ({"a": {"in": 5}}, "filter_value_invalid"),
])
def test_filters_refused(filters, expected):
    assert code(parse_filters, filters) == expected


@pytest.mark.parametrize("field, value, expected", [
    ("row_limit", 0, "row_limit_invalid"), ("row_limit", True, "row_limit_invalid"), ("row_limit", 1.5, "row_limit_invalid"),
    ("timeout_seconds", "9", "timeout_seconds_invalid"),
])
def test_limits_refused(field, value, expected):
    assert code(ExtractSpec.from_dict, {**contract(), field: value}) == expected


@pytest.mark.parametrize("change, expected", [
    ({"template_id": "other"}, "template_not_allowed"), ({"row_limit": 100_001}, "row_limit_exceeds_cap"),
    ({"timeout_seconds": 301}, "timeout_exceeds_cap"),
])
def test_template_caps_reject_and_do_not_clamp(change, expected):
    assert code(ExtractSpec.from_dict({**contract(), **change}).check_template) == expected


def test_template_cap_is_the_least_of_all():
    spec = ExtractSpec.from_dict({**contract(), "row_limit": 600})
    assert spec.check_template() is spec
    assert code(lambda: spec.check_template(row_cap=500)) == "row_limit_exceeds_cap"

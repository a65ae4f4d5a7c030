from __future__ import annotations

import math

import pytest

from rowguard.catalogs import YELLOW_TAXI
from rowguard.rules import (
    FLAG,
    REMOVE,
    SET_NULL,
    Catalog,
    ColumnRule,
    DuplicateRule,
    MonthRule,
    TimeOrderRule,
    column_rules,
    require_columns,
)


def test_specific_action_before_general_one():
    rule = ColumnRule("v", min=0, max=9, on_below_min=REMOVE, on_violation=FLAG)
    assert rule.below_min_action == REMOVE
    assert rule.above_max_action == FLAG
    assert rule.domain_action == FLAG
    assert ColumnRule("v", min=0).below_min_action is None


def test_rules_from_plain_mappings():
    specs = {
        "distance": {"min": 0, "min_inclusive": False, "max": 100, "on_below_min": "remove"},
        "code": {"allowed": {1, 2}, "on_violation": "flag", "on_null": "keep_null"},
    }
    rules = column_rules(specs)
    assert [rule.column for rule in rules] == ["distance", "code"]
    assert rules[0] == ColumnRule(
        "distance", min=0, min_inclusive=False, max=100, on_below_min=REMOVE
    )
    assert set(rules[1].allowed) == {1, 2}


@pytest.mark.parametrize(
    "wrong",
    [
        {"on_below_min": "delete"},
        {"on_violation": "keep_null"},
        {"on_null": "remove"},
        {"min": "0"},
        {"min": True},
        {"max": math.nan},
        {"allowed": (1, "Y")},
        {"allowed": (None,)},
    ],
)
def test_senseless_column_rules_are_refused(wrong):
    with pytest.raises(ValueError):
        ColumnRule("v", **wrong)


def test_cross_rules_take_their_one_action_or_none():
    assert TimeOrderRule("t", "a", "b").on_violation == REMOVE
    assert MonthRule("m", "a", on_violation=None).on_violation is None
    with pytest.raises(ValueError):
        TimeOrderRule("t", "a", "b", on_violation=FLAG)
    with pytest.raises(ValueError):
        MonthRule("m", "a", on_violation=REMOVE)
    with pytest.raises(ValueError):
        DuplicateRule("d", on_violation=SET_NULL)


def test_catalog_is_checked():
    with pytest.raises(ValueError, match="More than one rule"):
        Catalog(columns=(ColumnRule("v"), ColumnRule("v")))
    with pytest.raises(ValueError, match="flag column"):
        Catalog(columns=(ColumnRule("dq_flags"),))
    assert YELLOW_TAXI.column_rule("fare_amount").max == 500
    with pytest.raises(KeyError):
        YELLOW_TAXI.column_rule("tip_amount")


def test_require_columns():
    require_columns(["a", "b"], ["a"])
    with pytest.raises(ValueError, match=r"Missing required columns: \['A', 'c'\]"):
        require_columns(["a", "b"], ["A", "b", "c"])


def test_shipped_labels():
    labels = []
    for rule in YELLOW_TAXI.columns:
        if rule.min is not None:
            labels.append((rule.below_min_label, rule.below_min_action))
        if rule.max is not None:
            labels.append((rule.above_max_label, rule.above_max_action))
        if rule.allowed:
            labels.append((rule.domain_label, rule.domain_action))
    assert labels == [
        ("trip_distance:below_min", REMOVE),
        ("trip_distance:above_max", FLAG),
        ("passenger_count:below_min", SET_NULL),
        ("passenger_count:above_max", SET_NULL),
        ("fare_amount:below_min", FLAG),
        ("fare_amount:above_max", FLAG),
        ("total_amount:below_min", FLAG),
        ("total_amount:above_max", FLAG),
        ("RatecodeID:domain", FLAG),
        ("store_and_fwd_flag:domain", FLAG),
    ]

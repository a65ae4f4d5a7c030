"""Declarative rules: plain frozen data on the driver, no Spark objects.

A :class:`Catalog` says what is wrong with a row and what to do about it. It is turned into Spark
columns only when it meets a table (see ``rowguard.operators.binding``).
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from decimal import Decimal
from typing import Any

REMOVE = "remove"
SET_NULL = "set_null"
FLAG = "flag"
KEEP_NULL = "keep_null"

ROW_ACTIONS = (REMOVE, SET_NULL, FLAG)


def _check_action(owner: str, what: str, action: str | None, accepted: tuple[str, ...]) -> None:
    if action is not None and action not in accepted:
        raise ValueError(f"{owner}: {what}={action!r} is not one of {', '.join(accepted)}")


def _is_number(value: Any) -> bool:
    return isinstance(value, (int, float, Decimal)) and not isinstance(value, bool)


@dataclass(frozen=True)
class ColumnRule:
    """Range and domain limits of one column, with the action each kind of breach calls for.

    ``on_below_min`` and ``on_above_max`` fall back to ``on_violation``. A breach without an action
    is counted by the profile but leaves the row alone. A missing value is never a breach.
    """

    column: str
    min: float | int | Decimal | None = None
    max: float | int | Decimal | None = None
    min_inclusive: bool = True
    max_inclusive: bool = True
    allowed: tuple[Any, ...] = ()
    on_below_min: str | None = None
    on_above_max: str | None = None
    on_violation: str | None = None
    on_null: str | None = None
    description: str = ""

    def __post_init__(self) -> None:
        for what in ("min", "max"):
            limit = getattr(self, what)
            if limit is None:
                continue
            if not _is_number(limit) or math.isnan(limit):
                raise ValueError(f"{self.column}: {what}={limit!r} is not a number")
        object.__setattr__(self, "allowed", tuple(self.allowed or ()))
        kinds = {"number" if _is_number(v) else type(v).__name__ for v in self.allowed}
        if not kinds <= {"number", "str"} or len(kinds) > 1:
            raise ValueError(f"{self.column}: allowed must be all numbers or all strings")
        for what in ("on_below_min", "on_above_max", "on_violation"):
            _check_action(self.column, what, getattr(self, what), ROW_ACTIONS)
        _check_action(self.column, "on_null", self.on_null, (KEEP_NULL,))

    @property
    def below_min_action(self) -> str | None:
        return self.on_below_min or self.on_violation

    @property
    def above_max_action(self) -> str | None:
        return self.on_above_max or self.on_violation

    @property
    def domain_action(self) -> str | None:
        return self.on_violation

    @property
    def is_numeric(self) -> bool:
        """True if the limits compare numbers, so that text has to be read as a number first."""
        if self.min is not None or self.max is not None:
            return True
        return bool(self.allowed) and _is_number(self.allowed[0])

    @property
    def below_min_label(self) -> str:
        return f"{self.column}:below_min"

    @property
    def above_max_label(self) -> str:
        return f"{self.column}:above_max"

    @property
    def domain_label(self) -> str:
        return f"{self.column}:domain"

    @classmethod
    def from_spec(cls, column: str, spec: Mapping[str, Any]) -> ColumnRule:
        """Build a rule from a plain mapping with the field names of this class as keys."""
        return cls(column=column, **spec)


@dataclass(frozen=True)
class TimeOrderRule:
    """``end`` must not be earlier than ``start``. The only possible action is removal."""

    label: str
    start: str
    end: str
    on_violation: str | None = REMOVE
    description: str = ""

    def __post_init__(self) -> None:
        _check_action(self.label, "on_violation", self.on_violation, (REMOVE,))


@dataclass(frozen=True)
class MonthRule:
    """``column`` must lie in the month the data is filed under. The only action is a flag.

    The rule is inactive if one of the columns in ``needs`` is absent.
    """

    label: str
    column: str
    needs: tuple[str, ...] = ()
    on_violation: str | None = FLAG
    description: str = ""

    def __post_init__(self) -> None:
        _check_action(self.label, "on_violation", self.on_violation, (FLAG,))


@dataclass(frozen=True)
class DuplicateRule:
    """Identical rows are kept once. The only possible action is removal."""

    label: str
    on_violation: str | None = REMOVE
    description: str = ""

    def __post_init__(self) -> None:
        _check_action(self.label, "on_violation", self.on_violation, (REMOVE,))


@dataclass(frozen=True)
class PolicyLine:
    """One line of the written cleaning policy, with the counters whose rows it speaks about."""

    problem: str
    rule: str
    covers: tuple[str, ...] = ()


@dataclass(frozen=True)
class Catalog:
    """Everything known about one kind of table."""

    columns: tuple[ColumnRule, ...] = ()
    time_order: TimeOrderRule | None = None
    month: MonthRule | None = None
    duplicates: DuplicateRule | None = None
    required: tuple[str, ...] = ()
    policy: tuple[PolicyLine, ...] = ()
    flag_column: str = "dq_flags"
    # Sign breakdown of money columns by a code column, and what the codes stand for.
    money_columns: tuple[str, ...] = ()
    code_column: str | None = None
    code_meanings: Mapping[int, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        names = [rule.column for rule in self.columns]
        repeated = sorted({name for name in names if names.count(name) > 1})
        if repeated:
            raise ValueError(f"More than one rule for columns: {repeated}")
        if self.flag_column in names:
            raise ValueError(f"No rule may be set on the flag column {self.flag_column!r}")

    def column_rule(self, column: str) -> ColumnRule:
        for rule in self.columns:
            if rule.column == column:
                return rule
        raise KeyError(column)


def column_rules(specs: Mapping[str, Mapping[str, Any]]) -> tuple[ColumnRule, ...]:
    """Column rules from a mapping of column name to specification, in the mapping's order."""
    return tuple(ColumnRule.from_spec(column, spec) for column, spec in specs.items())


def require_columns(present: Iterable[str], required: Iterable[str]) -> None:
    """Fail with the list of required columns that are not there. Names are case sensitive."""
    have = set(present)
    absent = [name for name in required if name not in have]
    if absent:
        raise ValueError(f"Missing required columns: {absent}")

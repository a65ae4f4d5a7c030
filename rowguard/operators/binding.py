"""Binding a catalogue to a table: which checks apply, as Spark columns of that table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowguard.functions import conditions, values
from rowguard.functions.conditions import Condition
from rowguard.functions.months import Month, MonthColumn, resolve_month
from rowguard.rules import FLAG, REMOVE, ROW_ACTIONS, SET_NULL, Catalog, ColumnRule

# Name under which each action's rows are counted.
KIND_OF_ACTION = {REMOVE: "removed", SET_NULL: "set_null", FLAG: "flagged"}


@dataclass(frozen=True)
class Check:
    """One possible breach. ``column`` is set for column rules only."""

    label: str
    action: str | None
    condition: Condition
    column: str | None = None

    @property
    def kind(self) -> str | None:
        return KIND_OF_ACTION.get(self.action)


@dataclass(frozen=True)
class ColumnBinding:
    """A column rule and, if its column exists, the reading and its checks by breach name."""

    rule: ColumnRule
    reading: values.Reading | None
    below_min: Check | None = None
    above_max: Check | None = None
    domain: Check | None = None

    @property
    def present(self) -> bool:
        return self.reading is not None

    @property
    def checks(self) -> list[Check]:
        return [c for c in (self.below_min, self.above_max, self.domain) if c is not None]


@dataclass(frozen=True)
class Binding:
    """All checks of a catalogue that apply to one table.

    Every condition refers to the columns of the input, so what one rule does to a value never
    changes the verdict of another.
    """

    catalog: Catalog
    data_columns: tuple[str, ...]
    columns: tuple[ColumnBinding, ...]
    time_order: Check | None
    month: Check | None
    expected: Month | MonthColumn | None

    @property
    def checks(self) -> list[Check]:
        """Catalogue order: per column below, above, domain; then time order; then month."""
        found = [check for column in self.columns for check in column.checks]
        return found + [c for c in (self.time_order, self.month) if c is not None]

    @property
    def active_checks(self) -> list[Check]:
        return [check for check in self.checks if check.action is not None]

    def without_helpers(self, df: DataFrame) -> DataFrame:
        """``df`` as it came, less the column that holds each row's expected month."""
        return df.drop(self.expected.name) if isinstance(self.expected, MonthColumn) else df

    def with_action(self, action: str) -> list[Check]:
        return [check for check in self.checks if check.action == action]

    def keeps(self) -> Column:
        return conditions.all_of([c.condition.holds for c in self.with_action(REMOVE)])

    def flags(self) -> Column:
        return values.label_list((c.label, c.condition.broken) for c in self.with_action(FLAG))

    def value_of(self, column: str) -> Column:
        """The column's value after set_null, under its own name."""
        breaches = [c.condition.broken for c in self.with_action(SET_NULL) if c.column == column]
        value = values.named(column)
        if breaches:
            value = F.when(~conditions.any_of(breaches), value)
        return value.alias(column)

    @property
    def flags_follow_from_data(self) -> bool:
        """True if rows with equal cleaned values always have equal flags.

        Not so if a flag rule looks at a value that set_null takes away, or at the expected month
        of the row, which is no part of the cleaned data.
        """
        nulled = {c.column for c in self.with_action(SET_NULL)}
        watched = {c.column for c in self.with_action(FLAG) if c.column is not None}
        if self.month is not None and self.month.action == FLAG:
            if isinstance(self.expected, MonthColumn):
                return False
            watched.add(self.catalog.month.column)
        return not nulled & watched

    def with_flags(self, cleaned: DataFrame) -> DataFrame:
        """Add the flag column to rows whose flags follow from their data."""
        return cleaned.withColumn(self.catalog.flag_column, self.flags())

    def apply(self, df: DataFrame, actions: tuple[str, ...] = ROW_ACTIONS) -> DataFrame:
        """Carry out the given actions in one filter and one projection."""
        kept = df.filter(self.keeps()) if REMOVE in actions else df
        columns = [
            self.value_of(name) if SET_NULL in actions else values.named(name)
            for name in self.data_columns
        ]
        if FLAG in actions:
            columns.append(self.flags().alias(self.catalog.flag_column))
        return kept.select(*columns)


def _bind_column(rule: ColumnRule, fields: dict[str, T.StructField]) -> ColumnBinding:
    field = fields.get(rule.column)
    if field is None:
        return ColumnBinding(rule, None)
    if rule.is_numeric:
        reading = values.as_number(field)
    elif rule.allowed:
        reading = values.as_text(field)
    else:
        reading = values.as_is(field)

    below = above = domain = None
    if rule.min is not None:
        below = Check(
            rule.below_min_label,
            rule.below_min_action,
            conditions.below_min(reading, rule.min, rule.min_inclusive),
            rule.column,
        )
    if rule.max is not None:
        above = Check(
            rule.above_max_label,
            rule.above_max_action,
            conditions.above_max(reading, rule.max, rule.max_inclusive),
            rule.column,
        )
    if rule.allowed:
        domain = Check(
            rule.domain_label,
            rule.domain_action,
            conditions.outside_domain(reading, rule.allowed),
            rule.column,
        )
    return ColumnBinding(rule, reading, below, above, domain)


def _span(expected: Month | MonthColumn) -> tuple[Column, Column]:
    if isinstance(expected, Month):
        return F.lit(expected.first_day), F.lit(expected.day_after)
    first = F.concat(values.named(expected.name), F.lit("-01")).try_cast("date")
    return first, F.add_months(first, 1)


def bind(
    df: DataFrame,
    catalog: Catalog,
    period: str | Month | MonthColumn | None = None,
) -> Binding:
    """Bind ``catalog`` to the columns of ``df``. Rules without their columns are left out."""
    expected = resolve_month(period)
    fields = {field.name: field for field in df.schema.fields}
    if isinstance(expected, MonthColumn) and expected.name not in fields:
        raise ValueError(f"No column {expected.name!r} to take the expected month from")

    # Helper columns never reach the result; an old flag column is replaced by the new one.
    hidden = {catalog.flag_column.lower()}
    if isinstance(expected, MonthColumn):
        hidden.add(expected.name.lower())
    data_columns = tuple(name for name in df.columns if name.lower() not in hidden)

    order = month = None
    rule = catalog.time_order
    if rule is not None and {rule.start, rule.end} <= fields.keys():
        order = Check(
            rule.label,
            rule.on_violation,
            conditions.ends_before_start(
                values.as_moment(fields[rule.start]), values.as_moment(fields[rule.end])
            ),
        )
    rule = catalog.month
    if rule is not None and expected is not None and {rule.column, *rule.needs} <= fields.keys():
        month = Check(
            rule.label,
            rule.on_violation,
            conditions.outside_span(values.as_moment(fields[rule.column]), *_span(expected)),
        )
    return Binding(
        catalog=catalog,
        data_columns=data_columns,
        columns=tuple(_bind_column(rule, fields) for rule in catalog.columns),
        time_order=order,
        month=month,
        expected=expected,
    )

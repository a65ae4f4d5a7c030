"""Cleaning: carrying out the action of every broken rule."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowguard.functions.months import Month, MonthColumn
from rowguard.functions.values import named
from rowguard.operators.binding import Binding, bind
from rowguard.operators.duplicates import drop_duplicates
from rowguard.rules import FLAG, REMOVE, SET_NULL, Catalog, require_columns

Period = str | Month | MonthColumn | None


def check_columns(df: DataFrame, catalog: Catalog) -> None:
    """Fail if a column the catalogue requires is absent. Looks at the schema only."""
    require_columns(df.columns, catalog.required)


def removes_duplicates(catalog: Catalog) -> bool:
    return catalog.duplicates is not None and catalog.duplicates.on_violation == REMOVE


def clean(
    df: DataFrame,
    catalog: Catalog,
    period: Period = None,
    drop: Callable[[DataFrame], DataFrame] = drop_duplicates,
) -> DataFrame:
    """Cleaned rows: the input columns plus the flag column.

    Rows breaking a remove rule go, values breaking a set_null rule become null, the labels of
    broken flag rules are listed in the flag column, and of the rows that are then identical
    (flags included) one stays. Lazy with the default way of dropping duplicates; one scan and one
    shuffle.
    """
    check_columns(df, catalog)
    binding = bind(df, catalog, period)
    if not removes_duplicates(catalog):
        return binding.apply(df)
    if binding.flags_follow_from_data:
        # Identical data has identical flags: leave them out of the shuffle, add them behind it.
        return binding.with_flags(drop(binding.apply(df, (REMOVE, SET_NULL))))
    return drop(binding.apply(df))


def surviving_rows(df: DataFrame, catalog: Catalog, period: Period = None) -> DataFrame:
    """The rows duplicates are looked for in: everything :func:`clean` does before. No shuffle."""
    check_columns(df, catalog)
    binding = bind(df, catalog, period)
    if binding.flags_follow_from_data:
        return binding.apply(df, (REMOVE, SET_NULL))
    return binding.apply(df)


def remove_rows(df: DataFrame, catalog: Catalog, period: Period = None) -> DataFrame:
    """Only the remove rules. Pushable conditions reach the file scan."""
    return bind(df, catalog, period).apply(df, (REMOVE,))


def null_values(df: DataFrame, catalog: Catalog, period: Period = None) -> DataFrame:
    """Only the set_null rules: every row stays."""
    return bind(df, catalog, period).apply(df, (SET_NULL,))


def flag_rows(df: DataFrame, catalog: Catalog, period: Period = None) -> DataFrame:
    """Only the flag rules: every row and value stays, the flag column is added."""
    return bind(df, catalog, period).apply(df, (FLAG,))


def rows_with_flag(cleaned: DataFrame, label: str, flag_column: str = "dq_flags") -> DataFrame:
    """Cleaned rows carrying ``label`` among their flags."""
    return cleaned.filter(F.array_contains(F.split(named(flag_column), ";"), label))


def mark_breaches(df: DataFrame, binding: Binding, label: str, as_name: str) -> DataFrame:
    """All rows with a TRUE/FALSE column telling whether the check ``label`` is broken."""
    for check in binding.checks:
        if check.label == label:
            return df.withColumn(as_name, check.condition.broken)
    raise KeyError(label)

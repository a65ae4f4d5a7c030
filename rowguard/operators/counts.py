"""Counting what the rules find, as small tables.

Every count of one table comes out of a single aggregate over it: one scan of the columns the rules
read, partial sums per task, one row shuffled per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowguard.functions.values import NO_FLAGS, named, sql_text
from rowguard.operators.binding import Binding, bind
from rowguard.operators.cleaning import Period, check_columns, clean, removes_duplicates
from rowguard.rules import Catalog

TOTAL = "total"
REMOVED = "removed"
SET_TO_NULL = "set_null"
FLAGGED = "flagged"

INPUT_ROWS = "input_rows"
OUTPUT_ROWS = "output_rows"
ROWS_REMOVED = "rows_removed"
ROWS_FLAGGED = "rows_flagged"

_KIND_ORDER = (REMOVED, SET_TO_NULL, FLAGGED)


def unpivot(
    df: DataFrame,
    rows: Sequence[Mapping[str, str]],
    where: str | None = None,
    otherwise: Sequence[Mapping[str, str]] = (),
) -> DataFrame:
    """Turn each row of ``df`` into one row per mapping of column name to SQL expression.

    The expressions are text so that a table of hundreds of cells is handed to Spark in one piece.
    With ``where``, rows for which it is not true become those of ``otherwise``.
    """

    def structs(mappings: Sequence[Mapping[str, str]]) -> str:
        cells = (
            ", ".join(f"{sql_text(name)}, {value}" for name, value in row.items())
            for row in mappings
        )
        return f"array({', '.join(f'named_struct({cell})' for cell in cells)})"

    made = structs(rows)
    if where is not None:
        made = f"IF({where}, {made}, {structs(otherwise)})"
    return df.select(F.expr(f"inline({made})"))


class _Counter(NamedTuple):
    kind: str
    rule: str
    value: Column


def _rule_counters(binding: Binding) -> list[_Counter]:
    counters = [
        _Counter(check.kind, check.label, F.count_if(check.condition.broken))
        for check in binding.active_checks
    ]
    return sorted(counters, key=lambda counter: _KIND_ORDER.index(counter.kind))


def rule_counts(df: DataFrame, catalog: Catalog, period: Period = None) -> DataFrame:
    """Rows breaking each active rule: ``(kind, rule, rows)``.

    A row counts under every rule it breaks. Rules nothing breaks are listed with 0.
    """
    counters = _rule_counters(bind(df, catalog, period))
    if not counters:
        return df.sparkSession.createDataFrame([], "kind string, rule string, rows bigint")
    totals = df.agg(*[c.value.alias(f"n{i}") for i, c in enumerate(counters)])
    return unpivot(
        totals,
        [
            {"kind": sql_text(c.kind), "rule": sql_text(c.rule), "rows": f"n{i}"}
            for i, c in enumerate(counters)
        ],
    )


def clean_summary(
    df: DataFrame,
    catalog: Catalog,
    period: Period = None,
    cleaned: DataFrame | None = None,
) -> DataFrame:
    """Totals and per-rule counts of a cleaning run: ``(kind, rule, rows)`` in catalogue order.

    ``cleaned`` is the result of :func:`clean` if it exists already, for instance read back from
    where it was written; then only its flag column is read. Otherwise it is computed.

    Totals that are differences (rows removed, duplicates) are sums of a share taken from the input
    and a negative share taken from the output, so the two sides need no join.
    """
    check_columns(df, catalog)
    binding = bind(df, catalog, period)
    if cleaned is None:
        cleaned = clean(df, catalog, period)

    before = [
        _Counter(TOTAL, INPUT_ROWS, F.count(F.lit(1))),
        _Counter(TOTAL, ROWS_REMOVED, F.count(F.lit(1))),
        *_rule_counters(binding),
    ]
    after = [
        _Counter(TOTAL, OUTPUT_ROWS, F.count(F.lit(1))),
        _Counter(TOTAL, ROWS_REMOVED, -F.count(F.lit(1))),
        _Counter(TOTAL, ROWS_FLAGGED, F.count(named(catalog.flag_column))),
    ]
    order = [(TOTAL, name) for name in (INPUT_ROWS, OUTPUT_ROWS, ROWS_REMOVED, ROWS_FLAGGED)]
    order += [(c.kind, c.rule) for c in before if c.kind == REMOVED]
    if removes_duplicates(catalog):
        label = catalog.duplicates.label
        before.append(_Counter(REMOVED, label, F.count_if(binding.keeps())))
        after.append(_Counter(REMOVED, label, -F.count(F.lit(1))))
        order.append((REMOVED, label))
    order += [(c.kind, c.rule) for c in before if c.kind in (SET_TO_NULL, FLAGGED)]

    def shares(table: DataFrame, counters: list[_Counter]) -> DataFrame:
        totals = table.agg(*[c.value.alias(f"n{i}") for i, c in enumerate(counters)])
        return unpivot(
            totals,
            [
                {
                    "position": str(order.index((c.kind, c.rule))),
                    "kind": sql_text(c.kind),
                    "rule": sql_text(c.rule),
                    "rows": f"n{i}",
                }
                for i, c in enumerate(counters)
            ],
        )

    return (
        shares(df, before)
        .unionByName(shares(cleaned, after))
        .groupBy("position", "kind", "rule")
        .agg(F.sum("rows").alias("rows"))
        .orderBy("position")
        .select("kind", "rule", "rows")
    )


def flag_distribution(cleaned: DataFrame, flag_column: str = "dq_flags") -> DataFrame:
    """Rows per distinct flag text, ordered by it; unflagged rows under ``__none__``."""
    flags = F.coalesce(named(flag_column), F.lit(NO_FLAGS)).alias("flags")
    return cleaned.groupBy(flags).agg(F.count(F.lit(1)).alias("rows")).orderBy("flags")


def post_clean_checks(cleaned: DataFrame, catalog: Catalog, period: Period = None) -> DataFrame:
    """What is left in a cleaned table: one row of counts.

    For every numeric column rule with a lower limit ``<column>_below_min`` and ``<column>_null``,
    and the rows still breaking the time order. Columns under a remove or set_null rule must show 0.
    """
    binding = bind(cleaned, catalog, period)
    found: list[Column] = [F.count(F.lit(1)).alias("rows")]
    for column in binding.columns:
        if column.below_min is None:
            continue
        name = column.rule.column
        found.append(F.count_if(column.below_min.condition.broken).alias(f"{name}_below_min"))
        found.append(F.count_if(column.reading.missing).alias(f"{name}_null"))
    if binding.time_order is not None:
        order = binding.time_order
        found.append(F.count_if(order.condition.broken).alias(order.label))
    return cleaned.agg(*found)

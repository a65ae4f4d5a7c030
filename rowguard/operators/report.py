"""The quality report as tables: every count with its action, the policy, the money breakdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowguard.functions import conditions
from rowguard.functions.months import MonthColumn
from rowguard.functions.values import meaning_of, named, sql_text
from rowguard.operators.binding import Binding, bind
from rowguard.operators.cleaning import Period
from rowguard.operators.counts import unpivot
from rowguard.operators.duplicates import distinct_rows, plain_rows, weights, with_zero_row
from rowguard.operators.profile import TOTAL, Measures, negative_amount
from rowguard.rules import Catalog

# The code of a row and its meaning, while the report is made.
_CODE = "__rowguard_code"

_COLUMNS = ("section", "rule", "metric", "value", "action")

# Where each part stands in the report.
_MEASURED, _DUPLICATES, _POLICY, _MONEY = range(4)


def _line(
    part: int,
    order: int,
    section: str,
    rule: str | None,
    metric: str,
    value: str,
    action: str | None = None,
) -> dict[str, str]:
    """One report line. ``value`` is SQL text, the other texts are plain."""
    return {
        "part": str(part),
        "order": f"{order}L",
        "section": sql_text(section),
        "rule": sql_text(rule),
        "metric": sql_text(metric),
        "value": f"CAST({value} AS STRING)",
        "action": sql_text(action),
    }


def _measured_lines(measures: Measures) -> list[dict[str, str]]:
    binding, catalog = measures.binding, measures.binding.catalog
    lines: list[tuple[str, str | None, str, str, str | None]] = [
        ("file", None, "total_records", TOTAL, None)
    ]
    for i, column in enumerate(binding.columns):
        rule = column.rule
        if not column.present:
            lines.append(("column", rule.column, "present", "FALSE", None))
            continue
        actions = {
            "missing": rule.on_null,
            "below_min": rule.below_min_action,
            "above_max": rule.above_max_action,
            "domain_invalid": rule.domain_action,
        }
        for metric, value in measures.of_column(i).items():
            lines.append(("column", rule.column, metric, value, actions.get(metric)))
    cross = []
    if binding.time_order is not None:
        cross.append((catalog.time_order, measures.of_time_order()))
    if binding.month is not None:
        cross.append((catalog.month, measures.of_month()))
    for rule, counts in cross:
        for metric, value in counts.items():
            action = rule.on_violation if metric == "invalid" else None
            lines.append(("cross_field", rule.label, metric, value, action))
    return [_line(_MEASURED, order, *line) for order, line in enumerate(lines)]


def _weighted(df: DataFrame, binding: Binding, copied: bool) -> DataFrame:
    """The distinct rows with their copies, which merge in each task before the one shuffle; rows as
    they are if nobody asks for copies."""
    if not copied:
        return plain_rows(df)
    helper = binding.expected.name if isinstance(binding.expected, MonthColumn) else None
    return distinct_rows(df, helper)


def quality_report(df: DataFrame, catalog: Catalog, period: Period = None) -> DataFrame:
    """The whole report in long form: ``(section, rule, metric, value, action)``.

    Sections, in order: ``file``, ``column``, ``cross_field``, ``policy``, ``negative_money``. One
    scan and one wide shuffle: the table is reduced to its distinct rows with their copies, and an
    aggregation over these by code gives every figure, duplicates included. Without a duplicate rule
    there is no shuffle of rows at all.
    """
    binding = bind(df, catalog, period)
    rows, weight = _weighted(df, binding, catalog.duplicates is not None), weights()
    measures = Measures(df, binding, weight)
    lines = _measured_lines(measures)
    taken, extra = measures.columns(), []
    if catalog.duplicates is not None:
        taken.append(weight.distinct().alias("distinct_rows"))
        extra.append("distinct_rows")
        section = ("cross_field", catalog.duplicates.label)
        action = catalog.duplicates.on_violation
        surplus = f"{TOTAL} - distinct_rows"
        lines.append(_line(_DUPLICATES, 0, *section, "invalid", surplus, action))
        lines.append(_line(_DUPLICATES, 1, *section, "valid", "distinct_rows"))
    lines += [
        _line(_POLICY, i, "policy", line.problem, "rule", sql_text(line.rule))
        for i, line in enumerate(catalog.policy)
    ]

    negative = negative_amount(df, catalog)
    if negative is None:
        report = unpivot(rows.agg(*taken), lines)
    else:
        code = next(f for f in df.schema.fields if f.name == catalog.code_column)
        meaning = meaning_of(code, catalog.code_meanings)
        # Every figure by code, and then over these few rows once more and over all of them.
        coded = F.struct(named(code.name).alias("code"), meaning.alias("meaning"))
        by_code = (
            with_zero_row(rows)
            .groupBy(coded.alias(_CODE))
            .agg(weight.rows(negative).alias("negative"), *taken)
        )
        again = [F.sum(name).alias(name) for name in ("negative", *extra)]
        found = by_code.groupingSets([[], [named(_CODE)]], named(_CODE)).agg(
            F.grouping_id().alias("of_all"), *again, *measures.combined()
        )
        money = {
            "part": str(_MONEY),
            "order": "-negative",
            "section": sql_text("negative_money"),
            "rule": f"CAST({_CODE}.code AS STRING)",
            "metric": f"{_CODE}.meaning",
            "value": "CAST(negative AS STRING)",
            "action": sql_text(None),
        }
        report = unpivot(found, lines, where="of_all = 1", otherwise=[money]).filter(
            f"part <> {_MONEY} OR value <> '0'"
        )
    return report.orderBy("part", "order", "rule").select(*_COLUMNS)


def _policy_masks(binding: Binding) -> dict[str, Column]:
    masks = {check.label: check.condition.broken for check in binding.checks}
    for column in binding.columns:
        if column.present:
            masks[f"{column.rule.column}:missing"] = column.reading.missing
    return masks


def cleaning_policy(df: DataFrame, catalog: Catalog, period: Period = None) -> DataFrame:
    """The written policy with the rows each line concerns: ``(position, problem, rule, rows)``.

    For duplicates these are the surplus copies. ``rows`` is null if the table lacks the column a
    line speaks about. One scan; rows cross a shuffle only if there is a line on duplicates, and
    then as distinct rows with their copies.
    """
    binding = bind(df, catalog, period)
    masks = _policy_masks(binding)
    duplicates = catalog.duplicates.label if catalog.duplicates is not None else None
    copied = duplicates is not None and any(duplicates in line.covers for line in catalog.policy)
    rows, weight = _weighted(df, binding, copied), weights()
    taken = [weight.rows().alias(TOTAL)]
    lines = []
    for i, line in enumerate(catalog.policy):
        found = [masks[label] for label in line.covers if label in masks]
        value = "CAST(NULL AS BIGINT)"
        if copied and duplicates in line.covers:
            taken.append((weight.rows() - weight.distinct()).alias(f"n{i}"))
            value = f"n{i}"
        elif found:
            taken.append(weight.rows(conditions.any_of(found)).alias(f"n{i}"))
            value = f"n{i}"
        lines.append(
            {
                "position": str(i + 1),
                "problem": sql_text(line.problem),
                "rule": sql_text(line.rule),
                "rows": value,
            }
        )
    return unpivot(rows.agg(*taken), lines).orderBy("position")

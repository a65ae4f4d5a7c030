"""Profiling a table against a catalogue without changing it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowguard.functions import conditions, values
from rowguard.functions.months import Month
from rowguard.functions.values import named, sql_text
from rowguard.operators.binding import Binding, ColumnBinding, bind
from rowguard.operators.cleaning import Period
from rowguard.operators.counts import unpivot
from rowguard.operators.duplicates import Weights, duplicate_counts
from rowguard.rules import Catalog, MonthRule, TimeOrderRule

TOTAL = "total"


class Measures:
    """The measures of a profile, all taken by one aggregate, and how to read them back.

    With ``weights`` they are taken of a table that lists distinct rows with their copies.
    """

    def __init__(self, df: DataFrame, binding: Binding, weights: Weights | None = None) -> None:
        self.binding = binding
        count = F.count_if if weights is None else weights.rows
        self._taken: dict[str, Column] = {TOTAL: count(F.lit(True))}
        for i, column in enumerate(binding.columns):
            if not column.present:
                continue
            self._taken[f"missing_{i}"] = count(column.reading.missing)
            for breach in ("below_min", "above_max", "domain"):
                check = getattr(column, breach)
                if check is not None:
                    self._taken[f"{breach}_{i}"] = count(check.condition.broken)
        moments = {f.name: f for f in df.schema.fields}
        if binding.time_order is not None:
            rule = binding.catalog.time_order
            start = values.as_moment(moments[rule.start]).value
            end = values.as_moment(moments[rule.end]).value
            self._taken["inverted"] = count(binding.time_order.condition.broken)
            self._taken["no_start"] = count(start.isNull())
            self._taken["no_end"] = count(end.isNull())
        if binding.month is not None:
            dated = values.as_moment(moments[binding.catalog.month.column]).value
            self._taken["outside"] = count(binding.month.condition.broken)
            self._taken["dated"] = count(dated.isNotNull())
            self._taken["earliest"] = F.min(dated)
            self._taken["latest"] = F.max(dated)

    def columns(self) -> list[Column]:
        return [measure.alias(name) for name, measure in self._taken.items()]

    def combined(self) -> list[Column]:
        """The same measures over all parts of a table of which each row holds one part's."""
        ends = {"earliest": F.min, "latest": F.max}
        return [ends.get(name, F.sum)(named(name)).alias(name) for name in self._taken]

    def take(self, df: DataFrame) -> DataFrame:
        return df.agg(*self.columns())

    def count(self, name: str) -> str:
        """A count as SQL text; 0 if there is no such measure."""
        return name if name in self._taken else "0L"

    def of_column(self, i: int) -> dict[str, str]:
        """Counts of the i-th rule's column: nulls throughout if the table does not have it."""
        missing = self.count(f"missing_{i}")
        below = self.count(f"below_min_{i}")
        above = self.count(f"above_max_{i}")
        domain = self.count(f"domain_{i}")
        counts = {
            "missing": missing,
            "invalid": f"{below} + {above} + {domain}",
            "valid": f"{TOTAL} - {missing} - {below} - {above} - {domain}",
            "below_min": below,
            "above_max": above,
            "domain_invalid": domain,
        }
        if not self.binding.columns[i].present:
            return dict.fromkeys(counts, "CAST(NULL AS BIGINT)")
        return counts

    def of_time_order(self) -> dict[str, str]:
        inverted = self.count("inverted")
        return {
            "invalid": inverted,
            "valid": f"{TOTAL} - {inverted}",
            "missing": f"{self.count('no_start')} + {self.count('no_end')}",
        }

    def of_month(self) -> dict[str, str]:
        expected = self.binding.expected
        return {
            "invalid": self.count("outside"),
            "valid": f"{self.count('dated')} - {self.count('outside')}",
            "expected_month": sql_text(expected.text if isinstance(expected, Month) else None),
            "min_pickup": "earliest",
            "max_pickup": "latest",
        }


def profile_columns(df: DataFrame, catalog: Catalog) -> DataFrame:
    """One row per column rule: how many values are missing, invalid and valid, and the actions.

    ``invalid`` is the sum of the three breach counts and ``valid`` what neither is missing nor
    invalid. Columns the table does not have are listed with ``present`` false.
    """
    binding = bind(df, catalog)
    measures = Measures(df, binding)

    def row(i: int, column: ColumnBinding) -> dict[str, str]:
        rule, present = column.rule, column.present
        stated = ("on_below_min", "on_above_max", "on_violation", "on_null", "description")
        return {
            "column": sql_text(rule.column),
            "present": str(present),
            "total": TOTAL,
            **measures.of_column(i),
            **{name: sql_text(getattr(rule, name) if present else None) for name in stated},
        }

    rows = [row(i, column) for i, column in enumerate(binding.columns)]
    return unpivot(measures.take(df), rows)


def _cross_rule_row(
    rule: TimeOrderRule | MonthRule, counts: dict[str, str]
) -> list[dict[str, str]]:
    return [
        {
            "rule": sql_text(rule.label),
            **counts,
            "on_violation": sql_text(rule.on_violation),
            "description": sql_text(rule.description),
        }
    ]


def profile_time_order(df: DataFrame, catalog: Catalog) -> DataFrame:
    """One row on the time order rule. Fails if it does not apply.

    Rows with a missing time count as valid, and ``missing`` adds up both columns.
    """
    binding = bind(df, catalog)
    if binding.time_order is None:
        raise ValueError("The time order rule does not apply: a column is absent")
    measures = Measures(df, binding)
    return unpivot(
        measures.take(df), _cross_rule_row(catalog.time_order, measures.of_time_order())
    )


def profile_month(df: DataFrame, catalog: Catalog, period: Period) -> DataFrame:
    """One row on the month rule. Fails if it does not apply. Undated rows are not counted valid.

    ``expected_month`` is null if each row carries a month of its own.
    """
    binding = bind(df, catalog, period)
    if binding.month is None:
        raise ValueError("The month rule does not apply: no month given or a column is absent")
    measures = Measures(df, binding)
    return unpivot(measures.take(df), _cross_rule_row(catalog.month, measures.of_month()))


def profile_duplicates(
    df: DataFrame, catalog: Catalog, copies: DataFrame | None = None
) -> DataFrame:
    """One row on surplus copies among the raw rows: ``invalid`` of them, the rest ``valid``.

    ``copies`` is a duplicate count on ``df`` if there is one already.
    """
    rule = catalog.duplicates
    counted = duplicate_counts(df) if copies is None else copies
    return counted.select(
        F.lit(rule.label).alias("rule"),
        named("removed").alias("invalid"),
        named("output_rows").alias("valid"),
        F.lit(rule.on_violation).cast("string").alias("on_violation"),
        F.lit(rule.description).alias("description"),
    )


def negative_money(df: DataFrame, catalog: Catalog) -> DataFrame:
    """Rows with a negative amount by code: ``(<code column>, rows, meaning)``, most rows first.

    The code column keeps its own type. Empty if the table lacks it (its type is then text) or all
    money columns, or has no negative amount.
    """
    code = catalog.code_column or "code"
    kinds = {field.name: field.dataType for field in df.schema.fields}
    negative = negative_amount(df, catalog)
    if negative is None:
        schema = T.StructType().add(code, kinds.get(code, T.StringType()))
        schema = schema.add("rows", T.LongType()).add("meaning", T.StringType())
        return df.sparkSession.createDataFrame([], schema)
    field = next(f for f in df.schema.fields if f.name == code)
    found = df.filter(negative).groupBy(named(code)).agg(F.count(F.lit(1)).alias("rows"))
    found = found.withColumn("meaning", values.meaning_of(field, catalog.code_meanings))
    return found.orderBy(F.desc("rows"), F.asc_nulls_first(named(code)))


def negative_amount(df: DataFrame, catalog: Catalog) -> Column | None:
    """True where a money column is negative; None if the table lacks the code or all of them."""
    fields = {field.name: field for field in df.schema.fields}
    amounts = [fields[name] for name in catalog.money_columns if name in fields]
    if catalog.code_column not in fields or not amounts:
        return None
    return conditions.any_of(
        [conditions.below_min(values.as_number(field), 0).broken for field in amounts]
    )


def with_position(ordered: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """``ordered`` with each row's place in ``order``, from 1, so that it outlives a shuffle.

    For result tables, which hold a row per group: the rank is taken in one task. Rows that are equal
    in all of ``order`` are ranked in no particular order.
    """
    return ordered.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def with_code_meaning(df: DataFrame, catalog: Catalog, as_name: str = "meaning") -> DataFrame:
    """``df`` with the meaning of its code column."""
    field = next(f for f in df.schema.fields if f.name == catalog.code_column)
    return df.withColumn(as_name, values.meaning_of(field, catalog.code_meanings))

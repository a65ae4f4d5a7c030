"""Reading raw values: quoting, numbers, timestamps, code meanings, label lists."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NOT_A_REVERSAL = "not_a_known_reversal"
MISSING = "missing"
NO_FLAGS = "__none__"
LABEL_SEPARATOR = ";"


def sql_name(name: str) -> str:
    """``name`` as it stands in SQL text."""
    return "`" + name.replace("`", "``") + "`"


def sql_text(value: str | None) -> str:
    """A string literal, or the null string, as it stands in SQL text."""
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def named(name: str) -> Column:
    """The top-level column called exactly ``name``, whatever characters the name has."""
    return F.col(sql_name(name))


class Reading(NamedTuple):
    """A column as its rule sees it, and whether it may hold NaN (which counts as missing)."""

    value: Column
    maybe_nan: bool = False

    @property
    def missing(self) -> Column:
        gone = self.value.isNull()
        return gone | F.isnan(self.value) if self.maybe_nan else gone


def as_is(field: T.StructField) -> Reading:
    return Reading(named(field.name), isinstance(field.dataType, (T.DoubleType, T.FloatType)))


def as_number(field: T.StructField) -> Reading:
    """Numeric reading. Text is parsed, and text that is no number counts as missing."""
    if isinstance(field.dataType, (T.StringType, T.CharType, T.VarcharType)):
        return Reading(named(field.name).try_cast("double"), True)
    return as_is(field)


def as_text(field: T.StructField) -> Reading:
    reading = as_is(field)
    if isinstance(field.dataType, T.StringType):
        return reading
    return Reading(reading.value.cast("string"))


class Moment(NamedTuple):
    """A point-in-time column and the Spark type its literals must have."""

    value: Column
    type_name: str


def as_moment(field: T.StructField) -> Moment:
    """Timestamp reading. Timestamps keep their own type; unreadable text becomes null."""
    column = named(field.name)
    if isinstance(field.dataType, T.TimestampNTZType):
        return Moment(column, "timestamp_ntz")
    if isinstance(field.dataType, T.TimestampType):
        return Moment(column, "timestamp")
    if isinstance(field.dataType, T.DateType):
        return Moment(column, "date")
    if isinstance(field.dataType, T.StringType):
        return Moment(F.try_to_timestamp(column), "timestamp")
    return Moment(column.try_cast("timestamp"), "timestamp")


def meaning_of(field: T.StructField, meanings: Mapping[int, str]) -> Column:
    """Text behind an integer code: its meaning, the no-reversal text, or ``missing``."""
    reading = as_is(field)
    code = reading.value.try_cast("bigint")
    text = F.when(reading.missing, F.lit(MISSING))
    for known, meaning in meanings.items():
        text = text.when(code == known, F.lit(meaning))
    return text.otherwise(F.lit(NOT_A_REVERSAL))


def label_list(labelled: Iterable[tuple[str, Column]]) -> Column:
    """Labels whose condition holds, in the order given, as one string; null if none holds."""
    parts = [F.when(condition, F.lit(label)) for label, condition in labelled]
    if not parts:
        return F.lit(None).cast("string")
    return F.nullif(F.concat_ws(LABEL_SEPARATOR, *parts), F.lit(""))

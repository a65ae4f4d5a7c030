"""Exact duplicate rows: dropping them, counting them, and counting anything else by distinct rows.

Two ways give the same rows, as far as SQL tells values apart:

* :func:`drop_duplicates` is one hash aggregation over the full row. Copies are merged before the
  shuffle within each task, so a row repeated millions of times sends one copy per task. Everything
  else crosses the shuffle at full width.
* :func:`drop_rare_duplicates` first shuffles only an 8-byte fingerprint per row. Rows whose
  fingerprint occurs once cannot have a copy and skip the aggregation; only the others go through it,
  so a chance collision of fingerprints changes nothing. Rows meet the repeated fingerprints where
  they are read, in a table of ``FILTER_BITS`` bits that every task gets: no row is shuffled to find
  out, whatever the number of repeated fingerprints. A bit may stand for several of them; that sends
  some rows without a copy through the aggregation as well, all rows if nearly all bits are set.
"""

from __future__ import annotations

import time
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowguard.functions.values import named

_FINGERPRINT = "__rowguard_fingerprint"
_COPIES = "__rowguard_copies"
_FIRST = "__rowguard_first"
_LINE = "__rowguard_line"
_WORDS = "__rowguard_words"

#: Bits of the table of repeated fingerprints (16 MB), and its 64-bit words in a line: powers of two.
FILTER_BITS, LINE_WORDS = 1 << 27, 32


def drop_duplicates(df: DataFrame) -> DataFrame:
    """One copy of each row. Nulls are equal to each other, as are NaNs and the two zeros."""
    return df.dropDuplicates()


def row_copies(df: DataFrame, copies: str = _COPIES) -> DataFrame:
    """Each distinct row with the number of times it occurs."""
    return df.groupBy(*[named(c) for c in df.columns]).agg(F.count(F.lit(1)).alias(copies))


def duplicate_counts(df: DataFrame) -> DataFrame:
    """One row: ``input_rows``, ``output_rows`` (distinct) and ``removed`` (surplus copies)."""
    copies = named(_COPIES)
    return row_copies(df).agg(
        F.coalesce(F.sum(copies), F.lit(0)).alias("input_rows"),
        F.count(F.lit(1)).alias("output_rows"),
        F.coalesce(F.sum(copies - 1), F.lit(0)).alias("removed"),
    )


def timed_duplicate_counts(df: DataFrame) -> dict[str, int | float]:
    """:func:`duplicate_counts` carried out now, with the time it took in ``elapsed_seconds``."""
    started = time.perf_counter()
    counts = duplicate_counts(df).first().asDict()
    counts["elapsed_seconds"] = round(time.perf_counter() - started, 3)
    return counts


def distinct_rows(df: DataFrame, helper: str | None = None) -> DataFrame:
    """Each distinct row with the number of its copies and, as the second added column, whether it
    stands for a distinct row by itself (1).

    ``helper`` is a column that is no part of the data. Rows that differ in it alone are listed one
    by one, and only one of them has the 1.
    """
    if helper is None:
        return row_copies(df).withColumn(_FIRST, F.lit(1))
    data = [named(c) for c in df.columns if c != helper]
    listed = (
        row_copies(df)
        .groupBy(*data)
        .agg(F.collect_list(F.struct(named(helper), named(_COPIES))).alias(_COPIES))
        .select(*data, F.posexplode(_COPIES).alias(_FIRST, _COPIES))
    )
    own = [named(_COPIES).getField(name).alias(name) for name in (helper, _COPIES)]
    return listed.select(*data, *own, (named(_FIRST) == 0).cast("int").alias(_FIRST))


def plain_rows(df: DataFrame) -> DataFrame:
    """The rows as they are, in the form of :func:`distinct_rows`: each is one copy."""
    return df.withColumns({_COPIES: F.lit(1).cast("bigint"), _FIRST: F.lit(1)})


def with_zero_row(rows: DataFrame) -> DataFrame:
    """``rows`` and one of nulls that counts nothing, so that grouping an empty table, too, gives the
    group of all rows."""
    counted = {_COPIES: F.lit(0).cast("bigint"), _FIRST: F.lit(0)}
    zero = rows.sparkSession.range(1, numPartitions=1).select(
        *[
            counted.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name)
            for f in rows.schema.fields
        ]
    )
    return rows.unionByName(zero)


class Weights(NamedTuple):
    """Counting by a table that lists each row with its copies."""

    copies: Column
    first: Column

    def rows(self, condition: Column | None = None) -> Column:
        """How many rows there are, or fulfil the condition."""
        share = self.copies if condition is None else F.when(condition, self.copies)
        return F.coalesce(F.sum(share), F.lit(0).cast("bigint"))

    def distinct(self) -> Column:
        return F.coalesce(F.sum(self.first), F.lit(0).cast("bigint"))


def weights() -> Weights:
    """Weights of :func:`distinct_rows`."""
    return Weights(named(_COPIES), named(_FIRST))


def _hashed_alike(kind: T.DataType) -> bool:
    """True if values that SQL calls equal have equal hashes; not so under most collations."""
    if isinstance(kind, T.StringType):
        return kind.isUTF8BinaryCollation()
    if isinstance(kind, T.ArrayType):
        return _hashed_alike(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashed_alike(field.dataType) for field in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def row_fingerprint(df: DataFrame) -> Column:
    """64-bit hash of the row. Equal rows have equal hashes; the reverse need not hold.

    Text under a collation of its own is left out: equal texts may differ in their bytes.
    """
    hashed = [named(f.name) for f in df.schema.fields if _hashed_alike(f.dataType)]
    return F.xxhash64(*hashed) if hashed else F.lit(0).cast("bigint")


def repeated_fingerprints(df: DataFrame) -> DataFrame:
    """Fingerprints that occur more than once, as the only column. One narrow shuffle."""
    return (
        df.select(row_fingerprint(df).alias(_FINGERPRINT))
        .groupBy(_FINGERPRINT)
        .agg(F.count(F.lit(1)).alias(_COPIES))
        .filter(named(_COPIES) > 1)
        .select(_FINGERPRINT)
    )


def _place(fingerprint: Column) -> tuple[Column, Column, Column]:
    """Where the bit of a fingerprint is: the line, the word in it, the word with this bit alone."""
    # Shifts and masks are null for no fingerprint, as divisions might be: a test for null would move
    # down to the scan, with the fingerprint's expression in it.
    bit = fingerprint.bitwiseAND(F.lit(FILTER_BITS - 1))
    word = F.shiftright(bit, 6)
    line = F.shiftright(word, LINE_WORDS.bit_length() - 1)
    alone = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.bitwiseAND(F.lit(63)).cast("int"))
    return line, word.bitwiseAND(F.lit(LINE_WORDS - 1)).cast("int"), alone


def repeated_bits(keys: DataFrame) -> DataFrame:
    """The table of bits in which those of ``keys`` are set, by lines; lines without any are absent."""
    line, word, alone = _place(named(_FINGERPRINT))
    words = [F.bit_or(F.when(word == i, alone).otherwise(F.lit(0).cast("bigint"))) for i in range(LINE_WORDS)]
    # Lines hardly merge within a task: a number per key is less to shuffle than a line.
    gathered = keys.withColumn(_LINE, line).repartition(named(_LINE))
    return gathered.groupBy(named(_LINE)).agg(F.array(*words).alias(_WORDS))


class SplitRows(NamedTuple):
    """Rows without a copy for certain, and rows that may have one. Both have the input columns."""

    single: DataFrame
    suspect: DataFrame


def split_rare_duplicates(df: DataFrame) -> SplitRows:
    """Split by whether the bit of the row's fingerprint is that of a repeated one."""
    bits = F.broadcast(repeated_bits(repeated_fingerprints(df)))
    marked = df.withColumn(_FINGERPRINT, row_fingerprint(df))
    line, word, alone = _place(named(_FINGERPRINT))
    repeated = (named(_LINE) == line) & (F.get(named(_WORDS), word).bitwiseAND(alone) != 0)
    return SplitRows(
        single=marked.join(bits, repeated, "left_anti").drop(_FINGERPRINT),
        suspect=marked.join(bits, repeated, "left_semi").drop(_FINGERPRINT),
    )


def drop_rare_duplicates(df: DataFrame) -> DataFrame:
    """Same rows as :func:`drop_duplicates`; only rows that may have a copy are compared whole."""
    split = split_rare_duplicates(df)
    return split.single.unionByName(drop_duplicates(split.suspect))


def rare_duplicate_counts(df: DataFrame) -> DataFrame:
    """Same row as :func:`duplicate_counts`; only rows that may have a copy cross the shuffle."""
    split = split_rare_duplicates(df)
    # Counting all rows needs no column of them; the suspects then only say what is surplus.
    everything = df.agg(F.count(F.lit(1)).alias("n")).select(
        named("n").alias("input_rows"),
        named("n").alias("output_rows"),
        F.lit(0).cast("bigint").alias("removed"),
    )
    surplus = duplicate_counts(split.suspect).select(
        F.lit(0).cast("bigint").alias("input_rows"),
        (-named("removed")).alias("output_rows"),
        named("removed"),
    )
    return everything.unionByName(surplus).agg(
        *[F.sum(c).alias(c) for c in ("input_rows", "output_rows", "removed")]
    )

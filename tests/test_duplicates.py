from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from rowguard.operators import duplicates
from rowguard.operators.duplicates import (
    drop_duplicates,
    drop_rare_duplicates,
    duplicate_counts,
    rare_duplicate_counts,
    split_rare_duplicates,
    timed_duplicate_counts,
)
from rowguard.session import private_session


def mixed(spark):
    """Copies of several kinds between rows that occur once."""
    rows = [
        (1, "a", 0.0),
        (1, "a", -0.0),
        (1, "a", None),
        (1, "a", None),
        (1, None, math.nan),
        (1, None, math.nan),
        (None, None, None),
        (None, None, None),
        (None, None, None),
        (2, "a", 1.0),
        (2, "b", 1.0),
    ]
    return spark.createDataFrame(rows, "k int, t string, v double")


def plain(df):
    return sorted(map(repr, df.collect()))


def test_both_ways_keep_the_same_rows(spark):
    df = mixed(spark)
    assert len(plain(drop_duplicates(df))) == 6
    assert plain(drop_rare_duplicates(df)) == plain(drop_duplicates(df))


def test_counts(spark):
    df = mixed(spark)
    want = {"input_rows": 11, "output_rows": 6, "removed": 5}
    assert duplicate_counts(df).first().asDict() == want
    assert rare_duplicate_counts(df).first().asDict() == want
    timed = timed_duplicate_counts(df)
    assert timed.pop("elapsed_seconds") >= 0
    assert timed == want


def test_counts_of_an_empty_table(spark):
    empty = mixed(spark).limit(0)
    want = {"input_rows": 0, "output_rows": 0, "removed": 0}
    assert duplicate_counts(empty).first().asDict() == want
    assert rare_duplicate_counts(empty).first().asDict() == want


def test_equal_under_a_collation(spark):
    """Texts that a collation calls equal differ in their bytes; both ways see one row."""
    rows = [("a", 1), ("A", 1), ("b", 1), ("b", 2), ("B ", 2)]
    df = spark.createDataFrame(rows, "t string, k int").selectExpr(
        "collate(t, 'UTF8_LCASE') AS t", "struct(collate(t, 'UTF8_LCASE') AS u) AS s", "k"
    )
    want = {"input_rows": 5, "output_rows": 4, "removed": 1}
    assert duplicate_counts(df).first().asDict() == want
    assert rare_duplicate_counts(df).first().asDict() == want
    assert drop_rare_duplicates(df).count() == drop_duplicates(df).count() == 4
    only_text = df.select("t")
    assert drop_rare_duplicates(only_text).count() == drop_duplicates(only_text).count() == 3


def test_colliding_fingerprints_do_no_harm(spark, monkeypatch):
    monkeypatch.setattr(duplicates, "row_fingerprint", lambda df: F.lit(7).cast("bigint"))
    df = mixed(spark)
    assert plain(drop_rare_duplicates(df)) == plain(drop_duplicates(df))
    assert rare_duplicate_counts(df).first()["removed"] == 5


def test_a_third_of_the_rows_are_one_row(spark):
    many = spark.range(0, 30_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.lit("cold")).alias("t"),
    )
    want = {"input_rows": 30_000, "output_rows": 20_001, "removed": 9_999}
    assert duplicate_counts(many).first().asDict() == want
    assert rare_duplicate_counts(many).first().asDict() == want
    assert drop_rare_duplicates(many).count() == 20_001


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_copies_merge_before_the_shuffle(spark):
    plan = plan_of(drop_duplicates(mixed(spark)))
    assert plan.count("Exchange") == 1
    below = plan[plan.index("Exchange") :]
    assert "HashAggregate" in below


def test_single_rows_are_not_shuffled_by_their_values(spark):
    split = split_rare_duplicates(mixed(spark))
    plan = plan_of(split.single)
    assert "LeftAnti" in plan
    assert plan.count("Exchange hashpartitioning(__rowguard_fingerprint") >= 1
    assert "hashpartitioning(k" not in plan


@pytest.mark.parametrize("name", ["copies", "count", "__rowguard"])
def test_column_names_do_not_clash(spark, name):
    df = spark.createDataFrame([(1,), (1,)], [name])
    assert duplicate_counts(df).first()["removed"] == 1


def test_distinct_rows_with_a_helper_column(spark):
    """Rows that differ in the helper alone are one distinct row, listed once for each value of it."""
    rows = [(1, "a", "x"), (1, "a", "x"), (1, "a", "y"), (1, "a", None), (2, "a", "x")]
    df = spark.createDataFrame(rows, "k int, t string, month string")
    listed = duplicates.distinct_rows(df, "month")
    weights = duplicates.weights()
    totals = listed.agg(
        weights.rows().alias("rows"),
        weights.distinct().alias("distinct"),
        weights.rows(F.col("month") == "x").alias("x"),
    )
    assert totals.first().asDict() == {"rows": 5, "distinct": 2, "x": 3}
    assert listed.count() == 4


def test_rows_meet_repeated_fingerprints_where_they_are_read(spark):
    """No wide row is shuffled, or sorted, to find out whether it may have a copy, however many
    repeated fingerprints there are; only suspects are, for the comparison itself."""
    session = private_session(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"})
    df = session.range(0, 4000, 1, 4).selectExpr("id % 3900 AS k", "uuid() IS NULL AS u", "repeat('x', 50) AS t")
    split = split_rare_duplicates(df)
    for rows in split:
        plan = plan_of(rows)
        assert "SortMergeJoin" not in plan and "Sort " not in plan
        assert plan.count("Exchange hashpartitioning(__rowguard_fingerprint") == 1
        rows_side = plan[plan.index("BroadcastHashJoin") : plan.index("BroadcastExchange")]
        assert "Exchange" not in rows_side
    assert split.suspect.count() == 200 and split.single.count() == 3800
    assert drop_rare_duplicates(df).count() == 3900


@pytest.mark.parametrize("bits", [64, 1 << 12])
def test_fingerprints_that_share_bits_do_no_harm(spark, monkeypatch, bits):
    monkeypatch.setattr(duplicates, "FILTER_BITS", bits)
    df = spark.range(0, 3000, 1, 4).selectExpr("id % 2700 AS k", "if(id % 2 = 0, 'a', 'b') AS t")
    split = split_rare_duplicates(df)
    assert split.single.count() + split.suspect.count() == 3000
    assert split.suspect.count() >= 600
    assert plain(drop_rare_duplicates(df)) == plain(drop_duplicates(df))
    want = {"input_rows": 3000, "output_rows": 2700, "removed": 300}
    assert rare_duplicate_counts(df).first().asDict() == want
    mixed_rows = mixed(spark)
    assert plain(drop_rare_duplicates(mixed_rows)) == plain(drop_duplicates(mixed_rows))

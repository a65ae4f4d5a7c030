from __future__ import annotations

import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from rowguard.catalogs import YELLOW_TAXI
from rowguard.functions.months import MonthColumn
from rowguard.operators.binding import bind
from rowguard.operators.cleaning import (
    check_columns,
    clean,
    flag_rows,
    mark_breaches,
    null_values,
    remove_rows,
    rows_with_flag,
    surviving_rows,
)
from rowguard.operators.counts import (
    clean_summary,
    flag_distribution,
    post_clean_checks,
    rule_counts,
)
from rowguard.operators.duplicates import drop_duplicates
from rowguard.rules import FLAG, REMOVE, SET_NULL, Catalog, ColumnRule
from tests.samples import GOOD, MONTH, ROWS, as_counts, good_but, trips_of


def cleaned_rows(spark, rows, period=MONTH, catalog=YELLOW_TAXI):
    return clean(trips_of(spark, rows), catalog, period).collect()


def flags_of(spark, row, period=MONTH):
    (found,) = cleaned_rows(spark, [row], period)
    return found["dq_flags"]


def test_sample_rows(spark):
    by_distance = {row["trip_distance"]: row for row in cleaned_rows(spark, ROWS)}
    assert by_distance.keys() == {3.25, 120.5, 7.75}
    assert by_distance[3.25]["dq_flags"] is None
    assert by_distance[3.25]["passenger_count"] == 2
    assert by_distance[120.5]["passenger_count"] is None
    assert by_distance[120.5]["dq_flags"] == (
        "trip_distance:above_max;fare_amount:above_max;total_amount:above_max;"
        "pickup_outside_file_month"
    )
    assert by_distance[7.75]["fare_amount"] == -21.5
    assert by_distance[7.75]["dq_flags"] == "fare_amount:below_min;total_amount:below_min"


def test_sample_counts(spark):
    assert as_counts(clean_summary(trips_of(spark), YELLOW_TAXI, MONTH)) == {
        ("total", "input_rows"): 5,
        ("total", "output_rows"): 3,
        ("total", "rows_removed"): 2,
        ("total", "rows_flagged"): 2,
        ("removed", "trip_distance:below_min"): 2,
        ("removed", "dropoff_before_pickup"): 1,
        ("removed", "exact_duplicate_rows"): 0,
        ("set_null", "passenger_count:below_min"): 1,
        ("set_null", "passenger_count:above_max"): 1,
        ("flagged", "trip_distance:above_max"): 1,
        ("flagged", "fare_amount:below_min"): 1,
        ("flagged", "fare_amount:above_max"): 1,
        ("flagged", "total_amount:below_min"): 1,
        ("flagged", "total_amount:above_max"): 1,
        ("flagged", "RatecodeID:domain"): 0,
        ("flagged", "pickup_outside_file_month"): 1,
    }


def test_output_columns_keep_order_and_type(spark):
    df = trips_of(spark)
    result = clean(df, YELLOW_TAXI, MONTH)
    assert result.dtypes == [*df.dtypes, ("dq_flags", "string")]


def test_required_columns(spark):
    df = spark.createDataFrame([(1.0,)], "trip_distance double")
    with pytest.raises(ValueError, match="Missing required columns") as error:
        clean(df, YELLOW_TAXI, MONTH)
    for name in YELLOW_TAXI.required:
        assert (repr(name) in str(error.value)) == (name != "trip_distance")
    check_columns(trips_of(spark), YELLOW_TAXI)


@pytest.mark.parametrize(
    ("change", "kept", "flags"),
    [
        ({"trip_distance": 0.0}, False, None),
        ({"trip_distance": 0.001}, True, None),
        ({"trip_distance": 100.0}, True, None),
        ({"trip_distance": 100.5}, True, "trip_distance:above_max"),
        ({"trip_distance": None}, True, None),
        ({"trip_distance": math.nan}, True, None),
        ({"trip_distance": math.inf}, True, "trip_distance:above_max"),
        ({"trip_distance": -math.inf}, False, None),
        ({"fare_amount": 0.0}, True, None),
        ({"fare_amount": -0.01}, True, "fare_amount:below_min"),
        ({"fare_amount": 500.0}, True, None),
        ({"fare_amount": 500.01}, True, "fare_amount:above_max"),
        ({"total_amount": math.nan}, True, None),
        ({"RatecodeID": 7}, True, "RatecodeID:domain"),
        ({"RatecodeID": 99}, True, None),
        ({"RatecodeID": None}, True, None),
        ({"tpep_pickup_datetime": "2025-01-01 00:00:00"}, True, None),
        (
            {"tpep_pickup_datetime": "2024-12-31 23:59:59.999999"},
            True,
            "pickup_outside_file_month",
        ),
        (
            {
                "tpep_pickup_datetime": "2025-02-01 00:00:00",
                "tpep_dropoff_datetime": "2025-02-01 00:00:00",
            },
            True,
            "pickup_outside_file_month",
        ),
        ({"tpep_pickup_datetime": "2025-01-07 08:42:00"}, True, None),
        ({"tpep_pickup_datetime": "2025-01-07 08:42:01"}, False, None),
        ({"tpep_pickup_datetime": None}, True, None),
        ({"tpep_pickup_datetime": "no time at all"}, True, None),
        ({"tpep_dropoff_datetime": "31/31/2025"}, True, None),
    ],
)
def test_limits(spark, change, kept, flags):
    found = cleaned_rows(spark, [good_but(**change)])
    assert len(found) == kept
    if kept:
        assert found[0]["dq_flags"] == flags


@pytest.mark.parametrize(
    ("passengers", "after"), [(0, None), (-3, None), (1, 1), (9, 9), (10, None), (None, None)]
)
def test_passengers(spark, passengers, after):
    (found,) = cleaned_rows(spark, [good_but(passenger_count=passengers)])
    assert found["passenger_count"] == after
    assert found["dq_flags"] is None


def test_unreadable_time_text_stays_as_it_is(spark):
    (found,) = cleaned_rows(spark, [good_but(tpep_pickup_datetime="no time at all")])
    assert found["tpep_pickup_datetime"] == "no time at all"


def test_all_null_row_passes(spark):
    (found,) = cleaned_rows(spark, [(None,) * 8])
    assert all(value is None for value in found)


def test_empty_table(spark):
    df = trips_of(spark, [])
    assert clean(df, YELLOW_TAXI, MONTH).count() == 0
    counted = as_counts(clean_summary(df, YELLOW_TAXI, MONTH))
    assert set(counted.values()) == {0} and len(counted) == 16
    assert set(as_counts(rule_counts(df, YELLOW_TAXI, MONTH)).values()) == {0}


def test_without_month_the_month_rule_is_off(spark):
    assert flags_of(spark, good_but(tpep_pickup_datetime="2024-05-01 00:00:00"), None) is None
    labels = {rule for _, rule in as_counts(rule_counts(trips_of(spark), YELLOW_TAXI))}
    assert "pickup_outside_file_month" not in labels


def test_cross_rules_need_both_times(spark):
    catalog = replace(YELLOW_TAXI, required=())
    df = trips_of(spark).drop("tpep_dropoff_datetime")
    binding = bind(df, catalog, MONTH)
    assert binding.time_order is None
    assert binding.month is None


def test_rules_of_absent_columns_are_skipped(spark):
    labels = {check.label for check in bind(trips_of(spark), YELLOW_TAXI, MONTH).checks}
    assert "store_and_fwd_flag:domain" not in labels


def test_column_names_are_case_sensitive(spark):
    df = trips_of(spark).withColumnRenamed("trip_distance", "Trip_Distance")
    with pytest.raises(ValueError, match="trip_distance"):
        clean(df, YELLOW_TAXI, MONTH)


def test_existing_flags_are_replaced(spark):
    once = clean(trips_of(spark), YELLOW_TAXI, MONTH).withColumn("dq_flags", F.lit("old"))
    again = clean(once, YELLOW_TAXI, MONTH)
    assert again.columns.count("dq_flags") == 1
    assert again.filter(F.col("dq_flags") == "old").count() == 0


def test_cleaning_twice_changes_nothing(spark):
    once = clean(trips_of(spark), YELLOW_TAXI, MONTH)
    twice = clean(once, YELLOW_TAXI, MONTH)
    assert sorted(map(repr, once.collect())) == sorted(map(repr, twice.collect()))


def test_exact_duplicates(spark):
    df = trips_of(spark, [GOOD, GOOD])
    assert drop_duplicates(df).count() == 1
    counted = as_counts(clean_summary(df, YELLOW_TAXI, MONTH))
    assert counted[("removed", "exact_duplicate_rows")] == 1
    assert counted[("total", "output_rows")] == 1


def test_rows_equal_after_set_null_are_duplicates(spark):
    rows = [good_but(passenger_count=0), good_but(passenger_count=12)]
    assert len(cleaned_rows(spark, rows)) == 1
    counted = as_counts(clean_summary(trips_of(spark, rows), YELLOW_TAXI, MONTH))
    assert counted[("removed", "exact_duplicate_rows")] == 1


def test_removed_copies_are_not_counted_as_duplicates(spark):
    rows = [good_but(trip_distance=-1.0)] * 3
    counted = as_counts(clean_summary(trips_of(spark, rows), YELLOW_TAXI, MONTH))
    assert counted[("removed", "trip_distance:below_min")] == 3
    assert counted[("removed", "exact_duplicate_rows")] == 0
    assert counted[("total", "rows_removed")] == 3


def test_nulls_nans_and_zeros_are_equal_in_duplicates(spark):
    rows = [good_but(fare_amount=value) for value in (math.nan, math.nan, None, None, 0.0, -0.0)]
    assert len(cleaned_rows(spark, rows)) == 3


def test_flags_of_a_column_that_is_nulled_too(spark):
    catalog = replace(
        YELLOW_TAXI,
        required=(),
        columns=(
            ColumnRule("v", min=0, max=10, on_below_min=SET_NULL, on_above_max=FLAG),
            ColumnRule("u", max=1, on_violation=SET_NULL),
        ),
    )
    df = spark.createDataFrame([(-1.0, 5.0), (-2.0, 7.0), (11.0, 0.0)], "v double, u double")
    assert not bind(df, catalog).flags_follow_from_data
    assert {tuple(row) for row in clean(df, catalog).collect()} == {
        (None, None, None),
        (11.0, 0.0, "v:above_max"),
    }


def test_one_column_both_nulled_and_flagged(spark):
    catalog = Catalog(
        columns=(ColumnRule("v", max=10, allowed=(1, 2, 20), on_above_max=SET_NULL, on_violation=FLAG),),
        duplicates=YELLOW_TAXI.duplicates,
    )
    df = spark.createDataFrame([(20,), (30,), (40,), (2,), (5,)], "v int")
    assert sorted(map(str, (tuple(r) for r in clean(df, catalog).collect()))) == sorted(
        map(str, [(None, None), (None, "v:domain"), (2, None), (5, "v:domain")])
    )


def test_flags_are_left_out_of_the_shuffle(spark):
    df = trips_of(spark)
    assert bind(df, YELLOW_TAXI, MONTH).flags_follow_from_data
    assert "dq_flags" not in surviving_rows(df, YELLOW_TAXI, MONTH).columns


def test_single_actions(spark):
    df = trips_of(spark)
    assert remove_rows(df, YELLOW_TAXI, MONTH).count() == 3
    nulled = null_values(df, YELLOW_TAXI, MONTH)
    assert nulled.columns == df.columns
    assert nulled.count() == 5
    assert nulled.filter("passenger_count IS NULL").count() == 3
    flagged = flag_rows(df, YELLOW_TAXI, MONTH)
    assert flagged.count() == 5
    assert rows_with_flag(flagged, "pickup_outside_file_month").count() == 1


def test_verdicts_are_never_null(spark):
    df = trips_of(spark, [*ROWS, (None,) * 8, good_but(trip_distance=math.nan)])
    binding = bind(df, YELLOW_TAXI, MONTH)
    for check in binding.checks:
        both = df.select(check.condition.broken.alias("b"), check.condition.holds.alias("h"))
        assert all(row["b"] is (not row["h"]) for row in both.collect()), check.label
    marked = mark_breaches(df, binding, "fare_amount:below_min", "violates")
    assert marked.filter("violates").count() == 1
    with pytest.raises(KeyError):
        mark_breaches(df, binding, "no such rule", "violates")


def test_text_columns_are_read_as_numbers(spark):
    catalog = Catalog(
        columns=(
            ColumnRule("n", min=0, max=10, on_violation=REMOVE),
            ColumnRule("code", allowed=(1, 2), on_violation=FLAG),
        )
    )
    rows = [("5", "1"), ("-1", "1"), ("11", "2"), ("many", "2"), (None, "x"), ("3", "9")]
    df = spark.createDataFrame(rows, "n string, code string")
    kept = {tuple(row) for row in clean(df, catalog).collect()}
    assert kept == {
        ("5", "1", None),
        ("many", "2", None),
        (None, "x", None),
        ("3", "9", "code:domain"),
    }


def test_other_number_types(spark):
    catalog = Catalog(columns=(ColumnRule("n", min=1, max=9, on_violation=SET_NULL),))
    for kind in ("decimal(10,2)", "float", "int", "smallint", "bigint"):
        df = spark.range(0, 12).select(F.col("id").cast(kind).alias("n"))
        result = clean(df, catalog)
        assert result.dtypes[0] == df.dtypes[0]
        assert result.filter("n IS NULL").count() == 3


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_time_types(spark, kind):
    df = trips_of(spark).withColumns(
        {
            name: F.col(name).cast(kind)
            for name in ("tpep_pickup_datetime", "tpep_dropoff_datetime")
        }
    )
    counted = as_counts(rule_counts(df, YELLOW_TAXI, MONTH))
    assert counted[("flagged", "pickup_outside_file_month")] == 1
    assert counted[("removed", "dropoff_before_pickup")] == (0 if kind == "date" else 1)


def test_rules_without_limits_check_nothing(spark):
    catalog = Catalog(columns=(ColumnRule("v", on_violation=REMOVE), ColumnRule("w", allowed=())))
    df = spark.createDataFrame([(-1, None), (None, 7)], "v int, w int")
    assert bind(df, catalog).checks == []
    assert clean(df, catalog).count() == 2
    assert rule_counts(df, catalog).count() == 0


def test_limits_that_exclude_themselves(spark):
    limits = {"min": 1, "max": 3, "min_inclusive": False, "max_inclusive": False}
    catalog = Catalog(columns=(ColumnRule("v", on_violation=FLAG, **limits),))
    df = spark.createDataFrame([(1,), (2,), (3,)], "v int")
    found = {row["v"]: row["dq_flags"] for row in flag_rows(df, catalog).collect()}
    assert found == {1: "v:below_min", 2: None, 3: "v:above_max"}


def test_odd_column_names(spark):
    catalog = Catalog(columns=(ColumnRule("a.b `c`", min=0, on_violation=SET_NULL),))
    df = spark.createDataFrame([(1, "x"), (-1, "y")], ["a.b `c`", "d.e"])
    result = clean(df, catalog)
    assert result.columns == ["a.b `c`", "d.e", "dq_flags"]
    assert {row[0] for row in result.collect()} == {1, None}


def test_month_per_row(spark):
    df = trips_of(spark)
    # The same trip filed under two months, one of them twice, and under no month.
    months = F.array(*[F.lit(m) for m in ("2025-01", "2024-12", None, "2024-12")])
    filed = trips_of(spark, [GOOD]).withColumn("m", F.explode(months))
    assert df.columns == clean(filed, YELLOW_TAXI, MonthColumn("m")).columns[:-1]
    found = [row["dq_flags"] for row in clean(filed, YELLOW_TAXI, MonthColumn("m")).collect()]
    assert sorted(found, key=str) == [None, "pickup_outside_file_month"]
    with pytest.raises(ValueError, match="No column"):
        clean(df, YELLOW_TAXI, MonthColumn("m"))


def test_catalog_without_duplicates_rule_keeps_copies(spark):
    catalog = replace(YELLOW_TAXI, duplicates=None)
    df = trips_of(spark, [GOOD, GOOD])
    assert clean(df, catalog, MONTH).count() == 2
    counted = as_counts(clean_summary(df, catalog, MONTH))
    assert ("removed", "exact_duplicate_rows") not in counted
    assert counted[("total", "rows_removed")] == 0


def test_flag_distribution(spark):
    cleaned = clean(trips_of(spark), YELLOW_TAXI, MONTH)
    found = [tuple(row) for row in flag_distribution(cleaned).collect()]
    assert found == [
        ("__none__", 1),
        ("fare_amount:below_min;total_amount:below_min", 1),
        (
            "trip_distance:above_max;fare_amount:above_max;total_amount:above_max;"
            "pickup_outside_file_month",
            1,
        ),
    ]


def test_post_clean_checks(spark):
    cleaned = clean(trips_of(spark), YELLOW_TAXI, MONTH)
    found = post_clean_checks(cleaned, YELLOW_TAXI, MONTH).first().asDict()
    assert found["rows"] == 3
    assert found["fare_amount_below_min"] == 1
    assert found["passenger_count_null"] == 1
    assert found["passenger_count_below_min"] == 0
    assert found["trip_distance_below_min"] == 0
    assert found["dropoff_before_pickup"] == 0

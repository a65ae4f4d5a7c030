from __future__ import annotations

import datetime as dt
import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from rowguard.catalogs import YELLOW_TAXI
from rowguard.functions.months import MonthColumn
from rowguard.operators.profile import (
    negative_money,
    profile_columns,
    profile_duplicates,
    profile_month,
    profile_time_order,
    with_code_meaning,
    with_position,
)
from rowguard.operators.report import cleaning_policy, quality_report
from rowguard.rules import Catalog, ColumnRule
from tests.samples import GOOD, MONTH, ROWS, good_but, trips_of


def by_column(df):
    return {row["column"]: row for row in df.collect()}


def test_sample_columns(spark):
    df = trips_of(spark).withColumn(
        "Airport_fee", F.when(F.col("trip_distance") != 3.25, F.lit(1.75))
    )
    found = by_column(profile_columns(df, YELLOW_TAXI))
    assert list(found) == [rule.column for rule in YELLOW_TAXI.columns]
    numbers = {
        name: (r["missing"], r["below_min"], r["above_max"], r["domain_invalid"], r["valid"])
        for name, r in found.items()
        if r["present"]
    }
    assert numbers == {
        "trip_distance": (0, 2, 1, 0, 2),
        "passenger_count": (1, 1, 1, 0, 2),
        "fare_amount": (0, 1, 1, 0, 3),
        "total_amount": (0, 1, 1, 0, 3),
        "RatecodeID": (1, 0, 0, 0, 4),
        "Airport_fee": (1, 0, 0, 0, 4),
    }
    for row in found.values():
        assert row["total"] == 5
        if row["present"]:
            assert row["total"] == row["missing"] + row["invalid"] + row["valid"]


def test_absent_column_is_listed(spark):
    row = by_column(profile_columns(trips_of(spark), YELLOW_TAXI))["congestion_surcharge"]
    assert row.asDict() == dict.fromkeys(row.asDict()) | {
        "column": "congestion_surcharge",
        "present": False,
        "total": 5,
    }


def test_actions_and_texts(spark):
    row = by_column(profile_columns(trips_of(spark), YELLOW_TAXI))["trip_distance"]
    assert (row["on_below_min"], row["on_above_max"], row["on_violation"], row["on_null"]) == (
        "remove",
        "flag",
        None,
        "keep_null",
    )
    assert row["description"] == "Elapsed trip distance in miles from the taximeter."


def test_nan_is_missing(spark):
    df = trips_of(spark, [good_but(trip_distance=v) for v in (math.nan, None, 1.0)])
    row = by_column(profile_columns(df, YELLOW_TAXI))["trip_distance"]
    assert (row["missing"], row["invalid"], row["valid"]) == (2, 0, 1)


def test_breach_without_action_is_profiled(spark):
    catalog = Catalog(columns=(ColumnRule("v", min=0, max=9),))
    df = spark.createDataFrame([(-1,), (5,), (10,)], "v int")
    row = by_column(profile_columns(df, catalog))["v"]
    assert (row["below_min"], row["above_max"], row["valid"]) == (1, 1, 1)


def test_time_order(spark):
    row = profile_time_order(trips_of(spark), YELLOW_TAXI).first()
    assert (row["rule"], row["invalid"], row["valid"], row["missing"]) == (
        "dropoff_before_pickup",
        1,
        4,
        0,
    )


def test_time_order_counts_missing_rows_as_valid_and_each_missing_time(spark):
    rows = [
        good_but(tpep_pickup_datetime=None, tpep_dropoff_datetime=None),
        good_but(tpep_dropoff_datetime="?"),
    ]
    row = profile_time_order(trips_of(spark, rows), YELLOW_TAXI).first()
    assert (row["invalid"], row["valid"], row["missing"]) == (0, 2, 3)


def test_month(spark):
    row = profile_month(trips_of(spark), YELLOW_TAXI, MONTH).first()
    assert (row["invalid"], row["valid"], row["expected_month"]) == (1, 4, "2025-01")
    assert row["min_pickup"] == dt.datetime(2024, 12, 30, 5, 45)
    assert row["max_pickup"] == dt.datetime(2025, 1, 28, 17, 30)


def test_month_does_not_count_undated_rows_as_valid(spark):
    df = trips_of(spark, [GOOD, good_but(tpep_pickup_datetime=None)])
    row = profile_month(df, YELLOW_TAXI, MONTH).first()
    assert (row["invalid"], row["valid"]) == (0, 1)


def test_month_per_row(spark):
    df = trips_of(spark).withColumn("m", F.lit("2024-12"))
    row = profile_month(df, YELLOW_TAXI, MonthColumn("m")).first()
    assert (row["invalid"], row["valid"], row["expected_month"]) == (4, 1, None)


def test_rules_that_do_not_apply(spark):
    with pytest.raises(ValueError, match="does not apply"):
        profile_month(trips_of(spark), YELLOW_TAXI, None)
    with pytest.raises(ValueError, match="does not apply"):
        profile_time_order(trips_of(spark).drop("tpep_pickup_datetime"), YELLOW_TAXI)


def test_duplicates_are_counted_on_raw_rows(spark):
    rows = [*ROWS, GOOD, GOOD, ROWS[2]]
    row = profile_duplicates(trips_of(spark, rows), YELLOW_TAXI).first()
    assert (row["rule"], row["invalid"], row["valid"]) == ("exact_duplicate_rows", 3, 5)


def test_negative_money(spark):
    found = negative_money(trips_of(spark), YELLOW_TAXI).collect()
    assert [tuple(row) for row in found] == [(4, 1, "dispute")]


def test_negative_money_order_and_meanings(spark):
    codes = [3, 3, 3, 6, 6, 4, 0, None]
    rows = [good_but(fare_amount=-1.0, payment_type=code) for code in codes]
    rows += [good_but(total_amount=-1.0, payment_type=3), good_but(payment_type=5)]
    found = [tuple(row) for row in negative_money(trips_of(spark, rows), YELLOW_TAXI).collect()]
    assert found == [
        (3, 4, "no_charge"),
        (6, 2, "voided_trip"),
        (None, 1, "missing"),
        (0, 1, "not_a_known_reversal"),
        (4, 1, "dispute"),
    ]


@pytest.mark.parametrize(
    "dropped", [("payment_type",), ("fare_amount", "total_amount"), ("fare_amount",)]
)
def test_negative_money_without_columns(spark, dropped):
    found = negative_money(trips_of(spark).drop(*dropped), YELLOW_TAXI)
    assert found.columns == ["payment_type", "rows", "meaning"]
    assert found.count() == (1 if dropped == ("fare_amount",) else 0)


def test_negative_money_without_hits(spark):
    assert negative_money(trips_of(spark, [GOOD]), YELLOW_TAXI).count() == 0


@pytest.mark.parametrize("kind", ["double", "string", "int", "decimal(5,0)"])
def test_meaning_of_codes_of_any_type(spark, kind):
    rows = [good_but(payment_type=code) for code in (3, 4, 6, 9, None)]
    df = trips_of(spark, rows).withColumn("payment_type", F.col("payment_type").cast(kind))
    found = [r["meaning"] for r in with_code_meaning(df, YELLOW_TAXI).collect()]
    assert found == ["no_charge", "dispute", "voided_trip", "not_a_known_reversal", "missing"]


def test_report(spark):
    found = quality_report(trips_of(spark), YELLOW_TAXI, MONTH).collect()
    sections = [row["section"] for row in found]
    order = ["file", "column", "cross_field", "policy", "negative_money"]
    assert sorted(sections, key=order.index) == sections
    values = {(r["section"], r["rule"], r["metric"]): (r["value"], r["action"]) for r in found}
    assert values[("file", None, "total_records")] == ("5", None)
    assert values[("column", "trip_distance", "below_min")] == ("2", "remove")
    assert values[("column", "trip_distance", "above_max")] == ("1", "flag")
    assert values[("column", "RatecodeID", "domain_invalid")] == ("0", "flag")
    assert values[("column", "RatecodeID", "missing")] == ("1", "keep_null")
    assert values[("column", "congestion_surcharge", "present")] == ("false", None)
    assert values[("cross_field", "dropoff_before_pickup", "invalid")] == ("1", "remove")
    outside = "pickup_outside_file_month"
    assert values[("cross_field", outside, "expected_month")] == ("2025-01", None)
    assert values[("cross_field", outside, "min_pickup")] == ("2024-12-30 05:45:00", None)
    assert values[("cross_field", "exact_duplicate_rows", "valid")] == ("5", None)
    assert values[("policy", "dropoff < pickup", "rule")] == ("Remove", None)
    assert values[("negative_money", "4", "dispute")] == ("1", None)
    assert sections.count("policy") == 15


def test_report_leaves_out_what_does_not_apply(spark):
    catalog = replace(YELLOW_TAXI, duplicates=None, policy=())
    df = trips_of(spark).drop("tpep_dropoff_datetime", "payment_type")
    sections = {row["section"] for row in quality_report(df, catalog, MONTH).collect()}
    assert sections == {"file", "column"}


def test_helper_month_column_does_not_hide_duplicates(spark):
    months = F.array(F.lit("2025-01"), F.lit("2025-02"))
    df = trips_of(spark, [GOOD]).withColumn("m", F.explode(months))
    found = quality_report(df, YELLOW_TAXI, MonthColumn("m")).filter(
        "rule = 'exact_duplicate_rows' AND metric = 'invalid'"
    )
    assert found.first()["value"] == "1"


def test_policy_counts(spark):
    found = cleaning_policy(trips_of(spark, [*ROWS, GOOD]), YELLOW_TAXI, MONTH).collect()
    assert [row["position"] for row in found] == list(range(1, 16))
    rows = {row["problem"]: row["rows"] for row in found}
    assert rows["trip_distance <= 0"] == 2
    assert rows["fare/total > 500"] == 1
    assert rows["Missing passenger_count"] == 1
    assert rows["Missing congestion_surcharge"] is None
    assert rows["Duplicate rows"] == 1
    assert rows["Pickup outside file month"] == 1


def _scans(df):
    """Of the plan that runs: after it has, the first form follows the final one."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.partition("Initial Plan")[0].count("FileScan")


@pytest.fixture(scope="module")
def filed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("filed") / "yellow_tripdata_2025-01.parquet")
    trips_of(spark, [*ROWS, *ROWS, GOOD]).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def test_report_and_policy_take_one_scan(spark, filed):
    for made in (quality_report, cleaning_policy):
        for period in (MONTH, None):
            df = made(filed, YELLOW_TAXI, period)
            assert _scans(df) == 1
            df.collect()
            assert _scans(df) == 1


def test_report_counts_copies(spark, filed):
    lines = {(r["section"], r["rule"], r["metric"]): r["value"] for r in quality_report(filed, YELLOW_TAXI, MONTH).collect()}
    assert lines["file", None, "total_records"] == "11"
    assert lines["column", "trip_distance", "below_min"] == "4"
    assert lines["column", "passenger_count", "missing"] == "2"
    assert lines["cross_field", "exact_duplicate_rows", "invalid"] == "6"
    assert lines["cross_field", "exact_duplicate_rows", "valid"] == "5"
    assert lines["negative_money", "4", "dispute"] == "2"
    policy = {r["problem"]: r["rows"] for r in cleaning_policy(filed, YELLOW_TAXI, MONTH).collect()}
    assert policy["Duplicate rows"] == 6 and policy["trip_distance <= 0"] == 4
    assert policy["Missing congestion_surcharge"] is None


def test_report_by_month_of_each_row(spark, filed):
    """The helper column guides the month rule and is no part of what makes rows equal."""
    months = filed.withColumn("m", F.expr("CASE WHEN rand(1) < 0.5 THEN '2025-01' ELSE '2024-12' END"))
    rows = months.collect()
    df = spark.createDataFrame(rows, months.schema)
    lines = {(r["rule"], r["metric"]): r["value"] for r in quality_report(df, YELLOW_TAXI, MonthColumn("m")).collect()}
    outside = sum(r["tpep_pickup_datetime"][:7] != r["m"] for r in rows)
    assert lines["pickup_outside_file_month", "invalid"] == str(outside)
    assert lines["exact_duplicate_rows", "valid"] == "5"
    assert lines[None, "total_records"] == "11"
    without = quality_report(df.limit(0), YELLOW_TAXI, MonthColumn("m")).collect()
    assert {r["value"] for r in without if r["metric"] in ("invalid", "total_records")} == {"0"}


def test_positions_say_the_order(spark):
    rows = [good_but(fare_amount=-1.0, payment_type=code) for code in (6, 3, 3, None, 9, 9)]
    found = negative_money(trips_of(spark, rows), YELLOW_TAXI)
    ranked = with_position(found, F.desc("rows"), F.asc_nulls_first("payment_type")).repartition(3)
    assert sorted((r["position"], r["payment_type"], r["rows"]) for r in ranked.collect()) == [
        (1, 3, 2), (2, 9, 2), (3, None, 1), (4, 6, 1)
    ]


def test_code_column_keeps_its_type_without_money_columns(spark):
    bare = trips_of(spark).drop("fare_amount", "total_amount")
    assert negative_money(bare, YELLOW_TAXI).dtypes == negative_money(trips_of(spark), YELLOW_TAXI).dtypes
    assert negative_money(bare.drop("payment_type"), YELLOW_TAXI).dtypes[0] == ("payment_type", "string")

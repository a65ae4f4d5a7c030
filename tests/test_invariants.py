"""What must hold on any data, checked on the trips derived from the given tables."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from rowguard.catalogs import YELLOW_TAXI
from rowguard.operators.cleaning import clean, rows_with_flag
from rowguard.operators.counts import clean_summary, flag_distribution, rule_counts
from rowguard.operators.duplicates import drop_rare_duplicates
from rowguard.operators.profile import profile_columns
from rowguard.plans.clean_job import write_cleaned
from tests.samples import as_counts
from trip_queries.trips import PERIOD, trips

SCALES = [d for d in ("/root/testdata/sf0.001", "/root/testdata/sf0.01") if os.path.isdir(d)]

# Known counts of the trips at scale 0.01.
KNOWN = {
    ("total", "input_rows"): 60_561,
    ("total", "output_rows"): 57_201,
    ("total", "rows_removed"): 60_561 - 57_201,
    ("total", "rows_flagged"): 17_461,
    ("removed", "trip_distance:below_min"): 1_842,
    ("removed", "dropoff_before_pickup"): 1_012,
    ("removed", "exact_duplicate_rows"): 57_741 - 57_201,
    ("set_null", "passenger_count:below_min"): 1_345,
    ("set_null", "passenger_count:above_max"): 1_184,
    ("flagged", "trip_distance:above_max"): 3_482,
    ("flagged", "fare_amount:below_min"): 2_499,
    ("flagged", "fare_amount:above_max"): 2_712,
    ("flagged", "total_amount:below_min"): 1_272,
    ("flagged", "total_amount:above_max"): 5_725,
    ("flagged", "RatecodeID:domain"): 7_858,
    ("flagged", "store_and_fwd_flag:domain"): 679,
    ("flagged", "pickup_outside_file_month"): 542,
}


@pytest.fixture(scope="module", params=SCALES)
def data(request, spark, tmp_path_factory):
    """Raw trips as a Parquet file, so that the tests do not derive them each time."""
    path = str(tmp_path_factory.mktemp("trips") / "trips.parquet")
    trips(spark, request.param).write.parquet(path)
    return request.param, spark.read.parquet(path)


def test_known_counts(data):
    scale, df = data
    if scale.endswith("sf0.01"):
        assert as_counts(clean_summary(df, YELLOW_TAXI, PERIOD)) == KNOWN


def test_nothing_removable_is_left(data):
    _, df = data
    cleaned = clean(df, YELLOW_TAXI, PERIOD).cache()
    left = as_counts(rule_counts(cleaned, YELLOW_TAXI, PERIOD))
    assert all(rows == 0 for (kind, _), rows in left.items() if kind in ("removed", "set_null"))
    assert {check for check, _ in left} == {"removed", "set_null", "flagged"}
    assert cleaned.exceptAll(clean(cleaned, YELLOW_TAXI, PERIOD)).count() == 0
    # A flag's label is on exactly the cleaned rows that break its rule.
    for (kind, label), rows in left.items():
        if kind == "flagged":
            assert rows_with_flag(cleaned, label).count() == rows
    total = flag_distribution(cleaned).agg(F.sum("rows")).first()[0]
    assert total == cleaned.count()
    cleaned.unpersist()


def test_profile_adds_up(data):
    _, df = data
    profile = profile_columns(df, YELLOW_TAXI)
    assert profile.filter("present AND total <> missing + invalid + valid").count() == 0
    assert profile.filter("present AND invalid <> below_min + above_max + domain_invalid").count() == 0


def test_profile_and_cleaning_count_alike(data):
    _, df = data
    counted = as_counts(rule_counts(df, YELLOW_TAXI, PERIOD))
    by_label = {rule: rows for (_, rule), rows in counted.items()}
    for row in profile_columns(df, YELLOW_TAXI).filter("present").collect():
        rule = YELLOW_TAXI.column_rule(row["column"])
        for label, rows in (
            (rule.below_min_label, row["below_min"]),
            (rule.above_max_label, row["above_max"]),
            (rule.domain_label, row["domain_invalid"]),
        ):
            assert by_label.get(label, 0) == rows


def test_all_ways_of_counting_agree(data, tmp_path):
    _, df = data
    ways = [
        {"dedup": "aggregate"},
        {"dedup": "fingerprint"},
    ]
    outcomes = []
    for i, options in enumerate(ways):
        outcome = write_cleaned(
            df, str(tmp_path / str(i)), YELLOW_TAXI, PERIOD, output_format="parquet", **options
        ).as_dict()
        outcomes.append(
            {k: v for k, v in outcome.items() if k not in ("output_path", "elapsed_seconds", "dedup")}
        )
    assert outcomes[0] == outcomes[1]
    assert outcomes[0]["input_rows"] == outcomes[0]["output_rows"] + outcomes[0]["rows_removed"]


def test_fingerprints_keep_the_same_rows(data):
    _, df = data
    plain = clean(df, YELLOW_TAXI, PERIOD)
    rare = clean(df, YELLOW_TAXI, PERIOD, drop=drop_rare_duplicates)
    assert plain.exceptAll(rare).count() == 0
    assert rare.exceptAll(plain).count() == 0


def test_row_order_does_not_matter(data):
    _, df = data
    shuffled = clean(df.orderBy(F.hash(*df.columns)), YELLOW_TAXI, PERIOD)
    assert shuffled.exceptAll(clean(df, YELLOW_TAXI, PERIOD)).count() == 0

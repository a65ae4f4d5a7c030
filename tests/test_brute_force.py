"""Random trips, cleaned by Spark and row by row in plain Python."""

from __future__ import annotations

import datetime as dt
import math
import random
from collections import Counter

import pytest

from rowguard.catalogs import YELLOW_TAXI
from rowguard.operators.cleaning import clean
from rowguard.operators.counts import clean_summary
from rowguard.operators.duplicates import drop_rare_duplicates
from tests.samples import MONTH, as_counts

SCHEMA = """trip_distance double, passenger_count int, fare_amount double, total_amount double,
RatecodeID int, store_and_fwd_flag string, tpep_pickup_datetime timestamp_ntz,
tpep_dropoff_datetime timestamp_ntz, payment_type int"""

TIMES = [
    None,
    dt.datetime(2024, 12, 31, 23, 59, 59),
    dt.datetime(2025, 1, 1),
    dt.datetime(2025, 1, 31, 23, 59, 59),
    dt.datetime(2025, 2, 1),
    dt.datetime(2026, 1, 15),
]
AMOUNTS = [None, math.nan, -5.0, 0.0, 10.0, 500.0, 500.5]


def random_rows(seed: int, n: int) -> list[tuple]:
    pick = random.Random(seed).choice
    return [
        (
            pick([None, math.nan, -1.0, 0.0, 1.0, 100.0, 101.0]),
            pick([None, 0, 1, 9, 10]),
            pick(AMOUNTS),
            pick([1.0, 2.0, -1.0]),
            pick([None, 1, 99, 7]),
            pick([None, "Y", "Z"]),
            pick(TIMES),
            pick(TIMES),
            1,
        )
        for _ in range(n)
    ]


def key(row):
    """NaN equal to itself."""
    return tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in row)


def by_hand(rows):
    counts, kept = Counter(), []
    for row in rows:
        distance, people, fare, total, rate, stored, pickup, dropoff, paid = row
        known = {
            "distance": distance if distance is not None and distance == distance else None,
            "fare": fare if fare is not None and fare == fare else None,
        }
        labels = []

        def breach(broken, kind, label, labels=labels):
            if broken:
                counts[(kind, label)] += 1
                if kind == "flagged":
                    labels.append(label)
            return broken

        d, f = known["distance"], known["fare"]
        gone = breach(d is not None and d <= 0, "removed", "trip_distance:below_min")
        breach(d is not None and d > 100, "flagged", "trip_distance:above_max")
        if breach(people is not None and people < 1, "set_null", "passenger_count:below_min"):
            people = None
        elif breach(people is not None and people > 9, "set_null", "passenger_count:above_max"):
            people = None
        breach(f is not None and f < 0, "flagged", "fare_amount:below_min")
        breach(f is not None and f > 500, "flagged", "fare_amount:above_max")
        breach(total < 0, "flagged", "total_amount:below_min")
        breach(rate is not None and rate not in {1, 2, 3, 4, 5, 6, 99}, "flagged", "RatecodeID:domain")
        breach(stored is not None and stored not in {"Y", "N"}, "flagged", "store_and_fwd_flag:domain")
        inverted = pickup is not None and dropoff is not None and dropoff < pickup
        gone |= breach(inverted, "removed", "dropoff_before_pickup")
        outside = pickup is not None and (pickup.year, pickup.month) != (2025, 1)
        breach(outside, "flagged", "pickup_outside_file_month")
        if not gone:
            flags = ";".join(labels) or None
            kept.append((distance, people, fare, total, rate, stored, pickup, dropoff, paid, flags))
    distinct = {key(row) for row in kept}
    counts[("removed", "exact_duplicate_rows")] = len(kept) - len(distinct)
    counts[("total", "input_rows")] = len(rows)
    counts[("total", "output_rows")] = len(distinct)
    counts[("total", "rows_removed")] = len(rows) - len(distinct)
    counts[("total", "rows_flagged")] = sum(row[-1] is not None for row in distinct)
    return distinct, counts


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cleaning_equals_plain_python(spark, seed):
    rows = random_rows(seed, 3000)
    # A third of all rows are copies of one.
    rows += [rows[0]] * 1500
    df = spark.createDataFrame(rows, SCHEMA)
    want, counts = by_hand(rows)
    found = clean(df, YELLOW_TAXI, MONTH).collect()
    assert len(found) == len(want)
    assert {key(row) for row in found} == want
    rare = clean(df, YELLOW_TAXI, MONTH, drop=drop_rare_duplicates).collect()
    assert sorted(map(repr, map(key, rare))) == sorted(map(repr, map(key, found)))
    summary = as_counts(clean_summary(df, YELLOW_TAXI, MONTH))
    assert {rule: rows for rule, rows in summary.items() if rows} == {
        rule: rows for rule, rows in counts.items() if rows
    }

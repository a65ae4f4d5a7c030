"""Hand-written trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = """trip_distance double, passenger_count bigint, fare_amount double, total_amount double,
RatecodeID bigint, tpep_pickup_datetime string, tpep_dropoff_datetime string, payment_type bigint"""

FILE = "data/yellow_tripdata_2025-01.parquet"
MONTH = "2025-01"

# Good; no distance and passengers unknown; driven backwards in space and time, nobody in the car;
# too much of everything, a month early; money given back.
ROWS = [
    (3.25, 2, 14.5, 17.75, 2, "2025-01-07 08:15:00", "2025-01-07 08:42:00", 2),
    (0.0, None, 6.25, 7.0, 5, "2025-01-19 21:05:00", "2025-01-19 21:09:00", 1),
    (-4.75, 0, 9.5, 11.25, None, "2025-01-28 17:30:00", "2025-01-28 17:12:00", 2),
    (120.5, 11, 640.0, 655.5, 3, "2024-12-30 05:45:00", "2024-12-30 09:20:00", 1),
    (7.75, 4, -21.5, -26.25, 1, "2025-01-11 12:00:00", "2025-01-11 12:31:00", 4),
]

GOOD = ROWS[0]


def trips_of(spark: SparkSession, rows=ROWS) -> DataFrame:
    return spark.createDataFrame(list(rows), SCHEMA)


def good_but(**changes) -> tuple:
    """The first sample row with some values changed."""
    names = [part.split()[0] for part in SCHEMA.replace("\n", " ").split(",")]
    return tuple(changes.get(name, value) for name, value in zip(names, GOOD, strict=True))


def as_counts(df: DataFrame) -> dict[tuple[str, str], int]:
    return {(row["kind"], row["rule"]): row["rows"] for row in df.collect()}

"""Trips derived from the whole ``lineitem`` table.

The given tables hold no taxi trips, so each line item becomes one trip whose values break the
rules by simple arithmetic on its keys; the trips of every hundredth order appear twice, which
plants exact duplicates. ``congestion_surcharge`` is left out on purpose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PERIOD = "2025-01"

_NOT_RECORDED = "(l_orderkey + l_suppkey) % 6 = 0"

_COLUMNS = (
    "l_orderkey",
    "l_linenumber",
    """CASE WHEN l_partkey % 50 = 0 THEN -l_quantity
            WHEN l_partkey % 97 = 0 THEN 0.0D
            ELSE l_quantity * 2.1D END AS trip_distance""",
    f"""CASE WHEN {_NOT_RECORDED} THEN NULL
            WHEN (l_orderkey + l_suppkey) % 37 = 0 THEN 0
            WHEN (l_orderkey + l_suppkey) % 41 = 0 THEN 12
            ELSE l_linenumber END AS passenger_count""",
    """CASE WHEN (l_orderkey + l_suppkey) % 25 = 0 THEN -l_extendedprice / 200.0D
            ELSE l_extendedprice / 200.0D END AS fare_amount""",
    """CASE WHEN (l_orderkey + l_suppkey) % 50 = 0 THEN -l_extendedprice / 190.0D
            ELSE l_extendedprice / 190.0D END AS total_amount""",
    f"""CASE WHEN {_NOT_RECORDED} THEN NULL
            WHEN l_partkey % 71 = 0 THEN 42
            ELSE l_linenumber END AS RatecodeID""",
    f"""CASE WHEN {_NOT_RECORDED} THEN NULL
            WHEN l_partkey % 83 = 0 THEN 'X'
            WHEN l_returnflag = 'R' THEN 'Y'
            ELSE 'N' END AS store_and_fwd_flag""",
    f"CASE WHEN {_NOT_RECORDED} THEN NULL ELSE 1.75D END AS Airport_fee",
    """CASE WHEN l_partkey % 59 = 0 THEN NULL
            ELSE CAST(l_partkey % 7 AS INT) END AS payment_type""",
    """CASE WHEN l_partkey % 113 = 0 THEN TIMESTAMP_NTZ'2024-12-31 23:00:00'
            ELSE TIMESTAMP_NTZ'2025-01-01 00:00:00'
                 + make_dt_interval(CAST(l_orderkey % 30 AS INT)) END AS tpep_pickup_datetime""",
    """tpep_pickup_datetime + CASE WHEN l_partkey % 61 = 0 THEN INTERVAL '-10' MINUTE
            ELSE INTERVAL '20' MINUTE END AS tpep_dropoff_datetime""",
)

_COPIES = "explode(CASE WHEN l_orderkey % 100 = 0 THEN array(1, 2) ELSE array(1) END) AS copy"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips of all line items; one scan of ``lineitem``, no shuffle."""
    once = table(spark, sf_dir, "lineitem").selectExpr(*_COLUMNS)
    return once.selectExpr("*", _COPIES).drop("copy")


#: Says which values the tables below change.
_KEY = "(7 * l_orderkey + l_linenumber)"


def trips_with_text_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times as text; some are words, empty, or days that do not exist."""
    unreadable = f"""CASE WHEN {_KEY} % 13 = 0 THEN 'not a time' WHEN {_KEY} % 17 = 0 THEN ''
                          WHEN {_KEY} % 19 = 0 THEN '2025-02-30 10:00:00' END"""
    written = "date_format({}, 'yyyy-MM-dd HH:mm:ss')"
    pickup, dropoff = "tpep_pickup_datetime", "tpep_dropoff_datetime"
    return trips(spark, sf_dir).withColumns(
        {
            pickup: F.expr(f"coalesce({unreadable}, {written.format(pickup)})"),
            dropoff: F.expr(f"CASE WHEN (l_orderkey + 3 * l_linenumber) % 7 = 0 THEN 'n/a' ELSE {written.format(dropoff)} END"),
        }
    )


def trips_with_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some amounts and distances are NaN, some null."""
    nan = f"CASE WHEN {_KEY} % 31 = 0 THEN double('NaN') WHEN {_KEY} % 37 <> 0 THEN {{0}} END"
    columns = ("trip_distance", "fare_amount", "Airport_fee")
    return trips(spark, sf_dir).withColumns({c: F.expr(nan.format(c)) for c in columns})


def trips_with_surcharge(spark: SparkSession, sf_dir: str) -> DataFrame:
    surcharge = f"CASE WHEN {_KEY} % 11 <> 0 THEN 2.5D END"
    return trips(spark, sf_dir).withColumn("congestion_surcharge", F.expr(surcharge))

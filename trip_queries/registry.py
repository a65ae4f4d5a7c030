"""The queries by name. Each takes the session and the folder with the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowguard.catalogs import YELLOW_TAXI
from rowguard.functions.months import MonthColumn
from rowguard.operators import cleaning, counts, duplicates, profile, report
from rowguard.operators.binding import bind
from rowguard.plans.clean_job import read_for_cleaning, write_cleaned
from rowguard.rules import FLAG, REMOVE, SET_NULL, Catalog, ColumnRule, MonthRule
from rowguard.sources.scratch import scratch_path
from rowguard.sources.tables import (
    LINES,
    file_month,
    file_month_counts,
    read_table,
    with_file_month,
    write_table,
)
from trip_queries.trips import (
    PERIOD,
    table,
    trips,
    trips_with_nan,
    trips_with_surcharge,
    trips_with_text_times,
)

Query = Callable[[SparkSession, str], DataFrame]

KEYS = ("l_orderkey", "l_linenumber")


def _marked(
    label: str, *shown: str, catalog: Catalog = YELLOW_TAXI, source: Query = trips
) -> Query:
    """All trips with the verdict of one check on each."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = source(spark, sf_dir)
        marked = cleaning.mark_breaches(df, bind(df, catalog, PERIOD), label, "violates")
        return marked.select(*KEYS, *shown, "violates")

    return query


# No shipped rule has an exclusive upper limit, so this one is made for the query; 105.0 occurs.
_EXCLUSIVE_MAX = Catalog(
    columns=(ColumnRule("trip_distance", max=105, max_inclusive=False, on_above_max=FLAG),)
)

_CUSTOMERS = Catalog(columns=(ColumnRule("c_acctbal", min=0, on_below_min=REMOVE),))
_EVENTS = Catalog(
    columns=(ColumnRule("event_type", allowed=("click", "view"), on_violation=REMOVE),)
)
_ORDERS = Catalog(month=MonthRule("ordered_outside_month", column="o_orderdate"))


# A breach without an action of its own takes the general one.
_FALLBACK = Catalog(
    columns=(
        ColumnRule("c_acctbal", min=0, max=5000, on_below_min=SET_NULL, on_violation=FLAG),
        ColumnRule("c_mktsegment", allowed=("BUILDING", "MACHINERY"), on_violation=FLAG),
    )
)
_ONE_LIMIT = Catalog(
    columns=(
        ColumnRule("p_size", min=10, on_below_min=REMOVE, on_violation=FLAG),
        ColumnRule("p_retailprice", max=1500, on_violation=FLAG),
    )
)
_ABSENT = Catalog(
    columns=(
        ColumnRule("s_acctbal", min=0, on_below_min=FLAG),
        ColumnRule("s_rating", min=1, max=5, on_violation=REMOVE, on_null="keep_null"),
    ),
    month=MonthRule("outside_month", column="s_since"),
)


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/lineitem.parquet")


def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips written as CSV and read with inferred types."""
    path = scratch_path(spark, "scan") + ".csv"
    write_table(trips(spark, sf_dir), path)
    # Inferred times are instants of the session's zone; the trips have times without a zone.
    local = {
        name: F.col(name).cast("timestamp_ntz")
        for name in ("tpep_pickup_datetime", "tpep_dropoff_datetime")
    }
    return read_table(spark, path).withColumns(local)


def roundtrip_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "roundtrip") + ".parquet"
    write_table(cleaning.clean(trips(spark, sf_dir), YELLOW_TAXI, PERIOD), path)
    return read_table(spark, path)


def roundtrip_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "roundtrip") + ".csv"
    cleaned = cleaning.clean(trips(spark, sf_dir), YELLOW_TAXI, PERIOD)
    write_table(cleaned, path)
    return read_table(spark, path, schema=cleaned.schema)


def scan_csv_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as CSV with quotes, commas and line ends in the texts, as other programs write
    it. Such files are read one per task."""
    documents = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "scan") + ".csv"
    write_table(documents, path)
    return read_table(spark, path, schema=documents.schema, multi_line=True)


def roundtrip_csv_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as CSV of one line a record; files can be read in parts."""
    documents = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "roundtrip") + ".csv"
    write_table(documents, path, dialect=LINES)
    return read_table(spark, path, schema=documents.schema, dialect=LINES)


def clean_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job over a raw file named by its month; the written table is read back."""
    raw = scratch_path(spark, "raw") + f"/yellow_tripdata_{PERIOD}.parquet"
    write_table(trips(spark, sf_dir), raw)
    target = scratch_path(spark, "cleaned")
    df, period = read_for_cleaning(spark, raw, "from-name")
    write_cleaned(df, target, YELLOW_TAXI, period, output_format="parquet")
    return read_table(spark, target, format="parquet")


def trips_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips(spark, sf_dir)


def act_remove(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.remove_rows(trips(spark, sf_dir), YELLOW_TAXI, PERIOD)


def act_set_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.null_values(trips(spark, sf_dir), YELLOW_TAXI, PERIOD)


def act_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.flag_rows(trips(spark, sf_dir), YELLOW_TAXI, PERIOD)


def clean_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(trips(spark, sf_dir), YELLOW_TAXI, PERIOD)


def clean_trips_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same rows as ``clean_trips`` with only possible duplicates crossing the shuffle."""
    return cleaning.clean(
        trips(spark, sf_dir), YELLOW_TAXI, PERIOD, drop=duplicates.drop_rare_duplicates
    )


def flag_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.rows_with_flag(clean_trips(spark, sf_dir), "pickup_outside_file_month")


def dedup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.drop_duplicates(trips(spark, sf_dir))


def dedup_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicates among the rows that survive the remove rules, after values were nulled."""
    survivors = cleaning.surviving_rows(trips(spark, sf_dir), YELLOW_TAXI, PERIOD)
    return duplicates.duplicate_counts(survivors)


def dedup_stats_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    survivors = cleaning.surviving_rows(trips(spark, sf_dir), YELLOW_TAXI, PERIOD)
    return duplicates.rare_duplicate_counts(survivors)


def rule_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.rule_counts(trips(spark, sf_dir), YELLOW_TAXI, PERIOD)


def clean_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.clean_summary(trips(spark, sf_dir), YELLOW_TAXI, PERIOD)


def flag_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.flag_distribution(clean_trips(spark, sf_dir))


def post_clean_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.post_clean_checks(clean_trips(spark, sf_dir), YELLOW_TAXI, PERIOD)


def profile_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_columns(trips(spark, sf_dir), YELLOW_TAXI)


def profile_time_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_time_order(trips(spark, sf_dir), YELLOW_TAXI)


def profile_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_month(trips(spark, sf_dir), YELLOW_TAXI, PERIOD)


def profile_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_duplicates(trips(spark, sf_dir), YELLOW_TAXI)


def negative_money_by_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.negative_money(trips(spark, sf_dir), YELLOW_TAXI)


def negative_money_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order of the breakdown as data: most rows first, then by code, null first."""
    found = profile.negative_money(trips(spark, sf_dir), YELLOW_TAXI)
    return profile.with_position(found, F.desc("rows"), F.asc_nulls_first("payment_type"))


def flag_distribution_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order of the flag texts as data."""
    found = counts.flag_distribution(clean_trips(spark, sf_dir))
    return profile.with_position(found, F.col("flags"))


def profile_time_order_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times as text, some of them unreadable, which counts as no time."""
    return profile.profile_time_order(trips_with_text_times(spark, sf_dir), YELLOW_TAXI)


def clean_text_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unreadable times break no rule and stay as they are."""
    return cleaning.clean(trips_with_text_times(spark, sf_dir), YELLOW_TAXI, PERIOD)


def profile_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN is missing: neither above a limit nor valid."""
    return profile.profile_columns(trips_with_nan(spark, sf_dir), YELLOW_TAXI)


def rule_stats_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.rule_counts(trips_with_nan(spark, sf_dir), YELLOW_TAXI, PERIOD)


def profile_surcharge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the column that the other trips lack."""
    return profile.profile_columns(trips_with_surcharge(spark, sf_dir), YELLOW_TAXI)


def policy_surcharge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.cleaning_policy(trips_with_surcharge(spark, sf_dir), YELLOW_TAXI, PERIOD)


def action_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(table(spark, sf_dir, "customer"), _FALLBACK)


def limit_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules with one limit only: the other counts nothing, and its action is never taken."""
    df = table(spark, sf_dir, "part")
    counted = counts.rule_counts(df, _ONE_LIMIT)
    return counted.unionByName(
        cleaning.clean(df, _ONE_LIMIT).select(
            F.lit("total").alias("kind"), F.lit("output_rows").alias("rule"), F.lit(1).alias("rows")
        ).groupBy("kind", "rule").agg(F.count("rows").alias("rows"))
    )


def column_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule on a column that the table lacks is listed, counts nothing and removes nothing."""
    return profile.profile_columns(table(spark, sf_dir, "supplier"), _ABSENT)


def column_absent_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(table(spark, sf_dir, "supplier"), _ABSENT, "1996-01")


def decode_payment_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = profile.with_code_meaning(trips(spark, sf_dir), YELLOW_TAXI)
    return decoded.select(*KEYS, "payment_type", "meaning")


def cleaning_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.cleaning_policy(trips(spark, sf_dir), YELLOW_TAXI, PERIOD)


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.quality_report(trips(spark, sf_dir), YELLOW_TAXI, PERIOD)


def _monthly_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trips filed under two months, the odd orders under January, read back together."""
    folder = scratch_path(spark, "monthly")
    paths = []
    for month, odd in (("2024-12", 0), ("2025-01", 1)):
        paths.append(f"{folder}/yellow_tripdata_{month}.parquet")
        write_table(trips(spark, sf_dir).filter(F.col("l_orderkey") % 2 == odd), paths[-1])
    return spark.read.parquet(*paths)


def file_months_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the names of files say: a month, an impossible one, or nothing. All trips, filed in three
    parts."""
    folder = scratch_path(spark, "named")
    paths = []
    for name, rest in (("yellow_tripdata_2025-01", 0), ("yellow_tripdata_2025-13", 1), ("trips", 2)):
        paths.append(f"{folder}/{name}.parquet")
        write_table(trips(spark, sf_dir).filter(F.col("l_orderkey") % 3 == rest), paths[-1])
    return file_month_counts(spark.read.parquet(*paths))


def file_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per file month."""
    filed = _monthly_files(spark, sf_dir).select(file_month().alias("file_month"))
    return filed.groupBy("file_month").agg(F.count(F.lit(1)).alias("rows"))


def clean_per_file_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaning several monthly files at once, each trip checked against its own file's month."""
    filed = with_file_month(_monthly_files(spark, sf_dir))
    return cleaning.clean(filed, YELLOW_TAXI, MonthColumn("file_month"))


def customers_not_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A remove rule on a given table; the condition reaches the Parquet scan."""
    return cleaning.remove_rows(table(spark, sf_dir, "customer"), _CUSTOMERS)


def events_in_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.remove_rows(table(spark, sf_dir, "events"), _EVENTS)


def orders_outside_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month condition as a filter; as a half-open span it reaches the Parquet scan."""
    df = table(spark, sf_dir, "orders")
    return df.filter(bind(df, _ORDERS, "1996-01").month.condition.broken)


REGISTRY: dict[str, Query] = {
    "scan_parquet": scan_parquet,
    "scan_csv": scan_csv,
    "roundtrip_parquet": roundtrip_parquet,
    "roundtrip_csv": roundtrip_csv,
    "scan_csv_text": scan_csv_text,
    "roundtrip_csv_text": roundtrip_csv_text,
    "clean_job": clean_job,
    "trips": trips_in,
    "pred_below_min": _marked("passenger_count:below_min", "passenger_count"),
    "pred_below_min_exclusive": _marked("trip_distance:below_min", "trip_distance"),
    "pred_above_max": _marked("trip_distance:above_max", "trip_distance"),
    "pred_above_max_exclusive": _marked(
        "trip_distance:above_max", "trip_distance", catalog=_EXCLUSIVE_MAX
    ),
    "pred_domain": _marked("RatecodeID:domain", "RatecodeID"),
    "pred_domain_text": _marked("store_and_fwd_flag:domain", "store_and_fwd_flag"),
    "pred_time_order": _marked(
        "dropoff_before_pickup", "tpep_pickup_datetime", "tpep_dropoff_datetime"
    ),
    "pred_outside_month": _marked("pickup_outside_file_month", "tpep_pickup_datetime"),
    "act_remove": act_remove,
    "act_set_null": act_set_null,
    "act_flag": act_flag,
    "clean_trips": clean_trips,
    "clean_trips_fingerprint": clean_trips_fingerprint,
    "flag_contains": flag_contains,
    "dedup_exact": dedup_exact,
    "dedup_stats": dedup_stats,
    "dedup_stats_fingerprint": dedup_stats_fingerprint,
    "rule_stats": rule_stats,
    "clean_summary": clean_summary,
    "flag_distribution": flag_distribution,
    "post_clean_checks": post_clean_checks,
    "profile_columns": profile_columns,
    "profile_time_order": profile_time_order,
    "profile_month": profile_month,
    "profile_duplicates": profile_duplicates,
    "negative_money_by_payment": negative_money_by_payment,
    "negative_money_ranked": negative_money_ranked,
    "flag_distribution_ranked": flag_distribution_ranked,
    "pred_time_order_text": _marked(
        "dropoff_before_pickup",
        "tpep_pickup_datetime",
        "tpep_dropoff_datetime",
        source=trips_with_text_times,
    ),
    "profile_time_order_text": profile_time_order_text,
    "clean_text_times": clean_text_times,
    "profile_nan": profile_nan,
    "rule_stats_nan": rule_stats_nan,
    "profile_surcharge": profile_surcharge,
    "policy_surcharge": policy_surcharge,
    "action_fallback": action_fallback,
    "limit_absent": limit_absent,
    "column_absent": column_absent,
    "column_absent_clean": column_absent_clean,
    "decode_payment_type": decode_payment_type,
    "cleaning_policy": cleaning_policy,
    "dq_report": dq_report,
    "file_month": file_months,
    "file_months_named": file_months_named,
    "clean_per_file_month": clean_per_file_month,
    "customers_not_negative": customers_not_negative,
    "events_in_domain": events_in_domain,
    "orders_outside_month": orders_outside_month,
}

"""Independent SQL for each query, in DuckDB's dialect.

Written by hand with CASE and FILTER; nothing here is generated from the rule catalogue.
"""

from __future__ import annotations

_BASE = """
base AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_partkey % 50 = 0 THEN -l_quantity WHEN l_partkey % 97 = 0 THEN 0.0::DOUBLE
         ELSE l_quantity * 2.1::DOUBLE END AS trip_distance,
    CASE WHEN (l_orderkey + l_suppkey) % 6 = 0 THEN NULL
         WHEN (l_orderkey + l_suppkey) % 37 = 0 THEN 0
         WHEN (l_orderkey + l_suppkey) % 41 = 0 THEN 12 ELSE l_linenumber END AS passenger_count,
    CASE WHEN (l_orderkey + l_suppkey) % 25 = 0 THEN -l_extendedprice / 200.0::DOUBLE
         ELSE l_extendedprice / 200.0::DOUBLE END AS fare_amount,
    CASE WHEN (l_orderkey + l_suppkey) % 50 = 0 THEN -l_extendedprice / 190.0::DOUBLE
         ELSE l_extendedprice / 190.0::DOUBLE END AS total_amount,
    CASE WHEN (l_orderkey + l_suppkey) % 6 = 0 THEN NULL WHEN l_partkey % 71 = 0 THEN 42
         ELSE l_linenumber END AS RatecodeID,
    CASE WHEN (l_orderkey + l_suppkey) % 6 = 0 THEN NULL WHEN l_partkey % 83 = 0 THEN 'X'
         WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    CASE WHEN (l_orderkey + l_suppkey) % 6 = 0 THEN NULL ELSE 1.75::DOUBLE END AS Airport_fee,
    CASE WHEN l_partkey % 59 = 0 THEN NULL ELSE CAST(l_partkey % 7 AS INTEGER) END AS payment_type,
    CASE WHEN l_partkey % 113 = 0 THEN TIMESTAMP '2024-12-31 23:00:00'
         ELSE TIMESTAMP '2025-01-01 00:00:00' + to_days(CAST(l_orderkey % 30 AS INTEGER))
    END AS tpep_pickup_datetime,
    l_partkey % 61 = 0 AS inverted
  FROM lineitem),
once AS (
  SELECT l_orderkey, l_linenumber, trip_distance, passenger_count, fare_amount, total_amount,
    RatecodeID, store_and_fwd_flag, Airport_fee, payment_type, tpep_pickup_datetime,
    tpep_pickup_datetime + CASE WHEN inverted THEN INTERVAL (-10) MINUTE
                                ELSE INTERVAL 20 MINUTE END AS tpep_dropoff_datetime
  FROM base),
trips AS (
  SELECT * FROM once UNION ALL SELECT * FROM once WHERE l_orderkey % 100 = 0)
"""


def _flags(outside_month: str) -> str:
    return f"""
    nullif(concat_ws(';',
      CASE WHEN trip_distance > 100 THEN 'trip_distance:above_max' END,
      CASE WHEN fare_amount < 0 THEN 'fare_amount:below_min' END,
      CASE WHEN fare_amount > 500 THEN 'fare_amount:above_max' END,
      CASE WHEN total_amount < 0 THEN 'total_amount:below_min' END,
      CASE WHEN total_amount > 500 THEN 'total_amount:above_max' END,
      CASE WHEN RatecodeID NOT IN (1, 2, 3, 4, 5, 6, 99) THEN 'RatecodeID:domain' END,
      CASE WHEN store_and_fwd_flag NOT IN ('Y', 'N') THEN 'store_and_fwd_flag:domain' END,
      CASE WHEN {outside_month} THEN 'pickup_outside_file_month' END), '') AS dq_flags"""


_OUTSIDE = "strftime(tpep_pickup_datetime, '%Y-%m') <> '2025-01'"
_NULLED = """CASE WHEN passenger_count < 1 OR passenger_count > 9 THEN NULL
                  ELSE passenger_count END AS passenger_count"""
_KEPT = """(trip_distance IS NULL OR trip_distance > 0)
    AND (tpep_pickup_datetime IS NULL OR tpep_dropoff_datetime IS NULL
         OR tpep_dropoff_datetime >= tpep_pickup_datetime)"""


def _cleaning(outside_month: str) -> str:
    return f"""
survivors AS (
  SELECT l_orderkey, l_linenumber, trip_distance, {_NULLED}, fare_amount, total_amount,
    RatecodeID, store_and_fwd_flag, Airport_fee, payment_type, tpep_pickup_datetime,
    tpep_dropoff_datetime, {_flags(outside_month)}
  FROM trips
  WHERE {_KEPT}),
cleaned AS (SELECT DISTINCT * FROM survivors)
"""


def _on_trips(select: str) -> str:
    return f"WITH {_BASE}\n{select}"


def _on_cleaned(select: str, outside_month: str = _OUTSIDE) -> str:
    return f"WITH {_BASE},\n{_cleaning(outside_month)}\n{select}"


_CLEANED = _on_cleaned("SELECT * FROM cleaned")

_RULE_COUNTS = f"""
  SELECT 'removed' AS kind, 'trip_distance:below_min' AS rule,
         count(*) FILTER (WHERE trip_distance <= 0) AS rows FROM trips
  UNION ALL SELECT 'removed', 'dropoff_before_pickup',
         count(*) FILTER (WHERE tpep_dropoff_datetime < tpep_pickup_datetime) FROM trips
  UNION ALL SELECT 'set_null', 'passenger_count:below_min',
         count(*) FILTER (WHERE passenger_count < 1) FROM trips
  UNION ALL SELECT 'set_null', 'passenger_count:above_max',
         count(*) FILTER (WHERE passenger_count > 9) FROM trips
  UNION ALL SELECT 'flagged', 'trip_distance:above_max',
         count(*) FILTER (WHERE trip_distance > 100) FROM trips
  UNION ALL SELECT 'flagged', 'fare_amount:below_min',
         count(*) FILTER (WHERE fare_amount < 0) FROM trips
  UNION ALL SELECT 'flagged', 'fare_amount:above_max',
         count(*) FILTER (WHERE fare_amount > 500) FROM trips
  UNION ALL SELECT 'flagged', 'total_amount:below_min',
         count(*) FILTER (WHERE total_amount < 0) FROM trips
  UNION ALL SELECT 'flagged', 'total_amount:above_max',
         count(*) FILTER (WHERE total_amount > 500) FROM trips
  UNION ALL SELECT 'flagged', 'RatecodeID:domain',
         count(*) FILTER (WHERE RatecodeID NOT IN (1, 2, 3, 4, 5, 6, 99)) FROM trips
  UNION ALL SELECT 'flagged', 'store_and_fwd_flag:domain',
         count(*) FILTER (WHERE store_and_fwd_flag NOT IN ('Y', 'N')) FROM trips
  UNION ALL SELECT 'flagged', 'pickup_outside_file_month',
         count(*) FILTER (WHERE {_OUTSIDE}) FROM trips
"""

_SUMMARY = f"""
  SELECT 'total' AS kind, 'input_rows' AS rule, (SELECT count(*) FROM trips) AS rows
  UNION ALL SELECT 'total', 'output_rows', (SELECT count(*) FROM cleaned)
  UNION ALL SELECT 'total', 'rows_removed',
         (SELECT count(*) FROM trips) - (SELECT count(*) FROM cleaned)
  UNION ALL SELECT 'total', 'rows_flagged',
         (SELECT count(*) FROM cleaned WHERE dq_flags IS NOT NULL)
  UNION ALL SELECT 'removed', 'exact_duplicate_rows',
         (SELECT count(*) FROM survivors) - (SELECT count(*) FROM cleaned)
  UNION ALL {_RULE_COUNTS}
"""


def _marked(verdict: str, *shown: str) -> str:
    return _on_trips(
        f"SELECT l_orderkey, l_linenumber, {', '.join(shown)}, "
        f"coalesce({verdict}, FALSE) AS violates FROM trips"
    )


def _profile_row(
    column: str,
    below: str,
    above: str,
    domain: str,
    actions: tuple[str | None, str | None, str | None],
    description: str,
) -> str:
    def text(value: str | None) -> str:
        return "CAST(NULL AS VARCHAR)" if value is None else f"'{value}'"

    below_min, above_max, violation = (text(action) for action in actions)
    return f"""
  SELECT '{column}' AS "column", TRUE AS present, count(*) AS total,
    count(*) - count({column}) AS missing,
    count(*) FILTER (WHERE ({below}) OR ({above}) OR ({domain})) AS invalid,
    count({column}) - count(*) FILTER (WHERE ({below}) OR ({above}) OR ({domain})) AS valid,
    count(*) FILTER (WHERE {below}) AS below_min,
    count(*) FILTER (WHERE {above}) AS above_max,
    count(*) FILTER (WHERE {domain}) AS domain_invalid,
    {below_min} AS on_below_min, {above_max} AS on_above_max, {violation} AS on_violation,
    'keep_null' AS on_null, '{description}' AS description
  FROM trips"""


_PROFILE = "\nUNION ALL".join(
    [
        _profile_row(
            "trip_distance", "trip_distance <= 0", "trip_distance > 100", "FALSE",
            ("remove", "flag", None),
            "Elapsed trip distance in miles from the taximeter.",
        ),
        _profile_row(
            "passenger_count", "passenger_count < 1", "passenger_count > 9", "FALSE",
            ("set_null", "set_null", None),
            "Number of passengers. 0 is not a valid occupancy; missing is allowed.",
        ),
        _profile_row(
            "fare_amount", "fare_amount < 0", "fare_amount > 500", "FALSE",
            ("flag", "flag", None),
            "Meter fare. Negatives may be disputes/voids/refunds — do not auto-delete.",
        ),
        _profile_row(
            "total_amount", "total_amount < 0", "total_amount > 500", "FALSE",
            ("flag", "flag", None),
            "Total charged to passenger. Negatives treated like fare_amount.",
        ),
        _profile_row(
            "RatecodeID", "FALSE", "FALSE", "RatecodeID NOT IN (1, 2, 3, 4, 5, 6, 99)",
            (None, None, "flag"),
            "1=standard 2=JFK 3=Newark 4=Nassau/Westchester 5=negotiated 6=group 99=unknown.",
        ),
        _profile_row(
            "store_and_fwd_flag", "FALSE", "FALSE", "store_and_fwd_flag NOT IN ('Y', 'N')",
            (None, None, "flag"),
            "Y if the trip record was stored and forwarded; N otherwise.",
        ),
        _profile_row(
            "Airport_fee", "FALSE", "FALSE", "FALSE", (None, None, None),
            "LaGuardia/JFK pickup surcharge. Missing is allowed.",
        ),
        """
  SELECT 'congestion_surcharge', FALSE, count(*), NULL, NULL, NULL, NULL, NULL, NULL,
         NULL, NULL, NULL, NULL, NULL FROM trips""",
    ]
)

_SURPLUS = "(SELECT count(*) FROM trips) - (SELECT count(*) FROM (SELECT DISTINCT * FROM trips))"

_MONEY = """
  SELECT payment_type, count(*) AS rows,
    CASE WHEN payment_type IS NULL THEN 'missing' WHEN payment_type = 3 THEN 'no_charge'
         WHEN payment_type = 4 THEN 'dispute' WHEN payment_type = 6 THEN 'voided_trip'
         ELSE 'not_a_known_reversal' END AS meaning
  FROM trips WHERE fare_amount < 0 OR total_amount < 0 GROUP BY payment_type
"""

# Problem, rule, rows concerned. The first two are fixed values: texts that results must show.
_POLICY_LINES = (
    ("trip_distance <= 0", "Remove", "count(*) FILTER (WHERE trip_distance <= 0)"),
    (
        "trip_distance > 100 miles",
        "Flag (investigate outlier)",
        "count(*) FILTER (WHERE trip_distance > 100)",
    ),
    (
        "fare_amount < 0",
        "Flag; keep row (possible reversal)",
        "count(*) FILTER (WHERE fare_amount < 0)",
    ),
    (
        "total_amount < 0",
        "Flag; keep row (possible reversal)",
        "count(*) FILTER (WHERE total_amount < 0)",
    ),
    (
        "fare/total > 500",
        "Flag (investigate outlier)",
        "count(*) FILTER (WHERE fare_amount > 500 OR total_amount > 500)",
    ),
    ("passenger_count <= 0", "Set to NULL", "count(*) FILTER (WHERE passenger_count <= 0)"),
    ("passenger_count > 9", "Set to NULL", "count(*) FILTER (WHERE passenger_count > 9)"),
    (
        "dropoff < pickup",
        "Remove",
        "count(*) FILTER (WHERE tpep_dropoff_datetime < tpep_pickup_datetime)",
    ),
    ("Missing passenger_count", "Keep as NULL", "count(*) - count(passenger_count)"),
    ("Missing Airport_fee", "Keep as NULL", "count(*) - count(Airport_fee)"),
    ("Missing RatecodeID", "Keep as NULL", "count(*) - count(RatecodeID)"),
    ("Missing store_and_fwd_flag", "Keep as NULL", "count(*) - count(store_and_fwd_flag)"),
    ("Missing congestion_surcharge", "Keep as NULL", "max(CAST(NULL AS BIGINT))"),
    ("Duplicate rows", "Remove if found", _SURPLUS),
    ("Pickup outside file month", "Flag (keep row)", f"count(*) FILTER (WHERE {_OUTSIDE})"),
)

_POLICY = "\nUNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS position, '{problem}' AS problem, '{rule}' AS rule, "
    f"(SELECT {rows} FROM trips) AS rows"
    if rows != _SURPLUS
    else f"SELECT CAST({i} AS INTEGER), '{problem}', '{rule}', {rows}"
    for i, (problem, rule, rows) in enumerate(_POLICY_LINES, start=1)
)


def _report_column(column: str, below: str | None, above: str | None, domain: str | None) -> str:
    """Report lines of one column out of its profile row; the arguments are the actions."""

    def text(value: str | None) -> str:
        return "NULL" if value is None else f"'{value}'"

    return "\nUNION ALL ".join(
        f"SELECT 'column', '{column}', '{metric}', CAST({metric} AS VARCHAR), {text(action)} "
        f"FROM profiled WHERE \"column\" = '{column}'"
        for metric, action in (
            ("missing", "keep_null"),
            ("invalid", None),
            ("valid", None),
            ("below_min", below),
            ("above_max", above),
            ("domain_invalid", domain),
        )
    )


_REPORT = f"""
, profiled AS ({_PROFILE}), money AS ({_MONEY})
SELECT 'file' AS section, CAST(NULL AS VARCHAR) AS rule, 'total_records' AS metric,
       CAST(count(*) AS VARCHAR) AS value, CAST(NULL AS VARCHAR) AS action FROM trips
UNION ALL {_report_column("trip_distance", "remove", "flag", None)}
UNION ALL {_report_column("passenger_count", "set_null", "set_null", None)}
UNION ALL {_report_column("fare_amount", "flag", "flag", None)}
UNION ALL {_report_column("total_amount", "flag", "flag", None)}
UNION ALL {_report_column("RatecodeID", "flag", "flag", "flag")}
UNION ALL {_report_column("store_and_fwd_flag", "flag", "flag", "flag")}
UNION ALL {_report_column("Airport_fee", None, None, None)}
UNION ALL SELECT 'column', 'congestion_surcharge', 'present', 'false', NULL
UNION ALL SELECT 'cross_field', 'dropoff_before_pickup', 'invalid',
  CAST(count(*) FILTER (WHERE tpep_dropoff_datetime < tpep_pickup_datetime) AS VARCHAR), 'remove'
  FROM trips
UNION ALL SELECT 'cross_field', 'dropoff_before_pickup', 'valid',
  CAST(count(*) - count(*) FILTER (WHERE tpep_dropoff_datetime < tpep_pickup_datetime) AS VARCHAR),
  NULL FROM trips
UNION ALL SELECT 'cross_field', 'dropoff_before_pickup', 'missing',
  CAST(2 * count(*) - count(tpep_pickup_datetime) - count(tpep_dropoff_datetime) AS VARCHAR),
  NULL FROM trips
UNION ALL SELECT 'cross_field', 'pickup_outside_file_month', 'invalid',
  CAST(count(*) FILTER (WHERE {_OUTSIDE}) AS VARCHAR), 'flag' FROM trips
UNION ALL SELECT 'cross_field', 'pickup_outside_file_month', 'valid',
  CAST(count(*) FILTER (WHERE strftime(tpep_pickup_datetime, '%Y-%m') = '2025-01') AS VARCHAR),
  NULL FROM trips
UNION ALL SELECT 'cross_field', 'pickup_outside_file_month', 'expected_month', '2025-01', NULL
UNION ALL SELECT 'cross_field', 'pickup_outside_file_month', 'min_pickup',
  CAST(min(tpep_pickup_datetime) AS VARCHAR), NULL FROM trips
UNION ALL SELECT 'cross_field', 'pickup_outside_file_month', 'max_pickup',
  CAST(max(tpep_pickup_datetime) AS VARCHAR), NULL FROM trips
UNION ALL SELECT 'cross_field', 'exact_duplicate_rows', 'invalid',
  CAST({_SURPLUS} AS VARCHAR), 'remove'
UNION ALL SELECT 'cross_field', 'exact_duplicate_rows', 'valid',
  CAST((SELECT count(*) FROM (SELECT DISTINCT * FROM trips)) AS VARCHAR), NULL
UNION ALL {" UNION ALL ".join(
    f"SELECT 'policy', '{problem}', 'rule', '{rule}', NULL" for problem, rule, _ in _POLICY_LINES
)}
UNION ALL SELECT 'negative_money', CAST(payment_type AS VARCHAR), meaning,
  CAST(rows AS VARCHAR), NULL FROM money
"""

_FILED_UNDER = "CASE WHEN l_orderkey % 2 = 0 THEN '2024-12' ELSE '2025-01' END"

_STATS = """
  SELECT (SELECT count(*) FROM survivors) AS input_rows,
         (SELECT count(*) FROM cleaned) AS output_rows,
         (SELECT count(*) FROM survivors) - (SELECT count(*) FROM cleaned) AS removed
"""

_TEXT_TIMES = """
text_trips AS (
  SELECT * REPLACE (
    coalesce(CASE WHEN (7 * l_orderkey + l_linenumber) % 13 = 0 THEN 'not a time' WHEN (7 * l_orderkey + l_linenumber) % 17 = 0 THEN ''
                  WHEN (7 * l_orderkey + l_linenumber) % 19 = 0 THEN '2025-02-30 10:00:00' END,
             strftime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S')) AS tpep_pickup_datetime,
    CASE WHEN (l_orderkey + 3 * l_linenumber) % 7 = 0 THEN 'n/a'
         ELSE strftime(tpep_dropoff_datetime, '%Y-%m-%d %H:%M:%S') END AS tpep_dropoff_datetime)
  FROM trips)
"""
_NAN = """
nan_trips AS (
  SELECT * REPLACE (
    CASE WHEN (7 * l_orderkey + l_linenumber) % 31 = 0 OR (7 * l_orderkey + l_linenumber) % 37 = 0 THEN NULL ELSE trip_distance END AS trip_distance,
    CASE WHEN (7 * l_orderkey + l_linenumber) % 31 = 0 OR (7 * l_orderkey + l_linenumber) % 37 = 0 THEN NULL ELSE fare_amount END AS fare_amount,
    CASE WHEN (7 * l_orderkey + l_linenumber) % 31 = 0 OR (7 * l_orderkey + l_linenumber) % 37 = 0 THEN NULL ELSE Airport_fee END AS Airport_fee)
  FROM trips)
"""
_PICKED = "try_cast(tpep_pickup_datetime AS TIMESTAMP)"
_DROPPED = "try_cast(tpep_dropoff_datetime AS TIMESTAMP)"


def _on_changed(changed: str, select: str) -> str:
    return f"WITH {_BASE},\n{changed}\n{select}"


_SURCHARGED = _PROFILE.replace(
    """
  SELECT 'congestion_surcharge', FALSE, count(*), NULL, NULL, NULL, NULL, NULL, NULL,
         NULL, NULL, NULL, NULL, NULL FROM trips""",
    _profile_row(
        "congestion_surcharge", "FALSE", "FALSE", "FALSE", (None, None, None),
        "NYS congestion surcharge. Missing is allowed.",
    ),
)
_SURCHARGE = """
charged AS (
  SELECT *, CASE WHEN (7 * l_orderkey + l_linenumber) % 11 <> 0 THEN 2.5::DOUBLE END AS congestion_surcharge
  FROM trips)
"""

ORACLE: dict[str, str] = {
    "scan_csv_text": "SELECT * REPLACE (nullif(text, '') AS text) FROM documents",
    "roundtrip_csv_text": "SELECT * FROM documents",
    "negative_money_ranked": _on_trips(
        f"""SELECT *, CAST(row_number() OVER (ORDER BY rows DESC, payment_type NULLS FIRST) AS INTEGER)
             AS position FROM ({_MONEY})"""
    ),
    "flag_distribution_ranked": _on_cleaned(
        """SELECT *, CAST(row_number() OVER (ORDER BY flags) AS INTEGER) AS position FROM (
             SELECT coalesce(dq_flags, '__none__') AS flags, count(*) AS rows FROM cleaned GROUP BY 1)"""
    ),
    "pred_time_order_text": _on_changed(
        _TEXT_TIMES,
        f"""SELECT l_orderkey, l_linenumber, tpep_pickup_datetime, tpep_dropoff_datetime,
              coalesce({_DROPPED} < {_PICKED}, FALSE) AS violates FROM text_trips""",
    ),
    "profile_time_order_text": _on_changed(
        _TEXT_TIMES,
        f"""SELECT 'dropoff_before_pickup' AS rule,
              count(*) FILTER (WHERE {_DROPPED} < {_PICKED}) AS invalid,
              count(*) - count(*) FILTER (WHERE {_DROPPED} < {_PICKED}) AS valid,
              2 * count(*) - count({_PICKED}) - count({_DROPPED}) AS missing,
              'remove' AS on_violation,
              'Dropoff timestamp is earlier than pickup.' AS description
            FROM text_trips""",
    ),
    "clean_text_times": _on_changed(
        _TEXT_TIMES,
        f"""SELECT DISTINCT * REPLACE ({_NULLED}),
              {_flags(f"strftime({_PICKED}, '%Y-%m') <> '2025-01'")}
            FROM text_trips WHERE (trip_distance IS NULL OR trip_distance > 0)
              AND coalesce({_DROPPED} >= {_PICKED}, TRUE)""",
    ),
    "profile_nan": _on_changed(_NAN, _PROFILE.replace("FROM trips", "FROM nan_trips")),
    "rule_stats_nan": _on_changed(_NAN, _RULE_COUNTS.replace("FROM trips", "FROM nan_trips")),
    "profile_surcharge": _on_changed(_SURCHARGE, _SURCHARGED.replace("FROM trips", "FROM charged")),
    "policy_surcharge": _on_changed(
        _SURCHARGE,
        _POLICY.replace(
            "max(CAST(NULL AS BIGINT))", "count(*) - count(congestion_surcharge)"
        ).replace("FROM trips", "FROM charged"),
    ),
    "action_fallback": """
      SELECT DISTINCT * REPLACE (CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS c_acctbal),
        nullif(concat_ws(';', CASE WHEN c_acctbal > 5000 THEN 'c_acctbal:above_max' END,
          CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN 'c_mktsegment:domain' END), '')
          AS dq_flags
      FROM customer""",
    "limit_absent": """
      SELECT 'removed' AS kind, 'p_size:below_min' AS rule,
             count(*) FILTER (WHERE p_size < 10) AS rows FROM part
      UNION ALL SELECT 'flagged', 'p_retailprice:above_max',
             count(*) FILTER (WHERE p_retailprice > 1500) FROM part
      UNION ALL SELECT 'total', 'output_rows', count(*) FROM part WHERE p_size >= 10 OR p_size IS NULL""",
    "column_absent": """
      SELECT 's_acctbal' AS "column", TRUE AS present, count(*) AS total,
        count(*) - count(s_acctbal) AS missing, count(*) FILTER (WHERE s_acctbal < 0) AS invalid,
        count(*) FILTER (WHERE s_acctbal >= 0) AS valid,
        count(*) FILTER (WHERE s_acctbal < 0) AS below_min, 0::BIGINT AS above_max,
        0::BIGINT AS domain_invalid, 'flag' AS on_below_min, NULL::VARCHAR AS on_above_max,
        NULL::VARCHAR AS on_violation, NULL::VARCHAR AS on_null, '' AS description
      FROM supplier
      UNION ALL SELECT 's_rating', FALSE, count(*), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
        NULL, NULL, NULL FROM supplier""",
    "column_absent_clean": """
      SELECT *, CASE WHEN s_acctbal < 0 THEN 's_acctbal:below_min' END AS dq_flags FROM supplier""",
    "file_months_named": _on_trips(
        """SELECT CASE l_orderkey % 3 WHEN 0 THEN '2025-01' WHEN 1 THEN '2025-13' END AS named,
             CASE WHEN l_orderkey % 3 = 0 THEN '2025-01' END AS month, count(*) AS rows
           FROM trips GROUP BY ALL"""
    ),
    "scan_parquet": "SELECT * FROM lineitem",
    "scan_csv": _on_trips(
        "SELECT * REPLACE (CAST(l_orderkey AS INTEGER) AS l_orderkey) FROM trips"
    ),
    "roundtrip_parquet": _CLEANED,
    "roundtrip_csv": _CLEANED,
    "clean_job": _CLEANED,
    "trips": _on_trips("SELECT * FROM trips"),
    "pred_below_min": _marked("passenger_count < 1", "passenger_count"),
    "pred_below_min_exclusive": _marked("trip_distance <= 0", "trip_distance"),
    "pred_above_max": _marked("trip_distance > 100", "trip_distance"),
    "pred_above_max_exclusive": _marked("trip_distance >= 105", "trip_distance"),
    "pred_domain": _marked("RatecodeID NOT IN (1, 2, 3, 4, 5, 6, 99)", "RatecodeID"),
    "pred_domain_text": _marked("store_and_fwd_flag NOT IN ('Y', 'N')", "store_and_fwd_flag"),
    "pred_time_order": _marked(
        "tpep_dropoff_datetime < tpep_pickup_datetime",
        "tpep_pickup_datetime",
        "tpep_dropoff_datetime",
    ),
    "pred_outside_month": _marked(
        "year(tpep_pickup_datetime) <> 2025 OR month(tpep_pickup_datetime) <> 1",
        "tpep_pickup_datetime",
    ),
    "act_remove": _on_trips(f"SELECT * FROM trips WHERE {_KEPT}"),
    "act_set_null": _on_trips(f"SELECT * REPLACE ({_NULLED}) FROM trips"),
    "act_flag": _on_trips(f"SELECT *, {_flags(_OUTSIDE)} FROM trips"),
    "clean_trips": _CLEANED,
    "clean_trips_fingerprint": _CLEANED,
    "flag_contains": _on_cleaned(
        "SELECT * FROM cleaned WHERE contains(dq_flags, 'pickup_outside_file_month')"
    ),
    "dedup_exact": _on_trips("SELECT DISTINCT * FROM trips"),
    "dedup_stats": _on_cleaned(_STATS),
    "dedup_stats_fingerprint": _on_cleaned(_STATS),
    "rule_stats": _on_trips(_RULE_COUNTS),
    "clean_summary": _on_cleaned(_SUMMARY),
    "flag_distribution": _on_cleaned(
        "SELECT coalesce(dq_flags, '__none__') AS flags, count(*) AS rows FROM cleaned GROUP BY 1"
    ),
    "post_clean_checks": _on_cleaned(
        """SELECT count(*) AS rows,
             count(*) FILTER (WHERE trip_distance <= 0) AS trip_distance_below_min,
             count(*) FILTER (WHERE trip_distance IS NULL) AS trip_distance_null,
             count(*) FILTER (WHERE passenger_count < 1) AS passenger_count_below_min,
             count(*) FILTER (WHERE passenger_count IS NULL) AS passenger_count_null,
             count(*) FILTER (WHERE fare_amount < 0) AS fare_amount_below_min,
             count(*) FILTER (WHERE fare_amount IS NULL) AS fare_amount_null,
             count(*) FILTER (WHERE total_amount < 0) AS total_amount_below_min,
             count(*) FILTER (WHERE total_amount IS NULL) AS total_amount_null,
             count(*) FILTER (WHERE tpep_dropoff_datetime < tpep_pickup_datetime)
               AS dropoff_before_pickup
           FROM cleaned"""
    ),
    "profile_columns": _on_trips(_PROFILE),
    "profile_time_order": _on_trips(
        """SELECT 'dropoff_before_pickup' AS rule,
             count(*) FILTER (WHERE tpep_dropoff_datetime < tpep_pickup_datetime) AS invalid,
             count(*) - count(*) FILTER (WHERE tpep_dropoff_datetime < tpep_pickup_datetime)
               AS valid,
             2 * count(*) - count(tpep_pickup_datetime) - count(tpep_dropoff_datetime) AS missing,
             'remove' AS on_violation,
             'Dropoff timestamp is earlier than pickup.' AS description
           FROM trips"""
    ),
    "profile_month": _on_trips(
        f"""SELECT 'pickup_outside_file_month' AS rule,
             count(*) FILTER (WHERE {_OUTSIDE}) AS invalid,
             count(tpep_pickup_datetime) - count(*) FILTER (WHERE {_OUTSIDE}) AS valid,
             '2025-01' AS expected_month,
             min(tpep_pickup_datetime) AS min_pickup, max(tpep_pickup_datetime) AS max_pickup,
             'flag' AS on_violation,
             'Pickup timestamp is outside the month implied by the TLC filename.' AS description
           FROM trips"""
    ),
    "profile_duplicates": _on_trips(
        f"""SELECT 'exact_duplicate_rows' AS rule, {_SURPLUS} AS invalid,
             (SELECT count(*) FROM (SELECT DISTINCT * FROM trips)) AS valid,
             'remove' AS on_violation,
             'Exact duplicate rows. None expected in TLC monthly files.' AS description"""
    ),
    "negative_money_by_payment": _on_trips(_MONEY),
    "decode_payment_type": _on_trips(
        """SELECT l_orderkey, l_linenumber, payment_type,
             CASE WHEN payment_type IS NULL THEN 'missing' WHEN payment_type = 3 THEN 'no_charge'
                  WHEN payment_type = 4 THEN 'dispute' WHEN payment_type = 6 THEN 'voided_trip'
                  ELSE 'not_a_known_reversal' END AS meaning
           FROM trips"""
    ),
    "cleaning_policy": _on_trips(_POLICY),
    "dq_report": f"WITH {_BASE}{_REPORT}",
    "file_month": _on_trips(
        f"SELECT {_FILED_UNDER} AS file_month, count(*) AS rows FROM trips GROUP BY 1"
    ),
    "clean_per_file_month": _on_cleaned(
        "SELECT * FROM cleaned",
        f"strftime(tpep_pickup_datetime, '%Y-%m') <> {_FILED_UNDER}",
    ),
    "customers_not_negative": "SELECT * FROM customer WHERE c_acctbal IS NULL OR c_acctbal >= 0",
    "events_in_domain": (
        "SELECT * FROM events WHERE event_type IS NULL OR event_type IN ('click', 'view')"
    ),
    "orders_outside_month": (
        "SELECT * FROM orders WHERE strftime(o_orderdate, '%Y-%m') <> '1996-01'"
    ),
}

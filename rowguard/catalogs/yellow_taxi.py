"""Rules for monthly yellow-taxi trip files.

Negative amounts are flagged and kept: no-charge, disputed and voided trips are booked as
reversals, so a negative amount alone does not show an error.
"""

from __future__ import annotations

from rowguard.rules import (
    FLAG,
    KEEP_NULL,
    REMOVE,
    SET_NULL,
    Catalog,
    ColumnRule,
    DuplicateRule,
    MonthRule,
    PolicyLine,
    TimeOrderRule,
)

# ---------------------------------------------------------------------------------------------
# Column names, codes, limits, labels and texts that results must show exactly.
# ---------------------------------------------------------------------------------------------
PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
PAYMENT_TYPE = "payment_type"

REVERSAL_MEANINGS = {3: "no_charge", 4: "dispute", 6: "voided_trip"}
RATE_CODES = (1, 2, 3, 4, 5, 6, 99)
STORE_AND_FORWARD_VALUES = ("Y", "N")

REQUIRED = (PICKUP, DROPOFF, "trip_distance", "passenger_count", "fare_amount", "total_amount")

COLUMN_RULES = (
    ColumnRule(
        "trip_distance",
        min=0,
        min_inclusive=False,
        max=100,
        on_below_min=REMOVE,
        on_above_max=FLAG,
        on_null=KEEP_NULL,
        description="Elapsed trip distance in miles from the taximeter.",
    ),
    ColumnRule(
        "passenger_count",
        min=1,
        max=9,
        on_below_min=SET_NULL,
        on_above_max=SET_NULL,
        on_null=KEEP_NULL,
        description="Number of passengers. 0 is not a valid occupancy; missing is allowed.",
    ),
    ColumnRule(
        "fare_amount",
        min=0,
        max=500,
        on_below_min=FLAG,
        on_above_max=FLAG,
        on_null=KEEP_NULL,
        description="Meter fare. Negatives may be disputes/voids/refunds — do not auto-delete.",
    ),
    ColumnRule(
        "total_amount",
        min=0,
        max=500,
        on_below_min=FLAG,
        on_above_max=FLAG,
        on_null=KEEP_NULL,
        description="Total charged to passenger. Negatives treated like fare_amount.",
    ),
    ColumnRule(
        "RatecodeID",
        allowed=RATE_CODES,
        on_violation=FLAG,
        on_null=KEEP_NULL,
        description="1=standard 2=JFK 3=Newark 4=Nassau/Westchester 5=negotiated 6=group 99=unknown.",
    ),
    ColumnRule(
        "store_and_fwd_flag",
        allowed=STORE_AND_FORWARD_VALUES,
        on_violation=FLAG,
        on_null=KEEP_NULL,
        description="Y if the trip record was stored and forwarded; N otherwise.",
    ),
    ColumnRule(
        "Airport_fee",
        on_null=KEEP_NULL,
        description="LaGuardia/JFK pickup surcharge. Missing is allowed.",
    ),
    ColumnRule(
        "congestion_surcharge",
        on_null=KEEP_NULL,
        description="NYS congestion surcharge. Missing is allowed.",
    ),
)

TIME_ORDER = TimeOrderRule(
    "dropoff_before_pickup",
    start=PICKUP,
    end=DROPOFF,
    description="Dropoff timestamp is earlier than pickup.",
)
FILE_MONTH = MonthRule(
    "pickup_outside_file_month",
    column=PICKUP,
    needs=(PICKUP, DROPOFF),
    description="Pickup timestamp is outside the month implied by the TLC filename.",
)
DUPLICATES = DuplicateRule(
    "exact_duplicate_rows",
    description="Exact duplicate rows. None expected in TLC monthly files.",
)

POLICY = (
    PolicyLine("trip_distance <= 0", "Remove", ("trip_distance:below_min",)),
    PolicyLine("trip_distance > 100 miles", "Flag (investigate outlier)", ("trip_distance:above_max",)),
    PolicyLine("fare_amount < 0", "Flag; keep row (possible reversal)", ("fare_amount:below_min",)),
    PolicyLine("total_amount < 0", "Flag; keep row (possible reversal)", ("total_amount:below_min",)),
    PolicyLine(
        "fare/total > 500",
        "Flag (investigate outlier)",
        ("fare_amount:above_max", "total_amount:above_max"),
    ),
    PolicyLine("passenger_count <= 0", "Set to NULL", ("passenger_count:below_min",)),
    PolicyLine("passenger_count > 9", "Set to NULL", ("passenger_count:above_max",)),
    PolicyLine("dropoff < pickup", "Remove", ("dropoff_before_pickup",)),
    PolicyLine("Missing passenger_count", "Keep as NULL", ("passenger_count:missing",)),
    PolicyLine("Missing Airport_fee", "Keep as NULL", ("Airport_fee:missing",)),
    PolicyLine("Missing RatecodeID", "Keep as NULL", ("RatecodeID:missing",)),
    PolicyLine("Missing store_and_fwd_flag", "Keep as NULL", ("store_and_fwd_flag:missing",)),
    PolicyLine("Missing congestion_surcharge", "Keep as NULL", ("congestion_surcharge:missing",)),
    PolicyLine("Duplicate rows", "Remove if found", ("exact_duplicate_rows",)),
    PolicyLine("Pickup outside file month", "Flag (keep row)", ("pickup_outside_file_month",)),
)
# ---------------------------------------------------------------------------------------------

YELLOW_TAXI = Catalog(
    columns=COLUMN_RULES,
    time_order=TIME_ORDER,
    month=FILE_MONTH,
    duplicates=DUPLICATES,
    required=REQUIRED,
    policy=POLICY,
    money_columns=("fare_amount", "total_amount"),
    code_column=PAYMENT_TYPE,
    code_meanings=REVERSAL_MEANINGS,
)

"""Batch job: read trips, clean them, write them, account for every row.

    python -m rowguard.plans.clean_job --input RAW --output CLEANED
    spark-submit --py-files rowguard.zip rowguard/plans/clean_job.py --input RAW --output CLEANED
"""

from __future__ import annotations

import argparse
import time
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from rowguard.catalogs import YELLOW_TAXI
from rowguard.functions.months import MonthColumn, month_of_path
from rowguard.operators.cleaning import (
    Period,
    check_columns,
    clean,
)
from rowguard.operators.counts import (
    INPUT_ROWS,
    OUTPUT_ROWS,
    ROWS_FLAGGED,
    ROWS_REMOVED,
    TOTAL,
    clean_summary,
)
from rowguard.operators.duplicates import drop_duplicates, drop_rare_duplicates
from rowguard.plans.sizing import size_shuffles
from rowguard.rules import Catalog
from rowguard.session import get_session, private_session
from rowguard.sources.tables import (
    CSV,
    PARQUET,
    check_file_months,
    format_of,
    read_table,
    with_file_month,
    write_table,
)

FROM_NAME = "from-name"
PER_FILE = "per-file"
_FILE_MONTH = "__rowguard_file_month"
# Suffixes of data files that are neither Parquet nor CSV: refused.
_OTHER_FILES = (".json", ".jsonl", ".txt", ".tsv", ".gz", ".bz2", ".zip", ".xz", ".zst", ".orc", ".avro", ".xlsx")

DEDUP_AGGREGATE = "aggregate"
DEDUP_FINGERPRINT = "fingerprint"


@dataclass
class CleanOutcome:
    """What a run did. The three maps are keyed by rule label and list rules with 0 rows too."""

    output_path: str
    input_rows: int = 0
    output_rows: int = 0
    rows_removed: int = 0
    rows_flagged: int = 0
    removed: dict[str, int] = field(default_factory=dict)
    set_null: dict[str, int] = field(default_factory=dict)
    flagged: dict[str, int] = field(default_factory=dict)
    dedup: str = DEDUP_AGGREGATE
    elapsed_seconds: float = 0.0

    def add(self, kind: str, rule: str, rows: int) -> None:
        if kind == TOTAL:
            setattr(self, rule, rows)
        else:
            getattr(self, kind)[rule] = rows

    def as_dict(self) -> dict[str, Any]:
        return asdict(self)

    def lines(self) -> list[str]:
        """Readable summary."""
        text = [
            f"{name.replace('_', ' ')}: {getattr(self, name):,}"
            for name in (INPUT_ROWS, ROWS_REMOVED, OUTPUT_ROWS, ROWS_FLAGGED)
        ]
        for kind in ("removed", "set_null", "flagged"):
            text += [f"{kind} {rule}: {rows:,}" for rule, rows in getattr(self, kind).items()]
        return text + [f"written to {self.output_path} in {self.elapsed_seconds}s"]


def _input_format(path: str) -> str:
    """By suffix; a folder without one of a known data file (``.json``, ``.gz``...) is Parquet."""
    name = path.rstrip("/").rsplit("/", 1)[-1].lower()
    if name.endswith((".csv", ".parquet")) or name.endswith(_OTHER_FILES):
        return format_of(path)
    return PARQUET


def read_for_cleaning(
    spark: SparkSession,
    path: str,
    period: Period,
    input_format: str | None = None,
    schema: str | None = None,
) -> tuple[DataFrame, Period]:
    """The input and the month rule's period: given, in the path's name, or per data file.

    Per data file, names are looked at before anything runs: one that names an impossible month is
    an error. Rows of files that name none are not checked against a month.
    """
    df = read_table(spark, path, format=input_format or _input_format(path), schema=schema)
    if period == FROM_NAME:
        return df, month_of_path(path)
    if period == PER_FILE:
        check_file_months(df)
        return with_file_month(df, _FILE_MONTH), MonthColumn(_FILE_MONTH)
    return df, period


def write_cleaned(
    df: DataFrame,
    output_path: str,
    catalog: Catalog = YELLOW_TAXI,
    period: Period = None,
    *,
    output_format: str | None = None,
    dedup: str = DEDUP_AGGREGATE,
) -> CleanOutcome:
    """Clean ``df``, write it and return the counts.

    Runs in ``df``'s session and leaves its settings alone; :func:`run` uses a session of its own,
    with shuffles sized for the input. The input is counted in a second, narrow scan and the output by reading it back, so a task that
    runs twice cannot change the numbers. Duplicates are dropped by one aggregation whatever the
    size; ``dedup="fingerprint"`` asks for the other way by name.
    """
    if dedup not in (DEDUP_AGGREGATE, DEDUP_FINGERPRINT):
        raise ValueError(f"Unknown way of dropping duplicates: {dedup}")
    check_columns(df, catalog)
    kind = output_format or _input_format(output_path)
    started = time.perf_counter()
    outcome = _write_exact(df, output_path, kind, catalog, period, dedup)
    outcome.elapsed_seconds = round(time.perf_counter() - started, 3)
    return outcome


def _write_exact(
    df: DataFrame, path: str, kind: str, catalog: Catalog, period: Period, dedup: str
) -> CleanOutcome:
    drop = drop_rare_duplicates if dedup == DEDUP_FINGERPRINT else drop_duplicates
    cleaned = clean(df, catalog, period, drop)
    write_table(cleaned, path, format=kind)
    # A text may hold line ends; each file we wrote is one task anyway.
    written = read_table(df.sparkSession, path, format=kind, schema=cleaned.schema, multi_line=kind == CSV)
    outcome = CleanOutcome(path, dedup=dedup)
    # Bounded by the catalogue: one row per rule.
    for row in clean_summary(df, catalog, period, cleaned=written).collect():
        outcome.add(row["kind"], row["rule"], row["rows"])
    return outcome


def run(
    input_path: str,
    output_path: str,
    spark: SparkSession | None = None,
    *,
    catalog: Catalog = YELLOW_TAXI,
    period: Period = FROM_NAME,
    input_format: str | None = None,
    input_schema: str | None = None,
    output_format: str | None = None,
    dedup: str = DEDUP_AGGREGATE,
) -> CleanOutcome:
    """Clean one file or folder into ``output_path``, in a session of the job's own on the same
    Spark. Stops Spark only if it started it itself.

    ``input_schema`` spares CSV input the extra pass that infers its types.
    """
    own = spark is None and SparkSession.getActiveSession() is None
    session = spark or get_session("rowguard_clean")
    job = private_session(session)
    try:
        df, expected = read_for_cleaning(job, input_path, period, input_format, input_schema)
        size_shuffles(job, df)
        return write_cleaned(
            df,
            output_path,
            catalog,
            expected,
            output_format=output_format,
            dedup=dedup,
        )
    finally:
        if own:
            session.stop()


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Clean yellow-taxi trips by the quality rules.")
    parser.add_argument("--input", required=True, help="Parquet or CSV file or folder")
    parser.add_argument("--output", required=True, help="folder to write, .csv for CSV")
    parser.add_argument(
        "--period",
        default=FROM_NAME,
        help=f"YYYY-MM, {FROM_NAME} (of the input path) or {PER_FILE} (of each data file)",
    )
    parser.add_argument("--input-format", choices=(PARQUET, CSV))
    parser.add_argument("--input-schema", help="column names and types, as in CREATE TABLE")
    parser.add_argument("--output-format", choices=(PARQUET, CSV))
    parser.add_argument(
        "--dedup", default=DEDUP_AGGREGATE, choices=(DEDUP_AGGREGATE, DEDUP_FINGERPRINT)
    )
    options = parser.parse_args(arguments)
    outcome = run(
        options.input,
        options.output,
        period=options.period,
        input_format=options.input_format,
        input_schema=options.input_schema,
        output_format=options.output_format,
        dedup=options.dedup,
    )
    print("\n".join(outcome.lines()))


if __name__ == "__main__":
    main()

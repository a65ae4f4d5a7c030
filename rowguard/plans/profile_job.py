"""Batch job: profile trips against the catalogue and write the report table.

    python -m rowguard.plans.profile_job --input RAW [--report FOLDER]
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from rowguard.catalogs import YELLOW_TAXI
from rowguard.operators.cleaning import Period
from rowguard.operators.report import quality_report
from rowguard.plans.clean_job import FROM_NAME, read_for_cleaning
from rowguard.plans.sizing import size_shuffles
from rowguard.rules import Catalog
from rowguard.session import get_session, private_session
from rowguard.sources.tables import CSV, PARQUET

REPORT_FORMATS = ("json", CSV, PARQUET)


def report_path_for(input_path: str) -> str:
    """Next to the input: ``<name without suffix>_dq_report``."""
    folder, slash, name = input_path.rstrip("/").rpartition("/")
    stem = name.rpartition(".")[0] or name
    return f"{folder}{slash}{stem}_dq_report"


def run(
    input_path: str,
    report_path: str | None = None,
    spark: SparkSession | None = None,
    *,
    catalog: Catalog = YELLOW_TAXI,
    period: Period = FROM_NAME,
    input_format: str | None = None,
    input_schema: str | None = None,
    report_format: str = "json",
) -> str:
    """Profile one file or folder; returns where the report was written."""
    if report_format not in REPORT_FORMATS:
        raise ValueError(f"Unsupported report format: {report_format}")
    own = spark is None and SparkSession.getActiveSession() is None
    session = spark or get_session("rowguard_profile")
    job = private_session(session)
    target = report_path or report_path_for(input_path)
    try:
        df, expected = read_for_cleaning(job, input_path, period, input_format, input_schema)
        size_shuffles(job, df)
        writer = quality_report(df, catalog, expected).write.mode("overwrite").format(report_format)
        if report_format == CSV:
            writer = writer.option("header", True)
        writer.save(target)
        return target
    finally:
        if own:
            session.stop()


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Profile yellow-taxi trips by the quality rules.")
    parser.add_argument("--input", required=True, help="Parquet or CSV file or folder")
    parser.add_argument("--report", help="folder for the report; by default next to the input")
    parser.add_argument("--report-format", default="json", choices=REPORT_FORMATS)
    parser.add_argument("--period", default=FROM_NAME)
    parser.add_argument("--input-format", choices=(PARQUET, CSV))
    parser.add_argument("--input-schema", help="column names and types, as in CREATE TABLE")
    options = parser.parse_args(arguments)
    target = run(
        options.input,
        options.report,
        period=options.period,
        input_format=options.input_format,
        input_schema=options.input_schema,
        report_format=options.report_format,
    )
    print(f"report written to {target}")


if __name__ == "__main__":
    main()

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from rowguard.catalogs import YELLOW_TAXI
from rowguard.operators.cleaning import clean
from rowguard.plans import clean_job, profile_job
from rowguard.plans.sizing import (
    input_bytes,
    shuffle_partitions,
    size_shuffles,
)
from rowguard.session import private_session
from rowguard.sources.tables import check_file_months, read_table, write_table
from tests.samples import GOOD, MONTH, ROWS, SCHEMA, good_but, trips_of

RAW_ROWS = [
    *ROWS,
    GOOD,
    good_but(passenger_count=0, fare_amount=20.0),
    good_but(passenger_count=12, fare_amount=20.0),
]


@pytest.fixture
def raw(spark, tmp_path):
    path = str(tmp_path / "yellow_tripdata_2025-01.parquet")
    write_table(trips_of(spark, RAW_ROWS), path)
    return path


EXPECTED = {
    "input_rows": 8,
    "output_rows": 4,
    "rows_removed": 4,
    "rows_flagged": 2,
    "removed": {
        "trip_distance:below_min": 2,
        "dropoff_before_pickup": 1,
        "exact_duplicate_rows": 2,
    },
    "set_null": {"passenger_count:below_min": 2, "passenger_count:above_max": 2},
    "flagged": {
        "trip_distance:above_max": 1,
        "fare_amount:below_min": 1,
        "fare_amount:above_max": 1,
        "total_amount:below_min": 1,
        "total_amount:above_max": 1,
        "RatecodeID:domain": 0,
        "pickup_outside_file_month": 1,
    },
}


def plain(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize(
    "dedup",
    ["aggregate", "fingerprint"],
)
@pytest.mark.parametrize("target", ["out.spark_cleaned", "out.csv"])
def test_clean_job(spark, raw, tmp_path, dedup, target):
    path = str(tmp_path / target)
    outcome = clean_job.run(raw, path, spark, dedup=dedup).as_dict()
    assert {key: outcome[key] for key in EXPECTED} == EXPECTED
    assert outcome["output_path"] == path
    assert outcome["elapsed_seconds"] > 0
    cleaned = clean(trips_of(spark, RAW_ROWS), YELLOW_TAXI, MONTH)
    kind = "csv" if target.endswith("csv") else "parquet"
    back = read_table(spark, path, format=kind, schema=cleaned.schema)
    assert plain(back) == plain(cleaned)
    # The session is the caller's and stays alive.
    assert spark.range(1).count() == 1


def test_clean_job_reads_csv(spark, tmp_path):
    raw, out = str(tmp_path / "t_2025-01.csv"), str(tmp_path / "out")
    write_table(trips_of(spark, RAW_ROWS), raw)
    outcome = clean_job.run(raw, out, spark).as_dict()
    assert {key: outcome[key] for key in EXPECTED} == EXPECTED
    typed = clean_job.run(raw, out, spark, input_schema=SCHEMA).as_dict()
    assert {key: typed[key] for key in EXPECTED} == EXPECTED


def test_clean_job_month_per_file(spark, tmp_path):
    folder, out = tmp_path / "raw", str(tmp_path / "out")
    for month in ("2024-12", "2025-01"):
        write_table(trips_of(spark), str(folder / f"yellow_tripdata_{month}.parquet"))
    outcome = clean_job.run(str(folder) + "/*.parquet", out, spark, period="per-file")
    assert outcome.input_rows == 10
    assert outcome.flagged["pickup_outside_file_month"] == 1 + 4
    written = spark.read.parquet(out)
    assert written.columns == [*trips_of(spark).columns, "dq_flags"]


def test_clean_job_with_given_month(spark, raw, tmp_path):
    outcome = clean_job.run(raw, str(tmp_path / "out"), spark, period="2024-12")
    assert outcome.flagged["pickup_outside_file_month"] == 7


def test_clean_job_refuses_bad_input(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        clean_job.run(str(tmp_path / "none.parquet"), out, spark)
    for name in ("a.json", "a.txt", "a.csv.gz"):
        with pytest.raises(ValueError, match="Unsupported"):
            clean_job.run(str(tmp_path / name), out, spark)
    with pytest.raises(ValueError, match="duplicates"):
        clean_job.run(raw, out, spark, dedup="sort")
    narrow = str(tmp_path / "narrow.parquet")
    write_table(trips_of(spark).select("fare_amount"), narrow)
    with pytest.raises(ValueError, match="Missing required columns"):
        clean_job.run(narrow, out, spark)


def test_clean_job_command_line(spark, raw, tmp_path, capsys):
    clean_job.main(["--input", raw, "--output", str(tmp_path / "out")])
    printed = capsys.readouterr().out
    assert "input rows: 8" in printed
    assert "removed exact_duplicate_rows: 2" in printed
    assert spark.range(1).count() == 1


@pytest.mark.parametrize("kind", ["json", "csv", "parquet"])
def test_profile_job(spark, raw, kind):
    path = profile_job.run(raw, None, spark, report_format=kind)
    assert path.endswith("yellow_tripdata_2025-01_dq_report")
    reader = spark.read.format(kind).option("header", True)
    found = {(r["section"], r["rule"], r["metric"]): r["value"] for r in reader.load(path).collect()}
    assert str(found[("file", None, "total_records")]) == "8"
    assert str(found[("cross_field", "exact_duplicate_rows", "invalid")]) == "1"


def test_profile_job_command_line(spark, raw, tmp_path, capsys):
    target = tmp_path / "report"
    profile_job.main(["--input", raw, "--report", str(target)])
    assert str(target) in capsys.readouterr().out
    lines = [json.loads(l) for f in sorted(target.glob("*.json")) for l in f.read_text().splitlines()]
    assert lines[0]["metric"] == "total_records"
    with pytest.raises(ValueError, match="report format"):
        profile_job.run(raw, str(target), spark, report_format="txt")


@pytest.mark.parametrize("keep", ["false", "true"])
def test_counts_with_line_ends_and_without_rows(spark, raw, tmp_path, keep):
    df = read_table(spark, raw).withColumn("note", F.lit('two\n"lines", \nmore')).filter(keep)
    out = clean_job.write_cleaned(df, str(tmp_path / "notes.csv"), YELLOW_TAXI, MONTH)
    assert out.input_rows == df.count() == out.output_rows + out.rows_removed
    assert out.output_rows == clean(df, YELLOW_TAXI, MONTH).count()
    assert min(out.removed.values()) >= 0


def test_shuffle_partitions_grow_with_the_input(spark, raw):
    assert shuffle_partitions(None, 8) == 8
    assert shuffle_partitions(1 << 20, 8) == 8
    assert shuffle_partitions(1 << 40, 200) == 16_384
    assert shuffle_partitions(100 << 40, 200) == 1_638_400
    df = read_table(spark, raw)
    assert 0 < input_bytes(df) < 1 << 20
    own = private_session(spark)
    size_shuffles(own, df)
    assert own.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == str(256 << 20)
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert own.conf.get(first) == spark.conf.get("spark.sql.shuffle.partitions")
    assert spark.conf.get(first, None) is None


def test_jobs_in_threads_leave_the_session_alone(spark, raw, tmp_path):
    before = dict(spark.conf.getAll)
    seen = []

    def clean_one(number):
        outcome = clean_job.run(raw, str(tmp_path / f"out{number}"), spark)
        seen.append(dict(spark.conf.getAll) == before)
        return {key: outcome.as_dict()[key] for key in EXPECTED}

    with ThreadPoolExecutor(3) as pool:
        jobs = [pool.submit(clean_one, i) for i in range(2)]
        report = pool.submit(profile_job.run, raw, str(tmp_path / "report"), spark)
        assert [job.result() for job in jobs] == [EXPECTED, EXPECTED]
        assert report.result() == str(tmp_path / "report")
    assert seen == [True, True] and dict(spark.conf.getAll) == before


def test_impossible_months_are_refused_before_the_job(spark, tmp_path):
    folder, out = tmp_path / "raw", tmp_path / "out"
    for name in ("yellow_tripdata_2025-01", "yellow_tripdata_2025-13", "trips"):
        write_table(trips_of(spark), str(folder / f"{name}.parquet"))
    with pytest.raises(ValueError, match=r"\d of \d+ files name no valid month.*2025-13"):
        clean_job.run(str(folder) + "/*.parquet", str(out), spark, period="per-file")
    assert not out.exists()
    paths = [str(folder / f"{name}.parquet") for name in ("yellow_tripdata_2025-01", "trips")]
    check_file_months(spark.read.parquet(*paths))


def test_conditions_reach_the_scan(spark, raw):
    df = read_table(spark, raw)
    plan = clean(df, YELLOW_TAXI, MONTH)._jdf.queryExecution().executedPlan().toString()
    assert "Or(IsNull(trip_distance),GreaterThan(trip_distance,0.0))" in plan
    assert plan.count("Exchange") == 1
    assert "Python" not in plan
    flagged = df.withColumn("unused", F.lit(1))
    assert "unused" in clean(flagged, YELLOW_TAXI, MONTH).columns

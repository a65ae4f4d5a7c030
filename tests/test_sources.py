from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rowguard.catalogs import YELLOW_TAXI
from rowguard.functions.months import (
    Month,
    MonthColumn,
    month_in_file_path,
    month_of_file,
    month_of_path,
)
from rowguard.operators.cleaning import clean
from rowguard.session import DEFAULTS, get_session, private_session
from rowguard.sources.scratch import reliable_checkpoint, scratch_folder, scratch_path
from rowguard.sources.tables import (
    check_file_months,
    file_month,
    file_month_counts,
    format_of,
    read_table,
    with_file_month,
    write_table,
)
from tests.samples import MONTH, SCHEMA, trips_of


def plain(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize(
    ("path", "kind"),
    [
        ("a/b.parquet", "parquet"),
        ("a/b.PARQUET/", "parquet"),
        ("a.d/b.Csv", "csv"),
        ("scheme://bucket/x.csv", "csv"),
    ],
)
def test_format_by_suffix(path, kind):
    assert format_of(path) == kind


@pytest.mark.parametrize("path", ["a/b.json", "a/b", "a.csv/b", "x.parquet.gz"])
def test_other_suffixes_are_refused(spark, path):
    with pytest.raises(ValueError, match="Unsupported file type"):
        read_table(spark, path)


@pytest.mark.parametrize("suffix", ["parquet", "csv"])
def test_missing_path(spark, tmp_path, suffix):
    with pytest.raises(FileNotFoundError):
        read_table(spark, str(tmp_path / f"none.{suffix}"))


def test_parquet_round_trip(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    cleaned = clean(trips_of(spark), YELLOW_TAXI, MONTH)
    write_table(cleaned, path)
    back = read_table(spark, path)
    assert back.dtypes == cleaned.dtypes
    assert plain(back) == plain(cleaned)
    write_table(cleaned.limit(0), path)
    assert read_table(spark, path).count() == 0
    assert any(file.name.endswith(".snappy.parquet") for file in (tmp_path / "t.parquet").iterdir())


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    cleaned = clean(trips_of(spark), YELLOW_TAXI, MONTH)
    write_table(cleaned, path)
    assert plain(read_table(spark, path, schema=cleaned.schema)) == plain(cleaned)
    inferred = dict(read_table(spark, path).dtypes)
    assert inferred["trip_distance"] == "double"
    assert inferred["passenger_count"] == "int"
    assert inferred["tpep_pickup_datetime"] == "timestamp"
    assert inferred["dq_flags"] == "string"


def test_cleaning_a_csv_file(spark, tmp_path):
    path = tmp_path / "yellow_tripdata_2025-01.csv"
    names = [part.split()[0] for part in SCHEMA.replace("\n", " ").split(",")]
    lines = [
        "1.5,1,12.5,15.0,1,2025-01-01 10:00:00,2025-01-01 10:20:00,1",
        "3.0,,10.0,12.0,,2025-02-01 11:00:00,2025-02-01 11:50:00,4",
    ]
    path.write_text("\n".join([",".join(names), *lines]) + "\n")
    found = clean(read_table(spark, str(path)), YELLOW_TAXI, month_of_path(str(path))).collect()
    assert {row["dq_flags"] for row in found} == {None, "pickup_outside_file_month"}


def test_csv_null_text(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b\n1,x\nN/A,\n3,N/A\n")
    assert dict(read_table(spark, str(path)).dtypes)["a"] == "string"
    df = read_table(spark, str(path), null_value="N/A")
    assert dict(df.dtypes)["a"] == "int"
    assert [tuple(row) for row in df.collect()] == [(1, "x"), (None, None), (3, None)]


def test_month_of_path():
    assert month_of_path("data/yellow_tripdata_2025-01.parquet") == Month(2025, 1)
    assert month_of_path("s3://b/yellow_tripdata_2024-12.spark_cleaned/") == Month(2024, 12)
    assert month_of_path("2025-01/trips.parquet") is None
    assert month_of_path("trips_1999-01.parquet") is None
    assert month_of_path("2023-05_to_2023-06.csv") == Month(2023, 5)
    for name in ("trips_2025-13.parquet", "trips_2025-00.parquet"):
        with pytest.raises(ValueError, match="no valid month"):
            month_of_path(name)


def test_month_bounds():
    assert Month(2024, 12).day_after == "2025-01-01"
    assert Month(2025, 1).day_after == "2025-02-01"
    assert Month(2025, 11).first_day == "2025-11-01"
    assert Month.parse("2025-07") == Month(2025, 7)
    for text in ("2025-7", "2025-13", "July", ""):
        with pytest.raises(ValueError):
            Month.parse(text)


def test_month_in_file_path(spark):
    cases = {
        "file:/d/yellow_tripdata_2025-01.parquet": "2025-01",
        "file:/d/yellow_tripdata_2025-01.parquet/part-0-2031-0744-c000.parquet": "2025-01",
        "file:/d/2025-01/trips.parquet": None,
        "file:/d/x/part-00000-aa2025-1199.parquet": None,
        "file:/d/yellow_tripdata_2025-13.parquet": None,
        "plain_2024-06.csv": "2024-06",
    }
    df = spark.createDataFrame([(path,) for path in cases], "p string")
    found = df.select("p", month_in_file_path(F.col("p"))).collect()
    assert {row[0]: row[1] for row in found} == cases


def test_file_month_of_a_folder_of_files(spark, tmp_path):
    rows = trips_of(spark).coalesce(1)
    for month in ("2024-12", "2025-01"):
        write_table(rows, str(tmp_path / f"yellow_tripdata_{month}.parquet"))
    df = spark.read.parquet(*[str(p) for p in sorted(tmp_path.glob("*.parquet"))])
    months = df.select(file_month().alias("m")).groupBy("m").count().collect()
    assert {row["m"]: row["count"] for row in months} == {"2024-12": 5, "2025-01": 5}
    cleaned = clean(with_file_month(df), YELLOW_TAXI, MonthColumn("file_month"))
    assert "file_month" not in cleaned.columns
    outside = cleaned.filter(F.col("dq_flags").contains("pickup_outside_file_month"))
    assert outside.count() == 3


def test_file_months_named(spark, tmp_path):
    rows = trips_of(spark).coalesce(1)
    for name in ("t_2025-01", "t_2025-13", "t"):
        write_table(rows, str(tmp_path / f"{name}.parquet"))
    df = spark.read.parquet(*[str(p) for p in sorted(tmp_path.glob("*.parquet"))])
    found = {(r["named"], r["month"]): r["rows"] for r in file_month_counts(df).collect()}
    assert found == {("2025-01", "2025-01"): 5, ("2025-13", None): 5, (None, None): 5}
    assert month_of_file("/d/t_2025-02.parquet/part-0-2031-11.parquet").text == "2025-02"
    with pytest.raises(ValueError, match="2025-13"):
        check_file_months(df)


AWKWARD = [
    None, "", " ", "a,b", '"quoted"', 'say "it", he said', "  leading and trailing  ", "line\nfeed",
    "carriage\rreturn", "both\r\n", "\n", "\\n", "\\", "\\\\n\\", "\\N", "\\\\N", "tab\t", "#comment", "é漢😀",
    "\x85 \u2028", "'", ",", '"', '""', '\\"', "NULL", "null", "1", "true", "\ufeffmark",
]


def test_any_text_survives_the_lines_dialect(spark, tmp_path):
    rows = [(i, text, f"{i}") for i, text in enumerate(AWKWARD)]
    df = spark.createDataFrame(rows, "id int, `te xt` string, other string")
    path = str(tmp_path / "texts.csv")
    write_table(df, path, dialect="lines")
    back = read_table(spark, path, schema=df.schema, dialect="lines")
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    lines = [line for f in tmp_path.glob("texts.csv/part-*") for line in f.read_bytes().splitlines()]
    heads = sum(line.startswith(b"id,") for line in lines)
    assert len([x for f in tmp_path.glob("texts.csv/part-*") for x in f.read_bytes().split(b"\n") if x]) == (
        len(rows) + heads
    )


def test_standard_csv_keeps_line_ends_but_not_empty_text(spark, tmp_path):
    rows = [(i, text) for i, text in enumerate(AWKWARD)]
    df = spark.createDataFrame(rows, "id int, text string")
    path = str(tmp_path / "texts.csv")
    write_table(df, path)
    back = read_table(spark, path, schema=df.schema, multi_line=True)
    assert sorted(map(tuple, back.collect())) == [(i, text or None) for i, text in rows]


def test_unknown_dialects_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="dialect"):
        write_table(spark.range(1), str(tmp_path / "x.csv"), dialect="excel")
    with pytest.raises(ValueError, match="dialect"):
        read_table(spark, str(tmp_path / "x.csv"), dialect="excel")


def test_a_running_session_is_left_alone(spark):
    before = dict(spark.conf.getAll)
    other = get_session("another name", extra_config={"spark.sql.shuffle.partitions": "17"})
    assert other is not spark and other._jsc is spark._jsc
    assert other.conf.get("spark.sql.shuffle.partitions") == "17"
    for key, value in DEFAULTS.items():
        assert other.conf.get(key) == value
    assert dict(spark.conf.getAll) == before


def test_private_sessions_copy_settings(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Oslo")
    try:
        own = private_session(spark, {"spark.sql.shuffle.partitions": "9"})
        assert own.conf.get("spark.sql.session.timeZone") == "Europe/Oslo"
        assert own.conf.get("spark.sql.shuffle.partitions") == "9"
        own.conf.set("spark.sql.ansi.enabled", "false")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_scratch_folder_is_stable_and_paths_are_new(spark):
    assert scratch_folder(spark) == scratch_folder(spark)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_scratch_folder_of_the_cluster_is_used(spark, tmp_path):
    class Conf:
        def get(self, key, default=None):
            return str(tmp_path) if key == "spark.checkpoint.dir" else default

    class Session:
        conf = Conf()

    assert scratch_path(Session(), "x").startswith(str(tmp_path))


def test_cluster_without_scratch_folder_is_refused():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(Session())


def test_checkpoint_keeps_the_rows(spark):
    df = trips_of(spark)
    assert plain(reliable_checkpoint(df)) == plain(df)

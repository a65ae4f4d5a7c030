"""Parquet and CSV tables, chosen by suffix or by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowguard.functions.months import month_in_file_path, month_of_file, text_in_file_path
from rowguard.functions.values import named

PARQUET = "parquet"
CSV = "csv"
FORMATS = (PARQUET, CSV)

#: How text stands in CSV. ``standard``: quoted where needed, quotes doubled, line ends as they are;
#: null and empty text both stand as the empty field or ``""`` and are read as null.
STANDARD = "standard"
#: ``lines``: as before, but backslash, line feed and carriage return are written as ``\\``, ``\n``
#: and ``\r``, and null as ``\N``. A record is one line, so large files are read in
#: parts, and any text comes back as it was, empty text included.
LINES = "lines"
DIALECTS = (STANDARD, LINES)
_NULL = "\\N"


def format_of(path: str) -> str:
    """``parquet`` or ``csv`` by the lower-cased suffix of the path; any other is refused."""
    name = str(path).rstrip("/").rsplit("/", 1)[-1]
    suffix = name.rpartition(".")[2].lower() if "." in name else ""
    if suffix not in FORMATS:
        raise ValueError(f"Unsupported file type: {'.' + suffix if suffix else name!r}")
    return suffix


def _on_texts(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({name: change(named(name)) for name in texts}) if texts else df


def escaped(text: Column) -> Column:
    """Text without line ends: each stands as a backslash and a letter, a backslash as two."""
    for plain, written in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescaped(text: Column) -> Column:
    """The text that :func:`escaped` was given."""

    def part(between: Column) -> Column:
        for plain, written in (("\n", "\\n"), ("\r", "\\r")):
            between = F.replace(between, F.lit(written), F.lit(plain))
        return between

    # Between double backslashes a backslash can only begin the sign for a line end.
    parts = F.split(text, r"\\\\", -1)
    changed = F.array_join(F.transform(parts, part), "\\")
    return F.when(F.contains(text, F.lit("\\")), changed).otherwise(text)


def read_table(
    spark: SparkSession,
    path: str,
    *,
    format: str | None = None,  # noqa: A002 - the word Spark uses
    schema: T.StructType | str | None = None,
    null_value: str | None = None,
    multi_line: bool = False,
    dialect: str = STANDARD,
) -> DataFrame:
    """Read one file or a folder of files.

    The format comes from the suffix unless given. CSV files have a header. Without a schema their
    types are inferred, which reads the whole input once more, so give one for large inputs.
    ``null_value`` is the text that stands for null besides the empty field; empty text is null.
    Quotes inside a quoted field are doubled. ``multi_line`` allows line ends in quoted fields; such
    files cannot be split, so each is one task. Values that do not fit a given schema become null.
    Files written in the ``lines`` dialect are read in it; they keep empty text apart from null.
    """
    _check_dialect(dialect)
    kind = format or format_of(path)
    if kind not in FORMATS:
        raise ValueError(f"Unsupported file type: {kind}")
    reader = spark.read.format(kind)
    if schema is not None:
        reader = reader.schema(schema)
    if kind == CSV:
        reader = reader.option("header", True).option("inferSchema", schema is None)
        reader = reader.option("escape", '"').option("multiLine", multi_line)
        if dialect == LINES:
            reader = reader.option("nullValue", _NULL)
        elif null_value is not None:
            reader = reader.option("nullValue", null_value)
    try:
        df = reader.load(str(path))
        return _on_texts(df, unescaped) if kind == CSV and dialect == LINES else df
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(str(path)) from error
        raise


def _check_dialect(dialect: str) -> None:
    if dialect not in DIALECTS:
        raise ValueError(f"Unknown CSV dialect: {dialect}")


def write_table(
    df: DataFrame,
    path: str,
    *,
    format: str | None = None,  # noqa: A002
    dialect: str = STANDARD,
) -> None:
    """Write ``df``, replacing what is at ``path``: snappy Parquet, or CSV with a header."""
    _check_dialect(dialect)
    kind = format or format_of(path)
    if kind not in FORMATS:
        raise ValueError(f"Unsupported file type: {kind}")
    if kind == CSV and dialect == LINES:
        df = _on_texts(df, escaped)
    writer = df.write.mode("overwrite").format(kind)
    if kind == PARQUET:
        writer = writer.option("compression", "snappy")
    else:
        writer = writer.option("header", True).option("escape", '"')
        for blanks in ("ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace"):
            writer = writer.option(blanks, False)
        if dialect == LINES:
            writer = writer.option("nullValue", _NULL)
    writer.save(str(path))


def file_month() -> Column:
    """Month (``YYYY-MM``) named by the file a row comes from; null if there is none.

    Only usable on a table just read from files, before any projection hides the file metadata.
    """
    return month_in_file_path(named("_metadata").getField("file_path"))


def with_file_month(df: DataFrame, name: str = "file_month") -> DataFrame:
    """``df`` with each row's file month, to be used as ``MonthColumn(name)``."""
    return df.withColumn(name, file_month())


def file_month_counts(df: DataFrame) -> DataFrame:
    """Rows by what their files' names say: ``(named, month, rows)``.

    ``named`` is what stands for a month in the name, null if nothing does; ``month`` is null also if
    that is no possible month. Rows with a null month are not checked by the month rule.
    """
    path = named("_metadata").getField("file_path")
    text = F.nullif(text_in_file_path(path), F.lit(""))
    month = month_in_file_path(path)
    return (
        df.select(text.alias("named"), month.alias("month"))
        .groupBy("named", "month")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def check_file_months(df: DataFrame) -> None:
    """Fail if the name of an input file holds an impossible month (``2025-13``).

    Looks at names only, which the driver has from listing the files; no job runs.
    """
    wrong = []
    files = df.inputFiles()
    for path in files:
        try:
            month_of_file(path)
        except ValueError:
            wrong.append(path)
    if wrong:
        shown = ", ".join(sorted(wrong)[:5])
        raise ValueError(f"{len(wrong)} of {len(files)} files name no valid month: {shown}")

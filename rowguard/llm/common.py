"""What several operators share: the shared scratch folder, sizes, and the given columns."""

from __future__ import annotations

import ctypes
import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where it is unset on a local master, one of our own."""
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"Set {_SETTING} to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rowguard-llm-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: what follows reads it and survives a lost executor.

    The shuffle files that made it go as soon as it is written, where Spark can do that (4.1)."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def parts_for(amount: int, each: int) -> int:
    """How many parts of about ``each`` make up ``amount``; one at least, no upper limit."""
    return max(1, math.ceil(amount / each))


def text_or_empty(column: Column | str = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def lower_ascii(column: Column) -> Column:
    """A-Z in lower case and nothing else changed."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts."""
    return docs.agg(F.sum(F.octet_length(text_or_empty())).alias("n")).first()["n"] or 0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def release_memory() -> None:
    """Give memory that a Python worker no longer uses back to the machine; workers live on after a
    task, and what they keep counts against the executor."""
    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass

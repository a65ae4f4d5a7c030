"""Fitting the shuffle to the size of the input."""

from __future__ import annotations

import math
from pyspark.sql import DataFrame, SparkSession

_SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
_FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_MERGED_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"

# A Parquet byte becomes about this many bytes as shuffled rows.
EXPANSION = 4
# Also what AQE merges small partitions to, which makes files of about 64 MB.
TARGET_PARTITION_BYTES = 256 << 20
# Spark's size for sources it knows nothing about is in the exabytes.
_UNKNOWN_BYTES = 1 << 60


def input_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of ``df``, None if there is none. Reads file sizes, no data."""
    if not hasattr(df, "_jdf"):  # Spark Connect has no handle on the plan
        return None
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < _UNKNOWN_BYTES else None


def shuffle_partitions(size: int | None, at_least: int) -> int:
    """Partitions for a full-row shuffle of an input of ``size`` bytes. AQE merges small ones."""
    if size is None:
        return at_least
    needed = math.ceil(size * EXPANSION / TARGET_PARTITION_BYTES)
    return max(at_least, needed)


def size_shuffles(session: SparkSession, df: DataFrame) -> None:
    """Give ``session``, a job's own, the shuffle settings that reading ``df`` in it asks for.

    The number is what adaptive execution starts from; it merges partitions up to the target size.
    """
    least = session.conf.get(_FIRST_PARTITIONS, None) or session.conf.get(_SHUFFLE_PARTITIONS)
    session.conf.set(_FIRST_PARTITIONS, str(shuffle_partitions(input_bytes(df), int(least))))
    session.conf.set(_MERGED_BYTES, str(TARGET_PARTITION_BYTES))

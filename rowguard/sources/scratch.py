"""The shared scratch folder for data that has to outlive an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def scratch_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    If the setting is absent, a local run gets a folder of its own. A cluster run does not: a
    folder on one machine would be lost with it.
    """
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"Set {_SETTING} to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="rowguard-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the scratch folder that nothing has been written to yet."""
    return f"{scratch_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """``df`` written to the scratch folder and read from there from now on."""
    spark = df.sparkSession
    folder = scratch_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)

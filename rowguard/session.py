"""The Spark sessions of jobs and tests."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark import SparkContext
from pyspark.sql import SparkSession

# The settings results depend on, and those the plans are made for.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.parquet.int96RebaseModeInRead": "CORRECTED",
    "spark.sql.parquet.datetimeRebaseModeInRead": "CORRECTED",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The extra hash map in front of an aggregation's own helps if keys repeat within a task. Those of
    # the large aggregations here, whole rows and their fingerprints, hardly do: a quarter slower.
    "spark.sql.codegen.aggregate.map.twolevel.enabled": "false",
    # Noting the Python line behind every column expression doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def private_session(running: SparkSession, settings: Mapping[str, str] | None = None) -> SparkSession:
    """A session on the same Spark application with a copy of ``running``'s settings, and
    ``settings`` on top. What is set there is seen by no one else."""
    own = running.newSession()
    for key, value in {**running.conf.getAll, **(settings or {})}.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


def get_session(
    app_name: str = "rowguard",
    *,
    master: str | None = None,
    extra_config: Mapping[str, str] | None = None,
) -> SparkSession:
    """A session with our settings. Leave ``master`` out when submitting to a cluster.

    If Spark is running already, the running session stays as it is and a private one beside it is
    returned; settings that only a new application can take are then left as they are.
    """
    settings = {**DEFAULTS, **(extra_config or {})}
    if SparkContext._active_spark_context is not None:  # the only way to ask without starting it
        return private_session(SparkSession.builder.getOrCreate(), settings)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
